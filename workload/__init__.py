"""The operators applied to the test tables, with an independent SQL statement for each."""
