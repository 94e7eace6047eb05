"""Readers and writers: landing archives, table layers, mapping files, deliverables."""
