"""DataFrame-to-DataFrame operators. Nothing here reads, writes or runs a job."""
