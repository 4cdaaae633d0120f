"""Building blocks and batch jobs: table in, table out, for all keys at once."""
