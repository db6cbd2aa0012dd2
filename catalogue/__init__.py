"""The queries the driver runs, their inputs derived from the given tables, and their SQL."""
