"""The queries the driver runs, each beside the SQL that states the same result."""
