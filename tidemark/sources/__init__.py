"""Reading cuts and keeping the published store."""
