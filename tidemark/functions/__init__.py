"""Column builders: text, dates, hashes and exact sums."""
