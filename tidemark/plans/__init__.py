"""Runs: one cut, many cuts, a rebuild, and the reports after them."""
