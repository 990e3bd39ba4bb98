"""Continuous arrival of cuts."""
