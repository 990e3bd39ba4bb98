"""Snapshot change capture and Type 2 history on Spark DataFrames."""

from tidemark.model import Attribute, Cut, Derived, KeyColumn, TableSpec

__all__ = ["Attribute", "Cut", "Derived", "KeyColumn", "TableSpec"]
