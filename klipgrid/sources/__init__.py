"""Readers of tables and of the text formats the corpus arrives in."""

from .tables import table

__all__ = ["table"]
