"""Importing the package registers every query."""

from riskloom.entrypoints import batch, observability, quality, storage, streams  # noqa: F401
from riskloom.entrypoints.registry import QUERIES

__all__ = ["QUERIES"]
