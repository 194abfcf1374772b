"""All runnable queries by name, each over the given tables, with the SQL that checks it."""

from tallyframe.registry import blocks_functions, blocks_io, blocks_rows, flows  # noqa: F401
from tallyframe.registry.core import REGISTRY

__all__ = ["REGISTRY"]
