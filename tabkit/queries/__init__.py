"""All registered queries."""

from . import modelling, preparation, quality, storage, tables  # noqa: F401  (each registers its queries)
from .registry import QUERIES

__all__ = ["QUERIES"]
