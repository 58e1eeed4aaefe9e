"""All queries of the library (without the llm subpackage) and their SQL."""

from . import queries2  # noqa: F401  adds its queries
from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
