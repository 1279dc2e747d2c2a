"""All registered queries; importing the area modules fills the registry."""

from . import (definitions, expectations, functions, hierarchy, history, metrics, quality, recon,  # noqa: F401
               relational, sources, tables, upserts)
from .base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
