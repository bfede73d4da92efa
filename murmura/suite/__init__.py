"""Registered queries over the given tables, each with the SQL that must give the same rows where SQL can."""

from murmura.suite import corpus, features, joins, search, sources, text, tokens, windows  # noqa: F401
from murmura.suite.base import CATALOG

__all__ = ["CATALOG"]
