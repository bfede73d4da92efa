"""Registered queries of this subpackage, with the SQL each must agree with where SQL can express it."""

from murmura.llm import archives, collisions, contamination, divergence, language_model, licenses, lines, mixing, pages, quality, simhash, urls, whitening  # noqa: F401
from murmura.llm.base import CATALOG

__all__ = ["CATALOG"]
