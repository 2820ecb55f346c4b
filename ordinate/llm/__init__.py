"""Operators of training-data pipelines.  Nothing else in the library imports this subpackage."""

from ordinate.llm.queries import QUERIES, SQL  # noqa: F401
