"""Registered queries; importing this package fills the registry."""

from ordinate.plans import batches, combining, featuring, folds, reading, sequence, streams, table_functions  # noqa: F401
from ordinate.plans.registry import QUERIES, SQL  # noqa: F401
