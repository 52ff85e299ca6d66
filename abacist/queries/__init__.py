"""Queries over the driver's tables, one module per subject."""

from abacist.queries import (  # noqa: F401
    credit, evaluate, marketing, models, prep, relational, series, supplier, survival,
)
from abacist.queries.registry import ORACLES, QUERIES  # noqa: F401
