"""Column-level building blocks.  Every function takes and returns ``Column``."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Sequence[tuple[Column, Any]], default: Any = None) -> Column:
    """Value of the first rule whose predicate is TRUE (a NULL predicate does not match)."""
    case = None
    for predicate, value in rules:
        case = F.when(predicate, value) if case is None else case.when(predicate, value)
    return case.otherwise(default) if default is not None else case


def null_of(type_name: str) -> Column:
    """A typed NULL, so that the column can be written to parquet and unioned."""
    return F.lit(None).cast(type_name)
