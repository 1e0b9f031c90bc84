"""Predicates for a data source's scan, given when it is loaded.

Spark can hand filters to a Python data source by itself (pushFilters), but it keeps them by loaded relation: two scans of one
loaded DataFrame in one plan, or a later one without filters, get the filters of whichever was planned last, and with
them wrong rows.  So the sources here take their predicates with the load, where each DataFrame has its own; with
option `pushdown` they take Spark's filters as well, for a DataFrame that is scanned once.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.datasource import EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith

KINDS = {"=": EqualTo, "<=>": EqualNullSafe, "<": LessThan, "<=": LessThanOrEqual, ">": GreaterThan, ">=": GreaterThanOrEqual, "in": In, "starts": StringStartsWith, "ends": StringEndsWith, "contains": StringContains}
NULLS = {"null": IsNull, "not null": IsNotNull}


def as_option(where: list[tuple]) -> str:
    """(column, operator) or (column, operator, value) tuples, all of which are to hold; `not ` before an operator denies it."""
    filters_of(made := json.dumps(where))
    return made


def filters_of(option: str | None) -> list[Filter]:
    out: list[Filter] = []
    for column, kind, *value in json.loads(option or "[]"):
        denied = kind.startswith("not ") and kind != "not null"
        kind = kind[4:] if denied else kind
        if kind in NULLS:
            one = NULLS[kind]((column,))
        elif kind in KINDS and len(value) == 1:
            one = KINDS[kind]((column,), tuple(value[0]) if kind == "in" else value[0])
        else:
            raise ValueError(f"no such predicate: {column} {kind}")
        out.append(Not(one) if denied else one)
    return out


def allow_pushdown(spark: SparkSession) -> None:
    """Spark hands filters to Python sources only where the session says so."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
