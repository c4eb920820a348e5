"""Field comparison between a submitted and an enriched value."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions.text import casefold, with_identifiers

# The outcomes of comparing one field, in report order.
FIELD_STATUSES = ("match", "mismatch", "original_blank", "enrichment_blank", "both_blank")


def field_status(left: Column, right: Column, same: Column) -> Column:
    """Status of one field from its two normalised values and their sameness."""
    return (
        F.when(left.isNull() & right.isNull(), "both_blank")
        .when(left.isNull(), "original_blank")
        .when(right.isNull(), "enrichment_blank")
        .when(same, "match")
        .otherwise("mismatch")
    )


def compare_fields(
    rows: DataFrame,
    fields: Sequence[str],
    matcher: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Add <field>_match for original_<field> against enrichment_<field>.

    A matcher, when given, decides on the two raw values; otherwise the normalised values
    must agree after case folding. The normalised values are columns of their own for a
    moment, so that each is worked out once.
    """
    sides = {f"_{side}_{f}": f"{side}_{f}" for f in fields for side in ("original", "enrichment")}
    statuses = {}
    for f in fields:
        left, right = F.col(f"_original_{f}"), F.col(f"_enrichment_{f}")
        if matcher:
            same = matcher(F.col(f"original_{f}"), F.col(f"enrichment_{f}"))
        else:
            same = (left == right) | (casefold(left) == casefold(right))
        statuses[f"{f}_match"] = field_status(left, right, same)
    return with_identifiers(rows, sides).withColumns(statuses).drop(*sides)


def arrow_matcher(predicate: Callable[[pa.Array, pa.Array], pa.Array]) -> Callable[[Column, Column], Column]:
    """A matcher for compare_fields from a predicate over whole Arrow arrays.

    The predicate gets the two raw values of many rows as arrays of one length and returns a boolean
    array; a null in it is no match. Fields compared together go to Python in one step.
    """

    @F.arrow_udf("boolean")
    def same(left: pa.Array, right: pa.Array) -> pa.Array:
        found = predicate(left, right)
        if len(found) != len(left) or not pa.types.is_boolean(found.type):
            raise ValueError("a matcher returns one boolean for each row")
        return found.fill_null(False)

    return lambda left, right: same(left.cast("string"), right.cast("string"))


def agreement(statuses: list[Column]) -> Column:
    """Overall verdict: all_match and all_mismatch need every field to be comparable."""
    matches = sum((F.when(s == "match", 1).otherwise(0) for s in statuses), F.lit(0))
    misses = sum((F.when(s == "mismatch", 1).otherwise(0) for s in statuses), F.lit(0))
    return (
        F.when(matches == len(statuses), "all_match")
        .when(misses == len(statuses), "all_mismatch")
        .when(matches + misses > 0, "partial_match")
        .otherwise("no_comparable_field")
    )
