"""Row-by-row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame


def difference(spark_result: DataFrame, duck_result) -> str:
    """What differs between the two results, or the empty string."""
    ours = sorted(spark_result.columns)
    theirs = sorted(d[0] for d in duck_result.description)
    if ours != theirs:
        return f"columns {sorted(set(ours) ^ set(theirs))}"
    place = [[d[0] for d in duck_result.description].index(c) for c in theirs]
    right = Counter(tuple(row[i] for i in place) for row in duck_result.fetchall())
    left = Counter(tuple(row) for row in spark_result.select(*[f"`{c}`" for c in ours]).collect())
    if left == right:
        return ""
    only_left, only_right = left - right, right - left
    return (
        f"{sum(left.values())} and {sum(right.values())} rows; {sum(only_left.values())} only here, "
        f"{sum(only_right.values())} only there: {list(only_left)[:1]} {list(only_right)[:1]}"
    )
