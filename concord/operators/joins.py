"""Lookup joins.

``attach`` writes the lookup side to the shared folder once, unless it is a written table already.
Spark then knows its size: a lookup within ``spark.sql.autoBroadcastJoinThreshold`` is broadcast
and the facts are not shuffled; a larger one is joined by a shuffle of two plain tables, where
adaptive execution splits the partitions of frequent keys (and of missing ones) however many
there are. Apart from that write nothing runs while a plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.session import checkpointed


def attach(
    facts: DataFrame, lookup: DataFrame, on: str | list[str], how: str = "left", written: bool = False
) -> DataFrame:
    """Join facts with a lookup that has one row per key.

    how      left, inner, left_semi or left_anti
    written  the lookup is read from a written table, so it is not written again
    """
    on = [on] if isinstance(on, str) else list(on)
    return facts.join(lookup if written else checkpointed(lookup), on, how)


def attach_many(facts: DataFrame, lookup: DataFrame, on: str, written: bool = False) -> DataFrame:
    """Inner join with a lookup that may repeat a key: every match is kept, missing keys match nothing."""
    known = lookup.where(F.col(on).isNotNull())
    return facts.join(known if written else checkpointed(known), on, "inner")
