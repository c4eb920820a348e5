"""Mixing sources to target weights by subset-sum budget fitting.

Sources in code-point order (null last) get the weights in turn and share the words of all
documents by weight; what a source cannot take at `MOST` times its size is shared again by weight.
A source takes as many whole passes over its documents as its target allows. The rest of its budget
is fitted on the counts of documents by exact length: but for the last words the same share of every
length, then greedily from the longest, and the last words by a bounded knapsack over the lengths
that are left (a budget of no more than LAST_WORDS is thus met as nearly as can be).
Which documents of a length are taken follows a seeded hash of the id, so that reruns agree.

A document's size is its number of runs of characters other than space, \\t, \\n, \\v, \\f and \\r; a null
text has size 0. A null source is a source of its own; rows repeated in full are documents of their
own. An empty table gives an empty result; a source without words takes nothing.

No task gathers a source or a length: counts are added up by (source, size, one of BUCKETS parts by
hash) first, and only such a part, or the lengths of one source, is looked at as a group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concord.llm.frames import picked, table, written
from concord.operators.keyed import source_ordinal

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 17
#: Parts of the documents of one source and length; a part is ranked in one task.
BUCKETS = 4096
#: The knapsack fills the last so many words of a budget (more if every document is longer).
LAST_WORDS = 1 << 14
SIZE = r"[^\x20\x09-\x0D]+"


def water_level(sources: DataFrame, total: int) -> float:
    """The share for each unit of weight at which the targets add up to the total.

    sources: a written table of (weight, source_size). Each round adds up those at their limit,
    and ends when none is added; only sums reach the driver.
    """
    level = None
    limit = F.col("source_size") * MOST
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) > limit
        capped, weight = sources.agg(F.sum(F.when(full, limit).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if not weight:
            return level or 0.0
        new = (total - capped) / weight
        if level is not None and new <= level:
            return level
        level = new


def best_fit(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size (0 to counts) come closest to the budget of words.

    sizes: distinct and positive. Ends with an exact bounded knapsack over the last words.
    """
    order = np.argsort(-sizes, kind="stable")
    sizes, counts = sizes[order].astype(object), counts[order].astype(object)
    total = int((sizes * counts).sum()) if len(sizes) else 0
    taken = np.zeros(len(sizes), object)
    if total <= budget:
        taken[:] = counts
    elif budget > 0:
        taken = counts * max(0, budget - LAST_WORDS) // total
        left = budget - int((taken * sizes).sum())
        for i, size in enumerate(sizes):
            if left <= LAST_WORDS + sizes[0]:
                break  # the shorter ones are kept, to make up any sum
            n = min(counts[i] - taken[i], max(0, left - LAST_WORDS) // size)
            taken[i] += n
            left -= n * size
        taken += knapsack(sizes, counts - taken, left)
    back = np.zeros(len(sizes), np.int64)
    back[order] = taken.astype(np.int64)
    return back


def knapsack(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset sum nearest to the budget, from the shortest size upward.

    The sums that can be reached are the bits of an integer. Counts are split into powers of two;
    what was reachable before each part is kept, to go back from the best sum.
    """
    taken = np.zeros(len(sizes), object)
    free = [i for i in range(len(sizes) - 1, -1, -1) if counts[i] > 0]
    if budget <= 0 or not free:
        return taken
    high = 2 * budget  # a sum further away than nothing at all is never the nearest
    mask = (1 << (high + 1)) - 1
    reached, steps = 1, []
    for i in free:
        left, part = min(counts[i], high // sizes[i]), 1
        while left > 0 and not reached >> budget & 1:
            part = min(part, left)
            steps.append((i, part, reached))
            reached |= reached << int(part * sizes[i]) & mask
            left -= part
            part *= 2
    below = (reached & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reached >> (budget + 1)
    best = below
    if above and (above & -above).bit_length() < budget - below:
        best = budget + (above & -above).bit_length()
    for i, part, before in reversed(steps):
        if not before >> best & 1:
            taken[i] += part
            best -= int(part * sizes[i])
    return taken


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    """One source: whole passes, and how many documents of each size once more."""
    target, total = float(pdf["target"].iloc[0]), int(pdf["source_size"].iloc[0])
    passes = min(MOST, int(target // total)) if total else 0
    rest = 0 if passes == MOST else round(target - passes * total)
    sizes, counts = pdf["size"].to_numpy(), pdf["n"].to_numpy()
    more = np.zeros(len(pdf), np.int64)
    full = sizes > 0
    more[full] = best_fit(sizes[full], counts[full], rest)
    return pd.DataFrame(
        {"key": pdf["key"], "size": sizes, "passes": passes, "more": more, "source_size": total, "target": target}
    )


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words, repeats counted)."""
    docs = picked(docs, doc_id=id_column, text=text_column, source=source_column)
    hashed = F.xxhash64(F.lit(seed), "doc_id")
    base = written(
        docs.select(
            "doc_id",
            "source",
            # Sorts as the source does, null last.
            F.coalesce(F.concat(F.lit("0"), F.col("source").cast("string")), F.lit("1")).alias("key"),
            F.coalesce(F.regexp_count("text", F.lit(SIZE)), F.lit(0)).cast("long").alias("size"),
            hashed.alias("luck"),
            F.pmod(hashed, F.lit(BUCKETS)).cast("int").alias("part"),
        )
    )
    parts = written(base.groupBy("key", "size", "part").agg(F.count("*").alias("n")))
    lengths = parts.groupBy("key", "size").agg(F.sum("n").alias("n"))
    totals = written(lengths.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    sources = written(with_weights(totals, weights))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(sources, total)
    targets = sources.select(
        "key", "source_size", F.least(F.col("source_size").cast("double") * MOST, F.col("weight") * F.lit(level)).alias("target")
    )
    plan = (
        lengths.join(targets, "key")
        .groupBy("key")
        .applyInPandas(_fit, "key string, size long, passes long, more long, source_size long, target double")
    )
    before = Window.partitionBy("key", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.join(plan, ["key", "size"]).select(
        "key", "size", "part", "passes", "source_size", "target", (F.col("more") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("more")
    )
    nth = F.row_number().over(Window.partitionBy("key", "size", "part").orderBy("luck", "doc_id"))
    taken = F.col("size") * (F.col("passes") + F.when(nth <= F.col("more"), 1).otherwise(0))
    return base.join(parts, ["key", "size", "part"]).select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken")
    )


def with_weights(totals: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """(key, source_size, weight): the weights in turn, by the keys in order; no task sees all sources."""
    turn = F.pmod(F.col("nth") - 1, F.lit(len(weights))).cast("int")
    listed = F.array(*(F.lit(w).cast("long") for w in weights))
    return source_ordinal(totals, "key", "nth").select("key", "source_size", F.get(listed, turn).alias("weight"))


def op1_mixing(spark, folder: str) -> DataFrame:
    """doc_id, size, source_size, target, taken (and source) for every row of documents."""
    return mix_sources(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")
