"""Name standardisation, master data enrichment and duplicate rules for a catalog."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions.text import canonical_key, loose_key
from concord.operators.joins import attach
from concord.operators.keyed import keep_last, keep_none, maybe_repeated, repeated_rows
from concord.session import checkpointed

MASTER_COLUMNS = ("canonical_manufacturer_name", "region", "parent_manufacturer_id", "manufacturer_status")


def name_lookup(
    master: DataFrame,
    names: Sequence[str] = ("canonical_manufacturer_name", "display_name"),
    order_by: str = "manufacturer_id",
    key: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Every known name to its canonical name; the last row wins, later columns over earlier.

    ``key`` (for example ``canonical_key``) makes the lookup blind to case and blanks.
    """
    canonical = F.col("canonical_manufacturer_name")
    entries = F.array(
        *[F.struct(F.lit(i).alias("kind"), F.col(c).alias("name")) for i, c in enumerate(names)]
    )
    listed = master.select(
        canonical.alias("manufacturer_name_std"), F.col(order_by).alias("ord"), F.inline(entries)
    ).where(F.col("name").isNotNull())
    if key:
        listed = listed.withColumn("name", key(F.col("name"))).where("name <> ''")
    return keep_last(listed, "name", ["ord", "kind"]).select("name", "manufacturer_name_std")


def standardize_names(
    catalog: DataFrame,
    lookup: DataFrame,
    name: str = "manufacturer_name",
    key: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add manufacturer_name_std, null where the name is unknown."""
    raw = key(F.col(name)) if key else F.col(name)
    keyed = catalog.withColumn("_name", raw)
    return attach(keyed, lookup.withColumnRenamed("name", "_name"), "_name").drop("_name")


def _master_columns(master: DataFrame) -> DataFrame:
    kept = [c for c in MASTER_COLUMNS if c in master.columns]
    return master.where(F.col("manufacturer_id").isNotNull()).select("manufacturer_id", *kept)


def enrich(
    catalog: DataFrame, master: DataFrame, keep_unmatched: bool = False, stored: bool = False
) -> DataFrame:
    """Attach the master columns by manufacturer_id.

    As in the original job unmatched rows are lost, which makes any match rate taken
    afterwards 100 %. ``keep_unmatched`` keeps them and adds fk_matched. ``stored`` tells that the
    master is a stored table; if both are bucketed by manufacturer_id, they are joined in place.
    """
    side = _master_columns(master)
    if not keep_unmatched:
        return attach(catalog, side, "manufacturer_id", "inner", written=stored)
    flagged = side.withColumn("fk_matched", F.lit(True))
    joined = attach(catalog, flagged, "manufacturer_id", written=stored)
    return joined.withColumn("fk_matched", F.coalesce("fk_matched", F.lit(False)))


def _rate(flag: Column) -> Column:
    return F.coalesce(F.avg(flag.cast("double")), F.lit(0.0))


def match_rates(
    standardized: DataFrame, master: DataFrame, truth: str = "manufacturer_name_canonical"
) -> DataFrame:
    """Standardisation, foreign key and accuracy rates, with rows in and out, in one row.

    ``fk_rate_of_joined`` is the rate over the joined rows only, ``fk_rate`` the rate over
    all. Accuracy compares the standardised name with a ground-truth column.
    """
    rows = enrich(standardized, master, keep_unmatched=True)
    std, matched = F.col("manufacturer_name_std"), F.col("fk_matched")
    found = F.col("canonical_manufacturer_name").isNotNull()
    return rows.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(matched).alias("rows_out"),
        _rate(std.isNotNull()).alias("standardized_rate"),
        _rate(F.when(matched, found)).alias("fk_rate_of_joined"),
        _rate(matched).alias("fk_rate"),
        _rate(F.coalesce(std == F.col(truth), F.lit(False))).alias("accuracy"),
    )


def parent_rollup(master: DataFrame) -> DataFrame:
    """Top-level parent of every manufacturer, with depth and status.

    status is root (no parent but itself), rolled_up, orphan_parent (the chain ends at an id that is
    not in the master; that id is the top) or cycle (no top). Every round doubles the
    distance covered, so a chain of n steps needs about log2(n) joins; each round is
    written to the shared folder, and adaptive execution splits a much-used ancestor. A path
    of more steps than there are rows is a cycle, which bounds the rounds.
    """
    edges = checkpointed(
        master.where(F.col("manufacturer_id").isNotNull()).select(
            F.col("manufacturer_id").alias("id"),
            F.nullif("parent_manufacturer_id", "manufacturer_id").alias("up"),
        )
    )
    ids = edges.select(F.col("id").alias("up"), F.lit(True).alias("known"))
    # up: the next ancestor to follow, null once the chain has ended at `top`
    start = attach(edges, ids, "up", written=True).select(
        "id",
        F.when(F.col("known"), F.col("up")).alias("up"),
        F.coalesce("up", "id").alias("top"),
        F.when(F.col("up").isNull(), 0).otherwise(1).alias("depth"),
        (F.col("up").isNotNull() & F.col("known").isNull()).alias("orphan"),
    )
    state, reach, rows = checkpointed(start), 1, edges.count()
    while reach <= rows and not state.where(F.col("up").isNotNull()).isEmpty():
        step = state.select(
            F.col("id").alias("up"),
            F.col("up").alias("up2"),
            F.col("top").alias("top2"),
            F.col("depth").alias("depth2"),
            F.col("orphan").alias("orphan2"),
        )
        going = F.col("up").isNotNull()
        state = checkpointed(
            attach(state, step, "up", written=True).select(
                "id",
                F.col("up2").alias("up"),
                F.when(going, F.col("top2")).otherwise(F.col("top")).alias("top"),
                (F.col("depth") + F.when(going, F.col("depth2")).otherwise(0)).alias("depth"),
                F.when(going, F.col("orphan2")).otherwise(F.col("orphan")).alias("orphan"),
            )
        )
        reach *= 2
    endless = F.col("up").isNotNull()
    return state.select(
        F.col("id").alias("manufacturer_id"),
        F.when(~endless, F.col("top")).alias("top_parent_id"),
        F.when(~endless, F.col("depth").cast("bigint")).alias("depth"),
        F.when(endless, "cycle")
        .when(F.col("orphan"), "orphan_parent")
        .when(F.col("depth") == 0, "root")
        .otherwise("rolled_up")
        .alias("status"),
    )


def remove_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop identical rows, then every row whose key still occurs more than once."""
    return keep_none(df.distinct(), list(keys))


def near_duplicates(
    df: DataFrame,
    columns: Sequence[str],
    row_id: str,
    key: Callable[[Column], Column] | None = None,
    digest: bool = False,
) -> DataFrame:
    """All rows that share the given columns with another row.

    key      applied to every column first, for example ``loose_key``
    digest   compare SHA-256 digests, which keeps long text out of the shuffle
    """
    keys = [key(F.col(c)) if key else F.col(c) for c in columns]
    if digest:
        keys = [F.sha2(k.cast("binary"), 256) for k in keys]
    return repeated_rows(df, keys, row_id)


def compared_share(
    df: DataFrame, columns: Sequence[str], key: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Rows, rows whose keys are compared in whole to find near duplicates, and their share, in one row."""
    keys = [key(F.col(c)) if key else F.col(c) for c in columns]
    maybe = maybe_repeated(df.select(*columns), keys).select(F.lit(0).alias("r"), F.lit(1).alias("c"))
    both = df.select(F.lit(1).alias("r"), F.lit(0).alias("c")).unionAll(maybe)
    counts = both.agg(F.coalesce(F.sum("r"), F.lit(0)).alias("rows"), F.coalesce(F.sum("c"), F.lit(0)).alias("compared_rows"))
    return counts.withColumn("share", F.coalesce(F.try_divide(F.col("compared_rows"), F.col("rows")), F.lit(0.0)))


def duplicate_counts(df: DataFrame, keys: Sequence[str], near: Sequence[str]) -> DataFrame:
    """Rows before and after the duplicate rules, rows removed, and near-duplicate rows.

    Equal rows are counted first; the same grouping serves both rules if their columns agree.
    """
    zero = F.lit(0).cast("bigint")
    distinct = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))

    def grouped(columns: Sequence[str]) -> DataFrame:
        return distinct.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"), F.sum("_n").alias("_n"))

    alike = F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), zero)
    counted = grouped(keys).agg(
        F.coalesce(F.sum("_n"), zero).alias("rows_before"),
        F.count_if(F.col("_rows") == 1).alias("rows_after"),
        alike.alias("near_duplicate_rows"),
    )
    if set(near) != set(keys):
        counted = counted.withColumn("near_duplicate_rows", grouped(near).agg(alike).scalar())
    removed = F.col("rows_before") - F.col("rows_after")
    return counted.withColumn("rows_removed", removed)


def duplicate_groups(
    df: DataFrame,
    columns: Sequence[str],
    row_id: str,
    key: Callable[[Column], Column] = loose_key,
) -> DataFrame:
    """Members of every duplicate group with group id, decision and reason.

    Columns are compared after ``key``. The first row of a group is kept and names it; the
    reason tells whether a dropped row repeats that row's text or only its normalised form.
    """
    raw = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    rows = df.select(F.col(row_id), *columns, raw.alias("_raw"))
    rows = maybe_repeated(rows, [key(F.col(c)) for c in columns]).select(row_id, "_raw", "_key")
    groups = (
        rows.groupBy("_key")
        .agg(
            F.count(F.lit(1)).alias("group_size"),
            F.min(F.struct(F.col(row_id).alias("id"), F.col("_raw").alias("raw"))).alias("_first"),
        )
        .where("group_size > 1")
    )
    members = attach(rows, groups, "_key", "inner")
    kept = F.col(row_id) == F.col("_first.id")
    same = F.col("_raw").eqNullSafe(F.col("_first.raw"))
    return members.select(
        F.col(row_id),
        F.col("_first.id").alias("group_id"),
        "group_size",
        F.when(kept, "keep").otherwise("drop").alias("decision"),
        F.when(kept, "first row of the group")
        .when(same, "same text as the kept row")
        .otherwise("same text after normalisation")
        .alias("reason"),
    )


def standardize_and_enrich(catalog: DataFrame, master: DataFrame) -> dict[str, DataFrame]:
    """Standardised and enriched catalog with its rates, by exact names and by key."""
    exact = standardize_names(catalog, name_lookup(master))
    loose = standardize_names(catalog, name_lookup(master, key=canonical_key), key=canonical_key)
    return {
        "standardized": exact,
        "enriched": enrich(exact, master),
        "rates": match_rates(exact, master),
        "rates_by_key": match_rates(loose, master),
    }
