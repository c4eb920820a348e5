"""Ordered de-duplication and numbering.

Rows of one key are never brought together: "keep the first" leaves at most one row of a key in
every task before anything is shuffled, "latest" is an aggregate with a partial step, and the rows a
rule removes are found by an anti-join on where they are, which spreads evenly however the keys are
distributed. Keys that may be missing are compared as structs, in which missing parts are equal.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.operators.joins import attach
from concord.session import checkpointed


def _names(value: str | list[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def keep_first(df: DataFrame, keys: str | list[str], order_by: str | list[str], wide: bool = False) -> DataFrame:
    """The first row of each key; missing keys count as equal.

    wide  only key, order and place of a row are shuffled to find the rows that go, so rows stay
          where they are as long as few of them go
    """
    return _keep(df, _names(keys), _names(order_by), F.asc_nulls_first, wide)


def keep_last(df: DataFrame, keys: str | list[str], order_by: str | list[str], wide: bool = False) -> DataFrame:
    """The last row of each key; missing keys count as equal."""
    return _keep(df, _names(keys), _names(order_by), F.desc_nulls_last, wide)


def _keep(df: DataFrame, keys: list[str], order_by: list[str], direction, wide: bool) -> DataFrame:
    """The rank limit is applied within every task first, so one row of a key leaves it."""
    key, order = [F.col(f"`{k}`") for k in keys], [F.col(f"`{c}`") for c in order_by]

    def best(rows: DataFrame, *tie: Column) -> DataFrame:
        first = Window.partitionBy(*key).orderBy(*[direction(c) for c in order], *tie)
        return rows.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")

    if not wide:
        return best(df)
    placed = located(df)
    narrow = placed.select(*key, *[c for n, c in zip(order_by, order) if n not in keys], "_place")
    kept = best(narrow, F.col("_place")).select("_place")
    gone = narrow.select("_place").join(kept, "_place", "left_anti")
    return attach(placed, gone, "_place", "left_anti").drop("_place")


def located(df: DataFrame) -> DataFrame:
    """The rows with _place, the file and row they are read from.

    A frame that is no plain scan of files with row numbers is written first.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        found = df.withColumn("_place", place)
        found.schema  # resolves the columns
        return found
    except AnalysisException:
        return checkpointed(df).withColumn("_place", place)


def first_present(value: str, newest: Column, order_by: str) -> Column:
    """Aggregate: the non-null value of the newest row, ties to the first in order.

    Partial results are combined again by ``F.min`` on the same struct, so it can be taken
    per raw name first and per key later.
    """
    entry = F.struct((-newest).alias("age"), F.col(order_by).alias("ord"), F.col(value).alias("value"))
    return F.min(F.when(F.col(value).isNotNull() & newest.isNotNull(), entry))


def keep_none(df: DataFrame, keys: str | list[str]) -> DataFrame:
    """Only the rows whose key occurs once: every member of a repeated key is removed.

    Keys are counted by themselves; the rows are compared with the repeated ones only.
    """
    rows = checkpointed(df).withColumn("_key", F.struct(*[F.col(f"`{k}`") for k in _names(keys)]))
    repeated = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_key")
    return attach(rows, repeated, "_key", "left_anti").drop("_key")


def maybe_repeated(df: DataFrame, keys: list[Column], name: str = "_key") -> DataFrame:
    """The rows whose key may be that of another row as well, with the key as a struct.

    A row that is certainly alone leaves its task as the hash of its key only, sixteen bytes with its
    count; hashes that occur once are dropped, and rows are looked up among the others. With few
    of these they are broadcast, and no row is shuffled.
    """
    named = df.withColumn(name, F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]))
    hashed = named.withColumn("_hash", F.xxhash64(name))
    many = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")
    return attach(hashed, many, "_hash", "left_semi").drop("_hash")


def repeated_rows(df: DataFrame, keys: list[Column], row_id: str) -> DataFrame:
    """Every row whose key occurs more than once; missing key parts count as equal.

    Rows that are certainly alone are left out first; of the others whole keys are compared.
    """
    ids = maybe_repeated(df, keys).select(row_id, "_key")
    counted = ids.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_key")
    repeated = attach(ids, counted, "_key", "left_semi").select(row_id)
    return attach(df, repeated, row_id, "left_semi")


def source_ordinal(
    df: DataFrame, order_by: str, name: str = "source_row", partitions: int | None = None
) -> DataFrame:
    """Number the rows 1, 2, 3, ... in the order of a column of any sortable type, missing values first.

    The rows are sorted into ranges, and written with their range and place in it, which freezes
    both; a number is the place plus the rows of the ranges before. Rows that tie are spread by a
    hash of the row, so frequent values do not meet in one range. ``partitions`` (by default
    spark.sql.shuffle.partitions) is the number of ranges, and of the counts that pass the driver.
    """
    spark = df.sparkSession
    ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = F.col(f"`{order_by}`").asc_nulls_first()
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    order = [first, F.col("_tie")]
    placed = checkpointed(
        df.withColumn("_tie", F.xxhash64(*hashed))
        .repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = placed.withColumns({"_range": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND((1 << 33) - 1)})
    counts = sorted(placed.groupBy("_range").agg(F.count(F.lit(1))).collect())
    shifts = list(zip((r for r, _ in counts), accumulate([n for _, n in counts], initial=1)))
    shifts = spark.createDataFrame(shifts, "_range bigint, _shift bigint")
    numbered = placed.join(F.broadcast(shifts), "_range")  # a row for each range
    return numbered.withColumn(name, F.col("_at") + F.col("_shift")).drop("_range", "_at", "_shift")


def share_of_total(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """Each value divided by the sum of all, 0 when the sum is 0."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, F.coalesce(F.try_divide(F.col(value), total), F.lit(0.0)))
