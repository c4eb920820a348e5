"""Which sources supplied the items of a list, and how much of each list they cover."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators.joins import attach
from concord.operators.keyed import keep_first, share_of_total, source_ordinal
from concord.session import checkpointed
from concord.sources.headers import normalize_headers, require_columns

# The label of an unknown source, and the column contracts.
NO_SOURCE = "no-source-found"
OBSERVED_COLUMNS = ("list_id", "item_id", "source_id")
CANDIDATE_COLUMNS = ("list_id", "item_id")


def annotate_sources(
    observed: DataFrame, lookup: DataFrame | None = None, order_by: str = "ord"
) -> DataFrame:
    """Add source_name to every observed row; the first lookup row of a source id counts.

    Without a lookup, and for ids that are unknown or have a blank name, the name is
    ``no-source-found``.
    """
    if lookup is None:
        return observed.withColumn("source_name", F.lit(NO_SOURCE))
    lookup = normalize_headers(lookup)
    require_columns(lookup.columns, ("source_id", "source_name", order_by), "source lookup")
    raw = lookup.where(F.col("source_id").isNotNull()).select("source_id", "source_name", order_by)
    names = keep_first(raw, "source_id", order_by).select("source_id", "source_name")
    named = attach(observed, names, "source_id")
    name = F.coalesce(F.nullif(F.col("source_name"), F.lit("")), F.lit(NO_SOURCE))
    return named.withColumn("source_name", name)


def source_share(observed: DataFrame) -> DataFrame:
    """Distinct (list, item, source id) records per source name, and their share of all."""
    records = observed.groupBy("list_id", "item_id", "source_id").agg(
        F.min("source_name").alias("source_name")
    )
    counts = records.groupBy("source_name").agg(F.count(F.lit(1)).alias("observed_records"))
    return share_of_total(counts, "observed_records")


def _candidate_items(candidates: DataFrame) -> DataFrame:
    candidates = normalize_headers(candidates)
    require_columns(candidates.columns, CANDIDATE_COLUMNS, "candidate lists")
    return candidates.select(*CANDIDATE_COLUMNS).where(F.col("list_id").isNotNull()).distinct()


def candidate_totals(candidates: DataFrame) -> DataFrame:
    """Distinct items per list; a missing item counts as one item."""
    return _candidate_items(candidates).groupBy("list_id").agg(
        F.count(F.lit(1)).alias("candidate_items")
    )


def list_coverage(
    candidates: DataFrame, observed: DataFrame, restrict_to_candidates: bool = False
) -> DataFrame:
    """Distinct items each source supplied per list, against the list's candidate items.

    Lists without any observation stay, with a null source. Observed items need not be
    candidates, so coverage can exceed 1 unless ``restrict_to_candidates`` is set.
    """
    require_columns(observed.columns, (*OBSERVED_COLUMNS, "source_name"), "observed records")
    supplied = (
        observed.where(F.col("list_id").isNotNull() & F.col("source_name").isNotNull())
        .select("list_id", "item_id", "source_name")
        .distinct()
    )
    if restrict_to_candidates:  # after the distinct step, an item has one row per source
        supplied = supplied.join(_candidate_items(candidates), list(CANDIDATE_COLUMNS), "left_semi")
    covered = supplied.groupBy("list_id", "source_name").agg(F.count(F.lit(1)).alias("covered_items"))
    return _with_totals(candidates, covered)


def _with_totals(candidates: DataFrame, covered: DataFrame) -> DataFrame:
    """Covered items by list and source against the list's candidate items; lists without any stay."""
    coverage = F.coalesce(F.try_divide("covered_items", "candidate_items"), F.lit(0.0))
    return (
        candidate_totals(candidates)
        .join(covered, "list_id", "left")
        .select(
            "list_id",
            "source_name",
            F.coalesce("covered_items", F.lit(0)).cast("bigint").alias("covered_items"),
            "candidate_items",
        )
        .withColumn("coverage", coverage)
    )


# Batches --------------------------------------------------------------------------------

ITEM = "item_id"
#: The number of a missing item; other items are numbered from 1.
MISSING_ITEM = 0


def number_items(observed: DataFrame, folder: str) -> DataFrame:
    """(item_id, number) of all items seen so far, those new in these rows numbered after the others.

    The dictionary is a folder of tables, one for each time that new items came.
    """
    spark = observed.sparkSession
    kept = f"{folder}/items"
    schema = "item_id string, number bigint"
    # The folder has a table from the start, so that it can be read.
    spark.createDataFrame([], schema).write.mode("append").parquet(kept)
    known = checkpointed(spark.read.schema(schema).parquet(kept))
    items = observed.select(ITEM).where(F.col(ITEM).isNotNull()).distinct()
    new = source_ordinal(items.join(known.select(ITEM), ITEM, "left_anti"), ITEM, "number")
    highest = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    added = new.select(ITEM, (F.col("number") + highest).cast("bigint").alias("number"))
    added.write.mode("append").parquet(kept)
    return spark.read.schema(schema).parquet(kept)


def add_batch(observed: DataFrame, folder: str, batch: str) -> None:
    """Store the items of a batch of observed rows as bitmaps by list and source name.

    A bitmap has the items of one range of 32,768 numbers. A batch that is loaded again replaces
    what it was.
    """
    require_columns(observed.columns, (*OBSERVED_COLUMNS, "source_name"), "observed records")
    named = observed.where(F.col("list_id").isNotNull() & F.col("source_name").isNotNull())
    named = checkpointed(named.select("list_id", ITEM, "source_name").distinct())
    numbers = number_items(named, folder)
    number = F.coalesce("number", F.lit(MISSING_ITEM))
    bits = (
        attach(named, numbers, ITEM, written=True)
        .groupBy("list_id", "source_name", F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    )
    bits.write.mode("overwrite").parquet(f"{folder}/bitmaps/batch={batch}")


def batch_coverage(spark: SparkSession, candidates: DataFrame, folder: str) -> DataFrame:
    """list_coverage of all batches loaded so far: bitmaps are combined, no observed row is read again."""
    bits = spark.read.parquet(f"{folder}/bitmaps")
    combined = bits.groupBy("list_id", "source_name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    covered = combined.groupBy("list_id", "source_name").agg(F.sum(F.bitmap_count("bits")).alias("covered_items"))
    return _with_totals(candidates, covered)


def summarize_coverage(coverage: DataFrame) -> DataFrame:
    """Lists, mean coverage and item-weighted coverage per source.

    The weights are the candidate items of the lists in which the source appears.
    """
    return coverage.groupBy("source_name").agg(
        F.count_distinct("list_id").alias("lists"),
        F.avg("coverage").alias("unweighted_coverage"),
        F.coalesce(
            F.try_divide(F.sum("covered_items"), F.sum("candidate_items")), F.lit(0.0)
        ).alias("weighted_coverage"),
    )


def unmatched_source_rate(observed: DataFrame) -> DataFrame:
    """Share of the observed rows, repeats included, without a known source."""
    unknown = (F.col("source_name") == NO_SOURCE).cast("double")
    rate = F.coalesce(F.avg(F.coalesce(unknown, F.lit(0.0))), F.lit(0.0))
    return observed.agg(rate.alias("unmatched_source_rate"))


def coverage_tables(
    observed: DataFrame, candidates: DataFrame, lookup: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The four result tables by name, in report order."""
    annotated = annotate_sources(observed, lookup)
    coverage = list_coverage(candidates, annotated)
    return {
        "source_share": source_share(annotated).orderBy(F.desc("observed_records"), "source_name"),
        "list_coverage": coverage.orderBy("list_id", F.col("source_name").asc_nulls_last()),
        "coverage_summary": summarize_coverage(coverage).orderBy(
            F.col("source_name").asc_nulls_last()
        ),
        "diagnostics": unmatched_source_rate(annotated),
    }
