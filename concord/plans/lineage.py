"""Submitted research lines through enrichment, matching and import, one row per line."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.functions.text import has_identifier, normalize_bool, with_identifiers
from concord.operators.compare import FIELD_STATUSES, agreement, compare_fields
from concord.operators.joins import attach
from concord.session import checkpointed, shared_partitions
from concord.sources.headers import require_columns
from concord.sources.sinks import save_bucketed

# The compared fields, the column contracts and the label of a missing stage.
FIELDS = ("manufacturer", "article", "typecode")
RESEARCH_COLUMNS = (
    "list_id",
    "material_reference",
    "research_returned",
    "original_manufacturer",
    "original_article",
    "original_typecode",
    "enrichment_manufacturer",
    "enrichment_article",
    "enrichment_typecode",
)
MATCHING_COLUMNS = ("list_id", "material_reference", "is_matched")
IMPORT_COLUMNS = ("material_reference",)
NO_MATCHING_ROW = "no matching row"
PAIR = ["list_id", "material_reference"]
#: Lines of a bucket on average, where their number is left open.
BUCKET_LINES = 500_000


def _with_keys(df: DataFrame) -> DataFrame:
    return with_identifiers(df, {k: k for k in PAIR if k in df.columns})


def _with_pair(matching: DataFrame) -> DataFrame:
    require_columns(matching.columns, MATCHING_COLUMNS, "matching candidates")
    complete = has_identifier(F.col("list_id")) & has_identifier(F.col("material_reference"))
    return _with_keys(matching.where(complete))


def collapse_candidates(matching: DataFrame) -> DataFrame:
    """One row per (list, material) with candidate counts; green when any is positive."""
    return (
        _with_pair(matching)
        .groupBy(*PAIR)
        .agg(
            F.count(F.lit(1)).alias("n_candidates"),
            F.count_if(normalize_bool(F.col("is_matched"))).alias("n_positive"),
        )
        .withColumn("n_negative", F.col("n_candidates") - F.col("n_positive"))
        .withColumn("match_status", F.when(F.col("n_positive") > 0, "green").otherwise("yellow"))
    )


def candidate_descriptions(matching: DataFrame) -> DataFrame:
    """Optional descriptive columns of the candidates, aggregated per pair.

    One row per pair, column and distinct value with its candidate count, so that a pair
    with very many values needs no list in one row.
    """
    extra = [c for c in matching.columns if c not in MATCHING_COLUMNS]
    values = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in extra]
    return (
        _with_pair(matching)
        .select(*PAIR, F.inline(F.array(*values)))
        .where(F.col("value").isNotNull())
        .groupBy(*PAIR, "field", "value")
        .agg(F.count(F.lit(1)).alias("n_candidates"))
    )


def compare_identifiers(rows: DataFrame, matcher=None) -> DataFrame:
    """Add the status of every compared field and the overall agreement."""
    compared = compare_fields(rows, FIELDS, matcher)
    return compared.withColumn(
        "identifier_agreement", agreement([F.col(f"{f}_match") for f in FIELDS])
    )


def build_lineage(
    research: DataFrame, matching: DataFrame, imports: DataFrame, pairs: DataFrame | None = None
) -> DataFrame:
    """Every submitted line with its matching status, import flag and field comparison.

    ``pairs`` may be a written table of the collapsed candidates. The fields are
    compared before the joins, which they do not depend on: together with the joins they
    would make one generated method too large to be compiled. Where both lookups are shuffled, the
    lines are shuffled once, by their material.
    """
    lines, imported = research_lines(research), imported_materials(imports)
    shared_partitions(research.sparkSession)
    return _joined(lines, checkpointed(collapse_candidates(matching)) if pairs is None else pairs, imported)


def _joined(lines: DataFrame, pairs: DataFrame, imported: DataFrame, bucketed: bool = False) -> DataFrame:
    """Lines with the counts of their pair and whether their material was imported; pairs are a stored table.

    Bucketed lines meet their pairs first, where both are.
    """
    zero = F.lit(0).cast("bigint")
    imported = checkpointed(imported.withColumn("imported", F.lit(True)))
    lookups = [(imported, IMPORT_COLUMNS[0]), (pairs, PAIR)]
    joined = reduce(
        lambda rows, lookup: attach(rows, *lookup, written=True), reversed(lookups) if bucketed else lookups, lines
    )
    named = [c for c in lines.columns if c not in PAIR], [c for c in pairs.columns if c not in PAIR]
    joined = joined.select(*PAIR, *named[0], *named[1], "imported")
    return joined.withColumns(
        {
            **{c: F.coalesce(F.col(c), zero) for c in ("n_candidates", "n_positive", "n_negative")},
            "in_matching": F.col("match_status").isNotNull(),
            "match_status": F.coalesce("match_status", F.lit(NO_MATCHING_ROW)),
            "imported": F.coalesce("imported", F.lit(False)),
        }
    )


def pair_differences(lineage: DataFrame, pairs: DataFrame) -> DataFrame:
    """Distinct pairs only in research and only in matching, from one grouping.

    Both sides are marked and grouped by pair; missing key parts count as equal.
    """
    marked = lineage.select(*PAIR, F.lit(1).alias("r"), F.lit(0).alias("m")).unionAll(
        pairs.select(*PAIR, F.lit(0), F.lit(1))
    )
    sides = marked.groupBy(*PAIR).agg(F.max("r").alias("r"), F.max("m").alias("m"))
    return sides.agg(
        F.count_if(F.col("r") > F.col("m")).alias("pairs_in_research_not_matching"),
        F.count_if(F.col("m") > F.col("r")).alias("pairs_in_matching_not_research"),
    )


def coverage_summary(lineage: DataFrame, pairs: DataFrame) -> DataFrame:
    """Stage counts and pair overlap as (metric, value)."""
    status = F.col("match_status")
    stages = lineage.agg(
        F.count(F.lit(1)).alias("research_rows"),
        F.count_distinct("material_reference").alias("research_distinct_materials"),
        F.count_if("research_returned").alias("research_returned"),
        F.count_if("in_matching").alias("research_with_matching"),
        F.count_if(status == "green").alias("research_green"),
        F.count_if(status == "yellow").alias("research_yellow"),
        F.count_if(status == NO_MATCHING_ROW).alias("research_no_matching_row"),
        F.count_if("imported").alias("research_imported"),
    )
    differences = pair_differences(lineage, pairs)
    long = [t.unpivot([], t.columns, "metric", "value") for t in (stages, differences)]
    return long[0].unionByName(long[1])


def stage_summary(research: DataFrame, pairs: DataFrame, imports: DataFrame) -> DataFrame:
    """coverage_summary without the joined lines: lines are counted by pair before anything is joined.

    pairs are the collapsed candidates, a stored table.
    """
    require_columns(research.columns, RESEARCH_COLUMNS, "research rows")
    lines = (
        _with_keys(research.select(*PAIR, normalize_bool(F.col("research_returned")).alias("back")))
        .groupBy(*PAIR)
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("back").alias("returned"))
    )
    met = lines.join(pairs.select(*PAIR, "match_status"), PAIR, "full_outer")
    met = attach(met, imported_materials(imports).withColumn("imported", F.lit(True)), IMPORT_COLUMNS[0])
    status, n = F.col("match_status"), F.coalesce("n", F.lit(0))

    def lines_where(condition):
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).cast("bigint")

    counted = met.agg(
        lines_where(F.lit(True)).alias("research_rows"),
        F.count_distinct(F.when(n > 0, F.col("material_reference"))).alias("research_distinct_materials"),
        F.coalesce(F.sum("returned"), F.lit(0)).cast("bigint").alias("research_returned"),
        lines_where(status.isNotNull()).alias("research_with_matching"),
        lines_where(status == "green").alias("research_green"),
        lines_where(status == "yellow").alias("research_yellow"),
        lines_where(status.isNull()).alias("research_no_matching_row"),
        lines_where(F.col("imported")).alias("research_imported"),
        F.count_if((n > 0) & status.isNull()).alias("pairs_in_research_not_matching"),
        F.count_if(n == 0).alias("pairs_in_matching_not_research"),
    )
    return counted.unpivot([], counted.columns, "metric", "value")


def identifier_summary(lineage: DataFrame) -> DataFrame:
    """Count of each status per field: five fixed rows, from one pass without a shuffle of rows."""
    counts = lineage.agg(
        *[
            F.count_if(F.col(f"{f}_match") == s).alias(f"{f}_{s}")
            for f in FIELDS
            for s in FIELD_STATUSES
        ]
    )
    rows = [
        F.struct(F.lit(s).alias("status"), *[F.col(f"{f}_{s}").alias(f) for f in FIELDS])
        for s in FIELD_STATUSES
    ]
    return counts.select(F.inline(F.array(*rows)))


def lineage_tables(
    research: DataFrame, matching: DataFrame, imports: DataFrame
) -> dict[str, DataFrame]:
    """The three result tables by name; only the pairs are read twice, so only they are written."""
    pairs = checkpointed(collapse_candidates(matching))
    return {
        "throughput": build_lineage(research, matching, imports, pairs),
        "identifier_summary": identifier_summary(compare_identifiers(research)),
        "coverage_summary": stage_summary(research, pairs, imports),
    }


# Saved tables ---------------------------------------------------------------------------


def research_lines(research: DataFrame) -> DataFrame:
    """The submitted lines with compared fields and normalised keys, as build_lineage joins them."""
    require_columns(research.columns, RESEARCH_COLUMNS, "research rows")
    lines = _with_keys(compare_identifiers(research))
    return lines.withColumn("research_returned", normalize_bool(F.col("research_returned")))


def imported_materials(imports: DataFrame) -> DataFrame:
    """Distinct material references of the imports."""
    require_columns(imports.columns, IMPORT_COLUMNS, "imports")
    named = imports.select(*IMPORT_COLUMNS).where(has_identifier(F.col("material_reference")))
    return _with_keys(named).distinct()


def save_lineage_inputs(
    research: DataFrame, matching: DataFrame, prefix: str, folder: str, buckets: int | None = None
) -> dict[str, DataFrame]:
    """Save lines and collapsed pairs bucketed by list and material, so that later runs join them in place.

    A bucket is one task's work, so unless their number is given there are more of them with more lines.
    """
    buckets = buckets or max(1, -(-research.count() // BUCKET_LINES))
    tables = {"lines": research_lines(research), "pairs": collapse_candidates(matching)}
    return {
        name: save_bucketed(df, f"{prefix}_{name}", PAIR, buckets, f"{folder}/{name}") for name, df in tables.items()
    }


def lineage_from_tables(lines: DataFrame, pairs: DataFrame, imports: DataFrame) -> DataFrame:
    """build_lineage on saved tables: lines and pairs are joined bucket by bucket, without an exchange."""
    return _joined(lines, pairs, imported_materials(imports), bucketed=True)
