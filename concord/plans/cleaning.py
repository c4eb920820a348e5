"""Staged catalog cleaning with a row-level audit log.

Stages, in this order: drop rows marked as not identified, move supplier fields into blank
manufacturer fields, drop repeats of the business key, map reviewed manufacturer names.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions.text import key_of_text, normalize_text, with_texts
from concord.operators.joins import attach
from concord.operators.keyed import source_ordinal
from concord.session import checkpointed
from concord.sources.headers import fill_optional

# The catalog columns, created blank when absent, and the audit texts.
CATALOG_COLUMNS = (
    "proper_identification",
    "manufacturer_name",
    "manufacturer_article",
    "manufacturer_typecode",
    "manufacturer_url",
    "supplier_name",
    "supplier_article",
    "supplier_url",
)
SUPPLIER_COLUMNS = ("supplier_name", "supplier_article", "supplier_url")
KEY_COLUMNS = ("manufacturer_name", "manufacturer_article", "manufacturer_typecode")
NOT_IDENTIFIED = ("drop_not_identified", "proper_identification is no")
TRANSPLANTED = ("transplant_supplier_to_manufacturer", "manufacturer fields were blank")
DUPLICATE = ("drop_duplicate", "duplicate normalized manufacturer business key")
MAPPED = "map_manufacturer_name"


def prepare_catalog(catalog: DataFrame, order_by: str, row_number: str | None = None) -> DataFrame:
    """All catalog columns as normalised text, plus source_row.

    ``row_number`` names a column that already numbers the rows 1, 2, 3, ...; without it the
    rows are numbered in the order of ``order_by``.
    """
    filled = fill_optional(catalog, CATALOG_COLUMNS)
    if row_number:
        numbered = filled.withColumn("source_row", F.col(row_number).cast("bigint"))
    else:
        numbered = source_ordinal(filled, order_by)
    return with_texts(numbered, CATALOG_COLUMNS)


def _events(rows: DataFrame, stage: Column, action: Column, details: Column) -> DataFrame:
    return rows.select(
        stage.alias("stage_no"),
        F.col("source_row").alias("row_number"),
        action.alias("action"),
        details.alias("details"),
    )


def _any_supplier() -> Column:
    return reduce(or_, [F.col(c) != "" for c in SUPPLIER_COLUMNS])


def _transplant(rows: DataFrame) -> DataFrame:
    """Copy the non-blank supplier fields over, then blank all of them, where the name is blank."""
    blank_name = F.col("manufacturer_name") == ""
    rows = rows.withColumn("_moved", ~F.col("_no") & blank_name & _any_supplier())
    moved = {}
    for source in SUPPLIER_COLUMNS:
        target = source.replace("supplier", "manufacturer")
        taken = F.col("_moved") & (F.col(source) != "")
        moved[target] = F.when(taken, F.col(source)).otherwise(F.col(target))
        moved[source] = F.when(F.col("_moved"), "").otherwise(F.col(source))
    return rows.withColumns(moved)


def _with_business_key(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """The three key parts stay separate columns."""
    keys = {f"_k{i}": key_of_text(F.col(c)) for i, c in enumerate(KEY_COLUMNS)}
    return rows.withColumns(keys), list(keys)


def _map_names(rows: DataFrame, mappings: DataFrame | None) -> DataFrame:
    """Attach the reviewed name of each row; null where none applies."""
    if mappings is None:
        return rows.withColumn("_mapped", F.lit(None).cast("string"))
    reviewed = mappings.select(
        F.col("name_key").alias("_name_key"), F.col("mapped").alias("_mapped")
    ).where((F.col("_mapped") != "") & F.col("_name_key").isNotNull())
    keyed = rows.withColumn("_name_key", key_of_text(F.col("manufacturer_name")))
    joined = attach(keyed, reviewed, "_name_key").drop("_name_key")
    changed = F.col("_mapped") != F.col("manufacturer_name")
    return joined.withColumn("_mapped", F.when(changed, F.col("_mapped")))


def clean_catalog(
    catalog: DataFrame,
    mappings: DataFrame | None = None,
    order_by: str = "row_id",
    row_number: str | None = None,
    materialize: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Cleaned rows and audit events (stage_no, row_number, action, details).

    ``mappings`` has one row per comparison key: name_key, mapped. Mapping comes after the
    repeats are dropped, so it can make new ones. Sort the events by stage_no and row_number.

    The first row number of each key comes from one aggregate, which is written. The rows kept
    and the rows dropped are joins with it on the row number, so no key, however frequent, is
    gathered in one task, and whole rows are never sorted by key.

    ``materialize`` writes the prepared rows to the shared folder first, which saves reading
    and numbering them again for each event kind.
    """
    prepared = prepare_catalog(catalog, order_by, row_number)
    if materialize:
        prepared = checkpointed(prepared)
    marked = prepared.withColumn("_no", key_of_text(F.col("proper_identification")) == "no")
    moved = _transplant(marked)
    staged, keys = _with_business_key(moved.where(~F.col("_no")))

    first = checkpointed(staged.groupBy(*keys).agg(F.min("source_row").alias("source_row")).select("source_row"))
    kept = attach(staged, first, "source_row", "left_semi", written=True).drop(*keys)
    kept = _map_names(kept, mappings)
    repeats = attach(staged, first, "source_row", "left_anti", written=True)

    def pick(index: int) -> Column:
        return F.when(F.col("_no"), NOT_IDENTIFIED[index]).otherwise(TRANSPLANTED[index])

    audit = reduce(
        DataFrame.unionByName,
        (
            _events(
                moved.where(F.col("_no") | F.col("_moved")),
                F.when(F.col("_no"), 1).otherwise(2),
                pick(0),
                pick(1),
            ),
            _events(repeats, F.lit(3), F.lit(DUPLICATE[0]), F.lit(DUPLICATE[1])),
            _events(
                kept.where(F.col("_mapped").isNotNull()),
                F.lit(4),
                F.lit(MAPPED),
                F.concat(F.lit("mapped to "), F.col("_mapped")),
            ),
        ),
    )

    mapped_name = F.coalesce(
        F.when(F.col("_mapped").isNotNull(), normalize_text(F.col("_mapped"))),
        F.col("manufacturer_name"),
    )
    cleaned = kept.withColumn("manufacturer_name", mapped_name).drop("_mapped", "_moved", "_no")
    return cleaned, audit


def with_role(cleaned: DataFrame) -> DataFrame:
    """Add role: supplier when any supplier field is filled, else manufacturer."""
    filled = reduce(or_, [F.coalesce(F.col(c), F.lit("")) != "" for c in SUPPLIER_COLUMNS])
    return cleaned.withColumn("role", F.when(filled, "supplier").otherwise("manufacturer"))


def split_by_role(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Manufacturer rows and supplier rows."""
    tagged = with_role(cleaned)
    return (
        tagged.where("role = 'manufacturer'").drop("role"),
        tagged.where("role = 'supplier'").drop("role"),
    )


def cleaning_tables(
    catalog: DataFrame, mappings: DataFrame | None = None, order_by: str = "row_id"
) -> dict[str, DataFrame]:
    """The four result tables by name."""
    cleaned, audit = clean_catalog(catalog, mappings, order_by, materialize=True)
    manufacturer, supplier = split_by_role(cleaned)
    return {
        "cleaned_catalog": cleaned.orderBy("source_row").drop("source_row"),
        "audit_log": audit.orderBy("stage_no", "row_number").drop("stage_no"),
        "manufacturer_records": manufacturer.orderBy("source_row").drop("source_row"),
        "supplier_records": supplier.orderBy("source_row").drop("source_row"),
    }
