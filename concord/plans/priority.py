"""Supplier-by-client priority report.

Every figure is computed in long form: counts are added up per raw name and list before any
name is repaired or joined, so the text functions and the lookups see distinct names only.
The wide table is pivoted last.

Inputs are frames with role-named columns; ``read_roles`` renames raw headers to them. ``ord``
is a column that gives the input order wherever the first or last row counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions.dates import format_date, with_timestamps
from concord.functions.numbers import normalize_id_key, to_int, to_rate, with_id_keys
from concord.functions.text import canonical_key, is_blank, is_flagged, repair_text, strip
from concord.operators.joins import attach, attach_many
from concord.operators.keyed import first_present, keep_first
from concord.session import checkpointed
from concord.sources.folders import PANDAS_NULLS, load_inputs, read_prior_report
from concord.sources.headers import arrow_header, resolve_column, select_roles

# The header hints of each input role.
CONTRACTS = {
    "supplier_ref": {
        "manufacturer": ["name"],
        "legal_name": ["legalname"],
        "abbr": ["abbreviation"],
    },
    "unmatched": {
        "splist_id": ["sparepartlistid"],
        "manu_name": [
            "manufacturermatchingcandidates - materialreference → manufacturername",
            "manufacturername",
            "manufacturer",
            "name",
        ],
        "cnt": ["count", "rows", "qty"],
    },
    "matched": {
        "splist_id": [
            "matchingcandidates - matchingcandidateid → sparepartlistid",
            "sparepartlistid",
        ],
        "abbr": ["spt id abbreviation", "manufacturerabbreviation", "abbreviation", "abbr"],
        "cnt": ["count", "rows", "qty"],
    },
    "datasets": {
        "source_format": ["sourceformat"],
        "company_source": ["company source", "company_source"],
        "import_done": ["importdone"],
        "source_origin": ["sourceorigin"],
    },
    "products": {
        "name": ["manufacturer: name", "name"],
        "cnt": ["count"],
    },
    "entities": {
        "client": [
            "clients->name",
            "clients→name",
            "clients â†’ name",
            "clients -> name",
            "client",
            "clientname",
        ],
        "be_name": [
            "businessentities->name",
            "businessentities → name",
            "businessentities â†’ name",
            "businessentities - businessentityid â†’ name",
            "businessentities -> name",
        ],
        "be_id": ["id"],
        "mm_total_rows": ["totalnumberofrows"],
    },
    "rules": {
        "manufacturer": ["manufacturer"],
        "exclude_flag": ["exclude due to bad name"],
    },
    "prev": {
        "abbr": ["abbreviation"],
        "last_month_mr": ["matching rate"],
        "research": ["research"],
        "crawlability": ["crawlability"],
        "crawler_status": ["crawler status"],
        "partner_status": ["partner status"],
        "stage_in_sf": ["crm stage"],
        "acqu_method": ["acquisition method"],
        "wrong_match": ["wrong match"],
    },
    "match_ts": {
        "list_id": [
            "matchingcandidates - matchingcandidateid -> sparepartlistid",
            "client entities - entityid -> sparepartlistid",
            "sparepartlistid",
            "sparepartlist_id",
        ],
        "matched_at": ["matchedat"],
    },
}
# Roles that may be absent, and the tracking columns of the prior report.
OPTIONAL_ROLES = {
    "datasets": ("import_done", "source_origin"),
    "rules": ("exclude_flag",),
    "match_ts": ("matched_at",),
    "prev": tuple(CONTRACTS["prev"])[2:],
}
TRACKING = OPTIONAL_ROLES["prev"]
# Report headers.
REPORT_NAMES = {
    "abbr": "Abbreviation",
    "manufacturer": "Manufacturer",
    "legal_name": "Legal Name",
    "import_done": "Import Done",
    "source_format": "Source Format",
    "source_origin": "Source Origin",
    "products_in_db": "Products in DB",
    "datasets_imported": "Datasets imported",
    "research": "Research",
    "crawlability": "Crawlability",
    "crawler_status": "Crawler Status",
    "partner_status": "Partner status",
    "stage_in_sf": "CRM stage",
    "acqu_method": "Acquisition Method",
    "wrong_match": "wrong match",
    "total_rows": "Total Rows MM signed clients",
    "unmatched_rows": "Unmatched Rows MM Signed Clients",
    "matched_rows": "Matched Rows MM Signed Clients",
    "matching_rate": "Matching Rate",
    "last_month_mr": "Last Month MR",
}
LABELS = {"unmatched": "Unmatched", "matched": "Matched Rows"}
NO_DATE = "N/A"
SUPPLIER = ["abbr", "manufacturer"]


def read_roles(df: DataFrame, kind: str) -> DataFrame:
    """Rename the raw headers of one input to its roles; ``ord`` is passed through.

    An input without any column (an absent or empty folder) has all roles and no rows. The list
    id of the match dates may be headed by a plain ``id``.
    """
    if not df.columns:
        return no_rows(df.sparkSession, kind)
    roles = CONTRACTS[kind]
    if kind == "match_ts" and "id" in df.columns and resolve_column(df.columns, roles["list_id"]) is None:
        df = df.withColumnRenamed("id", arrow_header(roles["list_id"][0]))
    keep = [c for c in ("ord",) if c in df.columns]
    return select_roles(df, CONTRACTS[kind], kind, OPTIONAL_ROLES.get(kind, ()), keep)


def no_rows(spark: SparkSession, kind: str) -> DataFrame:
    """An empty input."""
    roles = ", ".join(f"{r} string" for r in CONTRACTS[kind])
    return spark.createDataFrame([], f"{roles}, ord bigint")


# Dimensions -----------------------------------------------------------------------------


def excluded_keys(rules: DataFrame) -> DataFrame:
    """Distinct canonical keys of the manufacturers flagged for exclusion."""
    if "exclude_flag" not in rules.columns:  # no flags, no exclusions
        return rules.limit(0).select(F.lit("").alias("manu_key"))
    flagged = rules.where(is_flagged(F.col("exclude_flag")) & ~is_blank(F.col("manufacturer")))
    return flagged.select(canonical_key(F.col("manufacturer")).alias("manu_key")).distinct()


def supplier_dim(supplier_ref: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """One row per abbreviation, the first in order; excluded names are removed afterwards.

    Rows without an abbreviation are left out: a missing key joins nothing here.
    """
    named = supplier_ref.where(F.col("abbr") != "").select("abbr", "manufacturer", "legal_name", "ord")
    dim = keep_first(named, "abbr", "ord")
    if rules is None:
        return dim
    keyed = dim.withColumn("manu_key", canonical_key(F.col("manufacturer")))
    return attach(keyed, excluded_keys(rules), "manu_key", "left_anti").drop("manu_key")


def exclusion_counts(supplier_ref: DataFrame, rules: DataFrame) -> DataFrame:
    """Suppliers before and after the exclusions, in one row."""
    before = supplier_dim(supplier_ref).select(F.lit(1).alias("b"), F.lit(0).alias("a"))
    after = supplier_dim(supplier_ref, rules).select(F.lit(0).alias("b"), F.lit(1).alias("a"))
    both = before.unionAll(after).agg(
        F.coalesce(F.sum("b"), F.lit(0)).alias("before"), F.coalesce(F.sum("a"), F.lit(0)).alias("after")
    )
    return both.withColumn("excluded", F.col("before") - F.col("after"))


def alias_table(dim: DataFrame) -> DataFrame:
    """Canonical key of every display and legal name to its abbreviation, the first one wins."""
    names = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("manufacturer").alias("alias")),
        F.struct(F.lit(1).alias("kind"), F.col("legal_name").alias("alias")),
    )
    listed = dim.select("abbr", "ord", F.inline(names)).where(~is_blank(F.col("alias")))
    keyed = listed.select("abbr", canonical_key(F.col("alias")).alias("alias_key"), "ord", "kind")
    return keep_first(keyed, "alias_key", ["ord", "kind"]).select("alias_key", "abbr")


def entity_map(entities: DataFrame) -> DataFrame:
    """Client entities with repaired names, join keys, list id and total rows."""
    named = entities.withColumns(
        {
            "client": repair_text(F.col("client")),
            "be_name": repair_text(F.col("be_name")),
            "be_id": normalize_id_key(F.col("be_id")),
            "mm_total_rows": to_int(F.col("mm_total_rows")),
        }
    )
    return named.withColumns(
        {"client_key": canonical_key(F.col("client")), "be_key": canonical_key(F.col("be_name"))}
    )


# Facts ----------------------------------------------------------------------------------
# The dimension, the aliases and the entities are stored tables here, so that their sizes are known
# without a job while a plan is built, and a fact table is read once.


def _with_entity(facts: DataFrame, entities: DataFrame) -> DataFrame:
    """Facts of known lists with their client and entity; a repeated list id fans out.

    A blank list id is made null, which matches nothing: a filter on it would be applied to the facts'
    keys as well, and pushed below the counting of their raw rows.
    """
    known = entities.where(F.col("client").isNotNull()).select(
        F.nullif(F.col("be_id"), F.lit("")).alias("splist_id"), "client", "client_key", "be_name", "be_key"
    )
    return attach_many(facts, known, "splist_id", written=True)


def unmatched_rows(
    unmatched: DataFrame, dim: DataFrame, aliases: DataFrame, entities: DataFrame
) -> DataFrame:
    """Unmatched counts with client and supplier.

    Names without an alias keep abbreviation '' and their repaired name as manufacturer.
    """
    named = aliases.where("alias_key <> ''").join(dim.select(*SUPPLIER), "abbr", "left")
    facts = with_id_keys(unmatched, {"splist_id": "splist_id"}).select(
        "splist_id",
        canonical_key(F.col("manu_name")).alias("alias_key"),
        F.coalesce(repair_text(F.col("manu_name")), F.lit("")).alias("repaired"),
        _count(unmatched).alias("cnt"),
    )
    joined = attach(_with_entity(facts, entities), named, "alias_key", written=True)
    return joined.select(
        F.coalesce("abbr", F.lit("")).alias("abbr"),
        F.coalesce("manufacturer", "repaired").alias("manufacturer"),
        "client",
        "client_key",
        "be_name",
        "be_key",
        "cnt",
    )


def matched_rows(matched: DataFrame, dim: DataFrame, entities: DataFrame) -> DataFrame:
    """Matched counts with client and supplier; unknown abbreviations have no manufacturer."""
    facts = with_id_keys(matched, {"splist_id": "splist_id"}).select(
        "splist_id",
        strip(F.col("abbr")).alias("abbr"),
        _count(matched).alias("cnt"),
    )
    named = dim.select("abbr", "manufacturer", "legal_name")
    joined = attach(_with_entity(facts, entities), named, "abbr", written=True)
    return joined.select(
        "abbr",
        "manufacturer",
        "legal_name",
        "client",
        "client_key",
        "be_name",
        "be_key",
        F.col("splist_id").alias("be_id"),
        "cnt",
    )


def _count(facts: DataFrame):
    """The count of a fact row: text is parsed, a number is taken as it is."""
    return to_int(F.col("cnt")) if facts.schema["cnt"].dataType.typeName() == "string" else F.col("cnt")


def _summed(facts: DataFrame, *keys: str) -> DataFrame:
    """Add up the counts per raw key before any repair or join; sums are not changed by it."""
    return facts.groupBy(*keys).agg(F.sum(_count(facts)).alias("cnt"))


def report_long(
    unmatched: DataFrame, matched: DataFrame, dim: DataFrame, aliases: DataFrame, entities: DataFrame
) -> DataFrame:
    """Counts per block, supplier, client and entity; the source of every total and of the pivot."""
    blocks = {
        "unmatched": unmatched_rows(_summed(unmatched, "splist_id", "manu_name"), dim, aliases, entities),
        "matched": matched_rows(_summed(matched, "splist_id", "abbr"), dim, entities).where(
            F.col("manufacturer").isNotNull()
        ),
    }
    long = [
        rows.select(F.lit(block).alias("block"), *SUPPLIER, "client_key", "be_key", "cnt")
        for block, rows in blocks.items()
    ]
    return (
        long[0]
        .unionByName(long[1])
        .groupBy("block", *SUPPLIER, "client_key", "be_key")
        .agg(F.sum("cnt").alias("row_count"))
    )


def supplier_totals(long: DataFrame) -> DataFrame:
    """Unmatched and matched row totals per abbreviation and manufacturer, both in one grouping."""
    total = {
        b: F.coalesce(F.sum(F.when(F.col("block") == b, F.col("row_count"))), F.lit(0).cast("bigint"))
        for b in LABELS
    }
    return long.where("abbr <> ''").groupBy(*SUPPLIER).agg(*[v.alias(f"{b}_rows") for b, v in total.items()])


def _max_products(products: DataFrame, aliases: DataFrame) -> DataFrame:
    """Largest product count per canonical name, with its abbreviation or null."""
    by_name = products.groupBy("name").agg(F.max(to_int(F.col("cnt"))).alias("cnt"))
    keyed = by_name.withColumn("alias_key", canonical_key(F.col("name")))
    by_key = keyed.groupBy("alias_key").agg(F.max("cnt").alias("cnt"))
    return attach(by_key, aliases, "alias_key", written=True)


def products_in_db(products: DataFrame, dim: DataFrame, aliases: DataFrame) -> DataFrame:
    """Products per supplier: the largest count over batches and aliases, never the sum."""
    largest = (
        _max_products(products, aliases)
        .where(F.col("abbr").isNotNull())
        .groupBy("abbr")
        .agg(F.max("cnt").alias("products_in_db"))
    )
    return dim.select(*SUPPLIER).join(largest, "abbr", "left").fillna(0, ["products_in_db"])


def unmapped_suppliers(products: DataFrame, aliases: DataFrame) -> DataFrame:
    """Distinct product supplier keys without an alias."""
    keys = products.select("name").distinct().select(canonical_key(F.col("name")).alias("alias_key"))
    unknown = attach(keys.distinct(), aliases.select("alias_key"), "alias_key", "left_anti", written=True)
    return unknown.withColumnRenamed("alias_key", "unmapped_supplier_key")


def latest_dataset(datasets: DataFrame, dim: DataFrame, aliases: DataFrame) -> DataFrame:
    """Newest import per supplier and the number of its datasets, undated ones included.

    Format and origin are each taken from the newest dated row that has one, ties to the
    first row, so they can come from an older row than the date. Partial results per raw
    company name are combined per abbreviation.
    """
    missing = [c for c in OPTIONAL_ROLES["datasets"] if c not in datasets.columns]
    complete = datasets.withColumns({c: F.lit(None).cast("string") for c in missing})
    stamped = with_timestamps(complete, {"imported_at": "import_done"}).select(
        "company_source", "ord", "source_format", "source_origin", "imported_at"
    )
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    age = F.timestamp_diff("MICROSECOND", epoch, F.col("imported_at"))
    by_name = stamped.withColumn("age", age).groupBy("company_source").agg(
        F.count(F.lit(1)).alias("datasets_imported"),
        F.max("imported_at").alias("imported_at"),
        first_present("source_format", F.col("age"), "ord").alias("source_format"),
        first_present("source_origin", F.col("age"), "ord").alias("source_origin"),
    )
    keyed = by_name.withColumn("alias_key", canonical_key(F.col("company_source")))
    by_abbr = (
        attach(keyed, aliases, "alias_key", "inner", written=True)
        .groupBy("abbr")
        .agg(
            F.sum("datasets_imported").alias("datasets_imported"),
            F.max("imported_at").alias("imported_at"),
            F.min("source_format").alias("source_format"),
            F.min("source_origin").alias("source_origin"),
        )
    )
    text = {
        "import_done": format_date(F.col("imported_at")),
        "source_format": F.col("source_format.value"),
        "source_origin": F.col("source_origin.value"),
    }
    return (
        dim.select(*SUPPLIER)
        .join(by_abbr, "abbr", "left")
        .select(
            *SUPPLIER,
            *[F.coalesce(v, F.lit("")).alias(c) for c, v in text.items()],
            F.coalesce("datasets_imported", F.lit(0).cast("bigint")).alias("datasets_imported"),
        )
    )


def matched_at_latest(match_ts: DataFrame) -> DataFrame:
    """Newest match day per list id; null when no cell holds a date."""
    if "matched_at" not in match_ts.columns:
        match_ts = match_ts.limit(0).withColumn("matched_at", F.lit(None).cast("string"))
    keyed = with_timestamps(with_id_keys(match_ts, {"be_id": "list_id"}), {"at": "matched_at"}).select("be_id", "at")
    return (
        keyed.where("be_id <> ''")
        .groupBy("be_id")
        .agg(F.max("at").cast("date").alias("matched_at"))
    )


def matched_at_text(day: str = "matched_at"):
    """Presentation form of the match day."""
    return F.coalesce(format_date(F.col(day)), F.lit(NO_DATE))


def prior_period(prev: DataFrame) -> DataFrame:
    """Rate and tracking columns of the prior report, the first row per abbreviation."""
    tracked = [c for c in TRACKING if c in prev.columns]
    rows = prev.select(
        strip(F.col("abbr")).alias("abbr"),
        to_rate(F.col("last_month_mr")).alias("last_month_mr"),
        *tracked,
        "ord",
    )
    return keep_first(rows.where("abbr <> ''"), "abbr", "ord").drop("ord")


# Report ---------------------------------------------------------------------------------


def supplier_kpis(
    dim: DataFrame, long: DataFrame, products: DataFrame, datasets: DataFrame, prior: DataFrame
) -> DataFrame:
    """One row per supplier with totals, matching rate, products, datasets and prior figures.

    Every side has one row per abbreviation, so all joins share one partitioning. Totals belong
    to an abbreviation and a manufacturer, as in the wide report.
    """
    zero = F.lit(0).cast("bigint")
    joined = reduce(
        lambda left, right: left.join(right, "abbr", "left"),
        (products.drop("manufacturer"), datasets.drop("manufacturer"), prior),
        dim.select("abbr", "manufacturer", "legal_name").join(supplier_totals(long), SUPPLIER, "left"),
    )
    filled = joined.withColumns({c: F.coalesce(F.col(c), zero) for c in ("unmatched_rows", "matched_rows")})
    both = F.col("unmatched_rows") + F.col("matched_rows")
    return filled.withColumn("total_rows", both).withColumn(
        "matching_rate", F.try_divide(F.col("matched_rows"), F.col("total_rows"))
    )


def report_columns(entities: DataFrame, matched_at: DataFrame, long: DataFrame) -> DataFrame:
    """Header data of the wide report: one row per block and (client, entity) column.

    The list id is that of the first matching row. A display name is the one that was seen
    for the first time last.
    """
    used = long.select("client_key", "be_key").distinct()
    first_id = entities.groupBy("client_key", "be_key").agg(F.min_by("be_id", "ord").alias("be_id"))
    heads = used.join(first_id, ["client_key", "be_key"], "left").join(matched_at, "be_id", "left")
    for key, name in (("client_key", "client"), ("be_key", "be_name")):
        seen = entities.groupBy(key, name).agg(F.min("ord").alias("first_seen"))
        shown = seen.groupBy(key).agg(F.max_by(name, "first_seen").alias(name))
        heads = heads.join(shown, key, "left")
    return heads.select(
        F.explode(F.array(*[F.lit(v) for v in LABELS.values()])).alias("label"),
        F.coalesce("be_id", F.lit("")).alias("be_id"),
        matched_at_text().alias("matched_at"),
        F.coalesce("client", "client_key").alias("client"),
        F.coalesce("be_name", "be_key").alias("be_name"),
        "client_key",
        "be_key",
    )


def column_name(label: str, client_key: str, be_key: str) -> str:
    """Name of a pivoted report column; the separator inside a key is escaped, so names are unique."""
    keys = (k.replace("\\", "\\\\").replace("|", "\\|") for k in (client_key, be_key))
    return " | ".join((label, *keys))


def _escaped(key: str):
    return F.replace(F.replace(key, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))


def report_pairs(long: DataFrame) -> list[tuple[str, str]]:
    """The (client, entity) pairs of the wide report's columns, in order."""
    return sorted(tuple(r) for r in long.select("client_key", "be_key").distinct().collect())


def report_wide_parts(kpis: DataFrame, long: DataFrame, pairs: int = 1000) -> Iterator[DataFrame]:
    """The wide report in groups of columns, for more client entities than one table should have.

    Every part has all rows and the key figures, and the columns of so many client entities.
    """
    found = report_pairs(long)
    for i in range(0, max(1, len(found)), pairs):
        yield report_wide(kpis, long, found[i : i + pairs])


def report_wide(kpis: DataFrame, long: DataFrame, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """The wide report: key figures, then one column per block, client and entity.

    Names that could not be mapped appear as rows of their own with zero figures. Numeric
    gaps are filled with 0; missing text stays null. ``pairs`` limits the columns (not the rows)
    to some client entities.
    """
    label = F.concat_ws(
        " | ",
        F.when(F.col("block") == "unmatched", LABELS["unmatched"]).otherwise(LABELS["matched"]),
        _escaped("client_key"),
        _escaped("be_key"),
    )
    pairs = report_pairs(long) if pairs is None else pairs
    names = [column_name(v, *pair) for v in LABELS.values() for pair in pairs]
    counts = (
        long.withColumn("column", label)
        .groupBy(*SUPPLIER)
        .pivot("column", names)
        .agg(F.sum("row_count"))
    )
    wide = kpis.join(counts, SUPPLIER, "full_outer")
    figures = [c for c in REPORT_NAMES if c in wide.columns]

    def cell(source: str, name: str):
        column = F.col(f"`{source}`")
        numeric = wide.schema[source].dataType.typeName() != "string"
        return (F.coalesce(column, F.lit(0)) if numeric else column).alias(name)

    return wide.select(*[cell(c, REPORT_NAMES[c]) for c in figures], *[cell(n, n) for n in names])


def report_from_folders(spark: SparkSession, root: str, folders: dict[str, dict]) -> dict[str, DataFrame]:
    """All report tables from folders of raw exports, {kind: {"dir": ..., "formats": [...]}}.

    Kinds that are not named, and folders that are absent or empty, count as empty inputs; but a
    prior report that is named must be exactly one file.
    """
    others = {kind: spec for kind, spec in folders.items() if kind != "prev"}
    raw = load_inputs(spark, root, others, position="ord", null_tokens=PANDAS_NULLS)
    if "prev" in folders:
        spec = folders["prev"]
        raw["prev"] = read_prior_report(spark, f"{root}/{spec['dir']}", spec["formats"], PANDAS_NULLS)
    return build_report({kind: read_roles(frame, kind) for kind, frame in raw.items()})


def build_report(inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All report tables from the nine role-named inputs.

    The dimension, the aliases and the long counts are each read several times, so they are
    written to the shared folder once. Inputs that are absent count as empty, but for the
    supplier reference.
    """
    spark = inputs["supplier_ref"].sparkSession
    inputs = {kind: no_rows(spark, kind) for kind in CONTRACTS} | inputs
    dim = checkpointed(supplier_dim(inputs["supplier_ref"], inputs["rules"]))
    aliases = checkpointed(alias_table(dim))
    entities = checkpointed(entity_map(inputs["entities"]))
    long = checkpointed(
        report_long(inputs["unmatched"], inputs["matched"], dim, aliases, entities)
    )
    kpis = supplier_kpis(
        dim,
        long,
        products_in_db(inputs["products"], dim, aliases),
        latest_dataset(inputs["datasets"], dim, aliases),
        prior_period(inputs["prev"]),
    )
    return {
        "dim": dim,
        "aliases": aliases,
        "entities": entities,
        "long": long,
        "kpis": kpis,
        "columns": report_columns(entities, matched_at_latest(inputs["match_ts"]), long),
        "unmapped": unmapped_suppliers(inputs["products"], aliases),
    }
