"""One entry per job or operator: (session, folder of tables) -> result.

Doubles are rounded here and in the SQL alike, because sums of doubles depend on the order
in which partitions are added.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.views import view
from concord.functions.dates import format_date, with_timestamps
from concord.functions.numbers import with_counts, with_id_keys
from concord.functions.text import canonical_key, loose_key, repair_text, with_identifiers
from concord.operators.compare import arrow_matcher
from concord.operators.keyed import keep_first, source_ordinal
from concord.plans import cleaning, coverage, lineage, priority, quality, trips
from concord.session import checkpointed, shared_folder
from concord.sources import folders, headers, sinks


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in doubles})


# Trips ----------------------------------------------------------------------------------


def _clean(spark, sf):
    return trips.clean_trips(view(spark, sf, "v_trips"))


def trips_clean(spark, sf):
    return rounded(_clean(spark, sf))


def trips_daily(spark, sf):
    return rounded(trips.daily_metrics(_clean(spark, sf)), 4)


def trips_hourly(spark, sf):
    return rounded(trips.hourly_demand(_clean(spark, sf)), 4)


def trips_zone(spark, sf):
    return rounded(trips.zone_performance(_clean(spark, sf)), 4)


def trips_stage_counts(spark, sf):
    return trips.stage_counts(view(spark, sf, "v_trips"))


def source_preview(spark, sf):
    return folders.preview(view(spark, sf, "v_trips"))


def csv_preview(spark, sf):
    """The preview of the customers written as CSV, with the types that are inferred."""
    folder = shared_folder(spark)
    sinks.write_csv(view(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), folder)
    return folders.preview_csv(spark, folder)


def source_sample(spark, sf):
    return rounded(folders.sample_rows(view(spark, sf, "v_trips"), "trip_id"))


def mart_roundtrip(spark, sf):
    """The daily mart after writing the clean trips and all marts and reading them again."""
    tables = trips.write_marts(view(spark, sf, "v_trips"), shared_folder(spark))
    return rounded(tables["daily_metrics"], 4)


def _increments(spark, sf):
    """Two halves of the month loaded one after the other, then one day of each again."""
    raw, folder = view(spark, sf, "v_trips"), shared_folder(spark)
    for first, last in (("2024-01-16", "2024-01-31"), ("2024-01-01", "2024-01-15"), ("2024-01-20", "2024-01-20"), ("2024-01-03", "2024-01-03")):
        trips.load_days(raw, folder, first, last)
    return trips.merged_marts(spark, folder)


def mart_increment(spark, sf):
    return rounded(_increments(spark, sf)["daily_metrics"], 4)


def mart_increment_zones(spark, sf):
    return rounded(_increments(spark, sf)["zone_performance"], 4)


def mart_table(spark, sf):
    """The hourly mart after saving it as a catalog table."""
    sinks.save_table(trips.hourly_demand(_clean(spark, sf)), "concord_hourly_demand", shared_folder(spark))
    return rounded(spark.table("concord_hourly_demand"), 4)


# Priority report ------------------------------------------------------------------------


def _inputs(spark, sf):
    names = ("supplier_ref", "entities", "matched", "unmatched", "products", "datasets", "rules", "prev", "match_ts")
    return {n: view(spark, sf, f"v_{n}") for n in names}


def _dim(spark, sf):
    return checkpointed(priority.supplier_dim(view(spark, sf, "v_supplier_ref"), view(spark, sf, "v_rules")))


def _names(spark, sf):
    """The dimension and its aliases, each written once."""
    dim = _dim(spark, sf)
    return dim, checkpointed(priority.alias_table(dim))


def _entities(spark, sf):
    return checkpointed(priority.entity_map(view(spark, sf, "v_entities")))


def supplier_dim(spark, sf):
    return priority.supplier_dim(view(spark, sf, "v_supplier_ref"))


def supplier_dim_excluded(spark, sf):
    return priority.supplier_dim(view(spark, sf, "v_supplier_ref"), view(spark, sf, "v_rules"))


def exclusion_counts(spark, sf):
    return priority.exclusion_counts(view(spark, sf, "v_supplier_ref"), view(spark, sf, "v_rules"))


def alias_table(spark, sf):
    return priority.alias_table(priority.supplier_dim(view(spark, sf, "v_supplier_ref")))


def entity_map(spark, sf):
    return priority.entity_map(view(spark, sf, "v_entities"))


def unmatched_by_entity(spark, sf):
    return priority.unmatched_rows(view(spark, sf, "v_unmatched"), *_names(spark, sf), _entities(spark, sf))


def matched_by_entity(spark, sf):
    return priority.matched_rows(view(spark, sf, "v_matched"), _dim(spark, sf), _entities(spark, sf))


def products_max(spark, sf):
    return priority.products_in_db(view(spark, sf, "v_products"), *_names(spark, sf))


def unmapped_suppliers(spark, sf):
    return priority.unmapped_suppliers(view(spark, sf, "v_products"), _names(spark, sf)[1])


def unmapped_diagnostics(spark, sf):
    """The unmapped names after writing the diagnostics table, which is written as it has rows."""
    folder = shared_folder(spark)
    written = sinks.write_if_any(unmapped_suppliers(spark, sf), f"{folder}/unmapped")
    none = sinks.write_if_any(unmapped_suppliers(spark, sf).where("unmapped_supplier_key IS NULL"), f"{folder}/none")
    if not written or none:
        raise AssertionError("a table is written if and only if it has rows")
    return folders.read_csv_folder(spark, f"{folder}/unmapped")


def latest_dataset(spark, sf):
    return priority.latest_dataset(view(spark, sf, "v_datasets"), *_names(spark, sf))


def matched_at_latest(spark, sf):
    latest = priority.matched_at_latest(view(spark, sf, "v_match_ts"))
    return latest.select("be_id", priority.matched_at_text().alias("matched_at"))


def prior_period(spark, sf):
    return priority.prior_period(view(spark, sf, "v_prev"))


def supplier_kpis(spark, sf):
    return rounded(priority.build_report(_inputs(spark, sf))["kpis"])


def _long(spark, sf):
    unmatched, matched = view(spark, sf, "v_unmatched"), view(spark, sf, "v_matched")
    return priority.report_long(unmatched, matched, *_names(spark, sf), _entities(spark, sf))


def report_long(spark, sf):
    return _long(spark, sf)


def report_pivot(spark, sf):
    tables = priority.build_report(_inputs(spark, sf))
    return rounded(priority.report_wide(tables["kpis"], tables["long"]))


# Raw headers that exports of the report's inputs have.
RAW_HEADERS = {
    "supplier_ref": {"abbr": "Abbreviation", "manufacturer": "Name", "legal_name": "LegalName"},
    "unmatched": {"splist_id": "SparePartListId", "manu_name": "ManufacturerName", "cnt": "Count"},
    "matched": {"splist_id": "SparePartListId", "abbr": "SPT ID  Abbreviation", "cnt": "Rows"},
    "datasets": {"company_source": "Company Source", "import_done": "ImportDone", "source_format": "SourceFormat", "source_origin": "SourceOrigin"},
    "products": {"name": "Manufacturer: Name", "batch": "Batch", "cnt": "COUNT"},
    "entities": {"be_id": "ID", "client": "Clients → Name", "be_name": "BusinessEntities → Name", "mm_total_rows": "TotalNumberOfRows"},
    "rules": {"manufacturer": "Manufacturer", "exclude_flag": "Exclude due to bad name"},
    "prev": {"abbr": "Abbreviation", "last_month_mr": "Matching Rate", "research": "Research"},
    "match_ts": {"list_id": "id", "matched_at": "MatchedAt"},
}


def report_from_folders(spark, sf):
    """The wide report from exports: the inputs written as CSV, JSON or Parquet with raw headers, in order."""
    root, spec = shared_folder(spark), {}
    for i, (kind, names) in enumerate(RAW_HEADERS.items()):
        frame = view(spark, sf, f"v_{kind}")
        ordered = frame.orderBy("ord") if "ord" in frame.columns else frame
        ordered = ordered.coalesce(1) if kind == "prev" else ordered  # the prior report is one file
        cells = [F.col(role).cast("string").alias(raw) for role, raw in names.items()]
        form = folders.FORMATS[i % len(folders.FORMATS)]
        options = {"header": True, "quote": '"', "escape": '"'} if form == "csv" else {"ignoreNullFields": False}
        ordered.select(*cells).write.format(form).options(**options).save(f"{root}/{kind}")
        spec[kind] = {"dir": kind, "formats": ["csv", "json", "parquet"]}
    tables = priority.report_from_folders(spark, root, spec)
    return rounded(priority.report_wide(tables["kpis"], tables["long"]))


def report_percent(spark, sf):
    """The rates of the report file, which are percent text there; read back with its own headers."""
    tables = priority.build_report(_inputs(spark, sf))
    folder = shared_folder(spark)
    sinks.write_report(priority.report_wide(tables["kpis"], tables["long"]), folder)
    return folders.read_table(spark, folder).select("Abbreviation", "Manufacturer", "Matching Rate", "Last Month MR")


def report_columns(spark, sf):
    entities = _entities(spark, sf)
    matched_at = priority.matched_at_latest(view(spark, sf, "v_match_ts"))
    unmatched, matched = view(spark, sf, "v_unmatched"), view(spark, sf, "v_matched")
    long = priority.report_long(unmatched, matched, *_names(spark, sf), entities)
    return priority.report_columns(entities, matched_at, long)


def report_without_optional_inputs(spark, sf):
    """The key figures when rules, datasets, match dates and the prior report are absent."""
    inputs = {k: v for k, v in _inputs(spark, sf).items() if k not in ("rules", "datasets", "match_ts", "prev")}
    return rounded(priority.build_report(inputs)["kpis"])


# Catalog quality ------------------------------------------------------------------------


def name_standardised(spark, sf):
    lookup = quality.name_lookup(view(spark, sf, "v_master"))
    return quality.standardize_names(view(spark, sf, "v_catalog"), lookup)


def name_standardised_by_key(spark, sf):
    lookup = quality.name_lookup(view(spark, sf, "v_master"), key=canonical_key)
    return quality.standardize_names(view(spark, sf, "v_catalog"), lookup, key=canonical_key)


def fk_enriched(spark, sf):
    return quality.enrich(view(spark, sf, "v_catalog"), view(spark, sf, "v_master"))


def match_rates(spark, sf):
    return rounded(quality.match_rates(name_standardised(spark, sf), view(spark, sf, "v_master")))


def match_rates_by_key(spark, sf):
    return rounded(quality.match_rates(name_standardised_by_key(spark, sf), view(spark, sf, "v_master")))


def parent_rollup(spark, sf):
    return quality.parent_rollup(view(spark, sf, "v_master"))


PART_KEY = ["manufacturer_name_canonical", "manufacturer_article"]


def _feed(spark, sf):
    """The catalog sent twice: every row has a byte-for-byte repeat."""
    rows = view(spark, sf, "v_catalog").drop("row_id")
    return rows.unionAll(rows)


def catalog_dedup_full(spark, sf):
    return _feed(spark, sf).distinct()


def catalog_keep_none(spark, sf):
    return quality.remove_duplicates(_feed(spark, sf), PART_KEY)


def first_orders(spark, sf):
    """Each customer's first order, whole rows; only keys and places are shuffled to find it."""
    return keep_first(view(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], wide=True).select(
        "o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus"
    )


def near_duplicates_compared(spark, sf):
    """How many rows have to be compared to find the near duplicates; the others are certainly alone."""
    return rounded(quality.compared_share(view(spark, sf, "v_catalog"), PART_KEY, key=loose_key))


def fk_from_tables(spark, sf):
    """fk_enriched on a catalog and a master that are saved bucketed by the manufacturer."""
    root = shared_folder(spark)
    saved = [
        sinks.save_bucketed(view(spark, sf, f"v_{name}"), f"concord_{name}", ["manufacturer_id"], 4, f"{root}/{name}")
        for name in ("catalog", "master")
    ]
    return quality.enrich(*saved, stored=True)


def duplicate_counts(spark, sf):
    return quality.duplicate_counts(view(spark, sf, "v_catalog"), PART_KEY, PART_KEY)


def near_duplicates(spark, sf):
    return quality.near_duplicates(view(spark, sf, "v_catalog"), PART_KEY, "row_id")


def near_duplicate_documents(spark, sf):
    documents = view(spark, sf, "documents")
    return quality.near_duplicates(documents, ["lang", "text"], "doc_id", digest=True).select(
        "doc_id", "lang", "source"
    )


def near_duplicates_loose(spark, sf):
    catalog = view(spark, sf, "v_catalog")
    return quality.near_duplicates(catalog, PART_KEY, "row_id", key=loose_key)


def duplicate_groups(spark, sf):
    return quality.duplicate_groups(view(spark, sf, "v_catalog"), PART_KEY, "row_id")


# Coverage -------------------------------------------------------------------------------


def _annotated(spark, sf):
    return coverage.annotate_sources(view(spark, sf, "v_observed"), view(spark, sf, "v_lookup"))


def observed_annotated(spark, sf):
    return _annotated(spark, sf)


def observed_no_lookup(spark, sf):
    return coverage.annotate_sources(view(spark, sf, "v_observed"))


def source_share(spark, sf):
    return rounded(coverage.source_share(_annotated(spark, sf)))


def candidate_totals(spark, sf):
    return coverage.candidate_totals(view(spark, sf, "v_candidates"))


def _coverage(spark, sf, **options):
    return coverage.list_coverage(view(spark, sf, "v_candidates"), _annotated(spark, sf), **options)


def list_coverage(spark, sf):
    return rounded(_coverage(spark, sf))


def coverage_restricted(spark, sf):
    return rounded(_coverage(spark, sf, restrict_to_candidates=True))


def coverage_summary(spark, sf):
    return rounded(coverage.summarize_coverage(_coverage(spark, sf)))


def unmatched_rate(spark, sf):
    return rounded(coverage.unmatched_source_rate(_annotated(spark, sf)))


def coverage_by_batches(spark, sf):
    """The coverage of three batches loaded one after the other, the second one twice."""
    folder, observed = shared_folder(spark), _annotated(spark, sf)
    part = F.pmod(F.xxhash64("list_id", "item_id", "source_id"), F.lit(3))
    dealt = checkpointed(observed.withColumn("part", part))
    for batch in (0, 1, 2, 1):
        coverage.add_batch(dealt.where(F.col("part") == batch), folder, f"b{batch}")
    return rounded(coverage.batch_coverage(spark, view(spark, sf, "v_candidates"), folder))


def coverage_from_folders(spark, sf):
    """The coverage of CSV batches read from a folder, as the whole run gives it."""
    folder = shared_folder(spark)
    sinks.write_csv(view(spark, sf, "v_observed").toDF("List ID", "Item-ID", "SOURCE_id"), folder)
    batches = folders.load_batches(spark, folder, coverage.OBSERVED_COLUMNS).drop("batch_name")
    tables = coverage.coverage_tables(batches, view(spark, sf, "v_candidates"), view(spark, sf, "v_lookup"))
    return rounded(tables["list_coverage"])


def coverage_positions(spark, sf):
    """The place of each coverage row in report order, lists without a source last."""
    name = F.col("source_name")
    place = F.struct("list_id", name.isNull().alias("last"), name.alias("source_name"))
    ordered = source_ordinal(_coverage(spark, sf).withColumn("place", place), "place", "position")
    return ordered.select("position", "list_id", "source_name")


# Audited cleaning -----------------------------------------------------------------------


def _cleaned(spark, sf):
    return cleaning.clean_catalog(view(spark, sf, "v_catalog"), view(spark, sf, "v_mapping"))


def catalog_cleaned(spark, sf):
    return _cleaned(spark, sf)[0]


def catalog_audit(spark, sf):
    return _cleaned(spark, sf)[1]


def cleaning_from_folders(spark, sf):
    """The audit log of a catalog read from CSV, numbered by the place of its rows."""
    root = shared_folder(spark)
    sinks.write_csv(view(spark, sf, "v_catalog").orderBy("row_id").drop("row_id"), f"{root}/catalog")
    catalog = folders.read_folder(spark, f"{root}/catalog", ["csv"], position="ord")
    return cleaning.cleaning_tables(catalog, view(spark, sf, "v_mapping"), "ord")["audit_log"]


def catalog_filled(spark, sf):
    """The cleaned catalog of an export without the two address columns, which are created blank."""
    export = view(spark, sf, "v_catalog").drop("manufacturer_url", "supplier_url")
    return cleaning.clean_catalog(export, view(spark, sf, "v_mapping"))[0]


def mapping_from_json(spark, sf):
    """The name of every part and its brand as JSON objects, one a line, read back as rows."""
    folder = shared_folder(spark)
    view(spark, sf, "v_part_mapping").select(F.to_json(F.create_map("name_key", "mapped")).alias("value")).write.text(folder)
    return folders.read_mapping(spark, folder, records=True)


def catalog_roles(spark, sf):
    return cleaning.with_role(_cleaned(spark, sf)[0]).select("row_id", "source_row", "role")


def row_ordinal(spark, sf):
    """Orders numbered by a text key, the missing keys first, in several ranges."""
    key = F.when(F.col("o_orderkey") != 1, F.concat_ws("-", "o_orderpriority", F.lpad(F.col("o_orderkey").cast("string"), 12, "0")))
    named = view(spark, sf, "orders").select("o_orderkey", key.alias("place"))
    return source_ordinal(named, "place", partitions=7)


# Lineage --------------------------------------------------------------------------------


def _lineage(spark, sf):
    research, matching, imports = (view(spark, sf, f"v_{n}") for n in ("research", "matching", "imports"))
    pairs = checkpointed(lineage.collapse_candidates(matching))
    return lineage.build_lineage(research, matching, imports, pairs), pairs


def candidate_pairs(spark, sf):
    return lineage.collapse_candidates(view(spark, sf, "v_matching"))


def candidate_descriptions(spark, sf):
    return lineage.candidate_descriptions(view(spark, sf, "v_matching"))


def lineage_rows(spark, sf):
    return _lineage(spark, sf)[0]


def identifier_status(spark, sf):
    """Lines per combination of field statuses and agreement."""
    rows = lineage.compare_identifiers(view(spark, sf, "v_research"))
    statuses = [f"{f}_match" for f in lineage.FIELDS]
    return rows.groupBy(*statuses, "identifier_agreement").agg(F.count(F.lit(1)).alias("lines"))


def identifier_matcher(spark, sf):
    """Lines per combination of field statuses when two shared letters at the start count as a match."""
    def alike(left, right):
        return F.left(F.lower(F.trim(left)), F.lit(2)) == F.left(F.lower(F.trim(right)), F.lit(2))

    rows = lineage.compare_identifiers(view(spark, sf, "v_research"), alike)
    return rows.groupBy(*[f"{f}_match" for f in lineage.FIELDS]).agg(F.count(F.lit(1)).alias("lines"))


def _alike(left: pa.Array, right: pa.Array) -> pa.Array:
    """Two shared letters at the start, as identifier_matcher has it."""
    starts = [pc.utf8_slice_codeunits(pc.utf8_lower(pc.utf8_trim(side, " ")), 0, 2) for side in (left, right)]
    return pc.equal(*starts)


def identifier_matcher_arrow(spark, sf):
    """identifier_matcher with the predicate over Arrow arrays."""
    rows = lineage.compare_identifiers(view(spark, sf, "v_research"), arrow_matcher(_alike))
    return rows.groupBy(*[f"{f}_match" for f in lineage.FIELDS]).agg(F.count(F.lit(1)).alias("lines"))


def lineage_from_tables(spark, sf):
    """The lineage rows from lines and pairs that are saved bucketed by their key."""
    research, matching, imports = (view(spark, sf, f"v_{n}") for n in ("research", "matching", "imports"))
    saved = lineage.save_lineage_inputs(research, matching, "concord_lineage", shared_folder(spark))
    return lineage.lineage_from_tables(saved["lines"], saved["pairs"], imports)


def lineage_summary(spark, sf):
    research, matching, imports = (view(spark, sf, f"v_{n}") for n in ("research", "matching", "imports"))
    return lineage.lineage_tables(research, matching, imports)["coverage_summary"]


def lineage_from_folders(spark, sf):
    """The summary of a lineage run over inputs of three formats."""
    root, inputs = shared_folder(spark), []
    formats = {"json": {"ignoreNullFields": False, "compression": "gzip"}, "parquet": {}, "csv": {"header": True}}
    for name, (form, options) in zip(("research", "matching", "imports"), formats.items()):
        view(spark, sf, f"v_{name}").write.format(form).options(**options).save(f"{root}/{name}")
        inputs.append(folders.read_folder(spark, f"{root}/{name}", ["csv", "json", "parquet"]))
    return lineage.lineage_tables(*inputs)["coverage_summary"]


def identifier_crosstab(spark, sf):
    return lineage.identifier_summary(lineage.compare_identifiers(view(spark, sf, "v_research")))


# Functions and sources ------------------------------------------------------------------


def text_repair(spark, sf):
    text = F.col("text")
    return view(spark, sf, "documents").select(
        "doc_id", repair_text(text).alias("repaired"), canonical_key(text).alias("text_key")
    )


def text_misread(spark, sf):
    """Documents whose UTF-8 was read as Latin-1; two letters whose bytes are white space there are replaced first."""
    text = F.translate("text", "àÅ", "aA")
    misread = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    return view(spark, sf, "documents").select("doc_id", repair_text(misread).alias("repaired"))


def text_widened(spark, sf):
    """Documents in full-width letters, which become plain ones again."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    wide = F.translate("text", letters, "".join(chr(ord(c) + 0xFEE0) for c in letters))
    return view(spark, sf, "documents").select("doc_id", repair_text(wide).alias("repaired"))


def id_and_int_parse(spark, sf):
    parsed = with_id_keys(with_counts(view(spark, sf, "v_id_text"), {"as_count": "raw"}), {"as_key": "raw"})
    return with_identifiers(parsed, {"as_identifier": "raw"}).drop("raw")


def date_parse(spark, sf):
    day = F.col("at").cast("date")
    return with_timestamps(view(spark, sf, "v_date_text"), {"at": "raw"}).select(
        "o_orderkey",
        day.alias("day"),
        format_date(day).alias("day_text"),
        F.coalesce(format_date(day), F.lit("")).alias("day_or_blank"),
    )


def batch_union(spark, sf):
    """Observed rows written as CSV batches of two header styles and read back as one table."""
    folder = shared_folder(spark)
    observed = view(spark, sf, "v_observed")
    first = observed.toDF("List ID", "Item-ID", "SOURCE_id")
    second = observed.select("source_id", "list_id", "item_id", F.lit("b").alias("Remark"))
    sinks.write_csv(first, folder)
    second.write.mode("append").options(header=True, quote='"', escape='"').csv(folder)
    batches = folders.load_batches(spark, folder, coverage.OBSERVED_COLUMNS)
    return batches.groupBy("list_id", "source_id", "remark").agg(
        F.count(F.lit(1)).alias("observed_rows"), F.count_distinct("item_id").alias("items")
    )


# Raw headers of the entities, as exports have them.
RAW_ENTITIES = {
    "ord": "ord",
    "client": "Clients → Name",
    "be_name": "BusinessEntities - BusinessEntityId â†’ Name",
    "be_id": "ID",
    "mm_total_rows": "Total NumberOfRows TotalNumberOfRows",
}


def hint_resolution(spark, sf):
    """The entity map from raw headers, which resolve to the same roles."""
    raw = view(spark, sf, "v_entities").select(
        *[F.col(role).alias(header) for role, header in RAW_ENTITIES.items()]
    )
    plain = headers.normalize_headers(raw, headers.arrow_header)
    return priority.entity_map(priority.read_roles(plain, "entities"))


JOBS = (
    trips_clean,
    trips_daily,
    trips_hourly,
    trips_zone,
    trips_stage_counts,
    source_preview,
    source_sample,
    csv_preview,
    mart_roundtrip,
    mart_increment,
    mart_increment_zones,
    mart_table,
    supplier_dim,
    supplier_dim_excluded,
    exclusion_counts,
    alias_table,
    entity_map,
    unmatched_by_entity,
    matched_by_entity,
    products_max,
    unmapped_suppliers,
    unmapped_diagnostics,
    latest_dataset,
    matched_at_latest,
    prior_period,
    supplier_kpis,
    report_long,
    report_pivot,
    report_from_folders,
    report_percent,
    report_columns,
    report_without_optional_inputs,
    name_standardised,
    name_standardised_by_key,
    fk_enriched,
    fk_from_tables,
    match_rates,
    match_rates_by_key,
    parent_rollup,
    catalog_dedup_full,
    catalog_keep_none,
    first_orders,
    near_duplicates_compared,
    duplicate_counts,
    near_duplicates,
    near_duplicate_documents,
    near_duplicates_loose,
    duplicate_groups,
    observed_annotated,
    observed_no_lookup,
    source_share,
    candidate_totals,
    list_coverage,
    coverage_restricted,
    coverage_summary,
    unmatched_rate,
    coverage_by_batches,
    coverage_from_folders,
    coverage_positions,
    catalog_cleaned,
    catalog_audit,
    cleaning_from_folders,
    catalog_filled,
    mapping_from_json,
    catalog_roles,
    row_ordinal,
    candidate_pairs,
    candidate_descriptions,
    lineage_rows,
    identifier_status,
    identifier_matcher,
    identifier_matcher_arrow,
    lineage_summary,
    lineage_from_tables,
    lineage_from_folders,
    identifier_crosstab,
    text_repair,
    text_misread,
    text_widened,
    id_and_int_parse,
    date_parse,
    batch_union,
    hint_resolution,
)

QUERIES = {job.__name__: job for job in JOBS}
