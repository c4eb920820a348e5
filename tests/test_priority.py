import datetime

import pytest
from pyspark.sql import functions as F

from concord.plans import priority
from concord.session import checkpointed
from concord.sources import headers
from tests.conftest import rows

REF = [
    (1, "A", "Alpha", "Alpha GmbH"),
    (2, "B", "Beta", "ALPHA"),
    (3, "A", "Alias late", None),
    (4, None, "No key", None),
    (5, "", "Blank key", None),
    (6, "C", "Ça va", " "),
]
RULES = [("  beta ", " Y "), ("Alpha", "yes"), (None, "y")]


def ref(spark):
    return spark.createDataFrame(REF, "ord int, abbr string, manufacturer string, legal_name string")


def entities(spark):
    raw = spark.createDataFrame(
        [
            (1, "007", "Client  One", "Site", "1,000"),
            (2, "8.0", "CLIENT ONE", "Site", "n/a"),
            (3, "9", "client one", "Other", None),
            (4, "7", "Second", "Depot", "5"),
            (5, "10", "CLIENT ONE", "Site", "1"),
            (6, "11", None, "Nowhere", "1"),
        ],
        "ord int, be_id string, client string, be_name string, mm_total_rows string",
    )
    return priority.entity_map(raw)


def test_dimension_keeps_the_first_row_and_drops_missing_keys(spark):
    dim = priority.supplier_dim(ref(spark))
    assert rows(dim, "abbr", "manufacturer") == [("A", "Alpha"), ("B", "Beta"), ("C", "Ça va")]
    rules = spark.createDataFrame(RULES, "manufacturer string, exclude_flag string")
    assert rows(priority.supplier_dim(ref(spark), rules), "abbr") == [("A",), ("C",)]
    assert rows(priority.exclusion_counts(ref(spark), rules)) == [(3, 2, 1)]


def test_first_alias_wins_and_blank_names_give_none(spark):
    aliases = priority.alias_table(priority.supplier_dim(ref(spark)))
    assert rows(aliases, "alias_key", "abbr") == [
        ("alpha", "A"),
        ("alpha gmbh", "A"),
        ("beta", "B"),
        ("ça va", "C"),
    ]


def test_entities(spark):
    found = rows(entities(spark), "ord", "be_id", "client", "client_key", "mm_total_rows")
    assert found[0] == (1, "7", "Client One", "client one", 1000)
    assert found[1] == (2, "8", "CLIENT ONE", "client one", 0)
    assert found[2][4] == 0 and found[5][3] == ""


def test_counts_fan_out_and_unmapped_names_stay(spark):
    dim = priority.supplier_dim(ref(spark))
    aliases = priority.alias_table(dim)
    unmatched = spark.createDataFrame(
        [
            ("7.0", "ALPHA  gmbh", "1,000"),
            ("8", "Ã\u0087a va", "2"),
            ("8", "Who  is", "3"),
            ("8", None, "4"),
            ("99", "Alpha", "5"),
            ("11", "Alpha", "6"),
        ],
        "splist_id string, manu_name string, cnt string",
    )
    got = priority.unmatched_rows(unmatched, dim, aliases, entities(spark))
    assert rows(got, "abbr", "manufacturer", "client_key", "cnt") == [
        ("", "", "client one", 4),
        ("", "Who is", "client one", 3),
        ("A", "Alpha", "client one", 1000),
        ("A", "Alpha", "second", 1000),
        ("C", "Ça va", "client one", 2),
    ]
    matched = spark.createDataFrame(
        [("8", " A ", "10"), ("8", "Z", "20"), ("8", None, "30")], "splist_id string, abbr string, cnt string"
    )
    found = priority.matched_rows(matched, dim, entities(spark))
    assert rows(found, "abbr", "manufacturer", "cnt") == [(None, None, 30), ("A", "Alpha", 10), ("Z", None, 20)]
    long = priority.report_long(unmatched, matched, dim, aliases, entities(spark))
    assert rows(long.where("block = 'matched'"), "abbr", "row_count") == [("A", 10)]
    assert rows(priority.supplier_totals(long)) == [("A", "Alpha", 2000, 10), ("C", "Ça va", 2, 0)]


def test_products_take_the_largest_count(spark):
    dim = priority.supplier_dim(ref(spark))
    aliases = priority.alias_table(dim)
    products = spark.createDataFrame(
        [("Alpha", "5"), ("ALPHA ", "9"), ("alpha gmbh", "7"), ("Unknown", "1"), ("unknown ", "2")],
        "name string, cnt string",
    )
    got = priority.products_in_db(products, dim, aliases)
    assert rows(got, "abbr", "products_in_db") == [("A", 9), ("B", 0), ("C", 0)]
    assert rows(priority.unmapped_suppliers(products, aliases)) == [("unknown",)]


def test_latest_dataset_mixes_rows_per_column(spark):
    dim = priority.supplier_dim(ref(spark))
    data = [
        (1, "Alpha", "2024-01-05", "csv", "web"),
        (2, "alpha", "May 1, 2024", None, "ftp"),
        (3, "ALPHA GMBH", "2024-05-01", None, "mail"),
        (4, "Alpha", None, "xls", "web"),
        (5, "Beta", "soon", "pdf", "web"),
        (6, "Nobody", "2024-05-01", "csv", "web"),
    ]
    schema = "ord int, company_source string, import_done string, source_format string, source_origin string"
    got = priority.latest_dataset(spark.createDataFrame(data, schema), dim, priority.alias_table(dim))
    assert rows(got.drop("manufacturer")) == [
        ("A", "2024-05-01", "csv", "ftp", 4),
        ("B", "", "", "", 1),
        ("C", "", "", "", 0),
    ]
    bare = spark.createDataFrame(data, schema).drop("import_done", "source_origin")
    undated = priority.latest_dataset(bare, dim, priority.alias_table(dim))
    assert rows(undated, "abbr", "import_done", "datasets_imported")[0] == ("A", "", 4)


def test_match_days_and_prior_period(spark):
    stamps = spark.createDataFrame(
        [("7.0", "2024-01-01"), ("007", "Feb 3, 2024"), ("8", "never"), ("", "2024-01-01")],
        "list_id string, matched_at string",
    )
    latest = priority.matched_at_latest(stamps)
    assert rows(latest) == [("7", datetime.date(2024, 2, 3)), ("8", None)]
    assert rows(latest.select(priority.matched_at_text())) == [("2024-02-03",), ("N/A",)]
    prev = spark.createDataFrame(
        [(1, " A ", "0.5", "open"), (2, "A", "0.9", "done"), (3, "", "1", "x"), (4, "B", "n/a", None)],
        "ord int, abbr string, last_month_mr string, research string",
    )
    assert rows(priority.prior_period(prev)) == [("A", 0.5, "open"), ("B", None, None)]


def test_header_data_uses_first_id_and_last_new_name(spark):
    long = spark.createDataFrame([("client one", "site"), ("client one", "other")], ["client_key", "be_key"])
    stamps = spark.createDataFrame([("7", datetime.date(2024, 2, 3))], ["be_id", "matched_at"])
    heads = priority.report_columns(entities(spark), stamps, long)
    assert rows(heads.where("label = 'Unmatched'"), "be_key", "be_id", "matched_at", "client") == [
        ("other", "9", "N/A", "client one"),
        ("site", "7", "2024-02-03", "client one"),
    ]


def test_wide_report(spark):
    kpis = spark.createDataFrame(
        [("A", "Alpha", None, 3, 1, 2, None)],
        "abbr string, manufacturer string, legal_name string, total_rows bigint, unmatched_rows bigint,"
        " matched_rows bigint, matching_rate double",
    )
    long = spark.createDataFrame(
        [
            ("unmatched", "A", "Alpha", "c", "x", 1),
            ("matched", "A", "Alpha", "c", "y.z", 2),
            ("unmatched", "", "Who is", "c", "x", 4),
        ],
        "block string, abbr string, manufacturer string, client_key string, be_key string, row_count bigint",
    )
    wide = priority.report_wide(kpis, long)
    assert wide.columns[-4:] == [
        "Unmatched | c | x",
        "Unmatched | c | y.z",
        "Matched Rows | c | x",
        "Matched Rows | c | y.z",
    ]
    found = {r["Manufacturer"]: r for r in wide.collect()}
    assert tuple(found["Who is"])[:2] == ("", "Who is")
    assert found["Who is"]["Matching Rate"] == 0.0 and found["Who is"]["Legal Name"] is None
    assert found["Alpha"]["Matched Rows | c | y.z"] == 2 and found["Alpha"]["Matched Rows | c | x"] == 0
    parts = [p.columns[-2:] for p in priority.report_wide_parts(kpis, long, pairs=1)]
    assert parts == [["Unmatched | c | x", "Matched Rows | c | x"], ["Unmatched | c | y.z", "Matched Rows | c | y.z"]]


def test_wide_columns_with_the_separator_in_a_name(spark):
    kpis = spark.createDataFrame([("A", "Alpha", 3)], "abbr string, manufacturer string, total_rows bigint")
    long = spark.createDataFrame(
        [("matched", "A", "Alpha", "a | b", "c", 1), ("matched", "A", "Alpha", "a", "b | c", 2)],
        "block string, abbr string, manufacturer string, client_key string, be_key string, row_count bigint",
    )
    row = priority.report_wide(kpis, long).first().asDict()
    assert row[r"Matched Rows | a \| b | c"] == 1 and row[r"Matched Rows | a | b \| c"] == 2


def test_report_of_the_supplier_reference_alone(spark):
    """Every other input may be absent, or come from an empty folder."""
    nothing = spark.createDataFrame([], "struct<>")
    for others in ({}, {k: priority.read_roles(nothing, k) for k in priority.CONTRACTS if k != "supplier_ref"}):
        tables = priority.build_report({"supplier_ref": ref(spark), **others})
        kpis = tables["kpis"].collect()
        assert len(kpis) == 3 and all(r["total_rows"] == 0 and r["matching_rate"] is None for r in kpis)
        assert priority.report_wide(tables["kpis"], tables["long"]).count() == 3
        assert all(tables[t].isEmpty() for t in ("long", "columns", "unmapped"))


def test_match_dates_headed_by_a_plain_id(spark):
    frame = spark.createDataFrame([("7.0", "2024-02-03")], "id string, matchedat string")
    latest = priority.matched_at_latest(priority.read_roles(frame, "match_ts"))
    assert [tuple(map(str, r)) for r in latest.collect()] == [("7", "2024-02-03")]
    undated = spark.createDataFrame([("7",)], "id string")
    assert priority.matched_at_latest(priority.read_roles(undated, "match_ts")).collect() == []


def test_raw_headers_resolve_to_roles(spark):
    raw = spark.createDataFrame(
        [(1, "Alpha", "Alpha GmbH", "A")], ["ord", "Name", "LegalName", "Abbreviation"]
    )
    plain = headers.normalize_headers(raw, headers.arrow_header)
    assert rows(priority.read_roles(plain, "supplier_ref")) == [("Alpha", "Alpha GmbH", "A", 1)]
    with pytest.raises(ValueError, match="rules"):
        priority.read_roles(plain.drop("name", "legalname"), "rules")
    unflagged = priority.read_roles(plain.withColumnRenamed("name", "manufacturer"), "rules")
    assert rows(priority.excluded_keys(unflagged)) == []
    prior = headers.normalize_headers(
        spark.createDataFrame([("A", "0.1", "hi")], ["Abbreviation", "Matching  Rate", "CRM Stage"]),
        headers.arrow_header,
    )
    assert priority.read_roles(prior, "prev").columns == ["abbr", "last_month_mr", "stage_in_sf"]


def test_list_ids_are_worked_out_after_the_counting(spark):
    """No filter on the repaired list id is pushed below the aggregate that counts the raw rows."""
    raw = spark.createDataFrame([(7, "A"), (7, "A"), (8, "B"), (None, "A"), (99, "A")], "list long, abbr string")
    lists = raw.groupBy("list", "abbr").agg(F.count("*").alias("cnt"))
    facts = lists.select(F.concat(F.col("list").cast("string"), F.lit(".0")).alias("splist_id"), "abbr", "cnt")
    known = entities(spark).unionAll(spark.createDataFrame([(9, "Blank", "Site", "", 1, "blank", "site")], "ord int, client string, be_name string, be_id string, mm_total_rows bigint, client_key string, be_key string").select(entities(spark).columns))
    dim = checkpointed(priority.supplier_dim(ref(spark)))
    found = priority.matched_rows(facts, dim, checkpointed(known))
    assert rows(found, "abbr", "be_id", "cnt") == [("A", "7", 2), ("A", "7", 2), ("B", "8", 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan and "RLIKE" not in plan[plan.index("Aggregate") :]
