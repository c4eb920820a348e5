import pytest
from pyspark.sql import functions as F

from concord.operators.compare import FIELD_STATUSES
from concord.plans import lineage
from tests.conftest import rows

RESEARCH = [
    (1, "7.0", "m1", "YES", "Bolt", "X", "T", "BOLT", "X", "t"),
    (2, "7", "m2.0", "0", None, "Y", " ", "nan", "Z", "k"),
    (3, "8", "m1", "y", "Straße", "", "", "STRASSE", "", "nan"),
    (4, None, "m9", "true", "a", "b", "c", "x", "y", "z"),
    (5, "8", "100.0", "no", "", "", "", "", "", ""),
]
COLUMNS = ["n", *lineage.RESEARCH_COLUMNS]
MATCHING = [
    ("7", "m1", "false", "fit"),
    ("7.0", "m1", "True", "fit"),
    ("8", "m1", "no", None),
    ("8", "m1", "n", "poor"),
    ("9", "m3", "1", "fit"),
    (None, "m9", "yes", "fit"),
    ("7", " ", "yes", "fit"),
]


def inputs(spark):
    schema = "n int, " + ", ".join(f"{c} string" for c in lineage.RESEARCH_COLUMNS)
    return (
        spark.createDataFrame(RESEARCH, schema),
        spark.createDataFrame(MATCHING, "list_id string, material_reference string, is_matched string, grade string"),
        spark.createDataFrame([("m1",), ("m1",), ("100",), (None,)], "material_reference string"),
    )


def test_candidates_collapse_to_pairs(spark):
    pairs = lineage.collapse_candidates(inputs(spark)[1])
    assert rows(pairs) == [
        ("7", "m1", 2, 1, 1, "green"),
        ("8", "m1", 2, 0, 2, "yellow"),
        ("9", "m3", 1, 1, 0, "green"),
    ]
    described = lineage.candidate_descriptions(inputs(spark)[1])
    assert rows(described, "list_id", "field", "value", "n_candidates") == [
        ("7", "grade", "fit", 2),
        ("8", "grade", "poor", 1),
        ("9", "grade", "fit", 1),
    ]


def test_every_line_stays_once(spark):
    lines = lineage.build_lineage(*inputs(spark))
    assert rows(lines, "n", "match_status", "in_matching", "n_candidates", "imported", "research_returned") == [
        (1, "green", True, 2, True, True),
        (2, "no matching row", False, 0, False, False),
        (3, "yellow", True, 2, True, True),
        (4, "no matching row", False, 0, False, True),
        (5, "no matching row", False, 0, True, False),
    ]
    assert rows(lines, "n", "manufacturer_match", "article_match", "typecode_match", "identifier_agreement") == [
        (1, "match", "match", "match", "all_match"),
        (2, "both_blank", "mismatch", "original_blank", "partial_match"),
        (3, "match", "both_blank", "both_blank", "partial_match"),
        (4, "mismatch", "mismatch", "mismatch", "all_mismatch"),
        (5, "both_blank", "both_blank", "both_blank", "no_comparable_field"),
    ]


def test_summaries(spark):
    tables = lineage.lineage_tables(*inputs(spark))
    assert dict(rows(tables["coverage_summary"])) == {
        "research_rows": 5,
        "research_distinct_materials": 4,
        "research_returned": 3,
        "research_with_matching": 2,
        "research_green": 1,
        "research_yellow": 1,
        "research_no_matching_row": 3,
        "research_imported": 3,
        "pairs_in_research_not_matching": 3,
        "pairs_in_matching_not_research": 1,
    }
    crosstab = {r["status"]: r for r in tables["identifier_summary"].collect()}
    assert tuple(crosstab) == FIELD_STATUSES
    assert crosstab["match"]["manufacturer"] == 2 and crosstab["both_blank"]["article"] == 2
    assert crosstab["enrichment_blank"]["typecode"] == 0


def test_matcher_sees_the_raw_values(spark):
    compared = lineage.compare_identifiers(
        inputs(spark)[0], matcher=lambda a, b: F.length(a) == F.length(b)
    )
    assert rows(compared, "n", "manufacturer_match")[3] == (4, "match")
    assert rows(compared, "n", "manufacturer_match")[2] == (3, "mismatch")


def test_contracts(spark):
    research, matching, imports = inputs(spark)
    with pytest.raises(ValueError, match="matching candidates: no column .is_matched."):
        lineage.collapse_candidates(matching.drop("is_matched"))
    with pytest.raises(ValueError, match="research rows"):
        lineage.build_lineage(research.drop("list_id"), matching, imports)


def test_lines_are_shuffled_once(shuffled):
    """Lines, imports and pairs are each shuffled once, and frequent materials give the same rows."""
    lines = lineage.build_lineage(*inputs(shuffled))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3
    research, matching, imports = inputs(shuffled)
    many = research.crossJoin(shuffled.range(400).select("id"))
    found = lineage.build_lineage(many, matching, imports)
    counted = found.groupBy("n", "match_status", "n_candidates", "imported").count()
    assert rows(counted) == [
        (1, "green", 2, True, 400),
        (2, "no matching row", 0, False, 400),
        (3, "yellow", 2, True, 400),
        (4, "no matching row", 0, False, 400),
        (5, "no matching row", 0, True, 400),
    ]


def test_buckets_grow_with_the_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lineage, "BUCKET_LINES", 2)
    research, matching, imports = inputs(spark)
    saved = lineage.save_lineage_inputs(research, matching, "tests_buckets", str(tmp_path))
    for name in saved:
        about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED tests_buckets_{name}").collect()}
        assert about["Num Buckets"] == "3"
    found = lineage.lineage_from_tables(saved["lines"], saved["pairs"], imports)
    built = lineage.build_lineage(research, matching, imports)
    assert rows(found.select(*built.columns)) == rows(built)
