import pytest

from concord.plans import coverage
from tests.conftest import rows


def observed(spark, data):
    return spark.createDataFrame(data, "list_id string, item_id string, source_id string, source_name string")


def test_unknown_and_blank_sources_are_labelled(spark):
    seen = spark.createDataFrame(
        [("l1", "i1", "a"), ("l1", "i2", "zzz"), ("l1", "i3", "blank"), ("l1", "i4", ""), ("l1", "i5", None)],
        "list_id string, item_id string, source_id string",
    )
    lookup = spark.createDataFrame(
        [(1, "a", "Alpha"), (2, "a", "Late"), (3, "blank", ""), (4, None, "Nobody")],
        "ord int, `Source ID` string, `Source-Name` string",
    )
    got = coverage.annotate_sources(seen, lookup)
    assert rows(got, "item_id", "source_name") == [
        ("i1", "Alpha"),
        ("i2", "no-source-found"),
        ("i3", "no-source-found"),
        ("i4", "no-source-found"),
        ("i5", "no-source-found"),
    ]
    bare = coverage.annotate_sources(seen)
    assert {r["source_name"] for r in bare.collect()} == {"no-source-found"}
    assert rows(coverage.unmatched_source_rate(got)) == [(0.8,)]


def test_coverage_counts_distinct_items_and_weights_by_list(spark):
    candidates = spark.createDataFrame(
        [("a", "1"), ("a", "2"), ("a", "3"), ("a", "3"), ("b", "9"), ("empty", "7")], ["List ID", "Item ID"]
    )
    seen = observed(
        spark,
        [
            ("a", "1", "s1", "S"),
            ("a", "1", "s1", "S"),
            ("a", "2", "s1", "S"),
            ("a", "2", "t1", "T"),
            ("b", "9", "s1", "S"),
            ("unlisted", "1", "s1", "S"),
        ],
    )
    table = coverage.list_coverage(candidates, seen)
    assert rows(table, "list_id", "source_name", "covered_items", "candidate_items") == [
        ("a", "S", 2, 3),
        ("a", "T", 1, 3),
        ("b", "S", 1, 1),
        ("empty", None, 0, 1),
    ]
    summary = {r["source_name"]: r for r in coverage.summarize_coverage(table).collect()}
    assert summary["S"]["lists"] == 2
    assert summary["S"]["weighted_coverage"] == 3 / 4
    assert summary["S"]["unweighted_coverage"] == pytest.approx((2 / 3 + 1) / 2)
    assert summary["T"]["weighted_coverage"] == 1 / 3
    assert summary[None]["lists"] == 1 and summary[None]["weighted_coverage"] == 0.0
    share = {r["source_name"]: r["observed_records"] for r in coverage.source_share(seen).collect()}
    assert share == {"S": 4, "T": 1}


def test_coverage_can_exceed_one_unless_restricted(spark):
    candidates = spark.createDataFrame([("a", "1")], ["list_id", "item_id"])
    seen = observed(spark, [("a", "1", "s", "S"), ("a", "2", "s", "S")])
    assert rows(coverage.list_coverage(candidates, seen), "coverage") == [(2.0,)]
    restricted = coverage.list_coverage(candidates, seen, restrict_to_candidates=True)
    assert rows(restricted, "coverage") == [(1.0,)]


def test_missing_item_counts_and_missing_list_does_not(spark):
    candidates = spark.createDataFrame(
        [("a", None), ("a", None), ("a", "1"), (None, "1")], "list_id string, item_id string"
    )
    assert rows(coverage.candidate_totals(candidates)) == [("a", 2)]


def test_empty_input_and_order(spark):
    none = observed(spark, [])
    assert rows(coverage.unmatched_source_rate(none)) == [(0.0,)]
    assert rows(coverage.source_share(none)) == []
    candidates = spark.createDataFrame([("b", "1"), ("a", "1")], ["list_id", "item_id"])
    seen = spark.createDataFrame([("b", "1", "x")], ["list_id", "item_id", "source_id"])
    tables = coverage.coverage_tables(seen, candidates)
    assert [r["list_id"] for r in tables["list_coverage"].collect()] == ["a", "b"]
    assert tables["coverage_summary"].collect()[-1]["source_name"] is None
    with pytest.raises(ValueError, match="source_name"):
        coverage.list_coverage(candidates, seen)
