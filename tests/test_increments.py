"""Marts loaded by days, coverage loaded by batches, saved tables, and the report's prior file."""

import pytest
from pyspark.sql import functions as F

from checks.views import view
from concord.operators import keyed
from concord.operators.compare import arrow_matcher, compare_fields
from concord.plans import coverage, lineage, priority, trips
from concord.sources import folders
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def rounded(df):
    doubles = {c: F.round(c, 4) for c, t in df.dtypes if t == "double"}
    return rows(df.withColumns(doubles).select(*sorted(df.columns)))


def test_loaded_days_replace_only_those(spark, tmp_path):
    raw, folder = view(spark, SF, "v_trips"), str(tmp_path)
    trips.load_days(raw, folder, "2024-01-01", "2024-01-31")
    whole = trips.clean_trips(raw)
    marts = trips.merged_marts(spark, folder)
    assert rounded(marts["daily_metrics"]) == rounded(trips.daily_metrics(whole))
    assert rounded(marts["hourly_demand"]) == rounded(trips.hourly_demand(whole))
    assert rounded(marts["zone_performance"]) == rounded(trips.zone_performance(whole))
    # Two days again: one of them has lost its trips, the other half of them.
    day = F.col("trip_start_timestamp").cast("date").cast("string")
    left = raw.where((day != "2024-01-05") & ((day != "2024-01-06") | (F.col("trip_id") % 2 == 0)))
    trips.load_days(left, folder, "2024-01-05", "2024-01-06")
    marts = trips.merged_marts(spark, folder)
    assert rounded(marts["daily_metrics"]) == rounded(trips.daily_metrics(trips.clean_trips(left)))
    assert not list(tmp_path.glob("*/trip_date=2024-01-05")) and list(tmp_path.glob("day_sums/trip_date=2024-01-04"))


def observed(spark, data):
    return spark.createDataFrame(data, "list_id string, item_id string, source_id string, source_name string")


def test_coverage_of_batches_is_that_of_all_rows(spark, tmp_path):
    first = [("l1", f"i{k}", "s", "A") for k in range(40)] + [("l1", None, "s", "A"), (None, "i1", "s", "A"), ("l1", "i1", "s", None)]
    second = [("l1", f"i{k}", "s", "A") for k in range(30, 60)] + [("l2", "i1", "s", "B"), ("l1", None, "s", "A")]
    candidates = spark.createDataFrame([(a, f"i{k}") for a in ("l1", "l2", "l3") for k in range(50)] + [("l1", None)], "list_id string, item_id string")
    folder = str(tmp_path)
    for name, data in (("one", second[:5]), ("one", first), ("two", second), ("none", []), ("two", second)):
        coverage.add_batch(observed(spark, data), folder, name)
    got = coverage.batch_coverage(spark, candidates, folder)
    want = coverage.list_coverage(candidates, observed(spark, first + second))
    assert rounded(got) == rounded(want) and got.count() == 3
    numbers = [r["number"] for r in spark.read.parquet(f"{folder}/items").collect()]
    assert sorted(numbers) == list(range(1, 61))


def test_arrow_matcher(spark):
    import pyarrow.compute as pc

    data = [("ab", "AB"), ("ab", "ac"), (None, "x"), ("x", None), (" ", "nan"), ("same", "same")]
    frame = spark.createDataFrame(data, "original_a string, enrichment_a string")
    got = compare_fields(frame, ["a"], arrow_matcher(lambda x, y: pc.equal(pc.utf8_lower(x), pc.utf8_lower(y))))
    assert [r["a_match"] for r in got.collect()] == ["match", "mismatch", "original_blank", "enrichment_blank", "both_blank", "match"]
    with pytest.raises(Exception, match="one boolean"):
        compare_fields(frame, ["a"], arrow_matcher(lambda x, y: pc.utf8_length(x))).collect()


@pytest.mark.parametrize("wide", (False, True))
def test_keep_first_of_wide_rows(spark, tmp_path, wide):
    data = [(k % 7 if k % 5 else None, (k * 31) % 17 if k % 4 else None, f"v{k}") for k in range(200)]
    frame = spark.createDataFrame(data, "k int, ord int, v string")
    order = [(o is not None, o) for _, o, _ in data]
    want = {k: min(order[i] for i, r in enumerate(data) if r[0] == k) for k in {r[0] for r in data}}
    frame.repartition(3).write.parquet(str(tmp_path / "t"))
    for source in (frame, spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "t")).where("v <> ''")):
        got = keyed.keep_first(source, "k", "ord", wide=wide).collect()
        assert {r["k"]: (r["ord"] is not None, r["ord"]) for r in got} == want and len(got) == len(want)
        last = keyed.keep_last(source, ["k"], ["ord", "v"], wide=wide).collect()
        best = {k: max(((o is not None, o), v) for kk, o, v in data if kk == k) for k in want}
        assert {r["k"]: ((r["ord"] is not None, r["ord"]), r["v"]) for r in last} == best


def test_rows_certainly_alone_are_left_out(spark):
    data = [(i, f"k{i}", None) for i in range(50)] + [(100, "a", None), (101, "a", None), (102, None, None), (103, None, None)]
    frame = spark.createDataFrame(data, "id int, x string, y string")
    maybe = keyed.maybe_repeated(frame, [F.col("x"), F.col("y")])
    assert rows(maybe, "id") == [(100,), (101,), (102,), (103,)]
    assert keyed.maybe_repeated(frame.limit(0), [F.col("x")]).count() == 0


def test_saved_lineage_tables(spark, tmp_path):
    research, matching, imports = (view(spark, SF, f"v_{n}") for n in ("research", "matching", "imports"))
    saved = lineage.save_lineage_inputs(research, matching, "tests_lineage", str(tmp_path), 3)
    got = lineage.lineage_from_tables(saved["lines"], saved["pairs"], imports)
    want = lineage.build_lineage(research, matching, imports)
    assert rows(got.select(*sorted(got.columns))) == rows(want.select(*sorted(want.columns)))
    pairs = lineage.collapse_candidates(matching)
    assert rows(lineage.stage_summary(research, pairs, imports)) == rows(lineage.coverage_summary(want, pairs))


def test_summary_counts_incomplete_lines_as_a_pair_of_their_own(spark):
    names = lineage.RESEARCH_COLUMNS
    line = dict.fromkeys(names, "x")
    data = [{**line, "list_id": a, "material_reference": b, "research_returned": "yes"} for a, b in (("1", "m"), ("1", None), (None, None), (None, None), ("2", "n"))]
    research = spark.createDataFrame([tuple(d[c] for c in names) for d in data], ", ".join(f"{c} string" for c in names))
    matching = spark.createDataFrame([("1", "m", "true"), ("9", "q", "no"), (None, "z", "true")], "list_id string, material_reference string, is_matched string")
    imports = spark.createDataFrame([("m",), (None,)], "material_reference string")
    pairs = lineage.collapse_candidates(matching)
    whole = lineage.build_lineage(research, matching, imports, pairs)
    assert rows(lineage.stage_summary(research, pairs, imports)) == rows(lineage.coverage_summary(whole, pairs))
    empty = lineage.stage_summary(research.limit(0), pairs.limit(0), imports)
    assert rows(empty) == rows(lineage.coverage_summary(whole.limit(0), pairs.limit(0)))


def test_report_reads_exactly_one_prior_file(spark, tmp_path):
    (tmp_path / "ref").mkdir()
    (tmp_path / "ref" / "a.csv").write_text("Abbreviation,Name,LegalName\nA,Alpha,Alpha GmbH\n")
    (tmp_path / "prev").mkdir()
    spec = {"supplier_ref": {"dir": "ref", "formats": ["csv"]}, "prev": {"dir": "prev", "formats": ["parquet", "csv"]}}
    with pytest.raises(ValueError, match="found 0"):
        priority.report_from_folders(spark, str(tmp_path), spec)
    (tmp_path / "prev" / "one.csv").write_text("Abbreviation,Matching Rate\nA,0.25\n")
    kpis = priority.report_from_folders(spark, str(tmp_path), spec)["kpis"]
    assert [(r["abbr"], r["last_month_mr"]) for r in kpis.collect()] == [("A", 0.25)]
    (tmp_path / "prev" / "two.csv").write_text("Abbreviation,Matching Rate\nA,0.75\n")
    with pytest.raises(ValueError, match="found 2"):
        priority.report_from_folders(spark, str(tmp_path), spec)
    del spec["prev"]
    assert [r["last_month_mr"] for r in priority.report_from_folders(spark, str(tmp_path), spec)["kpis"].collect()] == [None]


def test_mapping_of_one_object_a_line(spark, tmp_path):
    lines = ['{"a": "A"}', '{"b": "B", "c": ""}', "{}", '{"d": null, "e": 5}']
    (tmp_path / "m.json").write_text("\n".join(lines) + "\n")
    found = folders.read_mapping(spark, str(tmp_path / "m.json"), records=True)
    assert rows(found.where("name_key IS NOT NULL")) == [("a", "A"), ("b", "B"), ("c", ""), ("d", None), ("e", "5")]
