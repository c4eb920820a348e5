from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from concord import session
from concord.operators import keyed
from concord.operators.joins import attach, attach_many
from tests.conftest import rows

FACTS = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 7}") for i in range(60)]
LOOKUP = [("hot", "H"), ("k1", "A"), ("k2", "B"), ("unused", "U")]


def frames(spark):
    return (
        spark.createDataFrame(FACTS, "id int, k string"),
        spark.createDataFrame(LOOKUP, "k string, v string"),
    )


def expected(how):
    names = dict(LOOKUP)
    if how == "left":
        return [(i, k, names.get(k)) for i, k in FACTS]
    if how == "inner":
        return [(i, k, names[k]) for i, k in FACTS if k in names]
    if how == "left_semi":
        return [(i, k) for i, k in FACTS if k in names]
    return [(i, k) for i, k in FACTS if k not in names]


@pytest.mark.parametrize("how", ("left", "inner", "left_semi", "left_anti"))
def test_attach_by_broadcast(spark, how):
    wanted = sorted(expected(how), key=lambda r: r[0])
    columns = ("id", "k", "v") if how in ("left", "inner") else ("id", "k")
    assert rows(attach(*frames(spark), "k", how), *columns) == wanted


@pytest.mark.parametrize("how", ("left", "inner", "left_semi", "left_anti"))
def test_attach_by_shuffle(shuffled, how):
    wanted = sorted(expected(how), key=lambda r: r[0])
    columns = ("id", "k", "v") if how in ("left", "inner") else ("id", "k")
    facts, lookup = frames(shuffled)
    assert rows(attach(facts, lookup.groupBy("k").agg(F.max("v").alias("v")), "k", how), *columns) == wanted


def test_attach_on_two_keys_with_missing_parts(shuffled):
    facts = shuffled.createDataFrame(
        [("a", 1)] * 8 + [("a", None)] * 8 + [(None, 1)] * 2 + [("b", 2)], "x string, y int"
    )
    lookup = shuffled.createDataFrame([("a", 1, "A"), ("b", 2, "B")], "x string, y int, v string")
    got = attach(facts, lookup, ["x", "y"]).groupBy("x", "y", "v").count()
    assert rows(got, "x", "y", "v", "count") == [
        (None, 1, None, 2),
        ("a", None, None, 8),
        ("a", 1, "A", 8),
        ("b", 2, "B", 1),
    ]


def test_both_sides_of_a_large_lookup_are_plain_shuffles(shuffled):
    """Adaptive execution splits frequent keys only where nothing but a sort is between join and shuffle."""
    facts, lookup = frames(shuffled)
    plan = attach(facts, lookup.groupBy("k").agg(F.max("v").alias("v")), "k")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Aggregate" not in plan and "Broadcast" not in plan


def test_attach_many_keeps_every_match(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    lookup = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z")], "k string, v string")
    assert rows(attach_many(facts, lookup, "k"), "id", "v") == [(1, "x"), (1, "y")]


@pytest.mark.parametrize("kind", ("bigint", "string", "struct<a:bigint,b:string>"))
@pytest.mark.parametrize("ranges", (1, 3, 7))
def test_ordinal_is_contiguous_in_order(spark, kind, ranges):
    keys = [(k * 37) % 1009 + 1000 for k in range(1, 60)]
    cell = {"bigint": "k", "string": "cast(k as string)"}.get(kind, "named_struct('a', k div 100, 'b', cast(k as string))")
    frame = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5)
    frame = frame.selectExpr("k", f"CASE WHEN k > 1020 THEN {cell} END AS place")
    numbered = keyed.source_ordinal(frame, "place", "n", partitions=ranges).collect()
    missing = sum(k <= 1020 for k in keys)
    assert missing and sorted(r["n"] for r in numbered) == list(range(1, len(keys) + 1))
    assert {r["n"] for r in numbered if r["place"] is None} == set(range(1, missing + 1))
    present = sorted((r["n"], r["k"]) for r in numbered if r["place"] is not None)
    assert [k for _, k in present] == sorted(k for k in keys if k > 1020)


def test_ordinal_of_repeated_and_no_rows(spark):
    same = spark.range(1000).selectExpr("CAST(NULL AS string) AS k", "id", "map('a', 1) AS m")
    assert rows(keyed.source_ordinal(same, "k", "n", 4), "n") == [(i,) for i in range(1, 1001)]
    assert keyed.source_ordinal(same.limit(0), "k", "n").count() == 0


def test_keep_first_and_last_treat_missing_keys_as_equal(spark):
    data = [(1, "a", "x"), (2, "a", None), (3, None, "p"), (4, None, "q")]
    frame = spark.createDataFrame(data, "ord int, k string, v string")
    assert rows(keyed.keep_first(frame, "k", "ord")) == [(1, "a", "x"), (3, None, "p")]
    assert rows(keyed.keep_last(frame, "k", "ord")) == [(2, "a", None), (4, None, "q")]


def test_first_present_takes_each_column_on_its_own(spark):
    data = [("s", 1, 10, "old", "o1"), ("s", 2, 20, None, "o2"), ("s", 3, 20, "late", "o3")]
    frame = spark.createDataFrame(data, "k string, ord int, age int, f string, o string")
    age = F.col("age")
    got = frame.groupBy("k").agg(
        keyed.first_present("f", age, "ord").alias("f"), keyed.first_present("o", age, "ord").alias("o")
    )
    assert rows(got, "f.value", "o.value") == [("late", "o2")]


def test_keep_none_removes_every_member(spark):
    data = [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)]
    frame = spark.createDataFrame(data, "v int, k string")
    assert rows(keyed.keep_none(frame, "k")) == [(3, "b")]


def test_repeated_rows_group_missing_values(spark):
    data = [(1, "a", None), (2, "a", None), (3, "a", ""), (4, None, None), (5, "b", "x")]
    frame = spark.createDataFrame(data, "id int, x string, y string")
    got = keyed.repeated_rows(frame, [F.col("x"), F.col("y")], "id")
    assert rows(got, "id") == [(1,), (2,)]


def test_share_of_nothing(spark):
    assert rows(keyed.share_of_total(spark.createDataFrame([], "n bigint"), "n")) == []
    zero = spark.createDataFrame([(0,)], "n bigint")
    assert rows(keyed.share_of_total(zero, "n")) == [(0, 0.0)]


def test_written_tables_have_an_owner(spark):
    session.drop_written(spark)
    kept = session.checkpointed(spark.range(5))
    folder = Path(urlparse(kept.inputFiles()[0]).path).parent
    assert kept.count() == 5 and folder.exists()
    assert session.drop_written(spark) == 1 and not folder.exists()
