import pytest

from concord.functions.text import canonical_key
from concord.plans import quality
from tests.conftest import rows

MASTER = [
    (1, "Acme", "ACME Tools", None, "north"),
    (2, "Bolt", "Acme", 1, "south"),
    (3, "Cog", None, 99, "south"),
]


def master(spark):
    return spark.createDataFrame(
        MASTER,
        "manufacturer_id int, canonical_manufacturer_name string, display_name string,"
        " parent_manufacturer_id int, region string",
    )


def catalog(spark):
    return spark.createDataFrame(
        [(1, "Acme", 1, "Bolt"), (2, "acme  tools", 2, "Acme"), (3, "Bolt", 7, "Bolt"), (4, None, None, "Cog")],
        "row_id int, manufacturer_name string, manufacturer_id int, manufacturer_name_canonical string",
    )


def test_last_name_wins(spark):
    assert rows(quality.name_lookup(master(spark))) == [
        ("ACME Tools", "Acme"),
        ("Acme", "Bolt"),
        ("Bolt", "Bolt"),
        ("Cog", "Cog"),
    ]


def test_rates_as_written_and_over_all_rows(spark):
    exact = quality.standardize_and_enrich(catalog(spark), master(spark))
    assert rows(exact["standardized"], "row_id", "manufacturer_name_std") == [
        (1, "Bolt"),
        (2, None),
        (3, "Bolt"),
        (4, None),
    ]
    assert exact["enriched"].count() == 2
    assert rows(exact["rates"]) == [(4, 2, 0.5, 1.0, 0.5, 0.5)]
    assert rows(exact["rates_by_key"], "standardized_rate", "accuracy") == [(0.75, 0.75)]
    lookup = quality.name_lookup(master(spark), key=canonical_key)
    assert ("acme tools", "Acme") in rows(lookup)


def chain(spark, pairs):
    return spark.createDataFrame(pairs, "manufacturer_id int, parent_manufacturer_id int")


def test_rollup_of_chains_orphans_and_cycles(spark):
    pairs = [(1, None), (2, 1), (3, 2), (4, 4), (5, 77), (6, 5), (7, 8), (8, 9), (9, 7), (10, 9)]
    assert rows(quality.parent_rollup(chain(spark, pairs))) == [
        (1, 1, 0, "root"),
        (2, 1, 1, "rolled_up"),
        (3, 1, 2, "rolled_up"),
        (4, 4, 0, "root"),
        (5, 77, 1, "orphan_parent"),
        (6, 77, 2, "orphan_parent"),
        (7, None, None, "cycle"),
        (8, None, None, "cycle"),
        (9, None, None, "cycle"),
        (10, None, None, "cycle"),
    ]


@pytest.mark.parametrize("length", (1, 2, 3, 17, 40))
def test_rollup_of_a_long_chain(spark, length):
    pairs = [(i, i - 1 if i else None) for i in range(length)]
    got = quality.parent_rollup(chain(spark, pairs))
    assert rows(got, "manufacturer_id", "top_parent_id", "depth") == [(i, 0, i) for i in range(length)]


def test_rollup_with_a_hot_parent(shuffled):
    pairs = [(0, None)] + [(i, 0) for i in range(1, 30)] + [(100 + i, 1) for i in range(30)]
    got = quality.parent_rollup(chain(shuffled, pairs))
    assert got.where("top_parent_id = 0").count() == 60


def test_duplicate_rules(spark):
    frame = spark.createDataFrame(
        [(1, "a", "x"), (1, "a", "x"), (2, "a", "x"), (3, "b", "y"), (4, "c", None), (5, "c", None)],
        "id int, k string, v string",
    )
    assert rows(quality.remove_duplicates(frame, ["k", "v"])) == [(3, "b", "y")]
    unique = frame.distinct()
    assert rows(quality.near_duplicates(unique, ["k", "v"], "id"), "id") == [(1,), (2,), (4,), (5,)]
    digested = quality.near_duplicates(unique, ["k", "v"], "id", digest=True)
    assert rows(digested, "id") == [(1,), (2,), (4,), (5,)]
    assert rows(quality.duplicate_counts(unique, ["k", "v"], ["k", "v"])) == [(5, 1, 4, 4)]
    assert rows(quality.duplicate_counts(frame, ["k", "v"], ["k"])) == [(6, 1, 5, 5)]
    assert rows(quality.duplicate_counts(frame.limit(0), ["k"], ["k"])) == [(0, 0, 0, 0)]


@pytest.mark.parametrize("session", ("spark", "shuffled"))
def test_duplicate_groups_tell_why(request, session):
    spark = request.getfixturevalue(session)
    frame = spark.createDataFrame(
        [(1, "Bolt-1", None), (2, "bolt 1", None), (3, "Bolt-1", None), (4, "Bolt-2", None)],
        "id int, name string, note string",
    )
    got = rows(quality.duplicate_groups(frame, ["name", "note"], "id"))
    assert got == [
        (1, 1, 3, "keep", "first row of the group"),
        (2, 1, 3, "drop", "same text after normalisation"),
        (3, 1, 3, "drop", "same text as the kept row"),
    ]
