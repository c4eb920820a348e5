"""Every job against its SQL, with broadcasts and with shuffled, split joins."""

import duckdb
import pytest

from checks.compare import difference
from checks.jobs import QUERIES
from checks.oracles import ORACLES
from checks.views import TABLES

SF = "/root/testdata/sf0.001"
LOOKUPS = (
    "supplier_dim_excluded",
    "unmatched_by_entity",
    "matched_by_entity",
    "products_max",
    "latest_dataset",
    "name_standardised",
    "fk_enriched",
    "parent_rollup",
    "duplicate_groups",
    "observed_annotated",
    "catalog_cleaned",
    "lineage_rows",
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_oracle_has_a_job():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    assert difference(QUERIES[name](spark, SF), duck.execute(ORACLES[name])) == ""


@pytest.mark.parametrize("name", LOOKUPS)
def test_same_rows_when_everything_is_shuffled(shuffled, duck, name):
    assert difference(QUERIES[name](shuffled, SF), duck.execute(ORACLES[name])) == ""


@pytest.mark.parametrize("name", ("trips_zone", "source_share", "catalog_audit", "report_long"))
def test_results_do_not_depend_on_partitioning(spark, duck, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert difference(QUERIES[name](spark, SF), duck.execute(ORACLES[name])) == ""
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_entry_is_the_flagship(spark):
    import __spark_entry__ as driver

    result = driver.entry(spark)
    assert {"abbr", "matching_rate", "products_in_db"} <= set(result.columns)
    assert result.count() > 0
