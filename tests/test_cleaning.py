from concord.plans import cleaning
from concord.sources.sinks import write_tables
from tests.conftest import rows

COLUMNS = [
    "row_id",
    "proper_identification",
    "manufacturer_name",
    "manufacturer_article",
    "manufacturer_typecode",
    "supplier_name",
    "supplier_article",
    "supplier_url",
]
CATALOG = [
    (10, "yes", " Bolt  Works ", "B-7", "M", "", "", ""),
    (20, "YES", "bolt works", " b-7", "m ", "", "", ""),
    (30, " No ", "Lost", "L", "L", "", "", ""),
    (40, None, " null ", "keep me", "T", "Trader", "", "http://t.test"),
    (50, "yes", "a|b", "c", "", "", "", ""),
    (60, "yes", "a", "b|c", "", "", "", ""),
    (70, "yes", "", "", "", "", "", ""),
    (80, "yes", "nan", None, "", "", "", ""),
    (90, "yes", "Seller", "S", "S", "Shop", "", ""),
]


def clean(spark, mapping=(("bolt works", "Bolt Works Ltd"), ("seller", "Seller"), ("a", ""))):
    catalog = spark.createDataFrame(CATALOG, COLUMNS)
    return cleaning.clean_catalog(catalog, spark.createDataFrame(list(mapping), ["name_key", "mapped"]))


def test_rows_and_audit(spark):
    cleaned, audit = clean(spark)
    assert rows(cleaned, "source_row", "manufacturer_name", "manufacturer_article", "supplier_name") == [
        (1, "Bolt Works Ltd", "B-7", ""),
        (4, "Trader", "keep me", ""),
        (5, "a|b", "c", ""),
        (6, "a", "b|c", ""),
        (7, "", "", ""),
        (9, "Seller", "S", "Shop"),
    ]
    assert rows(audit, "stage_no", "row_number", "action") == [
        (1, 3, "drop_not_identified"),
        (2, 4, "transplant_supplier_to_manufacturer"),
        (3, 2, "drop_duplicate"),
        (3, 8, "drop_duplicate"),
        (4, 1, "map_manufacturer_name"),
    ]
    assert rows(audit.where("stage_no = 4"), "details") == [("mapped to Bolt Works Ltd",)]
    moved = cleaned.where("source_row = 4").first()
    assert (moved["manufacturer_url"], moved["supplier_url"], moved["manufacturer_typecode"]) == (
        "http://t.test",
        "",
        "T",
    )


def test_mapping_comes_after_the_duplicate_rule(spark):
    catalog = spark.createDataFrame([(1, "ACME"), (2, "Acme Inc")], ["row_id", "manufacturer_name"])
    mapping = spark.createDataFrame([("acme", "Acme Inc")], ["name_key", "mapped"])
    cleaned, _ = cleaning.clean_catalog(catalog, mapping)
    assert rows(cleaned, "manufacturer_name") == [("Acme Inc",), ("Acme Inc",)]
    assert set(cleaning.CATALOG_COLUMNS) <= set(cleaned.columns)


def test_same_result_when_written_first_or_numbered_by_the_caller(spark):
    catalog = spark.createDataFrame(CATALOG, COLUMNS)
    plain = cleaning.clean_catalog(catalog)
    for options in ({"materialize": True}, {"row_number": "n"}):
        numbered = catalog.withColumn("n", catalog["row_id"] / 10)
        got = cleaning.clean_catalog(numbered, **options)
        assert rows(got[0], *plain[0].columns) == rows(plain[0])
        assert rows(got[1]) == rows(plain[1])


def test_split_and_tables(spark, tmp_path):
    manufacturer, supplier = cleaning.split_by_role(clean(spark)[0])
    assert (manufacturer.count(), supplier.count()) == (5, 1)
    tables = cleaning.cleaning_tables(spark.createDataFrame(CATALOG, COLUMNS))
    assert [r["row_number"] for r in tables["audit_log"].collect()] == [3, 4, 2, 8]
    write_tables(tables, str(tmp_path))
    assert {p.name for p in tmp_path.iterdir()} == set(tables)


def test_a_hot_key_keeps_only_its_first_row(spark):
    catalog = spark.range(1, 2001).selectExpr("id AS row_id", "IF(id % 3 = 0, 'hot', concat('n', id)) AS manufacturer_name")
    cleaned, audit = cleaning.clean_catalog(catalog)
    assert cleaned.where("manufacturer_name = 'hot'").first()["row_id"] == 3
    assert cleaned.count() == 2000 - 666 + 1
    assert audit.count() == 665
