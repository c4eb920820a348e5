import json

import pytest
from pyspark.sql import functions as F

from concord.sources import folders, headers, sinks
from tests.conftest import rows


def put(folder, name, text, encoding="utf-8"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode(encoding))
    return str(folder / name)


def test_header_rules():
    assert headers.snake_header(" Source ID ") == "source_id"
    assert headers.snake_header("--Item-ID (new)") == "item_id_new"
    assert headers.arrow_header(" Clients  →  Name ") == "clients -> name"
    assert headers.arrow_header("A — b’s â†’ C") == "a - b's -> c"
    assert headers.arrow_header(None) == ""


def test_headers_that_become_equal_are_refused(spark):
    with pytest.raises(ValueError, match="item_id"):
        headers.normalize_headers(spark.createDataFrame([(1, 2)], ["Item ID", "item-id"]))


def test_resolution_follows_table_order():
    columns = ["total name", "display name", "name"]
    assert headers.resolve_column(columns, ["name"]) == "name"
    assert headers.resolve_column(columns[:2], ["display", "total"]) == "total name"
    assert headers.resolve_column(["b", "a"], ["a", "b"]) == "b"
    assert headers.resolve_column(columns, ["price"]) is None


def test_required_and_optional_columns(spark):
    frame = spark.createDataFrame([("x",)], ["a"])
    with pytest.raises(ValueError, match=r"input: no column .b., .c. among \[.a.\]"):
        headers.require_columns(frame.columns, ["a", "b", "c"], "input")
    assert rows(headers.fill_optional(frame, ["a", "b"]), "a", "b") == [("x", "")]
    with pytest.raises(ValueError, match="rate"):
        headers.select_roles(frame, {"name": ["a"], "rate": ["percent"]}, "prior")
    picked = headers.select_roles(frame, {"name": ["a"], "rate": ["percent"]}, "prior", optional=["rate"])
    assert picked.columns == ["name"]


def test_wide_rows_are_refused_and_leading_blank_lines_skipped(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "\n\nA,B\n1,2\n3\n")
    found = folders.read_csv_folder(spark, str(tmp_path / "in"))
    assert rows(found, "a", "b") == [("1", "2"), ("3", None)]
    put(tmp_path / "wide", "a.csv", "A,B\n1,2,3\n")
    with pytest.raises(Exception, match="more cells than columns"):
        folders.read_csv_folder(spark, str(tmp_path / "wide")).collect()


@pytest.mark.parametrize("kind", ("parquet", "json", "csv"))
def test_every_format_has_a_position_and_text(spark, tmp_path, kind):
    frame = spark.createDataFrame([(1, "x"), (2, "NA")], "Count int, Name string").coalesce(1)
    frame.write.format(kind).options(**({"header": True} if kind == "csv" else {})).save(str(tmp_path / "in"))
    found = folders.read_folder(spark, str(tmp_path / "in"), ["parquet", "json", "csv"], position="ord", null_tokens=["NA"])
    assert dict(found.dtypes)["count"] == "string"
    assert [(r["count"], r["name"]) for r in found.orderBy("ord").collect()] == [("1", "x"), ("2", None)]


def test_folder_with_mixed_headers_encodings_and_lines(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.csv", "Name,Count\nMüller,1\n\"two, parts\",\n")
    put(folder, "b b.csv", "Count,Name,Extra\n2,Müller,NA\n", "latin-1")
    put(folder, "c.csv", 'Name,Count\n"line one\nline ""two""",3\n')
    put(folder, "ignored.txt", "Name\nnobody\n")
    found = folders.read_csv_folder(spark, str(folder), file_column="file", position="ord")
    assert rows(found, "name", "count", "extra", "file") == [
        ("Müller", "1", None, "a.csv"),
        ("Müller", "2", "NA", "b b.csv"),
        ('line one\nline "two"', "3", None, "c.csv"),
        ("two, parts", None, None, "a.csv"),
    ]
    ordered = [r["name"] for r in found.orderBy("ord").collect()]
    assert ordered[:2] == ["Müller", "two, parts"]
    tokens = folders.read_csv_folder(spark, str(folder), null_tokens=folders.PANDAS_NULLS)
    assert rows(tokens.where("extra IS NOT NULL")) == []


def test_missing_folder_and_empty_file(spark, tmp_path):
    assert folders.read_csv_folder(spark, str(tmp_path / "none")).columns == []
    put(tmp_path / "e", "empty.csv", "")
    assert folders.read_csv_folder(spark, str(tmp_path / "e")).columns == []
    put(tmp_path / "e", "header.csv", "A,B\n")
    only_header = folders.read_csv_folder(spark, str(tmp_path / "e"))
    assert only_header.columns == ["a", "b"] and only_header.isEmpty()


def test_first_format_wins(spark, tmp_path):
    put(tmp_path / "d", "x.csv", "A\n1\n")
    put(tmp_path / "d", "y.json", '{"A": "2"}\n')
    assert rows(folders.read_folder(spark, str(tmp_path / "d"), ["json", "csv"])) == [("2",)]
    assert rows(folders.read_folder(spark, str(tmp_path / "d"), ["parquet", "csv"])) == [("1",)]
    assert folders.read_folder(spark, str(tmp_path / "d"), ["parquet"]).columns == []
    put(tmp_path / "d", "z.xlsx", "workbook")
    with pytest.raises(ValueError, match="unsupported"):
        folders.read_folder(spark, str(tmp_path / "d"), ["xlsx", "csv"])
    config = {"one": {"dir": "d", "formats": ["csv"]}, "two": {"dir": "none", "formats": ["csv"]}}
    inputs = folders.load_inputs(spark, str(tmp_path), config)
    assert inputs["one"].count() == 1 and inputs["two"].columns == []


def test_batches(spark, tmp_path):
    required = ("list_id", "item_id", "source_id")
    with pytest.raises(FileNotFoundError):
        folders.load_batches(spark, str(tmp_path / "none"), required)
    put(tmp_path / "b", "one.csv", "List ID,Item-ID,Source id\n l1 ,i1,s1\nl1,NA,\n")
    put(tmp_path / "b", "two.csv", "source_id,list_id,item_id,note\ns2,l2,i2,x\n")
    got = folders.load_batches(spark, str(tmp_path / "b"), required)
    assert rows(got, *required, "note", "batch_name") == [
        ("l1", "", "", None, "one.csv"),
        ("l1", "i1", "s1", None, "one.csv"),
        ("l2", "i2", "s2", "x", "two.csv"),
    ]
    put(tmp_path / "b", "three.csv", "list_id,item_id\nl,i\n")
    with pytest.raises(ValueError, match="three.csv: no column .source_id."):
        folders.load_batches(spark, str(tmp_path / "b"), required)


def test_prior_report_needs_exactly_one_file(spark, tmp_path):
    with pytest.raises(ValueError, match="found 0"):
        folders.read_prior_report(spark, str(tmp_path / "none"))
    put(tmp_path / "p", "one.csv", "Abbreviation,Matching Rate\nM1,0.5\n")
    assert folders.read_prior_report(spark, str(tmp_path / "p")).count() == 1
    put(tmp_path / "p", "two.csv", "Abbreviation,Matching Rate\nM1,0.5\n")
    with pytest.raises(ValueError, match="found 2"):
        folders.read_prior_report(spark, str(tmp_path / "p"))


def test_mapping_preview_and_single_table(spark, tmp_path):
    path = put(tmp_path, "map.json", json.dumps({"acme": "Acme Corp", "x": ""}, indent=1))
    assert rows(folders.read_mapping(spark, path)) == [("acme", "Acme Corp"), ("x", "")]
    table = put(tmp_path, "t.csv", "Id,When\n1,2024-01-01\n2,NA\n")
    assert rows(folders.read_table(spark, table)) == [("1", "2024-01-01"), ("2", None)]
    seen = folders.preview_csv(spark, put(tmp_path, "u.csv", "id,word\n1,a\n2,b\n"))
    assert rows(seen) == [(0, "id", "int", 2), (1, "word", "string", 2)]
    assert rows(folders.sample_rows(spark.range(9), "id", 4)) == [(i,) for i in range(4)]


def test_sinks(spark, tmp_path):
    frame = spark.createDataFrame([("2024-01-01", 'a "b", c'), ("2024-01-02", "d\ne")], "day string, text string")
    sinks.write_tables({"t": frame}, str(tmp_path / "csv"))
    back = folders.read_csv_folder(spark, str(tmp_path / "csv" / "t"))
    assert rows(back) == rows(frame)
    sinks.write_parquet(frame, str(tmp_path / "pq"), "day")
    assert {p.name for p in (tmp_path / "pq").glob("day=*")} == {"day=2024-01-01", "day=2024-01-02"}
    sinks.save_table(frame, "kept_table", str(tmp_path / "table"))
    sinks.save_table(frame, "kept_table", str(tmp_path / "table"))
    assert spark.table("kept_table").count() == 2
    assert sinks.write_if_any(frame, str(tmp_path / "diag"))
    assert not sinks.write_if_any(frame.where(F.lit(False)), str(tmp_path / "no_diag"))
    assert not (tmp_path / "no_diag").exists()
    report = spark.createDataFrame([("M1", 0.12345)], ["Abbreviation", "Matching Rate"])
    assert rows(sinks.with_percent(report)) == [("M1", "12.35%")]
    sinks.write_report(report, str(tmp_path / "report"))
    assert rows(folders.read_csv_folder(spark, str(tmp_path / "report"))) == [("M1", "12.35%")]


def test_compressed_json(spark, tmp_path):
    data = spark.createDataFrame([("1", None), ("2", "b")], "a string, b string")
    data.write.json(str(tmp_path / "in"), compression="gzip", ignoreNullFields=False)
    assert rows(folders.read_folder(spark, str(tmp_path / "in"), ["csv", "json"])) == [("1", None), ("2", "b")]
