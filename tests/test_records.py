"""Quote states of lines against a plain reader of characters, and files split anywhere."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from concord.sources import folders, records
from tests.conftest import rows


@pytest.fixture
def split(spark):
    """Files are split into blocks of a kilobyte."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def ends_inside(text, inside):
    """Whether a line ends inside a quoted cell, one character at a time."""
    state, i = "quoted" if inside else "start", 0
    while i < len(text):
        c = text[i]
        if state == "quoted":
            if c == '"':
                if text[i + 1 : i + 2] == '"':
                    i += 1
                else:
                    state = "cell"
        elif c == ",":
            state = "start"
        elif state == "start" and c == '"':
            state = "quoted"
        else:
            state = "cell"
        i += 1
    return state == "quoted"


def test_lines_say_what_they_do_to_either_state(spark, tmp_path):
    rng = random.Random(4)
    lines = ["".join(rng.choices('",a ', weights=[4, 3, 3, 1], k=rng.randint(0, 12))) for _ in range(600)]
    lines += ['"' * 9001, '"",' * 3000, "x" * 9000 + '"', '5" pipe,x', '"ab"cd,e', '""', '"', '","']
    (tmp_path / "a.csv").write_text("\n".join(lines))
    got = records.read_lines(spark, str(tmp_path)).orderBy("file", "block", "line").collect()
    assert [r.value for r in got] == lines
    assert [(r.opens, r.stays) for r in got] == [(ends_inside(x, False), ends_inside(x, True)) for x in lines]


def table(rng, n):
    def cell():
        kind = rng.random()
        if kind < 0.15:
            return rng.choice(["two\nlines", 'a "b"\n\nc, d', "\n", 'x,"\ny', "é\n" * rng.randint(1, 900)])
        return "".join(rng.choices('ab ,"é', weights=[5, 5, 1, 1, 1, 1], k=rng.randint(1, 9)))

    return [[f"{k}", cell(), cell()] for k in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_records_of_split_files(split, tmp_path, seed):
    rng, want = random.Random(seed), []
    for name in ("a", "b b", "c"):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n")
        body = table(rng, 150)
        writer.writerows([["No", "First", "Second"], *body])
        (tmp_path / f"{name}.csv").write_text(out.getvalue(), encoding="utf-8" if name != "c" else "latin-1")
        want += [(*r, f"{name}.csv") for r in body]
    found = folders.read_csv_folder(split, str(tmp_path), file_column="file", position="ord")
    got = [tuple(r)[:4] for r in found.orderBy("ord").collect()]
    assert got == sorted(want, key=lambda r: r[3].replace(" ", "%20"))


def test_a_stray_quote_and_a_cell_over_lines_leave_files_splittable(split, tmp_path):
    lines = ["id,text", *[f"{i},word {i} " + "x" * 200 for i in range(40)]]
    lines[9] = '8,5" pipe'
    (tmp_path / "stray.csv").write_text("\n".join(lines) + "\n")
    lines[9], lines[20] = "8,plain", '19,"over\nthree ""lines""\nof text"'
    (tmp_path / "torn.csv").write_text("\n".join(lines) + "\n")
    found = folders.read_csv_folder(split, str(tmp_path), file_column="file")
    values = {(r.file, r.id): r.text for r in found.collect()}
    assert len(values) == 80 and values["stray.csv", "8"] == '5" pipe'
    assert values["torn.csv", "19"] == 'over\nthree "lines"\nof text' and values["torn.csv", "39"].startswith("word 39 xxx")
    scan = records.read_lines(split, str(tmp_path))
    assert scan.groupBy("file").agg(F.count_distinct("block").alias("n")).where("n > 5").count() == 2
    files = records.files_of(scan)
    assert rows(files.select(F.substring_index("file", "/", -1).alias("f"), "torn")) == [("stray.csv", False), ("torn.csv", True)]


def test_header_over_two_lines_and_a_byte_order_mark(split, tmp_path):
    (tmp_path / "a.csv").write_text('\n"Item\nName","Count"\n"x",1\n')
    (tmp_path / "b.csv").write_text('﻿"Item Name",Count\ny,2\n', encoding="utf-8")
    assert rows(folders.read_csv_folder(split, str(tmp_path)), "item name", "count") == [("x", "1"), ("y", "2")]


def test_a_cell_that_is_never_closed_is_an_error(split, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n" * 400 + '3,"open\n' + "4,5\n" * 400)
    with pytest.raises(ValueError, match="a.csv: a quoted cell is never closed"):
        folders.read_csv_folder(split, str(tmp_path))


def test_blank_lines_inside_and_outside_of_cells(split, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n\n1,"\n\n"\n   \n"",2\n\n')
    assert rows(folders.read_csv_folder(split, str(tmp_path)), "a", "b") == [(None, "2"), ("1", "\n\n")]
    (tmp_path / "a.csv").write_text("\n \n")
    assert folders.read_csv_folder(split, str(tmp_path)).columns == []


def test_many_files_of_many_header_styles(spark, tmp_path):
    want = []
    for i in range(2000):
        style = i % 40
        names = ["List ID", f"Column {style}", "Value"][:: -1 if style % 2 else 1]
        cells = {"List ID": str(i), f"Column {style}": f"c{i}", "Value": f"v{i}"}
        (tmp_path / f"f{i:04}.csv").write_text(",".join(names) + "\n" + ",".join(cells[n] for n in names) + "\n")
        want.append((str(i), f"c{i}", f"v{i}"))
    found = folders.load_batches(spark, str(tmp_path), ["list_id", "value"])
    others = [f"column_{s}" for s in range(40)]
    assert set(found.columns) == {"list_id", "value", "batch_name", *others}
    assert sorted(found.select("list_id", F.coalesce(*others), "value").collect()) == sorted(want)
    assert "Union" not in found._jdf.queryExecution().optimizedPlan().toString()
