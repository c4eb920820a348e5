"""Text functions: what each cell becomes, and what must hold for any text."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from concord.functions import text

FUNCTIONS = ("repair_text", "canonical_key", "normalize_text", "comparison_key", "normalize_identifier")
# Each cell, and what the five functions make of it.
CELLS = [
    (None, None, "", "", "", None),
    ("", "", "", "", "", None),
    ("   ", "", "", "", "", None),
    (" Acme  Co ", "Acme Co", "acme co", "Acme  Co", "acme co", "Acme  Co"),
    ("ACME\tCo\n", "ACME Co", "acme co", "ACME\tCo", "acme co", "ACME\tCo"),
    ("\u3000wide\u2003gap\xa0", "wide gap", "wide gap", "wide\u2003gap", "wide gap", "wide\u2003gap"),
    ("\x1cfile\x1f", "file", "file", "file", "file", "file"),
    ("M\u00c3\u00bcller GmbH", "Müller GmbH", "müller gmbh", "M\u00c3\u00bcller GmbH", "m\u00e3\u00bcller gmbh", "M\u00c3\u00bcller GmbH"),
    ("Müller", "Müller", "müller", "Müller", "müller", "Müller"),
    ("\u00c3", "\u00c3", "\u00e3", "\u00c3", "\u00e3", "\u00c3"),
    ("Straße", "Straße", "straße", "Straße", "strasse", "Straße"),
    ("\ufb01ne \uff21\uff22", "fine AB", "fine ab", "\ufb01ne \uff21\uff22", "fine \uff41\uff42", "\ufb01ne \uff21\uff22"),
    ("\u2460\u00b2", "12", "12", "\u2460\u00b2", "\u2460\u00b2", "\u2460\u00b2"),
    ("e\u0301clair", "éclair", "éclair", "e\u0301clair", "e\u0301clair", "e\u0301clair"),
    ("smile 😀", "smile 😀", "smile 😀", "smile 😀", "smile 😀", "smile 😀"),
    ("nan", "nan", "nan", "", "", None),
    (" None ", "None", "none", "", "", None),
    ("NULL", "NULL", "null", "", "", None),
    ("NaT", "NaT", "nat", "NaT", "nat", None),
    ("nationality", "nationality", "nationality", "nationality", "nationality", "nationality"),
    ("7.0", "7.0", "7.0", "7.0", "7.0", "7"),
    ("007.0", "007.0", "007.0", "007.0", "007.0", "007"),
    (" -12.0", "-12.0", "-12.0", "-12.0", "-12.0", "-12"),
    ("1.00", "1.00", "1.00", "1.00", "1.00", "1.00"),
    ("12.5", "12.5", "12.5", "12.5", "12.5", "12.5"),
    ("x.0", "x.0", "x.0", "x.0", "x.0", "x.0"),
]
NAMES = ["Müller & Söhne", "François Frères", "Ñandú, S.A.", "Łódź", "Straße 5", "Ωmega", "plain", "한국 산업", "a\u0301b"]


def evaluate(spark, function, cells):
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    result = frame.select("i", function(F.col("c")).alias("out")).collect()
    return [r["out"] for r in sorted(result, key=lambda r: r["i"])]


@pytest.mark.parametrize("place", range(len(FUNCTIONS)), ids=FUNCTIONS)
def test_cells(spark, place):
    got = evaluate(spark, getattr(text, FUNCTIONS[place]), [c[0] for c in CELLS])
    assert got == [c[place + 1] for c in CELLS]


def test_misread_names_come_back(spark):
    names = [n for n in NAMES if not any(c in n.encode("utf-8") for c in b"\x85\xa0")]  # read as white space
    assert len(names) >= 7
    misread = [n.encode("utf-8").decode("latin-1") for n in names]
    wanted = [unicodedata.normalize("NFKC", n) for n in names]
    assert evaluate(spark, text.repair_text, [f"  {m} " for m in misread]) == wanted


def test_spellings_share_a_key(spark):
    keys = [evaluate(spark, text.canonical_key, [f(n) for n in NAMES]) for f in (str, str.upper, lambda n: f"\t {n.replace(' ', chr(0x2003) * 2)} ")]
    spelled = [[k.replace("ß", "ss") for k in ks] for ks in keys]
    assert spelled[0] == spelled[1] == spelled[2]


def test_nfkc_and_casefold(spark):
    some = [c[0] for c in CELLS if c[0] is not None] + NAMES + ["İstanbul", "ΌΔΟΣ", "a\u00b4b", "\u1112\u1161\u11ab"]
    assert evaluate(spark, text.nfkc, some) == [unicodedata.normalize("NFKC", c) for c in some]
    assert evaluate(spark, text.casefold, some) == [c.casefold() for c in some]


def test_bool_and_flags(spark):
    cells = ["TRUE", " 1 ", "yes", "Y", "no", "", None, "truth"]
    assert evaluate(spark, text.normalize_bool, cells) == [True] * 4 + [False] * 4
    assert evaluate(spark, text.is_flagged, [" Y ", "y", "yes", None]) == [True, True, False, False]
    assert evaluate(spark, text.is_blank, [None, " 　", "a"]) == [True, True, False]


def test_loose_key(spark):
    assert evaluate(spark, text.loose_key, ["A-1, x", "a 1  X!", None]) == ["a 1 x", "a 1 x", ""]


def test_repair_of_whole_documents_is_settled(spark):
    """Repairing the given documents, long ones included, leaves nothing to repair, and keys ignore it."""
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    once = documents.select("text", text.repair_text(F.col("text")).alias("once"), text.canonical_key(F.col("text")).alias("key"))
    again = once.select("*", text.repair_text(F.col("once")).alias("again"), text.canonical_key(F.col("once")).alias("key_of_once"))
    for row in again.collect():
        assert row["once"] == row["again"] and row["key"] == row["key_of_once"]
        assert row["once"].split() == unicodedata.normalize("NFKC", row["text"]).split()
        assert "  " not in row["once"] and row["key"] == row["once"].lower()
