"""Text repair and comparison keys, all evaluated in the JVM.

Spark has no built-in for Unicode NFKC or full case folding. Both come from the ICU
library on Spark's own class path through the SQL function ``reflect``, so no row
is sent to a Python worker; plain ASCII text skips the call altogether, and a call that fails raises.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters Python's str.split() and str.isspace() treat as white space.
ASCII_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
UNICODE_SPACE = (
    "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Words that stand for a missing value.
BLANK_TEXT = ("nan", "none", "null")
BLANK_IDENTIFIER = ("nan", "none", "null", "nat")
TRUE_WORDS = ("true", "1", "yes", "y")

_ASCII_RUN = "[" + ASCII_SPACE + "]+"
_UNICODE_RUN = "[" + ASCII_SPACE + UNICODE_SPACE + "]+"
_BEYOND_LATIN1 = r"[^\x00-\xff]"


def is_ascii(col: Column) -> Column:
    """True when every character takes one byte."""
    return F.octet_length(col) == F.char_length(col)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate a costly value once and use it several times in the body."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def collapse(col: Column) -> Column:
    """Every run of white space as one blank; the short ASCII class is searched much faster."""
    return F.when(is_ascii(col), F.regexp_replace(col, _ASCII_RUN, " ")).otherwise(
        F.regexp_replace(col, _UNICODE_RUN, " ")
    )


def squeeze(col: Column) -> Column:
    """Trim and collapse every run of white space to one blank."""
    return F.trim(collapse(col))


def strip(col: Column) -> Column:
    """Trim Unicode white space at both ends."""
    everything = F.btrim(col, F.lit(ASCII_SPACE + UNICODE_SPACE))
    return F.when(is_ascii(col), F.btrim(col, F.lit(ASCII_SPACE))).otherwise(everything)


def _called(owner: str, method: str, text: Column) -> Column:
    return F.when(text.isNotNull(), F.reflect(F.lit(owner), F.lit(method), text, F.lit(True)))


def _compose(text: Column) -> Column:
    return _called("com.ibm.icu.text.Normalizer", "compose", text)


def _fold(text: Column) -> Column:
    return _called("com.ibm.icu.lang.UCharacter", "foldCase", text)


def nfkc(col: Column) -> Column:
    """Unicode NFKC of a plain column."""
    return F.when(is_ascii(col), col).otherwise(_compose(col))


def casefold(col: Column) -> Column:
    """Full Unicode case folding of a plain column."""
    return F.when(is_ascii(col), F.lower(col)).otherwise(_fold(col))


def _reread(text: Column) -> Column:
    """Latin-1 characters read again as UTF-8, where that gives clean text."""
    reread = F.try_validate_utf8(F.encode(text, "ISO-8859-1").cast("string"))
    clean = let(
        F.when(~text.rlike(_BEYOND_LATIN1), reread),
        lambda new: F.when(~new.contains("\u00c3") & ~new.contains("\ufffd"), new),
    )
    return F.coalesce(clean, text)


def repair_text(col: Column) -> Column:
    """Collapse blanks, undo UTF-8 that was read as Latin-1, then apply NFKC.

    The re-read text is taken only when the bytes are valid UTF-8 and the outcome holds
    neither the tell-tale letter nor a replacement character. ASCII text needs neither step.
    """
    return let(squeeze(col), _repaired)


def _repaired(text: Column) -> Column:
    return F.when(is_ascii(text), text).otherwise(let(_reread(text), _compose))


def canonical_key(col: Column) -> Column:
    """Join key of a name. A missing name gives the empty key, which joins nothing."""

    def key(text: Column) -> Column:
        other = F.regexp_replace(F.lower(let(_reread(text), _compose)), _UNICODE_RUN, " ")
        return F.when(is_ascii(text), F.lower(text)).otherwise(F.trim(other))

    return F.coalesce(let(squeeze(col), key), F.lit(""))


def text_or_blank(text: Column) -> Column:
    """Stripped text; null and a word for a missing value become the empty string."""
    return F.when(F.lower(text).isin(*BLANK_TEXT), "").otherwise(F.coalesce(text, F.lit("")))


def normalize_text(col: Column) -> Column:
    """Trimmed text; a missing value or a word for one becomes the empty string."""
    return text_or_blank(strip(col))


def key_of_text(text: Column) -> Column:
    """Case-folded form of an already normalised plain column, blanks collapsed."""
    folded = F.regexp_replace(_fold(text), _UNICODE_RUN, " ")
    return F.when(is_ascii(text), F.regexp_replace(F.lower(text), _ASCII_RUN, " ")).otherwise(folded)


def comparison_key(col: Column) -> Column:
    """Case-folded text with every run of white space as one blank."""
    return let(normalize_text(col), key_of_text)


def loose_key(col: Column) -> Column:
    """Comparison key without punctuation, for near-duplicate checks."""
    plain = F.regexp_replace(comparison_key(col), r"[\p{P}\p{S}]+", " ")
    return F.trim(F.regexp_replace(plain, _UNICODE_RUN, " "))


def identifier_of(text: Column) -> Column:
    """Identifier of already stripped text."""
    whole = F.regexp_replace(text, r"\A(-?\p{Nd}+)\.0\z", "$1")
    present = ~F.lower(text).isin("", *BLANK_IDENTIFIER)
    return F.when(present, F.when(text.endswith(".0"), whole).otherwise(text))


def has_identifier(col: Column) -> Column:
    """True when normalize_identifier gives a value.

    Filter on this before normalising: a filter on the normalised column would be pushed
    down with the whole expression in it and work everything out twice.
    """
    return F.coalesce(~F.lower(strip(col)).isin("", *BLANK_IDENTIFIER), F.lit(False))


def normalize_identifier(col: Column) -> Column:
    """Trimmed identifier without a spreadsheet '.0'; words for a missing value become null."""
    return identifier_of(strip(col))


def with_identifiers(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add normalised identifiers {new name: source column}, each cell stripped once."""
    stripped = df.withColumns({new: strip(F.col(source)) for new, source in columns.items()})
    return stripped.withColumns({new: identifier_of(F.col(new)) for new in columns})


def with_texts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Replace the columns by their normalised text, each cell stripped once."""
    columns = list(columns)
    stripped = df.withColumns({c: strip(F.col(c).cast("string")) for c in columns})
    return stripped.withColumns({c: text_or_blank(F.col(c)) for c in columns})


def normalize_bool(col: Column) -> Column:
    """True for the accepted words in any case; everything else, null too, is false."""
    return F.coalesce(F.lower(strip(col.cast("string"))).isin(*TRUE_WORDS), F.lit(False))


def is_flagged(col: Column, word: str = "y") -> Column:
    """True when the trimmed, lower-cased cell equals the word."""
    return F.coalesce(F.lower(strip(col)) == word, F.lit(False))


def is_blank(col: Column) -> Column:
    """True for null and for text of white space only."""
    return F.coalesce(strip(col) == "", F.lit(True))
