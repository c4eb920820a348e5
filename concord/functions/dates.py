"""Dates that arrive as text in mixed formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions.text import let, squeeze

_TIME = r"(?: \d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)?"

# Shapes and the formats tried for each, in order. A cell is matched to one shape first, so
# only the formats that can fit are ever tried. Month-first is preferred where day and month
# are both possible, as pandas does.
SHAPES = (
    (r"\d{4}-\d{1,2}-\d{1,2}", ("yyyy-M-d",)),
    (r"\d{4}/\d{1,2}/\d{1,2}", ("yyyy/M/d",)),
    (r"\d{4}\.\d{1,2}\.\d{1,2}", ("yyyy.M.d",)),
    (r"\d{8}", ("yyyyMMdd",)),
    (r"\d{1,2}/\d{1,2}/\d{4}", ("M/d/yyyy", "d/M/yyyy")),
    (r"\d{1,2}-\d{1,2}-\d{4}", ("M-d-yyyy", "d-M-yyyy")),
    (r"\d{1,2}\.\d{1,2}\.\d{4}", ("M.d.yyyy", "d.M.yyyy")),
    (r"[A-Za-z]{3} \d{1,2}, ?\d{4}", ("MMM d,yyyy",)),
    (r"[A-Za-z]{4,9} \d{1,2}, ?\d{4}", ("MMMM d,yyyy",)),
    (r"[A-Za-z]{3} \d{1,2} \d{4}", ("MMM d yyyy",)),
    (r"[A-Za-z]{4,9} \d{1,2} \d{4}", ("MMMM d yyyy",)),
    (r"\d{1,2}[ -][A-Za-z]{3}[ -]\d{4}", ("d MMM yyyy",)),
    (r"\d{1,2}[ -][A-Za-z]{4,9}[ -]\d{4}", ("d MMMM yyyy",)),
)


_CLOCK = r" (\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)\z"
_CLOCK_ON = r" \d{1,2}:\d{2}.*\z"


def _cleaned(col: Column) -> Column:
    """Text in one of the shapes, as far as blanks, the T before a clock and commas go."""
    text = F.regexp_replace(squeeze(col.cast("string")), r"(\d)T(\d)", "$1 $2")
    text = F.regexp_replace(text, r"\A(\d{1,2})-([A-Za-z]{3,9})-(\d{4})", "$1 $2 $3")
    return F.regexp_replace(text, r", ?(\d{4})", ",$1")


def parse_timestamp(col: Column, shapes=SHAPES) -> Column:
    """Each cell read in its own format as a timestamp without zone; failures are null.

    Over many rows ``with_timestamps`` is faster.
    """
    return let(_cleaned(col), lambda cell: _timestamp_of(cell, shapes))


def _timestamp_of(text: Column, shapes) -> Column:
    return _stamp(text, F.regexp_replace(text, _CLOCK_ON, ""), F.regexp_extract(text, _CLOCK, 1), shapes)


def _stamp(text: Column, plain: Column, clock: Column, shapes) -> Column:
    """The timestamp of cleaned text, from its day without the clock and its clock."""
    day = F.lit(None).cast("date")
    for shape, formats in reversed(shapes):
        value = F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)).cast("date") for f in formats])
        day = F.when(text.rlike(rf"\A(?:{shape}){_TIME}\z"), value).otherwise(day)
    stamp = F.concat_ws(" ", day.cast("string"), F.coalesce(F.nullif(clock, F.lit("")), F.lit("00:00")))
    return stamp.try_cast("timestamp_ntz")


def with_timestamps(df: DataFrame, columns: dict[str, str], shapes=SHAPES) -> DataFrame:
    """Add parse_timestamp of {new name: source column}; every step is a column, so each is worked out once."""
    staged = df.withColumns({f"_text_{new}": _cleaned(F.col(source)) for new, source in columns.items()})
    staged = staged.withColumns({f"_plain_{new}": F.regexp_replace(f"_text_{new}", _CLOCK_ON, "") for new in columns})
    staged = staged.withColumns({f"_clock_{new}": F.regexp_extract(f"_text_{new}", _CLOCK, 1) for new in columns})
    stamps = {new: _stamp(*(F.col(f"_{step}_{new}") for step in ("text", "plain", "clock")), shapes) for new in columns}
    return staged.withColumns(stamps).drop(*[f"_{step}_{new}" for step in ("text", "plain", "clock") for new in columns])


def parse_date(col: Column, shapes=SHAPES) -> Column:
    """The day of parse_timestamp."""
    return parse_timestamp(col, shapes).cast("date")


def format_date(col: Column) -> Column:
    """YYYY-MM-DD."""
    return F.date_format(col, "yyyy-MM-dd")


def parse_date_text(col: Column, shapes=SHAPES) -> Column:
    """YYYY-MM-DD, or the empty string when the cell holds no date."""
    return F.coalesce(format_date(parse_date(col, shapes)), F.lit(""))
