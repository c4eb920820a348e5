"""Header normalisation, role resolution by hints, and column contracts.

Everything here works on column names on the driver; no job runs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Characters replaced in headers (arrow misread as Latin-1, arrow, long dashes, quote).
HEADER_REPLACEMENTS = {
    "â†’": "->",
    "→": "->",
    "—": "-",
    "–": "-",
    "’": "'",
}


def arrow_header(name: str | None) -> str:
    """Lower-cased header with plain arrows, dashes and quotes and single blanks."""
    text = name or ""
    for found, plain in HEADER_REPLACEMENTS.items():
        text = text.replace(found, plain)
    return " ".join(text.split()).lower()


def snake_header(name: object) -> str:
    """Lower-cased header with one underscore for every run of other characters."""
    return "_".join(re.findall(r"[a-z0-9]+", str(name).lower()))


def unique_names(names: Iterable[str], label: str = "table") -> list[str]:
    """The names, or an error naming those that occur twice."""
    names = list(names)
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"{label} has columns that become equal: {', '.join(twice)}")
    return names


def normalize_headers(df: DataFrame, rule: Callable[[str], str] = snake_header) -> DataFrame:
    """Rename all columns by a rule; two columns may not become one."""
    return df.toDF(*unique_names(rule(c) for c in df.columns))


def resolve_column(columns: Sequence[str], hints: Sequence[str]) -> str | None:
    """The first column equal to a hint, else the first that contains one.

    Both searches go through the columns in table order, so an earlier column wins over an
    earlier hint.
    """
    wanted = [arrow_header(h) for h in hints]
    equal = [c for c in columns if c in wanted]
    inside = [c for c in columns if any(w in c for w in wanted)]
    return (equal + inside + [None])[0]


def require_columns(columns: Iterable[str], required: Iterable[str], label: str) -> None:
    """Raise unless every required column is there; the error lists what was found instead."""
    found = list(columns)
    absent = [c for c in required if c not in found]
    if absent:
        raise ValueError(f"{label}: no column {', '.join(map(repr, absent))} among {found}")


def select_roles(
    df: DataFrame,
    roles: dict[str, Sequence[str]],
    label: str,
    optional: Iterable[str] = (),
    keep: Iterable[str] = (),
) -> DataFrame:
    """Select columns by role: each role is resolved by its hints and renamed to the role.

    Optional roles that are not found are left out; ``keep`` names columns passed through.
    """
    found = {role: resolve_column(df.columns, hints) for role, hints in roles.items()}
    require_columns([r for r, c in found.items() if c], set(roles) - set(optional), label)
    picked = [F.col(f"`{c}`").alias(role) for role, c in found.items() if c]
    return df.select(*picked, *[F.col(f"`{k}`") for k in keep if k not in found])


def fill_optional(df: DataFrame, columns: Iterable[str], value: str = "") -> DataFrame:
    """Add the columns that are absent, filled with one value."""
    return df.withColumns({c: F.lit(value) for c in columns if c not in df.columns})
