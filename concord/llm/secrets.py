"""Secret scans by a trigram inverted index.

Each rule is a regular expression. From its literal parts a Boolean query over trigrams is derived:
a text can only match if it has all trigrams of one of the rule's alternatives. The index holds a
posting (trigram, doc_id) for every trigram some rule asks for, of the text in lower case; postings
are intersected by document, and only the candidates of a rule are verified with its expression. A
rule without a mandatory trigram scans every text.

Matches of a rule are leftmost and do not overlap; those whose secret is too short are dropped.
Spans are code points, end exclusive. A null text is empty. Rows that share an id share their
candidates and are verified each on its own text; rows repeated in full get the same result. An
empty table gives an empty result. Everything is DataFrame functions.
"""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass
from re import _constants as C
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.llm.frames import picked, small_or_shuffled, table, written


@dataclass(frozen=True)
class Rule:
    """A kind of secret: an expression, and the least length of its first group (or of the whole, group 0)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# Public formats of credentials, in the order of their kinds.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # Every run is longest, so asking for the length at once finds the same spans as dropping short runs.
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
ADDED = (
    Rule("github", r"ghp_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
#: Alternatives of literal strings followed up for one rule; beyond, its query is less selective.
ALTERNATIVES = 64
_GAP = "\0"


def _strings(nodes) -> list[str]:
    """What a parsed expression's matches are made of: alternatives of literals, with gaps between them."""
    out = [""]
    for op, value in nodes:
        if op is C.LITERAL:
            parts = [chr(value)]
        elif op is C.SUBPATTERN:
            parts = _strings(value[3])
        elif op is C.BRANCH:
            parts = [s for branch in value[1] for s in _strings(branch)]
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and value[1] == 1:
            parts = ([""] if value[0] == 0 else []) + _strings(value[2])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and value[0] > 0:
            parts = [s + _GAP + s for s in _strings(value[2])]
        else:
            parts = [_GAP]
        if len(out) * len(parts) > ALTERNATIVES:
            parts = [_GAP]
        out = [a + b for a in out for b in parts]
    return out


def trigram_query(pattern: str) -> list[set[str]] | None:
    """Alternatives, each the set of trigrams (lower case) it needs; None if an alternative needs none."""
    query = []
    for string in _strings(parser.parse(pattern)):
        pieces = string.lower().split(_GAP)
        needed = {p[i : i + 3] for p in pieces for i in range(len(p) - 2) if p[i : i + 3].isascii()}
        if not needed:
            return None
        if needed not in query:
            query.append(needed)
    return query


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id): the inverted index for the trigrams that rules ask for."""
    there = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams)))
    # Lower-casing is a step of its own and no filter is set on the list, which would be moved down and
    # repeat it for every trigram.
    low = docs.select("doc_id", F.lower("text").alias("low"))
    return low.select(F.explode_outer(there).alias("trigram"), "doc_id").where("trigram IS NOT NULL")


def candidates(index: DataFrame, queries: dict[str, list[set[str]]]) -> DataFrame:
    """(doc_id, kinds): documents whose postings satisfy the query of a kind."""
    lists = index.groupBy("doc_id").agg(F.collect_set("trigram").alias("found"))

    def satisfied(query: list[set[str]]) -> Column:
        sides = [functools.reduce(operator.and_, (F.array_contains("found", t) for t in sorted(s))) for s in query]
        return functools.reduce(operator.or_, sides)

    kinds = F.array_compact(F.array(*(F.when(satisfied(q), F.lit(kind)) for kind, q in queries.items())))
    return lists.select("doc_id", kinds.alias("kinds")).where(F.size("kinds") > 0)


def spans(text: Column, rule: Rule, number: int) -> Column:
    """Array of (start, number, stop) of a rule's matches that are long enough."""
    pattern = F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    secrets = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    pieces = F.arrays_zip(between.alias("between"), matches.alias("match"), secrets.alias("secret"))
    none = F.array().cast("array<struct<start:int,number:int,stop:int>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def add(acc, piece):
        at = acc["at"] + F.length(piece["between"])
        stop = at + F.coalesce(F.length(piece["match"]), F.lit(0))
        span = F.array(F.struct(at.alias("start"), F.lit(number).alias("number"), stop.alias("stop")))
        long = F.coalesce(F.length(piece["secret"]) >= rule.least, F.lit(False))
        return F.struct(stop.alias("at"), F.when(long, F.concat(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    return F.aggregate(pieces, start, add, lambda acc: acc["found"])


def find_secrets(
    docs: DataFrame, base: tuple[Rule, ...] = BASE, added: tuple[Rule, ...] = ADDED, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: doc_id and spans, an array of (start, kind, stop, base) by start, then kind as listed."""
    docs = picked(docs, doc_id=id_column, text=text_column).withColumn("text", F.coalesce("text", F.lit("")))
    rules = (*base, *added)
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not None}
    needed = sorted({t for q in queries.values() for s in q for t in s})
    index = written(postings(docs, needed))
    wanted = small_or_shuffled(written(candidates(index, queries).select(F.col("doc_id").alias("of"), "kinds")))
    looked = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["of"]), "left").select("doc_id", "text", "kinds")
    none = F.array().cast("array<struct<start:int,number:int,stop:int>>")
    found = []
    for number, rule in enumerate(rules):
        if rule.kind in queries:
            test = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        else:
            test = F.rlike("text", F.lit(rule.pattern))
        found.append(F.when(test, spans(F.col("text"), rule, number)).otherwise(none))
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    named = F.transform(
        F.array_sort(F.concat(*found)),
        lambda x: F.struct(
            x["start"].alias("start"), F.element_at(kinds, x["number"] + 1).alias("kind"), x["stop"].alias("stop"),
            (x["number"] < len(base)).alias("base"),
        ),
    )
    return looked.select("doc_id", named.alias("spans"))


def op3_secrets(spark, folder: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row of documents."""
    found = find_secrets(table(spark, folder, "documents"))

    def joined(which: Column) -> Column:
        return F.array_join(F.transform(which, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(count(r.kind) for r in BASE), F.sha2(joined(F.filter("spans", lambda x: x["base"])), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def _sql_spans(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT row, {number} AS number, '{kind}' AS kind,
         CAST(list_sum([length(x) FOR x IN between[1:i]]) + coalesce(list_sum([length(x) FOR x IN matches[1:i - 1]]), 0) AS BIGINT) AS start,
         length(matches[i]) AS size
  FROM (
    SELECT row, regexp_split_to_array(text, '{quoted}') AS between, regexp_extract_all(text, '{quoted}', 0) AS matches,
           regexp_extract_all(text, '{quoted}', {group}) AS secrets, unnest(range(1, len(matches) + 1)) AS i
    FROM texts WHERE regexp_matches(text, '{quoted}')
  ) WHERE length(secrets[i]) >= {least}"""


_WORDS = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"

OP3_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join([
    _sql_spans(0, "assign", _WORDS + r'''["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)''', 1, 12),
    _sql_spans(1, "access", "AKIA[A-Z0-9]+", 0, 18),
    _sql_spans(2, "hex", "[0-9a-f]{16,}", 0, 16),
    _sql_spans(3, "github", "ghp_[A-Za-z0-9]{36,}", 0, 1),
    _sql_spans(4, "slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    _sql_spans(5, "key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
])}),
listed AS (
  SELECT row, count(*) FILTER (number = 0) AS n_assign, count(*) FILTER (number = 1) AS n_access, count(*) FILTER (number = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, number) FILTER (number < 3) AS base,
         string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, number) AS spans
  FROM found GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (row)
"""
