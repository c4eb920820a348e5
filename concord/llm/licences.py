"""Licence scans by canonical digest lookup.

A text's canonical form is its words in lower case, without punctuation, with one spelling for
words that have several, and without copyright lines (lines that begin with "copyright", "(c)" or
the sign, or with "all rights reserved"). Its digest is hash-joined to the digests of known
licences, so an entire text is found however it is wrapped, punctuated or capitalised. The same is
done for each statement of a text (a line, or a sentence of it): licences named in notices. A notice
of up to NOTICE_WORDS words is also found over several of them, as long as it begins and ends with one
and no empty line is inside.

An SPDX expression names the licences that AND and OR join, each without what follows WITH.

Known texts are a table (licence, text), by default the short ones below and the files in `known`,
with and without a usual title, and up to the end of their terms, and notices made from all names.
Their digests are counted first; up to KNOWN_ROWS of them are sent to every task. With a larger
registry the digests of texts and statements are joined to it by a shuffle; results are the same.

A null text is empty, and an empty text (or one of copyright lines alone) has no licence. Two known
texts with one canonical form give the licence that sorts first. Rows repeated in full each get
their result; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm import words as W
from concord.llm.frames import fields, picked, table, written

KNOWN_ROWS = 100_000
#: Most words of a notice that is looked for over several lines.
NOTICE_WORDS = 24

# Spellings that count as equal, each with the one used.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "centre": "center",
    "emphasise": "emphasize",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "sublicence": "sublicense",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}

# Short public licences, and names used in notices.
LICENCES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution.""",
    "WTFPL": """DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION
0. You just DO WHAT THE FUCK YOU WANT TO.""",
}
NOTICES = {
    "Apache-2.0": ("the Apache License, Version 2.0", "the Apache License 2.0", "Apache-2.0"),
    "GPL-3.0": ("the GNU General Public License, version 3", "the GNU GPL, version 3", "GPL-3.0"),
    "LGPL-3.0": ("the GNU Lesser General Public License, version 3", "LGPL-3.0"),
    "MPL-2.0": ("the Mozilla Public License, v. 2.0", "the Mozilla Public License 2.0", "MPL-2.0"),
    "MIT": ("the MIT License", "the MIT license", "MIT"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "the 3-clause BSD license", "BSD-3-Clause"),
    "CC-BY-4.0": ("CC BY 4.0",),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0",),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0",),
    "CC0-1.0": ("CC0 1.0",),
}
# Whole headers, and lines above a text.
HEADERS = {
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License");',
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License"),
    "BSD-2-Clause": ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License'),
    "WTFPL": (
        """DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
Version 2, December 2004
Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is
allowed as long as the name is changed.""",
    ),
}
END = "END OF TERMS AND CONDITIONS"
OPENINGS = ("Licensed under", "Released under", "This work is licensed under", "SPDX-License-Identifier:")


def known_texts(spark: SparkSession) -> DataFrame:
    """(licence, text): whole texts, and headers and a notice for each opening and name."""
    rows = list(LICENCES.items()) + [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "known").glob("*.txt"))]
    rows += [(k, text[: text.index(END) + len(END)]) for k, text in rows if END in text]
    rows += [(k, f"{title}\n\n{text}") for k, text in rows for title in TITLES.get(k, ())]
    rows += [(k, header) for k, headers in HEADERS.items() for header in headers]
    names = {k: (k, *NOTICES.get(k, ())) for k in sorted({k for k, _ in rows} | set(NOTICES))}
    rows += [(k, f"{o} {name}.") for k, listed in names.items() for name in listed for o in OPENINGS]
    return spark.createDataFrame(rows, "licence string, text string")


def _word_hashes(words: list[str]) -> np.ndarray:
    data = " ".join(words).encode()
    return W.split(np.frombuffer(data, np.uint8), np.array([0, len(data)])).hashes()


_variants = _word_hashes(list(SPELLINGS))
_order = np.argsort(_variants)
_VARIANTS, _USED = _variants[_order], _word_hashes(list(SPELLINGS.values()))[_order]
_SPDX = _word_hashes(["spdx", "license", "identifier"])
_JOINING, _WITH = _word_hashes(["and", "or"]), _word_hashes(["with"])[0]
_COPYRIGHT, _C, _SIGN, _ALL, _RIGHTS, _RESERVED = (_word_hashes([w])[0] for w in ("copyright", "c", "©", "all", "rights", "reserved"))


def canonical(found: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words with one spelling, and which of them stay (not in copyright lines)."""
    hashes = found.hashes()
    if not len(hashes):
        return hashes, np.zeros(0, bool)
    at = np.minimum(np.searchsorted(_VARIANTS, hashes), len(_VARIANTS) - 1)
    hashes = np.where(_VARIANTS[at] == hashes, _USED[at], hashes)
    data, starts, ends = found.data, found.starts, found.ends
    owner = np.repeat(np.arange(len(found.counts)), found.counts)
    line = np.searchsorted(np.flatnonzero(data == 10), starts) + owner  # grows with every break and every text
    first = np.concatenate([[True], (line[1:] != line[:-1]) | (owner[1:] != owner[:-1])])
    follow = [np.concatenate([hashes[i:], np.zeros(min(i, len(hashes)), np.uint64)]) for i in (1, 2)]
    in_brackets = (data[np.maximum(starts - 1, 0)] == ord("(")) & (data[np.minimum(ends, len(data) - 1)] == ord(")"))
    opens = (hashes == _COPYRIGHT) | (hashes == _SIGN) | ((hashes == _C) & in_brackets)
    opens |= (hashes == _ALL) & (follow[0] == _RIGHTS) & (follow[1] == _RESERVED)
    number = np.cumsum(first) - 1
    return hashes, ~(opens & first)[np.flatnonzero(first)][number]


def _digests(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """128 bits for each run of words, as two columns; zeros without words."""
    return np.stack([W.sequence_hashes(hashes, first), W.sequence_hashes(W.mix(hashes + np.uint64(11)), first)], axis=1)


def text_digests(found: W.Words) -> np.ndarray:
    hashes, stay = canonical(found)
    kept = np.concatenate([[0], np.cumsum(stay)])
    return _digests(hashes[stay], kept[found.first])


def spdx_parts(words: np.ndarray) -> list[np.ndarray]:
    """The statements of one licence each that an SPDX expression of several stands for."""
    body = words[len(_SPDX) :]
    cuts = np.flatnonzero(np.isin(body, _JOINING))
    parts = [p[p != j] for p, j in zip(np.split(body, cuts), [0, *body[cuts]])]
    ends = [np.flatnonzero(p == _WITH) for p in parts]
    parts = [p[: e[0]] if len(e) else p for p, e in zip(parts, ends)]
    return [np.concatenate([_SPDX, p]) for p in parts if len(p)] if len(cuts) or any(map(len, ends)) else []


def statement_digests(found: W.Words, sizes: dict[int, set[int]] | set[int]) -> tuple[np.ndarray, np.ndarray]:
    """Digest and text number of each statement: words up to a line break, or a full stop, ! or ? before a space.

    sizes: lengths of notices by the hash of their first word, or for any first word; statements put together
    that agree follow, and the parts of SPDX expressions.
    """
    hashes, stay = canonical(found)
    data = found.data
    stop = (data == ord(".")) | (data == ord("!")) | (data == ord("?"))
    space = np.concatenate([(data[1:] == 32) | ((data[1:] >= 9) & (data[1:] <= 13)), [True]]) if len(data) else stop
    breaks = np.flatnonzero((data == 10) | (stop & space))
    owner = np.repeat(np.arange(len(found.counts)), found.counts)[stay]
    hashes, part = hashes[stay], np.searchsorted(breaks, found.starts)[stay]
    if not len(hashes):
        return np.zeros((0, 2), np.uint64), owner
    heads = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])]))
    ends = np.concatenate([heads[1:], [len(hashes)]])
    joined, owners = [], []
    for k in np.flatnonzero((hashes[heads] == _SPDX[0]) & (ends - heads > len(_SPDX))).tolist():
        statement = hashes[heads[k] : ends[k]]
        if (statement[: len(_SPDX)] == _SPDX).all():
            parts = spdx_parts(statement)
            joined += parts
            owners += [owner[heads[k]]] * len(parts)
    listed = isinstance(sizes, dict)
    begin = np.flatnonzero(np.isin(hashes[heads], np.array(list(sizes), np.uint64))) if listed else np.arange(len(heads))
    for k in begin.tolist():
        wanted, e = sizes[int(hashes[heads[k]])] if listed else sizes, k + 1
        longest = max(wanted, default=0)
        while e < len(heads) and owner[heads[e]] == owner[heads[k]] and part[heads[e]] == part[heads[e - 1]] + 1 and ends[e] - heads[k] <= longest:
            if int(ends[e] - heads[k]) in wanted:
                joined.append(hashes[heads[k] : ends[e]])
                owners.append(owner[heads[k]])
            e += 1
    digests = _digests(hashes, np.concatenate([heads, [len(hashes)]]))
    if joined:
        more = _digests(np.concatenate(joined), np.cumsum([0, *map(len, joined)]))
        return np.concatenate([digests, more]), np.concatenate([owner[heads], np.array(owners)])
    return digests, owner[heads]


def _hex(digests: np.ndarray) -> pa.Array:
    return pa.array([f"{a:016x}{b:016x}" if a or b else None for a, b in digests.tolist()], pa.string())


def with_digests(
    texts: DataFrame, names: list[str], notices: dict[str, str] | None, sizes: dict[int, set[int]] | None = None
) -> DataFrame:
    """The named columns, the digest of each text (null without words), and the licences its statements name."""
    schema = T.StructType(
        [*fields(texts, names), T.StructField("digest", T.StringType()), T.StructField("notices", T.ArrayType(T.StringType()))]
    )
    known = notices or {}
    firsts = np.array(sorted({int(k[:16], 16) for k in known}), np.uint64)

    def run(batches):
        for b in batches:
            for i, j, data, offsets in W.blocks(b["text"]):
                found = W.split(data, offsets)
                lists: list[set[str]] = [set() for _ in range(j - i)]
                if known:
                    digests, owner = statement_digests(found, sizes or {})
                    hits = np.flatnonzero(np.isin(digests[:, 0], firsts))
                    for k in hits:
                        name = known.get(f"{int(digests[k, 0]):016x}{int(digests[k, 1]):016x}")
                        if name is not None:
                            lists[owner[k]].add(name)
                columns = [b[c].slice(i, j - i) for c in names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, _hex(text_digests(found)), pa.array([sorted(x) for x in lists], pa.list_(pa.string()))],
                    names=[*names, "digest", "notices"],
                )

    return texts.select(*names, "text").mapInArrow(run, schema)


def statements_of(texts: DataFrame, sizes: set[int]) -> DataFrame:
    """doc_id, digest of each text, and statements: the digests of all its statements."""
    schema = T.StructType([*fields(texts, ["doc_id"]), T.StructField("digest", T.StringType()), T.StructField("statements", T.ArrayType(T.StringType()))])

    def run(batches):
        for b in batches:
            for i, j, data, offsets in W.blocks(b["text"]):
                found = W.split(data, offsets)
                digests, owner = statement_digests(found, sizes)
                order = np.argsort(owner, kind="stable")
                lists = W.list_column(np.arange(len(order)), np.bincount(owner, minlength=j - i), pa.int64())
                texts = _hex(digests[order])
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"].slice(i, j - i), _hex(text_digests(found)), pa.ListArray.from_arrays(lists.offsets, texts)],
                    names=["doc_id", "digest", "statements"],
                )

    return texts.select("doc_id", "text").mapInArrow(run, schema)


def heads_and_sizes(known: DataFrame) -> DataFrame:
    """First word and number of words of each known text of up to NOTICE_WORDS words."""

    def run(batches):
        for b in batches:
            for _, _, data, offsets in W.blocks(b["text"]):
                found = W.split(data, offsets)
                hashes, stay = canonical(found)
                kept = np.concatenate([[0], np.cumsum(stay)])[found.first]
                size = np.diff(kept)
                short = (size > 0) & (size <= NOTICE_WORDS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[stay][kept[:-1][short]].view(np.int64)), pa.array(size[short])], names=["head", "size"]
                )

    return known.select("text").mapInArrow(run, "head long, size long")


def find_licences(
    docs: DataFrame, known: DataFrame | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: doc_id, digest, licence of the whole text (or null), notices (sorted licences of its statements)."""
    docs = picked(docs, doc_id=id_column, text=text_column)
    known = known_texts(docs.sparkSession) if known is None else picked(known, licence="licence", text="text")
    digests = (
        with_digests(known, ["licence"], None).where("digest IS NOT NULL").groupBy("digest").agg(F.min("licence").alias("licence"))
    )
    digests = written(digests)
    short = heads_and_sizes(known).distinct()
    if digests.count() > KNOWN_ROWS:
        return _joined(docs, digests, {r[0] for r in short.select("size").distinct().collect()})
    notices = {r["digest"]: r["licence"] for r in digests.collect()}
    sizes = defaultdict(set)
    for head, size in short.collect():
        sizes[head & (1 << 64) - 1].add(size)
    found = with_digests(docs, ["doc_id"], notices, dict(sizes)).join(F.broadcast(digests), "digest", "left")
    return found.select("doc_id", "digest", "licence", "notices")


def _joined(docs: DataFrame, digests: DataFrame, sizes: set[int]) -> DataFrame:
    """find_licences with a registry of any size: texts and statements are joined to it by their digests."""
    found = written(statements_of(docs, sizes).withColumn("row", F.monotonically_increasing_id()))
    named = found.select("row", F.explode("statements").alias("digest")).distinct().join(digests, "digest")
    named = named.groupBy("row").agg(F.array_sort(F.collect_set("licence")).alias("notices"))
    out = found.drop("statements").join(digests, "digest", "left").join(named, "row", "left")
    return out.select("doc_id", "digest", "licence", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"))


def op10_licences(spark, folder: str) -> DataFrame:
    """doc_id, digest, licence, notices for every row of documents."""
    return find_licences(table(spark, folder, "documents"))
