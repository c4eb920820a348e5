import random
import re

import pytest

from concord.llm import licences

from .conftest import words

MIT = licences.LICENCES["MIT"]


def test_texts_and_notices(docs):
    rows = [
        (1, "Copyright (c) 2020 Me\nAll rights reserved.\n" + MIT.upper().replace("\n", " ")), (2, MIT.replace("sublicense", "sublicence")),
        (3, MIT + " more"), (4, None), (5, ""), (6, "(C) 2020 Me\n© You"), (7, MIT), (7, MIT), (None, licences.LICENCES["Zlib"].replace("acknowledgment", "acknowledgement")),
        (8, "text\nLicenced under the Apache License, version 2.0. More text here"), (9, "Licensed under the Apache License, Version 2.0 or so."),
        (10, "Copyright Released under the MIT License."), (11, "Foo.\n\n  released under the MIT licence!\nLicensed under CC BY-NC 4.0."), (12, "word " * 50_000),
    ]
    got = {(r.doc_id, r.licence, tuple(r.notices)) for r in licences.find_licences(docs(rows)).collect()}
    assert got == {
        (1, "MIT", ()), (2, "MIT", ()), (3, None, ()), (4, None, ()), (5, None, ()), (6, None, ()), (7, "MIT", ()), (None, "Zlib", ()), (8, None, ("Apache-2.0",)),
        (9, None, ()), (10, None, ()), (11, None, ("CC-BY-NC-4.0", "MIT")), (12, None, ()),
    }
    assert licences.find_licences(docs(rows)).count() == len(rows)


def test_files_and_headers(docs):
    apache = (licences.Path(licences.__file__).parent / "known" / "Apache-2.0.txt").read_text()
    header = """# Copyright 2020 Me
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
"""
    rows = [
        (1, "MIT License\n\nCopyright (c) 2020 Me\n\n" + MIT), (2, "ISC License\n\n" + licences.LICENCES["ISC"]), (3, apache),
        (4, apache[: apache.index("APPENDIX")]), (5, "text\nLicensed under the Apache License,\nVersion 2.0\nmore"), (6, "text\n\n" + header),
        (7, "// Licensed\n// under the MPL\n\n// Licensed under the Mozilla Public License, v. 2.0."), (8, "text\n\nReleased under\n\nthe MIT License."),
    ]
    got = {(r.doc_id, r.licence, tuple(r.notices)) for r in licences.find_licences(docs(rows)).collect()}
    whole = {(d, k) for d, k, _ in got}
    assert whole == {(1, "MIT"), (2, "ISC"), (3, "Apache-2.0"), (4, "Apache-2.0"), (5, None), (6, None), (7, None), (8, None)}
    assert {(d, n) for d, k, n in got if k is None} == {(5, ("Apache-2.0",)), (6, ("Apache-2.0",)), (7, ("MPL-2.0",)), (8, ())}


def test_own_registry_with_ties(spark, docs):
    known = spark.createDataFrame([("b", "Some terms!"), ("a", "some TERMS"), ("c", "")], "licence string, text string")
    got = licences.find_licences(docs([(1, "SOME, terms."), (2, "")]), known).collect()
    assert {(r.doc_id, r.licence) for r in got} == {(1, "a"), (2, None)}


_SPELLED = {k: v for k, v in licences.SPELLINGS.items()}


def plain_words(text):
    return [_SPELLED.get(w, w) for w in words(text)]


def plain_lines(text):
    """(number, words) of the lines that are no copyright lines, cut into statements."""
    out, n = [], 0
    for line in (text or "").split("\n"):
        found = words(line)
        opens = found[:1] in (["copyright"], ["©"]) or found[:1] == ["c"] and re.match(r"[^0-9A-Za-z\x80-\U0010ffff]*\([cC]\)", line)
        opens = opens or found[:3] == ["all", "rights", "reserved"]
        for part in re.split(r"(?<=[.!?])(?=\s)", line):
            out.append((n, [] if opens else plain_words(part)))
            n += 1
    return out


def plain_find(rows, registry):
    """Licences of whole texts and of statements, put together word by word."""
    known = {}
    for licence, text in sorted(registry, reverse=True):
        key = tuple(w for _, p in plain_lines(text) for w in p)
        if key:
            known[key] = licence
    out = []
    for doc_id, text in rows:
        parts = plain_lines(text)
        named = set()
        for i in range(len(parts)):
            joined = []
            for n, p in parts[i:]:
                if joined and not p or len(joined) + len(p) > licences.NOTICE_WORDS and joined:
                    break
                joined += p
                named.add(known.get(tuple(joined)))
            body = parts[i][1]
            if body[:3] == ["spdx", "license", "identifier"]:
                for option in re.split(r" (?:and|or) ", " ".join(body[3:])):
                    named.add(known.get((*body[:3], *option.split(" with ")[0].split())))
        whole = tuple(w for _, p in parts for w in p)
        out.append((doc_id, known.get(whole) if whole else None, tuple(sorted(named - {None}))))
    return sorted(out)


NAMED = [
    "Licensed under GPL-2.0.", "Licensed under BSD-2-Clause.", "SPDX-License-Identifier: Apache-2.0 OR MIT",
    "# SPDX-License-Identifier: (GPL-2.0 WITH Classpath-exception-2.0 AND BSD-3-Clause)", "SPDX-License-Identifier: MIT", "SPDX-License-Identifier:",
    "Released under the GNU GPL,\nversion 3. More.", "All rights reserved. Licensed under MIT.", "Licensed\nunder\nMIT", "x. Licensed under the MIT licence! y\n",
    "(c) Me. Licensed under MIT", "word " * 40 + "\nLicensed under ISC\n\nrest",
]


@pytest.mark.parametrize("bound", (100_000, 1))
def test_plain_version_with_either_join(spark, docs, monkeypatch, bound):
    monkeypatch.setattr(licences, "KNOWN_ROWS", bound)
    rng = random.Random(bound)
    rows = [(i, t) for i, t in enumerate(NAMED)]
    rows += [(100 + i, rng.choice(["\n", " ", "\n\n"]).join(rng.choices(NAMED, k=4))) for i in range(60)]
    rows += [(200, MIT), (201, "MIT License\n\nCopyright (c) Me\n" + MIT), (202, MIT), (203, None), (204, "")]
    registry = [(r.licence, r.text) for r in licences.known_texts(spark).collect()]
    got = sorted((r.doc_id, r.licence, tuple(r.notices)) for r in licences.find_licences(docs(rows)).collect())
    assert got == plain_find(rows, registry)
    assert {n for d, _, ns in got if d < 4 for n in ns} >= {"GPL-2.0", "BSD-2-Clause", "Apache-2.0", "MIT", "BSD-3-Clause"}


def test_empty(docs):
    assert licences.find_licences(docs([])).collect() == []
