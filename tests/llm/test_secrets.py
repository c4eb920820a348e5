import random
import re

from concord.llm import secrets

PLAIN = {
    "assign": (re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 1, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
    "github": (re.compile(r"ghp_[A-Za-z0-9]{36,}"), 0, 1),
    "slack": (re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"), 0, 1),
    "key": (re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"), 0, 1),
}


def brute(text):
    found = []
    for n, (kind, (pattern, group, least)) in enumerate(PLAIN.items()):
        found += [(m.start(), n, m.end(), kind) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return [(a, kind, z) for a, _, z, kind in sorted(found)]


def test_brute_force(docs):
    r = random.Random(9)
    bits = ["password", "PassWd", "secret", "token", "api_key", "apikey", "API_KEY", "=", ":", " ", "  ", '"', "'", "abcdefghijkl", "0123456789abcdef", "AKIA", "ABCDEFGHIJKLMN12", "ghp_" + "a1" * 18,
            "xoxb-", "1234567890", "é", "😀", "\n", "x", "-----BEGIN RSA PRIVATE KEY-----", "K", "ſecret", "deadbeef" * 3, "a.b/c+d="]
    rows = [(i, "".join(r.choices(bits, k=r.choice([1, 4, 12, 60])))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "secret: token: abcdefghijklmnop"), (502, "password=abcdefghijklm"), (None, "token=abcdefghijklm"), (503, "word " * 40_000 + "AKIA" + "Z" * 16), (504, "token=aaaaaaaaaaaa " * 2000)]
    got = secrets.find_secrets(docs(rows)).collect()
    assert sorted((str(r.doc_id), str([(s.start, s.kind, s.stop) for s in r.spans])) for r in got) == sorted((str(d), str(brute(t))) for d, t in rows)
    assert all(s.base == (s.kind in ("assign", "access", "hex")) for r in got for s in r.spans)


def test_queries_from_expressions():
    assert secrets.trigram_query(r"[0-9a-f]{16,}") is None
    assert secrets.trigram_query(r"AKIA[A-Z0-9]+") == [{"aki", "kia"}]
    assert secrets.trigram_query(r"(abc|xy)d?") is None
    assert sorted(map(sorted, secrets.trigram_query(r"(?i:abcd|x_?yz)=[0-9]+"))) == [["_yz", "x_y", "yz="], ["abc", "bcd", "cd="], ["xyz", "yz="]]


def test_empty(docs):
    assert secrets.find_secrets(docs([])).collect() == []


def test_no_python_in_the_plan(docs):
    plan = secrets.find_secrets(docs([(1, "x")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
