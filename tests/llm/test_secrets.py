"""Secret scans against Python's regular expressions."""

import random
import re

from tripgauge.llm.secrets import BASE_RULES, RULES, find_secrets, spans_of

BRUTE = (
    ("assign", re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
    ("hosting", re.compile("gh[pousr]_[A-Za-z0-9]+"), 0, 40),
    ("pem", re.compile("-----BEGIN [A-Z ]*PRIVATE KEY-----"), 0, 0),
)


def brute(text):
    out = []
    for order, (kind, pattern, group, least) in enumerate(BRUTE):
        out += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


PIECES = ["password", "PassWd", "secret", "token", "api_key", "apikey", "AKIA", "akia", ":", "=", " ", "  ", '"', "'", "\n", "é", "日本", "ſecret",
          "abcdef", "0123456789abcdef", "0123456789abcdef01234567", "ABCDEFGHIJKLMNOP", "Z9" * 9, "x", ".", "-", "ghp_", "xoxb-", "eyJ", "a" * 50,
          "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "secret: token: ", "== ", ",", "K"]


def test_random_texts_match_regular_expressions():
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 60))) for _ in range(6000)]
    got = spans_of([t.encode() for t in texts])
    for text, found in zip(texts, got):
        assert found == brute(text), text


def test_long_text_crosses_lanes():
    rng = random.Random(4)
    text = "".join(rng.choice(PIECES) for _ in range(60000)) + "password=" + "q" * 100_000 + " " + "ab" * 9000
    assert spans_of([b"", text.encode(), b"token=abcdef"]) == [[], brute(text), [("assign", 0, 12)]]


def test_rows_nulls_and_clashing_columns(spark):
    rows = [(1, "token=abcdef é", "a"), (1, "token=abcdef é", "a"), (None, None, None), (2, "", "b"), (3, "é password: secret: abcdef1", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secret_spans string")
    out = find_secrets(docs).collect()
    assert len(out) == 5 and [r.doc_id for r in out].count(1) == 2
    by = {r.doc_id: [(s.kind, s.start, s.end) for s in r.secret_spans] for r in out}
    assert by[None] == [] and by[2] == [] and by[1] == [("assign", 0, 12)] and by[3] == brute(rows[4][1])
    hidden = {r.doc_id: r.text for r in find_secrets(docs, mask=True).collect()}
    assert hidden[1] == "[ASSIGN] é" and hidden[None] is None and hidden[3] == "é [ASSIGN]: abcdef1"
    assert find_secrets(docs.limit(0)).count() == 0
    assert [r.kind for r in BASE_RULES] == [r.kind for r in RULES[:3]]


def test_query_matches_brute_force(spark):
    import hashlib

    from tripgauge.llm.queries import op1_secret_scans

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = op1_secret_scans(spark, sf).collect()
    assert len(out) == len(texts)
    for r in out:
        found = brute(texts[r.doc_id])
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in found if k in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert r.spans == ",".join(f"{k}:{s}:{e}" for k, s, e in found)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for x, _, _ in found) for k in ("assign", "access", "hex"))
