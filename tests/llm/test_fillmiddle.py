"""Fill-in-middle against a plain implementation, SQL, and the exact way back."""

import hashlib
import random
import re

import duckdb
import pytest
from tripgauge.llm import fillmiddle, queries

SF = "/root/testdata/sf0.001"


def brute(doc_id, text, rate=100, share=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < share:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


PIECES = ["\n", "\n\n", "a", "é", "日本", "🙂", " ", "<", "<S", "<P", "P>", "S>", "<M", "M>", ">", "line of text", "\r", "\x00"]


def texts(count, seed, marks=0.05):
    rng = random.Random(seed)
    for i in range(count):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 25)))
        yield i, text + (rng.choice(["<P>", "<S>", "<M>"]) if rng.random() < marks else "")


def test_random_texts(spark, monkeypatch):
    rows = list(texts(4000, 1)) + [(None, "x\ny\nz"), (None, None), (5, None), (5, ""), (9, "é" * 300_000 + "\n" + "b\n" * 100_000)] * 2
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, form string, extra int")
    out = fillmiddle.restore(fillmiddle.fill_in_middle(docs)).collect()
    key = lambda r: (str(r[0]), r[1] or "")
    got = sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in out), key=key)
    assert got == sorted(((i, t, *brute(i, t), t or "") for i, t in rows), key=key)
    assert {r.form for r in out} == {"plain", "psm", "spm"} and out[0].extra == 1


@pytest.mark.parametrize("window", [1, 3, 64])
def test_windows_do_not_matter(monkeypatch, window):
    monkeypatch.setattr(fillmiddle, "WINDOW", window)
    rows = list(texts(200, window))
    raw = [t.encode() for _, t in rows]
    digests = [hashlib.sha256(f"7:{i}".encode()).hexdigest() for i, _ in rows]
    out = fillmiddle.rearrange(raw, [tuple(int(d[k:k + 8], 16) for k in (0, 8, 16, 24)) for d in digests], 60, 30)
    want = [brute(i, t, 60, 30) for i, t in rows]
    assert list(zip(*(out[c].to_pylist() for c in ("n", "form", "prefix_chars", "middle_chars", "output")))) == want
    back = fillmiddle.put_back([o.encode() for o in out["output"].to_pylist()], out["form"].to_pylist())
    assert back.to_pylist() == [t for _, t in rows]


def test_broken_output_is_an_error():
    with pytest.raises(ValueError):
        fillmiddle.put_back([b"<P>a<S>b"], ["psm"])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fillmiddle.restore(fillmiddle.fill_in_middle(docs)).count() == 0


def test_op12_matches_sql_and_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = sorted(map(tuple, queries.op12_fill_in_middle(spark, SF).collect()))
    want = [(d, *brute(d, t)[:4], sha(brute(d, t)[4]), sha(t or "")) for d, t in con.sql("SELECT doc_id, text FROM documents").fetchall()]
    assert got == sorted(want)
    assert got == sorted(con.sql(queries.OP12_SQL).fetchall())
