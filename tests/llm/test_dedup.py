"""SimHash and line dedup against brute force."""

import hashlib
import random

import duckdb
import numpy as np
import xxhash
from tripgauge.llm import linededup, queries, simhash
from tripgauge.llm.components import components

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text).translate({c: " " for c in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, marks, distance=4):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (marks[a] ^ marks[b]).bit_count() <= distance:
                x, y = sorted((find(ids[a]), find(ids[b])))
                root[y] = x
    return {i: find(i) for i in ids}


def test_op8_matches_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(texts)
    marks = [brute_fingerprint(texts[i]) for i in ids]
    want = brute_components(ids, marks)
    out = queries.op8_simhash_near_dedup(spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in out} == {(i, f"{m:016x}", want[i]) for i, m in zip(ids, marks)}
    assert len(out) == len(ids) and len(set(want.values())) < len(ids)


def test_links_in_crowded_buckets_lose_nothing(spark):
    rng = random.Random(9)
    centre, marks = rng.getrandbits(64), set()
    while len(marks) < 600:  # a crowd around one fingerprint, chains, and strangers
        m = centre if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randrange(0, 14)):
            m ^= 1 << rng.randrange(64)
        marks.add(m)
    marks = sorted(marks)
    rows = spark.createDataFrame([(i, int(np.uint64(m).astype(np.int64))) for i, m in enumerate(marks)], "rep long, simhash long")
    want = brute_components(list(range(len(marks))), marks)
    for limit in (50, 4096):
        found = {r.node: r.component for r in components(simhash.links(rows, limit=limit)).collect()}
        assert {i: found.get(i, i) for i in want} == want


def test_near_duplicates_edges(spark):
    rows = [(5, "", "x"), (3, None, "x"), (9, " \t\n", "x"), (9, " \t\n", "x"), (None, "a b c d e", "x"), (7, "A b  c D\ne", "x"), (8, "w" * 300_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    out = sorted((str(r.doc_id), r.simhash, r.component_id) for r in simhash.near_duplicates(docs).collect())
    by = {i: c for i, _, c in out}
    assert len(out) == 7 and by["5"] == by["3"] == by["9"] == 3 and by["7"] == 7 and by["None"] == 7 and by["8"] == 8
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.fingerprint(b"one two") == brute_fingerprint("one two")


def test_long_path_and_hub(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, i) for i in range(1001, 1300)] + [(7, 7), (5, 6), (6, 5)]
    out = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {**dict.fromkeys(range(0, 201), 0), **dict.fromkeys(range(1000, 1300), 1000)}


def brute_lines(docs, least=3):
    holders = {}
    for d, text in docs:
        for line in (text or "").split("\n"):
            key = "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))
            if len(key) >= 20:
                holders.setdefault(key, set()).add(d)
    out = []
    for d, text in docs:
        lines = (text or "").split("\n")
        keep = []
        for line in lines:
            held = holders.get("".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r")), set())
            if len(held) < least or d == max(held):
                keep.append(line)
        out.append((d, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out)


def test_line_dedup_random(spark):
    rng = random.Random(11)
    pool = [f"Line number {k} of the common pool {'é' * (k % 5)}" for k in range(40)] + ["short", "", "é" * 19, "é" * 20, " " + "y" * 20]
    docs = []
    for d in range(400):
        lines = [rng.choice(["", " ", "\t"]) + (rng.choice(pool) if rng.random() < 0.8 else pool[0].upper()) + rng.choice(["", "\r", "  "]) for _ in range(rng.randrange(0, 30))]
        docs.append((d, "\n".join([*lines, "the line that every document holds"])))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_lines(docs)
    for parts in ("3", "40"):  # a hash spans partitions in the second
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7" if parts == "3" else "10000")
        try:
            got = sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in linededup.dedup_lines(frame).collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert got == want


def test_line_dedup_edges(spark):
    same = "this line is in several documents"
    rows = [(1, same, 0), (2, same + "\nx", 0), (2, same + "\nx", 0), (3, "y\n" + same.upper() + "\n" + same, 0), (None, same, 0), (4, None, 0), (5, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int")
    out = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in linededup.dedup_lines(docs).collect())
    assert out == sorted([("1", 1, 1, ""), ("2", 2, 1, "x"), ("2", 2, 1, "x"), ("3", 3, 0, rows[3][1]), ("None", 1, 0, same), ("4", 1, 0, None), ("5", 1, 0, "")],
                         key=lambda x: (x[0], x[1]))
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def test_op9_matches_sql_and_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = sorted(map(tuple, queries.op9_line_dedup(spark, SF).collect()))
    assert got == sorted(con.sql(queries.OP9_SQL).fetchall()) and sum(r[2] for r in got) > 0
    docs = con.sql("SELECT doc_id, text FROM documents").fetchall()
    assert got == sorted((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute_lines(docs))
