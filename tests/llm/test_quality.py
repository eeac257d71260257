"""Quality rules: measures against brute force, EM against a plain version, planted documents."""

import math
import random
import re
from collections import Counter

import numpy as np
from tripgauge.llm import quality
from tripgauge.llm.queries import op2_quality_rules

SF = "/root/testdata/sf0.001"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def em(patterns, rounds=quality.ROUNDS):
    """(share, alarm, catch, posterior) by the same steps in plain arithmetic."""
    m = len(next(iter(patterns)))
    share, alarm, catch = quality.SHARE, [quality.ALARM] * m, [quality.CATCH] * m
    weight = quality.PSEUDO + 0.02 * sum(patterns.values())

    def q(v):
        odds = math.log(share / (1 - share)) + sum(math.log(a / c) if x == -1 else math.log((1 - a) / (1 - c)) if x else 0 for x, a, c in zip(v, alarm, catch))
        return 1 / (1 + math.exp(-odds))

    def rate(scored, j, start, low, high):
        bad = sum(n for v, n in scored if v[j] == -1)
        return min(high, max(low, (bad + weight * start) / (sum(n for v, n in scored if v[j]) + weight)))

    for _ in range(rounds):
        good = [(v, n * q(v)) for v, n in patterns.items()]
        rest = [(v, n * (1 - q(v))) for v, n in patterns.items()]
        share = min(0.98, max(0.02, (sum(n for _, n in good) + weight * quality.SHARE) / (sum(patterns.values()) + weight)))
        alarm, catch = ([rate(rows, j, *bounds) for j in range(m)] for rows, bounds in ((good, (quality.ALARM, 0.001, 0.45)), (rest, (quality.CATCH, 0.05, 0.99))))
    return share, alarm, catch, q


def test_op2_matches_brute_force_and_has_no_python(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    frame = op2_quality_rules(spark, SF)
    assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().executedPlan().toString())
    out = frame.collect()
    assert len(out) == len(texts)
    for r in out:
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (want[0] < 50 or 2 * want[4] > want[0])
        assert not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id: r.kept for r in out if not r.base_failed}
    judged = [(labels[d], kept[d]) for d in labels if d in kept]
    assert all(k for q, k in judged if q == 1) and not any(k for q, k in judged if q == 0)


def test_fit_matches_plain_em(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(3000):
        good = rng.random() < 0.8
        rows.append(([0 if rng.random() < 0.2 else (-1 if rng.random() < (0.02 if good else c) else 1) for c in (0.95, 0.8, 0.6)],))
    frame = spark.createDataFrame(rows, "votes array<int>")
    model = quality.fit(frame, 3).first()
    share, alarm, catch, _ = em(Counter(tuple(r[0]) for r in rows))
    assert abs(model["share"] - share) < 1e-9 and np.allclose(model["alarm"], alarm) and np.allclose(model["catch"], catch)
    assert abs(share - 0.8) < 0.05 and catch[0] > catch[1] > catch[2]
    empty = quality.fit(frame.limit(0), 3).first()
    assert np.allclose(empty["catch"], quality.CATCH)


def test_edges_ties_and_clashes(spark):
    rng = random.Random(8)
    clean = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(300)) + "."
    junk = " ".join("#$%|" for _ in range(80)) + "\n" + "\n".join(f"<{i}> | & * $" for i in range(60)) + "\nx\nx\nx\nx"
    rows = [(1, clean, "?"), (1, clean, "?"), (2, None, "?"), (3, "", "?"), (4, "a b c a b c", "?"), (5, clean * 200, "?"), (6, junk, "?"),
            (7, " é x \x0b\x0c\r\t y", "?")]
    rows += [(100 + i, " ".join(f"w{i}x{k}" for k in range(120)), "?") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = quality.judge(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text)
    by = {r.doc_id: r.kept for r in out}
    assert by[1] and not by[2] and not by[3] and not by[4] and not by[5] and not by[6] and all(by[100 + i] for i in range(20))
    assert quality.judge(docs.limit(0)).count() == 0
    assert "text" not in quality.judge(docs, keep_text=False).columns
