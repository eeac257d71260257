"""The whole pipeline against its stages done by brute force."""

import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import test_bpe_packing
import test_dedup
import test_quality
import test_secrets
from tripgauge.llm.secrets import masked

SF = "/root/testdata/sf0.001"


def votes(text):
    n, chars, symbols, dup, repeat = test_quality.brute(text)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    letters, marked = sum(any(c.isalpha() for c in w) for w in words), sum(bool(re.search(r"[#*$%&|<>]", w)) for w in words)
    pick = lambda bad, good: -1 if bad else 1 if good else 0
    return (pick(n < 50, n >= 80), pick(chars < 2 * n, 3 * n <= chars <= 12 * n), pick(5 * symbols > n, 50 * symbols <= n),
            pick(2 * dup > len(lines), 10 * dup <= len(lines)), pick(2 * repeat > n, 5 * repeat <= n), pick(30 * symbols > chars, 200 * symbols <= chars), pick(100 * marked > 15 * n, 100 * marked <= 3 * n), pick(2 * letters < n, 10 * letters >= 8 * n))


def brute(docs):
    """docs: [(id, text)] with different ids; the pieces (id, piece, start, length, crc)."""
    voted = [(d, t, votes(t)) for d, t in docs]
    *_, q = test_quality.em(Counter(v for *_, v in voted))
    kept = []
    for d, t, v in voted:
        n, _, _, _, repeat = test_quality.brute(t)
        if n >= 50 and 2 * repeat <= n and q(v) >= 0.5:
            kept.append((d, t))
    kept = [(d, t) for d, _, _, t in test_dedup.brute_lines(kept)]
    group = test_dedup.brute_components([d for d, _ in kept], [test_dedup.brute_fingerprint(t) for _, t in kept])
    kept = [(d, masked(t, test_secrets.brute(t))) for d, t in kept if group[d] == d]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(test_bpe_packing.PATH)
    out = set()
    for d, t in kept:
        ids = library.encode(t, add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        for k, (a, b) in enumerate(zip([0, *range(first, len(ids), 1024)], range(first, len(ids) + 1, 1024))):
            out.add((d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def test_pipeline_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = corpus_pipeline.run(spark, SF).collect()
    want = brute(docs)
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out} == want and len(out) == len(want)
    sequences = test_bpe_packing._check_layout(out, 1024)
    assert sequences <= 1.05 * sum(r.length for r in out) / 1024 + 1


def test_stages_on_awkward_rows(spark):
    clean = " ".join(f"word{i} other{i * 7 % 31} thing{i * 3}" for i in range(60)) + "\n"
    rows = [(1, clean + "password: hunter2hunter2", "en", "a", 5), (1, clean + "password: hunter2hunter2", "en", "a", 5), (2, clean + "token=abcdef99", "en", None, None),
            (None, clean, None, None, None), (3, None, "en", "b", 0), (4, "", "en", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == docs.columns, name
    left = {r.doc_id: r for r in now.collect()}
    assert now.count() == 2 and set(left) == {1, None}
    assert "[ASSIGN]" in left[1].text and "hunter2" not in left[1].text and left[1].n_chars == len(left[1].text)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0


def test_unlike_texts_of_one_id_survive_near_dedup(spark):
    text = lambda k: " ".join(f"w{k}x{i * (k + 3) % 97}" for i in range(80))
    rows = [(1, text(1)), (1, text(2)), (2, text(1)), (1, text(1)), (0, text(3)), (3, text(3)), (3, text(4)), (None, text(1)), (5, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_dedup(spark, docs, SF).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in out) == sorted([("1", text(1)), ("1", text(2)), ("0", text(3)), ("3", text(4)), ("None", text(1)), ("5", "")])
