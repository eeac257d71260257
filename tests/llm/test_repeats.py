"""Suffix arrays, common prefixes and repeated passages against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from tripgauge.llm import repeats, suffixes
from tripgauge.llm.queries import op7_suffix_array_dedup
from tripgauge.llm.suffixes import permuted_prefixes, suffix_array

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("alphabet", [1, 2, 3, 60])
def test_suffix_array_and_prefixes(alphabet):
    rng = random.Random(alphabet)
    for _ in range(150):
        x = [rng.randrange(1, alphabet + 1) for _ in range(rng.randrange(0, 90))]
        x = x[:len(x) // 3] * 4 if rng.random() < 0.4 else x
        s = np.array([*x, 0], np.int32)
        b = bytes(s.tolist())
        want = sorted(range(len(b)), key=lambda i: b[i:])
        assert suffix_array(s).tolist() == want
        plcp = permuted_prefixes(s, np.array(want))
        for i, j in zip(want[1:], want):
            n = 0
            while max(i, j) + n < len(b) and b[i + n] == b[j + n]:
                n += 1
            assert plcp[i] == n


@pytest.mark.parametrize("free, window", [(1 << 40, (1, 4)), (0, (256, 1 << 17)), (3, (8, 64)), (32, (256, 1 << 17))])
def test_walks_in_windows_and_singly(free, window, monkeypatch):
    """The same order whether the walk takes steps of any width, goes entry by entry or changes over; several levels of recursion."""
    monkeypatch.setattr(suffixes, "FREE", free)
    monkeypatch.setattr(suffixes, "WINDOW", window)
    rng = random.Random(free)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(40)]
    lines = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(12)]
    texts = ["".join(rng.choice(lines) for _ in range(25)), "".join(chr(200 - i // 20) for i in range(3000)), "a" * 2500, "ab" * 900 + "aab" * 300,
             "".join(chr(rng.randrange(1, 250)) for _ in range(5000)), "".join(rng.choice(words) for _ in range(1500))]
    for text in texts:
        b = text.encode("latin-1") + b"\0"
        assert suffix_array(np.frombuffer(b, np.uint8).astype(np.int32)).tolist() == sorted(range(len(b)), key=lambda i: b[i:])
    # An alphabet beyond 16 bits.
    x = np.append(np.array([rng.randrange(1, 90_000) for _ in range(400)] * 4, np.int32), np.int32(0))
    assert suffix_array(x).tolist() == sorted(range(len(x)), key=lambda i: x[i:].tolist())


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    often = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if often[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone]) if len(t) else b""
        out.append((len(t), int(gone.sum()), int((np.diff(np.append(False, gone).astype(int)) == 1).sum()), kept))
    return out


@pytest.mark.parametrize("crowd", [1, 3, 4096])
def test_random_texts(spark, crowd, monkeypatch):
    monkeypatch.setattr(repeats._crowded, "__defaults__", ((7, 1),))
    rng = random.Random(crowd)
    passages = ["".join(rng.choice("abé \n") for _ in range(rng.randrange(20, 140))) for _ in range(12)]
    texts = []
    for _ in range(160):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 60))) for _ in range(rng.randrange(0, 6))]
        texts.append("".join(parts))
    texts += [texts[5]] * 3 + ["x" * 500, "xy" * 200, "", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(frame, length=40, gram=8, crowd=crowd).collect()}
    want = brute(texts, 40)
    for i, w in enumerate(want):
        assert out[i] == w, i


def test_tiles_and_edges(spark, monkeypatch):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefghij") for _ in range(700_000))
    rows = [(1, long, "a"), (2, "q" + long[600_000:640_000] + "q", "b"), (None, long[5:900], "c"), (3, "z" * 399, "d"), (3, "z" * 399, "d"), (4, None, "e")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, body string")
    out = repeats.remove_repeats(frame).collect()
    want = brute([r[1] for r in rows], 400)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out) == sorted(want)
    assert repeats.remove_repeats(frame.limit(0)).count() == 0
    twice = spark.createDataFrame([(7, "ab" * 300), (7, "ab" * 300)], "doc_id long, text string")
    assert [(r.n_removed, r.n_spans) for r in repeats.remove_repeats(twice).collect()] == [(600, 1)] * 2


def test_op7_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {d: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for (d, _), w in zip(docs, brute([t for _, t in docs], 400))}
    out = op7_suffix_array_dedup(spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == want and len(out) == len(docs)
    assert sum(w[1] for w in want.values()) > 0


def test_thue_morse_texts(spark):
    """Strings on which polynomials modulo a power of two collide, whatever their base."""
    t = "a"
    while len(t) < 4096:
        t += t.translate(str.maketrans("ab", "ba"))
    u = t.translate(str.maketrans("ab", "ba"))
    texts = [f"{i}{x}{i}" for i, x in enumerate([t[:2048], u[:2048], t, "x" + u[100:1500], u[2048:] + "y"])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for crowd in (1, 2048):
        out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(frame, crowd=crowd).collect()}
        assert [out[i] for i in range(len(texts))] == brute(texts, 400)


def brute_passages(texts, words):
    split = [tuple((t or "").encode().split()) for t in texts]
    often = Counter(t[i:i + words] for t in split for i in range(len(t) - words + 1))
    out = []
    for t in split:
        held = np.zeros(len(t), bool)
        for i in range(len(t) - words + 1):
            if often[t[i:i + words]] > 1:
                held[i:i + words] = True
        out.append((len(t), int(held.sum())))
    return out


@pytest.mark.parametrize("crowd", [2, 2048])
def test_passages_match_brute_force(spark, crowd):
    rng = random.Random(crowd)
    shared = [" ".join(rng.choice(["of", "the", "é", "sea", "a"]) for _ in range(rng.randrange(8, 40))) for _ in range(10)]
    texts = []
    for _ in range(120):
        parts = [rng.choice(shared).replace(" ", rng.choice([" ", "\n", "\t "])) if rng.random() < 0.5 else " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(0, 30)))
                 for _ in range(rng.randrange(0, 6))]
        texts.append("  ".join(parts))
    long = [f"w{rng.randrange(5000)}" for _ in range(100_000)]  # several tiles
    texts += [None, "", "x " * 4000, "one word", " ".join(long), " ".join(long[40_000:46_000]), " ".join(long[86_000:88_500])]
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    out = {r.doc_id: (r.n_words, r.n_passage_words) for r in repeats.passages(frame, words=12, crowd=crowd).collect()}
    assert [out[i] for i in range(len(texts))] == brute_passages(texts, 12)


def test_op7_passages_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {d: n for (d, _), (_, n) in zip(docs, brute_passages([t for _, t in docs], 51))}
    assert {r.doc_id: r.n_passage_words for r in op7_suffix_array_dedup(spark, SF).collect()} == want and sum(want.values()) > 0


def test_shards_leave_out_segments_without_a_common_window_and_take_whole_words():
    """Of one anchor's segments only those that may share a window are sorted; words are single characters of the suffix array."""
    import numpy as np
    import pyarrow as pa

    from tripgauge.llm import repeats

    rng = np.random.default_rng(5)
    gram, part = rng.bytes(24), lambda n: rng.bytes(n)
    left, right = part(60), part(69)
    segments = [left + gram + right, left + gram + part(69), part(60) + gram + right, left[1:] + gram + right + b"x", part(60) + gram + part(69)]
    names = ["anchor", "h1", "h2", "alone", "segment", "place"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, (9, i, i, True, s, s.index(gram)))) for i, s in enumerate(segments)])
    kept = [r[1] for r in repeats._alike([tuple(r.values()) for r in batch.to_pylist()], 120)]
    assert 4 not in kept and {0, 3} <= set(kept)
    found = {r["h1"]: r["spans"] for b in repeats._shards(120)(iter([batch])) for r in b.to_pylist()}
    assert found == {0: [1, 153], 3: [0, 152]}
    # With words of 3 bytes a repeated string that begins inside a word doesn't count: these share bytes 2 to 152 alone.
    a, b = bytearray(part(153)), None
    b = bytearray(a)
    b[0] ^= 1
    words = pa.RecordBatch.from_pylist([dict(zip(names, (9, i, i, True, bytes(s), 60))) for i, s in enumerate((a, b))])
    assert not list(repeats._shards(153, 3)(iter([words]))) and list(repeats._shards(150, 3)(iter([words])))


def test_word_codes_tell_words_apart_at_any_place():
    from tripgauge.llm import repeats

    long = b"w" * (repeats.TILE + 5)
    texts = [b"", b" \t", b"one two\nthree", b"three\x0b one  two ", "é ü one".encode(), long + b" one", b"one " * 100_000, b"\xc2\xa0one"]
    codes = [[c[i:i + repeats.CODE] for i in range(0, len(c), repeats.CODE)] for c in repeats._word_codes(texts)]
    assert [len(c) for c in codes] == [len(t.split()) for t in texts]
    table = {}
    for text, made in zip(texts, codes):
        for word, code in zip(text.split(), made):
            assert table.setdefault(word, code) == code
    assert len(set(table.values())) == len(table)
    assert repeats._word_codes([]) == []


def test_a_worker_cuts_segments_from_a_megabyte_of_text_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    docs = spark.createDataFrame([(1, 1, "x")], "doc long, body long, text string")
    wanted = spark.createDataFrame([(1, 1, 1, True, 0, 1, 1, 0, 1)], "anchor long, h1 long, h2 long, alone boolean, place int, doc long, body long, start int, bytes int")
    monkeypatch.setattr(repeats, "map_batches", lambda frame, fn, schema: fn)
    cut = repeats._fetch(docs, wanted)
    texts = [f"{i:04d}" * 256 for i in range(5000)]
    lists = [[{"anchor": i, "h1": k, "h2": 0, "alone": True, "place": 0, "start": a, "bytes": 600} for k, a in enumerate((0, 171, 424))] for i in range(5000)]
    found = list(cut(pa.RecordBatch.from_pydict({"text": texts, "list": lists})))
    assert [s for part in found for s in part["segment"]] == [t[a:a + 600].encode() for t in texts for a in (0, 171, 424)]
    assert max(sum(map(len, part["segment"])) for part in found) <= 2 << 20  # 9 MB with all 5 MB of text in one step
    batch = pa.RecordBatch.from_pydict({"text": texts})
    parts = list(repeats._slim(batch))
    assert pa.Table.from_batches(parts).combine_chunks().to_pydict() == batch.to_pydict() and max(p.num_rows for p in parts) <= 512


def test_only_the_cuts_stay_on_disk(spark):
    from pathlib import Path

    from pyspark.sql import functions as F
    from tripgauge.session import shared_dir

    stages = Path(shared_dir(spark).removeprefix("file:")) / "tripgauge" / spark.sparkContext.applicationId
    rng = random.Random(4)
    same = "".join(rng.choice("abcd") for _ in range(90))
    frame = spark.createDataFrame([(i, same[:60 + i] + str(i) * 50) for i in range(9)], "doc long, text string")
    before = set(stages.glob("*/*"))
    cuts = repeats._covered(frame.select("doc", F.lit(0).cast("long").alias("body"), "text"), 40, 8, 2)
    assert {p.name for p in set(stages.glob("*/*")) - before} == {"cuts"}
    assert {r.doc for r in cuts.collect()} == set(range(9))


def test_op7_sends_small_batches_and_leaves_two_small_tables(spark, tmp_path, monkeypatch):
    """Batches that workers get of texts are bounded in bytes, not by 10,000 rows; neither word codes nor cuts stay on disk."""
    from pathlib import Path

    from tripgauge.session import shared_dir

    stages = Path(shared_dir(spark).removeprefix("file:")) / "tripgauge" / spark.sparkContext.applicationId
    rng = random.Random(6)
    texts = [" ".join(str(rng.randrange(10_000)) for _ in range(600)) for _ in range(3000)]
    texts[7] = texts[5]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    noted, real, key = str(tmp_path / "sizes"), repeats.steps, "spark.sql.execution.arrow.maxBytesPerBatch"

    def steps(batch, *args):
        with open(noted, "a") as f:
            f.write(f"{batch.nbytes}\n")
        return real(batch, *args)

    monkeypatch.setattr(repeats, "steps", steps)
    conf, before = spark.conf.get(key), set(stages.glob("*/*"))
    out = {r.doc_id: (r.n_bytes, r.n_removed) for r in op7_suffix_array_dedup(spark, str(tmp_path)).collect()}
    assert out == {i: (len(t), len(t) * (i in (5, 7))) for i, t in enumerate(texts)}
    sizes = [int(x) for x in Path(noted).read_text().split()]
    assert sum(sizes) > 3 * sum(map(len, texts)) and max(sizes) < 3 << 20  # 8 MB in one batch by rows
    assert {p.name for p in set(stages.glob("*/*")) - before} == {"passage_words", "cut_digests"} and spark.conf.get(key) == conf


def test_shared_anchors_are_joined_once(spark, monkeypatch):
    """The join of segments and shared anchors is written, not run again by each filter and join made of it."""
    made, real = [], repeats._fetch

    def fetch(docs, wanted):
        made.append(wanted._jdf.queryExecution().optimizedPlan().toString())
        return real(docs, wanted)

    monkeypatch.setattr(repeats, "_fetch", fetch)
    same = "".join(random.Random(8).choice("abcd") for _ in range(90))
    frame = spark.createDataFrame([(i, same[:60 + i] + str(i) * 50) for i in range(9)], "doc_id long, text string")
    assert {r.doc_id for r in repeats.remove_repeats(frame, length=40, gram=8, crowd=2).filter("n_removed > 0").collect()} == set(range(9))
    assert len(made) == 2 and not any("Join" in plan for plan in made)


def test_texts_are_hashed_once(spark, tmp_path, monkeypatch):
    """The segments are made in one pass over the texts, and what is written for that doesn't stay."""
    noted, real = str(tmp_path / "texts"), repeats.segments

    def segments(texts, *args):
        with open(noted, "a") as f:
            f.writelines(f"{len(x)}\n" for x in texts)
        return real(texts, *args)

    monkeypatch.setattr(repeats, "segments", segments)
    rng = random.Random(11)
    texts = ["".join(rng.choice("abcd") for _ in range(200 + i)) for i in range(40)]
    texts[3] = "x" + texts[9][20:150] + "y" * 70
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(frame, length=40, gram=8).collect()}
    assert [out[i] for i in range(len(texts))] == brute(texts, 40)
    with open(noted) as f:
        assert sorted(map(int, f)) == sorted(map(len, texts))  # each text was there twice


@pytest.mark.parametrize("alphabet", [5, 254, 255, 256, 65_534, 65_535, 65_536, 1 << 20])
def test_prefixes_of_any_alphabet(alphabet):
    """Characters of 8, 16 and 32 bits are compared several at a time."""
    rng = random.Random(alphabet)
    x = [rng.randrange(1, alphabet) for _ in range(60)]
    x = x * 3 + [alphabet - 1] * 9 + x[:31] + [alphabet] + x[:37]
    s = np.array([*x, 0], np.int32)
    sa = suffix_array(s)
    assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    plcp = permuted_prefixes(s, sa)
    for i, j in zip(sa.tolist()[1:], sa.tolist()):
        n = 0
        while s[i + n] == s[j + n]:
            n += 1
        assert plcp[i] == n
