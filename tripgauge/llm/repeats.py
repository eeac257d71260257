"""Repeated passages: suffix arrays by induced sorting over content-dealt shards.

Every window of ``length`` bytes has an anchor, the k-gram in it with the
smallest hash; equal windows have equal anchors at the same place. So windows
are dealt to shards by their anchor, and all equal windows meet in one shard:

1. The bytes covered by the consecutive windows of one anchor are a segment.
   Those of anchors that occur once are dropped by a bloom filter of the hashes
   that occur again (a filter can only let more through).
2. Equal segments are combined before any text moves: all their windows repeat.
3. One copy of each distinct segment goes to its anchor's shard. There the
   suffix array and the permuted common prefixes tell which windows repeat.
4. An anchor with more than ``crowd`` distinct segments is too large for a
   shard. Equal windows also have their anchor at the same place, so its
   segments are sliced by that place; all windows of a slice have some bytes
   around the anchor in common, the more the narrower the slice, and the
   slices are dealt to shards by those bytes. Slices that are still crowded
   are sliced again, at last into single windows, whose bytes are all common.
5. The spans found go back to every occurrence, and each document is cut.
"""

from __future__ import annotations

import functools
import re
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.llm.runtime import carried, map_batches, ship, small_batches, steps
from tripgauge.llm.suffixes import permuted_prefixes, suffix_array
from tripgauge.session import drop_stages, materialize

TILE = 1 << 18  # bytes hashed at a time; windows of longer texts are walked tile by tile
STEP = 1 << 20  # text bytes that a worker cuts into segments, or copies, at a time
SHARD = 1 << 19  # segment bytes in one suffix array, but for a larger anchor (up to ``crowd`` segments)
SLICES = (32, 1)  # windows in a slice of a crowded anchor, and in one of a crowded slice
#: 64-bit words of a bloom filter at most (32 MB); beyond that it lets more through.
MAX_WORDS = 1 << 22
_LONG, _INT = T.LongType(), T.IntegerType()


def _fields(*names_types) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in names_types])


def _powers(base: int) -> np.ndarray:
    out = np.full(TILE + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@functools.lru_cache(maxsize=1)
def _hash_tables(seed: int = 1):
    """A polynomial hash modulo 2^64: byte values, powers of the odd base, powers of its inverse."""
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = int(rng.integers(0, 1 << 61)) * 4 + 5
    return values, _powers(base), _powers(pow(base, -1, 1 << 64))


class _Hashes:
    """Hashes of byte ranges of ``data`` (at most a tile)."""

    def __init__(self, data: np.ndarray):
        values, powers, self.inverse = _hash_tables()
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * powers[:len(data)], out=self.prefix[1:])

    def every(self, size: int, stride: int) -> np.ndarray:
        """Those of all ranges of ``size`` bytes that begin at multiples of ``stride``."""
        n = len(self.prefix) - size
        return (self.prefix[size::stride] - self.prefix[:n:stride]) * self.inverse[:n:stride]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _tiles(texts: list[bytes], length: int, stride: int):
    """(texts' numbers, their starts in the text, joined bytes, ends) of buffers of about a tile."""
    held, size = [], 0
    step = TILE // 2 // stride * stride
    for row, text in enumerate(texts):
        for at in range(0, max(0, len(text) - length + 1), step):
            part = text[at:at + step + length - stride]
            if size + len(part) > TILE and held:
                yield held
                held, size = [], 0
            held.append((row, at, part))
            size += len(part)
    if held:
        yield held


def segments(texts: list[bytes], length: int, gram: int, stride: int = 1):
    """Arrays (row, start, bytes, anchor, place) of all segments: maximal runs of windows with one anchor, which begins at
    ``place`` in them. The anchors' hash only has to deal the windows; that segments are equal is told by ``_digests``.
    Windows and anchors begin at multiples of ``stride``, of which all texts, ``length`` and ``gram`` are multiples."""
    out = []
    for held in _tiles(texts, length, stride):
        data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
        ends = np.cumsum([len(p) for _, _, p in held])
        starts = ends - np.array([len(p) for _, _, p in held])
        grams = _mixed(_Hashes(data).every(gram, stride))
        least = grams & np.uint64(0xFFFFFFFF00000000)
        least |= np.arange(len(grams), dtype=np.uint64)  # the leftmost of equals
        width, span = 1, (length - gram) // stride + 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if span > width:
            least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
        begins, stops = starts // stride, (ends - length) // stride + 1  # a text's windows
        cuts = np.unique(np.concatenate([begins, stops, np.flatnonzero(least[1:] != least[:-1]) + 1]))
        part = np.searchsorted(begins, cuts, "right") - 1
        good = np.flatnonzero(cuts < stops[part])  # windows across texts are none
        own, begin, last = part[good], cuts[good], cuts[good + 1] - 1
        at = (least[begin] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        rows, offsets = np.array([r for r, _, _ in held]), np.array([a for _, a, _ in held])
        out.append((rows[own], begin * stride - starts[own] + offsets[own], (last - begin) * stride + length, grams[at].view(np.int64), (at - begin) * stride))
    return [np.concatenate([np.zeros(0, np.int64), *(o[i] for o in out)]) for i in range(5)]


def _digests(parts) -> tuple[np.ndarray, np.ndarray]:
    """XXH3 of 128 bits, as two signed longs, of each byte string."""
    joined = b"".join(map(xxhash.xxh3_128_digest, parts))
    both = np.frombuffer(joined, "<i8").reshape(-1, 2) if joined else np.zeros((0, 2), np.int64)
    return both[:, 0], both[:, 1]


def _bloom(keys: DataFrame, key) -> np.ndarray:
    """Words of a bloom filter over a uniform 64-bit hash: four bits in one word a key. Its size is bounded by MAX_WORDS."""
    hashes = keys.select(key.alias("k"))
    n = hashes.count()
    words = 1
    while words < MAX_WORDS and 4 * words < n:
        words *= 2
    bit = lambda at: F.expr(f"shiftleft(1L, cast(shiftrightunsigned(k, {at}) & 63 as int))")
    made = hashes.select(F.col("k").bitwiseAND(F.lit(words - 1)).alias("w"), bit(40).bitwiseOR(bit(46)).bitwiseOR(bit(52)).bitwiseOR(bit(58)).alias("m"))
    table = made.groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    out = np.zeros(words, np.int64)
    out[table.column("w").to_numpy()] = table.column("m").to_numpy()
    return out.view(np.uint64)


def _passes(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    h = h.view(np.uint64)
    word, six, one = words[(h & np.uint64(len(words) - 1)).astype(np.int64)], np.uint64(63), np.uint64(1)
    need = np.zeros(len(h), np.uint64)
    for at in (40, 46, 52, 58):
        need |= one << ((h >> np.uint64(at)) & six)
    return word & need == need


def _spans(starts: np.ndarray, length: int) -> list[int]:
    """Merged [from, to) pairs, in one list, of the windows at the sorted ``starts``."""
    cut = np.flatnonzero(np.diff(starts) > length)
    return np.column_stack([starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + length]).reshape(-1).tolist() if len(starts) else []


_SPANS = _fields(("anchor", _LONG), ("h1", _LONG), ("h2", _LONG), ("spans", T.ArrayType(_INT)))


def _alike(rows: list[tuple], length: int) -> list[tuple]:
    """Those of one anchor's ``rows`` that may have a window in common, at least one of the two with an open fate.

    Equal windows have the anchor at the same place. So their place in the segment, in steps, and the bytes that all windows
    of the step have in common are equal too: segments whose steps are all unlike the others' have no repeated window.
    """
    step = max(1, length // 16)
    holders: dict[tuple[int, int], list[int]] = {}
    for k, (_, _, _, _, segment, place) in enumerate(rows):
        for q in range((place - len(segment) + length) // step, place // step + 1):
            first = place - q * step
            holders.setdefault((q, xxhash.xxh3_64_intdigest(segment[max(0, first):first - step + 1 + length])), []).append(k)
    kept = {k for held in holders.values() if len(held) > 1 and any(rows[k][3] for k in held) for k in held}
    return [rows[k] for k in sorted(kept)]


def _symbols(joined: bytes, stride: int) -> np.ndarray:
    """Small numbers in the order of the parts of ``stride`` bytes."""
    parts = np.frombuffer(joined, np.uint8).reshape(-1, stride)
    if stride == 1:
        return parts[:, 0]
    number = np.zeros(len(parts), np.int64)
    for column in parts.T:
        number = number << 8 | column
    return np.unique(number, return_inverse=True)[1]


def _shards(length: int, stride: int = 1):
    """Repeated windows of the segments of a partition, sorted by anchor: suffix arrays over whole anchors of about SHARD bytes.
    Windows that begin at multiples of ``stride`` count (up to 7, of which all sizes are multiples); its parts are the characters."""
    arrow = pa.schema([("anchor", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("spans", pa.list_(pa.int32()))])

    def solve(rows):
        sizes = np.array([len(r[4]) // stride for r in rows])
        begins = np.cumsum(sizes + 1) - sizes - 1
        s = np.ones(int(sizes.sum()) + len(rows) + 1, np.int32)
        inner = np.ones(len(s), bool)
        inner[begins + sizes] = inner[-1] = False
        s[inner] = _symbols(b"".join(r[4] for r in rows), stride)
        s[inner] += 2
        s[-1] = 0
        sa = suffix_array(s)
        far = permuted_prefixes(s, sa) >= length // stride
        after = np.zeros(len(s), bool)
        after[sa[:-1]] = far[sa[1:]]
        repeated = np.flatnonzero(far | after)
        owner = np.searchsorted(begins, repeated, "right") - 1
        inside = repeated - begins[owner]
        fits = inside + length // stride <= sizes[owner]
        owner, inside = owner[fits], inside[fits] * stride
        bounds = np.searchsorted(owner, np.arange(len(rows) + 1))
        found = [(r[0], r[1], r[2], _spans(inside[bounds[i]:bounds[i + 1]], length)) for i, r in enumerate(rows) if r[3] and bounds[i] < bounds[i + 1]]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), arrow.types)], schema=arrow)

    def run(batches):
        named = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "h1", "h2", "alone", "segment", "place"))))
        held, size = [], 0
        for _, group in groupby(named, key=lambda row: row[0]):
            some = _alike(list(group), length)
            held += some
            size += sum(len(row[4]) for row in some)
            if size > SHARD:
                yield from solve(held)
                held, size = [], 0
        if held:
            yield from solve(held)

    return run


def _fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of ``wanted`` (anchor, h1, h2, alone, place, doc, body, start, bytes) from their documents; documents without any don't move."""
    filled = docs.sparkSession.sparkContext.broadcast(_bloom(wanted.select("doc", "body").distinct(), F.xxhash64("doc", "body")))
    lists = wanted.groupBy("doc", "body").agg(F.collect_list(F.struct("anchor", "h1", "h2", "alone", "place", "start", "bytes")).alias("list"))
    joined = _sifted(docs, filled).join(lists, ["doc", "body"]).select("text", "list")
    schema = _fields(("anchor", _LONG), ("h1", _LONG), ("h2", _LONG), ("alone", T.BooleanType()), ("place", _INT), ("segment", T.BinaryType()))

    def cut(batch):
        for part, texts in steps(batch, "text", STEP):
            lists = part.column(1)
            flat = lists.flatten()
            owner = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy()).tolist()
            start, size = flat.field("start").to_pylist(), flat.field("bytes").to_pylist()
            yield {c: flat.field(c) for c in ("anchor", "h1", "h2", "alone", "place")} | {"segment": [texts[o][a:a + n] for o, a, n in zip(owner, start, size)]}

    return map_batches(joined, cut, schema)


def _slim(batch: pa.RecordBatch):
    """Parts of a batch of documents, so that what a filter copies stays small."""
    return (batch.slice(start, 512) for start in range(0, batch.num_rows, 512))


def _sifted(docs: DataFrame, filled, by: tuple[str, str] = ("doc", "body")) -> DataFrame:
    """Documents that may be in the bloom filter of their key."""
    def run(batches):
        for batch in batches:
            for part in _slim(batch):
                yield part.filter(pa.array(_passes(filled.value, part.column(part.num_columns - 1).to_numpy())))

    keyed = docs.withColumn("_key", F.xxhash64(*by))
    return keyed.mapInArrow(run, keyed.schema).drop("_key")


def _several(distinct: DataFrame, crowd: int, made: list[str]) -> DataFrame:
    """(anchor, crowded) of the anchors with several distinct segments, one of them at least with an open fate."""
    several = distinct.groupBy("anchor").agg(F.count("*").alias("n"), F.max("alone").alias("open")).filter("n > 1 AND open")
    return materialize(several.select("anchor", (F.col("n") > crowd).alias("crowded")), "shared_anchors", made)


def _slices(fetched: DataFrame, length: int, width: int) -> DataFrame:
    """The slices of crowded segments: whose (anchor, h1, h2, alone), from where, their new anchor (the hash of the bytes that all
    windows of the slice have in common) and its place, their digests and bytes."""
    schema = _fields(("_anchor", _LONG), ("_h1", _LONG), ("_h2", _LONG), ("alone", T.BooleanType()), ("_from", _INT), ("anchor", _LONG), ("place", _INT),
                     ("h1", _LONG), ("h2", _LONG), ("segment", T.BinaryType()))

    def run(batch):
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            owner, begins, anchors, places, bodies = [], [], [], [], []
            for k, (place, segment) in enumerate(zip(part.column("place").to_pylist(), part.column("segment").to_pylist())):
                last = len(segment) - length  # the windows begin at 0 to last, the anchor ``place`` behind the segment's begin
                for q in range((place - last) // width, place // width + 1):
                    a, b = max(0, place - (q + 1) * width + 1), min(last, place - q * width)
                    if a > b:
                        continue
                    common = segment[place - q * width:place - (q + 1) * width + 1 + length]
                    owner.append(k)
                    begins.append(a)
                    anchors.append(xxhash.xxh3_64_intdigest(common, q))
                    places.append(place - a)
                    bodies.append(segment[a:b + length])
            h1, h2 = _digests(bodies)
            at = pa.array(owner, pa.int64())
            yield {"_" + c: part.column(c).take(at) for c in ("anchor", "h1", "h2")} | {
                "alone": part.column("alone").take(at), "_from": begins, "anchor": np.array(anchors, np.uint64).view(np.int64), "place": places,
                "h1": h1, "h2": h2, "segment": pa.array(bodies, pa.binary())}

    return map_batches(fetched, run, schema)


def _crowded(fetched: DataFrame, length: int, crowd: int, made: list[str], widths: tuple[int, ...] = SLICES) -> DataFrame:
    """The spans of segments whose anchor has too many of them for a shard: sliced, and the slices solved like segments."""
    rows = materialize(_slices(fetched, length, widths[0]), "slices", made)
    key = ["anchor", "h1", "h2"]
    distinct = rows.groupBy(*key).agg(F.count("*").alias("n"), F.max("alone").alias("open"), F.min("alone").alias("all"), F.min("place").alias("place"))
    # A slice that is also elsewhere, in whatever segment, repeats whole; so do those of segments that do.
    distinct = materialize(distinct.select(*key, ((F.col("n") == 1) & F.col("all")).alias("alone"), "open", "place"), "distinct_slices", made)
    several = _several(distinct, crowd, made)
    texts = rows.groupBy(*key).agg(F.min("segment").alias("segment"))
    wanted = distinct.join(several, "anchor").join(texts, key)
    spans = _by_shard(wanted.filter("NOT crowded"), length)
    if several.filter("crowded").limit(1).count():
        spans = spans.unionByName(_crowded(wanted.filter("crowded"), length, crowd, made, widths[1:]))
    size = rows.filter("alone").groupBy(*key).agg(F.max(F.octet_length("segment")).alias("size"))
    whole = distinct.filter("NOT alone AND open").join(size, key).select(*key, F.array(F.lit(0), F.col("size")).alias("spans"))
    found = materialize(spans.unionByName(whole), "slice_spans", made)
    back = rows.filter("alone").select("_anchor", "_h1", "_h2", "_from", *key).join(found, key)
    lists = back.groupBy("_anchor", "_h1", "_h2").agg(F.collect_list(F.struct(F.col("_from").alias("start"), "spans")).alias("list"))  # as many as a segment has slices

    def merge(batch):
        yield {c: batch.column("_" + c) for c in ("anchor", "h1", "h2")} | {"spans": [_united(found) for found in batch.column("list")]}

    return map_batches(lists, merge, _SPANS)


def _united(found) -> list[int]:
    """Merged [from, to) pairs, in one list, of a list of (start, spans)."""
    parts = found.values
    spans = parts.field("spans")
    pairs = spans.flatten().to_numpy().reshape(-1, 2) + np.repeat(parts.field("start").to_numpy(), spans.value_lengths().to_numpy() // 2)[:, None]
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    first = np.flatnonzero(np.append(True, pairs[1:, 0] > reach[:-1]))
    return np.column_stack([pairs[first, 0], reach[np.append(first[1:], len(pairs)) - 1]]).reshape(-1).tolist()


def _by_shard(fetched: DataFrame, length: int, stride: int = 1) -> DataFrame:
    rows = fetched.select("anchor", "h1", "h2", "alone", "segment", "place")
    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_shards(length, stride), _SPANS)


def _covered(base: DataFrame, length: int, gram: int, crowd: int, stride: int = 1, out: list[str] | None = None) -> DataFrame:
    """(doc, body, cuts, covered) of the rows of ``base`` (doc, body, text) with strings of ``length`` bytes that also start elsewhere:
    the merged [from, to) pairs of the bytes they cover, in one list, and their number. With a ``stride`` only strings that begin
    at its multiples count (see ``segments``). Rows equal in doc and body have equal texts. ``out`` gets the result's path."""
    spark, made = base.sparkSession, []
    base = base.filter(F.octet_length("text") >= length)

    def cut(batch):
        for part, texts in steps(batch, "text", STEP):
            row, start, size, anchor, place = segments(texts, length, gram, stride)
            h1, h2 = _digests(texts[r][a:a + n] for r, a, n in zip(row.tolist(), start.tolist(), size.tolist()))
            at = pa.array(row)
            yield {"anchor": anchor, "h1": h1, "h2": h2, "doc": part.column(0).take(at), "body": part.column(1).take(at),
                   "start": start, "bytes": size, "place": place}

    # Texts are hashed once: all segments are written, without their bytes, and those of anchors that occur once dropped from the table.
    shape = _fields(("anchor", _LONG), ("h1", _LONG), ("h2", _LONG), ("doc", _LONG), ("body", _LONG), ("start", _INT), ("bytes", _INT), ("place", _INT))
    unsifted: list[str] = []
    every = materialize(map_batches(base, cut, shape), "all_segments", unsifted)
    again = every.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    again = materialize(again.select("anchor"), "anchors", made)
    listed = spark.sparkContext.broadcast(_bloom(again, F.col("anchor")))

    def may(batches):
        for batch in batches:
            yield batch.filter(pa.array(_passes(listed.value, batch.column(0).to_numpy())))

    rows = materialize(every.mapInArrow(may, shape), "segments", made)
    drop_stages(spark, unsifted)
    key = ["anchor", "h1", "h2"]
    # ``first`` takes all its columns from one row, as each is set by the first row a key meets; a struct would be aggregated by sorting.
    one = [F.first(c).alias(c) for c in ("bytes", "doc", "body", "start", "place")]
    distinct = rows.groupBy(*key).agg(F.count("*").alias("n"), *one)
    distinct = materialize(distinct.select(*key, (F.col("n") == 1).alias("alone"), "bytes", "doc", "body", "start", "place"), "distinct_segments", made)
    several = _several(distinct, crowd, made)
    # Written, as a filter and a join are made of each half.
    wanted = materialize(distinct.join(several, "anchor"), "wanted_segments", made)
    spans = _by_shard(_fetch(base, wanted.filter("NOT crowded")), length, stride)
    if several.filter("crowded").limit(1).count():
        spans = spans.unionByName(_crowded(_fetch(base, wanted.filter("crowded")), length, crowd, made))
    whole = distinct.filter("NOT alone").select(*key, F.array(F.lit(0), F.col("bytes")).alias("spans"))
    spans = materialize(spans.unionByName(whole), "segment_spans", made)
    lists = rows.join(spans, key).groupBy("doc", "body").agg(F.collect_list(F.struct("start", "spans")).alias("list"))

    def union(batch):
        cuts = [_united(found) for found in batch.column("list")]
        yield {"doc": batch.column("doc"), "body": batch.column("body"), "cuts": cuts, "covered": [sum(c[1::2]) - sum(c[::2]) for c in cuts]}

    cuts = materialize(map_batches(lists, union, _fields(("doc", _LONG), ("body", _LONG), ("cuts", T.ArrayType(_LONG)), ("covered", _LONG))), "cuts", out)
    drop_stages(spark, made)  # only the cuts are read from here on
    return cuts


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, gram: int = 64, crowd: int = 2048,
                   stride: int = 1, made: list[str] | None = None) -> DataFrame:
    """All rows with ``n_bytes``, ``n_removed``, ``n_spans`` (long) and ``kept`` (binary): the text's UTF-8 bytes without those
    covered by a string of ``length`` bytes that also starts anywhere else, in any row.

    Strings are judged on the input and never cross rows; overlapping ones count. A null text is empty. Repeated rows are
    each other's copies and lose all such strings. Rows with a null id take part like others. Texts are read whole, tile by
    tile. Input columns of the new names are replaced. An empty table gives an empty one. The text may be binary;
    with a ``stride`` only strings that begin at its multiples count (see ``segments``). ``made`` gets the paths of the tables
    that the result reads, for ``drop_stages``. Who runs the result inside ``small_batches`` saves executors memory.
    """
    spark = docs.sparkSession
    ship(spark)
    passed = carried(docs, {"n_bytes", "n_removed", "n_spans", "kept"})
    # Rows are told apart by id and text; rows equal in both have equal results.
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63) + 1)).alias("doc"), F.xxhash64(text_col).alias("body"), F.col(text_col).alias("text"))
    with small_batches(spark):
        cuts = _covered(base, length, gram, crowd, stride, made).select("doc", "body", "cuts")
    filled = spark.sparkContext.broadcast(_bloom(cuts, F.xxhash64("doc", "body")))
    by, names = ("_doc", "_body"), [f.name for f in passed]
    named = docs.select(*names, F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63) + 1)).alias("_doc"), F.xxhash64(text_col).alias("_body"))
    hit = _sifted(named, filled, by).join(cuts.toDF("_doc", "_body", "_cuts"), list(by), "left").select(*names, "_cuts")
    clear = named.withColumn("_key", F.xxhash64(*by))
    schema = T.StructType([*passed, *_fields(("n_bytes", _LONG), ("n_removed", _LONG), ("n_spans", _LONG), ("kept", T.BinaryType())).fields])

    def finish(batch, cuts_of=lambda part: part.column(part.num_columns - 1).to_pylist()):
        for part, texts in steps(batch, text_col, STEP):
            gone, count, kept = [], [], []
            for text, cuts in zip(texts, cuts_of(part)):
                edges = [0, *(cuts or []), len(text)]
                rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                gone.append(len(text) - len(rest))
                count.append(len(cuts or []) // 2)
                kept.append(rest)
            yield {f.name: part.column(k) for k, f in enumerate(passed)} | {"n_bytes": [len(t) for t in texts], "n_removed": gone, "n_spans": count, "kept": kept}

    def uncut(batch):  # sifts and finishes in one pass, by one Python worker a task
        for few in _slim(batch):
            surely = ~_passes(filled.value, few.column(few.num_columns - 1).to_numpy())
            yield from finish(few.filter(pa.array(surely)), lambda part: [None] * part.num_rows)

    return map_batches(hit, finish, schema).unionByName(map_batches(clear, uncut, schema))


#: Bytes that stand for a word: a hash, so words that differ in a passage of 51 words go unseen once in 16 million.
CODE = 3


_WHITE = np.isin(np.arange(256), [*range(0x09, 0x0E), 0x20])
_GAP = re.compile(rb"[\x09-\x0D\x20]")


def _word_codes(texts: list[bytes]) -> list[bytes]:
    """The codes of each text's words: polynomial hashes of all words of about a tile at a time."""
    values, powers, _ = _hash_tables()
    joined = b" ".join([*texts, b""])
    begins, codes, at = [], [], 0
    while at < len(joined):
        stop = _GAP.search(joined, min(at + TILE, len(joined) - 1)).end()
        data = np.frombuffer(joined, np.uint8, stop - at, at)
        white = _WHITE[data]
        edges = np.flatnonzero(np.diff(white, prepend=True))
        first, size = edges[::2], edges[1::2] - edges[::2]
        if len(first):
            begin = np.cumsum(size) - size
            place = np.arange(int(size.sum())) - np.repeat(begin, size)
            hashes = np.add.reduceat(values[data[~white]] * powers[place % TILE], begin)
            codes.append(_mixed(hashes + size.astype(np.uint64)) >> np.uint64(64 - 8 * CODE))
            begins.append(first + at)
        at = stop
    begins = np.concatenate([np.zeros(0, np.int64), *begins])
    raw = np.concatenate([np.zeros(0, np.uint64), *codes]).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :CODE].tobytes()
    bounds = CODE * np.searchsorted(begins, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    return [raw[a:b] for a, b in pairwise(bounds.tolist())]


def passages(docs: DataFrame, text_col: str = "text", words: int = 51, crowd: int = 2048, made: list[str] | None = None) -> DataFrame:
    """The rows without the text, with ``n_words`` and ``n_passage_words``: the words covered by a passage of ``words`` words that
    also begins anywhere else, in any row.

    Words are parted by white space (x20, x09 to x0D); a passage is a sequence of words, whatever white space is between
    them. The method is that of ``remove_repeats``, on texts in which a code of 3 bytes stands for a word. Nulls are empty.
    ``made`` gets the paths of the tables that the result reads, for ``drop_stages``.
    """
    names = [c for c in docs.columns if c not in (text_col, "n_words", "n_passage_words", "codes")]
    source = docs.select(*names, text_col)
    fields = [f for f in source.schema.fields if f.name in names]
    schema = T.StructType([*fields, T.StructField("n_words", _LONG), T.StructField("codes", T.BinaryType())])

    def run(batch):
        for part, texts in steps(batch, text_col, STEP):
            coded = _word_codes(texts)
            yield {f.name: part.column(k) for k, f in enumerate(fields)} | {"n_words": [len(c) // CODE for c in coded], "codes": pa.array(coded, pa.binary())}

    with small_batches(docs.sparkSession):
        coded = materialize(map_batches(source, run, schema).withColumn("_row", F.monotonically_increasing_id()), "word_codes", made)
        base = coded.select(F.col("_row").alias("doc"), F.lit(0).cast("long").alias("body"), F.col("codes").alias("text"))
        found = _covered(base, words * CODE, 8 * CODE, crowd, CODE, made)
    found = found.select(F.col("doc").alias("_row"), (F.col("covered") / CODE).cast("long").alias("n_passage_words"))
    # Only the counts are joined; no text moves.
    return coded.select(*names, "n_words", "_row").join(found, "_row", "left").select(*names, "n_words", F.coalesce("n_passage_words", F.lit(0)).cast("long").alias("n_passage_words"))
