"""SimHash near-dedup: fingerprints, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.llm.blocks import compare, deal, forest
from tripgauge.llm.components import components
from tripgauge.llm.runtime import carried, map_batches, steps
from tripgauge.session import materialize

SEED = 42  # of XXH64


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """The 64-bit SimHash of the word shingles, repeats included; 0 without words."""
    words = text.lower().split()  # bytes: A-Z only, white space x20 and x09 to x0D
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    count, n = np.zeros(64, np.int64), len(words) - width + 1
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        stop = min(n, at + (1 << 16))
        a, b = starts[at:stop].tolist(), ends[at + width - 1:stop + width - 1].tolist()
        h = np.fromiter((digest(line[i:j], SEED) for i, j in zip(a, b)), np.uint64, stop - at)
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, keep: Sequence[str] = ()) -> DataFrame:
    """(id, the columns in ``keep``, simhash): the fingerprint of every row's whole text as a signed long; a null text has no words."""
    passed = [id_col, *keep]
    schema = T.StructType([*carried(docs.select(*passed), set()), T.StructField("simhash", T.LongType())])

    def run(batch):
        for part, texts in steps(batch, text_col):
            made = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield {c: part.column(k) for k, c in enumerate(passed)} | {"simhash": made}

    return map_batches(docs.select(*passed, text_col), run, schema)


def _masks(bits: int, distance: int, agree: int) -> list[int]:
    """Bit masks of every choice of ``agree`` blocks out of distance + agree: two fingerprints within ``distance`` bits agree on one."""
    parts = np.array_split(np.arange(bits), distance + agree)
    return [sum(1 << int(b) for p in chosen for b in p) for chosen in combinations(parts, agree)]


def links(marks: DataFrame, distance: int = 4, agree: int = 2, limit: int = 4096) -> DataFrame:
    """Spanning links (u, v) of the graph over distinct (rep, simhash) rows whose fingerprints differ in up to ``distance`` bits.

    Fingerprints are cut into distance + agree blocks; any two that are close agree on ``agree`` blocks, so they meet in
    a bucket of one of the choices. Larger buckets than ``limit`` are compared chunk by chunk, all of them.
    """
    masks = [m - (1 << 64) if m >> 63 else m for m in _masks(64, distance, agree)]
    keys = F.array(*(F.struct(F.lit(k).alias("_mask"), F.col("simhash").bitwiseAND(F.lit(m)).alias("_part")) for k, m in enumerate(masks)))
    rows = marks.select("rep", "simhash", F.explode(keys).alias("_k")).select("rep", "simhash", "_k._mask", "_k._part")
    schema = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])

    def check(table, bounds):
        rep = table.column("rep").combine_chunks().to_numpy()
        mark = table.column("simhash").combine_chunks().to_numpy().view(np.uint64)
        size = np.diff(bounds)
        u, v = [], []
        small = np.repeat(size <= 32, size)
        block = np.repeat(np.arange(len(size)), size)
        for d in range(1, 32):  # neighbours at distance d within all small blocks at once
            a = np.flatnonzero(small[:-d] & (block[d:] == block[:-d])) if d < len(mark) else np.zeros(0, int)
            if not len(a):
                break
            a = a[np.bitwise_count(mark[a] ^ mark[a + d]) <= distance]
            u.append(rep[a])
            v.append(rep[a + d])
        for b in np.flatnonzero(size > 32).tolist():
            own, ids = mark[bounds[b]:bounds[b + 1]], rep[bounds[b]:bounds[b + 1]]
            found = np.array(forest(lambda i, rest: np.bitwise_count(own[rest] ^ own[i]) <= distance, len(own)), np.int64).reshape(-1, 2)  # noqa: B023
            u.append(ids[found[:, 0]])
            v.append(ids[found[:, 1]])
        yield {"u": np.concatenate([np.zeros(0, np.int64), *u]), "v": np.concatenate([np.zeros(0, np.int64), *v])}

    return compare(deal(rows, ["_mask", "_part"], "simhash", limit), ["_mask", "_part"], check, schema)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4,
                    keep: Sequence[str] = ()) -> DataFrame:
    """(id, simhash, component_id, the columns in ``keep``) for every row: rows whose fingerprints are within ``distance`` bits are linked.

    component_id is the smallest id reachable. Equal fingerprints (copies, texts without words) are one class that stands
    for all its rows, so a huge group of copies costs one row in the comparison. Null and empty texts have fingerprint 0
    and link like any other. Repeated rows stay and share their component. A row with a null id keeps its fingerprint and
    has a null component unless its class has other rows; it names no component. An empty table gives an empty one. The id
    must be an integer; only it and the text are read, so clashing column names don't matter.
    """
    made = materialize(fingerprints(docs, id_col, text_col, shingle, keep), "fingerprints")
    marks = materialize(made.groupBy("simhash").agg(F.min(F.col(id_col).cast("long")).alias("rep")), "marks")
    found = components(links(marks.filter("rep is not null"), distance))
    named = marks.join(found, marks["rep"] == found["node"], "left").select("simhash", F.coalesce("component", "rep").alias("component_id"))
    return made.join(named, "simhash").select(id_col, "simhash", "component_id", *keep)
