"""Line dedup: range-partitioned hashes sorted by document and position, streamed; compressed keep bitmaps come back.

Line hashes with their document and position are range-partitioned by (hash,
document) and sorted with the largest document first. A pass over each sorted
partition keeps the first document of a hash and drops the others once a third
one has been seen. A very common line simply spans several partitions; what a
partition can't decide by itself (its first and last hash) is settled by one or
two summary rows a partition.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.llm.runtime import carried, map_batches, ship, steps
from tripgauge.session import materialize

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
LINE = T.StructType([T.StructField(n, t) for n, t in (("h1", T.LongType()), ("h2", T.LongType()), ("doc", T.LongType()), ("body", T.LongType()),
                                                      ("pos", T.IntegerType()), ("n_lines", T.IntegerType()))])
#: What a streamed partition says: a line that goes, a line whose hash other partitions may decide, the count of a hash at its edge.
DROP, OPEN, EDGE = 0, 1, 2
SAID = T.StructType([T.StructField("state", T.IntegerType()), *LINE.fields, T.StructField("n_docs", T.LongType())])


def _hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line whose key has at least ``min_chars`` code points. body: hash of the whole text, which tells rows of one id apart."""
    source = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("body"))

    def run(batch):
        for part, texts in steps(batch, "text"):
            row, pos, total, digests = [], [], [], []
            for i, text in enumerate(texts):
                lines = text.split(b"\n")
                for k, line in enumerate(lines):
                    if len(line) >= min_chars:
                        key = line.strip(SPACE).lower()
                        if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
                            row.append(i)
                            pos.append(k)
                            total.append(len(lines))
                            digests.append(xxhash.xxh3_128_digest(key))
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            at = pa.array(row, pa.int64())
            yield {"h1": halves[:, 0], "h2": halves[:, 1], "doc": part.column(0).take(at), "body": part.column(2).take(at), "pos": pos, "n_lines": total}

    return map_batches(source, run, LINE)


def _stream(least: int):
    """The pass over one sorted partition; ``least`` documents make a line repeated."""
    arrow = pa.schema([("state", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("body", pa.int64()), ("pos", pa.int32()),
                       ("n_lines", pa.int32()), ("n_docs", pa.int64())])

    def say(state, table, rows):
        n = len(rows)
        part = table.take(pa.array(rows))
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, state, np.int32)), *(part.column(c).cast(arrow.field(c).type) for c in arrow.names[1:7]),
                                           pa.array(np.zeros(n, np.int64))], schema=arrow)

    def edge(key, top, n):
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((EDGE, *key, top, 0, 0, 0, n), arrow.types)], schema=arrow)

    def run(batches):
        first = key = doc = top = None
        rank = -1  # of the document among those of the key, from 0
        waiting: list[pa.RecordBatch] = []  # lines of the key's documents 1 to least - 2: they go if enough documents follow
        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, docs = (batch.column(c).to_numpy() for c in ("h1", "h2", "doc"))
            if key is None:
                first = (int(h1[0]), int(h2[0]))
            new_key = np.append(key is None or (h1[0], h2[0]) != key, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
            new_doc = new_key | np.append(doc is None or docs[0] != doc, docs[1:] != docs[:-1])
            seen = np.cumsum(new_doc)
            group = np.cumsum(new_key)  # 0: the key of the batch before
            base = np.concatenate([[-rank], seen[new_key]])  # seen at the start of each key of this batch
            ranks = seen - base[group]
            heads = np.flatnonzero(new_key)
            opened = (h1 == first[0]) & (h2 == first[1]) if first else np.zeros(len(h1), bool)
            if opened.any():
                yield say(OPEN, batch, np.flatnonzero(opened))
            top_rank = np.full(group[-1] + 1, -1, np.int64)
            np.maximum.at(top_rank, group, ranks)
            if waiting and (top_rank[0] >= least - 1 if (group == 0).any() else False):
                yield from waiting
                waiting = []
            if heads.size and key is not None:  # the key of the batch before has ended
                if key == first:
                    yield edge(key, top, int(max(rank, top_rank[0])) + 1)
                waiting = []
            gone = ~opened & (ranks >= 1) & (ranks <= least - 2) & (top_rank[group] >= least - 1) | ~opened & (ranks >= least - 1)
            if gone.any():
                yield say(DROP, batch, np.flatnonzero(gone))
            last = group == group[-1]
            if not opened[-1] and top_rank[-1] < least - 1:
                rows = np.flatnonzero(last & (ranks >= 1))
                if len(rows):
                    waiting.append(say(DROP, batch, rows))
            if heads.size:
                if first is not None and opened[0] and key is None and group[-1] > 1:  # the first key began and ended in this batch
                    yield edge(first, int(docs[0]), int(top_rank[1]) + 1)
                top = int(docs[heads[-1]])
            key, doc, rank = (int(h1[-1]), int(h2[-1])), docs[-1], int(ranks[-1])
        if key is not None:
            yield edge(key, top, rank + 1)
            for held in waiting if key != first else []:  # a later partition may hold the documents that are missing
                yield held.set_column(0, "state", pa.array(np.full(held.num_rows, OPEN, np.int32)))

    return run


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc, body, n_lines, n_dropped, bitmap) of every document that loses a line.

    A line's key is the line without surrounding white space, A-Z lower-cased. Keys of ``min_chars`` code points or more
    in ``min_docs`` documents or more lose all lines but those of the largest id. body is the hash of the document's text;
    bitmap is the zlib-compressed bit per line (1: stays). Equal ids count as one document; rows with a null id count for
    nothing and lose nothing. Keys are compared by a 128-bit hash.
    """
    ship(docs.sparkSession)
    by = ["h1", "h2", F.col("doc").desc()]
    lines = _hashes(docs, id_col, text_col, min_chars)
    said = lines.repartitionByRange(*by).sortWithinPartitions(*by, "body", "pos").mapInArrow(_stream(min_docs), SAID)
    said = materialize(said, "line_decisions")
    # At most two summary rows a partition, so few enough to broadcast.
    edges = said.filter(F.col("state") == EDGE).groupBy("h1", "h2").agg(F.sum("n_docs").alias("_n"), F.max("doc").alias("_top"))
    settled = said.filter(F.col("state") == OPEN).join(F.broadcast(edges), ["h1", "h2"]).filter((F.col("_n") >= min_docs) & (F.col("doc") != F.col("_top")))
    names = ("doc", "body", "pos", "n_lines")
    gone = said.filter(F.col("state") == DROP).select(*names).unionByName(settled.select(*names))
    lost = gone.groupBy("doc", "body").agg(F.max("n_lines").alias("n_lines"), F.collect_set("pos").alias("lost"))
    schema = T.StructType([T.StructField("doc", T.LongType()), T.StructField("body", T.LongType()), T.StructField("n_lines", T.IntegerType()),
                           T.StructField("n_dropped", T.LongType()), T.StructField("bitmap", T.BinaryType())])

    def pack(batch):
        bitmaps, dropped = [], []
        for n, lost in zip(batch.column(2).to_pylist(), batch.column(3)):
            keep = np.ones(n, bool)
            keep[lost.values.to_numpy()] = False
            bitmaps.append(zlib.compress(np.packbits(keep).tobytes()))
            dropped.append(len(lost))
        yield {"doc": batch.column(0), "body": batch.column(1), "n_lines": batch.column(2), "n_dropped": dropped, "bitmap": bitmaps}

    return map_batches(lost, pack, schema)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All rows with the text that ``keep_bitmaps`` leaves, and ``n_lines`` and ``n_dropped`` (long).

    A null text is one empty line and stays null. Row counts, repeated rows and other columns
    stay; input columns ``n_lines`` and ``n_dropped`` are replaced. An empty table gives an empty one.
    """
    maps = keep_bitmaps(docs, id_col, text_col, min_chars, min_docs).select(
        F.col("doc").alias("_doc"), F.col("body").alias("_body"), F.col("bitmap").alias("_bitmap"))
    passed = carried(docs, {"n_lines", "n_dropped"})
    rows = docs.select(*(f.name for f in passed)).withColumn("_hash", F.xxhash64(text_col))
    joined = rows.join(maps, (rows[id_col].cast("long") == maps["_doc"]) & (rows["_hash"] == maps["_body"]), "left").select(*(f.name for f in passed), "_bitmap")
    schema = T.StructType([*passed, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def cut(batch):
        for part, texts in steps(batch, text_col):
            column = {f.name: part.column(k) for k, f in enumerate(passed)}
            total, dropped, changed = [], [], {}
            for i, (text, bitmap) in enumerate(zip(texts, part.column(len(passed)).to_pylist())):
                total.append(text.count(b"\n") + 1)
                dropped.append(0)
                if bitmap is not None:
                    lines = text.split(b"\n")
                    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
                    changed[i] = b"\n".join([line for line, k in zip(lines, keep.tolist()) if k]).decode()
                    dropped[-1] = int(len(lines) - keep.sum())
            if changed:
                values = column[text_col].to_pylist()
                for i, text in changed.items():
                    values[i] = text
                column[text_col] = values
            yield column | {"n_lines": total, "n_dropped": dropped}

    return map_batches(joined, cut, schema)
