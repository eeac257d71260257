"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens. Full pieces are
sequences of their own. The others are dealt to regions of bounded size; on
each region several islands (Spark groups) evolve packings. A packing's genes
are its bins: crossover injects the well-filled bins of one parent whole into
the other, drops the bins that now hold duplicates, and puts their displaced
documents back by best fit. After an epoch each island's elite migrates to the
next island of its region. The best island's full enough bins are kept; the
documents of the other bins meet again in fewer regions for another round.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.llm.bpe import STEP, codec
from tripgauge.llm.runtime import carried, map_batches, ship, steps
from tripgauge.session import materialize


def pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length and ids_crc32 (of the little-endian unsigned 32-bit ids).

    A document is its ids and ``end_id``; a null text is empty. Longer ones are cut into pieces of ``capacity``; the
    first takes what is over. Repeated rows give repeated pieces.
    """
    source = docs.select(id_col, text_col)
    schema = T.StructType([*carried(docs.select(id_col), set()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batch):
        for part, texts in steps(batch, text_col, STEP):
            owner, number, start, length, crc = [], [], [], [], []
            for row, ids in enumerate(codec(path).encode(texts)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                for k, (a, b) in enumerate(zip([0, *range(first, len(ids), capacity)], range(first, len(ids) + 1, capacity))):
                    owner.append(row)
                    number.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
            yield {id_col: part.column(0).take(np.array(owner, np.int64)), "piece": number, "start": start, "length": length, "ids_crc32": crc}

    return map_batches(source, run, schema)


class _Bins:
    """A packing: the bin of each item and the load of each bin; empty bins have load 0."""

    def __init__(self, where: np.ndarray, load: np.ndarray):
        self.where, self.load = where, load

    def fitness(self, capacity: int) -> tuple[int, float]:
        used = self.load[self.load > 0]
        return -len(used), float(((used / capacity) ** 2).mean()) if len(used) else 0.0


def _best_fit(lengths: list[int], order: list[int], where: np.ndarray, loads: list[int], capacity: int) -> _Bins:
    """Puts the items in ``order`` into the fullest bins that hold them, opening bins as needed."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for b, load in enumerate(loads):
        if 0 < load < capacity:
            room[capacity - load].append(b)
            mask |= 1 << (capacity - load)
    for i in order:
        need = lengths[i]
        fits = mask >> need
        if fits:
            gap = need + (fits & -fits).bit_length() - 1
            b = room[gap].pop()
            if not room[gap]:
                mask ^= 1 << gap
        else:
            gap, b = capacity, len(loads)
            loads.append(0)
        loads[b] += need
        where[i] = b
        if gap > need:
            room[gap - need].append(b)
            mask |= 1 << (gap - need)
    return _Bins(where, np.array(loads, np.int64))


def evolve(lengths: np.ndarray, seeds: list[np.ndarray], capacity: int, seed: int, population: int = 4, children: int = 10) -> np.ndarray:
    """The bin of each item after one epoch. ``seeds``: packings to begin with (an island's elite and the one that migrated)."""
    rng, sizes = np.random.default_rng(seed), lengths.tolist()
    n = len(sizes)
    stock = [_Bins(s.copy(), np.bincount(s, lengths).astype(np.int64)) for s in seeds]
    while len(stock) < population:
        noise = rng.random(n) * (capacity * 0.05 * len(stock))
        order = np.argsort(-(lengths + noise), kind="stable").tolist()
        stock.append(_best_fit(sizes, order, np.full(n, -1, np.int64), [], capacity))
    for _ in range(children):
        stock.sort(key=lambda p: p.fitness(capacity), reverse=True)
        bound = -(-int(lengths.sum()) // capacity)
        if -stock[0].fitness(capacity)[0] <= bound:
            break
        a, b = rng.choice(len(stock), 2, replace=False)
        receiver, donor = stock[a], stock[b]
        live = np.flatnonzero(donor.load > 0)
        good = live[donor.load[live] >= np.quantile(donor.load[live], 0.5)]
        chosen = rng.choice(good, max(1, len(good) // 2), replace=False)
        inject = np.isin(donor.where, chosen)
        hit = np.unique(receiver.where[inject])  # bins of the receiver that hold duplicates
        weak = np.flatnonzero((receiver.load > 0) & (receiver.load < capacity))
        if len(weak):  # mutation: some of the bins that aren't full are emptied
            hit = np.union1d(hit, rng.choice(weak, max(1, len(weak) // 2), replace=False))
        displaced = np.isin(receiver.where, hit) & ~inject
        loads = receiver.load.copy()
        loads[hit] = 0
        where = receiver.where.copy()
        slot = {int(c): len(loads) + k for k, c in enumerate(chosen)}
        where[inject] = [slot[int(c)] for c in donor.where[inject]]
        loads = [*loads.tolist(), *donor.load[chosen].tolist()]
        out = np.flatnonzero(displaced)
        out = out[np.argsort(-lengths[out] - rng.random(len(out)) * 8, kind="stable")].tolist()
        child = _best_fit(sizes, out, where, loads, capacity)
        child.where = np.unique(child.where, return_inverse=True)[1].reshape(-1)
        child.load = np.bincount(child.where, lengths).astype(np.int64)
        stock[-1] = child
    best = max(stock, key=lambda p: p.fitness(capacity))
    return np.unique(best.where, return_inverse=True)[1].reshape(-1)


def pack(items: DataFrame, capacity: int = 1024, region_size: int = 4096, islands: int = 2, epochs: int = 2, rounds: int = 3,
         slack: int = 0) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    Every row gets a place; a sequence's rows fill it from 0 without gaps, in no particular order of documents. Bins with
    more than ``slack`` free tokens are packed again in each further round, in fewer regions. Rows of equal length, and
    repeated rows, are packed one by one. Regions are dealt by a hash of the row's place in the written table, so no key
    can be hot. An empty table gives an empty one. Input columns ``sequence_id`` and ``offset`` are replaced.
    """
    if not 1 <= rounds <= 7:
        raise ValueError("1 to 7 rounds: a sequence's number holds the round in three bits")
    spark = items.sparkSession
    ship(spark)
    kept = [f.name for f in carried(items, {"sequence_id", "offset"})]
    rows = materialize(items.select(*kept).withColumn("_row", F.monotonically_increasing_id()), "pack_items")
    full = rows.filter(F.col("length") >= capacity).withColumn("sequence_id", F.col("_row") * 8).withColumn("offset", F.lit(0).cast("long"))
    # Only (row, length) travels through the rounds.
    todo = rows.filter(F.col("length") < capacity).select("_row", "length")
    shape = "_row long, length long, region int, island int, bin long, bins long"

    def settle(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_row", kind="stable", ignore_index=True)
        island = int(key[1])
        if "came" in frame:  # one copy of each row for every packing that arrived
            groups = [g.reset_index(drop=True) for _, g in frame.groupby("came")]
            seeds, frame = [g["bin"].to_numpy() for g in groups], groups[0]
        else:
            seeds = []
        lengths = frame["length"].to_numpy()
        where = evolve(lengths, seeds, capacity, 7919 * int(key[0]) + 31 * island + len(seeds))
        return pd.DataFrame({"_row": frame["_row"], "length": lengths, "region": int(key[0]), "island": island, "bin": where, "bins": int(where.max()) + 1})

    placed = None
    for turn in range(rounds):
        count = todo.count()
        if not count:
            break
        regions = max(1, -(-count // region_size))
        last = turn == rounds - 1 or regions == 1
        dealt = todo.select("_row", "length", F.pmod(F.xxhash64("_row", F.lit(turn)), F.lit(regions)).cast("int").alias("region"))
        now = dealt.withColumn("island", F.explode(F.array(*(F.lit(i) for i in range(islands))))).groupBy("region", "island").applyInPandas(settle, shape)
        for _ in range(epochs - 1):
            moved = now.withColumn("came", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
                "island", F.when(F.col("came") == 1, (F.col("island") + 1) % islands).otherwise(F.col("island")))
            now = moved.groupBy("region", "island").applyInPandas(settle, shape)
        now = materialize(now, "pack_epoch")
        best = now.groupBy("region").agg(F.min(F.struct("bins", "island")).alias("best")).select("region", "best.island")
        now = now.join(best, ["region", "island"])
        sequence = (F.col("region").cast("long") * (2 * region_size) + F.col("bin")) * 8 + 1 + turn
        loads = now.groupBy("region", "bin").agg(F.sum("length").alias("_load"))
        now = now.join(loads, ["region", "bin"]).select("_row", "length", sequence.alias("sequence_id"), "_load")
        now = materialize(now, "pack_round")
        done = now if last else now.filter(F.col("_load") >= capacity - slack)
        placed = done if placed is None else placed.unionByName(done)
        if last:
            break
        todo = now.filter(F.col("_load") < capacity - slack).select("_row", "length")
    if placed is None:
        return full.drop("_row")
    from pyspark.sql import Window

    # A sequence holds at most ``capacity`` rows, so its window is small.
    order = Window.partitionBy("sequence_id").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select("_row", "sequence_id", F.coalesce(F.sum("length").over(order), F.lit(0)).cast("long").alias("offset"))
    packed = rows.filter(F.col("length") < capacity).join(placed, "_row")
    return packed.unionByName(full).drop("_row")
