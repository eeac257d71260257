"""Sharding: best-fit-decreasing bin packing of indivisible groups into shards of one fixed capacity.

Rows with equal texts are a group, and a group never parts. Groups sorted by
falling size enter the open bin with the least room that still holds them,
found in a balanced tree of rooms. At scale the packing is a tree of bounded
tasks: groups are dealt to regions and packed into parcels of a small part of
a shard, parcels are packed again while there are too many, and the last few
thousand parcels go into the shards. With a wanted number of shards the
capacity is the smallest for which that last packing needs no more of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.llm.runtime import ship
from tripgauge.operators.ranking import _partition_offsets, _sorted_numbered
from tripgauge.session import materialize

#: Items of one packing task, on average.
REGION_ITEMS = 16_384
#: Parcels that the last packing into a wanted number of shards deals with, about.
LAST_ITEMS = 8_192
#: A group with more rows than this, and than 1/10,000 of all rows, is hot; so at most 10,000 groups are.
HOT_ROWS = 1_000


class RoomTree:
    """An AVL tree of open bins, ordered by (room, bin). A bin is in it once at most, and its node has the bin's number."""

    def __init__(self) -> None:
        self.root = -1
        self.left: list[int] = []
        self.right: list[int] = []
        self.height: list[int] = []
        self.room: list[int] = []

    def open(self, room: int) -> int:
        """A new bin; it isn't in the tree yet."""
        self.left.append(-1)
        self.right.append(-1)
        self.height.append(1)
        self.room.append(room)
        return len(self.room) - 1

    def tightest(self, need: int) -> int:
        """The bin with the least room of at least ``need``, or -1."""
        best, t = -1, self.root
        while t >= 0:
            if self.room[t] >= need:
                best, t = t, self.left[t]
            else:
                t = self.right[t]
        return best

    def add(self, b: int) -> None:
        self.left[b] = self.right[b] = -1
        self.height[b] = 1
        self.root = self._add(self.root, b)

    def remove(self, b: int) -> None:
        self.root = self._remove(self.root, b)

    def _before(self, a: int, b: int) -> bool:
        return (self.room[a], a) < (self.room[b], b)

    def _add(self, t: int, b: int) -> int:
        if t < 0:
            return b
        side = self.left if self._before(b, t) else self.right
        side[t] = self._add(side[t], b)
        return self._balanced(t)

    def _remove(self, t: int, b: int) -> int:
        if t == b:
            if self.left[t] < 0 or self.right[t] < 0:
                return max(self.left[t], self.right[t])
            heir = self.right[t]
            while self.left[heir] >= 0:
                heir = self.left[heir]
            rest = self._remove(self.right[t], heir)
            self.left[heir], self.right[heir] = self.left[t], rest
            return self._balanced(heir)
        side = self.left if self._before(b, t) else self.right
        side[t] = self._remove(side[t], b)
        return self._balanced(t)

    def _tall(self, t: int) -> int:
        return self.height[t] if t >= 0 else 0

    def _measure(self, t: int) -> None:
        self.height[t] = 1 + max(self._tall(self.left[t]), self._tall(self.right[t]))

    def _turn(self, t: int, one: list[int], other: list[int]) -> int:
        """The child of t in ``one`` becomes the parent of t."""
        top = one[t]
        one[t], other[top] = other[top], t
        self._measure(t)
        self._measure(top)
        return top

    def _balanced(self, t: int) -> int:
        self._measure(t)
        lean = self._tall(self.left[t]) - self._tall(self.right[t])
        if -2 < lean < 2:
            return t
        one, other = (self.left, self.right) if lean > 0 else (self.right, self.left)
        child = one[t]
        if self._tall(other[child]) > self._tall(one[child]):
            one[t] = self._turn(child, other, one)
        return self._turn(t, one, other)


def best_fit_decreasing(sizes: np.ndarray, capacity: int, most: int | None = None) -> np.ndarray | None:
    """The bin (0, 1, ...) of each size; sizes above ``capacity`` get bins of their own. None if more than ``most`` bins are needed."""
    tree, where = RoomTree(), np.empty(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        b = tree.tightest(size)
        if b < 0:
            b = tree.open(max(capacity, size))
            if most is not None and b >= most:
                return None
        else:
            tree.remove(b)
        tree.room[b] -= size
        where[i] = b
        if tree.room[b]:
            tree.add(b)
    return where


def even_bins(sizes: np.ndarray, bins: int) -> np.ndarray:
    """The bin (0 to bins-1) of each size, with loads as near equal as the sizes allow.

    A size of at least the average that is left has a bin of its own. The others share the remaining bins, packed by best
    fit decreasing at the smallest capacity, found by bisection, for which they suffice (average plus the largest always does).
    """
    where = np.full(len(sizes), -1, np.int64)
    order = np.argsort(-sizes, kind="stable")
    rest, own = int(sizes.sum()), 0
    while own < bins - 1 and own < len(sizes) and int(sizes[order[own]]) * (bins - own) >= rest:
        where[order[own]] = own
        rest -= int(sizes[order[own]])
        own += 1
    left = order[own:]
    if len(left):
        some, count = sizes[left], bins - own
        low = max(int(some.max()), -(-rest // count))
        high = -(-rest // count) + int(some.max())
        found = best_fit_decreasing(some, high, count)
        while high > low:
            middle = (low + high) // 2
            tried = best_fit_decreasing(some, middle, count)
            if tried is None:
                low = middle + 1
            else:
                found, high = tried, middle
            if high - low <= high >> 20:
                break
        where[left] = own + found
    return where


def _parcels(items: DataFrame, capacity: int, regions: int, turn: int) -> DataFrame:
    """(item, size, parent): each region's items packed into parcels, which are numbered over all regions."""

    def settle(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("item", kind="stable", ignore_index=True)
        bins = best_fit_decreasing(frame["size"].to_numpy(), capacity)
        return pd.DataFrame({"item": frame["item"], "size": frame["size"], "parent": (int(key[0]) << 32) + bins})

    dealt = items.select("item", "size", F.pmod(F.xxhash64("item", F.lit(turn)), F.lit(regions)).alias("region"))
    return dealt.groupBy("region").applyInPandas(settle, "item long, size long, parent long")


def place_groups(groups: DataFrame, shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """Adds ``shard`` (int) to rows (key, item, size), a row a group: either ``shards`` shards near equal in size, numbered
    from 0, or as few as best fit gives of ``capacity`` (a larger group is alone in its shard). item is unique."""
    if (shards is None) == (capacity is None) or (shards or capacity) < 1:
        raise ValueError("give either shards or capacity, 1 or more")
    ship(groups.sparkSession)
    total, count = groups.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    if shards:
        parts = max(16, min(128, LAST_ITEMS // shards))  # parcels a shard
        parcel, last = max(1, total // (shards * parts)), max(LAST_ITEMS, 3 * shards * parts)
    else:
        parcel, last = max(1, capacity // 16), REGION_ITEMS
    items, levels = groups.select("item", "size"), []
    while count > last:
        # At most one parcel of a region is less than half full, so the number falls to 2 * total / parcel + regions.
        regions = -(-count // REGION_ITEMS)
        level = materialize(_parcels(items, int(parcel), regions, len(levels)), "shard_parcels")
        levels.append(level.select("item", "parent"))
        items = materialize(level.groupBy(F.col("parent").alias("item")).agg(F.sum("size").alias("size")), "shard_items")
        before, count = count, items.count()
        if not shards and count > before // 2:  # parcels are as large as they may be: regions of them are packed apart
            break
    regions = 1 if shards else -(-count // last)

    def finish(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("item", kind="stable", ignore_index=True)
        sizes = frame["size"].to_numpy()
        bins = even_bins(sizes, shards) if shards else best_fit_decreasing(sizes, capacity)
        return pd.DataFrame({"item": frame["item"], "region": int(key[0]), "bin": bins})

    dealt = items.select("item", "size", F.pmod(F.xxhash64("item", F.lit(-1)), F.lit(regions)).alias("region"))
    placed = materialize(dealt.groupBy("region").applyInPandas(finish, "item long, region long, bin long"), "shard_bins")
    if shards:
        placed = placed.select("item", F.col("bin").cast("int").alias("shard"))
    else:
        used = placed.groupBy("region").agg((F.max("bin") + 1).alias("n")).orderBy("region").collect()  # a row per REGION_ITEMS parcels
        starts = dict(zip([r["region"] for r in used], np.cumsum([0] + [r["n"] for r in used]).tolist()))
        first = groups.sparkSession.createDataFrame(list(starts.items()), "region long, first long")
        placed = placed.join(F.broadcast(first), "region").select("item", (F.col("first") + F.col("bin")).cast("int").alias("shard"))
    for level in reversed(levels):
        placed = level.join(placed.withColumnRenamed("item", "parent"), "parent").select("item", "shard")
    return groups.join(placed, "item")


def shard_documents(docs: DataFrame, shards: int | None = 24, capacity: int | None = None, id_col: str = "doc_id", text_col: str = "text",
                    keep: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` (all columns, or those in ``keep``) with ``size``, ``shard`` and ``slot``.

    size: UTF-8 bytes of the text (null: none) plus 8. Rows with equal texts share a shard; a null text goes with the empty
    ones. Texts are told apart by MD5: a collision would only keep two texts together. ``shards``: so many shards, from 0,
    near equal in bytes as far as whole groups allow: a group larger than the even share is alone in its shard, and some
    stay empty if there are fewer groups. ``capacity`` (then ``shards`` must be None): as few shards of so many bytes as
    best fit gives. slot numbers a shard's rows from 0 without gaps, copies side by side and then by id (null ids first).
    Repeated rows are rows like any others. Input columns of the new names are replaced. An empty table gives an empty one.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("size", "shard", "slot")]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_own"), F.col(f"`{id_col}`").alias("_id"),
                       (F.octet_length(text) + 8).cast("long").alias("size"), F.unhex(F.md5(text)).alias("key"))
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "shard_rows")
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("copies"))
    groups = materialize(groups.withColumn("item", F.monotonically_increasing_id()), "shard_groups")
    placed = materialize(place_groups(groups, shards, capacity).select("key", "copies", "shard"), "shard_places")
    # A hot group's rows are not dealt by their key: its place is broadcast.
    hot = F.col("copies") > F.greatest(F.lit(HOT_ROWS), F.lit(rows.count() // 10_000))
    held = rows.join(F.broadcast(placed.filter(hot).select("key", F.col("shard").alias("_hot"))), "key", "left")
    cold = held.filter("_hot IS NULL").drop("_hot").join(placed.filter(~hot).select("key", "shard"), "key")
    both = cold.unionByName(held.filter("_hot IS NOT NULL").withColumnRenamed("_hot", "shard"))
    # Rows of a shard lie together after the range sort, over as many partitions as they need.
    ordered = _sorted_numbered(materialize(both, "shard_dealt"), ["shard", "key", "_id", "_row"], "shard_slots")
    starts = _partition_offsets(ordered, ["shard"]).select("shard", "_pid", "_first", "_off")  # a row per range partition and shard in it
    out = ordered.withColumn("_pid", F.shiftright("_mid", 33)).join(starts, ["shard", "_pid"])
    return out.select("_own.*", "size", "shard", (F.col("_off") + F.col("_mid") - F.col("_first")).alias("slot"))


def write_shards(placed: DataFrame, path: str) -> None:
    """Writes rows with ``shard`` and ``slot`` as Parquet folders shard=0, shard=1, ..., each file ordered by slot."""
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.mode("errorifexists").partitionBy("shard").parquet(path)
