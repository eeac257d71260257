"""A trip table of several loads: atomic replace, repeatable appends, ids in pickup order over all loads.

Rows of a load are sorted once, written to a folder of their own and never
rewritten. What the table holds is said by the newest snapshot, a small file
that appears whole or not at all, so readers see the old rows until a write
is complete, and a failed one leaves them as they were.

trip_id is a row's place in pickup order over the whole table. An append does
not sort the stored rows again. The pickup times of the new rows cut the time
line into cells; a cell that only one side has rows in keeps that side's order
and just moves by an offset, and only rows of cells that both sides have rows
in (equal pickup times, as long as the new rows have at most MAX_CUTS of them)
are sorted together. The result is a step function from old ids to new ones,
kept beside the load; reading applies the steps of later appends.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripgauge.functions import epoch_micros
from tripgauge.operators.ids import ORDER
from tripgauge.operators.ranking import _partition_offsets, attach_row_numbers, row_numbers
from tripgauge.operators.split import ntz_literal
from tripgauge.schema import TRIP_ID
from tripgauge.sources.files import delete_tree, list_names, read_text, write_new
from tripgauge.sources.sinks import content_hash, observed_content, verify_content

PICKUP = "pickup_datetime"
#: Cuts of the time line at most: the driver holds one row a cell, tasks the cuts.
MAX_CUTS = 50_000
#: Steps that a read broadcasts at most (24 MB); more are joined, by blocks of BLOCK ids.
MAX_STEPS = 1_000_000
BLOCK = 256
#: Steps that stand in the snapshot itself at most.
SHORT = 10_000


class TripTable:
    """The table at ``path``. ``tiebreak`` names the columns that order trips of equal time and place; trips equal in those
    too are ordered by a hash of all columns."""

    def __init__(self, spark: SparkSession, path: str, tiebreak: Sequence[str] = ()):
        self.spark, self.path, self.tiebreak = spark, path.rstrip("/"), tuple(tiebreak)

    # -- snapshots ------------------------------------------------------------
    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in list_names(self.spark, f"{self.path}/snapshots") if n.endswith(".json") and n[:-5].isdigit())

    def snapshot(self, version: int | None = None) -> dict:
        """{"version", "loads": [...]} as of ``version`` (default: the newest; version 0 without loads if there is none).

        A load has its "id", "rows" and "content" sum, its "first" and "last" pickup time, the folder "data" of its rows with
        the place of each file's first row ("offsets"), and two step functions, which place its rows ("placed") and move
        the earlier ones ("moved"; null: they keep their ids). A step function is a list of (lo, hi, shift), or the folder of
        a longer one.
        """
        found = self.versions()
        if version is None:
            if not found:
                return {"version": 0, "loads": []}
            version = found[-1]
        elif version not in found:
            raise ValueError(f"no version {version} of {self.path}; there are {found}")
        return json.loads(read_text(self.spark, f"{self.path}/snapshots/{version}.json"))

    def _commit(self, before: dict, loads: list[dict]) -> dict:
        """The next snapshot. FileExistsError: another writer came first, and nothing has changed."""
        after = {"version": before["version"] + 1, "loads": loads}
        write_new(self.spark, f"{self.path}/snapshots/{after['version']}.json", json.dumps(after))
        return after

    # -- reading --------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        """All rows with trip_id; a table without loads is an error, as it has no columns."""
        loads = self.snapshot(version)["loads"]
        if not loads:
            raise ValueError(f"{self.path} holds no trips")
        return self._united(loads)

    def _united(self, loads: list[dict]) -> DataFrame:
        """The rows of ``loads`` with their ids among each other: every load's own, moved by the loads behind it."""
        out = None
        for k, load in enumerate(loads):
            rows = self._moved(self._ranked(load), load["placed"])
            for later in loads[k + 1:]:
                if later["moved"]:
                    rows = self._moved(rows, later["moved"])
            out = rows if out is None else out.unionByName(rows)
        return out

    def _ranked(self, load: dict) -> DataFrame:
        """The rows of a load with their place in it, from 1, as trip_id."""
        rows = self.spark.read.parquet(f"{load['data']}/rows")
        return attach_row_numbers(rows, [tuple(r) for r in load["offsets"]], TRIP_ID).drop("_mid") if load["rows"] else rows.withColumn(TRIP_ID, F.col("_mid")).drop("_mid")

    def _moved(self, rows: DataFrame, steps: list | str) -> DataFrame:
        """trip_id moved by a step function: ids from lo to hi move by shift."""
        if isinstance(steps, str):
            stored = self.spark.read.parquet(steps)
            if stored.count() > MAX_STEPS:
                blocks = stored.withColumn("_block", F.explode(F.sequence(F.expr(f"lo div {BLOCK}"), F.expr(f"hi div {BLOCK}"))))
                found = rows.withColumn("_block", F.expr(f"{TRIP_ID} div {BLOCK}")).join(blocks, "_block").where(F.col(TRIP_ID).between(F.col("lo"), F.col("hi")))
                return found.withColumn(TRIP_ID, F.col(TRIP_ID) + F.col("shift")).drop("_block", "lo", "hi", "shift")
            table = stored.orderBy("lo").toPandas()
        else:
            table = pd.DataFrame(steps, columns=["lo", "hi", "shift"], dtype=np.int64)
        if len(table) == 1:
            return rows.withColumn(TRIP_ID, F.col(TRIP_ID) + F.lit(int(table["shift"][0])))
        shared = self.spark.sparkContext.broadcast((table["lo"].to_numpy(), table["shift"].to_numpy()))

        @F.pandas_udf("long")
        def move(ids: pd.Series) -> pd.Series:
            lows, shifts = shared.value
            return ids + shifts[np.searchsorted(lows, ids.to_numpy(), side="right") - 1]

        return rows.withColumn(TRIP_ID, move(F.col(TRIP_ID)))

    # -- writing --------------------------------------------------------------
    def replace(self, rows: DataFrame, load_id: str) -> dict:
        """The table holds ``rows`` alone from now on. Returns the snapshot."""
        before = self.snapshot()
        return self._commit(before, self._appended([], self._staged(rows, load_id)))

    def append(self, rows: DataFrame, load_id: str) -> dict:
        """Adds ``rows`` as the load ``load_id``; a table that isn't there begins with them. Returns the snapshot.

        The same load again changes nothing. Other rows under the id of an earlier load take the place of that load's.
        The columns must be those of the stored rows.
        """
        before = self.snapshot()
        loads = before["loads"]
        if loads:
            stored = {f.name: f.dataType for f in self.spark.read.parquet(f"{loads[0]['data']}/rows").schema if f.name != "_mid"}
            given = {f.name: f.dataType for f in rows.schema if f.name not in (TRIP_ID, "_mid")}
            if stored != given:
                raise ValueError(f"the table's columns are {stored}, the load's {given}")
        at = next((k for k, load in enumerate(loads) if load["id"] == load_id), len(loads))
        if at < len(loads):  # one scan tells a replay, before anything is sorted or written
            own = rows.drop(TRIP_ID, "_mid")
            told = own.agg(*observed_content(own)).first()
            if (told["rows"], int(told["content"] or 0)) == (loads[at]["rows"], loads[at]["content"]):
                return before
        new = self._staged(rows, load_id)
        out = self._appended(loads[:at], new)
        for later in loads[at + 1:]:  # their rows stay as they are; their places are found anew
            out = self._appended(out, later)
        return self._commit(before, out)

    def compact(self, load_id: str) -> dict:
        """The same rows and ids as one load, so that reads apply no steps. Earlier load ids are forgotten."""
        return self.replace(self.read(), load_id)

    def expire(self, keep: int = 2) -> list[str]:
        """Deletes all but the newest ``keep`` snapshots and the folders that none of those refers to (of old rows and of
        failed writes). Not to be run while another writer is at work. Returns the folders' names."""
        versions = self.versions()
        held = {load[c].split("/loads/")[1].split("/")[0] for v in versions[-keep:] for load in self.snapshot(v)["loads"]
                for c in ("data", "placed", "moved") if isinstance(load[c], str)}
        for v in versions[:-keep]:
            delete_tree(self.spark, f"{self.path}/snapshots/{v}.json")
        gone = [n for n in list_names(self.spark, f"{self.path}/loads") if n not in held]
        for n in gone:
            delete_tree(self.spark, f"{self.path}/loads/{n}")
        return gone

    def _folder(self) -> str:
        return f"{self.path}/loads/{uuid.uuid4().hex}"

    def _staged(self, rows: DataFrame, load_id: str) -> dict:
        """Sorts the rows into a folder that no snapshot knows yet, and checks that they read back as they were written."""
        folder = self._folder()
        rows = rows.select(*[F.col(f"`{c}`") for c in sorted(set(rows.columns) - {TRIP_ID, "_mid"})])
        keys = [*[F.col(c) for c in (*ORDER, *self.tiebreak)], content_hash(rows)]
        seen = Observation("staged")
        ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).observe(
            seen, *observed_content(rows), F.min(epoch_micros(PICKUP)).alias("first"), F.max(epoch_micros(PICKUP)).alias("last"),
            F.count_if(F.col(PICKUP).isNull()).alias("blank"))
        ordered = ordered.withColumn("_mid", F.monotonically_increasing_id())
        ordered.write.parquet(f"{folder}/rows")
        told = seen.get
        if told["blank"]:
            raise ValueError(f"{told['blank']} rows have no {PICKUP}: they have no place in the table")
        rows_told, content = int(told["rows"]), int(told["content"] or 0)
        back = self.spark.read.schema(ordered.schema).parquet(f"{folder}/rows")
        verify_content(back.drop("_mid"), rows_told, content)
        offsets = [list(r) for r in _partition_offsets(back.select("_mid"), ()).select("_pid", "_first", "_off").collect()]  # a row per file
        return {"id": load_id, "data": folder, "rows": rows_told, "content": content, "first": told["first"], "last": told["last"], "offsets": offsets}

    def _appended(self, loads: list[dict], new: dict) -> list[dict]:
        """``loads`` and ``new`` behind them, with the step functions that place its rows and move the earlier ones."""
        placed, moved = self._steps(loads, sum(load["rows"] for load in loads), new)
        still = isinstance(moved, list) and not any(shift for *_, shift in moved)
        return [*loads, {**new, "placed": placed, "moved": None if still else moved}]

    def _kept(self, steps: DataFrame) -> list | str:
        """A step function as a list, if it is short, or as the folder it is stored in; empty if it moves nothing."""
        # Ids and the ids they become rise together, so ids of one shift are one run of ids.
        folder = f"{self._folder()}/steps"
        steps.groupBy("shift").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("lo", "hi", "shift").write.parquet(folder)
        stored = self.spark.read.parquet(folder)
        some = [list(r) for r in stored.orderBy("lo").limit(SHORT + 1).collect()]
        return folder if len(some) > SHORT else some

    def _steps(self, loads: list[dict], stored: int, new: dict) -> tuple[list | str, list | str]:
        """How the ids of ``new`` become its places among all rows, and how those of the stored rows change (empty: not at all)."""
        spark, count = self.spark, new["rows"]
        table = lambda rows: spark.createDataFrame(rows, "lo long, hi long, shift long")
        if not stored or not count or new["first"] > max(load["last"] for load in loads if load["rows"]):
            return [[1, max(count, 1), stored]], []  # later than all that is stored: nothing is read of it
        fresh = self._ranked(new)
        us = epoch_micros(PICKUP)
        times = fresh.select(us.alias("us")).distinct().limit(MAX_CUTS + 1).toPandas()["us"].to_numpy()
        if len(times) <= MAX_CUTS:
            cuts = times
        else:  # about MAX_CUTS / 10 places of equal shares of the new rows
            marks = [k / (MAX_CUTS // 10) for k in range(MAX_CUTS // 10 + 1)]
            cuts = np.array(fresh.agg(F.percentile_approx(us, marks, MAX_CUTS)).first()[0])
        cuts = np.unique(cuts.astype(np.int64))
        shared = spark.sparkContext.broadcast(cuts)

        @F.pandas_udf("int")
        def cell(us: pd.Series) -> pd.Series:  # 2k + 1: at cut k; 2k: between cuts k - 1 and k
            us = us.to_numpy()
            return pd.Series((np.searchsorted(shared.value, us, "left") + np.searchsorted(shared.value, us, "right")).astype(np.int32))

        # Only stored rows between the first and the last cut are read; those before and behind are counted by their ids.
        pickup, low, high = F.col(PICKUP), ntz_literal(int(cuts[0])), ntz_literal(int(cuts[-1]))
        united = self._united(loads)
        old = united.where((pickup >= low) & (pickup <= high)).withColumn("_cell", cell(us))
        fresh = fresh.withColumn("_cell", cell(us))
        cells = 2 * len(cuts) + 1

        def counted(rows: DataFrame) -> tuple[np.ndarray, int | None]:
            got = rows.groupBy("_cell").agg(F.count("*").alias("n"), F.min(TRIP_ID).alias("lo")).toPandas()  # a row per cell
            out = np.zeros(cells, np.int64)
            out[got["_cell"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
            return out, int(got["lo"].min()) if len(got) else None

        n_new, _ = counted(fresh)
        n_old, least = counted(old)
        n_old[0] = least - 1 if least is not None else united.where(pickup < low).count()
        n_old[-1] = stored - n_old.sum()
        start = lambda n: 1 + np.cumsum(n) - n
        start_old, start_new, start_all = start(n_old), start(n_new), start(n_old + n_new)
        shared_cells = (n_old > 0) & (n_new > 0)
        sides = []
        for n, own in ((n_new, start_new), (n_old, start_old)):
            at = np.flatnonzero((n > 0) & ~shared_cells)
            sides.append(pd.DataFrame({"lo": own[at], "hi": own[at] + n[at] - 1, "shift": (start_all - own)[at]}))
        if not shared_cells.any() and max(map(len, sides)) <= SHORT:
            return tuple(side.groupby("shift", as_index=False).agg({"lo": "min", "hi": "max"})[["lo", "hi", "shift"]].to_numpy().tolist() for side in sides)
        sides = [table(side) for side in sides]
        if not shared_cells.any():
            return tuple(map(self._kept, sides))
        # Rows of cells that both sides have rows in are sorted together.
        at = np.flatnonzero(shared_cells)
        both = (n_old + n_new)[at]
        ahead = pd.DataFrame({"_cell": at.astype(np.int32), "_ahead": start_all[at] - (np.cumsum(both) - both)})
        mixed = F.broadcast(spark.createDataFrame(ahead, "_cell int, _ahead long"))  # a row per cell at most
        data = [c for c in fresh.columns if c not in (TRIP_ID, "_cell")]
        keys = list(dict.fromkeys((*ORDER, *self.tiebreak)))
        pick = lambda rows, side: rows.join(mixed, "_cell").select(
            *keys, content_hash(rows.select(*data)).alias("_hash"), F.lit(side).alias("_side"), TRIP_ID, "_ahead")
        ranked = row_numbers(pick(old, 1).unionByName(pick(fresh, 0)), [*keys, "_hash", "_side", TRIP_ID], "_at", start=0, name="merged_trips")
        moved = ranked.select("_side", F.col(TRIP_ID).alias("lo"), F.col(TRIP_ID).alias("hi"), (F.col("_at") + F.col("_ahead") - F.col(TRIP_ID)).alias("shift"))
        return tuple(self._kept(sides[k].unionByName(moved.where(F.col("_side") == k).drop("_side"))) for k in (0, 1))
