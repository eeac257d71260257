"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells, components.

Vectors go to the cell of their nearest centroid, and as visitors to every
other cell in which a vector within the angle could live: if y's centroid is
c and x's is o, then y.(c - o) >= 0, so x within angle t of y has
x.(c - o) >= -sin(t) |c - o|. Hence all pairs meet, whatever the centroids.

A label's cell is compared in blocks of two chunks of at most ``limit``
vectors, so what moves is a vector's visits times the chunks of a cell; cells
are made for PER_CELL vectors of the largest label, not sooner, as each
visit moves a vector again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.llm.blocks import compare, deal
from tripgauge.llm.components import components
from tripgauge.llm.runtime import map_batches
from tripgauge.session import materialize

#: Vectors that the centroids are fitted on, and centroids, at most. Every vector is assigned; the fit only steers the work.
SAMPLE, MAX_CELLS = 8192, 1024
#: Vectors of one label that a cell is made for, and of a chunk. Two chunks are compared in a task: 2 x 16,384 vectors.
PER_CELL, CHUNK = 32_768, 16_384
#: Products that a task holds at a time.
PRODUCTS = 1 << 21


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Unit rows in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_cells(vectors: DataFrame, dims: int, count: int, largest: int, per_cell: int = PER_CELL, turns: int = 6) -> np.ndarray:
    """Spherical k-means centroids, fitted on SAMPLE of ``count`` vectors picked by hash (all of them if there are fewer);
    their number follows from the ``largest`` label."""
    share = min(1.0, 1.2 * SAMPLE / max(count, 1))
    picked = vectors.filter(F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(F.xxhash64("rep")).limit(SAMPLE)
    x = picked.select("vector").toPandas()["vector"].to_list()
    k = int(min(MAX_CELLS, max(1, -(-largest // per_cell)), max(1, len(x) // 4)))
    if not x:
        return np.eye(1, dims)
    x = _matrix(pa.array([list(v) for v in x], pa.list_(pa.float64())), dims)
    rng = np.random.default_rng(0)
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(turns):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), centres)
    return centres


def _cells(vectors: DataFrame, centres: np.ndarray, dims: int, least: float) -> DataFrame:
    """A row per vector and cell: its own (home) and those it visits. Vectors of other lengths than ``dims`` share cell 0."""
    names = vectors.columns
    schema = T.StructType([*vectors.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("home", T.BooleanType())])
    sine = float(np.sqrt(max(0.0, 1 - least * least))) + 1e-7
    gap = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))  # |c - o|

    def run(batch):
        for start in range(0, batch.num_rows, 2048):
            part = batch.slice(start, 2048)
            fits = part.column(names.index("dims")).to_numpy() == dims
            other = part.filter(pa.array(~fits))
            if other.num_rows:
                yield {name: other.column(k) for k, name in enumerate(names)} | {"cell": np.zeros(other.num_rows, int), "home": np.ones(other.num_rows, bool)}
            part = part.filter(pa.array(fits))
            if not part.num_rows:
                continue
            near = _matrix(part.column(names.index("vector")), dims) @ centres.T
            own = near.argmax(axis=1)
            rows = np.arange(len(own))
            reach = near - near[rows, own][:, None] >= -sine * gap[own] - 1e-9
            reach[rows, own] = True
            at, cell = np.nonzero(reach)
            taken = part.take(pa.array(at))
            yield {name: taken.column(k) for k, name in enumerate(names)} | {"cell": cell, "home": cell == own[at]}

    return map_batches(vectors, run, schema)


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str = "label", least: float = 0.98,
                    limit: int = CHUNK) -> DataFrame:
    """All rows with ``n_links``, ``component_id`` and ``kept``.

    Two rows link if their groups are equal and not null and the cosine of their vectors, in double precision, is at least
    ``least`` (above 0). component_id is the smallest id reachable; the row that bears it is kept. Equal vectors of a group
    are one class that stands for all its rows. Rows with a null group or id, or a vector that is null, empty, zero or
    holds null or non-finite components, link with nothing: n_links 0, their own id as component, kept (unless the id is
    null: null component, kept false). Vectors of different lengths don't link. Repeated rows link like any others and, as
    they share an id, are all kept or all not. Input columns of the new names are replaced. An empty table gives an empty one.
    """
    new = ["n_links", "component_id", "kept"]
    kind = rows.schema[vector_col].dataType.elementType
    wide = F.transform(vector_col, lambda v: v.cast("double"))
    sound = F.coalesce(F.forall(wide, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(wide, lambda v: v != 0), F.lit(False))
    base = materialize(rows.drop(*new).withColumn("_good", sound & F.col(group_col).isNotNull() & F.col(id_col).isNotNull())
                       .withColumn("_vector", F.when(F.col("_good"), F.col(vector_col) if isinstance(kind, T.FloatType) else wide)), "vectors")
    classes = base.filter("_good").groupBy(F.col(group_col).alias("group"), F.col("_vector").alias("vector")).agg(
        F.min(F.col(id_col).cast("long")).alias("rep"), F.count("*").alias("copies"))
    classes = materialize(classes.select("group", F.size("vector").alias("dims"), "vector", "rep", "copies"), "vector_classes")
    # The id may be shared by unequal vectors, so classes have numbers of their own.
    classes = classes.withColumn("node", F.monotonically_increasing_id())
    classes = materialize(classes, "vector_nodes")
    # The length that most vectors have gets cells; all lengths are compared, each with its own.
    main = classes.groupBy("dims").count().agg(F.max(F.struct("count", "dims")).alias("m")).first()["m"]
    if main is None:
        return base.drop("_good", "_vector").withColumns({"n_links": F.lit(0).cast("long"), "component_id": F.col(id_col).cast("long"),
                                                          "kept": F.col(id_col).isNotNull()})
    dims, some = main["dims"], classes.filter(F.col("dims") == main["dims"])
    largest = some.groupBy("group").count().agg(F.max("count")).first()[0]
    centres = fit_cells(some, dims, main["count"], largest)
    dealt = deal(_cells(classes, centres, dims, least), ["group", "dims", "cell"], "node", limit)
    found = compare(dealt, ["group", "dims", "cell"], _linker(least), _LINK)
    found = materialize(found, "vector_links")
    weight = found.filter("v is null").groupBy("u").agg(F.sum("weight").alias("weight"))
    joined = components(found.filter("v is not null").select("u", "v"))
    named = classes.join(joined, classes["node"] == joined["node"], "left").select(classes["*"], F.coalesce("component", classes["node"]).alias("root"))
    # Copies of one id join their classes too: the least id of a component is taken over its classes.
    least_id = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(least_id, "root").join(weight, F.col("node") == F.col("u"), "left").select(
        "group", "vector", (F.col("copies") - 1 + F.coalesce("weight", F.lit(0))).alias("n_links"), "component_id")
    joined = base.join(named, (base[group_col] == named["group"]) & (base["_vector"] == named["vector"]), "left")
    out = joined.select(*(base[c] for c in base.columns if c not in ("_good", "_vector")), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        F.coalesce("component_id", base[id_col].cast("long")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


#: weight rows (u, null, copies linked) and links (u, v, null).
_LINK = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType()), T.StructField("weight", T.LongType())])


def _linker(least: float):
    def check(table, bounds):
        node, home, copies, own, i, j = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("node", "home", "copies", "_own", "_ci", "_cj"))
        vectors, dims = table.column("vector").combine_chunks(), table.column("dims").to_numpy()
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            n = b - a
            if not home[a:b].any() or n < 2:
                continue
            x = _matrix(vectors.slice(a, n), int(dims[a]))
            ids, at_home, times, chunk = node[a:b], home[a:b], copies[a:b], own[a:b]
            weight, part_of, edges = np.zeros(n, np.int64), np.arange(n), []
            own_rows, strip = np.flatnonzero(at_home), max(1, PRODUCTS // n)
            for t in range(0, len(own_rows), strip):  # some rows that are at home against all
                rows = own_rows[t:t + strip]
                i1, j1 = np.nonzero(x[rows] @ x.T >= least)
                i1 = rows[i1]
                # Each pair counts once: where both are at home, or where the one at home has the smaller number.
                good = (i1 != j1) & (at_home[j1] | (ids[i1] < ids[j1]))
                if i[a] != j[a]:  # pairs within a chunk are counted in the chunk's own block
                    good &= chunk[i1] != chunk[j1]
                i1, j1 = i1[good], j1[good]
                np.add.at(weight, i1, times[j1])
                guest = ~at_home[j1]  # a guest has no row of its own here
                np.add.at(weight, j1[guest], times[i1[guest]])
                # A link goes out where it joins two parts of the block: a dense group of n vectors gives n - 1, not all pairs.
                first = np.flatnonzero(np.append(True, i1[1:] != i1[:-1])) if len(i1) else []
                for u, v in zip(first, np.append(first[1:], len(i1))):
                    row, near = int(i1[u]), j1[u:v]
                    parts, at = np.unique(part_of[near], return_index=True)
                    fresh = parts != part_of[row]
                    if fresh.any():
                        edges += [(row, k) for k in near[at[fresh]].tolist()]
                        part_of[np.isin(part_of, parts[fresh])] = part_of[row]
            rows = np.flatnonzero(weight)
            if not len(rows):
                continue
            edges = np.array(edges, np.int64).reshape(-1, 2)
            yield {"u": np.concatenate([ids[rows], ids[edges[:, 0]]]), "v": pa.array([None] * len(rows) + ids[edges[:, 1]].tolist(), pa.int64()),
                   "weight": pa.array(weight[rows].tolist() + [None] * len(edges), pa.int64())}

    return check
