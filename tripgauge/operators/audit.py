"""Join fan-out audit: what a join on a given key would do, before running it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.session import materialize

#: Keys that a summary keeps per task, and those it tells at last. A key it does not tell occurs less often than the least
#: of those told, or than 3.5 / TRACKED of all rows, whichever is more.
TRACKED, CANDIDATES = 10_000, 1_000


def fanout_audit(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                 right_keys: Sequence[str] | None = None, label: str | None = None) -> DataFrame:
    """One row: per-side rows and distinct keys, keys repeated on each side, matched keys,
    rows an inner join would output (sum of l*r), its largest per-key product and the
    fan-out ratio output / left rows.

    Both sides are reduced to per-key counts (map-side combined) before the
    keyed join, so a hot key costs one row per task, never its full row set.
    Null keys never match (inner-join semantics) and are left out.
    """
    right_keys = list(left_keys) if right_keys is None else list(right_keys)
    ks = [f"_k{i}" for i in range(len(left_keys))]

    def per_key(df, keys):
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).isNotNull()
        return (df.where(cond).select(*[F.col(k).alias(a) for k, a in zip(keys, ks)])
                .groupBy(*ks).agg(F.count(F.lit(1)).alias("c")))

    lc = per_key(left, left_keys).withColumnRenamed("c", "l")
    rc = per_key(right, right_keys).withColumnRenamed("c", "r")
    j = lc.join(rc, ks, "full")
    l, r = F.coalesce("l", F.lit(0)), F.coalesce("r", F.lit(0))
    # Two hot keys of a few billion rows overflow a long.
    product = l.cast("decimal(19,0)") * r.cast("decimal(19,0)")
    out = j.agg(
        F.sum(l).alias("left_rows"), F.sum(r).alias("right_rows"),
        F.count(F.col("l")).alias("left_keys"), F.count(F.col("r")).alias("right_keys"),
        F.count(F.when(l > 1, 1)).alias("left_dup_keys"), F.count(F.when(r > 1, 1)).alias("right_dup_keys"),
        F.count(F.when((l > 0) & (r > 0), 1)).alias("matched_keys"),
        F.sum(product).alias("join_rows"), F.max(product).alias("max_key_rows"))
    out = out.select(
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in
          ("left_rows", "right_rows", "left_keys", "right_keys", "left_dup_keys", "right_dup_keys", "matched_keys")],
        *[F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,0)").alias(c) for c in ("join_rows", "max_key_rows")])
    out = out.withColumn("fanout_ratio", F.when(
        F.col("left_rows") > 0, F.col("join_rows").cast("double") / F.col("left_rows")))
    out = out.withColumn("keys_unique", (F.col("left_dup_keys") == 0) & (F.col("right_dup_keys") == 0))
    if label is not None:
        out = out.select(F.lit(label).alias("audit"), *out.columns)
    return out


def worst_keys(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str] | None = None, n: int = 10,
               candidates: int = CANDIDATES) -> DataFrame:
    """The ``n`` keys that make most rows in an inner join: (keys..., left_rows, right_rows, join_rows, place), place from 1, ties by key.

    A mergeable frequent-items summary of each side (one scan, no exchange of rows) names candidates; only their rows are
    counted exactly. A key that is no candidate occurs at most as often as the summaries' bounds say; if the product of
    the bounds could still reach the n-th place, all keys are counted instead. Hence exact either way. Null keys never match.
    """
    right_keys = list(left_keys) if right_keys is None else list(right_keys)
    names, candidates = list(left_keys), min(candidates, TRACKED)

    def sound(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        out = df.select(*[F.col(k).alias(a) for k, a in zip(keys, names)])
        return out.dropna().withColumn("_hash", F.xxhash64(*names))

    sides = [sound(left, left_keys), sound(right, right_keys)]
    bounds, hashes = [], []
    for side in sides:
        told = side.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_hash, {candidates}, {TRACKED})").alias("top")).first()
        top = [(r["item"], r["count"]) for r in told["top"] or []]  # at most ``candidates``
        least = min((c for _, c in top), default=0) if len(top) >= candidates else 0
        bounds.append(max(least, 3.5 * told["n"] / TRACKED))
        hashes += [(h,) for h, _ in top]

    def counted(some: DataFrame | None) -> DataFrame:
        per_key = []
        for side, total in zip(sides, ("left_rows", "right_rows")):
            rows = side if some is None else side.join(F.broadcast(some), "_hash", "left_semi")
            per_key.append(rows.groupBy(*names).agg(F.count(F.lit(1)).alias(total)))
        both = per_key[0].join(per_key[1], names)
        product = F.col("left_rows").cast("decimal(19,0)") * F.col("right_rows").cast("decimal(19,0)")
        top = both.withColumn("join_rows", product.cast("decimal(38,0)")).orderBy(F.desc("join_rows"), *names).limit(n)
        return materialize(top, "worst_keys")

    spark = left.sparkSession
    listed = spark.createDataFrame(sorted(set(hashes)), "_hash long")  # at most 2 * ``candidates`` rows
    out = counted(listed)
    worst = [r["join_rows"] for r in out.select("join_rows").collect()]  # n rows
    if len(worst) < n or min(worst) <= bounds[0] * bounds[1]:
        out = counted(None)
    rows = [tuple(r) for r in out.orderBy(F.desc("join_rows"), *names).collect()]  # n rows
    shape = out.schema.add("place", "long")
    return spark.createDataFrame([(*r, k + 1) for k, r in enumerate(rows)], shape)
