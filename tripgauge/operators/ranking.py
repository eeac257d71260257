"""Global order statistics without funnelling a group through one task.

Both operators sort with ``repartitionByRange`` (sampled range bounds, so a
hot group - even one holding a third of the rows - is spread over many
partitions) and then number rows inside each partition with
``monotonically_increasing_id`` (partition index in the high bits, row index
in the low 33 bits). The sorted rows are materialised once in the shared
folder, which pins the numbering; a per-(group, partition) count table - at
most one row per non-empty partition and group - turns partition-local
numbers into global ranks.

* ``row_numbers``: dense 1..n numbering in a total order (``row_number()`` over
  an unpartitioned window, without moving every row into one partition).
* ``exact_percentiles``: ``percentile_cont`` per group by bracket selection:
  sketches give a narrow value bracket around each wanted rank, and only rows
  inside one are sorted. No per-group value map is ever merged in one task,
  unlike the built-in exact ``percentile`` aggregate.

``row_numbers`` sorts only once: the range partitioner samples its input and
then shuffles it, so anything expensive that does not feed the sort keys
belongs after the exchange (``after_sort``), where it runs once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgauge.session import materialize

_LOW_BITS = 33


def _sorted_numbered(df: DataFrame, order: Sequence[Column | str], name: str,
                     drop: Sequence[str] = (),
                     after_sort: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Range-sort, apply the order-preserving ``after_sort`` (narrow steps such as
    derived columns and filters, evaluated once after the shuffle instead of in
    both the range-sampling and the map pass), number, materialise."""
    ordered = [F.col(c) if isinstance(c, str) else c for c in order]
    srt = df.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    if after_sort is not None:
        srt = after_sort(srt)
    numbered = srt.withColumn("_mid", F.monotonically_increasing_id())
    return materialize(numbered.drop(*drop) if drop else numbered, name)


def _partition_offsets(t: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., _pid, _cnt, _first, _off): rows of each group per partition, with
    the group's rank offset at the start of that partition."""
    pid = F.shiftright("_mid", _LOW_BITS).alias("_pid")
    stats = t.groupBy(*by, pid).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    # One row per (group, non-empty partition): small, bounded by partitions x groups.
    keys = [F.col(c) for c in by] if by else [F.lit(0)]
    w_run = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return stats.withColumn("_off", F.sum("_cnt").over(w_run) - F.col("_cnt"))


def numbered_table(df: DataFrame, order: Sequence[Column | str], name: str = "numbered",
                   after_sort: Callable[[DataFrame], DataFrame] | None = None):
    """Sort by ``order``, materialise with ``_mid``, and return ``(table, offsets)``.

    ``offsets`` holds one ``(_pid, _first, _off, _cnt)`` row per non-empty
    range partition - a bound set by the partition count, not the data.
    ``after_sort`` (order-preserving narrow steps) runs before the numbering.
    """
    t = _sorted_numbered(df, order, name, after_sort=after_sort)
    offs = [tuple(r) for r in _partition_offsets(t, ()).select("_pid", "_first", "_off", "_cnt").collect()]
    return t, offs


def mids_for_ranks(offsets, ranks: Sequence[int]) -> list[int]:
    """Row numbers (``_mid``) of 0-based global ranks, from the partition offsets."""
    out = []
    for r in ranks:
        for pid, first, off, cnt in offsets:
            if off <= r < off + cnt:
                out.append(first + r - off)
                break
    return out


def attach_row_numbers(t: DataFrame, offsets, id_col: str, start: int = 1) -> DataFrame:
    local = t.sparkSession.createDataFrame([o[:3] for o in offsets], "_pid long, _first long, _off long")
    out = (t.withColumn("_pid", F.shiftright("_mid", _LOW_BITS))
           .join(F.broadcast(local), "_pid")
           .withColumn(id_col, (F.col("_off") + F.col("_mid") - F.col("_first") + F.lit(start)).cast("long")))
    return out.drop("_pid", "_first", "_off")


def row_numbers(df: DataFrame, order: Sequence[Column | str], id_col: str,
                start: int = 1, name: str = "numbered") -> DataFrame:
    """Append ``id_col`` = position in ``order`` (ascending, from ``start``).

    ``order`` must end with a unique tie-break for the numbering to be
    deterministic. The per-partition offsets (one row per range partition of
    the sort, read from the ``_mid`` column alone) are computed once and
    broadcast as a local table; the result is a lazy frame over the
    materialised sorted rows.
    """
    t, offs = numbered_table(df, order, name)
    return attach_row_numbers(t, offs, id_col, start).drop("_mid")


#: Size parameter of a stored sketch: a rank it gives is off by 0.13 % of the group at most, nearly always.
SKETCH_SIZE = 4096
SKETCH_ERROR = 0.0013


def group_sketches(df: DataFrame, value: Column | str, by: Sequence[str] = (), sums: dict | None = None) -> DataFrame:
    """What ``exact_percentiles`` must know of a table before it looks for ranks, in a form that can be kept and merged.

    One row per group: count, extremes and a KLL sketch of the values, and the totals of ``sums`` (as there). Nulls are left out.
    """
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    base = df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull())
    return base.groupBy(*by).agg(F.count("_x").alias("_n"), F.min("_x").alias("_min"), F.max("_x").alias("_max"),
                                 F.kll_sketch_agg_double("_x", SKETCH_SIZE).alias("_sketch"),
                                 *[F.sum(f(F.col("_x"))).alias(k) for k, f in dict(sums or {}).items()])


def merge_sketches(tables: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """The sketches of several parts of a table as those of the whole; they must have been made with the same ``by`` and ``sums``."""
    both = tables[0]
    for t in tables[1:]:
        both = both.unionByName(t)
    totals = [c for c in both.columns if c not in (*by, "_n", "_min", "_max", "_sketch")]
    return both.groupBy(*by).agg(F.sum("_n").alias("_n"), F.min("_min").alias("_min"), F.max("_max").alias("_max"),
                                 F.kll_merge_agg_double("_sketch", SKETCH_SIZE).alias("_sketch"), *[F.sum(c).alias(c) for c in totals])


def exact_percentiles(df: DataFrame, value: Column | str, probs: Sequence[float],
                      by: Sequence[str] = (), names: Sequence[str] | None = None,
                      approx: bool = False, accuracy: int = 10_000, max_groups: int | None = None,
                      count_col: str | None = None, sums: dict | None = None, name: str = "pct",
                      sketches: DataFrame | None = None) -> DataFrame:
    """One row per group of ``by`` with one column per probability.

    Semantics of ``percentile_cont(p) WITHIN GROUP (ORDER BY value)``: nulls
    ignored, position ``p*(n-1)`` linearly interpolated. ``approx=True`` stops
    at the sketch (``percentile_approx``). ``max_groups`` is a caller-proven
    bound on the number of groups; with it (or without ``by``) the bracket
    table (one row per group) is broadcast. ``count_col`` adds the number of
    non-null values per group; ``sums`` ({name: f}) the group total of
    ``f(value)`` per row (means and threshold counts).

    Exact results by bracket selection, so that only a sliver of the rows is
    ever shuffled: (1) one map-side combined aggregate gives each group's
    count, extremes, sums and a quantile sketch, hence a value bracket around
    every wanted rank; (2) a second scan counts the rows below, at and inside
    each bracket; (3) rows strictly inside a bracket whose end values don't
    hold the wanted ranks - about ``4 / accuracy`` of the group at most, and
    none among ties - are range-sorted and the ranks looked up. A bracket that
    missed its rank is widened to the extremes, so the result is always exact.
    ``sketches`` (``group_sketches`` of ``df`` with the same value, ``by`` and
    ``sums``, or ``merge_sketches`` of its parts') replaces the first scan: of an
    appended-to table only the new rows are sketched.
    """
    sums = dict(sums or {})
    by = list(by)
    names = list(names) if names is not None else [f"p{int(round(p * 100))}" for p in probs]
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    base = df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull())
    extra = [F.sum(f(F.col("_x"))).alias(k) for k, f in sums.items()]
    if approx:
        arr = F.percentile_approx("_x", list(probs), accuracy)
        return (base.groupBy(*by).agg(arr.alias("_q"), F.min("_x").alias("_min"), F.max("_x").alias("_max"),
                                      *([F.count("_x").alias(count_col)] if count_col else []), *extra)
                .select(*by, *[(F.col("_min") if p <= 0 else F.col("_max") if p >= 1 else F.col("_q")[i]).alias(n)
                               for i, (p, n) in enumerate(zip(probs, names))],
                        *([count_col] if count_col else []), *sums))

    step = 2.0 / accuracy if sketches is None else 3 * SKETCH_ERROR
    marks = [m for p in probs for m in (max(0.0, p - step), min(1.0, p + step))]
    if sketches is None:
        stats = base.groupBy(*by).agg(F.count("_x").alias("_n"), F.min("_x").alias("_min"), F.max("_x").alias("_max"),
                                      F.percentile_approx("_x", marks, accuracy).alias("_q"), *extra)
    else:
        told = F.array(*[F.kll_sketch_get_quantile_double("_sketch", F.lit(float(m))) for m in marks])
        stats = sketches.select(*by, "_n", "_min", "_max", told.alias("_q"), *sums)
    if not by:
        stats = stats.where(F.col("_n") > 0)
    bounded = not by or max_groups is not None

    def kept(rows: DataFrame, stage: str) -> DataFrame:
        """A row per group, or per group and probability: a local table where the groups are bounded, else a stored one."""
        return _local(rows) if bounded else materialize(rows, f"{name}_{stage}")

    stats = kept(stats, "stats")

    def targets(widened: DataFrame | None) -> DataFrame:
        """(by..., _targets): one struct per probability with the ranks wanted and the bracket's ends."""
        rows = stats
        wide = F.lit(False)
        if widened is not None:
            rows, wide = _left_on(rows, widened, by), F.coalesce("_wide", F.lit(False))
        items = []
        for i, p in enumerate(probs):
            h = F.lit(float(p)) * (F.col("_n") - 1).cast("double")
            low = F.col("_min") if marks[2 * i] <= 0 else F.when(wide, F.col("_min")).otherwise(F.col("_q")[2 * i])
            high = F.col("_max") if marks[2 * i + 1] >= 1 else F.when(wide, F.col("_max")).otherwise(F.col("_q")[2 * i + 1])
            items.append(F.struct(h.alias("h"), F.floor(h).cast("long").alias("r0"), F.ceil(h).cast("long").alias("r1"),
                                  low.alias("lo"), high.alias("hi")))
        return rows.select(*by, F.array(*items).alias("_targets"))

    def counted(goal: DataFrame) -> DataFrame:
        """Per group and probability: rows below lo, up to lo, and below hi."""
        joined = _left_on(base, F.broadcast(goal) if bounded else goal, by)
        aggs = []
        for i in range(len(probs)):
            t = F.col("_targets")[i]
            aggs += [F.count(F.when(F.col("_x") < t["lo"], 1)).alias(f"_b{i}"), F.count(F.when(F.col("_x") <= t["lo"], 1)).alias(f"_e{i}"),
                     F.count(F.when(F.col("_x") < t["hi"], 1)).alias(f"_u{i}"), F.count(F.when(F.col("_x") <= t["hi"], 1)).alias(f"_v{i}")]
        out = _left_on(goal, joined.groupBy(*by).agg(*aggs), by)
        items = F.array(*[F.struct(F.lit(i).alias("i"), *[F.col("_targets")[i][c].alias(c) for c in ("h", "r0", "r1", "lo", "hi")],
                                   F.col(f"_b{i}").alias("b"), F.col(f"_e{i}").alias("e"), F.col(f"_u{i}").alias("u"),
                                   F.col(f"_v{i}").alias("v")) for i in range(len(probs))])
        return out.select(*by, F.inline(items))

    found = kept(counted(targets(None)), "counts")
    missed = found.where((F.col("r0") < F.col("b")) | (F.col("r1") >= F.col("v"))).select(*by).distinct()
    if missed.limit(1).count():
        wide = missed.withColumn("_wide", F.lit(True))
        found = kept(counted(targets(wide)), "widened")
    # A rank is at the lower end, at the upper end, or strictly inside.
    inside = found.where(((F.col("r0") >= F.col("e")) & (F.col("r0") < F.col("u"))) | ((F.col("r1") >= F.col("e")) & (F.col("r1") < F.col("u"))))
    goals = kept(inside, "goals")
    if bounded and goals.isEmpty():  # every rank is an end of its bracket: nothing is sorted
        return _at_ranks(found.withColumn("_at", F.lit(None).cast("map<bigint,double>")), stats, by, names, count_col, sums)
    keys = [*by, "i"]
    nest = goals.groupBy(*by).agg(F.collect_list(F.struct("i", "lo", "hi")).alias("_goal"))  # at most one per probability
    sliver = (_left_on(base, F.broadcast(nest) if bounded else nest, by, how="inner")
              .select(*by, "_x", F.explode("_goal").alias("_g"))
              .where((F.col("_x") > F.col("_g.lo")) & (F.col("_x") < F.col("_g.hi"))).select(*by, F.col("_g.i").alias("i"), "_x"))
    t = _sorted_numbered(sliver, [*keys, "_x"], f"{name}_sliver")
    offsets = _partition_offsets(t, keys)
    want = goals.select(*keys, F.explode(F.array_distinct(F.array("r0", "r1"))).alias("_r"), "e", "u").where(
        (F.col("_r") >= F.col("e")) & (F.col("_r") < F.col("u"))).withColumn("_k", F.col("_r") - F.col("e"))
    spots = (_left_on(want, offsets, keys, how="inner").where((F.col("_k") >= F.col("_off")) & (F.col("_k") < F.col("_off") + F.col("_cnt")))
             .select(*keys, "_r", (F.col("_first") + F.col("_k") - F.col("_off")).alias("_mid")))
    picked = t.select("_mid", "_x").join(F.broadcast(spots) if bounded else spots, "_mid").select(*keys, "_r", "_x")
    hit = picked.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_r", "_x"))).alias("_at"))  # two ranks at most
    return _at_ranks(_left_on(found, hit, keys), stats, by, names, count_col, sums)


def _at_ranks(rows: DataFrame, stats: DataFrame, by: Sequence[str], names: Sequence[str], count_col: str | None, sums: dict) -> DataFrame:
    """One row per group from one per group and probability with the values found strictly inside its bracket (``_at``: rank -> value)."""

    def at(rank: str) -> Column:
        r = F.col(rank)
        return F.when(r < F.col("e"), F.col("lo")).when(r >= F.col("u"), F.col("hi")).otherwise(F.element_at("_at", r))

    rows = rows.withColumn("_v", at("r0") + (F.col("h") - F.floor("h")) * (at("r1") - at("r0")))
    per_group = rows.groupBy(*by).agg(*[F.max(F.when(F.col("i") == i, F.col("_v"))).alias(n) for i, n in enumerate(names)])
    totals = stats.select(*by, *([F.col("_n").alias(count_col)] if count_col else []), *sums)
    out = _left_on(per_group, totals, by) if by or count_col or sums else per_group
    return out if by else out.where(F.col(names[0]).isNotNull())  # no rows: no result row


def _local(rows: DataFrame) -> DataFrame:
    """The rows as a local table; only for tables whose size the caller has bounded."""
    return rows.sparkSession.createDataFrame(rows.toArrow())


def _left_on(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``by`` with null keys equal to each other; without keys, ``right`` has one row at most."""
    if not by:
        return left.join(right, F.lit(True), how)
    renamed = right.select(*[F.col(c).alias(f"_by_{c}") if c in by else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for c in by:
        cond = cond & left[c].eqNullSafe(renamed[f"_by_{c}"])
    return left.join(renamed, cond, how).drop(*[f"_by_{c}" for c in by])
