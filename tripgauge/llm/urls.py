"""URL filters: a blocked Bloom filter passes possible hits to an exact hash join.

Listed entries are canonical ``host/path-prefix`` strings that fit a host and
all its subdomains. A URL's host has one suffix for each number of labels that
listed hosts have; a first filter over the listed hosts and an exact join tell
which of them are listed, and with which path lengths. Only those give
candidate entries, which the second filter, over whole entries, passes to the
exact join. A filter's 512-bit blocks are rows of eight longs; one hash picks
the block and eight bits in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.session import materialize

WORDS = 8
#: Blocks of the filter at most: 2^20 x 64 bytes. Longer lists only raise the share of false positives, which the join removes.
MAX_BLOCKS = 1 << 20
ENTRIES_PER_BLOCK = 48
#: A URL on more rows than this, and than 1/10,000 of all rows, is hot.
HOT_ROWS = 1_000


def _after(text, mark: str, otherwise):
    at = F.instr(text, mark)
    return F.when(at > 0, F.substring(text, at + len(mark), F.length(text))).otherwise(otherwise)


def split_url(url):
    """(host, path) columns. Host: behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from
    there up to ``?``, ``#`` or the end. Null, or no ``://``: both empty."""
    rest = F.coalesce(_after(url, "://", F.lit("")), F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def _places(key, blocks: int):
    """The block of a key, and its bit in each of the block's eight words."""
    g = F.xxhash64(key, F.lit(1))
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"), [F.shiftrightunsigned(g, 6 * w).bitwiseAND(F.lit(63)).cast("int") for w in range(WORDS)]


def build_filter(entries: DataFrame, key: str, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """(block, w0..w7) rows of the blocked Bloom filter over ``entries[key]`` and the number of blocks."""
    n = entries.count()
    blocks = max(1, min(max_blocks, -(-n // ENTRIES_PER_BLOCK)))
    block, bits = _places(F.col(key), blocks)
    rows = entries.select(block.alias("block"), *(b.alias(f"b{w}") for w, b in enumerate(bits))).select(
        "block", *(F.expr(f"shiftleft(1L, b{w})").alias(f"w{w}") for w in range(WORDS)))
    return rows.groupBy("block").agg(*(F.bit_or(f"w{w}").alias(f"w{w}") for w in range(WORDS))), blocks


def possible(probes: DataFrame, key: str, entries: DataFrame, entry: str, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """The rows of ``probes`` whose ``key`` may be among ``entries[entry]``: all that are, and few others."""
    bloom, blocks = build_filter(entries, entry, max_blocks)
    block, bits = _places(F.col(key), blocks)
    hits = probes.withColumns({"block": block} | {f"b{w}": b for w, b in enumerate(bits)}).join(F.broadcast(bloom), "block")
    for w in range(WORDS):
        hits = hits.filter(F.expr(f"shiftrightunsigned(w{w}, b{w}) & 1L = 1"))
    return hits.select(*probes.columns)


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to every row.

    rules: (host, path, verdict). A rule fits its host and subdomains if the URL's path starts with the rule's; the
    longest (then the longest host, then the last in string order) wins. URLs without a rule, without a host, and null URLs get a
    null ``rule`` and ``default``. Repeated rules count once; repeated rows stay. Input columns of the new names are replaced.

    Only (distinct host and path) keys are probed and joined, so copies of one URL cost one row. The filters are
    broadcast: their size is bounded by ``max_blocks``. The possible hits meet the rules in hash joins. Any number of
    rules, path lengths and labels is looked up; a URL is only probed at the lengths listed for its own host suffixes.
    The verdicts of the keys that most rows bear are broadcast (at most 10,000), so no join deals the rows by a hot key.
    """
    new = ("host", "path", "rule", "verdict")
    rules = rules.select(F.col("host").alias("_rh"), F.concat("host", "path").alias("_rule"), F.length("host").alias("_hl"), F.length("path").alias("_pl"),
                         F.col("verdict").alias("_verdict")).groupBy("_rh", "_rule", "_hl", "_pl").agg(F.min("_verdict").alias("_verdict"))
    keyed = rules.withColumn("_key", F.concat_ws("\u0001", "_rh", F.expr("substring(_rule, _hl + 1)")))
    listed = keyed.groupBy("_rh").agg(F.sort_array(F.collect_set("_pl")).alias("_lengths"))  # distinct lengths: no more than the longest path has characters
    labels = lambda host: F.size(F.split(host, r"\."))
    # One row: as many numbers at most as the longest listed host has labels.
    counts = [r[0] for r in listed.select(labels(F.col("_rh")).alias("n")).distinct().orderBy("n").collect()]
    host, path = split_url(F.col(url_col))
    rows = pages.drop(*new).withColumns({"host": host, "path": path})
    urls = materialize(rows.filter("host <> ''").groupBy("host", "path").agg(F.count("*").alias("_copies")), "url_keys")
    fits = F.filter(F.array(*(F.lit(n) for n in counts)), lambda n: n <= labels(F.col("host"))) if counts else F.array().cast("array<int>")
    hosts = urls.select("host").distinct().withColumn("_n", F.explode(fits)).withColumn("_rh", F.expr("substring_index(host, '.', -_n)"))
    held = materialize(possible(hosts.select("host", "_rh"), "_rh", listed, "_rh", max_blocks).join(listed, "_rh"), "listed_hosts")
    # A host with very many paths is a hot key here too; the planner may split its rows, as each meets one row a suffix.
    near = urls.join(held, "host").withColumn("_length", F.explode(F.filter("_lengths", lambda n: n <= F.length("path"))))
    probes = near.select("host", "path", F.concat_ws("\u0001", "_rh", F.expr("substring(path, 1, _length)")).alias("_key"))
    best = possible(probes, "_key", keyed, "_key", max_blocks).join(keyed.drop("_rh"), "_key").groupBy("host", "path").agg(
        F.max_by(F.struct("_rule", "_verdict"), F.struct(F.length("_rule"), "_hl", "_rule")).alias("_best"))
    best = materialize(best.join(urls, ["host", "path"]).select("host", "path", "_best", "_copies"), "url_verdicts")
    often = F.col("_copies") > F.greatest(F.lit(HOT_ROWS), F.lit(int(urls.agg(F.coalesce(F.sum("_copies"), F.lit(0))).first()[0]) // 10_000))
    hot = urls.filter(often).join(best.drop("_copies"), ["host", "path"], "left").select("host", "path", "_best", F.lit(True).alias("_hot"))
    told = rows.join(F.broadcast(hot), ["host", "path"], "left").withColumn("_hot", F.coalesce("_hot", F.col("host") == ""))
    cold = told.filter("NOT _hot").drop("_best").join(best.filter(~often).drop("_copies"), ["host", "path"], "left")
    both = told.filter("_hot").unionByName(cold)
    return both.withColumns({"rule": F.col("_best._rule"), "verdict": F.coalesce(F.col("_best._verdict"), F.lit(default))}).drop("_best", "_hot")
