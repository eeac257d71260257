"""Quality rules as weak supervision, with DataFrame functions only.

Every rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation
over the counts of vote patterns (at most 3^rules of them, however many
documents there are) estimates each rule's accuracy on good and on bad
documents (how often a vote is a false alarm, how often a fault is caught) and
the share of good documents; a document's posterior probability replaces
all-must-pass filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgauge.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
#: Votes: bad where the first condition holds, good where the second does, else none. Conditions are on the measures.
RULES = {
    "length": ("n_words < 50", "n_words >= 80"),
    "word_size": ("word_chars < 2 * n_words", "word_chars between 3 * n_words and 12 * n_words"),
    "symbols": ("5 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    "repeated_lines": ("2 * n_dup_lines > n_lines", "10 * n_dup_lines <= n_lines"),
    "repeated_words": ("100 * n_repeat_words > 50 * n_words", "100 * n_repeat_words <= 20 * n_words"),
    "symbol_chars": ("30 * n_symbols > word_chars", "200 * n_symbols <= word_chars"),
    "symbol_words": ("100 * n_symbol_words > 15 * n_words", "100 * n_symbol_words <= 3 * n_words"),
    "letters": ("2 * n_letter_words < n_words", "10 * n_letter_words >= 8 * n_words"),
}
ROUNDS = 30
#: Where the fit starts: share of good documents, bad votes among a rule's votes on good and on bad documents. Pseudo-votes
#: of the same shares (PSEUDO of them, and a fiftieth of the documents) hold the fit there where votes say little.
SHARE, ALARM, CATCH, PSEUDO = 0.9, 0.01, 0.5, 10


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines (lines with a word), n_dup_lines, n_repeat_words, n_letter_words, n_symbol_words (long)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumn("_text", text)
    rows = rows.withColumn("_words", F.filter(F.split("_text", SPACES), lambda w: w != ""))
    rows = rows.withColumn("_n", F.size("_words"))
    # Windows sorted by hash: those with an equal neighbour occur twice or more.
    window = F.transform(F.sequence(F.lit(1), F.col("_n") - 2), lambda i: F.struct(
        F.xxhash64(F.element_at("_words", i), F.element_at("_words", i + 1), F.element_at("_words", i + 2)).alias("h"), i.alias("i")))
    rows = rows.withColumn("_sorted", F.when(F.col("_n") >= 4, F.sort_array(window)))
    size = F.size("_sorted")
    same = lambda s, k: (k >= 0) & (k < size) & (F.get("_sorted", k)["h"] == s["h"])
    twice = F.filter("_sorted", lambda s, k: F.coalesce(same(s, k - 1) | same(s, k + 1), F.lit(False)))
    rows = rows.withColumn("_places", F.sort_array(F.transform(twice, lambda s: s["i"])))
    # A marked window adds its three words, or only those behind the window before it.
    added = F.aggregate(F.transform("_places", lambda i, k: F.when(k == 0, F.lit(3)).otherwise(F.least(F.lit(3), i - F.get("_places", k - 1)))),
                        F.lit(0), lambda a, x: a + x)
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.regexp_replace(x, SPACES, "")) > 0)
    rows = rows.withColumn("_lines", lines)
    long = lambda c: c.cast("long")
    return rows.withColumns({
        "n_words": long(F.col("_n")),
        "word_chars": long(F.length(F.regexp_replace("_text", SPACES, ""))),
        "n_symbols": long(F.length("_text") - F.length(F.regexp_replace("_text", r"[#*$%&|<>]+", ""))),
        "n_lines": long(F.size("_lines")),
        "n_dup_lines": long(F.size("_lines") - F.size(F.array_distinct("_lines"))),
        "n_repeat_words": long(F.coalesce(added, F.lit(0))),
        "n_symbol_words": long(F.size(F.filter("_words", lambda w: w.rlike(r"[#*$%&|<>]")))),
        "n_letter_words": long(F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}")))),
    }).drop("_text", "_words", "_n", "_sorted", "_places", "_lines")


def votes(rules: dict[str, tuple[str, str]] = RULES) -> Column:
    """The array of votes, in the rules' order."""
    return F.array(*(F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0) for bad, good in rules.values()))


def _posterior(vote: Column, share: Column, alarm: Column, catch: Column) -> Column:
    """P(good | votes), from the log odds that each vote adds."""
    weight = F.transform(F.arrays_zip(vote.alias("v"), alarm.alias("a"), catch.alias("c")), lambda r: F.when(r["v"] == -1, F.log(r["a"] / r["c"])).when(
        r["v"] == 1, F.log((1 - r["a"]) / (1 - r["c"]))).otherwise(0.0))
    return 1 / (1 + F.exp(-F.aggregate(weight, F.log(share / (1 - share)), lambda s, x: s + x)))


def fit(voted: DataFrame, n_rules: int, rounds: int = ROUNDS) -> DataFrame:
    """One row (share, alarm, catch): the result of ``rounds`` EM steps over the ``votes`` column of all rows.

    alarm and catch hold, for each rule, the share of bad votes among its votes on good and on bad documents. Bounds and
    pseudo-votes keep them away from 0 and 1 and make the fit defined for no rows at all.
    """
    patterns = voted.groupBy("votes").agg(F.count("*").cast("double").alias("n"))
    table = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("t"))
    table = table.withColumn("w", PSEUDO + 0.02 * F.aggregate(F.transform("t", lambda p: p["n"]), F.lit(0.0), lambda s, x: s + x))

    def total(rows, of):
        return F.aggregate(F.transform(rows, of), F.lit(0.0), lambda s, x: s + x)

    def clamp(x, low, high):
        return F.greatest(F.lit(low), F.least(F.lit(high), x))

    def bad(p, j):
        return F.when(F.get(p["votes"], j) == -1, p["n"]).otherwise(0.0)

    def cast(p, j):
        return p["n"] * F.abs(F.get(p["votes"], j))

    def step(now, _):
        scored = F.transform("t", lambda p: F.struct(p["votes"].alias("votes"), p["n"].alias("n"),
                                                     _posterior(p["votes"], now["share"], now["alarm"], now["catch"]).alias("q")))
        each = F.sequence(F.lit(0), F.lit(n_rules - 1))
        w = F.col("w")
        # The one-element transform names the scored patterns, so that they are computed once a step.
        return F.transform(F.array(scored), lambda s: F.struct(
            clamp((total(s, lambda p: p["n"] * p["q"]) + w * SHARE) / (total(s, lambda p: p["n"]) + w), 0.02, 0.98).alias("share"),
            F.transform(each, lambda j: clamp((total(s, lambda p: bad(p, j) * p["q"]) + w * ALARM) / (total(s, lambda p: cast(p, j) * p["q"]) + w), 0.001, 0.45)).alias("alarm"),
            F.transform(each, lambda j: clamp((total(s, lambda p: bad(p, j) * (1 - p["q"])) + w * CATCH) / (total(s, lambda p: cast(p, j) * (1 - p["q"])) + w), 0.05, 0.99)).alias("catch")))[0]

    start = F.struct(F.lit(SHARE).alias("share"), F.array_repeat(F.lit(ALARM), n_rules).alias("alarm"), F.array_repeat(F.lit(CATCH), n_rules).alias("catch"))
    return table.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step).alias("m")).select("m.*")


def judge(docs: DataFrame, text_col: str = "text", rules: dict[str, tuple[str, str]] = RULES, keep_text: bool = True) -> DataFrame:
    """All rows with the measures, ``votes``, ``p_good``, ``base_failed`` and ``kept``.

    base_failed: n_words < 50, or more than half the words repeat; such rows are never kept, the others are if their
    posterior is at least one half. A null or empty text has no words and fails. Ties and repeated rows are judged alike;
    input columns of the new names are replaced. An empty table gives an empty one.
    ``keep_text`` false leaves the text out. The rows are written once between fit and verdict, so texts are measured once.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words", "n_symbol_words", "votes", "p_good", "base_failed", "kept"]
    measured = measures(docs.drop(*names), text_col).withColumn("votes", votes(rules))
    voted = materialize(measured if keep_text else measured.drop(text_col), "quality_votes")
    model = fit(voted, len(rules)).first()  # a share and two numbers a rule
    share, alarm, catch = F.lit(model["share"]), *(F.array(*(F.lit(x) for x in model[c])) for c in ("alarm", "catch"))
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    return voted.withColumns({"p_good": _posterior(F.col("votes"), share, alarm, catch), "base_failed": failed}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))
