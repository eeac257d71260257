"""Secret scans: all rules compiled into one minimal byte automaton, run over whole texts in one pass."""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripgauge.llm.automaton import Scanner
from tripgauge.llm.runtime import carried, map_batches, steps


@dataclass(frozen=True)
class Rule:
    """A kind of secret. least: characters that the match needs, or its value (what follows the first accepting byte) if
    ``by_value``; shorter matches are found and dropped, so they still hide what they overlap."""

    kind: str
    pattern: str
    least: int = 0
    by_value: bool = False
    any_case: bool = False


#: The first three are the base kinds; the others widen the scan.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 6, True, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
RULES = BASE_RULES + (
    Rule("hosting", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


@functools.lru_cache(maxsize=8)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner.compile([(r.pattern, r.any_case) for r in rules])


def spans_of(texts: list[bytes], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) of every text in code points, by start, then in the rules' order."""
    out = []
    for text, found in zip(texts, scanner(rules).spans(texts)):
        kept = [(k, s, e) for k, s, e, f in found if (e - f if rules[k].by_value else e - s) >= rules[k].least]
        if kept and not text.isascii():
            lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
            before = np.append(0, np.cumsum(lead))
            kept = [(k, int(before[s]), int(before[e])) for k, s, e in kept]
        out.append([(rules[k].kind, s, e) for k, s, e in kept])
    return out


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span replaced by a mark of its kind; overlapping spans are one."""
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def find_secrets(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, mask: bool = False,
                 keep: list[str] | None = None) -> DataFrame:
    """Adds ``secret_spans`` (kind, start, end in code points, end exclusive) to every row; ``mask`` replaces the spans in the text.

    The rules' automaton is built once in each Python worker and scans whole texts side by side; no row is shuffled.
    A null text has no spans and stays null. Rows, ties, repeated rows and row counts stay as they are; an input column
    named ``secret_spans`` is replaced. ``keep`` names the columns to carry (all by default). An empty table gives an empty one.
    """
    source = docs if keep is None else docs.select(*dict.fromkeys([*keep, text_col]))
    passed = [f for f in carried(source, {"secret_spans"}) if keep is None or f.name in keep]
    schema = T.StructType([*passed, T.StructField("secret_spans", T.ArrayType(SPAN))])

    def scan(batch):
        for part, texts in steps(batch, text_col):
            found = spans_of(texts, rules)
            columns = {f.name: part.column(part.schema.get_field_index(f.name)) for f in passed}
            if mask and text_col in columns:
                columns[text_col] = [None if v is None else masked(v, s) if s else v
                                     for v, s in zip(columns[text_col].to_pylist(), found)]
            yield columns | {"secret_spans": [[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in found]}

    return map_batches(source, scan, schema)
