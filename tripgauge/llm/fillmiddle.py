"""Fill-in-middle transformation by displacement scatter.

A batch's texts lie one after another in one byte buffer. A scan finds the
cuts of every text; each piece (prefix, middle, suffix) moves as a whole, so
the output place of a byte is its own place plus its piece's shift. A
difference array holds the change of shift at the first byte of each piece;
its cumulative sum is every byte's shift, and one numpy scatter writes the
output, into which the marks are then written. The way back finds the marks,
makes the same shifts and gathers instead of scattering.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.llm.runtime import carried, map_batches, steps

#: FIXED VALUES: the marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
#: Text bytes held in one step, and bytes whose shifts are held at a time.
STEP, WINDOW = 4 << 20, 1 << 20


def move(source: np.ndarray, target: np.ndarray, starts: np.ndarray, shifts: np.ndarray, gather: bool = False) -> None:
    """Byte i of ``source`` goes to place i + shift of ``target``, where the shift is that of the last of ``starts`` (rising,
    0 first) at or before i. With ``gather``, byte i of ``target`` comes from place i + shift of ``source``."""
    length = len(target) if gather else len(source)
    change = np.diff(shifts, prepend=0)
    for a in range(0, length, WINDOW):
        b = min(a + WINDOW, length)
        i, j = np.searchsorted(starts, [a, b])
        delta = np.zeros(b - a, np.int64)
        np.add.at(delta, starts[i:j] - a, change[i:j])  # empty pieces share a start
        delta[0] += change[:i].sum()
        place = np.cumsum(delta) + np.arange(a, b)
        if gather:
            target[a:b] = source[place]
        else:
            target[place] = source[a:b]


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts as one buffer, and where each begins (and the last ends)."""
    ends = np.cumsum([0, *map(len, texts)])
    return np.frombuffer(b"".join(texts), np.uint8), ends


def _found(buffer: np.ndarray, mark: bytes) -> np.ndarray:
    """Every place where ``mark`` begins."""
    if len(buffer) < MARK:
        return np.empty(0, np.int64)
    at = np.flatnonzero(buffer[:-2] == mark[0])
    return at[(buffer[at + 1] == mark[1]) & (buffer[at + 2] == mark[2])]


def _holds(buffer: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which texts contain a mark (one that runs over the end of a text doesn't count)."""
    out = np.zeros(len(ends) - 1, bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        at = _found(buffer, mark)
        text = np.searchsorted(ends, at, side="right") - 1
        out[text[at + MARK <= ends[text + 1]]] = True
    return out


def _strings(buffer: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A large-offset string array over the buffer."""
    return pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(buffer)])


def _layout(spm: np.ndarray, plain: np.ndarray, sizes: list[np.ndarray], at: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Where the contents of prefix, middle and suffix, and their marks, begin in the output. ``at``: where each text's output begins."""
    p, m, s = sizes
    lead = np.where(spm, s + MARK, 0)  # what stands before the prefix's mark
    marks = [at + lead, at + p + s + 2 * MARK, np.where(spm, at, at + p + MARK)]
    places = [np.where(plain, at + before, mark + MARK) for mark, before in zip(marks, (0, p, p + m))]
    return places, marks


def rearrange(texts: list[bytes], draws: list[tuple[int, int, int, int]], rate: int, spm_share: int) -> dict:
    """Columns n, form, prefix_bytes, middle_bytes, prefix_chars, middle_chars, output of the texts. See ``fill_in_middle``."""
    buffer, ends = _joined(texts)
    first, last = ends[:-1], ends[1:]
    lines = np.flatnonzero(buffer == 10) + 1  # a unit ends after each line feed, and at the end of the text
    before, upto = np.searchsorted(lines, first, side="right"), np.searchsorted(lines, last, side="right")
    count = upto - before
    open_end = (last > first) & (buffer[np.maximum(last - 1, 0)] != 10) if len(buffer) else np.zeros(len(first), bool)
    n = count + open_end
    h = np.array(draws, np.int64).reshape(-1, 4)
    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)

    def cut(units: np.ndarray) -> np.ndarray:
        inner = lines[np.minimum(before + np.maximum(units, 1), len(lines)) - 1] if len(lines) else last
        return np.where(units == 0, first, np.where(units > count, last, inner))

    c1, c2 = cut(np.minimum(one, two)), cut(np.maximum(one, two))
    plain = (last == first) | _holds(buffer, ends) | (h[:, 2] % 100 >= rate)
    spm = ~plain & (h[:, 3] % 100 < spm_share)
    sizes = [c1 - first, c2 - c1, last - c2]
    out_ends = np.concatenate([[0], np.cumsum(last - first + np.where(plain, 0, 3 * MARK))])
    places, marks = _layout(spm, plain, sizes, out_ends[:-1])
    output = np.empty(out_ends[-1], np.uint8)
    starts = np.stack([first, c1, c2], 1).ravel()
    move(buffer, output, starts, np.stack(places, 1).ravel() - starts)
    for at, mark in zip(marks, (PREFIX, MIDDLE, SUFFIX)):
        output[at[~plain, None] + np.arange(MARK)] = np.frombuffer(mark, np.uint8)
    heads = np.flatnonzero((buffer & 0xC0) != 0x80)  # first bytes of code points
    chars = [np.searchsorted(heads, b) - np.searchsorted(heads, a) for a, b in ((first, c1), (c1, c2))]
    return {"n": pa.array(n, pa.int64()), "form": pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).tolist(), pa.string()),
            "prefix_chars": pa.array(chars[0], pa.int64(), mask=plain), "middle_chars": pa.array(chars[1], pa.int64(), mask=plain),
            "output": _strings(output, out_ends)}


def put_back(outputs: list[bytes], forms: list[str]) -> pa.Array:
    """The texts that ``rearrange`` was given, from its outputs and forms alone."""
    buffer, ends = _joined(outputs)
    first, last = ends[:-1], ends[1:]
    plain, spm = np.array([f not in ("psm", "spm") for f in forms], bool), np.array([f == "spm" for f in forms], bool)
    held = {}
    for mark in (PREFIX, SUFFIX, MIDDLE):
        at = _found(buffer, mark)
        text = np.searchsorted(ends, at, side="right") - 1
        good = ~plain[text] & (at + MARK <= last[text])
        at, text = at[good], text[good]
        if not np.array_equal(text, np.flatnonzero(~plain)):
            raise ValueError("an output of form psm or spm must hold each mark once")
        held[mark] = first.copy()
        held[mark][text] = at
    # psm: <P>prefix<S>suffix<M>middle; spm: <S>suffix<P>prefix<M>middle. Each piece ends where the next mark begins.
    begin = [held[m] + MARK for m in (PREFIX, MIDDLE, SUFFIX)]
    stop = [np.where(spm, held[MIDDLE], held[SUFFIX]), last, np.where(spm, held[PREFIX], held[MIDDLE])]
    size = [np.where(plain, 0, b - a) for a, b in zip(begin, stop)]
    size[0] = np.where(plain, last - first, size[0])
    begin[0] = np.where(plain, first, begin[0])
    text_ends = np.concatenate([[0], np.cumsum(sum(size))])
    restored = np.empty(text_ends[-1], np.uint8)
    at = text_ends[:-1]
    starts = np.stack([at, at + size[0], at + size[0] + size[1]], 1).ravel()
    move(buffer, restored, starts, np.stack(begin, 1).ravel() - starts, gather=True)
    return _strings(restored, text_ends)


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm_share: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   keep: list[str] | None = None) -> DataFrame:
    """The rows with n, form, prefix_chars, middle_chars and output; ``keep`` names the input columns to carry (default: all).

    A text is n lines, each with its line feed. Two cuts between lines, its ends included, part it into prefix, middle and
    suffix; output is ``<P>prefix<S>suffix<M>middle`` (psm) or ``<S>suffix<P>prefix<M>middle`` (spm). The cuts and the form
    come from the SHA-256 of ``seed:id``, so a row's result depends on nothing else: ``rate`` per cent of the rows are
    rearranged, ``spm_share`` per cent of them as spm. Empty texts and those with a mark stay plain: output is the text, and
    the sizes (code points) are null. A null text is empty; a null id counts as an empty string. Repeated rows give
    repeated results; input columns of the new names are replaced.
    """
    new = T.StructType([T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
                        T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])
    names = [c for c in (docs.columns if keep is None else keep) if c not in new.names]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    source = docs.select(*[F.col(f"`{c}`") for c in names], digest.alias("_fim_digest"), F.col(f"`{text_col}`").alias("_fim_text"))
    own = carried(source.select(*[f"`{c}`" for c in names]), set(new.names))

    def run(batch):
        for part, texts in steps(batch, "_fim_text", STEP):
            digests = part.column(len(names)).to_pylist()
            draws = [tuple(int(d[k:k + 8], 16) for k in (0, 8, 16, 24)) for d in digests]
            yield {f.name: part.column(k) for k, f in enumerate(own)} | rearrange(texts, draws, rate, spm_share)

    return map_batches(source, run, T.StructType([*own, *new.fields]))


def restore(rows: DataFrame, output_col: str = "output", form_col: str = "form", restored_col: str = "restored") -> DataFrame:
    """Adds the text rebuilt from output and form alone (``restored_col`` is replaced). A null output gives an empty text, a
    null or other form is taken as plain; a rearranged output without its three marks is an error."""
    names = [c for c in rows.columns if c != restored_col]
    at = names.index(form_col)
    source = rows.select(*[F.col(f"`{c}`") for c in names])

    def run(batch):
        for part, outputs in steps(batch, output_col, STEP):
            yield {c: part.column(k) for k, c in enumerate(names)} | {restored_col: put_back(outputs, part.column(at).to_pylist())}

    return map_batches(source, run, T.StructType([*source.schema.fields, T.StructField(restored_col, T.StringType())]))
