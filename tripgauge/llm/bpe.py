"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A pair of bytes that occurs inside no vocabulary token can never end up in one
token, so every place where such a pair meets is a certain cut. The fragments
between cuts are encoded independently (each distinct one once) and their ids
concatenated.

The tokenizer also splits words by an expression before it merges. A cut keeps
that expression's result if it doesn't change what the expression sees: the
character before the cut must not be white space (a run of white space looks
ahead), the byte after it must begin a character, and an apostrophe may only
follow a letter or digit (else ``'s`` and the like could arise). Only such
forced pairs are cut; special tokens stay whole.
"""

from __future__ import annotations

import functools
import json
import os
from array import array
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripgauge.llm.runtime import carried, map_batches, steps

#: Bytes of fragments and their ids that a worker remembers, overheads included; beyond that it starts anew (results stay the same).
REMEMBERED = 96 << 20
#: Fragments that are objects at a time while encoding, and text bytes of a step, so that a worker stays small whatever comes in a batch.
BLOCK, STEP = 1 << 17, 1 << 20
#: FIXED VALUE: how a byte-level tokenizer parts words before merging.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes as they are, the others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Tables of one byte-level BPE file, and the fragments met so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        words = spec["pre_tokenizer"] or {}
        plain = spec["model"].get("type") == "BPE" and not spec["normalizer"] and not any(
            spec["model"].get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or (words.get("type"), words.get("add_prefix_space"), words.get("use_regex", True)) != ("ByteLevel", False, True):
            raise ValueError(f"{path}: the cuts hold for byte-level BPE without a normalizer that splits words like {WORDS}; this file differs")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens must match as they are written")
        to_byte = _byte_of_char()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.special = [s.encode() for s in special]
        self.tokens = [b""] * (1 + max([*vocab.values(), *special.values()]))
        inside = np.zeros(65536, bool)
        for token, i in vocab.items():
            raw = bytes(to_byte[c] for c in token)
            self.tokens[i] = raw
            for a, b in pairwise(raw):
                inside[a << 8 | b] = True
        for content, i in special.items():
            self.tokens[i] = content.encode()
        for a, b in ("'s", "'t", "'r", "re", "'v", "ve", "'m", "'l", "ll", "'d"):  # FIXED VALUES: the expression's own suffixes
            inside[ord(a) << 8 | ord(b)] = True
        self.forced = ~inside
        self.path = path
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made, single = [vocab[a + b] for a, b in merges], len(vocab) - len(merges)
        #: The vocabulary's ids, if the merges make tokens in the order of their ids (else None).
        self.in_order = array("I", vocab.values()) if made == list(range(single, len(vocab))) else None
        solid = np.zeros(256, bool)  # first bytes of characters that are never white space
        solid[0x21:0x7F] = solid[0xC3:0xE0] = solid[0xE4:0xF5] = True
        self.solid = solid
        self.alnum = np.array([chr(b).isalnum() and b < 128 for b in range(256)])
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    # Made when first needed: a worker that decodes holds neither.
    @functools.cached_property
    def ranked(self):
        """A faster encoder of fragments, if the merges make tokens in the order of their ids (else None)."""
        import tiktoken

        if self.in_order is None:
            return None
        ranks = {self.tokens[i]: i for i in self.in_order}
        return tiktoken.Encoding("fragments", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    @functools.cached_property
    def tokenizer(self):
        """The library's own encoder, where there is no faster one."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.path)
        made.no_truncation()
        made.no_padding()
        return made

    def _encode_fragments(self, fragments: list[bytes]):
        special = {w: self.tokens.index(w) for w in self.special}
        if self.ranked is not None:
            encode = self.ranked.encode_ordinary
            for f in fragments:
                yield [special[f]] if f in special else encode(f.decode())
        else:
            for made in self.tokenizer.encode_batch_fast([f.decode() for f in fragments], add_special_tokens=False):
                yield made.ids

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """mask[i]: a certain cut lies before byte i (i > 0)."""
        left, right = data[:-1], data[1:]
        mask = np.zeros(len(data), bool)
        if len(data) < 2:
            return mask
        inner = (data & 0xC0) == 0x80
        solid = self.solid[data]
        if inner.any():
            at = np.flatnonzero(inner)
            at = at[at > 0]
            for _ in range(3):  # a character's first byte decides for its last
                solid[at] = solid[at - 1]
        pair = left.astype(np.uint16) << 8 | right
        mask[1:] = self.forced[pair] & solid[:-1] & ~inner[1:] & ((right != 0x27) | self.alnum[left])
        return mask

    def fragments(self, texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The joined texts, the places in them where fragments begin (and the end), and the number of fragments in each text."""
        joined = b"".join(texts)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        mask = self.cuts(np.frombuffer(joined, np.uint8))
        for word in self.special:
            at = joined.find(word)
            while at >= 0:
                stop = at + len(word)
                if np.searchsorted(ends, at, "right") == np.searchsorted(ends, stop - 1, "right"):
                    mask[at + 1:stop] = False
                    mask[at] = True
                    if stop < len(mask):
                        mask[stop] = True
                    at = joined.find(word, stop)
                else:
                    at = joined.find(word, at + 1)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        inside = ends > starts
        mask[starts[inside]] = True
        begins = np.flatnonzero(mask)
        counts = np.searchsorted(begins, ends) - np.searchsorted(begins, starts)
        return joined, np.append(begins, len(joined)), counts

    def _looked_up(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each fragment, as bytes; those not met yet are encoded once."""
        known = self.known
        if self.held > REMEMBERED:
            known.clear()
            self.held = 0
        found = list(map(known.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        fresh = list({pieces[i] for i in missing})
        for start in range(0, len(fresh), 20_000):
            some = fresh[start:start + 20_000]
            for piece, ids in zip(some, self._encode_fragments(some)):
                known[piece] = array("I", ids).tobytes()
                self.held += len(piece) + 4 * len(ids) + 180  # two objects and a place in the table
        for i in missing:
            found[i] = known[pieces[i]]
        return found

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids (unsigned 32-bit) of every text."""
        joined, bounds, counts = self.fragments(texts)
        ids, sizes = [], [np.zeros(1, np.int64)]
        for start in range(0, len(bounds) - 1, BLOCK):
            found = self._looked_up([joined[a:b] for a, b in pairwise(bounds[start:start + BLOCK + 1].tolist())])
            ids.append(b"".join(found))
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        flat = np.frombuffer(b"".join(ids), np.uint32)
        ends = np.cumsum(np.concatenate(sizes))[np.cumsum(counts)] // 4
        return [flat[a:b] for a, b in pairwise([0, *ends.tolist()])]

    def decode(self, ids: list[int]) -> str:
        """Special tokens included; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``token_ids`` (array of int) to every row, as the byte-level BPE file at ``path`` encodes the whole text.

    Null or empty texts have no ids. Rows keep their count; nothing is shuffled. ``keep`` names the columns to carry
    (all by default); an input column ``token_ids`` is replaced. An empty table gives an empty one.
    """
    source = docs if keep is None else docs.select(*dict.fromkeys([*keep, text_col]))
    passed = [f for f in carried(source, {"token_ids"}) if keep is None or f.name in keep]
    schema = T.StructType([*passed, T.StructField("token_ids", T.ArrayType(T.IntegerType()))])

    def run(batch):
        for part, texts in steps(batch, text_col, STEP):
            ids = codec(path).encode(texts)
            offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate([np.zeros(0, np.uint32), *ids]).view(np.int32)
            yield {f.name: part.column(part.schema.get_field_index(f.name)) for f in passed} | {
                "token_ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))}

    return map_batches(source, run, schema)


def decode(rows: DataFrame, path: str, ids_col: str = "token_ids") -> DataFrame:
    """Adds ``decoded`` (the text of the ids, special tokens included) to every row; null ids give null. An input column ``decoded`` is replaced."""
    passed = carried(rows, {"decoded"})
    schema = T.StructType([*passed, T.StructField("decoded", T.StringType())])

    def run(batch):
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            ids = part.column(part.schema.get_field_index(ids_col))
            texts = [codec(path).decode(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else None for x in ids]
            yield {f.name: part.column(part.schema.get_field_index(f.name)) for f in passed} | {"decoded": texts}

    return map_batches(rows, run, schema)
