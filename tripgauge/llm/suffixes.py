"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

The induction walks the suffix array in windows. All entries of a window up to
the first place that the window itself fills are final, so what they induce
goes out in one step of array operations. Where steps turn out short (strings of
substring names, in the recursion, and long runs) the walk goes on entry by
entry. So the work is linear in the text, whatever its alphabet.
"""

from __future__ import annotations

from itertools import islice

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour (S); the last character must be the unique smallest."""
    n = len(s)
    differs = np.append(s[1:] != s[:-1], True)
    nxt = np.where(differs, np.arange(n, dtype=np.int32), np.int32(n))
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]  # the last place of the run of equal characters
    small = np.empty(n, bool)
    inner = nxt < n - 1
    small[inner] = s[nxt[inner] + 1] > s[nxt[inner]]
    small[~inner] = True
    return small


def _push(sa, at, preds, chars, sign=1):
    """Puts ``preds`` at the open ends of their buckets, in order; sign is 1 for heads and -1 for tails."""
    order = chars.argsort(kind="stable")
    c = chars[order]
    edge = np.ones(len(c) + 1, bool)
    np.not_equal(c[1:], c[:-1], out=edge[1:-1])
    first = edge.nonzero()[0]
    count, first = first[1:] - first[:-1], first[:-1]
    head = c[first]
    sa[np.repeat(at[head] - sign * first, count) + sign * np.arange(len(c))] = preds[order]
    at[head] += sign * count


#: Entries looked at in one step of the walk, at least and at most.
WINDOW = (256, 1 << 17)
#: Entries that a step must settle on average to be worth its array operations, and steps that are free.
WORTH, FREE = 192, 32


def _walk(sa: np.ndarray, s: np.ndarray, wanted: np.ndarray, at: np.ndarray) -> None:
    """Goes through ``sa`` from the left; where the character left of a suffix is ``wanted``, the suffix that begins there
    goes to the head ``at`` of its bucket, which is always further on."""
    n, done, width, taken = len(sa), 0, WINDOW[0], 0
    none = np.iinfo(s.dtype).max  # no character
    left = np.full(n + 1, none, s.dtype)  # the character left of a suffix, if wanted; of the first and of -1 (an empty entry): none
    np.copyto(left[1:n], s[:-1], where=wanted[:-1])
    while done < n:
        if done < WORTH * (taken - FREE):
            return _walk_singly(sa, s, wanted, at, done)
        taken += 1
        part = sa[done:done + width]
        chars = left[part]
        place = (chars != none).nonzero()[0]
        stop = end = min(n, done + width)
        if len(place):
            chars = chars[place]
            goal = at[chars]
            if goal.min() < end:  # only up to the first place that these entries fill
                filled = np.minimum.accumulate(goal)
                late = place[1:] + done >= filled[:-1]
                fits = int(late.argmax()) + 1 if late.any() else len(place)
                stop = min(end, int(filled[fits - 1]))
                place, chars = place[:fits], chars[:fits]
            _push(sa, at, part[place] - 1, chars)
        width = min(WINDOW[1], 2 * width) if stop == end else max(WINDOW[0], min(width, 2 * (stop - done)))
        done = stop


def _walk_singly(sa: np.ndarray, s: np.ndarray, wanted: np.ndarray, at: np.ndarray, done: int) -> None:
    """The walk from place ``done`` on, entry by entry."""
    out, chars, wish, heads = sa.tolist(), s.tolist(), wanted.tolist(), at.tolist()
    for i in islice(out, done, None):  # entries put in further on are met later
        if i > 0 and wish[i - 1]:
            c = chars[i - 1]
            out[heads[c]] = i - 1
            heads[c] += 1
    sa[:] = out


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """The suffix array that follows from the order of ``lms`` (leftmost-smaller suffixes, or substrings)."""
    n = len(s)
    size = np.bincount(s, minlength=k)
    tail = np.cumsum(size) - 1
    sa = np.full(n, -1, np.int32)
    _push(sa, tail.copy(), lms[::-1], s[lms[::-1]], -1)
    seeds = np.flatnonzero(sa >= 0)
    _walk(sa, s, ~small, tail - size + 1)  # larger suffixes, from the left
    sa[seeds] = -1
    _walk(sa[::-1], s, small, n - 1 - tail)  # smaller suffixes, from the right
    sa[0] = n - 1
    return sa


def _settled(names: np.ndarray, single: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The places ``lms`` whose name is not ``single``, in the order of their suffixes, by the suffix array of the names.

    Two suffixes differ at the first single name at the latest, so single names behind another single name are left out.
    """
    keep = ~(single & np.append(False, single[:-1]))
    keep[-1] = True
    at = np.flatnonzero(keep)
    short = names[at]
    seen = np.zeros(int(names.max()) + 1, bool)
    seen[short] = True
    order = at[suffix_array((np.cumsum(seen, dtype=np.int32) - 1)[short])]
    return lms[order[~single[order]]]


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of the suffixes of ``s`` in order. Characters are small non-negative integers (int32); the last one is the unique smallest."""
    n, k = len(s), int(s.max()) + 1 if len(s) else 1
    if n < 2:
        return np.arange(n)
    if k < 1 << 16:
        s = s.astype(np.uint8 if k < 1 << 8 else np.uint16)  # numpy sorts these by radix; the largest number stays free
    small = _types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    order = _induce(s, small, lms, k)
    mark = np.zeros(n, bool)
    mark[lms] = True
    first = order[mark[order]]  # leftmost-smaller substrings in order
    end = np.empty(n, np.int32)
    end[lms] = np.append(lms[1:], n - 1)  # a substring runs to the next one
    a, b = first[:-1], first[1:]
    length = end[a] - a
    same = (length == end[b] - b) & (b != n - 1) & (a != n - 1)
    live, d = np.flatnonzero(same), 0
    while len(live):  # compare neighbours character by character
        equal = s[a[live] + d] == s[b[live] + d]
        same[live[~equal]] = False
        live = live[equal]
        d += 1
        live = live[d <= length[live]]
    if same.any():
        fresh = np.append(True, ~same)
        alone = fresh & np.append(fresh[1:], True)  # substrings unlike all others
        names = np.empty(n, np.int32)
        names[first] = np.cumsum(fresh) - 1
        single = np.empty(n, bool)
        single[first] = alone
        first[~alone] = _settled(names[lms], single[lms], lms)
    return _induce(s, small, first, k)


def _packed(s: np.ndarray) -> tuple[np.ndarray, int]:
    """For each place the characters from there on in one 64-bit word, the first one lowest, and the bits of a character."""
    bits = next(b for b in (8, 16, 32) if int(s.max()) >> b == 0)
    words = np.zeros(len(s) + 64 // bits, np.uint64)
    words[:len(s)] = s
    width = bits
    while width < 64:  # words of so many bits are joined by two
        words[:-(width // bits)] |= words[width // bits:] << np.uint64(width)
        width *= 2
    return words, bits


def permuted_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """plcp[i]: the common prefix of suffix i and the suffix before it in order.

    Only where the characters to the left differ are prefixes compared; elsewhere it is one less than its left neighbour's.
    """
    n = len(s)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n, dtype=np.int32)
    has = before >= 0
    own = np.ones(n, bool)
    inner = has & (i > 0) & (before > 0)
    own[inner] = s[i[inner] - 1] != s[before[inner] - 1]
    plcp = np.zeros(n, np.int32)
    live = np.flatnonzero(own & has)
    other = before[live]
    words, bits = _packed(s)
    d = 0
    while len(live):  # the last character is unique, so suffixes differ before their ends
        x = words[live + d] ^ words[other + d]
        differs = x != 0
        x = x[differs]
        plcp[live[differs]] = d + (np.frexp((x & (~x + np.uint64(1))).astype(float))[1] - 1) // bits
        live, other = live[~differs], other[~differs]
        d += 64 // bits
    at = np.maximum.accumulate(np.where(own, i, np.int32(0)))
    return np.where(own, plcp, np.maximum(plcp[at] - (i - at), 0))
