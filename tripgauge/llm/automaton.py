"""Byte automata from regular expressions: subset construction, minimisation and vectorised scanning.

Expressions may use literals, escapes (``\\xHH``, ``\\.``), classes, groups,
``|``, ``?``, ``*``, ``+``, ``{m}`` and ``{m,}``; all of them match bytes. An
expression should end in a repeated class or in a literal, so that its greedy
end is the end of a run of accepting states.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LANE = 2048  # bytes that one lane of the vectorised scan walks


class _Nfa:
    """Thompson construction; ``edges[s]`` holds (byte set, target), ``eps[s]`` the empty moves."""

    def __init__(self):
        self.edges: list[list[tuple[frozenset, int]]] = []
        self.eps: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.eps.append([])
        return len(self.eps) - 1


def _parse(pattern: str):
    """Syntax tree: ("set", bytes), ("cat", [...]), ("alt", [...]), ("rep", node, least, unbounded)."""
    at = 0

    def escape() -> int:
        nonlocal at
        at += 1
        c = pattern[at]
        at += 1
        if c == "x":
            at += 2
            return int(pattern[at - 2:at], 16)
        return {"n": 10, "t": 9, "r": 13}.get(c, ord(c))

    def char() -> int:
        nonlocal at
        if pattern[at] == "\\":
            return escape()
        at += 1
        return ord(pattern[at - 1])

    def charset() -> frozenset:
        nonlocal at
        at += 1
        negated = pattern[at] == "^"
        at += negated
        out: set[int] = set()
        while pattern[at] != "]":
            low = char()
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                out |= set(range(low, char() + 1))
            else:
                out.add(low)
        at += 1
        return frozenset(range(256)) - out if negated else frozenset(out)

    def atom():
        nonlocal at
        if pattern[at] == "(":
            at += 1
            node = alternatives()
            at += 1
            return node
        if pattern[at] == "[":
            return ("set", charset())
        return ("set", frozenset([char()]))

    def sequence():
        nonlocal at
        items = []
        while at < len(pattern) and pattern[at] not in "|)":
            node = atom()
            while at < len(pattern) and pattern[at] in "?*+{":
                mark = pattern[at]
                if mark == "{":
                    end = pattern.index("}", at)
                    least, comma, _ = pattern[at + 1:end].partition(",")
                    at = end + 1
                    node = ("rep", node, int(least), bool(comma))
                else:
                    at += 1
                    node = ("alt", [node, ("cat", [])]) if mark == "?" else ("rep", node, int(mark == "+"), True)
            items.append(node)
        return ("cat", items)

    def alternatives():
        nonlocal at
        options = [sequence()]
        while at < len(pattern) and pattern[at] == "|":
            at += 1
            options.append(sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    return alternatives()


def _folded(node):
    """The tree with ASCII letters in either case."""
    if node[0] == "set":
        both = {ord(chr(b).swapcase()) for b in node[1] if b < 128 and chr(b).isalpha()}
        return ("set", node[1] | both)
    if node[0] == "rep":
        return ("rep", _folded(node[1]), *node[2:])
    return (node[0], [_folded(x) for x in node[1]])


def _reversed(node):
    if node[0] == "set":
        return node
    if node[0] == "rep":
        return ("rep", _reversed(node[1]), *node[2:])
    items = [_reversed(x) for x in node[1]]
    return (node[0], items[::-1] if node[0] == "cat" else items)


def _build(nfa: _Nfa, node, start: int) -> int:
    kind = node[0]
    if kind == "set":
        end = nfa.state()
        nfa.edges[start].append((node[1], end))
        return end
    if kind == "cat":
        for item in node[1]:
            start = _build(nfa, item, start)
        return start
    if kind == "alt":
        end = nfa.state()
        for option in node[1]:
            nfa.eps[_build(nfa, option, start)].append(end)
        return end
    _, item, least, unbounded = node
    for _ in range(least):
        start = _build(nfa, item, start)
    if unbounded:
        loop = nfa.state()
        nfa.eps[start].append(loop)
        nfa.eps[_build(nfa, item, loop)].append(loop)
        return loop
    return start


@dataclass
class Dfa:
    """``table[state, class]``; state 0 is the start. The last class is the boundary between texts.

    accept: bit k is set if expression k may end here. dead: nothing follows.
    """

    classes: np.ndarray
    table: np.ndarray
    accept: np.ndarray
    dead: np.ndarray

    @property
    def boundary(self) -> int:
        return self.table.shape[1] - 1


def determinise(trees: list, unanchored: bool) -> Dfa:
    """One minimal automaton for all ``trees``. unanchored: a match may begin at any byte, and a text boundary restarts it."""
    nfa = _Nfa()
    root = nfa.state()
    ends = {}
    for k, tree in enumerate(trees):
        first = nfa.state()
        nfa.eps[root].append(first)
        ends[_build(nfa, tree, first)] = k
    sets = {s for edges in nfa.edges for s, _ in edges}
    signature: dict[tuple, int] = {}
    classes = np.zeros(256, np.uint8)
    for b in range(256):
        classes[b] = signature.setdefault(tuple(b in s for s in sorted(sets, key=sorted)), len(signature))
    member = [next(b for b in range(256) if classes[b] == c) for c in range(len(signature))]

    def closure(states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for t in nfa.eps[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    start = closure([root])
    index, order, rows = {start: 0}, [start], []
    step = [[frozenset(u for among, t in edges if b in among for u in closure([t])) for b in member] for edges in nfa.edges]
    active = [s for s, edges in enumerate(nfa.edges) if edges]
    again = start if unanchored else frozenset()
    useful = frozenset(active) | frozenset(ends)
    for subset in order:  # grows while it is walked
        row = []
        for c in range(len(member)):
            target = again.union(*(step[s][c] for s in subset if s in useful)) & useful | again
            if target not in index:
                index[target] = len(order)
                order.append(target)
            row.append(index[target])
        rows.append(row)
    table = np.array(rows, np.int64)
    accept = np.array([sum(1 << ends[s] for s in subset if s in ends) for subset in order], np.int64)
    # Moore's refinement: states stay together while accept marks and successors' blocks agree.
    block = np.unique(accept, return_inverse=True)[1].reshape(-1)
    while True:
        refined = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if refined.max() == block.max():
            break
        block = refined
    firsts = np.unique(block, return_index=True)[1]
    rank = np.empty(len(firsts), np.int64)  # number blocks by first appearance: the start is block 0
    rank[block[np.sort(firsts)]] = np.arange(len(firsts))
    block, firsts = rank[block], np.sort(firsts)
    small = block[table[firsts]]
    accept = accept[firsts]
    dead = (small == np.arange(len(small))[:, None]).all(axis=1) & (accept == 0)
    if not unanchored and not dead.any():  # boundaries need a dead state
        small = np.vstack([small, np.full(small.shape[1], len(small))])
        accept, dead = np.append(accept, 0), np.append(dead, True)
    out = np.full(len(small), 0 if unanchored else int(np.flatnonzero(dead)[0]))
    small = np.column_stack([small, out])
    return Dfa(classes, small.astype(np.uint16), accept, dead)


@dataclass
class Scanner:
    """All expressions in one forward automaton, and one backward automaton for each."""

    forward: Dfa
    backward: list[Dfa]

    @classmethod
    def compile(cls, patterns: list[tuple[str, bool]]) -> Scanner:
        """patterns: (expression, letters in either case)."""
        trees = [_folded(t) if fold else t for t, fold in ((_parse(p), fold) for p, fold in patterns)]
        return cls(determinise(trees, True), [determinise([_reversed(t)], False) for t in trees])

    def states(self, classes: np.ndarray) -> np.ndarray:
        """The forward state after each byte of ``classes`` (byte classes, texts parted by the boundary class).

        Lanes of LANE bytes walk side by side from the start state; lanes whose predecessor ended in another state
        are walked again from there until they meet the states already known.
        """
        dfa, n = self.forward, len(classes)
        width = dfa.table.shape[1]
        lanes = max(1, -(-n // LANE))
        length = min(LANE, max(n, 1))
        padded = np.full(lanes * length, dfa.boundary, np.uint8)
        padded[:n] = classes
        walk = np.ascontiguousarray(padded.reshape(lanes, length).T)
        flat = (dfa.table.astype(np.int64) * width).reshape(-1)  # states premultiplied by the row width
        seen = np.empty((length, lanes), np.int32)
        state = np.zeros(lanes, np.int64)
        for t in range(length):
            state += walk[t]
            state = flat.take(state)
            seen[t] = state
        begun = np.zeros(lanes, np.int32)
        while True:
            due = np.append(0, seen[-1][:-1]).astype(np.int32)
            again = np.flatnonzero(due != begun)
            if not len(again):
                break
            begun[again] = due[again]
            state, live = due[again], again
            for t in range(length):
                state = flat[state + walk[t, live]]
                fresh = state != seen[t, live]
                if not fresh.all():
                    state, live = state[fresh], live[fresh]
                    if not len(live):
                        break
                seen[t, live] = state
        return (np.ascontiguousarray(seen.T).reshape(-1)[:n] // width)

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int, int]]]:
        """Leftmost non-overlapping greedy matches (expression, start, end, first accepting byte) of every text, in bytes."""
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        data = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
        lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        begins = np.cumsum(lengths + 1) - lengths  # a boundary before each text
        edges = np.append(begins - 1, len(data) - 1)
        classes = self.forward.classes[data]
        classes[edges] = self.forward.boundary
        accept = self.forward.accept[self.states(classes)]
        hits = np.flatnonzero(accept)
        for k, back in enumerate(self.backward):
            at = hits[accept[hits] >> k & 1 == 1]
            if not len(at):
                continue
            cut = np.flatnonzero(np.diff(at) > 1)
            first, last = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]
            behind = back.classes[data]
            behind[edges] = back.boundary
            start = self._starts(back, behind, first)
            owner = np.searchsorted(begins, first, "right") - 1
            mixed = owner[1:][(start[1:] <= last[:-1]) & (owner[1:] == owner[:-1])]
            redo = set(mixed.tolist())
            for d, s, e, f in zip(owner.tolist(), start.tolist(), last.tolist(), first.tolist()):
                if d not in redo:
                    b = int(begins[d])
                    out[d].append((k, s - b, e + 1 - b, f - b))
            for d in redo:
                out[d] += self._one_by_one(k, texts[d])
        for found in out:
            found.sort(key=lambda x: (x[1], x[0]))
        return out

    @staticmethod
    def _starts(back: Dfa, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The leftmost start of a match that ends at each of ``first``: the longest walk back."""
        best, live, at = first.copy(), np.arange(len(first)), first.copy()
        state = np.zeros(len(first), np.int64)
        while len(live):
            state = back.table[state, classes[at]].astype(np.int64)
            good = back.accept[state] > 0
            best[live[good]] = at[good]
            go = ~back.dead[state] & (at > 0)
            live, at, state = live[go], at[go] - 1, state[go]
        return best

    def _one_by_one(self, k: int, text: bytes) -> list[tuple[int, int, int, int]]:
        """The same with a restart of both automata behind each match, for texts whose matches would overlap."""
        forward, back = self.forward, self.backward[k]
        table, accept, classes = forward.table.tolist(), (forward.accept >> k & 1).tolist(), forward.classes.tolist()
        behind, good, dead, among = back.table.tolist(), back.accept.tolist(), back.dead.tolist(), back.classes.tolist()
        out, at, floor, state = [], 0, 0, 0
        while at < len(text):
            state = table[state][classes[text[at]]]
            at += 1
            if not accept[state]:
                continue
            first = at - 1
            while at < len(text) and accept[table[state][classes[text[at]]]]:
                state = table[state][classes[text[at]]]
                at += 1
            start, walk, s = first, first, 0
            while walk >= floor:
                s = behind[s][among[text[walk]]]
                if dead[s]:
                    break
                if good[s]:
                    start = walk
                walk -= 1
            out.append((k, start, at, first))
            floor, state = at, 0
        return out
