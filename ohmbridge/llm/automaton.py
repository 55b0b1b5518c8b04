"""One deterministic automaton for many regular expressions over bytes.

Expressions are parsed to positions (Glushkov's construction, no empty moves),
all of them into one set; subset construction over bit masks of positions and
partition refinement give a minimal automaton whose states tell which rules have
a match that ends there. Built *backward*, from the reversed expressions, it reads
texts from their ends and its states tell which rules have a match that starts
there. Built *anchored*, matches must start where it does.

A batch is scanned in pieces, each in many lanes at once: each step moves all
lanes by one byte. Lanes start in the start state; where the lane before ends
elsewhere, a lane's head is run again from there until its states agree with those
found, and a piece starts where the one before ended, so the result is that of
one pass from end to end.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np


class Regex:
    """Positions of one expression: literals, escapes, classes, groups, ``|``, ``?``, ``*``, ``+``, ``{m,n}``, ``(?i:...)``."""

    def __init__(self, pattern: str):
        self.text, self.at, self.fold = pattern, 0, False
        self.accepts: list[frozenset[int]] = []
        tree = self._either()
        if self.at != len(pattern):
            raise ValueError(f"cannot read {pattern!r} from {self.at}")
        self.follow: list[set[int]] = []
        self._place(tree)

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _either(self):
        branches = [self._sequence()]
        while self._peek() == "|":
            self.at += 1
            branches.append(self._sequence())
        return ("or", branches) if len(branches) > 1 else branches[0]

    def _sequence(self):
        items = []
        while self._peek() not in ("", "|", ")"):
            items.append(self._repeat(self._atom()))
        return ("seq", items)

    def _repeat(self, item):
        while (c := self._peek()) and c in "?*+{":
            self.at += 1
            if c == "{":
                close = self.text.index("}", self.at)
                low, comma, high = self.text[self.at : close].partition(",")
                self.at = close + 1
                m = int(low)
                n = (int(high) if high else None) if comma else m
            else:
                m, n = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            item = ("rep", item, m, n)
        return item

    def _atom(self):
        c = self._peek()
        self.at += 1
        if c == "(":
            fold = self.fold
            for start in ("?i:", "?:"):
                if self.text.startswith(start, self.at):
                    self.fold |= start == "?i:"
                    self.at += len(start)
                    break
            inner = self._either()
            self.at += 1
            self.fold = fold
            return inner
        if c == "[":
            return ("set", self._class())
        if c == ".":
            return ("set", frozenset(range(256)) - {10})
        if c == "\\":
            return ("set", self._folded(self._escape()))
        return ("set", self._folded(frozenset(c.encode()[:1])))

    def _escape(self) -> frozenset[int]:
        c = self._peek()
        self.at += 1
        if c == "x":
            self.at += 2
            return frozenset([int(self.text[self.at - 2 : self.at], 16)])
        known = {"d": range(48, 58), "s": b" \t\n\r\x0b\x0c", "w": [*range(48, 58), *range(65, 91), 95, *range(97, 123)], "n": b"\n", "t": b"\t", "r": b"\r"}
        return frozenset(known.get(c, c.encode()))

    def _folded(self, found: frozenset[int]) -> frozenset[int]:
        if not self.fold:
            return found
        return found | {b ^ 32 for b in found if 65 <= b & ~32 <= 90}

    def _class(self) -> frozenset[int]:
        negated = self._peek() == "^"
        self.at += negated
        found: set[int] = set()
        while self._peek() != "]":
            c = self._peek()
            self.at += 1
            low = self._escape() if c == "\\" else frozenset(c.encode()[:1])
            if self._peek() == "-" and self.text[self.at + 1] != "]" and len(low) == 1:
                self.at += 1
                end = self._peek()
                self.at += 1
                high = self._escape() if end == "\\" else frozenset(end.encode()[:1])
                found.update(range(min(low), max(high) + 1))
            else:
                found |= low
        self.at += 1
        got = self._folded(frozenset(found))
        return frozenset(range(256)) - got if negated else got

    def _build(self, node) -> tuple[bool, set[int], set[int]]:
        """(may be empty, first positions, last positions); fills follow."""
        kind = node[0]
        if kind == "set":
            p = len(self.accepts)
            self.accepts.append(node[1])
            self.follow.append(set())
            return False, {p}, {p}
        if kind == "or":
            parts = [self._build(x) for x in node[1]]
            return any(p[0] for p in parts), set().union(*(p[1] for p in parts)), set().union(*(p[2] for p in parts))
        if kind == "rep":
            _, item, m, n = node
            copies = [("must", item)] * m + ([("loop", item)] if n is None else [("may", item)] * (n - m))
            if n is None and m:
                copies = [("must", item)] * (m - 1) + [("many", item)]
            parts = []
            for how, x in copies:
                empty, first, last = self._build(x)
                if how in ("loop", "many"):
                    for p in last:
                        self.follow[p] |= first
                parts.append((empty or how in ("loop", "may"), first, last))
            return self._chain(parts)
        return self._chain([self._build(x) for x in node[1]])

    def _chain(self, parts) -> tuple[bool, set[int], set[int]]:
        empty, first, last = True, set(), set()
        for e, f, z in parts:
            for p in last:
                self.follow[p] |= f
            if empty:
                first = first | f
            last = (last | z) if e else set(z)
            empty = empty and e
        return empty, first, last

    def _place(self, tree) -> None:
        self.empty, self.first, self.last = self._build(tree)
        if self.empty:
            raise ValueError("an expression that matches nothing would match everywhere")


#: Bytes of a piece, which hold four bytes of state each.
PIECE = 4 << 20


class Automaton:
    """``flat[state * classes + class]`` is the next state times ``classes``; ``hits[state]`` a bit for each rule."""

    def __init__(self, patterns: list[str], backward: bool = False, anchored: bool = False):
        accepts, follow, first, lasts = [], [], 0, []
        for pattern in patterns:
            r = Regex(pattern)
            base = len(accepts)
            accepts += r.accepts
            after, begin, end = r.follow, r.first, r.last
            if backward:
                after, begin, end = [set() for _ in r.follow], r.last, r.first
                for p, f in enumerate(r.follow):
                    for q in f:
                        after[q].add(p)
            follow += [sum(1 << (base + q) for q in f) for f in after]
            first |= sum(1 << (base + p) for p in begin)
            lasts.append(sum(1 << (base + p) for p in end))
        by_byte = [sum(1 << p for p, a in enumerate(accepts) if b in a) for b in range(256)]
        masks = list(dict.fromkeys([0, *by_byte]))
        #: class 0 is accepted by no position: it returns to the start, as between texts
        self.class_of = np.array([masks.index(m) for m in by_byte], np.uint8)
        k = len(masks)
        # no position is the start; where matches are anchored, it is the dead state, and the start is one of its own
        begin = -1 if anchored else 0
        states, rows, todo = {begin: 0}, [], [begin]
        while todo:
            nxt = []
            for s in todo:
                reach, rest = (0 if anchored and s != begin else first), max(s, 0)
                while rest:
                    low = rest & -rest
                    reach |= follow[low.bit_length() - 1]
                    rest ^= low
                row = []
                for m in masks:
                    t = reach & m
                    if t not in states:
                        states[t] = len(states)
                        nxt.append(t)
                    row.append(states[t])
                rows.append(row)
            todo = nxt
        table = np.array(rows, np.int64)
        hits = np.array([sum((1 << r) for r, z in enumerate(lasts) if s > 0 and s & z) for s in states], np.int64)
        small, self.hits, block = self._minimal(table, hits)
        self.start, self.dead, self.raw_states = int(block[0]), int(block[states[0]]) if anchored else -1, len(states)
        self.classes, self.rules, self.backward = k, len(patterns), backward
        self.flat = np.ascontiguousarray((small * k).ravel().astype(np.int32))

    @property
    def table(self) -> np.ndarray:
        """The next state, by state and class."""
        return (self.flat // self.classes).reshape(-1, self.classes)

    @staticmethod
    def _minimal(table: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merge states until no two of a block differ in where they lead (Moore): (table, hits, block of each state)."""
        _, block = np.unique(hits, return_inverse=True)
        while True:
            sign = np.concatenate((block[:, None], block[table]), 1)
            _, pick, new = np.unique(sign, axis=0, return_index=True, return_inverse=True)
            new = new.ravel()
            if new.max() == block.max():
                return new[table[pick]], hits[pick], new
            block = new

    def _piece(self, flow: np.ndarray, state: int, lanes: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(places of hits, their states, the state after the last byte) of a run over ``flow`` from ``state``; states times classes."""
        n, k = len(flow), self.classes
        lanes = max(1, min(lanes, n // 64))
        steps = -(-n // lanes)
        if steps * lanes > n:
            flow = np.concatenate((flow, np.zeros(steps * lanes - n, np.uint8)))
        by_step = np.ascontiguousarray(flow.reshape(lanes, steps).T)
        seen = np.empty((steps, lanes), np.int32)
        assumed = np.full(lanes, self.start * k, np.int32)
        assumed[0] = state
        now = assumed
        for t in range(steps):
            np.take(self.flat, now + by_step[t], out=seen[t])
            now = seen[t]
        # lanes that began in another state than assumed
        while True:
            begins = np.concatenate(([state], seen[-1, :-1])).astype(np.int32)
            wrong = np.flatnonzero(begins != assumed)
            if not len(wrong):
                break
            assumed, now = begins, begins[wrong]
            for t in range(steps):
                now = self.flat[now + by_step[t, wrong]]
                differs = now != seen[t, wrong]
                if not differs.any():
                    break
                wrong, now = wrong[differs], now[differs]
                seen[t, wrong] = now
        flag = np.zeros(len(self.hits) * k, bool)
        flag[np.flatnonzero(self.hits) * k] = True
        t, lane = np.nonzero(flag[seen])
        where = lane * steps + t
        real = where < n
        lane, t = (n - 1) // steps, (n - 1) % steps
        return where[real], seen.T.ravel()[where[real]] if real.any() else np.zeros(0, np.int32), int(seen[t, lane])

    def places(self, buf: np.ndarray, offsets: np.ndarray, lanes: int = 2048, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, byte, rules' bits) wherever matches end or, backward, start; ends are exclusive. Sorted by text and byte."""
        n, texts = len(buf), len(offsets) - 1
        # a text's bytes, then one of class 0
        flow = np.zeros(n + texts, np.uint8)
        place = np.arange(n) + np.repeat(np.arange(texts), np.diff(offsets))
        flow[place] = self.class_of[buf]
        if self.backward:
            flow = flow[::-1]
        state, found, bits = self.start * self.classes, [], []
        for a in range(0, len(flow), piece):
            at, states, state = self._piece(flow[a : a + piece], state, lanes)
            found.append(at + a)
            bits.append(self.hits[states // self.classes])
        where, bits = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found, bits))
        if self.backward:
            where = len(flow) - 1 - where
        by = np.argsort(where)
        where, bits = where[by], bits[by]
        text = np.searchsorted(offsets[1:] + np.arange(1, texts + 1), where, "right")
        return text, where - text - offsets[text] + (0 if self.backward else 1), bits

    def scan(self, buf: np.ndarray, offsets: np.ndarray, lanes: int = 2048) -> list[tuple[int, int]]:
        """(text, rule) for each rule that has a match in a text, sorted."""
        text, _, bits = self.places(buf, offsets, lanes)
        return sorted({(int(x), r) for x, b in set(zip(text.tolist(), bits.tolist(), strict=True)) for r in range(self.rules) if b >> r & 1})

    def longest(self, classes: bytes, start: int) -> int:
        """Where the longest match from ``start`` ends in a text given by its bytes' classes, -1 without any; for anchored automata."""
        state, end, dead, table, k = self.start, -1, self.dead, self.rows, self.classes
        ends = self.ends
        for i in range(start, len(classes)):
            state = table[state * k + classes[i]]
            if state == dead:
                break
            if ends[state]:
                end = i + 1
        return end

    @cached_property
    def rows(self) -> list[int]:
        return self.table.ravel().tolist()

    @cached_property
    def ends(self) -> list[bool]:
        return (self.hits != 0).tolist()
