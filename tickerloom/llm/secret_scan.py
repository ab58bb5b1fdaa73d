"""Secrets in text, found by one deterministic automaton for all rules.

Each rule's regular expression becomes a nondeterministic automaton over bytes. Subset construction over all rules at
once gives one deterministic automaton; its states keep, for each rule, the sets of positions in order of their start,
so the automaton itself knows the leftmost match that doesn't overlap an earlier one. After minimisation it is an array
of transitions, and one pass over the bytes of a text runs all rules. The pass takes many stretches of text side by
side: a byte after which every state is the first one (a line end, say) parts a text without changing what is found.

While a rule's match can end at a byte, the state says so. The bytes that say so in a row are the match's tail; a rule
asks a least length of it. For the few tails that are long enough the start of the match is looked up by going back
through the rule's automaton, no further than the end of the match before.

Rules have to end in a part that can only go on or stop (checked when they are compiled).

Defined cases: a missing text is empty and holds nothing; repeated rows hold the same; texts of any length are scanned
whole; an empty table gives an empty result; extra columns are no input. Positions count code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache
from re import _constants as sre
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerloom.llm.common import text_udf


@dataclass(frozen=True)
class Rule:
    """``tail``: the least number of bytes at which the match can end in a row. ASCII letters match in either case if asked."""

    kind: str
    pattern: str
    tail: int = 1
    any_case: bool = False


#: The base rules, in their fixed order.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 12),
    Rule("hex", r"[0-9a-f]+", 32),
)
#: Public formats of tokens and keys, beside the base rules.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 36),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 10),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 8),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE
#: Bytes of a stretch before it may be parted, and bytes of text that are scanned at a time.
STRETCH, CHUNK = 512, 4_000_000
#: Below so many stretches a step for all of them is dearer than single steps.
FEW = 24


class Nfa:
    """Positions and byte moves of one rule; position 0 is the start."""

    def __init__(self, rule: Rule):
        self.empty: list[list[int]] = [[]]
        self.moves: list[list[tuple[frozenset[int], int]]] = [[]]
        self.any_case = rule.any_case
        self.final = self._sequence(_parser.parse(rule.pattern), 0)
        self.back: list[list[tuple[frozenset[int], int]]] = [[] for _ in self.moves]
        for at, moves in enumerate(self.moves):
            for letters, to in moves:
                self.back[to].append((letters, at))
        self.back_empty: list[list[int]] = [[] for _ in self.moves]
        for at, then in enumerate(self.empty):
            for to in then:
                self.back_empty[to].append(at)

    def _new(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.moves) - 1

    def _sequence(self, items, at: int) -> int:
        for item in items:
            at = self._item(item, at)
        return at

    def _item(self, item, at: int) -> int:
        kind, value = item
        if kind is sre.SUBPATTERN:
            return self._sequence(value[3], at)
        if kind is sre.BRANCH:
            end = self._new()
            for part in value[1]:
                first = self._new()
                self.empty[at].append(first)
                self.empty[self._sequence(part, first)].append(end)
            return end
        if kind is sre.MAX_REPEAT:
            low, high, part = value
            for _ in range(low):
                at = self._sequence(part, at)
            if high is sre.MAXREPEAT:
                loop, end = self._new(), self._new()
                self.empty[at] += [loop, end]
                self.empty[self._sequence(part, loop)] += [loop, end]
                return end
            end = self._new()
            for _ in range(high - low):
                self.empty[at].append(end)
                at = self._sequence(part, at)
            self.empty[at].append(end)
            return end
        end = self._new()
        self.moves[at].append((self._letters(kind, value), end))
        return end

    def _letters(self, kind, value) -> frozenset[int]:
        if kind is sre.LITERAL:
            found = {value}
        elif kind is sre.IN:
            found = set()
            for k, v in value:
                if k is sre.LITERAL:
                    found.add(v)
                elif k is sre.RANGE:
                    found.update(range(v[0], v[1] + 1))
                else:
                    raise ValueError(f"not supported in a rule: {k}")
        else:
            raise ValueError(f"not supported in a rule: {kind}")
        if self.any_case:
            found |= {ord(f(chr(c))) for c in found if chr(c).isalpha() for f in (str.upper, str.lower)}
        if max(found) > 127:
            raise ValueError("rules are over ASCII")
        return frozenset(found)

    def closed(self, places: set[int], edges: list[list[int]]) -> frozenset[int]:
        todo, seen = list(places), set(places)
        while todo:
            for then in edges[todo.pop()]:
                if then not in seen:
                    seen.add(then)
                    todo.append(then)
        return frozenset(seen)

    def step(self, places: frozenset[int], byte: int) -> frozenset[int]:
        return self.closed({to for p in places for letters, to in self.moves[p] if byte in letters}, self.empty)

    def start_before(self, data: np.ndarray, first: int, limit: int) -> int:
        """The leftmost start, not before ``limit``, of a match that can first end with the byte at ``first``."""
        places, found = self.closed({self.final}, self.back_empty), first
        for at in range(first, limit - 1, -1):
            byte = int(data[at])
            places = self.closed({p for q in places for letters, p in self.back[q] if byte in letters}, self.back_empty)
            if not places:
                break
            if 0 in places:
                found = at
        return found


def _advance(nfa: Nfa, threads: tuple, byte: int) -> tuple:
    """The sets of one rule, by their start, after a byte."""
    ending = bool(threads) and nfa.final in threads[0]
    moved = [nfa.step(t, byte) for t in threads]
    if ending and moved[0]:
        if nfa.final not in moved[0]:
            raise ValueError("a rule has to end in a part that can only go on or stop")
        return (moved[0],)
    fresh = nfa.step(nfa.closed({0}, nfa.empty), byte)
    if ending and nfa.final in fresh:
        raise ValueError("two matches of a rule would touch")
    out, seen = [], set()
    for places in [*moved, fresh]:
        if places := frozenset(places - seen):
            out.append(places)
            seen |= places
    if any(nfa.final in t for t in out[1:]) and nfa.final not in out[0]:
        raise ValueError("a later start of a rule would end before an earlier one")
    return (out[0],) if out and nfa.final in out[0] else tuple(out)


class Automaton:
    """Transitions (states x 256) and, for each state, one bit per rule whose match can end there; state 0 is the first."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = tuple(rules)
        self.parts = [Nfa(rule) for rule in rules]
        sets = {letters for nfa in self.parts for moves in nfa.moves for letters, _ in moves}
        alike: dict[tuple, int] = {}
        kinds = [alike.setdefault(tuple(b in s for s in sets), len(alike)) for b in range(256)]
        example = {kind: b for b, kind in reversed(list(enumerate(kinds)))}
        step = cache(lambda i, threads, byte: _advance(self.parts[i], threads, byte))
        first = ((),) * len(self.parts)
        number, todo, table = {first: 0}, [first], []
        while todo:  # subset construction, in order of the states' numbers
            state, row = todo.pop(0), []
            for kind in range(len(example)):
                then = tuple(step(i, threads, example[kind]) for i, threads in enumerate(state))
                if then not in number:
                    number[then] = len(number)
                    todo.append(then)
                row.append(number[then])
            table.append(row)
        ends = [sum(1 << i for i, t in enumerate(state) if t and self.parts[i].final in t[0]) for state in number]
        table, ends = _minimised(np.array(table), np.array(ends, np.uint8))
        self.ends = ends
        self.table = np.ascontiguousarray(table[:, kinds].astype(np.uint16))
        self.resets = (self.table == 0).all(axis=0)
        if not self.resets[10]:
            raise ValueError("a line end has to end every match")

    def states(self, data: np.ndarray) -> np.ndarray:
        """The state after each byte. ``data`` begins in the first state."""
        flat, out = self.table.ravel(), np.empty(len(data), np.uint16)
        resets = np.flatnonzero(self.resets[data]) + 1
        # The first reset at or after every multiple of STRETCH parts the bytes.
        cuts = np.searchsorted(resets, np.arange(STRETCH, len(data), STRETCH))
        starts = np.unique(np.concatenate(([0], resets[cuts[cuts < len(resets)]])))
        starts = starts[starts < len(data)]
        sizes = np.diff(np.append(starts, len(data)))
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        # How many stretches are longer than each number of steps.
        longer = len(sizes) - np.searchsorted(sizes[::-1], np.arange(int(sizes[0]) if len(sizes) else 0), "right")
        state = np.zeros(len(starts), np.int64)
        for step, active in enumerate(longer.tolist()):
            if active < FEW:
                for one in range(active):
                    self._single(data, out, int(starts[one]) + step, int(starts[one] + sizes[one]), int(state[one]))
                break
            where = starts[:active] + step
            state = flat[(state[:active] << 8) | data[where]].astype(np.int64)
            out[where] = state
        return out

    def _single(self, data: np.ndarray, out: np.ndarray, first: int, end: int, state: int) -> None:
        rows, found = self.table.tolist() if end - first > 1 << 16 else None, []
        if rows is None:
            flat = self.table
            for byte in data[first:end].tolist():
                state = int(flat[state, byte])
                found.append(state)
        else:
            for byte in data[first:end].tolist():
                state = rows[state][byte]
                found.append(state)
        out[first:end] = found

    def scan(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """The spans (kind, start, end) of every text, by start, then in the order of the rules."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        pieces = [t.encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b"\n".join(pieces) + b"\n", np.uint8)
        edges = np.cumsum([0] + [len(p) + 1 for p in pieces])
        ends = self.ends[self.states(data)]
        letters = None
        for place, rule in enumerate(self.rules):
            says = np.concatenate(([0], (ends >> place) & 1, [0])).astype(np.int8)
            turns = np.flatnonzero(np.diff(says))
            first, last = turns[::2], turns[1::2]
            for hit in np.flatnonzero(last - first >= rule.tail).tolist():
                text = int(np.searchsorted(edges, first[hit], "right")) - 1
                limit = max(int(edges[text]), int(last[hit - 1]) if hit else 0)
                begin = self.parts[place].start_before(data, int(first[hit]), limit)
                if letters is None:
                    letters = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                base = letters[edges[text]]
                found[text].append((int(letters[begin] - base), place, int(letters[last[hit]] - base)))
        return [[(self.rules[p].kind, a, b) for a, p, b in sorted(spans)] for spans in found]


def _minimised(table: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest automaton that says the same: states are parted until all of a part move alike."""
    part = np.unique(ends, return_inverse=True)[1]
    while True:
        _, new = np.unique(np.column_stack((part, part[table])), axis=0, return_inverse=True)
        if new.max() == part.max():
            break
        part = new.ravel()
    firsts = np.unique(part, return_index=True)[1]
    order = np.argsort(firsts)  # the part of state 0 comes first
    number = np.empty(len(firsts), np.int64)
    number[order] = np.arange(len(firsts))
    firsts = firsts[order]
    return number[part[table[firsts]]], ends[firsts]


@cache
def compiled(rules: tuple[Rule, ...]) -> Automaton:
    return Automaton(rules)


def secrets(text: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The spans of a text column: an array of (kind, start, end), by start, then in the order of the rules."""
    rules = tuple(rules)

    @text_udf("array<struct<kind:string,start:int,end:int>>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = compiled(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for texts in batches:
            found, chunk, size = [], [], 0
            for text in texts:
                chunk.append(text.as_py() or "")
                size += len(chunk[-1])
                if size > CHUNK:
                    found += automaton.scan(chunk)
                    chunk, size = [], 0
            found += automaton.scan(chunk)
            yield pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in found], kind)

    return scan(text)
