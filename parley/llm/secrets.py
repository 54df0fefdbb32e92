"""Secret scan with one combined deterministic automaton.

``compile_rules`` parses the rule regexes, builds one nondeterministic automaton for all
rules (with a free start, so a match may begin anywhere), makes it deterministic by
subset construction over byte classes, minimises it by partition refinement and lays
it out as a flat transition array. ``Scanner.scan`` runs every text's bytes through that
array once and notes which rules accept, and where last. Such a rule's reversed automaton then runs back over
the text once and marks every place where a match begins; from the leftmost unused one its
anchored automaton takes the longest match. So each rule yields its leftmost, non-overlapping,
longest matches, in time linear in the text; texts without a hit are read once.

Rules may ask for a least length after the match is known (a shorter match is dropped, but
has used up its text). Positions are code points, ends exclusive.

Defined results: null or empty text has no spans; different rules may overlap; repeated
rows are scanned one by one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from parley.llm.common import process_cache, text_of


@dataclass(frozen=True)
class Rule:
    """``pattern``: literals, classes, groups, ``(?i:...)``, ``|``, ``?``, ``*``, ``+`` and ``{n,m}``.
    Of a match, the part behind ``before`` (a regex; empty: all of it) must have ``least`` bytes."""

    kind: str
    pattern: str
    least: int = 0
    before: str = ""


# The rules of the contract, in their order. Runs that are dropped when
# short are compiled with a smaller number, so the automaton need not count to ``least``.
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE_RULES = (
    Rule("assign", _ASSIGN + r"[A-Za-z0-9+/_.=-]+", 6, _ASSIGN),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{8,}", 24),
)
#: Further rules.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[opsur]_[A-Za-z0-9]+", 40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
)
RULES = BASE_RULES + MORE_RULES


class _Parser:
    """Rule regex to a fragment builder; every node is (kind, ...)."""

    def __init__(self, pattern: str) -> None:
        self.p, self.i, self.fold = pattern, 0, False

    def parse(self):
        tree = self.alternatives()
        if self.i < len(self.p):
            raise ValueError(f"unexpected {self.p[self.i]!r} in {self.p!r}")
        return tree

    def alternatives(self):
        branches = [self.sequence()]
        while self.peek() == "|":
            self.i += 1
            branches.append(self.sequence())
        return ("alt", branches) if len(branches) > 1 else branches[0]

    def peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            atom = self.atom()
            while self.peek() in ("?", "*", "+", "{") and self.peek():
                low, high = self.bounds()
                atom = ("repeat", atom, low, high)
            parts.append(atom)
        return ("seq", parts)

    def bounds(self) -> tuple[int, int | None]:
        c = self.peek()
        self.i += 1
        if c != "{":
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        end = self.p.index("}", self.i)
        low, comma, high = self.p[self.i:end].partition(",")
        self.i = end + 1
        return int(low), int(high) if high else None if comma else int(low)

    def char(self) -> int:
        c = self.p[self.i]
        self.i += 1
        if c != "\\":
            return ord(c)
        c = self.p[self.i]
        self.i += 1
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2:self.i], 16)
        return {"n": 10, "t": 9, "r": 13}.get(c, ord(c))

    def folded(self, chars: set[int]) -> tuple:
        if self.fold:
            chars = chars | {c ^ 32 for c in chars if chr(c).isalpha()}
        return ("set", frozenset(chars))

    def atom(self):
        c = self.peek()
        if c == "(":
            fold, self.fold = self.fold, self.fold or self.p.startswith("(?i:", self.i)
            self.i += 4 if self.p.startswith("(?i:", self.i) else 1
            inner = self.alternatives()
            self.i += 1
            self.fold = fold
            return inner
        if c != "[":
            return self.folded({self.char()})
        self.i += 1
        negate = self.peek() == "^"
        self.i += negate
        chars: set[int] = set()
        while self.peek() != "]":
            low = self.char()
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.i += 1
                chars |= set(range(low, self.char() + 1))
            else:
                chars.add(low)
        self.i += 1
        return self.folded(set(range(256)) - chars if negate else chars)


class _Nfa:
    """States with free moves and byte-set moves."""

    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.moves: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def build(self, node, start: int, reverse: bool) -> int:
        """Adds ``node`` from ``start`` on; returns its end state."""
        if node[0] == "set":
            end = self.state()
            self.moves[start].append((node[1], end))
            return end
        if node[0] == "seq":
            for part in reversed(node[1]) if reverse else node[1]:
                start = self.build(part, start, reverse)
            return start
        if node[0] == "alt":
            end = self.state()
            for branch in node[1]:
                self.free[self.build(branch, start, reverse)].append(end)
            return end
        _, inner, low, high = node
        for _ in range(low):
            start = self.build(inner, start, reverse)
        if high is None:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.build(inner, loop, reverse)].append(loop)
            return loop
        end = self.state()
        for _ in range(high - low):
            self.free[start].append(end)
            start = self.build(inner, start, reverse)
        self.free[start].append(end)
        return end


class Automaton:
    """A minimal deterministic automaton: byte classes, a flat array of next states, accepted rules by state.

    States are numbered as offsets into the array; those at ``first`` or above accept.
    State ``dead`` (if any) leads nowhere.
    """

    def __init__(self, trees: list, reverse: bool = False, anywhere: bool = False) -> None:
        nfa = _Nfa()
        begin = nfa.state()
        if anywhere:
            nfa.moves[begin].append((frozenset(range(256)), begin))
        accepts: dict[int, int] = {}
        for rule, tree in enumerate(trees):
            start = nfa.state()
            nfa.free[begin].append(start)
            accepts[nfa.build(tree, start, reverse)] = rule
        self._classes(nfa)
        self._determinise(nfa, begin, accepts)

    def _classes(self, nfa: _Nfa) -> None:
        """Bytes that no move tells apart share a class."""
        sets = list({s for m in nfa.moves for s, _ in m})
        seen: dict[tuple, int] = {}
        self.byte_class = bytes(seen.setdefault(tuple(b in s for s in sets), len(seen)) for b in range(256))
        self.width = len(seen)
        self.samples = [self.byte_class.index(c) for c in range(self.width)]

    def _determinise(self, nfa: _Nfa, begin: int, accepts: dict[int, int]) -> None:
        def closure(states) -> frozenset:
            todo, out = list(states), set(states)
            while todo:
                for t in nfa.free[todo.pop()]:
                    if t not in out:
                        out.add(t)
                        todo.append(t)
            return frozenset(out)

        # what a state leads to by each class, free moves included
        onward = [[frozenset().union(*[closure([t]) for chars, t in moves if b in chars]) for b in self.samples] if moves else None
                  for moves in nfa.moves]
        number = {closure([begin]): 0}
        order, table = list(number), []
        for states in order:  # grows
            row = []
            moving = [onward[s] for s in states if onward[s]]
            for c in range(self.width):
                nxt = frozenset().union(*[m[c] for m in moving])
                if nxt not in number:
                    number[nxt] = len(order)
                    order.append(nxt)
                row.append(number[nxt])
            table.append(row)
        accepted = [frozenset(accepts[s] for s in states if s in accepts) for states in order]
        self._minimise(table, accepted)

    def _minimise(self, table: list[list[int]], accepted: list[frozenset]) -> None:
        """Splits states by what they accept, then by where they lead, until nothing splits."""
        names: dict = {}
        block = [names.setdefault(a, len(names)) for a in accepted]
        while True:
            names = {}
            finer = [names.setdefault((block[i], *(block[t] for t in row)), len(names)) for i, row in enumerate(table)]
            if len(names) == len(set(block)):
                break
            block = finer
        first_of: dict[int, int] = {}
        for i, b in enumerate(block):
            first_of.setdefault(b, i)
        # accepting blocks get the highest numbers
        ranked = sorted(first_of, key=lambda b: (bool(accepted[first_of[b]]), first_of[b]))
        place = {b: k * self.width for k, b in enumerate(ranked)}
        self.next = array("i", [place[block[t]] for b in ranked for t in table[first_of[b]]])
        self.rules = {place[b]: sorted(accepted[first_of[b]]) for b in ranked if accepted[first_of[b]]}
        self.first = min(self.rules)
        self.start = place[block[0]]
        stuck = [p for p in place.values() if p < self.first and set(self.next[p:p + self.width]) == {p}]
        self.dead = stuck[0] if stuck else -1
        self.n_states = len(ranked)

    def longest(self, data: bytes, start: int) -> int:
        """The farthest end of a match that begins at ``start``."""
        s, reached = self.start, start
        for at in range(start, len(data)):
            s = self.next[s + self.byte_class[data[at]]]
            if s >= self.first:
                reached = at + 1
            elif s == self.dead:
                break
        return reached

    def accepting_places(self, data: bytes, stop: int) -> list[int]:
        """For a reversed automaton: all places at which a match that ends by ``stop`` begins, in order."""
        s, nxt, first, out = self.start, self.next, self.first, []
        for at, c in enumerate(data[:stop][::-1].translate(self.byte_class), 1):
            s = nxt[s + c]
            if s >= first:
                out.append(stop - at)
        return out[::-1]


class Scanner:
    """The combined automaton of the rules, and each rule's own two for placing a match."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        trees = [_Parser(r.pattern).parse() for r in rules]
        self.rules = rules
        self.all = Automaton(trees, anywhere=True)
        self.forward = [Automaton([t]) for t in trees]
        self.backward = [Automaton([t], anywhere=True, reverse=True) for t in trees]
        self.before = [re.compile(r.before.encode()) if r.before else None for r in rules]

    def scan_bytes(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule number) of the matches that are long enough, in bytes."""
        nxt, first, accepting = self.all.next, self.all.first, self.all.rules
        ends: dict[int, int] = {}                # rule: the last place where one of its matches ends
        s = self.all.start
        for i, c in enumerate(data.translate(self.all.byte_class), 1):
            s = nxt[s + c]
            if s >= first:
                for rule in accepting[s]:
                    ends[rule] = i
        out: list[tuple[int, int, int]] = []
        for rule, last in ends.items():
            r, used = self.rules[rule], 0
            for start in self.backward[rule].accepting_places(data, last):
                if start < used:
                    continue
                used = end = self.forward[rule].longest(data, start)
                skip = self.before[rule].match(data, start, end).end() - start if self.before[rule] else 0
                if end - start - skip >= r.least:
                    out.append((start, end, rule))
        return sorted(out, key=lambda m: (m[0], m[2]))

    def scan(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start and rule order."""
        data = text.encode()
        found = self.scan_bytes(data)
        if found and len(data) != len(text):
            points = np.append(0, np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80))
            found = [(int(points[a]), int(points[b]), r) for a, b, r in found]
        return [(self.rules[r].kind, a, b) for a, b, r in found]


def compiled(rules: tuple[Rule, ...]) -> Scanner:
    """The scanner of a rule set; built once in a process."""
    cache = process_cache("secrets")
    if rules not in cache:
        cache[rules] = Scanner(rules)
    return cache[rules]


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and ``spans`` (kind, start, end) of every document."""
    scanner = compiled(rules)  # its transition arrays (4 bytes a state and byte class, about 2 MB) travel to the tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in scanner.scan(t.as_py())]
                     for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")
