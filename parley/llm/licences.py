"""Licence scan: Aho-Corasick for phrases and tags, a shunting-yard parser for expressions.

One automaton holds every phrase of ``BASE`` and ``NOTICES`` and the identifier tag, as
word sequences between single spaces. Each text is scanned once, in its word form.
Texts with a hit get their statements put in order and joined by the word that
stands between two neighbours (``or``, ``and``, ``with``; anything else counts as
``and``); identifier tags bring their own expression, and end with it: further tags and notices
of the same line count. ``shunting_yard`` turns the whole
into postfix, ``evaluate`` gives the labels and how open the result is.

Defined results: null or empty text has no words, no label and score 0; overlapping
phrases all count; a malformed tag expression adds nothing, nor does one whose ``with`` has not one
licence on its left and one exception on its right; repeated rows are
scanned one by one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from parley.llm.common import WORD_BYTES, text_of

# The phrases of the contract and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Further notices.
NOTICES = {
    "the mit license": "mit",
    "apache license": "apache",
    "apache 2 0": "apache-2",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gpl v2": "gpl-2",
    "gpl v3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
TAG_HEAD = re.compile(r"spdx-license-identifier\s*:?[ \t]*", re.IGNORECASE)
#: The words of ``WORD_BYTES`` in a string.
WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")
#: Identifiers of tags that have a label above.
IDENTIFIERS = {"apache-2.0": "apache-2", "cc-by-nc-4.0": "cc-by-nc", "gpl-2.0-only": "gpl-2", "gpl-2.0-or-later": "gpl-2",
               "gpl-3.0-only": "gpl-3", "gpl-3.0-or-later": "gpl-3", "cc0-1.0": "cc0", "mpl-2.0": "mpl", "gpl-2.0": "gpl-2",
               "gpl-3.0": "gpl-3", "gpl-2.0+": "gpl-2", "gpl-3.0+": "gpl-3", "lgpl-2.1-only": "lgpl-2.1",
               "lgpl-2.1-or-later": "lgpl-2.1", "lgpl-3.0-only": "lgpl-3", "lgpl-3.0-or-later": "lgpl-3", "lgpl-3.0": "lgpl-3",
               "agpl-3.0-only": "agpl-3", "agpl-3.0-or-later": "agpl-3", "agpl-3.0": "agpl-3", "cc-by-4.0": "cc-by",
               "cc-by-3.0": "cc-by", "cc-by-sa-4.0": "cc-by-sa", "cc-by-sa-3.0": "cc-by-sa", "cc-by-nc-3.0": "cc-by-nc"}
#: How freely a text under a licence may be used, 0 to 1, by its name without a version.
OPENNESS = {"all-rights-reserved": 0.0, "cc-by-nc": 0.2, "cc-by-nc-sa": 0.2, "cc-by-nc-nd": 0.1, "cc-by-nd": 0.3, "busl": 0.2,
            "elastic": 0.2, "sspl": 0.3, "agpl": 0.4, "gpl": 0.5, "osl": 0.5, "lgpl": 0.6, "eupl": 0.6, "mpl": 0.7, "epl": 0.7,
            "cddl": 0.7, "ms-rl": 0.7, "odbl": 0.7, "cc-by-sa": 0.7, "artistic": 0.8, "ofl": 0.8, "cc-by": 0.9, "odc-by": 0.9,
            "mit": 1.0, "apache": 1.0, "bsd": 1.0, "0bsd": 1.0, "isc": 1.0, "zlib": 1.0, "bsl": 1.0, "ms-pl": 1.0, "afl": 1.0,
            "x11": 1.0, "ncsa": 1.0, "psf": 1.0, "python": 1.0, "postgresql": 1.0, "upl": 1.0, "wtfpl": 1.0, "unlicense": 1.0,
            "pddl": 1.0, "cc0": 1.0, "public-domain": 1.0}
#: What follows a licence's name: version, number of clauses, "only" or "or later".
VERSION = re.compile(r"(-v?\d[\d.]*)?(-clause)?(-only|-or-later)?\+?$")
UNKNOWN = 0.3
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, expression string, places array<struct<word:long,label:string>>")


def shunting_yard(tokens: list[str]) -> list[str] | None:
    """Postfix form of an infix token list with and / or / with and parentheses; None if it is malformed."""
    out, stack, operand = [], [], False
    for t in tokens:
        if t in PRECEDENCE:
            if not operand:
                return None
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[t]:
                out.append(stack.pop())
            stack.append(t)
            operand = False
        elif t == "(":
            if operand:
                return None
            stack.append(t)
        elif t == ")":
            while operand and stack and stack[-1] != "(":
                out.append(stack.pop())
            if not operand or not stack:
                return None
            stack.pop()
        else:
            if operand:
                return None
            out.append(t)
            operand = True
    if not operand or "(" in stack:
        return None
    return out + stack[::-1]


def well_formed(tokens: list[str]) -> int:
    """Length of the longest beginning of a token list that ``shunting_yard`` takes."""
    depth, operand, length = 0, False, 0
    for i, t in enumerate(tokens, 1):
        if operand != (t in PRECEDENCE or t == ")") or t == ")" and not depth:
            break
        depth += (t == "(") - (t == ")")
        operand = t not in PRECEDENCE and t != "("
        if operand and not depth:
            length = i
    return length


def openness(label: str) -> float:
    """By the licence's name, without its version and without an exception."""
    licence = label.split("-with-")[0]
    return OPENNESS.get(licence, OPENNESS.get(VERSION.sub("", licence), UNKNOWN))


def evaluate(postfix: list[str]) -> tuple[set[str], float]:
    """Labels of an expression and its openness: ``or`` takes the freer side, ``and`` the stricter one;
    ``with`` names an exception to the one licence on its left."""
    labels: set[str] = set()
    stack: list[tuple[str, float]] = []    # the label (empty: of several, already among ``labels``) and the openness
    for t in postfix:
        if t not in PRECEDENCE:
            stack.append((t, openness(t)))
            continue
        (right, b), (left, a) = stack.pop(), stack.pop()
        if t == "with":
            stack.append((f"{left}-with-{right}", a))
        else:
            labels |= {left, right}
            stack.append(("", max(a, b) if t == "or" else min(a, b)))
    return (labels | {stack[0][0]}) - {""}, stack[0][1]


def takes_exceptions(tokens: list[str]) -> bool:
    """Whether every ``with`` stands between one licence and one exception."""
    names = [t not in PRECEDENCE and t not in "()" for t in tokens]
    return all(0 < i < len(tokens) - 1 and names[i - 1] and names[i + 1] and (i < 2 or tokens[i - 2] != "with")
               for i, t in enumerate(tokens) if t == "with")


def tag_tokens(expression: str) -> list[tuple[str, int, int]]:
    """Tokens of an identifier tag's line with their places, up to the first thing that belongs to no expression."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9.+-]+|[()]|\S", expression):
        if not re.fullmatch(r"[A-Za-z0-9.+-]+|[()]", m[0]):
            break
        t = m[0].lower()
        out.append((t if t in PRECEDENCE else IDENTIFIERS.get(t, t), m.start(), m.end()))
    return out


class Scanner:
    """The automaton over words; built once per task."""

    def __init__(self, base: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> None:
        import ahocorasick
        self.base, self.notices = BASE if base is None else base, NOTICES if notices is None else notices
        self.machine = ahocorasick.Automaton()
        for phrase in {*self.base, *self.notices, TAG}:
            self.machine.add_word(f" {phrase.encode().decode('latin-1')} ", phrase)
        self.machine.make_automaton()

    def scan(self, text: str) -> dict:
        words = text.encode().translate(WORD_BYTES).split()
        flat = f" {b' '.join(words).decode('latin-1')} "
        hits, spaces, counted = [], 0, 0
        for end, phrase in self.machine.iter(flat):   # by ascending end
            spaces, counted = spaces + flat.count(" ", counted, end + 1), end + 1
            after = spaces - 1
            hits.append((after - phrase.count(" ") - 1, after, phrase))
        return {"words": words, "hits": sorted(hits)}

    def statements(self, text: str, found: dict) -> list[tuple[int, int, list[str]]]:
        """(first word, word after, tokens) of every statement; of overlapping phrases the longest."""
        notices = [(a, b, label) for a, b, p in sorted(found["hits"], key=lambda h: (h[0], -h[1]))
                   if (label := self.base.get(p) or self.notices.get(p))]
        tags = self.tags(text, notices) if any(p == TAG for _, _, p in found["hits"]) else []
        out, reached, k = [], -1, 0
        for start, end, label in notices:
            while k < len(tags) and tags[k][1] <= start:
                k += 1
            if start >= reached and not (k < len(tags) and tags[k][0] <= start and end <= tags[k][1]):
                out.append((start, end, [label]))
                reached = end
        return sorted(out + tags, key=lambda s: s[:2])

    @staticmethod
    def tags(text: str, notices: list[tuple[int, int, str]]) -> list[tuple[int, int, list[str]]]:
        """The statements of identifier tags. A tag ends with its expression: what follows on the line is scanned like any
        text, and a notice that begins in the expression and goes on behind it is a notice, not part of the expression."""
        words = [w.start() for w in WORD.finditer(text)]
        heads = list(TAG_HEAD.finditer(text))
        starts = [a for a, _, _ in notices]
        out = []
        for m, after in zip(heads, [*(h.start() for h in heads[1:]), len(text)]):
            stop = text.find("\n", m.end(), after)
            tokens = tag_tokens(text[m.end():after if stop < 0 else stop])
            while tokens := tokens[:well_formed([t for t, _, _ in tokens])]:  # trailing prose does not belong to the expression
                end = bisect_left(words, m.end() + tokens[-1][2])
                first = {bisect_left(words, m.end() + a): k for k, (t, a, _) in reversed([*enumerate(tokens)]) if t != ")"}
                inside = notices[bisect_left(starts, min(first)):bisect_left(starts, end)]
                cut = next((first[a] for a, b, _ in inside if b > end and a in first), None)
                if cut is None:
                    if takes_exceptions([t for t, _, _ in tokens]):
                        out.append((bisect_left(words, m.start()), end, ["(", *(t for t, _, _ in tokens), ")"]))
                    break
                tokens = tokens[:cut]
        return out

    def judge(self, text: str) -> tuple:
        found = self.scan(text)
        n = len(found["words"])
        if not found["hits"]:
            return n, 0, None, None, "", "", 0.0, "", []
        places = [(s, self.base[p]) for s, _, p in found["hits"] if p in self.base]
        starts = [s for s, _ in places]
        tokens, last, single, joiner = [], None, False, ""
        stated = self.statements(text, found)
        for start, end, part in stated:
            one = sum(x not in "()" for x in part) == 1
            if last is not None:
                between = [w.decode() for w in found["words"][last:start] if w not in (b"the", b"a", b"an", b"license")]
                joiner, before = between[0] if len(between) == 1 and between[0] in PRECEDENCE else "and", joiner
                if joiner == "with" and not (one and single and before != "with"):   # an exception to one licence only
                    joiner = "and"
                tokens.append(joiner)
            tokens += part
            last, single = end, one
        postfix = shunting_yard(tokens) if tokens else None
        labels, score = evaluate(postfix) if postfix else (set(), 0.0)
        base = {label for _, label in places}
        every = [{"word": s, "label": x} for s, _, part in stated for x in part if x not in PRECEDENCE and x not in "()"]
        return (n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                ",".join(sorted(base | labels)), score, " ".join(tokens), every)


def scan_licences(docs: DataFrame, base: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> DataFrame:
    """One row per document: counts, base places, labels, the evaluated expression and all places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string(),
                 pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expression",
                 "places"]
        for batch in batches:
            cols = list(zip(*(scanner.judge(t.as_py()) for t in batch.column("text")))) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             names=names)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, RESULT)
