"""Spelling variants: words one edit apart, found through a reduced alphabet.

1. ``word_counts``: the runs of letters of all whole texts, counted per task and summed.
2. ``reduced``: every letter is hashed to one of a few symbols; a word becomes a short
   string over them. One edit on a word is one edit, or none, on its reduced form.
   ``symbols_for`` takes more symbols as the vocabulary grows, so that few words share a form; the
   links found are the same for any number.
3. ``near_words``: the full one-edit neighbourhood (deletions, replacements, insertions, the form
   itself) of every distinct reduced form is generated and joined with the distinct forms; the
   words behind each pair of forms are verified on the original strings.
   Neighbourhoods mirror each other, so only the half with neighbour >= form travels.
   Forms shared by more than ``CROWD`` words (words that differ in letters with the same symbol) are left
   out there: their words are reduced again with a symbol for every letter, where a form
   is the word and no pair is wrong. No candidate list grows with a crowd.
4. ``groups``: a word's form is its most frequent near word, if that is ``FACTOR`` times as frequent;
   forms are followed to the last by doubling (each step multiplies the count by ``FACTOR``, so
   chains are short and have no cycle).

Word counts, reduced words and links are tables; nothing but the number of words, the letters that
occur (a part of Unicode) and the loop's counts reaches the driver.

Defined results: null and empty texts have no words; repeated rows and rows that share a doc_id all
count; a null doc_id reads as empty text where it enters a hash; runs of any length and
very long texts are taken whole; ties between near words go to the smallest in code-point order; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import LOWER, UPPER, give_back, written

#: Letters of a word once A-Z is lower-cased.
LETTERS = "a-zÀ-ÿ"
LEAST_LETTERS, LEAST_COUNT, FACTOR = 6, 5, 5
#: Words that may share a reduced form before they are reduced letter by letter.
CROWD = 32
#: Different words a task holds before it passes their counts on.
HELD_WORDS = 500_000
_LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def word_counts(docs: DataFrame, least_letters: int = LEAST_LETTERS, letters: str = LETTERS, lose_every: int | None = None) -> DataFrame:
    """word, n: maximal runs of ``letters``, at least ``least_letters`` long.

    ``lose_every``: where it divides the CRC-32 of ``<doc_id>:<run>``, the run loses the code point
    that this number's remainder by its length names (misspellings with a known origin).
    """
    run_form = re.compile(f"[{letters}]{{{least_letters},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                              names=["word", "n"])

        for b in batches:
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
                runs = run_form.findall(t.as_buffer().to_pybytes().translate(_LOWER_BYTES).decode())
                if lose_every is None:
                    total.update(runs)
                else:
                    seed = zlib.crc32(f"{'' if d is None else d}:".encode())
                    for run, n in Counter(runs).items():
                        h = zlib.crc32(run.encode(), seed)
                        if h % lose_every == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1:]
                            if len(run) < least_letters:
                                continue
                        total[run] += n
                if len(total) > HELD_WORDS:
                    yield counted()
                    total.clear()
        yield counted()
        total.clear()
        give_back()

    some = docs.select("doc_id", "text").filter("text is not null").mapInArrow(count, "word string, n long")
    return some.groupBy("word").agg(F.sum("n").alias("n"))


def symbols_for(n_words: int) -> int:
    """Symbols with which ``n_words`` words of ``LEAST_LETTERS`` letters rarely share a reduced form."""
    return max(4, min(64, round((16 * max(n_words, 1)) ** (1 / LEAST_LETTERS)) + 1))


class _Reduction(dict):
    """Letter to symbol, by hash; with ``letters`` one symbol for each of them."""

    def __init__(self, symbols: int, letters: str | None = None) -> None:
        super().__init__()
        self.symbols = letters or "".join(chr(ord("0") + i) for i in range(symbols))
        self.whole = letters is not None

    def __missing__(self, code: int) -> str:
        self[code] = chr(code) if self.whole else self.symbols[zlib.crc32(chr(code).encode()) % len(self.symbols)]
        return self[code]

    def neighbourhood(self, form: str) -> set[str]:
        """``form`` and every string one deletion, replacement or insertion away."""
        out = {form}
        for i in range(len(form) + 1):
            a, b = form[:i], form[i:]
            out.update([a + s + b for s in self.symbols])
            if b:
                out.add(a + b[1:])
                out.update([a + s + b[1:] for s in self.symbols])
        return out


def _mapped(df: DataFrame, column: str, schema: str, f) -> DataFrame:
    """Rows (value, f's values) for every value of a string column; ``f`` is made by the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column(column).to_pylist()
            for at in range(0, len(values), 500):
                pairs = [(v, x) for v in values[at:at + 500] for x in f(v)]
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())],
                                                 names=[x.split()[0] for x in schema.split(", ")])

    return df.select(column).mapInArrow(run, schema)


def reduced(words: DataFrame, symbols: int) -> DataFrame:
    """word, n and the word's reduced form."""
    table = _Reduction(symbols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            forms = [w.translate(table) for w in b.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("n"), pa.array(forms, pa.string())], names=["word", "n", "form"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, form string")


def near_words(words: DataFrame, symbols: int | None = None, crowd: int = CROWD) -> DataFrame:
    """word, n, near, near_n: both directions of every pair of distinct words exactly one edit apart."""
    k = symbols or symbols_for(words.count())
    r = written(reduced(words, k), "reduced-words")
    sizes = written(r.groupBy("form").agg(F.count(F.lit(1)).alias("size")), "reduced-forms")
    forms = sizes.filter(F.col("size") <= crowd).select("form")
    table = _Reduction(k)
    ring = _mapped(forms, "form", "form string, other string", lambda form: [x for x in table.neighbourhood(form) if x >= form])
    pairs = ring.join(forms.withColumnRenamed("form", "other"), "other")
    left = r.select("form", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = r.select(F.col("form").alias("other"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    pairs = (pairs.join(left, "form").join(right, "other")
             .filter((F.col("form") < F.col("other")) | (F.col("a") < F.col("b")))
             .filter(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n"))
    crowded = written(r.join(sizes.filter(F.col("size") > crowd), "form", "left_semi").select("word", "n"), "crowded-words")
    letters = crowded.limit(1).count() and "".join(sorted(
        x[0] for x in words.select(F.explode(F.split("word", "")).alias("c")).distinct().collect() if x[0]))
    links = _both(pairs)
    if letters:
        whole = _Reduction(0, letters)
        ring = _mapped(crowded, "word", "a string, b string", lambda w: whole.neighbourhood(w) - {w})
        found = (ring.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
                 .join(crowded.select(F.col("word").alias("a"), F.col("n").alias("a_n")), "a")
                 .filter(F.levenshtein("a", "b", 1) == 1))
        # a link between two crowded words is found from either
        once = found.join(crowded.select(F.col("word").alias("b"), F.lit(True).alias("_also")), "b", "left")
        links = links.unionByName(_both(once.filter(F.col("_also").isNull() | (F.col("a") < F.col("b"))).select("a", "a_n", "b", "b_n")))
    return links


def _both(pairs: DataFrame) -> DataFrame:
    side = F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    other = F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    return pairs.select(F.inline(F.array(side, other)))


def groups(words: DataFrame, factor: int = FACTOR, symbols: int | None = None, crowd: int = CROWD) -> DataFrame:
    """word, n, n_near, form, form_n, root of every row of ``words`` (word, n; distinct words)."""
    words = written(words.select("word", "n"), "vocabulary")
    links = near_words(words, symbols, crowd)
    best: Column = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    most = -F.col("best")["less"]
    t = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        *[F.when(most >= factor * F.col("n"), c).alias(name) for c, name in ((F.col("best")["near"], "form"), (most, "form_n"))])
    t = written(t, "word-forms")
    chain = t.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        further = chain.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        chain = written(chain.join(further, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "word-roots")
        if not chain.filter("_moved").limit(1).count():
            break
        chain = chain.drop("_moved")
    return t.join(chain.drop("_moved"), "word", "left").withColumn("root", F.coalesce("root", "word"))
