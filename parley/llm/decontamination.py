"""Benchmark decontamination with a positional inverted index (DataFrame functions only).

1. ``term_counts``: corpus frequency of every benchmark word.
2. ``probes``: each window of ``width`` item words names its two rarest words, the
   probe positions of the item. Every occurrence of a window holds both.
3. ``postings``: (term, doc_id, position) of the probe terms in the whole corpus,
   stored in the shared folder. The index is partitioned by document, so a term
   that a third of all documents hold is not one task.
4. ``alignments``: a posting at ``position`` of an item word at ``p`` proposes that
   the item starts at ``position - p``. Offset-adjusted lists are intersected on
   (document, item, start): one hash exchange by document and item, whose
   groups are bounded by one document's length.
   A start at which both probes of a window meet is a phrase candidate;
   two probes within ``slack`` words of their distance are a proximity match.
5. ``decontaminate``: candidates return to the documents, where the words are
   compared exactly; words inside an occurring window are hit.

The index lower-cases each *word* with ``lower`` (all scripts). Words that are equal once A-Z is
lower-cased are equal in that form too, so it can only add candidates; a whole text must not be
lower-cased so, as the form of a letter may depend on what stands behind its word. The final
comparison lower-cases A-Z alone, as the windows are defined.
Benchmark tables are broadcast in blocks of at most ``block_rows`` rows; a larger
benchmark takes more passes over the corpus and the same result. Documents are known by a hash of doc_id
and text, so null or repeated ids are spread. Texts move only for documents that have a candidate, as
far as a bitmap of ``MARK_BITS`` bits (8 MB, broadcast) can tell; the words of all others are counted in the scan.

Defined results: null or empty texts have no words; an item without words is never
found; a null doc_id or item_id is matched like any other value (its id prints
as an empty string); rows repeating a doc_id are compared each by its own
text; an empty benchmark hits nothing; extra columns stay in ``row``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import LOWER, NOT_WORD, UPPER, as_row, text_of, written

#: Everything that is not a word character, capitals being word characters.
NOT_CASED_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

WIDTH = 10
#: Words by which the distance of two probes may differ in a proximity match.
SLACK = 3
#: Rows of a benchmark table that one broadcast may hold (about 100 bytes a row).
BLOCK_ROWS = 200_000
#: Bits of the bitmap of documents with candidates, and of one of its rows (2048 rows of 4 KB).
MARK_BITS, ROW_BITS = 26, 15


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, NOT_WORD), "")


def _cased_words(text: Column) -> Column:
    """The same words in their own case."""
    return F.array_remove(F.split(text, NOT_CASED_WORD), "")


def _exact_words(text: Column) -> Column:
    return _words(F.translate(text, UPPER, LOWER))


def _blocks(df: DataFrame, key: str, block_rows: int) -> list[DataFrame]:
    """``df`` in parts of about ``block_rows`` rows at most, rows of a key together. Each part may be broadcast."""
    n = max(1, -(-df.count() // block_rows))
    return [df] if n == 1 else [df.filter(F.pmod(F.xxhash64(key), F.lit(n)) == b) for b in range(n)]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def item_words(items: DataFrame) -> DataFrame:
    """item (a key of id and words), item_id, exact words ``iw`` and index words ``tw``; repeated rows once."""
    t = items.select(F.col("item_id").cast("string").alias("item_id"), text_of().alias("text"))
    t = t.select("item_id", _exact_words(F.col("text")).alias("iw"), F.transform(
        _cased_words(F.col("text")), F.lower).alias("tw"))
    t = t.filter(F.size("iw") > 0).select(
        F.sha2(F.to_json(F.struct("item_id", "iw")), 256).alias("item"), F.coalesce("item_id", F.lit("")).alias("item_id"),
        "iw", "tw")
    return t.dropDuplicates(["item"])


def term_counts(docs: DataFrame, items: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Corpus occurrences of each word of the items (0 where the corpus has none)."""
    vocabulary = items.select(F.explode("tw").alias("term")).distinct()
    words = docs.select(F.explode(_cased_words(text_of())).alias("term")).select(F.lower("term").alias("term"))
    parts = [words.join(F.broadcast(b), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
             for b in _blocks(vocabulary, "term", block_rows)]
    return vocabulary.join(_union(parts), "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def window_probes(items: DataFrame, counts: DataFrame, width: int = WIDTH) -> DataFrame:
    """For each item the distinct pairs (a, b) of probe positions of its windows (a = b in a one-word window)."""
    at = items.select("item", F.size("tw").alias("len"), F.posexplode("tw").alias("p", "term"))
    ranked = at.join(counts, "term").groupBy("item", "len").agg(
        F.sort_array(F.collect_list(F.struct("p", "n"))).alias("w"))      # one benchmark item
    # struct (n, p) orders a window's words from rare to common
    win = ranked.select("item", F.explode(F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("len") - width)),
        lambda s: F.sort_array(F.transform(F.slice(F.col("w"), s + 1, F.lit(width)),
                                           lambda e: F.struct(e["n"].alias("n"), e["p"].alias("p")))))).alias("w"))
    pair = F.struct(F.col("w")[0]["p"].alias("a"), F.coalesce(F.get("w", F.lit(1))["p"], F.col("w")[0]["p"]).alias("b"))
    return win.groupBy("item").agg(F.collect_set(pair).alias("pairs"))


def postings(docs: DataFrame, terms: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The inverted index: every (term, doc_id, pos) in the corpus of the given terms."""
    words = docs.select("doc_id", F.posexplode(_cased_words(text_of())).alias("pos", "term")).withColumn("term", F.lower("term"))
    return _union([words.join(F.broadcast(b), "term") for b in _blocks(terms, "term", block_rows)])


def candidates(index: DataFrame, items: DataFrame, pairs: DataFrame, slack: int = SLACK,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, item, shift (where the item's first word would stand), ``phrase`` and ``near``."""
    probe = (pairs.select("item", F.explode(F.array_distinct(F.flatten(F.transform(
        "pairs", lambda x: F.array(x["a"], x["b"]))))).alias("p"))
        .join(items.select("item", "tw"), "item").select("item", "p", F.col("tw")[F.col("p")].alias("term")))
    lists = _union([index.join(F.broadcast(b), "term") for b in _blocks(probe, "item", block_rows)])
    lists = lists.select("doc_id", "item", (F.col("pos") - F.col("p")).alias("shift"), "p")
    met = (lists.repartition("doc_id", "item").groupBy("doc_id", "item", "shift")
           .agg(F.collect_set("p").alias("ps")).join(pairs, "item"))
    phrase = F.exists("pairs", lambda x: F.array_contains("ps", x["a"]) & F.array_contains("ps", x["b"]))
    around = Window.partitionBy("doc_id", "item").orderBy("shift").rangeBetween(-slack, slack)
    met = met.withColumn("ps_near", F.array_distinct(F.flatten(F.collect_list("ps").over(around))))
    near = F.exists("pairs", lambda x: F.array_contains("ps_near", x["a"]) & F.array_contains("ps_near", x["b"]))
    return met.select("doc_id", "item", "shift", phrase.alias("phrase"), near.alias("near")).filter("phrase or near")


def _matches(width: int) -> Column:
    """Of one candidate ``c`` and the document words ``w``: starts (in the item) of the windows that occur."""
    def starts(c: Column) -> Column:
        n = F.size(c["iw"])
        same = F.array_join(F.transform(c["iw"], lambda x, i: F.when(
            F.get(F.col("w"), i + c["shift"]) == x, F.lit("1")).otherwise(F.lit("0"))), "")
        span = F.least(F.lit(width), n)
        return F.filter(F.sequence(F.lit(0), n - span), lambda s: F.substr(same, s + 1, span) == F.repeat(F.lit("1"), span))

    return F.transform("cands", lambda c: F.struct(
        c["item_id"].alias("item_id"), c["shift"].alias("shift"), F.least(F.lit(width), F.size(c["iw"])).alias("span"),
        starts(c).alias("starts")))


def _marked(t: DataFrame, keys: DataFrame) -> DataFrame:
    """``t`` plus ``marked``: false where ``key`` is surely not among ``keys``. The bitmap is at most 8 MB, whatever their number."""
    place = lambda c: F.col(c).bitwiseAND(F.lit((1 << MARK_BITS) - 1))
    bits = keys.select(F.shiftright(place("key"), ROW_BITS).alias("_line"),
                       place("key").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_bit"))
    lines = bits.groupBy("_line").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    t = t.withColumns({"_at": F.shiftright(place("key"), ROW_BITS), "_bit": place("key").bitwiseAND(F.lit((1 << ROW_BITS) - 1))})
    byte = F.conv(F.hex(F.substr("_bits", (F.shiftright("_bit", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    on = F.getbit(byte, F.col("_bit").bitwiseAND(F.lit(7)).cast("int")) == 1
    t = t.join(F.broadcast(lines), t["_at"] == lines["_line"], "left")
    return t.withColumn("marked", F.coalesce(on, F.lit(False))).drop("_at", "_bit", "_line", "_bits")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, slack: int = SLACK,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``row`` (all columns of ``docs``) and a struct ``leak``: n_words, n_hit, items (ids with occurring
    windows, sorted), hits (spans of hit words: start, length), n_near (items with a proximity match)."""
    key = lambda doc_id, text: F.xxhash64(doc_id, F.coalesce(text, F.lit("")))
    slim = docs.select(key(F.col("doc_id"), F.col("text")).alias("doc_id"), "text")
    items = written(item_words(benchmark.select("item_id", "text")), "bench-items")
    counts = written(term_counts(slim, items, block_rows), "bench-terms")
    pairs = written(window_probes(items, counts, width), "bench-windows")
    probe_terms = (pairs.join(items.select("item", "tw"), "item")
                   .select(F.explode(F.flatten(F.transform("pairs", lambda x: F.array(
                       F.col("tw")[x["a"]], F.col("tw")[x["b"]])))).alias("term")).distinct())
    index = written(postings(slim, probe_terms, block_rows), "postings")
    cand = candidates(index, items, pairs, slack, block_rows)
    # One document's candidates: bounded by its own length.
    per_doc = (cand.join(items.select("item", "item_id", "iw"), "item").groupBy(F.col("doc_id").alias("of_doc"))
               .agg(F.collect_list(F.when(F.col("phrase"), F.struct("item_id", "shift", "iw"))).alias("cands"),
                    F.count_distinct(F.when(F.col("near"), F.col("item"))).alias("n_near")))
    per_doc = written(per_doc, "candidates")
    t = docs.select(as_row(docs)).withColumn("key", key(F.col("row")["doc_id"], F.col("row")["text"]))
    marked = _marked(t, per_doc.select(F.col("of_doc").alias("key")))
    text = F.coalesce(F.col("row")["text"], F.lit(""))
    near = marked.filter("marked").join(per_doc, F.col("key") == per_doc["of_doc"], "left")
    # counting words needs no lower case; only candidates pay for it
    has = F.size(F.coalesce("cands", F.array())) > 0
    near = near.select("row", "cands", "n_near", F.when(has, _exact_words(text)).otherwise(_cased_words(text)).alias("w"))
    far = marked.filter("not marked").select("row", F.size(_cased_words(text)).cast("long").alias("n_words"))
    t = near
    matches = F.when(F.size(F.coalesce("cands", F.array())) > 0, F.filter(
        _matches(width), lambda m: F.size(m["starts"]) > 0))
    # A generator, not a projection: a caller's filter on the result must not be pushed below it,
    # where the words would be cut again for every use.
    one = F.array(F.struct(F.size("w").cast("long").alias("n_words"), matches.alias("found")))
    t = t.select("row", "n_near", F.inline(one))
    nothing = [F.lit(None).cast(t.schema[c].dataType).alias(c) for c in ("n_near", "found")]
    t = t.unionByName(far.select("row", nothing[0], "n_words", nothing[1]))
    found = F.col("found")
    hits = F.flatten(F.transform(found, lambda m: F.transform(m["starts"], lambda s: F.struct(
        (m["shift"] + s).alias("start"), m["span"].alias("length")))))
    t = t.select("row", "n_near", "n_words", F.array_sort(F.array_distinct(F.transform(found, lambda m: m["item_id"]))).alias("items"),
                 F.array_distinct(hits).alias("hits"))
    hit_words = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(
        h["start"], h["start"] + h["length"] - 1))))
    leak = F.struct("n_words", F.coalesce(F.size(hit_words), F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"), "hits",
                    F.coalesce("n_near", F.lit(0)).alias("n_near"))
    return t.select("row", leak.alias("leak"))
