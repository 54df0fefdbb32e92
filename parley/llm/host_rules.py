"""Quality rules judged at host level (DataFrame functions only).

1. ``document_stats`` counts, inside each row, what the rules need. No rows are
   exploded: repeated three-word windows are found by sorting the window hashes
   of one text, so a text never leaves its task.
2. ``rule_failures`` turns the counts into one boolean per rule.
3. ``host_verdicts`` sums failures per host (partial aggregation, so a host with
   a third of all rows is combined map-side) and shrinks each rate towards the
   corpus with a beta prior fitted by moments over the hosts:
   ``(failures + a) / (documents + a + b)``. Small hosts stay near the corpus
   rate; only hosts with enough evidence are blocked.
4. ``judge`` joins the host verdicts back to the documents.

Defined results: null or empty text has no words (it fails ``too_short``); a null
host is a host of its own; repeated rows are judged one by one; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import space_words, text_of, written

#: A rule fails a document when its condition holds. Integer arithmetic, so no rounding.
RULES: dict[str, str] = {
    "too_short": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "exclaiming": "5 * n_exclaim > n_words",
    "capitals": "2 * n_capitals > word_chars",
    "repeated_lines": "2 * n_dup_lines > n_lines",
}
BASE_RULES = ("too_short", "repeated_words")
#: A host whose shrunk failure rate is above this loses all its documents.
MAX_HOST_RATE = 0.5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaim", "n_capitals")


def _only(text: Column, chars: str) -> Column:
    """How many characters of the class ``chars`` the text has."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def document_stats(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source") -> DataFrame:
    """doc_id, host and the counts of ``COUNTS`` for every row of ``docs``."""
    t = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text_of().alias("text"))
    t = t.select("doc_id", "host", "text", space_words(F.col("text")).alias("w"),
                 F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    w = F.col("w")
    windows = F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                                                 lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])))
    t = t.select("doc_id", "host", F.size(w).cast("long").alias("n_words"),
                 F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                 _only(F.col("text"), "#*$%&|<>").alias("n_symbols"),
                 _only(F.col("text"), "!").alias("n_exclaim"), _only(F.col("text"), "A-Z").alias("n_capitals"),
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.coalesce(windows, F.array().cast("array<bigint>")).alias("g"))
    # window starts whose window occurs twice or more: neighbours of the same hash after sorting
    g = F.col("g")
    by_hash = F.when(F.size(F.array_distinct(g)) < F.size(g),
                     F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("p")))))
    t = t.withColumn("s", by_hash).drop("g")
    s = F.col("s")
    twice = F.filter(s, lambda e, i: F.get(s, i - 1)["h"].eqNullSafe(e["h"]) | F.get(s, i + 1)["h"].eqNullSafe(e["h"]))
    t = t.withColumn("p", F.sort_array(F.transform(twice, lambda e: e["p"]))).drop("s")
    # the windows cover [p, p + 2]; the union's size is the sum of min(3, distance to the start before)
    p = F.col("p")
    cover = F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                        lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")),
                        lambda a: a["n"].cast("long"))
    return t.select("doc_id", "host", *[c for c in COUNTS if c != "n_repeat_words"],
                    F.coalesce(cover, F.lit(0)).cast("long").alias("n_repeat_words"))


def rule_failures(stats: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """``stats`` plus ``fails``: one boolean per rule, in a struct."""
    rules = rules or RULES
    return stats.withColumn("fails", F.struct(*[F.expr(c).alias(n) for n, c in rules.items()]))


def host_verdicts(failed: DataFrame, rules: dict[str, str] | None = None,
                  max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: documents, the shrunk failure rate of each rule, ``host_kept``."""
    names = list(rules or RULES)
    hosts = failed.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.count_if(F.col("fails")[n]).alias(f"k_{n}") for n in names])
    # The prior needs two moments of the host rates for each rule: one row, whatever the data's size.
    moments = hosts.agg(*[f(F.col(f"k_{n}") / F.col("n_docs")).alias(f"{m}_{n}")
                          for n in names for m, f in (("mean", F.avg), ("var", F.var_pop))]).first()
    rates = []
    for n in names:
        mean, var = moments[f"mean_{n}"] or 0.0, moments[f"var_{n}"] or 0.0
        strength = min(max(mean * (1 - mean) / var - 1, 1.0), 1e6) if var > 0 else 1e6
        if not 0 < mean < 1:
            strength = 1.0  # no host, or all alike: a weak prior at the common rate
        rates.append(((F.col(f"k_{n}") + mean * strength) / (F.col("n_docs") + strength)).alias(f"rate_{n}"))
    hosts = hosts.select("host", "n_docs", *rates)
    return hosts.withColumn("host_kept", F.greatest(*[f"rate_{n}" for n in names]) <= max_rate)


def judge(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source",
          rules: dict[str, str] | None = None, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Counts, the rules each document fails, its host's verdict, ``base_failed`` and ``kept``.

    A document is kept if it fails no rule and its host is not blocked.
    """
    rules = rules or RULES
    stats = rule_failures(written(document_stats(docs, id_col, host_col), "host-stats"), rules)
    hosts = host_verdicts(stats, rules, max_rate)
    base = F.lit(False)
    for n in BASE_RULES:
        if n in rules:
            base = base | F.col("fails")[n]
    any_fail = F.lit(False)
    for n in rules:
        any_fail = any_fail | F.col("fails")[n]
    verdict = hosts.select(F.col("host").alias("of_host"), "host_kept")
    return (stats.join(verdict, stats["host"].eqNullSafe(verdict["of_host"]), "left").drop("of_host")
            .withColumn("failed_rules", F.array_compact(F.array(
                *[F.when(F.col("fails")[n], F.lit(n)) for n in rules])))
            .withColumn("base_failed", base)
            .withColumn("kept", ~any_fail & F.coalesce(F.col("host_kept"), F.lit(True))))
