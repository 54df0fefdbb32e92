"""Packing, spelling variants and the Merkle manifest against their brute-force versions."""

import random
import zlib
from collections import Counter, defaultdict

import brute
import edge_rows
import numpy as np
import pytest
from parley.llm import merkle, packing, spelling
from parley.llm.common import table, tokenizer_path
from parley.llm.queries import QUERIES
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
TOKENIZER = tokenizer_path("byte_bpe_50k.json")


def corpus(spark, which):
    return {"edge": edge_rows.documents, "empty": edge_rows.empty}.get(which, lambda s: table(s, SF, "documents"))(spark)


@pytest.fixture(params=["edge", "empty", "small"])
def docs(request, spark):
    return corpus(spark, request.param)


def same(got, expected):
    assert Counter(map(tuple, got)) == Counter(map(tuple, expected))


# packing

@pytest.mark.parametrize("size", [8, 64])
def test_assignment_equals_the_plain_search(size):
    r = random.Random(3)
    for _ in range(60):
        lengths = [r.choice([1, 1, 2, 3, 5, size - 1, size, size + 1, 3 * size + 2, r.randint(1, 2 * size)]) for _ in range(r.randint(0, 40))]
        assert packing.assign(lengths, size, 50.0, 1.0) == brute.assign(lengths, size, 50.0, 1.0)


def test_costs_are_balanced():
    r = random.Random(4)
    sequences = packing.assign([r.randint(20, 900) for _ in range(3000)])
    cost = [sum(packing.LINEAR * n + packing.QUADRATIC * n * n for _, _, n in s) for s in sequences
            if sum(n for _, _, n in s) == packing.SIZE]
    assert np.std(cost) < 0.05 * np.mean(cost)


def check_pieces(pieces, texts, size):
    """Every id in exactly one piece, checksums, gapless sequences, no padding. ``texts``: Counter of (doc_id, text)."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(TOKENIZER)
    by_doc = defaultdict(Counter)
    for p in pieces:
        by_doc[p["doc_id"]][p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]] += 1
    expected = defaultdict(list)
    for (d, t), m in texts.items():
        expected[d] += [[*tok.encode(t or "", add_special_tokens=False).ids, 1]] * m
    assert set(by_doc) == set(expected)
    for d, documents in expected.items():
        assert sum(n * k for (_, n, _, _), k in by_doc[d].items()) == sum(map(len, documents))
        for start, n, crc, total in by_doc[d]:
            assert any(len(x) == total and zlib.crc32(np.array(x[start:start + n], "<u4").tobytes()) == crc for x in documents)
        if len(documents) == 1:
            spans = sorted((s, s + n) for s, n, _, _ in by_doc[d])
            assert spans[0][0] == 0 and spans[-1][1] == len(documents[0]) and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for s in sequences.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:]))
        used = s[-1][0] + s[-1][1]
        assert used == size or used < size and used & used - 1 == 0


def test_packing(docs, spark):
    texts = Counter((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    path = packing.write_sequences(docs, TOKENIZER, size=256, group_ids=5000, group_docs=20)
    pieces = packing.read_pieces(spark, path).collect()
    check_pieces(pieces, texts, 256)
    ids = {r["sequence_id"]: r["ids"] for r in packing.read_sequences(spark, path).collect()}
    for p in pieces:
        some = ids[p["sequence_id"]][p["offset"]:p["offset"] + p["length"]]
        assert zlib.crc32(np.array(some, "<u4").tobytes()) == p["ids_crc32"]


def test_packing_query(spark):
    texts = Counter((r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect())
    first, again = (QUERIES["op11_packing"](spark, SF).collect() for _ in range(2))
    check_pieces(first, texts, 2048)
    same(first, again)


# spelling

COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


@pytest.mark.parametrize("options", [{}, {"symbols": 2, "crowd": 3}, {"symbols": 5, "crowd": 1}])
def test_spelling(docs, options):
    words = spelling.word_counts(docs, lose_every=199).filter("n >= 5")
    got = spelling.groups(words, **options).select(*COLUMNS).collect()
    same(got, brute.spelling([tuple(r) for r in docs.select("doc_id", "text").collect()]))


def test_chains_ties_and_other_letters(spark):
    words = [("variant", 5000), ("varianta", 900), ("variantab", 100), ("variantabc", 20), ("other", 3), ("ather", 15), ("bther", 15),
             ("łódkaż", 4), ("łódkaź", 20), ("single", 7)]
    df = spark.createDataFrame(words, "word string, n long")
    for crowd in (1, 32):
        got = {r["word"]: (r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling.groups(df, crowd=crowd).collect()}
        assert got == {
            "variant": (1, None, None, "variant"), "varianta": (2, "variant", 5000, "variant"),
            "variantab": (2, "varianta", 900, "variant"), "variantabc": (1, "variantab", 100, "variant"),
            "other": (2, "ather", 15, "ather"), "ather": (2, None, None, "ather"), "bther": (2, None, None, "bther"),
            "łódkaż": (1, "łódkaź", 20, "łódkaź"), "łódkaź": (1, None, None, "łódkaź"), "single": (0, None, None, "single")}


def test_a_crowd_of_words_with_one_reduced_form_is_not_paired(spark):
    """5,000 words whose letters share a symbol: pairs formed before the check stay linear in the words."""
    table_ = spelling._Reduction(4)
    alike = [c for c in "abcdefghijklmnopqrstuvwxyz" if table_[ord(c)] == table_[ord("a")]]
    r = random.Random(1)
    words = sorted({"".join(r.choice(alike) for _ in range(9)) for _ in range(5000)})
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    assert spelling.reduced(df, 4).select("form").distinct().count() == 1
    got = {(a["word"], a["near"]) for a in spelling.near_words(df, symbols=4).collect()}
    known = set(words)
    expected = {(w, v) for w in words for i in range(9) for x in alike for v in [w[:i] + x + w[i + 1:]] if v != w and v in known}
    assert got == expected


# Merkle manifest

def test_merkle(docs):
    got = merkle.verify(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect()
    same(got, brute.merkle([tuple(r) for r in docs.select(*merkle.FIELDS).collect()]))


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_merkle_sizes_around_full_runs(spark, n):
    rows = [(i, f"Text {i}", None, "one" if i % 3 else "two", i) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = merkle.verify(df, F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect()
    same(got, brute.merkle([(d, s, g, k, t) for d, t, g, s, k in rows]))


def test_merkle_of_a_hot_source_and_equal_rows(spark):
    rows = [(7, "same", "en", "hot", 4)] * 700 + [(i, f"T{i}", "en", f"s{i % 300}", 2) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = merkle.verify(df, F.lit(False)).collect()
    expected = brute.merkle([(d, s, g, k, t) for d, t, g, s, k in rows])
    same([(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in got], [r[:5] for r in expected])
    assert all(r["verified"] for r in got)


def test_requests_for_some_leaves_follow_only_their_nodes(spark):
    rows = [(i, f"Text {i}", "en", f"s{i % 5}", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    m = merkle.build(df.select("doc_id", "source", merkle.leaf().alias("leaf")))
    some = m.leaves.filter("doc_id in (3, 1999)")
    got = merkle.prove(m, some).select("doc_id", merkle.fold(F.col("leaf"), F.col("proof")).alias("root"), F.size("proof").alias("n"))
    same(got.collect(), [(3, m.root, 4), (1999, m.root, 4)])
    wrong = merkle.prove(m, some).select(merkle.fold(merkle.digest(F.lit("x")), F.col("proof")) == m.root)
    assert not any(r[0] for r in wrong.collect())


def test_merkle_is_native_and_without_pairs(spark):
    plan = QUERIES["op13_merkle"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop") if x in plan]
