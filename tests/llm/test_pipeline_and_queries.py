"""The registered corpus queries against SQL, and the pipeline against brute force."""

import os
import shutil
import subprocess
import sys
from collections import Counter

import brute
import corpus_pipeline
import edge_rows
import pytest
from parley.llm import mixture
from parley.llm.common import table, tokenizer_path
from parley.llm.oracle import ORACLE
from parley.llm.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    from oracle_check import compare
    assert compare(spark, SF, [name])[name][0] == "OK"


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "source").collect()]


def check_stages(spark, docs, sf_dir, items):
    """Every stage on what its predecessor kept, against brute force."""
    from tokenizers import Tokenizer
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, docs, sf_dir)
    assert good.columns == columns
    assert not Counter(rows(good)) - Counter(rows(docs))

    one = stages["simhash near-dedup"](spark, good, sf_dir)
    before = rows(good)
    prints = [brute.fingerprint(t) for _, t, _ in before]
    names = brute.components([d for d, _, _ in before], prints)
    assert one.columns == columns
    assert one.count() == len(set(brute.groups(prints)))
    assert {r[0] for r in rows(one)} == set(names)

    clean = stages["benchmark decontamination"](spark, one, sf_dir)
    before = rows(one)
    hits = brute.contamination([r[:2] for r in before], items)
    assert clean.columns == columns
    assert Counter(rows(clean)) == Counter(r for r, h in zip(before, hits) if h[2] == 0)

    mix = stages["mixing sources to target weights"](spark, clean, sf_dir)
    assert mix.columns == columns
    copies = {(r["doc_id"], r["source"], r["size"]): r["copies"] for r in mixture.copies(clean).collect()}
    expected = Counter()
    for d, t, s in rows(clean):
        n = len(brute.space_words(t))
        expected[d, t, s] += copies[d, s, n] if n else 0
    assert Counter(rows(mix)) == +expected

    out = stages["token-id output"](spark, mix, sf_dir)
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    index = brute.token_index([r[:2] for r in rows(mix)], tok)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out.collect()) == Counter((d, n, c) for d, _, n, c in index)
    return out


def test_pipeline_on_the_small_corpus(spark):
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    staged = check_stages(spark, table(spark, SF, "documents"), SF, items)
    same = lambda df: Counter(tuple(r) for r in df.collect())
    assert same(corpus_pipeline.run(spark, SF)) == same(staged)


@pytest.mark.parametrize("make", [edge_rows.documents, edge_rows.empty])
def test_pipeline_on_awkward_rows(spark, scratch, make):
    edge_rows.benchmark(spark).write.parquet(f"{scratch}/benchmark.parquet")
    edge_rows.labels(spark, [(3, 1, 0), (4, 1, 0), (12, 0, 0), (None, 1, 0), (9, None, None)]).write.parquet(f"{scratch}/labels.parquet")
    check_stages(spark, make(spark), scratch, edge_rows.ITEMS)


def test_the_library_works_without_the_corpus_part(scratch):
    home = os.path.join(scratch, "repo")
    shutil.copytree(ROOT, home, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; n = e.queries(); assert 'chat_list' in n and not [x for x in n if x[:2] == 'op']; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=home, check=True, timeout=120, env={**os.environ, "PYTHONPATH": home})


def small(spark):
    return rows(table(spark, SF, "documents"))


def got(spark, name, *columns):
    df = QUERIES[name](spark, SF).select(*columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    return Counter(tuple(r) for r in df.collect())


def test_licence_query(spark):
    expected = Counter()
    for d, t, _ in small(spark):
        w, places, labels = brute.item_words(t), [], set()
        for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        expected[d, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))] += 1
    assert got(spark, "op1_licences", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == expected
    for base, labels, score in QUERIES["op1_licences"](spark, SF).select("base_labels", "labels", "score").collect():
        assert set(filter(None, base.split(","))) <= set(labels.split(",")) | {""} and 0 <= score <= 1
        assert labels == ",".join(sorted(set(filter(None, labels.split(",")))))


def test_simhash_query(spark):
    data = small(spark)
    prints = [brute.fingerprint(t) for _, t, _ in data]
    names = brute.components([d for d, _, _ in data], prints)
    assert got(spark, "op2_simhash", "doc_id", "fingerprint", "component_id") == Counter(
        (d, f"{p:016x}", n) for (d, _, _), p, n in zip(data, prints, names))


def test_secret_query(spark):
    import hashlib
    expected = Counter()
    for d, t, _ in small(spark):
        spans = brute.base_spans(t)
        n = [sum(k == kind for k, _, _ in spans) for kind in ("assign", "access", "hex")]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        expected[(d, *n, hashlib.sha256(text.encode()).hexdigest())] += 1
    assert got(spark, "op3_secrets", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == expected


def test_quality_query(spark):
    import zlib
    truth = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    result = QUERIES["op7_quality"](spark, SF).collect()
    assert Counter(r["doc_id"] for r in result) == Counter(d for d, _, _ in small(spark))
    for r in result:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r["predicted"] == truth[r["doc_id"]] for r in result if r["held_out"] and r["doc_id"] in truth]
    assert sum(held) >= 0.9 * len(held) > 10


def test_mixture_query(spark):
    sizes, taken = Counter(), Counter()
    data = {d: (len(brute.space_words(t)), s) for d, t, s in small(spark)}
    for n, s in data.values():
        sizes[s] += n
    targets = brute.mixture_targets(sizes)
    for r in QUERIES["op9_mixture"](spark, SF).collect():
        n, s = data[r["doc_id"]]
        assert r["size"] == n and r["source_size"] == sizes[s] and r["target"] == pytest.approx(targets[s])
        assert r["taken"] in (0, n, 2 * n)
        taken[s] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= max(n for n, x in data.values() if x == s) for s in targets)


def test_token_query(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    assert got(spark, "op10_token_files", "doc_id", "start", "n_tokens", "ids_crc32") == Counter(
        brute.token_index([r[:2] for r in small(spark)], tok))


def notices(text):
    """Labels and score of a text by plain search: single-identifier tags, longest notices from the left, or / and."""
    import re

    from parley.llm import licences
    flat, phrases, out = [], licences.NOTICES | licences.BASE, []
    for k, piece in enumerate(re.split(r"(?i)spdx-license-identifier: ([a-z0-9.+-]+)", text or "")):
        flat += [licences.IDENTIFIERS.get(piece.lower(), piece.lower()) + "\n"] if k % 2 else brute.item_words(piece)
    i, between = 0, []
    while i < len(flat):
        n = max((len(p.split()) for p in phrases if flat[i:i + len(p.split())] == p.split()), default=0)
        label = flat[i].strip() if flat[i].endswith("\n") else phrases[" ".join(flat[i:i + n])] if n else None
        if label:
            left = [w for w in between if w not in ("the", "a", "an", "license")]
            out.append(("or" if left == ["or"] else "and", label))
            between, i = [], i + max(n, 1)
        else:
            between.append(flat[i])
            i += 1
    sides = []
    for word, label in out:
        if word == "or" or not sides:
            sides.append([])
        sides[-1].append(next((v for k, v in licences.OPENNESS.items() if label.startswith(k)), licences.UNKNOWN))
    base = {v for p, v in licences.BASE.items() if f" {p} " in f" {' '.join(brute.item_words(text))} "}
    return ",".join(sorted(base | {label for _, label in out})), max(map(min, sides), default=0.0)


def test_licence_labels_and_score(spark):
    from parley.llm import licences
    texts = [t for _, t, _ in small(spark)] + [
        "SPDX-License-Identifier: MIT, all rights reserved", "a SPDX-License-Identifier: MIT or SPDX-License-Identifier: GPL-3.0-only b",
        "SPDX-License-Identifier: CC0-1.0; GPL v2 or the Apache License", "under the MIT license or GNU General Public License version 3"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    result = {r["doc_id"]: (r["labels"], r["score"]) for r in licences.scan_licences(df).collect()}
    assert result == {i: notices(t) for i, t in enumerate(texts)}
    assert len({labels for labels, _ in result.values()}) > 4


def test_quality_stage_keeps_the_good_and_drops_the_bad(spark):
    truth = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    kept = {d for d, _, _ in rows(dict(corpus_pipeline.STAGES)["quality classifier"](spark, table(spark, SF, "documents"), SF))}
    ids = {d for d, _, _ in small(spark)}
    good, bad = ({d for d in ids if truth.get(d) == q} for q in (1, 0))
    assert len(good) > 10 and len(good - kept) <= 0.1 * len(good)
    assert len(bad) > 10 and len(bad & kept) <= 0.1 * len(bad)


def test_quality_scores_and_the_stage_equal_a_plain_fit(spark):
    rows_, truth = small(spark), [(r["doc_id"], r["quality"]) for r in table(spark, SF, "labels").collect()]
    scores = dict(zip([d for d, _, _ in rows_], brute.quality_scores([r[:2] for r in rows_], truth)))
    assert len(scores) == len(rows_)
    got_ = {r["doc_id"]: r["score"] for r in QUERIES["op7_quality"](spark, SF).collect()}
    assert got_ == pytest.approx(scores, abs=1e-6)
    kept = dict(corpus_pipeline.STAGES)["quality classifier"](spark, table(spark, SF, "documents"), SF)
    assert {r[0] for r in rows(kept)} == {d for d, x in scores.items() if x >= 0.5}
