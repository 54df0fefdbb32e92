"""SimHash near-dedup with BK-trees over fingerprint shards.

1. ``fingerprints``: 64-bit SimHash of the word shingles of every whole text.
2. ``buckets``: fingerprints within ``radius`` bits agree exactly on at least
   ``parts - radius`` of any ``parts`` equal bit ranges. Each choice of that many ranges is a
   table; a fingerprint falls into one bucket per table, and every close pair shares a
   bucket. More distinct fingerprints call for more ranges (``key_plan``), so buckets
   stay small at any size; the pairs found are the same.
   A bucket of more than ``shard_rows`` members (templated texts) is cut again: the bits in which its own
   members differ are divided into ranges in the same way, until every bucket is one shard. So a crowded
   bucket costs a few copies of its members, not one for each pair of shards.
3. ``links``: the members of a bucket form one BK-tree (children keyed by their Hamming distance
   to the parent; a search follows only edges within the radius). The shuffle brings them
   together, not the driver, which must not hold all fingerprints. A shard returns a
   star per connected set, not pairs.
4. ``components``: large-star / small-star contraction of the links, each round a
   written table.

Copies share one fingerprint and take part once, so a text that a third of all
documents repeat is one node.

Defined results: null or empty texts (and texts without words) have fingerprint
zero and link like any other; fewer words than a shingle: the whole sequence is the only
shingle; repeated rows and ties fall into one component; a null doc_id is never the
smallest unless the component has no other; an empty table gives no rows; extra columns
stay in ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import as_row, from_row, give_back, text_of, written

SHINGLE = 4
RADIUS = 4
#: Members of one BK-tree, at most; larger buckets are cut on further bits.
SHARD_ROWS = 2048
#: Distinct fingerprints a bucket should hold on average, at most.
BUCKET_ROWS = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text: bit i is set if bit i is set in over half of the shingle hashes."""
    words = (text or "").encode().lower().split()  # both as bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    spaces = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 0x20)
    starts = [0, *(spaces + 1).tolist()]
    ends = [*spaces[shingle - 1:].tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends)], dtype="<u8")
    count = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 4096):  # bounded memory on long texts
        bits = np.unpackbits(h[i:i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long, computed batch by batch."""
    @F.arrow_udf("long")
    def fp(texts: pa.Array) -> pa.Array:
        out = pa.array(np.array([fingerprint(t.as_py(), shingle) for t in texts], dtype=np.uint64).view(np.int64))
        give_back()
        return out

    return fp(text)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp of every row, as a written table (the text is read once)."""
    return written(docs.select("doc_id", fingerprint_column(text_of(), shingle).alias("fp")), "fingerprints")


def _masks(bits: list[int], n: int, radius: int, target: int) -> list[int]:
    """Masks over ``bits`` (their positions) of which fingerprints that differ elsewhere in none, and within
    ``radius`` bits here, agree on at least one; as many ranges as leave ``target`` of ``n`` in a bucket."""
    agree = 1
    while n > target * 2 ** (len(bits) * agree / (radius + agree)) and agree < 5 and radius + agree < len(bits):
        agree += 1
    parts = radius + agree
    edges = [len(bits) * i // parts for i in range(parts + 1)]
    ranges = [sum(1 << x for x in bits[a:b]) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(ranges, agree)]


def key_plan(n: int, radius: int = RADIUS) -> list[int]:
    """Bit masks of the bucket tables for ``n`` distinct fingerprints."""
    return _masks(list(range(64)), n, radius, BUCKET_ROWS)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def finer_masks(varying: Column, n: Column, radius: int, target: int) -> Column:
    """The masks that cut a crowded bucket of ``n`` members, over the bits in which these differ."""
    @F.arrow_udf("array<long>")
    def masks(v: pa.Array, count: pa.Array) -> pa.Array:
        return pa.array([[_signed(m) for m in _masks([b for b in range(64) if x >> b & 1], c, radius, target)]
                         for x, c in zip(v.to_pylist(), count.to_pylist())], pa.list_(pa.int64()))

    return masks(varying, n)


def buckets(nodes: DataFrame, masks: list[int], radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """bucket, fp: each fingerprint in its bucket of every table, none with more than ``shard_rows`` members.

    A bucket is named by a hash; two that share a name are one larger bucket, which only adds candidates.
    Members differ in fewer bits at every level, so the loop ends. Distinct fingerprints that differ
    in at most ``radius`` bits are within the radius of each other anyway and stay together.
    """
    cut = F.array(*[F.lit(_signed(m)).cast("long") for m in masks])
    key = lambda *outer: F.xxhash64(*outer, "i", F.col("fp").bitwiseAND(F.col("mask")))
    level = nodes.select("fp", F.posexplode(cut).alias("i", "mask")).select(key().alias("bucket"), "fp")
    done = []
    while True:
        crowded = (level.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"),
                                               F.bit_or("fp").bitwiseXOR(F.bit_and("fp")).alias("varying"))
                   .filter((F.col("n") > shard_rows) & (F.bit_count("varying") > radius)))
        crowded = written(crowded.select(F.col("bucket").alias("of"), finer_masks(
            F.col("varying"), F.col("n"), radius, max(1, shard_rows // 4)).alias("masks")), "crowded-buckets")
        if crowded.isEmpty():
            return reduce(DataFrame.unionByName, done, level)
        split = written(level.join(crowded, F.col("bucket") == F.col("of"), "left").select(
            "bucket", "fp", F.posexplode_outer("masks").alias("i", "mask")), "split-buckets")
        done.append(split.filter("i is null").select("bucket", "fp"))
        level = split.filter("i is not null").select(key("bucket").alias("bucket"), "fp")


class BKTree:
    """Fingerprints by Hamming distance; ``children[i]`` maps a distance to the child of node i."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """The nodes within ``radius`` bits of ``value``."""
        found, todo = [], [0] if self.values else []
        values, children = self.values, self.children
        while todo:
            node = todo.pop()
            d = (values[node] ^ value).bit_count()
            if d <= radius:
                found.append(node)
            if kids := children[node]:
                low, high = d - radius, d + radius
                todo += [k for e, k in kids.items() if low <= e <= high]
        return found

    def add(self, value: int) -> int:
        at, new = 0, len(self.values)
        if new:
            while True:
                kids = self.children[at]
                nxt = kids.setdefault((self.values[at] ^ value).bit_count(), new)
                if nxt == new:
                    break
                at = nxt
        self.values.append(value)
        self.children.append({})
        return new


def shard_links(values, radius: int) -> Iterator[tuple[int, int]]:
    """Links among the fingerprints of one shard: a star per connected set."""
    tree, up = BKTree(), []

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for fp in values:
        near = tree.near(fp, radius)
        i = tree.add(fp)
        up.append(i)
        for other in near:
            up[root(other)] = i
    for i, fp in enumerate(tree.values):
        if (r := root(i)) != i:
            yield fp, tree.values[r]


def links(shards: DataFrame, radius: int = RADIUS) -> DataFrame:
    """u, v: fingerprints within the radius, as stars that connect what the close pairs connect."""
    dealt = shards.repartition("bucket").sortWithinPartitions("bucket", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                yield from zip(b.column("bucket").to_pylist(), b.column("fp").to_numpy().view(np.uint64).tolist())

        out: list[tuple[int, int]] = []

        def batch() -> pa.RecordBatch:
            a = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["u", "v"])

        for _, group in groupby(rows(), key=lambda r: r[0]):
            out.extend(shard_links((f for _, f in group), radius))
            if len(out) >= 65536:
                yield batch()
        yield batch()

    return dealt.select("bucket", "fp").mapInArrow(run, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """fp, root: the smallest fingerprint connected to each one that has a link."""
    e = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                "links")
    seen = None
    while True:
        # large star: larger neighbours move to the smallest neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("least", "u").alias("m"))
        large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        e = written(small, "links")
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return e.select(F.col("u").alias("fp"), F.col("v").alias("root"))
        seen = state


def linked(prints: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """fp, root of every distinct fingerprint of ``prints`` that has a neighbour."""
    nodes = written(prints.select("fp").distinct(), "fingerprint-nodes")
    return components(links(buckets(nodes, key_plan(nodes.count(), radius), radius, shard_rows), radius))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp (signed) and component_id, the smallest doc_id reachable over links."""
    prints = fingerprints(docs, shingle)
    roots = linked(prints, radius).withColumnRenamed("fp", "of")
    per_fp = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))     # copies combine map-side
    per_fp = per_fp.join(roots, per_fp["fp"] == roots["of"], "left").select(
        F.col("fp").alias("of"), "least", F.coalesce("root", "fp").alias("root"))
    ids = written(per_fp, "fingerprint-roots")
    smallest = ids.groupBy("root").agg(F.min("least").alias("component_id"))
    named = ids.join(smallest, "root").select("of", "component_id")
    return prints.join(named, prints["fp"] == named["of"], "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` (all columns) with one document of each component: the smallest doc_id, then the smallest
    text hash; of repeated rows one stays."""
    slim = docs.select("doc_id", text_of().alias("text"))
    prints = written(slim.select("doc_id", F.xxhash64("text").alias("hash"),
                                 fingerprint_column(F.col("text"), shingle).alias("fp")), "fingerprints")
    roots = linked(prints, radius).withColumnRenamed("fp", "of")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash"))
    per_fp = prints.groupBy("fp").agg(best.alias("best"))
    per_fp = per_fp.join(roots, per_fp["fp"] == roots["of"], "left")
    kept = per_fp.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best"))
    # one key per component; two components never share one, since equal texts have equal fingerprints
    key = lambda i, h: [i.isNull().alias("k1"), F.coalesce(i, F.lit(0)).alias("k2"), h.alias("k3")]
    kept = kept.select(*key(F.col("best")["doc_id"], F.col("best")["hash"]))
    row = docs.select(as_row(docs))
    text = F.coalesce(F.col("row")["text"], F.lit(""))
    rows = row.select("row", *key(F.col("row")["doc_id"], F.xxhash64(text))).join(kept, ["k1", "k2", "k3"], "left_semi")
    # the join's partitioning serves the window, whose groups are repeats of one row
    simple = [f"`{c}`" for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    order = F.xxhash64(*[F.col(f"row.{c}") for c in simple])
    nth = F.row_number().over(Window.partitionBy("k1", "k2", "k3").orderBy(order))
    return rows.withColumn("nth", nth).filter("nth = 1").select(*from_row(docs.columns))
