"""Merkle manifest of a dataset: a content-addressed tree per source, and one over the sources.

``leaves`` hashes every row. ``build`` numbers the leaves of each source by doc_id, hashes
every ``FAN`` consecutive nodes into one until one is left (the subroot), does the same
with the subroots, and stores one record a node: digest, children. Equal subtrees are one
record.

``prove`` answers requests for leaves by descent. The requests' ranks, written with base ``FAN``
digits, spell the way from the root: in each step the record of a node's digest is
looked up, the next digit selects a child, and the unselected children go to the node's
path. Requests that share a prefix share the node that holds it, so a level has
no more rows than the tree has nodes there, the root is looked up once whatever the
number of requests, and only nodes that some request needs are followed. The paths run
from the root down; a proof is the reverse: siblings of the leaf first.

Everything is built from DataFrame functions. Rows of a hot source are dealt by (source, doc_id),
and numbered by one count a (partition, source); a node's children are at most ``FAN`` rows;
no digest table reaches the driver, which only collects the root and the sizes
of the largest tree. Leaves, nodes and numbers are written tables.

Defined results: a null column is hashed as ``-``, an empty text as ``0:``; a null source is a
source of its own and the first one; null doc_ids come last in their source and
are never tampered with; rows that share a doc_id are ordered by their leaf, and equal rows have
equal leaves and neighbouring ranks; a source with one row has its leaf as subroot, one
source its subroot as root; an empty table has no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import LOWER, UPPER, numbered, written

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[str] = FIELDS, **changed: Column) -> Column:
    """The leaf of a row; ``changed`` names other values for some columns."""
    return digest(*[field(changed.get(c, F.col(f"`{c}`"))) for c in fields])


def depth(n: Column) -> Column:
    """Levels above n leaves: the smallest d with FAN**d >= n (bit lengths, as FAN is a power of two)."""
    bits = FAN.bit_length() - 1
    return F.ceil((F.length(F.bin(n - 1)) * (n > 1).cast("int")) / bits).cast("int")


@dataclass
class Manifest:
    """A stored tree: ``leaves`` (the rows given, tree, rank), ``trees`` (source, tree, n, height, subroot),
    ``records`` (digest, children), the root, its height and the height of the largest tree."""

    leaves: DataFrame
    trees: DataFrame
    records: DataFrame
    root: str | None
    root_height: int
    tallest: int


def _raise(nodes: DataFrame, height: int) -> tuple[DataFrame | None, DataFrame]:
    """Hashes (tree, rank, digest) level by level; returns all records and the top node of every tree."""
    bits, records, tops = FAN.bit_length() - 1, None, None
    for level in range(height + 1):
        done = nodes.filter(F.col("height") == level).select("tree", "digest")
        tops = done if tops is None else tops.unionByName(done)
        if level == height:
            break
        children = F.transform(F.array_sort(F.collect_list(F.struct("rank", "digest"))), lambda x: x["digest"])
        nodes = written(nodes.filter(F.col("height") > level)
                        .groupBy("tree", "height", F.shiftright("rank", bits).alias("rank")).agg(children.alias("children"))
                        .withColumn("digest", F.sha2(F.array_join("children", "").cast("binary"), 256)), "merkle-level")
        some = nodes.select("digest", "children")
        records = some if records is None else records.unionByName(some)
    return records, tops


def build(leaves: DataFrame, group: str = "source", order: str = "doc_id") -> Manifest:
    """The manifest of rows with ``group``, ``order`` and ``leaf``; other columns stay in its ``leaves``."""
    spark = leaves.sparkSession
    salted = written(leaves.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id())), "merkle-leaves")
    placed = numbered(salted, [group], [F.col(order).asc_nulls_last(), F.col("leaf")], salt="_salt").drop("_salt")
    counts = placed.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    trees = numbered(counts, [], [F.col(group).asc_nulls_first()], out="tree")
    trees = written(trees.withColumn("height", depth(F.col("n"))), "merkle-trees")
    n_trees, tallest = trees.agg(F.count(F.lit(1)), F.max("height")).first()
    names = trees.select(F.col(group).alias("_group"), "tree", "height")
    placed = written(placed.join(names, F.col(group).eqNullSafe(F.col("_group"))).drop("_group"), "merkle-placed")
    none = spark.createDataFrame([], "digest string, children array<string>")
    if not n_trees:
        return Manifest(placed.drop("height"), trees.withColumn("subroot", F.lit(None).cast("string")), none, None, 0, 0)
    below, subroots = _raise(placed.select("tree", "height", "rank", F.col("leaf").alias("digest")), tallest)
    subroots = written(subroots, "merkle-subroots")
    root_height = spark.range(1).select(depth(F.lit(n_trees))).first()[0]
    above, root = _raise(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(root_height).alias("height"),
                                         F.col("tree").alias("rank"), "digest"), root_height)
    records = none
    for t in (below, above):   # None where a single leaf or a single source needs no node
        records = records if t is None else records.unionByName(t)
    records = written(records.groupBy("digest").agg(F.any_value("children").alias("children")), "merkle-records")
    trees = trees.join(subroots.withColumnRenamed("digest", "subroot"), "tree")
    return Manifest(placed.drop("height"), trees, records, root.first()["digest"], root_height, tallest)


def _siblings(children: Column, digit: Column) -> Column:
    """One path segment: the unselected children left and right of the selected one, as text."""
    return F.struct(F.array_join(F.slice(children, F.lit(1), digit), "").alias("left"),
                    F.array_join(F.slice(children, digit + 2, F.lit(FAN)), "").alias("right"))


def _step(nodes: DataFrame, records: DataFrame, wanted: DataFrame) -> DataFrame:
    """From (tree, height, rank, digest, path) to those children that ``wanted`` (tree, rank) names."""
    found = nodes.join(records, "digest")
    child = found.select("tree", (F.col("height") - 1).alias("height"), F.col("rank").alias("_parent"), "path", "children",
                         F.posexplode("children").alias("_digit", "_child"))
    child = child.select("tree", "height", (F.col("_parent") * FAN + F.col("_digit")).alias("rank"), F.col("_child").alias("digest"),
                         F.concat("path", F.array(_siblings(F.col("children"), F.col("_digit")))).alias("path"))
    return child.join(wanted, ["tree", "rank"], "left_semi")


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (rows with ``tree`` and ``rank``) plus ``proof``: segments (left, right), the leaf's first."""
    spark, bits = requests.sparkSession, FAN.bit_length() - 1
    if manifest.root is None:
        return requests.withColumn("proof", F.lit(None).cast("array<struct<left: string, right: string>>"))
    parents = written(requests.select("tree", F.shiftright("rank", bits).alias("rank")).distinct(), "merkle-wanted")

    def above(t: DataFrame, levels: int, *keys: str) -> DataFrame:
        return t.select(*keys, F.shiftright("rank", bits * levels).alias("rank")).distinct()

    # down the tree of the sources
    sources = parents.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank")).distinct()
    at = spark.createDataFrame([(0, manifest.root_height, 0, manifest.root, [])],
                               "tree long, height int, rank long, digest string, path array<struct<left: string, right: string>>")
    for level in range(manifest.root_height - 1, -1, -1):
        at = _step(at, manifest.records, above(sources, level, "tree"))
    # down the trees of all sources, the tallest first, as far as the leaves' parents
    heights = manifest.trees.select(F.col("tree").alias("rank"), F.col("height").alias("_height"))
    at = written(at.join(heights, "rank").select(F.col("rank").alias("tree"), F.col("_height").alias("height"),
                                                 F.lit(0).cast("long").alias("rank"), "digest", "path"), "merkle-subroot-paths")
    for level in range(manifest.tallest, 1, -1):
        lower = _step(at.filter(F.col("height") == level), manifest.records, above(parents, level - 2, "tree"))
        at = written(at.filter(F.col("height") < level).unionByName(lower), "merkle-paths")
    # the last digit is the request's own: the parent's record travels, not one long path a leaf
    last = at.join(manifest.records, "digest", "left").select(
        "tree", F.col("rank").alias("_parent"), "path", F.when(F.col("height") == 1, F.col("children")).alias("children"))
    digit = F.col("rank").bitwiseAND(F.lit(FAN - 1)).cast("int")
    found = requests.withColumn("_parent", F.shiftright("rank", bits)).join(last, ["tree", "_parent"])
    own = F.when(F.col("children").isNull(), F.array()).otherwise(F.array(_siblings(F.col("children"), digit)))
    return found.select(*requests.columns, F.concat(own, F.reverse("path")).alias("proof"))


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, start, lambda node, s: digest(s["left"], node, s["right"]))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings of a proof in order."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def tampered_text(text: Column) -> Column:
    """The text with A-Z lower-cased."""
    return F.translate(text, UPPER, LOWER)


def verify(docs: DataFrame, tampered: Column) -> DataFrame:
    """Builds the manifest of ``docs``, requests every leaf, and folds each row's proof from the leaf of
    the row, or of its tampered version where ``tampered`` holds."""
    t = docs.select(*[F.col(f"`{c}`") for c in FIELDS], tampered.alias("_hit"))
    t = t.select("doc_id", "source", leaf().alias("leaf"),
                 F.when(F.coalesce("_hit", F.lit(False)), leaf(text=tampered_text(F.col("text")))).alias("other_leaf"))
    m = build(t)
    proofs = prove(m, m.leaves)
    subroots = m.trees.select("tree", "subroot")
    done = proofs.join(subroots, "tree").withColumn("root", F.lit(m.root).cast("string"))
    folded = fold(F.coalesce("other_leaf", "leaf"), F.col("proof"))
    return done.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                       folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
