"""Near copies of whole texts: SimHash with multi-index hashing, min-hash buckets, verified shingle sets.

This is the near-dedup of the pipeline, at a five-word shingle similarity
(Jaccard) of ``least`` or more.  First ``simhash.links`` fetches the pairs whose
SimHashes of the shingles lie within two bits, and the verified ones are the first
components.  Multi-index hashing of 64-bit SimHashes alone cannot reach all
pairs: texts 0.8 alike lie 3 to 14 bits apart, and balls of that radius hold most
of a segment's values.  So the pairs beyond two bits are fetched by min-hashes.

Each text has ``BANDS`` times ``ROWS`` min-hashes of its shingles; texts that agree
on all min-hashes of a band meet in a bucket.  Runs of further text and scattered
edits count alike here: of pairs 0.8 alike (1 - 0.8^ROWS)^BANDS, about 3 in a
million, never meet.  A pair that meets goes on if the share of equal min-hashes
is at most ``SLACK`` below ``least`` (six standard deviations at 0.8), and is an
edge only if the shingle sets of the two texts themselves are ``least`` alike.
Texts of equal shingle sets are one class from the start.

Pairs within a bucket would grow with the square of a group of near copies.  So
in each of ``ROUNDS`` rounds a class is held against one member of the largest
component of the fullest of its buckets (in the first against the member that
meets most others: copies of a text are nearer to it than to each other), and
then only pairs of different components are fetched, each once, of which at most
one end lies in the largest component of the bucket.  A pair that is left out
has both ends in one component already, so no component loses a member.

Copies that are less than ``least`` alike to each other stay apart, and all meet.
A pair comes out of the first bucket that it shares alone, and only if its
min-hashes let it go on.  In buckets of more than ``CROWD`` classes it must also
be possible: two sets of n and m shingles that are ``least`` alike share
``least / (1 + least) * (n + m)`` of them, and neither shares more than it has in
common with all classes of such buckets (``live``).  No edge is lost by this; the
comparisons of sketches still grow with the square of a bucket of such copies.

Defined results: texts without words are equal; a text of fewer than five words
is one shingle; rows with a null doc_id follow their text; equal rows are one;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.llm import simhash
from kinlink.llm.common import stored
from kinlink.llm.graph import components

ROUNDS = 3
WIDTH = 5  # words of a shingle
ROWS, BANDS = 4, 24  # min-hashes of a band, and bands
SLACK = 0.24
CROWD = 8  # classes of a bucket whose pairs are sifted by what they can share


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots.toDF("_n", "_r"), F.col("node") == F.col("_n"), "left").withColumn("root", F.coalesce("_r", "node")).drop("_n", "_r")


def near_roots(own: DataFrame, sketched: DataFrame, verified: Callable[..., DataFrame], first: DataFrame, can_share: Callable[[DataFrame], DataFrame], least: float) -> DataFrame:
    """node, root: components of all pairs that meet in a bucket, or are named in ``first``, and are ``verified``, for nodes with a link.

    own: a row for each bucket (key, band) of a node; sketched: node, sketch; first: pairs a, b; can_share(nodes): node, n, live for the nodes of crowded buckets.
    """
    # The components so far are the nodes of the next round's graph, so that an edge is walked in one round only.
    to = lambda d, x, roots: d.join(roots.toDF(x, f"root_{x}"), x, "left").withColumn(f"root_{x}", F.coalesce(f"root_{x}", x))

    def merged(roots: DataFrame, pairs: DataFrame, sifted: bool = False) -> DataFrame:
        links = to(to(verified(pairs, sifted), "a", roots), "b", roots).select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).filter("a <> b").distinct()
        upper = stored(components(links), "near-upper").toDF("_u", "_top")
        below = roots.join(upper, F.col("root") == F.col("_u"), "left").select("node", F.coalesce("_top", "root").alias("root"))
        alone = upper.join(roots, F.col("_u") == F.col("node"), "left_anti").select(F.col("_u").alias("node"), F.col("_top").alias("root"))
        return stored(below.unionByName(alone), "near-roots")

    nodes = own.select("node").limit(0)
    roots = merged(nodes.select("node", F.col("node").alias("root")), first)

    # Each class is held against one member of the largest component of its fullest bucket, another in each round.
    sizes = own.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    shares = own.join(sizes, "key").groupBy("node").agg(F.sum("n").alias("shared"))
    own = stored(own.join(shares, "node"), "near-own")
    for k in range(ROUNDS):
        known = stored(_rooted(own, roots), "near-known")
        middle = -F.col("shared") if k == 0 else F.lit(0)
        sizes = known.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(middle.alias("rank"), F.xxhash64("node", F.lit(k)).alias("h"), "node")).alias("m"))
        largest = stored(sizes.groupBy("key").agg(F.max(F.struct("n", "root", "m")).alias("x"), F.sum("n").alias("all")).filter("all > 1").select("key", F.col("x.root").alias("largest"), F.col("x.m").alias("m"), "all"), "near-largest")
        fullest = F.min(F.struct(*([F.col("m.rank")] if k == 0 else []), -F.col("all"), F.col("m.node").alias("node")))
        star = known.join(largest, "key").filter(F.col("root") != F.col("largest")).groupBy("node").agg(fullest.alias("x"))
        roots = merged(roots, star.select(F.least("node", "x.node").alias("a"), F.greatest("node", "x.node").alias("b")).distinct())

    # Then only pairs of different components, each once; of a bucket at most one end lies in its largest component.
    known = stored(_rooted(own, roots), "near-known")
    sizes = known.groupBy("key", "root").count()
    largest = sizes.groupBy("key").agg(F.max(F.struct("count", "root")).alias("m"), F.count(F.lit(1)).alias("roots"), F.sum("count").alias("all")).filter("roots > 1")
    open_ = stored(known.join(largest.select("key", F.col("m.root").alias("largest"), (F.col("all") > CROWD).alias("crowded")), "key").select("key", "band", "node", "root", "crowded", (F.col("root") != F.col("largest")).alias("out")), "near-open")
    share = stored(can_share(open_.filter("crowded").select("node").distinct()), "near-share")
    rows = open_.join(share, "node", "left").join(sketched, "node")
    rows = rows.filter(~F.col("crowded") | (F.col("live") >= least * F.col("n") - 1e-6))
    x, y = rows.filter("out").alias("x"), rows.alias("y")
    equal = lambda k, size: F.substring("x.sketch", k * size + 1, F.lit(size)) == F.substring("y.sketch", k * size + 1, F.lit(size))
    where = (F.col("x.key") == F.col("y.key")) & (F.col("x.root") != F.col("y.root")) & (~F.col("y.out") | (F.col("x.node") < F.col("y.node")))
    where = where & (~F.col("x.crowded") | (F.least("x.live", "y.live") >= least / (1 + least) * (F.col("x.n") + F.col("y.n")) - 1e-6))
    where = where & ~F.exists(F.sequence(F.lit(0), F.col("x.band")), lambda k: (k < F.col("x.band")) & equal(k, 4 * ROWS))
    where = where & (F.size(F.filter(F.sequence(F.lit(0), F.lit(ROWS * BANDS - 1)), lambda k: equal(k, 4))) >= enough(least))
    return merged(roots, x.join(y, where).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), True)


def enough(least: float) -> int:
    """How many min-hashes of a pair must be equal for it to go on."""
    return int((least - SLACK) * ROWS * BANDS)


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``WIDTH`` words."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    known = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    codes = np.fromiter((known[w] for w in words), dtype=np.uint64, count=len(words))
    factors = np.random.default_rng(WIDTH).integers(0, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    width = min(WIDTH, len(words))
    last = len(words) - width + 1
    total = np.full(last, width, dtype=np.uint64)
    for j in range(width):
        total += codes[j : j + last] * factors[j]
    total ^= total >> np.uint64(31)
    return np.unique(total)


def sketch(own: np.ndarray) -> bytes:
    """Min-hashes of a set of shingles, 32 bits each."""
    if not len(own):
        return bytes(4 * ROWS * BANDS)
    a, b = np.random.default_rng(BANDS).integers(0, 1 << 63, (2, ROWS * BANDS), dtype=np.uint64)
    a |= np.uint64(1)
    out = np.full(ROWS * BANDS, (1 << 64) - 1, dtype=np.uint64)
    for i in range(0, len(own), 1024):
        part = own[i : i + 1024, None] * a + b
        part ^= part >> np.uint64(32)
        part *= np.uint64(0x9E3779B97F4A7C15)
        out = np.minimum(out, part.min(axis=0))
    return (out >> np.uint64(32)).astype("<u4").tobytes()


def alike(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    """Whether the Jaccard similarity of two sets is ``least`` or more."""
    if not len(x) or not len(y):
        return len(x) == len(y)
    if min(len(x), len(y)) < least * max(len(x), len(y)) - 1e-9:
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common >= least * (len(x) + len(y) - common) - 1e-9


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, th, node (hash of the shingle set), sketch, fp (SimHash of the shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, out, fps = [], [], []
            for t in b.column(2).to_pylist():
                own = shingles(t)
                fps.append(simhash.fingerprint(t, WIDTH))
                nodes.append(xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63))
                out.append(sketch(own))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(nodes, pa.int64()), pa.array(out, pa.binary()), pa.array(fps, pa.int64())], ["doc_id", "th", "node", "sketch", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("th"), F.col("text").cast("binary")).mapInArrow(run, f"doc_id {kind}, th long, node long, sketch binary, fp long")


def bands(classes: DataFrame) -> DataFrame:
    """node, band, key: the band and its min-hashes in one hash."""
    size = 4 * ROWS
    keys = F.array(*(F.xxhash64(F.lit(k), F.substring("sketch", k * size + 1, size)) for k in range(BANDS)))
    return classes.select("node", F.posexplode(keys).alias("band", "key"))


def within_shingles(classes: DataFrame, texts: DataFrame, least: float) -> Callable[..., DataFrame]:
    """Keeps pairs a, b of nodes whose shingle sets are ``least`` alike; classes: node, sketch; texts: node, text; sifted pairs have sketches alike."""
    equal = enough(least)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in batches:
            x, y = (np.frombuffer(b"".join(p.column(k).to_pylist()), dtype="<u4").reshape(-1, ROWS * BANDS) for k in (2, 3))
            yield p.select([0, 1]).filter(pa.array((x == y).sum(axis=1) >= equal))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[int, tuple[int, np.ndarray]] = {}

        def of(side: int, node: int, text: pa.Scalar) -> np.ndarray:  # rows of one leader often follow each other
            if last.get(side, (None,))[0] != node:
                last[side] = node, shingles(text.as_py())
            return last[side][1]

        for p in batches:
            rows = zip(p.column(0).to_pylist(), p.column(1).to_pylist(), p.column(2), p.column(3), strict=True)
            yield p.select([0, 1]).filter(pa.array([alike(of(0, a, s), of(1, b, t), least) for a, b, s, t in rows], pa.bool_()))

    def verified(pairs: DataFrame, sifted: bool = False) -> DataFrame:
        at = lambda d, own, x, c: d.join(own.toDF(x, f"{c}_{x}"), x)
        some = pairs if sifted else at(at(pairs, classes, "a", "s"), classes, "b", "s").select("a", "b", "s_a", "s_b").mapInArrow(likely, "a long, b long")
        some = stored(some, "near-likely")
        return at(at(some, texts, "a", "t"), texts, "b", "t").select("a", "b", "t_a", "t_b").mapInArrow(exact, "a long, b long")

    return verified


def within_two_bits(classes: DataFrame) -> DataFrame:
    """Pairs a, b of nodes that link all nodes whose fingerprints lie within two bits; classes: node, fp."""
    fps = stored(classes.groupBy("fp").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("n")), "near-fps")
    of = lambda x: fps.select(F.col("fp").alias(x), F.col("node").alias(f"node_{x}"))
    far = simhash.links(fps.select("fp")).join(of("a"), "a").join(of("b"), "b").select("node_a", "node_b")
    same = classes.join(fps.filter("n > 1").select("fp", F.col("node").alias("node_b")), "fp").select(F.col("node").alias("node_a"), "node_b")
    return far.unionByName(same).filter("node_a <> node_b").select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def shareable(texts: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """For some nodes: node, n (shingles), live (those that another of these nodes has too); texts: node, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for node, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                own = shingles(t.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), node), pa.int64()), pa.array(own.view(np.int64))], ["node", "h"])

    def share(nodes: DataFrame) -> DataFrame:
        rows = stored(texts.join(nodes, "node").select("node", "text").mapInArrow(run, "node long, h long"), "near-shingles")
        lone = rows.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node")).filter("c = 1").groupBy("node").agg(F.count(F.lit(1)).alias("lone"))
        counts = nodes.join(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "node", "left").join(lone, "node", "left").na.fill(0, ["n", "lone"])
        return counts.select("node", "n", (F.col("n") - F.col("lone")).alias("live"))

    return share


def shingle_groups(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id, th, group: the smallest doc_id and text hash that texts ``least`` alike reach, as a struct."""
    own = stored(sketches(docs), "near-docs")
    classes = stored(own.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "th")).alias("first"), F.min("sketch").alias("sketch"), F.min("fp").alias("fp")), "near-classes")
    near = stored(within_two_bits(classes.select("node", "fp")), "near-simhash")
    keys = bands(classes)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    met = stored(keys.join(shared, "key"), "near-bands")
    ends = met.select("node").union(near.select("a")).union(near.select("b"))
    busy = stored(classes.join(ends.distinct(), "node"), "near-busy")
    names = busy.select("node", F.col("first.doc_id").alias("__id"), F.col("first.th").alias("__th"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("text")).join(names, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")))
    texts = stored(texts.select("node", "text").dropDuplicates(["node"]), "near-texts")
    sketched = busy.select("node", "sketch")
    roots = near_roots(met, sketched, within_shingles(sketched, texts, least), near, shareable(texts), least)
    known = classes.select("node", "first").join(roots.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    named = known.groupBy("root").agg(F.min("first").alias("group"))
    return own.select("doc_id", "th", "node").join(known.join(named, "root").select("node", "group"), "node").select("doc_id", "th", "group")


def one_of_each(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without near copies: the row with the smallest doc_id of each group stays, with all columns."""
    own = shingle_groups(docs, least)
    first = own.filter((F.col("doc_id").eqNullSafe(F.col("group.doc_id"))) & (F.col("th") == F.col("group.th"))).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).distinct()
    names, at, text = [f"c{i}" for i in range(len(docs.columns))], docs.columns.index("doc_id"), docs.columns.index("text")
    rows = docs.toDF(*names).withColumn("__h", F.xxhash64(names[text]))
    kept = rows.join(first, F.col(names[at]).eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__th")), "left_semi")
    return kept.dropDuplicates([names[at], "__h"]).select(*names).toDF(*docs.columns)
