"""SimHash near-duplicates: fingerprints in vantage-point trees, exact links within a Hamming distance.

Equal fingerprints collapse first.  The distinct ones are dealt to shards by a small vantage-point tree: a
node splits by the distance to its point, and a fingerprint also visits the other side where its
ball crosses the boundary, so every link lies whole in some shard.  A shard grows its own tree over what it
stores and sends all its points down together, pruned by the triangle bounds.  It returns a spanning forest
of its links, never all pairs; the forests are joined into components by Spark.

The dealing tree is built from a bounded sample of fingerprints and only steers the work: results do not
depend on it.  A tight ball of fingerprints cannot be halved for ever by distances, but it holds a bounded number
of different ones; its pairs are found by keys with one bit flipped, in linear time.

Defined results: texts without words (NULL too) have fingerprint zero and link like any other; a NULL doc_id gets its
component, but is never one; repeated rows get a row each.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import stored, table, texts_of
from stratalake.operators.joins import skew_join

SHINGLE_WORDS, DISTANCE = 3, 2
#: Fingerprints that the dealing tree is built from; fingerprints of a shard, about; of a leaf in a shard's tree.
SAMPLE, SHARD_POINTS, LEAF_POINTS = 8_192, 8_000, 48
#: Points of a leaf that distances don't split any more, above which flipped keys find the pairs.
TIGHT_LEAF = 512
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes | None, xxh64, words_each: int = SHINGLE_WORDS) -> int:
    words = (text or b"").translate(_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= words_each:
        return xxh64(joined, 42)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - words_each + 1].tolist()
    hashes = np.fromiter([xxh64(joined[a:b], 42) for a, b in zip(starts, ends[words_each - 1:].tolist())], ">u8", len(starts))
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        counts += np.unpackbits(hashes[k:k + 4096].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fp`` (64 bits as a bigint)."""

    def run(batches):
        import xxhash
        for batch in batches:
            found = np.fromiter((fingerprint(t, xxhash.xxh64_intdigest) for t in texts_of(batch)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp bigint")


def distance(points: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ point).astype(np.int64)


def split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that halve the points best; None if distances from the tried points don't split them."""
    best = None
    for at in (0, len(points) // 3, len(points) // 2, len(points) - 1):
        far = distance(points, points[at])
        radius = int(np.median(far))
        for r in {max(0, radius - 1), radius}:
            inside = int((far <= r).sum())
            crossing = int((np.abs(2 * far - 2 * r - 1) <= 2 * DISTANCE).sum())
            if 0 < inside < len(points):
                cost = max(inside, len(points) - inside) + crossing
                if best is None or cost < best[0]:
                    best = (cost, points[at], r)
    return best[1:] if best else None


def dealing_tree(sample: np.ndarray, shards: int):
    """Nested ``(point, radius, inside, outside)``; a leaf is a shard's number."""
    number = iter(range(1 << 30))

    def grow(points: np.ndarray, share: float):
        cut = split(points) if share > 1 and len(points) > 1 else None
        if cut is None:
            return next(number)
        point, radius = cut
        inside = distance(points, point) <= radius
        return (point, radius, grow(points[inside], share * inside.mean()), grow(points[~inside], share * (1 - inside.mean())))

    return grow(sample, float(shards))


def deal(points: np.ndarray, tree, reach: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each shard touched: its number, the indexes of the points, and whether the shard stores them (else they visit)."""
    out, stack = [], [(tree, np.arange(len(points)), np.ones(len(points), bool))]
    while stack:
        node, at, owns = stack.pop()
        if not len(at):
            continue
        if not isinstance(node, tuple):
            out.append((node, at, owns))
            continue
        point, radius, inside, outside = node
        far = distance(points[at], point)
        near, beyond = far - reach <= radius, far + reach > radius
        stack.append((inside, at[near], owns[near] & (far[near] <= radius)))
        stack.append((outside, at[beyond], owns[beyond] & (far[beyond] > radius)))
    return out


class Forest:
    """Union-find over points of a shard."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, pairs) -> None:
        for a, b in pairs:
            a, b = self.root(a), self.root(b)
            if a != b:
                self.parent[max(a, b)] = min(a, b)


def flipped_links(points: np.ndarray, at: np.ndarray, forest: Forest) -> None:
    """All links up to two bits among ``points[at]``: two points link if they share a value at most one bit from each."""
    order = at[np.argsort(points[at])]
    values = points[order]
    keys = np.concatenate([values, *(values ^ (np.uint64(1) << np.uint64(b)) for b in range(64))])
    owner = np.tile(order, 65)
    by = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[by][1:] == keys[by][:-1])
    forest.join(zip(owner[by][same].tolist(), owner[by][same + 1].tolist()))


def shard_links(points: np.ndarray, owned: np.ndarray, reach: int = DISTANCE) -> Forest:
    """Components of the links between an owned point and any other of a shard, by its vantage-point tree."""
    forest = Forest(len(points))
    stack = [(np.flatnonzero(owned), np.arange(len(points)))]
    while stack:
        held, asks = stack.pop()
        if not len(held) or not len(asks):
            continue
        cut = split(points[held]) if len(held) > LEAF_POINTS else None
        if cut is not None:
            point, radius = cut
            far, ask = distance(points[held], point), distance(points[asks], point)
            near, beyond = asks[ask - reach <= radius], asks[ask + reach > radius]
        # A tight ball: the bounds prune nothing, every point asks on both sides.
        if len(held) > TIGHT_LEAF and reach == 2 and (cut is None or len(near) + len(beyond) > 1.9 * len(asks)):
            flipped_links(points, np.union1d(held, asks), forest)
        elif cut is None:
            for k in range(0, len(held), 64):
                a, b = np.nonzero(np.bitwise_count(points[held[k:k + 64], None] ^ points[None, asks]) <= reach)
                forest.join(zip(held[k:k + 64][a].tolist(), asks[b].tolist()))
        else:
            stack += [(held[far <= radius], near), (held[far > radius], beyond)]
    return forest


def links(distinct: DataFrame, reach: int = DISTANCE) -> DataFrame:
    """``a, b``: a forest whose components are those of all links between the distinct ``fp``."""
    total = distinct.count()
    shards = max(1, -(-total // SHARD_POINTS))
    # A bounded sample, by hash; the tree only deals the work.
    sample = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(max(1, total // SAMPLE))) == 0).orderBy(F.xxhash64("fp")).limit(SAMPLE)
    points = np.sort(np.array([r["fp"] for r in sample.collect()], np.int64).view(np.uint64))
    tree = dealing_tree(points, shards) if len(points) else 0

    def send(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for shard, at, owns in deal(fps, tree, reach):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), shard, np.int32)), pa.array(fps[at].view(np.int64)), pa.array(owns)],
                                                 names=["shard", "fp", "owned"])

    def find(rows):
        fps = rows.column("fp").to_numpy().view(np.uint64)
        order = np.argsort(fps)
        fps, owned = fps[order], rows.column("owned").to_numpy(zero_copy_only=False)[order]
        forest = shard_links(fps, owned, reach)
        roots = np.array([forest.root(i) for i in range(len(fps))], np.int64)
        own = np.flatnonzero(roots != np.arange(len(fps)))
        return pa.table({"a": fps[own].view(np.int64), "b": fps[roots[own]].view(np.int64)})

    return (distinct.select("fp").mapInArrow(send, "shard int, fp bigint, owned boolean")
            .groupBy("shard").applyInArrow(find, "a bigint, b bigint"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of its component, for every other node of a component.

    Alternates large-star and small-star steps until nothing changes; each step's edges are written, so an
    executor lost later repeats one step at most.  Neighbours of a node meet only in sums (a minimum), so a hub is no hot group.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: larger neighbours of a node point to its least one.  Small star: so do the smaller ones and the node.
        large = skew_join(both.filter("b > a"), low, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = skew_join(large, least, ["a"]).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        after = stored(small.filter("a <> b").distinct())
        same = edges.count() == after.count() and edges.join(after, ["a", "b"], "left_anti").isEmpty()
        edges = after
        if same:
            return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")


def near_duplicates(docs: DataFrame, reach: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest doc_id reachable by links, for every document."""
    prints = stored(fingerprints(docs))
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = stored(components(links(distinct, reach)))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = skew_join(rooted.select("root", "fp"), ids, ["root"]).select("fp", "component_id")
    return skew_join(prints, named, ["fp"])


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
