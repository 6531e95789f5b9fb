"""SimHash near-duplicates: exact pairs within a Hamming radius by vantage-point trees over sharded fingerprints."""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import connected_components, raw, slices, small_batches, table
from millrace.session import staged

SHINGLE, SEED, RADIUS = 3, 42, 3
LEAF_ROWS, MAX_SAMPLE, BLOCK = 1000, 1 << 18, 1 << 21


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles, repeats included; zero without words. Only A-Z are lower-cased."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined, hash_of = b" ".join(words), xxhash.xxh64_intdigest
        starts = [0, *accumulate(len(w) + 1 for w in words)]
        hashes = [hash_of(joined[s:e - 1], SEED) for s, e in zip(starts, starts[shingle:])]
    bytes_of = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(bytes_of), 1 << 15):
        counts += np.unpackbits(bytes_of[at:at + (1 << 15)], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, text_hash, fp): the fingerprint as a signed long, and a hash that tells texts of one id apart."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                fps = np.array([fingerprint(t, shingle) for t in raw(part.column("text"))], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(fps.view(np.int64))],
                    ["doc_id", "text_hash", "fp"])

    return small_batches(docs).select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id long, text_hash long, fp long")


class Tree:
    """A vantage-point tree over one half of the fingerprint's bits.

    Two fingerprints at most 3 bits apart differ by at most 1 in one of their halves, so a tree of each half with
    radius 1 finds every pair. Inner nodes hold a vantage point and a distance; what lies within the distance goes to
    the left. A query also enters the other side where the triangle bound can't exclude a neighbour there.
    """

    def __init__(self, sample: np.ndarray, shift: int, leaf: int):
        self.shift = np.uint64(shift)
        self.point, self.cut, self.left = [], [], []  # left child, or -1 at leaves; the right one follows it
        self._grow(self._half(sample), leaf)
        self.point = np.array(self.point, dtype=np.uint64)
        self.cut, self.left = np.array(self.cut, dtype=np.int64), np.array(self.left, dtype=np.int64)

    def _half(self, fps: np.ndarray) -> np.ndarray:
        return (fps >> self.shift) & np.uint64(0xFFFFFFFF)

    def _grow(self, halves: np.ndarray, leaf: int) -> None:
        todo = [(0, halves)]
        self._add()
        while todo:
            node, own = todo.pop()
            if len(own) <= leaf:
                continue
            best = None
            for v in own[:: max(1, len(own) // 8)][:8]:  # the vantage point that leaves the fewest at the boundary
                d = np.bitwise_count(own ^ v)
                for cut in {int(np.median(d)), int(np.median(d)) - 1}:
                    inside = int((d <= cut).sum())
                    if 0 < inside < len(own):
                        cost = (int((d <= cut + 1).sum()) ** 2 + int((d >= cut).sum()) ** 2)
                        if best is None or cost < best[0]:
                            best = (cost, v, cut)
            if best is None or best[0] >= 1.9 * len(own) ** 2:
                continue
            _, self.point[node], self.cut[node] = best
            self.left[node] = self._add()
            self._add()
            d = np.bitwise_count(own ^ best[1])
            todo += [(self.left[node], own[d <= best[2]]), (self.left[node] + 1, own[d > best[2]])]

    def _add(self) -> int:
        self.point.append(0)
        self.cut.append(0)
        self.left.append(-1)
        return len(self.left) - 1

    def visits(self, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, home) for every leaf that may hold a neighbour; home marks the one leaf the row belongs to."""
        halves = self._half(fps)
        row, node, home = np.arange(len(fps)), np.zeros(len(fps), dtype=np.int64), np.ones(len(fps), dtype=bool)
        out = []
        while len(row):
            at_leaf = self.left[node] < 0
            out.append((row[at_leaf], node[at_leaf], home[at_leaf]))
            row, node, home = row[~at_leaf], node[~at_leaf], home[~at_leaf]
            d = np.bitwise_count(halves[row] ^ self.point[node]).astype(np.int64)
            cut, left = self.cut[node], self.left[node]
            inside, goes_left, goes_right = d <= cut, d - radius <= cut, d + radius > cut
            row, node, home = (np.concatenate([row[goes_left], row[goes_right]]),
                               np.concatenate([left[goes_left], left[goes_right] + 1]),
                               np.concatenate([(home & inside)[goes_left], (home & ~inside)[goes_right]]))
        return tuple(np.concatenate(x) for x in zip(*out))


def forest(own: np.ndarray, others: np.ndarray, radius: int = RADIUS, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) that connect what the pairs (own, other) within the radius connect: one per member, never all pairs.

    Compares in blocks of at most ``block`` cells and folds each block into a label per fingerprint.
    """
    everyone = np.unique(np.concatenate([own, others]))
    label, place = np.arange(len(everyone)), np.searchsorted(everyone, others)
    own_place, step = np.searchsorted(everyone, own), max(1, block // max(1, len(others)))
    for at in range(0, len(own), step):
        i, j = np.nonzero(np.bitwise_count(own[at:at + step, None] ^ others[None, :]) <= radius)
        i, j = own_place[at + i], place[j]
        i, j = i[i != j], j[i != j]
        while True:
            a, b = label[i], label[j]
            if (a == b).all():
                break
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label != label[label]).any():
                label = label[label]
    moved = label != np.arange(len(everyone))
    return everyone[moved], everyone[label[moved]]


def link(fps: DataFrame, radius: int = RADIUS, leaf_rows: int = LEAF_ROWS, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """Rows (node, component) for the distinct fingerprints (fp) that have another one within ``radius`` bits.

    The trees are grown on the driver from a sample of at most ``max_sample`` fingerprints (8 bytes each), their first
    ones by hash; every fingerprint then enters its home leaf and the leaves that the triangle bound can't exclude.
    A leaf's home rows go in salted blocks where a leaf is large, so a task holds a bounded share of them. Distinct
    fingerprints within 3 bits of one number at most 43,745, so no group of copies makes a leaf grow without end.
    """
    if radius != RADIUS:
        raise ValueError("halves and their radius of 1 are made for 3 bits")
    total = fps.count()
    # Eight sampled fingerprints stand for one leaf.
    size = min(max_sample, max(64, 8 * total // leaf_rows))
    picked = [r[0] for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(size).collect()]
    sample = np.array(picked, dtype=np.int64).view(np.uint64)
    trees = [Tree(sample, shift, 8) for shift in (32, 0)]
    salts = max(1, -(-8 * total // (max(1, len(picked)) * 4 * leaf_rows)))

    def scatter(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                own = batch.column("fp").slice(at, 4096).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                for k, tree in enumerate(trees):
                    row, leaf, home = tree.visits(own, 1)
                    fp = own[row]
                    salt = (fp * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(salts)
                    if salts > 1:  # visitors meet every block of home rows, home rows are in one block as such
                        copies = np.tile(np.arange(salts, dtype=np.uint64), len(fp))
                        fp, leaf, home, salt = (np.repeat(x, salts) for x in (fp, leaf, home, salt))
                        home, salt = home & (salt == copies), copies
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(fp), k)), pa.array(leaf), pa.array(salt.astype(np.int64)),
                         pa.array(fp.view(np.int64)), pa.array(home)], ["tree", "leaf", "salt", "fp", "home"])

    def within(group: pa.Table) -> pa.Table:
        fp, home = group.column("fp").to_numpy().view(np.uint64), group.column("home").to_numpy()
        a, b = forest(fp[home], fp)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    visits = fps.select("fp").mapInArrow(scatter, "tree long, leaf long, salt long, fp long, home boolean")
    edges = visits.groupBy("tree", "leaf", "salt").applyInArrow(within, "a long, b long")
    return connected_components(edges, "simhash")


def classes(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, fp), one per document, and the class of each fingerprint (fp, component)."""
    rows = staged(fingerprints(docs, shingle), "simhash-rows")
    distinct = staged(rows.select("fp").distinct(), "simhash-distinct")
    linked = staged(link(distinct, radius), "simhash-linked")
    return rows, distinct.join(linked, distinct.fp == linked.node, "left").select(
        "fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one per row of ``docs`` (doc_id, text).

    Documents link when their fingerprints differ in at most ``radius`` bits; component_id is the least doc_id that
    links reach. Null, empty and white-space texts have the fingerprint zero and link like any other. Rows with a null
    id get a component like others but never name one; the component of a group without any id is null. Repeated rows
    and ids give a row each. An empty table gives an empty result. Other columns are ignored.

    Texts are read once and never shuffled; equal fingerprints collapse before any comparison.
    """
    rows, of_fp = classes(docs, shingle, radius)
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = first.join(of_fp, "fp")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = staged(named.join(least, "component").select("fp", "component_id"), "simhash-classes")
    return rows.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay when each group of linked documents keeps one: that with the least id.

    Rows without an id come last; of several texts with that id the one with the least hash stays, and of rows that
    repeat both, one.
    """
    rows, of_fp = classes(docs, shingle, radius)
    per_fp = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("best"))
    kept = per_fp.join(of_fp, "fp").groupBy("component").agg(F.min("best").alias("best"))
    kept = staged(kept.select(F.col("best.doc_id").alias("__id"), F.col("best.text_hash").alias("__kept")), "simhash-kept")
    hashed = docs.withColumn("__hash", F.xxhash64("text"))
    same = hashed.doc_id.eqNullSafe(kept["__id"]) & (hashed["__hash"] == kept["__kept"])
    return hashed.join(kept, same, "left_semi").dropDuplicates(["doc_id", "__hash"]).drop("__hash")


def query(spark: SparkSession, root: str) -> DataFrame:
    return near_duplicates(table(spark, root, "documents"))
