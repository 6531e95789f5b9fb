"""Approximate vector search by a stored inverted file: coarse lists, residual product codes, exact re-ranking.

A coarse quantiser cuts the vectors into lists; a vector is kept as a few bytes, one per part of its residual to the
list's centre. A query looks into the lists nearest to it, adds up tabled distances of the bytes, and only its best
candidates are compared exactly. All vectors are of length one here, where the order of distances is that of cosines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.vectors import cosine_similarity, doubles, norm
from millrace.operators.search import KEY, best_places, top_k
from millrace.session import staged

SAMPLE_BYTES = 32 << 20  # of the vectors that both quantisers learn from, on the driver
MAX_LISTS = 4096
LIST_BLOCK = 65_536  # vectors of a list that one group holds; longer lists are several groups
QUERY_BLOCK = 1024  # queries that one group holds
PART = 4  # dimensions behind one byte
TRIES = 256  # sampled queries that choose the number of lists to look into and of candidates to compare exactly


@dataclass
class Quantizer:
    """Centres of the lists, code books of the parts, how many lists a query looks into, and how many candidates by code
    are compared exactly for each neighbour that is wanted."""

    centres: np.ndarray
    books: list[np.ndarray]
    probes: int
    rerank: float = 1.0

    @property
    def dim(self) -> int:
        return self.centres.shape[1]

    def cuts(self) -> list[slice]:
        ends = np.cumsum([0] + [b.shape[1] for b in self.books])
        return [slice(a, b) for a, b in zip(ends, ends[1:])]

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(list, code) of vectors of length one."""
        own = nearest(vectors, self.centres)
        rest = vectors - self.centres[own]
        return own, np.stack([nearest(rest[:, c], b) for c, b in zip(self.cuts(), self.books)], axis=1).astype(np.uint8)

    def tables(self, queries: np.ndarray, number: int) -> np.ndarray:
        """Squared distance of each part of each query's residual to every word of the part's book."""
        rest = queries - self.centres[number]
        out = np.full((len(queries), len(self.books), 256), np.inf, dtype=np.float32)
        for p, (c, b) in enumerate(zip(self.cuts(), self.books)):
            out[:, p, :len(b)] = distances(rest[:, c], b)
        return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0)


def nearest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a), dtype=np.int64)
    step = max(1, (4 << 20) // max(1, len(b)))
    for at in range(0, len(a), step):
        out[at:at + step] = distances(a[at:at + step], b).argmin(1)
    return out


def k_means(points: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centres of a bounded sample; a centre that loses all points moves to the point farthest from its own."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(points, centres)
        size = np.bincount(own, minlength=len(centres))
        for d in range(points.shape[1]):
            centres[:, d] = np.bincount(own, points[:, d], len(centres)) / np.maximum(size, 1)
        lost = np.flatnonzero(size == 0)
        if len(lost):
            apart = ((points - centres[own]) ** 2).sum(1)
            centres[lost] = points[np.argsort(-apart, kind="stable")[:len(lost)]]
    return centres


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (..., embedding as doubles) whose vector has a finite length above zero."""
    known = vectors.where("embedding IS NOT NULL").withColumn("embedding", doubles(F.col("embedding")))
    length = norm(F.col("embedding"))
    return known.where((length > 0) & (length < float("inf")))


def _units(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)
    return (flat / np.linalg.norm(flat, axis=1, keepdims=True)).astype(np.float32)


def code_ranks(quantizer: Quantizer, points: np.ndarray, own: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places that the points ``wanted`` of each of the first points take among the other points, by distance of codes."""
    code = quantizer.encode(points)[1]
    part = np.arange(code.shape[1])
    ranks = np.empty(wanted.shape, dtype=np.int64)
    members = [np.flatnonzero(own == number) for number in range(len(quantizer.centres))]
    far = np.empty((len(wanted), len(points)), dtype=np.float32)
    for number, rows in enumerate(members):
        for q, tables in enumerate(quantizer.tables(points[:len(wanted)], number) if len(rows) else ()):
            far[q, rows] = tables[part, code[rows]].sum(axis=1)
    for q, row in enumerate(far):
        row[q] = np.inf
        ranks[q] = np.searchsorted(np.sort(row), row[wanted[q]], side="right")
    return ranks


def train(vectors: DataFrame, lists: int | None = None, sample_bytes: int = SAMPLE_BYTES, target: float = 0.95,
          k: int = 10, seed: int = 7, code_target: float = 0.99) -> Quantizer:
    """Quantisers from a sample of ``vectors(document_id, chunk_index, embedding)``.

    The sample is drawn by a bound on the key's hash, computed from the count, so about ``sample_bytes`` reach the
    driver at any size. Sampled queries and their exact neighbours choose the number of lists to look into: the fewest
    that hold the share ``target`` of the neighbours. They choose the number of candidates as well: as many as have the
    share ``code_target`` of the neighbours among them, in the sample and, in proportion, in all vectors; the farther
    the nearest vectors are, the more others have codes as near. Vectors of one dimension are expected.
    """
    pool = usable(vectors).select(*KEY, "embedding")
    n, dim, low = pool.agg(F.count(F.lit(1)), F.max(F.size("embedding")), F.min(F.size("embedding"))).first()
    if not n:
        raise ValueError("there are no vectors to index")
    if dim != low:
        raise ValueError("all vectors must have one dimension")
    most = max(1, sample_bytes // (8 * dim))
    hashed = pool.withColumn("_h", F.xxhash64(*KEY))
    if n > most:
        hashed = hashed.where(F.col("_h") < F.lit(int(-(1 << 63) + (1 << 64) * (most / n))))
    held = hashed.select("_h", "embedding").toArrow().combine_chunks()
    order = np.argsort(np.asarray(held.column("_h")), kind="stable")
    points = _units(held.column("embedding").combine_chunks())[order]
    centres = k_means(points, lists or int(np.clip(np.sqrt(n), 1, min(MAX_LISTS, max(1, len(points) // 8)))), seed)
    own = nearest(points, centres)
    rest = points - centres[own]
    books = [k_means(rest[:, c], 256, seed + 1) for c in np.array_split(np.arange(dim), max(1, dim // PART))]
    asked = points[:TRIES]
    alike = asked @ points.T
    alike[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    wanted = np.argsort(-alike, axis=1)[:, :min(k, max(1, len(points) - 1))]
    rank = np.argsort(np.argsort(distances(asked, centres), axis=1, kind="stable"), axis=1)
    depth = np.sort(rank[np.arange(len(asked))[:, None], own[wanted]].ravel())
    probes = int(depth[min(len(depth) - 1, int(np.ceil(target * len(depth))) - 1)]) + 1
    found = Quantizer(centres, books, probes)
    places = np.sort(code_ranks(found, points, own, wanted).ravel())
    place = places[min(len(places) - 1, int(np.ceil(code_target * len(places))) - 1)]
    found.rerank = float(max(1.0, place * max(1.0, n / len(points)) / wanted.shape[1]))
    return found


@dataclass
class Index:
    """A stored inverted file: ``rows`` (list, document_id, chunk_index, code, embedding) and the sizes of the lists."""

    quantizer: Quantizer
    rows: DataFrame
    sizes: np.ndarray

    @property
    def blocks(self) -> np.ndarray:
        """Groups of each list."""
        return np.maximum(1, -(-self.sizes // LIST_BLOCK))


def build(vectors: DataFrame, quantizer: Quantizer) -> Index:
    """Writes the index of all usable vectors of the quantiser's dimension, in order of their lists."""
    pool = usable(vectors).select(*KEY, "embedding").where(F.size("embedding") == quantizer.dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own, code = quantizer.encode(_units(batch.column("embedding")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), *(batch.column(c) for c in KEY), pa.array([c.tobytes() for c in code], pa.binary()),
                     batch.column("embedding")], ["list", *KEY, "code", "embedding"])

    schema = T.StructType([T.StructField("list", T.IntegerType()), *(pool.schema[c] for c in KEY),
                           T.StructField("code", T.BinaryType()), pool.schema["embedding"]])
    coded = pool.mapInArrow(run, schema)
    rows = staged(coded.repartitionByRange("list", *KEY).sortWithinPartitions("list"), "ivf-index")
    sizes = np.zeros(len(quantizer.centres), dtype=np.int64)
    for number, n in rows.groupBy("list").count().collect():  # no more rows than lists
        sizes[number] = n
    return Index(quantizer, rows, sizes)


def candidates(index: Index, queries: DataFrame, keep: int, probes: int | None = None) -> DataFrame:
    """Rows (query_id, document_id, chunk_index, score, rank): the ``keep`` nearest by code of each query.

    Queries meet the lists they look into by an equi-join on (list, block of the list, block of the queries), so a
    group holds a bounded number of both sides however long a list is and however many queries want it.
    """
    quantizer, blocks, sizes = index.quantizer, index.blocks, index.sizes
    probes = min(probes or quantizer.probes, len(quantizer.centres))
    asked = usable(queries.select("query_id", "embedding"))
    n, dim, low = asked.agg(F.count(F.lit(1)), F.max(F.size("embedding")), F.min(F.size("embedding"))).first()
    if n and not dim == low == quantizer.dim:
        raise ValueError(f"queries must have {quantizer.dim} dimensions")
    parts = max(1, -(-n // QUERY_BLOCK))
    cell = ["list", "block", "part"]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _units(batch.column("embedding"))
            near = np.argsort(distances(vectors, quantizer.centres), axis=1, kind="stable")[:, :probes]
            query, number = np.repeat(np.arange(len(near)), near.shape[1]), near.ravel()
            query, number = query[sizes[number] > 0], number[sizes[number] > 0]
            times = blocks[number]
            block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            query, number = np.repeat(query, times), np.repeat(number, times)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int32()), pa.array(block, pa.int32()), batch.column("part").take(pa.array(query)),
                 batch.column("query_id").take(pa.array(query)), pa.array(list(vectors[query]), pa.list_(pa.float32()))],
                [*cell, "query_id", "unit"])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            which = place = np.zeros(0, dtype=np.int64)
            values = np.zeros(0)
        else:
            number = left.column("list")[0].as_py()
            units = np.asarray(left.column("unit").combine_chunks().flatten(), dtype=np.float32).reshape(left.num_rows, -1)
            code = np.frombuffer(b"".join(right.column("code").to_pylist()), dtype=np.uint8).reshape(right.num_rows, -1)
            found = []
            for q, tables in enumerate(quantizer.tables(units, number)):
                near = -tables[np.arange(code.shape[1]), code].sum(axis=1, dtype=np.float64)[None, :]
                place = best_places(near, keep)[1]
                found.append((np.full(len(place), q), place, near[0, place]))
            which, place, values = (np.concatenate(c) for c in zip(*found))
        return pa.Table.from_arrays(
            [left.column("query_id").take(pa.array(which, pa.int64())), *(right.column(c).take(pa.array(place, pa.int64())) for c in KEY),
             pa.array(values, pa.float64())], names=["query_id", *KEY, "score"])

    part = F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int").alias("part")
    kind = T.StructType([T.StructField("list", T.IntegerType()), T.StructField("block", T.IntegerType()),
                         T.StructField("part", T.IntegerType()), asked.schema["query_id"],
                         T.StructField("unit", T.ArrayType(T.FloatType()))])
    wanted = asked.select("query_id", "embedding", part).mapInArrow(probe, kind)
    # Blocks of a list come from a map of at most MAX_LISTS entries.
    of_list = F.try_element_at(F.lit([int(b) for b in blocks]), F.col("list") + 1)
    codes = index.rows.select(
        "list", F.pmod(F.xxhash64(*KEY), of_list).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), *KEY, "code")
    out = T.StructType([asked.schema["query_id"], *(index.rows.schema[c] for c in KEY), T.StructField("score", T.DoubleType())])
    return top_k(wanted.groupBy(*cell).cogroup(codes.groupBy(*cell)).applyInArrow(score, out), keep)


def reranked(index: Index, queries: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query's candidates by exact cosine."""
    pairs = found.select("query_id", *KEY).join(index.rows.select(*KEY, "embedding"), KEY)
    asked = queries.select("query_id", F.col("embedding").alias("_q"))
    exact = F.round(cosine_similarity(F.col("_q"), F.col("embedding")), 10)
    return top_k(pairs.join(asked, "query_id").select("query_id", *KEY, exact.alias("score")), k)


def search(index: Index, queries: DataFrame, k: int = 20, probes: int | None = None, rerank: int = 8) -> DataFrame:
    """Approximate cosine search of ``queries(query_id, embedding)``: (query_id, document_id, chunk_index, score, rank).

    Scores are exact; what may be missing are neighbours in lists that were not looked into, or beyond ``rerank * k``
    candidates by code, or as many more as training found to be needed. Null and zero vectors on either side match
    nothing.
    """
    return reranked(index, queries, candidates(index, queries, depth(index, k, rerank), probes), k)


def depth(index: Index, k: int, rerank: int = 8) -> int:
    """Candidates by code that are compared exactly for ``k`` neighbours."""
    return int(np.ceil(max(rerank, index.quantizer.rerank) * k))
