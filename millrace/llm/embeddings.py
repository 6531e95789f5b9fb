"""Embedding near-duplicates: cluster shards, each compared in blocks with the vectors that ask it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Labels, connected_components, table
from millrace.session import staged

THRESHOLD = 0.95
SHARD_ROWS, MAX_CENTERS, MAX_SAMPLE = 1000, 1024, 16_384
BLOCK = 1 << 21  # cells of a task's products
AUDIT_EVERY = 50
QUERY_ROWS = 1 << 16  # of a table: so many vectors at most may ask a part in one task


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def matrix(column) -> np.ndarray:
    """Rows of equal length of a list column."""
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def centers(sample: np.ndarray, k: int, steps: int = 6, seed: int = 3) -> np.ndarray:
    """Spherical k-means on the sample; centres without rows stay where they are."""
    c = sample[np.random.default_rng(seed).choice(len(sample), k, replace=False)]
    for _ in range(steps):
        own = np.argmax(sample @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, sample)
        size = np.linalg.norm(sums, axis=1)
        c = np.where((size > 1e-9)[:, None], sums / np.maximum(size, 1e-9)[:, None], c)
    return c


def _distinct(vectors: DataFrame) -> DataFrame:
    """(node, vec, weight): distinct usable vectors in double precision and how many rows have them."""
    vec = F.col("embedding").cast("array<double>")
    usable = vec.isNotNull() & F.forall(vec, lambda v: v.isNotNull() & (F.abs(v) < float("inf"))) & F.exists(vec, lambda v: v != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), F.transform(vec, lambda v: v + 0.0).alias("vec")).where(usable)
    return rows.groupBy("vec").agg(F.count("*").alias("weight"), F.min("vec_id").alias("first")).select(
        F.monotonically_increasing_id().alias("node"), "vec", "weight", "first")


def links(nodes: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS, max_centers: int = MAX_CENTERS,
          max_sample: int = MAX_SAMPLE, query_rows: int = QUERY_ROWS) -> DataFrame:
    """What links among ``nodes`` (node, vec, weight; vectors of one length), as rows (kind, a, b).

    links: node a has b other rows within ``threshold``. edge: a and b are connected. audit: the exact number of
    links of an audited node. Sums and connections over all rows of a kind give the result; no pair is written out.

    Centres come from k-means on at most ``max_sample`` vectors on the driver, their first ones by hash, with at most
    ``max_centers`` centres; every vector is at home with its nearest one. A shard can hold a neighbour of a vector only
    if the plane between the two centres is within ``reach`` of it; all these shards are asked, whatever the directions
    in which neighbours lie. As that holds for both ends of a link, one of two shards asks the other, and what it finds
    counts for both. A shard of more than twice ``shard_rows`` is split by hash, and asked in all its parts; what asks
    is dealt out in blocks of about ``query_rows`` vectors of the table. A part compares all its rows with whatever
    asks it: at this size a product costs less than a search in a graph, and no group of near copies is out of reach.

    Every 50th vector also asks the shards that would ask it: this audit counts all its links by itself.
    """
    n = nodes.count()
    k = max(1, min(max_centers, n // shard_rows))
    picked = [r[0] for r in nodes.orderBy(F.xxhash64("node"), "node").limit(min(max_sample, 32 * k)).select("vec").collect()]
    if not picked:
        return nodes.sparkSession.createDataFrame([], "kind string, a long, b long")
    middle = centers(unit(np.array(picked)), min(k, len(picked)))
    spread = np.sqrt(np.maximum(2 - 2 * middle @ middle.T, 0))
    reach = np.sqrt(2 - 2 * threshold) + 1e-9

    def assign(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                rows = batch.slice(at, 2048)
                x = unit(matrix(rows.column("vec")))
                dots = x @ middle.T
                home, shard = np.argmax(dots, axis=1)[:, None], np.arange(len(middle))[None, :]
                near = np.take_along_axis(dots, home, axis=1) - dots <= reach * spread[home[:, 0]] + 1e-9
                near |= shard == home
                asks = near & ((shard == home) | (((shard + home) % 2 == 0) == (shard < home)))
                checked = near & (rows.column("node").to_numpy() % AUDIT_EVERY == 0)[:, None]
                asked = [pa.array([np.flatnonzero(r) for r in m], pa.list_(pa.int64())) for m in (asks, checked & ~asks)]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(home[:, 0]), *asked],
                                                 ["node", "vec", "weight", "home", "asks", "checks"])

    kind_of = nodes.schema["vec"].dataType.simpleString()
    schema = f"node long, vec {kind_of}, weight long, home long, asks array<long>, checks array<long>"
    dealt = staged(nodes.select("node", "vec", "weight").mapInArrow(assign, schema), "vectors-dealt")
    sizes = {r.home: r.n for r in dealt.groupBy("home").agg(F.count("*").alias("n")).collect()}
    parts = F.create_map(*[F.lit(v) for s, c in sizes.items() for v in (int(s), max(1, -(-c // (2 * shard_rows))))])
    blocks = -(-n // query_rows)
    upto = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long") - 1))
    members = dealt.select(F.col("home").alias("shard"), F.pmod(F.xxhash64("node"), parts[F.col("home")]).cast("long").alias("part"),
                           upto(F.lit(blocks)).alias("block"), "node", "vec", "weight")
    to = F.concat(F.transform("asks", lambda s: F.struct(s.alias("shard"), F.lit(True).alias("asks"))),
                  F.transform("checks", lambda s: F.struct(s.alias("shard"), F.lit(False).alias("asks"))))
    queries = dealt.select("node", "vec", "weight", "home", F.explode(to).alias("to")).where(parts[F.col("to.shard")].isNotNull()).select(
        F.col("to.shard").alias("q_shard"), upto(parts[F.col("to.shard")]).alias("q_part"),
        F.pmod(F.xxhash64("node", F.lit(1)), F.lit(blocks)).cast("long").alias("q_block"), F.col("node").alias("q_node"),
        F.col("vec").alias("q_vec"), F.col("weight").alias("q_weight"), F.col("to.asks").alias("q_asks"),
        (F.col("home") == F.col("to.shard")).alias("q_home"))

    def search(rows: pa.Table, asked: pa.Table) -> pa.Table:
        kinds, a, b = [], [], []

        def found(kind, left, right):
            kinds.extend([kind] * len(left))
            a.append(left)
            b.append(right)

        if rows.num_rows and asked.num_rows:
            node, weight, x = rows.column("node").to_numpy(), rows.column("weight").to_numpy(), unit(matrix(rows.column("vec")))
            ids, weights = asked.column("q_node").to_numpy(), asked.column("q_weight").to_numpy()
            asks, home = (asked.column(c).to_numpy(zero_copy_only=False) for c in ("q_asks", "q_home"))
            labels, step = Labels(np.concatenate([ids, node])), max(1, BLOCK // len(node))
            back = np.zeros(len(node), dtype=np.int64)  # links of the part's rows to vectors of other shards
            for at in range(0, len(ids), step):
                own, wanted, other = ids[at:at + step], asks[at:at + step], ~home[at:at + step]
                sims = unit(matrix(asked.column("q_vec").slice(at, step))) @ x.T
                i, j = np.nonzero(sims >= threshold)
                i, j = i[own[i] != node[j]], j[own[i] != node[j]]
                total = np.zeros(len(own), dtype=np.int64)
                np.add.at(total, i, weight[j])
                audited = own % AUDIT_EVERY == 0
                found("audit", own[audited], total[audited])
                some = wanted & (total > 0)
                found("links", own[some], total[some])
                i, j = i[wanted[i]], j[wanted[i]]
                if len(i):
                    labels.add(own[i], node[j])
                    np.add.at(back, j[other[i]], weights[at:at + step][i[other[i]]])
            found("links", node[back > 0], back[back > 0])
            found("edge", *labels.edges())
        flat = lambda v: np.concatenate(v).astype(np.int64) if v else np.array([], dtype=np.int64)
        return pa.table({"kind": pa.array(kinds, pa.string()), "a": flat(a), "b": flat(b)})

    return members.groupBy("shard", "part", "block").cogroup(queries.groupBy("q_shard", "q_part", "q_block")).applyInArrow(
        search, "kind string, a long, b long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept, audited_links), one per row of ``vectors`` (vec_id, embedding).

    Rows link when the cosine of their vectors, in double precision, reaches ``threshold``. n_links counts the other
    rows linked directly; component_id is the least vec_id reachable; kept marks the row that names its component.
    audited_links is the number of links of every 50th distinct vector as it finds them by itself, null elsewhere.
    ``options`` are those of ``links``.

    Null vectors, zero vectors and vectors with null or non-finite parts link with nothing and keep their own id, as
    do vectors of different length to each other. Equal vectors collapse before the search and count as links of each
    other. Rows with a null id take part but name no component; kept is false for them. Repeated rows are rows like
    others. An empty table gives an empty result. Other columns are ignored.
    """
    nodes = staged(_distinct(vectors), "vectors-distinct")
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    narrow = "array<float>" if single else "array<double>"  # as they travel; products are in double precision
    found = None
    for size in sorted(r[0] for r in nodes.select(F.size("vec")).distinct().collect()):
        same = nodes.where(F.size("vec") == size).select("node", F.col("vec").cast(narrow).alias("vec"), "weight")
        own = links(same, threshold, **options)
        found = own if found is None else found.unionByName(own)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "kind string, a long, b long")
    found = staged(found, "vectors-found")
    counts = found.where("kind <> 'edge'").groupBy(F.col("a").alias("node")).agg(
        F.sum(F.when(F.col("kind") == "links", F.col("b"))).alias("links"),
        F.sum(F.when(F.col("kind") == "audit", F.col("b"))).alias("audit"))
    linked = connected_components(found.where("kind = 'edge'").select("a", "b"), "vectors")
    named = nodes.select("node", "vec", "weight", "first").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    known = named.join(least, "component").join(counts, "node", "left").select(
        F.col("vec").alias("k_vec"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id",
        (F.col("audit") + F.col("weight") - 1).alias("audited_links"))
    known = staged(known, "vectors-known")
    vec = F.transform(F.col("embedding").cast("array<double>"), lambda v: v + 0.0)
    rows = vectors.select(F.col("vec_id").cast("long"), vec.alias("k_vec"))
    return rows.join(known, "k_vec", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"), "audited_links"
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def query(spark: SparkSession, root: str) -> DataFrame:
    return near_duplicates(table(spark, root, "embeddings")).drop("audited_links")


# All pairs: meant for the small tables that results are compared on.
SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, e, sqrt(list_sum([x * x FOR x IN e])) AS norm FROM v),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b),
linked AS (SELECT a, count(*) AS n FROM pairs GROUP BY a),
least_of AS (SELECT a, min(b) AS first FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least(vec_id, first), vec_id) AS component_id,
       coalesce(least(vec_id, first), vec_id) = vec_id AS kept
FROM u LEFT JOIN linked ON linked.a = vec_id LEFT JOIN least_of ON least_of.a = vec_id
"""
