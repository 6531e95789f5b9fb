"""Keyword, vector and fused retrieval for tables of queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import jaccard, terms, tokens

KEY = ["document_id", "chunk_index"]
BM25_K1 = 1.2
BM25_B = 0.75
RRF_K = 60

# Query vectors up to this many bytes are sent to every task; larger sets use the grid.
BROADCAST_BYTES = 32 << 20
GRID_QUERIES = 2048
GRID_VECTORS = 16384


def restrict(chunks: DataFrame, tenant: str | None = None, doc_types: list[str] | None = None) -> DataFrame:
    """Optional tenant and type predicates, applied before any scoring."""
    out = chunks
    if tenant is not None:
        out = out.where(F.col("tenant_id") == F.lit(tenant))
    if doc_types:
        out = out.where(F.col("doc_type").isin(list(doc_types)))
    return out


def top_k(scored: DataFrame, k: int, score: str = "score", by: str = "query_id",
          keys: list[str] = KEY, rank: str = "rank") -> DataFrame:
    """Best ``k`` per query with a total order; Spark prunes to ``k`` per task before the shuffle."""
    w = W.partitionBy(by).orderBy(F.desc(score), *keys)
    return scored.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


# A run of one token in a sorted, space-terminated token text.
_RUN = r"(\S+ )\1*"


def build_postings(chunks: DataFrame, text: str = "content") -> DataFrame:
    """Rows ``(document_id, chunk_index, term, tf, length, leads)``, made inside each row without a shuffle.

    In the sorted tokens of a chunk equal ones are neighbours, so each run is one posting and its
    size gives the count.  ``leads`` marks one row per chunk, so that chunks and tokens can be counted
    without grouping.  Store the result to search it more than once.
    """
    ordered = F.sort_array(tokens(F.col(text)))
    runs = F.regexp_extract_all(F.concat(F.array_join("_tokens", " "), F.lit(" ")), F.lit(_RUN), F.lit(0))
    term = F.substring_index("_run", " ", 1)
    tf = (F.octet_length("_run") / (F.octet_length("term") + 1)).cast("int")
    return (chunks.select(*KEY, ordered.alias("_tokens"))
            .select(*KEY, F.size("_tokens").alias("length"), F.posexplode(runs).alias("_at", "_run"))
            .select(*KEY, term.alias("term"), "_run", "length", (F.col("_at") == 0).alias("leads"))
            .select(*KEY, "term", tf.alias("tf"), "length", "leads"))


def search_texts(queries: DataFrame, chunks: DataFrame, k: int = 20, match: str = "all", ranking: str = "bm25",
                 stems: bool = False) -> DataFrame:
    """Keyword search of the chunks' texts, without an index: one pass keeps the words that the queries ask for.

    ``ranking`` is ``"bm25"``, or ``"density"``, which always needs every query term.
    """
    from millrace.operators import lexical

    if ranking == "density":
        return lexical.search_density(queries, chunks, k, stems=stems)
    return lexical.search_bm25(queries, chunks, k, match, stems=stems)


def query_terms(queries: DataFrame, text: str = "query_text") -> DataFrame:
    """Distinct terms per query with their number; a query of stop words only has none."""
    found = terms(F.col(text))
    return (queries.select("query_id", found.alias("_t"))
            .select("query_id", F.size("_t").alias("n_terms"), F.explode("_t").alias("term")))


def keyword_search(queries: DataFrame, postings: DataFrame, k: int = 20, match: str = "all") -> DataFrame:
    """BM25 over postings; ``match="all"`` needs every query term, ``"any"`` at least one.

    Matching all terms starts from each query's rarest term, so only chunks holding that term are ever
    scored.  Document frequencies come from a map-side combined count over the query terms only.
    """
    wanted = query_terms(queries)
    vocabulary = wanted.select("term").distinct()
    # Corpus size and mean length enter as a scalar subquery.
    size = F.count_if("leads").cast("double")
    corpus = postings.agg(F.struct(size.alias("n"), (F.sum("tf") / size).alias("mean")).alias("c")).scalar()
    n, mean = corpus["n"], corpus["mean"]
    relevant = postings.join(vocabulary, "term", "left_semi")
    df = relevant.groupBy("term").agg(F.count(F.lit(1)).cast("double").alias("df"))
    weighted = wanted.join(df, "term").withColumn(
        "idf", F.log(F.lit(1.0) + (n - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    if match == "all":
        # A query with a term that no chunk has cannot match.
        known = W.partitionBy("query_id")
        weighted = (weighted.withColumn("_known", F.count(F.lit(1)).over(known))
                    .where("_known = n_terms").drop("_known"))
        rarest = (weighted.withColumn("_r", F.row_number().over(known.orderBy("df", "term")))
                  .where("_r = 1").select("query_id", "term"))
        candidates = postings.join(rarest, "term").select("query_id", *KEY)
        pairs = postings.join(candidates.join(weighted, "query_id"), [*KEY, "term"])
    else:
        pairs = postings.join(weighted, "term")
    tf, length = F.col("tf").cast("double"), F.col("length").cast("double")
    gain = F.col("idf") * tf * F.lit(BM25_K1 + 1) / (
        tf + F.lit(BM25_K1) * (F.lit(1 - BM25_B) + F.lit(BM25_B) * length / mean))
    scored = pairs.withColumn("_gain", gain).groupBy("query_id", *KEY).agg(
        F.sum("_gain").alias("score"), F.count(F.lit(1)).alias("matched"), F.first("n_terms").alias("n_terms"))
    if match == "all":
        scored = scored.where("matched = n_terms")
    # Scores are compared at 9 digits, so that the order of summation never decides a rank.
    scored = scored.withColumn("score", F.round("score", 9))
    return top_k(scored.select("query_id", *KEY, "score"), k)


def _normalised(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = np.asarray(flat.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    matrix = values.reshape(len(flat), -1) if len(flat) else values.reshape(0, 1)
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.full_like(matrix, np.nan), where=length > 0)


def best_places(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column positions of every score that may be among its row's best ``k``, ties included."""
    m = scores.shape[1]
    valid = np.where(np.isnan(scores), -np.inf, scores)
    if m > k:
        # Everything not clearly below the k-th value stays, so that rounding cannot lose a tie.
        cut = np.partition(valid, m - k, axis=1)[:, m - k][:, None] - 1e-9
    else:
        cut = np.full((scores.shape[0], 1), -np.inf)
    return np.nonzero((valid >= cut) & ~np.isnan(scores))


_SCORED = "query_id {q}, document_id {d}, chunk_index {c}, score double"


def _scored_schema(queries: DataFrame, chunks: DataFrame) -> str:
    kind = dict(queries.dtypes) | {}
    types = dict(chunks.dtypes)
    return _SCORED.format(q=kind["query_id"], d=types["document_id"], c=types["chunk_index"])


def vector_search(queries: DataFrame, chunks: DataFrame, k: int = 20, tenant: str | None = None,
                  doc_types: list[str] | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Exact cosine search of ``queries(query_id, embedding)`` in ``chunks(..., embedding)``.

    Each task scores its vectors against all queries as one matrix product and keeps the best
    ``k`` per query, so only ``k`` rows per query and batch are shuffled.  The query matrix is sent
    to the tasks when its size is within ``broadcast_bytes``; beyond that a grid of bounded query
    and vector blocks is used, with the same result.
    Vectors whose dimension differs from the query's cannot match and are rejected.
    """
    pool = restrict(chunks, tenant, doc_types).select(*KEY, "embedding").where("embedding IS NOT NULL")
    asked = queries.select("query_id", "embedding").where("embedding IS NOT NULL")
    shape = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dim"),
                      F.min(F.size("embedding")).alias("low")).first()
    schema = _scored_schema(queries, chunks)
    if not shape["n"]:
        return queries.sparkSession.createDataFrame([], schema + ", rank int")
    if shape["dim"] != shape["low"]:
        raise ValueError("all query vectors must have one dimension")
    pool = pool.where(F.size("embedding") == shape["dim"])
    if shape["n"] * shape["dim"] * 8 <= broadcast_bytes:
        scored = _scan_with_queries(asked, pool, k, schema)
    else:
        scored = _grid(asked, pool, k, schema, shape["n"])
    return top_k(scored.withColumn("score", F.round("score", 10)), k)


def _scan_with_queries(asked: DataFrame, pool: DataFrame, k: int, schema: str) -> DataFrame:
    held = asked.toArrow()
    shared = asked.sparkSession.sparkContext.broadcast(
        (held.column("query_id").to_pylist(), _normalised(held.column("embedding"))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = matrix @ _normalised(batch.column("embedding")).T
            rows, cols = best_places(scores, k)
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[r] for r in rows], type=held.schema.field("query_id").type),
                batch.column("document_id").take(pa.array(cols)),
                batch.column("chunk_index").take(pa.array(cols)),
                pa.array(scores[rows, cols], type=pa.float64())],
                names=["query_id", "document_id", "chunk_index", "score"])

    return pool.mapInArrow(score, schema)


def _grid(asked: DataFrame, pool: DataFrame, k: int, schema: str, n_queries: int) -> DataFrame:
    """Query blocks times vector blocks; every cell holds a bounded number of both."""
    q_blocks = -(-n_queries // GRID_QUERIES)
    v_blocks = max(1, -(-pool.count() // GRID_VECTORS))
    q = (asked.withColumn("_qb", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int"))
         .withColumn("_vb", F.explode(F.sequence(F.lit(0), F.lit(v_blocks - 1)))))
    v = (pool.withColumn("_vb", F.pmod(F.xxhash64(*KEY), F.lit(v_blocks)).cast("int"))
         .withColumn("_qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "document_id", "chunk_index", "score"]
        scores = (_normalised(left.column("embedding")) @ _normalised(right.column("embedding")).T
                  if left.num_rows and right.num_rows else np.zeros((0, 0)))
        rows, cols = best_places(scores, k) if scores.size else (np.array([], int), np.array([], int))
        return pa.Table.from_arrays([
            left.column("query_id").take(pa.array(rows, type=pa.int64())),
            right.column("document_id").take(pa.array(cols, type=pa.int64())),
            right.column("chunk_index").take(pa.array(cols, type=pa.int64())),
            pa.array(scores[rows, cols] if scores.size else [], type=pa.float64())], names=names)

    return (q.groupBy("_qb", "_vb").cogroup(v.groupBy("_qb", "_vb")).applyInArrow(cell, schema))


def approximate_search(queries: DataFrame, chunks: DataFrame, k: int = 20) -> DataFrame:
    """Approximate cosine search through an inverted file that is built and stored for this search.

    Keep ``ivf.build`` and use ``ivf.search`` to search more than once.
    """
    from millrace.operators import ivf

    return ivf.search(ivf.build(chunks, ivf.train(chunks, k=k)), queries, k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact neighbours that an approximate search found, per query."""
    hit = found.select("query_id", *KEY).withColumn("_hit", F.lit(1))
    return (exact.select("query_id", *KEY).join(hit, ["query_id", *KEY], "left")
            .groupBy("query_id").agg(F.avg(F.coalesce("_hit", F.lit(0)).cast("double")).alias("recall")))


def candidate_union(lists: list[DataFrame]) -> DataFrame:
    """Keys of several ranked lists, each once, with the first list and rank that had it."""
    rows = None
    for i, ranked in enumerate(lists):
        part = ranked.select("query_id", *KEY, F.lit(i).alias("source_list"), F.col("rank"))
        rows = part if rows is None else rows.unionByName(part)
    return (rows.groupBy("query_id", *KEY)
            .agg(F.min(F.struct("source_list", "rank")).alias("f"))
            .select("query_id", *KEY, F.col("f.source_list").alias("source_list"), F.col("f.rank").alias("rank")))


def fusion_ranks(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both ranks of each key side by side, null where a list does not have it."""
    a = first.select("query_id", *KEY, F.col("rank").alias("first_rank"))
    b = second.select("query_id", *KEY, F.col("rank").alias("second_rank"))
    return a.join(b, ["query_id", *KEY], "full_outer")


def rrf(lists: list[DataFrame], k: int = RRF_K, weights: list[float] | None = None,
        top: int | None = None) -> DataFrame:
    """Reciprocal-rank fusion: the sum of ``weight / (k + rank)`` over the lists that have the key.

    Ties keep the order of the first list that has the key, then its rank.
    """
    weights = weights or [1.0 / len(lists)] * len(lists)
    rows = None
    for i, (ranked, w) in enumerate(zip(lists, weights)):
        part = ranked.select("query_id", *KEY, (F.lit(float(w)) / (F.lit(float(k)) + F.col("rank"))).alias("_w"),
                             F.struct(F.lit(i).alias("i"), F.col("rank").alias("r")).alias("_seen"))
        rows = part if rows is None else rows.unionByName(part)
    fused = rows.groupBy("query_id", *KEY).agg(F.round(F.sum("_w"), 12).alias("score"), F.min("_seen").alias("_seen"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "_seen.i", "_seen.r", *KEY)
    ranked = fused.withColumn("rank", F.row_number().over(order)).drop("_seen")
    return ranked if top is None else ranked.where(F.col("rank") <= top)


def hybrid_search(queries: DataFrame, chunks: DataFrame, postings: DataFrame | None = None, k: int = 10,
                  tenant: str | None = None, doc_types: list[str] | None = None, match: str = "all",
                  candidates: int = 20, weights: list[float] | None = None, ranking: str = "bm25",
                  stems: bool = False) -> DataFrame:
    """Keyword and vector candidates fused; ``queries`` has ``query_id, query_text, embedding``.

    Only keys, ranks and scores are carried; join contents to the result afterwards.
    """
    pool = restrict(chunks, tenant, doc_types)
    if postings is None:
        words = search_texts(queries, pool, candidates, match, ranking, stems)
    else:
        if tenant is not None or doc_types:
            postings = postings.join(pool.select(*KEY), KEY, "left_semi")
        words = keyword_search(queries, postings, candidates, match)
    near = vector_search(queries, pool, candidates)
    return rrf([words, near], weights=weights, top=k)


def token_overlap(query: Column, content: Column) -> Column:
    """Default pair score: shared over all distinct tokens."""
    return F.coalesce(jaccard(F.array_distinct(tokens(query)), F.array_distinct(tokens(content))), F.lit(0.0))


PairScorer = Callable[[list[tuple[str, str]]], list[float]]


def model_score(load: Callable[[], PairScorer]):
    """A supplied pair model as a column function; ``load`` runs once per worker."""
    @F.pandas_udf(T.DoubleType())
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = load()
        for query, content in parts:
            yield pd.Series(model(list(zip(query.fillna(""), content.fillna("")))), dtype="float64")

    return run


def rerank(candidates: DataFrame, scorer=token_overlap, k: int = 5) -> DataFrame:
    """Scores ``(query_text, content)`` pairs of the candidates jointly and keeps the best ``k``."""
    scored = candidates.withColumn("rerank_score", scorer(F.col("query_text"), F.col("content")))
    return top_k(scored, k, score="rerank_score", rank="rerank_rank")


def with_contents(results: DataFrame, chunks: DataFrame, queries: DataFrame) -> DataFrame:
    """Contents and query texts joined to the few result rows."""
    return results.join(chunks, KEY).join(queries.select("query_id", "query_text"), "query_id")


def troubleshoot_search(codes: DataFrame, chunks: DataFrame, tenant: str | None = None, k: int = 10,
                        top: int = 3) -> DataFrame:
    """Manual passages for a table of error codes; a code without any gets a not-found row."""
    context = F.coalesce(F.col("device_context"), F.lit("")) if "device_context" in codes.columns else F.lit("")
    text = F.trim(F.concat(F.lit("error code "), "error_code", F.lit(" troubleshooting "), context))
    queries = codes.select(F.col("error_code").alias("query_id"), text.alias("query_text"))
    pool = restrict(chunks, tenant, ["manual"])
    words = search_texts(queries, pool, k, match="any")
    # A passage must name the code itself.
    named = F.array_contains(tokens(F.col("content")), F.lower("query_id"))
    best = rerank(with_contents(words, pool, queries).where(named), k=top)
    out = best.select(F.col("query_id").alias("error_code"), *KEY, "title", "rerank_score", "rerank_rank")
    return (codes.select("error_code").join(out, "error_code", "left")
            .withColumn("found", F.col("document_id").isNotNull()))


def articles_per_code(codes: DataFrame, chunks: DataFrame, k: int = 3) -> DataFrame:
    """Chunks that contain a code as a token, the ``k`` shortest per code first."""
    wanted = codes.select("error_code", F.lower("error_code").alias("term"))
    hits = build_postings(chunks).join(wanted, "term").withColumn("density", F.col("tf").cast("double") / F.col("length"))
    return top_k(hits.select("error_code", *KEY, "density"), k, score="density", by="error_code")


def freshness_boost(results: DataFrame, asof: str, days: int = 7, factor: float = 1.2) -> DataFrame:
    age = F.datediff(F.lit(asof).cast("date"), F.col("last_updated"))
    return results.withColumn("boosted_score", F.col("score") * F.when(age <= days, factor).otherwise(1.0))


def latest_versions(docs: DataFrame, key: str = "source_path", tie: list[str] = ()) -> DataFrame:
    """Newest version per source; versions compare part by part as numbers."""
    order = F.transform(F.split("version", r"\."), lambda p: p.try_cast("int"))
    w = W.partitionBy(key).orderBy(F.desc("_order"), F.desc("last_updated"), *tie)
    return (docs.withColumn("_order", order).withColumn("_r", F.row_number().over(w))
            .where("_r = 1").drop("_r", "_order"))
