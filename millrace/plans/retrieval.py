"""Document queries: identity, chunks, keyword, vector and fused search, contexts, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import STOP_WORDS, TOKEN, tokens
from millrace.operators import context, corpus, evaluate, ivf, lexical, search, upsert
from millrace.plans.base import CHUNKS, CORPUS, day, query, rounded, with_
from millrace.session import scratch_dir, staged
from millrace.sources import tables
from millrace.sources.documents import read_documents

C_ = with_(CORPUS)
CH_ = with_(CORPUS, CHUNKS)


def docs(spark, root):
    return tables.corpus(spark, root)


def window_chunks(spark, root):
    """Fixed-window chunks keyed by the stored document number."""
    return corpus.chunk_windows(docs(spark, root).withColumnRenamed("doc_id", "document_id"))


@query("documents_source", "S8 S9", C_ + f"""
SELECT doc_id, tenant_id, doc_type, title, source_path, version, {day('last_updated')} AS last_updated,
       length(content) AS chars FROM corpus""")
def _(spark, root):
    return docs(spark, root).select("doc_id", "tenant_id", "doc_type", "title", "source_path", "version",
                                    "last_updated", F.length("content").alias("chars"))


@query("document_identity", "X6 U9", C_ + """
SELECT doc_id, substring(sha256(source_path || ':' || version), 1, 16) AS document_id, sha256(content) AS file_hash,
       length(content) AS total_chars, strlen(content) AS total_size_bytes FROM corpus""")
def _(spark, root):
    return corpus.with_identity(docs(spark, root)).select(
        "doc_id", "document_id", "file_hash", "total_chars", "total_size_bytes")


@query("unique_documents", "U9", C_ + "SELECT min(doc_id) AS doc_id, sha256(content) AS file_hash FROM corpus GROUP BY 2")
def _(spark, root):
    return corpus.unique_documents(docs(spark, root), "doc_id").select("doc_id", "file_hash")


@query("unique_documents_per_tenant", "U9", C_ + """
SELECT min(doc_id) AS doc_id, tenant_id, sha256(content) AS file_hash FROM corpus GROUP BY 2, 3""")
def _(spark, root):
    return corpus.unique_documents(docs(spark, root), "doc_id", per_tenant=True).select("doc_id", "tenant_id", "file_hash")


@query("unseen_documents", "J4 R13", C_ + """
SELECT doc_id FROM corpus c WHERE NOT EXISTS (
  SELECT 1 FROM corpus s WHERE s.doc_type = 'runbook' AND sha256(s.content) = sha256(c.content))""")
def _(spark, root):
    d = corpus.with_identity(docs(spark, root))
    return corpus.unseen(d, d.where("doc_type = 'runbook'")).select("doc_id")


@query("window_chunks", "R1", CH_ + """
SELECT document_id, chunk_index, length(content) AS chunk_size, sha256(content) AS content_hash FROM chunks""")
def _(spark, root):
    return window_chunks(spark, root).select(
        "document_id", "chunk_index", "chunk_size", F.sha2("content", 256).alias("content_hash"))


@query("recursive_chunks", "R1 UD3", C_ + """
SELECT doc_id, true AS within_size, true AS in_text, true AS dense, 0 AS words_lost FROM corpus WHERE content <> ''""")
def _(spark, root):
    # What SQL can state of each document's chunks; the chunks themselves are compared in the tests.
    d = docs(spark, root)
    pieces = corpus.chunk_recursive(d.select("doc_id", "content")).groupBy("doc_id").agg(
        (F.max("chunk_size") <= corpus.CHUNK_SIZE).alias("within_size"),
        (F.max("chunk_index") + 1 == F.count_distinct("chunk_index")).alias("dense"),
        F.collect_list("content").alias("pieces"))
    # One comparison with the text per document.
    words = F.array_except(tokens(F.col("content")), tokens(F.array_join("pieces", " ")))
    return pieces.join(d.select("doc_id", "content"), "doc_id").select(
        "doc_id", "within_size", F.forall("pieces", lambda c: F.contains(F.col("content"), c)).alias("in_text"), "dense",
        F.size(words).cast("long").alias("words_lost"))


@query("corpus_stats", "A19", CH_ + """
SELECT count(DISTINCT document_id) AS documents, count(*) AS chunks,
       CAST(floor(avg(length(content))) AS BIGINT) AS avg_chunk_size, count(DISTINCT tenant_id) AS tenants FROM chunks""")
def _(spark, root):
    return corpus.corpus_stats(window_chunks(spark, root))


@query("embedded_chunks", "R2", CH_ + f"""
, cells AS (
  SELECT document_id, chunk_index, CAST('0x' || substr(sha256(term), 1, 8) AS BIGINT) % 64 AS cell, count(*) AS n
  FROM (SELECT document_id, chunk_index, unnest(regexp_extract_all(lower(content), '{TOKEN}')) AS term FROM chunks) t GROUP BY 1, 2, 3),
parts AS (SELECT *, CAST(n / sqrt(sum(n * n) OVER (PARTITION BY document_id, chunk_index)) AS FLOAT) AS part FROM cells),
sums AS (SELECT document_id, chunk_index, sum(CAST(part AS DOUBLE)) AS total, sum(CAST(part AS DOUBLE) * (cell + 1)) AS first_moment,
                sum(CAST(part AS DOUBLE) * (cell + 1) * (cell + 1)) AS second_moment FROM parts GROUP BY 1, 2)
SELECT document_id, chunk_index, 64 AS dim, round(coalesce(total, 0), 6) AS total, round(coalesce(first_moment, 0), 4) AS first_moment,
       round(coalesce(second_moment, 0), 2) AS second_moment
FROM chunks LEFT JOIN sums USING (document_id, chunk_index)""")
def _(spark, root):
    # Moments over the cells tell vectors apart whose values lie in other places.
    e = corpus.embed_hashed(window_chunks(spark, root))
    add = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    at = lambda power: F.transform("embedding", lambda x, i: x.cast("double") * F.pow((i + 1).cast("double"), F.lit(power)))
    return e.select("document_id", "chunk_index", F.size("embedding").alias("dim"), F.round(add(at(0)), 6).alias("total"),
                    F.round(add(at(1)), 4).alias("first_moment"), F.round(add(at(2)), 2).alias("second_moment"))


@query("embedded_with_model", "R2 UD1", CH_ + """
SELECT document_id, chunk_index, CAST(length(content) AS DOUBLE) AS characters,
       CAST(length(content) - length(replace(content, ' ', '')) AS DOUBLE) AS spaces FROM chunks""")
def _(spark, root):
    # A model of one's own, loaded once per worker; here it measures its texts.
    def load():
        return lambda texts: [[len(t), t.count(" ")] for t in texts]

    e = corpus.embed(window_chunks(spark, root).select("document_id", "chunk_index", "content"), load=load)
    return e.select("document_id", "chunk_index", F.get("embedding", F.lit(0)).cast("double").alias("characters"),
                    F.get("embedding", F.lit(1)).cast("double").alias("spaces"))


@query("documents_from_files", "S8", """
SELECT item_id, sha256(text) AS file_hash, length(text) AS chars, 'runbook' AS doc_type FROM benchmark""")
def _(spark, root):
    # Texts written as files and read back, with their metadata by path.
    path = scratch_dir(spark, "files")
    items = tables.table(spark, root, "benchmark").select("item_id", F.col("text").alias("value"))
    items.repartition("item_id").write.option("lineSep", " ").partitionBy("item_id").text(path)
    paths = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_path"), "item_id")
    known = paths.withColumn("doc_type", F.lit("runbook")).withColumn("version", F.lit(None).cast("string"))
    read = read_documents(spark, path, known)
    text = F.expr("substring(content, 1, length(content) - 1)")  # without the separator behind it
    return read.select(F.col("item_id").cast("long").alias("item_id"), F.sha2(text, 256).alias("file_hash"),
                       F.length(text).alias("chars"), "doc_type")


@query("ingested_documents", "R13 S9")
def _(spark, root):
    d = docs(spark, root)
    stored = corpus.with_identity(d.where("doc_type = 'ADR'"))
    documents, _ = corpus.ingest(d, stored, "doc_id")
    return documents


@query("stored_documents", "S9 U3", C_ + """
SELECT substring(sha256(source_path || ':' || version), 1, 16) AS document_id, doc_type, sha256(content) AS file_hash,
       CASE WHEN sha256(content) < '8' THEN length(content) * 2 ELSE length(content) END AS total_chars FROM corpus""")
def _(spark, root):
    # Documents of all types stored by type and merged with a second edition of some of them.
    path = scratch_dir(spark, "stored")
    rows = corpus.with_identity(docs(spark, root)).select(
        "document_id", "doc_type", "file_hash", F.col("total_chars").cast("long").alias("total_chars"))
    upsert.replace_partitions(rows, path, ["doc_type"])
    again = rows.where("file_hash < '8'").withColumn("total_chars", F.col("total_chars") * 2)
    upsert.merge_into(path, again, ["document_id", "doc_type"], ["doc_type"])
    return spark.read.parquet(path).select("document_id", "doc_type", "file_hash", "total_chars")


@query("ingested_documents_windowed", "R13 U9 J4", C_ + """
SELECT substring(sha256(source_path || ':' || version), 1, 16) AS document_id, sha256(content) AS file_hash, doc_type,
       greatest(1, CAST(ceil((length(content) - 50) / 462.0) AS BIGINT)) AS chunk_count, length(content) AS total_chars
FROM corpus WHERE doc_id IN (SELECT min(doc_id) FROM corpus GROUP BY sha256(content))
  AND sha256(content) NOT IN (SELECT sha256(content) FROM corpus WHERE doc_type = 'ADR')""")
def _(spark, root):
    d = docs(spark, root)
    documents, _ = corpus.ingest(d, corpus.with_identity(d.where("doc_type = 'ADR'")), "doc_id", method="window")
    return documents.select("document_id", "file_hash", "doc_type", "chunk_count", "total_chars")


# Search inputs -----------------------------------------------------------------------------------

def vectors(spark, root):
    return tables.table(spark, root, "embeddings").select(
        F.col("vec_id").alias("document_id"), F.lit(0).alias("chunk_index"), "embedding", "label")


def exemplars(spark, root):
    """One query per label: the vector of its lowest id."""
    return (tables.table(spark, root, "embeddings").groupBy(F.col("label").alias("query_id"))
            .agg(F.min_by("embedding", "vec_id").alias("embedding")))


def text_queries(spark, root):
    """Every benchmark text is a query, with the exemplar vector of one label."""
    labels = exemplars(spark, root)
    n = labels.agg(F.count(F.lit(1)).alias("n")).scalar()
    items = tables.table(spark, root, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text"), (F.col("item_id") % n).alias("label"))
    return items.join(labels.withColumnRenamed("query_id", "label"), "label").drop("label")


EXEMPLARS = """exemplars AS (SELECT label AS query_id, arg_min(embedding, vec_id)::DOUBLE[] AS q FROM embeddings GROUP BY 1)"""
VECTORS = """vectors AS (SELECT vec_id AS document_id, 0 AS chunk_index, embedding::DOUBLE[] AS v, label FROM embeddings)"""


def near_sql(queries: str, pool: str, k: int, name: str = "near") -> str:
    return f"""{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, document_id, chunk_index) AS rank
    FROM (SELECT query_id, document_id, chunk_index, round(list_cosine_similarity(q, v), 10) AS score
          FROM {queries} CROSS JOIN {pool}) s) r WHERE rank <= {k})"""


@query("vector_search", "R4 T1 T2 X12 J1", with_(EXEMPLARS, VECTORS, near_sql("exemplars", "vectors", 20)) + """
SELECT query_id, document_id, chunk_index, score, rank FROM near""")
def _(spark, root):
    return search.vector_search(exemplars(spark, root), vectors(spark, root), 20)


@query("vector_search_grid", "R4 T2", with_(EXEMPLARS, VECTORS, near_sql("exemplars", "vectors", 20)) + """
SELECT query_id, document_id, chunk_index, score, rank FROM near""")
def _(spark, root):
    # The path for query sets too large to send to every task.
    return search.vector_search(exemplars(spark, root), vectors(spark, root), 20, broadcast_bytes=0)


@query("vector_search_filtered", "F6 F7 F8", with_(CORPUS, EXEMPLARS, VECTORS, """
pool AS (SELECT v.* FROM vectors v JOIN corpus c ON c.doc_id = v.document_id
         WHERE tenant_id = 'tenant-1' AND doc_type IN ('manual', 'runbook'))""", near_sql("exemplars", "pool", 20)) + """
SELECT query_id, document_id, score, rank FROM near WHERE score >= 0.1""")
def _(spark, root):
    meta = docs(spark, root).select(F.col("doc_id").alias("document_id"), "tenant_id", "doc_type")
    pool = vectors(spark, root).join(meta, "document_id")
    found = search.vector_search(exemplars(spark, root), pool, 20, "tenant-1", ["manual", "runbook"])
    return found.where("score >= 0.1").select("query_id", "document_id", "score", "rank")


@query("approximate_search", "R5", """
SELECT count(DISTINCT label) AS queries, 10 * count(DISTINCT label) AS results, true AS recall_reached,
       true AS few_scored, true AS scores_exact FROM embeddings""")
def _(spark, root):
    # Recall@10 of 0.9 with under a fifth of the vectors scored, on the exemplars of all labels.
    q, v = exemplars(spark, root), vectors(spark, root)
    index = ivf.build(v, ivf.train(v))
    near = staged(ivf.candidates(index, q, ivf.depth(index, 10)), "near")
    found = staged(ivf.reranked(index, q, near, 10), "found")
    exact = search.vector_search(q, v, 10)
    same = found.join(exact.select("query_id", *search.KEY, F.col("score").alias("exact")), ["query_id", *search.KEY], "left")
    reached = same.agg(F.count_distinct("query_id").alias("queries"), F.count(F.lit(1)).alias("results"),
                       (F.count("exact") >= 0.9 * exact.agg(F.count(F.lit(1))).scalar()).alias("recall_reached"),
                       F.bool_and(F.coalesce(F.abs(F.col("score") - F.col("exact")) < 1e-9, F.lit(True))).alias("scores_exact"))
    share = near.agg(F.count(F.lit(1)) / F.count_distinct("query_id")).scalar() / v.agg(F.count(F.lit(1))).scalar()
    return reached.withColumn("few_scored", share < 0.2)


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
POSTINGS = f"""tokenised AS (
  SELECT document_id, chunk_index, regexp_extract_all(lower(content), '{TOKEN}') AS t FROM chunks),
postings AS (
  SELECT document_id, chunk_index, term, count(*) AS tf, any_value(n) AS length
  FROM (SELECT document_id, chunk_index, len(t) AS n, unnest(t) AS term FROM tokenised) x GROUP BY 1, 2, 3)"""


def words_sql(queries: str, k: int, match: str, name: str = "words") -> str:
    need = "WHERE matched = n_terms" if match == "all" else ""
    return f"""{name}_terms AS (
  SELECT DISTINCT query_id, unnest(regexp_extract_all(lower(query_text), '{TOKEN}')) AS term FROM {queries}),
{name}_kept AS (SELECT *, count(*) OVER (PARTITION BY query_id) AS n_terms FROM {name}_terms WHERE term NOT IN ({_STOP})),
{name}_corpus AS (SELECT count(*)::DOUBLE AS n, avg(length) AS mean FROM (
  SELECT document_id, chunk_index, any_value(length) AS length FROM postings GROUP BY 1, 2) x),
{name}_df AS (SELECT term, count(*)::DOUBLE AS df FROM postings GROUP BY 1),
{name}_scored AS (
  SELECT query_id, document_id, chunk_index, count(*) AS matched, any_value(n_terms) AS n_terms,
         round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
                   / (tf + 1.2 * (0.25::DOUBLE + 0.75::DOUBLE * length / mean))), 9) AS score
  FROM {name}_kept JOIN {name}_df USING (term) JOIN postings USING (term) CROSS JOIN {name}_corpus GROUP BY 1, 2, 3),
{name} AS (SELECT * FROM (
  SELECT query_id, document_id, chunk_index, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, document_id, chunk_index) AS rank
  FROM {name}_scored {need}) x WHERE rank <= {k})"""


TEXT_QUERIES = "text_queries AS (SELECT item_id AS query_id, text AS query_text FROM benchmark)"
WORDS_ANY = with_(CORPUS, CHUNKS, POSTINGS, TEXT_QUERIES, words_sql("text_queries", 20, "any"))


def benchmark_queries(spark, root):
    return tables.table(spark, root, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def words_any(spark, root, k=20):
    return search.search_texts(benchmark_queries(spark, root), window_chunks(spark, root), k, "any")


@query("keyword_search_all", "R3 T1 X15", with_(
    CORPUS, CHUNKS, POSTINGS, TEXT_QUERIES, words_sql("text_queries", 20, "all")) + "SELECT * FROM words")
def _(spark, root):
    return search.search_texts(benchmark_queries(spark, root), window_chunks(spark, root), 20)


@query("keyword_search_any", "R3 T1 X15", WORDS_ANY + "SELECT * FROM words")
def _(spark, root):
    return words_any(spark, root)


# Short queries next to the whole texts: three neighbouring words of each, some of them stop words.
SHORT_QUERIES = f"""text_queries AS (
  SELECT item_id AS query_id, text AS query_text FROM benchmark
  UNION ALL SELECT item_id + 1000000, array_to_string(regexp_extract_all(lower(text), '{TOKEN}')[11:13], ' ') FROM benchmark)"""
# Every entry with, for each term of its query, the next place of that term; the farthest ends a cover.
DENSITY = """density_entries AS (
  SELECT k.query_id, p.document_id, p.chunk_index, k.term, p.pos, k.n_terms
  FROM words_kept k JOIN (
    SELECT document_id, chunk_index, unnest(t) AS term, unnest(range(len(t))) AS pos FROM tokenised) p ON p.term = k.term),
density_whole AS (SELECT query_id, document_id, chunk_index FROM density_entries GROUP BY 1, 2, 3
                  HAVING count(DISTINCT term) = any_value(n_terms)),
density_held AS (SELECT e.* FROM density_entries e JOIN density_whole w ON e.query_id = w.query_id
                 AND e.document_id = w.document_id AND e.chunk_index = w.chunk_index),
density_next AS (
  SELECT a.query_id, a.document_id, a.chunk_index, a.pos, b.term, min(b.pos) AS next, any_value(a.n_terms) AS n_terms
  FROM density_held a JOIN density_held b ON a.query_id = b.query_id AND a.document_id = b.document_id
       AND a.chunk_index = b.chunk_index AND b.pos >= a.pos GROUP BY 1, 2, 3, 4, 5),
density_ends AS (SELECT query_id, document_id, chunk_index, pos, max(next) AS stop FROM density_next
                 GROUP BY 1, 2, 3, 4 HAVING count(*) = any_value(n_terms)),
density_covers AS (SELECT query_id, document_id, chunk_index, max(pos) AS start, stop FROM density_ends GROUP BY 1, 2, 3, 5),
density_scores AS (
  SELECT query_id, document_id, chunk_index, round(sum(0.1::DOUBLE / (1 + others)), 9) AS score FROM (
    SELECT c.query_id, c.document_id, c.chunk_index, c.stop - c.start + 1 - count(*) AS others
    FROM density_covers c JOIN density_held e ON e.query_id = c.query_id AND e.document_id = c.document_id
         AND e.chunk_index = c.chunk_index AND e.pos BETWEEN c.start AND c.stop GROUP BY 1, 2, 3, c.start, c.stop) x GROUP BY 1, 2, 3),
density AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, document_id, chunk_index) AS rank
  FROM density_scores) x WHERE rank <= 20)"""


def short_queries(spark, root):
    whole = benchmark_queries(spark, root)
    few = F.array_join(F.slice(tokens(F.col("query_text")), 11, 3), " ")
    return whole.unionByName(whole.select((F.col("query_id") + 1_000_000).alias("query_id"), few.alias("query_text")))


@query("keyword_search_density", "R3 T1 X15", with_(
    CORPUS, CHUNKS, POSTINGS, SHORT_QUERIES, words_sql("text_queries", 20, "all"), DENSITY) + "SELECT * FROM density")
def _(spark, root):
    return lexical.search_density(short_queries(spark, root), window_chunks(spark, root), 20)


@query("keyword_search_stemmed", "R3 X15")
def _(spark, root):
    # English stems are beyond SQL; the tests compare with a search of stemmed texts.
    return lexical.search_density(short_queries(spark, root), window_chunks(spark, root), 20, stems=True)


# Every benchmark text gets the exemplar of one label, as in the Spark query.
HYBRID_QUERIES = EXEMPLARS + """,
vector_queries AS (SELECT item_id AS query_id, e.q FROM benchmark b JOIN exemplars e
                   ON e.query_id = b.item_id % (SELECT count(*) FROM exemplars))"""
FUSED = """ranked AS (
  SELECT query_id, document_id, chunk_index, 0 AS i, rank, 0.5 / (60 + rank) AS w FROM words
  UNION ALL SELECT query_id, document_id, chunk_index, 1, rank, 0.5 / (60 + rank) FROM near),
fused AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, seen.i, seen.r, document_id, chunk_index) AS rank
  FROM (SELECT query_id, document_id, chunk_index, round(sum(w), 12) AS score, min({'i': i, 'r': rank}) AS seen
        FROM ranked GROUP BY 1, 2, 3) x)"""
HYBRID = with_(CORPUS, CHUNKS, POSTINGS, TEXT_QUERIES, words_sql("text_queries", 20, "any"), HYBRID_QUERIES, VECTORS,
               near_sql("vector_queries", "vectors", 20), FUSED)


def both_lists(spark, root):
    q = text_queries(spark, root)
    return words_any(spark, root), search.vector_search(q, vectors(spark, root), 20)


@query("hybrid_search", "R6 R7 T3 W7", HYBRID + "SELECT query_id, document_id, chunk_index, score, rank FROM fused WHERE rank <= 10")
def _(spark, root):
    # Texts without a vector and vectors without a text are one table of chunks.
    pool = window_chunks(spark, root).select("document_id", "chunk_index", "content").unionByName(
        vectors(spark, root).select("document_id", "chunk_index", "embedding"), allowMissingColumns=True)
    return search.hybrid_search(text_queries(spark, root), pool, k=10, match="any")


@query("hybrid_search_density", "R3 R6 R7", with_(
    CORPUS, CHUNKS, POSTINGS, TEXT_QUERIES, words_sql("text_queries", 20, "all"), DENSITY, HYBRID_QUERIES, VECTORS,
    near_sql("vector_queries", "vectors", 20), FUSED.replace("FROM words", "FROM density"))
    + "SELECT query_id, document_id, chunk_index, score, rank FROM fused WHERE rank <= 10")
def _(spark, root):
    # The words ranked by cover density.
    pool = window_chunks(spark, root).select("document_id", "chunk_index", "content").unionByName(
        vectors(spark, root).select("document_id", "chunk_index", "embedding"), allowMissingColumns=True)
    return search.hybrid_search(text_queries(spark, root), pool, k=10, ranking="density")


@query("fusion_ranks", "J3 W7", HYBRID + """
SELECT coalesce(w.query_id, n.query_id) AS query_id, coalesce(w.document_id, n.document_id) AS document_id,
       coalesce(w.chunk_index, n.chunk_index) AS chunk_index, w.rank AS first_rank, n.rank AS second_rank
FROM words w FULL OUTER JOIN near n ON w.query_id = n.query_id AND w.document_id = n.document_id
     AND w.chunk_index = n.chunk_index""")
def _(spark, root):
    return search.fusion_ranks(*both_lists(spark, root))


@query("candidate_union", "U1", HYBRID + """
SELECT query_id, document_id, chunk_index, arg_min(i, (i, rank)) AS source_list, arg_min(rank, (i, rank)) AS rank
FROM ranked GROUP BY 1, 2, 3""")
def _(spark, root):
    return search.candidate_union(list(both_lists(spark, root)))


def hashed_sql(name: str, source: str, keys: str, text: str, out: str) -> str:
    """Token counts in 64 cells, scaled to length one; texts without a token have no vector."""
    return f"""{name}_cells AS (
  SELECT {keys}, CAST('0x' || substr(sha256(term), 1, 8) AS BIGINT) % 64 AS cell, count(*) AS n
  FROM (SELECT {keys}, unnest(regexp_extract_all(lower({text}), '{TOKEN}')) AS term FROM {source}) t GROUP BY ALL),
{name}_norms AS (SELECT {keys}, sqrt(sum(n * n)) AS norm FROM {name}_cells GROUP BY ALL),
{name}_grid AS (SELECT * FROM {name}_norms CROSS JOIN (SELECT unnest(range(64)) AS cell) r),
{name} AS (SELECT {keys}, list(CAST(CAST(coalesce(n, 0) / norm AS FLOAT) AS DOUBLE) ORDER BY cell) AS {out}
  FROM {name}_grid LEFT JOIN {name}_cells USING ({keys}, cell) GROUP BY {keys})"""


@query("hybrid_search_text", "R2 R7", with_(
    CORPUS, CHUNKS, POSTINGS, TEXT_QUERIES, words_sql("text_queries", 20, "all"),
    hashed_sql("hashed_chunks", "chunks", "document_id, chunk_index", "content", "v"),
    hashed_sql("hashed_queries", "text_queries", "query_id", "query_text", "q"),
    near_sql("hashed_queries", "hashed_chunks", 20), FUSED)
    + "SELECT query_id, document_id, chunk_index, score, rank FROM fused WHERE rank <= 10")
def _(spark, root):
    # Texts only: chunks and queries are embedded by token hashing. Chunks are cut into tokens once for both searches.
    cut = window_chunks(spark, root).select("document_id", "chunk_index", tokens(F.col("content")).alias("tokens"))
    chunks = staged(corpus.embed_hashed(cut), "token-chunks")
    q = corpus.embed_hashed(benchmark_queries(spark, root), "query_text")
    return search.hybrid_search(q, chunks, k=10)


RERANKED = f"""candidates AS (
  SELECT w.*, c.content, c.title, c.doc_type, c.version, c.source_path, c.last_updated, q.query_text
  FROM words w JOIN chunks c ON c.document_id = w.document_id AND c.chunk_index = w.chunk_index
  JOIN text_queries q ON q.query_id = w.query_id),
pairs AS (
  SELECT *, list_distinct(regexp_extract_all(lower(query_text), '{TOKEN}')) AS a,
         list_distinct(regexp_extract_all(lower(content), '{TOKEN}')) AS b FROM candidates),
reranked AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, document_id, chunk_index) AS rerank_rank
  FROM (SELECT *, coalesce(len(list_intersect(a, b))::DOUBLE
                           / nullif(len(list_distinct(list_concat(a, b)))::DOUBLE, 0), 0.0) AS rerank_score FROM pairs) y) x
  WHERE rerank_rank <= 3)"""
RERANK = WORDS_ANY.rstrip() + ",\n" + RERANKED + "\n"


def reranked(spark, root):
    q = benchmark_queries(spark, root)
    found = search.with_contents(words_any(spark, root), window_chunks(spark, root), q)
    return search.rerank(found, k=3)


@query("reranked", "R8 T4 UD2", RERANK + """
SELECT query_id, document_id, chunk_index, round(rerank_score, 10) AS rerank_score, rerank_rank FROM reranked""")
def _(spark, root):
    return rounded(reranked(spark, root).select("query_id", "document_id", "chunk_index", "rerank_score", "rerank_rank"))


@query("reranked_with_model", "R8 UD2", RERANK.replace("ORDER BY rerank_score DESC", "ORDER BY model_score DESC").replace(
    "coalesce(len(list_intersect(a, b))::DOUBLE", "CAST(length(content) - length(replace(content, 'e', '')) AS DOUBLE) AS model_score,\n  coalesce(len(list_intersect(a, b))::DOUBLE") + """
SELECT query_id, document_id, chunk_index, model_score, rerank_rank FROM reranked""")
def _(spark, root):
    # A pair model of one's own; here it counts a letter of the passage.
    q = benchmark_queries(spark, root)
    found = search.with_contents(words_any(spark, root), window_chunks(spark, root), q)
    score = search.model_score(lambda: (lambda pairs: [float(text.count("e")) for _, text in pairs]))
    return search.rerank(found, score, k=3).select(
        "query_id", "document_id", "chunk_index", F.col("rerank_score").alias("model_score"), "rerank_rank")


CITE = "title || ' (v' || version || '), ' || doc_type || ', Chunk ' || chunk_index"


@query("citations", "P7", RERANK + f"""
SELECT query_id, rerank_rank, '[' || rerank_rank || '] ' || {CITE} AS citation, title, doc_type, version, chunk_index,
       source_path, score FROM reranked""")
def _(spark, root):
    c = context.with_citations(reranked(spark, root), "rerank_rank")
    return c.select("query_id", "rerank_rank", "citation", "citation_record.*")


@query("formatted_results", "P8", RERANK + f"""
SELECT query_id, rerank_rank, 'Result ' || rerank_rank || ' (score: ' || printf('%.4f', score) || ')' || chr(10)
       || '[' || rerank_rank || '] ' || {CITE} || chr(10) || 'Content: ' || substring(content, 1, 200) || '...' AS formatted
FROM reranked""")
def _(spark, root):
    return context.format_results(reranked(spark, root), "rerank_rank").select("query_id", "rerank_rank", "formatted")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query("grounded_context", "R9", RERANK + f"""
SELECT query_id, count(*) AS context_used,
       sha256({_quoted(f"<s>[INST] <<SYS>>{chr(10)}{context.QA_RULES}{chr(10)}<</SYS>>{chr(10)}{chr(10)}Context:{chr(10)}")}
         || string_agg('[' || rerank_rank || '] ' || {CITE} || chr(10) || content || chr(10) || chr(10), '' ORDER BY rerank_rank)
         || chr(10) || chr(10) || 'Question: ' || any_value(query_text) || ' [/INST]') AS prompt_hash
FROM reranked GROUP BY 1""")
def _(spark, root):
    p = context.assemble_context(reranked(spark, root), rank="rerank_rank")
    return p.select("query_id", "context_used", F.sha2("prompt", 256).alias("prompt_hash"))


@query("guide_context", "R9", RERANK + f"""
SELECT query_id, sha256({_quoted(f"<s>[INST] <<SYS>>{chr(10)}{context.GUIDE_RULES}{chr(10)}<</SYS>>{chr(10)}{chr(10)}Error Code: ")}
         || any_value(query_text) || chr(10) || chr(10) || 'Context from manual:' || chr(10)
         || string_agg(content, chr(10) || chr(10) ORDER BY rerank_rank)
         || {_quoted(chr(10) + chr(10) + context.GUIDE_PARTS + " [/INST]")}) AS prompt_hash
FROM reranked GROUP BY query_id""")
def _(spark, root):
    p = context.assemble_context(reranked(spark, root), "guide", "rerank_rank")
    return p.select("query_id", F.sha2("prompt", 256).alias("prompt_hash"))


@query("extracted_steps", "R10 X8", rf"""
WITH lines AS (
  SELECT doc_id, pos, regexp_replace(line, '^\s+|\s+$', '', 'g') AS line
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents) x),
actions AS (
  SELECT doc_id, pos, regexp_replace(line, '^[0-9.\-) ]+', '') AS action FROM lines WHERE regexp_matches(line, '^[0-9-]')),
steps AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS step, action
          FROM actions WHERE length(action) > 10)
SELECT doc_id, step, action FROM steps
UNION ALL
SELECT doc_id, 1, '{context.FALLBACK_STEP}' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM steps)""")
def _(spark, root):
    return context.extract_steps(tables.table(spark, root, "documents"), "doc_id")


CODES = f"""codes AS (
  SELECT DISTINCT code AS error_code FROM (
    SELECT arg_max(t, (length(t), t)) AS code FROM (
      SELECT item_id, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS t FROM benchmark) x GROUP BY item_id) y)"""


def codes(spark, root):
    """The longest word of every benchmark text stands for an error code."""
    sized = F.transform(tokens(F.col("text")), lambda t: F.struct(F.length(t).alias("n"), t.alias("t")))
    return tables.table(spark, root, "benchmark").select(
        F.array_max(sized)["t"].alias("error_code")).distinct()


@query("troubleshoot_search", "R11 F6", with_(CORPUS, CHUNKS.replace("chunks AS", "all_chunks AS"), """
chunks AS (SELECT * FROM all_chunks WHERE doc_type = 'manual')""", POSTINGS, CODES, """
code_queries AS (SELECT error_code AS query_id, 'error code ' || error_code || ' troubleshooting' AS query_text FROM codes)""",
    words_sql("code_queries", 10, "any"), RERANKED.replace("text_queries", "code_queries").replace(
        "FROM pairs) y", "FROM pairs WHERE list_contains(b, lower(query_id))) y")) + """
SELECT c.error_code, r.document_id, r.chunk_index, r.title, round(r.rerank_score, 10) AS rerank_score, r.rerank_rank,
       r.document_id IS NOT NULL AS found
FROM codes c LEFT JOIN reranked r ON r.query_id = c.error_code""")
def _(spark, root):
    return rounded(search.troubleshoot_search(codes(spark, root), window_chunks(spark, root)))


@query("articles_per_code", "J9", with_(CORPUS, CHUNKS, POSTINGS, CODES) + """
SELECT * FROM (SELECT error_code, document_id, chunk_index, tf / length::DOUBLE AS density,
  row_number() OVER (PARTITION BY error_code ORDER BY tf / length::DOUBLE DESC, document_id, chunk_index) AS rank
  FROM codes JOIN postings ON term = lower(error_code)) x WHERE rank <= 3""")
def _(spark, root):
    return search.articles_per_code(codes(spark, root), window_chunks(spark, root))


@query("freshness_boost", "R12", RERANK + """
SELECT query_id, document_id, chunk_index, round(score * CASE WHEN DATE '2024-01-31' - last_updated <= 7 THEN 1.2 ELSE 1.0 END, 10)
       AS boosted_score FROM candidates""")
def _(spark, root):
    found = search.with_contents(words_any(spark, root), window_chunks(spark, root), benchmark_queries(spark, root))
    return rounded(search.freshness_boost(found, "2024-01-31").select(
        "query_id", "document_id", "chunk_index", "boosted_score"))


@query("latest_versions", "R12", C_ + """
SELECT source, doc_id, version FROM (
  SELECT source, doc_id, '1.' || (doc_id % 12) AS version,
         row_number() OVER (PARTITION BY source ORDER BY doc_id % 12 DESC, last_updated DESC, doc_id) AS r FROM corpus) x
WHERE r = 1""")
def _(spark, root):
    d = docs(spark, root).withColumn("version", F.concat(F.lit("1."), F.col("doc_id") % 12))
    return search.latest_versions(d, "source", ["doc_id"]).select("source", "doc_id", "version")


@query("retrieval_quality", "A30", with_(EXEMPLARS, VECTORS, near_sql("exemplars", "vectors", 10)) + """
SELECT t.query_id, round(coalesce(hits, 0) / 10.0, 10) AS precision_at_k,
       round(coalesce(hits, 0) / relevant::DOUBLE, 10) AS recall_at_k, round(coalesce(1.0 / first, 0.0), 10) AS reciprocal_rank
FROM (SELECT label AS query_id, count(*) AS relevant FROM embeddings GROUP BY 1) t
LEFT JOIN (SELECT n.query_id, count(*) AS hits, min(rank) AS first FROM near n JOIN vectors v
           ON v.document_id = n.document_id AND v.label = n.query_id GROUP BY 1) h ON h.query_id = t.query_id""")
def _(spark, root):
    v = vectors(spark, root)
    ranked = search.vector_search(exemplars(spark, root), v, 10)
    relevant = v.select(F.col("label").alias("query_id"), "document_id", "chunk_index")
    totals = relevant.groupBy("query_id").agg(F.count(F.lit(1)).alias("relevant"))
    return rounded(evaluate.retrieval_quality(ranked, relevant, totals, 10))
