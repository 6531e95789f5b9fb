import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.functions.text import STOP_WORDS, tokens
from millrace.operators import context, corpus, search
from millrace.session import scratch_dir
from millrace.sources import tables
from millrace.sources.documents import read_documents

DOC = "doc_id int, tenant_id string, doc_type string, title string, source_path string, version string, content string, last_updated date"


def doc(i, content, path=None, version="1.0"):
    return (i, "t", "manual", f"title {i}", path or f"p{i}", version, content, None)


def test_recursive_split_prefers_coarse_separators():
    assert corpus.split_recursive("one two\n\nthree four", 12, 0) == ["one two", "three four"]
    assert corpus.split_recursive("abcdefghij", 4, 1) == ["abcd", "defg", "ghij"]
    assert corpus.split_recursive("", 10, 2) == []


@pytest.mark.parametrize("seed", range(5))
def test_recursive_chunks_are_bounded_and_lose_no_word(seed):
    rnd = random.Random(seed)
    text = "".join(rnd.choice(["word", "longer", "x" * rnd.randrange(1, 90), ". ", " ", "\n", "\n\n"]) for _ in range(400))
    chunks = corpus.split_recursive(text, 60, 10)
    assert all(0 < len(c) <= 60 for c in chunks)
    assert set("".join(text.split())) == set("".join("".join(chunks).split()))
    assert len("".join("".join(chunks).split())) >= len("".join(text.split()))


def test_window_chunks_cover_the_whole_text(spark):
    text = "".join(chr(97 + i % 26) for i in range(1200))
    rows = corpus.chunk_windows(spark.createDataFrame([doc(1, text), doc(2, "short"), doc(3, "")], DOC)).collect()
    one = sorted((r.chunk_index, r.content) for r in rows if r.doc_id == 1)
    assert "".join(c if i == 0 else c[50:] for i, c in one) == text
    assert [r.content for r in rows if r.doc_id == 2] == ["short"]


def test_window_blocks_do_not_show(spark):
    text = "".join(chr(97 + (i * i) % 26) for i in range(5000)) + "é" * 300
    df = spark.createDataFrame([doc(1, text)], DOC)
    cut = lambda block: [r.content for r in corpus.chunk_windows(df, block=block).orderBy("chunk_index").collect()]
    want = [text[i:i + 512] for i in range(0, len(text) - 50, 462)]
    assert cut(1) == cut(3) == cut(100) == want


def test_ingest_twice_adds_nothing_and_replaces_old_chunks(spark):
    docs = spark.createDataFrame([doc(1, "alpha beta. " * 100), doc(2, "alpha beta. " * 100, "copy"), doc(3, "gamma")], DOC)
    documents, chunks = corpus.ingest(docs, None, "doc_id")
    assert sorted((r.title, r.chunk_count) for r in documents.collect()) == [("title 1", 3), ("title 3", 1)]
    again, _ = corpus.ingest(docs, documents, "doc_id")
    assert again.count() == 0
    changed, fresh = corpus.ingest(spark.createDataFrame([doc(4, "short now", "p1")], DOC), documents, "doc_id")
    assert changed.count() == 1
    left = corpus.replace_chunks(chunks, fresh)
    assert sorted(r.content for r in left.collect()) == ["gamma", "short now"]


def test_embedding_functions(spark):
    df = spark.createDataFrame([("a b a",), ("",), (None,)], "content string")
    v = [r.embedding for r in corpus.embed_hashed(df, dim=16).collect()]
    assert abs(sum(x * x for x in v[0]) - 1) < 1e-6 and sum(v[1]) == 0 and len(v[2]) == 16

    def load():
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    assert [list(r.embedding) for r in corpus.embed(df, load=load).collect()] == [[5.0, 1.0], [0.0, 1.0], [0.0, 1.0]]


def test_document_files(spark):
    path = scratch_dir(spark, "files")
    spark.createDataFrame([("# Manual\n\nline",)], "value string").coalesce(1).write.text(path)
    d = read_documents(spark, path).first()
    assert d.content == "# Manual\n\nline\n" and d.version == "1.0"


def brute_bm25(chunks, queries, match):
    tokens = {k: "".join(c if c.isalnum() or c == "_" else " " for c in t.lower()).split() for k, t in chunks.items()}
    df = Counter(w for t in tokens.values() for w in set(t))
    n, mean = len(tokens), sum(map(len, tokens.values())) / len(tokens)
    out = {}
    for q, text in queries.items():
        words = {w for w in text.lower().split() if w not in STOP_WORDS}
        scored = []
        for k, t in tokens.items():
            tf = Counter(t)
            hit = [w for w in words if tf[w]]
            if not hit or (match == "all" and len(hit) < len(words)):
                continue
            s = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(t) / mean))
                    for w in hit)
            scored.append((-round(s, 9), *k))
        out[q] = [(a, b) for _, a, b in sorted(scored)[:5]]
    return out


@pytest.mark.parametrize("match", ["all", "any"])
def test_keyword_search_equals_brute_force(spark, match):
    rnd = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)]
    # One word is in nearly every chunk.
    chunks = {(i, 0): " ".join(["hot"] * rnd.randrange(3) + rnd.choices(vocabulary, k=rnd.randrange(3, 30))) for i in range(150)}
    queries = {i: " ".join(["hot", "the", *rnd.sample(vocabulary, 2)]) for i in range(12)}
    queries[99] = "absent hot"
    c = spark.createDataFrame([(*k, t) for k, t in chunks.items()], "document_id int, chunk_index int, content string")
    q = spark.createDataFrame(list(queries.items()), "query_id int, query_text string")
    found = search.keyword_search(q, search.build_postings(c), 5, match).orderBy("query_id", "rank").collect()
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r.document_id, r.chunk_index))
    assert got == {k: v for k, v in brute_bm25(chunks, queries, match).items() if v}


def test_vector_paths_agree_with_numpy(spark, monkeypatch):
    rng = np.random.default_rng(0)
    v, q = rng.normal(size=(300, 8)), rng.normal(size=(40, 8))
    v[7] = 0.0
    chunks = spark.createDataFrame([(i, 0, [float(x) for x in r]) for i, r in enumerate(v)] + [(900, 0, [1.0])],
                                   "document_id int, chunk_index int, embedding array<double>")
    queries = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(q)], "query_id int, embedding array<double>")
    with np.errstate(invalid="ignore"):
        cos = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (v / np.linalg.norm(v, axis=1, keepdims=True)).T
    want = {(i, r + 1): int(j) for i in range(40) for r, j in enumerate(np.argsort(-np.nan_to_num(cos[i], nan=-2))[:6])}
    monkeypatch.setattr(search, "GRID_QUERIES", 16)
    monkeypatch.setattr(search, "GRID_VECTORS", 64)
    for limit in (1 << 20, 0):
        got = search.vector_search(queries, chunks, 6, broadcast_bytes=limit).collect()
        assert {(r.query_id, r["rank"]): r.document_id for r in got} == want


def test_approximate_search_recall(spark, root):
    v = tables.table(spark, root, "embeddings").select(
        F.col("vec_id").alias("document_id"), F.lit(0).alias("chunk_index"), "embedding")
    q = v.where("document_id < 20").select(F.col("document_id").alias("query_id"), "embedding")
    exact = search.vector_search(q, v, 10)
    found = search.approximate_search(q, v, 10)
    assert search.recall(found, exact).agg(F.avg("recall")).first()[0] >= 0.8


def test_fusion_is_symmetric_with_equal_weights(spark):
    schema = "query_id int, document_id int, chunk_index int, rank int"
    a = spark.createDataFrame([(1, 10, 0, 1), (1, 11, 0, 2)], schema)
    b = spark.createDataFrame([(1, 11, 0, 1), (1, 12, 0, 2)], schema)
    ab, ba = search.rrf([a, b]), search.rrf([b, a])
    scores = lambda df: {r.document_id: r.score for r in df.collect()}
    assert scores(ab) == scores(ba)
    assert abs(scores(ab)[11] - (0.5 / 62 + 0.5 / 61)) < 1e-12
    assert ab.orderBy("rank").first().document_id == 11


def test_hybrid_search_runs_on_texts(spark):
    c = corpus.embed_hashed(spark.createDataFrame(
        [(1, 0, "t", "manual", "spindle vibration alarm"), (2, 0, "t", "runbook", "belt speed"), (3, 0, "u", "manual", "spindle oil")],
        "document_id int, chunk_index int, tenant_id string, doc_type string, content string"))
    q = corpus.embed_hashed(spark.createDataFrame([(1, "spindle vibration")], "query_id int, query_text string"), "query_text")
    got = search.hybrid_search(q, c, k=2, tenant="t", doc_types=["manual"]).collect()
    assert [(r.document_id, r["rank"]) for r in got] == [(1, 1)]


def test_rerank_with_a_model(spark):
    df = spark.createDataFrame([(1, "q", 1, 0, "aa"), (1, "q", 2, 0, "aaaa"), (1, "q", 3, 0, "a")],
                               "query_id int, query_text string, document_id int, chunk_index int, content string")
    score = search.model_score(lambda: (lambda pairs: [float(len(c)) for _, c in pairs]))
    assert [r.document_id for r in search.rerank(df, score, 2).orderBy("rerank_rank").collect()] == [2, 1]


def test_steps_and_troubleshooting(spark):
    text = "Intro\n1. Check the coolant flow\n  - Replace the worn tool\n2) ok\n\n10. Restart the whole machine"
    t = spark.createDataFrame([(1, text), (2, "no list here")], "id int, text string")
    got = sorted((r.id, r.step, r.action) for r in context.extract_steps(t, "id").collect())
    assert got == [(1, 1, "Check the coolant flow"), (1, 2, "Replace the worn tool"), (1, 3, "Restart the whole machine"),
                   (2, 1, context.FALLBACK_STEP)]
    chunks = spark.createDataFrame([(1, 0, "t", "manual", "m", "VIB_HIGH_001: high vibration"), (2, 0, "t", "runbook", "r", "VIB_HIGH_001")],
                                   "document_id int, chunk_index int, tenant_id string, doc_type string, title string, content string")
    codes = spark.createDataFrame([("VIB_HIGH_001",), ("NONE_404",)], "error_code string")
    rows = {r.error_code: r for r in search.troubleshoot_search(codes, chunks).collect()}
    assert rows["VIB_HIGH_001"].document_id == 1 and not rows["NONE_404"].found


def test_versions_compare_as_numbers(spark):
    d = spark.createDataFrame([("p", "1.9"), ("p", "1.10"), ("q", "2.0")], "source_path string, version string").withColumn(
        "last_updated", F.lit(None).cast("date"))
    assert sorted((r.source_path, r.version) for r in search.latest_versions(d).collect()) == [("p", "1.10"), ("q", "2.0")]


def test_hashed_embeddings_hash_each_distinct_token_once(spark, monkeypatch):
    want = [0.0] * 64
    for token, n in (("alpha", 2), ("beta", 1), ("\u00fc", 1)):
        want[int(hashlib.sha256(token.encode()).hexdigest()[:8], 16) % 64] += n
    length = sum(x * x for x in want) ** 0.5
    df = spark.createDataFrame([(i, "Alpha beta alpha, \u00dc") for i in range(50)] + [(50, None), (51, "...")], "i int, content string")
    got = {r.i: r.embedding for r in corpus.embed_hashed(df.coalesce(1)).collect()}
    assert got[49] == pytest.approx([x / length for x in want], abs=1e-6) and got[50] == got[51] == [0.0] * 64
    cell, seen = corpus.cell_of, []
    monkeypatch.setattr(corpus, "cell_of", lambda token, dim: seen.append(token) or cell(token, dim))
    lists = pa.array([["alpha", "beta", "alpha", "\u00fc"]] * 50 + [[]])
    assert corpus.hashed_vectors(lists, 64).to_pylist() == [got[0]] * 50 + [[0.0] * 64]
    assert sorted(seen) == [b"alpha", b"beta", "\u00fc".encode()]


def test_stored_tokens_stand_for_the_text(spark):
    texts = ["Alpha beta, alpha gamma", None, "...", "gamma beta " * 30, "delta \u00dc alpha"]
    chunks = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "document_id int, chunk_index int, content string")
    queries = spark.createDataFrame([(1, "alpha beta"), (2, "gamma"), (3, "the")], "query_id int, query_text string")
    cut = chunks.select("document_id", "chunk_index", tokens(F.col("content")).alias("tokens"))
    key = lambda df: sorted(map(tuple, df.collect()))
    vectors = [corpus.embed_hashed(c).select("document_id", "embedding") for c in (chunks, cut)]
    assert key(vectors[0]) == key(vectors[1])
    for ranking, match in (("bm25", "all"), ("bm25", "any"), ("density", "all")):
        found = [key(search.search_texts(queries, c, 5, match, ranking)) for c in (chunks, cut)]
        assert found[0] and found[0] == found[1]


def test_batches_are_split_in_slices(spark, monkeypatch):
    texts = ["a" * 10, None, "", "b" * 500, "c" * 10, "d" * 10, "\u00fc" * 9]
    slices = [s.to_pylist() for s in corpus.text_slices(pa.array(texts), 25)]
    assert sum(slices, []) == texts and [len(s) for s in slices] == [3, 1, 2, 1]
    assert list(corpus.text_slices(pa.array([], pa.string()))) == []
    lists = pa.array([["x"] * (i % 4) + ["y"] for i in range(23)])
    want = corpus.hashed_vectors(lists, 8).to_pylist()
    monkeypatch.setattr(corpus, "ROWS_AT_ONCE", 5)
    assert corpus.hashed_vectors(lists, 8).to_pylist() == want
    docs = spark.createDataFrame([(i, "one two three. " * (i * 7)) for i in range(30)] + [(99, None)], "i int, content string")
    got = corpus.chunk_recursive(docs.coalesce(1)).orderBy("i", "chunk_index").collect()
    assert [(r.i, r.content) for r in got] == [(i, c) for i in range(30) for c in corpus.split_recursive("one two three. " * (i * 7))]
