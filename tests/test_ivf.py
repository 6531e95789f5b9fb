"""The inverted file against exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import ivf, search

SCHEMA = "document_id int, chunk_index int, embedding array<float>"


def clustered(seed, n=3000, dim=16, groups=30):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    # A third of the vectors are of one group.
    group = np.where(rng.random(n) < 0.33, 0, rng.integers(0, groups, n))
    return centres[group] + 0.4 * rng.normal(size=(n, dim))


def frame(spark, vectors, extra=()):
    rows = [(i, i % 2, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows + list(extra), SCHEMA).repartition(4)


def asked(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "query_id int, embedding array<float>")


def share(found, exact):
    key = lambda df: {(r.query_id, r.document_id) for r in df.collect()}
    want = key(exact)
    return len(key(found) & want) / len(want)


def test_recall_and_exact_scores(spark, monkeypatch):
    v = clustered(1)
    chunks, queries = frame(spark, v), asked(spark, v[::60] + 0.05)
    index = ivf.build(chunks, ivf.train(chunks, lists=32))
    assert index.sizes.sum() == len(v) and index.quantizer.probes < 16
    exact = search.vector_search(queries, chunks, 10)
    found = ivf.search(index, queries, 10)
    assert share(found, exact) >= 0.9
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    for r in found.collect():
        q = v[::60][r.query_id] + 0.05
        assert abs(r.score - unit[r.document_id] @ (q / np.linalg.norm(q))) < 1e-5
    # Looked into a part of the lists only.
    probed = ivf.candidates(index, queries, 10_000).groupBy("query_id").count().agg(F.avg("count")).first()[0]
    assert probed < 0.6 * len(v)
    # Lists and queries in several blocks change nothing.
    want = sorted(map(tuple, found.collect()))
    monkeypatch.setattr(ivf, "LIST_BLOCK", 20)
    monkeypatch.setattr(ivf, "QUERY_BLOCK", 7)
    assert index.blocks.max() > 5
    assert sorted(map(tuple, ivf.search(index, queries, 10).collect())) == want


def test_all_lists_and_all_candidates_are_exact_search(spark):
    v = clustered(2, 400)
    chunks, queries = frame(spark, v), asked(spark, v[:20])
    index = ivf.build(chunks, ivf.train(chunks))
    got = ivf.search(index, queries, 10, probes=10_000, rerank=40)
    exact = search.vector_search(queries, chunks, 10)
    key = lambda df: sorted((r.query_id, r["rank"], r.document_id) for r in df.collect())
    assert key(got) == key(exact)


def test_unusable_vectors_match_nothing(spark):
    v = clustered(3, 200)
    odd = [(900, 0, None), (901, 0, [0.0] * 16), (902, 0, [float("nan")] * 16), (903, 0, [float("inf")] + [0.0] * 15)]
    chunks = frame(spark, v, odd)
    queries = asked(spark, v[:3]).unionByName(spark.createDataFrame(
        [(50, None), (51, [0.0] * 16)], "query_id int, embedding array<float>"))
    index = ivf.build(chunks, ivf.train(chunks))
    got = ivf.search(index, queries, 5, probes=1000).collect()
    assert {r.query_id for r in got} == {0, 1, 2} and max(r.document_id for r in got) < 900
    assert ivf.search(index, queries.where("query_id < 0"), 5).collect() == []
    with pytest.raises(ValueError):
        ivf.train(chunks.where("document_id >= 900"))
    with pytest.raises(ValueError):
        ivf.search(index, asked(spark, [[1.0, 2.0]]), 5)


def test_sample_is_bounded_and_repeats(spark):
    v = clustered(4)
    chunks = frame(spark, v)
    a, b = (ivf.train(chunks, sample_bytes=8 * 16 * 500) for _ in range(2))
    assert np.array_equal(a.centres, b.centres) and len(a.centres) <= 500 // 4
    index = ivf.build(chunks, a)
    assert index.sizes.sum() == len(v)  # every vector is indexed, whatever the sample


def test_equal_vectors(spark):
    chunks = frame(spark, np.ones((50, 8)))
    index = ivf.build(chunks, ivf.train(chunks))
    got = ivf.search(index, asked(spark, np.ones((1, 8))), 4).orderBy("rank").collect()
    assert [(r.document_id, round(r.score, 6)) for r in got] == [(0, 1.0), (1, 1.0), (2, 1.0), (3, 1.0)]


def test_coarse_codes_get_more_candidates(spark, monkeypatch):
    # One byte for all 16 dimensions, and vectors without groups: the nearest by code are seldom the nearest.
    monkeypatch.setattr(ivf, "PART", 16)
    v = np.random.default_rng(5).normal(size=(3000, 16))
    chunks, queries = frame(spark, v), asked(spark, v[::100])
    index = ivf.build(chunks, ivf.train(chunks, lists=8))
    assert share(ivf.search(index, queries, 10), search.vector_search(queries, chunks, 10)) >= 0.9
    assert ivf.depth(index, 10) > 80
