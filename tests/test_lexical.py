"""Search inside chunk rows against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.functions.stem import stem
from millrace.functions.text import STOP_WORDS
from millrace.operators import lexical, search
from tests.test_documents import brute_bm25

CHUNK = "document_id int, chunk_index int, content string"
QUERY = "query_id int, query_text string"


def corpus(seed, n=150):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)]
    # One word is in nearly every chunk, and often several times.
    chunks = {(i, i % 3): " ".join(rnd.choices(["hot", *vocabulary], [8, *[1] * 30], k=rnd.randrange(3, 60))) for i in range(n)}
    queries = {i: " ".join(["hot", "the", *rnd.sample(vocabulary, i % 4)]) for i in range(16)}
    queries |= {97: "the of", 98: "", 99: "absent hot", 100: "hot hot"}
    return chunks, queries


def frames(spark, chunks, queries):
    c = spark.createDataFrame([(*k, t) for k, t in chunks.items()] + [(900, 0, ""), (901, 0, None), (902, 0, "!")], CHUNK)
    return spark.createDataFrame(list(queries.items()) + [(101, None)], QUERY), c.repartition(5)


def ranked(found):
    got = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.document_id, r.chunk_index, r.score))
    return dict(got)


def brute_density(chunks, queries, k):
    """Covers by trying every stretch of words."""
    out = {}
    for q, text in queries.items():
        words = {w for w in text.split() if w not in STOP_WORDS}
        rows = []
        for key, content in chunks.items():
            t = content.split()
            whole = lambda a, b: words <= set(t[a:b + 1])
            covers = [(a, b) for a in range(len(t)) for b in range(a, len(t))
                      if words and whole(a, b) and not whole(a + 1, b) and not whole(a, b - 1)]
            if covers:
                score = sum(0.1 / (1 + sum(w not in words for w in t[a:b + 1])) for a, b in covers)
                rows.append((-round(score, 9), *key))
        if rows:
            out[q] = [(a, b, -s) for s, a, b in sorted(rows)[:k]]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_cover_density(spark, monkeypatch, seed):
    chunks, queries = corpus(seed)
    q, c = frames(spark, chunks, queries)
    want = brute_density(chunks, queries, 6)
    assert ranked(lexical.search_density(q, c, 6)) == want
    # Small blocks of queries and places, and several passes, change nothing.
    monkeypatch.setattr(lexical, "QUERY_BLOCK", 3)
    monkeypatch.setattr(lexical, "PAIR_BLOCK", 40)
    assert ranked(lexical.search_density(q, c, 6, query_bytes=60)) == want


@pytest.mark.parametrize("match", ["all", "any"])
def test_bm25(spark, monkeypatch, match):
    chunks, queries = corpus(3)
    q, c = frames(spark, chunks, queries)
    want = {k: v for k, v in brute_bm25(chunks, queries, match).items() if v}
    keys = lambda found: {k: [r[:2] for r in v] for k, v in ranked(found).items()}
    assert keys(lexical.search_bm25(q, c, 5, match)) == want
    monkeypatch.setattr(lexical, "QUERY_BLOCK", 3)
    assert keys(lexical.search_bm25(q, c, 5, match, query_bytes=60)) == want
    # Stored postings give the same rows and scores.
    stored = ranked(search.keyword_search(q, search.build_postings(c), 5, match))
    assert ranked(lexical.search_bm25(q, c, 5, match)) == stored


def test_no_queries_and_no_chunks(spark):
    chunks, queries = corpus(4, 5)
    q, c = frames(spark, chunks, queries)
    for run in (lexical.search_density, lexical.search_bm25):
        assert run(q.where("query_id < 0"), c).collect() == []
        assert run(q, c.where("document_id < 0")).collect() == []


def test_only_asked_words_are_kept(spark):
    _, c = frames(spark, {(1, 0): "a b c a", (2, 0): "d"}, {})
    rows = {r.document_id: (r.length, r.words, r.places) for r in
            lexical.matched_words(c, pa.array(["a", "c"])).collect()}
    assert rows == {1: (4, [0, 1, 0], [0, 2, 3]), 2: (1, [], [])}


def test_covers_prefer_close_terms():
    # a x b b y a b
    pair, place, slot = np.zeros(5, int), np.array([0, 2, 3, 5, 6]), np.array([0, 1, 1, 0, 1])
    got = lexical._covers(pair, place, slot, np.array([2]))
    assert np.allclose(got, [0.1 / 2, 0, 0.1 / 2, 0.1, 0])


STEMS = dict(
    caresses="caress", flies="fli", dies="die", mules="mule", denied="deni", agreed="agre", owned="own", humbled="humbl",
    sized="size", meeting="meet", stating="state", itemization="item", sensational="sensat", traditional="tradit",
    reference="refer", colonizer="colon", plotted="plot", running="run", generously="generous", knightly="knight",
    consolatory="consolatori", hopping="hop", hoped="hope", ties="tie", cries="cri", gas="gas", kiwis="kiwi", happily="happili",
    say="say", by="by", cry="cri", vibrations="vibrat", maintenance="mainten", temperatures="temperatur", bearings="bear",
    spindles="spindl", relational="relat", communication="communic", skies="sky", innings="inning", proceeds="proceed",
    bled="bled", analogies="analog", fluently="fluentli", national="nation", yellow="yellow", boyish="boyish",
    adoption="adopt", opinion="opinion", argue="argu", shopped="shop", disabled="disabl", éclairs="éclair", x1="x1")


def test_stems():
    assert {w: stem(w) for w in STEMS} == STEMS


@pytest.mark.parametrize("run", ["density", "bm25"])
def test_search_by_stems_is_search_of_stemmed_texts(spark, run):
    rnd = random.Random(6)
    words = [w for w in STEMS if w not in ("by", "say")] + ["reading", "read", "reads", "machine", "machines", "doing", "does"]
    chunks = {(i, 0): " ".join(rnd.choices(words, k=rnd.randrange(3, 40))) for i in range(90)}
    queries = {i: " ".join(rnd.sample(words, 2)) for i in range(20)} | {90: "reads reading", 91: "does"}
    search_ = lexical.search_density if run == "density" else lexical.search_bm25
    q, c = frames(spark, chunks, queries)
    got = ranked(search_(q, c, 6, stems=True))
    # A stop word takes a place but matches nothing, whatever its stem would be.
    reduced = lambda t: " ".join("of" if w in STOP_WORDS else "s" + stem(w) for w in t.split())
    q, c = frames(spark, {k: reduced(t) for k, t in chunks.items()}, {k: reduced(t) for k, t in queries.items()})
    assert got == ranked(search_(q, c, 6)) and 90 in got and 91 not in got


def test_types_of_keys_stay(spark):
    q = spark.createDataFrame([("q1", "red fox")], "query_id string, query_text string")
    c = spark.createDataFrame([("d1", 3, "a red and a brown fox")], "document_id string, chunk_index long, content string")
    found = lexical.search_density(q, c)
    assert dict(found.dtypes) == {"query_id": "string", "document_id": "string", "chunk_index": "bigint",
                                  "score": "double", "rank": "int"}
    assert found.select(F.round("score", 6)).first()[0] == 0.025


def test_rows_and_results_are_held_in_bounded_numbers(spark, monkeypatch):
    rnd = random.Random(8)
    words = ["ab", "cd", "ef", "gh", "ij", "kl"]
    rows = [(i, i % 3, " ".join(rnd.choice(words) for _ in range(rnd.randrange(12)))) for i in range(300)] + [(900 + i, 0, "ab cd") for i in range(60)]
    chunks = spark.createDataFrame(rows, "document_id int, chunk_index int, content string").coalesce(2)
    queries = spark.createDataFrame([(i, " ".join(rnd.sample(words, 2))) for i in range(40)] + [(99, "ab cd")], "query_id int, query_text string")
    key = lambda df: sorted(map(tuple, df.collect()))
    ways = [lambda: lexical.search_density(queries, chunks, 4), lambda: lexical.search_bm25(queries, chunks, 4, "any"),
            lambda: lexical.search_density(queries, chunks, 4, stems=True)]
    want = [key(way()) for way in ways]
    for row_block, held in ((7, 1 << 16), (50, 20), (1024, 300)):
        monkeypatch.setattr(lexical, "ROW_BLOCK", row_block)
        monkeypatch.setattr(lexical, "HELD_ROWS", held)
        assert [key(way()) for way in ways] == want and len(want[0]) > 40
    batch = pa.RecordBatch.from_pydict({"i": list(range(20))})
    monkeypatch.setattr(lexical, "ROW_BLOCK", 8)
    assert [b.num_rows for b in lexical.row_blocks(iter([batch, batch]))] == [8, 8, 4, 8, 8, 4]
