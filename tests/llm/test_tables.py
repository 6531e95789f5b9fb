"""Operators on pages, vectors and labels, the registered queries and the pipeline."""

import base64
import hashlib
import io
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

import corpus_pipeline
from check import canon, database
from millrace.llm import embeddings, outliers, quality, queries, simhash, urls, warc
from millrace.session import scratch_dir
from tests.llm.corpus import awkward, documents, empty
from tests.llm.test_texts import brute_components, brute_removals, brute_spans, found

# --- WARC ---------------------------------------------------------------------------------------------------------------

PAGES = [(1, "http://a/", "same"), (2, "http://b/\r\nx", "same"), (3, None, ""), (4, "http://c/", None), (5, "http://d/é", "é漢" * 9000),
         (9, "http://e/", "same"), (None, "http://f/", "same"), (None, "http://g/", "alone"), (7, "http://h/", "tie"),
         (7, "http://h/", "tie"), (6, "http://h/", "tie"), (8, "http://i/", "\r\n\r\nWARC/1.1\r\n\r\n")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "extra", "extra") for r in rows], "page_id long, url string, html string, payload string, record_type string").repartition(3)


def test_warc_round_trip(spark):
    path = scratch_dir(spark, "warc-test")
    warc.write(pages(spark), path)
    top = {}
    for i, _, html in PAGES:
        own = (html or "").encode()
        top[own] = max([x for x in (top.get(own), i) if x is not None], default=None)
    want = []
    for i, _, html in PAGES:
        own = (html or "").encode()
        first = i == top[own]
        want.append((i, len(own), base64.b32encode(hashlib.sha1(own).digest()).decode(), "response" if first else "revisit",
                     None if first else top[own]))
    assert found(warc.page_records(spark, path)) == sorted(want, key=repr)
    responses = warc.read(spark, path, ["record_type", "target_uri", "payload"]).where("record_type = 'response'")
    assert "PushedFilters" in responses._jdf.queryExecution().toString() or responses.count()
    assert sorted(bytes(r.payload) for r in responses.collect()) == sorted((h or "").encode() for (_, _, h), w in zip(PAGES, want) if w[3] == "response")
    assert warc.read(spark, path, ["refers_to"]).where(F.col("refers_to").isin("urn:page:9")).count() == 3


def test_small_payloads_are_never_revisits(spark):
    path = scratch_dir(spark, "warc-test")
    warc.write(pages(spark), path, min_bytes=4)
    kinds = Counter((r.payload_bytes, r.record_type) for r in warc.page_records(spark, path).collect())
    assert kinds[(3, "revisit")] == 0 and kinds[(3, "response")] == 3 and kinds[(4, "revisit")] == 3
    path = scratch_dir(spark, "warc-test")
    warc.write(pages(spark).where("page_id = 77"), path)
    assert warc.page_records(spark, path).collect() == []


def test_archives_of_others():
    record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    packed = zlib.compressobj(wbits=31)
    member = packed.compress(record) + packed.flush()
    for data in (record * 3, member * 3, warc._member(record, 1) * 3, record + member + warc._member(record, 1)):
        for ask in (True, False):
            own = [block() if ask else None for _, block in warc._Archive(io.BytesIO(data)).records()]
            assert own == ([b"hello"] * 3 if ask else [None] * 3)
    with pytest.raises(ValueError):
        list(warc._Archive(io.BytesIO(record[:30])).records())


def test_broken_payloads_are_noticed(spark):
    path = scratch_dir(spark, "warc-test")
    bad = pages(spark, [(1, "http://a/", "x")])
    warc.register(spark)
    bad.select(F.lit("response").alias("record_type"), F.lit("urn:page:1").alias("record_id"), F.col("url").alias("target_uri"),
               F.lit("2024").alias("date"), F.lit(None).cast("string").alias("refers_to"), F.sha1(F.lit("other")).alias("payload_sha1"),
               F.lit(1).cast("long").alias("payload_length"), F.col("html").cast("binary").alias("payload")).write.format("warc").mode("append").save(path)
    with pytest.raises(Exception, match="differ"):
        warc.page_records(spark, path).collect()


# --- URL filter -----------------------------------------------------------------------------------------------------------

def brute_verdict(url, rules):
    rest = url.partition("://")[2] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].partition("#")[0].partition("?")[0]
    fit = [(len(h + p), len(h), v, h + p) for v, h, p in rules if v and h is not None and p is not None
           and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_urls(spark):
    rules = [*urls.RULES, ("block", "a.b", "/cc"), ("allow", "b", "/ccdd"), ("block", "tie", "/x"), ("allow", "tie", "/x"), ("block", None, "/")]
    given = [None, "", "nothing", "http://", "http://EXAMPLE.org/es/1", "http://x.example.org/en/123?q=/es/", "https://example.org?x#y",
             "a://b.com/fr/", "a://.com/de/z#/fr/", "x://notexample.org/es/", "p://é.com/fr/É", "http://a.b/ccdd", "q://tie/x", "q://T.TIE/xy",
             "http://a.com/de", "http://h/://example.org/es/", "http://user@org:80/", "http://org", "http://org/"] * 2
    df = spark.createDataFrame([(k if k else None, u, "extra", "extra") for k, u in enumerate(given)], "page_id long, url string, host string, row string").repartition(3)
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    want = [(k if k else None, *brute_verdict(u, rules)) for k, u in enumerate(given)]
    assert found(urls.judge(df, table)) == sorted(want, key=repr)
    assert {r.verdict for r in urls.judge(df, table.where("host = ''"), "block").collect()} == {"block"}
    assert urls.judge(df.where("page_id < 0"), table).collect() == []


# --- vectors --------------------------------------------------------------------------------------------------------------

def test_embeddings(spark):
    rng = np.random.default_rng(1)
    c = rng.normal(size=(20, 16))
    x = np.concatenate([c[rng.integers(0, 20, 400)] + rng.normal(size=(400, 16)) * 0.12, c[0] + rng.normal(size=(200, 16)) * 0.08]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [
        (5000, None), (5001, [0.0] * 16), (5002, [float("nan")] + [1.0] * 15), (5003, [None] + [1.0] * 15), (5004, [float("inf")] * 16),
        (5005, x[3].tolist()), (5006, x[3].tolist()), (5006, (2 * x[3]).tolist()), (None, x[450].tolist()), (5007, [1.0, 2.0]), (5008, [1.0, 2.0]), (5009, [])]
    good = [k for k, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    linked = []
    for a in good:
        for b in good:
            if a != b and len(rows[a][1]) == len(rows[b][1]):
                p, q = np.array(rows[a][1]), np.array(rows[b][1])
                if p @ q / np.linalg.norm(p) / np.linalg.norm(q) >= 0.95:
                    linked.append((a, b))
    of = brute_components([i for i, _ in rows], linked)
    count = Counter(a for a, _ in linked)
    want = [(i, count[k], of[k], i is not None and i == of[k]) for k, (i, _) in enumerate(rows)]
    df = spark.createDataFrame([(*r, "extra", "extra") for r in rows], "vec_id long, embedding array<float>, node string, vec string").repartition(3)
    got = embeddings.near_duplicates(df, shard_rows=60)
    assert found(got.select("vec_id", "n_links", "component_id", "kept")) == sorted(want, key=repr)
    audited = got.where("audited_links is not null").agg(F.sum("n_links"), F.sum("audited_links")).first()
    assert audited[0] == audited[1] > 0
    assert embeddings.near_duplicates(df.where("vec_id < 0")).collect() == []


def brute_links(x):
    y = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    return ((y @ y.T >= 0.95).sum(axis=1) - 1).tolist()


def test_groups_of_near_copies_are_no_islands(spark):
    rng = np.random.default_rng(8)
    x = (np.repeat(rng.normal(size=(20, 64)), 60, axis=0) + rng.normal(size=(1200, 64)) * 0.1).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)
    got = embeddings.near_duplicates(df).orderBy("vec_id").collect()
    assert [r.n_links for r in got] == brute_links(x) == [59] * 1200
    assert [r.component_id for r in got] == [60 * (i // 60) for i in range(1200)]


def test_neighbours_along_the_centres_axis(spark):
    """Vectors that drift along one arc: their links cross the planes between centres as steeply as can be."""
    rng = np.random.default_rng(9)
    at = np.sort(rng.uniform(0, np.pi, 600))
    x = rng.normal(size=(600, 64)) * 0.002
    x[:, 0] += np.cos(at)
    x[:, 1] += np.sin(at)
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)
    for options in ({"shard_rows": 60}, {"shard_rows": 60, "max_centers": 3, "query_rows": 250}):  # the second splits shards
        got = embeddings.near_duplicates(df, **options).orderBy("vec_id").collect()
        assert [r.n_links for r in got] == brute_links(x)
        assert all(r.audited_links in (None, r.n_links) for r in got)


# --- quality ----------------------------------------------------------------------------------------------------------------

def test_quality(spark, root):
    docs, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in scored if r.held_out]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9
    swapped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.score(docs, swapped).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-12 for r in scored)


def test_quality_edges(spark):
    docs = documents(spark, awkward())
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (7, 1), (7, 0), (None, 1), (9, None)], "doc_id long, quality int")
    got = quality.score(docs, labels).collect()
    assert len(got) == len(awkward()) and all(0 <= r.score <= 1 for r in got)
    assert {round(r.score, 9) for r in quality.score(docs, labels.where("quality = 5")).collect()} == {0.7}
    assert quality.score(empty(spark), labels).collect() == []


def test_pairs_order_rows():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (x @ [2.0, -1.0, 0.0] + rng.normal(size=400) * 0.1 > 0).astype(int)
    w = quality.fit_pairs(x, y, pairs=20_000)
    assert w[0] > 0 > w[1] and abs(w[2]) < 0.5 * abs(w[1])


def test_quality_learns_from_every_label(spark, monkeypatch):
    # One label in sixteen is 1, and groups are small; what a group lacks is held by several.
    monkeypatch.setattr(quality, "GROUP_ROWS", 50)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1600, len(quality.FEATURES)))
    y = (np.arange(1600) % 16 == 0).astype(int)
    x[:, 0] += 2.0 * y
    rows = spark.createDataFrame([([float(v) for v in a], int(b), 1 + i % 3) for i, (a, b) in enumerate(zip(x, y))],
                                 "x array<double>, quality int, n long")
    groups = quality.learning_groups(rows, 100, 1500)
    held = [np.frombuffer(r.rows).reshape(-1, 3 + x.shape[1]) for r in groups.collect()]
    assert len(held) == 32 and sum((h[:, 0] * h[:, 1]).sum() for h in held) == sum(1 + i % 3 for i in range(1600))
    for number, h in enumerate(held):
        good, bad, weight = quality.group_pairs(number, h[:, 1], h[:, 2])
        assert set(good) | set(bad) == set(range(len(h))) and (h[good, 2] == 1).all() and (h[bad, 2] == 0).all()
    w = quality.fit(rows)
    whole = np.repeat(np.arange(1600), 1 + np.arange(1600) % 3)
    mean, dev = x[whole].mean(axis=0), x[whole].std(axis=0)
    want = quality.fit_pairs((x[whole] - mean) / dev, y[whole]) / dev
    assert np.abs(w - want).max() < 0.25 and w[0] > 4 * np.abs(w[1:]).max()
    for share in (0.0, 0.1, 15 / 16, 1.0):
        got = quality.weighted_quantile(rows.select(F.col("x")[0].alias("u"), "n"), "u", "n", share, bins=4)
        assert got == pytest.approx(np.quantile(x[whole, 0], share), abs=1e-12)


def test_quality_has_no_bound_on_labels(spark):
    # The rows that a sample of 20,000 by hash would take look one way, 20,000 others the other way.
    ids = spark.range(40_000).select(F.col("id").alias("doc_id")).where(~quality.held_out(F.col("doc_id")))
    order = F.row_number().over(W.orderBy(F.xxhash64("doc_id")))
    seen = ids.withColumn("r", order)
    docs = seen.withColumn("text", F.when((F.col("r") <= 20_000) | (F.col("r") % 2 == 0), F.lit("a b c")).otherwise(F.lit("| | |! # 9")))
    labels = docs.select("doc_id", (F.col("text") == "a b c").cast("int").alias("quality"))
    got = quality.score(docs.select("doc_id", "text"), labels).join(docs, "doc_id").groupBy("text").agg(F.min("score"), F.max("score"))
    found = {r[0]: r[1:] for r in got.collect()}
    assert found["a b c"][0] > found["| | |! # 9"][1]


# --- registered queries and the pipeline ------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_registered(spark, root, name):
    out = queries.queries()[name](spark, root)
    rows = [tuple(r) for r in out.collect()]
    assert rows
    if name in queries.oracle_sql():
        want = database(root).execute(queries.oracle_sql()[name])
        names = [d[0] for d in want.description]
        assert sorted(names) == sorted(out.columns)
        order = [out.columns.index(n) for n in names]
        assert sorted(tuple(canon(r[i]) for i in order) for r in rows) == sorted(tuple(map(canon, r)) for r in want.fetchall())


def test_pipeline_against_brute_force(spark, root):
    """Each stage's rows against its own input; verdicts of the robust estimates are taken from the operator."""
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    (_, rules), (_, near), (_, passages), (_, private), (_, pack) = corpus_pipeline.STAGES
    kept = rules(spark, docs, root).select(columns)
    judged = {r.doc_id for r in outliers.judged(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == judged and 0.5 * docs.count() < len(judged) < docs.count()
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    fps = [simhash.fingerprint(t.encode()) for _, t in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3]
    stay = set(brute_components([i for i, _ in rows], linked))
    unique = near(spark, kept, root).cache()
    assert unique.columns == columns and {r.doc_id for r in unique.collect()} == stay
    rows = [(r.doc_id, r.text) for r in unique.collect()]
    cut = passages(spark, unique, root).cache()
    assert cut.columns == columns
    want = {r[0]: r[3] for r in brute_removals(rows)}
    for r in cut.collect():
        assert hashlib.sha256(b" ".join(r.text.encode().split())).hexdigest() == want[r.doc_id] and r.n_chars == len(r.text)
    clean = private(spark, cut, root).cache()
    assert clean.columns == columns
    before = {r.doc_id: r.text for r in cut.collect()}
    for r in clean.collect():
        assert not brute_spans(r.text) and (r.text == before[r.doc_id]) == (not brute_spans(before[r.doc_id]) and "[OTHER]" not in r.text)
    final = pack(spark, clean, root)
    # Which pieces share a sequence depends on how tasks deal them out.
    placed = ["sequence_id", "offset"]
    assert found(final.drop(*placed)) == found(corpus_pipeline.run(spark, root).drop(*placed))
    assert {r.doc_id for r in final.collect()} == stay


def test_pipeline_takes_awkward_documents(spark):
    docs = documents(spark, awkward()).select("doc_id", "text", "lang", "source", "n_chars")
    for rows in (docs, docs.where("doc_id < 0")):
        out = rows
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, "")
        assert (out.count() > 0) == (rows is docs)
