"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import periodic
from tests.llm.corpus import awkward, documents, empty


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def brute_runs(words, least=12):
    """Every maximal stretch of each period; of equal stretches the least period."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = j
    return sorted((s, e - s, p) for (s, e), p in found.items())


def brute_planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    words = words if doc_id is None else brute_planted(doc_id, words)
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), max_size=4), st.sampled_from([2, 5, 12]))
def test_runs_of_small_alphabets(texts, least):
    got = [[tuple(r) for r in rows.tolist()] for rows in periodic.runs_of(texts, least)]
    assert got == [brute_runs(t, least) for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_runs_inside_runs(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(8):
        unit = [rng.randrange(5) for _ in range(rng.randint(1, 30))]
        inner = (unit * 9)[:rng.randint(12, 90)]
        texts.append([rng.randrange(99) for _ in range(rng.randint(0, 9))] + (inner * 3)[:rng.randint(20, 260)] + inner)
    texts += [[7] * 500, list(range(100)) * 4, [], [1]]
    got = [[tuple(r) for r in rows.tolist()] for rows in periodic.runs_of(texts)]
    assert got == [brute_runs(t) for t in texts]


def test_extensions_are_exact():
    rng = np.random.default_rng(3)
    fib = [0, 1]
    while len(fib) < 400:
        fib = fib + fib[:len(fib) - 1] if len(fib) > 2 else [0, 1, 0]
    for body in (rng.integers(0, 2, 400), np.array(fib[:400]), np.repeat(rng.integers(0, 3, 80), 5), np.zeros(400, int)):
        names = np.concatenate([[0], body, [0]]).astype(np.int64)
        edge = np.zeros(len(names), dtype=bool)
        edge[[0, -1]] = True
        grammar = periodic.Grammar(names, edge)
        assert len(grammar.name[-1]) <= periodic.TOP + 2
        i = rng.integers(1, 300, 600)
        j = i + rng.integers(1, 100, 600)
        for sign in (1, -1):
            want = []
            for x, y in zip(i, j):
                n = 0
                while not edge[x] and not edge[y] and names[x] == names[y]:
                    x, y, n = x + sign, y + sign, n + 1
                want.append(n)
            assert grammar.extension(i, j, sign).tolist() == want


def test_digests(spark):
    rows = [r for r in awkward() if r[0] != 504]  # brute force is quadratic
    rows += [(i, "a b c d e f g " * 9) for i in range(600, 640)] + [(700, "la " * 4000)]
    got = sorted((tuple(r) for r in periodic.digests(documents(spark, rows), rewrite=periodic.planted).collect()), key=repr)
    assert got == sorted((brute_row(i, t) for i, t in rows), key=repr)
    assert periodic.digests(empty(spark)).collect() == []
    assert periodic.periodic_runs(empty(spark)).collect() == []


def test_runs_and_collapsed_texts(spark):
    rows = [(1, "x  y\n" * 10 + "end"), (2, None), (3, "no run here"), (4, "a " * 12), (5, "")]
    runs = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.periodic_runs(documents(spark, rows)).collect()}
    assert runs == {1: [(0, 20, 2)], 2: [], 3: [], 4: [(0, 12, 1)], 5: []}
    docs = documents(spark, rows)
    out = periodic.collapsed(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "x  y\nend", 2: None, 3: "no run here", 4: "a", 5: ""}


def test_very_long_text_of_one_word():
    rows, = periodic.runs_of([["w"] * 300_000])
    assert rows.tolist() == [[0, 300_000, 1]]


def test_query(spark, root):
    from millrace.llm.queries import queries

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{root}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r) for r in queries()["op11_periodic"](spark, root).collect()}
    assert len(got) == len(docs) and sum(r[1] > 0 for r in got.values()) > 10
    short = [i for i, t in docs.items() if len((t or "").split()) < 1200]
    assert [got[i] for i in short] == [brute_row(i, docs[i]) for i in short]
