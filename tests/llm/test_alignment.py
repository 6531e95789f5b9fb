"""Cross-tokenizer alignment against brute force with plain calls of both libraries."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from millrace.llm import alignment
from tests.llm.corpus import awkward, documents, empty

TOK = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TOK.encode_special_tokens = True
PIECES = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
LETTER = {chr(b): b for b in VISIBLE} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in VISIBLE)}


def ends(parts):
    return np.cumsum([len(p) for p in parts]).tolist()


def brute_document(text):
    """(a, b, groups, links) by byte ranges, or nothing."""
    if not text:
        return [], [], [], []
    a = TOK.encode(" " + text, add_special_tokens=False).ids
    b = PIECES.encode(text)
    own_a = [bytes(LETTER[c] for c in TOK.id_to_token(i)) for i in a]
    own_b = [bytes([int(PIECES.id_to_piece(i)[3:5], 16)]) if PIECES.is_byte(i)
             else PIECES.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not (b"".join(own_a) == b"".join(own_b) == (" " + text).encode()):
        return [], [], [], []
    ea, eb = ends(own_a), ends(own_b)
    cuts = sorted(set(ea) & set(eb))
    groups, before = [], 0
    for c in cuts:
        groups.append(f"{','.join(str(i) for i, e in zip(a, ea) if before < e <= c)}|"
                      f"{','.join(str(i) for i, e in zip(b, eb) if before < e <= c)}")
        before = c
    links, j = [], 0
    for i, (end, part) in enumerate(zip(ea, own_a)):
        start = end - len(part)
        while eb[j] <= start:
            j += 1
        k = j
        while k < len(b) and eb[k] - len(own_b[k]) < end:
            links.append((a[i], b[k]))
            k += 1
    return a, b, groups, links


def brute(rows):
    all_of = [brute_document(t) for _, t in rows]
    count = Counter(p for *_, links in all_of for p in set(links))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    return sorted(((i, len(a), len(b), len(g), len(links), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "",
                    sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links))
                   for (i, _), (a, b, g, links) in zip(rows, all_of)), key=repr)


ODD = ["<|endoftext|> plain <s> </s> <unk> <0x0A>", "under▁score", "  two  spaces ", " ", "\n \n  x\t y", "naïve café 漢字 😀",
       "a" * 3000, "x" * 50 + " " * 50 + "y", "it's 12,345 {code} == ok;\r\n", "  hard spaces 　 ", "é é ﬁ",
       "\x00 nul", "tail ", "don't ▁ stop", "the the of the"]


def cases():
    rows = [r for r in awkward() if r[0] != 504] + [(800 + k, t) for k, t in enumerate(ODD)]
    return rows + [(504, "long " + "word " * 3000)]


@pytest.mark.parametrize("options", [{}, {"radices": 3, "limit": 300, "lanes": 2}])
def test_alignment(spark, options):
    rows = cases()
    got = alignment.alignment(documents(spark, rows), **options)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_many_short_texts_in_a_batch(spark, monkeypatch):
    rows = [(i, f"n{i % 700} m") for i in range(9000)]
    monkeypatch.setattr(alignment, "small_batches", lambda df: df)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    got = alignment.alignment(documents(spark, rows, 1)).collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_empty_table(spark):
    assert alignment.alignment(empty(spark)).collect() == []
    assert alignment.pair_counts(empty(spark)).collect() == []
    assert alignment.groups(empty(spark)).collect() == []


def test_pair_counts_and_groups(spark):
    rows = cases()
    docs = documents(spark, rows)
    found = [brute_document(t) for _, t in rows]
    count = Counter(p for *_, links in found for p in set(links))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    got = {(r.a, r.b): (r.documents, r.best) for r in alignment.pair_counts(docs, limit=500).collect()}
    assert got == {p: (n, n == top[p[0]]) for p, n in count.items()}
    assert sorted((r.doc_id or -1, r.groups) for r in alignment.groups(docs).collect()) == \
        sorted((i or -1, ";".join(g)) for (i, _), (_, _, g, _) in zip(rows, found))


def test_heaps_merge_in_passes():
    rng = np.random.default_rng(5)
    merger, want = alignment.Merger(), Counter()
    for _ in range(200):
        pairs = np.unique(rng.integers(0, 40_000, 3000))
        counts = rng.integers(1, 5, len(pairs))
        want.update(dict(zip(pairs.tolist(), counts.tolist())))
        merger.add(alignment.count_run(pairs, counts))
    assert max(len(p) for p in merger.passes) < alignment.FAN
    pairs, counts = (np.concatenate(c) for c in zip(*alignment.frames(merger.result())))
    assert dict(zip(pairs.tolist(), counts.tolist())) == want and (np.diff(pairs) > 0).all()


def test_query_on_the_smallest_table(spark, root):
    from millrace.llm.queries import queries

    rows = [tuple(r) for r in spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()]
    got = queries()["op12_alignment"](spark, root)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
    assert got.where(F.col("n_best") > F.col("n_links")).count() == 0
