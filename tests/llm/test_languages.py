"""Language identification against a plain reading of the rank-order method, and its accuracy on held-out rows."""

import zlib
from collections import Counter, defaultdict

import pytest

from millrace.llm import languages
from tests.llm.corpus import awkward, documents, empty


def brute_grams(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    out = Counter()
    for w in words:
        out.update(w)
    line = " " + " ".join(words) + " "
    out.update(a + b for a, b in zip(line, line[1:]) if a + b != "  ")
    out.update(a + b + c for a, b, c in zip(line, line[1:], line[2:]) if b != " ")
    return out


def brute_order(counts):
    """Most frequent first, ties by length and code points: shorter n-grams have zeros in front."""
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], len(x[0]), [ord(c) for c in x[0]]))]


def brute_predictions(rows, ranks=300):
    learned = defaultdict(Counter)
    for doc_id, text, lang in rows:
        if lang is not None and text is not None and not held(doc_id):
            learned[lang].update(brute_grams(text))
    places = {k: {g: r for r, g in enumerate(brute_order(c)[:ranks])} for k, c in learned.items() if c}
    out = []
    for doc_id, text, _ in rows:
        top = brute_order(brute_grams(text))[:ranks]
        if not top or not places:
            out.append((doc_id, held(doc_id), "und", 0.0))
            continue
        apart = sorted((sum(abs(p[g] - r) if g in p else ranks for r, g in enumerate(top)), k) for k, p in places.items())
        rival = apart[1][0] if len(apart) > 1 else ranks * len(top)
        total = apart[0][0] + rival
        out.append((doc_id, held(doc_id), apart[0][1], rival / total if total else 0.5))
    return sorted(out, key=repr)


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def saved(spark, rows, folder, partitions=3):
    docs = documents(spark, rows, partitions)
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return [(r.doc_id, r.text, r.lang) for r in docs.collect()]


def test_query_on_awkward_rows(spark, tmp_path):
    rows = saved(spark, awkward() + [(900, "12 34 !?"), (901, "Ünïcödé ǅ ÉÉ"), (902, "漢字かな"), (903, "İstanbul")], tmp_path)
    got = languages.query(spark, str(tmp_path))
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_predictions(rows)


def test_query_on_the_smallest_table(spark, root):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in languages.query(spark, root).collect()), key=repr) == brute_predictions(rows)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    unseen = [r for r in languages.query(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert len(unseen) > 200
    assert sum(r.lang_pred == truth[r.doc_id] for r in unseen) >= 0.98 * len(unseen)


def test_counts_handed_on_early_add_up(spark, monkeypatch):
    docs = documents(spark, awkward())
    want = sorted(map(tuple, languages.language_grams(docs).collect()))
    monkeypatch.setattr(languages, "slices", lambda batch, text: [batch.slice(i, 1) for i in range(batch.num_rows)])
    monkeypatch.setattr(languages, "HELD", 50)
    assert sorted(map(tuple, languages.language_grams(docs).collect())) == want


def test_nothing_learned_and_too_much(spark):
    none = empty(spark)
    known = languages.learned(none)
    assert languages.identified(none, known).collect() == []
    docs = documents(spark, [(1, "a text"), (2, None)])
    assert {(r.lang_pred, r.score) for r in languages.identified(docs, known).collect()} == {("und", 0.0)}
    with pytest.raises(ValueError):
        languages.learned(documents(spark, [(i, "words of a text") for i in range(9)]), max_languages=1)


def test_other_columns_stay(spark):
    docs = documents(spark, [(1, "one text"), (1, "one text"), (2, "")])
    out = languages.identified(docs, languages.learned(docs))
    assert out.columns == [*docs.columns, "lang_pred", "score"]
    assert out.count() == 3
