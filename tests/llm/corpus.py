"""Small corpora with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

from __future__ import annotations

import random

CLASHING = ["row", "fp", "spans", "parts", "kept", "rule", "n_words", "component", "first", "start", "x"]


def texts(seed: int, n: int = 60) -> list[str]:
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "Straße", "漢字", "a,", "b."]
    passages = [" ".join(rng.choices(words, k=rng.randint(48, 75))) for _ in range(4)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            parts.append(rng.choice(passages) if kind < 0.4 else "again " * rng.randint(1, 120) if kind < 0.5
                         else " ".join(rng.choices(words, k=rng.randint(1, 90))))
        out.append(rng.choice([" ", "\n", " \t\n"]).join(parts))
    return out


def documents(spark, rows, partitions: int = 3):
    """(doc_id, text) pairs as a documents table with extra columns."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    full = [(i, t, ["en", "de", None][k % 3], f"s{k % 2}", None if t is None else len(t), *["extra"] * len(CLASHING))
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, schema).repartition(partitions)


def awkward(seed: int = 1) -> list[tuple]:
    rows = list(enumerate(texts(seed)))
    return rows + [(500, None), (501, ""), (502, " \n\t"), (None, rows[3][1]), (None, None), (503, rows[5][1]),
                   (7, rows[7][1]), (7, rows[7][1]), (8, "another text of id 8"), (504, "long " + "word " * 30_000),
                   (505, rows[9][1].replace("w1", "w2"))]


def empty(spark):
    return documents(spark, [(1, "x")]).where("doc_id = 2")
