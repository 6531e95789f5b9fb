"""Language identification by rank-order profiles of character n-grams and their out-of-place distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from millrace.llm.common import slices, small_batches, table

RANKS = 300  # n-grams of a profile, of a language or a document
LANGUAGES = 1000  # learned values whose profiles (a few kilobytes each) may reach the driver and the tasks
BLANK = 0x20
HELD = 1 << 20  # distinct n-grams that a task counts before it hands them on
UNKNOWN = "und"


def grams(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Per text its n-grams of one to three characters as numbers, three code points of 21 bits each.

    Letters are lower-cased; anything else ends a word, and words have one blank on both sides. An n-gram has a letter
    in it and no blank inside. Shorter n-grams have zeros in front, so numbers are exact.
    """
    for text in texts:
        point = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kinds, which = np.unique(point, return_inverse=True)
        letter = np.array([chr(c).isalpha() for c in kinds.tolist()])[which]
        x = np.where(letter, point, BLANK).astype(np.int64)
        x = x[letter | np.append(True, letter[:-1])]  # one blank between words
        two = x[:-1] << 21 | x[1:]
        three = two[:-1] << 21 | x[2:]
        yield np.concatenate([x[x != BLANK], two[two != (BLANK << 21 | BLANK)], three[x[1:-1] != BLANK]])


def counted(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and how often each occurs."""
    own = np.sort(found)
    first = np.flatnonzero(np.diff(own, prepend=-1))
    return own[first], np.diff(np.append(first, len(own)))


def language_grams(labelled: DataFrame) -> DataFrame:
    """Rows (lang, gram, n) over all texts of ``labelled`` (lang, text): combined inside each task before the shuffle."""
    def rows(held):
        for lang, (gram, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)], ["lang", "gram", "n"])

    def run(batches):
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for some in slices(batch, "text"):
                own: dict[str, list] = {}
                for lang, g in zip(some.column("lang").to_pylist(), grams(some.column("text").to_pylist())):
                    own.setdefault(lang, []).append(g)
                for lang, parts in own.items():
                    gram, n = counted(np.concatenate(parts))
                    if lang in held:
                        both, at = np.unique(np.concatenate([held[lang][0], gram]), return_inverse=True)
                        gram, n = both, np.bincount(at, np.concatenate([held[lang][1], n])).astype(np.int64)
                    held[lang] = gram, n
                if sum(len(g) for g, _ in held.values()) > HELD:
                    yield from rows(held)
                    held = {}
        yield from rows(held)

    slim = small_batches(labelled).where("lang is not null and text is not null").select("lang", "text")
    return slim.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def profiles(labelled: DataFrame, ranks: int = RANKS) -> DataFrame:
    """Rows (lang, gram, place): the ``ranks`` most frequent n-grams per language, ties in order of the n-gram."""
    order = W.Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    placed = language_grams(labelled).withColumn("place", F.row_number().over(order) - 1)
    return placed.where(F.col("place") < ranks).select("lang", "gram", "place")


class Profiles:
    """Profiles of all languages, by n-gram: which languages have it, and at which place."""

    def __init__(self, rows: list[tuple[str, int, int]], ranks: int):
        self.ranks, self.langs = ranks, sorted({r[0] for r in rows})
        number = {lang: k for k, lang in enumerate(self.langs)}
        entries = np.array(sorted((g, number[lang], place) for lang, g, place in rows), dtype=np.int64).reshape(-1, 3)
        self.gram, self.first = np.unique(entries[:, 0], return_index=True)
        self.size = np.diff(np.append(self.first, len(entries)))
        self.lang, self.place = entries[:, 1], entries[:, 2]

    def distances(self, found: np.ndarray) -> tuple[np.ndarray, int]:
        """Out-of-place distance of a text's n-grams to each language, and the largest possible one.

        A text's n-grams are ranked by how often they occur, ties in order of the n-gram. Each of the first ``ranks``
        adds by how many places the language ranks it elsewhere; one that the language lacks adds ``ranks``.
        """
        gram, n = counted(found)
        top = gram[np.argsort(-n, kind="stable")[:self.ranks]]
        at = np.minimum(np.searchsorted(self.gram, top), len(self.gram) - 1)
        rank = np.flatnonzero(self.gram[at] == top)
        size = self.size[at[rank]]
        entry = np.repeat(self.first[at[rank]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        apart = np.abs(self.place[entry] - np.repeat(rank, size)) - self.ranks
        most = self.ranks * len(top)
        return most + np.bincount(self.lang[entry], apart, len(self.langs)).astype(np.int64), most

    def predict(self, found: np.ndarray) -> tuple[str, float]:
        if not len(found) or not self.langs:
            return UNKNOWN, 0.0
        apart, most = self.distances(found)
        best = int(np.argmin(apart))
        rival = int(np.delete(apart, best).min()) if len(apart) > 1 else most
        total = int(apart[best]) + rival
        return self.langs[best], rival / total if total else 0.5


def learned(labelled: DataFrame, ranks: int = RANKS, max_languages: int = LANGUAGES) -> Profiles:
    """The profiles of ``labelled`` (lang, text): ``ranks`` rows per language reach the driver.

    More than ``max_languages`` values of ``lang`` are no languages, and an error.
    """
    rows = profiles(labelled, ranks).limit(max_languages * ranks + 1).collect()
    out = Profiles([tuple(r) for r in rows], ranks)
    if len(rows) > max_languages * ranks or len(out.langs) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    return out


def identified(docs: DataFrame, known: Profiles) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, of ``text`` alone.

    The language is the one with the least distance, of equal ones the first by name; the score is the runner-up's
    distance divided by the sum of both: 1 at no distance, 0.5 if nothing tells them apart. With a single language the
    largest possible distance takes the runner-up's part. Null texts, texts without a letter, and any text if nothing
    was learned, are ``und`` with score 0. Whole texts count, whatever their length. All rows and other columns stay;
    columns of the two new names are replaced. An empty table stays empty.
    """
    @F.pandas_udf("lang string, score double")
    def predict(texts):
        import pandas as pd

        return pd.DataFrame([known.predict(g) for g in grams(texts)], columns=["lang", "score"], index=texts.index)

    own = [f"`{c}`" for c in docs.columns if c not in ("lang_pred", "score")]
    guess = predict(F.coalesce("text", F.lit("")))
    return small_batches(docs).select(*own, guess.alias("__guess")).select(
        *own, F.col("__guess.lang").alias("lang_pred"), F.col("__guess.score").alias("score"))


def held_out() -> Column:
    """The contract's held-out rows; a null id is none of them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def query(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "lang", "text", held_out().alias("held_out"))
    known = learned(docs.where("not held_out"))
    return identified(docs.select(F.col("doc_id").cast("long"), "held_out", "text"), known).drop("text")
