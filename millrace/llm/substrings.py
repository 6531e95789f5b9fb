"""Removal of repeated passages, found by recompression: word sequences shrink in rounds that name runs and pairs."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import raw, slices, small_batches, table
from millrace.session import discard, staged

WINDOW = 50
ROUNDS = 6  # of pairs: letters then cover some five words, and a window of 50 words still holds several
RUN_ROUNDS = (0, 3)  # rounds that name runs before pairs

WORD_AND_SPACE = re.compile(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], dtype=np.uint64)


def mix(a: np.ndarray, b) -> np.ndarray:
    """A 64-bit name of a pair of names."""
    x = (a ^ (a >> np.uint64(29))) * _MIX[1] + np.atleast_1d(np.asarray(b, dtype=np.uint64)) * _MIX[0] + _MIX[3]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class Sequence:
    """Symbols of many documents in a row, each with the words it needs.

    ``lo`` and ``hi`` bound the words that decide a symbol: any text that has these words has the symbol at that place.
    Documents are separated by a slot that never merges and that no window contains, so what depends on a document's
    edge is never taken for a property of a window.
    """

    def __init__(self, names: np.ndarray, edge: np.ndarray):
        self.name, self.edge = names, edge
        self.lo = np.arange(len(names), dtype=np.int64)
        self.hi = self.lo + 1

    def runs(self) -> None:
        """Names every maximal run of one symbol; a symbol's neighbours decide where its run ends."""
        n, edge = self.name, self.edge
        start = np.ones(len(n), dtype=bool)
        start[1:] = (n[1:] != n[:-1]) | edge[1:] | edge[:-1]
        first = np.flatnonzero(start)
        size = np.diff(np.append(first, len(n)))
        last = first + size - 1
        name = n[first]
        longer = size > 1
        name[longer] = mix(name[longer], size[longer].astype(np.uint64))
        lo, hi = self.lo[np.maximum(first - 1, 0)], self.hi[np.minimum(last + 1, len(n) - 1)]
        self.name, self.edge = name, edge[first]
        self.lo, self.hi = np.where(self.edge, self.lo[first], lo), np.where(self.edge, self.hi[first], hi)

    def pairs(self, round_no: int) -> None:
        """Names every pair of a left and a right letter. Hashes split the letters anew in each round, so about a
        quarter of the neighbours join; a letter that stays single depends on the neighbour it might have joined."""
        n, edge = self.name, self.edge
        right = (mix(n, np.uint64(round_no)) >> np.uint64(63)).astype(bool)
        joins = np.zeros(len(n), dtype=bool)
        joins[:-1] = ~right[:-1] & right[1:] & ~edge[:-1] & ~edge[1:]
        joined = np.zeros(len(n), dtype=bool)
        joined[1:] = joins[:-1]
        following, before = np.minimum(np.arange(len(n)) + 1, len(n) - 1), np.maximum(np.arange(len(n)) - 1, 0)
        reach = joins | (~right & ~edge)
        hi = np.where(reach, self.hi[following], self.hi)
        lo = np.where(~joined & right & ~edge, self.lo[before], self.lo)
        keep = ~joined
        name = np.where(joins, mix(n, n[following]), n)[keep]
        self.name, self.edge, self.lo, self.hi = name, edge[keep], lo[keep], hi[keep]


def _leftmost_least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Index of the least value in each range first..last (ends included), the leftmost of equal ones."""
    out, size = np.empty(len(first), dtype=np.int64), last - first + 1
    best, width = np.arange(len(values)), 1
    while len(size) and width <= size.max():
        now = (size >= width) & (size < 2 * width)
        a, b = best[first[now]], best[last[now] - width + 1]
        out[now] = np.where(values[a] <= values[b], a, b)
        if 2 * width > len(values):
            break
        a, b = best[:len(best) - width], best[width:]
        best, width = np.where(values[a] <= values[b], a, b), 2 * width
    return out


def anchors(names: np.ndarray, edge: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """(symbol, first, n): runs of ``n`` windows, from slot ``first`` on, that share a symbol.

    A window's symbol is, of the highest level's symbols whose deciding words it contains, the one with the least name,
    and of equal ones the leftmost; where it contains none, the level below is asked, down to single words. Equal
    windows therefore have equal symbols at the same place. ``starts`` marks the slots where a window of words of one
    document starts.
    """
    seq, levels = Sequence(names, edge), []
    levels.append((seq.name, seq.lo, seq.hi, seq.edge))
    for r in range(ROUNDS):
        if r in RUN_ROUNDS:
            seq.runs()
        seq.pairs(r)
        levels.append((seq.name, seq.lo, seq.hi, seq.edge))
    todo = at = np.flatnonzero(starts)
    symbol, owner = np.zeros(len(at), dtype=np.uint64), np.zeros(len(at), dtype=np.int64)
    where = np.arange(len(at))
    for level in range(ROUNDS, -1, -1):
        name, lo, hi, is_edge = levels[level]
        inner = np.flatnonzero(~is_edge & (hi - lo <= window))
        # Bounds never fall from one symbol to the next, so a window's symbols are neighbours.
        first, last = np.searchsorted(lo[inner], todo), np.searchsorted(hi[inner], todo + window, side="right") - 1
        found = first <= last
        own = mix(name[inner], np.uint64(level))
        best = _leftmost_least(own, first[found], last[found])
        symbol[where[found]], owner[where[found]] = own[best], level * len(names) + inner[best]
        todo, where = todo[~found], where[~found]
        if not len(todo):
            break
    new = np.ones(len(at), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (np.diff(at) != 1)
    begin = np.flatnonzero(new)
    return symbol[begin], at[begin], np.diff(np.append(begin, len(at)))


class Hashes:
    """128-bit hashes of any word ranges of a sequence, by prefix sums of two polynomials modulo 2**64."""

    BASES = (0x8BB84B93962EACCB, 0x2545F4914F6CDD1B)

    def __init__(self, names: np.ndarray):
        self.sums, self.inverse = [], []
        for k, base in enumerate(self.BASES):
            powers, back = (np.full(len(names) + 1, b, dtype=np.uint64) for b in (base, pow(base, -1, 1 << 64)))
            powers[0] = back[0] = 1
            powers, back = np.cumprod(powers), np.cumprod(back)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(names, np.uint64(k)) * powers[:-1])]))
            self.inverse.append(back)

    def of(self, first: np.ndarray, size) -> list[np.ndarray]:
        return [((s[first + size] - s[first]) * i[first]).view(np.int64) for s, i in zip(self.sums, self.inverse)]


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def _laid_out(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(names, edge, begin, end): word names of the texts, a slot before and after each, and where texts begin and end."""
    hash_of = xxhash.xxh64_intdigest
    sizes = np.array([len(w) for w in texts], dtype=np.int64)
    begin = np.cumsum(sizes + 1) - sizes
    names = np.zeros(int(sizes.sum()) + len(texts) + 1, dtype=np.uint64)
    for w, b in zip(texts, begin):
        names[b:b + len(w)] = np.fromiter(map(hash_of, w), np.uint64, len(w))
    edge = np.zeros(len(names), dtype=bool)
    edge[begin - 1] = edge[-1] = True
    return names, edge, begin, begin + sizes


def _keyed(docs: DataFrame) -> DataFrame:
    return small_batches(docs).select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")


ANCHOR = "symbol long, ctx1 long, ctx2 long, doc_id long, text_hash long, first int, n int"


def anchor_rows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Runs of windows with one symbol: the symbol, a hash of all words that the windows cover, and where they are."""
    def run(batches):
        for batch in batches:
            for rows in slices(batch, "text", 1 << 20):
                names, edge, begin, end = _laid_out([words_of(t) for t in raw(rows.column("text"))])
                starts = np.zeros(len(names), dtype=bool)
                for b, e in zip(begin, end):
                    starts[b:max(b, e - window + 1)] = True
                symbol, first, n = anchors(names, edge, starts, window)
                ctx = Hashes(names).of(first, n + window - 1)
                doc = np.searchsorted(begin, first, side="right") - 1
                owner = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(symbol.view(np.int64)), pa.array(ctx[0]), pa.array(ctx[1]), rows.column("doc_id").take(owner),
                     rows.column("text_hash").take(owner), pa.array((first - begin[doc]).astype(np.int32)),
                     pa.array(n.astype(np.int32))], ["symbol", "ctx1", "ctx2", "doc_id", "text_hash", "first", "n"])

    return _keyed(docs).where("doc_id is not null").mapInArrow(run, ANCHOR)


def window_rows(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(w1, w2, doc_id, text_hash, first) for the windows of ``parts``, an array of (first, n), of each text."""
    def run(batches):
        for batch in batches:
            for rows in slices(batch, "text", 1 << 20):
                names, _, begin, _ = _laid_out([words_of(t) for t in raw(rows.column("text"))])
                parts = rows.column("parts").to_pylist()
                first = [np.arange(p["first"], p["first"] + p["n"]) for own in parts for p in own]
                doc = np.repeat(np.arange(len(parts)), [sum(p["n"] for p in own) for own in parts])
                at = np.concatenate(first) if first else np.array([], dtype=np.int64)
                w1, w2 = Hashes(names).of(begin[doc] + at, window)
                owner = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1), pa.array(w2), rows.column("doc_id").take(owner), rows.column("text_hash").take(owner),
                     pa.array(at.astype(np.int32))], ["w1", "w2", "doc_id", "text_hash", "first"])

    return texts.mapInArrow(run, "w1 long, w2 long, doc_id long, text_hash long, first int")


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, parts): the word ranges (first, last; last excluded) of each text that windows cover whose
    words also start a window in a document with a smaller id.

    Only symbols of several documents go on. Runs of windows whose whole context a smaller document has are decided
    by that context; of each other context one run is left, and its windows are compared one by one. All hashes of
    words that decide are 128 bits long. Groups are combined before they are shuffled, and joins are between written
    tables, so a passage that a third of the documents share is spread over tasks.
    """
    found = staged(anchor_rows(docs, window), "repeat-anchors")
    shared = found.groupBy("symbol").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = staged(shared.where("least < most").select("symbol", "least"), "repeat-symbols")
    runs = staged(found.join(shared, "symbol"), "repeat-runs")
    discard(found, shared)
    key = ["symbol", "ctx1", "ctx2"]
    contexts = staged(runs.groupBy(*key).agg(F.min("doc_id").alias("holder")), "repeat-contexts")
    several = contexts.groupBy("symbol").agg(F.count("*").alias("contexts")).where("contexts > 1").select("symbol")
    known = staged(contexts.join(several.withColumn("open", F.lit(True)), "symbol", "left"), "repeat-known")
    decided = runs.join(known, key)
    whole = decided.where("doc_id > holder").select(
        "doc_id", "text_hash", "first", (F.col("first") + F.col("n") + window - 1).alias("last"))
    unsure = decided.where("doc_id = holder and open").groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("first", "n")).alias("parts"))
    unsure = staged(unsure, "repeat-open")
    windows = staged(window_rows(_keyed(docs).join(unsure, ["doc_id", "text_hash"]), window), "repeat-windows")
    least = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("holder"), F.max("doc_id").alias("most"))
    least = staged(least.where("holder < most").select("w1", "w2", "holder"), "repeat-holders")
    single = windows.join(least, ["w1", "w2"]).where("doc_id > holder").select(
        "doc_id", "text_hash", "first", (F.col("first") + window).alias("last"))
    return whole.unionByName(single).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("first", "last"))).alias("parts"))


def _kept(n: int, parts: list | None) -> np.ndarray:
    cover = np.zeros(n + 1, dtype=np.int64)
    for p in parts or ():
        cover[p["first"]] += 1
        cover[p["last"]] -= 1
    return np.cumsum(cover[:n]) == 0


def _with_parts(docs: DataFrame, window: int) -> DataFrame:
    found = staged(repeats(docs, window), "repeat-parts").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("parts").alias("__parts"))
    same = (F.col("doc_id").cast("long") == F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    return docs.join(found, same, "left").drop("__id", "__hash")


def removals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256), one per row of ``docs`` (doc_id, text).

    A word goes when a window of ``window`` words covers it that also starts in a document with a smaller id; windows
    are judged on the whole input. Rows with one id are one document to each other: none removes words of another.
    Rows without an id lose no words and take none. Null and empty texts and texts shorter than a window are kept
    whole. An empty table gives an empty result. Other columns are ignored.
    """
    def run(batches):
        for batch in batches:
            for rows in slices(batch, "text"):
                out = []
                for text, parts in zip(raw(rows.column("text")), rows.column("__parts").to_pylist()):
                    words = words_of(text)
                    kept = _kept(len(words), parts)
                    left = words if not parts else [w for w, k in zip(words, kept) if k]
                    out.append((len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()))
                n, gone, digest = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest)],
                    ["doc_id", "n_words", "n_removed", "kept_sha256"])

    slim = docs.select(F.col("doc_id").cast("long"), "text")
    return _with_parts(slim, window).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with those words cut out of ``text`` that ``removals`` removes, each with the white space after it.

    Texts without removed words stay as they are, and so do all other columns and rows.
    """
    @F.pandas_udf("string")
    def cut(texts, parts):
        return texts.combine(parts, lambda t, p: _cut(t, p) if t is not None and p is not None else t)

    return _with_parts(docs, window).withColumn(
        "text", F.when(F.col("__parts").isNull(), F.col("text")).otherwise(cut("text", "__parts"))).drop("__parts")


def _cut(text: str, parts) -> str:
    found = WORD_AND_SPACE.findall(text)
    kept = _kept(len(found), list(parts))
    return "".join([w for w, k in zip(found, kept) if k]).strip(" \t\n\r\v\f")


def query(spark: SparkSession, root: str) -> DataFrame:
    return removals(table(spark, root, "documents"))
