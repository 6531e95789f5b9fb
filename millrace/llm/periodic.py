"""Periodic stretches of words, found by longest common extensions over a run-length grammar of recompression."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import raw, slices, small_batches, table
from millrace.llm.substrings import WORD_AND_SPACE, mix, words_of

LEAST = 12  # words of the shortest run
TOP = 8  # symbols that a text may have on the grammar's highest level; extensions walk over them one by one
BLOCK = 1 << 20  # candidates looked at together, which bounds a task's memory
SLICE = 2 << 20  # bytes of text whose grammars are built together


class Grammar:
    """Run-length grammar of several texts in a row, each between two edge slots with names of their own.

    Levels alternate between blocks (maximal repetitions of one symbol become one) and pairs (a left letter and a right
    letter become one). Names are exact: equal names on a level stand for equal words. Symbol ``k`` of level ``v`` has
    the children ``lo[v][k]`` to ``hi[v][k]`` on the level below and the parent ``up[v][k]`` above.
    """

    def __init__(self, names: np.ndarray, edge: np.ndarray):
        own = names.astype(np.int32)
        own[edge] = -1 - np.arange(edge.sum())
        self.name, self.lo, self.hi, self.up, self.block = [own], [None], [None], [], [False]
        self.used = int(own.max(initial=0)) + 1
        rounds = 0
        while np.diff(np.flatnonzero(self.name[-1] < 0)).max(initial=0) > TOP + 1:
            self._blocks()
            self._pairs(rounds)
            rounds += 1

    def _rise(self, first: np.ndarray, name: np.ndarray, block: bool) -> None:
        size = len(self.name[-1])
        if len(first) == size:
            return
        starts = np.zeros(size, dtype=np.int32)
        starts[first] = 1
        self.up.append(np.cumsum(starts, dtype=np.int32) - 1)
        self.name.append(name.astype(np.int32))
        self.lo.append(first.astype(np.int32))
        self.hi.append(np.append(first[1:], size).astype(np.int32) - 1)
        self.block.append(block)

    def _named(self, name: np.ndarray, where: np.ndarray, keys: np.ndarray) -> np.ndarray:
        found, which = np.unique(keys, return_inverse=True)
        name[where] = self.used + which
        self.used += len(found)
        return name

    def _blocks(self) -> None:
        n = self.name[-1]
        start = np.ones(len(n), dtype=bool)
        start[1:] = n[1:] != n[:-1]
        first = np.flatnonzero(start)
        size = np.diff(np.append(first, len(n)))
        name, longer = n[first].astype(np.int64), size > 1
        self._rise(first, self._named(name, longer, name[longer] * (len(n) + 1) + size[longer]), True)

    def _pairs(self, round_no: int) -> None:
        n = self.name[-1]
        right = (mix(n.astype(np.uint64), np.uint64(round_no)) >> np.uint64(63)).astype(bool)
        joins = np.zeros(len(n), dtype=bool)
        joins[:-1] = ~right[:-1] & right[1:] & (n[:-1] >= 0) & (n[1:] >= 0)
        joined = np.zeros(len(n), dtype=bool)
        joined[1:] = joins[:-1]
        first = np.flatnonzero(~joined)
        name, both = n[first].astype(np.int64), joins[first]
        keys = name[both] * self.used + n[first[both] + 1]
        self._rise(first, self._named(name, both, keys), False)

    def extension(self, i: np.ndarray, j: np.ndarray, sign: int) -> np.ndarray:
        """How many words from slots ``i`` and ``j`` on agree, to the right (``sign`` 1) or to the left (-1).

        On the way up a query leaves a parent that it entered in its middle by one step, and rises as soon as both
        places begin a parent; it stops at symbols that differ. On the way down the children of two symbols that
        differ agree in at most one letter, or the shorter of two blocks. Slots are of one text, ``i`` before ``j``.
        """
        near, far = (self.lo, self.hi) if sign > 0 else (self.hi, self.lo)
        a, b = i.astype(np.int32), j.astype(np.int32)
        top = len(self.name) - 1
        stop = np.full(len(a), top, dtype=np.int32)
        active = np.arange(len(a))
        for v in range(top):
            x, y = a[active], b[active]
            up, name = self.up[v], self.name[v]
            px, py = up[x], up[y]
            begins = (near[v + 1][px] == x) & (near[v + 1][py] == y)
            left, other = np.abs(far[v + 1][px] - x) + 1, np.abs(far[v + 1][py] - y) + 1
            walks = ~begins & (name[x] == name[y])
            step = np.where(walks, sign * np.minimum(left, other), 0)
            x, y = x + step, y + step
            rises = begins | (walks & (left == other))
            ends = active[~rises]
            a[ends], b[ends], stop[ends] = x[~rises], y[~rises], v
            active = active[rises]
            a[active], b[active] = up[x[rises]], up[y[rises]]
        while len(active):
            active = active[self.name[top][a[active]] == self.name[top][b[active]]]
            a[active] += sign
            b[active] += sign
        down = np.flatnonzero(stop == top)
        for v in range(top - 1, -1, -1):
            x, y = near[v + 1][a[down]], near[v + 1][b[down]]
            step = np.where(self.name[v][x] == self.name[v][y], sign, 0)
            if self.block[v + 1]:
                step *= np.minimum(np.abs(far[v + 1][a[down]] - x), np.abs(far[v + 1][b[down]] - y)) + 1
            a[down], b[down] = x + step, y + step
            down = np.concatenate([down, np.flatnonzero(stop == v)])
        return (a - i) * sign


def _grid(sizes: np.ndarray, least: int):
    """Blocks (text, period, place) of candidates: for each period up to half a text, the places that are multiples of
    the shortest stretch of words that a run of this period has equal to the words a period later."""
    half = np.where(sizes >= least, sizes // 2, 0)
    text = np.repeat(np.arange(len(sizes)), half)
    period = np.arange(len(text)) - np.repeat(np.cumsum(half) - half, half) + 1
    pace = np.maximum(period, least - period)
    counts = (sizes[text] - 1 - period) // pace + 1
    ends = np.cumsum(counts)
    at = 0
    while at < len(text):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, side="right")))
        own = counts[at:stop]
        place = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        yield np.repeat(text[at:stop], own), np.repeat(period[at:stop], own), place * np.repeat(pace[at:stop], own)
        at = stop


def _least_periods(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], period[new]


def runs_of(texts: list[list], least: int = LEAST) -> list[np.ndarray]:
    """Per text (a list of words) its runs, an array of rows (start, length, period) in order of start and period.

    A run has ``least`` words and two periods at least, its smallest period, and no neighbour that extends it. Each one
    holds a grid candidate of its period whose two words are equal; extensions to both sides give its exact ends. A
    stretch is found for multiples of its period too, so of equal stretches the least period counts.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begin = np.cumsum(sizes + 1) - sizes
    names, known = np.zeros(int(sizes.sum()) + len(texts) + 1, dtype=np.int64), {}
    for t, b in zip(texts, begin):
        names[b:b + len(t)] = [known.setdefault(w, len(known)) for w in t]
    edge = np.zeros(len(names), dtype=bool)
    edge[begin - 1] = edge[-1] = True
    grammar, found = Grammar(names, edge), [np.zeros(0, dtype=np.int64)] * 3
    for text, period, place in _grid(sizes, least):
        i = begin[text] + place
        same = names[i] == names[i + period]
        i, period = i[same], period[same]
        end = i + period + grammar.extension(i, i + period, 1)
        start = i - grammar.extension(i - 1, i + period - 1, -1)
        real = end - start >= np.maximum(least, 2 * period)
        found = _least_periods(*(np.concatenate([f, n[real]]) for f, n in zip(found, (start, end, period))))
    start, end, period = found
    order = np.lexsort((period, start))
    owner = np.searchsorted(begin, start[order], side="right") - 1
    rows = np.stack([start - begin[np.searchsorted(begin, start, side="right") - 1], end - start, period], axis=1)[order]
    cuts = np.searchsorted(owner, np.arange(1, len(texts)))
    return np.split(rows, cuts) if texts else []


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay: those that no run contains after its first period."""
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(cover[:n]) == 0


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Rows (doc_id, runs) of ``docs`` (doc_id, text), ``runs`` an array of (start, length, period) in words.

    Null and empty texts and texts shorter than ``least`` words have none. Null and repeated ids and repeated rows give
    a row each; an empty table gives an empty result; other columns are ignored. Nothing is shuffled: a text is judged
    by itself.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            for rows in slices(batch, "text", SLICE):
                found = runs_of([words_of(t) for t in raw(rows.column("text"))], least)
                lists = [[dict(zip(("start", "length", "period"), r)) for r in own.tolist()] for own in found]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(lists, kind)], ["doc_id", "runs"])

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, runs array<struct<start: long, length: long, period: long>>")


def collapsed(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` with every run in ``text`` cut down to its first period, each word with the white space after it.

    Texts without runs stay as they are, and so do all other columns and rows.
    """
    @F.pandas_udf("string")
    def cut(texts):
        split = [words_of(None if t is None else t.encode("utf-8", "surrogatepass")) for t in texts]
        out = list(texts)
        for k, (words, runs) in enumerate(zip(split, runs_of(split, least))):
            if len(runs):
                keep = kept_words(len(words), runs)
                out[k] = "".join([w for w, stays in zip(WORD_AND_SPACE.findall(out[k]), keep) if stays]).rstrip(" \t\n\r\v\f")
        return texts.__class__(out, index=texts.index, dtype=object)

    return small_batches(docs).withColumn("text", cut("text"))


def digests(docs: DataFrame, least: int = LEAST, rewrite: Callable[[int, list], list] | None = None) -> DataFrame:
    """Rows (doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256): the number of a
    text's runs, its longest run (of equal ones the first, then the one with the least period; nulls without a run),
    and hashes of all runs and of the words that stay. ``rewrite`` gets an id that is not null and the words of its
    text and gives the words to judge. Edge cases are those of ``periodic_runs``; without words both hashes are of
    the empty string.
    """
    names = ["n_runs", "start", "length", "period", "exponent_milli"]

    def run(batches):
        for batch in batches:
            for rows in slices(batch, "text", SLICE):
                ids = rows.column("doc_id").to_pylist()
                texts = [words_of(t) for t in raw(rows.column("text"))]
                if rewrite is not None:
                    texts = [t if i is None else rewrite(i, t) for i, t in zip(ids, texts)]
                out = []
                for words, runs in zip(texts, runs_of(texts, least)):
                    lines, best, left = "", (None,) * 4, words
                    if len(runs):
                        listed = runs.tolist()
                        lines = "".join([f"{s},{n},{q}\n" for s, n, q in listed])
                        s, n, q = min(listed, key=lambda r: (-r[1], r[0], r[2]))
                        best = (s, n, q, 1000 * n // q)
                        left = [w for w, stays in zip(words, kept_words(len(words), runs)) if stays]
                    out.append((len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(),
                                hashlib.sha256(b" ".join(left)).hexdigest()))
                *numbers, listed, kept = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), *(pa.array(c, pa.int64()) for c in numbers), pa.array(listed), pa.array(kept)],
                    ["doc_id", *names, "runs_sha256", "collapsed_sha256"])

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, f"doc_id long, {', '.join(n + ' long' for n in names)}, runs_sha256 string, collapsed_sha256 string")


def planted(doc_id: int, words: list) -> list:
    """The contract's words of a document: for a tenth of the ids, periodic from some word on."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def query(spark: SparkSession, root: str) -> DataFrame:
    return digests(table(spark, root, "documents"), rewrite=planted)
