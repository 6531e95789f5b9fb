"""Alignment of two tokenizers over a corpus; pair counts by external counting with compressed runs and heap merges.

Tasks encode texts and collect records (pair of ids, document). Full buffers are sorted by radix (of the A id), pair and
document and leave as *spills*: the records, compressed, beside one count run per radix, which holds each pair once. Only
count runs meet by radix: heaps merge them, first in lanes, then into one run per radix. That run is in order of the A
id, so the highest count of an A id is known when its pairs have passed. The merged run is streamed past the count runs
of its radix, each of which gets an answer of the same length, and the answers return to their spills. Records never
move by key: a pair that every document holds is one entry in each count run.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import tokens
from millrace.llm.common import slices, small_batches, table
from millrace.llm.substrings import mix
from millrace.session import staged

B_BITS = 20  # a pair is one number: the A id above the B id
SPILL = 1_000_000  # records of a buffer
RADICES = 256
LANES = 8  # parts of a radix that are merged and answered by themselves, so that a common A id is no single task
FAN = 64  # runs that one heap merges
FRAME = 8192  # pairs of a run that are decompressed at once


class Aligner:
    """Tokens of both vocabularies with their groups and links; at most ``limit`` parts are kept between calls."""

    def __init__(self, path_a: str, path_b: str, limit: int = 400_000):
        from sentencepiece import SentencePieceProcessor

        self.a, self.b = tokens.ByteBpe(path_a), SentencePieceProcessor(model_file=path_b)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if len(names) > 1 << B_BITS or max(self.a.bytes_of) >= 1 << 31:
            raise ValueError(f"A ids of up to 31 bits and B ids of up to {B_BITS} bits are expected")
        self.bytes_b = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode()
                        for i, n in enumerate(names)]
        self.by_parts = not any(b" " in b.lstrip(b" ") for b in self.bytes_b)
        self.known, self.limit = {}, limit
        self.size_a = np.zeros(max(self.a.bytes_of) + 1, dtype=np.int64)
        self.size_a[list(self.a.bytes_of)] = [len(b) for b in self.a.bytes_of.values()]
        self.size_b = np.array([len(b) for b in self.bytes_b], dtype=np.int64)
        # Decimal ids with what follows them inside and at the end of a group.
        self.text_a, self.text_b = (np.array([[f"{i}{mark}" for i in range(n)] for mark in marks], dtype=object)
                                    for n, marks in ((len(self.size_a), ",|"), (len(names), ",;")))

    def _tokens_b(self, texts: list[str]) -> list[np.ndarray | None]:
        """B ids of texts, or nothing where they do not spell a space and the text.

        No piece of B's vocabulary goes across a space behind a visible character, so texts are cut there and each
        distinct part is encoded once; B adds the space that a part starts with. A text with a part that its tokens do
        not spell is tried as a whole.
        """
        if len(self.known) > self.limit:
            self.known = {}
        cut = [[p for p in tokens.pieces(" " + t) if p] if self.by_parts else [" " + t] for t in texts]
        self._learn(set().union(*cut).difference(self.known))
        out = []
        for text, parts in zip(texts, cut):
            data = [self.known[p] for p in parts]
            if len(parts) > 1 and not all(data):
                self._learn([" " + text])
                data = [self.known[" " + text]]
            out.append(np.frombuffer(b"".join(data), dtype="<u4").astype(np.int64) if all(data) else None)
        return out

    def _learn(self, parts: Iterable[str]) -> None:
        parts = list(parts)
        for part, ids in zip(parts, self.b.encode([p[1:] for p in parts], num_threads=1) if parts else ()):
            spelled = b"".join([self.bytes_b[i] for i in ids]) == part.encode("utf-8", "surrogatepass")
            self.known[part] = np.array(ids, dtype="<u4").tobytes() if spelled else b""

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides of each text, or nothing where there is no text or a side does not spell it."""
        some = [k for k, t in enumerate(texts) if t]
        out: list = [None] * len(texts)
        for k, b in zip(some, self._tokens_b([texts[k] for k in some])):
            a = None if b is None else self.a.ids(" " + texts[k]).astype(np.int64)
            # A side of bytes gives its matches back whatever it merges, so its size tells whether it spells the text.
            if a is not None and self.size_a[a].sum() == self.size_b[b].sum():
                out[k] = a, b
        return out

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """(sizes, groups, text, links): per text the numbers of its tokens, groups and links, its groups as a string,
        and for all links of all texts, the number of the text and the pair.

        Texts lie one after the other. Between two neighbouring ends of tokens of either side, one token of each side
        covers the bytes: that is a link; where tokens of both sides end, a group ends.
        """
        found = self.tokens(texts)
        sizes = np.zeros((len(texts), 4), dtype=np.int64)
        spelled = [k for k, f in enumerate(found) if f is not None]
        if not spelled:
            return sizes, [""] * len(texts), np.zeros(0, np.int64), np.zeros(0, np.int64)
        n_a, n_b = (np.array([len(found[k][side]) for k in spelled]) for side in (0, 1))
        a, b = (np.concatenate([found[k][side] for k in spelled]) for side in (0, 1))
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        kind = np.zeros(ends_a[-1] + 1, dtype=np.uint8)
        kind[ends_a] = 1
        kind[ends_b] |= 2
        at = np.flatnonzero(kind)
        kind = kind[at]
        is_a, is_b, both = (kind & 1).astype(np.int64), (kind >> 1).astype(np.int64), kind == 3
        upto_a, upto_b, upto = np.cumsum(is_a), np.cumsum(is_b), np.cumsum(both)
        links = a[upto_a - is_a] << B_BITS | b[upto_b - is_b]
        owner = np.searchsorted(ends_a[np.cumsum(n_a) - 1], at)
        sizes[spelled] = np.stack([n_a, n_b, np.bincount(owner[both], minlength=len(spelled)),
                                   np.bincount(owner, minlength=len(spelled))], axis=1)
        # A group's A tokens stand behind the B tokens of the groups before, its B tokens behind its own A tokens.
        group = upto - both
        before_b, own_a = np.append(0, upto_b[both]), upto_a[both]
        at_a, at_b = is_a == 1, is_b == 1
        line = np.empty(len(a) + len(b), dtype=object)
        line[np.arange(len(a)) + before_b[group[at_a]]] = self.text_a[both[at_a].astype(np.int8), a]
        line[np.arange(len(b)) + own_a[group[at_b]]] = self.text_b[both[at_b].astype(np.int8), b]
        groups, stop = [""] * len(texts), np.cumsum(n_a + n_b).tolist()
        for k, first, last in zip(spelled, [0, *stop], stop):
            groups[k] = "".join(line[first:last].tolist())[:-1]
        return sizes, groups, np.array(spelled, dtype=np.int64)[owner], links


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str | None = None, path_b: str | None = None) -> Aligner:
    """This worker's vocabularies; read once."""
    key = (path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model"))
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


# --- runs --------------------------------------------------------------------------------------------------------------

def packed(*columns: np.ndarray) -> bytes:
    """Columns of one length as a compressed block."""
    body = b"".join(c.astype("<i8").tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=3).compress(body)


def unpacked(block: bytes, n_columns: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(block), dtype="<i8").reshape(n_columns, -1)


def count_run(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """Pairs in order with their counts, compressed in frames, each after its length."""
    out = []
    for at in range(0, len(pairs), FRAME):
        own = pairs[at:at + FRAME]
        frame = packed(np.diff(own, prepend=0), counts[at:at + FRAME])
        out += [len(frame).to_bytes(4, "little"), frame]
    return b"".join(out)


def frames(run: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    at = 0
    while at < len(run):
        size = int.from_bytes(run[at:at + 4], "little")
        steps, counts = unpacked(run[at + 4:at + 4 + size], 2)
        yield np.cumsum(steps), counts
        at += 4 + size


def _entries(run: bytes) -> Iterator[tuple[int, int]]:
    for pairs, counts in frames(run):
        yield from zip(pairs.tolist(), counts.tolist())


def heap_merge(runs: list[bytes]) -> bytes:
    """One count run from several: a heap yields entries in order of their pairs, and counts of one pair add up."""
    if len(runs) == 1:
        return runs[0]
    out, pairs, counts, last = [], [], [], None
    for pair, n in heapq.merge(*map(_entries, runs)):
        if pair == last:
            counts[-1] += n
            continue
        if len(pairs) == FRAME:
            out.append(count_run(np.array(pairs), np.array(counts)))
            pairs, counts = [], []
        pairs.append(pair)
        counts.append(n)
        last = pair
    out.append(count_run(np.array(pairs, dtype=np.int64), np.array(counts, dtype=np.int64)))
    return b"".join(out)


class Merger:
    """Merges any number of runs, ``FAN`` at a time: full sets of runs become one run of the next pass at once."""

    def __init__(self):
        self.passes: list[list[bytes]] = []

    def add(self, run: bytes, at: int = 0) -> None:
        if at == len(self.passes):
            self.passes.append([])
        self.passes[at].append(run)
        if len(self.passes[at]) == FAN:
            self.add(heap_merge(self.passes[at]), at + 1)
            self.passes[at] = []

    def result(self) -> bytes:
        left: list[bytes] = []
        for own in self.passes:
            left = [heap_merge(own + left)] if own or left else []
        return left[0]


def with_best(run: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, counts, best) of a merged run; ``best`` marks pairs with the highest count of their A id."""
    found = list(frames(run))
    pairs, counts = (np.concatenate(c) for c in zip(*found))
    a = pairs >> B_BITS
    first = np.flatnonzero(np.diff(a, prepend=-1))
    top = np.maximum.reduceat(counts, first)
    return pairs, counts, counts == np.repeat(top, np.diff(np.append(first, len(a))))


def _grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, dict]]:
    """Rows one by one as (key, row), off batches that are in order of ``keys``."""
    for batch in batches:
        for at in range(0, batch.num_rows, 32):
            for row in batch.slice(at, 32).to_pylist():
                yield tuple(row[k] for k in keys), row


def _dealt(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


# --- stages ------------------------------------------------------------------------------------------------------------

SIZES = ["n_a", "n_b", "n_groups", "n_links"]
DOC = pa.struct([("doc_id", pa.int64()), *((n, pa.int64()) for n in SIZES), ("groups_sha256", pa.string())])
DOC_SCHEMA = f"doc_id long, {', '.join(n + ' long' for n in SIZES)}, groups_sha256 string"


def _few(parts: Iterable[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for at in range(0, part.num_rows, rows):
            yield part.slice(at, rows)


def spilled(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, radices: int = RADICES,
            limit: int = SPILL) -> DataFrame:
    """Rows (part, spill, radix, docs, data): per spill one row of its records with the digests of its documents
    (``radix`` is ``radices`` there) and a count run for each radix that occurs. ``part`` is the task."""
    def spill(part, number, held, rows):
        pairs, doc, times = (np.concatenate(c) for c in zip(*held)) if held else [np.zeros(0, np.int64)] * 3
        radix = (mix((pairs >> B_BITS).astype(np.uint64), np.uint64(0)) % np.uint64(radices)).astype(np.int64)
        order = np.lexsort((doc, pairs, radix))
        pairs, doc, times, radix = pairs[order], doc[order], times[order], radix[order]
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        counts = np.diff(np.append(first, len(pairs)))
        own, own_radix = pairs[first], radix[first]
        cuts = np.flatnonzero(np.diff(own_radix, prepend=-1))
        runs = [count_run(p, n) for p, n in zip(np.split(own, cuts[1:]), np.split(counts, cuts[1:]))] if len(own) else []
        # A record is one number, the document above the times it holds the link; counts say where a pair begins.
        sizes, records, n = packed(counts), packed(doc << 32 | times), len(runs) + 1
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * n, pa.int64()), pa.array([number] * n, pa.int64()),
             pa.array([*own_radix[cuts].tolist(), radices], pa.int32()), pa.array([None] * (n - 1) + [rows], pa.list_(DOC)),
             pa.array([*runs, len(sizes).to_bytes(4, "little") + sizes + records], pa.binary())], ["part", "spill", "radix", "docs", "data"])

    def run(batches):
        own, part, number = aligner(path_a, path_b), TaskContext.get().partitionId(), 0
        held, rows, size = [], [], 0
        for batch in batches:
            for some in _few(slices(batch, "text", 2 << 20)):
                sizes, groups, text, links = own.align(some.column("text").to_pylist())
                hashes = [g and hashlib.sha256(g.encode()).hexdigest() for g in groups]
                # Pairs are below 2**51, and a slice has no more than 2**12 texts.
                keys, times = np.unique(links << 12 | text, return_counts=True)
                held.append((keys >> 12, (keys & 4095) + len(rows), times))
                rows += [dict(zip(("doc_id", *SIZES, "groups_sha256"), (i, *s, h)))
                         for i, s, h in zip(some.column("doc_id").to_pylist(), sizes.tolist(), hashes)]
                size += len(keys)
                if size >= limit:
                    yield spill(part, number, held, rows)
                    held, rows, size, number = [], [], 0, number + 1
        if rows:
            yield spill(part, number, held, rows)

    kind = f"part long, spill long, radix int, docs array<struct<{DOC_SCHEMA.replace(' ', ': ').replace(',: ', ', ')}>>, data binary"
    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kind)


def merged(runs: DataFrame, keys: list[str]) -> DataFrame:
    """One count run per key from the rows (keys, data) of ``runs``."""
    def run(batches):
        def out(key, merger):
            return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int32()) for k in key),
                                               pa.array([merger.result()], pa.binary())], [*keys, "data"])

        now = merger = None
        for key, row in _grouped(batches, keys):
            if key != now:
                if now is not None:
                    yield out(now, merger)
                now, merger = key, Merger()
            merger.add(row["data"])
        if now is not None:
            yield out(now, merger)

    return _dealt(runs.select(*keys, "data"), keys).mapInArrow(run, ", ".join(f"{k} int" for k in keys) + ", data binary")


def answers(runs: DataFrame, counts: DataFrame, lanes: int = LANES) -> DataFrame:
    """Rows (part, spill, radix, data): corpus-wide count and best mark of each pair of each count run, in its order."""
    def run(batches):
        pairs = known = best = None
        for _, row in _grouped(batches, ["radix"]):
            if row["part"] is None:
                pairs, known, best = with_best(row["data"])
                continue
            own = np.concatenate([p for p, _ in frames(row["data"])])
            at = np.searchsorted(pairs, own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]], pa.int64()), pa.array([row["spill"]], pa.int64()), pa.array([row["radix"]], pa.int32()),
                 pa.array([packed(known[at] << 1 | best[at])], pa.binary())], ["part", "spill", "radix", "data"])

    every = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))
    heads = counts.select("radix", every.alias("lane"), F.lit(None).cast("long").alias("part"),
                          F.lit(None).cast("long").alias("spill"), "data")
    both = heads.unionByName(runs.select("radix", "lane", "part", "spill", "data"))
    return _dealt(both, ["radix", "lane"], "part").mapInArrow(run, "part long, spill long, radix int, data binary")


def returned(spills: DataFrame, found: DataFrame) -> DataFrame:
    """Per document of ``spills`` its digest with n_best and count_sum, from the answers to its spill's runs."""
    def run(batches):
        known = []
        for _, row in _grouped(batches, ["part", "spill"]):
            if row["docs"] is None:
                known.append(unpacked(row["data"], 1)[0])
                continue
            data, docs = row["data"], pa.array(row["docs"], DOC)
            cut = 4 + int.from_bytes(data[:4], "little")
            counts, records = unpacked(data[4:cut], 1)[0], unpacked(data[cut:], 1)[0]
            answer = np.repeat(np.concatenate(known) if known else np.zeros(0, np.int64), counts)
            doc, times = records >> 32, records & 0xFFFFFFFF
            sums = np.zeros((2, len(docs)), dtype=np.int64)
            np.add.at(sums[0], doc, times * (answer & 1))
            np.add.at(sums[1], doc, times * (answer >> 1))
            known = []
            yield pa.RecordBatch.from_arrays([*docs.flatten(), *map(pa.array, sums)], [*(f.name for f in DOC), "n_best", "count_sum"])

    answer = found.select("part", "spill", "radix", F.lit(None).cast(spills.schema["docs"].dataType).alias("docs"), "data")
    both = spills.select("part", "spill", "radix", "docs", "data").unionByName(answer)
    return _dealt(both, ["part", "spill"], "radix").mapInArrow(run, DOC_SCHEMA + ", n_best long, count_sum long")


def _counted(docs: DataFrame, path_a, path_b, radices, limit, lanes) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = staged(spilled(docs, path_a, path_b, radices, limit), "alignment-runs")
    lane = F.pmod(F.xxhash64("part", "spill"), F.lit(lanes)).cast("int").alias("lane")
    runs = rows.where(F.col("radix") < radices).select("radix", lane, "part", "spill", "data")
    counts = staged(merged(merged(runs, ["radix", "lane"]), ["radix"]), "alignment-counts")
    return rows.where(F.col("radix") == radices), runs, counts


def alignment(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, radices: int = RADICES,
              limit: int = SPILL, lanes: int = LANES) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum), one per row of ``docs``.

    A encodes a space and the text, B the text, to which it adds a space; no special tokens. Tokens link where their
    bytes overlap. A pair's count is the number of rows of ``docs`` that hold it; ``n_best`` counts the links whose pair
    has the highest count of its A id, ties included, and ``count_sum`` adds up the counts over all links. Null and
    empty texts, and texts that the tokens of a side do not spell, have zeros and an empty string. Null and repeated
    ids and repeated rows are documents of their own. An empty table gives an empty result. Other columns are ignored.
    A text is encoded by one task; records of at most ``limit`` and one slice more are held at once.
    """
    spills, runs, counts = _counted(docs, path_a, path_b, radices, limit, lanes)
    return returned(spills, answers(runs, counts, lanes))


def pair_counts(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, radices: int = RADICES,
                limit: int = SPILL, lanes: int = LANES) -> DataFrame:
    """Rows (a, b, documents, best): linked ids, how many documents hold the pair, and whether that is A's highest."""
    def run(batches):
        for _, row in _grouped(batches, ["radix"]):
            pairs, counts, best = with_best(row["data"])
            yield pa.RecordBatch.from_arrays([pa.array(pairs >> B_BITS), pa.array(pairs & (1 << B_BITS) - 1), pa.array(counts),
                                              pa.array(best)], ["a", "b", "documents", "best"])

    return _counted(docs, path_a, path_b, radices, limit, lanes)[2].mapInArrow(run, "a long, b long, documents long, best boolean")


def groups(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Rows (doc_id, groups): the groups of each text, ``a1,a2|b1;a3|b2,b3``; an empty string without tokens."""
    def run(batches):
        own = aligner(path_a, path_b)
        for batch in batches:
            for some in slices(batch, "text", 2 << 20):
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(own.align(some.column("text").to_pylist())[1])],
                                                 ["doc_id", "groups"])

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, groups string")


def query(spark: SparkSession, root: str) -> DataFrame:
    return alignment(table(spark, root, "documents"))
