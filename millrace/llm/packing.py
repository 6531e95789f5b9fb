"""Sequence packing: shortest-pack-first over the histogram of piece lengths."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from millrace.llm import tokens
from millrace.llm.common import slices, small_batches, table
from millrace.session import staged

SEQUENCE, END = 1024, 0

_MODELS: dict[str, tokens.ByteBpe] = {}


def _model(path: str) -> tokens.ByteBpe:
    if path not in _MODELS:
        _MODELS[path] = tokens.ByteBpe(path, special=True)
    return _MODELS[path]


def cut(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE, end: int = END,
        with_ids: bool = False) -> DataFrame:
    """Pieces of tokenized documents: (doc_id, start, length, ids_crc32, doc_tokens, part, nth[, ids]).

    Ids are those of the tokenizer's plain call without special tokens around the text; strings of its added tokens
    inside a text have their own ids. A document's ids end with ``end``; pieces hold ``size`` ids, its last one what is left. ``part`` is the task and
    ``nth`` counts the task's pieces of one length. ``ids`` are the piece's ids as an int array.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    last = end.to_bytes(4, "little")
    fields = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
              ("part", pa.int64()), ("nth", pa.int64())]

    def run(batches):
        model, part, counted = _model(path), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for rows in slices(batch, "text"):
                out, ids, source = [], [], []
                for i, text in enumerate(rows.column("text").to_pylist()):
                    data = (model.ids(text).astype("<u4").tobytes() if text else b"") + last
                    n = len(data) // 4
                    for start in range(0, n, size):
                        own = data[4 * start:4 * (start + size)]
                        length = len(own) // 4
                        out.append((start, length, zlib.crc32(own), n, part, counted[length]))
                        counted[length] += 1
                        source.append(i)
                        if with_ids:
                            ids.append(np.frombuffer(own, dtype="<i4"))
                columns = [rows.column("doc_id").take(pa.array(source, pa.int64()))]
                columns += [pa.array(c, kind) for c, (_, kind) in zip(zip(*out), fields)]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *[n for n, _ in fields], *["ids"] * with_ids])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, nth long"
    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema + ", ids array<int>" * with_ids)


def patterns(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns (count, lengths in descending order) for a histogram of lengths.

    Lengths are placed longest first, each into the shortest packs that it fits, which leaves counts of changed
    patterns; what fits nowhere opens packs. Work and result depend on ``size``, not on the number of documents.
    """
    open_packs: dict[int, list] = {}  # by the room left
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r in open_packs if r >= length), default=None)
            if room is None:
                open_packs.setdefault(size - length, []).append((left, (length,)))
                break
            count, own = open_packs[room].pop()
            # A pack that can take the length several times takes as many as there are for it.
            times = max(1, min(room // length, left // count))
            used = min(count, left)
            if used < count:
                open_packs[room].append((count - used, own))
            elif not open_packs[room]:
                del open_packs[room]
            open_packs.setdefault(room - length * times, []).append((used, own + (length,) * times))
            left -= used * times
    return [p for packs in open_packs.values() for p in packs]


def slots(histogram: dict[int, int], size: int = SEQUENCE) -> dict[str, np.ndarray]:
    """Per pattern and length in it: from which rank of that length on it takes pieces, how many each of its packs
    takes, its first sequence and the offset of the first such piece; ordered by length and rank."""
    rows, taken, sequence = [], Counter(), 0
    for count, lengths in patterns(histogram, size):
        offset = 0
        for length, times in Counter(lengths).items():  # in order, as equal lengths are neighbours
            rows.append((length, taken[length], times, sequence, offset))
            taken[length] += count * times
            offset += length * times
        sequence += count
    order = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "times", "sequence", "offset"), order.T))


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Adds (sequence_id, offset) to the rows of ``cut``: no sequence exceeds ``size`` ids or has a gap.

    Only the histogram of lengths (at most ``size`` rows) reaches the driver. Ranks within a length come from the
    tasks' own counts and a running total over tasks, so a length that many documents share is never gathered.
    """
    pieces = staged(pieces, "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    order = W.Window.partitionBy("length").orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)
    before = staged(counts.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))), "piece-ranks")
    histogram = {r.length: r.n for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table_of = slots(histogram, size)
    names = [f for f in pieces.columns if f not in ("part", "nth")]
    ranked = pieces.join(before.select("part", "length", "before").hint("merge"), ["part", "length"])
    # Lengths are below 2**20 and ranks below 2**43: one sorted number per slot.
    starts = (table_of["length"] << 43) + table_of["rank"]

    def place(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(starts, (length << 43) + rank, side="right") - 1
            pack_no, nth = np.divmod(rank - table_of["rank"][at], table_of["times"][at])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(table_of["sequence"][at] + pack_no),
                 pa.array(table_of["offset"][at] + nth * length)], [*names, "sequence_id", "offset"])

    schema = T.StructType([*(pieces.schema[n] for n in names), T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    return ranked.select(*names, (F.col("before") + F.col("nth")).alias("rank")).mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """Rows (sequence_id, ids, doc_ids, starts) of packed pieces with ids: the training sequences, unpadded.

    A group is one sequence, so never more than its size.
    """
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "start")))
    return packed.groupBy("sequence_id").agg(inside.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.start").alias("starts"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE, end: int = END,
                   with_ids: bool = False) -> DataFrame:
    """Packs ``docs`` (doc_id, text): one row per piece with its place in a sequence.

    Null and empty texts are one piece with the end id alone. Documents longer than a sequence fill sequences of their
    own, and their rest is packed like a short document. Null ids, repeated ids and repeated rows are packed row by
    row. An empty table gives an empty result. Other columns are ignored.
    """
    return pack(cut(docs, tokenizer, size, end, with_ids), size)


def query(spark: SparkSession, root: str) -> DataFrame:
    return pack_documents(table(spark, root, "documents"))
