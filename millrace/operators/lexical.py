"""Keyword search that scores inside each chunk's row: BM25 and cover density over the words that queries ask for.

One pass over the texts keeps, per chunk, only the tokens of the query vocabulary with their places and the chunk's
length, so no postings of the whole corpus are made. Scores are worked out batch by batch against blocks of queries,
and only the best rows of a batch are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.stem import stem
from millrace.functions.text import STOP_WORDS, tokens_of
from millrace.operators.search import BM25_B, BM25_K1, KEY, best_places, query_terms, top_k
from millrace.session import staged

QUERY_BYTES = 4 << 20  # of query texts whose terms are sent to every task; more queries take several passes
QUERY_BLOCK = 256  # queries scored at once, which bounds the matrices of a task
PAIR_BLOCK = 1 << 20  # places looked at together by the cover sweep
ROW_BLOCK = 1024  # chunks of a batch looked at together, which bounds a task's memory whatever the batches
HELD_ROWS = 1 << 16  # results that a task holds before it hands them on

_STOPS = frozenset(STOP_WORDS)

# Fixed value: the weight of a word without a class of its own in cover density.
WORD_WEIGHT = 0.1


@dataclass
class Block:
    """Some queries: their terms (numbers of the vocabulary), and per term and query the term's place among the
    query's terms, or -1."""

    queries: np.ndarray  # positions in the list of query ids
    terms: np.ndarray
    slot: np.ndarray
    n_terms: np.ndarray

    def __post_init__(self):
        # Per term the queries that ask for it, one after the other.
        term, self.asking = np.nonzero(self.slot >= 0)
        self.size = np.bincount(term, minlength=len(self.terms))
        self.first = np.cumsum(self.size) - self.size


@dataclass
class Asked:
    """A set of queries as their tasks need it."""

    ids: pa.Array
    vocabulary: pa.Array
    blocks: list[Block]


def _asked(queries: DataFrame, stems: bool = False) -> Asked:
    held = query_terms(queries).toArrow().combine_chunks()
    ids = held.column("query_id").combine_chunks().dictionary_encode()
    words = held.column("term").combine_chunks()
    words = (_stemmed(words) if stems else words).dictionary_encode()
    # Words of a query that have one stem are one term.
    pairs = np.stack([np.asarray(c.indices, dtype=np.int64) for c in (ids, words)], axis=1)
    owner, term = np.unique(pairs.reshape(-1, 2), axis=0).T
    n_terms = np.bincount(owner, minlength=len(ids.dictionary))
    blocks = []
    for at in range(0, len(ids.dictionary), QUERY_BLOCK):
        inside = (owner >= at) & (owner < at + QUERY_BLOCK)
        own, which = np.unique(term[inside], return_inverse=True)
        some = np.arange(at, min(at + QUERY_BLOCK, len(ids.dictionary)))
        slot = np.full((len(own), len(some)), -1, dtype=np.int64)
        first = np.cumsum(n_terms[some]) - n_terms[some]
        column = owner[inside] - at
        slot[which, column] = np.arange(inside.sum()) - first[column]
        blocks.append(Block(some, own, slot, n_terms[some]))
    return Asked(ids.dictionary, words.dictionary, blocks)


def _stemmed(words: pa.Array) -> pa.Array:
    """Stems of tokens, each distinct one worked out once; stop words have none."""
    coded = words.dictionary_encode()
    stems = [None if w is None or w in _STOPS else stem(w) for w in coded.dictionary.to_pylist()]
    return pa.array(stems, pa.string()).take(coded.indices)


def matched_words(chunks: DataFrame, vocabulary: pa.Array, text: str = "content", stems: bool = False) -> DataFrame:
    """Rows ``(document_id, chunk_index, length, words, places)``: the tokens of each chunk that the vocabulary has, as
    its numbers, with their places in the text, and the number of all tokens. Chunks without a token are left out.
    With ``stems`` the vocabulary and the tokens are compared as English stems; stop words match nothing then."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_blocks(batches):
            lists = batch.column("_tokens")
            size = np.asarray(pc.list_value_length(lists), dtype=np.int64)
            flat = lists.flatten()
            number = pc.index_in(_stemmed(flat) if stems else flat, value_set=vocabulary, skip_nulls=True)
            owner = np.repeat(np.arange(batch.num_rows), size)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
            hit = np.asarray(number.is_valid())
            ends = pa.array(np.append(0, np.cumsum(np.bincount(owner[hit], minlength=batch.num_rows))), pa.int32())
            words = pa.array(np.asarray(number.fill_null(-1))[hit], pa.int32())
            places = pa.array(place[hit], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in KEY), pa.array(size, pa.int32()), pa.ListArray.from_arrays(ends, words),
                 pa.ListArray.from_arrays(ends, places)], [*KEY, "length", "words", "places"])

    slim = chunks.select(*KEY, tokens_of(chunks, text).alias("_tokens")).where(F.size("_tokens") > 0)
    schema = T.StructType([*(slim.schema[c] for c in KEY), T.StructField("length", T.IntegerType()),
                           *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("words", "places"))])
    return slim.mapInArrow(run, schema)


def row_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROW_BLOCK):
            yield batch.slice(at, ROW_BLOCK)


class Rows:
    """A batch of ``matched_words``: one entry per kept token, in order of chunk and place."""

    def __init__(self, batch: pa.RecordBatch):
        self.n = batch.num_rows
        words = batch.column("words")
        self.size = np.asarray(pc.list_value_length(words), dtype=np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.owner = np.repeat(np.arange(self.n), self.size)
        self.word = np.asarray(words.flatten(), dtype=np.int64)
        self.place = np.asarray(batch.column("places").flatten(), dtype=np.int64)
        self.length = np.asarray(batch.column("length"), dtype=np.float64)

    def hits(self, block: Block, n_words: int) -> "Hits":
        """How often each chunk has each term of the block, spread over the queries that ask for the term."""
        column = np.full(n_words, -1, dtype=np.int64)
        column[block.terms] = np.arange(len(block.terms))
        own = column[self.word]
        keep = own >= 0
        pair, tf = np.unique(self.owner[keep] * max(1, len(block.terms)) + own[keep], return_counts=True)
        chunk, term = np.divmod(pair, max(1, len(block.terms)))
        size = block.size[term]
        which = np.repeat(np.arange(len(pair)), size)
        asking = block.asking[np.repeat(block.first[term] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        return Hits(own, chunk, term, tf, which, chunk[which] * len(block.queries) + asking)


@dataclass
class Hits:
    """Entries (chunk, term, tf) of a batch and a block; ``which`` entry adds to which cell (chunk, query)."""

    column: np.ndarray
    chunk: np.ndarray
    term: np.ndarray
    tf: np.ndarray
    which: np.ndarray
    cell: np.ndarray


Score = Callable[[Rows, Block, int], np.ndarray]


def bm25(df: np.ndarray, n: float, mean: float, match: str) -> Score:
    idf = np.log(1.0 + (n - df + 0.5) / (df + 0.5))

    def score(rows: Rows, block: Block, n_words: int) -> np.ndarray:
        hits, shape = rows.hits(block, n_words), (rows.n, len(block.queries))
        soft = BM25_K1 * (1 - BM25_B + BM25_B * rows.length[hits.chunk] / mean)
        gain = idf[block.terms[hits.term]] * hits.tf * (BM25_K1 + 1) / (hits.tf + soft)
        total = np.bincount(hits.cell, gain[hits.which], shape[0] * shape[1]).reshape(shape)
        found = np.bincount(hits.cell, minlength=shape[0] * shape[1]).reshape(shape)
        return np.where(found == block.n_terms if match == "all" else found > 0, total, np.nan)

    return score


def cover_density(rows: Rows, block: Block, n_words: int) -> np.ndarray:
    """Sum over the minimal covers of a chunk: stretches that hold every term of the query and no shorter such stretch.

    A cover counts ``WORD_WEIGHT / (1 + other words inside)``. From each entry on, the sweep looks up the next place of
    every term; the farthest of them ends the cover, and of the entries with one end the last begins it.
    """
    hits = rows.hits(block, n_words)
    column = hits.column
    found = np.bincount(hits.cell, minlength=rows.n * len(block.queries)).reshape(rows.n, -1)
    chunk, query = np.nonzero(found == block.n_terms)
    out = np.full((rows.n, len(block.queries)), np.nan)
    cost = np.cumsum(rows.size[chunk])
    at = 0
    while at < len(chunk):
        stop = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + PAIR_BLOCK, side="right")))
        c, q = chunk[at:stop], query[at:stop]
        size = rows.size[c]
        pair = np.repeat(np.arange(len(c)), size)
        entry = np.repeat(rows.begin[c] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        known = column[entry]
        slot = np.where(known >= 0, block.slot[known, q[pair]], -1)
        pair, place, slot = pair[slot >= 0], rows.place[entry[slot >= 0]], slot[slot >= 0]
        out[c, q] = np.bincount(pair, _covers(pair, place, slot, block.n_terms[q]), len(c))
        at = stop
    return out


def _covers(pair: np.ndarray, place: np.ndarray, slot: np.ndarray, n_terms: np.ndarray) -> np.ndarray:
    """Per entry what the minimal cover that begins there counts, or nothing."""
    n = len(pair)
    index = np.arange(n)
    last = np.searchsorted(pair, pair, side="right") - 1
    end = index.copy()
    for s in range(int(n_terms.max(initial=0))):
        after = np.minimum.accumulate(np.where(slot == s, index, n)[::-1])[::-1]
        end = np.where(s < n_terms[pair], np.maximum(end, after), end)
    begins = end <= last
    begins[:-1] &= (end[1:] != end[:-1]) | (pair[1:] != pair[:-1])
    to = np.minimum(end, last)
    others = place[to] - place - (to - index)
    return np.where(begins, WORD_WEIGHT / (1 + others), 0.0)


def best_rows(parts: list[pa.RecordBatch], k: int) -> pa.RecordBatch:
    """Rows (query, document_id, chunk_index, score) that may be among the best ``k`` of their query, ties included."""
    rows = pa.Table.from_batches(parts).combine_chunks()
    query, value = (np.asarray(rows.column(c).combine_chunks()) for c in ("query", "score"))
    order = np.lexsort((-value, query))
    query, value = query[order], value[order]
    first = np.searchsorted(query, query)
    last = np.minimum(first + k, np.searchsorted(query, query, side="right")) - 1
    # Everything not clearly below the k-th value stays, so that rounding cannot lose a tie.
    kept = rows.take(pa.array(np.sort(order[value >= value[last] - 1e-9])))
    return kept.combine_chunks().to_batches()[0]


def scored(rows: DataFrame, asked: Asked, score: Score, k: int) -> DataFrame:
    """Best ``k`` chunks per query, of each task's rows first and then of all."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def named(part: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([asked.ids.take(part.column("query")), *part.columns[1:]], ["query_id", *KEY, "score"])

        held, size = [], 0
        for batch in row_blocks(batches):
            own = Rows(batch)
            for block in asked.blocks:
                values = score(own, block, len(asked.vocabulary)).T
                which, chunk = best_places(values, k)
                if not len(which):
                    continue
                at = pa.array(chunk)
                held.append(pa.RecordBatch.from_arrays(
                    [pa.array(block.queries[which], pa.int64()), *(batch.column(c).take(at) for c in KEY),
                     pa.array(values[which, chunk])], ["query", *KEY, "score"]))
                size += len(which)
                if size > HELD_ROWS:
                    held = [best_rows(held, k)]
                    size = held[0].num_rows
                    if size > HELD_ROWS // 2:  # ties, or very many queries: Spark goes on from here
                        yield named(held[0])
                        held, size = [], 0
        if held:
            yield named(best_rows(held, k))

    schema = T.StructType([T.StructField("query_id", T._parse_datatype_string(_spark_type(asked.ids.type))),
                           *(T.StructField(c, kinds[c]) for c in KEY), T.StructField("score", T.DoubleType())])
    # Scores are compared at 9 digits, so that the order of summation never decides a rank.
    return top_k(rows.where(F.size("words") > 0).mapInArrow(run, schema).withColumn("score", F.round("score", 9)), k)


def _spark_type(kind: pa.DataType) -> str:
    from pyspark.sql.pandas.types import from_arrow_type

    return from_arrow_type(kind).simpleString()


def _passes(queries: DataFrame, limit: int) -> list[DataFrame]:
    """``queries`` in parts whose texts have about ``limit`` bytes."""
    total = queries.agg(F.coalesce(F.sum(F.octet_length("query_text")), F.lit(0))).first()[0]
    n = max(1, -(-total // limit))
    return [queries] if n == 1 else [
        queries.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == i) for i in range(n)]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def search_bm25(queries: DataFrame, chunks: DataFrame, k: int = 20, match: str = "all",
                query_bytes: int = QUERY_BYTES, stems: bool = False) -> DataFrame:
    """BM25 of ``queries(query_id, query_text)`` over ``chunks(document_id, chunk_index, content)``.

    ``match="all"`` needs every query term, ``"any"`` at least one. Terms reach the tasks up to ``query_bytes`` of query
    text; larger sets are searched in parts of that size. Queries of stop words only find nothing. With ``stems`` words
    match by their English stems.
    """
    def one(part: DataFrame) -> DataFrame:
        asked = _asked(part, stems)
        rows = staged(matched_words(chunks, asked.vocabulary, stems=stems), "lexical-words")
        n, mean = rows.agg(F.count(F.lit(1)), F.avg("length")).first()
        seen = rows.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
        df = np.zeros(len(asked.vocabulary))
        for word, count in seen.toLocalIterator():  # no more rows than terms
            df[word] = count
        return scored(rows, asked, bm25(df, float(n), mean or 1.0, match), k)

    return _union([one(p) for p in _passes(queries, query_bytes)])


def search_density(queries: DataFrame, chunks: DataFrame, k: int = 20, query_bytes: int = QUERY_BYTES,
                   stems: bool = False) -> DataFrame:
    """Cover-density ranking of chunks that hold every term of a query; arguments as in ``search_bm25``.

    The closer together a chunk has a query's terms, and the more often, the higher it ranks; no statistics of the
    corpus enter, so one pass over the texts is enough.
    """
    def one(part: DataFrame) -> DataFrame:
        asked = _asked(part, stems)
        return scored(matched_words(chunks, asked.vocabulary, stems=stems), asked, cover_density, k)

    return _union([one(p) for p in _passes(queries, query_bytes)])
