"""Documents to hashed, chunked, embedded and stored rows."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import content_hash, document_key
from millrace.functions.text import tokens_of
from millrace.operators.silver import first_per_key
from millrace.session import staged

CHUNK_SIZE = 512
CHUNK_OVERLAP = 50
ROWS_AT_ONCE = 2048  # of token lists that are counted at once
SLICE_BYTES = 1 << 20  # of texts that are split at once
# Separators tried from coarse to fine; the empty one cuts between characters.
SEPARATORS = ["\n\n", "\n", ". ", " ", ""]


def with_identity(docs: DataFrame) -> DataFrame:
    """Adds the document id of path and version, the content hash, and both size measures."""
    return docs.withColumns({
        "document_id": document_key(F.col("source_path"), F.col("version")),
        "file_hash": content_hash(F.col("content")),
        "total_chars": F.length("content").cast("long"),
        "total_size_bytes": F.octet_length("content").cast("long"),
    })


def unique_documents(docs: DataFrame, order: str, per_tenant: bool = False) -> DataFrame:
    """One document per content hash (globally or per tenant), the lowest in ``order``.

    Only hashes and ids are grouped; copies collapse before the shuffle, so a text copied very
    often costs no more than one row per task.  Texts move only if the keepers are many.
    ``order`` must be unique per document.
    """
    keys = ["tenant_id", "file_hash"] if per_tenant else ["file_hash"]
    hashed = docs if "file_hash" in docs.columns else docs.withColumn("file_hash", content_hash(F.col("content")))
    keep = hashed.groupBy(*keys).agg(F.min(order).alias(order)).select(order)
    return hashed.join(keep, order, "left_semi")


def unseen(docs: DataFrame, existing: DataFrame) -> DataFrame:
    """Documents whose content hash is not stored yet."""
    return docs.join(existing.select("file_hash").distinct(), "file_hash", "left_anti")


def chunk_windows(docs: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                  text: str = "content", block: int = 100) -> DataFrame:
    """Fixed windows of ``size`` characters, each sharing ``overlap`` with the one before.

    Finding a character position means reading the text up to it, so windows are cut from blocks of
    ``block`` windows; a very long text is not read from its start for each window.
    """
    step = size - overlap
    n = F.greatest(F.lit(1), F.ceil((F.length(text) - F.lit(overlap)) / F.lit(float(step)))).cast("int")
    last_block = F.floor((n - 1) / F.lit(float(block))).cast("int")

    def windows(b: Column) -> Column:
        part = F.substring(F.col(text), b * (block * step) + 1, F.lit(block * step + overlap + size))
        count = F.least(F.lit(block), n - b * block)
        # The one-element array binds the block's text, so that it is cut out once.
        return F.get(F.transform(F.array(part), lambda p: F.transform(
            F.sequence(F.lit(0), count - 1), lambda i: F.substring(p, i * step + 1, F.lit(size)))), F.lit(0))

    return _numbered(docs, F.flatten(F.transform(F.sequence(F.lit(0), last_block), windows)), text)


def _numbered(docs: DataFrame, pieces: Column, text: str) -> DataFrame:
    rest = [c for c in docs.columns if c != text]
    return (docs.select(*rest, F.posexplode(pieces).alias("chunk_index", "content"))
            .withColumn("chunk_size", F.length("content")))


def _merged(pieces: list[str], size: int, overlap: int) -> Iterator[str]:
    """Packs consecutive pieces into chunks of at most ``size``, repeating a tail of ``overlap``."""
    window: list[str] = []
    held = 0
    for piece in pieces:
        if window and held + len(piece) > size:
            yield "".join(window)
            drop = 0
            while drop < len(window) and (held > overlap or held + len(piece) > size):
                held -= len(window[drop])
                drop += 1
            window = window[drop:]
        window.append(piece)
        held += len(piece)
    if window:
        yield "".join(window)


def _pieces(text: str, separator: str) -> list[str]:
    """Text cut before each separator, which stays at the head of its piece."""
    if separator == "":
        return list(text)
    head, *rest = text.split(separator)
    return [p for p in [head, *[separator + r for r in rest]] if p]


def split_recursive(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                    separators: list[str] = SEPARATORS) -> list[str]:
    """Chunks of at most ``size`` characters, cut at the coarsest separator that allows it."""
    level = next((i for i, s in enumerate(separators) if s in text), len(separators) - 1)
    finer = separators[level + 1:]
    chunks: list[str] = []
    small: list[str] = []
    for piece in _pieces(text, separators[level]):
        if len(piece) < size:
            small.append(piece)
            continue
        chunks += _merged(small, size, overlap)
        small = []
        chunks += split_recursive(piece, size, overlap, finer) if finer else [piece]
    chunks += _merged(small, size, overlap)
    return [c for c in (chunk.strip() for chunk in chunks) if c]


def chunk_recursive(docs: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                    text: str = "content") -> DataFrame:
    """Separator-aware chunks; only the text column travels to Python, in Arrow batches."""
    @F.arrow_udf(T.ArrayType(T.StringType()))
    def split(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.string())
        return pa.concat_arrays([pa.array([split_recursive(t, size, overlap) if t else [] for t in part.to_pylist()], kind)
                                 for part in text_slices(texts)] or [pa.array([], kind)])

    return _numbered(docs, split(F.col(text)), text)


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """``texts`` in slices of about ``limit`` bytes, one text at least, so that few of a batch are Python's at once."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield texts.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(texts):
        yield texts.slice(start)


def chunk(docs: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
          method: str = "recursive") -> DataFrame:
    return (chunk_recursive if method == "recursive" else chunk_windows)(docs, size, overlap)


def embed_hashed(df: DataFrame, text_col: str = "content", dim: int = 64, out: str = "embedding") -> DataFrame:
    """Default embedding: token counts in ``dim`` cells, scaled to length one.

    A token's cell is the number of its first eight SHA-256 digits modulo ``dim``, the same in every engine. Rows may
    bring their ``tokens`` in place of a text.
    """
    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def unit(found: pa.Array) -> pa.Array:
        return hashed_vectors(found, dim)

    known = df.withColumn("_text", F.coalesce(F.col(text_col), F.lit(""))) if "tokens" not in df.columns else df
    return known.withColumn(out, unit(tokens_of(known, "_text"))).drop("_text")


def hashed_vectors(found: pa.Array, dim: int) -> pa.Array:
    """Vectors of lists of tokens; each distinct token of ``ROWS_AT_ONCE`` rows is hashed once."""
    if len(found) > ROWS_AT_ONCE:
        return pa.concat_arrays([hashed_vectors(found.slice(at, ROWS_AT_ONCE), dim) for at in range(0, len(found), ROWS_AT_ONCE)])
    size = np.asarray(pc.list_value_length(found), dtype=np.int64)
    coded = found.flatten().cast(pa.binary()).dictionary_encode()
    cells = np.array([cell_of(token, dim) for token in coded.dictionary.to_pylist()], dtype=np.int64)
    # One count over the batch: a row's cells are shifted by its place.
    flat = cells[np.asarray(coded.indices, dtype=np.int64)] + np.repeat(np.arange(len(size)) * dim, size)
    counts = np.bincount(flat, minlength=len(size) * dim).reshape(-1, dim).astype(np.float64)
    length = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    values = (counts / np.where(length > 0, length, 1.0)).astype(np.float32)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1) * dim, pa.int32()), pa.array(values.ravel()))


def cell_of(token: bytes, dim: int) -> int:
    return int(hashlib.sha256(token).hexdigest()[:8], 16) % dim


Embedder = Callable[[list[str]], list[list[float]]]


def embed_with(df: DataFrame, text_col: str, load: Callable[[], Embedder], out: str = "embedding",
               batch: int = 32) -> DataFrame:
    """A supplied model as embedding: ``load`` runs once per worker, texts go in small batches."""
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in parts:
            values = texts.fillna("").tolist()
            vectors: list[list[float]] = []
            for i in range(0, len(values), batch):
                vectors += [[float(x) for x in v] for v in model(values[i:i + batch])]
            yield pd.Series(vectors, index=texts.index, dtype="object")

    return df.withColumn(out, run(F.col(text_col)))


def embed(df: DataFrame, text_col: str = "content", load: Callable[[], Embedder] | None = None) -> DataFrame:
    return embed_hashed(df, text_col) if load is None else embed_with(df, text_col, load)


DOCUMENT_COLUMNS = ["document_id", "tenant_id", "doc_type", "title", "source_path", "file_hash", "version",
                    "chunk_count", "total_chars", "total_size_bytes", "last_updated"]
CHUNK_COLUMNS = ["document_id", "tenant_id", "chunk_index", "doc_type", "title", "source_path", "version",
                 "last_updated", "content", "chunk_size", "embedding"]


def newest(docs: DataFrame, order: str) -> DataFrame:
    """Of documents with one id the highest in ``order``, which is unique."""
    keep = docs.groupBy("document_id").agg(F.max(order).alias(order)).select(order)
    return docs.join(keep, order, "left_semi")


def superseded(docs: DataFrame, order: str) -> DataFrame:
    """The documents that ``newest`` leaves out, to be reported as rejects."""
    keep = docs.groupBy("document_id").agg(F.max(order).alias(order)).select(order)
    return docs.join(keep, order, "left_anti")


def ingest(docs: DataFrame, existing: DataFrame | None, order: str, method: str = "recursive",
           load: Callable[[], Embedder] | None = None) -> tuple[DataFrame, DataFrame]:
    """New documents and their embedded chunks; contents already stored are skipped.

    New documents and chunks are each written to scratch once, so that texts are hashed, split and
    embedded a single time.  Store the chunks first and the document rows last, so that a stored
    document always has its chunks.  If several new contents share path and version, the highest in
    ``order``, which is the newest, is taken; ``superseded`` has the others.  Ids decide, texts don't travel.
    """
    fresh = unique_documents(with_identity(docs), order)
    if existing is not None:
        fresh = unseen(fresh, existing)
    fresh = staged(newest(fresh, order), "ingest-documents")
    chunks = staged(embed(chunk(fresh, method=method), load=load).select(*CHUNK_COLUMNS), "ingest-chunks")
    counts = chunks.groupBy("document_id").agg(F.count(F.lit(1)).alias("chunk_count"))
    documents = (fresh.join(counts, "document_id", "left")
                 .withColumn("chunk_count", F.coalesce("chunk_count", F.lit(0).cast("long")))
                 .select(*DOCUMENT_COLUMNS))
    return documents, chunks


def replace_chunks(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Chunk table after an ingest; re-ingested documents lose all their old chunks."""
    again = fresh.select("document_id").distinct()
    return stored.join(again, "document_id", "left_anti").unionByName(fresh)


def corpus_stats(chunks: DataFrame) -> DataFrame:
    """Documents, chunks, truncated average chunk size and tenants."""
    return chunks.agg(
        F.count_distinct("document_id").alias("documents"),
        F.count(F.lit(1)).alias("chunks"),
        F.coalesce(F.floor(F.avg("chunk_size")), F.lit(0)).cast("long").alias("avg_chunk_size"),
        F.count_distinct("tenant_id").alias("tenants"))
