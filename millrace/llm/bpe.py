"""Byte-level BPE by recursive DuckDB queries inside each partition, and its inverse by ordered aggregation."""

from __future__ import annotations

import base64
import hashlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import tokens
from millrace.llm.common import slices, small_batches, table

WORD_BYTES, ROUNDS = 400_000, 64  # start rows of one recursive query, and its steps before it is begun anew

# A token row starts at byte pos, is size bytes long, and knows the token after it in its word (-1: none). Each step finds
# the pairs that the merge table knows and picks per word the least rank, of these the leftmost: the smallest of numbers
# made of rank (17 bits), position (30), and the sizes of both tokens (8 each). The row of that pair's right token becomes
# the merged one, since it knows what comes next; words without a pair are done and leave the recursion.
CONTRACT = """
WITH RECURSIVE step(it, word, pos, size, tok, next_size, next_tok) AS (
  SELECT 0, word, pos, size, tok, next_size, next_tok FROM start
  UNION ALL
  SELECT it + 1, s.word, CASE WHEN s.pos = b.gone THEN b.pos ELSE s.pos END,
         CASE WHEN s.pos = b.gone THEN b.both ELSE s.size END, CASE WHEN s.pos = b.gone THEN b.merged ELSE s.tok END,
         CASE WHEN s.pos + s.size = b.pos THEN b.both ELSE s.next_size END,
         CASE WHEN s.pos + s.size = b.pos THEN b.merged ELSE s.next_tok END
  FROM step s JOIN (
    SELECT word, CAST(best >> 46 AS INT) AS merged, CAST((best >> 16) & 1073741823 AS INT) AS pos,
           CAST(((best >> 16) & 1073741823) + ((best >> 8) & 255) AS INT) AS gone,
           CAST(((best >> 8) & 255) + (best & 255) AS INT) AS both
    FROM (
      SELECT l.word, min((((m.merged << 30) + l.pos) << 16) + (l.size << 8) + l.next_size) AS best
      FROM step l JOIN merges m ON m.lhs = l.tok AND m.rhs = l.next_tok
      GROUP BY l.word)) b ON b.word = s.word
  WHERE s.pos <> b.pos AND s.it < {rounds})
SELECT s.word, s.it, s.pos, s.tok FROM step s JOIN (SELECT word, max(it) AS it FROM step GROUP BY word) USING (word, it)
ORDER BY s.pos
"""

DECODE = """
SELECT doc, list(v.bytes ORDER BY t.pos) AS parts FROM tokens t JOIN vocabulary v ON v.id = t.id GROUP BY doc
"""


class Bpe:
    """Ranks in a DuckDB database of this worker: the vocabulary and every pair of tokens that makes a token."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB"})
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t))
                 if t[:i] in self.ranks and t[i:] in self.ranks]
        if max(self.ranks.values()) >= 1 << 17 or max(map(len, self.ranks)) > 255:
            raise ValueError("ranks of up to 17 bits and tokens of up to 255 bytes are expected")
        kinds = {"lhs": pa.int32(), "rhs": pa.int32(), "merged": pa.int64()}
        merges = pa.table({n: pa.array(c, kinds[n]) for n, c in zip(kinds, zip(*pairs))})
        vocabulary = pa.table({"id": pa.array(self.ranks.values(), pa.int64()),
                               "bytes": pa.array(self.ranks.keys(), pa.binary())})
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", rows)
            self.db.execute(f"CREATE TABLE {name} AS FROM given")
            self.db.unregister("given")
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.size_of = np.zeros(max(self.ranks.values()) + 1, dtype=np.int32)
        self.size_of[list(self.ranks.values())] = [len(t) for t in self.ranks]
        self.decimals = np.array([str(i) for i in range(len(self.size_of))], dtype=object)
        self.cache = tokens.PieceCache(self.values)
        self.cache.join = self.join

    def contract(self, word: np.ndarray, tok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges tokens of each word, given in order as (word, token) rows, until no pair is left.

        Long words take several queries, so none holds many steps; the rows of a word stay together and in order.
        """
        done = []
        while len(tok):
            size = self.size_of[tok]
            last = np.append(word[1:] != word[:-1], True)
            start = pa.table({"word": word, "pos": (np.cumsum(size) - size).astype(np.int32), "size": size, "tok": tok,
                              "next_size": np.where(last, 0, np.roll(size, -1)).astype(np.int32),
                              "next_tok": np.where(last, -1, np.roll(tok, -1)).astype(np.int32)})
            self.db.register("start", start)
            found = self.db.execute(CONTRACT.format(rounds=ROUNDS)).fetchnumpy()
            self.db.unregister("start")
            more = found["it"] == ROUNDS
            done.append((found["word"][~more], found["tok"][~more]))
            word, tok = found["word"][more], found["tok"][more]
        return tuple(np.concatenate(c) for c in zip(*done))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Rows (word number, id) of the matches of the pattern: its own rank if it has one, else its bytes contracted."""
        as_bytes = [w.encode("utf-8", "surrogatepass") for w in words]
        own = np.array([self.ranks.get(b, -1) for b in as_bytes], dtype=np.int32)
        whole, rest = np.flatnonzero(own >= 0), np.flatnonzero(own < 0)
        sizes = np.array([len(as_bytes[i]) for i in rest], dtype=np.int64)
        found = [(whole, own[whole])]
        cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // WORD_BYTES)) + 1
        for group, n in zip(np.split(rest, cuts), np.split(sizes, cuts)):
            if len(group):
                raw = np.frombuffer(b"".join([as_bytes[i] for i in group]), np.uint8)
                at, ids = self.contract(np.repeat(np.arange(len(group), dtype=np.int32), n), self.of_byte[raw])
                found.append((group[at], ids))
        word, ids = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(word, kind="stable")
        return word[order], ids[order]

    def decode(self, doc: np.ndarray, ids: np.ndarray, n: int) -> list[bytes]:
        """The bytes that the ids of each of the documents 0 to n - 1 stand for, from rows (document, id) in order."""
        self.db.register("tokens", pa.table({"doc": doc, "pos": np.arange(len(ids)), "id": ids}))
        found = self.db.sql(DECODE).to_arrow_table()
        self.db.unregister("tokens")
        out = [b""] * n
        for rows in found.to_batches():
            # The tokens of a document lie behind one another, so its bytes are one stretch of theirs.
            parts = rows.column(1)
            flat = parts.values
            kind = np.int64 if pa.types.is_large_binary(flat.type) else np.int32
            ends = np.frombuffer(flat.buffers()[1], kind)[flat.offset:flat.offset + len(flat) + 1]
            edges, data = ends[parts.offsets.to_numpy()].tolist(), memoryview(flat.buffers()[2])
            for d, a, b in zip(rows.column(0).to_pylist(), edges, edges[1:]):
                out[d] = bytes(data[a:b])
        return out

    def values(self, words: list[str]) -> list[tuple]:
        """Per word: its ids as decimals, and what the ids decode to."""
        out = []
        for at in range(0, len(words), 50_000):
            part = words[at:at + 50_000]
            word, ids = self.encode_words(part)
            ends = np.searchsorted(word, np.arange(len(part) + 1)).tolist()
            text = self.decimals[ids].tolist()
            out += [(" ".join(text[a:b]), d) for a, b, d in zip(ends, ends[1:], self.decode(word, ids, len(part)))]
        return out

    @staticmethod
    def join(values: list[tuple]) -> tuple:
        return " ".join([v[0] for v in values]), b"".join([v[1] for v in values])


_MODELS: dict[str, Bpe] = {}


def model(path: str | None = None) -> Bpe:
    """This worker's database for a file of ranks; built once."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if path not in _MODELS:
        _MODELS[path] = Bpe(path)
    return _MODELS[path]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Rows (doc_id, ids): the ids of each text of ``docs`` (doc_id, text), an empty array for null or empty texts.

    Every match of the pattern is encoded by itself, without special tokens. Null and repeated ids and repeated rows
    give a row each; an empty table gives an empty result; other columns are ignored. Distinct matches of a slice of
    rows are encoded together; single characters runs of any length work, but take time that grows faster than they.
    """
    def run(batches):
        bpe = model(path)
        for batch in batches:
            for rows in slices(batch, "text"):
                found = bpe.cache.look_up([t or "" for t in rows.column("text").to_pylist()])
                ids = [np.array(" ".join([v[0] for v in values]).split(), dtype=np.int32) for values in found]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Rows (doc_id, decoded): the bytes of each id array (doc_id, ids); null ids decode to nothing."""
    def run(batches):
        bpe = model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                ids = [np.array(i or [], dtype=np.int64) for i in rows.column("ids").to_pylist()]
                doc = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
                found = bpe.decode(doc, np.concatenate(ids), len(ids))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256): ``encode`` and ``decode`` in one pass, as digests.

    A text's ids are those of its matches in order and decode to what these decode to in order, so each distinct match
    is encoded and decoded once. Edge cases are those of ``encode``.
    """
    def run(batches):
        bpe = model(path)
        for batch in batches:
            for rows in slices(batch, "text"):
                found = bpe.cache.look_up([t or "" for t in rows.column("text").to_pylist()])
                sizes, ids, decoded = [], [], []
                for values in found:
                    written = " ".join([v[0] for v in values])
                    sizes.append(written.count(" ") + 1 if written else 0)
                    ids.append(hashlib.sha256(written.encode()).hexdigest())
                    decoded.append(hashlib.sha256(b"".join([v[1] for v in values])).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids), pa.array(decoded)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, root: str) -> DataFrame:
    return digests(table(spark, root, "documents"))
