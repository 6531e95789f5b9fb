"""Quality rules: base limits and robust multivariate outliers per language and source."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from millrace.llm.common import slices, small_batches, table
from millrace.session import discard, staged

# The limits and the symbols of the contract.
MIN_WORDS, MAX_REPEAT, SYMBOLS = 50, 0.5, "#*$%&|<>"
SPACES = " \t\n\r\v\f"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more in the text, by 64-bit hashes of the words."""
    if len(words) < 4:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).astype(np.uint64)
    key = h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:] * np.uint64(0x165667B19E3779F9)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), dtype=bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    inside = np.zeros(len(words), dtype=bool)
    for i in range(3):
        inside[i:i + len(again)] |= again
    return int(inside.sum())


def statistics(text: str) -> tuple[int, int, int, int, int]:
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def measured(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, lang, source, text_hash) with the base statistics, one per row of ``docs``."""
    names = ["doc_id", "lang", "source", "text_hash"]

    def run(batches):
        for batch in batches:
            for rows in slices(batch, "text"):
                found = [statistics(t or "") for t in rows.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(n) for n in names), *(pa.array(c, pa.int64()) for c in zip(*found))], [*names, *BASE])

    return small_batches(docs).select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"),
                       F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id long, lang string, source string, text_hash long, " + ", ".join(f"{c} long" for c in BASE))


# The vector of a document, and the least standard deviation that each part is granted: most documents have no symbol
# and no repetition at all, and where more than half of a group agree in a part its robust variance is zero.
FLOORS = (0.05, 0.5, 0.5, 0.1, 0.5)
DIM = len(FLOORS)
PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]


def vector() -> dict[str, Column]:
    """Mean word length, symbols per thousand letters, repeated lines, share of repeated words, number of words."""
    n, chars = F.col("n_words").cast("double"), F.col("word_chars").cast("double")
    return {"x0": F.log(chars / n), "x1": F.log1p(1000 * F.col("n_symbols") / chars),
            "x2": F.log1p(F.col("n_dup_lines").cast("double")), "x3": F.col("n_repeat_words") / n, "x4": F.log(n)}


def chi_square(x: float, k: int) -> float:
    """Distribution function, by the series of the incomplete gamma function."""
    a, half = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > 1e-17 * total:
        n += 1
        term *= half / (a + n)
        total += term
    return min(1.0, total * math.exp(-half + a * math.log(half) - math.lgamma(a))) if x > 0 else 0.0


def chi_square_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, k) < p else (low, mid)
    return high


def _estimates(moments: DataFrame, coverage: float | None) -> DataFrame:
    """Sums per (grp, start) to location, precision matrix and log determinant."""
    scale = coverage / chi_square(chi_square_quantile(coverage, DIM), DIM + 2) if coverage else 1.0
    floors = np.diag(np.square(FLOORS))

    def run(batches):
        for b in batches:
            n = b.column("n").to_numpy()
            loc = np.stack([b.column(f"s{i}").to_numpy() for i in range(DIM)], axis=1) / n[:, None]
            cov = np.empty((len(n), DIM, DIM))
            for i, j in PAIRS:
                cov[:, i, j] = cov[:, j, i] = b.column(f"s{i}{j}").to_numpy() / n - loc[:, i] * loc[:, j]
            cov = scale * cov + floors
            yield pa.RecordBatch.from_arrays(
                [b.column("grp"), b.column("start"), b.column("rows"), pa.array(list(loc), pa.list_(pa.float64())),
                 pa.array(list(np.linalg.inv(cov).reshape(-1, DIM * DIM)), pa.list_(pa.float64())), pa.array(np.linalg.slogdet(cov)[1])],
                ["grp", "start", "rows", "loc", "prec", "logdet"])

    return moments.mapInArrow(
        run, "grp long, start int, rows long, loc array<double>, prec array<double>, logdet double")


def _distance() -> Column:
    """Squared Mahalanobis distance of x0.. to the joined estimate."""
    d = [F.col(f"x{i}") - F.col("loc")[i] for i in range(DIM)]
    total = F.lit(0.0)
    for i, j in PAIRS:
        total = total + (1 if i == j else 2) * F.col("prec")[i * DIM + j] * d[i] * d[j]
    return F.greatest(total, F.lit(0.0))


def _sums() -> list[Column]:
    return [F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(DIM)],
            *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in PAIRS]]


def _central_start(vectors: DataFrame) -> DataFrame:
    """Location and spread by quantiles of each part: exact on a grid of 1/256, from counts per grid cell."""
    cells = vectors.select("grp", F.posexplode(F.array(*[F.round(F.col(f"x{i}") * 256) for i in range(DIM)])).alias("i", "v"))
    counts = cells.groupBy("grp", "i", "v").agg(F.count("*").alias("n"))
    by_value = W.Window.partitionBy("grp", "i").orderBy("v")
    ranked = counts.withColumn("upto", F.sum("n").over(by_value)).withColumn("rows", F.sum("n").over(W.Window.partitionBy("grp", "i")))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("rows"), F.col("v"))) / 256
    parts = ranked.groupBy("grp", "i").agg(at(0.5).alias("mid"), ((at(0.84) - at(0.16)) / 2).alias("dev"), F.first("rows").alias("rows"))
    listed = parts.groupBy("grp").agg(F.first("rows").alias("rows"), F.array_sort(F.collect_list(F.struct("i", "mid", "dev"))).alias("p"))
    floors = F.array(*[F.lit(f) for f in FLOORS])
    var = F.transform("p", lambda p: p.dev * p.dev + floors[p.i] * floors[p.i])
    prec = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(DIM - 1)), lambda i: F.transform(
        F.sequence(F.lit(0), F.lit(DIM - 1)), lambda j: F.when(i == j, 1 / var[i]).otherwise(0.0))))
    return listed.select("grp", F.lit(1).alias("start"), "rows", F.col("p.mid").alias("loc"), prec.alias("prec"),
                         F.lit(0.0).alias("logdet"))


def estimates(vectors: DataFrame, coverage: float = 0.75, steps: int = 5, per_unit: int = 32) -> DataFrame:
    """Minimum-covariance-determinant estimates (grp, rows, loc, prec, logdet) of the vectors (grp, x0..) of each group.

    Two starts, all rows and the robust centre, each take ``steps`` concentration steps over all rows: distances to the
    estimate, then the moments of the nearest ``coverage`` of the group. The nearest rows are found from sums per
    distance cell (``per_unit`` cells per unit of its logarithm), added up task by task before they are shuffled, so a
    group of any size costs its tasks alone. The start with the smaller determinant wins.
    """
    every = vectors.groupBy("grp").agg(*_sums()).withColumn("start", F.lit(0)).withColumn("rows", F.col("n"))
    now = staged(_estimates(every, None).unionByName(_central_start(vectors)), "mcd-start")
    for _ in range(steps):
        cells = (vectors.join(now.select("grp", "start", "rows", "loc", "prec"), "grp")
                 .withColumn("cell", F.floor(F.log(_distance() + 1e-6) * per_unit))
                 .groupBy("grp", "start", "cell").agg(F.first("rows").alias("rows"), *_sums()))
        nearer = W.Window.partitionBy("grp", "start").orderBy("cell").rowsBetween(W.Window.unboundedPreceding, -1)
        inner = cells.withColumn("nearer", F.coalesce(F.sum("n").over(nearer), F.lit(0))).where(
            F.col("nearer") < F.ceil(coverage * F.col("rows")))
        moments = inner.groupBy("grp", "start").agg(
            F.first("rows").alias("rows"), F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(DIM)],
            *[F.sum(f"s{i}{j}").alias(f"s{i}{j}") for i, j in PAIRS])
        before, now = now, staged(_estimates(moments, coverage), "mcd-step")
        discard(before)
    return now.groupBy("grp").agg(F.min_by(F.struct("rows", "loc", "prec", "logdet"), F.struct("logdet", "start")).alias("e")).select("grp", "e.*")


def groups(rows: DataFrame, min_rows: int) -> DataFrame:
    """(lang, source, grp, n, rest): a group of its own from ``min_rows`` rows on; the smaller ones of a language
    together, if they are as many; the rest of all languages together."""
    sizes = rows.where(~F.col("base_failed")).groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = sizes.where(F.col("n") < min_rows).groupBy(F.col("lang").alias("small_lang")).agg(F.sum("n").alias("pooled"))
    level = F.when(F.col("n") >= min_rows, 0).when(F.col("pooled") >= min_rows, 1).otherwise(2)
    of = F.xxhash64(level, F.when(level < 2, F.col("lang")), F.when(level < 1, F.col("source")))
    return sizes.join(small, F.col("lang").eqNullSafe(F.col("small_lang")), "left").select(
        F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), of.alias("grp"),
        "n", (level == 2).alias("rest"))


def judged(docs: DataFrame, min_rows: int = 100, tail: float = 1e-9) -> DataFrame:
    """The rows of ``measured`` with base_failed and kept.

    base_failed: fewer than 50 words, or more than half of the words repeated. kept: not base_failed, and the squared
    Mahalanobis distance of the document's vector to its group's estimate does not exceed the chi-square quantile that
    leaves ``tail`` of a normal group outside. Estimates are made from rows that pass the base rules, per language and
    source (see ``groups``); a last pool of fewer than ``min_rows`` rows is judged by the estimate of all rows.

    Null and empty texts have no words and fail; null languages and sources are values of their own; null ids, repeated
    ids and repeated rows are judged row by row. An empty table gives an empty result. Other columns are ignored.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    rows = staged(measured(docs).withColumn("base_failed", failed), "rules-rows")
    of = staged(groups(rows, min_rows), "rules-groups")
    passed = rows.where(~F.col("base_failed")).join(
        of, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))).drop("g_lang", "g_source", "n", "rest")
    passed = staged(passed.withColumns(vector()), "rules-vectors")
    parts = passed.select("grp", *[f"x{i}" for i in range(DIM)])
    rest = of.where("rest").groupBy("grp").agg(F.sum("n").alias("n")).first()
    if rest is not None and rest.n < min_rows:
        parts = parts.where(F.col("grp") != rest.grp).unionByName(parts.withColumn("grp", F.lit(rest.grp).cast("long")))
    found = staged(estimates(parts), "rules-estimates")
    limit = chi_square_quantile(1 - tail, DIM)
    near = _distance() <= limit
    names = ["doc_id", "lang", "source", "text_hash", *BASE, "base_failed"]
    return passed.join(found, "grp").select(*names, near.alias("kept")).unionByName(
        rows.where("base_failed").select(*names, F.lit(False).alias("kept")))


def keep(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps."""
    good = staged(judged(docs, **options).where("kept").select(
        *[F.col(c).alias(f"__{c}") for c in ("doc_id", "text_hash", "lang", "source")]).distinct(), "rules-kept")
    same = F.xxhash64("text") == F.col("__text_hash")
    for c in ("doc_id", "lang", "source"):
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return docs.join(good, same, "left_semi")


def query(spark: SparkSession, root: str) -> DataFrame:
    return judged(table(spark, root, "documents")).select("doc_id", *BASE, "base_failed", "kept")
