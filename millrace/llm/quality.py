"""Quality classifier: Bradley-Terry scores learned from preference pairs, thresholded at a score quantile."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import slices, small_batches, table
from millrace.llm.outliers import SPACES, SYMBOLS, repeated_words
from millrace.session import staged

PUNCTUATION = ".,;:?'\"()-"
FEATURES = ["words", "word_length", "symbols", "bars", "exclamations", "capitals", "digits", "punctuation",
            "repeated", "doubled", "distinct", "repeated_lines", "line_length"]
PAIRS, THRESHOLD = 200_000, 0.7
GROUP_ROWS, LEAST, PAIRS_PER_ROW = 4096, 64, 5


def features(text: str) -> list[float]:
    """What the text looks like, whole; all parts are finite for any text."""
    words = text.encode("utf-8", "surrogatepass").split()
    n, letters = len(words), max(1, len(text) - sum(map(text.count, SPACES)))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    per = lambda count, of: math.log1p(1000 * count / max(1, of))
    capitals = sum(map(str.isupper, text))
    return [math.log1p(n), math.log(letters / max(1, n)), per(sum(map(text.count, SYMBOLS)), letters),
            per(text.count("|"), n), per(text.count("!"), letters), per(capitals, letters),
            per(sum(map(text.count, "0123456789")), letters), per(sum(map(text.count, PUNCTUATION)), letters),
            repeated_words(words) / max(1, n), per(sum(map(bytes.__eq__, words, words[1:])), n),
            len(set(words)) / max(1, n), per(len(lines) - len(set(lines)), len(lines)), math.log1p(n / max(1, len(lines)))]


def featured(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, x): the feature array of each row's whole text; null texts count as empty."""
    def run(batches):
        for batch in batches:
            for rows in slices(batch, "text"):
                found = [features(t or "") for t in rows.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "x"])

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, x array<double>")


def fit_pairs(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3, steps: int = 25,
              seed: int = 7) -> np.ndarray:
    """Bradley-Terry weights w: the sigmoid of w . (x_i - x_j) is the probability that i is preferred to j.

    Every pair has one row of either label, drawn so that each row occurs equally often; Newton steps minimise the
    logistic loss of the feature differences. Without both labels there is no preference and the weights are zero.
    """
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return np.zeros(x.shape[1])
    draw = np.random.default_rng(seed)
    deal = lambda own: np.concatenate([draw.permutation(own) for _ in range(-(-pairs // len(own)))])[:pairs]
    d = x[deal(good)] - x[deal(bad)]
    return newton(lambda w: pair_sums(d, np.ones(len(d)), w), x.shape[1], ridge, steps)


def pair_sums(d: np.ndarray, weight: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(curvature, gradient, weight) of the logistic loss at ``w``, summed over pairs with feature differences ``d``."""
    p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # probability given to the wrong order
    return (d * (weight * p * (1 - p))[:, None]).T @ d, d.T @ (weight * p), float(weight.sum())


def newton(sums, n: int, ridge: float = 1e-3, steps: int = 25) -> np.ndarray:
    """Minimum of the ridged mean loss, whose (curvature, gradient, weight) ``sums`` gives at any weights."""
    w = np.zeros(n)
    for _ in range(steps):
        curvature, gradient, total = sums(w)
        step = np.linalg.solve(curvature / total + ridge * np.eye(n), gradient / total - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def learning_groups(learn: DataFrame, good: int, bad: int) -> DataFrame:
    """Rows (number, rows) of about ``GROUP_ROWS`` rows (x, quality, n) each, dealt by a hash of the row.

    ``rows`` is a matrix with the columns: 1 in one group and 0 in the others that hold the row, n, quality, x. Where a
    label is rare, its rows are in several groups, so that each group has about ``LEAST`` of them.
    """
    groups = max(1, -(-(good + bad) // GROUP_ROWS))
    copies = [min(groups, -(-LEAST * groups // max(1, n))) for n in (bad, good)]
    copy = F.sequence(F.lit(0), F.when(F.col("quality") == 1, copies[1]).otherwise(copies[0]) - 1)
    number = F.pmod(F.xxhash64("x", "quality") + F.col("copy"), F.lit(groups)).cast("int")
    placed = learn.withColumn("copy", F.explode(copy)).select(number.alias("number"), "copy", "n", "quality", "x")

    def run(rows: pa.Table) -> pa.Table:
        x = np.asarray(rows.column("x").combine_chunks().flatten(), dtype=np.float64).reshape(rows.num_rows, -1)
        head = [np.asarray(rows.column("copy")) == 0, np.asarray(rows.column("n")), np.asarray(rows.column("quality"))]
        held = np.column_stack([*head, x])
        held = held[np.lexsort(held.T)]  # whatever order the rows came in
        return pa.table({"number": rows.column("number")[:1], "rows": pa.array([held.tobytes()], pa.binary())})

    tasks = min(groups, 4 * learn.sparkSession.sparkContext.defaultParallelism)  # few groups are not left to one task
    return placed.repartition(tasks, "number").groupBy("number").applyInArrow(run, "number int, rows binary")


def over_groups(groups: DataFrame, sums) -> np.ndarray:
    """Sum of the arrays that ``sums(number, copy, n, quality, x)`` gives for the groups, added in the groups' order."""
    def run(batches):
        for batch in batches:
            for number, data in zip(batch.column("number").to_pylist(), batch.column("rows")):
                held = np.frombuffer(data.as_buffer(), dtype=np.float64).reshape(-1, 3 + len(FEATURES))
                out = sums(number, held[:, 0], held[:, 1], held[:, 2], held[:, 3:])
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([out.tobytes()], pa.binary())], ["number", "sums"])

    found = groups.mapInArrow(run, "number int, sums binary").toArrow().sort_by("number")
    return sum(np.frombuffer(s.as_buffer(), dtype=np.float64) for s in found.column("sums"))


def group_pairs(number: int, n: np.ndarray, y: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(preferred row, other row, weight) of a group's pairs.

    Each row is ``PAIRS_PER_ROW`` times with the weight of its n in pairs whose other rows are drawn by their n, so every
    row is learned from, and both labels weigh the same.
    """
    rng = np.random.default_rng([seed, number])
    own = {label: np.flatnonzero(y == label) for label in (0, 1)}
    if not len(own[0]) or not len(own[1]):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    parts = []
    for label in (1, 0):
        each, others = np.repeat(own[label], PAIRS_PER_ROW), own[1 - label]
        ends = np.cumsum(n[others])
        at = np.searchsorted(ends, (np.arange(len(each)) + rng.random()) / len(each) * ends[-1], side="right")
        partner = rng.permutation(others[np.minimum(at, len(others) - 1)])
        parts.append((*((each, partner) if label == 1 else (partner, each)), n[each] / n[each].sum() * n.sum()))
    return tuple(np.concatenate(c) for c in zip(*parts))


def fit(learn: DataFrame) -> np.ndarray:
    """Bradley-Terry weights (see ``fit_pairs``) of all rows (x, quality, n); n is how often a row occurs.

    Spark deals the rows into groups of bounded size and sums the loss over the pairs of each group; a Newton step is one
    pass over the groups, of which the driver gets 1.5 KB each.
    """
    counts = {r.quality: r.rows for r in learn.groupBy("quality").agg(F.count(F.lit(1)).alias("rows")).collect()}
    size = len(FEATURES)
    if not counts.get(0) or not counts.get(1):
        return np.zeros(size)
    groups = staged(learning_groups(learn, counts[1], counts[0]), "quality-groups")
    total = over_groups(groups, lambda number, first, n, y, x: np.append((first * n) @ x, (first * n).sum()))
    mean = total[:-1] / total[-1]
    dev = np.sqrt(over_groups(groups, lambda number, first, n, y, x: (first * n) @ (x - mean) ** 2) / total[-1])
    dev[dev < 1e-9] = 1.0

    def sums(w):
        def one(number, first, n, y, x):
            i, j, weight = group_pairs(number, n, y)
            curvature, gradient, own = pair_sums((x[i] - x[j]) / dev, weight, w)
            return np.concatenate([curvature.ravel(), gradient, [own]])

        found = over_groups(groups, one)
        return found[:size * size].reshape(size, size), found[size * size:-1], found[-1]

    return newton(sums, size) / dev


def weighted_quantile(rows: DataFrame, value: str, n: str, share: float, bins: int = 1024) -> float:
    """The quantile of all values, each occurring n times, between neighbours as numpy has it.

    Values are counted in bins, and the bin of the wanted place is cut into bins again until its neighbours are known.
    """
    low, high, total = rows.agg(F.min(value), F.max(value), F.sum(n)).first()
    place = (total - 1) * share
    before, part, found = 0, rows, []
    first, second = math.floor(place), math.ceil(place)
    while low < high:
        bin_ = F.least(F.floor((F.col(value) - F.lit(low)) / F.lit(high - low) * bins), F.lit(bins - 1))
        counted = part.groupBy(bin_.alias("bin")).agg(F.sum(n).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        held, at = sorted(counted.collect()), before  # no more rows than bins
        ends = [at := at + r.n for r in held]
        one, two = (next(i for i, e in enumerate(ends) if k < e) for k in (first, second))
        if one != two:
            found = [held[one].high, held[two].low]
            break
        before, part = ends[one] - held[one].n, part.where(bin_ == held[one].bin)
        low, high = held[one].low, held[one].high
    below, above = found or (low, high)
    return below + (above - below) * (place - first)


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def utility(w: np.ndarray):
    """weights . x"""
    out = F.lit(0.0)
    for i, c in enumerate(w):
        out = out + F.lit(float(c)) * F.col("x")[i]
    return out


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per row of ``docs`` (doc_id, text).

    ``labels`` has (doc_id, quality). The model and its threshold come from all labels of documents that are not held out
    (crc32 of the id modulo 4 is not 2): the sigmoid of weights . x + bias is the score, and reaches ``threshold`` at the
    quantile of these rows' utilities that is the share of label 0 among them. Scores depend on texts alone.

    Null and empty texts are scored like others. Rows with a null id are scored, not held out and never learned from;
    repeated ids and rows are scored row by row, and each labelled row of them is a row to learn from. Null labels are
    ignored; without labels of both kinds every score equals ``threshold``, if there is one. An empty table gives an empty
    result. Other columns are ignored.
    """
    rows = staged(featured(docs), "quality-features")
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where("quality in (0, 1)").dropna()
    # Rows that look alike are one row with their number, so that copies of a text do not crowd a group.
    learn = staged(rows.join(known.hint("merge"), "doc_id").where(~held_out(F.col("doc_id")))
                   .groupBy("x", "quality").agg(F.count(F.lit(1)).alias("n")), "quality-learn")
    w, bias = fit(learn), math.log(threshold / (1 - threshold))
    share = learn.agg(F.sum(F.when(F.col("quality") == 0, F.col("n")).otherwise(0)) / F.sum("n")).first()[0]
    if share is not None:
        bias -= weighted_quantile(learn.select(utility(w).alias("u"), "n"), "u", "n", share)
    value = 1 / (1 + F.exp(-(F.lit(bias) + utility(w))))
    return rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), value.alias("score"),
                       (value >= threshold).cast("int").alias("predicted"))


def query(spark: SparkSession, root: str) -> DataFrame:
    return score(table(spark, root, "documents"), table(spark, root, "labels"))
