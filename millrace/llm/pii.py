"""Personal data by fixed base patterns and by contextual patterns bootstrapped from what these find. SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from millrace.llm.common import table
from millrace.session import staged

# The base patterns of the contract, in its order of kinds. The quantifiers are possessive where nothing
# could follow what they would give back, which finds the same and needs no stack on long runs. An address is tried
# at the start of a run of its letters, or where the match before ends: from inside the run nothing else can match.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OTHER = "other"  # what the bootstrapped patterns find
ORDER = [*KINDS, OTHER]

SPACE = r"\x20\x09-\x0D"
# A cue is a word with a mark after it that announces a value: "Ref: X", "id=X", "token = X".
CUE = rf"(?<![^{SPACE}])[\p{{L}}_-]{{2,30}}\x20?[:=#]\x20?[^{SPACE}]++"
MARKED = r"^[\p{L}_-]{2,30}\x20?[:=#]"
BEFORE_VALUE = MARKED + r"\x20?[\"'(<\[]*+"
AFTER_VALUE = r"[\"')>\].,;:!?]++$"

# Texts without these can't match, and most have none of them.
NEEDS = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda t: t.contains("+"),
    "cue": lambda t: t.contains(":") | t.contains("=") | t.contains("#"),
}


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """Array of (gap, found): each match with the number of characters between it and the one before."""
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, f: F.struct(g.alias("gap"), f.alias("found")))
    return F.when(NEEDS[kind](text), both)


def _placed(rows: DataFrame, kind: str) -> DataFrame:
    """(row, kind, start, end, found) of every match: positions are running totals of gaps and matches."""
    each = rows.where(F.size(kind) > 0).select("row", F.posexplode(kind).alias("i", "m")).select(
        "row", "i", "m.found", F.length("m.found").alias("n"), "m.gap")
    upto = F.sum(F.col("gap") + F.col("n")).over(W.Window.partitionBy("row").orderBy("i"))
    return each.withColumn("end", upto).select("row", F.lit(kind).alias("kind"), (F.col("end") - F.col("n")).alias("start"), "end", "found")


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Every second digit from the right counts double, nines thrown out; the total ends in 0."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    weighed = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(weighed, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    digits = _digits(found)
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (p.try_cast("decimal(38,0)") <= 255))
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def scanned(docs: DataFrame) -> DataFrame:
    """One row per document: its number, ids and the matches of every kind. Texts are read once and not kept."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"),
                       F.xxhash64("text").alias("text_hash"),
                       *[_matches(text, k, p).alias(k) for k, p in (KINDS | {"cue": CUE}).items()])
    return staged(rows, "pii-scan")


def base_spans(rows: DataFrame) -> DataFrame:
    """(row, kind, start, end) of the base matches that hold as such."""
    out = None
    for kind in KINDS:
        good = _placed(rows, kind).where(_valid(kind, F.col("found"))).drop("found")
        out = good if out is None else out.unionByName(good)
    return out


def discovered(rows: DataFrame, base: DataFrame, rounds: int = 3, min_seeds: int = 3, confidence: float = 0.8) -> DataFrame:
    """(row, kind, start, end) of values that high-confidence patterns announce.

    Patterns are the cues of the corpus, instances the distinct values after them, and values that overlap a base span
    are seeds. Each round scores a pattern by the share of its distinct instances that are believed so far (one more
    counts as not believed), and believes an instance as much as its best pattern that has ``min_seeds`` believed
    instances and a score of ``confidence``. Values with a digit and at least four characters that end up believed
    are found. Copies of a text add no weight, since edges are distinct.

    Everything is grouped with combining before the shuffle; a cue that a third of the texts share is joined as two
    written tables, which Spark splits.
    """
    lead = F.length(F.regexp_extract("found", BEFORE_VALUE, 0))
    seen = _placed(rows, "cue").select(
        "row", (F.col("start") + lead).alias("start"),
        F.lower(F.regexp_replace(F.regexp_extract("found", MARKED, 0), r"\x20", "")).alias("pattern"),
        F.regexp_replace(F.col("found").substr(lead + 1, F.length("found")), AFTER_VALUE, "").alias("value"))
    seen = staged(seen.where(F.length("value") > 0).withColumn("end", F.col("start") + F.length("value")), "pii-cues")
    hit = base.select(F.col("row").alias("b_row"), F.col("start").alias("b_start"), F.col("end").alias("b_end"))
    overlaps = (F.col("row") == F.col("b_row")) & (F.col("b_start") < F.col("end")) & (F.col("b_end") > F.col("start"))
    seeds = seen.join(hit, overlaps, "left_semi").select("value").distinct().withColumn("seed", F.lit(1.0))
    edges = staged(seen.select("pattern", "value").distinct().join(seeds, "value", "left").fillna(0.0, ["seed"]), "pii-edges")
    belief = edges.groupBy("value").agg(F.max("seed").alias("belief"))
    for _ in range(rounds):
        scored = edges.join(belief, "value").groupBy("pattern").agg(F.sum("belief").alias("s"), F.count("*").alias("n"))
        trusted = staged(scored.select("pattern", (F.col("s") / (F.col("n") + 1)).alias("score")).where(
            (F.col("s") >= min_seeds) & (F.col("score") >= confidence)), "pii-patterns")
        belief = staged(edges.join(trusted, "pattern", "left").groupBy("value").agg(
            F.greatest(F.max("seed"), F.coalesce(F.max("score"), F.lit(0.0))).alias("belief")), "pii-instances")
    looks = (F.length("value") >= 4) & F.col("value").rlike("[0-9]")
    believed = belief.where((F.col("belief") >= confidence) & looks).select("value")
    found = seen.join(believed, "value", "left_semi").join(trusted.select("pattern"), "pattern", "left_semi")
    return found.join(hit, overlaps, "left_anti").select("row", F.lit(OTHER).alias("kind"), "start", "end")


def spans_of(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    rows = scanned(docs)
    base = staged(base_spans(rows), "pii-base")
    more = staged(discovered(rows, base, **options), "pii-more")
    return rows, base.unionByName(more)


def _per_row(spans: DataFrame) -> DataFrame:
    """(row, spans): the spans of a document in order of start and kind."""
    order = F.array_position(F.array(*[F.lit(k) for k in ORDER]), F.col("kind"))
    return spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", order.alias("no"), "end", "kind"))).alias("spans"))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def personal_data(docs: DataFrame, **options) -> DataFrame:
    """Rows (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), one per row of ``docs`` (doc_id, text).

    Spans are kind:start:end in code points, the end exclusive. Per base kind, matches are the leftmost ones that don't
    overlap; those that fail their test are dropped without another try. ``options`` are those of ``discovered``, which
    adds spans of the kind ``other`` outside of base spans.

    Null and empty texts have no spans. Null ids, repeated ids and repeated rows are searched row by row. An empty
    table gives an empty result. Other columns are ignored. The scan's row numbers are written with its matches, so
    later steps and repeated tasks agree on them.
    """
    rows, spans = spans_of(docs, **options)
    found = F.coalesce(F.col("spans"), F.expr("array()").cast("array<struct<start:bigint,no:bigint,end:bigint,kind:string>>"))
    base = F.filter(found, lambda s: s.kind != OTHER)
    counts = [F.size(F.filter(found.kind, lambda s: s == F.lit(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("row", "doc_id").join(_per_row(spans), "row", "left").select(
        "doc_id", *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(found).alias("spans"))


def masked(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets; overlapping spans become one.

    Other columns stay as they are. Rows with the same id and text share their spans; null texts stay null.
    """
    rows, spans = spans_of(docs, **options)
    of = rows.join(_per_row(spans), "row").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans")).dropDuplicates(["__id", "__hash"])
    of = staged(of, "pii-masks")
    text = F.col("text")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def add(acc, s):
        before = text.substr((acc.at + 1).cast("int"), (s.start - acc.at).cast("int"))
        return F.when(s.start >= acc.at, F.struct(
            s.end.alias("at"), F.concat(acc.out, before, F.lit("["), F.upper(s.kind), F.lit("]")).alias("out"))
        ).otherwise(F.struct(F.greatest(acc.at, s.end).alias("at"), acc.out.alias("out")))

    clean = F.aggregate("__spans", start, add, lambda acc: F.concat(
        acc.out, text.substr((acc.at + 1).cast("int"), F.length(text))))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    return docs.join(of, same, "left").withColumn("text", F.coalesce(clean, text)).drop("__id", "__hash", "__spans")


def query(spark: SparkSession, root: str) -> DataFrame:
    return personal_data(table(spark, root, "documents"))
