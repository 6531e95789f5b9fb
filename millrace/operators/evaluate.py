"""Retrieval quality against known relevance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ratio


def retrieval_quality(ranked: DataFrame, relevant: DataFrame, totals: DataFrame, k: int) -> DataFrame:
    """Per query: precision and recall at ``k`` and the reciprocal rank of the first relevant hit.

    ``relevant`` holds the result rows known to be relevant; ``totals`` the number of relevant items
    per query.  Queries without any result count as zero.
    """
    top = ranked.where(F.col("rank") <= k)
    hits = (top.join(relevant, ["query_id", "document_id", "chunk_index"], "left_semi")
            .groupBy("query_id").agg(F.count(F.lit(1)).alias("hits"), F.min("rank").alias("first")))
    n = F.coalesce("hits", F.lit(0)).cast("double")
    return (totals.join(hits, "query_id", "left").select(
        "query_id", (n / F.lit(float(k))).alias("precision_at_k"),
        ratio(n, F.col("relevant")).alias("recall_at_k"),
        F.coalesce(F.lit(1.0) / F.col("first"), F.lit(0.0)).alias("reciprocal_rank")))
