"""Citations, formatted results, grounded contexts and steps from answer texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.columns import fixed_point

# Instruction texts of the two templates.
QA_RULES = (
    "You are an IoT operations assistant helping troubleshoot industrial equipment.\n"
    "Answer the user's question using ONLY the provided context from equipment manuals and runbooks.\n\n"
    "Rules:\n"
    "- If the context doesn't contain the answer, say \"I don't have enough information to answer that question.\"\n"
    "- Always cite your sources using [1], [2], etc.\n"
    "- Be concise and practical\n"
    "- Focus on actionable steps when applicable")
GUIDE_RULES = (
    "You are an equipment troubleshooting assistant.\n"
    "Create a step-by-step troubleshooting guide for the error code below using the provided manual context.")
GUIDE_PARTS = (
    "Provide:\n"
    "1. A brief explanation of what this error means\n"
    "2. Step-by-step troubleshooting actions (numbered)\n"
    "3. Tools or parts needed (if any)\n"
    "4. Estimated time to resolve")
FALLBACK_STEP = "Follow manual instructions from citations below"
MIN_STEP_CHARS = 10


def citation_text() -> Column:
    return F.concat("title", F.lit(" (v"), "version", F.lit("), "), "doc_type", F.lit(", Chunk "),
                    F.col("chunk_index").cast("string"))


def with_citations(results: DataFrame, rank: str = "rank") -> DataFrame:
    """Adds the citation line and the citation record of each result row."""
    numbered = F.concat(F.lit("["), F.col(rank).cast("string"), F.lit("] "), citation_text())
    record = F.struct("title", "doc_type", "version", "chunk_index", "source_path", "score")
    return results.withColumns({"citation": numbered, "citation_record": record})


def format_results(results: DataFrame, rank: str = "rank", preview: int = 200) -> DataFrame:
    """One text block per result: rank, score to four decimals, citation, first characters."""
    block = F.concat(
        F.lit("Result "), F.col(rank).cast("string"), F.lit(" (score: "),
        fixed_point(F.col("score"), 4), F.lit(")\n"), F.col("citation"), F.lit("\nContent: "),
        F.substring("content", 1, preview), F.lit("..."))
    return with_citations(results, rank).withColumn("formatted", block)


def assemble_context(results: DataFrame, template: str = "qa", rank: str = "rank") -> DataFrame:
    """One prompt per query from its few result rows, in rank order.

    The rows of a query are bounded by the k of the search before it.
    """
    if template == "qa":
        block = F.concat(F.lit("["), F.col(rank).cast("string"), F.lit("] "), citation_text(),
                         F.lit("\n"), F.col("content"), F.lit("\n\n"))
    else:
        block = F.col("content")
    items = F.sort_array(F.collect_list(F.struct(F.col(rank).alias("r"), block.alias("b"))))
    sep = "" if template == "qa" else "\n\n"
    grouped = results.groupBy("query_id", "query_text").agg(
        F.array_join(F.transform(items, lambda x: x["b"]), sep).alias("context"),
        F.count(F.lit(1)).alias("context_used"))
    if template == "qa":
        prompt = F.concat(F.lit(f"<s>[INST] <<SYS>>\n{QA_RULES}\n<</SYS>>\n\nContext:\n"), "context",
                          F.lit("\n\nQuestion: "), "query_text", F.lit(" [/INST]"))
    else:
        prompt = F.concat(F.lit(f"<s>[INST] <<SYS>>\n{GUIDE_RULES}\n<</SYS>>\n\nError Code: "), "query_text",
                          F.lit("\n\nContext from manual:\n"), "context", F.lit(f"\n\n{GUIDE_PARTS} [/INST]"))
    return grouped.withColumn("prompt", prompt)


def extract_steps(texts: DataFrame, key: str, text: str = "text", fallback: bool = True) -> DataFrame:
    """Numbered or dashed lines as steps, renumbered; a text without any gets the fallback step."""
    line = F.regexp_replace("line", r"(?U)^\s+|\s+$", "")
    action = F.regexp_replace(line, r"^[0-9.\-) ]+", "")
    lines = (texts.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
             .where(line.rlike("^[0-9-]"))
             .select(key, "pos", action.alias("action"))
             .where(F.length("action") > MIN_STEP_CHARS))
    # A text's lines are on one row before the explode, so the window per text is bounded by it.
    steps = lines.select(key, F.row_number().over(W.partitionBy(key).orderBy("pos")).alias("step"), "action")
    if not fallback:
        return steps
    none = texts.select(key).join(steps.select(key).distinct(), key, "left_anti")
    return steps.unionByName(none.select(key, F.lit(1).alias("step"), F.lit(FALLBACK_STEP).alias("action")))
