"""Sources mixed to target shares of a total size, without sorting.

Every document has a hash. Tokens are summed by source and hash bucket; the running sum over buckets tells in
which bucket a source's budget ends, and only that bucket is summed again, by finer buckets, until the threshold
is exact. A document is in if its hash lies below its source's threshold, so a larger budget holds a smaller one's
documents. A source smaller than its budget is taken whole as often as it fits, and the rest by threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.tokens import VOCABULARY, count_tokens_udf
from tarnlake.session import stage

#: Bits of the hash that a refinement resolves, and how many refinements there are.
BITS, LEVELS = 10, 5


def named_source(c: Column) -> Column:
    """A source name without case, outer white space and with one underscore for every separator; blank is null."""
    t = F.regexp_replace(F.lower(F.trim(c)), r"[\s\-_./]+", "_")
    return F.when(t != "", t)


def sized(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens, h): documents with their tokens and a hash of BITS * LEVELS bits, staged."""
    h = F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.lit("mix")), 64 - BITS * LEVELS)
    return stage(documents.select("doc_id", named_source(F.col("source")).alias("source"), count_tokens_udf(vocabulary)("text").alias("n_tokens"), h.alias("h")), "sized")


def budgets(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per mix and source: share (of the mix's, made to sum to one), wanted tokens, tokens there, whole
    repeats and the budget left for a part, which is less than the source's tokens.

    Rows of ``targets`` without mix, source or a positive share have no effect; of repeated rows the shares add up
    and the lowest cap counts. A source without documents gets nothing.
    """
    per_source = sizes.where("source is not null").groupBy("source").agg(F.sum("n_tokens").alias("there"))
    total = sizes.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("total"))
    t = targets.select("mix_name", named_source(F.col("source")).alias("source"), "target_share", "max_repeats", "size_factor").where("mix_name is not null and source is not null and target_share > 0")
    t = t.groupBy("mix_name", "source").agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"), F.max("size_factor").alias("size_factor"))
    share = F.col("target_share") / F.sum("target_share").over(Window.partitionBy("mix_name"))
    t = t.withColumn("share", share).join(F.broadcast(total)).join(F.broadcast(per_source.join(F.broadcast(t.select("source").distinct()), "source", "left_semi")), "source", "left")
    wanted = F.col("share") * F.coalesce("size_factor", F.lit(1.0)) * F.col("total")
    there = F.coalesce("there", F.lit(0))
    t = t.select("mix_name", "source", "max_repeats", "share", wanted.alias("wanted"), there.alias("there"))
    most = F.when(F.col("max_repeats").isNull(), F.col("wanted")).otherwise(F.least("wanted", F.greatest("max_repeats", F.lit(0)) * F.col("there")))
    t = t.withColumn("budget", F.when(F.col("there") > 0, most).otherwise(F.lit(0.0)))
    repeats = F.when(F.col("there") > 0, F.floor(F.col("budget") / F.col("there"))).otherwise(F.lit(0)).cast("long")
    return t.withColumn("whole", repeats).withColumn("part", F.col("budget") - F.col("whole") * F.col("there"))


def thresholds(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with the hash threshold of each part: documents of the source with h < threshold are taken once more.

    The number of plan rows is that of target rows; each level's histogram has at most 2**BITS rows for each.
    """
    left = plan.withColumn("low", F.lit(0).cast("long"))
    for level in range(LEVELS):
        width = 1 << (BITS * (LEVELS - 1 - level))
        span = width << BITS
        inside = sizes.join(F.broadcast(left.where("part > 0").select("mix_name", "source", "low")), "source").where((F.col("h") >= F.col("low")) & (F.col("h") < F.col("low") + span))
        hist = inside.groupBy("mix_name", "source", F.floor((F.col("h") - F.col("low")) / width).alias("bucket")).agg(F.sum("n_tokens").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("mix_name", "source").orderBy("bucket"))
        sums = hist.withColumn("upto", upto).join(F.broadcast(left.select("mix_name", "source", "part")), ["mix_name", "source"])
        over = F.min(F.when(F.col("upto") > F.col("part"), F.col("bucket")))  # empty buckets may lie before it
        best = sums.groupBy("mix_name", "source").agg(F.max(F.when(F.col("upto") <= F.col("part"), F.col("upto"))).alias("used"), F.coalesce(over, F.max("bucket") + 1).alias("buckets"))
        left = stage(left.join(best, ["mix_name", "source"], "left").select(*plan.columns[:-1], (F.col("part") - F.coalesce("used", F.lit(0))).alias("part"), (F.col("low") + F.coalesce("buckets", F.lit(0)) * width).cast("long").alias("low")), "thresholds")
    return left.withColumnRenamed("low", "threshold")


def mix(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY, sizes_given: bool = False) -> tuple[DataFrame, DataFrame]:
    """(mix_name, doc_id, source, n_tokens, copies) of every document that a mix holds, and the report per mix and
    source: target and actual share, tokens wanted and taken, documents, and the most copies of one.

    ``documents`` (doc_id, source, text), ``targets`` (mix_name, source, target_share, max_repeats, size_factor).
    ``sizes_given``: documents have n_tokens and h, a hash of BITS * LEVELS bits, in place of text.
    A source ends at most one document short of its budget, or at its cap; other sources aren't stretched to
    make up for it, the report shows the difference. Documents without source or tokens enter no mix.
    """
    sizes = stage(documents.select("doc_id", named_source(F.col("source")).alias("source"), "n_tokens", "h"), "sized") if sizes_given else sized(documents, vocabulary)
    plan = budgets(sizes, targets)
    cut = thresholds(sizes, plan)
    rows = sizes.where("n_tokens > 0").join(F.broadcast(cut.select("mix_name", "source", "whole", "threshold")), "source")
    rows = rows.select("mix_name", "doc_id", "source", "n_tokens", (F.col("whole") + (F.col("h") < F.col("threshold")).cast("long")).alias("copies")).where("copies > 0")
    taken = rows.groupBy("mix_name", "source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("taken"), F.count("*").alias("n_docs"), F.max("copies").alias("most_copies"))
    report = cut.join(taken, ["mix_name", "source"], "left").select("mix_name", "source", F.col("share").alias("target_share"), F.col("wanted").alias("wanted_tokens"), "there", F.coalesce("taken", F.lit(0)).alias("taken_tokens"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"))
    every = F.sum("taken_tokens").over(Window.partitionBy("mix_name"))
    return rows, report.withColumn("actual_share", F.when(every > 0, F.col("taken_tokens") / every).otherwise(F.lit(0.0)))
