"""Queries of classifiers, scores and language models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions import models
from tarnlake.functions.text import words
from tarnlake.session import table


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a score and a label that any engine computes alike."""
    return table(spark, sf, "documents").select("doc_id", ((F.col("doc_id") * 37 % 101) / 100.0).alias("doc_score"), (F.col("n_chars") > 800).cast("int").alias("label"))


def quality_eval_counts(spark: SparkSession, sf: str) -> DataFrame:
    return models.evaluate(_scored(spark, sf).withColumn("prediction", (F.col("doc_score") > 0.5).cast("int")))


def score_describe(spark: SparkSession, sf: str) -> DataFrame:
    d = models.describe_score(_scored(spark, sf))
    return d.select("n", *[F.round(c, 9).alias(c) for c in d.columns if c != "n"])


def keep_label(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select("doc_id", models.keep_by_score(F.col("doc_score")).alias("should_keep"))


def ml_tokens(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml.feature import Tokenizer

    d = table(spark, sf, "documents").where("text is not null")
    return Tokenizer(inputCol="text", outputCol="words").transform(d).select("doc_id", F.size("words").cast("long").alias("n_words"), F.get("words", F.lit(0)).alias("first_word"))


def quality_predict(spark: SparkSession, sf: str) -> DataFrame:
    """A quality classifier on judged documents: those that a reviewer found to be about something count as good."""
    docs = table(spark, sf, "documents").where("text is not null").select("doc_id", "line_id", "text")
    judged = table(spark, sf, "review_label").where("subjects is not null").groupBy("line_id").agg(F.max((F.size("subjects") > 0).cast("int")).alias("label"))
    model = models.train_quality(docs.join(judged, "line_id").select("text", "label"), features=1 << 14, rounds=20)
    return models.predict_quality(docs, model).select("doc_id", F.round("doc_score", 3).alias("doc_score"), "should_keep")


def lm_perplexity(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").where("text is not null").select("doc_id", words(F.lower("text")).alias("w"))
    singles, pairs = models.bigram_counts(d, "w")
    return models.perplexity(d, "doc_id", "w", singles, pairs).select("doc_id", F.round("perplexity", 3).alias("perplexity"))


def annotate_ads(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "text")
    return models.annotate(d, {"ad_subject": models.advertising}).select("doc_id", "ad_subject")


_SCORED = "s as (select doc_id, (doc_id * 37 % 101) / 100.0 doc_score, case when n_chars > 800 then 1 else 0 end label from documents)"
_ADS = [p for ps in models.AD_PHRASES.values() for p in ps]
AD_PATTERN = r"(?i)(?:(?:^|[^\p{L}\p{N}_])(?:" + "|".join(p for p in _ADS if p[0] < "\u4e00") + r")(?:$|[^\p{L}\p{N}_])|" + "|".join(p for p in _ADS if p[0] >= "\u4e00") + ")"

QUERIES = {f.__name__: f for f in (quality_eval_counts, score_describe, keep_label, ml_tokens, quality_predict, lm_perplexity, annotate_ads)}
SQL = {
    "quality_eval_counts": f"""with {_SCORED}, c as (select count(*) filter (label = 1 and doc_score > 0.5) + 1 tp, count(*) filter (label <> 1 and doc_score > 0.5) + 1 fp, count(*) filter (label = 1 and doc_score <= 0.5) + 1 fn, count(*) filter (label <> 1 and doc_score <= 0.5) + 1 tn, count(*) filter (label = 1) actual from s),
p as (select *, tp / (tp + fp) "precision", tp / nullif(actual, 0) recall from c) select tp, fp, fn, tn, "precision", recall, 2 * "precision" * recall / ("precision" + recall) f1 from p""",
    "score_describe": f"with {_SCORED}, d as (select cast(doc_score as double) x from s) select count(x) n, round(avg(x), 9) mean, round(stddev_samp(x), 9) std, round(min(x), 9) min, round(quantile_cont(x, 0.25), 9) p25, round(quantile_cont(x, 0.5), 9) p50, round(quantile_cont(x, 0.75), 9) p75, round(max(x), 9) max from d",
    "keep_label": f"with {_SCORED} select doc_id, case when doc_score > 0.5 then 1 else 0 end should_keep from s",
    "ml_tokens": r"select doc_id, case when text = '' then 1 when t = '' then 0 else len(w) end n_words, case when text = '' then '' when t = '' then null else w[1] end first_word from (select doc_id, text, t, string_split_regex(t, '[\t-\r ]') w from (select *, regexp_replace(lower(text), '[\t-\r ]+$', '') t from documents where text is not null))",
    "annotate_ads": f"select doc_id, case when regexp_matches(text, '{AD_PATTERN}') then 'ad' else 'not-ad' end ad_subject from documents",
    "lm_perplexity": r"""
with w as (select doc_id, list_concat(list_concat(['<s>'], list_filter(list_transform(regexp_split_to_array(lower(text), '[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda w: regexp_replace(w, '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g')), lambda w: w <> '')), ['</s>']) w from documents where text is not null),
own as (select doc_id, w[i] a, w[i + 1] b, count(*) k from (select doc_id, w, unnest(range(1, len(w))) i from w) group by all),
pairs as (select a, b, sum(k) n from own group by all), singles as (select a, sum(n) seen from pairs group by 1)
select doc_id, round(pow(10, -sum(k * log10((n + 0.4) / (seen + 40000.0))) / sum(k)), 3) perplexity from own join pairs using (a, b) join singles using (a) group by 1""",
}
