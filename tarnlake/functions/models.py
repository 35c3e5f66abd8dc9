"""Injected models and their local defaults: quality classifier, language-model perplexity, annotators.

The published models behind these steps aren't available here; each is a strategy with a default that is trained
on the lake's own labels or counts, and makes no claim to the published quality.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.operators.lookup import HOT_LEAST, hot_keys, lookup_join
from tarnlake.session import stage

#: Presets: how texts are cut into words, and how scores decide.
PRESETS = {"gpt3": ("standard", "pareto"), "chinese": ("pieces", "label"), "code": ("pieces", "label")}


def predict_preset(df: DataFrame, model: PipelineModel, preset: str, pieces: str | None = None, seed: int = 42) -> DataFrame:
    """``predict_quality`` as a preset has it: its words (``pieces``: file of the piece model, where it takes one) and its rule."""
    if preset not in PRESETS:
        raise ValueError(f"no preset {preset}; there are {', '.join(PRESETS)}")
    words, method = PRESETS[preset]
    if words == "pieces":
        if not pieces:
            raise ValueError(f"{preset} needs a piece model")
        df = df.withColumn("words", pieces_udf(pieces)(F.col("text")))
    out = predict_quality(df, model, method, seed)
    return out.drop("words") if words == "pieces" else out


def training_sets(df: DataFrame, label: str, key: str, per_class: int | None = None, share: int = 80, seed: str = "42") -> DataFrame:
    """``df`` with part train or test by the key's hash, after at most ``per_class`` rows of each class are taken in seeded order."""
    from tarnlake.operators.lake import sample_per_class, split_three

    some = df if per_class is None else sample_per_class(df, label, key, per_class, seed)
    return split_three(some, key, (share, 0, 100 - share))


def labels_udf(predict: Callable[[list[str]], "object"], names: list[str], kind: str = "single") -> Callable[[Column], Column]:
    """Column function: probability by name from a model's raw scores, by softmax for one label or by sigmoid for many.

    ``predict``: a function from texts to a matrix of scores, one column a name; it is called per Arrow batch.
    """
    if kind not in ("single", "multi"):
        raise ValueError(f"unknown kind {kind}")

    @F.pandas_udf("map<string,double>")
    def run(texts: pd.Series) -> pd.Series:
        s = np.asarray(predict(texts.fillna("").tolist()), float).reshape(len(texts), len(names))
        if kind == "single":
            e = np.exp(s - s.max(1, keepdims=True))
            p = e / e.sum(1, keepdims=True)
        else:
            p = 1 / (1 + np.exp(-s))
        return pd.Series([dict(zip(names, map(float, r))) for r in p])

    return run


def pieces_udf(model_file: str) -> Callable[[Column], Column]:
    """Column function: the pieces of a text under a piece model, loaded once per Python worker."""
    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=model_file)
        return pd.Series([p.encode(t, out_type=str, num_threads=1) if t else [] for t in texts])

    return run


def train_quality(labelled: DataFrame, words: str | None = None, features: int = 1 << 18, rounds: int = 100) -> PipelineModel:
    """A classifier of (text, label 0 or 1): words, hashed term counts, logistic regression. ``words``: a column of ready words."""
    stages = [HashingTF(inputCol=words or "words", outputCol="features", numFeatures=features), LogisticRegression(maxIter=rounds)]
    if words is None:
        stages.insert(0, Tokenizer(inputCol="text", outputCol="words"))
    return Pipeline(stages=stages).fit(labelled)


def predict_quality(df: DataFrame, model: PipelineModel, method: str = "label", seed: int = 42) -> DataFrame:
    """``df`` with doc_score, the probability of class 1, and should_keep by ``method``; helper columns are dropped."""
    out = model.transform(df).withColumn("doc_score", F.get(vector_to_array("probability"), F.lit(1)))
    drop = [c for c in ("words", "features", "rawPrediction", "probability", "prediction") if c not in df.columns]
    return out.drop(*drop).withColumn("should_keep", keep_by_score(F.col("doc_score"), method, seed))


def keep_by_score(score: Column, method: str = "label", seed: int = 42) -> Column:
    """label: over one half; pareto: over 1 less a draw of the Pareto (Lomax) law of shape 9."""
    if method == "label":
        return (score > 0.5).cast("int")
    if method == "pareto":
        return (score > 1 - (F.pow(1 - F.rand(seed), F.lit(-1 / 9)) - 1)).cast("int")
    raise ValueError(f"unknown method {method}")


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: tp, fp, fn, tn (each plus one), precision, recall over the labelled positives, f1."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    c = df.agg(*[(F.count_if(x) + 1).alias(k) for k, x in (("tp", y & p), ("fp", ~y & p), ("fn", y & ~p), ("tn", ~y & ~p))], F.count_if(y).alias("actual"))
    c = c.withColumn("precision", F.col("tp") / (F.col("tp") + F.col("fp"))).withColumn("recall", F.try_divide(F.col("tp").cast("double"), F.col("actual").cast("double")))
    return c.withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).drop("actual")


def describe_score(df: DataFrame, score: str = "doc_score") -> DataFrame:
    """One row: count, mean, std, min, quartiles, max."""
    s = F.col(score)
    return df.agg(F.count(s).alias("n"), F.avg(s).alias("mean"), F.stddev_samp(s).alias("std"), F.min(s).alias("min"), *[F.percentile(s, q).alias(k) for k, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))], F.max(s).alias("max"))


def bigram_counts(df: DataFrame, words: str, least: int = 1) -> tuple[DataFrame, DataFrame]:
    """Counts of words and of neighbouring words over all rows, sentence ends as </s>; pre-aggregated before the shuffle."""
    ext = df.select(F.concat(F.array(F.lit("<s>")), F.filter(words, lambda w: w.isNotNull()), F.array(F.lit("</s>"))).alias("w"))
    pairs = ext.select(F.explode(F.transform(F.sequence(F.lit(0), F.size("w") - 2), lambda i: F.struct(F.get("w", i).alias("a"), F.get("w", i + 1).alias("b")))).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return pairs.groupBy("a").agg(F.sum("n").alias("n")), pairs


def perplexity(df: DataFrame, key: str, words: str, singles: DataFrame, pairs: DataFrame, alpha: float = 0.4, vocabulary: int = 100_000) -> DataFrame:
    """(key, perplexity) under the counted bigram model, add-alpha smoothed: 10 to minus the mean log10 probability of words and end.

    The pairs of all texts join the counts by shuffle, as neither side's size is bounded.
    """
    ext = df.select(key, F.concat(F.array(F.lit("<s>")), F.filter(words, lambda w: w.isNotNull()), F.array(F.lit("</s>"))).alias("w"))
    own = ext.select(key, F.explode(F.transform(F.sequence(F.lit(0), F.size("w") - 2), lambda i: F.struct(F.get("w", i).alias("a"), F.get("w", i + 1).alias("b")))).alias("p")).groupBy(key, "p.a", "p.b").agg(F.count("*").alias("k"))
    # a word like <s> begins a pair in every text: what is looked up for such words is broadcast, one row each
    begins = stage(own, "pairs")
    n = begins.count()
    hot = hot_keys(begins.groupBy("a").agg(F.count("*").alias("c")), "a", "c", n) if n > HOT_LEAST else []
    counted = pairs.join(singles.withColumnRenamed("n", "seen"), "a").select(F.concat_ws("\u0001", "a", "b").alias("ab"), "n", "seen")
    hot_pairs = begins.groupBy("a", "b").agg(F.count("*").alias("c")).select(F.concat_ws("\u0001", "a", "b").alias("ab"), "c")
    both = begins.withColumn("own", F.concat_ws("\u0001", "a", "b"))
    scored = lookup_join(both, counted, F.col("own") == F.col("ab"), "own", "ab", hot_keys(hot_pairs, "ab", "c", n) if n > HOT_LEAST else [])
    seen = singles.select(F.col("a").alias("first"), F.col("n").alias("alone"))
    scored = lookup_join(scored, seen, F.col("a") == F.col("first"), "a", "first", hot).withColumn("seen", F.coalesce("seen", "alone"))
    p = (F.coalesce("n", F.lit(0)) + alpha) / (F.coalesce("seen", F.lit(0)) + alpha * vocabulary)
    return scored.groupBy(key).agg(F.pow(F.lit(10.0), -F.sum(F.col("k") * F.log10(p)) / F.sum("k")).alias("perplexity"))


def annotate(df: DataFrame, steps: dict[str, Callable[[Column], Column]], text: str = "text") -> DataFrame:
    """``df`` with one column per annotator, in the order given; each maps the text column to a column."""
    for name, step in steps.items():
        df = df.withColumn(name, step(F.col(text)))
    return df


def word_flag(terms: list[str], yes: str, no: str) -> Callable[[Column], Column]:
    """A default annotator: ``yes`` if a text holds one of ``terms`` as words (Han terms anywhere), else ``no``."""
    import re

    han = [t for t in terms if "\u4e00" <= t[0] <= "\u9fff"]
    words = [t for t in terms if t not in han]
    pattern = "(?iU)" + "|".join([r"\b(?:" + "|".join(map(re.escape, words)) + r")\b"] * bool(words) + list(map(re.escape, han)))
    return lambda c: F.when(c.rlike(pattern), yes).otherwise(no)


#: Phrases of offers and calls to buy, by language: what the default of the advertising flag looks for.
AD_PHRASES = {
    "en": ["buy now", "discount", "click here", "click now", "special offer", "subscribe", "promo code", "limited time offer", "order now", "order today", "free shipping", "money back guarantee", "call now", "best price", "act now", "sign up today", "coupon", "sponsored"],
    "zh": ["立即购买", "马上购买", "点击购买", "优惠券", "促销", "特价", "限时抢购", "包邮", "扫码关注", "加微信", "免费领取", "折扣"],
    "de": ["jetzt klicken", "jetzt kaufen", "jetzt bestellen", "rabatt", "gutschein", "sonderangebot", "kostenloser versand", "nur heute", "geld zurück"],
    "fr": ["achetez maintenant", "commandez maintenant", "offre spéciale", "code promo", "livraison gratuite", "cliquez ici", "soldes", "réduction immédiate", "satisfait ou remboursé"],
    "es": ["haz clic", "compra ahora", "compre ahora", "oferta especial", "código promocional", "envío gratis", "descuento", "pide ya", "solo hoy"],
    "ru": ["купить сейчас", "купите сейчас", "закажите сейчас", "скидка", "скидки", "промокод", "бесплатная доставка", "специальное предложение", "только сегодня", "распродажа"],
}
#: Default of the advertising flag.
advertising = word_flag([p for ps in AD_PHRASES.values() for p in ps], "ad", "not-ad")


def load_model(path: str, unpack_to: str | None = None) -> PipelineModel:
    """A saved pipeline; a zip archive is unpacked first."""
    if path.endswith(".zip"):
        import os
        import zipfile

        target = unpack_to or path[: -len(".zip")]
        with zipfile.ZipFile(path) as z:
            z.extractall(target)
        inner = os.listdir(target)
        path = target if "metadata" in inner or len(inner) != 1 else os.path.join(target, inner[0])
    return PipelineModel.load(path)


def train_labels(labelled: DataFrame, n: int = 3, features: int = 1 << 15) -> PipelineModel:
    """A default classifier of (text, label string) by hashed character n-grams and naive Bayes: languages, topics, flags."""
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import IndexToString, NGram, RegexTokenizer, StringIndexer

    index = StringIndexer(inputCol="label", outputCol="label_no", handleInvalid="skip").fit(labelled)
    return Pipeline(
        stages=[index, RegexTokenizer(inputCol="text", outputCol="letters", pattern="", minTokenLength=1), NGram(n=n, inputCol="letters", outputCol="grams"), HashingTF(inputCol="grams", outputCol="features", numFeatures=features), NaiveBayes(labelCol="label_no"), IndexToString(inputCol="prediction", outputCol="said", labels=index.labels)]
    ).fit(labelled)
