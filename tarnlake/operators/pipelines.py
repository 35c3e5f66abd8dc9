"""Steps put together: web and paper cleaning, classifier rows, Chinese keywords, labels from scores, embeddings."""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tarnlake.functions import clean, text
from tarnlake.operators.lookup import HOT_LEAST, hot_keys, lookup_join
from tarnlake.session import stage


def map_text(c: Column) -> Column:
    """Copyright comments cut, repeated sentences dropped, spaces made plain."""
    return clean.normalize_spaces(text.drop_repeated_sentences(clean.strip_copyright(c)))


_URL, _GARBLED = re.compile(r"https?://\S+"), re.compile(r"[^\x20-\x7e\u4e00-\u9fa5]+")
_NOT_WORD, _HAN_SPACE, _NO_KEY = re.compile(r"([^0-9A-Za-z_\u4e00-\u9fa5])\1+"), re.compile(r"(?<=[\u4e00-\u9fa5]) +"), re.compile(r"[^a-zA-Z0-9\u4e00-\u9fa5]+")
_BLOCK, _TOLD, _BREAK = re.compile(r"/\*[^*]*\*+(?:[^*/][^*]*\*+)*/"), re.compile("(?i)copyright | 版权"), re.compile(r"([.!?])(.)")


@lru_cache(maxsize=1)
def _special() -> re.Pattern:
    """The special signs among those that ``strip_garbled`` leaves."""
    return re.compile("[" + re.escape("".join(x for x in clean._special_set() if not _GARBLED.match(x))) + "]+")


def web_text(t: str | None, least: int = 50) -> str | None:
    """A web text cleaned, None if it is dropped: what ``strip_urls``, ``strip_garbled``, ``keep_special`` up to 0.5, ``clean_common``,
    ``map_text`` and ``keep_line`` say one after the other. Only printable ASCII and U+4E00-9FA5 pass the second, so all that these do with
    line ends, control characters, wide signs, other spaces and NFKC has nothing left to act on, and a text is one line.
    """
    if t is None:
        return None
    t = _GARBLED.sub("", _URL.sub("", t))
    if len(t) < least or 2 * (len(t) - len(_special().sub("", t))) > len(t):  # no later step makes a text longer
        return None
    t = _HAN_SPACE.sub("", _NOT_WORD.sub(r"\1", t.rstrip(" ")))
    if (m := _BLOCK.search(t)) and _TOLD.search(m[0]):
        t = t[: m.start()] + t[m.end() :]
    if t.startswith(("//", "#", "--")):
        return None
    sentences, known = _BREAK.sub(r"\1\n\2", t).split("\n"), set()
    for i, s in enumerate(sentences):
        if len(k := _NO_KEY.sub("", s)) >= 3:
            if k in known:
                sentences[i] = ""
            known.add(k)
    t = "".join(sentences).strip(" ")
    return t if len(t) >= least else None


@F.pandas_udf(StringType())
def _web_texts(texts: pd.Series) -> pd.Series:
    return texts.map(web_text)


def clean_web(df: DataFrame, column: str = "text", normalize: bool = True, perplexity: DataFrame | None = None, key: str = "doc_id", most: float = 2500.0) -> DataFrame:
    """Web texts: addresses and foreign signs removed, texts of over half special signs dropped, cleaned, mapped,
    kept if not too perplexing (``perplexity``: key, perplexity) and long enough. Rows that fail are left out.

    After common cleaning no line end survives, so a text that begins with # is one comment line and becomes empty.
    ``normalize`` changes nothing: what is left after foreign signs are removed is in NFKC.
    """
    # were it deterministic, the filter would be pushed below it and every text cleaned twice
    out = df.withColumn(column, _web_texts.asNondeterministic()(F.col(column))).where(F.col(column).isNotNull())
    return out if perplexity is None else out.join(perplexity.where(F.col("perplexity") <= most).select(key), key, "left_semi")


def clean_paper(df: DataFrame, column: str = "text", normalize: bool = True, perplexity: DataFrame | None = None, key: str = "doc_id", most: float = 2500.0) -> DataFrame:
    """Papers: cleaned and mapped, kept if not too perplexing."""
    out = df.withColumn(column, map_text(clean.clean_common(F.col(column), normalize)))
    return out if perplexity is None else out.join(perplexity.where(F.col("perplexity") <= most).select(key), key, "left_semi")


def classifier_row(label: Column, c: Column, stop_words: list[str]) -> Column:
    """(doc_label, doc_token, doc_keyword, doc_topic) of a labelled text: words of Latin letters, digits and Han characters only."""
    kept = F.regexp_replace(c, r"[^0-9A-Za-z\x{4e00}-\x{9fa5} ]", "")
    words = F.filter(F.split(kept, " "), lambda w: (w != "") & ~F.lower(w).isin(stop_words))
    none = F.array().cast("array<string>")
    return F.struct(F.array(label).alias("doc_label"), words.alias("doc_token"), none.alias("doc_keyword"), none.alias("doc_topic"))


def han_pairs(c: Column) -> Column:
    """Every pair of neighbouring Han characters: the default terms, where no segmenter is given."""
    return F.flatten(F.transform(F.regexp_extract_all(c, F.lit(rf"({clean.HAN}{{2,}})")), lambda r: F.transform(text.positions(F.length(r) - 1), lambda i: F.substring(r, i + 1, F.lit(2)))))


def classifier_row_han(label: Column, name: Column, c: Column, stop_words: list[str], terms=None) -> Column:
    """(doc_topic, doc_label, doc_token, doc_keyword) of a labelled text: its Han terms of two characters or more that are no stop words, without spaces."""
    found = F.transform((terms or han_pairs)(c), lambda w: F.regexp_replace(w, r"\s+", ""))
    kept = F.filter(found, lambda w: (F.length(w) >= 2) & w.rlike(clean.HAN) & ~w.isin(stop_words))
    return F.struct(F.array(label).alias("doc_topic"), F.array(name).alias("doc_label"), kept.alias("doc_token"), F.array(F.lit("")).alias("doc_keyword"))


def keywords_chinese(df: DataFrame, key: str = "doc_id", column: str = "text", top: int = 5, terms=None) -> DataFrame:
    """(key, keywords): the terms of highest frequency times rarity over all texts, for texts with Han characters.

    ``terms``: a function from text column to array of terms; the default takes pairs of Han characters. Counts are
    aggregated before they are shuffled; the table of document frequencies joins by shuffle, as its size isn't bounded.
    """
    docs = df.where(F.col(column).rlike(clean.HAN))
    counts = stage(docs.select(key, F.explode(text.runs((terms or han_pairs)(F.col(column)))).alias("r")).select(key, F.col("r.item").alias("term"), (-F.col("r.neg_count")).alias("n"), F.col("r.first").alias("first")), "counts")
    total = docs.agg(F.count("*").alias("total"))
    rare = counts.groupBy("term").agg(F.count("*").alias("df")).join(F.broadcast(total)).select("term", F.log(F.col("total") / F.col("df")).alias("idf"))
    n = counts.count()
    hot = hot_keys(counts.groupBy("term").agg(F.count("*").alias("c")), "term", "c", n) if n > HOT_LEAST else []
    rare = rare.withColumnRenamed("term", "rare_term")
    scored = lookup_join(counts, rare, F.col("term") == F.col("rare_term"), "term", "rare_term", hot, "inner").select(key, F.struct((-F.round(F.col("n") * F.col("idf"), 9)).alias("s"), "first", "term").alias("x"))
    # a document's terms are those of one text
    return scored.groupBy(key).agg(F.array_join(F.transform(F.slice(F.sort_array(F.collect_list("x")), 1, top), lambda x: x["term"]), ", ").alias("keywords"))


def labels_from_scores(scores: Column, names: list[str], top: int = 3, threshold: float = 0.5) -> Column:
    """The ``top`` names with scores over ``threshold``, best first; ties keep the order of names."""
    pairs = F.transform(scores, lambda s, i: F.struct((-s).alias("neg"), i.alias("i")))
    best = F.slice(F.sort_array(F.filter(pairs, lambda p: -p["neg"] > threshold)), 1, top)
    return F.transform(best, lambda p: F.element_at(F.array(*map(F.lit, names)), p["i"] + 1))


def message_score(c: Column) -> Column:
    """A stand-in for a reward model: between 0 and 1, by length, sentences and variety of words."""
    words = text.words(c)
    n = F.greatest(F.size(words), F.lit(1))
    variety = F.size(F.array_distinct(words)) / n
    return F.when(c.isNotNull(), 1 / (1 + F.exp(-(F.log1p(n.cast("double")) + variety - 3))))


def embed_udf(dim: int = 256):
    """A stand-in for an embedding model: hashed words and pairs of words, signed, at unit length; no words give zeros.

    Every Han character is a word, as no spaces stand between Han words.
    """
    word = re.compile(r"[㐀-鿿]|[^\s㐀-鿿]+")


    @F.pandas_udf("array<float>")
    def run(texts: pd.Series) -> pd.Series:
        out, known = [], {}  # of each word: its hash, and what follows the hash of the word before in that of the pair
        for t in texts:
            w = word.findall(t.lower()) if t else []
            for x in w:
                if x not in known:
                    e = x.encode()
                    known[x] = zlib.crc32(e), b" " + e
            w = [known[x] for x in w]
            h = np.array([x for x, _ in w] + [zlib.crc32(b, a) for (a, _), (_, b) in zip(w, w[1:])], np.uint32)
            n = np.bincount(h % dim * 2 + (h >> 31), minlength=2 * dim)
            v = (n[1::2] - n[::2]).astype(np.float32)
            n = np.linalg.norm(v)
            out.append(v / n if n else v)
        return pd.Series(out)

    return run


def registered_at(utc: Column) -> Column:
    """A time of the registry: eight hours ahead of UTC."""
    return F.from_utc_timestamp(utc, "Asia/Shanghai")


def dataset_lines(lines: DataFrame, dataset: str) -> DataFrame:
    """Lines whose id begins with the dataset's four digits, in the order of their trees."""
    return lines.where(F.left("line_id", F.lit(4)) == dataset).orderBy(F.col("indexID").asc_nulls_first(), "line_id")
