import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnlake.functions import clean, text


def one(spark, make, *values, types="string"):
    df = spark.createDataFrame([(v,) for v in values], f"t {types}")
    return [r[0] for r in df.select(make(F.col("t"))).collect()]


def test_clean(spark):
    assert one(spark, clean.clean_common, "「a」  b\r\n\n\nc!!  ", "中文 字 abc", None, "", "ﬁ１") == ['"a" b c!', "中文字abc", None, "", "fi1"]
    assert one(spark, clean.clean_chat, "ab\n\ncd") == ["abcd"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB1 \n\t.!中é「」", max_size=30), min_size=1, max_size=20))
def test_clean_twice_is_once(spark, texts):
    once = one(spark, clean.clean_common, *texts)
    assert one(spark, clean.clean_common, *once) == once


def test_ratios(spark):
    assert one(spark, clean.control_ratio, "a\tb\n", "", None) == [0.5, None, None]
    assert one(spark, clean.keep_line, "x" * 50, "x" * 49, "", None, "\x01" * 10 + "x" * 50) == [True, False, False, None, False]
    assert one(spark, clean.special_ratio, "ab1!", "", None, "abcd") == [0.5, 0.0, None, 0.0]


def test_strips(spark):
    assert one(spark, clean.strip_urls, "a https://x.y/z?q=1 b http://c") == ["a  b "]
    assert one(spark, clean.strip_garbled, "aé中\n") == ["a中"]
    assert one(spark, clean.normalize_spaces, " a b　c​ ") == ["a b c "]
    assert one(spark, clean.strip_copyright, "/* Copyright 1 */x", "/* other */x", "# a\n\n// b\ncode\n# c", "/* a */ /* copyright b */x", None) == ["x", "/* other */x", "code\n# c", "/* a */ /* copyright b */x", None]
    assert one(spark, lambda c: clean.normalize_for_model(c, True, True), " Été 12、x\x07") == ["ete 00,x"]


def test_ngrams(spark):
    rate = lambda n: lambda c: text.ngram_repeat_rate(c, n)
    assert one(spark, rate(5), "a b c d e a b c d e", "short text", "", None) == [pytest.approx(1 / 6), 0.0, 0.0, None]
    assert one(spark, rate(2), "aaaa") == [pytest.approx(1 / 3)]


def test_keywords_and_sentences(spark):
    assert one(spark, lambda c: text.keywords(c, ["the"]), "b a, the The a c b. d-e x1", "", None) == ["b, a, c", "", None]
    assert one(spark, text.split_sentences, "a.b!c”d") == [["a.", "b!", "c”d"]]
    assert one(spark, text.drop_repeated_sentences, "abc. abc.def.\nabc.\nx", "", None, "\n\n") == ["abc.def.\n\nx", "", None, "\n\n"]


def test_complexity(spark):
    assert one(spark, text.complexity, "One two. Three four five.", "", None) == [pytest.approx(0.3 * 5 / 3 + 0.6), 0.0, None]
    assert one(spark, text.complexity, "中文字。") == [pytest.approx(0.3 * 4 / 2 + 0.3 + 0.4 * 2)]


def chunks_in_python(t, size, overlap):
    if len(t) <= size:
        return [t]
    out, at = [], 0
    while at < len(t) - size:
        out.append(t[at : at + size])
        at += size - overlap
    last = t[at:]
    return [*out, last if len(last) == size else out[-1][-(size - len(last) + 1) : -1] + last]


@pytest.mark.parametrize("n", [0, 1, 10, 11, 17, 18, 25, 26, 100])
def test_chunks(spark, n):
    t = "".join(chr(97 + i % 26) for i in range(n))
    assert one(spark, lambda c: text.chunks(c, 10, 3), t) == [chunks_in_python(t, 10, 3)]


def test_chunk_counts(spark):
    assert [len(x) for x in one(spark, text.chunks, "x" * 10_000, "x" * 10_129)] == [2, 3]


def test_ids(spark):
    got = spark.range(1).select(text.line_id(F.lit(26), F.lit(0), F.lit(10)), text.point_id(F.lit("a"), F.lit(3))).collect()[0]
    assert got[0] == "001a00000000000a" and got[1].endswith("00000003") and len(got[1]) == 32


def test_long_text(spark):
    t = "word and more " * 40_000
    assert len(one(spark, clean.clean_common, t)[0]) == len(t) - 1
    assert one(spark, lambda c: text.ngram_repeat_rate(c, 5), t)[0] < 0.01


def test_nfkc_is_the_usual_one(spark):
    assert one(spark, clean.nfkc, "Ⅷ", "ｶﾞ") == [unicodedata.normalize("NFKC", x) for x in ("Ⅷ", "ｶﾞ")]


def test_chunk_table_cuts_as_the_column_function(spark):
    from tarnlake.functions import text

    spark.udtf.register("chunk_table", text.chunk_table())
    df = spark.createDataFrame([(i, "".join(chr(97 + (i * j) % 26) for j in range(n))) for i, n in enumerate((0, 5, 10, 11, 18, 19, 27, 40))] + [(99, None)], "i int, t string")
    want = {(r.i, r.n, r.c) for r in df.select("i", F.posexplode(text.chunks(F.col("t"), 10, 2)).alias("n", "c")).collect()}
    df.createOrReplaceTempView("texts_")
    got = {(r.i, r.chunk_no, r.chunk) for r in spark.sql("select i, chunk_no, chunk from texts_, lateral chunk_table(t, 10, 2)").collect()}
    assert got == want
