"""Queries that clean, measure and cut the documents' texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions import clean, text
from tarnlake.functions.fixed import OTHER_SPECIAL
from tarnlake.operators.lookup import HOT_LEAST, hot_keys, lookup_join
from tarnlake.session import table

#: English stop words for keywords; a parameter of the operator.
STOP_WORDS = "i me my we our you your he him his she her it its they them their what which who this that these those am is are was were be been being have has had do does did a an the and but if or because as until while of at by for with about against between into through during before after above below to from up down in out on off over under again then once here there when where why how all any both each few more most other some such no nor not only own same so than too very s t can will just don should now".split()


def _per_text(make):
    """A query of doc_id and the columns that ``make`` builds from the text; they are built when it runs."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return table(spark, sf, "documents").select("doc_id", *(c.alias(k) for k, c in make(F.col("text")).items()))

    return run


_S = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _sql_tidy(blank: str) -> str:
    s = "regexp_replace(text, '[「」｢｣『』]', '\"', 'g')"
    for a, b in (("\\r", "\\n"), ("\\n\\n", blank), (rf"\n{_S}*\n", "\\n"), ("\\n+", "\\n")):
        to = {"\\n": "chr(10)", "": "''"}[b]
        s = f"regexp_replace({s}, '{a}', {to}, 'g')"
    s = f"regexp_replace({s}, '{_S}+$', '')"
    s = f"regexp_replace({s}, '{_S}+', ' ', 'g')"
    return s


_COLLAPSE = r"array_to_string(list_filter({a}, lambda x, i: i = 1 or x <> {a}[i - 1] or regexp_matches(x, '[\p{{L}}\p{{N}}_]')), '')"


def _sql_clean(blank: str) -> str:
    once = _COLLAPSE.format(a="a")
    return rf"""select doc_id, regexp_replace({once}, '([\x{{4e00}}-\x{{9fff}}]){_S}+', '\1', 'g') cleaned
from (select doc_id, text, string_split({_sql_tidy(blank)}, '') a from documents)"""


_NGRAM = r"""
with tok as (select doc_id, text, case when text is null then null when contains(text, ' ') then list_filter(regexp_split_to_array(text, '{s}+'), lambda w: w <> '') else list_filter(string_split(text, ''), lambda w: w <> '') end t from documents),
g as (select doc_id, unnest(list_transform(range(1, len(t) - {n} + 2), lambda i: array_to_string(t[i:i + {n} - 1], chr(1)))) g from tok where len(t) >= {n}),
c as (select doc_id, g, count(*) n from g group by all),
r as (select doc_id, count(*) filter (n > 1) / sum(n) rate from c group by 1)
select d.doc_id, case when d.text is null then null else coalesce(r.rate, 0.0) end rate from documents d left join r using (doc_id)"""

_WORDS = rf"list_filter(list_transform(regexp_split_to_array(text, '{_S}+'), lambda w: regexp_replace(w, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g')), lambda w: w <> '')"
_TERMS = r"list_distinct(flatten(list_transform(regexp_extract_all({c}, '[\x{{4e00}}-\x{{9fff}}]{{2,}}'), lambda r: list_transform(range(1, length(r)), lambda i: substr(r, i, 2)))))"
_LATIN = r"len(list_filter(regexp_extract_all({c}, '[\p{{L}}\p{{N}}_]+'), lambda w: regexp_full_match(w, '[a-zA-Z]+')))"


def chunk_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every chunk of every document, with its number."""
    d = table(spark, sf, "documents").where("text is not null")
    return d.select("doc_id", F.posexplode(text.chunks(F.col("text"))).alias("chunk_no", "chunk")).select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), "chunk", text.point_id(F.col("chunk"), F.col("chunk_no")).alias("point_id"))


def head_tail_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """First and last chunk of every document."""
    c = text.chunks(F.col("text"), 400, 100)
    d = table(spark, sf, "documents").where("text is not null").select("doc_id", c.alias("c"))
    return d.select("doc_id", F.size("c").cast("long").alias("n_chunks"), F.element_at("c", 1).alias("head"), F.element_at("c", -1).alias("tail"))


def sentence_rows(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").where("text is not null")
    return d.select("doc_id", F.posexplode(text.split_sentences(F.col("text"))).alias("at", "sentence")).where("sentence <> ''").groupBy("doc_id").agg(F.count("*").alias("n_sentences"), F.max(F.length("sentence")).cast("long").alias("longest"))


def qa_complexity(spark: SparkSession, sf: str) -> DataFrame:
    """Complexity of each question with each of its answers."""
    m = table(spark, sf, "text_line_sft").where("content is not null").groupBy("line_id").agg(F.max("content").alias("content"), F.max(F.lower(F.trim("frontID"))).alias("front"))
    q = m.select(F.col("line_id").alias("front"), F.col("content").alias("question"))
    asked = q.withColumnRenamed("front", "asked")
    n = m.count()
    hot = hot_keys(m.groupBy("front").agg(F.count("*").alias("n")), "front", "n", n) if n > HOT_LEAST else []
    r = lookup_join(m, asked, F.col("front") == F.col("asked"), "front", "asked", hot, "inner").select("line_id", text.complexity_qa(F.col("question"), F.col("content")).alias("c"))
    return r.select("line_id", F.round("c.overall", 6).alias("overall"), F.round("c.term", 6).alias("term"), F.col("c.syntactic").cast("long").alias("syntactic"))


# Code points with the Emoji property, beyond ASCII and without the letters of flags, as ranges.
_EMOJI = (
    "A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 260E 2611 2614-2615 "
    "2618 261D 2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642 2648-2653 265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 "
    "26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716 271D 2721 2728 "
    "2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 "
    "1F0CF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F201-1F202 1F21A 1F22F 1F232-1F23A 1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570 1F573-1F57A "
    "1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2 1F6D5-1F6D9 1F6DC-1F6E5 1F6E9 "
    "1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945 1F947-1F9FF 1FA70-1FA7C 1FA80-1FAC6 1FAC8 1FACC-1FADD 1FADF-1FAEB 1FAEF-1FAFA "
)
_SPECIAL = "[!-@\\[-`{-~\\x09-\\x0d " + "".join(f"\\x{{{ord(c):x}}}" for c in OTHER_SPECIAL) + "".join("-".join(rf"\x{{{p}}}" for p in r.split("-")) for r in _EMOJI.split()) + "]"

QUERIES = {
    "clean_common": _per_text(lambda t: dict(cleaned=clean.clean_common(t, normalize=False))),
    "clean_common_nfkc": _per_text(lambda t: dict(cleaned=clean.clean_common(t))),
    "clean_chat": _per_text(lambda t: dict(cleaned=clean.clean_chat(t, normalize=False))),
    "strip_urls": _per_text(lambda t: dict(cleaned=clean.strip_urls(F.concat(F.lit("see http://a.b/c?d=1 and "), t, F.lit(" https://x.y/z end"))))),
    "strip_garbled": _per_text(lambda t: dict(cleaned=clean.strip_garbled(t))),
    "control_ratio": _per_text(lambda t: dict(ratio=clean.control_ratio(t), keep=clean.keep_line(t))),
    "special_char_ratio": _per_text(lambda t: dict(ratio=clean.special_ratio(t), keep=clean.keep_special(t, 0.0, 0.25))),
    "ws_normalize": _per_text(lambda t: dict(cleaned=clean.normalize_spaces(F.concat(F.lit(" 　"), t, F.lit("​\t"))))),
    "copyright_strip": _per_text(lambda t: dict(cleaned=clean.strip_copyright(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("/* Copyright 2020 */"), t)).otherwise(F.concat(F.lit("// note\n\n"), t))))),
    "repeat_sentence_dedup": _per_text(lambda t: dict(cleaned=text.drop_repeated_sentences(t))),
    "ngram_repeat_5": _per_text(lambda t: dict(rate=text.ngram_repeat_rate(t, 5))),
    "ngram_repeat_9": _per_text(lambda t: dict(rate=text.ngram_repeat_rate(t, 9))),
    "keywords_top5": _per_text(lambda t: dict(keywords=text.keywords(t, STOP_WORDS))),
    "complexity_single": _per_text(lambda t: dict(complexity=F.round(text.complexity(t), 6))),
    "complexity_qa": qa_complexity,
    "lm_normalize": _per_text(lambda t: dict(cleaned=clean.normalize_for_model(t, lower=True))),
    "sentences": sentence_rows,
    "chunks": chunk_rows,
    "head_tail_chunks": head_tail_chunks,
}

_ONCE = "string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '([.。！!?])([^’”])', '\\1' || chr(10) || '\\2', 'g'), '(\\.{{6}})([^’”])', '\\1' || chr(10) || '\\2', 'g'), '(…{{2}})([^’”])', '\\1' || chr(10) || '\\2', 'g'), '([.。！!?{{}}26…][’”])([^’”])', '\\1' || chr(10) || '\\2', 'g'), chr(10))"
_PARTS = "(case when zh then len(string_split_regex({c}, '[.?!。？！]')) else len(string_split_regex({c}, '[.?!]')) end)"


def _sql_lm() -> str:
    from tarnlake.functions.fixed import PUNCTUATION_TABLE

    s = rf"regexp_replace(lower(regexp_replace(text, '^{_S}+|{_S}+$', '', 'g')), '\p{{Nd}}', '0', 'g')"
    q = lambda x: "'" + x.replace("'", "''") + "'"
    for k, v in PUNCTUATION_TABLE.items():
        if len(v) != 1:
            s = f"replace({s}, {q(k)}, {q(v)})"
    single = {k: v for k, v in PUNCTUATION_TABLE.items() if len(v) == 1}
    return rf"select doc_id, regexp_replace(translate({s}, {q(''.join(single))}, {q(''.join(single.values()))}), '[\x00-\x1f\x7f-\x{{9f}}]', '', 'g') cleaned from documents"


def _sql_spaces() -> str:
    from tarnlake.functions.fixed import VARIOUS_SPACES

    chars = " || ".join(f"chr({ord(c)})" for c in VARIOUS_SPACES)
    return rf"select doc_id, translate(regexp_replace(' ' || chr(12288) || text || chr(8203) || chr(9), '^{_S}+|{_S}+$', '', 'g'), {chars}, '{' ' * len(VARIOUS_SPACES)}') cleaned from documents"


def _chunk_sql(size: int, overlap: int) -> str:
    step = size - overlap
    return f"""
with n as (select doc_id, text, length(text) n, case when length(text) <= {size} then 1 else cast(ceil((length(text) - {size}) / {step}.0) as bigint) + 1 end k from documents where text is not null),
c as (select doc_id, text, n, k, unnest(range(0, k)) i from n),
p as (select *, substr(text, i * {step} + 1) tail_, {size} - length(substr(text, i * {step} + 1)) missing from c),
chunks as (select doc_id, i chunk_no, k, case when k = 1 then text when i < k - 1 then substr(text, i * {step} + 1, {size})
  when missing > 0 then substr(text, (i - 1) * {step} + {size} - missing, missing) || tail_ else tail_ end chunk from p)"""


SQL = {
    "clean_common": _sql_clean("\\n"),
    "clean_chat": _sql_clean(""),
    "strip_urls": rf"select doc_id, regexp_replace('see http://a.b/c?d=1 and ' || text || ' https://x.y/z end', 'https?://[^{_S[1:-1]}]+', '', 'g') cleaned from documents",
    "strip_garbled": r"select doc_id, regexp_replace(text, '[^\x20-\x7e\x{4e00}-\x{9fa5}]+', '', 'g') cleaned from documents",
    "control_ratio": r"select doc_id, length(regexp_replace(text, '[^\p{Cc}]', '', 'g')) / nullif(length(text), 0) ratio, case when text is null then null else coalesce(length(regexp_replace(text, '[^\p{Cc}]', '', 'g')) / nullif(length(text), 0) <= 0.03 and length(text) >= 50, false) end keep from documents",
    "special_char_ratio": rf"select doc_id, r ratio, r between 0 and 0.25 keep from (select doc_id, case when length(text) = 0 then 0.0 else (length(text) - length(regexp_replace(text, '{_SPECIAL}', '', 'g'))) / length(text) end r from documents)",
    "ws_normalize": _sql_spaces(),
    "copyright_strip": r"""select doc_id, regexp_replace(case when doc_id % 2 = 0 then text else '// note' || chr(10) || chr(10) || text end, '^(?:(?://|#|--)[^\n]*(?:\n|\z)|\n)+', '') cleaned from documents""",
    "repeat_sentence_dedup": f"""
with l as (select doc_id, i, string_split(text, chr(10))[i] line from (select doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) i from documents where text is not null)),
s as (select doc_id, i, j, (case when line = '' then [''] else {_ONCE.format(c='line')} end)[j] s from (select doc_id, i, line, unnest(range(1, len(case when line = '' then [''] else {_ONCE.format(c='line')} end) + 1)) j from l)),
k as (select *, regexp_replace(s, '[^a-zA-Z0-9\\x{{4e00}}-\\x{{9fa5}}]', '', 'g') k from s),
f as (select *, row_number() over (partition by doc_id, k order by i, j) r from k),
o as (select doc_id, i, string_agg(case when length(k) < 3 or r = 1 then s else '' end, '' order by j) line from f group by 1, 2),
d as (select doc_id, string_agg(line, chr(10) order by i) cleaned from o group by 1)
select doc_id, d.cleaned from documents left join d using (doc_id)""",
    "ngram_repeat_5": _NGRAM.format(n=5, s=_S),
    "ngram_repeat_9": _NGRAM.format(n=9, s=_S),
    "keywords_top5": rf"""
with w as (select doc_id, list_filter({_WORDS}, lambda w: regexp_full_match(w, '\p{{L}}+') and not list_contains([{', '.join("'" + w + "'" for w in STOP_WORDS)}], lower(w))) w from documents where text is not null),
u as (select doc_id, w[i] tok, i from (select doc_id, w, unnest(range(1, len(w) + 1)) i from w)),
c as (select doc_id, tok, count(*) n, min(i) first_ from u group by 1, 2),
r as (select *, row_number() over (partition by doc_id order by n desc, first_) k from c),
a as (select doc_id, string_agg(tok, ', ' order by k) keywords from r where k <= 5 group by 1)
select d.doc_id, case when d.text is null then null else coalesce(a.keywords, '') end keywords from documents d left join a using (doc_id)""",
    "complexity_single": rf"""
with z as (select doc_id, text, regexp_matches(text, '[\x{{4e00}}-\x{{9fff}}]') zh from documents),
p as (select *, case when zh then len(string_split_regex(text, '[。？！]')) else len(string_split_regex(text, '[.?!]')) end parts from z)
select doc_id, case when text is null then null else round(0.3 * (case when zh then length(text) else {_LATIN.format(c='text')} end) / parts + 0.3 * (parts - 1) + case when zh and parts > 1 then 0.4 * len({_TERMS.format(c='text')}) / (parts - 1) else 0 end, 6) end complexity from p""",
    "complexity_qa": rf"""
with m as (select line_id, max(content) content, max(lower(trim(frontID))) front from text_line_sft where content is not null group by 1),
p as (select a.line_id, q.content q, a.content a, regexp_matches(q.content, '[\x{{4e00}}-\x{{9fff}}]') or regexp_matches(a.content, '[\x{{4e00}}-\x{{9fff}}]') zh from m a join m q on q.line_id = a.front),
n as (select *, {_PARTS.format(c='q')} pq, {_PARTS.format(c='a')} pa, case when zh then length(q) else {_LATIN.format(c='q')} end lq, case when zh then length(a) else {_LATIN.format(c='a')} end la from p),
t as (select *, pq + pa - 2 s, case when not zh then null when pq + pa > 2 then len(list_distinct(list_concat({_TERMS.format(c='q')}, {_TERMS.format(c='a')}))) / (pq + pa - 2) else 0.0 end term from n)
select line_id, round(0.2 * lq / pq + 0.2 * la / pa + 0.3 * s + coalesce(0.3 * term, 0), 6) overall, round(term, 6) term, cast(s as bigint) syntactic from t""",
    "lm_normalize": _sql_lm(),
    "sentences": f"select doc_id, count(*) n_sentences, cast(max(length(s)) as bigint) longest from (select doc_id, unnest({_ONCE.format(c='text')}) s from documents where text is not null) where s <> '' group by 1",
    "chunks": _chunk_sql(5164, 200) + " select doc_id, chunk_no, chunk, left(md5(chunk), 24) || lpad(cast(chunk_no as varchar), 8, '0') point_id from chunks",
    "head_tail_chunks": _chunk_sql(400, 100) + " select doc_id, max(k) n_chunks, arg_min(chunk, chunk_no) head, arg_max(chunk, chunk_no) tail from chunks group by 1",
}
