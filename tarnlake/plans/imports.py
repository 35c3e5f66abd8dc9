"""Queries of whole imports, cleaning pipelines, selections and the smaller steps around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions import clean, models, text, tokenizers
from tarnlake.operators import chat, imports, lake, packing, pipelines, vectors
from tarnlake.plans import chats, texts
from tarnlake.plans.models import AD_PATTERN as _AD_PATTERN
from tarnlake.plans.texts import _S, STOP_WORDS
from tarnlake.session import stage, table
from tarnlake.sources import files


def _docs(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", *cols)


def other_json(spark: SparkSession, sf: str) -> DataFrame:
    """Records as JSON lines, read back: the text, the title, and the rest with its types."""
    rest = [F.struct(F.col("lang").alias("l"), F.array("n_chars", F.lit(2.5)).alias("k")).alias("n"), F.lit(True).alias("b"), "dataset_id", "source", F.coalesce("text", F.lit("")).alias("body"), "title"]
    line = F.to_json(F.struct(*rest), {"ignoreNullFields": "false"})
    return table(spark, sf, "documents").select("doc_id", files.split_record(line, "body").alias("r")).select("doc_id", "r.text", "r.title", "r.other")


def document_import(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata rows of all documents with every annotation, numbered anew."""
    d = _docs(spark, sf, "dataset_id", "title", "text", F.to_json(F.struct("source", "dataset_id")).alias("other"))
    ids = lake.number_lines(d.select("doc_id", "dataset_id"), F.col("dataset_id"), ["doc_id"], 100)
    hooks = {
        "language": lambda c: F.when(c.rlike(clean.HAN), "zh").otherwise("other"), "subject": lambda c: F.when(c.contains("court"), "law"),
        "keywords": lambda c: text.keywords(c, STOP_WORDS), "toxic": lambda c: F.when(c.contains("a"), "unsafety").otherwise("safety"),
    }
    return imports.document_rows(d.join(ids.select("doc_id", "line_id"), "doc_id"), **hooks).drop("title")


def message_import(spark: SparkSession, sf: str) -> DataFrame:
    """Message rows of all distinct paths of chat messages, as dataset 7."""
    tree = chat.linked_message_tree(table(spark, sf, "text_line_sft")).withColumnRenamed("line_id", "rep")
    return imports.message_rows(tree, 7, ["rep"])


def preference_import(spark: SparkSession, sf: str) -> DataFrame:
    """Message rows of all distinct paths of prompts and scored responses, as dataset 9."""
    tree = chat.linked_message_tree(table(spark, sf, "text_line_dpo"), "score").withColumnRenamed("line_id", "rep")
    return imports.message_rows(tree, 9, ["rep"])


def select_greedy(spark: SparkSession, sf: str) -> DataFrame:
    """Documents chosen by metadata, in seeded order, up to a budget of bytes; those too large for what is left are skipped."""
    d = _docs(spark, sf, "line_id", F.octet_length("text").cast("long").alias("n_bytes")).where("n_bytes > 0")
    chosen = lake.fetch_by_filter(table(spark, sf, "text_line"), d, {"language": "^(en|zh|de)"})
    return packing.greedy_with_skip(chosen.withColumn("o", lake.seeded_order(F.col("doc_id"))), ["o", "doc_id"], "n_bytes", 100_000).select("doc_id", "n_bytes")


def vector_keep(spark: SparkSession, sf: str) -> DataFrame:
    """Keep decisions by vector search: three embeddings in a row stand for the chunks of a text."""
    v = table(spark, sf, "embeddings").select(F.floor(F.col("vec_id") / 3).cast("long").alias("text_no"), (F.col("vec_id") % 3).cast("int").alias("chunk_no"), "embedding")
    n = v.groupBy("text_no").agg(F.count("*").cast("int").alias("n_chunks"))
    return vectors.embedded_keep(stage(v.join(n, "text_no"), "vectors"), threshold=0.5)


def perplexity_keep(spark: SparkSession, sf: str) -> DataFrame:
    """Documents cleaned as papers whose perplexity under the counted model is 2,500 at most."""
    from tarnlake.plans.models import lm_perplexity

    p = lm_perplexity(spark, sf)
    return pipelines.clean_paper(_docs(spark, sf, "text"), perplexity=p).select("doc_id")


def nfkc_text(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf, clean.nfkc(F.col("text")).alias("cleaned"))


def clean_chat_nfkc(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf, clean.clean_chat(F.col("text")).alias("cleaned"))


def mapped_text(spark: SparkSession, sf: str) -> DataFrame:
    """Copyright comments cut, repeated sentences dropped, spaces made plain."""
    return _docs(spark, sf, pipelines.map_text(F.col("text")).alias("cleaned"))


def partition_sequential(spark: SparkSession, sf: str) -> DataFrame:
    """Lines cut into seven files one after another, and dealt to seven files in turn."""
    d = _docs(spark, sf)
    return packing.partition_lines(d, ["doc_id"], 7)


def tokens_null(spark: SparkSession, sf: str) -> DataFrame:
    """Token numbers as text, encoded with the end of the document."""
    words = F.concat_ws(" ", F.col("doc_id").cast("string"), F.col("dataset_id").cast("string"))
    r = _docs(spark, sf, "dataset_id", tokenizers.encode_udf("null", 100_000)(words).alias("r"))
    return r.select("doc_id", F.array_join(F.transform("r.ids", lambda x: x.cast("string")), " ").alias("ids"), F.get("r.lens", F.lit(0)).cast("long").alias("n"))


def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, sequences, tokens and bytes of an encoding."""
    words = F.concat_ws(" ", F.col("doc_id").cast("string"), F.col("dataset_id").cast("string"))
    return tokenizers.encoding_totals(_docs(spark, sf, words.alias("text")), "null", 100_000)


def quality_split(spark: SparkSession, sf: str) -> DataFrame:
    """At most 40 documents of each class, four fifths of them for training."""
    d = _docs(spark, sf, (F.col("source").isNotNull() & (F.col("n_chars") > 700)).cast("int").alias("label"))
    return models.training_sets(d, "label", "doc_id", per_class=40)


def labels_top(spark: SparkSession, sf: str) -> DataFrame:
    """The two highest of eight scores, if over 0.05."""
    e = table(spark, sf, "embeddings")
    got = pipelines.labels_from_scores(F.transform(F.slice("embedding", 1, 8), lambda x: F.round(x.cast("double"), 6)), list("abcdefgh"), 2, 0.05)
    return e.select(F.col("vec_id").cast("long").alias("vec_id"), F.array_join(got, ",").alias("labels"))


def unit_vectors(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), vectors.l2_normalize(F.col("embedding")).alias("u"))
    return e.select("vec_id", F.round(F.get("u", F.lit(0)), 6).alias("first"), F.round(F.aggregate("u", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


def registered_time(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "text_meta").select(F.col("dataset_id").cast("long").alias("dataset_id"), pipelines.registered_at(F.col("added_date")).alias("registered_at"))


def markdown_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf, files.text_to_markdown(F.col("text")).alias("md"))


def markdown_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows as a converted book has them: some repeated, marked, blank or with a promotion."""
    c = F.concat(F.lit("> first\nfirst\n < > \n"), F.col("text"), F.lit("\n Visit our shop now \nlast（\nlast（\nlast］"))
    return _docs(spark, sf, files.clean_markdown_rows(c, ("our shop",)).alias("md")).where("md is not null")


def messages_normal(spark: SparkSession, sf: str) -> DataFrame:
    """Message lists of three shapes in one form."""
    m = table(spark, sf, "text_line_sft").where("content is not null").select("line_id", "role", "content").distinct()
    told = F.to_json(F.array(F.struct(F.coalesce("role", F.lit("x")).alias("from"), F.col("content").alias("value")), F.struct(F.lit("bot").alias("from"), F.lit("fine").alias("value"))))
    pairs = F.to_json(F.array(F.array("content", F.lit("fine")), F.array("content")))
    turns = F.to_json(F.array(F.col("content"), F.lit("fine"), F.lit("more")))
    forms = F.explode(F.array(*[F.struct(F.lit(k).alias("form"), chat.normalize_messages(j).alias("m")) for k, j in (("told", told), ("pairs", pairs), ("turns", turns))]))
    return m.select("line_id", forms.alias("f")).select("line_id", "f.form", F.posexplode("f.m").alias("at", "m")).select("line_id", "form", F.col("at").cast("long").alias("at_"), "m.role", "m.content")


def labelled_union(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a source as class 1, chat contents as class 0, counted by class and length."""
    pos = table(spark, sf, "documents").where("source is not null and text is not null").select("text", F.lit(1).alias("label"))
    neg = table(spark, sf, "text_line_sft").where("content is not null").select(F.col("content").alias("text"), F.lit(0).alias("label"))
    return pos.unionByName(neg).groupBy("label", F.length("text").cast("long").alias("n_chars")).agg(F.count("*").alias("n"))


def classifier_rows_han(spark: SparkSession, sf: str) -> DataFrame:
    """Classifier rows of the Han terms of two characters or more."""
    d = _docs(spark, sf, "source", "text").where("text is not null")
    return d.select("doc_id", pipelines.classifier_row_han(F.col("source"), F.col("source"), F.col("text"), ["可以", "这个"]).alias("r")).select("doc_id", F.get("r.doc_label", F.lit(0)).alias("label"), F.array_join("r.doc_token", " ").alias("tokens"), F.array_join("r.doc_keyword", "|").alias("keyword"))


def few_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as files of one page for every 400 characters; those of ten pages at most."""
    page = F.lit("/Type /Page\n")
    d = _docs(spark, sf, (F.floor(F.coalesce("n_chars", F.lit(0)) / 400) + 1).cast("int").alias("n"))
    return files.few_pages(d.select(F.col("doc_id").cast("string").alias("path"), F.repeat(page, F.col("n")).cast("binary").alias("content"))).select(F.col("path").cast("long").alias("doc_id"), F.col("n_pages").cast("long").alias("n_pages"))


QUERIES = {
    f.__name__: f
    for f in (
        other_json, document_import, message_import, preference_import, select_greedy, vector_keep, perplexity_keep, nfkc_text, clean_chat_nfkc, mapped_text, partition_sequential, tokens_null, token_counts, quality_split, labels_top,
        unit_vectors, registered_time, markdown_lines, markdown_rows, messages_normal, labelled_union, classifier_rows_han, few_pages,
    )
}

# What normal form KC makes of the characters in the tables, besides those of full width.
_FOLDS = {
    "µ": "μ", "…": "...", "º": "o", "´": " ́", "³": "3", "²": "2", "¹": "1", "¾": "3⁄4", "¸": " ̧", "¯": " ̄", "ª": "a", "¨": " ̈", "½": "1⁄2", "¼": "1⁄4", "™": "TM", "\xa0": " ", "﹝": "〔", "﹛": "{",
    "︺": "〕", "№": "No", "℃": "°C", "˜": " ̃", "ﬂ": "fl", "″": "′′", "︼": "】", "﹀": "〉", "㈡": "(二)", "˙": " ̇", "㈠": "(一)", "︽": "《", "︿": "〈", "˚": " ̊", "㈢": "(三)", "﹁": "「", "⑩": "10", "︾": "》",
    "㈤": "(五)", "③": "3", "⑴": "(1)",
}


def _folded(c: str) -> str:
    """SQL of normal form KC for the characters that the tables hold."""
    q = lambda x: "'" + x.replace("'", "''") + "'"
    for a, b in _FOLDS.items():
        c = f"replace({c}, {q(a)}, {q(b)})"
    wide = "".join(chr(i) for i in range(0xFF01, 0xFF5F))
    return f"translate({c}, {q(wide)}, {q(''.join(chr(ord(w) - 0xFEE0) for w in wide))})"


def _over(sql: str, source: str) -> str:
    """A query over documents as one over another table of doc_id and text."""
    return sql.replace("documents", source)


def _cleaned(blank: str, source: str) -> str:
    return _over(texts._sql_clean(blank), source)


_FOLDED = f"folded as (select doc_id, {_folded('text')} as text from documents)"
_BLOCK = r"/\*[^*]*\*+(?:[^*/][^*]*\*+)*/"
_HEAD = r"^(?:(?://|#|--)[^\n]*(?:\n|\z)|\n)+"


def _mapped(source: str) -> str:
    """CTEs m1 to m3: ``source`` (doc_id, text) without copyright comments, repeated sentences and special spaces."""
    spaces = texts._sql_spaces().replace("' ' || chr(12288) || text || chr(8203) || chr(9)", "text").replace(" cleaned ", " as text ")
    dedup = _over(texts.SQL["repeat_sentence_dedup"], "m1").replace("cleaned", "text_")
    return rf"""m1 as (select doc_id, regexp_replace(case when regexp_matches(regexp_extract(text, '{_BLOCK}'), '(?i)copyright | 版权') then regexp_replace(text, '{_BLOCK}', '') else text end, '{_HEAD}', '') as text from {source}),
m2 as (select doc_id, text_ as text from ({dedup})), m3 as ({_over(spaces, 'm2')})"""


_MANY = "case when text is null then null else"
_TREE = chats._TREE
_NUMBERED = """, numbered as (select *, row_number() over (order by f.id) - 1 no from tree),
lines as (select *, printf('%04x%04x%08x', {ds}, no // 65536, no % 65536) line_id from numbered),
up as (select path, line_id indexID, path at_ from lines where parent is null union all select l.path, u.indexID, l.path from lines l join up u on l.parent = u.at_)
select l.line_id, p.line_id frontID, u.indexID, case when p.line_id is not null and not exists (select 1 from lines c where c.parent = l.path) then 'true' else 'false' end "end",
  l.f.role role, left(l.f.content, 1000) content, case when coalesce(l.f.role, '') = '' then 0 else strlen(l.f.content) end length{score}
from lines l left join lines p on p.path = l.parent join up u on u.path = l.path"""

SQL = {
    "other_json": r"""select doc_id, coalesce(text, '') as text, coalesce(title, '') title,
'{"n":{"k":[' || n_chars || ',2.5],"l":' || coalesce(cast(to_json(lang) as varchar), 'null') || '},"b":true,"dataset_id":' || dataset_id || ',"source":' || coalesce(cast(to_json(source) as varchar), 'null') || ',"title":' || coalesce(cast(to_json(title) as varchar), 'null') || '}' other from documents""",
    "document_import": f"""with k as ({texts.SQL['keywords_top5']}), five as ({texts.SQL['ngram_repeat_5']}), nine as ({texts.SQL['ngram_repeat_9']}), ids as (select doc_id, printf('%04x%04x%08x', dataset_id, r // 100, r % 100) line_id from (select doc_id, dataset_id, row_number() over (partition by dataset_id order by doc_id) - 1 r from documents))
select i.line_id, strlen(text) length, case when regexp_matches(text, '[\\x{{4e00}}-\\x{{9fff}}]') then 'zh' else 'other' end as language, case when contains(text, 'court') then 'law' end industry_subject, left(k.keywords, 255) key_word, five.rate fifth_grams, nine.rate ninth_grams,
 case when regexp_matches(text, '{_AD_PATTERN}') then 'ad' else 'not-ad' end ad_subjecrt,
 case when contains(left(text, 510), 'a') then 'unsafety' else 'safety' end toxic_subject,
 left('{{' || array_to_string(list_filter([case when source is not null then '"source":' || cast(to_json(source) as varchar) end, '"dataset_id":' || dataset_id], lambda x: x is not null), ',') || '}}', 255) other
from documents d join ids i using (doc_id) join k using (doc_id) join five using (doc_id) join nine using (doc_id) where text is not null""",
    "message_import": f"with recursive {_TREE.format(t='text_line_sft', s='')}" + _NUMBERED.format(ds=7, score=""),
    "preference_import": f"with recursive {_TREE.format(t='text_line_dpo', s=', s := score')}" + _NUMBERED.format(ds=9, score=", l.f.score score"),
    "select_greedy": """with recursive c as (select doc_id, strlen(text) n from documents where strlen(text) > 0 and line_id in (select line_id from text_line where regexp_matches(language, '(?i)^(en|zh|de)'))),
o as (select *, row_number() over (order by md5('42' || doc_id), doc_id) r from c),
g as (select cast(0 as bigint) r, cast(0 as bigint) used, cast(null as bigint) doc_id, cast(null as bigint) n, false took union all
 select o.r, case when g.used + o.n <= 100000 then g.used + o.n else g.used end, o.doc_id, o.n, g.used + o.n <= 100000 from g join o on o.r = g.r + 1)
select doc_id, n n_bytes from g where took""",
    "vector_keep": """with v as (select vec_id // 3 t, vec_id % 3 c, cast(embedding as double[]) e from embeddings), n as (select t, count(*) k from v group by 1),
asked as (select v.*, k from v join n using (t) where c <= 1 or c = k - 1),
p as (select a.t, a.c, b.t b, row_number() over (partition by a.t, a.c order by list_cosine_similarity(a.e, b.e) desc, b.t, b.c) r from asked a join v b on b.t < a.t where list_cosine_similarity(a.e, b.e) >= 0.5),
h as (select t, c, b from p where r <= 5),
o as (select h.t, list(h.b) x from h join n using (t) where h.c = 0 or h.c = k - 1 group by 1), m as (select t, list(b) x from h where c = 1 group by 1)
select n.t text_id, case when o.x is null then true when len(list_distinct(o.x)) < len(o.x) then false when k = 1 then false when k = 2 then true when m.x is null then true else not list_has_any(m.x, o.x) end keep
from n left join o using (t) left join m using (t)""",
    "nfkc_text": f"select doc_id, {_folded('text')} cleaned from documents",
    "clean_common_nfkc": f"with {_FOLDED} {_cleaned(chr(92) + 'n', 'folded')}",
    "clean_chat_nfkc": f"with {_FOLDED} {_cleaned('', 'folded')}",
    "mapped_text": f"with {_mapped('documents')} select doc_id, text cleaned from m3",
    "clean_paper": f"with {_FOLDED}, c as (select doc_id, cleaned as text from ({_cleaned(chr(92) + 'n', 'folded')})), {_mapped('c')} select doc_id, text from m3",
    "clean_web": rf"""with bare as (select doc_id, regexp_replace(regexp_replace(text, 'https?://[^{_S[1:-1]}]+', '', 'g'), '[^\x20-\x7e\x{{4e00}}-\x{{9fa5}}]+', '', 'g') as text from documents),
kept as (select * from bare where case when length(text) = 0 then 0.0 else (length(text) - length(regexp_replace(text, '{texts._SPECIAL}', '', 'g'))) / length(text) end between 0 and 0.5),
c as (select doc_id, cleaned as text from ({_cleaned(chr(92) + 'n', 'kept')})), {_mapped('c')}
select doc_id, text from m3 where length(regexp_replace(text, '[^\p{{Cc}}]', '', 'g')) / nullif(length(text), 0) <= 0.03 and length(text) >= 50""",
    "partition_sequential": "select doc_id, r // cast(ceil(n / 7.0) as bigint) in_order, r % 7 in_turn from (select doc_id, row_number() over (order by doc_id) - 1 r, count(*) over () n from documents)",
    "tokens_null": "select doc_id, doc_id || ' ' || dataset_id || ' 100000' ids, 3 n from documents",
    "token_counts": "select count(*) n_docs, count(*) n_sequences, 3 * count(*) n_tokens, cast(sum(strlen(doc_id || ' ' || dataset_id)) as bigint) n_bytes from documents",
    "quality_split": """select doc_id, label, case when cast('0x' || left(md5(cast(doc_id as varchar)), 8) as bigint) % 100 < 80 then 'train' else 'test' end part
from (select *, row_number() over (partition by label order by md5('42' || doc_id), doc_id) k from (select doc_id, cast(source is not null and n_chars > 700 as int) label from documents)) where k <= 40""",
    "labels_top": """with s as (select vec_id, round(cast(embedding[i] as double), 6) s, i from embeddings, unnest(range(1, 9)) t(i)), r as (select *, row_number() over (partition by vec_id order by s desc, i) k from s where s > 0.05)
select e.vec_id, coalesce(string_agg(substr('abcdefgh', r.i, 1), ',' order by r.k), '') labels from embeddings e left join r on r.vec_id = e.vec_id and r.k <= 2 group by 1""",
    "unit_vectors": "select vec_id, round(e[1] / n, 6) first, round(list_sum(e) / n, 6) total from (select vec_id, cast(embedding as double[]) e, sqrt(list_dot_product(cast(embedding as double[]), cast(embedding as double[]))) n from embeddings)",
    "registered_time": "select cast(dataset_id as bigint) dataset_id, added_date + interval 8 hour as registered_at from text_meta",
    "markdown_lines": rf"select doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x: '*' || regexp_replace(x, '^{_S}+|{_S}+$', '', 'g') || '*'), chr(10)) md from documents",
    "markdown_rows": rf"""with recursive d as (select doc_id, list_transform(string_split('> first' || chr(10) || 'first' || chr(10) || ' < > ' || chr(10) || text || chr(10) || ' Visit our shop now ' || chr(10) || 'last（' || chr(10) || 'last（' || chr(10) || 'last］', chr(10)), lambda x: regexp_replace(x, '^{_S}+|{_S}+$', '', 'g')) a from documents where text is not null),
f as (select doc_id, a, 1 i, cast([] as varchar[]) kept from d union all
 select doc_id, a, i + 1, case when regexp_full_match(a[i], '[\s<>]*') or contains(a[i], 'our shop') or coalesce(kept[-1], '') = a[i] then kept
  else list_append(kept, regexp_replace(regexp_replace(regexp_replace(a[i], '[（］]+$', ''), '^>', ''), '^{_S}+|{_S}+$', '', 'g')) end from f where i <= len(a))
select doc_id, array_to_string(kept, chr(10)) md from f where i = len(a) + 1""",
    "messages_normal": """with m as (select distinct line_id, role, content from text_line_sft where content is not null), f as (
select line_id, 'told' form, 0 at_, coalesce(role, 'x') role, content from m union all select line_id, 'told', 1, 'bot', 'fine' from m union all
select line_id, 'pairs', 0, 'user', content from m union all select line_id, 'pairs', 1, 'assistant', 'fine' from m union all
select line_id, 'turns', 0, 'user', content from m union all select line_id, 'turns', 1, 'assistant', 'fine' from m union all select line_id, 'turns', 2, 'user', 'more' from m)
select line_id, form, cast(at_ as bigint) at_, role, content from f""",
    "labelled_union": "select label, length(t) n_chars, count(*) n from (select text t, 1 label from documents where source is not null and text is not null union all select content, 0 from text_line_sft where content is not null) group by all",
    "classifier_rows_han": r"""with d as (select doc_id, source, regexp_extract_all(text, '[\x{4e00}-\x{9fff}]{2,}') r from documents where text is not null),
t as (select doc_id, source, list_filter(flatten(list_transform(r, lambda x: list_transform(range(1, length(x)), lambda i: substr(x, i, 2)))), lambda w: w not in ('可以', '这个')) t from d)
select doc_id, source as label, coalesce(array_to_string(t, ' '), '') tokens, '' keyword from t""",
    "few_pages": "select doc_id, n n_pages from (select doc_id, coalesce(n_chars, 0) // 400 + 1 n from documents) where n <= 10",
}
from tarnlake.plans.models import SQL as _MODELS  # noqa: E402

SQL["perplexity_keep"] = f"select doc_id from ({_MODELS['lm_perplexity']}) where perplexity <= 2500"
