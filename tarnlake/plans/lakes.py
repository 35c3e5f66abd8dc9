"""Queries of the lake: ids, metadata, packing, sampling, registering, deleting; and of vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators import lake, packing, pipelines, vectors
from tarnlake.operators.lookup import hot_keys, lookup_join
from tarnlake.session import stage, table


def line_ids(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "dataset_id")
    return lake.number_lines(d, F.col("dataset_id"), ["doc_id"], 100).select("doc_id", "line_id")


def pt_metadata(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").withColumn("language", F.col("lang"))
    return lake.document_metadata(d).select("line_id", "length", "language", "other")


def sft_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return lake.message_metadata(table(spark, sf, "text_line_sft").select("line_id", "role", "content").distinct())


def _sizes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where("text is not null").select("doc_id", "dataset_id", (F.octet_length("text") + 1).cast("long").alias("n_bytes"))


def roll_files_cumsum(spark: SparkSession, sf: str) -> DataFrame:
    return packing.files_by_running_sum(_sizes(spark, sf), [], ["doc_id"], "n_bytes", 65_536).select("doc_id", F.col("file_no").cast("long").alias("file_no"))


def roll_files_exact(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_exactly(_sizes(spark, sf), ["dataset_id"], "doc_id", "n_bytes", 16_384).select("doc_id", "dataset_id", "file_no")


def fetch_by_filter(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("line_id", "n_chars")
    return lake.fetch_by_filter(table(spark, sf, "text_line"), docs, {"language": "^(en|zh)", "title": "a"})


def sample_budget(spark: SparkSession, sf: str) -> DataFrame:
    return lake.sample_budget(_sizes(spark, sf), "doc_id", "n_bytes", 400_000, 65_536).select("doc_id", F.col("part").cast("long").alias("part"))


def sample_datasets(spark: SparkSession, sf: str) -> DataFrame:
    return lake.sample_datasets(table(spark, sf, "documents").select("doc_id", "dataset_id"), [5, 6, 8, 11])


def sample_per_label(spark: SparkSession, sf: str) -> DataFrame:
    """A sampling operator: ten documents of each source."""
    return lake.sample_per_class(table(spark, sf, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source")), "source", "doc_id", 10)


def split_80_10_10(spark: SparkSession, sf: str) -> DataFrame:
    return lake.split_three(table(spark, sf, "documents").select("doc_id"), "doc_id")


def delete_by_title(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "text_line").select("line_id", "title", "dataset_id")
    docs = table(spark, sf, "documents").select("line_id")
    kept = lake.delete_by_title(lines, docs, docs, ["untitled", "Report 385"], None)
    return kept[1]


def register_dataset(spark: SparkSession, sf: str) -> DataFrame:
    new = table(spark, sf, "documents").select(F.concat(F.lit("new_"), F.coalesce("source", F.lit("none"))).alias("dataset_name")).unionByName(table(spark, sf, "text_meta").select("dataset_name")).distinct()
    return lake.register(table(spark, sf, "text_meta").select("dataset_id", "dataset_name"), new).select("dataset_id", "dataset_name", "folder")


def flat_names(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select(F.concat(F.lit("/in/"), F.col("doc_id").cast("string"), F.lit("/"), F.coalesce("original_format", F.lit("x")), F.lit(".md")).alias("path"))
    return lake.flat_names(d)


def file_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    files = table(spark, sf, "documents").select(F.concat("line_id", F.lit(".pdf")).alias("name"))
    return lake.missing_results(files, table(spark, sf, "text_line").select(F.col("line_id").alias("name"))).select("name")


def similar_top5(spark: SparkSession, sf: str) -> DataFrame:
    """The five nearest vectors with cosine 0.3 at least, for every vector whose id is divisible by 20, among all."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return vectors.search(e.where("vec_id % 20 = 0"), e, 5, 0.3).select("query_id", "vec_id", F.round("score", 6).alias("score"), "rank")


def semantic_keep(spark: SparkSession, sf: str) -> DataFrame:
    """Keep decisions on every document by exact repeats of its chunks only, as SQL can say them; ``embedded_keep`` searches vectors."""
    from tarnlake.functions.text import chunks

    d = table(spark, sf, "documents").where("text is not null").select("doc_id", chunks(F.col("text"), 600, 100).alias("c"))
    c = d.select(F.col("doc_id").alias("text_id"), F.posexplode("c").alias("chunk_no", "chunk"), F.size("c").alias("n_chunks")).withColumn("h", F.md5("chunk"))
    c = stage(c.drop("chunk"), "chunks")
    first = stage(c.groupBy("h").agg(F.min("text_id").alias("prefix"), F.count("*").alias("n")).withColumnRenamed("h", "of"), "first")
    hot = hot_keys(first, "of", "n", c.count())
    hits = lookup_join(c, first.drop("n"), F.col("h") == F.col("of"), "h", "of", hot, "inner").where("prefix <> text_id").select("text_id", "chunk_no", F.col("prefix").cast("string").alias("prefix"))
    return vectors.keep_decisions(c.select("text_id", "chunk_no", "n_chunks"), hits)


def embedded_keep(spark: SparkSession, sf: str) -> DataFrame:
    """Keep decisions on every document by the vector search over its chunks: nearly equal documents count as repeats."""
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("long").alias("text_no"), "text")
    return vectors.embedded_keep(stage(vectors.chunk_vectors(d, pipelines.embed_udf(), 600, 100), "vectors"))


def dataset_lines(spark: SparkSession, sf: str) -> DataFrame:
    return pipelines.dataset_lines(table(spark, sf, "text_line_sft"), "0007").select("line_id", "indexID")


def clean_web(spark: SparkSession, sf: str) -> DataFrame:
    return pipelines.clean_web(table(spark, sf, "documents").select("doc_id", "text"))


def clean_paper(spark: SparkSession, sf: str) -> DataFrame:
    return pipelines.clean_paper(table(spark, sf, "documents").select("doc_id", "text"))


def keywords_zh(spark: SparkSession, sf: str) -> DataFrame:
    return pipelines.keywords_chinese(table(spark, sf, "documents").select("doc_id", "text"))


def classifier_rows(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").where("text is not null")
    r = pipelines.classifier_row(F.col("source"), F.col("text"), ["the", "of"])
    return d.select("doc_id", F.size(r["doc_token"]).cast("long").alias("n_tokens"), F.get(r["doc_token"], F.lit(0)).alias("first_token"))


_SIZES = "s as (select doc_id, dataset_id, strlen(text) + 1 n_bytes from documents where text is not null)"
QUERIES = {f.__name__: f for f in (line_ids, pt_metadata, sft_metadata, roll_files_cumsum, roll_files_exact, fetch_by_filter, sample_budget, sample_datasets, sample_per_label, split_80_10_10, delete_by_title, register_dataset, flat_names, file_anti_join, similar_top5, semantic_keep, embedded_keep, dataset_lines, clean_web, clean_paper, keywords_zh, classifier_rows)}
SQL = {
    "line_ids": "select doc_id, printf('%04x%04x%08x', dataset_id, r // 100, r % 100) line_id from (select doc_id, dataset_id, row_number() over (partition by dataset_id order by doc_id) - 1 r from documents)",
    "pt_metadata": """select line_id, strlen(text) length, lang as language, left('{' || array_to_string(list_filter([case when source is not null then '"source":' || cast(to_json(source) as varchar) end, '"dataset_id":' || dataset_id], lambda x: x is not null), ',') || '}', 255) other from documents where text is not null""",
    "sft_metadata": "select line_id, role, left(content, 1000) content, case when coalesce(role, '') = '' then 0 else strlen(content) end length from (select distinct line_id, role, content from text_line_sft)",
    "roll_files_cumsum": f"with {_SIZES} select doc_id, cast(floor((sum(n_bytes) over (order by doc_id) - n_bytes) / 65536) as bigint) file_no from s",
    "roll_files_exact": f"""with recursive {_SIZES}, o as (select *, row_number() over (partition by dataset_id order by doc_id) r from s),
f as (select dataset_id, doc_id, r, n_bytes used, cast(0 as bigint) no from o where r = 1 union all
 select o.dataset_id, o.doc_id, o.r, case when f.used + o.n_bytes >= 16384 then o.n_bytes else f.used + o.n_bytes end, f.no + case when f.used + o.n_bytes >= 16384 then 1 else 0 end from f join o on o.dataset_id = f.dataset_id and o.r = f.r + 1)
select doc_id, dataset_id, no file_no from f""",
    "fetch_by_filter": "select line_id, n_chars from documents where line_id in (select line_id from text_line where regexp_matches(language, '(?i)^(en|zh)') and regexp_matches(title, '(?i)a'))",
    "sample_budget": f"with {_SIZES}, o as (select *, sum(n_bytes) over (order by md5('42' || doc_id), doc_id) u from s) select doc_id, cast(floor((u - n_bytes) / 65536) as bigint) part from o where u <= 400000",
    "sample_datasets": "select doc_id, dataset_id from documents where dataset_id in (5, 6, 8, 11)",
    "sample_per_label": "select doc_id, source from (select doc_id, coalesce(source, '') source, row_number() over (partition by coalesce(source, '') order by md5('42' || doc_id), doc_id) r from documents) where r <= 10",
    "split_80_10_10": "select doc_id, case when b < 80 then 'train' when b < 90 then 'val' else 'test' end part from (select doc_id, cast('0x' || left(md5(cast(doc_id as varchar)), 8) as bigint) % 100 b from documents)",
    "delete_by_title": "select line_id from documents where line_id not in (select line_id from text_line where title in ('untitled', 'Report 385'))",
    "register_dataset": """with n as (select distinct 'new_' || coalesce(source, 'none') dataset_name from documents), f as (select * from n where dataset_name not in (select dataset_name from text_meta)),
r as (select dataset_name, (select max(dataset_id) from text_meta) + row_number() over (order by dataset_name) dataset_id from f) select cast(dataset_id as bigint) dataset_id, dataset_name, printf('%04x', dataset_id) folder from r""",
    "flat_names": "select path, case when k = 0 then base || '.md' else base || '_' || k || '.md' end as name from (select path, base, row_number() over (partition by base order by path) - 1 k from (select '/in/' || doc_id || '/' || coalesce(original_format, 'x') || '.md' path, coalesce(original_format, 'x') base from documents))",
    "file_anti_join": "select line_id || '.pdf' as name from documents where line_id not in (select line_id from text_line)",
    "similar_top5": """with p as (select q.vec_id query_id, b.vec_id vec_id, list_cosine_similarity(cast(q.embedding as double[]), cast(b.embedding as double[])) score from embeddings q join embeddings b on q.vec_id <> b.vec_id where q.vec_id % 20 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from p where score >= 0.3) select cast(query_id as bigint) query_id, cast(vec_id as bigint) vec_id, round(score, 6) score, rank from r where rank <= 5""",
}
from tarnlake.plans.texts import _chunk_sql  # noqa: E402

SQL["semantic_keep"] = _chunk_sql(600, 100) + """,
ch as (select doc_id text_id, chunk_no, k, md5(chunk) h from chunks), f as (select h, min(text_id) prefix from ch group by 1),
hits as (select text_id, chunk_no, prefix from ch join f using (h) where prefix <> text_id),
o as (select h.text_id, list(prefix) p from hits h join ch using (text_id, chunk_no) where chunk_no = 0 or chunk_no = k - 1 group by 1),
m as (select text_id, list(prefix) p from hits where chunk_no = 1 group by 1), t as (select text_id, max(k) n from ch group by 1)
select t.text_id, case when o.p is null then true when len(list_distinct(o.p)) < len(o.p) then false when n = 1 then false when n = 2 then true when m.p is null then true else not list_has_any(m.p, o.p) end keep
from t left join o using (text_id) left join m using (text_id)"""

SQL["dataset_lines"] = "select line_id, indexID from text_line_sft where left(line_id, 4) = '0007'"
SQL["classifier_rows"] = r"select doc_id, len(w) n_tokens, w[1] first_token from (select doc_id, list_filter(string_split(regexp_replace(text, '[^0-9A-Za-z\x{4e00}-\x{9fa5} ]', '', 'g'), ' '), lambda w: w <> '' and lower(w) not in ('the', 'of')) w from documents where text is not null)"
SQL["keywords_zh"] = r"""
with d as (select doc_id, regexp_extract_all(text, '[\x{4e00}-\x{9fff}]{2,}') r from documents where regexp_matches(text, '[\x{4e00}-\x{9fff}]')),
t as (select doc_id, flatten(list_transform(r, lambda x: list_transform(range(1, length(x)), lambda i: substr(x, i, 2)))) t from d),
u as (select doc_id, t[i] term, i from (select doc_id, t, unnest(range(1, len(t) + 1)) i from t)),
c as (select doc_id, term, count(*) n, min(i) first_ from u group by all), f as (select term, ln((select count(*) from d) / count(*)) idf from c group by 1),
r as (select doc_id, term, row_number() over (partition by doc_id order by round(n * idf, 9) desc, first_) k from c join f using (term))
select doc_id, string_agg(term, ', ' order by k) keywords from r where k <= 5 group by 1"""
