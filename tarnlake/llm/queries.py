"""Queries of the llm operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm.answers import defective_answers
from tarnlake.llm.conversations import rebuild_conversations
from tarnlake.llm.encoding import full_repair, restore_garbled, train_char_model
from tarnlake.llm.language import LEAST_CONFIDENCE, labelled, languages_of_documents, train_language_model, wrong_labels
from tarnlake.llm.leaks import find_leaks
from tarnlake.llm.messages import has_content, speaker
from tarnlake.llm.sql import SQL
from tarnlake.llm.mixing import mix, named_source
from tarnlake.llm.subjects import judged_rows, learned_terms, subjects_of
from tarnlake.llm.toxicity import score_texts, spans_udf, train_on_reviewed
from tarnlake.operators.hierarchy import clean_id, clean_parent
from tarnlake.session import table


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Arrow batches of long texts must stay small where two Python workers share an executor."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def _openings(spark: SparkSession, sf: str) -> DataFrame:
    """(line_id, text) of the chat openings: no parent, a user role, content; one row a line."""
    rows = table(spark, sf, "text_line_sft").where(clean_parent(F.col("frontID")).isNull() & (speaker(F.col("role")) == "user") & has_content(F.col("content")))
    return rows.groupBy(clean_id(F.col("line_id")).alias("line_id")).agg(F.max("content").alias("text")).where("line_id is not null")


def _subjects(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("line_id", "text").where("line_id is not null")
    openings, labels = _openings(spark, sf), table(spark, sf, "review_label").select("line_id", "subjects")
    of_docs, of_openings = judged_rows(docs, labels), judged_rows(openings, labels)
    terms = learned_terms(of_docs, of_openings)
    found = subjects_of(docs, of_docs, 2, terms, full_repair(docs))
    return found.unionByName(subjects_of(openings, of_openings, 1, terms))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """The subject areas of every document and chat opening."""
    return _subjects(spark, sf).select("line_id", F.explode("subjects").alias("subject")).distinct()


def p1_composition(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and openings by subject, with their share of all; texts without a subject count under "none"."""
    found = _subjects(spark, sf)
    named = found.select(F.explode(F.when(F.size("subjects") > 0, F.col("subjects")).otherwise(F.array(F.lit("none")))).alias("subject"))
    total = found.agg(F.count("*").alias("total"))
    return named.groupBy("subject").agg(F.count("*").alias("n_texts")).join(F.broadcast(total)).select("subject", "n_texts", (F.col("n_texts") / F.col("total")).alias("share"))


def _tagger(spark: SparkSession, sf: str):
    return train_on_reviewed(table(spark, sf, "documents"), table(spark, sf, "review_label"))


def _single_texts(spark: SparkSession, sf: str) -> DataFrame:
    """(record_id, item_no, origin, text) of every document and every element of a text list."""
    docs = table(spark, sf, "documents").where("line_id is not null")
    requests = table(spark, sf, "import_text_item").where("request_id is not null")
    of_docs = docs.select(F.col("line_id").alias("record_id"), F.lit(0).cast("long").alias("item_no"), F.concat(F.lit("source:"), named_source(F.col("source"))).alias("origin"), "text")
    items = requests.select("request_id", "caller", F.posexplode("text_list").alias("at", "text"))
    of_items = items.select(F.col("request_id").cast("string").alias("record_id"), (F.col("at") + 1).cast("long").alias("item_no"), F.concat(F.lit("caller:"), named_source(F.col("caller"))).alias("origin"), "text")
    return of_docs.unionByName(of_items)


def _toxicity(spark: SparkSession, sf: str, least: float = 0.0) -> DataFrame:
    """(record_id, item_no, origin, score) of every single text; only scores over ``least`` are sure to be exact."""
    return score_texts(_single_texts(spark, sf), _tagger(spark, sf), full_repair(table(spark, sf, "documents")), least).drop("text")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that abuse, threaten, degrade a group or depict sex themselves."""
    return _toxicity(spark, sf, 0.5).where("score > 0.5").select("record_id", "item_no").distinct()


def p2_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Texts, offending texts and mean score by source and caller, repeated requests counted once."""
    each = _toxicity(spark, sf).groupBy("record_id", "item_no").agg(F.max("score").alias("score"), F.min("origin").alias("origin"))
    return each.groupBy(F.coalesce("origin", F.lit("unknown")).alias("origin")).agg(F.count("*").alias("n_texts"), F.sum((F.col("score") > 0.5).cast("long")).alias("n_offending"), F.avg("score").alias("mean_score"))


def p2_spans(spark: SparkSession, sf: str) -> DataFrame:
    """The offending sentences of every single text, as places in it."""
    spans = spans_udf(_tagger(spark, sf), full_repair(table(spark, sf, "documents")))
    found = _single_texts(spark, sf).where(F.col("text").rlike(r"\p{L}")).select("record_id", "item_no", F.explode(spans("text")).alias("s"))
    return found.select("record_id", "item_no", "s.start", "s.end", "s.score").distinct()


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Missing or wrong language labels of lines and datasets, and documents in several languages."""
    docs = table(spark, sf, "documents")
    messages = table(spark, sf, "text_line_sft").select("dataset_id", "content").unionByName(table(spark, sf, "text_line_dpo").select("dataset_id", "content"))
    cases, _ = wrong_labels(docs, table(spark, sf, "text_line"), table(spark, sf, "text_meta"), messages, train_language_model(labelled(docs)), full_repair(docs))
    return cases


def p4_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Every passage of every document with its language and confidence; ambiguous where either is under the least to be sure."""
    docs = table(spark, sf, "documents")
    found = languages_of_documents(docs, train_language_model(labelled(docs)), full_repair(docs))
    return found.select("line_id", F.col("lang").alias("main_lang"), F.col("confidence").alias("main_confidence"), F.explode_outer("passages").alias("p")).select("line_id", "main_lang", "main_confidence", "p.lang", "p.start", "p.end", "p.confidence", (F.least("main_confidence", "p.confidence") < LEAST_CONFIDENCE).alias("ambiguous"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """All good conversations of text_line_sft, message by message."""
    return rebuild_conversations(table(spark, sf, "text_line_sft"))


def _defects(spark: SparkSession, sf: str) -> DataFrame:
    languages = train_language_model(labelled(table(spark, sf, "documents")))
    return defective_answers(table(spark, sf, "text_line_sft"), languages)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Defective answers of text_line_sft with their defect."""
    return _defects(spark, sf)


def p6_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Defective answers by dataset (the first four digits of the line) and defect."""
    return _defects(spark, sf).groupBy(F.substring("line_id", 1, 4).alias("dataset"), "defect").agg(F.count("*").alias("n_answers"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold more than half of a test item's own text, and the items."""
    return find_leaks(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "eval_item")).select("doc_id", "item_id")


def p7_items(spark: SparkSession, sf: str) -> DataFrame:
    """How many documents hold each test item that leaked, and the largest share held."""
    found = find_leaks(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "eval_item"))
    return found.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.max("share").alias("largest_share"))


def p8_mix(spark: SparkSession, sf: str) -> DataFrame:
    """The documents of every mix of mix_target and how often each is repeated."""
    return mix(table(spark, sf, "documents"), table(spark, sf, "mix_target"))[0]


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual shares of every mix."""
    return mix(table(spark, sf, "documents"), table(spark, sf, "mix_target"))[1]


def _mixed_by_chars(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf, "documents")
    first = F.conv(F.left(F.md5(F.concat(F.lit("mix"), F.col("doc_id").cast("string"))), F.lit(13)), 16, 10).cast("long")
    rows = docs.select("doc_id", "source", F.coalesce("n_chars", F.lit(0)).cast("long").alias("n_tokens"), F.floor(first / 4).cast("long").alias("h"))
    return mix(rows, table(spark, sf, "mix_target"), sizes_given=True)


def p8_mix_chars(spark: SparkSession, sf: str) -> DataFrame:
    """As p8_mix, with characters for tokens and a hash that SQL has too."""
    return _mixed_by_chars(spark, sf)[0].select("mix_name", "doc_id", "source", "n_tokens", "copies")


def p8_shares_chars(spark: SparkSession, sf: str) -> DataFrame:
    """As p8_shares, with characters for tokens and a hash that SQL has too."""
    r = _mixed_by_chars(spark, sf)[1]
    return r.select("mix_name", "source", F.round("target_share", 9).alias("target_share"), F.round("wanted_tokens", 3).alias("wanted_tokens"), "there", "taken_tokens", "n_docs", "most_copies", F.round("actual_share", 9).alias("actual_share"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents some of whose text was decoded with the wrong encoding."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return restore_garbled(docs, train_char_model(docs)).select("doc_id")


def p9_restored(spark: SparkSession, sf: str) -> DataFrame:
    """The garbled documents with their text restored and the chains that did it."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return restore_garbled(docs, train_char_model(docs))


def _run(query):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf)

    run.__doc__ = query.__doc__
    return run


QUERIES = {k: _run(f) for k, f in {"p1_found": p1_found, "p1_composition": p1_composition, "p2_found": p2_found, "p2_rates": p2_rates, "p2_spans": p2_spans, "p4_found": p4_found, "p4_passages": p4_passages, "p5_found": p5_found, "p6_found": p6_found, "p6_rates": p6_rates, "p7_found": p7_found, "p7_items": p7_items, "p8_mix": p8_mix, "p8_shares": p8_shares, "p8_mix_chars": p8_mix_chars, "p8_shares_chars": p8_shares_chars, "p9_found": p9_found, "p9_restored": p9_restored}.items()}


def oracle_sql() -> dict[str, str]:
    return SQL
