"""The steps as functions, and a command line: python -m tarnlake.api STEP --key value ..."""

from __future__ import annotations

import argparse
import json
import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake import sinks
from tarnlake.functions import clean, tokenizers
from tarnlake.operators import chat, imports, lake, packing, pipelines, vectors
from tarnlake.session import build_session, stage
from tarnlake.sources import files
from tarnlake.sources.token_files import TokenFiles, best_type

log = logging.getLogger("tarnlake")


def import_documents(spark: SparkSession, path: str, kind: str, text_key: str, dataset_id: int, out: str, annotators: dict | None = None) -> DataFrame:
    """Read, clean, drop repeated texts, number, annotate and store documents; returns the metadata rows.

    Repeated are texts equal to another and those that the vector search finds like one before them or like one
    that an earlier import left in the lake.

    ``kind``: parquet, jsonl, json, or documents for files of other formats. ``annotators``: column functions for language,
    subject, keywords, ad and toxic (see ``imports.annotations``).
    """
    if kind == "parquet":
        df = files.read_parquet_text(spark, path, text_key)
    elif kind in ("jsonl", "json"):
        df = files.read_json_lines(spark, path, text_key, f".{kind}")
    elif kind == "documents":
        df = files.read_documents(spark, path).where("text is not null").select("text", "title", F.lit("{}").alias("other"))
    else:
        raise ValueError(f"unknown kind {kind}")
    df = df.withColumn("text", clean.clean_common(F.col("text")))
    once = df.withColumn("h", F.sha2("text", 256)).groupBy("h").agg(F.min(F.struct("title", "other", "text")).alias("r")).select("h", "r.*")
    once = stage(once, "once")
    numbers = packing.running_sum(once.select("h", F.lit(1).alias("one")), [], ["h"], "one", "text_no").select("h", "text_no")
    numbers = stage(numbers, "numbers")
    chunked = stage(vectors.chunk_vectors(once.join(numbers, "h").select("text_no", "text"), pipelines.embed_udf(), 5164, 200), "vectors")
    kept = stage(vectors.embedded_keep(chunked, _lake_vectors(spark, f"{out}/lake")).where("keep").select(F.col("text_id").alias("text_no")), "kept")
    # ids are given to hashes; the texts meet them in one join
    ids = lake.number_lines(numbers.join(kept, "text_no", "left_semi").select("h", F.lit(dataset_id).alias("ds")), F.col("ds"), ["h"]).select("h", "line_id")
    numbered = stage(once.join(ids, "h").select("line_id", "title", "other", "text"), "import")
    sinks.write_lake(numbered, f"{out}/lake")
    imports.document_rows(numbered, **(annotators or {})).withColumn("dataset_id", F.lit(dataset_id)).write.mode("append").parquet(f"{out}/text_line")
    return spark.read.parquet(f"{out}/text_line").where(F.col("dataset_id") == dataset_id)


def keep_flags(spark: SparkSession, texts: list[str], out: str) -> list[bool] | None:
    """For a batch of texts, whether the vector search keeps each beside those before it and the lake below ``out``; None if it fails."""
    try:
        df = spark.createDataFrame(list(enumerate(texts)), "text_no long, text string")
        chunked = stage(vectors.chunk_vectors(df, pipelines.embed_udf(), 5164, 200), "vectors")
        kept = {r.text_id: r.keep for r in vectors.embedded_keep(chunked, _lake_vectors(spark, f"{out}/lake")).collect()}
        return [kept.get(i, False) for i in range(len(texts))]
    except Exception:  # callers go on without deduplication, as with a service that can't be reached
        log.exception("no keep flags")
        return None


def register_dataset(spark: SparkSession, name: str, out: str, **fields: str) -> int:
    """Enter a dataset in the registry below ``out`` and return its id; a name that is taken raises (code 01)."""
    path = f"{out}/text_meta"
    new = spark.createDataFrame([(name, *fields.values())], ["dataset_name", *fields])
    old = spark.read.parquet(path).select("dataset_id", "dataset_name") if _exists(spark, path) else spark.createDataFrame([], "dataset_id long, dataset_name string")
    row = stage(lake.register(old, new).withColumn("added_date", pipelines.registered_at(F.current_timestamp())), "registered")
    got = row.select("dataset_id").collect()
    if not got:
        raise ValueError(f"01: there is a dataset {name}")
    row.write.mode("append").parquet(path)
    return int(got[0][0])


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _lake_vectors(spark: SparkSession, path: str) -> DataFrame | None:
    """Chunk vectors of the lines of a lake, with negative numbers: they come before whatever is imported; None without a lake."""
    if not _exists(spark, path):
        return None
    lines = sinks.read_lake(spark, path).where("line_id is not null")
    return stage(vectors.chunk_vectors(lines.select(F.xxhash64("line_id").bitwiseOR(F.lit(-(1 << 63))).alias("text_no"), "text"), pipelines.embed_udf(), 5164, 200), "lake-vectors")


def import_chats(spark: SparkSession, path: str, dataset_id: int, out: str, preferences: bool = False) -> DataFrame:
    """Read and clean chats, store each distinct message path once as a message row with its line, parent, root and end,
    and write the threads; returns the rows."""
    turns = files.explode_chats(files.read_chats(spark, path))
    c = F.col("content")
    turns = turns.withColumn("content", clean.clean_chat(c) if preferences else clean.clean_common(c))
    tree = stage(chat.message_tree(turns, score="score" if preferences else None), "tree")
    rows = stage(imports.message_rows(tree, dataset_id, ["conv_id", "turn"]), "rows")
    kind = "dpo" if preferences else "sft"
    rows.withColumn("dataset_id", F.lit(dataset_id)).write.mode("append").parquet(f"{out}/text_line_{kind}")
    whole = rows.drop("content").join(imports.message_lines(tree, dataset_id, ["conv_id", "turn"]), "line_id")
    sinks.write_threads(imports.threads(whole, preferences), f"{out}/threads_{kind}/{dataset_id:04x}", "messages" if preferences else "message")
    return rows


def export_tokens(df: DataFrame, prefix: str, name: str, *args, single: bool = False) -> None:
    """Texts (text) as a token dataset under ``prefix``, by a kind of tokenizer or one of the names of ``tokenizers.NAMED``."""
    df.sparkSession.dataSource.register(TokenFiles)
    given = tokenizers.tokenizer_arguments(name, *args)
    t = tokenizers.build_tokenizer(*given)
    ids = df.select(tokenizers.encode_udf(*given)("text").alias("r")).select("r.ids", "r.lens")
    ids.write.format("tokens").mode("append").option("dtype", best_type(t.vocab_size)).option("single", str(single).lower()).save(prefix)


def chosen_lines(spark: SparkSession, out: str, method: str, datasets: list[str] | None = None, conditions: dict[str, str] | None = None, budget: int | None = None, per_file: int = 1 << 26) -> DataFrame:
    """(line_id, text, part) of lines of the lake. ``method``: random (every line of the datasets), certain_sampling (in seeded
    order up to ``budget`` bytes), select or subject_sampling (by metadata ``conditions``, then in seeded order, those too large
    for what is left of the budget skipped). Budget and part size count separately; without a budget all are taken.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method}")
    df = sinks.read_lake(spark, f"{out}/lake", datasets).where("line_id is not null and text <> ''")
    if method in ("select", "subject_sampling"):
        df = lake.fetch_by_filter(spark.read.parquet(f"{out}/text_line"), df, {k: v if isinstance(v, str) else "|".join(v) for k, v in (conditions or {}).items()})
    # ids and sizes decide; the texts join once it is known which lines are taken
    sizes = stage(df.select("line_id", (F.octet_length("text") + 1).cast("long").alias("n"), F.octet_length("text").cast("long").alias("bare")), "sizes")
    if method in ("select", "subject_sampling") and budget is not None:
        sizes = packing.greedy_with_skip(sizes.withColumn("o", lake.seeded_order(F.col("line_id"))), ["o", "line_id"], "bare", budget).drop("o")
        budget = None
    parts = lake.sample_budget(sizes.drop("bare"), "line_id", "n", budget if method == "certain_sampling" and budget is not None else 1 << 62, per_file)
    return df.join(parts.select("line_id", "part"), "line_id")


METHODS = ("random", "certain_sampling", "select", "subject_sampling")


def export(spark: SparkSession, out: str, target: str, method: str, data_type: str = "jsonl", tokenizer: str | None = None, vocabulary: str | None = None, **choice) -> str | None:
    """Lines chosen as ``chosen_lines`` says, below a new folder of ``target`` named by the time: JSON parts (jsonl) or a token
    dataset (binidx, which needs a tokenizer and its vocabulary). Returns the folder, None if nothing was chosen."""
    if data_type not in ("jsonl", "binidx") or method not in METHODS:
        raise ValueError(f"400: no export of {data_type} by {method}")
    if data_type == "binidx" and not (tokenizer and vocabulary):
        raise ValueError("400: a token dataset needs a tokenizer and a vocabulary")
    lines = stage(chosen_lines(spark, out, method, **choice), "chosen")
    if lines.isEmpty():
        return None
    stamp = time.strftime("%Y%m%d%H%M%S")
    if data_type == "jsonl":
        sinks.export_parts(lines.select(F.col("line_id").alias("id"), "text", "part"), f"{target.rstrip('/')}/{stamp}")
        return f"{target.rstrip('/')}/{stamp}"
    folder = f"{target.rstrip('/')}/binidx/{stamp}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    export_tokens(lines.orderBy("part", "line_id"), f"{folder}/{stamp}", tokenizer, vocabulary)
    return folder


def delete_titles(spark: SparkSession, out: str, titles: list[str], datasets: list[int] | None = None) -> int:
    """Delete lines by title from lake and metadata; returns how many."""
    lines = spark.read.parquet(f"{out}/text_line")
    hit = F.col("title").isin(titles) if datasets is None else F.col("title").isin(titles) & F.col("dataset_id").isin(datasets)
    gone = stage(lines.where(hit).select("line_id").distinct(), "gone")
    n = gone.count()
    if n:
        sinks.delete_from_lake(spark, f"{out}/lake", gone)
        kept = stage(lines.join(gone, "line_id", "left_anti"), "kept")
        kept.write.mode("overwrite").parquet(f"{out}/text_line")
    return n


def normalize_chat_file(spark: SparkSession, path: str, out: str) -> None:
    """Chat records of any known shape (one JSON object a line) as {"messages": [...]} lines; records without messages keep their fields."""
    m = chat.normalize_keys(F.col("value"))
    df = spark.read.text(path).select(m.alias("m")).where("m is not null")
    messages = chat.normalize_messages(F.try_element_at("m", F.lit("messages")))
    df.select(F.when(F.map_contains_key("m", "messages"), F.to_json(F.struct(messages.alias("messages")))).otherwise(F.to_json("m")).alias("value")).write.mode("overwrite").text(out)


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("step", choices=["register", "import-documents", "import-chats", "export", "export-tokens", "delete", "normalize-chats", "convert"])
    for k in ("path", "kind", "text-key", "out", "vocabulary", "name", "method", "data-type", "tokenizer", "target", "datasets", "titles", "conditions"):
        p.add_argument(f"--{k}")
    for k in ("dataset-id", "budget", "per-file"):
        p.add_argument(f"--{k}", type=int)
    p.add_argument("--preferences", action="store_true")
    a = p.parse_args(argv)
    spark = build_session()
    if a.step == "register":
        n = register_dataset(spark, a.name, a.out)
    elif a.step == "import-documents":
        n = import_documents(spark, a.path, a.kind or "jsonl", a.text_key or "text", a.dataset_id, a.out).count()
    elif a.step == "import-chats":
        n = import_chats(spark, a.path, a.dataset_id, a.out, a.preferences).count()
    elif a.step == "export":
        more = {"per_file": a.per_file} if a.per_file else {}
        n = export(spark, a.out, a.target, a.method, a.data_type or "jsonl", a.tokenizer, a.vocabulary, datasets=a.datasets.split(",") if a.datasets else None, conditions=json.loads(a.conditions) if a.conditions else None, budget=a.budget, **more)
    elif a.step == "delete":
        n = delete_titles(spark, a.out, json.loads(a.titles), [int(x) for x in a.datasets.split(",")] if a.datasets else None)
    elif a.step == "normalize-chats":
        n = normalize_chat_file(spark, a.path, a.out)
    elif a.step == "convert":
        df = stage(files.read_documents(spark, a.path).where("text is not null").select("title", "text"), "converted")
        df.write.mode("overwrite").json(a.out)
        n = df.count()
    else:
        df = files.load_dataset(spark, a.path, a.text_key or "text", only_text=True)
        export_tokens(df, a.out, a.kind or "ranks", *([a.vocabulary] if a.vocabulary else []))
        n = df.count()
    log.info("%s: %s", a.step, n)


if __name__ == "__main__":
    main()
