"""Tables written as files: the lake's lines, chat threads, exports, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.models import describe_score
from tarnlake.operators.packing import files_by_running_sum
from tarnlake.session import stage


def _folders(line_id):
    """Folder names of a line: a letter before the digits keeps Spark from reading them as numbers."""
    return F.concat(F.lit("d"), F.left(line_id, F.lit(4))), F.concat(F.lit("f"), F.left(line_id, F.lit(8)))


def write_lake(df: DataFrame, path: str) -> None:
    """Lines {id, text} as JSON below one folder per dataset and file, both read off the line id."""
    dataset, file = _folders(F.col("line_id"))
    d = df.select(dataset.alias("dataset"), file.alias("file"), F.to_json(F.struct(F.col("line_id").alias("id"), "text")).alias("value"))
    d.repartition("file").sortWithinPartitions("file").write.partitionBy("dataset", "file").mode("append").text(path)


def read_lake(spark, path: str, datasets: list[str] | None = None) -> DataFrame:
    """(line_id, text) of a lake; folders of other datasets aren't opened."""
    df = spark.read.text(path)
    if datasets is not None:
        df = df.where(F.col("dataset").isin([f"d{x}" for x in datasets]))
    j = F.from_json("value", "id string, text string")
    return df.select(j["id"].alias("line_id"), j["text"].alias("text"))


def delete_from_lake(spark, path: str, gone: DataFrame) -> None:
    """Rewrite the files that hold lines of ``gone`` (line_id), and only those; other folders stay untouched."""
    hit = gone.select(_folders(F.col("line_id"))[1].alias("file")).distinct()
    old = spark.read.text(path)
    rest = old.join(hit, "file", "left_semi").withColumn("line_id", F.get_json_object("value", "$.id")).join(gone.select("line_id"), "line_id", "left_anti")
    kept = stage(rest.select("value", "dataset", "file"), "rewrite")  # read and overwritten: a copy in between
    empty = stage(old.join(hit, "file", "left_semi").select("dataset", "file").distinct(), "touched")
    full = kept.unionByName(empty.join(kept.select("dataset", "file").distinct(), ["dataset", "file"], "left_anti").withColumn("value", F.lit("")))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        full.select("value", "dataset", "file").repartition("file").write.partitionBy("dataset", "file").mode("overwrite").text(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def write_threads(paths: DataFrame, path: str, key: str = "messages", order: str = "root", per_file: int = 53_687_091) -> None:
    """One JSON line per thread, {key: [messages]}, in parts of about ``per_file`` bytes (0.05 GiB) by ``order``, which is
    unique; ``messages`` holds each message as JSON."""
    lines = stage(paths.select(order, F.concat(F.lit('{"' + key + '":['), F.array_join("messages", ","), F.lit("]}")).alias("value")), "threads")
    parts = files_by_running_sum(lines.select(order, (F.octet_length("value") + 1).cast("long").alias("n")), [], [order], "n", per_file)
    lines.join(parts.select(order, F.col("file_no").alias("part")), order).select("value", "part").repartition("part").write.partitionBy("part").mode("overwrite").text(path)


def export(df: DataFrame, path: str) -> None:
    """Written by suffix: .json or .jsonl as JSON lines, else Parquet; replaces what is there."""
    kind = "json" if path.rstrip("/").endswith((".json", ".jsonl")) else "parquet"
    df.write.mode("overwrite").format(kind).save(path)


def export_parts(df: DataFrame, path: str, part: str = "part") -> None:
    """JSON lines in one folder per part file number."""
    df.select(F.to_json(F.struct(*[c for c in df.columns if c != part])).alias("value"), part).repartition(part).write.partitionBy(part).mode("overwrite").text(path)


def score_report(df: DataFrame, csv: str, markdown: str, score: str = "doc_score") -> None:
    """Count, mean, spread and quartiles of a score as a CSV and a Markdown table; one row reaches the driver."""
    row = describe_score(df, score).collect()[0].asDict()
    with open(csv, "w") as f:
        f.write(",".join(row) + "\n" + ",".join("" if v is None else str(v) for v in row.values()) + "\n")
    with open(markdown, "w") as f:
        f.write("| " + " | ".join(row) + " |\n|" + "---|" * len(row) + "\n| " + " | ".join("" if v is None else str(v) for v in row.values()) + " |\n")
