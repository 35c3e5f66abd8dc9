"""The lake: registering datasets, line ids, metadata rows, fetching, sampling and deleting."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.functions.text import line_id
from tarnlake.operators.packing import running_sum


def register(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Rows for the datasets of ``new`` (dataset_name, ...) whose name is in neither ``existing`` nor earlier in ``new``,
    numbered on from the highest id, with the hex folder. A null name is never registered.

    One row a dataset: both sides are registry-sized. Ids over 65,535 don't fit the line ids and raise.
    """
    fresh = new.where("dataset_name is not null").groupBy("dataset_name").agg(F.count("*").alias("_n"), *[F.min(c).alias(c) for c in new.columns if c not in ("dataset_name", "dataset_id", "folder")]).drop("_n").join(existing.select("dataset_name"), "dataset_name", "left_anti")
    top = existing.agg(F.coalesce(F.max("dataset_id").cast("long"), F.lit(0)).alias("top"))
    numbered = fresh.crossJoin(F.broadcast(top)).withColumn("dataset_id", F.col("top") + F.row_number().over(Window.orderBy("dataset_name"))).drop("top")
    ok = F.when(F.col("dataset_id") <= 65535, F.col("dataset_id")).otherwise(F.raise_error(F.lit("no dataset ids left")).cast("long"))
    return numbered.withColumn("dataset_id", ok).withColumn("folder", F.lpad(F.lower(F.hex("dataset_id")), 4, "0"))


def number_lines(df: DataFrame, dataset: Column, order: list[str], per_file: int = 65_536) -> DataFrame:
    """``df`` with line_id: lines are numbered by dataset in ``order`` and cut into files of ``per_file``.

    A dataset's rows are numbered by range blocks, so none gathers in one task. Pass narrow rows and join texts back.
    """
    d = df.withColumn("_ds", dataset.cast("long")).withColumn("_one", F.lit(1))
    at = F.col("_rank") - 1
    return running_sum(d, ["_ds"], order, "_one", "_rank").withColumn("line_id", line_id(F.col("_ds"), F.floor(at / per_file), at % per_file)).drop("_ds", "_one", "_rank")


def document_metadata(df: DataFrame) -> DataFrame:
    """Metadata of documents (line_id, title, text, language, source, dataset_id): bytes, and the rest as JSON cut to 255 characters. Null texts are left out."""
    title = F.regexp_replace(F.coalesce(F.to_json(F.struct("title")), F.lit("{}")), r'^\{(?:"title":)?"?|"?\}$', "")
    return df.where("text is not null").select("line_id", title.alias("title"), "language", F.octet_length("text").cast("long").alias("length"), F.left(F.to_json(F.struct("source", "dataset_id")), F.lit(255)).alias("other"))


def message_metadata(df: DataFrame, most: int = 1000) -> DataFrame:
    """Metadata of messages (line_id, role, content): bytes of the whole (0 without role), content cut to ``most`` characters."""
    return df.select("line_id", "role", F.left("content", F.lit(most)).alias("content"), F.when(F.coalesce(F.col("role"), F.lit("")) == "", F.lit(0)).otherwise(F.octet_length("content")).cast("long").alias("length"))


def metadata_filter(conditions: dict[str, str]) -> Column:
    """All of ``field REGEXP value``, without case; no condition keeps every row."""
    out = F.lit(True)
    for field, pattern in conditions.items():
        out = out & F.coalesce(F.col(field).cast("string").rlike(f"(?i){pattern}"), F.lit(False))
    return out


def fetch_by_filter(meta: DataFrame, lake: DataFrame, conditions: dict[str, str], key: str = "line_id") -> DataFrame:
    """Lake lines of the metadata rows that pass: pruned by dataset where the lake is partitioned by it."""
    return lake.join(meta.where(metadata_filter(conditions)).select(key).distinct(), key, "left_semi")


def seeded_order(key: Column, seed: str = "42") -> Column:
    """A value to order by at random but always alike."""
    return F.md5(F.concat(F.lit(seed), key.cast("string")))


def sample_budget(df: DataFrame, key: str, size: str, budget: int, per_file: int, seed: str = "42") -> DataFrame:
    """Rows in seeded order while their running size stays within ``budget``, with the number of their part file."""
    d = df.withColumn("_o", seeded_order(F.col(key), seed))
    upto = running_sum(d, [], ["_o", key], size, "_upto").where(F.col("_upto") <= budget)
    return upto.withColumn("part", F.floor((F.col("_upto") - F.col(size)) / per_file)).drop("_o", "_upto")


def sample_datasets(df: DataFrame, datasets: list[int]) -> DataFrame:
    """All lines of the chosen datasets."""
    return df.where(F.col("dataset_id").isin(datasets))


def sample_per_class(df: DataFrame, label: str, key: str, n: int, seed: str = "42") -> DataFrame:
    """``n`` rows of every class in seeded order. A window of limited rank: each task keeps n rows of a class before the shuffle."""
    w = Window.partitionBy(label).orderBy(seeded_order(F.col(key), seed), key)
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k")


def split_three(df: DataFrame, key: str, shares: tuple[int, int, int] = (80, 10, 10)) -> DataFrame:
    """train, val or test by the key's hash: no shuffle, the same row always in the same part."""
    bucket = F.conv(F.left(F.md5(F.col(key).cast("string")), F.lit(8)), 16, 10).cast("long") % sum(shares)
    return df.withColumn("part", F.when(bucket < shares[0], "train").when(bucket < shares[0] + shares[1], "val").otherwise("test"))


def delete_by_title(lines: DataFrame, lake: DataFrame, vectors: DataFrame, titles: list[str], datasets: list[int] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What remains of metadata, lake and vectors (line_id) once lines with the titles, in the datasets, are deleted.

    Datasets are compared by equality of their id, not by text. Deleting nothing leaves all as it is.
    """
    hit = F.col("title").isin(titles)
    if datasets is not None:
        hit = hit & F.col("dataset_id").isin(datasets)
    gone = lines.where(hit).select("line_id").distinct()
    return tuple(d.join(gone, "line_id", "left_anti") for d in (lines, lake, vectors))


def flat_names(paths: DataFrame, path: str = "path") -> DataFrame:
    """(path, name) of files copied into one folder: later ones of the same name get _1, _2 ... before the suffix.

    However many files bear one name, none gathers them. Paths are unique.
    """
    base, k = F.col("_base"), F.col("_k") - 1
    named = paths.select(path, F.regexp_extract(path, r"([^/]+)$", 1).alias("_base"), F.lit(1).alias("_one"))
    return running_sum(named, ["_base"], [path], "_one", "_k").select(path, F.when(k == 0, base).otherwise(F.concat(F.regexp_replace(base, r"\.[^.]*$", ""), F.lit("_"), k.cast("string"), F.regexp_extract(base, r"(\.[^.]*)$", 1))).alias("name"))


def missing_results(files: DataFrame, folders: DataFrame) -> DataFrame:
    """Files (name) without a result folder of their stem."""
    return files.withColumn("stem", F.regexp_replace("name", r"\.[^.]*$", "")).join(folders.select(F.col("name").alias("stem")).distinct(), "stem", "left_anti")


def blend(parts: list[str]) -> tuple[list[str], list[float] | None]:
    """Prefixes and weights of a dataset blend: either prefixes alone, or weights and prefixes in turn; weights are made to sum to one."""
    number = re.compile(r"^\d+(\.\d*)?$")
    weighted = [bool(number.match(p)) for p in parts[::2]]
    if not any(weighted):
        return list(parts), None
    if not all(weighted) or len(parts) % 2:
        raise ValueError("give a weight before every prefix, or before none")
    w = [float(x) for x in parts[::2]]
    if sum(w) <= 0:
        raise ValueError("weights must have a positive sum")
    return list(parts[1::2]), [x / sum(w) for x in w]
