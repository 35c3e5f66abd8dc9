"""Whole imports: documents annotated and given their metadata rows, chats stored as linked message rows and as threads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions import text
from tarnlake.functions.fixed import TOXIC_CHARACTERS
from tarnlake.functions.models import advertising
from tarnlake.functions.text import line_id
from tarnlake.operators.hierarchy import resolve_trees
from tarnlake.operators.lookup import HOT_LEAST, hot_keys, lookup_join
from tarnlake.operators.packing import running_sum
from tarnlake.session import stage

Annotator = Callable[[Column], Column]


def annotations(c: Column, language: Annotator | None = None, subject: Annotator | None = None, keywords: Annotator | None = None, ad: Annotator = advertising, toxic: Annotator | None = None) -> dict[str, Column]:
    """The annotations of a text in the order in which they are made. Those without an annotator are null; the flag of
    abuse looks at the first characters only, as its usual model does."""
    given = lambda f, x: f(x) if f else F.lit(None).cast("string")
    return {
        "language": given(language, c), "industry_subject": given(subject, c), "key_word": F.left(given(keywords, c), F.lit(255)), "fifth_grams": text.ngram_repeat_rate(c, 5), "ninth_grams": text.ngram_repeat_rate(c, 9),
        "ad_subjecrt": given(ad, c), "toxic_subject": given(toxic, F.left(c, F.lit(TOXIC_CHARACTERS))),
    }


def document_rows(lines: DataFrame, **annotators: Annotator) -> DataFrame:
    """Metadata rows of ``lines`` (line_id, title, text, other): bytes, annotations, ``other`` cut to 255 characters; null texts are left out."""
    c = F.col("text")
    return lines.where("text is not null").select("line_id", "title", F.octet_length("text").cast("long").alias("length"), *[v.alias(k) for k, v in annotations(c, **annotators).items()], F.left("other", F.lit(255)).alias("other"))


def message_rows(tree: DataFrame, dataset_id: int, order: list[str], per_file: int = 65_536, most: int = 1000) -> DataFrame:
    """Message rows of a tree of distinct paths (node, parent, role, content[, score]): line_id, frontID, indexID, end, role,
    content cut to ``most`` characters, length in bytes of the whole (0 without role).

    Lines are numbered by ``order`` (unique). frontID and indexID are the lines of the parent and of the root; end is
    "true" where nothing follows, but never on a root.
    """
    ids = _lines(tree, dataset_id, order, per_file)
    named = stage(ids, "lines")
    parents = named.select(F.col("node").alias("above"), F.col("line_id").alias("frontID"))
    n = named.count()
    hot = hot_keys(named.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n")), "parent", "n", n) if n > HOT_LEAST else []
    linked = stage(lookup_join(named, parents, F.col("parent") == F.col("above"), "parent", "above", hot).select("node", "line_id", "frontID"), "linked")
    roots = resolve_trees(linked.select(F.col("line_id").alias("id"), F.col("frontID").alias("parent"), F.lit(None).cast("string").alias("payload")))
    placed = linked.join(roots.select(F.col("id").alias("line_id"), F.col("root").alias("indexID"), "n_children"), "line_id")
    end = F.when((F.col("n_children") == 0) & F.col("frontID").isNotNull(), "true").otherwise("false")
    size = F.when(F.coalesce(F.col("role"), F.lit("")) == "", F.lit(0)).otherwise(F.octet_length("content")).cast("long")
    score = ["score"] if "score" in tree.columns else []
    return placed.withColumn("end", end).join(tree.select("node", "role", "content", *score), "node").select("line_id", "frontID", "indexID", "end", "role", F.left("content", F.lit(most)).alias("content"), size.alias("length"), *score)


def _lines(tree: DataFrame, dataset_id: int, order: list[str], per_file: int = 65_536) -> DataFrame:
    ids = running_sum(tree.select("node", "parent", *order, F.lit(1).alias("one")), [], order, "one", "no")
    return ids.select("node", "parent", line_id(F.lit(dataset_id).cast("long"), F.floor((F.col("no") - 1) / per_file), (F.col("no") - 1) % per_file).alias("line_id"))


def message_lines(tree: DataFrame, dataset_id: int, order: list[str]) -> DataFrame:
    """(line_id, content) of a tree's messages, whole: what ``message_rows`` cuts."""
    return _lines(tree, dataset_id, order).join(tree.select("node", "content"), "node").select("line_id", "content")


def threads(rows: DataFrame, preferences: bool = False) -> DataFrame:
    """(root, messages) of stored message rows (line_id, frontID, role, content[, score]) for the thread files.

    Chats: one thread per leaf, the messages from the root down. Preferences: one per root, all its messages by line,
    those of one prompt together; a tree's messages are gathered in one row, as the file's form demands.
    """
    fields = ["role", "content", *(["score"] if "score" in rows.columns else [])]
    said = F.to_json(F.struct(*fields))
    nodes = rows.select(F.col("line_id").alias("id"), F.col("frontID").alias("parent"), said.alias("payload"))
    if preferences:
        found = resolve_trees(nodes).where("state = 'whole'").select("id", "root", "depth")
        each = rows.join(found.withColumnRenamed("id", "line_id"), "line_id").select("root", F.struct("depth", "frontID", "line_id", said.alias("m")).alias("x"))
        return each.groupBy("root").agg(F.sort_array(F.collect_list("x")).alias("x")).select("root", F.transform("x", lambda x: x["m"]).alias("messages"))
    return resolve_trees(nodes, with_paths=True).where("state = 'whole' and n_children = 0").select(F.col("id").alias("root"), F.col("path").alias("messages"))
