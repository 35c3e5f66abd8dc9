"""Message rows rebuilt into ordered conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.messages import has_content, speaker
from tarnlake.operators.hierarchy import clean_id, clean_parent, resolve_trees, tree_nodes

#: The automaton: state is the last speaker, "" before the opening; the moves each state allows.
MOVES = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
FINAL = ("assistant",)


def accept_conversations(rows: DataFrame, key: str = "leaf_id", seq: str = "turn_no", who: str = "speaker", ok: str = "ok") -> DataFrame:
    """The rows of those conversations that the automaton ``MOVES`` accepts.

    Rows are partitioned by ``key`` and sorted by ``seq`` within it, once for all windows; one that isn't
    ``ok`` (broken or without content) or has no known speaker spoils its conversation. A conversation is
    one way through a tree, so no key gathers more rows than a tree is deep, however wide it is.
    """
    by = Window.partitionBy(key)
    turn = by.orderBy(seq)
    state = F.coalesce(F.lag(who).over(turn), F.lit(""))
    moves = F.lit(False)
    for s, nexts in MOVES.items():
        moves = moves | ((state == s) & F.col(who).isin(*nexts))
    ends = F.lead(seq).over(turn).isNotNull() | F.col(who).isin(*FINAL)
    # a missing speaker shows itself both here and as the next row's state
    fine = F.coalesce(moves & ends & F.col(ok) & F.col(who).isNotNull(), F.lit(False))
    return rows.withColumn("_bad", F.when(fine, 0).otherwise(1)).withColumn("_bad", F.max("_bad").over(by)).where("_bad = 0").drop("_bad")


def rebuild_conversations(messages: DataFrame) -> DataFrame:
    """``(leaf_id, turn_no, line_id, speaker)`` of all good conversations in ``messages``
    (line_id, role, content, frontID, indexID, added_date).

    A conversation is the way from a line that no line follows up to its opening. It is good if every
    parent has a row, the opening has no parent and its indexID is null or itself, and
    ``accept_conversations`` takes it. Of repeated rows of a line the latest counts. Null roles or
    contents spoil the conversation; rows without line_id are left out; empty input gives no rows.
    """
    me = clean_id(F.col("line_id"))
    root = clean_parent(F.col("indexID"))
    mark = lambda c, yes, no: F.when(c, F.lit(yes)).otherwise(F.lit(no))
    # the node's text rides along the path: speaker, content and index marks, then the id
    packed = F.concat(F.coalesce(F.substring(speaker(F.col("role")), 1, 1), F.lit("?")), mark(has_content(F.col("content")), "1", "0"), mark(root.isNull() | (root == me), "1", "0"), me)
    nodes = tree_nodes(messages.select("line_id", "frontID", "added_date", packed.alias("packed")), "line_id", "frontID", "added_date", "packed")
    leaves = resolve_trees(nodes, with_paths=True).where("n_children = 0 and state = 'whole'").where(F.substring(F.element_at("path", 1), 3, 1) == "1")
    rows = leaves.select(F.col("id").alias("leaf_id"), F.posexplode("path").alias("turn_no", "packed"))
    code = F.substring("packed", 1, 1)
    rows = rows.select(
        "leaf_id", F.col("turn_no").cast("long").alias("turn_no"), F.expr("substring(packed, 4)").alias("line_id"),
        F.when(code == "u", "user").when(code == "a", "assistant").when(code == "s", "system").alias("speaker"), (F.substring("packed", 2, 1) == "1").alias("ok"),
    )
    return accept_conversations(rows).select("leaf_id", "turn_no", "line_id", "speaker")
