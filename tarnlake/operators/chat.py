"""Chat data brought to one form, stored as trees of messages without repeated prefixes, and exported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.clean import SPACE
from tarnlake.functions.fixed import CHAT_KEYS, MESSAGE_KEYS, TAGGED_SPEAKERS
from tarnlake.operators.hierarchy import Ride, clean_id, resolve_trees, tree_nodes
from tarnlake.operators.lookup import hot_keys, lookup_join
from tarnlake.session import stage


def normalize_keys(record: Column) -> Column:
    """A JSON object's fields under their common names, as a map to JSON texts; of two that meet, the later wins.

    An object without a known field stays as it is; text that is no JSON object is null.
    """
    m = F.from_json(record, "map<string,string>")
    names = F.create_map(*[F.lit(x) for kv in CHAT_KEYS.items() for x in kv])
    entries = F.transform(F.map_entries(m), lambda e, i: F.struct(F.coalesce(F.element_at(names, F.lower(e["key"])), e["key"]).alias("k"), i.alias("i"), e["value"].alias("v")))
    known = F.exists(F.map_keys(m), lambda k: F.map_contains_key(names, F.lower(k)))
    last = F.filter(entries, lambda e: ~F.exists(entries, lambda o: (o["k"] == e["k"]) & (o["i"] > e["i"])))
    return F.when(known, F.map_from_entries(F.transform(last, lambda e: F.struct(e["k"], e["v"])))).otherwise(m)


def normalize_messages(messages: Column) -> Column:
    """A JSON message list of any known shape as array of (role, content): objects with other field names, pairs of
    question and answer, texts in turn, or one tagged dialogue. Pairs of another length are dropped."""
    first = F.regexp_extract(messages, r'^\s*\[\s*(.)', 1)
    rows = F.from_json(messages, "array<map<string,string>>")
    field = lambda m, target: F.coalesce(*[F.element_at(m, k) for k, v in reversed(MESSAGE_KEYS.items()) if v == target], F.element_at(m, target))
    objects = F.transform(rows, lambda m: F.struct(field(m, "role").alias("role"), field(m, "content").alias("content")))
    pairs = F.flatten(F.transform(F.filter(F.from_json(messages, "array<array<string>>"), lambda p: F.size(p) == 2), lambda p: F.array(F.struct(F.lit("user").alias("role"), F.get(p, 0).alias("content")), F.struct(F.lit("assistant").alias("role"), F.get(p, 1).alias("content")))))
    texts = F.transform(F.from_json(messages, "array<string>"), lambda t, i: F.struct(F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), t.alias("content")))
    return F.when(first == "{", objects).when(first == "[", pairs).when(first == '"', texts).otherwise(parse_tagged(messages))


def parse_tagged(dialogue: Column) -> Column:
    """Messages of a dialogue tagged ``[Name]: text <eoh>`` or ``<eoa>``, trimmed; other names are dropped."""
    pattern = r"(?s)\[([a-zA-Z]+)\]: (.*?)(?:<eoa>|<eoh>)"
    who, said = F.regexp_extract_all(dialogue, F.lit(pattern), 1), F.regexp_extract_all(dialogue, F.lit(pattern), 2)
    names = F.create_map(*[F.lit(x) for kv in TAGGED_SPEAKERS.items() for x in kv])
    both = F.arrays_zip(who.alias("who"), said.alias("said"))
    known = F.filter(both, lambda x: F.map_contains_key(names, x["who"]))
    return F.transform(known, lambda x: F.struct(F.element_at(names, x["who"]).alias("role"), F.regexp_replace(x["said"], rf"\A{SPACE}+|{SPACE}+\z", "").alias("content")))


def end_flags(turns: DataFrame, conversation: str, turn: str) -> DataFrame:
    """``end``: "true" for the last message of a conversation that isn't its first, else "false".

    First and last turn are aggregated before they are joined back; a conversation that holds much of all rows stays where it is.
    """
    ends = turns.groupBy(F.col(conversation).alias("_c")).agg(F.min(turn).alias("_first"), F.max(turn).alias("_last"), F.count("*").alias("_n"))
    ends = stage(ends, "ends")
    hot = hot_keys(ends, "_c", "_n", ends.agg(F.coalesce(F.sum("_n"), F.lit(0))).collect()[0][0])
    joined = lookup_join(turns, ends, F.col(conversation) == F.col("_c"), conversation, "_c", hot)
    return joined.withColumn("end", F.when((F.col(turn) == F.col("_last")) & (F.col(turn) > F.col("_first")), "true").otherwise("false")).drop("_c", "_first", "_last", "_n")


#: Moduli and bases of the polynomial hash of a way; each lane takes other digits of the messages' hashes.
_LANES = ((2_147_483_647, 1_000_003), (2_147_483_629, 998_244_353), (2_147_483_587, 1_220_703), (2_147_483_579, 786_433))


def _hash_own() -> Column:
    return F.array(*[F.struct((F.conv(F.substring("payload", 1 + 7 * k, 7), 16, 10).cast("long") + 1).alias("h"), F.lit(b).cast("long").alias("f"), (F.conv(F.substring("payload", 1 + 7 * k, 7), 16, 10).cast("long") + 1).alias("own")) for k, (_, b) in enumerate(_LANES)])


def _hash_join(up: Column, low: Column) -> Column:
    lanes = []
    for k, (p, _) in enumerate(_LANES):
        a, b = up[k], low[k]
        lanes.append(F.struct(((a["h"] * b["f"] + b["h"]) % p).alias("h"), (a["f"] * b["f"] % p).alias("f"), b["own"].alias("own")))
    return F.array(*lanes)


#: The messages' hashes along a way as one hash of fixed size: sum of hash times base to the power of the distance, for four moduli.
HASHED = Ride(_hash_own, _hash_join)


def _key(ride: str, up: int) -> Column:
    """The way's hash as a text, or (``up`` 1) that of the way without its last message."""
    lanes = []
    for k, (p, b) in enumerate(_LANES):
        lane = F.col(ride)[k]
        lanes.append(lane["h"] if not up else (lane["h"] - lane["own"] + p) % p * pow(b, -1, p) % p)
    return F.concat_ws("-", *[F.hex(x) for x in lanes])


def linked_message_tree(messages: DataFrame, score: str | None = None) -> DataFrame:
    """As ``message_tree``, for rows that name the line before them (line_id, frontID, role, content, added_date).

    Ways up are resolved by the hierarchy operator with a hash of each message riding along, so a tree may be as wide
    as it likes: nothing gathers a conversation. Lines whose way up is broken or loops are left out. The smallest
    line_id stands for a node.
    """
    own = F.sha2(F.to_json(F.struct(F.col("role").alias("r"), F.col("content").alias("c"), *([F.col(score).alias("s")] if score else []))), 256)
    cols = ["role", "content", *([score] if score else [])]
    rows = stage(messages.withColumn("own", own).withColumn("line_id", clean_id(F.col("line_id"))).where("line_id is not null"), "messages")
    ways = resolve_trees(tree_nodes(rows, "line_id", "frontID", "added_date", "own"), ride=HASHED).where("state = 'whole'")
    keyed = ways.select("id", _key("ride", 0).alias("node"), F.when(F.col("depth") > 0, _key("ride", 1)).alias("parent"), "depth", F.col("payload").alias("own"))
    # one row a line: that whose message the way holds
    said = rows.groupBy("line_id", "own").agg(F.min(F.struct(*cols)).alias("m")).select(F.col("line_id").alias("id"), "own", "m.*")
    first = F.min_by(F.struct("id", *cols), "id")
    return keyed.join(said, ["id", "own"]).groupBy("node", "parent", "depth").agg(first.alias("f"), F.count("*").alias("n_uses")).select("node", "parent", "depth", F.col("f.id").alias("line_id"), *[f"f.{c}" for c in cols], "n_uses")


def message_tree(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", score: str | None = None) -> DataFrame:
    """(node, parent, root, depth, role, content, conv_id, turn, n_uses): each distinct path of messages once.

    ``turns`` has role, content and, for preferences, a score that tells nodes apart too (null equals null).
    A node's key is a hash chained along its path, folded once per conversation, so equal prefixes of any
    conversations meet in one group; the first conversation and turn by order stand for it. A conversation's
    turns are gathered in one row; it has as many as were said.
    """
    cols = [turn, "role", "content", *([score] if score else [])]
    talk = turns.groupBy(conversation).agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("m"))

    def chain(a: Column, x: Column) -> Column:
        own = F.to_json(F.struct(x["role"].alias("r"), x["content"].alias("c"), *([x[score].alias("s")] if score else [])))
        return F.concat(a, F.array(F.sha2(F.concat(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit("")), F.lit("/"), own), 256)))

    keyed = talk.withColumn("h", F.aggregate("m", F.array().cast("array<string>"), chain)).select(conversation, "h", F.posexplode("m").alias("i", "x"))
    keyed = keyed.select(conversation, "x.*", F.get("h", F.col("i")).alias("node"), F.when(F.col("i") > 0, F.get("h", F.col("i") - 1)).alias("parent"), F.get("h", F.lit(0)).alias("root"), F.col("i").cast("long").alias("depth"))
    first = F.min_by(F.struct(conversation, *cols), F.struct(conversation, turn))
    return keyed.groupBy("node", "parent", "root", "depth").agg(first.alias("f"), F.count("*").alias("n_uses")).select("node", "parent", "root", "depth", "f.*", "n_uses")


def leaf_paths(tree: DataFrame) -> DataFrame:
    """Leaves of a message tree: nodes that are nobody's parent. Prefixes of longer conversations are absorbed."""
    return tree.join(tree.select(F.col("parent").alias("node")).where("node is not null").distinct(), "node", "left_anti")


def preference_groups(tree: DataFrame, score: str = "score", order: tuple[str, ...] = ("conv_id", "turn")) -> DataFrame:
    """One row per prompt: its responses with scores, ordered by first appearance.

    Responses of one prompt are gathered in one row, as the result's form demands; ``preference_summary`` doesn't.
    """
    answers = tree.where("parent is not null").select(F.col("parent").alias("node"), F.struct(*order, "role", "content", score).alias("r"))
    grouped = answers.groupBy("node").agg(F.sort_array(F.collect_list("r")).alias("responses"))
    return tree.select("node", "content").join(grouped, "node")


def preference_summary(tree: DataFrame, score: str = "score", order: str = "line_id") -> DataFrame:
    """(node, content, n_responses, first_response, score_sum) per prompt, aggregated without gathering responses."""
    answers = tree.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_responses"), F.min_by("content", order).alias("first_response"), F.sum(F.coalesce(score, F.lit(0))).cast("long").alias("score_sum"))
    return tree.select("node", "content").join(answers, "node")
