"""Queries on chat messages: one form, trees without repeated prefixes, groups of responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators import chat
from tarnlake.plans.texts import _S
from tarnlake.session import table


def conv_end_flag(spark: SparkSession, sf: str) -> DataFrame:
    """The end flag of every message of a tree by line number."""
    m = table(spark, sf, "text_line_sft").where("indexID is not null").select("indexID", "line_id").distinct()
    turns = m.select(F.col("indexID").alias("conv_id"), "line_id", F.conv(F.substring("line_id", 5, 12), 16, 10).cast("long").alias("turn"))
    return chat.end_flags(turns, "conv_id", "turn").select("conv_id", "turn", "end")


def conv_trie_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Each distinct path of messages once, with the first line that stands for it."""
    return chat.linked_message_tree(table(spark, sf, "text_line_sft")).select("line_id", "depth", "role", "content", "n_uses")


def conv_paths(spark: SparkSession, sf: str) -> DataFrame:
    """The ends of the distinct conversations."""
    return chat.leaf_paths(chat.linked_message_tree(table(spark, sf, "text_line_sft"))).select("line_id", "depth")


def dpo_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts with their distinct responses; scores tell responses apart."""
    return chat.preference_summary(chat.linked_message_tree(table(spark, sf, "text_line_dpo"), "score")).select("content", "n_responses", "first_response", "score_sum")


def chat_key_normalize(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "text_line_sft").where("content is not null").select("line_id", F.to_json(F.struct(F.col("content").alias("Question"), F.col("line_id").alias("Output"), F.col("role").alias("other"))).alias("j")).distinct()
    k = chat.normalize_keys(F.col("j"))
    return m.select("line_id", F.element_at(k, "user").alias("user"), F.element_at(k, "assistant").alias("assistant"), F.element_at(k, "other").alias("other"))


def tagged_dialog_parse(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "text_line_sft").where("content is not null").select("line_id", "content").distinct()
    text = F.concat(F.lit("[Human]: "), F.col("content"), F.lit(" <eoh>\n[Else]: x <eoa>[MOSS]:  fine <eoa>"))
    return m.select("line_id", F.posexplode(chat.parse_tagged(text)).alias("at", "m")).select("line_id", F.col("at").cast("long").alias("at_"), "m.role", "m.content")


_TREE = r"""
raw as (select lower(trim(line_id)) id, lower(trim(frontID)) f, role, content, score, added_date from {t}),
named as (select id, role, content, score, added_date, to_json(struct_pack(r := role, c := content{s})) own, case when f in ('', 'none', 'null', 'nil', 'nan', 'n/a', 'na', 'zero', 'root', '-', '--', '\\n', 'undefined') or regexp_full_match(f, '(0x)?0+(\.0+)?') then null else f end p from raw),
latest as (select id, arg_max(struct_pack(p := p, own := own, role := role, content := content, score := score), (added_date, coalesce(p, ''))) r from named group by id),
nodes as (select id, r.p p, r.own own, r.role role, r.content content, r.score score from latest),
way as (select id, cast(own as varchar) path, cast(null as varchar) parent, 0 depth from nodes where p is null union all
  select n.id, w.path || chr(1) || n.own, w.path, w.depth + 1 from nodes n join way w on w.id = n.p),
tree as (select path, parent, depth, arg_min(struct_pack(id := n.id, role := role, content := content, score := score), n.id) f, count(*) n_uses from way join nodes n using (id) group by all)"""

QUERIES = {"conv_end_flag": conv_end_flag, "conv_trie_nodes": conv_trie_nodes, "conv_paths": conv_paths, "dpo_groups": dpo_groups, "chat_key_normalize": chat_key_normalize, "tagged_dialog_parse": tagged_dialog_parse}
SQL = {
    "conv_end_flag": "with t as (select distinct indexID conv_id, line_id, cast('0x' || substr(line_id, 5) as bigint) turn from text_line_sft where indexID is not null) select conv_id, turn, case when turn = max(turn) over (partition by conv_id) and turn > min(turn) over (partition by conv_id) then 'true' else 'false' end \"end\" from t",
    "conv_trie_nodes": f"with recursive {_TREE.format(t='text_line_sft', s='')} select f.id line_id, depth, f.role role, f.content content, n_uses from tree",
    "conv_paths": f"with recursive {_TREE.format(t='text_line_sft', s='')} select f.id line_id, depth from tree t where not exists (select 1 from tree c where c.parent = t.path)",
    "dpo_groups": f"""with recursive {_TREE.format(t='text_line_dpo', s=', s := score')}
select p.f.content content, count(*) n_responses, arg_min(struct_pack(x := c.f.content), c.f.id).x first_response, cast(sum(coalesce(c.f.score, 0)) as bigint) score_sum from tree p join tree c on c.parent = p.path group by p.path, p.f.content""",
    "chat_key_normalize": "select distinct line_id, content \"user\", line_id assistant, role other from text_line_sft where content is not null",
    "tagged_dialog_parse": rf"with m as (select distinct line_id, content from text_line_sft where content is not null) select line_id, 0 at_, 'user' role, regexp_replace(content, '^{_S}+|{_S}+$', '', 'g') content from m union all select line_id, 1, 'assistant', 'fine' from m",
}
