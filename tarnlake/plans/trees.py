"""Queries on parent-child rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators.hierarchy import clean_id, descendants, intervals, resolve_trees, tree_nodes
from tarnlake.session import table


def _dpo(spark: SparkSession, sf: str) -> DataFrame:
    return tree_nodes(table(spark, sf, "text_line_dpo"), "line_id", "frontID", "added_date")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """State, root and depth of every line of text_line_dpo."""
    return resolve_trees(_dpo(spark, sf)).select(F.col("id").alias("line_id"), F.col("root").alias("root_id"), "depth", "state")


def p3_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Full path, subtree size and the check of ``end`` (true: nothing follows) for every line."""
    r = resolve_trees(_dpo(spark, sf), with_sizes=True, with_paths=True)
    told = F.lower(F.trim("end"))
    flag = F.when(told.isin("true", "1", "yes", "t", "y"), True).when(told.isin("false", "0", "no", "f", "n"), False)
    ends = table(spark, sf, "text_line_dpo").groupBy(clean_id(F.col("line_id")).alias("id")).agg(F.max_by(F.struct(flag.alias("told")), F.struct("added_date", F.coalesce("end", F.lit("")))).alias("e"))
    is_end = F.col("n_children") == 0
    return r.join(ends, "id", "left").select(
        F.col("id").alias("line_id"), F.array_join("path", "/").alias("path"), F.col("subtree").cast("long").alias("subtree"), is_end.alias("is_end"),
        F.when(F.col("e.told").isNull(), "unknown").when(F.col("e.told") == is_end, "right").otherwise("wrong").alias("end_check"),
    )


def p3_descendants(spark: SparkSession, sf: str) -> DataFrame:
    """Every pair of a line and a line below it."""
    r = resolve_trees(_dpo(spark, sf), with_paths=True)
    return descendants(r.where("state in ('whole', 'lost')"))


def p3_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Every line's place in a walk through its tree: its descendants are the lines of the tree behind it up to its exit."""
    r = intervals(_dpo(spark, sf))
    return r.select(F.col("id").alias("line_id"), F.col("root").alias("root_id"), "enter", "exit")


_NODES = r"""
rows_ as (select lower(trim(line_id)) id, lower(trim(frontID)) f, added_date, "end" e from text_line_dpo),
named as (select id, added_date, e, case when f is null or f in ('', 'none', 'null', 'nil', 'nan', 'n/a', 'na', 'zero', 'root', '-', '--', '\n', 'undefined') or regexp_full_match(f, '(0x)?0+(\.0+)?') then null else f end p from rows_),
nodes as (select id, arg_max(struct_pack(p := p), (added_date, coalesce(p, ''))).p p, arg_max(struct_pack(e := e), (added_date, coalesce(e, ''))).e e from named group by id),
up as (
  select id, id top_, p next_, 0 d, [id] seen from nodes
  union all
  select u.id, n.id, n.p, d + 1, list_append(seen, n.id) from up u join nodes n on n.id = u.next_ where not list_contains(u.seen, n.id)
),
ends as (select id, arg_max(struct_pack(top_ := top_, next_ := next_, seen := seen), d) m, max(d) d from up group by id),
way as (select id, d, m.top_ top_, m.next_ next_, m.seen seen, list_position(m.seen, m.next_) loop_at from ends)
"""
_WAY = f"with recursive {_NODES}"

QUERIES = {"p3_found": p3_found, "p3_paths": p3_paths, "p3_descendants": p3_descendants, "p3_intervals": p3_intervals}
SQL = {
    "p3_found": _WAY + """
select id line_id,
  case when loop_at is null then top_ else list_min(seen[loop_at:]) end root_id,
  cast(case when loop_at is null then d else loop_at - 1 end as bigint) depth,
  case when next_ is null then 'whole' when loop_at is null then 'lost' when loop_at = 1 then 'cycle' else 'below_cycle' end state
from way""",
    "p3_paths": _WAY + """,
below as (select u.top_ id, count(*) n from up u join way w on w.id = u.id where w.loop_at is null group by 1),
parents as (select distinct p from nodes where p is not null)
select w.id line_id, array_to_string(case when loop_at is null then list_reverse(seen) when loop_at = 1 then [w.id] else list_reverse(seen[:loop_at - 1]) end, '/') path,
  cast(case when loop_at is null then b.n end as bigint) subtree, q.p is null is_end,
  case when lower(trim(n.e)) in ('true', '1', 'yes', 't', 'y') then case when q.p is null then 'right' else 'wrong' end
       when lower(trim(n.e)) in ('false', '0', 'no', 'f', 'n') then case when q.p is null then 'wrong' else 'right' end else 'unknown' end end_check
from way w join nodes n on n.id = w.id left join below b on b.id = w.id left join parents q on q.p = w.id""",
    "p3_intervals": _WAY + """,
below as (select u.top_ id, count(*) n from up u join way w on w.id = u.id where w.loop_at is null group by 1),
walk as (select id, top_, row_number() over (partition by top_ order by list_reverse(seen)) - 1 e from way where loop_at is null)
select w.id line_id, top_ root_id, e enter, e + b.n - 1 "exit" from walk w join below b using (id)""",
    "p3_descendants": _WAY + """
select u.top_ ancestor, u.id descendant, u.d distance from up u join way w on w.id = u.id where w.loop_at is null and u.d > 0""",
}
