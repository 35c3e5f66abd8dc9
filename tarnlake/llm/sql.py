"""SQL that gives the same rows as the llm queries."""

from tarnlake.llm.messages import SPEAKERS, STAND_INS

_list = lambda words: ", ".join("'" + w.replace("'", "''") + "'" for w in words)
_NONE = "('', 'none', 'null', 'nil', 'nan', 'n/a', 'na', 'zero', 'root', '-', '--', 'undefined')"


def _id(c: str) -> str:
    return rf"lower(regexp_replace({c}, '^[\s\x{{00a0}}\x{{3000}}]+|[\s\x{{00a0}}\x{{3000}}]+$', '', 'g'))"


def _core(c: str) -> str:
    return rf"lower(regexp_replace({c}, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g'))"


SPEAKER = " ".join(["case", *(f"when {_core('role')} in ({_list(w)}) then '{k}'" for k, w in SPEAKERS.items()), "end"])
CONTENT = rf"coalesce(regexp_matches(content, '[\p{{L}}\p{{N}}]') and not (length(trim(content)) <= 40 and regexp_replace({_core('left(content, 60)')}, '\s+', ' ', 'g') in ({_list(STAND_INS)})), false)"
MESSAGES = rf"""
raw as (select {_id('line_id')} id, {_id('frontID')} f, {_id('indexID')} x, {SPEAKER} who, {CONTENT} has, added_date from text_line_sft),
clean as (select id, who, has, added_date, case when f in {_NONE} or regexp_full_match(f, '(0x)?0+(\.0+)?') then null else f end p, case when x in {_NONE} or regexp_full_match(x, '(0x)?0+(\.0+)?') then null else x end x from raw where id <> ''),
nodes as (select id, arg_max(struct_pack(p := p, x := x, who := who, has := has), (added_date, coalesce(p, ''))) r from clean group by id),
msg as (select id, r.p p, r.x x, r.who who, r.has has from nodes)"""

SQL = {
    "p5_found": f"""with recursive {MESSAGES},
leaf as (select id from msg where id not in (select p from msg where p is not null)),
up as (
  select l.id leaf, m.id, m.p, m.x, m.who, m.has, 0 d from leaf l join msg m on m.id = l.id
  union all
  select u.leaf, m.id, m.p, m.x, m.who, m.has, d + 1 from up u join msg m on m.id = u.p where u.d < 10000
),
seq as (select *, lead(who) over w prev, lag(id) over w is null last_, lead(id) over w is null first_ from up window w as (partition by leaf order by d)),
judged as (select *, coalesce(has and who is not null
   and case when first_ then p is null and (x is null or x = id) and who in ('system', 'user')
            when prev = 'system' then who = 'user' when prev = 'user' then who = 'assistant' when prev = 'assistant' then who = 'user' else false end
   and (not last_ or who = 'assistant'), false) ok from seq),
good as (select leaf, max(d) deep from judged group by leaf having bool_and(ok))
select j.leaf leaf_id, cast(g.deep - j.d as bigint) turn_no, j.id line_id, j.who speaker from judged j join good g on g.leaf = j.leaf""",
}
_SOURCE = "nullif(regexp_replace(lower(trim({c})), '[\\s\\-_./]+', '_', 'g'), '')"
MIXED = f"""d as (select doc_id, {_SOURCE.format(c='source')} source, coalesce(n_chars, 0) n, cast('0x' || left(md5('mix' || doc_id), 13) as bigint) // 4 h from documents),
s as (select source, sum(n) there from d where source is not null group by 1),
g as (select mix_name, {_SOURCE.format(c='source')} source, sum(target_share) share, min(max_repeats) cap, max(size_factor) factor from mix_target where mix_name is not null and target_share > 0 group by 1, 2 having {_SOURCE.format(c='source')} is not null),
w as (select g.mix_name, g.source, share / sum(share) over (partition by g.mix_name) share, cap, coalesce(s.there, 0) there, share / sum(share) over (partition by g.mix_name) * coalesce(factor, 1.0) * (select sum(n) from d) wanted from g left join s on s.source = g.source),
b as (select *, case when there > 0 then case when cap is null then wanted else least(wanted, greatest(cap, 0) * there) end else 0.0 end budget from w),
p as (select *, case when there > 0 then floor(budget / there) else 0 end whole from b),
o as (select source, doc_id, n, sum(n) over (partition by source order by h) upto from d where source is not null),
taken as (select p.mix_name, o.doc_id, o.source, o.n n_tokens, cast(p.whole + case when o.upto <= p.budget - p.whole * p.there then 1 else 0 end as bigint) copies from o join p using (source) where o.n > 0)"""
SQL["p8_mix_chars"] = f"with {MIXED} select * from taken where copies > 0"
SQL["p8_shares_chars"] = f"""with {MIXED}, t as (select mix_name, source, cast(sum(n_tokens * copies) as bigint) taken, count(*) n_docs, max(copies) most from taken where copies > 0 group by 1, 2),
r as (select p.mix_name, p.source, share, wanted, there, coalesce(taken, 0) taken, coalesce(n_docs, 0) n_docs, coalesce(most, 0) most from p left join t on t.mix_name = p.mix_name and t.source = p.source)
select mix_name, source, round(share, 9) target_share, round(wanted, 3) wanted_tokens, cast(there as bigint) there, taken taken_tokens, n_docs, most most_copies, round(case when sum(taken) over (partition by mix_name) > 0 then taken / sum(taken) over (partition by mix_name) else 0 end, 9) actual_share from r"""
