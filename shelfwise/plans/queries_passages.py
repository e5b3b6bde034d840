"""Text passage queries over whole documents in all languages."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import passages as ps
from shelfwise.plans.registry import REGISTRY
from shelfwise.rules import CONTENTS_LINES, DENSITY_PATTERNS, MARKETING_WORDS, PASSAGE_SEPARATOR

BUDGET = 4000

# RE2 counts only ASCII as word characters; an underscore in place of an accented letter is one,
# is no letter to the patterns either, and keeps all positions.
_MASK = "regexp_replace({x}, '[À-ÖØ-öø-ÿ]', '_', 'g')"


def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


def _count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '(?i){_q(pattern)}'))"


_COUNTS = ", ".join(f"{_count('masked', regex)} as c_{name}" for name, regex, _ in DENSITY_PATTERNS)
_SUM = " + ".join(f"c_{name} * {w}" for name, _, w in DENSITY_PATTERNS)
_KINDS = " + ".join(f"cast(c_{name} > 0 as int)" for name, _, _ in DENSITY_PATTERNS)

_WINDOWS = """
win as (select doc_id, s as start, least(s + 1000, n) as "end", text[s + 1:least(s + 1000, n)] as text, full_text, n
  from (select doc_id, text, text as full_text, length(text) as n, unnest(range(0, length(text), 500)) as s from fx_doc) w where least(s + 1000, n) - s >= 400)"""
_SCORED = f"""{_WINDOWS},
cnt as (select *, {_COUNTS}, {_count('masked', MARKETING_WORDS)} as fluff from (select *, {_MASK.format(x='text')} as masked from win) m),
scored as (select doc_id, start, "end", n, full_text, text,
   cast({_SUM} as double) * case when {_KINDS} >= 3 then 1.5::double else 1 end * case when c_spec_headers > 0 then 2.0::double else 1 end
     * case when fluff > 5 then 0.5::double else 1 end / length(text) * 1000 as score from cnt)"""
# With this budget the upper limit of 1.5 budgets never binds, so the choice is a prefix by score.
_SELECTED = f"""{_SCORED},
run as (select *, coalesce(sum("end" - start) over (partition by doc_id order by score desc, start rows between unbounded preceding and 1 preceding), 0) as before
        from scored where score > 0),
chosen as (select doc_id, start, "end", full_text from run where before < {BUDGET} * 1.2)"""
_STITCHED = f"""{_SELECTED},
prev as (select *, coalesce(max("end") over w, -1) as pe, row_number() over (partition by doc_id order by start) as rn from chosen
         window w as (partition by doc_id order by start rows between unbounded preceding and 1 preceding)),
grow as (select *, "end" - greatest(start, pe) as part, case when start >= pe then 1 else 0 end as fresh from prev),
tot as (select *, coalesce(sum(part) over (partition by doc_id order by start rows between unbounded preceding and 1 preceding), 0) as total from grow),
stop as (select doc_id, min(rn) as rn from tot where total + "end" - start > {BUDGET} group by doc_id),
kept as (select t.*, sum(fresh) over (partition by t.doc_id order by start) as island from tot t left join stop s on s.doc_id = t.doc_id where s.rn is null or t.rn < s.rn),
runs as (select doc_id, min(start) as start, max("end") as "end", any_value(full_text) as full_text from kept group by doc_id, island)"""
_TOC = f"array_to_string(list_filter(string_split(@@, chr(10)), lambda l: not regexp_matches(trim(l, ' ' || chr(9) || chr(13)), '{_q('|'.join(CONTENTS_LINES))}')), chr(10))"
_SEPARATOR = PASSAGE_SEPARATOR.replace("\n", "' || chr(10) || '")
_PASSAGES = f"""{_STITCHED},
joined as (select doc_id, string_agg(full_text[start + 1:"end"], '{_SEPARATOR}' order by start) as t from runs group by doc_id),
passages as (select d.doc_id, d.text, case when length(d.text) <= 5000 then d.text when j.t is null then d.text[:{BUDGET}] else {_TOC.replace('@@', 'j.t')} end as passage
  from fx_doc d left join joined j on j.doc_id = d.doc_id)"""


@REGISTRY.add("T01_make_windows", f"""with {_WINDOWS} select doc_id, cast(start as int) as start, cast("end" as int) as "end", text from win""")
def _(v):
    return ps.make_windows(v.fx_doc)


@REGISTRY.add("T02_score_windows", f"""with {_SCORED} select doc_id, cast(start as int) as start, round(score, 6) as score from scored""")
def _(v):
    scored = ps.score_windows(ps.make_windows(v.fx_doc))
    return scored.select("doc_id", "start", F.round("score", 6).alias("score"))


@REGISTRY.add("T03_select_windows", f"""with {_SELECTED} select doc_id, cast(start as int) as start, cast("end" as int) as "end" from chosen""")
def _(v):
    return ps.select_windows(v.fx_doc, BUDGET)


@REGISTRY.add("T04_stitch_windows", f"""with {_STITCHED} select doc_id, cast(start as int) as start, cast("end" as int) as "end" from runs""")
def _(v):
    return ps.stitch_windows(v.fx_doc, BUDGET)


_TOC_DOC = """(select doc_id, 'Camera . . . . . . . . . . 3' || chr(10) || text || chr(10) || '. . . . . . . . 2' || chr(10) || 'Chapter 4. Using the thing'
  || chr(10) || 'Short title line' || chr(10) || 'Cleaning and care of your new machine for the ' || chr(10) || 'End: 5 kg' as text from fx_doc)"""


@REGISTRY.add("T05_drop_toc_lines", f"select doc_id, {_TOC.replace('@@', 'text')} as text from {_TOC_DOC} d")
def _(v):
    lines = F.concat_ws(
        "\n", F.lit("Camera . . . . . . . . . . 3"), "text", F.lit(". . . . . . . . 2"), F.lit("Chapter 4. Using the thing"),
        F.lit("Short title line"), F.lit("Cleaning and care of your new machine for the "), F.lit("End: 5 kg"),
    )
    return ps.drop_toc_lines(v.fx_doc.select("doc_id", lines.alias("text")))


@REGISTRY.add("T06_select_passages", f"with {_PASSAGES} select doc_id, passage from passages")
def _(v):
    return ps.select_passages(v.fx_doc, BUDGET).select("doc_id", "passage")


_REPORT = " union all ".join(
    f"select '{name}' as pattern, cast(sum({_count('b', regex)}) as bigint) as before, cast(sum({_count('a', regex)}) as bigint) as after from m"
    for name, regex, _ in DENSITY_PATTERNS
)


@REGISTRY.add("G09_density_report", f"""
with {_PASSAGES},
m as (select {_MASK.format(x=f'text[:{BUDGET}]')} as b, {_MASK.format(x='passage')} as a from passages),
r as ({_REPORT}),
t as (select * from r union all select 'total', cast(sum(before) as bigint), cast(sum(after) as bigint) from r)
select *, case when before > 0 then round(cast(after - before as double) / before * 100, 1) end as change_percent from t""")
def _(v):
    pairs = ps.select_passages(v.fx_doc, BUDGET).select(F.substring("text", 1, BUDGET).alias("naive"), "passage")
    return ps.density_report(pairs, "naive", "passage")
