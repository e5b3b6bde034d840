"""Attribute standardization queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.tables import rule_table
from shelfwise.operators import attributes as at
from shelfwise.operators import standardize as st
from shelfwise.plans.registry import REGISTRY
from shelfwise.plans.standardizing import RuleSet, product_rules, read_rules, standardize, write_rules
from shelfwise.rules import BLACKLIST_KEYS, BOOLEAN_WORDS, KEY_UNIT_SUFFIXES, RESIDUAL_UNITS, UNIT_PATTERNS
from shelfwise.session import new_shared_path

RULES = RuleSet(
    merges={"timer_function": "timer", "depth_centimeters": "depth_cm", "programmes": "number_of_programmes"},
    deletions=["energy_rating", "supply_v"],
    unit_rules={
        "weight": (["g", "kg"], "weight_kg"),
        "width": (["mm", "cm"], "width_cm"),
        "capacity": (["L", "Litres"], "capacity_l"),
        "energy_rating": (["kWh", "to"], "energy_rating"),
    },
    remove_specs=["rare_key"],
    remove_features=["smart"],
)
VALUE_MAP = [("colour", "black", "Black"), ("autodose", "Ja", "Yes"), ("autodose", "Nee", "No")]


def value_map_table(spark):
    keys, values, normalized = zip(*VALUE_MAP)
    return rule_table(spark, {"key": list(keys), "value": list(values), "normalized": list(normalized)})


def n_products(v):
    return v.part.agg(F.count("*").alias("n")).scalar()


# --- SQL counterparts ---------------------------------------------------------------------------

def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def sql_number_text(x: str) -> str:
    return f"case when {x} = floor({x}) then cast(cast({x} as bigint) as varchar) else cast({x} as varchar) end"


def sql_units_auto(source: str) -> str:
    unit = "case " + " ".join(
        f"when regexp_matches(trim(value), '(?i){r}') then '{n}'" for n, _, r, _ in UNIT_PATTERNS
    ) + " end"
    number = "case u " + " ".join(
        f"when '{n}' then "
        + (
            sql_number_text(f"(cast(regexp_extract(trim(value), '(?i){r}', 1) as double) / {d})")
            if d else f"regexp_extract(trim(value), '(?i){r}', 1)"
        )
        for n, _, r, d in UNIT_PATTERNS
    ) + " end"
    suffix = "case u " + " ".join(f"when '{n}' then '{s}'" for n, s, _, _ in UNIT_PATTERNS) + " end"
    return f"""
select product_id, kind, ord, case when u is null or ends_with(key, sfx) then key else key || sfx end as key,
       case when u is null then value else num end as value
from (select *, {number} as num, {suffix} as sfx from (select *, {unit} as u from {source}) q1) q2"""


def sql_clean(x: str) -> str:
    return rf"trim(replace(replace(regexp_replace({x}, '(\d),(\d)', '\1.\2', 'g'), '–', '-'), '—', '-'))"


def sql_rule_rows() -> str:
    return " union all ".join(
        f"select '{k}' as key, [{quoted(sorted(units, key=len, reverse=True))}] as units, '{new}' as new_key"
        for k, (units, new) in RULES.unit_rules.items()
    )


def sql_units_rules(source: str) -> str:
    cut = sql_clean(r"regexp_replace(trim(value), '(?i)(\d)\s*mm\s*', '\1', 'g')")
    return rf"""
select product_id, kind, ord, coalesce(new_key, key) as key,
  case when new_key is null then value
       when mm then case when ends_with(new_key, '_cm') and try_cast(cut as double) is not null
                         then {sql_number_text('(cast(cut as double) / 10)')} else cut end
       when u_end is not null then {sql_clean("regexp_replace(trim(value), '(?i)\\s*' || u_end || '\\s*$', '')")}
       when u_any is not null then {sql_clean("regexp_replace(trim(value), '(?i)\\s*' || u_any || '\\s*', '', 'g')")}
       else {sql_clean('trim(value)')} end as value
from (select e.*, r.new_key, regexp_matches(trim(value), '(?i)\d\s*mm') as mm, {cut} as cut,
        list_filter(r.units, lambda u: ends_with(lower(trim(value)), lower(u)))[1] as u_end,
        list_filter(r.units, lambda u: contains(lower(trim(value)), lower(u)))[1] as u_any
      from {source} e left join ({sql_rule_rows()}) r on r.key = e.key) q"""


def sql_collisions(source: str) -> str:
    return f"""
select product_id, kind, min(ord) as ord, key, max_by(value, ord) as value
from {source} group by product_id, kind, key"""


def sql_comparable(key: str) -> str:
    return (
        f"replace(replace(replace(regexp_replace(lower({key}), '[_\\- ](?:{'|'.join(KEY_UNIT_SUFFIXES)})$', ''), "
        "'_', ''), '-', ''), ' ', '')"
    )


def sql_unify(source: str) -> str:
    canonical = "case key " + " ".join(f"when '{a}' then '{c}'" for a, c in RULES.merges.items()) + " else key end"
    return f"""
select product_id, kind, ord, key, value from (
  select *, row_number() over (partition by product_id, kind, {sql_comparable('key')} order by ord) as rn
  from (select product_id, kind, ord, {canonical} as key, value from {source}) q) q2 where rn = 1"""


def sql_coverage(source: str, percent: int) -> str:
    return f"""
select e.* from {source} e join (
  select kind, key from {source} group by kind, key
  having count(distinct product_id) >= greatest(1, floor((select count(*) from part) * {percent} / 100))) k
on k.kind = e.kind and k.key = e.key"""


def sql_values(source: str) -> str:
    rows = ", ".join(f"({quoted(row)})" for row in VALUE_MAP)
    return f"""
select product_id, kind, ord, e.key, coalesce(m.normalized, e.value) as value,
       coalesce(m.normalized, e.value) <> e.value as changed
from {source} e left join (values {rows}) m(key, value, normalized) on m.key = e.key and m.value = e.value"""


def sql_kinds(source: str) -> str:
    """Step by step: specs to features with overwriting, then features to specs with overwriting."""
    words = quoted(BOOLEAN_WORDS)
    return f"""
select product_id, kind, ord, key, value from (
 with stats as (
   select kind, key, coalesce(bool_and(lower(trim(value)) in ({words})) filter (where trim(value) <> ''), false) as b
   from {source} group by kind, key),
 go_features as (select key from stats where kind = 'specs' and b),
 go_specs as (select key from stats where kind = 'features' and not b),
 s0 as (select * from {source} where kind = 'specs'),
 f0 as (select * from {source} where kind = 'features'),
 moved1 as (select * from s0 where key in (from go_features)),
 s1 as (select * from s0 where key not in (from go_features)),
 f1 as (
   select coalesce(m.product_id, f.product_id) as product_id, coalesce(m.key, f.key) as key,
          coalesce(m.value, f.value) as value, f.ord as o_f, m.ord as o_m
   from f0 f full join moved1 m on m.product_id = f.product_id and m.key = f.key),
 moved2 as (select * from f1 where key in (from go_specs)),
 f2 as (select product_id, key, value, coalesce(o_f, o_m + 4294967296) as ord from f1 where key not in (from go_specs)),
 s2 as (
   select coalesce(m.product_id, s.product_id) as product_id, coalesce(m.key, s.key) as key,
          coalesce(m.value, s.value) as value,
          coalesce(s.ord, least(m.o_f, m.o_m) + 4294967296) as ord
   from s1 s full join moved2 m on m.product_id = s.product_id and m.key = s.key)
 select product_id, 'specs' as kind, ord, key, value from s2
 union all select product_id, 'features', ord, key, value from f2) q"""


def sql_product_rules(source: str) -> str:
    auto = sql_units_auto(f"(select * from {source} where key not in ({quoted(RULES.unit_rules)})) a")
    ruled = sql_units_rules(f"(select * from {source} where key in ({quoted(RULES.unit_rules)}))")
    unified = sql_unify(f"({sql_collisions(f'({auto} union all {ruled}) u')}) c")
    return f"""
select * from ({unified}) f where key not in ({quoted(RULES.deletions)})
and not (kind = 'specs' and key in ({quoted(RULES.remove_specs)}))
and not (kind = 'features' and key in ({quoted(RULES.remove_features)}))"""


# --- queries ------------------------------------------------------------------------------------


@REGISTRY.add("C01_eav_round_trip", """
select product_id, kind, count(*) as n_keys, string_agg(key || '=' || value, ';' order by ord) as packed
from fx_spec group by product_id, kind""")
def _(v):
    """Maps of every product to rows and back to maps, read out in map order."""
    products = at.from_eav(v.fx_spec)
    maps = at.from_eav(at.to_eav(products))

    def read(kind):
        text = F.array_join(F.transform(F.map_entries(kind), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
        return F.struct(F.lit(kind).alias("kind"), F.size(kind).cast("bigint").alias("n_keys"), text.alias("packed"))

    return maps.select("product_id", F.inline(F.array(read("specs"), read("features"))))


@REGISTRY.add("C02_normalize_labels", """
select product_id, kind, ord, key, value from (
select product_id, kind, ord,
  regexp_replace(regexp_replace(lower(regexp_replace(upper(key) || '. (' || kind || '):', '[:]', '', 'g')), '[^a-z0-9]+', '_', 'g'),
                 '^_|_$', '', 'g') as key, value from fx_spec) q where key <> ''""")
def _(v):
    labelled = v.fx_spec.withColumn("key", F.concat(F.upper("key"), F.lit(". ("), "kind", F.lit("):")))
    return at.normalize_labels(labelled)


@REGISTRY.add("C03_extract_units_auto", sql_units_auto("fx_spec"))
def _(v):
    return st.extract_units_auto(v.fx_spec)


_BLANK_KEYS = "key in ('weight', 'width', 'capacity', 'spin_speed')"


@REGISTRY.add("C03_unicode_blanks", sql_units_auto(f"(select * from fx_spec where {_BLANK_KEYS}) s"))
def _(v):
    """Values whose blanks are no-break spaces give what plain ones give."""
    value = F.when(F.expr("product_id % 2 = 0"), F.translate("value", " ", "\u00a0")).otherwise(F.concat(F.lit("\u202f"), F.translate("value", " ", "\u202f")))
    return st.extract_units_auto(v.fx_spec.where(_BLANK_KEYS).withColumn("value", value))


@REGISTRY.add("C04_extract_units_rules", sql_units_rules("fx_spec"))
def _(v):
    return st.extract_units_rules(v.fx_spec, RULES.unit_table(v.spark))


@REGISTRY.add("C05_clean_numbers", f"""
select kind, key, {sql_clean("value || '–48'")} as value, count(*) as n from fx_spec group by all""")
def _(v):
    cleaned = v.fx_spec.withColumn("value", st.clean_number_text(F.concat("value", F.lit("–48"))))
    return cleaned.groupBy("kind", "key", "value").agg(F.count("*").alias("n"))


@REGISTRY.add("C06_resolve_collisions", sql_collisions(f"({sql_units_auto('fx_spec')}) u"))
def _(v):
    return st.resolve_collisions(st.extract_units_auto(v.fx_spec))


@REGISTRY.add("C07_unify_keys", sql_unify("(" + sql_collisions(f"({sql_units_auto('fx_spec')}) u") + ") c"))
def _(v):
    return st.unify_keys(st.resolve_collisions(st.extract_units_auto(v.fx_spec)), RULES.merge_table(v.spark))


@REGISTRY.add("C08_delete_keys", "select * from fx_spec where key not in ('energy_rating', 'supply')")
def _(v):
    return at.delete_keys(v.fx_spec, ["energy_rating", "supply"])


@REGISTRY.add("C09_remove_cross_kind", """
select * from fx_spec where not (kind = 'specs' and key in ('rare_key', 'smart'))
and not (kind = 'features' and key in ('smart', 'depth'))""")
def _(v):
    return at.remove_cross_kind(v.fx_spec, ["rare_key", "smart"], ["smart", "depth"])


@REGISTRY.add("C10_filter_coverage", sql_coverage("fx_spec", 10))
def _(v):
    return st.filter_coverage(v.fx_spec, n_products(v), 10)


@REGISTRY.add("C10_coverage_stats", """
select kind, count(*) filter (where n >= greatest(1, floor((select count(*) from part) * 10 / 100))) as kept,
       count(*) filter (where n < greatest(1, floor((select count(*) from part) * 10 / 100))) as removed
from (select kind, key, count(distinct product_id) as n from fx_spec group by kind, key) q group by kind""")
def _(v):
    return st.coverage_stats(v.fx_spec, n_products(v), 10)


@REGISTRY.add("C13_normalize_values", sql_values("fx_spec"))
def _(v):
    return st.normalize_values(v.fx_spec, value_map_table(v.spark))


TWO_KINDS = """(select * from fx_spec union all
 select product_id, kind, ord + 100, key, value from fx_extra_spec where kind = 'features' and key <> 'smart')"""


def two_kinds(v):
    extra = v.fx_extra_spec.where("kind = 'features' and key <> 'smart'").withColumn("ord", F.col("ord") + 100)
    return v.fx_spec.unionByName(extra)


@REGISTRY.add("C14_assign_kinds", sql_kinds(f"{TWO_KINDS} t"))
def _(v):
    return st.assign_kinds(two_kinds(v))


@REGISTRY.add("C14_kind_stats", f"""
with two as materialized {TWO_KINDS}, moved as materialized ({sql_kinds('two')}),
stats as (select kind, key, coalesce(bool_and(lower(trim(value)) in ({quoted(BOOLEAN_WORDS)})) filter (where trim(value) <> ''), false) as b from two group by kind, key)
select count(distinct key) filter (where kind = 'specs' and b) as boolean_fields_in_specs,
       count(distinct key) filter (where kind = 'features' and not b) as non_boolean_fields_in_features,
       (select count(*) from two) - (select count(*) from moved) as values_lost from stats""")
def _(v):
    return st.kind_stats(two_kinds(v))


@REGISTRY.add("C15_validate", rf"""
with named as (select product_id, kind, ord, key, value from fx_spec
               union all select product_id, 'specs', 50, 'DEPTH', value from fx_spec where key = 'depth'),
found as (select *, list_filter([{quoted(RESIDUAL_UNITS)}],
            lambda u: regexp_matches(value, '(?i)\b(\d+\.?\d*)\s*' || u || '\b')) as f from named)
select case kind when 'specs' then 'units_in_values' else 'units_in_features' end as issue, product_id, key, value,
       array_to_string(f, ',') as detail from found where len(f) > 0
union all
select 'duplicate_keys', product_id, key, value, first_key from (
  select *, first_value(key) over w as first_key, row_number() over w as rn from named where kind = 'specs'
  window w as (partition by product_id, replace(replace(replace(lower(key), '_', ''), '-', ''), ' ', '') order by ord)) q
where rn > 1""")
def _(v):
    again = v.fx_spec.where("key = 'depth'").withColumn("key", F.lit("DEPTH")).withColumn("ord", F.lit(50).cast("bigint"))
    return st.validate(v.fx_spec.unionByName(again))


@REGISTRY.add("C15_validation_summary", f"""
select count(*) as issues, count(*) filter (where issue = 'duplicate_keys') as duplicate_keys, count(*) = 0 as passed
from (
  select 'units' as issue from ({sql_units_auto('fx_spec')}) u
  where regexp_matches(value, '(?i)\\b(\\d+\\.?\\d*)\\s*({'|'.join(RESIDUAL_UNITS)})\\b')
  union all
  select 'duplicate_keys' from (
    select row_number() over (partition by product_id, replace(replace(replace(lower(key), '_', ''), '-', ''), ' ', '')
                              order by ord) as rn from ({sql_units_auto('fx_spec')}) u where kind = 'specs') q where rn > 1
) i""")
def _(v):
    return st.validation_summary(st.validate(st.extract_units_auto(v.fx_spec)))


_VALUED = f"(select product_id, kind, ord, key, value from ({sql_values('(' + sql_coverage('local', 10) + ')')}) v)"
STANDARDIZE_SQL = f"with local as materialized ({sql_product_rules('fx_spec')}), valued as materialized {_VALUED} {sql_kinds('valued')}"


@REGISTRY.add("C16_standardize", STANDARDIZE_SQL)
def _(v):
    return standardize(v.fx_spec, v.part, RULES, value_map_table(v.spark), 10)


@REGISTRY.add("C16_product_rules", sql_product_rules("fx_spec"))
def _(v):
    return product_rules(v.fx_spec, RULES)


@REGISTRY.add("C16_stored_rules", sql_product_rules("fx_spec"))
def _(v):
    path = new_shared_path(v.spark, "unification_map")
    write_rules(v.spark, RULES, path)
    return product_rules(v.fx_spec, read_rules(v.spark, path))


@REGISTRY.add("C17_fill_gaps", """
select product_id, kind, min(ord) as ord, key, min_by(value, src) as value from (
  select product_id, kind, ord + 4294967296 as ord, key, value, 0 as src from fx_spec
  union all select product_id, kind, ord, key, value, 1 from fx_extra_spec) q
group by product_id, kind, key""")
def _(v):
    return at.fill_gaps(v.fx_spec, v.fx_extra_spec)


@REGISTRY.add("C18_drop_keys", "select * from fx_extra_spec where key not in ('special_feature', 'product_dimensions')")
def _(v):
    return at.delete_keys(v.fx_extra_spec, ["special_feature", "product_dimensions"])


@REGISTRY.add("A04_flatten_sections", """
with sectioned as (
  select product_id, cast(0 as bigint) as section_ord, ord, key, value from fx_spec
  union all select product_id, 1, ord, key, value from fx_extra_spec)
select product_id, key, arg_max(value, section_ord * 1000 + ord) as value,
       min(section_ord) as section_ord, arg_min(ord, section_ord * 1000 + ord) as ord
from sectioned group by product_id, key""")
def _(v):
    sections = v.fx_spec.withColumn("section_ord", F.lit(0).cast("bigint")).unionByName(
        v.fx_extra_spec.withColumn("section_ord", F.lit(1).cast("bigint"))
    )
    return at.flatten_sections(sections)


@REGISTRY.add("B09_filter_blacklist", f"select * from fx_spec where key not in ({quoted(BLACKLIST_KEYS)})")
def _(v):
    return at.filter_blacklist(v.fx_spec, BLACKLIST_KEYS)


@REGISTRY.add("B09_blacklist_hits", f"select distinct kind, key from fx_spec where key in ({quoted(BLACKLIST_KEYS)})")
def _(v):
    return at.blacklist_hits(v.fx_spec, BLACKLIST_KEYS)


@REGISTRY.add("B10_unit_bearing", r"""
select kind, key, value, count(*) as n from fx_spec
where regexp_matches(value, '\d+[,.]?\d*\s*[A-Za-z°µ%£€$]+') group by all""")
def _(v):
    from shelfwise.operators.profiling import unit_bearing

    return unit_bearing(v.fx_spec).groupBy("kind", "key", "value").agg(F.count("*").alias("n"))


@REGISTRY.add("S02_distinct_keys", "select distinct key from fx_spec")
def _(v):
    return v.fx_spec.select("key").distinct()
