"""Key profiling and filter metadata queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import metadata as md
from shelfwise.operators import profiling as pf
from shelfwise.plans.queries_attributes import n_products, quoted
from shelfwise.plans.registry import REGISTRY
from shelfwise.rules import (
    BLACKLIST_KEYS, BOOLEAN_FIELDS, METADATA_EXCLUDED_SPECS, NUMERIC_FIELD, STANDARD_UNIT_SPELLINGS, UNIT_SPELLINGS, VARIANT_SUFFIXES, YES_NO_VARIANTS,
)
from shelfwise.session import new_shared_path
from shelfwise.sources.loads import LoadedTable

# Specs keys of two more sources, so that spellings of one name meet.
MORE_KEYS = """(
  select product_id, kind, ord, key, value from fx_spec
  union all select product_id, 'specs', ord + 100, key || '_function', value from fx_spec where kind = 'features'
  union all select product_id, 'specs', ord + 200, key || '_mode', value from fx_spec where kind = 'features'
  union all select product_id, 'specs', 300, 'depth_centimeter', value from fx_spec where key = 'depth_cm'
  union all select product_id, 'specs', 301, 'run_' || case product_id % 3 when 0 then 'min' when 1 then 'mins' else 'minutes' end, value
            from fx_spec where key = 'depth'
  union all select product_id, 'specs', 302, 'energy_ratings', value from fx_spec where key = 'energy_rating'
  union all select product_id, 'specs', 303, 'spin_sped', value from fx_spec where key = 'spin_speed')"""


def more_keys(v):
    s = v.fx_spec
    big = lambda n: F.lit(n).cast("bigint")
    named = lambda df, key, ord_: df.select("product_id", F.lit("specs").alias("kind"), ord_.alias("ord"), key.alias("key"), "value")
    features = s.where("kind = 'features'")
    run = F.concat(F.lit("run_"), F.expr("case product_id % 3 when 0 then 'min' when 1 then 'mins' else 'minutes' end"))
    return (
        s.unionByName(named(features, F.concat("key", F.lit("_function")), F.col("ord") + 100))
        .unionByName(named(features, F.concat("key", F.lit("_mode")), F.col("ord") + 200))
        .unionByName(named(s.where("key = 'depth_cm'"), F.lit("depth_centimeter"), big(300)))
        .unionByName(named(s.where("key = 'depth'"), run, big(301)))
        .unionByName(named(s.where("key = 'energy_rating'"), F.lit("energy_ratings"), big(302)))
        .unionByName(named(s.where("key = 'spin_speed'"), F.lit("spin_sped"), big(303)))
    )


def spec_keys(v):
    return pf.key_table(more_keys(v)).where("kind = 'specs'")


SQL_KEYS = f"""
keys as (select key, count(*) as products, min(product_id * 1000 + ord) as place from {MORE_KEYS} m
         where kind = 'specs' and key not in ({quoted(BLACKLIST_KEYS)}) group by key)"""


@REGISTRY.add("C11_profile_values", "select distinct key, value from fx_spec where trim(value) <> ''")
def _(v):
    return pf.profile_values(v.fx_spec)


@REGISTRY.add("C12_normalization_candidates", rf"""
select key, count(*) as n_values, count(distinct lower(value)) as n_ignoring_case,
       bool_or(lower(value) in ({quoted(YES_NO_VARIANTS)})) as has_yes_no
from (select distinct key, value from fx_spec where trim(value) <> '') q
group by key
having count(*) > 1 and not ends_with(key, '_value')
   and not bool_and(try_cast(replace(value, ',', '.') as double) is not null)
   and (count(distinct lower(value)) < count(*) or bool_or(lower(value) in ({quoted(YES_NO_VARIANTS)})) or count(*) >= 3)""")
def _(v):
    return pf.normalization_candidates(pf.profile_values(v.fx_spec))


@REGISTRY.add("D01_analyze_keys", rf"""
with e as (select * from fx_spec where key not in ({quoted(BLACKLIST_KEYS)})),
s as (select kind, key, string_agg(value, '|' order by rn) as samples from (
        select *, row_number() over (partition by kind, key order by product_id, ord) as rn from e) q where rn <= 10 group by kind, key)
select e.kind, e.key, count(*) as products, any_value(s.samples) as samples,
       count(distinct case when e.kind = 'specs' and regexp_matches(value, '\d+[,.]?\d*\s*[A-Za-z°µ%£€$]+') then value end) as unit_values
from e join s on s.kind = e.kind and s.key = e.key group by e.kind, e.key""")
def _(v):
    return pf.analyze_keys(v.fx_spec).withColumn("samples", F.array_join("samples", "|"))


@REGISTRY.add("D01_unit_values", rf"""
select distinct key, value from fx_spec where kind = 'specs' and key not in ({quoted(BLACKLIST_KEYS)})
and regexp_matches(value, '\d+[,.]?\d*\s*[A-Za-z°µ%£€$]+')""")
def _(v):
    return pf.unit_values(v.fx_spec)


@REGISTRY.add("D02_suffix_clusters", f"""
with {SQL_KEYS},
b as (select *, regexp_replace(key, '({'|'.join(VARIANT_SUFFIXES)})$', '') as base from keys)
select base, string_agg(key, ',' order by products desc, place) as variants,
       string_agg(cast(products as varchar), ',' order by products desc, place) as coverage, count(*) as size,
       case when bool_or(key = base) then base else arg_min(key, -products * 1000000000 + place) end as suggested_canonical,
       cast(round(cast(max(products) as double) / min(products), 1) as varchar) || ':1' as coverage_ratio
from b group by base having count(*) > 1""")
def _(v):
    return pf.suffix_clusters(spec_keys(v))


# The longest common block of the texts a and b, the earliest in a and then in b.
_BLOCK = """list_max(flatten([[{'l': l, 'i': -i, 'j': -strpos(b, substr(a, i, l))}
  for l in range(1, length(a) - i + 2) if contains(b, substr(a, i, l))] for i in range(1, length(a) + 1)]))"""


@REGISTRY.add("D03_similar_keys", f"""
with recursive {SQL_KEYS},
b as (select *, regexp_replace(key, '({'|'.join(VARIANT_SUFFIXES)})$', '') as base from keys),
pairs as (select x.key as key1, y.key as key2, x.products as products1, y.products as products2
          from b x join b y on x.place < y.place and x.base <> y.base),
rest as (
  select key1, key2, key1 as a, key2 as b from pairs
  union all
  select key1, key2, unnest([substr(a, 1, -m.i - 1), substr(a, m.l - m.i)]), unnest([substr(b, 1, -m.j - 1), substr(b, m.l - m.j)])
  from (select *, {_BLOCK} as m from rest where a <> '' and b <> '') q where m is not null),
blocks as (select key1, key2, {_BLOCK} as m from rest where a <> '' and b <> ''),
ratios as (select key1, key2, 2.0::double * coalesce(sum(m.l), 0) / (length(key1) + length(key2)) as ratio from blocks group by key1, key2)
select key1, key2, round(ratio, 2) as similarity, products1, products2 from ratios join pairs using (key1, key2) where ratio >= 0.85""")
def _(v):
    return pf.similar_keys(spec_keys(v))


@REGISTRY.add("D04_unit_inconsistencies", f"""
with {SQL_KEYS},
u as (select * from (values {', '.join(f"('{unit}', '{s}')" for unit, all_ in UNIT_SPELLINGS.items() for s in all_)}) t(unit, suffix)),
m as (select *, key[:-(length(suffix) + 1)] as base, suffix in ({quoted(STANDARD_UNIT_SPELLINGS)}) as standard
      from keys join u on ends_with(key, suffix))
select base, string_agg(key, ',' order by products desc, place) as variants,
       string_agg(cast(products as varchar), ',' order by products desc, place) as coverage,
       arg_min(key, (case when standard then 0 else 1 end) * 1000000000000 - products * 100000000 + place) as suggested_canonical,
       'inconsistent_' || arg_min(unit, -products * 100000000 + place) || '_suffix' as reason
from m group by base having count(*) > 1""")
def _(v):
    return pf.unit_inconsistencies(spec_keys(v))


@REGISTRY.add("D05_redundant_pairs", f"""
with {SQL_KEYS}
select a.key as key1, b.key as key2, a.products as products1, b.products as products2,
       case when b.products > a.products then b.key else a.key end as suggested_canonical
from keys a join keys b on b.key = a.key || '_value'""")
def _(v):
    return pf.redundant_pairs(spec_keys(v))


@REGISTRY.add("D06_key_report", rf"""
with e as (select * from fx_spec where key not in ({quoted(BLACKLIST_KEYS)})),
u as (select distinct key, value from e where kind = 'specs' and regexp_matches(value, '\d+[,.]?\d*\s*[A-Za-z°µ%£€$]+')),
un as (select key, string_agg(value, ', ' order by value) filter (where rn <= 20) || case when count(*) > 20
         then ' ... (' || cast(count(*) as varchar) || ' total unique values)' else '' end as shown
       from (select *, row_number() over (partition by key order by value) as rn from u) q group by key),
s as (select kind, key, string_agg(value, ', ' order by rn) as shown from (
        select *, row_number() over (partition by kind, key order by product_id, ord) as rn from e) q where rn <= 5 group by kind, key)
select e.kind, e.key, count(*) as products,
       coalesce(any_value(case when e.kind = 'specs' then un.shown end), any_value(s.shown)) as shown
from e join s on s.kind = e.kind and s.key = e.key left join un on un.key = e.key
group by e.kind, e.key having count(*) >= greatest(2, floor((select count(*) from part) * 10 / 100))""")
def _(v):
    return pf.key_report(v.fx_spec, n_products(v), 10)


@REGISTRY.add("D07_key_consistency", """
with n as (select count(*) as n from part)
select kind, key, count(*) as products, cast(floor(count(*) * 100 / any_value(n)) as bigint) as percent,
       count(*) = any_value(n) as in_all, count(*) < any_value(n) * 0.5 as below_half
from fx_spec, n group by kind, key""")
def _(v):
    return pf.key_consistency(v.fx_spec, n_products(v))


CATEGORY_SPEC = """(select p_size % 5 + 1 as category_id, kind, key, value from (
  select product_id, kind, key, value from fx_spec
  union all select product_id, 'specs', 'price_band', case when product_id % 4 = 0 then 'from £' || cast(product_id % 3 as string)
       else '£' || cast(product_id % 60 as string) || '.5 each' end from fx_spec where key = 'depth'
  union all select product_id, 'specs', 'running_cost', case when product_id % 4 <> 0 then 'about ' || cast(product_id % 90 as string)
       else cast(product_id % 2 as string) end from fx_spec where key = 'depth'
  union all select product_id, 'specs', '@excluded', 'x' from fx_spec where key = 'depth') s
  join part on p_partkey = product_id)""".replace("@excluded", METADATA_EXCLUDED_SPECS[0])


def category_spec(v):
    depth = v.fx_spec.where("key = 'depth'")
    band = F.expr("case when product_id % 4 = 0 then 'from £' || cast(product_id % 3 as string) else '£' || cast(product_id % 60 as string) || '.5 each' end")
    cost = F.expr("case when product_id % 4 <> 0 then 'about ' || cast(product_id % 90 as string) else cast(product_id % 2 as string) end")
    added = [("price_band", band), ("running_cost", cost), (METADATA_EXCLUDED_SPECS[0], F.lit("x"))]
    rows = v.fx_spec
    for key, value in added:
        rows = rows.unionByName(depth.withColumn("key", F.lit(key)).withColumn("value", value))
    return rows.join(v.fx_product.select("product_id", "category_id"), "product_id")


SQL_TYPE = (
    f"case when key in ({quoted(BOOLEAN_FIELDS)}) then 'boolean' when regexp_matches(key, '{NUMERIC_FIELD}') then 'number' else 'string' end"
)
SQL_VALUES = rf"""
typed as (select *, {SQL_TYPE} as t, try_cast(nullif(regexp_extract(replace(replace(replace(value, '£', ''), '$', ''), '€', ''),
            '^(-?\d+(?:\.\d+)?)', 1), '') as double) as n, lower(trim(value)) as w
          from {CATEGORY_SPEC} c where trim(value) <> '' and not (kind = 'specs' and key = '{METADATA_EXCLUDED_SPECS[0]}')),
vals as (select distinct cast(category_id as bigint) as category_id, kind, key, case when t = 'number' then n end as num_value,
           case when t = 'boolean' then case when w in ('yes', 'true', '1') then true when w in ('no', 'false', '0') then false end end as bool_value,
           case when t = 'string' or (t = 'number' and n is null) then value end as text_value from typed),
known as (select * from vals where num_value is not null or bool_value is not null or text_value is not null)"""
SQL_RESOLVED = f"""{SQL_VALUES},
counted as (select *, count(num_value) over w as nums, count(text_value) over w as texts from known
            window w as (partition by category_id, kind, key)),
resolved as (select distinct category_id, kind, key,
  case when bool_value is not null then 'boolean' when num_value is not null and (texts = 0 or nums >= texts) then 'number' else 'string' end as value_type,
  case when texts = 0 or nums >= texts then num_value end as num_value, bool_value,
  case when texts > 0 and nums < texts and num_value is not null then cast(num_value as varchar) else text_value end as text_value
  from counted where not (nums > 0 and texts > 0 and nums >= texts and num_value is null))"""


@REGISTRY.add("E01_type_fields", f"select distinct kind, key, {SQL_TYPE} as field_type from fx_spec")
def _(v):
    return md.type_fields(v.fx_spec)


@REGISTRY.add("E02_distinct_values", f"with {SQL_VALUES} select * from known")
def _(v):
    return md.distinct_values(category_spec(v))


@REGISTRY.add("E03_resolve_types", f"with {SQL_RESOLVED} select * from resolved")
def _(v):
    return md.build_metadata(category_spec(v))


@REGISTRY.add("E04_metadata_counts", f"""
with {SQL_RESOLVED}
select category_id, kind, count(distinct key) as fields, count(*) as values from resolved group by category_id, kind""")
def _(v):
    return md.metadata_counts(md.build_metadata(category_spec(v)))


@REGISTRY.add("A10_upsert_metadata", """
with new as (select category_id, count(*) as field_values, cast(null as double) as price, cast(null as double) as score
             from fx_product group by category_id),
old as (select category_id + 2 as category_id, count(*) as field_values, min(price) as price, max(score) as score from fx_product group by category_id)
select coalesce(n.category_id, o.category_id) as category_id, coalesce(n.field_values, o.field_values) as field_values,
       o.price as price, o.score as score,
       case when n.category_id is null then 'kept' when o.category_id is not null then 'updated' else 'inserted' end as action
from new n full join old o on o.category_id = n.category_id""")
def _(v):
    stats = v.fx_product.groupBy("category_id").agg(
        F.count("*").alias("field_values"), F.min("price").alias("price"), F.max("score").alias("score")
    )
    new = stats.select("category_id", "field_values", F.lit(None).cast("double").alias("price"), F.lit(None).cast("double").alias("score"))
    return md.upsert_metadata(stats.withColumn("category_id", F.col("category_id") + 2), new, ["price", "score"])


@REGISTRY.add("A10_bucketed_upsert", """
select product_id, case when product_id % 50 = 7 then category_id + 100 else category_id end as field_values, price, score
from fx_product where product_id % 3 <> 0 or product_id % 50 = 7""")
def _(v):
    """Only the buckets of the upserted keys are read and rewritten; stored prices and scores stay, new keys bring their own."""
    stored = v.fx_product.selectExpr("product_id as category_id", "cast(category_id as bigint) as field_values", "price", "score")
    table = LoadedTable(v.spark, new_shared_path(v.spark, "metadata"), stored.schema, ["category_id"])
    table.append(stored.where("category_id % 3 <> 0"), "stored")
    fresh = stored.where("category_id % 50 = 7").withColumn("field_values", F.col("field_values") + 100)
    fresh = fresh.withColumns({c: F.when(F.col("category_id") % 3 == 0, F.col(c)) for c in ("price", "score")})
    table.upsert(fresh, "fresh", lambda old, new: md.upsert_metadata(old, new, ["price", "score"]).drop("action"))
    return table.read().withColumnRenamed("category_id", "product_id")
