"""Catalog queries: names, prices, categories, loading."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.tables import rule_table
from shelfwise.operators import attributes as at
from shelfwise.operators import catalog as ct
from shelfwise.plans.registry import REGISTRY
from shelfwise.rules import FILE_CATEGORIES, MODEL_CASCADE, QUERY_CATEGORY_TERMS, QUERY_MODEL_CASCADE
from shelfwise.session import new_shared_path
from shelfwise.sources.loads import LoadedTable

BRAND_LIST = ["Brand#1", "Brand#12", "brand#2", "BRAND#25"]
CATEGORY_SLUGS = ["washing-machines", "air-fryers", "tvs", "laptops", "gadgets"]


def sql_brand(alias_brand="brand", alias_model="model") -> str:
    hits = " ".join(f"when starts_with(lower(name), '{b.lower()}') then '{b}'" for b in BRAND_LIST)
    rests = " ".join(f"when starts_with(lower(name), '{b.lower()}') then trim(name[{len(b) + 1}:])" for b in BRAND_LIST)
    return (
        f"case {hits} when contains(name, ' ') then split_part(name, ' ', 1) else name end as {alias_brand}, "
        f"case {rests} when contains(name, ' ') then name[strpos(name, ' ') + 1:] else name end as {alias_model}"
    )


def slug_rows() -> str:
    return ", ".join(f"({i + 1}, '{s}')" for i, s in enumerate(CATEGORY_SLUGS))


# Product names of several shapes.
NAME_CASES = """case product_id % 5
  when 0 then brand || ' AF' || cast(100 + product_id as string) || 'UK'
  when 1 then name
  when 2 then brand || ' ' || cast(product_id % 12 as string) || 'L T17190 Vortx 11L Deluxe'
  when 3 then '  Plain   words only here '
  else 'Solo' || cast(product_id as string) end"""

LINK_NAMES = """case product_id % 6 when 0 then null when 1 then '' when 2 then 'AO;Argos' when 3 then 'Laptop Chaos'
  when 4 then 'Currys;Amazon Marketplace' else 'Boots Kitchen Appliances' end"""


def with_links(v):
    names = F.expr(LINK_NAMES)
    links = F.when(names == "", F.array().cast("array<struct<name:string>>")).otherwise(
        F.transform(F.split(names, ";"), lambda n: F.struct(n.alias("name")))
    )
    return v.fx_product.withColumn("links", links)


SQL_LINKED = f"""
linked as (select *, case when {LINK_NAMES.replace(chr(10), ' ')} = '' then [] else string_split({LINK_NAMES}, ';') end as links from fx_product)"""


def slug_table(v):
    return rule_table(v.spark, {"category_id": list(range(1, len(CATEGORY_SLUGS) + 1)), "slug": CATEGORY_SLUGS})


@REGISTRY.add("B01_project_catalog", f"""
select product_id, category_id, name, {sql_brand()},
       try_cast(replace(replace(replace(price_text, '£', ''), '$', ''), ',', '') as double) as price,
       case when product_id % 4 <> 0 then score end as rating_score,
       case when product_id % 4 <> 0 and product_id % 3 <> 0 then 'Good ' || name end as summary,
       case when product_id % 4 <> 0 then brand end as pro, 'https://x.example.com/' || cast(product_id as varchar) as source_url,
       case when product_id % 2 = 0 then '1cm' end as depth, 'front' || cast(product_id as varchar) as front,
       'https://l.example.com/' || cast(product_id as varchar) as link
from (select * replace (case when product_id % 11 = 0 then 'n/a' else '£' || cast(product_id as varchar) || ',' || cast(100 + product_id % 900 as varchar) || '.50' end as price_text)
      from fx_product) p""")
def _(v):
    text = F.expr(
        "case when product_id % 11 = 0 then 'n/a' else '£' || cast(product_id as string) || ',' || cast(100 + product_id % 900 as string) || '.50' end"
    )
    reviews = F.when(F.expr("product_id % 4 <> 0"), F.struct(
        F.when(F.expr("product_id % 3 <> 0"), F.concat(F.lit("Good "), "name")).alias("summary"),
        F.array("brand").alias("pros"), F.array("brand").alias("cons"), F.col("score").alias("ratingScore"),
    ))
    number = F.col("product_id").cast("string")
    raw = v.fx_product.withColumns({
        "price_text": text, "reviews": reviews, "sourceUrl": F.concat(F.lit("https://x.example.com/"), number),
        "specs": F.when(F.expr("product_id % 2 = 0"), F.create_map(F.lit("depth"), F.lit("1cm"))),
        "images": F.struct(F.concat(F.lit("front"), number).alias("front"), F.lit(None).cast("string").alias("side")),
        "retailerLinks": F.array(F.struct(F.lit("Shop").alias("name"), F.concat(F.lit("https://l.example.com/"), number).alias("url"))),
    }).drop("brand", "price", "score")
    return ct.project_catalog(raw, BRAND_LIST).withColumns({
        "summary": F.col("reviews.summary"), "pro": F.col("reviews.pros")[0], "depth": F.col("specs")["depth"],
        "front": F.col("images.front"), "link": F.col("retailer_links")[0]["url"],
    }).drop("reviews", "specs", "features", "images", "retailer_links")


PRICE_TEXTS = """case product_id % 7 when 0 then '£' || cast(product_id as string) || ',999.50' when 1 then 'n/a' when 2 then '$12.5'
  when 3 then '999Typical price' when 4 then ' 45 ' when 5 then null else '£1,2,3' end"""


def _price_sql(mode: str) -> str:
    if mode == "listing":
        return r"coalesce(try_cast(nullif(regexp_extract(replace(replace(t, '£', ''), ',', ''), '^(\d+(?:\.\d+)?)', 1), '') as double), 0.0)"
    if mode == "load":
        return "try_cast(replace(replace(replace(t, '£', ''), '$', ''), ',', '') as double)"
    return "coalesce(try_cast(replace(replace(t, '£', ''), ',', '') as double), 0.0)"


for _mode in ("listing", "load", "legacy"):
    def _build(v, mode=_mode):
        return ct.clean_prices(v.fx_product.select("product_id", F.expr(PRICE_TEXTS).alias("price_text")), mode)

    REGISTRY.add(f"B02_clean_prices_{_mode}", f"""
select product_id, t as price_text, cast({_price_sql(_mode)} as double) as price
from (select product_id, {PRICE_TEXTS} as t from fx_product) p""")(_build)


@REGISTRY.add("B02_price_rejects", f"""
select * from (select product_id, t as price_text, cast({_price_sql('load')} as double) as price
from (select product_id, {PRICE_TEXTS} as t from fx_product) p) q where price is null or price = 0""")
def _(v):
    return ct.price_rejects(v.fx_product.select("product_id", F.expr(PRICE_TEXTS).alias("price_text")))


@REGISTRY.add("B03_split_brand_model", f"select product_id, name, {sql_brand()} from (select product_id, {NAME_CASES} as name from fx_product) p")
def _(v):
    return ct.split_brand_model(v.fx_product.select("product_id", F.expr(NAME_CASES).alias("name")), BRAND_LIST)


@REGISTRY.add("B03_brand_table", """
with b as (select lower(p_name) as low, min(p_partkey) as ord, arg_min(p_name, p_partkey) as brand from part group by 1),
p as (select l_orderkey, l_linenumber, p_name || case l_linenumber % 3 when 0 then 'X' when 1 then ' mark ' || cast(l_quantity as varchar) else '' end as name
      from lineitem join part on p_partkey = l_partkey),
hit as (select name, min(ord) as o from (select distinct name from p) p join b on starts_with(lower(name), low)
        and not regexp_matches(substr(name, length(brand) + 1, 1), '[A-Za-z0-9]') group by name)
select l_orderkey, l_linenumber, p.name, coalesce(b.brand, split_part(p.name, ' ', 1)) as brand,
       case when b.brand is not null then trim(substr(p.name, length(b.brand) + 1)) when contains(p.name, ' ') then substr(p.name, strpos(p.name, ' ') + 1) else p.name end as model
from p left join hit on hit.name = p.name left join b on b.ord = hit.o""")
def _(v):
    """Every part's name is a brand; names of ordered parts begin with one, a letter behind it or not."""
    name = "p_name || case l_linenumber % 3 when 0 then 'X' when 1 then ' mark ' || cast(l_quantity as string) else '' end as name"
    ordered = v.lineitem.join(v.part, F.col("p_partkey") == F.col("l_partkey")).selectExpr("l_orderkey", "l_linenumber", name)
    return ct.split_brand_model(ordered, v.part.select(F.col("p_name").alias("brand"), F.col("p_partkey").alias("ord")), strict=True)


@REGISTRY.add("B04_extract_model", f"""
select product_id, name, lower(regexp_extract(name, '^\\s*(\\S*)', 1)) as brand_word,
       coalesce({', '.join(f"nullif(regexp_extract(upper(name), '{p}', 0), '')" for p in MODEL_CASCADE)}, '') as model_number
from (select product_id, {NAME_CASES} as name from fx_product) p""")
def _(v):
    return ct.extract_model(v.fx_product.select("product_id", F.expr(NAME_CASES).alias("name")))


_TERMS = " ".join(f"when '{k}' then '{t}'" for k, t in QUERY_CATEGORY_TERMS.items())
_SLUG_CASE = "case category_id " + " ".join(f"when {i + 1} then '{s}'" for i, s in enumerate(CATEGORY_SLUGS)) + " end"


@REGISTRY.add("B05_build_queries", f"""
with named as (select product_id, {NAME_CASES} as name, {_SLUG_CASE} as category from fx_product),
m as (select *, string_split_regex(trim(name), '\\s+') as w,
        coalesce({', '.join(f"nullif(regexp_extract(name, '{p}', 1), '')" for p in QUERY_MODEL_CASCADE)}) as target_model from named),
h as (select *, list_filter(w[1:3], lambda x: not regexp_matches(x, '^\\d+(\\.\\d+)?[Ll]$') and not coalesce(contains(x, target_model), false)) as head,
        list_filter(w[4:5], lambda x: not regexp_matches(x, '^\\d+(\\.\\d+)?[Ll]$')) as more from m),
b as (select *, case when len(w) = 2 and length(target_model) >= 5 then lower(w[1]) || ' ' || target_model
        else lower(array_to_string((case when len(head) < 2 and len(w) > 3 then list_concat(head, more) else head end)[1:3], ' ')) end as base,
        case category {_TERMS} end as term from h)
select product_id, name, category, target_model,
       case when term is null or contains(lower(base), term) then base else base || ' ' || term end as search_query from b""")
def _(v):
    named = v.fx_product.select("product_id", F.expr(NAME_CASES).alias("name"), F.expr(_SLUG_CASE).alias("category"))
    return ct.build_queries(named)


_FILE_NAMES = """case product_id % 6 when 0 then 'air-fryers_full.json' when 1 then 'test_tvs.json' when 2 then 'cars.json'
  when 3 then 'laptops.metadata.json' when 4 then 'unknown.json' else 'washing_machines.json' end"""


@REGISTRY.add("B06_assign_category", f"""
select product_id, file_name, category from (select product_id, {_FILE_NAMES} as file_name from fx_product) p
join (values {', '.join(f"('{k}', '{c}')" for k, c in FILE_CATEGORIES.items())}) m(base, category)
  on m.base = replace(replace(file_name, '.metadata.json', ''), '.json', '') where not starts_with(file_name, 'test_')""")
def _(v):
    return ct.assign_category(v.fx_product.select("product_id", F.expr(_FILE_NAMES).alias("file_name")))


@REGISTRY.add("B06_category_from_url", f"""
select product_id, url, nullif(regexp_extract(url, '/reviews/([^/?#]+)', 1), '') as category
from (select product_id, case when product_id % 3 = 0 then 'https://x.example.com/news/1' else
        'https://x.example.com/reviews/' || {_SLUG_CASE} || '?page=' || cast(product_id as string) end as url from fx_product) p""")
def _(v):
    url = F.expr(
        f"case when product_id % 3 = 0 then 'https://x.example.com/news/1' else 'https://x.example.com/reviews/' || {_SLUG_CASE} || '?page=' || cast(product_id as string) end"
    )
    return ct.category_from_url(v.fx_product.select("product_id", url.alias("url")))


@REGISTRY.add("B07_split_by_links", f"""
with {SQL_LINKED}
select product_id, coalesce(len(links) > 0, false) as linked,
       coalesce(len(list_filter(links, lambda n: contains(lower(n), 'ao') or contains(lower(n), 'amazon'))) > 0, false) as from_source,
       coalesce(len(list_filter(links, lambda n: list_has_any(string_split_regex(lower(n), '[^a-z0-9]+'), ['ao', 'amazon']))) > 0, false) as from_source_strict
from linked""")
def _(v):
    links = F.col("links")
    return with_links(v).select(
        "product_id", ct.has_links(links).alias("linked"),
        ct.has_source(links, ["ao", "amazon"]).alias("from_source"),
        ct.has_source(links, ["ao", "amazon"], strict=True).alias("from_source_strict"),
    )


_GAP = "product_id, product_id % 37 as baseline, case when product_id % 4 = 0 then null else product_id % 9 end as added, case when product_id % 3 = 0 then 'AO' end as enrichment_source"
_GAP_SQL = f"""
(select *, greatest(cast(baseline as double) * 0.5::double, 5.0::double) as target,
   cast(floor(greatest(cast(baseline as double) * 0.5::double, 5)) as bigint) as target_specs,
   greatest(greatest(cast(baseline as double) * 0.5::double, 5.0::double) - coalesce(added, 0), 0.0::double) as gap
 from (select {_GAP} from fx_product) p) g"""


@REGISTRY.add("B08_enrichment_candidates", f"select * from {_GAP_SQL} where enrichment_source is null and gap > 0")
def _(v):
    return ct.enrichment_candidates(v.fx_product.selectExpr(*_split_select(_GAP)))


def _split_select(text: str) -> list[str]:
    """Comma-separated select items without commas inside them."""
    return [item.strip() for item in text.split(",")]


@REGISTRY.add("H08_enrichment_gap", f"select * from {_GAP_SQL}")
def _(v):
    return ct.enrichment_gap(v.fx_product.selectExpr(*_split_select(_GAP)))


_SLUG_SQL = r"""
slugged as (select product_id, name, case when s = '' then 'product' else rtrim(s[1:100], '-') end as slug from (
  select *, lower(trim(regexp_replace(regexp_replace(regexp_replace(name, '[\s_]+', '-', 'g'), '[^a-zA-Z0-9\-]', '', 'g'), '-+', '-', 'g'), '-')) as s
  from (select product_id, case when product_id % 97 = 3 then '##' else name || ' _ (' || brand || ') ' || repeat('x', cast(product_id % 90 as int)) end as name from fx_product) p) q)"""
_SLUG_NAME = "case when product_id % 97 = 3 then '##' else name || ' _ (' || brand || ') ' || repeat('x', cast(product_id % 90 as int)) end"


@REGISTRY.add("B11_build_slugs", f"with {_SLUG_SQL} select product_id, name, slug from slugged")
def _(v):
    return ct.build_slugs(v.fx_product.select("product_id", F.expr(_SLUG_NAME).alias("name"))).drop("display_name")


@REGISTRY.add("B11_slug_collisions", f"""
with {_SLUG_SQL} select slug, count(*) as products, min(product_id) as first_product from slugged group by slug having count(*) > 1""")
def _(v):
    return ct.slug_collisions(ct.build_slugs(v.fx_product.select("product_id", F.expr(_SLUG_NAME).alias("name"))))


@REGISTRY.add("B11_document_slugs", r"""
select doc_id as product_id, case when s = '' then 'product' else rtrim(s[1:100], '-') end as slug,
  array_to_string(list_transform(string_split(case when s = '' then 'product' else rtrim(s[1:100], '-') end, '-'), lambda w: upper(w[1]) || lower(w[2:])), ' ') as display_name from (
  select doc_id, lower(trim(regexp_replace(regexp_replace(regexp_replace(strip_accents(text), '[\s_]+', '-', 'g'), '[^a-zA-Z0-9\-]', '', 'g'), '-+', '-', 'g'), '-')) as s from documents) q""")
def _(v):
    """Slugs of whole document texts in four languages; accents need the folding step."""
    return ct.build_slugs(v.documents.select(F.col("doc_id").alias("product_id"), F.col("text").alias("name"))).drop("name")


_EXISTING = "category_id <= 3"


@REGISTRY.add("A09_load_products", """
select product_id, category_id, name, brand, price from fx_product""")
def _(v):
    rows = v.fx_product.select("product_id", "category_id", "name", "brand", "price")
    return ct.load_products(rows.where(_EXISTING), rows, ["category_id", "name"])


@REGISTRY.add("A09_load_new_products", f"""
select * from (select product_id, category_id, name, brand, price from fx_product) p
where not exists (select 1 from fx_product e where e.category_id <= 3 and e.name = p.name and e.category_id = p.category_id)""")
def _(v):
    rows = v.fx_product.select("product_id", "category_id", "name", "brand", "price")
    return ct.load_products(rows.where(_EXISTING), rows, ["category_id", "name"], "new")


@REGISTRY.add("A09_loads_once", """
select product_id, category_id, name, price from fx_product where category_id <= 3
union all select product_id, category_id, name, price + 1 from fx_product where category_id > 3""")
def _(v):
    """Two loads, each run twice: the second run of a load that is committed changes nothing."""
    rows = v.fx_product.select("product_id", "category_id", "name", "price")
    table = LoadedTable(v.spark, new_shared_path(v.spark, "catalog"), rows.schema, ["product_id"])
    for name, part in (("first", rows.where(_EXISTING)), ("second", rows.where(f"not ({_EXISTING})").withColumn("price", F.col("price") + 1))) * 2:
        table.append(part, name)
    return table.read()


_REPEATED_NAME = "case when product_id % 5 = 0 then brand else name end"


@REGISTRY.add("A09_left_out", f"""
with p as (select product_id, category_id, {_REPEATED_NAME} as name from fx_product),
k as (select distinct category_id, name from p where category_id <= 3),
n as (select min(product_id) as product_id from p anti join k using (category_id, name) group by category_id, name)
select p.*, case when exists (select 1 from k where k.category_id = p.category_id and k.name = p.name) then 'loaded before' else 'repeated in this load' end as reason
from p where product_id not in (select product_id from n)""")
def _(v):
    rows = v.fx_product.select("product_id", "category_id", F.expr(_REPEATED_NAME).alias("name"))
    return ct.left_out(rows.where(_EXISTING), rows, ["category_id", "name"])


@REGISTRY.add("A09_load_counts", """
select count(*) as total, count(*) as inserted, cast(0 as bigint) as left_out,
       count(*) filter (where price_text = 'n/a') as without_price from fx_product""")
def _(v):
    rows = v.fx_product.withColumn("price", F.when(F.col("price_text") != "n/a", F.col("price")))
    return ct.load_counts(rows.where(_EXISTING), rows, ["category_id", "name"])


@REGISTRY.add("A09_new_load_counts", """
select count(*) as total, count(*) filter (where category_id > 3) as inserted, count(*) filter (where category_id <= 3) as left_out,
       count(*) filter (where price_text = 'n/a') as without_price from fx_product""")
def _(v):
    rows = v.fx_product.withColumn("price", F.when(F.col("price_text") != "n/a", F.col("price")))
    return ct.load_counts(rows.where(_EXISTING), rows, ["category_id", "name"], "new")


_MODEL = "cast(product_id % 60 as string)"


@REGISTRY.add("F01_refresh_links", f"""
with catalog as (select product_id, brand, {_MODEL} as model, category_id, 'old' as links from fx_product),
incoming as (select brand, {_MODEL} as model, category_id, product_id as ord, 'https://n/' || cast(product_id as varchar) as links
             from fx_product where product_id % 5 <> 0),
latest as (select brand, model, category_id, max_by(links, ord) as links from incoming group by all),
firsts as (select brand, model, category_id, min(product_id) as product_id from catalog group by all),
up as (select f.product_id, l.links from firsts f join latest l using (brand, model, category_id))
select c.product_id, c.brand, c.model, c.category_id, coalesce(u.links, c.links) as links, u.links is not null as updated
from catalog c left join up u on u.product_id = c.product_id""")
def _(v):
    catalog = v.fx_product.select("product_id", "brand", F.expr(_MODEL).alias("model"), "category_id", F.lit("old").alias("links"))
    incoming = v.fx_product.select(
        "brand", F.expr(_MODEL).alias("model"), "category_id", F.col("product_id").alias("ord"),
        F.expr("case when product_id % 5 <> 0 then 'https://n/' || cast(product_id as string) end").alias("links"),
    )
    return ct.refresh_links(catalog, incoming)


@REGISTRY.add("F01_not_found", f"""
select brand, {_MODEL} as model, category_id, product_id as ord from fx_product p where not exists (
  select 1 from fx_product c where c.brand = p.brand and c.category_id = p.category_id + 1 and {_MODEL.replace('product_id', 'c.product_id')} = {_MODEL.replace('product_id', 'p.product_id')})""")
def _(v):
    catalog = v.fx_product.select("brand", F.expr(_MODEL).alias("model"), (F.col("category_id") - 1).alias("category_id"))
    incoming = v.fx_product.select("brand", F.expr(_MODEL).alias("model"), "category_id", F.col("product_id").alias("ord"), F.lit("x").alias("links"))
    return ct.unmatched_incoming(catalog, incoming).drop("links")


@REGISTRY.add("F03_overlay", """
select p.product_id, p.ord, case when u.product_id is null then p.price else u.price end as price,
       case when u.product_id is null then p.source else u.source end as source
from (select product_id, rnk as ord, price, cast(source_id as varchar) as source from fx_offer) p
left join (select product_id, max_by(price * 2, source_id) as price, 'update ' || cast(max(source_id) as varchar) as source
           from fx_offer where source_id % 3 = 0 group by product_id) u on u.product_id = p.product_id""")
def _(v):
    base = v.fx_offer.select("product_id", F.col("rnk").cast("bigint").alias("ord"), "price", F.col("source_id").cast("string").alias("source"))
    updates = v.fx_offer.where("source_id % 3 = 0").select(
        "product_id", F.col("source_id").alias("ord"), (F.col("price") * 2).alias("price"),
        F.concat(F.lit("update "), F.col("source_id").cast("string")).alias("source"),
    )
    return at.overlay(base, updates, "product_id", "ord")


@REGISTRY.add("F05_ensure_categories", f"""
with known as (select * from (values {slug_rows()}) k(category_id, slug)),
fresh as (select distinct lower(replace(p_type || '-' || p_name, ' ', '-')) as slug from part)
select cast(category_id as bigint) as category_id, slug, 'Known' as name from known
union all
select 5 + row_number() over (order by md5(slug)), slug,
       array_to_string(list_transform(string_split(slug, '-'), lambda w: upper(w[1]) || lower(w[2:])), ' ')
from fresh where slug not in (select slug from known)""")
def _(v):
    known = slug_table(v).withColumn("category_id", F.col("category_id").cast("bigint")).withColumn("name", F.lit("Known"))
    slugs = v.part.select(F.lower(F.replace(F.concat("p_type", F.lit("-"), "p_name"), F.lit(" "), F.lit("-"))).alias("slug"))
    return ct.ensure_categories(known, slugs)


@REGISTRY.add("F06_pending_categories", f"""
select cast(category_id as bigint) as category_id, slug from (values {slug_rows()}) k(category_id, slug)
where category_id not in (select category_id from fx_product where price_text <> 'n/a' and category_id < 4)""")
def _(v):
    landed = v.fx_product.where("category_id < 4").groupBy("category_id").agg(F.count_if(F.col("price_text") != "n/a").alias("products"))
    return ct.pending_categories(slug_table(v), landed.join(slug_table(v), "category_id").select("slug", "products"))


@REGISTRY.add("G01_run_summary", """
with s as (select product_id, count(*) filter (where kind = 'specs') as n_specs, count(*) filter (where kind = 'features') as n_features
           from fx_spec where product_id % 10 <> 0 group by product_id)
select count(*) as total, count(*) filter (where n_specs > 0) as successful_enriched,
       count(*) filter (where coalesce(n_specs, 0) = 0) as failed_enriched,
       cast(sum(n_specs) as bigint) as total_specs_extracted, cast(sum(n_features) as bigint) as total_features_extracted,
       count(*) filter (where p.product_id % 4 > 0) as products_with_images, cast(sum(p.product_id % 4) as bigint) as total_images,
       count(*) filter (where p.product_id % 6 <> 0) as products_with_url, count(*) filter (where price_text = 'n/a') as zero_price
from fx_product p left join s on s.product_id = p.product_id""")
def _(v):
    counts = v.fx_spec.where("product_id % 10 <> 0").groupBy("product_id").agg(
        F.count_if(F.col("kind") == "specs").alias("n_specs"), F.count_if(F.col("kind") == "features").alias("n_features")
    )
    products = v.fx_product.join(counts, "product_id", "left").selectExpr(
        "n_specs", "n_features", "product_id % 4 as n_images", "case when product_id % 6 <> 0 then 'u' end as source_url",
        "case when price_text = 'n/a' then 0.0D else price end as price",
    )
    return ct.run_summary(products)


@REGISTRY.add("G02_enrichment_summary", """
select case when source_id % 6 = 5 then 'unknown' else source_name end as source, count(*) as products, cast(sum(spec_count) as bigint) as specs_added
from fx_attempt where spec_count >= 20 group by all""")
def _(v):
    stats = v.fx_attempt.select(
        (F.col("spec_count") >= 20).alias("success"), F.expr("case when source_id % 6 <> 5 then source_name end").alias("source"), "spec_count"
    )
    return ct.enrichment_summary(stats)


@REGISTRY.add("G03_missing_links", f"""
with {SQL_LINKED}
select l.category_id, slug, upper(slug) as name, count(*) as missing from linked l join (values {slug_rows()}) k(category_id, slug) on k.category_id = l.category_id
where coalesce(len(links), 0) = 0 group by all""")
def _(v):
    return ct.missing_links(with_links(v), slug_table(v).withColumn("name", F.upper("slug")))


@REGISTRY.add("G03_smallest_missing", f"""
with {SQL_LINKED}
select arg_min(slug, missing * 100 + category_id) as slug, min(missing) as missing from (
select l.category_id, slug, count(*) as missing from linked l join (values {slug_rows()}) k(category_id, slug) on k.category_id = l.category_id
where coalesce(len(links), 0) = 0 group by all) q""")
def _(v):
    counts = ct.missing_links(with_links(v), slug_table(v).withColumn("name", F.upper("slug")))
    return counts.agg(F.min_by("slug", F.struct("missing", "category_id")).alias("slug"), F.min("missing").alias("missing"))


@REGISTRY.add("S01_union_branches", f"""
with {SQL_LINKED}
select case when coalesce(len(links) > 0, false) then 0 else 1 end as branch, product_id,
       case when coalesce(len(links) > 0, false) then price * 2 else price end as price from linked""")
def _(v):
    products = with_links(v)
    enriched = products.where(ct.has_links(F.col("links"))).select(F.lit(0).alias("branch"), "product_id", (F.col("price") * 2).alias("price"))
    untouched = products.where(~ct.has_links(F.col("links"))).select(F.lit(1).alias("branch"), "product_id", "price")
    return enriched.unionByName(untouched)
