"""Search, ranking, facet and metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import browsing as br
from shelfwise.operators import facet_index as fi
from shelfwise.operators import ranked_search as rs
from shelfwise.operators import search as sc
from shelfwise.plans.queries_attributes import quoted
from shelfwise.plans.registry import REGISTRY
from shelfwise.plans.views import SPEC_ROWS
from shelfwise.rules import INTENT_WORDS, PRICE_INTENTS, SIZE_INTENTS
from shelfwise.session import new_shared_path


def catalog(v):
    """Products with attribute maps, built inside each row."""
    def entries(kind):
        rows = [r for r in SPEC_ROWS if r[0] == kind]
        structs = ", ".join(
            f"{'if(' + when + ', ' if when else ''}struct('{key}', {value}){', null)' if when else ''}" for _, _, key, value, when in rows
        )
        return F.expr(f"map_from_entries(filter(array({structs}), r -> r is not null))").alias(kind)

    maps = v.part.select(F.col("p_partkey").alias("product_id"), entries("specs"), entries("features"))
    part = v.fx_product.join(maps, "product_id")
    return part.withColumn("model", F.expr("'MX' || cast(product_id as string)"))


# All searchable words of a product, as text.
SQL_TEXT = """
words as (select p.product_id, p.category_id, p.name || ' ' || p.brand || ' MX' || cast(p.product_id as varchar) || ' '
            || string_agg(s.key || ' ' || s.value, ' ' order by case kind when 'specs' then 0 else 1 end, ord) as text
          from fx_product p join fx_spec s on s.product_id = p.product_id group by p.product_id, p.category_id, p.name, p.brand),
idx as (select category_id, product_id, term, count(*) as tf from (
          select category_id, product_id, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) as term from words) w where term <> '' group by all)"""


@REGISTRY.add("K01_build_index", f"with {SQL_TEXT} select * from idx")
def _(v):
    return sc.build_index(catalog(v))


_stored: dict[tuple[str, str], str] = {}


def stored_index(v):
    """The term table of this catalog, stored once a session and read from there."""
    key = (v.spark.sparkContext.applicationId, v.sf_dir)
    if key not in _stored:
        _stored[key] = new_shared_path(v.spark, "index")
        sc.write_index(sc.build_index(catalog(v), positions=True), _stored[key])
    return sc.read_index(v.spark, _stored[key])


OUT = ["product_id", "category_id", "name", "brand", "price", "score", "relevance_score"]


def rounded(df):
    return df.withColumn("relevance_score", F.round("relevance_score", 6)).select(*OUT)


@REGISTRY.add("K02_smart_search", f"""
with {SQL_TEXT},
hit as (select product_id, bool_or(term = 'yes') and bool_or(term = 'widget') as ok, sum(cast(tf as double) / (tf + 1)) / 2 as ts
        from idx where term in ('yes', 'widget') group by product_id)
select p.product_id, category_id, name, brand, price, score, round(ts * 40 + 30 + 20 + coalesce(score / 10, 0), 6) as relevance_score
from fx_product p join hit h on h.product_id = p.product_id and h.ok
where category_id = 2 and price between 905 and 1500 and brand in ('Brand#1', 'Brand#12', 'Brand#13', 'Brand#14', 'Brand#17', 'Brand#2', 'Brand#20', 'Brand#5')
order by round(ts * 40 + 30 + 20 + coalesce(score / 10, 0), 12) desc, score desc nulls last, product_id limit 200""")
def _(v):
    products = catalog(v)
    brands = ["Brand#1", "Brand#12", "Brand#13", "Brand#14", "Brand#17", "Brand#2", "Brand#20", "Brand#5"]
    return rounded(sc.smart_search(products, stored_index(v), 2, "widget yes", 905.0, 1500.0, brands))


@REGISTRY.add("K02_soft_price_search", """
select product_id, category_id, name, brand, price, score,
  round(case when price between 920 and 950 then 30 when price < 920 then greatest(0, 30 - (920 - price) / 50) else greatest(0, 30 - (price - 950) / 50) end
        + coalesce(score / 10, 0), 6) as relevance_score from fx_product where category_id = 3
order by round(case when price between 920 and 950 then 30 when price < 920 then greatest(0, 30 - (920 - price) / 50) else greatest(0, 30 - (price - 950) / 50) end
        + coalesce(score / 10, 0), 9) desc, score desc nulls last, product_id limit 200""")
def _(v):
    products = catalog(v)
    return rounded(sc.smart_search(products, stored_index(v), 3, None, 920.0, 950.0, soft_price=True))


@REGISTRY.add("K03_query_forms", f"""
with {SQL_TEXT},
t as (select product_id, list(term) as terms from idx group by product_id)
select p.product_id from fx_product p join t on t.product_id = p.product_id join words w on w.product_id = p.product_id
where (list_contains(terms, 'widget') and list_contains(terms, 'black') and not list_contains(terms, 'red'))
   or (list_contains(terms, 'smart') and list_contains(terms, 'yes') and regexp_matches(w.text, '(?i)(^|[^a-z0-9])smart[^a-z0-9]+yes($|[^a-z0-9])')
       and list_contains(terms, 'silver'))""")
def _(v):
    products = catalog(v)
    return sc.match_text(products, stored_index(v), 'widget black -red or "smart yes" silver').select("product_id")


@REGISTRY.add("K03_exclusion_only", f"""
with {SQL_TEXT} select product_id from fx_product where product_id not in (select product_id from idx where term = 'silver')""")
def _(v):
    products = catalog(v)
    return sc.match_text(products, stored_index(v), "-silver").select("product_id")


@REGISTRY.add("K03_excluded_phrase", f"""
with {SQL_TEXT}
select w.product_id from words w join idx i on i.product_id = w.product_id and i.term = 'black'
where not regexp_matches(w.text, '(?i)(^|[^a-z0-9])smart[^a-z0-9]+yes($|[^a-z0-9])')""")
def _(v):
    return sc.match_text(catalog(v), stored_index(v), 'black -"smart yes"').select("product_id")


# Published stems of the words of the test catalog that change, and those of its words that are stop words.
STEMS = "('autodose', 'autodos'), ('capacity', 'capac'), ('energy', 'energi'), ('key', 'kei'), ('large', 'larg'), ('litres', 'litr'), ('programmes', 'programm'), ('rating', 'rate'), ('supply', 'suppli'), ('value', 'valu'), ('yes', 'ye')"
STOPS = "'a', 'no', 'to'"
# Tokens of the fields in their order, with weights, stems and places.
ENGLISH = f"""
field as (
  select product_id, category_id, 0 as f, 1.0::double as w, name as text from fx_product
  union all select product_id, category_id, 1, 0.4::double, brand from fx_product
  union all select product_id, category_id, 2, 0.4::double, 'MX' || cast(product_id as varchar) from fx_product
  union all select s.product_id, category_id, case kind when 'specs' then 3 else 4 end, case kind when 'specs' then 0.2::double else 0.1::double end,
                   string_agg(s.key || ' ' || s.value, ' ' order by ord) from fx_spec s join fx_product p on p.product_id = s.product_id group by all
),
split as (select product_id, category_id, f, w, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '') as ts from field),
token as (select product_id, category_id, f, w, unnest(ts) as word, unnest(range(len(ts))) as i from split),
placed as (select product_id, category_id, w, word, row_number() over (partition by product_id order by f, i) - 1 as position from token),
stemmed as (select product_id, category_id, w, coalesce(s.stem, word) as term, position from placed left join (values {STEMS}) s(word, stem) using (word) where word not in ({STOPS})),
post as (select category_id, product_id, term, sum(w) as weight, list(position order by position) as positions from stemmed group by all)"""


@REGISTRY.add("K01_english_index", f"""
with {ENGLISH}
select category_id, product_id, term, round(weight, 6) as weight,
       array_to_string(list_transform(range(len(positions)), lambda i: positions[i + 1] - case when i = 0 then 0 else positions[i] end), ',') as positions
from post""")
def _(v):
    index = rs.english_index(catalog(v))
    return index.withColumns({"weight": F.round("weight", 6), "positions": F.array_join(F.col("positions").cast("array<string>"), ",")})


@REGISTRY.add("K01_stems", """
select p_partkey as product_id, p.word, p.stem
from part join (values (0, 'relational', 'relat'), (1, 'hopping', 'hop'), (2, 'electriciti', 'electr'), (3, 'adjustment', 'adjust'), (4, 'ponies', 'poni'),
  (5, 'controlling', 'control'), (6, 'sky', 'sky'), (7, 'filing', 'file'), (8, 'oscillators', 'oscil'), (9, 'generalizations', 'gener'), (10, 'agreed', 'agre'),
  (11, 'caresses', 'caress'), (12, 'vietnamization', 'vietnam')) p(k, word, stem) on p.k = p_partkey % 13""")
def _(v):
    words = ["relational", "hopping", "electriciti", "adjustment", "ponies", "controlling", "sky", "filing", "oscillators", "generalizations", "agreed", "caresses", "vietnamization"]
    word = F.get(F.array(*[F.lit(w) for w in words]), (F.col("p_partkey") % 13).cast("int"))
    return v.part.select(F.col("p_partkey").alias("product_id"), word.alias("word")).withColumn("stem", rs.english.stem(F.col("word")))


_ranked: dict[tuple[str, str], str] = {}


def ranked_index(v):
    """The ranked index of this catalog, stored once a session and read from there."""
    key = (v.spark.sparkContext.applicationId, v.sf_dir)
    if key not in _ranked:
        _ranked[key] = new_shared_path(v.spark, "ranked")
        rs.write_ranked_index(catalog(v), _ranked[key], block_rows=64)
    return rs.read_ranked_index(v.spark, _ranked[key])


def _ranked_sql(accepted: str, wanted: list[str], where: str, points: str = "0") -> str:
    terms = ", ".join(f"'{t}'" for t in wanted)
    relevance = f"coalesce(ts, 0) * 40 + {points} + coalesce(score / 10, 0)"
    return f"""
with {ENGLISH},
hit as (select product_id, list(term) as terms, coalesce(sum(weight / (weight + 1)) filter (where term in ({terms})), 0) / {max(len(wanted), 1)} as ts,
               map_from_entries(list((term, positions))) as places from post group by product_id)
select p.product_id, category_id, brand, price, score, round({relevance}, 6) as relevance_score
from fx_product p join hit h on h.product_id = p.product_id where {where} and ({accepted})
order by round({relevance}, 9) desc, score desc nulls last, p.product_id limit 200"""


def ranked(df):
    return df.select("product_id", "category_id", "brand", "price", "score", F.round("relevance_score", 6).alias("relevance_score"))


@REGISTRY.add("K02_block_search", _ranked_sql(
    "list_contains(terms, 'ye') and list_contains(terms, 'capac')", ["capac", "ye"], "category_id = 2 and price between 905 and 1500", "30"))
def _(v):
    """`the`, being a stop word, asks for nothing; the other words are found by their stems."""
    return ranked(rs.ranked_search(ranked_index(v), 2, "the capacities yes", 905.0, 1500.0))


@REGISTRY.add("K02_block_soft_price", _ranked_sql(
    "list_contains(terms, 'black') or (list_contains(terms, 'autodos') and not list_contains(terms, 'silver'))", ["autodos", "black"],
    "category_id = 3 and brand in ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#12', 'Brand#20')",
    "20 + case when price between 920 and 950 then 30 when price < 920 then greatest(0, 30 - (920 - price) / 50) else greatest(0, 30 - (price - 950) / 50) end"))
def _(v):
    brands = ["Brand#1", "Brand#2", "Brand#3", "Brand#12", "Brand#20"]
    return ranked(rs.ranked_search(ranked_index(v), 3, "black or autodosing -silver", 920.0, 950.0, brands, soft_price=True))


@REGISTRY.add("K03_english_phrase", _ranked_sql(
    "list_contains(terms, 'rate') and list_contains(terms, 'energi') and list_contains(terms, 'g') and "
    "len(list_filter(places['energi'], lambda p: list_contains(places['rate'], p + 1) and list_contains(places['g'], p + 4))) > 0",
    ["energi", "g", "rate"], "category_id = 4"))
def _(v):
    """Words of a phrase stand at their distance; the stop words between them may be any."""
    return ranked(rs.ranked_search(ranked_index(v), 4, '"energy ratings a to g"'))


@REGISTRY.add("K03_english_exclusion", _ranked_sql("not list_contains(terms, 'silver')", [], "category_id = 1"))
def _(v):
    return ranked(rs.ranked_search(ranked_index(v), 1, "-silver"))


# Every 29th product has no price, and category 5 no brand.
SOME_MISSING = "case when product_id % 29 = 0 then null else price end as price, case when category_id = 5 then null else brand end as brand"


def some_missing(products):
    price, brand = SOME_MISSING.split(", ")
    return products.withColumns({"price": F.expr(price.removesuffix(" as price")), "brand": F.expr(brand.removesuffix(" as brand"))})


_TIERS = {1: ("capacity_value", 7, 25), 4: ("depth_cm", 20, 40)}


@REGISTRY.add("K04_product_rankings", """
select product_id, category_id, price, percent_rank() over (partition by category_id order by price nulls last) as price_percentile,
  case when percent_rank() over (partition by category_id order by price nulls last) < 0.33 then 'budget'
       when percent_rank() over (partition by category_id order by price nulls last) < 0.66 then 'mid-range' else 'premium' end as price_tier,
  cast((select count(*) from fx_spec s where s.product_id = p.product_id and kind = 'features' and value = 'Yes') as int) as feature_count,
  case category_id when 1 then (case when cap < 7 then 'small' when cap < 25 then 'medium' else 'large' end)
                   when 4 then (case when dep < 20 then 'small' when dep < 40 then 'medium' else 'large' end) end as capacity_tier
from (select f.* replace (case when product_id % 29 = 0 then null else price end as price), (select try_cast(max(value) as double) from fx_spec s where s.product_id = f.product_id and key = 'capacity_value') as cap,
        (select try_cast(max(value) as double) from fx_spec s where s.product_id = f.product_id and key = 'depth_cm') as dep from fx_product f) p""")
def _(v):
    ranked = sc.product_rankings(some_missing(catalog(v)), _TIERS)
    return ranked.select("product_id", "category_id", "price", "price_percentile", "price_tier", "feature_count", "capacity_tier")


@REGISTRY.add("K05_category_stats", """
select category_id, count(*) as product_count, round(avg(price), 2) as avg_price, quantile_cont(price, 0.25) as price_q1, quantile_cont(price, 0.5) as price_median,
  quantile_cont(price, 0.75) as price_q3, avg(score) as avg_score, count(distinct brand) as n_brands
from (select * replace (""" + SOME_MISSING + """) from fx_product) p group by category_id""")
def _(v):
    return sc.category_stats(some_missing(v.fx_product))


@REGISTRY.add("K05_category_brands", "select distinct category_id, brand from fx_product")
def _(v):
    return sc.category_brands(v.fx_product)


@REGISTRY.add("K05_common_features", """
select category_id, key, count(*) as products, cast(row_number() over (partition by category_id order by count(*) desc, key) as int) as rank
from fx_spec s join fx_product p on p.product_id = s.product_id where kind = 'features' and value = 'Yes' group by category_id, key qualify rank <= 20""")
def _(v):
    rows = v.fx_spec.where("kind = 'features'").join(v.fx_product.select("product_id", "category_id"), "product_id")
    return sc.common_features(rows)


FILTER = sc.FilterSpec(
    specs={"capacity_value": {"min": 6, "max": 45}, "colour": {"in": ["Black", "Silver"]}, "supply": {"exact": "220-240V"}},
    required=["timer"], preferred=["smart", "timer_function"], excluded=["smart"], price_min=901.0, price_max=1900.0, score_min=5.0,
    sort_priority=("price",),
)
_PIVOT = """
piv as (select product_id, max(value) filter (where key = 'capacity_value') as cap, max(value) filter (where key = 'colour') as colour,
          max(value) filter (where key = 'supply') as supply, coalesce(max(value) filter (where key = 'timer'), '') as timer,
          coalesce(max(value) filter (where key = 'smart'), '') as smart, coalesce(max(value) filter (where key = 'timer_function'), '') as tf,
          coalesce(max(value) filter (where key = 'autodose'), '') as autodose
        from fx_spec group by product_id),
filtered as (select p.*, piv.* exclude (product_id) from fx_product p join piv on piv.product_id = p.product_id
   where try_cast(cap as double) between 6 and 45 and colour in ('Black', 'Silver') and supply = '220-240V' and timer = 'Yes' and smart <> 'Yes'
     and price between 901 and 1900 and score >= 5)"""


@REGISTRY.add("K06_filter_catalog", f"with {_PIVOT} select product_id, price, score from filtered")
def _(v):
    return sc.filter_catalog(catalog(v), FILTER).select("product_id", "price", "score")


@REGISTRY.add("K07_rank_matches", f"""
with {_PIVOT}
select product_id, round(40 + (cast(smart = 'Yes' as int) + cast(tf = 'Yes' as int)) * 10 + score / 100 * 20 + 20, 6) as relevance_score,
       true as required_met, cast(smart = 'Yes' as int) + cast(tf = 'Yes' as int) as preferred_matched from filtered""")
def _(v):
    ranked = sc.rank_matches(sc.filter_catalog(catalog(v), FILTER), FILTER)
    return ranked.select("product_id", F.round("relevance_score", 6).alias("relevance_score"), "required_met", "preferred_matched")


@REGISTRY.add("K08_score_products", f"""
with {_PIVOT},
s as (select p.product_id, case when price between 910 and 1000 then 30 when price < 910 then greatest(0, 30 - (910 - price) / 50) else greatest(0, 30 - (price - 1000) / 50) end * 40 / 30
   + case when autodose = 'Yes' then 10.0::double else 8 end
   + case when lower(colour) = 'silver' then 8.0::double else 0 end
   + case when timer = 'Yes' then 10.0::double else 0 end
   + case when brand in ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4') then 15 else 0 end + coalesce(score, 0) / 100 * 10 as m
  from fx_product p join piv on piv.product_id = p.product_id)
select product_id, round(m, 6) as match_score, case when round(m, 9) >= 85 then 'perfect' when round(m, 9) >= 70 then 'excellent' when round(m, 9) >= 50 then 'good' when round(m, 9) >= 30 then 'acceptable' else 'alternative' end as tier
from s""")
def _(v):
    products = catalog(v).withColumn("specs", F.map_concat("specs", F.create_map(F.lit("note"), F.lit("with AutoDose"))))
    scored = sc.score_products(products, ["autodose", "Silver", "timer"], 910.0, 1000.0, ["Brand#1", "Brand#2", "Brand#3", "Brand#4"])
    return scored.select("product_id", F.round("match_score", 6).alias("match_score"), "tier")


_QUERY = """text || case conv_id % 5 when 0 then ' cheap small Brand#12' when 1 then ' PREMIUM family washer' when 2 then ' mid-range standard' when 3 then ' luxury big Brand#1' else ' etc' end"""


def _intent_sql(intents) -> str:
    return "case " + " ".join(f"when regexp_matches(lower(q), '{p}') then '{n}'" for n, p in intents) + " end"


@REGISTRY.add("K09_parse_queries", f"""
select conv_id, turn, {_intent_sql(PRICE_INTENTS)} as price_intent, {_intent_sql(SIZE_INTENTS)} as size_intent,
  array_to_string(list_filter(['Brand#1', 'Brand#12', 'Brand#3'], lambda b: contains(lower(q), lower(b))), ',') as brands,
  array_to_string(list_filter(string_split_regex(regexp_replace(lower(q), '{INTENT_WORDS}', '', 'g'), '\\s+'), lambda t: length(t) > 2), ' ') as search_terms
from (select conv_id, turn, {_QUERY} as q from conversations) c""")
def _(v):
    queries = v.conversations.select("conv_id", "turn", F.expr(_QUERY).alias("query_text"))
    parsed = sc.parse_queries(queries, ["Brand#1", "Brand#12", "Brand#3"])
    return parsed.withColumns({"brands": F.array_join("brands", ","), "search_terms": F.array_join("search_terms", " ")}).drop("query_text")


@REGISTRY.add("K10_facets", """
with f as (select * from fx_product where category_id = 2)
select 'brand' as facet, brand as label, count(*) as products from f group by brand
union all select 'price', cast(cast(floor(price / 100) * 100 as bigint) as varchar) || '-' || cast(cast(floor(price / 100) * 100 + 100 as bigint) as varchar), count(*) from f group by all
union all select 'feature', key, count(*) from fx_spec s join f on f.product_id = s.product_id where kind = 'features' and value = 'Yes' group by key""")
def _(v):
    return sc.facets(catalog(v).where("category_id = 2"))


_facets: dict[tuple[str, str], str] = {}


def facet_index(v):
    """The facet index of this catalog, stored once a session and read from there."""
    key = (v.spark.sparkContext.applicationId, v.sf_dir)
    if key not in _facets:
        _facets[key] = new_shared_path(v.spark, "facets")
        fi.write_facet_index(catalog(v), _facets[key])
    return fi.read_facet_index(v.spark, _facets[key])


@REGISTRY.add("K10_filtered_facets", f"""
with {_PIVOT},
f as (select * from filtered where category_id = 2)
select 'brand' as facet, brand as label, count(*) as products from f group by brand
union all select 'price', cast(cast(floor(price / 100) * 100 as bigint) as varchar) || '-' || cast(cast(floor(price / 100) * 100 + 100 as bigint) as varchar), count(*) from f group by all
union all select 'feature', key, count(*) from fx_spec s join f on f.product_id = s.product_id where kind = 'features' and value = 'Yes' group by key""")
def _(v):
    """The facets of what a structured filter leaves, from bitmaps."""
    return facet_index(v).facets(2, FILTER)


@REGISTRY.add("K10_filtered_count", f"with {_PIVOT} select count(*) as products from filtered where category_id = 3")
def _(v):
    return facet_index(v).count(3, FILTER)


@REGISTRY.add("K11_complete", "select distinct name from fx_product where starts_with(lower(name), 'brand#1') order by name limit 10")
def _(v):
    return sc.complete(v.fx_product, "BRAND#1")


@REGISTRY.add("K11_page", "select product_id, price from fx_product order by price desc, product_id limit 50 offset 100")
def _(v):
    return sc.page(v.fx_product.select("product_id", "price"), [F.desc("price"), F.col("product_id")], 50, 100)


_names: dict[tuple[str, str], str] = {}


@REGISTRY.add("K11_complete_stored", "select distinct name from fx_product where starts_with(lower(name), 'brand#1') order by name limit 10")
def _(v):
    key = (v.spark.sparkContext.applicationId, v.sf_dir)
    if key not in _names:
        _names[key] = new_shared_path(v.spark, "names")
        br.write_names(v.fx_product, _names[key])
    return br.complete_stored(br.read_names(v.spark, _names[key]), "BRAND#1")


@REGISTRY.add("K11_page_after", """
select product_id, price from (select product_id, case when product_id % 29 = 0 then null else price end as price from fx_product) p
order by price desc nulls last, product_id limit 50 offset 100""")
def _(v):
    """The third page, found from the last row of the second."""
    rows, order = some_missing(v.fx_product).select("product_id", "price"), [("price", True), ("product_id", False)]
    last = None
    for _ in range(2):
        seen = br.page_after(rows, order, 50, last).collect()
        last = (seen[-1]["price"], seen[-1]["product_id"])
    return br.page_after(rows, order, 50, last)


@REGISTRY.add("K11_lookup", """
select product_id, name from fx_product where product_id in (select l_partkey from lineitem where l_quantity > 49)""")
def _(v):
    ids = v.lineitem.where("l_quantity > 49").select(F.col("l_partkey").alias("product_id"))
    return sc.lookup(v.fx_product, ids).select("product_id", "name")


@REGISTRY.add("K12_coverage", """
select category_id, count(*) filter (where price > 1000) as matched, count(*) as total,
       round(cast(count(*) filter (where price > 1000) as double) / count(*) * 100, 1) as percent from fx_product group by category_id""")
def _(v):
    return sc.coverage(v.fx_product.where("price > 1000"), v.fx_product)


@REGISTRY.add("K13_metrics_rollup", """
with now as (select max(created_at) as now from fx_metrics)
select date_trunc('hour', created_at) as hour, category_id, count(*) as search_count, round(avg(execution_time_ms), 6) as avg_latency,
  quantile_cont(execution_time_ms, 0.5) as p50_latency, quantile_cont(execution_time_ms, 0.95) as p95_latency,
  cast(count(*) filter (where cache_hit) as double) / count(*) as cache_hit_rate
from fx_metrics, now where created_at > now - interval 24 hours group by hour, category_id""")
def _(v):
    now = v.fx_metrics.agg(F.max("created_at")).scalar()
    return sc.metrics_rollup(v.fx_metrics, now)


@REGISTRY.add("K14_popular_searches", """
select category_id, query_text, count(*) as hits from fx_metrics group by category_id, query_text order by hits desc, category_id, query_text limit 21""")
def _(v):
    return sc.popular_searches(v.fx_metrics)
