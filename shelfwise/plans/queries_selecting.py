"""Source selection, prices, ratings and reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import prices as pr
from shelfwise.operators import reviews as rv
from shelfwise.operators import selecting as se
from shelfwise.plans.queries_attributes import quoted
from shelfwise.plans.registry import REGISTRY
from shelfwise.rules import (
    AD_WORDS, BAD_DOCUMENT_WORDS, EMPTY_REVIEW, MANUAL_WORDS, PRICE_FORMS, PRICE_NUMBER_LITERAL, PRICE_NUMBER_STRICT,
    RELATIVE_DATE, TRUSTED_DOCUMENT_HOSTS,
)


@REGISTRY.add("H01_dedupe_first", """
select category_id, name, min(product_id) as product_id, arg_min(price, product_id) as price
from (select product_id, cast(category_id as bigint) as category_id, split_part(name, ' MX', 1) as name, price from fx_product) p
group by category_id, name
qualify row_number() over (partition by name order by min(product_id)) = 1""")
def _(v):
    named = v.fx_product.select("product_id", "category_id", F.split("name", " MX")[0].alias("name"), "price")
    return se.dedupe_first(named, "name", "product_id")


PRIORITY = ["S3", "S1"]


def _select_sql(stop: bool, fallback: bool) -> str:
    limit = 3 if fallback else 1
    rank = "n" if stop else "-q * 1000 + n"
    done = f"coalesce(min(n) filter (where ok), max(n))" if stop else "max(n)"
    return f"""
with a as (select *, case source_name when 'S3' then 0 when 'S1' then 1 else 2 end as p from fx_attempt),
t as (select *, row_number() over (partition by product_id order by p, ord) as n, spec_count >= 20 as ok,
        least(cast(spec_count as double) / 50, 1.0::double) as q from a qualify n <= {limit})
select product_id, bool_or(ok) as success, cast({done} as int) as attempts,
       arg_min(source_name, {rank}) filter (where ok) as source_name, arg_min(ord, {rank}) filter (where ok) as ord,
       arg_min(spec_count, {rank}) filter (where ok) as spec_count, arg_min(q, {rank}) filter (where ok) as quality_score
from t group by product_id"""


@REGISTRY.add("H02_select_source", _select_sql(True, True))
def _(v):
    return se.select_source(v.fx_attempt.withColumn("ord", F.col("ord")), PRIORITY)


@REGISTRY.add("H02_select_best_quality", _select_sql(False, True))
def _(v):
    return se.select_source(v.fx_attempt, PRIORITY, stop_at_first=False)


@REGISTRY.add("H02_select_no_fallback", _select_sql(True, False))
def _(v):
    return se.select_source(v.fx_attempt, PRIORITY, fallback=False)


@REGISTRY.add("H03_quality_score", """
select product_id, source_id, least(cast(spec_count as double) / 50, 1.0::double) as quality_score from fx_attempt""")
def _(v):
    return v.fx_attempt.select("product_id", "source_id", se.quality_score(F.col("spec_count")).alias("quality_score"))


# Keys brought by each source of a product: the offer's source reports a few overlapping keys.
_SOURCE_KEYS = """(select product_id, cast(rnk as bigint) as rank, 'k' || cast((source_id * 7 + i * 3) % 23 as string) as key,
  cast(source_id as string) || '/' || cast(i as string) as value, row_number() over (partition by product_id, rnk, (source_id * 7 + i * 3) % 23 order by i) as rn
  from fx_offer, (values (1), (2), (3), (4)) t(i) where i <= source_id % 4 + 1)"""
_TARGETS = "(select product_id, greatest(5, product_id % 17) as target from fx_product)"


def source_keys(v):
    rows = v.fx_offer.withColumn("i", F.explode(F.sequence(F.lit(1), (F.col("source_id") % 4 + 1).cast("int"))))
    return rows.select(
        "product_id", F.col("rnk").cast("bigint").alias("rank"),
        F.expr("'k' || cast((source_id * 7 + i * 3) % 23 as string)").alias("key"),
        F.expr("cast(source_id as string) || '/' || cast(i as string)").alias("value"),
    )


def accumulated(v):
    targets = v.fx_product.select("product_id", F.greatest(F.lit(5), F.col("product_id") % 17).alias("target"))
    return se.accumulate_until(source_keys(v), targets)


_ACCUMULATE = f"""
with recursive src as (select * from {_SOURCE_KEYS} k),
step as (
  select product_id, 0 as rank, cast([] as varchar[]) as seen, 0 as added, target from {_TARGETS} t
  union all
  select s.product_id, s.rank + 1, list_distinct(list_concat(s.seen, n.keys)),
         len(list_distinct(list_concat(s.seen, n.keys))) - len(s.seen), s.target
  from step s join (select product_id, rank, list(key) as keys from src group by product_id, rank) n
    on n.product_id = s.product_id and n.rank = s.rank + 1
  where len(s.seen) < s.target)"""


@REGISTRY.add("H07_accumulate_sources", _ACCUMULATE + """
select product_id, cast(rank as bigint) as rank, cast(added as bigint) as new_keys, cast(len(seen) as bigint) as total_keys
from step where rank > 0""")
def _(v):
    return accumulated(v)[1]


@REGISTRY.add("H07_accumulate_keys", _ACCUMULATE + """
select s.product_id, s.key, arg_max(s.value, s.rank) as value, cast(min(s.rank) as bigint) as first_rank
from src s join step t on t.product_id = s.product_id and t.rank = s.rank where t.rank > 0 group by s.product_id, s.key""")
def _(v):
    return accumulated(v)[0]


@REGISTRY.add("F02_match_candidates", """
with c as (select product_id, rnk as rank, case when (product_id + source_id) % 4 = 0 then 'Thing mx-' || cast(product_id as varchar) || ' white'
                 else 'Other ' || cast(source_id as varchar) end as name,
             case when source_id % 9 = 0 then null else 'https://s/' || cast(source_id as varchar) end as href from fx_offer where rnk <= 10),
j as (select c.*, contains(replace(replace(upper(name), ' ', ''), '-', ''), 'MX' || cast(product_id as varchar)) as matched from c)
select product_id, name, href, rank, matched from j
qualify row_number() over (partition by product_id order by matched desc, rank) = 1 and href is not null""")
def _(v):
    candidates = v.fx_offer.selectExpr(
        "product_id", "rnk as rank",
        "case when (product_id + source_id) % 4 = 0 then 'Thing mx-' || cast(product_id as string) || ' white' else 'Other ' || cast(source_id as string) end as name",
        "case when source_id % 9 = 0 then null else 'https://s/' || cast(source_id as string) end as href",
    ).withColumn("rank", F.col("rank").cast("bigint"))
    targets = v.fx_product.selectExpr("product_id", "'MX' || cast(product_id as string) as model")
    return se.match_candidates(targets, candidates)


_DOC_URL = """case source_id % 8 when 0 then 'https://www.' || lower(replace(brand, '#', '')) || '.com/manuals/' || cast(source_id as string) || '.pdf'
  when 1 then 'https://docs.example.com/' || lower(replace(brand, '#', '')) || '/MX' || cast(product_id as string) || '-im.pdf'
  when 2 then 'https://m.media-amazon.com/images/I/' || cast(source_id as string) || '.pdf'
  when 3 then 'https://ads.doubleclick.net/x.pdf' when 4 then 'https://www.howdens.com/mx' || cast(product_id as string) || '.pdf'
  when 5 then 'https://a.example.com/dp/spec.pdf' else 'https://other.example.com/' || cast(source_id % 3 as string) || '.pdf' end"""


def _alt(words):
    return "|".join(w.replace(".", r"\.").replace("?", r"\?") for w in words)


@REGISTRY.add("H06_score_documents", f"""
with u as (select o.product_id, min(rnk) as ord, {_DOC_URL.replace('product_id', 'o.product_id')} as url, lower(replace(brand, '#', '')) as brand, 'MX' || cast(o.product_id as varchar) as model
           from fx_offer o join fx_product p on p.product_id = o.product_id group by all),
s as (select *, case when contains(split_part(lower(url), '/', 3), brand) then 50 when contains(lower(url), brand) then 20 else 0 end
   + case when contains(lower(url), lower(model)) then 30 else 0 end
   + case when regexp_matches(lower(url), '{_alt(MANUAL_WORDS)}') then 10 else 0 end
   + case when regexp_matches(lower(url), '{_alt(TRUSTED_DOCUMENT_HOSTS)}') then 15 else 0 end
   + case when regexp_matches(lower(url), '{_alt(BAD_DOCUMENT_WORDS)}') then -50 else 0 end
   + case when regexp_matches(lower(url), '{_alt(AD_WORDS)}') then -100 else 0 end as score from u)
select product_id, cast(row_number() over (partition by product_id order by score desc, ord) as int) as rank, url, score from s
where score >= 0 qualify rank <= 5""")
def _(v):
    urls = v.fx_offer.drop("price").join(v.fx_product, "product_id").selectExpr(
        "product_id", "rnk as ord", f"{_DOC_URL} as url", "lower(replace(brand, '#', '')) as brand", "'MX' || cast(product_id as string) as model"
    )
    return se.score_documents(urls)


@REGISTRY.add("H09_pick_views", """
with ok as (select *, case when contains(url, 'front') then 0 when contains(url, 'side') then 1 when contains(url, 'rear') then 2 else 3 end * 100 + ord as o
            from fx_image where contains(url, 'dam.example.com') and contains(url, '.webp') and contains(url, '800x600'))
select product_id, arg_min(url, o) filter (where contains(url, 'front')) as front, arg_min(url, o) filter (where contains(url, 'side')) as side,
       arg_min(url, o) filter (where contains(url, 'rear')) as rear from ok group by product_id""")
def _(v):
    return se.pick_views(v.fx_image, "dam.example.com")


_SUMMARY = f"case when spec_count % 5 = 0 then '{EMPTY_REVIEW}' when spec_count % 7 = 0 then null else 'Summary ' || cast(spec_count as string) end"


@REGISTRY.add("H10_pick_review_source", f"""
with u as (select product_id, source_name as source, {_SUMMARY} as summary, ord from fx_attempt where source_name in ('S2', 'S0', 'S4')),
r as (select *, row_number() over (partition by product_id order by case source when 'S2' then 0 when 'S0' then 1 else 2 end, ord) as n
      from u where summary is not null and summary <> '{EMPTY_REVIEW}')
select product_id, max(source) filter (where n = 1) as source, max(summary) filter (where n = 1) as summary,
       max(source) filter (where n = 2) as alternative_source, max(summary) filter (where n = 2) as alternative_summary
from r where n <= 2 group by product_id""")
def _(v):
    reviews = v.fx_attempt.selectExpr("product_id", "source_name as source", f"{_SUMMARY} as summary", "ord")
    return se.pick_review_source(reviews, ["S2", "S0", "S4"])


@REGISTRY.add("H10_scored_reviews", f"""
with u as (select product_id, source_name as source, {_SUMMARY} as summary, ord from fx_attempt where source_name in ('S2', 'S0', 'S4')),
r as (select * from u where summary is not null and summary <> '{EMPTY_REVIEW}'
      qualify row_number() over (partition by product_id order by case source when 'S2' then 0 when 'S0' then 1 else 2 end, ord) = 1),
s as (select product_id, source_name as source, floor(avg(spec_count) / 1.2::double) / 10 as rating, count(*) * 20 as count
      from fx_attempt where spec_count % 4 > 0 group by product_id, source_name)
select r.product_id, r.source, rating, count, case when rating <> 0 then round((count / (cast(count as double) + 30) * rating + 30 / (cast(count as double) + 30) * 4.0::double) / 5 * 100, 1) end as rating_score
from r left join s on s.product_id = r.product_id and s.source = r.source""")
def _(v):
    reviews = v.fx_attempt.selectExpr("product_id", "source_name as source", f"{_SUMMARY} as summary", "ord")
    picked = se.pick_review_source(reviews, ["S2", "S0", "S4"]).select("product_id", "source")
    snapshots = v.fx_attempt.where("spec_count % 4 > 0").groupBy("product_id", F.col("source_name").alias("source")).agg(
        (F.floor(F.avg("spec_count") / 1.2) / 10).alias("rating"), (F.count("*") * 20).alias("count")
    )
    return rv.attach_scores(picked, snapshots)


@REGISTRY.add("H11_fan_out_pages", r"""
select product_id, ord, cast(page as int) as page,
  replace(regexp_replace(regexp_extract(url, '^[^?#]*', 0), '\.aspx.*$', ''), '/product/', '/p/reviews/') || '?order=HelpfulnessDescending&page=' || cast(page as varchar) as page_url
from fx_retailer_link, (select unnest(generate_series(1, 4)) as page) p where starts_with(url, 'https://ao.com')""")
def _(v):
    urls = v.fx_retailer_link.where("url like 'https://ao.com%'").select("product_id", "ord", "url")
    return se.fan_out_pages(urls, 4).drop("url")


@REGISTRY.add("H11_first_products", "select product_id, name, price from fx_product order by price desc, product_id limit 25")
def _(v):
    products = v.fx_product.select("product_id", "name", "price").withColumn("_o", -F.col("price"))
    return se.first_n(products, ["_o", "product_id"], 25).drop("_o")


@REGISTRY.add("S03_new_source_keys", f"""
with src as (select product_id, rank, key from {_SOURCE_KEYS} k)
select product_id, key from src where rank = 2 except select product_id, key from src where rank = 1""")
def _(v):
    keys = source_keys(v).select("product_id", "rank", "key")
    return keys.where("rank = 2").drop("rank").distinct().join(keys.where("rank = 1").drop("rank"), ["product_id", "key"], "left_anti")


# --- prices -------------------------------------------------------------------------------------


def _mention_sql(number: str) -> str:
    parts = " union all ".join(
        f"select doc_id, {i} as form, unnest(range(len(m))) as position, unnest(m) as price_text from (select doc_id, regexp_extract_all(text, '{form.replace('{n}', number)}', 1) as m from fx_doc) q{i}"
        for i, form in enumerate(PRICE_FORMS)
    )
    return f"""
select doc_id, form, cast(position as int) as position, cast(replace(price_text, ',', '') as double) as price from ({parts}) p
where cast(replace(price_text, ',', '') as double) between 1 and 10000"""


@REGISTRY.add("P01_extract_prices", _mention_sql(PRICE_NUMBER_STRICT))
def _(v):
    return pr.extract_prices(v.fx_doc)


@REGISTRY.add("P01_extract_prices_literal", _mention_sql(PRICE_NUMBER_LITERAL))
def _(v):
    return pr.extract_prices(v.fx_doc, strict=False)


CONSENSUS_SQL = """
m0 as (select product_id, count(*) as n_offers, median(price) as med from fx_offer group by product_id),
cleaned as (select o.product_id, o.price, m0.n_offers from fx_offer o join m0 on m0.product_id = o.product_id
            where o.price between m0.med * 0.5::double and m0.med * 2.0::double),
jumps as (select *, case when price - lag(price) over (partition by product_id order by price) > 5.0::double then 1 else 0 end as j,
            row_number() over (partition by product_id order by price) as rn from cleaned),
islands as (select *, sum(j) over (partition by product_id order by price, rn) as c from jumps),
sized as (select product_id, c, count(*) as size, median(price) as mode from islands group by product_id, c),
best as (select product_id, arg_max(mode, size * 1000000 - c) as mode, max(size) as size from sized group by product_id),
consensus as (
  select i.product_id, any_value(n_offers) as n_offers, count(*) as n_kept,
         case when any_value(n_offers) >= 2 then case when count(*) >= 3 and any_value(b.size) >= 2 then any_value(b.mode) else median(price) end end as target_price
  from islands i join best b on b.product_id = i.product_id group by i.product_id)"""


@REGISTRY.add("P02_consensus_price", f"with {CONSENSUS_SQL} select * from consensus")
def _(v):
    return pr.consensus_price(v.fx_offer)


_MENTIONS = """(select product_id, source_id, i as ord, price * case when (source_id + i) % 3 = 0 then 3 when (source_id + i) % 7 = 1 then 0.1 else 1 end as price
  from fx_offer, (values (0), (1), (2)) t(i))"""


def price_mentions(v):
    rows = v.fx_offer.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(2))))
    return rows.selectExpr(
        "product_id", "source_id", "i as ord",
        "price * case when (source_id + i) % 3 = 0 then 3D when (source_id + i) % 7 = 1 then 0.1D else 1D end as price",
    )


def repaired(v):
    return pr.repair_prices(price_mentions(v), pr.consensus_price(v.fx_offer))


_REPAIR = f"""
with {CONSENSUS_SQL},
mentions as (select product_id, source_id, ord, cast(price as double) as price from {_MENTIONS.replace('then 0.1 else 1', 'then 0.1::double else 1')} m),
j as (select m.*, c.target_price, m.price between c.target_price * (1 - 20.0::double / 100) and c.target_price * (1 + 20.0::double / 100) as ok
      from mentions m left join consensus c on c.product_id = m.product_id),
f as (select product_id, source_id, arg_min(price, ord) as first_price, arg_min(price, ord) filter (where ok) as within, any_value(target_price) as target_price,
        arg_min(ok, ord) as first_ok from j group by product_id, source_id),
r as (select product_id, source_id, first_price, target_price, case when target_price is null or first_ok then first_price else within end as price from f),
repaired as (select *, price <> first_price as repaired from r where price is not null)"""


@REGISTRY.add("P03_repair_prices", f"{_REPAIR} select * from repaired")
def _(v):
    return repaired(v)


@REGISTRY.add("P04_price_summary", f"""{_REPAIR}
select (select count(*) from fx_product) as products, count(distinct product_id) as successful, count(*) as prices from repaired""")
def _(v):
    return pr.price_summary(repaired(v), v.fx_product)


# --- ratings and reviews ------------------------------------------------------------------------

_SCORE = "round((c / (c + 30) * r + 30 / (c + 30) * {g}) / 5 * 100, 1)"


@REGISTRY.add("G04_rating_score", f"""
select product_id, r as rating, cast(c as bigint) as count, {_SCORE.format(g='4.0::double')} as rating_score
from (select product_id, avg(stars) as r, cast(count(*) as double) as c from fx_review group by product_id) q""")
def _(v):
    return rv.rating_score(v.fx_review)


_SNAPSHOT = "product_id, case when product_id % 10 = 0 then '0' else cast(cast(product_id % 41 as double) / 10 + 1 as string) || '/5' end as rating_text, product_id % 300 as count"


@REGISTRY.add("G04_snapshot_score", f"""
select *, case when rating <> 0 and count <> 0 then {_SCORE.format(g='4.0::double').replace('c /', 'cast(count as double) /').replace('(c +', '(count +').replace('* r', '* rating')} end as rating_score
from (select *, cast(split_part(rating_text, '/', 1) as double) as rating from (select {_SNAPSHOT} from fx_product) p) q""")
def _(v):
    return rv.snapshot_score(v.fx_product.selectExpr(
        "product_id",
        "case when product_id % 10 = 0 then '0' else cast(cast(product_id % 41 as double) / 10 + 1 as string) || '/5' end as rating_text",
        "product_id % 300 as count",
    ))


@REGISTRY.add("G05_global_rating", """
select round(sum(r * c) / sum(c), 2) as global_rating, cast(sum(c) as bigint) as total_reviews
from (select product_id, round(avg(stars), 1) as r, count(*) as c from fx_review group by product_id) q""")
def _(v):
    snapshots = v.fx_review.groupBy("product_id").agg(F.round(F.avg("stars"), 1).alias("rating"), F.count("*").alias("count"))
    return rv.global_rating(snapshots)


@REGISTRY.add("G05_score_with_global_prior", f"""
with s as (select product_id, avg(stars) as r, cast(count(*) as double) as c from fx_review group by product_id),
g as (select round(sum(r * c) / sum(c), 2) as g from s)
select product_id, r as rating, cast(c as bigint) as count, {_SCORE.format(g='g')} as rating_score from s, g""")
def _(v):
    snapshots = v.fx_review.groupBy("product_id").agg(F.avg("stars").alias("rating"), F.count("*").alias("count"))
    prior = rv.global_rating(snapshots).select("global_rating").scalar()
    return rv.rating_score(v.fx_review, prior_mean=prior)


@REGISTRY.add("G06_review_summary", """
select count(*) as processed, count(*) filter (where c >= 4) as successful, count(*) filter (where c < 4) as failed,
       count(*) filter (where c >= 4 and r >= 3) as texts_extracted,
       cast(round(cast(count(*) filter (where c >= 4) as double) / count(*) * 100, 1) as varchar) || '%' as success_rate
from (select product_id, count(*) as c, avg(stars) as r from fx_review group by product_id) q""")
def _(v):
    per_product = v.fx_review.groupBy("product_id").agg(F.count("*").alias("c"), F.avg("stars").alias("r"))
    return rv.review_summary(per_product.select((F.col("c") >= 4).alias("success"), (F.col("r") >= 3).alias("has_text")))


@REGISTRY.add("G07_review_corpus", """
with r as (select *, row_number() over (partition by product_id order by review_id) as n from fx_review)
select product_id, string_agg('Review ' || cast(n as varchar) || ' (' || cast(stars as varchar) || '/5 stars): ' || body, chr(10) order by n) filter (where n <= 50) as corpus,
       count(*) filter (where n <= 50) as reviews_analyzed, avg(stars) as average_rating, count(*) as reviews_total from r group by product_id""")
def _(v):
    return rv.review_corpus(v.fx_review)


_T7 = rf"""
with p as (select doc_id, string_split_regex(text, '\d+\s+out of 5 stars\.')[2:] as parts, regexp_extract_all(text, '(\d+)\s+out of 5 stars\.', 1) as stars from fx_blob),
u as (select doc_id, unnest(range(len(parts))) as ord, unnest(parts) as part, unnest(stars) as stars from p),
d as (select *, regexp_extract(part, '{RELATIVE_DATE}', 1) as date from u),
a as (select doc_id, ord, stars, trim(part[strpos(part, date) + length(date):], ' ' || chr(9) || chr(10) || chr(13)) as after from d where date <> ''),
t as (select *, case when regexp_matches(after, '(Yes|No), I would') then regexp_extract(after, '(?s)^(.*?)(Yes|No), I would', 1)
                     when contains(after, 'Originally posted') then after[:strpos(after, 'Originally posted') - 1] else after[:200] end as cut from a)
select doc_id, cast(ord as bigint) as ord, cast(stars as int) as stars, trim(trim(cut, ' ' || chr(9) || chr(10) || chr(13)), '.,; ') as text from t
where length(trim(trim(cut, ' ' || chr(9) || chr(10) || chr(13)), '.,; ')) > 10"""


@REGISTRY.add("T07_split_reviews", _T7)
def _(v):
    return rv.split_reviews(v.fx_blob)


@REGISTRY.add("T08_review_rows", f"""
with texts as ({_T7})
select d.doc_id as product_id, coalesce(t.ord, 0) as ord, coalesce(t.text, '{EMPTY_REVIEW}') as text, '' as title, 0 as rating, 0 as helpful,
       '' as date, '' as reviewer, false as verified, t.doc_id is null as is_empty
from documents d left join (select * from texts where stars > 3) t on t.doc_id = d.doc_id""")
def _(v):
    texts = rv.split_reviews(v.fx_blob).where("stars > 3").withColumnRenamed("doc_id", "product_id")
    return rv.to_review_rows(texts, v.documents.select(F.col("doc_id").alias("product_id")))
