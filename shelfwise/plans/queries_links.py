"""Link and harvest queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.operators import links as lk
from shelfwise.plans.queries_attributes import quoted
from shelfwise.plans.registry import REGISTRY
from shelfwise.rules import (
    EXCLUDED_DOMAINS, HOME_PAGES, MANUFACTURER_DOMAINS, PARAMETER_RULES, REDIRECT_HOSTS, REVIEW_DOMAINS, SOURCES, TRACKER_HOSTS_KEPT,
)
from shelfwise.sources import harvest as hv
from shelfwise.sources import responses as rp

# Retailer links of all products together with all page addresses.
ALL_LINKS = """(select product_id, ord, name, url from fx_retailer_link
  union all select page_id as product_id, cast(0 as bigint) as ord, 'Page' as name, url from fx_link)"""


def all_links(v):
    pages = v.fx_link.select(F.col("page_id").alias("product_id"), F.lit(0).cast("bigint").alias("ord"), F.lit("Page").alias("name"), "url")
    return v.fx_retailer_link.select("product_id", "ord", "name", "url").unionByName(pages)


def dots(words) -> str:
    return "|".join(w.replace(".", r"\.") for w in words)


HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
BARE = "regexp_extract(url, '^[^?#;]*', 0)"
CANONICAL = (
    f"case when contains({HOST}, 'amazon.co.uk') and regexp_matches({BARE}, '/(?:dp|gp/product)/[A-Z0-9]{{10}}') "
    f"then 'https://www.amazon.co.uk/dp/' || regexp_extract({BARE}, '/(?:dp|gp/product)/([A-Z0-9]{{10}})', 1) else {BARE} end"
)


@REGISTRY.add("U01_canonicalize_links", f"select *, {CANONICAL} as canonical_url from {ALL_LINKS} l")
def _(v):
    return lk.canonicalize_links(all_links(v))


@REGISTRY.add("U01_group_by_canonical", f"""
select c as canonical_url, count(*) as links, min(url) as first_url, count(*) filter (where url <> c) as changed
from (select *, {CANONICAL} as c from {ALL_LINKS} l) q group by c""")
def _(v):
    return lk.group_by_canonical(all_links(v))


_RULES = [*PARAMETER_RULES, ("example.", ["utm_source", "ref"])]
_DROP = (
    f"case when regexp_matches(host, '{dots(TRACKER_HOSTS_KEPT)}') then [] "
    + " ".join(f"when contains(host, '{h}') then [{quoted(names)}]" for h, names in _RULES)
    + " else [] end"
)


@REGISTRY.add("U02_strip_params", f"""
with h as (select *, {HOST} as host from {ALL_LINKS} l),
d as (select *, {_DROP} as drops, regexp_extract(url, '\\?([^#]*)', 1) as query from h),
k as (select *, list_filter(string_split(query, '&'), lambda p: not list_contains(drops, split_part(p, '=', 1))) as kept from d)
select product_id, ord, name, url, case when len(drops) > 0 and query <> '' then
   regexp_extract(url, '^[^?#]*', 0) || case when len(kept) > 0 then '?' || array_to_string(kept, '&') else '' end || regexp_extract(url, '(#.*)$', 1)
   else url end as clean_url from k""")
def _(v):
    return lk.strip_params(all_links(v), _RULES)


def _target(url: str) -> str:
    t = (
        f"coalesce(url_decode(nullif(regexp_extract({url}, 'url\\(([^)]+)\\)', 1), '')), "
        f"url_decode(nullif(regexp_extract({url}, '[?&]url=([^&#]+)', 1), '')), url_decode(nullif(regexp_extract({url}, '[?&]q=([^&#]+)', 1), '')))"
    )
    return f"case when regexp_matches({t}, '^https?://') then {t} end"


@REGISTRY.add("U03_unwrap_links", f"""
with one as (select *, coalesce({_target('url')}, url) as u1 from {ALL_LINKS} l)
select product_id, ord, name, url, coalesce({_target('u1')}, u1) as target_url from one""")
def _(v):
    return lk.unwrap_links(all_links(v))


_HOME = f"case when regexp_matches({HOST}, '{dots(REDIRECT_HOSTS)}') then coalesce(case name " + " ".join(
    f"when '{n}' then '{h}'" for n, h in HOME_PAGES.items()
) + " end, url) else url end"


@REGISTRY.add("U04_fallback_links", f"select *, {_HOME} as fallback_url from {ALL_LINKS} l")
def _(v):
    return lk.fallback_links(all_links(v))


_CLEAN = f"""
cleaned as (select *, coalesce(item, embedded, home) as clean_url,
   case when coalesce(item, embedded, home) = url then 'unchanged' when item is not null then 'item' when embedded is not null then 'embedded' else 'home_page' end as method
 from (select *, case when contains({HOST}, 'amazon.co.uk') then 'https://www.amazon.co.uk/dp/' || nullif(regexp_extract({BARE}, '/dp/([A-Z0-9]+)', 1), '') end as item,
         case when regexp_matches({HOST}, 'markselectrical\\.co\\.uk|digidip\\.net') then {_target('url')} end as embedded, {_HOME} as home
       from {ALL_LINKS} l) q)"""


@REGISTRY.add("U05_clean_links", f"with {_CLEAN} select product_id, ord, name, url, clean_url, method from cleaned")
def _(v):
    return lk.clean_links(all_links(v))


@REGISTRY.add("G08_link_report", f"""
with {_CLEAN}
select count(*) as total, count(*) filter (where method <> 'unchanged') as changed,
       round(cast(count(*) filter (where method <> 'unchanged') as double) / count(*) * 100, 1) as percent,
       count(*) filter (where method = 'item') as item, count(*) filter (where method = 'embedded') as embedded,
       count(*) filter (where method = 'home_page') as home_page, count(*) filter (where method = 'unchanged') as unchanged from cleaned""")
def _(v):
    return lk.link_report(lk.clean_links(all_links(v)))


_HOSTED = """(select product_id, ord, name, case ord % 5 when 0 then replace(url, 'shop', 'philips') when 1 then replace(url, 'shop', 'techradar')
  when 2 then replace(url, 'shop', 'cnet') else url end as url from fx_retailer_link)"""


def hosted_links(v):
    url = F.expr("case ord % 5 when 0 then replace(url, 'shop', 'philips') when 1 then replace(url, 'shop', 'techradar') when 2 then replace(url, 'shop', 'cnet') else url end")
    return v.fx_retailer_link.select("product_id", "ord", "name", url.alias("url"))


_CLASS = (
    f"case when regexp_matches(lower(url), '{dots(EXCLUDED_DOMAINS)}') then 0 when regexp_matches(lower(url), '{dots(MANUFACTURER_DOMAINS)}') then 1 "
    f"when regexp_matches(lower(url), '{dots(REVIEW_DOMAINS)}') then 2 else 3 end"
)


@REGISTRY.add("H04_classify_links", f"select *, {_CLASS} as priority from {_HOSTED} l")
def _(v):
    return lk.classify_links(hosted_links(v))


@REGISTRY.add("H05_pick_links", f"""
with c as (select *, {_CLASS} as priority from {_HOSTED} l),
f as (select *, row_number() over (partition by product_id, priority order by ord) as n from c where priority > 0)
select product_id, ord, name, url, priority, cast(row_number() over (partition by product_id order by priority, ord) as int) as pick
from f where priority <> 1 or n = 1 qualify pick <= 3""")
def _(v):
    return lk.pick_links(lk.classify_links(hosted_links(v)))


_ROUTE_NAME = "case upper(name) " + " ".join(f"when '{s.name.upper()}' then '{s.name}'" for s in SOURCES) + " end"
_ROUTE_URL = "case " + " ".join(f"when regexp_matches(lower(url), '{dots(s.patterns)}') then '{s.name}'" for s in SOURCES) + " end"
_ROUTE_PRIORITY = "case source " + " ".join(f"when '{s.name}' then {s.priority}" for s in SOURCES) + " end"


@REGISTRY.add("F04_route_links", f"""
select *, {_ROUTE_PRIORITY} as priority from (select *, coalesce({_ROUTE_NAME}, {_ROUTE_URL}) as source from {ALL_LINKS} l) q where source is not null""")
def _(v):
    return lk.route_links(all_links(v))


# Every address of the landed pages, without its scheme, is a rule; the shortest ones also as a word.
_PAGE_RULES = """(select page_id as ord, 'S' || cast(page_id as varchar) as name, regexp_replace(lower(url), '^https?://', '') as pattern, page_id % 3 <> 1 as enabled from pages
  union all select 1000000 + page_id, 'H' || cast(page_id % 7 as varchar), 'item/' || cast(page_id % 40 as varchar), true from pages)"""


def page_rules(v):
    own = v.pages.select(
        F.col("page_id").alias("ord"), F.concat(F.lit("S"), F.col("page_id").cast("string")).alias("name"),
        F.array(F.regexp_replace(F.lower("url"), "^https?://", "")).alias("patterns"), F.expr("cast(page_id % 5 as int)").alias("priority"), F.expr("page_id % 3 <> 1").alias("enabled"),
    )
    items = v.pages.selectExpr(
        "1000000 + page_id as ord", "'H' || cast(page_id % 7 as string) as name", "array('item/' || cast(page_id % 40 as string)) as patterns",
        "cast(9 as int) as priority", "true as enabled",
    )
    return own.unionByName(items)


def linked_texts(v):
    """Retailer links and all page addresses, every second one with an item at its end."""
    tail = F.expr("case when product_id % 2 = 0 then '/item/' || cast(product_id % 50 as string) else '' end")
    return all_links(v).withColumn("url", F.concat("url", tail))


_LINKED = f"(select product_id, ord, name, url || case when product_id % 2 = 0 then '/item/' || cast(product_id % 50 as varchar) else '' end as url from {ALL_LINKS} a)"


@REGISTRY.add("F04_route_rules", f"""
with rule as (select ord as o, name as rn, pattern, enabled, case when ord < 1000000 then cast(ord % 5 as int) else 9 end as priority from {_PAGE_RULES} r where pattern <> ''),
named as (select upper(rn) as u, min(o) as o from rule group by 1),
text as (select distinct lower(url) as t from {_LINKED} l),
hit as (select t, min(o) as o from text join rule on contains(t, pattern) group by t)
select l.product_id, l.ord, l.name, l.url, r.rn as source, r.priority
from {_LINKED} l left join named n on n.u = upper(l.name) left join hit h on h.t = lower(l.url) join rule r on r.o = coalesce(n.o, h.o) where r.enabled""")
def _(v):
    return lk.route_links(linked_texts(v), page_rules(v))


@REGISTRY.add("H04_classify_by_table", f"""
with domain as (select regexp_replace(lower(url), '^https?://([^/]*).*$', '\\1') as d, min(cast(page_id % 3 as int)) as p from pages group by 1),
text as (select distinct lower(url) as t from {_LINKED} l), hit as (select t, min(p) as p from text join domain on contains(t, d) and d <> '' group by t)
select l.*, coalesce(h.p, 3) as priority from {_LINKED} l left join hit h on h.t = lower(l.url)""")
def _(v):
    """The hosts of all pages are the list of domains."""
    domains = v.pages.select(F.regexp_replace(F.lower("url"), "^https?://([^/]*).*$", "$1").alias("domain"), F.expr("cast(page_id % 3 as int)").alias("priority"))
    return lk.classify_links(linked_texts(v), domains)


@REGISTRY.add("F08_resolve_redirects", """
with recursive edge as (
  select src, min(case when starts_with(dst, '/') then regexp_extract(src, '^(https?://[^/]*)', 1) || dst else dst end) as dst from fx_redirect group by src),
walk as (
  select distinct 'https://r.example.com/u' || cast(page_id as varchar) as url, 'https://r.example.com/u' || cast(page_id as varchar) as cur, 0 as hops from pages
  union all select w.url, e.dst, w.hops + 1 from walk w join edge e on e.src = w.cur where w.hops < 10)
select url, arg_max(cur, hops) as final_url, max(hops) as hops from walk group by url""")
def _(v):
    urls = v.pages.select(F.concat(F.lit("https://r.example.com/u"), F.col("page_id").cast("string")).alias("url"))
    return lk.resolve_redirects(urls, v.fx_redirect)


# --- harvest ------------------------------------------------------------------------------------


@REGISTRY.add("A03_harvest_specs", """
select product_id, kind, key, value from fx_spec where key <> 'depth'
union all select product_id, 'specs', 'depth', replace(value, 'cm', ' cm < 99') from fx_spec where key = 'depth'
union all select p_partkey, 'specs', 'wi_fi_app', 'Yes' from part
union all select p_partkey, 'specs', 'door_lock', 'No' from part""")
def _(v):
    return hv.harvest_specs(v.fx_html).drop("ord")


@REGISTRY.add("A03_harvest_pages", """
with m as (select page_id, regexp_extract_all(html, '<li><a href="/([^"]*)">[^<]*</a></li>', 1) as labels,
                  regexp_extract_all(html, '<li><a href="/[^"]*">([^<]*)</a></li>', 1) as vals from pages),
u as (select page_id, unnest(range(len(labels))) as ord, unnest(labels) as label, unnest(vals) as value from m),
k as (select page_id, ord, regexp_replace(regexp_replace(lower(replace(label, ':', '')), '[^a-z0-9]+', '_', 'g'), '^_|_$', '', 'g') as key, trim(value) as value from u)
select page_id as product_id, 'specs' as kind, min(ord) as ord, key, arg_max(value, ord) as value
from k where key not in ('', '_') and value not in ('', '-', 'N/A') group by page_id, key""")
def _(v):
    """Whole raw pages, their navigation list read as a table."""
    html = F.regexp_replace("html", '<li><a href="/([^"]*)">([^<]*)</a></li>', "<tr><td>$1</td><td>$2</td></tr>")
    html = F.replace(F.replace(html, F.lit("<ul>"), F.lit("<table>")), F.lit("</ul>"), F.lit("</table>"))
    return hv.harvest_specs(v.pages.select(F.col("page_id").alias("product_id"), html.alias("html")))


@REGISTRY.add("A03_behind_heading", """
select product_id, case kind when 'specs' then 'specs' else 'features' end as kind, key, value from fx_spec where key <> 'depth' and product_id % 3 <> 0
union all select product_id, 'specs', 'depth', replace(value, 'cm', ' cm < 99') from fx_spec where key = 'depth' and product_id % 3 <> 0
union all select p_partkey, 'specs', 'wi_fi_app', 'Yes' from part where p_partkey % 3 <> 0
union all select p_partkey, 'specs', 'door_lock', 'No' from part where p_partkey % 3 <> 0""")
def _(v):
    """A delivery table comes first on each page; every third page has no specification heading."""
    before = F.lit("<table><tr><td>Delivery</td><td>free</td></tr></table><h2>Technical data</h2>")
    heading = F.when(F.expr("product_id % 3 <> 0"), F.lit('<h3 class="t">The full <b>data sheet</b></h3>')).otherwise(F.lit("<h3>Reviews</h3>"))
    pages = v.fx_html.select("product_id", F.concat(before, heading, "html").alias("html"))
    return hv.harvest_specs(pages, heading="data sheet").drop("ord")


_SIZE = "cast(p_size as string)"


def part_pages(v, *pieces: str):
    """A page for each part, from SQL expressions over its row."""
    return v.part.select(F.col("p_partkey").alias("product_id"), F.concat(*[F.expr(p) for p in pieces]).alias("html"))


@REGISTRY.add("A03_nested_tables", """
select p_partkey as product_id, k.kind, k.key, case k.v when 'name' then p_name when 'size' then cast(p_size as varchar) else k.v end as value
from part, (values ('specs', 'width', 'size'), ('specs', 'colour', 'name'), ('specs', 'inner_height', 'size'), ('specs', 'deepest', 'name'),
  ('specs', 'behind', 'last'), ('features', 'timer', 'Yes'), ('features', 'brand', 'name'), ('features', 'open', 'size')) k(kind, key, v)
where k.key <> 'deepest' or p_partkey % 2 = 0""")
def _(v):
    """A table in a cell, on every second page another one in that; a table that is never closed; closing tags left out."""
    return hv.harvest_specs(part_pages(
        v, "'</table><p>1 < 2</p><TABLE class=a><tr><td>Width<td>'", _SIZE, "'<tr><th>Size</th><td><table border=1><tr><td>Inner height</td><td>'", _SIZE,
        "'</td></tr><tr><td>More</td><td>'",
        "case when p_partkey % 2 = 0 then '<table><tr><td>Deepest</td><td>' || p_name || '</td></tr></table>' else '<table></table>' end",
        "'</td></tr></table> and <table><tr><td>a</td></tr></table></td></tr><tr><td>Colour</td><td>'", "p_name",
        "'</td></tr><tr><td>Behind</td><td>last</td></tr></table><table><tbody><tr><td>Timer</td><td>Yes</td></tr><tr><td>Brand</td><td>'", "p_name",
        "'</td></tr></tbody><table><tr><td>Open</td><td>'", _SIZE, "'</td></tr>'",
    )).drop("ord")


@REGISTRY.add("A03_commented_tables", """
select p_partkey as product_id, k.kind, k.key, case k.v when 'name' then p_name else cast(p_size as varchar) end as value
from part, (values ('specs', 'width', 'size'), ('specs', 'maker', 'name'), ('features', 'rows', 'size')) k(kind, key, v)""")
def _(v):
    """Tables inside comments, scripts and templates are no tables, wherever they stand; a comment that never ends is one too."""
    old = "'<table><tr><td>Old</td><td>' || p_name || '</td></tr></table>'"
    return hv.harvest_specs(part_pages(
        v, "'<!-- '", old, "' --><script>var t = \"'", old, "'\";</script><table><!-- </table> --><tr><td>Width</td><td><!-- 9 -->'", _SIZE,
        "'</td></tr><!--<tr><td>Old</td><td>1</td></tr>--><tr><td>Maker</td><td>'", "p_name", "'</td></tr></table><template>'", old,
        "'</template><table><tr><td>Rows</td><td>'", _SIZE, "'</td></tr></table><!-- '", old,
    )).drop("ord")


@REGISTRY.add("A03_icon_paths", """
select p_partkey as product_id, 'specs' as kind, k.key, case k.v when 'size' then cast(p_size as varchar) else k.v end as value
from part, (values ('steam', 'Yes'), ('lock', 'No'), ('app', 'Yes'), ('grill', 'No'), ('code', 'M438.6 of size'), ('wash', 'size')) k(key, v)""")
def _(v):
    """Icons without a name, told by their drawing; the same characters in a text or in a name mean nothing."""
    def row(key: str, value: str) -> str:
        return f"'<tr><td>{key}</td><td><span class=\"BodyText\">{value}</span></td></tr>'"

    svg = '<svg viewBox="0 0 512 512"><path fill="none" d="{}"/></svg>'
    return hv.harvest_specs(part_pages(
        v, "'<table>'", row("Steam", svg.format("M438.6 105.4c12.5 12.5")), row("Lock", svg.format("M342.6 150.6c12.5-12.5")),
        row("App", '<svg data-icon="check"></svg>'), row("Grill", '<svg data-icon="xmark"><path d="M1 1"/></svg>'), row("Code", "M438.6 of size"),
        f"replace({row('Wash', '<svg><path id=M438.6 d=M2/></svg>@')}, '@', {_SIZE})", row("None", svg.format("M1 1")), "'</table>'",
    )).drop("ord")


@REGISTRY.add("A03_character_references", """
select p_partkey as product_id, 'specs' as kind, k.key, replace(k.v, '@', cast(p_size as varchar)) as value
from part, (values ('price', '£@.99'), ('price_2', '£@'), ('price_3', '€@'), ('noise', '@ dB'), ('range', '@–20 °C'), ('note', '&lt; @ & "co" &nothing;'),
  ('odd', '' || chr(65533) || '@'), ('face', '😀 @')) k(key, v)""")
def _(v):
    def row(key: str, value: str) -> str:
        return f"replace('<tr><td>{key}</td><td>{value}</td></tr>', '@', {_SIZE})"

    return hv.harvest_specs(part_pages(
        v, "'<table>'", row("Price", "&#163;@.99"), row("Price&nbsp;2", "&#xA3;@"), row("Price&#160;3", "&#128;@"), row("Noise", "@&#8239;dB"),
        row("Range", "@&ndash;20&nbsp;&deg;C"), row("Note", "&amp;lt; @ &amp; &quot;co&quot; &nothing;"), row("Odd", "&#55555;@"), row("Face", "&#x1F600; @"), "'</table>'",
    )).drop("ord")


@REGISTRY.add("A03_feature_bullets", """
select p_partkey as product_id, 'features' as kind, cast(k.n - 1 as bigint) as ord, 'feature_' || cast(k.n as varchar) as key,
       replace(k.v, '@', case when k.n = 1 then p_name else cast(p_size as varchar) end) as value
from part, (values (1, 'Made as @'), (3, 'Holds @ litres & more'), (4, 'Part @ of an inner list'), (6, '12345678901')) k(n, v)
where length(replace(k.v, '@', case when k.n = 1 then p_name else cast(p_size as varchar) end)) > 10""")
def _(v):
    def item(text: str, put: str = _SIZE) -> str:
        return f"replace('<li class=\"x\"><span class=\"a-list-item\"> {text} </span></li>', '@', {put})"

    return hv.harvest_bullets(part_pages(
        v, "'<ul><li><span class=\"a-list-item\">Not in the section, long enough</span></li></ul><div id=\"feature-bullets\"><h1>About</h1><ul class=\"a\">'",
        item("Made <b>as</b> <span>@</span>", "p_name"), item("short @"), item("Holds @ litres &amp; more"),
        "'<li><ul>'", item("Part <span class=\"b\">@</span> of an inner list"), "'</ul></li>'", item("1234567890"), item("12345678901"),
        "'<li>no marked item in here</li></ul><ul><li><span class=\"a-list-item\">A second list of the section</span></li></ul></div>'",
    ))


@REGISTRY.add("A04_harvest_sections", """
select page_id as product_id, s.section, cast(s.o as bigint) as section_ord, cast(r.o as bigint) as ord, r.key, r.value
from pages, (values (0, 'main_features'), (1, 'unknown')) s(o, section),
  lateral (select 0 as o, 'page' as key, cast(page_id as varchar) as value where page_id % 5 <> 0 union all select 1, 'spin_speed', '1 400 rpm') r""")
def _(v):
    """Sections of div rows in front of whole raw pages; the second has no title, and every fifth page a blank value."""
    page = F.col("page_id").cast("string")

    def row(key: str, value) -> Column:
        return F.concat(
            F.lit(f'<div class="flex items-center p-3"><div data-tag-type="accordion" class="x text-body-sm">{key}</div><p>?</p><span class="flex-shrink-0 ml-auto">'),
            value, F.lit("</span></div>"),
        )

    rows = F.concat(row("<i>Page</i>", F.when(F.expr("page_id % 5 = 0"), "&nbsp;").otherwise(page)), row("Spin&nbsp;speed", F.lit("1&#160;400 rpm")))
    section = F.lit('<div data-accordion="specification-features">')
    html = F.concat(F.lit("<body>"), section, F.lit("<header><h3> Main features </h3></header>"), rows, section, rows, F.lit("</div></div>"), "html")
    return hv.harvest_sections(v.pages.select(F.col("page_id").alias("product_id"), html.alias("html")))


@REGISTRY.add("A05_harvest_jsonld", """
select p_partkey as product_id,
  case when p_partkey % 4 = 3 then '1' else cast(cast(p_partkey % 41 as double) / 10 + 1 as varchar) end || '/5' as rating_text,
  cast(case when p_partkey % 4 = 3 then 1 else p_size * 3 end as bigint) as count,
  case when p_partkey % 4 = 3 then 'Second block is ignored' else 'Long enough body of part ' || p_name || '|Another body number ' || cast(p_size as varchar) end as reviews
from part""")
def _(v):
    return hv.harvest_jsonld(v.fx_jsonld).withColumn("reviews", F.array_join("reviews", "|"))


@REGISTRY.add("A06_harvest_ratings", """
select p_partkey as product_id, case when p_partkey % 4 < 3 then cast(p_size as double) / 10 end as rating,
  cast(case p_partkey % 4 when 0 then p_size * 30 when 1 then p_size when 2 then 1000 + p_size + 100 end as bigint) as count from part""")
def _(v):
    return hv.harvest_ratings(v.fx_rating_html)


@REGISTRY.add("A07_harvest_listing", """
select page_id, cast(0 as int) as position, p_name || '  MX' || cast(l_partkey as varchar) as name, '£' || cast(p_retailprice as varchar) as price_text,
  case when l_partkey % 10 <> 0 then 'https://x.example.com/reviews/p' || cast(l_partkey as varchar) end as link from fx_card where l_quantity <= 48
union all
select page_id, 1, 'Offer of ' || cast(l_suppkey as varchar), '£5', 'https://y.example.com/' || cast(line as varchar) from fx_card""")
def _(v):
    second = F.concat(
        F.lit('<li class="item"><h3>Offer of '), F.col("l_suppkey").cast("string"), F.lit('</h3><span class="price">£5</span><a class="b" href="https://y.example.com/'),
        F.col("line").cast("string"), F.lit('">x</a></li>'),
    )
    pages = v.fx_card.select("page_id", F.concat(F.lit("<ul>"), "card", second, F.lit("</ul>")).alias("html"))
    return hv.harvest_listing(pages, "https://x.example.com")


@REGISTRY.add("A07_page_count", """
select page_id, cast(page_id % 90 + 1 as int) as pages from pages""")
def _(v):
    marked = v.pages.select("page_id", F.concat("html", F.expr("'<p>Page 1 of ' || cast(page_id % 90 + 1 as string) || '</p>'")).alias("html"))
    return hv.page_count(marked).drop("html")


_RESULTS = """(select page_id, replace(replace(html, 'href="/', 'href="' || regexp_extract(url, '^https?://[^/]+', 0) || '/'), '</a></li>', '</a> £1,299.99 in stock</li>') as html from pages)"""


@REGISTRY.add("A08_harvest_links", rf"""
with i as (select page_id, unnest(range(len(m))) as position, unnest(m) as item from (
             select page_id, regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1)[1:20] as m from {_RESULTS} r) q),
l as (select *, nullif(regexp_extract(item, '<a [^>]*href="(http[^"]*)"', 1), '') as url from i),
h as (select *, split_part(replace(lower(regexp_extract(url, '://([^/?#:]*)', 1)), 'www.', ''), '.', 1) as label from l where url is not null)
select page_id, cast(position as int) as position, url,
  trim(replace(regexp_replace(regexp_extract(item, '(?s)<a [^>]*>(.*?)</a>', 1), '<[^>]*>', '', 'g'), '&amp;', '&')) as title, '£1,299.99' as price,
  array_to_string(list_transform(string_split(label, '-'), lambda w: upper(w[1]) || w[2:]), '-') as source_name from h""")
def _(v):
    origin = F.regexp_extract("url", "^https?://[^/]+", 0)
    html = F.replace(F.replace("html", F.lit('href="/'), F.concat(F.lit('href="'), origin, F.lit("/"))), F.lit("</a></li>"), F.lit("</a> £1,299.99 in stock</li>"))
    return hv.harvest_links(v.pages.select("page_id", html.alias("html")))


@REGISTRY.add("A11_ingest_responses", """
with s as (select conv_id, turn, clean, (conv_id * 31 + turn) % 7 <> 0 as json, conv_id % 9 <> 0 as whole, role from (select f.*, c.role from fx_reply f join conversations c using (conv_id, turn)) q)
select conv_id, turn, case when json and whole then clean else 'Unable to analyze reviews' end as summary,
  case when json and whole then role || '|turn ' || cast(turn as varchar) else '' end as pros,
  case when json and whole and turn % 2 = 0 then 'none' else '' end as cons, '' as themes,
  case when json and whole then 'ok' else 'Analysis failed' end as insights,
  case when not (json and whole) then 0.0::double when (conv_id + turn) % 5 = 0 then 0.5::double else least(1.0::double, cast(conv_id % 15 as double) / 10) end as confidence,
  case when not json then 'No valid JSON found in response' when not whole then 'Missing required field: insights' end as error
from s""")
def _(v):
    typed = rp.ingest_responses(v.fx_reply)
    for name in ("pros", "cons", "themes"):
        typed = typed.withColumn(name, F.array_join(name, "|"))
    return typed.drop("clean", "reply")


@REGISTRY.add("A12_pick_largest_object", """
select doc_id, '{"a": 1, "b": {"c": 2}, "d": "' || regexp_replace(text, '[^A-Za-z0-9 .]', '_', 'g') || '"}' as object, cast(3 as int) as keys from documents""")
def _(v):
    return rp.pick_largest_object(v.fx_multi).drop("reply")


_MANY = "case when doc_id % 500 = 0 then 100000 else cast(doc_id % 40 as int) end"


@REGISTRY.add("A12_many_inner_objects", f"""
select doc_id, cast(length('{{"list": [' || repeat('{{"a": 1}}, ', {_MANY}) || '0]}}') as int) as size, cast(1 as int) as keys from documents""")
def _(v):
    reply = F.concat(F.lit('reply: {"list": ['), F.repeat(F.lit('{"a": 1}, '), F.expr(_MANY)), F.lit("0]} end"))
    picked = rp.pick_largest_object(v.documents.select("doc_id", reply.alias("reply")))
    return picked.select("doc_id", F.length("object").alias("size"), "keys")
