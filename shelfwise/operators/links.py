"""Links: cleaning, unwrapping, classification, routing and redirect resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions.tables import rule_table
from shelfwise.functions.text import contains_any, extract_or_null
from shelfwise.operators.matching import first_contained
from shelfwise.rules import (
    EXCLUDED_DOMAINS, HOME_PAGES, MANUFACTURER_DOMAINS, PARAMETER_RULES, REDIRECT_HOSTS, REVIEW_DOMAINS, SOURCES,
    TRACKER_HOSTS_KEPT, Source,
)


def host_of(url: Column) -> Column:
    """Lower-cased host without user and port; empty when there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def without_query(url: Column) -> Column:
    """URL up to its path: no parameters, query or fragment."""
    return F.regexp_extract(url, r"^[^?#;]*", 0)


def canonical_url(url: Column) -> Column:
    """Short product form for amazon.co.uk ids, otherwise the URL without query and fragment."""
    item = extract_or_null(without_query(url), r"/(?:dp|gp/product)/([A-Z0-9]{10})", 1)
    short = F.concat(F.lit("https://www.amazon.co.uk/dp/"), item)
    return F.when(F.contains(host_of(url), F.lit("amazon.co.uk")) & item.isNotNull(), short).otherwise(without_query(url))


def canonicalize_links(links: DataFrame) -> DataFrame:
    return links.withColumn("canonical_url", canonical_url(F.col("url")))


def group_by_canonical(links: DataFrame) -> DataFrame:
    """Links per canonical form. Counts only, so a form with very many links stays cheap."""
    return canonicalize_links(links).groupBy("canonical_url").agg(
        F.count("*").alias("links"), F.min("url").alias("first_url"), F.count_if(F.col("url") != F.col("canonical_url")).alias("changed")
    )


def strip_params(links: DataFrame, rules=PARAMETER_RULES, keep_hosts=TRACKER_HOSTS_KEPT) -> DataFrame:
    """Drop listed query parameters per host; tracker links keep theirs, they stop working without."""
    url, host = F.col("url"), host_of(F.col("url"))
    dropped = F.when(contains_any(host, keep_hosts), F.array().cast("array<string>"))
    for fragment, names in rules:
        dropped = dropped.when(F.contains(host, F.lit(fragment)), F.array(*[F.lit(n) for n in names]))
    dropped = dropped.otherwise(F.array().cast("array<string>"))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: ~F.array_contains(F.col("_dropped"), F.split(p, "=")[0]))
    rebuilt = F.concat(
        F.regexp_extract(url, "^[^?#]*", 0),
        F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""),
        F.regexp_extract(url, "(#.*)$", 1),
    )
    touched = (F.size("_dropped") > 0) & (query != "")
    return links.withColumn("_dropped", dropped).withColumn("clean_url", F.when(touched, rebuilt).otherwise(url)).drop("_dropped")


def _decoded(text: Column) -> Column:
    return F.try_url_decode(text)


def embedded_target(url: Column) -> Column:
    """Address carried inside a tracking link, or null."""
    bracket = extract_or_null(url, r"url\(([^)]+)\)")
    target = F.coalesce(
        _decoded(F.replace(bracket, F.lit("+"), F.lit("%2B"))),
        _decoded(extract_or_null(url, r"[?&]url=([^&#]+)")),
        _decoded(extract_or_null(url, r"[?&]q=([^&#]+)")),
    )
    return F.when(target.rlike("^https?://"), target)


def unwrap_links(links: DataFrame, levels: int = 2) -> DataFrame:
    """Replace tracking links by the address they carry, also when nested."""
    result = links.withColumn("target_url", F.col("url"))
    for _ in range(levels):
        result = result.withColumn("target_url", F.coalesce(embedded_target(F.col("target_url")), F.col("target_url")))
    return result


def fallback_url(url: Column, name: Column, homes: dict[str, str] = HOME_PAGES, redirect_hosts=REDIRECT_HOSTS) -> Column:
    """Home page of the named source when the link only leads to a redirect service."""
    home = None
    for source, page in homes.items():
        home = F.when(name == source, page) if home is None else home.when(name == source, page)
    return F.when(contains_any(host_of(url), redirect_hosts), F.coalesce(home, url)).otherwise(url)


def fallback_links(links: DataFrame, homes: dict[str, str] = HOME_PAGES) -> DataFrame:
    return links.withColumn("fallback_url", fallback_url(F.col("url"), F.col("name"), homes))


def clean_links(links: DataFrame) -> DataFrame:
    """Best cleaned form of an affiliate link (url, name) and the method that gave it."""
    url, host = F.col("url"), host_of(F.col("url"))
    item = extract_or_null(without_query(url), r"/dp/([A-Z0-9]+)")
    by_item = F.when(F.contains(host, F.lit("amazon.co.uk")), F.concat(F.lit("https://www.amazon.co.uk/dp/"), item))
    carried = F.when(host.rlike(r"markselectrical\.co\.uk|digidip\.net"), embedded_target(url))
    home = fallback_url(url, F.col("name"))
    return links.withColumn("clean_url", F.coalesce(by_item, carried, home)).withColumn(
        "method",
        F.when(F.col("clean_url") == url, "unchanged").when(by_item.isNotNull(), "item").when(carried.isNotNull(), "embedded")
        .otherwise("home_page"),
    )


def link_report(cleaned: DataFrame) -> DataFrame:
    """Links, changed links with percent, and links per method."""
    changed = F.count_if(F.col("method") != "unchanged")
    methods = [F.count_if(F.col("method") == m).alias(m) for m in ("item", "embedded", "home_page", "unchanged")]
    return cleaned.agg(F.count("*").alias("total"), changed.alias("changed"), F.round(changed / F.count("*") * 100, 1).alias("percent"), *methods)


def link_class(url: Column) -> Column:
    """0 excluded, 1 manufacturer, 2 review site, 3 unknown; the first list that hits decides."""
    lowered = F.lower(url)
    return (
        F.when(contains_any(lowered, EXCLUDED_DOMAINS), 0)
        .when(contains_any(lowered, MANUFACTURER_DOMAINS), 1)
        .when(contains_any(lowered, REVIEW_DOMAINS), 2)
        .otherwise(3)
    )


def classify_links(links: DataFrame, domains: DataFrame | None = None) -> DataFrame:
    """Adds `priority` by the built-in lists, or by a table (domain, priority) of any size: of the domains a link contains the
    one of the smallest priority decides, 3 where there is none."""
    if domains is None:
        return links.withColumn("priority", link_class(F.col("url")))
    patterns = domains.select(F.lower("domain").alias("pattern"), F.col("priority").cast("int").alias("ord"))
    found = first_contained(links.select(F.lower("url").alias("text")), patterns)
    joined = links.join(found.select("text", F.col("ord").alias("_class")), F.lower(links["url"]) == F.col("text"), "left")
    return joined.withColumn("priority", F.coalesce("_class", F.lit(3))).drop("text", "_class")


def pick_links(classified: DataFrame, k: int = 3) -> DataFrame:
    """Up to `k` links per product: one manufacturer, then review sites, then unknown ones."""
    in_class = Window.partitionBy("product_id", "priority").orderBy("ord")
    overall = Window.partitionBy("product_id").orderBy("priority", "ord")
    return (
        classified.where("priority > 0")
        .withColumn("_n", F.row_number().over(in_class))
        .where(F.col("_n") <= k)
        .where("priority <> 1 or _n = 1")
        .withColumn("pick", F.row_number().over(overall))
        .where(F.col("pick") <= k)
        .drop("_n")
    )


def source_table(spark: SparkSession, sources: list[Source] = SOURCES) -> DataFrame:
    """The source list as a table: ord, name, patterns, priority, enabled."""
    return rule_table(spark, {
        "ord": list(range(len(sources))), "name": [s.name for s in sources], "patterns": [list(s.patterns) for s in sources],
        "priority": [s.priority for s in sources], "enabled": [s.enabled for s in sources],
    })


def route_links(links: DataFrame, sources: list[Source] | DataFrame = SOURCES, enabled_only: bool = True) -> DataFrame:
    """Source of each link (name, url) and its priority: by exact name, else by the first registered URL pattern.

    `sources` is a list, looked through inside the row, or a table like that of `source_table` of any size, which is joined; of
    equal names the first counts.
    """
    if isinstance(sources, DataFrame):
        named = sources.groupBy(F.upper("name").alias("_name")).agg(F.min("ord").alias("_by_name"))
        found = first_contained(links.select(F.lower("url").alias("text")), sources.select(F.explode("patterns").alias("pattern"), "ord"))
        found = found.select("text", F.col("ord").alias("_by_url"))
        joined = links.join(named, F.upper(links["name"]) == F.col("_name"), "left").join(found, F.lower(links["url"]) == F.col("text"), "left")
        placed = joined.withColumn("_ord", F.coalesce("_by_name", "_by_url")).drop("_name", "_by_name", "text", "_by_url")
        kept = sources.where("enabled") if enabled_only else sources
        about = kept.select(F.col("ord").alias("_ord"), F.col("name").alias("source"), F.col("priority").cast("int").alias("priority"))
        return placed.join(about, "_ord").drop("_ord")
    listed = F.array(*[
        F.struct(
            F.lit(s.name).alias("name"), F.array(*[F.lit(p) for p in s.patterns]).cast("array<string>").alias("patterns"),
            F.lit(s.priority).alias("priority"), F.lit(s.enabled).alias("enabled"),
        ) for s in sources
    ])
    name, url = F.upper("name"), F.lower("url")
    by_name = F.get(F.filter(listed, lambda s: F.upper(s["name"]) == name), F.lit(0))
    by_url = F.get(F.filter(listed, lambda s: F.exists(s["patterns"], lambda p: F.contains(url, p))), F.lit(0))
    routed = links.withColumn("_source", F.coalesce(by_name, by_url)).where("_source is not null")
    routed = routed.where("_source.enabled") if enabled_only else routed
    return routed.withColumns({"source": F.col("_source.name"), "priority": F.col("_source.priority")}).drop("_source")


def absolute_url(base: Column, target: Column) -> Column:
    """Target of a redirect seen at `base`; a leading slash keeps the scheme and host of the base."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    return F.when(target.startswith("//"), F.concat(scheme, target)).when(target.startswith("/"), F.concat(origin, target)).otherwise(target)


def resolve_redirects(urls: DataFrame, edges: DataFrame, max_hops: int = 10) -> DataFrame:
    """Where each URL ends after at most `max_hops` observed redirects (src, dst), and the hops taken.

    Jump tables for 1, 2, 4, ... hops are joined from each other, and the powers that sum to
    `max_hops` are applied one after the other, so ten hops cost five joins. Only the distinct
    starting URLs travel; a popular target is the probe side of its join, which may be split.
    """
    jump = edges.groupBy("src").agg(F.min(absolute_url(F.col("src"), F.col("dst"))).alias("dst")).withColumn("hops", F.lit(1))
    state = urls.select("url").distinct().select("url", F.col("url").alias("final_url"), F.lit(0).alias("hops"))
    remaining = max_hops
    while remaining:
        if remaining & 1:
            step = jump.select(F.col("src").alias("final_url"), F.col("dst").alias("_next"), F.col("hops").alias("_more"))
            state = state.join(step, "final_url", "left").select(
                "url", F.coalesce("_next", "final_url").alias("final_url"), (F.col("hops") + F.coalesce("_more", F.lit(0))).alias("hops")
            )
        remaining >>= 1
        if remaining:
            further = jump.select(F.col("src").alias("dst"), F.col("dst").alias("_next"), F.col("hops").alias("_more"))
            jump = jump.join(further, "dst", "left").select(
                "src", F.coalesce("_next", "dst").alias("dst"), (F.col("hops") + F.coalesce("_more", F.lit(0))).alias("hops")
            )
    return state
