"""Product-catalog views over the TPC-H-like tables.

Each view exists twice: as a DataFrame for the Spark queries and as SQL text for the SQL
counterparts. Views marked shared use one SQL text for both engines.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Tables whose rows are small in the file and become many rows or long texts, by the key that places them.
SPREAD = {"part": "p_partkey"}
# Rows of such a table that one task works on.
ROWS_A_TASK = 5000

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# (kind, ord, key, value expression, condition or None) over a `part` row.
SPEC_ROWS = [
    ("specs", 1, "depth", "cast(p_size as string) || 'cm'", None),
    ("specs", 2, "depth_cm", "cast(p_size + 1 as string)", "p_partkey % 4 = 0"),
    ("specs", 3, "width", "cast(p_size * 10 + 5 as string) || ' mm'", None),
    ("specs", 4, "weight", "cast(p_partkey % 30 + 1 as string) || ',5 kg'", None),
    ("specs", 5, "spin_speed", "cast(800 + 100 * (p_partkey % 9) as string) || ' RPM'", None),
    ("specs", 6, "supply", "'220-240V'", None),
    ("specs", 7, "energy_rating", "'A to G'", None),
    ("specs", 8, "colour", "case p_partkey % 3 when 0 then 'Black' when 1 then 'black' else 'Silver' end", None),
    ("specs", 9, "drum_light", "case p_partkey % 2 when 0 then 'Yes' else 'No' end", None),
    ("specs", 10, "capacity", "cast(p_size as string) || ' litres'", "p_partkey % 2 = 0"),
    ("specs", 11, "capacity_value", "cast(p_size as string)", "p_partkey % 3 = 0"),
    ("specs", 12, "rare_key", "'x'", "p_partkey % 50 = 0"),
    ("features", 1, "smart", "case when p_partkey % 4 = 0 then 'Yes' else 'No' end", None),
    ("features", 2, "timer", "'Yes'", None),
    ("features", 3, "timer_function", "'Yes'", "p_partkey % 5 = 0"),
    ("features", 4, "programmes", "cast(p_size as string)", None),
    ("features", 5, "autodose", "case p_partkey % 3 when 0 then 'Ja' when 1 then 'Nee' else 'Yes' end", None),
]

# A second source for every part: agrees, conflicts, adds aliases, and adds keys.
EXTRA_ROWS = [
    ("specs", 1, "depth", "cast(p_size + 3 as string) || 'cm'", None),
    ("specs", 2, "noise_level", "cast(p_partkey % 40 + 30 as string) || ' dB'", None),
    ("specs", 3, "depth_centimeters", "cast(p_size + 2 as string)", "p_partkey % 3 = 0"),
    ("specs", 4, "special_feature", "'Quick wash, Steam'", "p_partkey % 6 = 0"),
    ("specs", 5, "drum_light", "'Maybe'", "p_partkey % 7 = 0"),
    ("features", 1, "smart", "'No'", None),
    ("features", 2, "drum_light", "case when p_partkey % 2 = 0 then 'Yes' else 'Sometimes' end", "p_partkey % 4 = 1"),
    ("features", 3, "steam", "'Yes'", None),
]


def spark_row_array(rows) -> str:
    """Array of the (kind, ord, key, value) structs that apply to a `part` row."""
    structs = ", ".join(
        f"{'if(' + when + ', ' if when else ''}named_struct('kind', '{kind}', 'ord', {ord_}L, 'key', '{key}', "
        f"'value', {value}){', null)' if when else ''}"
        for kind, ord_, key, value, when in rows
    )
    return f"filter(array({structs}), r -> r is not null)"


def _sql_rows(rows, extra: str = "") -> str:
    return " union all ".join(
        f"select p_partkey as product_id, '{kind}' as kind, cast({ord_} as bigint) as ord, '{key}' as key, "
        f"{value} as value{extra} from part{' where ' + when if when else ''}"
        for kind, ord_, key, value, when in rows
    )


def _html_table(rows) -> str:
    cells = " || ".join(
        (f"case when {when} then " if when else "")
        + f"'<tr><td><span class=\"Header\">{key.replace('_', ' ').title()}:</span></td>"
        + f"<td><span class=\"BodyText\">' || {value} || '</span></td></tr>'"
        + (" else '' end" if when else "")
        for _, _, key, value, when in rows
    )
    return cells


_SPECS_HTML = _html_table([r for r in SPEC_ROWS if r[0] == "specs"])
_FEATURES_HTML = _html_table([r for r in SPEC_ROWS if r[0] == "features"])

PRODUCT_SQL = """
select p_partkey as product_id, cast(p_size % 5 + 1 as bigint) as category_id,
       p_brand || ' ' || p_name || ' MX' || cast(p_partkey as string) as name,
       p_brand as brand, p_retailprice as price,
       case when p_partkey % 11 = 0 then 'n/a'
            else '£' || cast(p_retailprice as string) || 'Typical price' end as price_text,
       case when p_partkey % 13 = 0 then null else cast(p_partkey % 101 as double) end as score
from part"""

OFFER_SQL = """
select product_id, source_id,
       cast(row_number() over (partition by product_id order by source_id) as bigint) as rnk,
       cast(cast(round(p_retailprice * 100) as bigint)
            * case when source_id % 17 = 0 then 500 else 90 + (source_id % 7) * 5 end as double) / 10000 as price
from (select distinct l_partkey as product_id, l_suppkey as source_id from lineitem) o
join part on p_partkey = product_id"""

REVIEW_SQL = """
select l_partkey as product_id,
       l_orderkey * 100000 + l_suppkey * 10 + l_linenumber as review_id,
       cast(1 + cast(l_quantity as int) % 5 as double) as stars,
       'Review of line ' || cast(l_linenumber as string) || ' shipped ' || l_returnflag as body
from lineitem"""

METRICS_SQL = """
select event_id as search_id, cast(user_id % 5 + 1 as bigint) as category_id, event_type as query_text,
       value * 10 as execution_time_ms, event_id % 3 = 0 as cache_hit, ts as created_at
from events"""

# Every page knows one observed hop unless its id is a multiple of three; some targets are relative.
REDIRECT_SQL = """
select 'https://r.example.com/u' || cast(page_id as string) as src,
       case when page_id % 5 = 1 then '/u' || cast(cast(floor(page_id / 2.0) as bigint) as string)
            else 'https://r.example.com/u' || cast(cast(floor(page_id / 2.0) as bigint) as string) end as dst
from pages where page_id % 3 <> 0"""

DOC_SQL = """
select doc_id, lang, text || ' ' || cast(doc_id % 90 + 10 as string) || ' kg capacity: ' || cast(doc_id % 7 as string)
       || '. Was £1,' || cast(doc_id % 900 + 100 as string) || '.99 now £' || cast(1000 + doc_id % 777 as string)
       || ' or GBP ' || cast(doc_id % 50 as string) || ' or ' || cast(doc_id % 300 as string) || ' GBP' as text
from documents"""

HTML_SQL = f"""
select p_partkey as product_id,
       '<html><body><h3>Specifications</h3><table class="a">' || {_SPECS_HTML}
       || '<tr><td>Blank</td><td> </td></tr><tr><td>Dash</td><td>-</td></tr><tr><td>Missing</td><td>N/A</td></tr>'
       || '<tr><td>A</td><td>B</td><td>C</td></tr>'
       || '<tr><th>Wi-Fi &amp; App</th><td><svg data-icon="check"><path/></svg></td></tr>'
       || '<tr><th>Door (lock).</th><td><svg data-icon="xmark"></svg></td></tr>'
       || '<tr><td>Depth</td><td>' || cast(p_size as string) || ' cm &lt; 99</td></tr></table><p>x</p><table>'
       || {_FEATURES_HTML} || '</table></body></html>' as html
from part"""

# (ord, url expression, condition or None) over a `part` row.
IMAGE_ROWS = [
    (0, "'https://dam.example.com/' || p_name || '-rear-800x600.webp'", None),
    (1, "'https://dam.example.com/a' || cast(p_partkey as string) || '-side-front-800x600.webp'", "p_partkey % 2 = 0"),
    (2, "'https://dam.example.com/b' || cast(p_partkey as string) || '-front-800x600.webp'", None),
    (3, "'https://dam.example.com/b' || cast(p_partkey as string) || '-front-800x600.webp'", None),
    (4, "'https://dam.example.com/c-side-400x300.webp'", None),
    (5, "'https://dam.example.com/d' || cast(p_partkey as string) || '-side-800x600.webp'", None),
    (6, "'https://cdn.example.com/e-rear-800x600.png'", None),
]

ATTEMPT_SQL = """
select product_id, source_id, 'S' || cast(source_id % 6 as string) as source_name, rnk as ord,
       cast((product_id * 7 + source_id * 3) % 60 as bigint) as spec_count
from {fx_offer}"""

# Retailer links of a product, one per offer.
RETAILER_LINK_SQL = """
select product_id, rnk as ord,
       case source_id % 7 when 0 then 'AO' when 1 then 'Currys' when 2 then 'Appliances Direct'
            when 3 then 'Amazon Marketplace' when 4 then 'Argos' when 5 then 'boots kitchen appliances'
            else 'Unknown Store' end as name,
       case source_id % 6
            when 0 then 'https://www.amazon.co.uk/Some-Thing/dp/B0' || cast(10000000 + product_id as string)
                        || '?tag=t-21&ascsubtag=x&th=' || cast(source_id as string)
            when 1 then 'https://clicks.trx-hub.com/xid/c?q=https%3A%2F%2Fgo.digidip.net%2Fvisit%3Furl%3Dhttps%253A%252F%252Fwww.appliancesdirect.co.uk%252Fp%252F'
                        || cast(product_id as string)
            when 2 then 'https://visit.markselectrical.co.uk/click?a(1)url(https%3A%2F%2Fmarkselectrical.co.uk%2F'
                        || cast(product_id as string) || '%3Freferrer%3DT)'
            when 3 then 'https://ao.com/product/p' || cast(product_id as string) || '.aspx?utm_source=a#top'
            when 4 then 'https://www.ebay.co.uk/itm/' || cast(product_id as string) || '?mkevt=1&keep=2&campid=3'
            else 'https://www.shop' || cast(source_id as string) || '.example.com/p/' || cast(product_id as string)
                 || '?tag=1' end as url,
       price
from {fx_offer}"""

SHARED = {
    "fx_product": PRODUCT_SQL,
    "fx_offer": OFFER_SQL,
    "fx_review": REVIEW_SQL,
    "fx_metrics": METRICS_SQL,
    "fx_redirect": REDIRECT_SQL,
    "fx_link": "select page_id, url from pages",
    "fx_doc": DOC_SQL,
    "fx_html": HTML_SQL,
    "fx_attempt": ATTEMPT_SQL,
    "fx_retailer_link": RETAILER_LINK_SQL,
    # Free text becomes JSON-safe by keeping only letters, digits, blanks and points.
    "fx_reply": r"""
select conv_id, turn, regexp_replace(text, '[^A-Za-z0-9 .]', '_'{G}) as clean,
       case when (conv_id * 31 + turn) % 7 = 0 then 'Sorry, no result.'
            else 'Here you go: ```json' || chr(10) || '{"summary": "' || regexp_replace(text, '[^A-Za-z0-9 .]', '_'{G})
                 || '", "pros": ["' || role || '", "turn ' || cast(turn as string) || '"], "cons": '
                 || case when turn % 2 = 0 then '["none"]' else '"text"' end
                 || ', "themes": []' || case when conv_id % 9 = 0 then '' else ', "insights": "ok"' end
                 || case when (conv_id + turn) % 5 = 0 then ''
                         else ', "confidence": ' || cast(cast(conv_id % 15 as double) / 10 as string) end
                 || '}' || chr(10) || '```' end as reply
from conversations""",
    "fx_multi": r"""
select doc_id,
       'First {"a": ' || cast(doc_id as string) || '} then {"a": 1, "b": {"c": 2}, "d": "'
       || regexp_replace(text, '[^A-Za-z0-9 .]', '_'{G}) || '"} last {"x": 1, "y": 2, "z": ' || cast(doc_id % 3 as string)
       || '} and {broken: ' || cast(doc_id as string) || ', "p": 1, "q": 2, "r": 3, "s": 4}' as reply
from documents""",
    "fx_jsonld": """
select p_partkey as product_id,
       '<html><script type="application/ld+json">{"@type": "Organization", "name": "' || p_name || '"}</script>'
       || case when p_partkey % 9 = 0 then '<script type="application/ld+json">{broken</script>' else '' end
       || case when p_partkey % 4 = 3 then '' else
          '<script type="application/ld+json">{"@type": "Product", "aggregateRating": {"ratingValue": "'
          || cast(cast(p_partkey % 41 as double) / 10 + 1 as string) || '", "reviewCount": "' || cast(p_size * 3 as string)
          || '"}, "review": [{"reviewBody": "short"}, {"reviewBody": "Long enough body of part ' || p_name
          || '"}, {"reviewBody": "Another body number ' || cast(p_size as string) || '"}]}</script>' end
       || '<script type="application/ld+json">{"@type": "Product", "aggregateRating": {"ratingValue": "1", "reviewCount": "1"}, "review": [{"reviewBody": "Second block is ignored"}]}</script></html>' as html
from part""",
    "fx_rating_html": """
select p_partkey as product_id,
       case p_partkey % 4
         when 0 then '<div><span itemprop="ratingValue">' || cast(cast(p_size as double) / 10 as string)
              || '</span> <span itemprop="reviewCount">(' || cast(p_size * 30 as string) || ' reviews)</span></div>'
         when 1 then '<div><meta itemprop="ratingValue" content="' || cast(cast(p_size as double) / 10 as string)
              || '"><meta itemprop="reviewCount" content="' || cast(p_size as string) || '"></div>'
         when 2 then '<span data-hook="rating-out-of-text"> ' || cast(cast(p_size as double) / 10 as string)
              || ' out of 5</span><span id="acrCustomerReviewText">1,' || cast(p_size + 100 as string) || ' ratings</span>'
         else '<p>no reviews of ' || p_name || '</p>' end as html
from part""",
    "fx_card": """
select l_orderkey as page_id, cast(l_linenumber as bigint) as line,
       '<li class="item"><h3>' || p_name || chr(10) || chr(10) || ' MX' || cast(l_partkey as string) || '</h3>'
       || case when l_quantity > 48 then '' else '<span class="price">£' || cast(p_retailprice as string) || ' View retailers</span>' end
       || case when l_partkey % 10 = 0 then '' else '<a href="/reviews/p' || cast(l_partkey as string) || '">go</a>' end
       || '</li>' as card, l_partkey, l_suppkey, p_name, p_retailprice, l_quantity
from lineitem join part on p_partkey = l_partkey""",
}

# Views whose text differs between the engines.
SPARK_ONLY = {
    "fx_spec": f"select p_partkey as product_id, inline({spark_row_array(SPEC_ROWS)}) from part",
    "fx_extra_spec": f"select p_partkey as product_id, inline({spark_row_array(EXTRA_ROWS)}) from part",
    "fx_image": "select p_partkey as product_id, inline(filter(array("
    + ", ".join(
        f"if({when or 'true'}, named_struct('ord', {ord_}L, 'url', {url}), null)" for ord_, url, when in IMAGE_ROWS
    )
    + "), r -> r is not null)) from part",
    # One review blob per document: every line becomes one review.
    "fx_blob": r"""
select doc_id, 'Rating snapshot of ' || lang || ' ' || array_join(transform(split(text, chr(10)), (x, i) ->
       cast(1 + (doc_id + i) % 5 as string) || ' out of 5 stars. by user ' ||
       case when (doc_id + i) % 6 = 5 then 'never. ' else cast(i + 2 as string) || ' days ago ' end || x ||
       case (doc_id + i) % 3 when 0 then ' Yes, I would recommend.' when 1 then ' Originally posted on a site.' else '' end), ' ') as text
from documents""",
}
SQL_ONLY = {
    "fx_image": " union all ".join(
        f"select p_partkey as product_id, cast({ord_} as bigint) as ord, {url} as url from part"
        + (f" where {when}" if when else "")
        for ord_, url, when in IMAGE_ROWS
    ),
    "fx_spec": _sql_rows(SPEC_ROWS),
    "fx_extra_spec": _sql_rows(EXTRA_ROWS),
    "fx_blob": r"""
select doc_id, 'Rating snapshot of ' || lang || ' ' || array_to_string(list_transform(string_split(text, chr(10)), lambda x, i:
       cast(1 + (doc_id + i - 1) % 5 as varchar) || ' out of 5 stars. by user ' ||
       case when (doc_id + i - 1) % 6 = 5 then 'never. ' else cast(i + 1 as varchar) || ' days ago ' end || x ||
       case (doc_id + i - 1) % 3 when 0 then ' Yes, I would recommend.' when 1 then ' Originally posted on a site.' else '' end), ' ') as text
from documents""",
}


def spread(df: DataFrame, key: str, n_rows: int, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """The table of `n_rows` rows placed by its key, about `rows_a_task` rows a task.

    The files decide how many tasks read a table, and one task reads a file of a few megabytes however many rows it has.
    """
    tasks = -(-n_rows // rows_a_task)
    return df.repartition(tasks, key) if tasks > 1 else df


class Views:
    """Lazy DataFrames of the views over one directory of parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._rows: dict[str, int] = {}

    def table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in SPREAD:
            return df
        if name not in self._rows:
            # Reads no more than the files' footers.
            self._rows[name] = df.count()
        return spread(df, SPREAD[name], self._rows[name])

    def _view(self, name: str) -> DataFrame:
        text = SPARK_ONLY.get(name) or SHARED[name]
        text = text.replace("{G}", "")
        needed = set(re.findall(r"\{(fx_\w+)\}", text))
        frames = {n: self._view(n) for n in needed}
        for table in TABLES:
            text, hits = re.subn(rf"\b(from|join)\s+{table}\b", rf"\1 {{{table}}}", text)
            if hits:
                frames[table] = self.table(table)
        literals: dict[str, str] = {}

        def as_parameter(match: re.Match) -> str:
            # Braces inside string literals would read as parameters.
            if "{" not in match[1] and "}" not in match[1]:
                return match[0]
            literals[f"lit{len(literals)}"] = match[1]
            return f":lit{len(literals) - 1}"

        text = re.sub(r"'([^']*)'", as_parameter, text)
        return self.spark.sql(text, args=literals or None, **frames)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_"):
            return self._view(name)
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)


def sql_with_views(body: str) -> str:
    """Prefix `body` with the views it mentions, in dependency order."""
    texts = {**SHARED, **SQL_ONLY}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bfx_\w+", text):
            if name in texts and name not in ordered:
                visit(texts[name])
                ordered.append(name)

    visit(body)
    if not ordered:
        return body.strip()

    def plain(name: str) -> str:
        text = re.sub(r"\{(fx_\w+)\}", r"\1", texts[name]).replace("{G}", ", 'g'")
        return f"{name} as ({text})"

    views = ",\n".join(plain(name) for name in ordered)
    body = body.strip()
    if body.lower().startswith("with recursive"):
        return f"with recursive {views},\n{body[len('with recursive'):].strip()}"
    if body.lower().startswith("with "):
        return f"with {views},\n{body[5:].strip()}"
    return f"with {views}\n{body}"
