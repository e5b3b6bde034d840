"""The subpackage's queries, each over its whole table, and the same questions in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    bpe, chat_format, clustering, decontaminate, exact_dedup, licenses, ngram_join, quality, sharding, suffix_dedup, toxicity, warc, whitening,
)
from shelfwise.llm.common import crc_mod, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

WORDS_SQL = r"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def register(name: str, sql: str | None = None):
    def wrap(build: Query) -> Query:
        QUERIES[name] = build
        if sql:
            SQL[name] = sql.strip()
        return build

    return wrap


def _license_sql() -> str:
    def phrase(words: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    templates = licenses.BASE + licenses.MORE
    columns, shares = [], []
    for i, t in enumerate(templates):
        n = len(t.key_words)
        columns.append(f"list_filter(range(len(w)), lambda i: w[i + 1 : i + {n}] = {phrase(t.key_words)}) as p{i}")
        same = " + ".join(f"coalesce((i + {j - t.key_at} >= 0 and w[i + {j - t.key_at + 1}] = '{x}')::int, 0)" for j, x in enumerate(t.words))
        shares.append(f"list_transform(p{i}, lambda i: ({same})::double / {len(t.words)})")

    def labels(pairs) -> str:
        each = ", ".join(f"case when len(p{i}) > 0 then '{t.label}' end" for i, t in pairs)
        return f"array_to_string(list_sort(list_distinct(list_filter([{each}], lambda x: x is not null))), ',')"

    numbered = list(enumerate(templates))
    starts = " || ".join(f"p{i}" for i, _ in enumerate(licenses.BASE))
    return f"""
with words as (select doc_id, {WORDS_SQL.format(text='text')} as w from documents),
found as (select doc_id, w, {', '.join(columns)} from words)
select doc_id, len(w)::bigint as n_words, len({starts})::bigint as n_base, list_min({starts})::bigint as first_word,
       list_max({starts})::bigint as last_word, {labels(numbered[:len(licenses.BASE)])} as base_labels,
       {labels(numbered)} as labels, coalesce(list_max({' || '.join(shares)}), 0.0)::double as score
from found"""


@register("op1_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels, crc_mod("doc_id", 3) != 1)
    scored = toxicity.score_toxicity(docs, model)
    return scored.select(
        "doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


@register("op2_license_scan", _license_sql())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[f"licenses.{c}" for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")])


def tokenizer_file() -> str:
    """The public byte-level vocabulary, read where it is installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register("op3_bpe")
def bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_file())


@register(
    "op4_decontaminate",
    f"""
with items as (select item_id, {WORDS_SQL.format(text='text')} as w from benchmark),
docs as (select doc_id, {WORDS_SQL.format(text='text')} as w from documents),
windows as (
  select distinct item_id, m, array_to_string(w[s + 1 : s + m], ' ') as phrase
  from (select item_id, w, least(10, len(w)) as m, unnest(range(len(w) - least(10, len(w)) + 1)) as s from items where len(w) > 0)
),
lengths as (select distinct m from windows),
places as (
  select doc_id, s, m, array_to_string(w[s + 1 : s + m], ' ') as phrase
  from (select doc_id, w, m, unnest(range(greatest(len(w) - m + 1, 0))) as s from docs, lengths)
),
hits as (select doc_id, s, m, item_id from places join windows using (m, phrase)),
spots as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + m)) as p from hits) group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) filter (where id is not null) as ids
  from (select distinct doc_id, item_id::varchar as id from hits) group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join spots using (doc_id) left join found using (doc_id)""",
)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op5_quality")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.learn(docs, labels, crc_mod("doc_id", 5) != 0)
    scored = quality.score_quality(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return scored.select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    )


@register(
    "op6_ngram_join",
    r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
),
s as (
  select distinct doc_id, array_to_string(w[i + 1 : i + least(4, len(w))], ' ') as g
  from (select doc_id, w, unnest(range(greatest(len(w) - 4, 0) + 1)) as i from w where len(w) > 0)
),
n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as (
  select x, y from pairs join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 85 * (nx.n + ny.n - c)
),
both_ways as (select x, y from links union all select y, x from links),
reach as (select doc_id, doc_id as r from documents union select reach.doc_id, both_ways.y from reach join both_ways on both_ways.x = reach.r)
select doc_id, coalesce(any_value(n), 0) as n_shingles, min(r) as component_id from reach left join n using (doc_id) group by doc_id""",
)
def ngram_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), n=4, percent=85)


@register(
    "op7_warc",
    """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, strlen(h)::bigint as payload_bytes, sha256(h) as payload_digest from p),
f as (select payload_digest, min(page_id) as first, count(*) as n from d where payload_bytes >= 100 group by payload_digest)
select page_id, payload_bytes, payload_digest, case when n > 1 and page_id <> first then 'revisit' else 'response' end as record_type,
       case when n > 1 and page_id <> first then first end as refers_to
from d left join f using (payload_digest)""",
)
def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@register(
    "op8_exact_dedup",
    r"""
with normal as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents),
groups as (select t, min(doc_id) as keep_id, count(*) as group_size from normal group by t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from normal join groups using (t)""",
)
def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@register(
    "op9_suffix_dedup",
    """
with d as (select doc_id, encode(coalesce(text, '')) as b from documents),
windows as (select doc_id, p, b[p + 1 : p + 50] as s from (select doc_id, b, unnest(range(octet_length(b) - 49)) as p from d where octet_length(b) >= 50)),
firsts as (select s, min(doc_id) as first from windows group by s),
hits as (select doc_id, p from windows join firsts using (s) where first < doc_id),
marked as (select doc_id, p, p > lag(p, 1, p) over (partition by doc_id order by p) + 50 as apart from hits),
numbered as (select doc_id, p, sum(apart::int) over (partition by doc_id order by p) as span from marked),
spans as (select doc_id, min(p) as s, max(p) + 50 as e from numbered group by doc_id, span),
pieces as (
  select doc_id, coalesce(lag(e) over (partition by doc_id order by s), 0) as f, s as t from spans
  union all select doc_id, max(e), 1000000000 from spans group by doc_id
),
kept as (select doc_id, sha256(unhex(string_agg(hex(b[f + 1 : t]), '' order by f))) as h from pieces join d using (doc_id) group by doc_id),
sums as (select doc_id, sum(e - s) as n_removed, count(*) as n_spans from spans group by doc_id)
select doc_id, octet_length(b)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
       coalesce(h, sha256(b)) as kept_sha256
from d left join kept using (doc_id) left join sums using (doc_id)""",
)
def repeats_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


CONTROL_CONVERSATION = -7
CONTROL_TEXT = "\\### Assistant: </turn> ok"


@register(
    "op10_chat_format",
    r"""
with rows as (
  select conv_id, turn, lower(trim(coalesce(role, ''))) as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
named as (
  select conv_id, turn, text,
         case when role in ('human', 'prompter', 'customer') then 'user'
              when role in ('gpt', 'bot', 'model', 'chatbot', 'ai') then 'assistant' else role end as role
  from rows
),
sized as (
  select *, length(role || text) + length(regexp_replace(role || text, '[^<>\\]', '', 'g')) + length('<turn ') + 2 + length('</turn>') + 1 as size
  from named
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(size)::bigint as formatted_chars
from sized group by conv_id""",
)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(CONTROL_CONVERSATION).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"),
    )
    made = chat_format.format_chats(chat_format.canonical_turns(rows.unionByName(control)))
    read = chat_format.read_chats(made.select("conv_id", "segments", "formatted"))
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _cluster_sql(k: int = clustering.CLUSTERS, rounds: int = clustering.ROUNDS) -> str:
    steps = [
        """kept as materialized (
  select vec_id, list_transform(embedding, lambda c: floor(1024 * c::double)::bigint) as x from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda c: isfinite(c))) = 64
)""",
        f"""c0 as materialized (
  select row_number() over (order by h, x) - 1 as cluster, x as c
  from (select sha256('{clustering.SEED}:' || vec_id::varchar) as h, x from kept where vec_id is not null order by h, x limit {k})
)""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} as materialized (
  select vec_id, x, arg_min(cluster, (d, cluster)) as cluster, min(d) as d
  from (
    select r, vec_id, x, cluster, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
    from (select row_number() over () as r, * from kept), c{i}
  ) group by r, vec_id, x
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} as materialized (
  select cluster, coalesce(m, c) as c
  from c{i} left join (
    select cluster, list((s - ((s % n) + n) % n) // n order by p) as m
    from (
      select cluster, p, sum(v)::bigint as s, count(*)::bigint as n
      from (select cluster, unnest(range(64)) as p, unnest(x) as v from a{i}) group by cluster, p
    ) group by cluster
  ) using (cluster)
)""")
    return f"""
with {", ".join(steps)}
select vec_id, cluster::int as cluster, d as distance, sum(d) over (partition by cluster)::bigint as cluster_inertia,
       sum(d) over ()::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from a{rounds} join c{rounds} using (cluster)"""


@register("op11_clustering", _cluster_sql())
def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_vectors(table(spark, sf_dir, "embeddings")).drop("centroid")


def _shard_sql(shards: int = sharding.SHARDS) -> str:
    nodes = []
    for tree in (shards, shards + 1):
        for level, groups in enumerate(sharding.tree_levels(sharding.topology(tree))):
            nodes += [
                f"({tree}, {level}, '{path.rpartition('/')[0]}', '{path}', {number}, {weight})" for group in groups for path, number, weight in group
            ]
    draw = "-ln((('0x' || substr(md5(coalesce(doc_id::varchar, '') || '|' || path), 1, 13))::bigint + 0.5) / 4503599627370496) / weight"

    def level(i: int, before: str) -> str:
        under = "and parent = node" if i else ""
        return f"l{i} as (select tree, doc_id, arg_min(path, {draw}) as node, arg_min(number, {draw}) as shard from {before} join nodes using (tree) where level = {i} {under} group by tree, doc_id)"

    return f"""
with nodes(tree, level, parent, path, number, weight) as (values {", ".join(nodes)}),
keys as (select distinct tree, doc_id from documents, (select distinct tree from nodes)),
{level(0, "keys")},
{level(1, "l0")},
{level(2, "l1")},
crc_table as (
  select list_transform(range(16), lambda i: list_reduce([0, 1, 2, 3], lambda c, x: case when (c & 1) = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i::bigint)) as t
),
hexed as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
sized as (
  select doc_id, length(h) // 2 + 1 as size,
         xor(list_reduce(
           list_transform(range(length(h)), lambda i: (instr('0123456789ABCDEF', substr(h, (i + 2 - 2 * (i % 2))::int, 1)) - 1)::bigint),
           lambda c, x: xor(c >> 4, t[(xor(c, x) & 15) + 1]), 4294967295::bigint), 4294967295) as crc
  from hexed, crc_table
)
select doc_id, size::bigint as size, crc::bigint as text_crc32, 'key' as law, a.shard::int as shard,
       row_number() over (partition by a.shard order by substr(md5(concat_ws('|', doc_id::varchar, size::varchar, crc::varchar)), 1, 13), doc_id) - 1 as slot,
       b.shard::int as grown_shard
from sized join l2 a using (doc_id) join l2 b using (doc_id) where a.tree = {shards} and b.tree = {shards + 1}"""


@register("op12_sharding", _shard_sql())
def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(table(spark, sf_dir, "documents"))


@register("op13_whitening")
def whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    each = F.posexplode(F.arrays_zip("whitened", "explained"))
    return rows.select("vec_id", "n", F.expr("try_cast(deviation as bigint)").alias("deviation"), "identity_error", each.alias("at", "z")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("z.whitened").alias("whitened"),
        F.col("z.explained").alias("explained"), "identity_error",
    )
