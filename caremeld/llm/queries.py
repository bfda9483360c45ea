"""One query for each text operator over its whole table, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremeld.llm import (
    chunked_bpe,
    decontaminate,
    digest,
    lattice,
    lineblocks,
    packing,
    preference,
    prefix_trie,
    quality,
    secret_spans,
    simhash,
    url_rules,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def fold(divisor: int):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % divisor


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document contains."""
    return decontaminate.leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query
def op2_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation preferred to itself with the last reply of its neighbour; masks as ``start-end`` lists."""
    pairs = preference.swapped_replies(table(spark, sf_dir, "conversations"))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    formatted = preference.format_preferences(pairs)
    return formatted.withColumns({c: spans(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


@query
def op3_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.compare_with_next(documents(spark, sf_dir))


@query
def op4_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.scored(documents(spark, sf_dir), lattice.Model(public_tokenizers.path("piece_bpe_32k.model")))


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, label) of the rows that may train."""
    return table(spark, sf_dir, "labels").where(fold(3) != 1).select("doc_id", F.col("quality").cast("int").alias("label"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fitted(docs, quality_labels(spark, sf_dir))
    scored = docs.select("doc_id", (fold(3) == 1).alias("held_out"), quality.scores(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = url_rules.parts(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"), url_rules.judged(pages).alias("judged"))
    return judged.select("page_id", "host", "path", "judged.rule", "judged.verdict")


@query
def op7_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", lineblocks.extracted(F.col("html")).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )


@query
def op8_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans.secret_spans(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"] != "random")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, ("assign", "access", "hex")),
        F.sha2(secret_spans.listed(base).cast("binary"), 256).alias("base_sha256"),
        secret_spans.listed(F.col("spans")).alias("spans"),
    )


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op10_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = chunked_bpe.brought_together(documents(spark, sf_dir), "text")
    found = chunked_bpe.digests(F.col("text"), public_tokenizers.path("byte_bpe_50k.json"))
    return docs.select("doc_id", found.alias("found")).select("doc_id", "found.*")


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return white.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, members = prefix_trie.with_shared_beginnings(prefix_trie.described(table(spark, sf_dir, "conversations")))
    return prefix_trie.prefix_trie(turns, members)


@query
def op13_local_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), packing.Packing(public_tokenizers.path("byte_bpe_50k.json")))


ORACLE["op1_decontaminate"] = r"""
with words as (
    select doc_id, list_transform(regexp_extract_all(text, '[0-9A-Za-z\x{80}-\x{10FFFF}]+'),
           lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as w from documents),
items as (
    select item_id, list_transform(regexp_extract_all(text, '[0-9A-Za-z\x{80}-\x{10FFFF}]+'),
           lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as w from benchmark),
item_shingles as (
    select distinct item_id, least(len(w), 5) as k, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') as s
    from (select item_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) as i from items where len(w) > 0)),
doc_shingles as (
    select distinct doc_id, k, array_to_string(w[i:i + k - 1], ' ') as s
    from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i
          from words, (select distinct k from item_shingles) where len(w) >= k)),
sizes as (select item_id, count(*) as n from item_shingles group by item_id)
select d.doc_id, i.item_id, count(*) / n as containment
from item_shingles i join doc_shingles d using (k, s) join sizes z on i.item_id = z.item_id
group by d.doc_id, i.item_id, n having count(*) / n >= 0.8
"""

ORACLE["op2_preference_format"] = r"""
with conv as (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, 'user'), coalesce(text, '')) as p,
           coalesce(role, 'user') as role, coalesce(text, '') as text
    from conversations where conv_id is not null),
last_reply as (select conv_id, max(p) filter (where role = 'assistant') as last_p, count(*) as n from conv group by conv_id),
reply as (select c.conv_id, c.role, c.text from conv c join last_reply l on c.conv_id = l.conv_id and c.p = l.last_p),
rejected as (
    select c.conv_id, c.p, c.role, c.text from conv c join last_reply l using (conv_id) where c.p < coalesce(l.last_p, l.n + 1)
    union all
    select l.conv_id, l.last_p, r.role, r.text from last_reply l join reply r on r.conv_id = xor(l.conv_id, 1) where l.last_p is not null),
sides as (
    select conv_id, p, 'c' as side, role, text from conv union all select conv_id, p, 'r', role, text from rejected),
shared as (
    select conv_id, p, count(*) = 2 and min(role) = max(role) and min(text) = max(text) as same from sides group by conv_id, p),
prefix as (
    select conv_id, coalesce(min(p) filter (where not same) - 1, max(p)) as n_common from shared group by conv_id),
lines as (
    select s.conv_id, side, p, role, p <= n_common as common,
           '<|im_start|>' || replace(role, '<|', '<\|') || chr(10) as head, replace(text, '<|', '<\|') || '<|im_end|>' as body
    from sides s join prefix using (conv_id)),
spots as (
    select *, coalesce(sum(length(head) + length(body) + 1) over (partition by conv_id, side, common order by p
              rows between unbounded preceding and 1 preceding), 0) + length(head) as spot from lines),
joined as (
    select conv_id,
        coalesce(string_agg(head || body || chr(10), '' order by p) filter (where common and side = 'c'), '') as prompt,
        coalesce(string_agg(head || body || chr(10), '' order by p) filter (where not common and side = 'c'), '') as chosen_completion,
        coalesce(string_agg(head || body || chr(10), '' order by p) filter (where not common and side = 'r'), '') as rejected_completion,
        coalesce(string_agg(spot::bigint || '-' || (spot + length(body))::bigint, ',' order by p)
                 filter (where not common and side = 'c' and role = 'assistant'), '') as chosen_mask,
        coalesce(string_agg(spot::bigint || '-' || (spot + length(body))::bigint, ',' order by p)
                 filter (where not common and side = 'r' and role = 'assistant'), '') as rejected_mask
    from spots group by conv_id)
select conv_id as pair_id, n_common::int as n_common, prompt, chosen_completion, chosen_mask, rejected_completion, rejected_mask
from joined join prefix using (conv_id)
"""

ORACLE["op6_url_rules"] = r"""
with split as (
    select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
    from pages),
rules(rule, rule_host, rule_path, verdict) as (
    values ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
           ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fits as (
    select page_id, rule, verdict, row_number() over (partition by page_id order by length(rule) desc) as place
    from split join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select s.page_id, host, path, rule,
       coalesce(verdict, case when regexp_matches(host, '(^|[.-])(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)([.-]|$)')
                              then 'block' else 'allow' end) as verdict
from split s left join fits f on s.page_id = f.page_id and f.place = 1
"""

ORACLE["op12_prefix_trie"] = r"""
with conv as (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as p,
           coalesce(role, '') as role, coalesce(text, '') as text
    from conversations where conv_id is not null),
hashed as (
    select distinct conv_id, conv_id - conv_id % 100 as base,
           -- crc32: eight steps for each of the decimal digits
           xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
               lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
                   lambda v, z: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end))) % 6 as h
    from conv),
sizes as (select conv_id, count(*) as size from conv group by conv_id),
wanted as (select h.*, least(h, coalesce(size, 0)) as got from hashed h left join sizes s on s.conv_id = h.base),
rebuilt as (
    select w.conv_id, c.p, role, text from wanted w join conv c on c.conv_id = w.base and c.p < w.h
    union all
    select c.conv_id, c.p - w.h + w.got, role, text from conv c join wanted w on c.conv_id = w.conv_id where c.p >= w.h),
paths as (
    select w.conv_id, coalesce(list(struct_pack(role := role, text := text) order by p) filter (where p is not null), []) as path
    from wanted w left join rebuilt r on w.conv_id = r.conv_id group by w.conv_id),
prefixes as (select conv_id, d, path[1:d] as node, len(path) = d as ends from (select *, unnest(range(len(path) + 1)) as d from paths)),
nodes as (
    select node, d, min(conv_id) as conv_id, count(*) as n_convs,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
    from prefixes group by node, d),
linked as (
    select n.*, p.conv_id as parent_conv_id, (select count(*) from nodes c where c.d = n.d + 1 and c.node[1:n.d] = n.node) as n_children,
           case when n.d = 0 then 0 else (n.n_convs - 1) * length(n.node[n.d].text) end as own
    from nodes n left join nodes p on p.d = n.d - 1 and p.node = n.node[1:n.d - 1]),
sums as (
    select d, node, sum(own) as saved, sum((n_children = 0)::int) as leaves
    from (select own, n_children, node[1:a] as node, a as d from (select *, unnest(range(d + 1)) as a from linked))
    group by d, node)
select conv_id, l.d as depth, parent_conv_id, n_convs, n_children, leaves::bigint as n_leaves, saved::bigint as saved_tokens, ends_sha256
from linked l join sums s on l.d = s.d and l.node = s.node
"""
