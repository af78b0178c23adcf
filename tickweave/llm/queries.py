"""Registered queries of the operators, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from tickweave.llm import bpe, convtrie, htmlcrf, langid, mining, mixing, qda, qualityrules, secretscan, simhash, tokencount, topk, warc
from tickweave.llm.common import prepare, read_table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.public_counts(read_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", simhash.hex16().alias("fingerprint"), "component_id")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.digests(read_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return qualityrules.judge(docs, qualityrules.fit(spark, docs, read_table(spark, sf_dir, "labels")))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.positions(read_table(spark, sf_dir, "documents"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.every_hundredth(read_table(spark, sf_dir, "embeddings"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlcrf.extract(read_table(spark, sf_dir, "pages"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return qda.classify(docs, qda.fit(spark, docs, read_table(spark, sf_dir, "labels")))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), bpe.public_bpe())


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.every_hundredth(read_table(spark, sf_dir, "embeddings"))


def op12_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digests(read_table(spark, sf_dir, "pages"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.fives(read_table(spark, sf_dir, "conversations"))


def _prepared(query):
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {f.__name__: _prepared(f) for f in (op1_language_id, op2_token_counts, op3_simhash, op4_secret_scan, op5_quality_rules,
                                   op6_source_mix, op7_exact_topk, op8_html_text, op9_quality_classifier, op10_byte_bpe,
                                   op11_hard_negatives, op12_warc_bundles, op13_conversation_trie)}


def _kind_sql(kind: str, order: int, pattern: str, group: int, least: int, flags: str = "") -> str:
    """Spans of one kind: matches are fenced, and every second part is one."""
    value = f"regexp_extract(p[i], '{pattern}', {group}{flags})" if group else "p[i]"
    fenced = f"regexp_replace(t, '{pattern}', chr(1) || '\\0' || chr(1), 'g{flags[3:4]}')"
    return f"""
    select doc_id, row, [{{'s': cast(coalesce(list_sum([length(x) for x in p[1:i-1]]), 0) as bigint), 'o': {order}, 'n': cast(length(p[i]) as bigint), 'k': '{kind}'}}
      for i in range(2, len(p) + 1, 2) if length({value}) >= {least}] as spans
    from (select doc_id, row, string_split({fenced}, chr(1)) as p from d)"""


def _secret_sql() -> str:
    kinds = []
    for order, r in enumerate(secretscan.RULES):
        pattern, flags = r.pattern, ""
        if pattern.startswith("(?i:"):
            pattern, flags = pattern[4:-1], ", 'i'"
        kinds.append(_kind_sql(r.kind, order, pattern.replace("'", "''"), r.group, r.least, flags))
    one = "list_aggregate([x.k || ':' || x.s || ':' || (x.s + x.n) for x in {}], 'string_agg', ',')"
    base = "[x for x in spans if x.o < 3]"
    count = lambda o: f"cast(len([x for x in spans if x.o = {o}]) as bigint)"
    return f"""
with d as (select doc_id, row_number() over () as row, replace(coalesce(text, ''), chr(1), chr(2)) as t from documents),
kinds as ({" union all ".join(kinds)}),
found as (select any_value(doc_id) as doc_id, row, list_sort(flatten(list(spans))) as spans from kinds group by row)
select doc_id, {count(0)} as n_assign, {count(1)} as n_access, {count(2)} as n_hex,
  sha256(coalesce({one.format(base)}, '')) as base_sha256, coalesce({one.format("spans")}, '') as spans
from found"""


SQL = {
    "op4_secret_scan": _secret_sql(),
    "op7_exact_topk": """
with fine as (
  select distinct vec_id, [floor(1024 * cast(x as double)) for x in embedding]::double[] as v from embeddings
  where vec_id is not null and len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
pairs as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
  from fine q join fine c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from pairs)
select query_id, rank, vec_id, score from ranked where rank <= 10""",
    "op11_hard_negatives": """
with fine as (
  select row_number() over () as row, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    [floor(256 * cast(x as double)) for x in embedding]::double[] as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
near as (
  select a.row, a.vec_id as anchor_id, a.label, a.v, p.vec_id as positive_id, cast(list_dot_product(a.v, p.v) as bigint) as positive_score, p.row as p_row
  from fine a join fine p on a.vec_id % 100 = 0 and a.label = p.label and a.row <> p.row
  qualify row_number() over (partition by a.row order by positive_score desc, p.vec_id, p.row) <= 5),
far as (
  select r.row, r.p_row, r.anchor_id, r.positive_id, r.positive_score, n.vec_id as negative_id, n.row as n_row,
    cast(list_dot_product(r.v, n.v) as bigint) as negative_score
  from near r join fine n on n.label <> r.label)
select anchor_id, positive_id, cast(row_number() over (partition by row, p_row order by negative_score desc, negative_id, n_row) as integer) as rank,
  negative_id, positive_score, negative_score
from far where 30 * positive_score <= 100 * negative_score and 100 * negative_score <= 90 * positive_score
qualify rank <= 10""",
    # base32: every five hex digits are four characters
    "op12_warc_bundles": """
with p as (select page_id, url, coalesce(html, '') as t, sha1(coalesce(html, '')) as h from pages),
g as (select *, max(page_id) over (partition by t) as first from p),
q as (select *, first is not null and (page_id is null or page_id < first) as copy,
  [cast('0x' || h[5 * i + 1 : 5 * i + 5] as bigint) for i in range(8)] as parts from g)
select page_id, url, cast(strlen(t) as bigint) as payload_bytes,
  list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((parts[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31 as integer) + 1, 1) for i in range(32)], 'string_agg', '') as payload_digest,
  case when copy then 'revisit' else 'response' end as record_type, case when copy then first end as refers_to
from q""",
    "op13_conversation_trie": """
with t as (
  select conv_id, coalesce(role, '') as r, coalesce(text, '') as t,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as pos
  from conversations where conv_id is not null),
c as (select conv_id, list({'r': r, 't': t, 'c': conv_id, 'p': pos} order by pos) as turns from t group by conv_id),
-- CRC-32, a bit at a time
h as (
  select conv_id, turns, xor(list_reduce([cast(4294967295 as bigint)] || [cast(ascii(x) as bigint) for x in string_split(cast(conv_id as varchar), '')],
    lambda s, x: list_reduce([xor(s, x)] || [cast(0 as bigint) for i in range(8)],
      lambda a, b: case when a & 1 = 1 then xor(a >> 1, cast(3988292384 as bigint)) else a >> 1 end)), cast(4294967295 as bigint)) % 9 as h
  from c),
r as (
  select a.conv_id, coalesce(b.turns[1 : a.h], []) || a.turns[a.h + 1 :] as path
  from h a left join c b on b.conv_id = a.conv_id - a.conv_id % 5),
p as (select conv_id, d as depth, path[1 : d] as path, [[x.r, x.t] for x in path[1 : d]] as prefix, len(path) = d as ends from r, unnest(range(0, len(path) + 1)) u(d)),
n as (
  select depth, prefix, min(conv_id) as conv_id, count(*) as n_convs, arg_min(path[depth], conv_id) as turn,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '')) as ends_sha256
  from p group by depth, prefix),
k as (select depth - 1 as depth, prefix[1 : depth - 1] as prefix, count(*) as n_children from n where depth > 0 group by all),
w as (
  select n.*, coalesce(k.n_children, 0) as n_children, coalesce((n.n_convs - 1) * strlen(n.prefix[n.depth][2]), 0) as saved
  from n left join k on n.depth = k.depth and n.prefix = k.prefix),
s as (
  select d as depth, prefix[1 : d] as prefix, cast(sum(saved) as bigint) as saved_tokens, count(*) filter (n_children = 0) as n_leaves
  from w, unnest(range(0, depth + 1)) u(d) group by all)
select w.conv_id, w.depth, u.conv_id as parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends_sha256,
  w.turn.c as turn_conv_id, w.turn.p as turn_position
from w join s on w.depth = s.depth and w.prefix = s.prefix
left join n u on u.depth = w.depth - 1 and u.prefix = w.prefix[1 : w.depth - 1]""",
}
