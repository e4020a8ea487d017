"""The named queries of the text operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwake.llm import bpe_tree, decontaminate, licenses, line_templates, mixing, page_text, prefix_trie, quality, quality_rules, ranked_search, simhash_dedup, token_codes, warc
from cartwake.llm.common import on_workers, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            on_workers(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_token_codes")
def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_codes.encode_documents(docs, public_tokenizers.path(TOKENIZER), end_id=1).select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )


@query("op2_licenses")
def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents"), keep=["doc_id"]))


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, keep=["doc_id"]).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query("op4_decontaminate")
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.scan(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return marked.select(
        "doc_id", "n_words", "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )


# The query's own limits come from its contract, the other rules from the operator.
OP5_SQL = """
with w as (
  select doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as lines
  from documents),
g as (
  select *, row_number() over () as r,
    [words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] for i in range(1, len(words) - 1)] as grams
  from w),
places as (select r, unnest(range(1, len(grams) + 1)) as i, unnest(grams) as gram from g),
found as (select r, i, count(*) over (partition by r, gram) as n from places),
covered as (
  select r, sum(least(3, coalesce(i - before, 3))) as n_repeat_words
  from (select r, i, lag(i) over (partition by r order by i) as before from found where n > 1) group by r),
s as (
  select doc_id, text, lines, len(words) as n_words,
    len(text) - len(regexp_replace(text, '[^\\x20\\x09-\\x0D]', '', 'g')) as word_chars,
    len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from g left join covered using (r)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from s)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 10 * n_symbols > n_words or word_chars < 2 * n_words or word_chars > 20 * n_words
    or 2 * n_dup_lines > len(lines)
    or 2 * (len(text) - len(regexp_replace(text, '[A-Z]', '', 'g'))) > len(text)) as kept
from b"""


@query("op5_quality_rules", OP5_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = quality_rules.cascade(docs)
    return marked.select(
        "doc_id", *quality_rules.BASE,
        quality_rules.base_failed().alias("base_failed"),
        F.col("rejected_by").isNull().alias("kept"),
    )


@query("op6_simhash_dedup")
def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_dedup.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query("op7_line_templates")
def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )


@query("op8_mixing")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "uses")


@query("op9_page_text")
def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


OP10_SQL = """
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
f as (select *, min(page_id) over (partition by payload_digest) as first from p)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first then first end as refers_to
from f"""


@query("op10_warc", OP10_SQL)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


# crc32 of the decimal conv_id, bit by bit: 8 steps (-1) after each byte.
OP11_SQL = """
with own as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as place
  from conversations where conv_id is not null),
convs as (
  select c, c - c % 20 as head,
    xor(4294967295, list_reduce([4294967295::bigint] || flatten([[ascii(x)::bigint] || [-1::bigint for i in range(8)]
        for x in string_split(c::varchar, '')]),
      lambda s, x: case when x >= 0 then xor(s, x) when s & 1 = 1 then xor(s >> 1, 3988292384) else s >> 1 end)) % 4 as h
  from (select distinct c from own)),
turns as (
  select convs.c, 0 as part, place, role, text from convs join own on own.c = head where place < h
  union all
  select c, 1, place, role, text from own join convs using (c) where place >= h),
p as (
  select c, role, text, row_number() over w as depth,
    sha256(string_agg(sha256(role) || sha256(text), '') over (partition by c order by part, place rows unbounded preceding)) as k
  from turns window w as (partition by c order by part, place)),
every as (
  select c, depth, k, lag(k, 1, 'root') over (partition by c order by depth) as parent,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as words
  from p union all select c, 0, 'root', null, 0 from convs),
nodes as (
  select k, depth, min(parent) as parent, min(c) as conv_id, count(*) as n_convs, min(words) as words
  from every group by k, depth),
kids as (select parent as k, count(*) as n_children from nodes where depth > 0 group by parent),
v as (
  select nodes.*, coalesce(n_children, 0) as n_children, (n_convs - 1) * words as saved from nodes left join kids using (k)),
below as (
  select a.k, sum((v.n_children = 0)::bigint) as n_leaves, sum(saved) as saved_tokens
  from v join every a on a.c = v.conv_id and a.depth <= v.depth group by a.k),
ends as (
  select k, sha256(string_agg(c::varchar, ',' order by c)) as ends_sha256
  from (select k, c from every qualify row_number() over (partition by c order by depth desc) = 1) group by k)
select v.conv_id, v.depth::bigint as depth, up.conv_id as parent_conv_id, v.n_convs, v.n_children,
  n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, coalesce(ends_sha256, sha256('')) as ends_sha256
from v join below using (k) left join ends using (k) left join nodes up on up.k = v.parent"""


@query("op11_prefix_trie", OP11_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.shared_head_trie(table(spark, sf_dir, "conversations")).drop("k1", "k2")


@query("op13_bpe")
def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    done = bpe_tree.decode(bpe_tree.encode(table(spark, sf_dir, "documents"), path), path)
    return done.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


OP12_SQL = """
with d as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms, row_number() over () as r
  from documents),
s as (select count(*) as big_n, sum(len(terms))::bigint as big_l from d where len(terms) > 0),
tf as (select r, term, count(*) as tf from (select r, unnest(terms) as term from d) group by r, term),
q as (
  select item_id, row_number() over () as i, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms from benchmark),
qt as (select distinct i, unnest(terms) as term from q),
w as (
  select term, floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1)::double))::bigint as w
  from tf, s where term in (select term from qt) group by term),
m as (select r, doc_id, 100 - 50 + (50 * len(terms) * big_n) // big_l as m from d, s where len(terms) > 0),
scored as (
  select i, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
  from qt join w using (term) join tf using (term) join m using (r) group by i, doc_id, r having score > 0),
ranked as (
  select *, row_number() over (partition by i order by score desc, doc_id nulls last) as rank from scored)
select item_id, rank::int as rank, doc_id, score from ranked join q using (i) where rank <= 50"""


@query("op12_ranked_search", OP12_SQL)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.build_index(table(spark, sf_dir, "documents"))
    return ranked_search.search(index, table(spark, sf_dir, "benchmark"), k=50)
