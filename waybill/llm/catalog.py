"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.common import table
from waybill.llm.decontaminate import leaks
from waybill.llm.fill_middle import fill_in_middle, restored
from waybill.llm.lengths import length_histogram
from waybill.llm.lexical import ranked
from waybill.llm.minhash import Near, near_duplicates
from waybill.llm.packing import packed
from waybill.llm.pieces import encoded
from waybill.llm.private import private_report
from waybill.llm.quality import quality_report
from waybill.llm.shards import kd_shards
from waybill.llm.substrings import repeats_removed
from waybill.llm.tools import linked_chats
from waybill.llm.urls import judged_urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query(r"""
    with w as (
        select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
    ), windows as (
        select doc_id, i, array_to_string(w[i:i + 7], ' ') as g
        from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from w where len(w) >= 8)
    ), twice as (
        select doc_id, i from windows qualify count(*) over (partition by doc_id, g) > 1
    ), repeats as (
        select doc_id, sum(least(8, coalesce(n - i, 8))) as n_repeat_words
        from (select doc_id, i, lead(i) over (partition by doc_id order by i) as n from twice) group by doc_id
    ), lines as (
        select doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as f from w
    ), base as (
        select doc_id, t, w, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
               cast(length(t) - length(translate(t, '#*$%&|<>', '')) as bigint) as n_symbols,
               cast(len(f) - len(list_distinct(f)) as bigint) as n_dup_lines,
               cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
        from w join lines using (doc_id) left join repeats using (doc_id)
    ), judged as (
        select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from base
    )
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           not base_failed and 10 * n_symbols <= n_words
           and 10 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) <= 5 * word_chars
           and 10 * (length(t) - length(translate(t, '!', ''))) <= 3 * n_words
           and word_chars between 2 * n_words and 20 * n_words
           and (n_dup_lines <= 3 or 10 * n_dup_lines <= 3 * len(string_split(t, chr(10))))
           and 10 * len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) <= 3 * n_words as kept
    from judged
""")
def op1_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_report(table(spark, d, "documents"))


@query()
def op2_kd_shards(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    placed = kd_shards(docs, ["lang", "source", "n_chars", "doc_id"], shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query(r"""
    with recursive w as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') as w from documents
    ), s as (
        select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
               else list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) end as s from w
    ), sets as (
        select s, min(doc_id) as k, len(s) as n from (select doc_id, list_sort(s) as s from s) where len(s) > 0 group by s
    ), inv as (
        select k, n, unnest(s) as g from sets
    ), pairs as (
        select x.k as a, y.k as b from inv x join inv y on x.g = y.g and x.k < y.k and 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
        group by x.k, y.k, x.n, y.n having 100 * count(*) >= 85 * (x.n + y.n - count(*))
    ), linked as (
        select a, b from pairs union all select b, a from pairs
    ), walk as (
        select k, k as to_ from sets union select w.k, b.b from walk w join linked b on b.a = w.to_
    ), roots as (
        select k, min(to_) as root from walk group by k
    )
    select s.doc_id, cast(len(s.s) as bigint) as n_shingles, coalesce(root, s.doc_id) as component_id,
           s.doc_id = coalesce(root, s.doc_id) as kept
    from (select doc_id, list_sort(s) as s from s) s left join sets on sets.s = s.s left join roots using (k)
""")
def op3_minhash_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(table(spark, d, "documents"), Near())


@query()
def op4_packing(spark: SparkSession, d: str) -> DataFrame:
    return packed(table(spark, d, "documents"), added=True)


@query(r"""
    with u as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
    p as (
        select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
               regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) as path from u
    ), r(rule, said, h, pre) as (
        values ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
               ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')
    )
    select page_id, host, path, rule, coalesce(said, 'allow') as verdict
    from p left join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, pre)
    qualify row_number() over (partition by page_id order by length(rule) desc nulls last) = 1
""")
def op5_url_aliases(spark: SparkSession, d: str) -> DataFrame:
    """The SQL leaves out aliases: the given pages hold no canonical links or redirects; tests plant them."""
    return judged_urls(table(spark, d, "pages"))


@query(r"""
    select conv_id, turn, cast(null as integer) as step, cast(0 as integer) as place, role, cast(null as varchar) as call_id,
           'message' as status, cast(null as varchar) as problem,
           '{"content":' || cast(to_json(coalesce(text, '')) as varchar) || ',"role":' || coalesce(cast(to_json(role) as varchar), 'null')
           || ',"turn":' || coalesce(cast(turn as varchar), 'null') || '}' as json
    from conversations
""")
def op6_tool_calls(spark: SparkSession, d: str) -> DataFrame:
    """The SQL leaves out calls: the given conversations hold none; tests plant them."""
    return linked_chats(table(spark, d, "conversations"))


@query(r"""
    with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
    g as (
        select doc_id, i, array_to_string(w[i:i + 19], ' ') as g
        from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from w where len(w) >= 20)
    ), late as (
        select doc_id, i from g qualify row_number() over (partition by g order by doc_id, i) > 1
    ), gone as (
        select distinct doc_id, p from (select doc_id, unnest(range(i, i + 20)) as p from late)
    ), each as (
        select doc_id, w, unnest(range(1, len(w) + 1)) as p from w
    ), kept as (
        select e.doc_id, string_agg(w[p], ' ' order by p) as t, count(*) as n
        from each e anti join gone g on e.doc_id = g.doc_id and e.p = g.p group by e.doc_id
    )
    select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
           sha256(coalesce(t, '')) as kept_sha256
    from w left join kept using (doc_id)
""")
def op7_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return repeats_removed(table(spark, d, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op8_private_data(spark: SparkSession, d: str) -> DataFrame:
    return private_report(table(spark, d, "documents"))


@query()
def op9_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return leaks(table(spark, d, "documents"), table(spark, d, "benchmark")).drop("text_mark")


@query()
def op10_token_lengths(spark: SparkSession, d: str) -> DataFrame:
    return length_histogram(table(spark, d, "documents"), added=True)


@query(r"""
    with d as (
        select doc_id, w, len(w) as n from (
            select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents)
        where len(w) > 0
    ), c as (
        select count(*) as docs, cast(sum(n) as bigint) as l from d
    ), m as (
        select doc_id, 100 - 75 + (75 * n * docs) // l as m from d, c
    ), tf as (
        select doc_id, term, count(*) as tf from (select doc_id, unnest(w) as term from d) group by all
    ), v as (
        select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint) as w
        from (select term, count(*) as df from tf group by term), c
    ), q as (
        select item_id, term, count(*) as r from (
            select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
        group by all
    ), s as (
        select item_id, doc_id, cast(sum(r * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
        from q join v using (term) join tf using (term) join m using (doc_id) group by all
    )
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
    from s where score > 0 qualify rank <= 10
""")
def op11_lexical_search(spark: SparkSession, d: str) -> DataFrame:
    return ranked(table(spark, d, "documents"), table(spark, d, "benchmark"), top=10)


@query(r"""
    with u as (
        select doc_id, coalesce(text, '') as t, sha256('42:' || cast(doc_id as varchar)) as h,
               regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u
        from documents
    ), k as (
        select *, ('0x' || h[1:8])::bigint % (len(u) + 1) as a, ('0x' || h[9:16])::bigint % (len(u) + 1) as b,
               case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
                         or ('0x' || h[17:24])::bigint % 100 >= 50 then 'plain'
                    when ('0x' || h[25:32])::bigint % 100 < 80 then 'spm' else 'psm' end as form from u
    ), cut as (
        select *, array_to_string(u[1:least(a, b)], '') as p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as m,
               array_to_string(u[greatest(a, b) + 1:], '') as s from k
    )
    select doc_id, cast(len(u) as bigint) as n, form,
           case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
           case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
           sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                  else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
           sha256(t) as restored_sha256
    from cut
""")
def op12_fill_in_middle(spark: SparkSession, d: str) -> DataFrame:
    cut = fill_in_middle(table(spark, d, "documents"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query()
def op13_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    """``spans_mark`` is a hash of the source bytes that the pieces come from."""
    pieces = encoded(table(spark, d, "documents"), decoded=True)
    return pieces.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), F.xxhash64("starts", "ends").alias("spans_mark"))
