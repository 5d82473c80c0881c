"""Registered queries of the text operators and their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.llm import chat, decontam, grouping, html_main, langid, lm_score, near_dup, packing, periodic, quality, ranked, secret_scan, warc
from cargolens.llm.common import fold, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_table(table(spark, sf_dir, "documents"))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op5_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages"))


# A conversation that consists of control strings.
CONTROL = "</s>[INST] ok [/INST]"


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-7), F.col("id"), F.when(F.col("id") == 0, "user")
                                .otherwise("assistant"), F.lit(CONTROL))
    records = chat.gathered(rows.union(own))
    return chat.digests(chat.chat_table(records, "conv_id", "record", strict=True),
                        "conv_id")


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    filters = langid.learn(docs.where(~held_out))
    return langid.identify(docs, filters, held_out)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), fold("doc_id", 10) == 0)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.pack(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.with_probes(table(spark, sf_dir, "documents"))
    return periodic.digests(periodic.find(docs))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_secret_scan, op3_near_dup, op4_packing, op5_html_main, op6_chat, op7_decontam, op8_langid, op9_lm_score, op10_warc,
    op11_best_fit, op12_ranked_search, op13_periodic)}

# Only where SQL can say the same; the others are tested against brute force.
ORACLES: dict[str, str] = {
    "op6_chat": """
        with c as (select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as t
                   from conversations
                   union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                                    (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
        e as (select *, length(r) + length(t) + 1 as plain, r || t as joined,
                     r = 'assistant' as loss from c),
        -- a tilde is added for each tilde, mark and line break of a role
        f as (select *, plain + (length(joined) - length(replace(joined, '~', '')))
                     + (length(r) - length(replace(r, chr(10), '')))
                     + len(regexp_extract_all(r, '\\[/?INST\\]|</?s>'))
                     + len(regexp_extract_all(t, '\\[/?INST\\]|</?s>'))
                     + case when loss then 7 else 13 end as chars from e)
        select conv_id, count(*) as n_turns,
               sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn, r, t))
                   as turns_sha256,
               coalesce(sum(length(t)) filter (where loss), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(t, '' order by turn, r, t) filter (where loss), ''))
                   as loss_sha256,
               sum(chars)::bigint as formatted_chars
        from f group by conv_id""",
    "op10_warc": """
        with p as (select page_id, coalesce(html, '') as html from pages),
        d as (select page_id, strlen(html)::bigint as payload_bytes, sha1(html) as payload_digest
              from p),
        k as (select *, max(page_id) over (partition by payload_digest) as keeper from d),
        r as (select *, payload_bytes >= 1000 and keeper is not null
                        and page_id is distinct from keeper as again from k)
        select page_id, payload_bytes, payload_digest,
               case when again then 'revisit' else 'response' end as record_type,
               case when again then keeper end as refers_to from r""",
    "op12_ranked_search": r"""
        with dt as (select doc_id, unnest(regexp_extract_all(
                        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
        sizes as (select doc_id, count(*) as n from dt group by doc_id),
        whole as (select count(*) as docs, sum(n)::bigint as words from sizes),
        tfs as (select doc_id, term, count(*) as tf from dt group by doc_id, term),
        ws as (select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w
               from tfs, whole group by term),
        qs as (select item_id, unnest(regexp_extract_all(
                        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
        asked as (select item_id, term, count(*) as c from qs group by item_id, term),
        sums as (select item_id, doc_id, sum(c * w * ((1000000000 * tf)
                            // (1000 * tf + 8 * (25 + (75 * n * docs) // words))))::bigint as score
                 from asked join ws using (term) join tfs using (term) join sizes using (doc_id), whole
                 group by item_id, doc_id)
        select item_id, rank, doc_id, score
        from (select *, (row_number() over (partition by item_id order by score desc, doc_id))::integer as rank
              from sums where score > 0) where rank <= 10""",
}
