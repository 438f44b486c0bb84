"""Queries of the training-data operators over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmeta.llm import (
    exact_dedup,
    filter_audit,
    imatch,
    importance,
    kneser_ney,
    line_winnow,
    minhash_forest,
    packing,
    quality_rules,
    sentencepiece_codec,
    token_store,
    toxicity,
    warc_zip,
)
from crawlmeta.llm.common import held_out, shared_folder, table, written

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(documents(spark, sf_dir), public_tokenizers.path(PIECES))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), size=2048, end_id=0)


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_store.write_store(documents(spark, sf_dir), shared_folder(spark, "token-store"),
                                       public_tokenizers.path(BYTE_BPE), end_id=2)
    return token_store.read_store(manifest)


def op4_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_dedup(documents(spark, sf_dir), width=3, percent=85)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out().alias("held_out"),
                         toxicity.score_column(docs, model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality_rules.with_score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint(documents(spark, sf_dir))


def op9_line_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_winnow.dedup_lines(documents(spark, sf_dir))
    return done.select("doc_id", "n_lines", "deleted_lines", "deleted_words",
                       F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("text_sha256"))


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = kneser_ney.fit_identify(docs, shared_folder(spark, "language"))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op11_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "packages")
    packages = warc_zip.write(table(spark, sf_dir, "pages"), folder)
    records = written(warc_zip.read(packages, with_payload=False).drop("payload"), folder, "records")
    return warc_zip.resolved(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = importance.resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return made.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_token_store": op3_token_store,
    "op4_minhash_forest": op4_minhash_forest,
    "op5_toxicity": op5_toxicity,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_imatch": op8_imatch,
    "op9_line_winnow": op9_line_winnow,
    "op10_kneser_ney": op10_kneser_ney,
    "op11_warc_zip": op11_warc_zip,
    "op12_filter_audit": op12_filter_audit,
    "op13_importance_resampling": op13_importance_resampling,
}

_SPACES = r"'[\x20\x09-\x0D]+', ' ', 'g'"
ORACLE: dict[str, str] = {
    "op6_exact_dedup": f"""
        with d as (select doc_id, regexp_replace(coalesce(text, ''), {_SPACES}) as t from documents),
        g as (select t, min(doc_id) as keep_id, count(*) as group_size from d group by t)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256
        from d join g using (t)""",
    "op11_warc_zip": """
        with p as (select page_id, encode(coalesce(html, '')) as b from pages),
        g as (select page_id, octet_length(b) as n, sha1(b) as payload_digest,
                     case when octet_length(b) >= 1000 then max(page_id) over (partition by b) end as largest from p)
        select page_id, cast(n as bigint) as payload_bytes, payload_digest,
               case when largest is null or page_id = largest then 'response' else 'revisit' end as record_type,
               case when page_id <> largest then largest end as refers_to, cast(null as varchar) as error
        from g""",
    "op12_filter_audit": r"""
        with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
        w as (select doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
                     min(doc_id) over (partition by t) as first_id from d),
        l as (select doc_id, max(coalesce(quality, 0)) as quality, max(coalesce(toxic, 0)) as toxic
              from labels group by doc_id),
        f as (select part, len(ws) < 50 as a, 100 * len(list_distinct(ws)) < 65 * len(ws) as b,
                     100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) as c,
                     regexp_matches(t, '[#$%&*|]') as d, coalesce(doc_id > first_id, false) as e,
                     coalesce(quality = 1, false) as good, coalesce(toxic = 1, false) as toxic
              from w left join l using (doc_id)),
        cells as (select part, a, b, c, d, e, count(*) as n, count(*) filter (good) as n_good,
                         count(*) filter (toxic) as n_toxic from f group by all),
        letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
        orders as (select p.x || q.x || r.x || s.x || u.x as filter_order
                   from letters p, letters q, letters r, letters s, letters u
                   where len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
        steps as (select filter_order, step, substr(filter_order, step, 1) as letter,
                         substr(filter_order, 1, step - 1) as earlier
                  from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
        failed as (select *, (case when a then 'A' else '' end || case when b then 'B' else '' end ||
                              case when c then 'C' else '' end || case when d then 'D' else '' end ||
                              case when e then 'E' else '' end) as fails from cells),
        at_step as (select part, filter_order, step, letter, n, n_good, n_toxic, fails,
                           contains(fails, letter) as here,
                           earlier <> '' and translate(earlier, fails, '') <> earlier as gone
                    from failed, steps),
        sums as (select part, filter_order, cast(step as integer) as step, letter,
                        coalesce(sum(n) filter (not gone and not here), 0) as kept,
                        coalesce(sum(n) filter (not gone and here), 0) as removed,
                        coalesce(sum(n) filter (gone and here), 0) as redundant,
                        coalesce(sum(n) filter (fails = letter), 0) as unique_fails,
                        coalesce(sum(n_good) filter (not gone and here), 0) as good_lost,
                        coalesce(sum(n_toxic) filter (not gone and here), 0) as toxic_lost
                 from at_step group by all)
        select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
               cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
               cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
               cast(sum(removed) over (partition by part, letter) as bigint) as shapley
        from sums""",
}
