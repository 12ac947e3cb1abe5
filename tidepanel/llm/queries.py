"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidepanel.llm import ann, exact, html, langid, mixing, near, packing, quality, repeats, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive(_table(spark, sf_dir, "pages"), min_bytes=0, payloads=False)
    return read.selectExpr("cast(nullif(page_id, 'null') as bigint) as page_id", "payload_bytes", "payload_digest", "record_type", "cast(nullif(refers_to, 'null') as bigint) as refers_to")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.label(docs, langid.fit(docs))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), every=20, k=20)


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_classes(_table(spark, sf_dir, "documents"))


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"))


def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (op1_mix_sources, op2_warc_revisits, op3_exact_dedup, op4_quality, op5_language, op6_nearest, op7_pack, op8_near_dedup, op9_repeated_passages, op10_page_text)
    }


_DIGIT_GROUPS = " || ".join(f"lpad(upper(to_base(('0x' || substr(h, {1 + 10 * k}, 10))::BIGINT, 32)), 8, '0')" for k in range(4))

ORACLE_SQL = {
    "op2_warc_revisits": f"""
        with hashed as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as h from pages),
        named as (select page_id, payload_bytes, translate({_DIGIT_GROUPS}, '{warc.RADIX32}', '{warc.BASE32}') as payload_digest from hashed),
        ranked as (select *, min(page_id) over (partition by payload_digest) as original from named)
        select page_id, payload_bytes::BIGINT as payload_bytes, payload_digest,
               case when page_id = original then 'response' else 'revisit' end as record_type,
               case when page_id = original then null else original end as refers_to
        from ranked""",
    "op3_exact_dedup": """
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
        from documents window same as (partition by coalesce(text, ''))""",
}
