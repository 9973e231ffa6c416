"""The queries ``opN_<name>`` over the driver's tables, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    chat_format,
    decontaminate,
    fingerprints,
    html_text,
    language_id,
    near_dedup,
    quality_classifier,
    quality_rules,
    sharding,
    vector_codes,
    warc,
    whitening,
)
from .stage import documents, held_out, ship

SHARDS = 64
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ranks() -> dict[bytes, int]:
    return byte_bpe.read_ranks(public_tokenizers.path(VOCABULARY))


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", "n_chars")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id")
    return sharding.assign(docs, sharding.shard_names(SHARDS))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), spec=near_dedup.Spec(words=2))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return byte_bpe.digests(docs, ranks(), public_tokenizers.PATTERN)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language_id.train(docs.where(~held_out(F.col("doc_id"))))
    found = language_id.identify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(
        documents(spark, sf_dir), _table(spark, sf_dir, "labels")
    ).drop("lang", "n_lines")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = chat_format.transcripts(_table(spark, sf_dir, "conversations"))
    model = chat_format.train(lines.where(~held_out(F.col("conv_id"))))
    return chat_format.render(
        lines.drop("role", "first"), model, part=F.floor(F.col("turn") / 64)
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"), payloads=False).drop("payload")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    ranker = quality_classifier.train(docs, labels)
    scored = quality_classifier.classify(docs, ranker)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings")).drop("label")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.edits(documents(spark, sf_dir))
    prints = ("fingerprint", "edited_fingerprint")
    in_lines = {c: F.base64(c) for c in prints}
    return found.withColumns({c: F.replace(v, F.lit("\r\n"), F.lit("")) for c, v in in_lines.items()})


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_html_text, op2_sharding, op3_near_dedup, op4_decontaminate, op5_byte_bpe,
        op6_language_id, op7_quality_rules, op8_chat_format, op9_warc, op10_quality_classifier,
        op11_vector_codes, op12_whitening, op13_fingerprints,
    )
    return {query.__name__: _shipped(query) for query in found}


def _sharding_sql() -> str:
    """The table filled in SQL would be a recursion over its slots; it is given as values."""
    size = sharding.table_size(SHARDS)
    table = sharding.fill(sharding.shard_names(SHARDS), size)
    return f"""
        select d.doc_id, d.slot, cast(t.tab[d.slot + 1] as int) shard
        from (select doc_id, cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15))
                                  as bigint) % {size} slot
              from documents) d, (select {table} tab) t"""


_WARC_SQL = """
    with own as (
        select page_id, url, encode(coalesce(html, '')) payload from pages
    ), sized as (
        select page_id, url, octet_length(payload) payload_bytes, sha1(payload) payload_digest
        from own
    ), planned as (
        select *, case when payload_bytes >= 1000 then
                      max(page_id) over (partition by payload_digest) end response
        from sized
    )
    select page_id, url, cast(payload_bytes as bigint) payload_bytes, payload_digest,
           case when response is not null and page_id is distinct from response
                then 'revisit' else 'response' end record_type,
           case when page_id is distinct from response then response end refers_to
    from planned"""


def _codes_sql() -> str:
    """All entries are compared with all parts, round by round."""
    spec = vector_codes.Spec()
    nearest = """
        near{i} as materialized (
            select n, p, arg_min(e, d * 1000 + e) e, min(d) d
            from (select x.n, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v),
                         lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint d
                  from parts x join books{i} b on x.p = b.p) q
            group by n, p)"""
    updated = """
        means{j} as (
            select p, e, list(m order by i) v
            from (select a.p, a.e, g.i, cast(floor(sum(x.v[g.i]) / count(*)) as bigint) m
                  from near{i} a join parts x on x.n = a.n and x.p = a.p,
                       (select unnest(range(1, len(v) + 1)) i from (select v from parts limit 1) w) g
                  group by 1, 2, 3) q
            group by p, e),
        books{j} as materialized (
            select b.p, b.e, coalesce(m.v, b.v) v
            from books{i} b left join means{j} m on m.p = b.p and m.e = b.e)"""
    rounds = [nearest.format(i=0)]
    for i in range(spec.rounds):
        rounds += [updated.format(i=i, j=i + 1), nearest.format(i=i + 1)]
    return f"""
        with whole as materialized (
            select vec_id, label, row_number() over (order by vec_id nulls last) n,
                   list_transform(embedding, lambda c: floor({spec.scale} * c::double)::bigint) x
            from embeddings
            where len(embedding) > 0
              and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
        parts as materialized (
            select n, p, x[p * (len(x) // {spec.parts}) + 1 : (p + 1) * (len(x) // {spec.parts})] v
            from whole, range({spec.parts}) r(p)),
        books0 as (select p, n - 1 e, v from parts where n <= {spec.entries}),
        {",".join(rounds)},
        coded as (
            select n, string_agg(printf('%02x', e), '' order by p) code, sum(d)::bigint error
            from near{spec.rounds} group by n),
        digest as (
            select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) h
            from books{spec.rounds})
        select vec_id, code, error,
               sum(error) over (partition by label)::bigint label_error, h codebooks_sha256
        from whole join coded using (n), digest"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_sharding": _sharding_sql(), "op9_warc": _WARC_SQL, "op11_vector_codes": _codes_sql(),
    }
