"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, dac_tokens, decontaminate, exact_dedup, html_text, kk_shards, license_scan, mixing, simhash, spelling, substring_dedup, toxicity, url_rules
from .common import table

#: Listed URL rules of the query: what to do, host, path.
LISTED = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

SHARDS = 8


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    rules = url_rules.mine_rules(pages.select(F.col("page_id").alias("id"), "url"), labels)
    return url_rules.judge(pages, LISTED, rules).withColumnRenamed("id", "page_id")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False).withColumnRenamed("id", "doc_id")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_spans(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


def shards(docs: DataFrame) -> DataFrame:
    out = kk_shards.kk_shards(docs, SHARDS)
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_kk_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).withColumnRenamed("id", "doc_id")


def op8_dac_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = dac_tokens.write_dac(table(spark, sf_dir, "documents"), dac_tokens.token_files(spark), public_tokenizers.path("byte_bpe_50k.json"))
    return dac_tokens.read_dac(manifest).withColumnRenamed("id", "doc_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_summary(conversations.damaged(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.vocabulary(spelling.damaged(spelling.letter_runs(table(spark, sf_dir, "documents")))))


QUERIES = {f.__name__: f for f in (op1_url_rules, op2_exact_dedup, op3_substring_dedup, op4_license_scan, op5_decontaminate, op6_kk_shards, op7_toxicity, op8_dac_tokens, op9_simhash, op10_mixing, op11_conversation_repair, op12_html_text, op13_spelling)}

SQL = {
    "op2_exact_dedup": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
             row_number() OVER (PARTITION BY t, doc_id) AS twin FROM d)
SELECT doc_id, keep_id, group_size, (doc_id IS NOT DISTINCT FROM keep_id AND twin = 1) AS kept, sha256(t) AS text_sha256 FROM g""",
    "op3_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, len(ws) AS n, unnest(range(1, len(ws) + 1)) AS i, ws FROM d),
w AS (SELECT doc_id, i, ws[i] AS word, CASE WHEN i + 19 <= n THEN array_to_string(ws[i:i + 19], ' ') END AS s FROM p),
f AS (SELECT s, min(struct_pack(a := doc_id, b := i)) AS first FROM w WHERE s IS NOT NULL GROUP BY s),
m AS (SELECT w.doc_id, w.i, w.word, (f.first IS NOT NULL AND struct_pack(a := w.doc_id, b := w.i) > f.first) AS later FROM w LEFT JOIN f ON w.s = f.s),
c AS (SELECT doc_id, i, word, max(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM m),
k AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op10_mixing": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size::DOUBLE AS cap FROM s0),
s2 AS (SELECT *, cap / weight AS full_at, 1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE AS total FROM s1),
s3 AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY full_at, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
                 / sum(weight) OVER (ORDER BY full_at, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s2),
s4 AS (SELECT *, min_by(level, full_at) FILTER (WHERE level <= full_at) OVER () AS even FROM s3),
s5 AS (SELECT source, source_size, least(cap, coalesce(even * weight, cap)) AS target FROM s4),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0.0::DOUBLE END AS rate FROM s5)
SELECT d.doc_id, d.size, s6.source_size, s6.target,
       d.size * (floor(rate)::BIGINT + CASE WHEN ('0x' || substr(sha256('17:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source""",
}
