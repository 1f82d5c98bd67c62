"""The queries of the operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, ann, chroma, decontam, kmeans, langid, mixing, neardup, oracles, packing, pii, substring_dedup, tokens, urlfilter
from .common import session

VOCABULARY = "byte_bpe_50k.json"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(column: str, n: int):  # noqa: ANN201
    """crc32 of an id's decimal text, modulo n."""
    return F.crc32(F.col(column).cast("string")) % n


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removed(read(spark, sf_dir, "documents"), 50).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    filters = langid.fit(docs.where(bucket("doc_id", 5) != 0))
    found = langid.predict(docs, filters)
    return found.select("doc_id", F.coalesce(bucket("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "coverage")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read(spark, sf_dir, "documents"), tokens.named(VOCABULARY), 512)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlfilter.judge(read(spark, sf_dir, "pages").select("page_id", "url"), urlfilter.default_rules())
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_audio_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of kind member (vec_id, class_id) for every vector's recording, and of kind link between classes."""
    vectors = read(spark, sf_dir, "embeddings")
    asked = F.col("id") % 20 == 0
    members, links = chroma.search(chroma.fingerprints(chroma.melodies(vectors, "vec_id", "embedding"), "id", "audio", queries=asked), asked)
    none = F.lit(None)
    left = members.select(F.lit("member").alias("kind"), F.col("id").alias("vec_id"), "class_id", none.cast("bigint").alias("offset"), none.cast("bigint").alias("hits"), none.cast("double").alias("bit_error"))
    return left.unionByName(links.select(F.lit("link").alias("kind"), F.col("query_class").alias("vec_id"), F.col("match_class").alias("class_id"), "offset", "hits", "bit_error"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokens.named(VOCABULARY), 1024, 0)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(read(spark, sf_dir, "documents"), k=4, percent=80)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    fold = bucket("doc_id", 10)
    trained = F.coalesce(fold != 0, F.lit(False))
    model, counts = mixing.fit(docs.where(trained))
    found = mixing.scored(docs, model, counts, trained)
    return found.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(read(spark, sf_dir, "documents"))

    def digest(spans):  # noqa: ANN001, ANN202
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def n(kind: str):  # noqa: ANN202
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *map(n, ("email", "ip", "card", "phone")), F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans.with_inertia(*kmeans.cluster(read(spark, sf_dir, "embeddings"), k=8, rounds=10, d=64, scale=1024, seed="3:"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(read(spark, sf_dir, "documents"), align.named(VOCABULARY, "piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_decontaminate, op3_language_id, op4_token_counts, op5_url_filter, op6_audio_match, op7_packing, op8_near_duplicates, op9_lm_score, op10_pii, op11_nearest_neighbours, op12_centroid_clustering, op13_token_alignment)
}

ORACLES: dict[str, str] = {
    "op1_substring_dedup": oracles.SUBSTRING,
    "op2_decontaminate": oracles.CONTAINED,
    "op5_url_filter": oracles.URLS,
    "op8_near_duplicates": oracles.NEAR,
}
