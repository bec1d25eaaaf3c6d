"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from inkrank.llm import conversations, debruijn, decontaminate, neighbours, packing, pii, quality, secrets, sharding, simhash, sql, suffixes, token_files, vector_codes
from inkrank.llm.common import ship
from inkrank.session import scratch_path

# Fixed value of the contract of op11.
SHARDS = 8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.removable(_documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x.last - x.first)
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(_documents(spark, sf_dir))
    counts = [F.regexp_count("base", F.lit(f"{kind}:")).cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    manifest = token_files.write_token_files(_documents(spark, sf_dir), folder)
    return token_files.read_token_files(manifest, folder, keep_ids=False)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    found = decontaminate.contaminated(docs, _table(spark, sf_dir, "benchmark"))
    ids = F.array_join("item_ids", ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        "contaminated",
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"), keep_rows=False)
    return found.select("doc_id", "found.*")


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    asked = vectors.where(F.pmod("vec_id", F.lit(50)) == 0)
    return neighbours.search(neighbours.build_index(vectors), asked)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir))
    return found.select("doc_id", "fingerprint", "component_id")


def op8_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = debruijn.removable(_documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x.last - x.first)
    place = F.transform("spans", lambda x: F.concat_ws(":", x.first.cast("string"), x.last.cast("string")))
    return found.select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"), F.array_join(place, ",").alias("spans")
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_documents(spark, sf_dir))
    real = F.filter("findings", lambda x: x.score >= secrets.SECRET)
    place = F.transform(real, lambda x: F.concat_ws(":", x.start.cast("string"), x.end.cast("string")))
    return found.select(
        "doc_id",
        F.size("findings").cast("bigint").alias("n_candidates"),
        F.size(real).cast("bigint").alias("n_secrets"),
        F.array_join(place, ",").alias("spans"),
        F.array_max(F.transform("findings", lambda x: x.score)).alias("top_score"),
    )


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(_documents(spark, sf_dir)))


def op11_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_documents(spark, sf_dir).select("doc_id", "text"), SHARDS)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(_table(spark, sf_dir, "conversations")), times="times")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = vector_codes.compress(_table(spark, sf_dir, "embeddings"))
    components = ",".join(str(x) for x in books.ravel())
    return found.select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(sha256(components.encode()).hexdigest()).alias("codebooks_sha256"),
    )


Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    registered = [op1_suffix_array, op2_pii, op3_token_files, op4_decontamination, op5_quality, op6_nearest_neighbours, op7_simhash, op8_debruijn, op9_secrets, op10_best_fit_packing, op11_jump_shards, op12_conversation_repair, op13_vector_codes]
    named = {query.__name__: query for query in registered} | {"pipeline": corpus_pipeline.run}
    return {name: _shipped(query) for name, query in named.items()}


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def oracle_sql() -> dict[str, str]:
    return {
        "op1_suffix_array": sql.repeated_bytes(suffixes.WINDOW),
        "op4_decontamination": sql.contaminated(decontaminate.WINDOW, decontaminate.SHARE),
        "op8_debruijn": sql.repeated_words(debruijn.WINDOW),
        "op11_jump_shards": sql.jump_shards(SHARDS),
        "op12_conversation_repair": sql.conversation_repair(),
        "op13_vector_codes": sql.vector_codes(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS),
    }
