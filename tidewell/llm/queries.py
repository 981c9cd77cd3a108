"""The registered queries of the subpackage, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import (
    centroids,
    conversations,
    exact,
    fracsketch,
    html,
    language,
    mixing,
    oracles,
    phrases,
    pieces,
    repeats,
    shards,
    simhash,
    surrogates,
)
from tidewell.session import apply_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


SURROGATE_KEY = b"a key for the given tables"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and small Arrow batches, since texts may be very long."""
    apply_settings(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def query(*tables: str, sql: str | None = None):
    """Register a function from given tables to a result under its own name."""

    def register(build: Callable[..., DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepared(spark)
            return build(*[spark.read.parquet(f"{folder}/{table}.parquet") for table in tables])

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


@query("pages")
def op1_main_text(pages: DataFrame) -> DataFrame:
    return html.extract(pages, html.trained(), ("page_id", "url"))


@query("documents")
def op2_simhash(docs: DataFrame) -> DataFrame:
    return simhash.near_duplicates(docs)


@query("documents")
def op3_language(docs: DataFrame) -> DataFrame:
    return language.identify(docs)


@query("documents")
def op4_surrogates(docs: DataFrame) -> DataFrame:
    """The key here is public; real work takes one from its own configuration."""
    return surrogates.replace(docs, SURROGATE_KEY)


@query("documents")
def op5_fingerprints(docs: DataFrame) -> DataFrame:
    return fracsketch.edited_likeness(docs)


@query("documents")
def op6_shards(docs: DataFrame) -> DataFrame:
    out = shards.assign(docs, 16)
    return out.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query(
    "documents",
    sql="""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op7_exact_dedup(docs: DataFrame) -> DataFrame:
    return exact.exact_groups(docs, keep="largest")


@query("documents")
def op8_mixing(docs: DataFrame) -> DataFrame:
    return mixing.taken_words(mixing.mix(docs)).select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken"
    )


@query("documents")
def op9_pieces(docs: DataFrame) -> DataFrame:
    return pieces.round_trip(docs, pieces.read_model(public_tokenizers.path("piece_bpe_32k.model")))


@query("documents")
def op10_substring_dedup(docs: DataFrame) -> DataFrame:
    return repeats.removal(docs).select(
        "doc_id",
        F.col("words").alias("n_words"),
        F.col("removed").alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("conversations", sql=oracles.conversations())
def op11_prefix_trie(turns: DataFrame) -> DataFrame:
    return conversations.prefix_trie(turns)


@query("embeddings", sql=oracles.centroids())
def op12_centroids(vectors: DataFrame) -> DataFrame:
    return centroids.clustered(vectors)


@query("documents", "benchmark", sql=oracles.phrases())
def op13_contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = phrases.contamination(docs, items)
    n_hit = F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0).cast("bigint"), lambda n, s: n + s["ends"] - s["starts"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("starts") > 0).alias("contaminated"),
    )
