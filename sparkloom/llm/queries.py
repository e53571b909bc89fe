"""The registered queries of this package and their SQL.

Each applies its operator to a whole table and derives the columns it returns
from what the operator gives.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import (
    exact_dedup,
    language,
    nbest,
    negatives,
    packing,
    pages,
    pii,
    quality,
    sharding,
    simhash,
    vectors,
    whitening,
    windows,
)
from sparkloom.llm.shared import read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

# Where the vocabulary files are; the operators take the path as a parameter.
WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"
SHARDS = [f"shard-{i:03d}" for i in range(64)]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


def _folded(text: str) -> str:
    """SQL: A-Z to lower case, other letters as they are."""
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query()
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query()
def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    extracted = pages.extract_text(read(spark, folder, "pages"))
    return extracted.withColumn("n_chars", F.length("text").cast("bigint"))


# The shards take turns in a recursive query, a claimed slot each step. The state
# is the list of taken slots and for each shard how far its wishes are tried.
_M, _N = sharding.SLOTS, len(SHARDS)


@query(f"""
    WITH RECURSIVE names AS (
        SELECT list(('0x' || substr(md5(printf('offset:shard-%03d', i)), 1, 15))::BIGINT % {_M} ORDER BY i) AS first,
               list(('0x' || substr(md5(printf('step:shard-%03d', i)), 1, 15))::BIGINT % {_M - 1} + 1 ORDER BY i) AS step
        FROM range({_N}) t(i)),
    turns(turn, slot, taken, tried) AS (
        SELECT 0, first[1], list_transform(range({_M}), lambda s: s = first[1]),
               list_transform(range({_N}), lambda i: CASE WHEN i = 0 THEN 1 ELSE 0 END)
        FROM names
        UNION ALL
        SELECT turn + 1, (f + wish * d) % {_M},
               list_concat(taken[:(f + wish * d) % {_M}], [true], taken[(f + wish * d) % {_M} + 2:]),
               list_concat(tried[:i], [wish + 1], tried[i + 2:])
        FROM (
            SELECT turn, taken, tried, i, f, d, tried[i + 1] - 1 + list_position(
                list_transform(range(tried[i + 1], {_M}), lambda j: taken[(f + j * d) % {_M} + 1]), false) AS wish
            FROM (SELECT turn, taken, tried, (turn + 1) % {_N} AS i,
                         first[(turn + 1) % {_N} + 1] AS f, step[(turn + 1) % {_N} + 1] AS d
                  FROM turns, names WHERE turn + 1 < {_M})))
    SELECT doc_id, slot, printf('shard-%03d', turn % {_N}) AS shard
    FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {_M} AS slot
          FROM documents)
    JOIN turns USING (slot)
""")
def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(read(spark, folder, "documents"), "doc_id", SHARDS).select(
        "doc_id", "slot", "shard"
    )


@query()
def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_groups(read(spark, folder, "documents"))
    return groups.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _spans(spans: str) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


@query()
def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_pii(read(spark, folder, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(_spans("base").cast("binary"), 256).alias("base_sha256"),
        _spans("spans").alias("spans"),
    )


@query(f"""
    WITH folded AS (SELECT doc_id, sha256({_folded('text')}) AS text_sha256 FROM documents),
    groups AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size
               FROM folded GROUP BY text_sha256)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
    FROM folded JOIN groups USING (text_sha256)
""")
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_dedup.exact_groups(read(spark, folder, "documents"), all_digests=True)
    return groups.withColumnRenamed("full_hash", "text_sha256")


@query()
def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), public_tokenizers.path(WORD_TOKENIZER))


@query()
def op8_sentencepiece_nbest(spark: SparkSession, folder: str) -> DataFrame:
    """The three best segmentations of each text: score, ids and their digest, and
    whether decoding them gives the text back."""
    documents = read(spark, folder, "documents")
    return nbest.encode(documents, public_tokenizers.path(PIECE_MODEL), digests=True)


@query()
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(read(spark, folder, "documents"))


@query()
def op10_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(read(spark, folder, "embeddings"))


@query()
def op12_order_preserving_packing(spark: SparkSession, folder: str) -> DataFrame:
    return windows.pack_windows(read(spark, folder, "documents"), public_tokenizers.path(WORD_TOKENIZER))


@query()
def op11_hard_negative_mining(spark: SparkSession, folder: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    embeddings = read(spark, folder, "embeddings").withColumn("label", moved)
    return negatives.hard_negatives(embeddings, anchors=vec_id % 100 == 0, nameless=True)


@query()
def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read(spark, folder, "embeddings"))
