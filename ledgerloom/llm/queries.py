"""The operators with production parameters, applied to whole tables, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import (
    common,
    exact,
    html_text,
    language,
    mixing,
    packing,
    pii,
    search,
    simhash,
    substrings,
    token_files,
    toxicity,
    vectors,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Stands for the secret that a user passes.
PSEUDONYM_KEY = "registered-query-key"


@_query
def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


@_query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, 64 bits, links at 4 or fewer differing bits, exactly."""
    docs = _table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs, words=4, radius=4)


@_query
def op3_consensus_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(_table(spark, sf_dir, "pages"))


@_query
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_strings(_table(spark, sf_dir, "documents")).drop("spans")


@_query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, sf_dir, "documents"), keep="largest")


ORACLE_SQL["op5_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@_query
def op8_orc_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    path = f"{common.shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    docs = _table(spark, sf_dir, "documents")
    token_files.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.layout(spark, path)


@_query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


@_query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the labelled rows that are not held out, applied to every row."""
    docs = _table(spark, sf_dir, "documents")
    return language.predict(docs, language.learn(docs.filter(~language.held_out())))


@_query
def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of 95 % of the highest entropy, no source more than four times, as many tokens as there are."""
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("text_hash")


@_query
def op9_spherical_cap_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors, links at a cosine of 0.93 or more between equal labels."""
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.93)


@_query
def op11_convolutional_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on labels that are not held out, languages learned from the same rows; every row is scored."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    languages = language.learn(docs.filter(~toxicity.held_out()))
    return toxicity.score(docs, toxicity.learn(docs, labels, languages), languages)


@_query
def op12_contour_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on the 16 strongest components."""
    return whitening.whitened(_table(spark, sf_dir, "embeddings"), wanted=16)


@_query
def op13_pair_bound_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item."""
    return search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), top=20)


_TERMS = (
    "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"
)
ORACLE_SQL["op13_pair_bound_search"] = f"""
WITH words AS (SELECT doc_id, {_TERMS} FROM documents),
     held AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
     sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
     corpus AS (SELECT count(*) AS docs, cast(sum(n) AS bigint) AS total FROM sizes),
     weights AS (
        SELECT term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS bigint) AS w
        FROM held, corpus GROUP BY term, docs),
     lengths AS (SELECT doc_id, 100 - 25 + (25 * n * docs) // total AS m FROM sizes, corpus),
     asked AS (
        SELECT item_id, term, count(*) AS times
        FROM (SELECT item_id, {_TERMS} FROM benchmark) GROUP BY ALL),
     scores AS (
        SELECT item_id, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS bigint) AS score
        FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) GROUP BY ALL)
SELECT item_id, cast(row_number() OVER best AS integer) AS rank, doc_id, score
FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY rank <= 20
"""
