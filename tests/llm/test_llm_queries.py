import oracle
import pytest

import corpus_pipeline
from ledgerloom.llm import queries

RESULTS = {
    "op1_feistel_pseudonyms": {"doc_id", "text", "n_replaced"},
    "op2_simhash_near_dedup": {"doc_id", "fingerprint", "component_id"},
    "op3_consensus_html_text": {"page_id", "url", "text", "n_chars"},
    "op4_suffix_array_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op5_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op6_language_id": {"doc_id", "held_out", "lang_pred", "score", "known"},
    "op7_temperature_mixing": {"doc_id", "source", "n_tokens", "exponent", "weight", "position", "copies"},
    "op8_orc_token_files": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op9_spherical_cap_near_dedup": {"vec_id", "n_links", "component_id", "kept"},
    "op11_convolutional_toxicity": {"doc_id", "held_out", "score", "predicted", "lang_pred"},
    "op12_contour_whitening": {
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    },
    "op13_pair_bound_search": {"item_id", "rank", "doc_id", "score"},
    "op10_best_fit_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(name, spark, sf_dir):
    frame = queries.QUERIES[name](spark, sf_dir)
    assert set(frame.columns) == RESULTS[name]
    table = {"op3": "pages", "op9": "embeddings", "op12": "embeddings"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    if name.startswith("op12_"):
        assert frame.count() == 16 * rows
    elif name.startswith("op13_"):
        assert 0 < frame.count() <= 20 * spark.read.parquet(f"{sf_dir}/benchmark.parquet").count()
    else:
        assert frame.count() >= rows if name.startswith("op10_") else frame.count() == rows


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_against_sql(name, spark, sf_dir):
    frame = queries.QUERIES[name](spark, sf_dir)
    assert oracle.differences(frame, oracle.connect(sf_dir), queries.ORACLE_SQL[name]) is None


def test_language_accuracy_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = queries.QUERIES["op6_language_id"](spark, sf_dir).filter("held_out").join(docs, "doc_id").filter("lang is not null")
    assert judged.filter("lang_pred = lang").count() >= 0.97 * judged.count()


def test_pipeline_stages(spark, sf_dir, odd_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    kept = docs
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, kept, sf_dir)
        if number < 4:
            assert result.columns == docs.columns
            if number < 3:
                assert result.join(kept, "doc_id", "left_anti").count() == 0
        kept = result
    packed = kept.select("sequence_id").distinct().count()
    assert packed == corpus_pipeline.run(spark, sf_dir).select("sequence_id").distinct().count()
    kept = odd_docs
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, sf_dir)
    assert kept.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_docs.limit(0), sf_dir).count() == 0
