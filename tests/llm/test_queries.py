"""The registered queries: names, columns, and the SQL of those that have one."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from patronage.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL

COLUMNS = {
    "op1_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op2_simhash_dedup": "doc_id fingerprint component_id",
    "op3_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op4_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op5_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op6_topk": "query_id rank vec_id score",
    "op7_token_counts": "source lang tokenizer documents tokens",
    "op8_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256 text removed",
    "op9_token_files": "doc_id start n_tokens ids_crc32",
    "op10_quality": "doc_id held_out score predicted",
    "op11_language": "doc_id held_out lang_pred score",
    "op12_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op13_collocations": "lang rank phrase a l r n score",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    assert df.columns == COLUMNS[name].split()
    rows = df.collect()
    if "doc_id" in df.columns:
        assert {r["doc_id"] for r in rows} == set(range(200))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    df = entry.queries()[name](spark, SF_SMALL).select(*names)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(cur.fetchall(), key=str)


def test_registered():
    assert set(COLUMNS) == set(QUERIES) and {*QUERIES, "pipeline"} <= set(entry.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "packing"]
