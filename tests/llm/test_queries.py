"""Every registered query of the training-data operators on the smallest tables: columns, rows, and its SQL where there is one."""

from pathlib import Path

import duckdb
import pytest

from terraline.llm import registry

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")
COLUMNS = {
    "op1_language_id": "doc_id held_out lang_pred score bits", "op2_chat": "conv_id n_turns rendered", "op3_token_counts": "doc_id n_pretokens n_tokens", "op4_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5_simhash": "doc_id fingerprint component_id", "op6_sharding": "doc_id size text_crc32 law shard slot grown_shard", "op7_token_file": "doc_id start n_tokens ids_crc32",
    "op8_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated", "op9_telephony": "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature",
    "op10_suffix_array_dedup": "doc_id n_bytes n_removed n_spans kept_sha256", "op11_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256", "op12_whitening": "vec_id component n deviation whitened explained identity_error",
    "op13_top_k": "query_id rank vec_id score", "pipeline": "doc_id n_tokens ids_sha256 decoded_sha256",
}


@pytest.mark.parametrize("name", registry.queries())
def test_query(spark, name):
    got = registry.queries()[name](spark, str(SF)).toPandas()
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert list(got.columns) == COLUMNS[name].split()
    if "doc_id" in got and name != "pipeline":
        assert sorted(got["doc_id"]) == [x for (x,) in con.execute("SELECT doc_id FROM documents ORDER BY 1").fetchall()]
    if sql := registry.oracle_sql().get(name):
        want = con.execute(sql).fetchdf()[list(got.columns)]
        key = list(got.columns)[:2]
        assert got.sort_values(key).astype(object).where(got.sort_values(key).notna(), None).values.tolist() == want.sort_values(key).astype(object).where(want.sort_values(key).notna(), None).values.tolist()
