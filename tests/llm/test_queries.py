"""The registered queries over the smallest tables, against their SQL where there is one."""

import duckdb
import pytest

import __spark_entry__ as contract
from millrace.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op2_url_filters": "page_id host path rule verdict",
    "op3_secret_scans": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op5_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op6_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op7_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op8_toxicity": "doc_id held_out score predicted",
    "op9_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op10_minhash": "doc_id n_shingles component_id kept",
    "op11_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12_neighbours": "query_id rank vec_id score",
    "op13_centroids": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
}
#: Tables with a row for each of the result; documents where none is named.
ROWS_OF = {"op2_url_filters": "pages", "op11_prefix_trie": None, "op12_neighbours": None, "op13_centroids": "embeddings"}


def test_one_query_for_each_operator():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries() and set(queries.ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, name):
    df = contract.queries()[name](spark, SF)
    if name in COLUMNS:
        assert df.columns[: len(COLUMNS[name].split())] == COLUMNS[name].split()
        table = ROWS_OF.get(name, "documents")
        if table:
            assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name == "op8_toxicity":
        assert df.filter("score BETWEEN 0 AND 1 AND predicted = CAST(score >= 0.7 AS INT)").count() == df.count()
    if name == "op12_neighbours":
        assert df.count() == 20 * spark.read.parquet(f"{SF}/embeddings.parquet").filter("vec_id % 20 = 0").count()
    if name in queries.ORACLES:
        duck = duckdb.connect()
        for table in ("documents", "benchmark", "conversations", "embeddings"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        result = duck.execute(queries.ORACLES[name])
        names = [c[0] for c in result.description]
        assert sorted(names) == sorted(df.columns)
        got = [tuple(r[c] for c in names) for r in df.collect()]
        assert sorted(got, key=str) == sorted(result.fetchall(), key=str)
