"""Every operator's query on the smallest tables, against its SQL where it has one."""

from pathlib import Path

import duckdb
import pytest

from corpusloom.llm import catalog

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")

#: Columns that the contracts name.
COLUMNS = {
    "op1_mixing": "doc_id size source_size target taken",
    "op4_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op5_url_filters": "page_id host path rule verdict",
    "op7_topk": "query_id rank vec_id score",
    "op9_media_columns": "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature",
    "op10_html_extraction": "page_id url text n_chars",
    "op11_phrase_collocations": "lang rank phrase a l r n score",
    "op12_session_merging": "user batch start_s end_s n_events n_new n_retracted h_sum retracted_batch retracted_start_s",
    "op13_language_id": "doc_id held_out lang_pred score",
}
TABLES = {"op4_warc": "pages", "op5_url_filters": "pages", "op10_html_extraction": "pages", "op1_mixing": "documents", "op2_ngram_jaccard": "documents", "op3_sentencepiece": "documents", "op6_toxicity": "documents", "op9_media_columns": "documents", "op13_language_id": "documents"}


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, name):
    found = catalog.queries()[name](spark, SF)
    assert set(COLUMNS.get(name, "").split()) <= set(found.columns)
    rows = sorted(tuple(r[c] for c in sorted(found.columns)) for r in found.collect()) if name in catalog.oracle_sql() else found.collect()
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    if name in TABLES:
        assert len(rows) == con.execute(f"SELECT count(*) FROM {TABLES[name]}").fetchone()[0]
    if name not in catalog.oracle_sql():
        assert rows
        return
    answer = con.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    want = [tuple(v for _, v in sorted(zip(columns, r, strict=True))) for r in answer.fetchall()]
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(columns) == sorted(found.columns) and sorted(rows, key=key) == sorted(want, key=key)
