"""Every registered query of the subpackage at the smallest size: against its SQL where there is one, else for shape and rules."""

import math
from collections import Counter

import duckdb
import pytest

from framelake.llm import common, registry

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
COLUMNS = {
    "op1_sst": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op2_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op3_langid": {"doc_id", "held_out", "lang_pred", "score"},
    "op5_embedding": {"vec_id", "n_links", "component_id", "kept"},
    "op6_urls": {"page_id", "host", "path", "rule", "verdict"},
    "op7_simhash": {"doc_id", "fingerprint", "component_id"},
    "op9_quality": {"doc_id", "held_out", "score", "predicted"},
    "op11_whitening": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
    "op12_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op13_negatives": {"anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"},
    "op10_decontamination": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
}


def rows_of(rows, columns):
    def plain(v):
        return round(v, 9) if isinstance(v, float) and math.isfinite(v) else v

    return Counter(str([plain(r[c]) for c in columns]) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    before = set(scratch(spark))
    df = registry.QUERIES[name](spark, SF)
    assert COLUMNS.get(name, set()) <= set(df.columns)
    left = [x for x in scratch(spark) if x not in before]
    read = {p.rsplit("/", 1)[1] for p in common.folders_read(df)}
    if name != "op4_sharding":  # its store is a product
        assert set(left) <= read
    rows = [r.asDict() for r in df.collect()]
    if name in registry.ORACLES:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        want = con.execute(registry.ORACLES[name])
        columns = sorted(d[0] for d in want.description)
        names = [d[0] for d in want.description]
        assert columns == sorted(df.columns)
        assert rows_of(rows, columns) == rows_of([dict(zip(names, r, strict=True)) for r in want.fetchall()], columns)
    elif "doc_id" in df.columns and name != "op8_passages":
        docs = spark.read.parquet(f"{SF}/documents.parquet")
        assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.select("doc_id").collect())


def scratch(spark):
    from pathlib import Path

    folder = Path(common.scratch_dir(spark).removeprefix("file://"))
    return [p.name for p in folder.iterdir()] if folder.exists() else []
