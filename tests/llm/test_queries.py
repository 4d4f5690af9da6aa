"""Every registered query over the whole smallest tables: columns, row counts,
and equality with its SQL where there is any."""

import duckdb
import pytest

import __spark_entry__ as entry
from barsmith.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    1: {"doc_id", "log_weight", "gumbel_sum", "kept"},
    2: {"doc_id", "text", "n_lines", "n_removed"},
    3: {"doc_id", "held_out", "score", "predicted"},
    4: {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    5: {"page_id", "url", "text", "n_chars"},
    6: {"doc_id", "n_shingles", "component_id"},
    7: {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    8: {"page_id", "host", "path", "rule", "verdict"},
    9: {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    10: {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    11: {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    12: {"item_id", "rank", "doc_id", "score"},
    13: {"part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"},
}


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    number = int(name[2:].split("_")[0])
    got = QUERIES[name](spark, SF)
    assert COLUMNS[number] <= set(got.columns)
    rows = got.collect()
    table = "pages" if number in (5, 8) else "documents"
    there = spark.read.parquet(f"{SF}/{table}.parquet").count()
    if number < 12:
        assert len(rows) == there if number != 4 else len(rows) >= there
    if name in ORACLE:
        con = duckdb.connect()
        for t in ("documents", "benchmark", "pages", "labels"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        cur = con.execute(ORACLE[name])
        names = [d[0] for d in cur.description]
        assert set(names) == set(got.columns)
        assert sorted(map(str, cur.fetchall())) == sorted(str(tuple(r[c] for c in names)) for r in rows)
