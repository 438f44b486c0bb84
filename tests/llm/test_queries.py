import zlib

import duckdb
import pytest

import __spark_entry__ as entry

from . import odd

CONTRACTS = {
    2: "doc_id piece start length ids_crc32 sequence_id offset", 3: "doc_id start n_tokens ids_crc32",
    4: "doc_id n_shingles component_id kept", 5: "doc_id held_out score predicted",
    6: "doc_id keep_id group_size kept text_sha256", 7: "doc_id held_out score predicted",
    8: "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    10: "doc_id held_out lang_pred score"}


def query(n):
    (name,) = [q for q in entry.queries() if q.startswith(f"op{n}_")]
    return name


def test_one_query_for_each_operator():
    assert [query(n) for n in range(1, 11)] and "pipeline" in entry.queries()


@pytest.mark.parametrize("n", sorted(CONTRACTS))
def test_columns_and_rows_of_the_contract(spark, n):
    got = entry.queries()[query(n)](spark, odd.SF)
    assert set(CONTRACTS[n].split()) <= set(got.columns)
    rows = got.collect()
    ids = [r.doc_id for r in rows]
    assert set(ids) == {d for d, _ in odd.texts()} and (n == 2 or len(ids) == len(set(ids)))
    if "held_out" in got.columns:
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    if "predicted" in got.columns:
        assert all(r.predicted == (r.score >= (0.3 if n == 7 else 0.5)) for r in rows)


def test_exact_dedup_equals_its_sql(spark):
    name = query(6)
    got = entry.queries()[name](spark, odd.SF)
    documents = duckdb.sql(f"select * from '{odd.SF}/documents.parquet'")  # noqa: F841  (named in the SQL)
    want = duckdb.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
