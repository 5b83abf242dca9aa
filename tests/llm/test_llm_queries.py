"""The registered queries: results equal their SQL, columns and types are those of the contracts."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from content_signals.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}
COLUMNS = {
    1: {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    3: {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    4: {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    6: {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    7: {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    9: {
        "doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
        "base_sha256": "string", "spans": "string",
    },
}


def _named(number):
    return next(q for n, q in QUERIES.items() if n.startswith(f"op{number}_"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield con
    con.close()


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(SQL[name])
    kinds = {d[0]: str(d[1]) for d in result.description}
    columns = sorted(kinds)
    want = [tuple(dict(zip(kinds, row))[c] for c in columns) for row in result.fetchall()]
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(df.columns) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    assert sorted(got, key=str) == sorted(want, key=str) != []


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("number", sorted(COLUMNS))
def test_columns_and_one_row_per_document(spark, texts, number):
    df = _named(number)(spark, SF)
    assert COLUMNS[number].items() <= dict(df.dtypes).items()
    rows = {r.doc_id: r for r in df.collect()}
    assert rows.keys() == texts.keys() and df.count() == len(texts)
    if number in (1, 4):
        by, left, least = (4, 2, 0.7) if number == 1 else (5, 0, 0.5)
        for i, r in rows.items():
            assert r.held_out == (zlib.crc32(str(i).encode()) % by == left)
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= least)
    if number == 3:
        library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        for i, t in texts.items():
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            assert (rows[i].n_bytes, rows[i].n_tokens, rows[i].over_limit) == (len((t or "").encode()), n, n > 512)
    if number == 7:
        assert all(len(r.fingerprint) == 16 and r.component_id <= i for i, r in rows.items())
    if number == 9:
        for r in rows.values():
            base = ",".join(s for s in r.spans.split(",") if s.split(":")[0] in ("email", "ip", "card", "phone"))
            assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
            found = [s.split(":")[0] for s in base.split(",")]
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [found.count(k) for k in ("email", "ip", "card", "phone")]
