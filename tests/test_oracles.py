"""Every registered query against its DuckDB statement, on the given tables."""

import math
import os

import duckdb
import pytest

from lidarlattice.jobs import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    held = {}

    def of(folder):
        if folder not in held:
            con = duckdb.connect()
            con.execute("SET TimeZone='UTC'")
            for t in TABLES:
                if os.path.exists(f"{folder}/{t}.parquet"):
                    con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
            held[folder] = con
        return held[folder]

    return of


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v + 0.0, 9)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=str)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, duck, name):
    folder = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.001')}"
    df = registry.QUERIES[name](spark, folder)
    got_columns, got = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck(folder).execute(registry.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want_columns, want = rows(columns, cursor.fetchall())
    assert got_columns == want_columns
    assert len(got) == len(want)
    different = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    assert not different, f"{len(different)} rows differ: {different[:3]}"
