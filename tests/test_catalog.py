"""Every query against the SQL that it equals, over the smallest given tables."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry
from quern.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)
    assert found or name in ("rechunk_oversized",)
    if name in catalog.ORACLES:
        result = duck.execute(catalog.ORACLES[name])
        at = {d[0]: i for i, d in enumerate(result.description)}
        assert sorted(at) == columns
        assert found == sorted((tuple(plain(r[at[c]]) for c in columns) for r in result.fetchall()), key=repr)


#: A title and heading that end within a reference, as pages have where they are cut.
CUT = [(i, f"https://a.example/{i}", f"<title>T{i} &amp;{cut}</title><body><article><h1>T{i} &amp;{cut}</h1><p>x &amp; y</p></article></body>") for i, cut in enumerate(("&amp", "&am", "&", "&amp;", "&ampx", "&quot"))]


@pytest.mark.parametrize("name", ["article_content", "job_content", "signal_ingest"])
def test_cut_references(spark, tmp_path, name):
    import duckdb

    spark.createDataFrame(CUT, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    df = catalog.QUERIES[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    expected = con.execute(f"SELECT {', '.join(df.columns)} FROM ({catalog.ORACLES[name]})").fetchall()
    assert len(expected) == len(CUT) and sorted(map(tuple, df.collect()), key=repr) == sorted(expected, key=repr)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["page_id", "canonical_url", "url_hash", "n_chunks", "tokens"] and df.count() > 0


def test_scans_are_pruned_and_pushed(spark):
    plan = catalog.QUERIES["host_counts"](spark, SF)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<url:string>" in plan
    plan = catalog.QUERIES["upsert_latest"](spark, SF)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(event_id)" in plan
