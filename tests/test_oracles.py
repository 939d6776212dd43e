"""Every registered query against its DuckDB oracle on the smallest scale
factor: row count, column names and an order-insensitive value hash."""

import os

import pytest

from tests.conftest import SF_SMALL

import __spark_entry__ as E
from folio.plans import registry

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    from tools.compare import duck as open_duck
    return open_duck(SF_SMALL)


def test_every_query_has_an_oracle():
    from folio.plans.parse_plans import ROWS_ONLY
    assert set(registry.PLANS) - set(ORACLES) == ROWS_ONLY


def test_raw_pages_markdown_matches_direct_parse(spark):
    """The rows-only key against brute force: the same parser run directly in
    Python over the same rows (page keys may repeat across hosts, so rows are
    compared as a multiset)."""
    import re

    import pyarrow.parquet as pq

    from folio.operators.html_pass import extract
    rows = QUERIES["html_to_markdown_pages"](spark, SF_SMALL).collect()
    got = sorted((r.body_kind, r.body_markdown) for r in rows)
    assert all(r.parse_error is None for r in rows)
    want = []
    for row in pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist():
        out = extract(row["html"], frozenset({"body"}))
        md = re.sub(r"(?m)^\s*$\n", "", out["body_md"]).strip(" \t\n\x0b\x0c\r")
        want.append((out["body_kind"], md))
    assert got == sorted(want)


@pytest.mark.parametrize("key", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, duck, key):
    from tools.compare import digest
    sdf = QUERIES[key](spark, SF_SMALL)
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = duck.sql(ORACLES[key])
    d_rows, d_cols = rel.fetchall(), list(rel.columns)
    assert sorted(sdf.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(sdf.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="no test data")
def test_streaming_equals_batch(spark):
    """The incremental run gives the same per-page outcome as the batch job."""
    from pyspark.sql import functions as F
    a = QUERIES["incremental_extract"](spark, SF_SMALL)
    b = QUERIES["extract_articles"](spark, SF_SMALL).select("page_key", "article_key")
    ok = a.filter(F.col("outcome") == "ok").select("page_key", "article_key")
    assert ok.exceptAll(b).count() == 0 and b.exceptAll(ok).count() == 0
