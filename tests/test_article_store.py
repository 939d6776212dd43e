"""What the parse stage and the article store write, shuffle and hold in memory."""

from pyspark.sql import functions as F

from folio.operators import articles, known
from folio.session import HTML_ARROW_BATCH_ROWS, materialize
from folio.sources.fixtures import Fixtures
from folio.sources.tables import scan_pages
from tests.conftest import SF_SMALL

ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_the_store_gets_an_article_once(spark):
    """Only compiled rows, and the text in one column, are written for the store."""
    stage = spark.createDataFrame([("a", "compiled", "m", "b", "f"), ("x", "error", None, "b", "f")], "article_key string, status string, markdown string, body_markdown string, front_matter string")
    rows = articles.store_rows(stage)
    assert rows.columns == ["status", "article_key", "markdown"] and [tuple(r) for r in rows.collect()] == [("compiled", "a", "m")]


def test_pages_come_in_small_batches_and_late_ones_alone(spark, monkeypatch):
    """Both passes of a stage run in batches of few pages, and the session keeps its setting; of
    pages that the filter of known ids held wrongly the stage joins the deferred ones only."""
    seen, held = {}, spark.conf.get(ROWS_KEY)

    def write(df, name, path=None):
        out = materialize(df, name, path)
        seen[name] = (int(spark.conf.get(ROWS_KEY)), out)
        return out

    monkeypatch.setattr(articles, "materialize", write)
    full = known.KeyFilter(1 << 15, spark.sparkContext.broadcast(b"\xff" * (1 << 12)))
    monkeypatch.setattr(articles, "key_filter", lambda keys, column: full)
    fx = Fixtures(spark, SF_SMALL)
    st = articles.parse_stage(scan_pages(fx["fx_pages"]), fx["fx_meta"], fx["fx_completed"], ("body",))
    assert int(held) > HTML_ARROW_BATCH_ROWS and spark.conf.get(ROWS_KEY) == held
    assert {k: v[0] for k, v in seen.items()} == {"parsed-pages": HTML_ARROW_BATCH_ROWS, "late-pages": HTML_ARROW_BATCH_ROWS}
    late, parsed = seen["late-pages"][1], seen["parsed-pages"][1]
    deferred = {r.row_id for r in parsed.filter("deferred").collect()}
    rows = [r.late_row for r in late.collect()]
    assert late.columns == ["late_row", "late_body_md", "late_image_errors"] and set(rows) == deferred and len(rows) == len(deferred) > 0
    assert st.filter(F.col("status") == "compiled").filter("markdown IS NULL").count() == 0
