"""The fixtures bite: what these keys return is not what went in, and every case occurs."""

import pytest

import __spark_entry__ as E
from folio.plans.registry import PLANS
from folio.sources.fixtures import Fixtures
from tests.conftest import SF_SMALL

QUERIES = E.queries()


def test_every_reason_of_admission_occurs(spark):
    rows = QUERIES["fetch_admission_reasons"](spark, SF_SMALL).collect()
    assert {r.reason for r in rows} == {"admit", "completed", "exists", "ignored", "malformed"}
    admitted = [r.page_key for r in rows if r.reason == "admit"]
    assert len(admitted) == len(set(admitted))


def test_several_images_and_all_error_texts(spark):
    images = QUERIES["image_refs_many"](spark, SF_SMALL).collect()
    assert {r.pos for r in images} == {0, 1, 2} and len({r.title for r in images}) > 2
    assert len({r.reason for r in QUERIES["content_corruption_markers"](spark, SF_SMALL).collect()}) == 4


def test_furniture_goes(spark):
    cleaned = QUERIES["x_clean_body_furniture"](spark, SF_SMALL).collect()
    assert all("Stays" in r.body_markdown and "Subscribe now" not in r.body_markdown and "Likes" not in r.body_markdown for r in cleaned)


@pytest.mark.parametrize(("key", "table", "column"), [("prune_aliases", "fx_aliases", "url"), ("prune_completed", "fx_completed", "post_id")])
def test_pruning_removes_some_and_keeps_some(spark, key, table, column):
    fx = Fixtures(spark, SF_SMALL)
    before, after = fx[table].select(column).distinct().count(), PLANS[key](fx).select(column).distinct().count()
    assert 0 < after < before
