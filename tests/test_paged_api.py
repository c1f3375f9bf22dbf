"""The paged source over page files; no network."""

import json
import urllib.error

import pytest

from dealscope.operators import staging
from dealscope.schemas import MARKET
from dealscope.sources.paged_api import PagedApi, PagedReader
from pyspark.sql import types as T

COLUMNS = "market_deal_id string, object_type string, price string, area string, deal_date string"


def write_page(folder, name, items):
    (folder / f"{name}.json").write_text(json.dumps({"items": items, "next": None}))


def test_pages_are_partitions(spark, tmp_path):
    for period in ("2024-01", "2024-02"):
        for page in (1, 2):
            write_page(tmp_path, f"{period}-{page}", [
                {"market_deal_id": f"{period[-1]}{page}{n}", "object_type": " Квартира ", "price": 1000.5,
                 "area": "40,5", "deal_date": f"{period}-0{page}", "unused": {"x": 1}} for n in range(3)])
        write_page(tmp_path, f"{period}-3", [])
    spark.dataSource.register(PagedApi)
    frame = (spark.read.format("paged_api").schema(COLUMNS)
             .option("url", f"file://{tmp_path}/{{period}}-{{page}}.json")
             .option("pages", 3).option("periods", "2024-01, 2024-02").load())
    assert frame.rdd.getNumPartitions() == 6
    rows = frame.collect()
    assert len(rows) == 12 and {r.price for r in rows} == {"1000.5"}
    staged = staging.settle(staging.type_raw(frame, MARKET, names=["object_type"]), MARKET)
    assert staged.count() == 12
    row = staged.where("market_deal_id = 111").first()
    assert (row.object_type, str(row.price), str(row.area), str(row.deal_date)) == (
        "квартира", "1000.50", "40.50", "2024-01-01")


SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("tags", T.StringType())])


def reader(fetch, **options):
    return PagedReader(SCHEMA, {"url": "u?{page}", "pages": "2", "pause": "0", **options}, fetch)


def test_a_page_that_fails_once_is_fetched_again():
    calls = []

    def fetch(url):
        calls.append(url)
        if len(calls) == 1:
            raise urllib.error.URLError("busy")
        return {"items": [{"id": "1", "tags": ["a", "ж"]}, {"tags": None}]}

    source = reader(fetch)
    assert list(source.read(source.partitions()[0])) == [("1", '["a", "ж"]'), (None, None)]
    assert calls == ["u?1", "u?1"]


def test_a_page_that_keeps_failing_fails_the_read():
    def fetch(url):
        raise urllib.error.URLError("down")

    source = reader(fetch, attempts="2")
    with pytest.raises(urllib.error.URLError):
        list(source.read(source.partitions()[1]))


def test_error_body_is_no_empty_page():
    from dealscope.sources.paged_api import Page
    with pytest.raises(ValueError, match="quota"):
        list(reader(lambda url: {"error": "quota"}).read(Page(1, "")))


def test_more_pages_than_asked_for():
    from dealscope.sources.paged_api import Page
    pages = reader(lambda url: {"items": [], "next": "u?3"})
    assert list(pages.read(Page(1, ""))) == []
    with pytest.raises(ValueError, match="has more"):
        list(pages.read(Page(2, "")))
