"""How many pages a paged source has is asked of the source."""

import urllib.error

import pytest

from dealscope.sources.paged_api import PagedReader
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("id", T.StringType())])


def rows(content, extra=None, missing=False, clamp=False, **options):
    def fetch(url):
        number = int(url.split("?")[1])
        if number > len(content) and missing:
            raise urllib.error.HTTPError(url, 404, "not found", None, None)
        own = content[-1] if number > len(content) and clamp else content[number - 1] if number <= len(content) else []
        return {"items": [{"id": str(i)} for i in own], **(extra or {})}
    source = PagedReader(SCHEMA, {"url": "u?{page}", "pause": "0", **options}, fetch)
    return [r[0] for p in source.partitions() for r in source.read(p)]


@pytest.mark.parametrize("n", [1, 2, 3, 37])
def test_all_pages_come(n):
    pages = [[2 * i, 2 * i + 1] for i in range(n)]
    want = [str(i) for i in range(2 * n)]
    assert rows(pages) == rows(pages, missing=True) == want
    assert rows(pages, {"pages": n}) == rows(pages, {"total": 2 * n}) == rows(pages, {"pages": n}, clamp=True) == want
    assert rows([]) == []


def test_items_after_the_last_page_fail():
    pages = [[1], [2], [3]]
    for extra, options in (({}, {"pages": "2"}), ({"pages": 2}, {}), ({"total": 2}, {})):
        with pytest.raises(ValueError, match="has more"):
            rows(pages, extra, **options)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 37])
def test_a_source_that_repeats_its_last_page_is_read_once(n):
    pages = [[2 * i, 2 * i + 1] for i in range(n)]
    assert rows(pages, clamp=True) == [str(i) for i in range(2 * n)]


def test_equal_pages_are_pages():
    pages = [[1], [7], [3], [7], [5], [7], [7], [8], [9]]
    want = [str(i) for p in pages for i in p]
    assert rows(pages) == rows(pages, missing=True) == rows(pages, clamp=True) == want
    # A last page that equals the first ones, which the source repeats or doesn't.
    assert rows([[7], [2], [7]], clamp=True) == rows([[7], [2], [7]]) == ["7", "2", "7"]
    with pytest.raises(ValueError, match="has more"):
        rows([[1], [7], [7]], pages="2")
    assert rows([[1], [7]], clamp=True, pages="2") == ["1", "7"]
