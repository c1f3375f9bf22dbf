"""A paged REST result set as a Spark data source.

``spark.dataSource.register(PagedApi)``, then::

    spark.read.format("paged_api").schema("id string, price string")
        .option("url", "https://host/deals?page={page}&month={period}")
        .option("periods", "2024-01,2024-02").load()

Every page of every period is one input partition, so pages are fetched in
parallel and a lost executor costs the pages it was reading. Values arrive as
text; staging types them. Without ``pages`` the source is asked: by its first page's
``page_count`` or ``total`` field, or else by looking for the first empty page. A
read fails if there are items after the last page.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

Fetch = Callable[[str], dict]


#: A page number that no source reaches, and what sources answer to one that doesn't exist.
FAR = 10**9
NO_PAGE = (400, 404, 410, 416, 422)


def fetch_json(url: str) -> dict:
    with urllib.request.urlopen(url, timeout=60) as reply:
        return json.load(reply)


class Page(InputPartition):
    def __init__(self, number: int, period: str, last: int | None = None):
        super().__init__((number, period, last))
        self.number = number
        self.period = period
        self.last = last


class PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str], fetch: Fetch):
        self.names = schema.fieldNames()
        self.url = options["url"]
        self.first = int(options.get("first", "1"))
        self.pages = int(options["pages"]) if "pages" in options else None
        self.count = options.get("page_count", "pages")
        self.total = options.get("total", "total")
        self.periods = [p.strip() for p in options.get("periods", "").split(",")]
        self.items = options.get("items", "items")
        self.attempts = int(options.get("attempts", "3"))
        self.pause = float(options.get("pause", "1"))
        self.fetch = fetch

    def partitions(self) -> list[Page]:
        out = []
        for period in self.periods:
            pages = self.pages if self.pages is not None else self._pages(period)
            out += [Page(number, period, self.first + pages - 1) for number in range(self.first, self.first + pages)]
        return out

    def read(self, partition: Page) -> Iterator[tuple]:
        url = self._url(partition.number, partition.period)
        reply = self._load(url)
        items = self._items(url, reply)
        last = partition.last if partition.last is not None else self.first + self.pages - 1
        if partition.number == last and (reply.get("next") or items and self._more(last, partition.period, items)):
            raise ValueError(f"{url} is the last page asked for, but the source has more; raise pages")
        for item in items:
            yield tuple(_cell(item.get(name)) for name in self.names)

    def _pages(self, period: str) -> int:
        """How many pages a period has, at least 1."""
        url = self._url(self.first, period)
        reply = self._load(url)
        items = self._items(url, reply)
        if str(reply.get(self.count, "")).isdigit():
            return max(1, int(reply[self.count]))
        if str(reply.get(self.total, "")).isdigit() and items:
            return max(1, -(-int(reply[self.total]) // len(items)))
        if not items:
            return 1
        # Some sources answer any number beyond the last page with that page: a number far off tells.
        beyond = self._beyond(self.first + FAR, period)

        def there(page: int) -> bool:
            items = self._beyond(self.first + page - 1, period)
            if not items or not beyond:
                return bool(items)
            # The last page is followed by itself; another page may equal it, but not the one after that too.
            return items != beyond or self._beyond(self.first + page, period) != beyond

        # Pages up to ``full`` are there, ``empty`` isn't (or is the last one, if the source repeats that).
        full, empty = (0 if beyond else 1), (1 if beyond else 2)
        while there(empty):
            full, empty = empty, empty * 2
        while empty - full > 1:
            middle = (full + empty) // 2
            full, empty = (middle, empty) if there(middle) else (full, middle)
        return empty if beyond else full

    def _beyond(self, number: int, period: str) -> list:
        """The items of a page that may not exist."""
        url = self._url(number, period)
        try:
            return self._items(url, self._load(url))
        except urllib.error.URLError as error:
            if getattr(error, "code", None) in NO_PAGE or _no_file(error):
                return []
            raise

    def _more(self, last: int, period: str, items: list) -> bool:
        """Whether a page follows the last one read, which the source may only be repeating."""
        after = self._beyond(last + 1, period)
        return bool(after) and (after != items or self._beyond(self.first + FAR, period) != items)

    def _url(self, number: int, period: str) -> str:
        return self.url.replace("{page}", str(number)).replace("{period}", period)

    def _items(self, url: str, reply: dict) -> list:
        if self.items not in reply:
            raise ValueError(f"{url} has no {self.items!r}: {json.dumps(reply)[:200]}")
        return reply[self.items] or []

    def _load(self, url: str) -> dict:
        """A page, trying again after passing failures with growing pauses."""
        for attempt in range(1, self.attempts + 1):
            try:
                return self.fetch(url)
            except (urllib.error.URLError, TimeoutError, ConnectionError) as error:
                if attempt == self.attempts or getattr(error, "code", None) in NO_PAGE or _no_file(error):
                    raise
                time.sleep(self.pause * 2 ** (attempt - 1))
        raise ValueError("attempts must be at least 1")


class PagedApi(DataSource):
    """Subclass and override ``fetch`` for an API with its own sign-in."""

    fetch = staticmethod(fetch_json)

    @classmethod
    def name(cls) -> str:
        return "paged_api"

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedReader(schema, dict(self.options), type(self).fetch)


def _no_file(error: Exception) -> bool:
    """Whether a ``file:`` page is missing."""
    reason = getattr(error, "reason", None)
    return isinstance(reason, FileNotFoundError) or "No such file" in str(reason)


def _cell(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)
