"""SC12: a source paged by offset, as a Spark data source: the first page tells in planning how many pages there are, and each range of pages is a partition.

Pages are JSON files {"items": [...], "total": N, "page_size": M} named page_<number>.json from 1, in a folder or below a URI (see `cursor.page_text`);
"pages" may stand in place of total and page_size. A network reader would override `page_text`. Columns: page, pos (from 0) and item, as JSON text.

Filters on `page` (=, <, <=, >, >=, IN) reach the planning, so that other pages are not read; Spark hands them over where
spark.sql.python.filterPushdown.enabled is set, and checks the rest itself. Spark 4.1 keeps the partitions of a loaded source after a filtered query,
so load it anew for each query where that setting is on. Options: path; pagesPerPartition (10). A page below the last that is
missing is an error, or, with allowMissing, has no rows; a total that grows between planning and reading does not add pages, as with any offset paging.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from rosterweave.sources import cursor


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "offset_pages"

    def schema(self) -> str:
        return "page int, pos int, item string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)


@dataclass
class Pages(InputPartition):
    first: int
    last: int
    only: tuple[int, ...] | None = None


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.size = options["path"], max(1, int(options.get("pagesPerPartition", "10")))
        self.missing = options.get("allowMissing", "false").lower() == "true"
        self.least, self.most, self.only = 1, math.inf, None

    def _page(self, number: int) -> dict | None:
        found = cursor.page_text(self.path, f"page_{number}.json")
        return None if found is None else json.loads(found)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            value = getattr(f, "value", None)
            if getattr(f, "attribute", None) != ("page",) or isinstance(value, (bool, str)) or (isinstance(f, In) and not all(isinstance(v, int) for v in value)):
                yield f
            elif isinstance(f, EqualTo):
                self.least, self.most = max(self.least, value), min(self.most, value)
            elif isinstance(f, In):
                self.only = set(value) if self.only is None else self.only & set(value)
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.least = max(self.least, value + isinstance(f, GreaterThan))
            elif isinstance(f, (LessThan, LessThanOrEqual)):
                self.most = min(self.most, value - isinstance(f, LessThan))
            else:
                yield f

    def last_page(self) -> int:
        """From the first page; 0 if there is none."""
        first = self._page(1)
        if not first:
            return 0
        if "pages" in first:
            return int(first["pages"])
        size = int(first.get("page_size") or len(first.get("items") or []))
        return math.ceil(int(first.get("total") or 0) / size) if size else 0

    def partitions(self) -> list[InputPartition]:
        last = min(self.last_page(), self.most)
        wanted = range(max(1, self.least), int(last) + 1)
        if self.only is not None:
            picked = sorted(n for n in self.only if n in wanted)
            return [Pages(c[0], c[-1], tuple(c)) for c in (picked[k : k + self.size] for k in range(0, len(picked), self.size))] or [Pages(1, 0)]
        return [Pages(k, min(k + self.size - 1, wanted[-1])) for k in wanted[:: self.size]] or [Pages(1, 0)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        for number in partition.only or range(partition.first, partition.last + 1):
            page = self._page(number)
            if page is None and not self.missing:
                raise ValueError(f"page {number} of {self.path} is missing")
            for pos, item in enumerate((page or {}).get("items") or []):
                yield number, pos, json.dumps(item, ensure_ascii=False)
