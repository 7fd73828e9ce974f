"""SC13: a cursor source. Recorded pages of a keyset-paged service as a Spark data source: page N names the cursor of page N + 1.

Batch reads follow the chain from the start; streaming reads go on from the last cursor, which Spark keeps in the checkpoint.
Pages are JSON files {"items": [...], "last_sort": "..."} named page_<cursor>.json, the first page_start.json, in a local folder or in any store
that Arrow names by a URI; a network reader would override `page_text`. A batch reads the whole chain, however long; a chain that comes back to
a cursor it has seen is an error.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

START = "start"


class CursorSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cursor_pages"

    def schema(self) -> str:
        return "cursor string, item string"

    def reader(self, schema) -> DataSourceReader:
        return CursorReader(self.options)

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return CursorStream(self.options)


def page_text(path: str, name: str) -> str | None:
    """The text of a file of landed pages, None where there is none. path: a local folder, or a URI (file:, hdfs:, s3: ...)."""
    from pyarrow import fs

    where, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    file = f"{root.rstrip('/')}/{name}"
    if where.get_file_info(file).type != fs.FileType.File:
        return None
    with where.open_input_stream(file) as stream:
        return stream.read().decode("utf-8")


def _page(path: str, cursor: str) -> dict | None:
    found = page_text(path, f"page_{cursor}.json")
    return None if found is None else json.loads(found)


def _walk(path: str, cursor: str, most: int | None = None) -> Iterator[tuple[str, list, str]]:
    seen: set[str] = set()
    while most is None or len(seen) < most:
        if cursor in seen:
            raise ValueError(f"the chain of pages in {path} comes back to {cursor!r}")
        seen.add(cursor)
        page = _page(path, cursor)
        if page is None or not page.get("items"):
            return
        after = str(page.get("last_sort") or "")
        yield cursor, page["items"], after
        if not after:
            return
        cursor = after


class CursorReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]  # a chain has no second end to start from

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for cursor, items, _ in _walk(self.path, START):
            for item in items:
                yield cursor, json.dumps(item, ensure_ascii=False)


class CursorStream(SimpleDataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.most = options["path"], int(options.get("pagesPerBatch", "10"))

    def initialOffset(self) -> dict:
        return {"cursor": START}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = [], start["cursor"]
        for cursor, items, after in _walk(self.path, start["cursor"], self.most):
            rows += [(cursor, json.dumps(i, ensure_ascii=False)) for i in items]
            end = after or f"end-{cursor}"
        return iter(rows), {"cursor": end}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for cursor, items, after in _walk(self.path, start["cursor"], self.most):
            yield from ((cursor, json.dumps(i, ensure_ascii=False)) for i in items)
            if (after or f"end-{cursor}") == end["cursor"]:
                return
