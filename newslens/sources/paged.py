"""A feed of numbered pages as a source of Spark, for batch and stream.

Each page of an API is landed as a folder ``page=<n>`` of responses, one JSON object a line
or one a file. The stream's offset is the next page to read; up to ``PARTS`` pages are a partition
each, more are dealt over as many partitions in runs of at most ``RUN`` pages, so pages are
parsed side by side without a task and a result file for every one. A restart goes on after
the last page that was taken.
Pages count from 1 on, and a page that is missing holds up those after it until it lands, so
that none is passed over.

    spark.dataSource.register(PagedFeed)
    spark.readStream.format("paged_feed").option("source", "Guardian").load(folder)
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

LAYOUT = "source string, title string, url string, page bigint"
_PAGE = re.compile(r"page=(\d+)")
#: Partitions that the pages of a batch are dealt over, and the most pages of one.
PARTS, RUN = 256, 1_000


def _files(path: str):
    from pyarrow import fs

    place = path.removeprefix("file:") if path.startswith("file:") else path
    return fs.FileSystem.from_uri(place) if "://" in place else (fs.LocalFileSystem(), place)


def pages_landed(path: str) -> list[int]:
    """Numbers of the pages there are, in order."""
    from pyarrow import fs

    files, place = _files(path)
    found = files.get_file_info(fs.FileSelector(place, allow_not_found=True))
    return sorted(int(m.group(1)) for f in found if (m := _PAGE.fullmatch(f.base_name)))


def responses(text: str) -> Iterator[dict]:
    """The JSON objects of a file: one over all of it, or one a line."""
    try:
        yield json.loads(text)
    except json.JSONDecodeError:
        for line in text.splitlines():
            if line.strip():
                yield json.loads(line)


def results(path: str, page: int, source: str) -> Iterator[tuple[str, str | None, str | None, int]]:
    """The results of one page; a response without results gives none."""
    from pyarrow import fs

    files, place = _files(path)
    for file in sorted(files.get_file_info(fs.FileSelector(f"{place}/page={page}")), key=lambda f: f.path):
        if file.base_name.startswith(("_", ".")):
            continue
        with files.open_input_stream(file.path) as stream:
            text = stream.readall().decode("utf-8")
        for response in responses(text):
            for item in (response.get("response") or {}).get("results") or []:
                yield source, item.get("webTitle"), item.get("webUrl"), page


@dataclass
class Pages(InputPartition):
    numbers: Sequence[int]


def runs(numbers: Sequence[int]) -> list[Pages]:
    """The pages in order, in runs of about equal length."""
    size = min(max(1, -(-len(numbers) // PARTS)), RUN)
    return [Pages(numbers[i : i + size]) for i in range(0, len(numbers), size)]


class _Landed:
    """What batch and stream share: where the pages are, and how one is read."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.source = options["path"], options.get("source", "")

    def read(self, partition: Pages | None) -> Iterator[tuple]:
        # Without any page there is no partition.
        for number in partition.numbers if partition else ():
            yield from results(self.path, number, self.source)


class PagedReader(_Landed, DataSourceReader):
    def partitions(self) -> list[Pages]:
        return runs(pages_landed(self.path))


class PagedStreamReader(_Landed, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"page": 1}

    def latestOffset(self) -> dict:
        following = 1
        for number in pages_landed(self.path):
            if number > following:
                break
            following = max(following, number + 1)
        return {"page": following}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        return runs(range(start["page"], end["page"]))

    def commit(self, end: dict) -> None:
        pass


class PagedFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        return LAYOUT

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)

    def streamReader(self, schema) -> PagedStreamReader:
        return PagedStreamReader(self.options)
