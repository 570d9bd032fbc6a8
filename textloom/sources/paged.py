"""Texts that a server gives out page by page.

A text is read by a cursor: a page's answer may hold lines of several pages, and the next
page asked for follows the last of them.  The first line of a reference wins; an answer
without new lines, or the last page, ends the text.  Texts are dealt to tasks by the files of
an index, and each task paces its own requests.
"""

from __future__ import annotations

import json
import re
import sys
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, LessThan, LessThanOrEqual

from textloom.sources.store import located, write_files

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers that plan a source may lack this package

#: Seconds before each request, and how often one is tried; fixed values.
DELAY, TRIES = 1.5, 3
#: An anchored line and its characters; fixed formats.
LINE = re.compile(r'<a\s+name="(\d{4,}[abc]\d{2})"\s+class="al"><span class="tx">(.*?)</span></a>', re.DOTALL)
CHARACTER = re.compile(r'<span class="ec"[^>]*>(.*?)</span>')
#: The largest page of four digits; up to it, references in order of their characters are in order of their pages.
FOUR_DIGITS = 9999

Fetch = Callable[[str, str], str]


class StoredPages:
    """Pages kept as files: <folder>/pages/<text>/<page>.html."""

    def __init__(self, folder: str):
        self.folder = folder

    def __call__(self, text_id: str, page: str) -> str:
        fs, root = located(self.folder)
        with fs.open_input_stream(f"{root}/pages/{text_id}/{page}.html") as f:
            return f.read().decode("utf-8")


class Polite:
    """Requests with a pause before each and growing pauses between tries.

    What fails every time is None.
    """

    def __init__(self, fetch: Fetch, delay: float = DELAY, tries: int = TRIES, sleep: Callable[[float], None] = time.sleep):
        self.fetch, self.delay, self.tries, self.sleep = fetch, delay, tries, sleep

    def __call__(self, text_id: str, page: str) -> str | None:
        for attempt in range(self.tries):
            self.sleep(self.delay)
            try:
                return self.fetch(text_id, page)
            except OSError:
                if attempt + 1 < self.tries:
                    self.sleep(self.delay * (attempt + 2))
        return None


def page_of(ref: str) -> int:
    """The page of a reference, which has four digits or more."""
    return int(ref[:-3])


def lines_of(get: Callable[[str, str], str | None], text_id: str, first: int, last: int) -> Iterator[list[tuple[str, str]]]:
    """(ref, text) of a text, a list for each answer."""
    known: set[str] = set()
    page = first
    while page <= last:
        answer = get(text_id, f"{page:04d}") or ""
        found = {ref: body for ref, body in reversed(LINE.findall(answer)) if page_of(ref) <= last}  # the first of each
        new = [(ref, "".join(CHARACTER.findall(found[ref]))) for ref in sorted(found.keys() - known)]
        if not new:
            return
        yield new
        known |= found.keys()
        page = max(map(page_of, found)) + 1


@dataclass
class IndexFile(InputPartition):
    path: str


class PagedReader(DataSourceReader):
    def __init__(self, folder: str, get: Callable[[str, str], str | None]):
        self.folder, self.get = folder, get
        self.only: set | None = None
        self.last = FOUR_DIGITS

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Texts that aren't asked for are not requested, nor pages beyond a bound on the reference,
        unless the text has pages of five digits."""
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("text_id",):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only = values if self.only is None else self.only & values
                continue
            if isinstance(f, LessThan | LessThanOrEqual) and f.attribute == ("ref",) and re.match(r"\d{4}", f.value or ""):
                self.last = min(self.last, int(f.value[:4]))
            yield f

    def partitions(self) -> list[IndexFile]:
        fs, root = located(self.folder)
        return [IndexFile(i.path) for i in fs.get_file_info(arrow_fs.FileSelector(f"{root}/index")) if i.is_file and i.base_name.startswith("part-") and i.size]

    def read(self, partition: IndexFile) -> Iterator[pa.RecordBatch]:
        fs, _ = located(self.folder)
        with fs.open_input_stream(partition.path) as f:
            texts = [json.loads(line) for line in f.read().decode("utf-8").splitlines() if line]
        for text in texts:
            if self.only is None or text["text_id"] in self.only:
                last = int(text["last"])
                for lines in lines_of(self.get, text["text_id"], int(text["first"]), last if last > FOUR_DIGITS else min(last, self.last)):
                    refs, contents = zip(*lines, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([text["text_id"]] * len(lines)), pa.array(refs), pa.array(contents)], names=["text_id", "ref", "text"])


class PagedTexts(DataSource):
    """Lines (text_id, ref, text).  Options: ``path`` (index and stored pages), ``delay``, ``tries``.

    A subclass of another name can fetch from elsewhere.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_texts"

    def schema(self) -> str:
        return "text_id string, ref string, text string"

    def fetch(self) -> Fetch:
        return StoredPages(self.options["path"])

    def reader(self, schema) -> PagedReader:
        get = Polite(self.fetch(), float(self.options.get("delay", DELAY)), int(self.options.get("tries", TRIES)))
        return PagedReader(self.options["path"], get)


def paged_texts(spark: SparkSession, path: str, source: type[PagedTexts] = PagedTexts, delay: float = DELAY, tries: int = TRIES) -> DataFrame:
    """The lines of all texts in the index below ``path``."""
    if not spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true":
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    cloudpickle.register_pickle_by_value(sys.modules[source.__module__])
    spark.dataSource.register(source)
    return spark.read.format(source.name()).option("delay", delay).option("tries", tries).load(path)


def store_pages(pages: DataFrame, path: str, slices: int = 8) -> None:
    """Write pages (text_id, page, html) as a store with an index of first and last pages."""
    number = lambda page: F.format_string("%04d", page)
    write_files(pages, path, F.concat(F.lit("pages/"), F.col("text_id"), F.lit("/"), number(F.col("page")), F.lit(".html")), F.col("html"))
    bounds = pages.groupBy("text_id").agg(number(F.min("page")).alias("first"), number(F.max("page")).alias("last"))
    bounds.repartition(slices, "text_id").write.mode("overwrite").json(f"{path}/index")
