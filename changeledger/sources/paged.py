"""A collection read in pages (O01, O03, O05): a Python data source with a batch and a stream reader.

``spark.read.format("paged_documents")`` reads the documents of a stored collection (Parquet files in one folder, or one file) in
pages of ``pageSize`` documents, as a document database hands out cursors; tasks read ranges of pages side by side.
A task must decode a row group from its beginning, so ranges are no shorter than a quarter of the file's largest row group, nor
than a part in ``FILE_TASKS`` of the file: what all tasks decode together, and the footers they open, grow no faster than the documents.
``spark.readStream`` with the same options follows the folder: its offset is a resume token, the last file and the number of its
documents already read, so a query that restarts from its checkpoint goes on behind the last document that it committed.
Files are read in order of their names, and a file that appears later must have a later name (names with a time, as landing jobs write them).

Options: ``path``; ``pageSize`` (default 1000); ``pagesPerTask`` (default 100: the documents of one task, or more as above); ``since`` and
``sinceColumn``, which leave out documents whose column isn't above the mark (O03), row groups by their statistics first.
Columns: the collection's, ``source_file`` and ``document_no`` (place in its file).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..schemas import EXTRACT_PAGE_SIZE

#: Ranges of a row group, and of a file, at most.
GROUP_TASKS, FILE_TASKS = 4, 200
PLACE = [T.StructField("source_file", T.StringType()), T.StructField("document_no", T.LongType())]


@dataclass
class Pages(InputPartition):
    """Documents ``first`` to ``last`` (not included) of a file."""

    file: str
    first: int
    last: int


class Collection:
    """The files of a collection in order of their names."""

    def __init__(self, options: dict):
        from pyarrow import fs

        options = {k.lower(): v for k, v in options.items()}
        path = options.get("path")
        if not path:
            raise ValueError("paged_documents needs the option path")
        if path.startswith("file:") and not path.startswith("file://"):
            path = "file://" + path[len("file:"):]
        self.store, self.root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        self.page = int(options.get("pagesize", EXTRACT_PAGE_SIZE))
        self.task = self.page * int(options.get("pagespertask", 100))
        if self.page < 1 or self.task < self.page:
            raise ValueError("pageSize and pagesPerTask must be positive")
        self.since, self.column = options.get("since"), options.get("sincecolumn")
        if (self.since is None) != (self.column is None):
            raise ValueError("since and sinceColumn belong together")

    def files(self, after: str = "", upto: str | None = None) -> list[str]:
        """Names below the root, from ``after`` on, the later ones too if ``upto`` is not given."""
        from pyarrow import fs

        if self.store.get_file_info(self.root).type == fs.FileType.File:
            return [self.root]
        names = [f.path for f in self.store.get_file_info(fs.FileSelector(self.root, recursive=True)) if f.type == fs.FileType.File and f.base_name.endswith(".parquet")]
        hidden = [n for n in names if any(p.startswith(("_", ".")) for p in n[len(self.root):].split("/"))]
        return sorted(n for n in set(names).difference(hidden) if n >= after and (upto is None or n <= upto))

    def open(self, file: str) -> pq.ParquetFile:
        return pq.ParquetFile(self.store.open_input_file(file))

    def count(self, file: str) -> int:
        with self.open(file) as f:
            return f.metadata.num_rows

    def schema(self) -> pa.Schema:
        files = self.files()
        if not files:
            raise ValueError(f"no Parquet files in {self.root}: give a schema")
        with self.open(files[0]) as f:
            return f.schema_arrow

    def ranges(self, file: str, first: int, last: int | None = None) -> list[Pages]:
        with self.open(file) as f:
            m = f.metadata
            largest, rows = max((m.row_group(k).num_rows for k in range(m.num_row_groups)), default=0), m.num_rows
        least = max(self.task, -(-largest // GROUP_TASKS), -(-rows // FILE_TASKS))
        step, last = -(-least // self.page) * self.page, rows if last is None else last  # whole pages
        return [Pages(file, i, min(i + step, last)) for i in range(first, last, step)]

    def _groups(self, f: pq.ParquetFile, part: Pages) -> Iterator[tuple[int, int]]:
        """The row groups that hold documents of the range above the mark, with the number of their first document."""
        at = 0
        for k in range(f.metadata.num_row_groups):
            group = f.metadata.row_group(k)
            if at < part.last and at + group.num_rows > part.first and not self._below(f, group):
                yield k, at
            at += group.num_rows

    def _mark(self, kind: pa.DataType) -> pa.Scalar:
        return pa.scalar(self.since).cast(kind)

    def _below(self, f: pq.ParquetFile, group) -> bool:
        """Whether the statistics say that no document is above the mark."""
        if self.column is None:
            return False
        place = f.schema_arrow.get_field_index(self.column)
        stats = next((c.statistics for c in (group.column(i) for i in range(group.num_columns)) if c.path_in_schema == self.column), None)
        if stats is None or not stats.has_min_max:
            return False
        kind = f.schema_arrow.field(place).type
        return pa.scalar(stats.max, kind).as_py() <= self._mark(kind).as_py()

    def read(self, part: Pages) -> Iterator[pa.RecordBatch]:
        """The range's pages, each a batch of at most a page of documents."""
        with self.open(part.file) as f:
            for k, at in self._groups(f, part):
                for batch in f.iter_batches(self.page, row_groups=[k]):
                    if at >= part.last:
                        break
                    lo, hi = max(part.first - at, 0), min(part.last - at, batch.num_rows)
                    if lo < hi:
                        page = batch.slice(lo, hi - lo)
                        number = pa.array(range(at + lo, at + hi), pa.int64())
                        page = pa.RecordBatch.from_arrays([*page.columns, pa.array([part.file] * len(page)), number], [*page.schema.names, *(p.name for p in PLACE)])
                        if self.column is not None:
                            values = page.column(self.column)
                            page = page.filter(pc.fill_null(pc.greater(values, self._mark(values.type)), False))
                        if page.num_rows:
                            yield page
                    at += batch.num_rows


class _BatchReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> Sequence[InputPartition]:
        c = Collection(self.options)
        return [p for file in c.files() for p in c.ranges(file, 0)] or [Pages("", 0, 0)]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        if partition.file:
            yield from Collection(self.options).read(partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are ``{"file": last file read from, "documents": how many of its documents are read}``."""

    def __init__(self, options: dict):
        self.options = dict(options)

    def initialOffset(self) -> dict:
        return {"file": "", "documents": 0}

    def latestOffset(self) -> dict:
        c = Collection(self.options)
        files = c.files()
        return {"file": files[-1], "documents": c.count(files[-1])} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        c = Collection(self.options)
        parts: list[Pages] = []
        for file in c.files(start["file"], end["file"]):  # footers of new files alone
            first = start["documents"] if file == start["file"] else 0
            parts += c.ranges(file, first, end["documents"] if file == end["file"] else None)
        return parts or [Pages("", 0, 0)]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        if partition.file:
            yield from Collection(self.options).read(partition)


class PagedDocuments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_documents"

    def schema(self) -> T.StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        return T.StructType([*from_arrow_schema(Collection(self.options).schema(), prefer_timestamp_ntz=True).fields, *PLACE])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _BatchReader(self.options)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _StreamReader(self.options)


def register(spark: SparkSession) -> str:
    """Make the source known to the session; gives its format's name."""
    spark.dataSource.register(PagedDocuments)
    return PagedDocuments.name()
