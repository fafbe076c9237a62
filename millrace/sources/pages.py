"""Stored pages as a source of their own: partitions by year and code, filters that prune them, and a stream with offsets.

Pages are stored batch by batch under path/batch=<n>/year=<y>/code=<c>/. A scan asks the source for years and codes, and reads the folders of these
alone, one partition each; a stream's offset is the number of batches it has read. The source reads its folder by pyarrow's file
systems, so paths that these know.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

NAME = "millrace_pages"
SCHEMA = "page_id bigint, url string, html string, year int, code string"


def store(pages: DataFrame, path: str, batch: int) -> None:
    """Store a batch of pages (page_id, url, html, year, code) under its number; the same batch again takes its own place."""
    pages.select("page_id", "url", "html", "year", "code").write.mode("overwrite").partitionBy("year", "code").parquet(f"{path}/batch={batch}")


@dataclass
class Folder(InputPartition):
    path: str
    year: int
    code: str


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _batches(path: str) -> list[int]:
    """The numbers of the batches that are there as a whole."""
    from pyarrow import fs

    system, root = _filesystem(path)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    numbers = [int(f.base_name.removeprefix("batch=")) for f in found if f.base_name.startswith("batch=")]
    return sorted(n for n in numbers if system.get_file_info(f"{root}/batch={n}/_SUCCESS").type == fs.FileType.File)


def _folders(path: str, batches: list[int], years: set[int] | None, codes: set[str] | None) -> list[Folder]:
    from urllib.parse import unquote

    from pyarrow import fs

    system, root = _filesystem(path)
    out = []
    for n in batches:
        for y in system.get_file_info(fs.FileSelector(f"{root}/batch={n}")):
            year = y.base_name.removeprefix("year=")
            if not year.isdigit() or years is not None and int(year) not in years:
                continue
            for c in system.get_file_info(fs.FileSelector(y.path)):
                code = unquote(c.base_name.removeprefix("code="))
                if codes is None or code in codes:
                    out.append(Folder(c.path, int(year), code))
    return out


def _read(path: str, part: Folder) -> Iterator:
    """The rows of a folder as record batches of bounded size."""
    import pyarrow as pa
    import pyarrow.dataset as ds

    system, _ = _filesystem(path)
    for b in ds.dataset(part.path, format="parquet", filesystem=system).to_batches(columns=["page_id", "url", "html"], batch_size=1024):
        n = b.num_rows
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part.year] * n, pa.int32()), pa.array([part.code] * n, pa.string())], ["page_id", "url", "html", "year", "code"])


def _asked(options: dict) -> tuple[set[int] | None, set[str] | None]:
    years, codes = options.get("years"), options.get("codes")
    return {int(y) for y in years.split(",")} if years else None, set(codes.split(",")) if codes else None


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.years, self.codes = _asked(options)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters on year and code narrow the folders; others stay with Spark."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else set()
            if column == "year":
                self.years = values if self.years is None else self.years & values
            elif column == "code":
                self.codes = values if self.codes is None else self.codes & values
            else:
                yield f

    def partitions(self) -> list[Folder]:
        return _folders(self.path, _batches(self.path), self.years, self.codes)

    def read(self, partition: Folder) -> Iterator:
        return _read(self.path, partition) if partition else iter(())


class PageStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.years, self.codes = _asked(options)

    def initialOffset(self) -> dict:
        return {"batches": -1}

    def latestOffset(self) -> dict:
        return {"batches": max(_batches(self.path), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[Folder]:
        return _folders(self.path, [n for n in _batches(self.path) if start["batches"] < n <= end["batches"]], self.years, self.codes)

    def read(self, partition: Folder) -> Iterator:
        return _read(self.path, partition)

    def commit(self, end: dict) -> None:
        pass


class PageSource(DataSource):
    """Options: path, and years and codes as lists with commas; without them all are read."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)

    def streamReader(self, schema) -> PageStream:
        return PageStream(self.options)


def _options(path: str, years: list[int] | None, codes: list[str] | None) -> dict[str, str]:
    return {"path": path} | ({"years": ",".join(map(str, years))} if years else {}) | ({"codes": ",".join(codes)} if codes else {})


def scan(spark: SparkSession, path: str, years: list[int] | None = None, codes: list[str] | None = None) -> DataFrame:
    """The stored pages of these years and codes (all where none are given), narrowed by filters on them; other folders are not opened. The
    session's setting for filters of such sources is turned on, and has to stay so until the scan has run."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageSource)
    return spark.read.format(NAME).options(**_options(path, years, codes)).load()


def stream(spark: SparkSession, path: str, years: list[int] | None = None, codes: list[str] | None = None) -> DataFrame:
    """The same as a stream of the batches as they come."""
    spark.dataSource.register(PageSource)
    return spark.readStream.format(NAME).options(**_options(path, years, codes)).load()
