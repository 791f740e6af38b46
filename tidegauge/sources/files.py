"""Folders of series files as a Spark data source: one file task for each series and year, dates pushed down to the files.

Layout: <path>/series_id=<name>/year=<year>/<files>, each file an array of records {"data": "dd/MM/yyyy", "valor": text}, or one
record a line. Filters on `date` leave out the years beyond them and then rows; filters on `series_id` leave out folders. A
file that cannot be read or parsed gives one row with its error and no date or value; as nothing is known about what it
holds, filters on `date` keep such rows. Numbers and dates that do not parse are NULL.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import date, datetime
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

SCHEMA = "series_id string, date date, value double, error string"
ARROW = pa.schema([("series_id", pa.string()), ("date", pa.date32()), ("value", pa.float64()), ("error", pa.string())])


@dataclass
class YearOfSeries(InputPartition):
    series_id: str
    year: int
    paths: list[str]

    def __init__(self, series_id: str, year: int, paths: list[str]):
        self.series_id, self.year, self.paths = series_id, year, paths


def _number(text) -> float | None:
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def _day(text) -> date | None:
    try:
        return datetime.strptime(text, "%d/%m/%Y").date()
    except (TypeError, ValueError):
        return None


def records(content: str) -> list[tuple[date | None, float | None]]:
    """An array of records, or one a line."""
    content = content.strip()
    found = json.loads(content) if content.startswith("[") else [json.loads(line) for line in content.splitlines() if line.strip()]
    return [(_day(r.get("data")), _number(r.get("valor"))) for r in found]


class SeriesReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path
        self.first, self.last = date.min, date.max  # both included
        self.names: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        day = lambda n: date.fromordinal(min(max(n, date.min.toordinal()), date.max.toordinal()))
        for f in filters:
            at = getattr(f, "attribute", None)
            if at == ("date",) and isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                self.first = max(self.first, day(f.value.toordinal() + isinstance(f, GreaterThan)))
            if at == ("date",) and isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                self.last = min(self.last, day(f.value.toordinal() - isinstance(f, LessThan)))
            if at == ("series_id",) and isinstance(f, (EqualTo, In)):
                names = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.names = names if self.names is None else self.names & names
            elif not (at == ("date",) and isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, EqualTo, IsNotNull))):
                yield f

    def _files(self):
        from pyarrow import fs

        where, root = fs.FileSystem.from_uri(self.path)
        return where, root, fs.FileSelector

    def partitions(self) -> list[YearOfSeries]:
        """Folders and file names only; which are wanted is told from their names."""
        where, root, selector = self._files()
        named = lambda path, key: unquote(path.rsplit("/", 1)[-1].removeprefix(f"{key}="))
        out = []
        for series in where.get_file_info(selector(root)):
            name = named(series.path, "series_id")
            if f"series_id={name}" != unquote(series.path.rsplit("/", 1)[-1]) or (self.names is not None and name not in self.names):
                continue
            for year in where.get_file_info(selector(series.path)):
                number = named(year.path, "year")
                if number.isdigit() and self.first.year <= int(number) <= self.last.year:
                    files = [f.path for f in where.get_file_info(selector(year.path)) if f.is_file and not f.base_name.startswith(("_", "."))]
                    out += [YearOfSeries(name, int(number), sorted(files))] if files else []
        return sorted(out, key=lambda p: (p.series_id, p.year)) or [YearOfSeries("", 0, [])]

    def read(self, partition: YearOfSeries) -> Iterator[pa.RecordBatch]:
        where = self._files()[0]
        for path in partition.paths:
            try:
                with where.open_input_stream(path) as f:
                    rows = records(f.read().decode("utf-8"))
                rows = [(d, v) for d, v in rows if d is None or self.first <= d <= self.last]
                rows = [(partition.series_id, d, v, None) for d, v in rows]
            except (OSError, ValueError, AttributeError) as e:
                rows = [(partition.series_id, None, None, f"{type(e).__name__} in {path.rsplit('/', 1)[-1]}")]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)


class SeriesFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "series_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SeriesReader:
        return SeriesReader(self.options["path"])


def series_files(spark: SparkSession, path: str) -> DataFrame:
    """(series_id, date, value, error) of a folder of series files, read as described above."""
    spark.dataSource.register(SeriesFiles)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("series_files").load(path)


def write_series_files(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """(series_id, date, value) as such files, one for each series and year."""
    record = F.to_json(F.struct(F.date_format("date", "dd/MM/yyyy").alias("data"), F.col("value").cast("string").alias("valor")))
    rows = df.select(F.col("series_id"), F.year("date").alias("year"), record.alias("record"))
    rows.repartition("series_id", "year").write.mode(mode).partitionBy("series_id", "year").text(path)


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that spark.checkpoint.dir names; where it is unset, in a local session, in the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root if '://' in root else 'file://' + root.removeprefix('file:')}/tidegauge/{label}-{uuid.uuid4().hex}"
