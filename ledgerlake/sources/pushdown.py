"""Landed pages behind a zone map, read through a data source that takes filters.

Landing writes pages (JSON documents, records under `value`; a file each, or lines of a file that several share) and, beside them, a zone map: of each page
its file and place there, its part (a window or a series), its rows and the least and greatest value of the columns that pulls go by. The source answers a
filter like the service would: pages whose zones can't meet it are not read, rows that don't meet it are not sent, and what it can't evaluate is handed back to Spark. One input partition is one part.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from datetime import date, datetime
from decimal import Decimal

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringStartsWith

from ..plans.stages import discard, stage

ZONES, PART = "_zones", "_part"


def land_zoned(rows: DataFrame, part: Column, page: Column, path: str, zoned: list[str], bundle: Column | None = None) -> None:
    """Write rows as pages of records and their zone map. part: the window or series; page: bounds what a page holds; bundle: the pages of a part that share
    a file, one a line (without it each page is a file), so that the number of files need not follow that of pages."""
    spark = rows.sparkSession
    ends = [f(F.col(c)).alias(f"{name}_{c}") for c in zoned for f, name in ((F.min, "least"), (F.max, "greatest"))]
    named = rows.select(part.cast("string").alias("part"), (page if bundle is None else bundle).cast("string").alias("bundle"), page.cast("string").alias("page"), F.struct("*").alias("r"), *[F.col(c) for c in zoned])
    pages = stage(named.groupBy("part", "bundle", "page").agg(F.to_json(F.struct(F.collect_list("r").alias("value"))).alias("value"), F.count("*").alias("n"), *ends), "zoned-pages")
    # lines lie in the order of their pages, so a page begins behind the bytes of those before it, each with its line end
    pages.repartition("part", "bundle").sortWithinPartitions("part", "bundle", "page").select("value", "part", "bundle").write.partitionBy("part", "bundle").text(path)
    files = spark.read.schema("value string, part string, bundle string").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("part").alias("_p"), F.col("bundle").alias("_b")).distinct()
    before = Window.partitionBy("part", "bundle").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    size = F.octet_length("value").cast("bigint")
    placed = pages.withColumns({"size": size, "at": F.coalesce(F.sum(size + 1).over(before), F.lit(0))}).drop("value")
    placed.join(files, F.col("part").eqNullSafe(F.col("_p")) & F.col("bundle").eqNullSafe(F.col("_b"))).select("file", "at", "size", "part", "n", *[f"{name}_{c}" for c in zoned for name in ("least", "greatest")]).write.parquet(f"{path}/{ZONES}")
    discard(pages)


RUN = 4 << 20  # bytes that are read at once: neighbouring pages, or one page that is larger


class Part(InputPartition):
    """A part's pages as runs of neighbours: file, first byte, bytes."""

    def __init__(self, name: str, runs: list[tuple[str, int, int]]) -> None:
        super().__init__(name)
        self.runs = runs


def _compare(kind: type, values: pa.Array, to) -> pa.Array | None:
    """Which values meet a comparison; null where they are null."""
    tests = {GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less, LessThanOrEqual: pc.less_equal, EqualTo: pc.equal}
    return tests[kind](values, pa.scalar(to, values.type))


def _meets(f: Filter, rows: pa.Table) -> pa.Array:
    values = rows.column(f.attribute[0])
    if isinstance(f, IsNotNull):
        return pc.is_valid(values)
    if isinstance(f, In):
        return pc.is_in(values, pa.array([v for v in f.value if v is not None], values.type))
    if isinstance(f, StringStartsWith):
        return pc.starts_with(values, f.value)
    return _compare(type(f), values, f.value)


def _may_meet(f: Filter, least, greatest) -> bool:
    """Whether a page whose values lie in [least, greatest] can hold a row that meets f; a page of nulls alone can't."""
    if least is None:
        return False
    if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
        return greatest > f.value or (greatest == f.value and isinstance(f, GreaterThanOrEqual))
    if isinstance(f, (LessThan, LessThanOrEqual)):
        return least < f.value or (least == f.value and isinstance(f, LessThanOrEqual))
    if isinstance(f, EqualTo):
        return least <= f.value <= greatest
    if isinstance(f, In):
        return any(v is not None and least <= v <= greatest for v in f.value)
    if isinstance(f, StringStartsWith):
        return least[: len(f.value)] <= f.value <= greatest[: len(f.value)]
    return True


TAKEN = (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, EqualTo, In, IsNotNull, StringStartsWith)
PLAIN = (str, int, float, bool, date, datetime, Decimal)


class ZonedReader(DataSourceReader):
    def __init__(self, path: str, schema, order: str | None) -> None:
        from pyspark.sql.pandas.types import to_arrow_schema

        self.path, self.schema, self.order, self.filters = path, to_arrow_schema(schema), order, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802 - the API's name
        for f in filters:
            known = isinstance(f, TAKEN) and not isinstance(f, EqualNullSafe) and len(f.attribute) == 1 and f.attribute[0] in self.schema.names
            values = f.value if isinstance(f, In) else [getattr(f, "value", None)]
            if known and (isinstance(f, IsNotNull) or all(isinstance(v, PLAIN) for v in values if v is not None or not isinstance(f, In))):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Part]:
        where, path = fs.FileSystem.from_uri(f"{self.path}/{ZONES}")
        files = sorted(x.path for x in where.get_file_info(fs.FileSelector(path)) if x.path.endswith(".parquet"))
        runs: dict[tuple[str, str], list[list[int]]] = {}
        for batch in (b for file in files for b in pq.ParquetFile(file, filesystem=where).iter_batches(10_000)):
            for z in batch.to_pylist():
                if all(_may_meet(f, z[f"least_{c}"], z[f"greatest_{c}"]) for f in self.filters if f"least_{(c := f.attribute[0])}" in z):
                    runs.setdefault((z["part"], z["file"]), []).append([z["at"], z["size"]])
        parts: dict[str, list[tuple[str, int, int]]] = {}
        for (name, file), pages in sorted(runs.items()):
            at, size = 0, -1
            for first, n in sorted(pages):
                if size >= 0 and first == at + size + 1 and size + 1 + n <= RUN:
                    size += 1 + n
                    continue
                if size >= 0:
                    parts.setdefault(name, []).append((file, at, size))
                at, size = first, n
            parts.setdefault(name, []).append((file, at, size))
        return [Part(name, at) for name, at in parts.items()]

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        tables = (page for run in partition.runs for page in self._pages(*run, partition.value)) if partition else ()
        if self.order:  # a part in order of its key, as pulls by series need it
            tables = list(tables)
            tables = [pa.concat_tables(tables).sort_by(self.order)] if tables else []
        for rows in tables:
            yield from rows.to_batches(max_chunksize=10_000)

    def _pages(self, file: str, at: int, size: int, part: str) -> Iterator[pa.Table]:
        where, path = fs.FileSystem.from_uri(file)
        with where.open_input_file(path) as f:
            text = f.read_at(size, at)
        for line in text.split(b"\n"):
            yield self._page(json.loads(line, parse_float=Decimal)["value"], part)

    def _page(self, records: list[dict], part: str) -> pa.Table:
        rows = pa.Table.from_arrays([self._values([part if c.name == PART else r.get(c.name) for r in records], c.type) for c in self.schema], schema=self.schema)
        for f in self.filters:
            rows = rows.filter(_meets(f, rows))
        return rows

    @staticmethod
    def _values(values: list, kind: pa.DataType) -> pa.Array:
        if pa.types.is_date(kind) or pa.types.is_timestamp(kind):
            return pa.array(values, pa.string()).cast(kind)
        if pa.types.is_decimal(kind):
            unit = Decimal(1).scaleb(-kind.scale)
            return pa.array([None if v is None else Decimal(v).quantize(unit) for v in values], kind)
        if pa.types.is_floating(kind):
            return pa.array([None if v is None else float(v) for v in values], kind)
        return pa.array(values, kind)


class ZonedPages(DataSource):
    """spark.read.format("zoned_pages").schema(...).option("order", column).load(path)"""

    @classmethod
    def name(cls) -> str:
        return "zoned_pages"

    def schema(self) -> str:
        raise ValueError("zoned_pages needs a schema")

    def reader(self, schema) -> ZonedReader:
        return ZonedReader(self.options["path"], schema, self.options.get("order"))


def read_zoned(spark: SparkSession, path: str, schema: str, order: str | None = None) -> DataFrame:
    """Landed pages with their zone map, as a source that takes filters; order: a column by which each part's rows come sorted."""
    spark.dataSource.register(ZonedPages)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("zoned_pages").schema(f"{schema}, {PART} string")
    # a frame that was read with a filter keeps it for a later read without any, so each read brings one: the part, which is never null
    return (reader.option("order", order) if order else reader).load(path).where(F.col(PART) >= "").drop(PART)


def files_met(spark: SparkSession, path: str, condition: str) -> DataFrame:
    """The zone map's pages with `met`, whether a pull by condition (over least_ and greatest_ columns) opens them."""
    return spark.read.parquet(f"{path}/{ZONES}").withColumn("met", F.coalesce(F.expr(condition), F.lit(False)))
