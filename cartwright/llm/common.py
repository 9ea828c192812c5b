"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.session import scratch_path

ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
         "boolean": pa.bool_(), "binary": pa.binary()}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def utf8(text_col: str = "text"):
    """The text as UTF-8 bytes; NULL counts as the empty text."""
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")


def as_text(raw: bytes) -> str:
    return raw.decode("utf-8", "replace")


def id_type(docs: DataFrame, id_col: str) -> str:
    return docs.schema[id_col].dataType.simpleString()


def map_texts(docs: DataFrame, make: Callable[[], Callable[[bytes], tuple]], fields: list[tuple[str, str]],
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One output row per document: ``make()`` runs once a task and returns a
    function from the UTF-8 text to the values of ``fields``.  Only the id and
    the text leave the scan, so further columns of ``docs`` never clash."""
    kinds = [(n, ARROW[t]) for n, t in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            rows = [fn(x.as_py()) for x in batch.column(1)]
            cols = zip(*rows) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), type=k) for c, (_, k) in zip(cols, kinds))],
                names=[id_col, *(n for n, _ in kinds)])

    schema = ", ".join([f"`{id_col}` {id_type(docs, id_col)}", *(f"`{n}` {t}" for n, t in fields)])
    return docs.select(F.col(f"`{id_col}`"), utf8(text_col).alias("_utf8")).mapInArrow(run, schema)


class Memo(dict):
    """Remembers a function's values of short strings in two generations of
    bounded size, so what occurs often stays remembered."""

    def __init__(self, fn, entries: int = 400_000):
        super().__init__()
        self.fn, self.entries, self.old = fn, entries, {}

    def __missing__(self, part: str):
        if (value := self.old.get(part)) is None:
            value = self.fn(part)
        if len(part) <= 64:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[part] = value
        return value


def materialize(df: DataFrame, name: str, compression: str = "zstd", rows_a_file: int = 0) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts the lineage
    in a way that survives lost executors.  ``rows_a_file`` bounds the rows of
    a file, for rows that are large."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).option("maxRecordsPerFile", rows_a_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
