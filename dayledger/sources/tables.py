"""Driver table access: one parquet file per table, read with an explicit column
list so only the needed columns leave the scan (column pruning is then visible
as ``ReadSchema`` in the plan)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


#: Schemas by path, and the change time of the path they were read at.
_SCHEMAS: dict[tuple[str, str], tuple[int, StructType]] = {}


def _changed_at(spark: SparkSession, path: str) -> int:
    """The modification time of a file or folder, by the store's own client."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = there.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getFileStatus(there).getModificationTime()


def known_schema(spark: SparkSession, path: str) -> StructType:
    """The schema of a Parquet path, read from a footer once for as long as the
    path stays unchanged: inferring it is a job, and a model reads many tables.
    The files themselves are listed anew at every read."""
    key, at = (spark.sparkContext.applicationId, path), _changed_at(spark, path)
    held = _SCHEMAS.get(key)
    if held is None or held[0] != at:
        held = _SCHEMAS[key] = (at, spark.read.parquet(path).schema)
    return held[1]


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Read one driver table; ``columns`` projects at the scan."""
    path = table_path(sf_dir, name)
    df = spark.read.schema(known_schema(spark, path)).parquet(path)
    return df.select(*columns) if columns else df


#: Rows of the named table for which a join or an aggregate gets one task, about.
ROWS_PER_TASK = 300_000


def dealt(spark: SparkSession, sf_dir: str, larger: str, *sides: tuple) -> list[DataFrame]:
    """The sides of a join (or what is aggregated), each with its keys, dealt by them
    over as many tasks as the rows of the table ``larger`` ask for, so that a task's
    memory does not grow with the input. Where the session's number of partitions is
    enough, as they are: the work then stays Spark's to plan. The rows are counted
    from the file footers."""
    n = -(-read_table(spark, sf_dir, larger).count() // ROWS_PER_TASK)
    if n <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return [side for side, *_ in sides]
    return [side.repartition(n, *keys) for side, *keys in sides]
