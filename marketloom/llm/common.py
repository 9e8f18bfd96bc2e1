"""Helpers shared by the operators: tables in the shared folder, word rules, 64-bit mixing."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BATCH_BYTES = 4 << 20  # of the batches in which Python tasks get texts


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without that setting gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="corpus-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(frame: DataFrame) -> DataFrame:
    """The frame written once as Parquet in the shared folder and read again: later steps start from there."""
    path = f"{shared_folder(frame.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_table(spark: SparkSession, ddl: str, rows: list[tuple]) -> DataFrame:
    """Rows of the driver as a local relation; as a list they would be read by Python workers of their own in every executor."""
    schema = T.StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def small_batches(spark: SparkSession) -> None:
    """Lets Python tasks get rows in batches of about ``BATCH_BYTES``, unless the session has a limit of its own.

    Spark's limit of 64 MB makes one batch of most partitions of texts, which executor and worker then both hold.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def id_residue(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def utf8(column: str = "text") -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values, so that all bits of a sum or product depend on all its input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
