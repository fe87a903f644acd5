"""Written intermediate tables in the folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import io
import re
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ARROW_BYTES = 8 << 20  # of an Arrow batch


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Where spark.checkpoint.dir is unset, a temporary one if there is one machine only; else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="quern-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialize(df: DataFrame, name: str, row_group: int | None = None) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back.

    This cuts the lineage: a lost executor costs at most a re-read of files that all executors see.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/quern-{name}-{uuid.uuid4().hex}"
    w = df.write.option("parquet.block.size", row_group) if row_group else df.write
    w.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quern_path = path
    return out


def reads(df: DataFrame, *tables: DataFrame | None) -> DataFrame:
    """df, which notes the written tables that it reads: discard(df) deletes them too, once df's rows are elsewhere."""
    df._quern_reads = [*getattr(df, "_quern_reads", []), *tables]
    return df


def discard(df: DataFrame | None) -> None:
    """Deletes a table that materialize() wrote and that nothing reads any more, and what reads() noted for df."""
    for t in getattr(df, "_quern_reads", []):
        discard(t)
    path = getattr(df, "_quern_path", None)
    if path:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def ship(spark: SparkSession) -> None:
    """Sends the package to the Python workers, once a session, so that it need not be installed on the executors."""
    context = spark.sparkContext
    root = Path(__file__).resolve().parent
    if getattr(context, "_quern_shipped", False) or not root.is_dir():  # within an archive it has been sent already
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(str(p.relative_to(root.parent))), p.read_bytes())
    path = Path(tempfile.mkdtemp(prefix="quern-package-"), f"quern-{zlib.crc32(data.getvalue()):08x}.zip")
    path.write_bytes(data.getvalue())
    context.addPyFile(str(path))
    context._quern_shipped = True


def mapped(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """mapInArrow with batches that are bounded by bytes, and with the package on the executors."""
    spark = df.sparkSession
    ship(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > ARROW_BYTES:
        spark.conf.set(name, str(ARROW_BYTES))
    return df.mapInArrow(run, schema)
