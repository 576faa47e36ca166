"""Small helpers that the operators share."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segstream.session import ensure_checkpoint_dir, shared_root

#: Where the public vocabulary files lie when the caller names none.
TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package (as ``--py-files`` would), unless
    they inherit its place in PYTHONPATH."""
    sc, top = spark.sparkContext, Path(__file__).resolve().parents[2]
    paths = [Path(p or ".").resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if top in paths or getattr(sc, "_segstream_shipped", False):
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for f in sorted((top / "segstream").rglob("*.py")):
            z.write(f, f.relative_to(top).as_posix())
    sc.addPyFile(write_shared(spark, f"{fresh_folder(spark, 'package')}/segstream-{uuid.uuid4().hex}.zip", data.getvalue()))
    sc._segstream_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """A-Z only; other letters keep their case."""
    return F.translate(col, UPPER, LOWER)


def with_outputs(df: DataFrame, **outputs: Column) -> DataFrame:
    """``df`` plus the output columns; input columns of the same name (in any
    case) give way to them."""
    taken = {k.lower() for k in outputs}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[v.alias(k) for k, v in outputs.items()])


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder URI below the shared folder, seen by all executors."""
    return f"{shared_root(spark)}/llm-{label}-{uuid.uuid4().hex}"


def write_shared(spark: SparkSession, uri: str, data: bytes) -> str:
    """Put driver-side bytes at ``uri`` through Hadoop's file system API."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        for i in range(0, len(data), 1 << 22):
            out.write(bytearray(data[i : i + (1 << 22)]))
    finally:
        out.close()
    return uri


def delete_shared(spark: SparkSession, uri: str) -> None:
    """Delete a folder of this module's making, if it is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written to a new folder and read back, and the folder."""
    folder = fresh_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def settle(df: DataFrame, label: str, *scratch: str) -> DataFrame:
    """``df`` written to a new folder and read back, after which the ``scratch``
    folders that it was made from are deleted."""
    out, _ = written(df, label)
    for uri in scratch:
        delete_shared(df.sparkSession, uri)
    return out
