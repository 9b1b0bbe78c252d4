"""Small text files that are created once, whole or not at all, in a folder that all drivers share.

They are the commit marks of stored state: what a load has written counts once
its mark exists, and of several drivers that try for one mark a single one gets
it. On ``file:`` a hard link decides, elsewhere Hadoop's rename without
overwriting, which HDFS makes atomic. Object stores without an atomic rename
are for one writer at a time.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _file_system(spark, path)
    return bool(files.exists(at))


def _link(target: str, text: str) -> bool:
    folder = os.path.dirname(target)
    os.makedirs(folder, exist_ok=True)
    draft = os.path.join(folder, f".{uuid.uuid4().hex}")
    with open(draft, "w", encoding="utf-8") as out:
        out.write(text)
    try:
        os.link(draft, target)
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)
    return True


def _rename(spark: SparkSession, path: str, text: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, files = _file_system(spark, path)
    draft = hadoop.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = files.create(draft)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, target, options)
    except Exception:
        # Lost to another writer only if the mark is there; any other failure is the caller's.
        files.delete(draft, False)
        if files.exists(target):
            return False
        raise
    return True


def put_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create the mark with its text; False where it exists already."""
    at, files = _file_system(spark, path)
    if files.getUri().getScheme() == "file":
        return _link(at.toUri().getPath(), text)
    return _rename(spark, path, text)


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """The texts of all marks of a folder, read in one job; drafts begin with a dot and are not seen."""
    if not exists(spark, folder):
        return spark.createDataFrame([], "value string")
    return spark.read.text(folder, wholetext=True).select(F.col("value"))
