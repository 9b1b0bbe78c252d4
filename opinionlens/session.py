"""Session defaults for local runs and the shared working folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Stored bytes of a part that `spread` makes at most on average; texts are some three times as long.
SPREAD_BYTES = 16 << 20


def local_session(cores: str | int = "*", app: str = "opinionlens") -> SparkSession:
    """Single-JVM session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a session of a single JVM may leave the setting out, as in tests: it
    gets a folder of its own, removed when the driver's Python ends. (The
    setting itself cannot be changed once a session runs.)
    """
    path = spark.conf.get(CHECKPOINT_KEY, None)
    if path:
        return path
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = tempfile.mkdtemp(prefix="opinionlens-")
        atexit.register(shutil.rmtree, _OWN_DIRS[app], ignore_errors=True)
    return _OWN_DIRS[app]


def materialize(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage, survives lost executors, and tells Catalyst the
    true size of the data, so that joins with it are broadcast only when the
    files really are under ``spark.sql.autoBroadcastJoinThreshold``. All stages
    of an application share one folder, which can be removed when it has ended.
    Shuffle files of the write go with its end, not when the driver collects garbage.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark).rstrip('/')}/opinionlens-{app}/stage-{uuid.uuid4().hex}"
    writer = df.write if compression is None else df.write.option("compression", compression)
    before = spark.conf.get(CLEANUP_KEY, "false")
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(CLEANUP_KEY, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a table that ``materialize`` has written and nothing will read again."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if not re.search(r"/opinionlens-[^/]+/stage-[0-9a-f]{32}$", folder):
            raise ValueError(f"{folder} is not a stage of this application")
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def spread(df: DataFrame, key: str, joined: bool = False) -> DataFrame:
    """Use all cores on an input that arrives in too few files, in parts that do not grow with it.

    A file with one row group is one task whatever its size. Inputs of many
    files are left alone, without a shuffle; so are those of no file at all.
    Of the files only names and lengths are read.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    files = df.inputFiles()
    if not files or (len(files) >= cores and not joined):
        return df
    stored = spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0] or 0
    # A join keeps this partitioning only if it has no fewer parts than its own.
    least = int(spark.conf.get("spark.sql.shuffle.partitions")) if joined else 0
    return df.repartition(max(cores, least, -(-stored // SPREAD_BYTES)), key)
