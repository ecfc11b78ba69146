"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# A stage that cleans, snaps and joins in one pass becomes one long generated method; by
# default the JVM leaves methods of that length uncompiled and interprets them.
JIT_OPTION = "-XX:-DontCompileHugeMethods"


def get_session(app: str = "tidemark", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution and UTC; everything else is the cluster's business.

    Shuffle partition counts are left to AQE, which starts high and coalesces.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.extraJavaOptions": JIT_OPTION,
        "spark.executor.extraJavaOptions": JIT_OPTION,
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


METHOD_LIMIT_CONF = "spark.sql.codegen.hugeMethodLimit"
# Bytes of a method above which the JVM does not compile it, unless told to by ``JIT_OPTION``.
COMPILED_BYTES = "8000"


def keep_methods_compiled(spark: SparkSession) -> None:
    """Have long stages run as several methods that get compiled, in a session started without ``JIT_OPTION``.

    A limit that the session has set itself stays.
    """
    if spark.conf.get(METHOD_LIMIT_CONF, "65535") == "65535" and JIT_OPTION not in (spark.conf.get("spark.executor.extraJavaOptions", None) or ""):
        spark.conf.set(METHOD_LIMIT_CONF, COMPILED_BYTES)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster the
    executors would each see their own disk.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set(CHECKPOINT_CONF, base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whichever Hadoop file system it names."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write a frame as Parquet and read it back: later plans start at the written files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
