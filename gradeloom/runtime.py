"""Session helpers: local sessions, shared scratch space and path checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
LOCAL_SHARED_DIR = "/tmp/checkpoints/gradeloom"

# Whole texts go to Python in batches of at most so many rows: a batch is held by the Java VM
# and by Python at once, and 10,000 texts (the default) take tens of MB in each, per task.
TEXT_BATCH_ROWS = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

# The same for rows that are large themselves; Spark's own bound is 64 MB.
BATCH_BYTES = 4 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


# Settings every session of this package should have. The Java VM leaves methods
# above 8000 bytes uncompiled, so a stage that would need one is better split.
SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Give a running session the settings this package is tuned for."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def bound_text_batches(spark: SparkSession, rows: int = TEXT_BATCH_ROWS) -> None:
    """Hold the session's Arrow batches to ``rows`` rows; a smaller bound stays."""
    if not 0 < int(spark.conf.get(_BATCH_ROWS)) <= rows:
        spark.conf.set(_BATCH_ROWS, str(rows))


def bound_batch_bytes(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Hold the session's Arrow batches to about ``most`` bytes, unless it has a bound of its own."""
    if spark.conf.get(_BATCH_BYTES, None) in (None, "-1b", f"{64 << 20}b"):
        spark.conf.set(_BATCH_BYTES, f"{most}b")


def local_session(name: str = "gradeloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    settings = {
        **SESSION_SETTINGS,
        _CHECKPOINT_DIR: LOCAL_SHARED_DIR,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        # Files of checkpoints go when nothing refers to them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_one_machine(spark: SparkSession) -> bool:
    """True when driver and executors are one process, so that any folder is shared."""
    return spark.sparkContext.master.split("[")[0] == "local"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A checkpoint folder set on the context counts too. Without both this fails, on any
    master.
    """
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
    if chosen.isDefined():
        return chosen.get()
    raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder shared by all executors")


def ensure_shared_dir(spark: SparkSession, path: str = LOCAL_SHARED_DIR) -> None:
    """Name a folder for a one-machine session that has none; a named one stays."""
    context = spark.sparkContext
    if spark.conf.get(_CHECKPOINT_DIR, None) or context._jsc.sc().getCheckpointDir().isDefined():
        return
    if is_one_machine(spark):
        context.setCheckpointDir(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def prepare_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, with reliable files in the shared folder."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(spark))


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so that it is evaluated once.

    Survives lost executors. The files go when the session ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    system, jvm_path = _file_system(spark, path)
    system.deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder if it is there."""
    system, jvm_path = _file_system(spark, path)
    system.delete(jvm_path, True)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file unless there is one; True for the one who made it.

    The file appears whole under its name, or not at all, and only one writer can make it.
    """
    system, jvm_path = _file_system(spark, path)
    try:
        out = system.create(jvm_path, False)
    except Exception as error:  # of the file system, whichever it is
        if system.exists(jvm_path):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the file or folder exists on whatever file system it names."""
    system, jvm_path = _file_system(spark, path)
    return bool(system.exists(jvm_path))


def is_complete(spark: SparkSession, path: str) -> bool:
    """True for a plain file, or a folder whose write has been committed."""
    system, jvm_path = _file_system(spark, path)
    if not system.exists(jvm_path):
        return False
    if system.getFileStatus(jvm_path).isFile():
        return True
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when it does not exist."""
    system, jvm_path = _file_system(spark, path)
    if not system.exists(jvm_path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(jvm_path))
