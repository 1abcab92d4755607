"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Call sites are not recorded for every column expression: plans are built twice as fast.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    STATE_STORE:
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_root: str | None = None


def get_session(app: str = "adtally", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs were written for; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master without that setting (tests) falls back to a temporary folder:
    executors of a real cluster could not see one.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="adtally-")
    return _local_root


#: Folder of the job that runs now, below the application's.
_job: contextvars.ContextVar[str] = contextvars.ContextVar("job", default="")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses.

    The paths of one application share a folder, and those of a job (``owns_scratch``) a folder in it.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/adtally/{application}/{_job.get()}{name}-{uuid.uuid4().hex}"


def _store(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in any store that Spark can reach."""
    store, folder = _store(spark, path)
    store.delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    store, folder = _store(spark, path)
    return store.exists(folder)


@contextlib.contextmanager
def job_scratch(spark: SparkSession):
    """What is materialized within goes when the block ends; its results must be stored elsewhere by then."""
    name = f"job-{uuid.uuid4().hex}/"
    token = _job.set(_job.get() + name)
    path = f"{shared_root(spark)}/adtally/{spark.sparkContext.applicationId}/{_job.get()}"
    try:
        yield
    finally:
        _job.reset(token)
        drop_folder(spark, path)


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Settings of the session that hold within the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def owns_scratch(job):
    """A job (first argument: the session) that returns no DataFrame and leaves no scratch tables."""
    @functools.wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        with job_scratch(spark):
            return job(spark, *args, **kwargs)

    return run


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Later uses read the files: the lineage ends there, so a lost executor costs a re-read and
    not a recomputation, and several consumers share one computation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
