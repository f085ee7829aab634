"""Session helpers: UTC clock, sane shuffle sizing, shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(master: str | None = None, app: str = "aerosift", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session configured for this library.

    On a cluster, pass ``master=None`` and let spark-submit decide; the
    library only pins the settings its semantics depend on (UTC) and turns
    on adaptive execution (coalescing, skew-join splitting, runtime
    broadcast conversion with the size threshold as the guard).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": UTC,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    compiled_steps(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Epoch <-> timestamp_ntz conversions are defined in UTC (as in the warehouse)."""
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def compiled_steps(spark: SparkSession) -> None:
    """Let the JVM compile what Spark generates for wide rows.

    HotSpot never compiles a method of more than 8,000 bytes; Spark accepts generated ones of up to 65,535, which then
    run interpreted, several times slower. Beyond this limit Spark runs its operators one by one, as smaller methods.
    A limit that the session set itself stays."""
    if spark.conf.get(METHOD_LIMIT) == "65535":
        spark.conf.set(METHOD_LIMIT, "8000")


@contextlib.contextmanager
def shuffles_released(spark: SparkSession):
    """Actions inside delete their shuffle files as they end; the session's setting is as before afterwards.

    Otherwise the files of a step that is already written stay until the driver's collector happens to find its plan
    unreachable, which may be never in a short job. Frames inside are to be run once each or stored (``materialize``)."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """The session's settings inside; they are as before afterwards."""
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: ``spark.checkpoint.dir`` of the session.

    Where it is unset (tests, laptops) the folder ``_scratch`` inside the SQL
    warehouse is used, which is as shared as the session's own tables. The
    session's settings are not changed.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder. It is registered for deletion when
    the driver's JVM ends, because lazy frames may read it until then."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(jpath)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(jpath, True)


def materialize(df, name: str, partition_by: list[str] | None = None):
    """Cut lineage: write ``df`` as Parquet under the shared checkpoint folder
    and return the re-read table (column pruning, statistics, and it survives
    the loss of any executor, unlike a cache or a local checkpoint). Rows that
    are read slice by slice are stored by ``partition_by``, so each is read once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if not partition_by:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def python_workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it: for local mode and shared
    installations; elsewhere pass ``--py-files`` to spark-submit. Needed by the one Python operator of the position layers."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)
