"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the screen relies on; anything already set by the cluster wins.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerscreen") -> SparkSession:
    """Return the active session or build one (local runs and tests)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor; give it real memory
        b = b.config("spark.driver.memory", os.environ.get("LEDGERSCREEN_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is only
    read.  When it is unset a private folder is created for a local master (tests,
    a laptop); on any other master that is an error, as executors would write
    what the driver and other executors cannot read.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerscreen-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerscreen`` importable in every Python worker (the forest fit
    and the scoring pass run package code there), like ``--py-files``.

    The zip is built on the driver and handed to ``addPyFile``; Spark serves
    it to the executors.  Done once per application."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    import ledgerscreen
    root = os.path.dirname(os.path.dirname(os.path.abspath(ledgerscreen.__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerscreen-pkg-"), "ledgerscreen.zip")
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(os.path.join(root, "ledgerscreen")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def prepare(spark: SparkSession) -> str:
    """Everything a session needs before running the screen: the package on
    the workers and the shared checkpoint folder.  Returns the folder."""
    ship_package(spark)
    return checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for written intermediate tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


#: A side of a join is broadcast only while it is counted to have no more rows.
BROADCAST_ROWS = 1_000_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read back: computed once, lineage cut."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_side(df: DataFrame, name: str) -> DataFrame:
    """The side of a join that is made by an aggregate or a filter, stored and counted.

    The planner takes such a side to be as large as the table below it and shuffles the
    other side, too, before it sees the real size.  Counted, a side of few rows is
    broadcast and the ledger stays where it is; a larger one is joined by shuffle."""
    side = stored(df, name)
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side
