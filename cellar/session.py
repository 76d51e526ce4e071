"""Session helpers: local test session and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench (no UI, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cellar")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.timeType.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        # checkpoints go when the tables cut off with them do
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # generated methods over 8 KB of bytecode are never JIT-compiled by the JVM; the typing
        # expressions of many columns get there, so let Spark fall back to split codegen
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (tests, a laptop) gets a folder of its own when the setting is absent;
    on a cluster a driver's temporary folder could not be seen by the executors.
    """
    context = spark.sparkContext
    root = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cellar-ckpt-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
        return root
    # below the context's own folder there is one of a session; its parent is the shared one
    return spark.conf.get("spark.checkpoint.dir", None) or root


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks can import it
    wherever the driver was started (Python workers don't see the driver's ``sys.path``)."""
    context = spark.sparkContext
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if context.applicationId in _SHIPPED or (root in known and context.master.startswith("local")):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="cellar-code-")
    archive = os.path.join(folder, "cellar.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for top, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(top, name)
                    z.write(path, os.path.join("cellar", os.path.relpath(path, here)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def scratch_dir(spark: SparkSession, label: str = "scratch") -> str:
    """A fresh, unique folder below the shared checkpoint folder (plain path or URI)."""
    root = checkpoint_root(spark)
    path = f"{root.rstrip('/')}/cellar/{label}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(_local(path), exist_ok=True)
    return path


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def remove_tree(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through Hadoop's FileSystem (any file system Spark can reach)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hpath, True)
