"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings the operators depend on for correct results (time zone for year(),
# ANSI casts stay on) or for plans that hold at scale (AQE, skew handling).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Call-site capture for error messages costs three driver round trips per
    # API call; jobs built from hundreds of expressions pay for it in planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Suggested settings for a large cluster (pass to get_session or set in the
# deployment). Shuffle partitions are set high and AQE coalesces them to the
# advisory size at run time, so small stages stay small and big ones get
# enough tasks; skewed join partitions are split; scans pack small files.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.files.openCostInBytes": "8m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def get_session(master: str | None = None, app: str = "postlytics",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with :data:`BASE_CONF` applied.

    ``master`` and ``shuffle_partitions`` are only meant for local runs; on a
    cluster leave them unset and let the deployment decide.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate hands back an existing session unchanged: re-apply the
    # runtime SQL settings so results do not depend on who built it.
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(key, settings[key])
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder shared by all executors, taken from ``spark.checkpoint.dir``.

    The cluster names this folder. Only a local master may go without: there
    a scratch folder is picked and registered for ``DataFrame.checkpoint`` too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share "
                             f"(master {master})")
        root = tempfile.mkdtemp(prefix="postlytics-checkpoints-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path object) of a path in any store the session reaches."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = hadoop_path(spark, path)
    return fs.exists(hpath)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run: an archive of it is added
    to the application once. Only queries with Python code in tasks need it."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="postlytics-package-"), "postlytics.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, os.path.dirname(package)))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


_scratch: dict[str, str] = {}


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder under :func:`shared_root` for one run's tables.

    All of one application lie in one folder, which the file system deletes when the
    driver's JVM ends; results that are read back lazily stay readable until then.
    """
    app = spark.sparkContext.applicationId
    root = shared_root(spark)
    if _scratch.get(app) is None or not _scratch[app].startswith(root):
        _scratch[app] = f"{root}/postlytics-{app}-{uuid.uuid4().hex[:8]}"
        fs, path = hadoop_path(spark, _scratch[app])
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{_scratch[app]}/{label}-{uuid.uuid4().hex[:12]}"
