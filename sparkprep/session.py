"""Session helpers.

Library functions never require a particular configuration; these helpers
are for tests, the bench and scripts.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "sparkprep",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("SPARKPREP_MASTER", "local[8]")
    cores = 8
    if master.startswith("local[") and master[6:-1].isdigit():
        cores = int(master[6:-1])
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
         .config("spark.default.parallelism", str(cores))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("SPARKPREP_DRIVER_MEMORY", "16g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A folder of our own is set only when none is configured and the session is
    local (tests, bench); on a cluster an unset value is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="sparkprep-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sparkprep`` importable in Python workers (once per context).

    Operators that run NumPy code in tasks pickle references to this package's
    functions; workers must import it even when the driver found it through a
    ``sys.path`` entry of its own. The package is zipped once and added with
    ``addPyFile``, which Spark distributes to every executor.
    """
    import zipfile

    sc = spark.sparkContext
    key = (id(sc), sc.applicationId)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    # driver-side staging only: Spark copies the file to every executor; no data
    # or state is kept here
    path = os.path.join(tempfile.mkdtemp(prefix="sparkprep-pyfiles-"), "sparkprep.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(key)
