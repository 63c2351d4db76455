"""Session settings and the one place where lineage is cut.

``cut`` writes a table to the shared folder named by ``spark.checkpoint.dir``
and reads it back.  A written table outlives lost executors, is columnar (later
readers prune columns) and carries its size, so the planner broadcasts it only
below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

_own: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app: str = "klipgrid", cores: int | str = "*", **conf: object) -> SparkSession:
    """A local session with the engine's settings; clusters bring their own."""
    b = SparkSession.builder.appName(app).master(f"local[{cores}]")
    for k, v in {**DEFAULTS, "spark.ui.enabled": "false", **conf}.items():
        b = b.config(k, str(v))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only where the session names none *and* the master is local (tests, a
    notebook) is a temporary folder made; on a cluster that is an error, since
    a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="klipgrid-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return "file://" + _own[app]


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="klipgrid-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/klipgrid.zip", "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"klipgrid/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(f"{folder}/klipgrid.zip")


def scratch(spark: SparkSession) -> str:
    """A new place in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/klipgrid-tables/{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a written table in the shared folder; its lineage ends there."""
    path = scratch(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
