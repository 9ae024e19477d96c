"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on for right results (time zone) or for plans that
# survive skew (adaptive execution). Sizes such as the number of shuffle
# partitions stay with the cluster: AQE coalesces them at run time.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the Python call site of every column costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "meterlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_FOLDERS: dict[str, str] = {}


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The parent is the shared folder named by ``spark.checkpoint.dir``. Only a
    local session, where driver and executors are one machine, may fall back to
    a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        context = spark.sparkContext
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if context.applicationId not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="meterlake-")
        shared = _LOCAL_FOLDERS[context.applicationId]
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
