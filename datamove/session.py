"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Settings the operators are planned for.  Skew handling is left on so that a hot
# join key is split at run time; time zone is pinned so dates do not depend on the host.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "datamove",
    master: str | None = None,
    hive: bool = False,
    conf: Mapping[str, str] | None = None,
    shared_dir: str | None = None,
) -> SparkSession:
    """A session with ``SESSION_DEFAULTS`` and ``conf`` on top.

    ``shared_dir`` is where the library writes what it needs in between; all executors must
    see it.
    ``hive`` keeps tables, and with them which copy is published, beyond the session.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    shared = {"spark.checkpoint.dir": shared_dir} if shared_dir else {}
    for name, value in (SESSION_DEFAULTS | shared | dict(conf or {})).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the cluster's shared checkpoint folder.

    Executors on other machines must see what is written here, so the folder named by
    ``spark.checkpoint.dir`` is used.  Where it is unset, a local session gets a temporary
    folder of its own, and any other is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="datamove-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete files this library wrote, on whatever file system holds them."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
