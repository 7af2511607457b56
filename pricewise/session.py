"""Session settings the semantics depend on.

* ``spark.sql.session.timeZone=UTC``: months and years are taken of the UTC
  instant, as the cleaning step converts every sale time to UTC.
* ANSI mode stays on: every lossy conversion is written as ``try_*``.
* AQE on: shuffle partitions are coalesced and skewed joins split at run time;
  aggregated dimension tables become broadcast joins after their size is known.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "pricewise", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators rely on.

    On a cluster the session normally exists already; then only its time
    zone and adaptive settings are set, and its shuffle partitions are left.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = SparkSession.getActiveSession() or builder.getOrCreate()
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(k, conf[k])
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a folder on shared storage and is used
    as it is. Only when it is unset in local mode (tests) a scratch folder
    is created and registered; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="pricewise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
