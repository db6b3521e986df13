"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every detour job wants; a cluster deployment passes its own sizes
# for shuffle partitions and file splits on top of these.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Sizing for large inputs on a cluster, applied only to keys the deployment left
# unset: large scan splits, a high initial shuffle width that AQE coalesces to
# ~256 MB partitions, and skew splitting above 512 MB.
SCALE_DEFAULTS = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str | None = None, app: str = "detour",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SQL_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_sql_defaults(spark)
    explicit = spark.sparkContext.getConf()
    set_keys = {k for k in SCALE_DEFAULTS if explicit.contains(k)} | set(conf)
    for k, v in scale_settings(spark.sparkContext.master, set_keys).items():
        spark.conf.set(k, v)
    return spark


def scale_settings(master: str, already_set: set[str]) -> dict[str, str]:
    """The ``SCALE_DEFAULTS`` to apply: none on a ``local[...]`` master, and never a key
    the deployment (or the caller) already set."""
    if master.startswith("local"):
        return {}
    return {k: v for k, v in SCALE_DEFAULTS.items() if k not in already_set}


def apply_sql_defaults(spark: SparkSession) -> None:
    """Runtime SQL settings the operators rely on (UTC clock for the timestamp texts,
    AQE). The history sink sets dynamic partition overwrite on its own writes."""
    for k, v in SQL_DEFAULTS.items():
        spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a ``local[...]`` master (local
    runs, tests) is a private folder created and registered as the checkpoint
    directory. On a cluster an unset value is an error, never a machine-local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no JVM context (e.g. Spark Connect): nothing to fall back on
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    master = spark.conf.get("spark.master", "")
    if sc is None or not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="detour-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, *parts: str) -> str:
    """A new, unused location under the shared folder."""
    return "/".join([shared_dir(spark), *parts, uuid.uuid4().hex])

