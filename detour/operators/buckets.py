"""K3 / K4 on large tables: upserts that rewrite only the buckets they touch.

A bucketed table is a folder of immutable data files, dealt by a hash of the key into ``buckets`` buckets, and a manifest
that names the folder of each bucket. An upsert reads the current rows of the buckets in which it has keys, and
writes these buckets anew below a new folder; the manifest's next version names the new folders, and the old ones for all other
buckets, whose files are neither read nor written. A reader sees one version or the next. A failed
upsert leaves files that no version names.

The result is that of :func:`detour.operators.upsert.upsert`: the last write of a key wins, nulls included, null keys
are keys, and nothing is deleted. The number of buckets is a property of the table: it bounds what an upsert of few keys
reads, and the list of folders that the driver holds. One upsert at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from detour.operators.upsert import latest_per_key, upsert
from detour.sources import manifest

COLUMNS = "n_buckets int, keys array<string>, folders map<int,string>, ddl string"
BUCKET = "_bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _path(root: str) -> str:
    return f"{root.rstrip('/')}/_manifest"


def _write(rows: DataFrame, root: str) -> str:
    """``rows`` (with their bucket) below a new folder, each bucket's files apart; the folder's name."""
    name = uuid.uuid4().hex
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{root.rstrip('/')}/{name}")
    return name


def _read(spark: SparkSession, root: str, folders: dict[int, str], ddl: str) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(*[f"{root.rstrip('/')}/{f}/{BUCKET}={b}" for b, f in sorted(folders.items())])


def read_buckets(spark: SparkSession, root: str) -> DataFrame:
    """The table's newest version."""
    now = manifest.newest(spark, _path(root), COLUMNS)
    if now is None:
        raise ValueError(f"no bucketed table at {root}")
    return _read(spark, root, now["folders"], now["ddl"])


def upsert_buckets(spark: SparkSession, root: str, incoming: DataFrame, keys: list[str], seq: list[str], buckets: int = 64) -> list[int]:
    """Apply ``incoming`` (ordered by ``seq``) to the table at ``root``, which is made if there is none (then with ``buckets``
    buckets); the buckets that were written."""
    now = manifest.newest(spark, _path(root), COLUMNS)
    buckets, folders = (now["n_buckets"], dict(now["folders"])) if now else (buckets, {})
    if now and list(now["keys"]) != keys:
        raise ValueError(f"the table's keys are {now['keys']}")
    payload = incoming.drop(*seq)
    ddl = now["ddl"] if now else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in payload.schema.fields)
    # The delta is read twice: for its buckets, and to be merged.
    staged = _write(latest_per_key(incoming, keys, seq).select(*payload.columns).withColumn(BUCKET, bucket_of(keys, buckets)), root)
    delta = spark.read.schema(f"{ddl}, {BUCKET} int").parquet(f"{root.rstrip('/')}/{staged}")
    touched = sorted(r[BUCKET] for r in delta.select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
    old = {b: folders[b] for b in touched if b in folders}
    if old:
        # A key's rows lie in its bucket: the delta meets the rows of these buckets alone.
        new = delta.drop(BUCKET).withColumn("_one", F.lit(1))
        merged = upsert(_read(spark, root, old, ddl), new, keys, ["_one"]).drop("is_updated")
        written = _write(merged.withColumn(BUCKET, bucket_of(keys, buckets)), root)
    else:
        written = staged
    folders.update({b: written for b in touched})
    manifest.append(spark, _path(root), COLUMNS, (buckets, keys, folders, ddl), now)
    return touched
