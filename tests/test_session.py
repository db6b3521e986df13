"""Shared folder and size checks."""

from detour.operators.sizing import broadcast_if_bounded, row_count_at_most
from detour.session import fresh_path, shared_dir


def test_shared_dir_is_stable_and_fresh_paths_differ(spark):
    d = shared_dir(spark)
    assert d and shared_dir(spark) == d
    a, b = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert a != b and a.startswith(d)


def test_row_count_bound(spark):
    df = spark.range(10)
    assert row_count_at_most(df, 10) and not row_count_at_most(df, 9)
    small = broadcast_if_bounded(df, 10).join(spark.range(100), "id")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_no_local_scratch_folder_on_a_cluster():
    """An unset spark.checkpoint.dir on a non-local master is an error, never a local temp dir."""
    import pytest

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Ctx:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Ctx()

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_configured_checkpoint_dir_is_used():
    class Conf:
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/", "spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    assert shared_dir(Session()) == "hdfs://nn/shared/ckpt"


def test_scale_settings_fill_only_unset_keys_on_a_cluster():
    from detour.session import SCALE_DEFAULTS, scale_settings
    assert scale_settings("local[8]", set()) == {}
    got = scale_settings("yarn", {"spark.sql.shuffle.partitions"})
    assert "spark.sql.shuffle.partitions" not in got
    assert got == {k: v for k, v in SCALE_DEFAULTS.items() if k != "spark.sql.shuffle.partitions"}
