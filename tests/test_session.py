"""Session helpers: shared checkpoint folder and scale settings."""

from clickflow.session import checkpoint_root, scale_conf, work_path


def test_checkpoint_root_comes_from_the_session(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    p1, p2 = work_path(spark, "x"), work_path(spark, "x")
    assert p1 != p2 and p1.startswith(root.rstrip("/") + "/x-")


def test_scale_conf_sizes_from_input():
    c = scale_conf(100 * 2 ** 40)                      # 100 TB
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert c["spark.sql.adaptive.enabled"] == "true" and c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(c["spark.sql.autoBroadcastJoinThreshold"]) == 64 << 20
    assert int(scale_conf(10 << 20)["spark.sql.shuffle.partitions"]) == 200     # floor for small inputs
