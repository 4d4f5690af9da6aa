"""Scratch locations and shuffle width come from the session."""

from barsmith.session import checkpoint_root, scratch_path, shuffle_width


def test_scratch_goes_under_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert a.startswith(root.rstrip("/") + "/") and a != b


def test_shuffle_width_tolerates_non_numeric_setting(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        assert shuffle_width(spark) == 12
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)

    class Conf:  # some platforms accept e.g. "auto"; open-source Spark rejects it
        def get(self, key, default=None):
            return "auto"

    class Ctx:
        defaultParallelism = 7

    class Session:
        conf, sparkContext = Conf(), Ctx()

    assert shuffle_width(Session()) == 7
