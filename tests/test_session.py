from tagloom import session


def test_scratch_lies_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = (session.scratch_dir(spark, "x") for _ in range(2))
    assert first.startswith(base) and first != second


class WithoutFolder:
    """A session without ``spark.checkpoint.dir``."""

    def __init__(self, spark):
        self.conf, self.sparkContext = self, spark.sparkContext

    def get(self, key, default=None):
        return default


def test_without_a_setting_it_lies_in_the_default_file_system(spark):
    path = session.scratch_dir(WithoutFolder(spark), "x")
    assert path.startswith("file:/") and session.path_exists(spark, path.rsplit("/", 1)[0])
