import pytest

from millrace.workspace import checkpoint_root, scratch_path, stored


class Session:
    """A session without a configured folder."""

    def __init__(self, master, folder=None):
        self.sparkContext = self.conf = self
        self.master, self.folder = master, folder

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_configured_folder_is_used(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert checkpoint_root(spark) == (configured or spark.sparkContext.getCheckpointDir())
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(checkpoint_root(spark).rstrip("/") + "/x-")


def test_folder_of_the_context_is_used():
    assert checkpoint_root(Session("yarn", "s3a://bucket/c")) == "s3a://bucket/c"


def test_only_a_local_session_gets_a_temporary_folder():
    local = Session("local[4]")
    assert checkpoint_root(local) == checkpoint_root(local) == local.folder
    for master in ("spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_root(Session(master))


def test_stored_frame_reads_what_was_written(spark):
    df = stored(spark.sql("SELECT id, rand() AS r, cast(NULL AS string) AS n FROM range(100)"), "x")
    assert df.schema.names == ["id", "r", "n"]
    assert df.orderBy("id").collect() == df.orderBy("id").collect()
    assert "rand" not in df._jdf.queryExecution().executedPlan().toString()
