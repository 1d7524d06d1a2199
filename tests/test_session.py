import pytest

from reviewloom import session


class Recorder:
    def __init__(self):
        self.set = {}

    def config(self, name, value):
        self.set[name] = value
        return self


def test_partitions_follow_the_largest_shuffle():
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert name not in session.configure(Recorder()).set
    assert session.configure(Recorder(), 10 * 2**40).set[name] == "81920"
    assert session.configure(Recorder(), 1).set[name] == "1"


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    folders = {session.scratch_folder(spark) for _ in range(3)}
    assert len(folders) == 3
    assert all(f.startswith(shared + "/") for f in folders)


class Cluster:
    class conf:
        get = staticmethod(lambda name, default: default)

    class sparkContext:
        master = "yarn"


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_folder(Cluster)


def test_stored_frame_is_read_from_files(spark):
    stored = session.store(spark.range(5).selectExpr("id", "array(struct(id AS a)) AS n"))
    assert stored.count() == 5
    assert len(stored.inputFiles()) > 0
    assert stored.schema.simpleString() == "struct<id:bigint,n:array<struct<a:bigint>>>"
