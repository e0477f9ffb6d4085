import time
from types import SimpleNamespace

import pytest

from tallyhouse.session import settle, shared_dir


def session(master, folder=None):
    """A stand-in session: no cluster is at hand."""
    made = {"dir": None}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: made["dir"],
        setCheckpointDir=lambda path: made.update(dir=path),
        getConf=lambda: SimpleNamespace(get=lambda key: folder),
    )
    conf = SimpleNamespace(get=lambda key, default: default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_the_named_folder_is_taken():
    assert shared_dir(session("spark://host:7077", "hdfs:///shared")) == "hdfs:///shared"
    assert shared_dir(session("local[4]", "/shared")) == "/shared"


def test_a_cluster_never_gets_a_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))
    assert "tallyhouse-shared-" in shared_dir(session("local[*]"))


def test_settled_rows_are_read_from_the_shared_folder(spark):
    df = settle(spark.range(10).selectExpr("id", "id * 2 AS twice"))
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.agg({"twice": "sum"}).first()[0] == 90


def test_generated_methods_stay_compiled(spark, conf):
    from tallyhouse.session import COMPILED, keep_compiled

    with conf(**{COMPILED[0].replace(".", "__"): "65535"}):
        assert keep_compiled(spark).conf.get(COMPILED[0]) == "8000"
        spark.conf.set(COMPILED[0], "20000")
        assert keep_compiled(spark).conf.get(COMPILED[0]) == "20000"


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    from tallyhouse.session import DROPPED, shuffles_dropped

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def write(name):
        """Shuffles that have files when a write has ended, once files on their way out are gone."""
        before = {b for b in disk.getAllBlocks().mkString(",").split(",") if b.startswith("shuffle_")}
        spark.range(1000).repartition(3, "id").write.parquet(f"{tmp_path}/{name}")
        for _ in range(50):
            now = disk.getAllBlocks().mkString(",").split(",")
            left = {b for b in now if b.startswith("shuffle_")} - before
            if not left:
                break
            time.sleep(0.1)
        return left

    assert write("kept")
    was = spark.conf.get(DROPPED, None)
    with shuffles_dropped(spark):
        assert not write("dropped")
    assert spark.conf.get(DROPPED, None) == was
