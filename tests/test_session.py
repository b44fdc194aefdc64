from pathlib import Path

import pytest

from tickbars import session


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)

    def set(self, key, value):
        self[key] = value


class Session:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("__", "."): v for k, v in conf.items()})


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://host", "local-cluster[3,2,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(spark__master=master))
    assert session.shared_dir(Session(spark__master=master, spark__checkpoint__dir="hdfs://x/y/")) == "hdfs://x/y"


def test_one_machine_gets_a_folder_once():
    one = Session(spark__master="local[2]")
    assert session.shared_dir(one) == session.shared_dir(one)


def test_the_session_must_be_in_utc():
    session.require_utc(Session(spark__sql__session__timeZone="UTC"))
    with pytest.raises(ValueError, match="Europe/Berlin"):
        session.require_utc(Session(spark__sql__session__timeZone="Europe/Berlin"))


def test_discard_deletes_scratch_tables_only(spark, tmp_path):
    own, table = str(tmp_path / "own"), session.stored(spark.range(5), "some")
    spark.range(3).write.parquet(own)
    kept = spark.read.parquet(own)
    session.discard(table, kept)
    assert spark.read.parquet(own).count() == 3
    files, path = session.files_of(spark, table.inputFiles()[0])
    assert not files.exists(path)


def scratch_tables(spark):
    folder = Path(session.shared_dir(spark), session.SCRATCH)
    return {p.name for p in folder.iterdir()} if folder.exists() else set()


def test_settled_leaves_its_result_only(spark):
    def doubled(n):
        return session.stored(spark.range(n), "half").selectExpr("id * 2 AS id")

    def work():
        kept = session.settled(lambda: doubled(5), "inner")
        assert not [name for name in scratch_tables(spark) - before if name.startswith("half")]
        return session.stored(kept, "middle").unionAll(doubled(3))

    before = scratch_tables(spark)
    outside = session.stored(spark.range(4), "outside")
    got = session.settled(work, "result")
    assert sorted(r.id for r in got.collect()) == [0, 0, 2, 2, 4, 4, 6, 8] and outside.count() == 4
    assert sorted(name.split("-")[0] for name in scratch_tables(spark) - before) == ["outside", "result"]
