from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.sources import versions
from tickbars.sources.versions import VersionedTable

SCHEMA = T.StructType([T.StructField("x", T.LongType()), T.StructField("part", T.StringType())])


def frame(spark, **parts):
    return spark.createDataFrame([(x, p) for p, xs in parts.items() for x in xs], SCHEMA)


def state(spark, table, where=None):
    return sorted((r.part, r.x) for r in table.read(spark, where).collect())


def test_added_pieces_and_replaced_partitions(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"), SCHEMA, ("part",))
    assert state(spark, table) == []
    table.add(frame(spark, a=[1], b=[2]))
    table.add(frame(spark, a=[3]))
    assert state(spark, table) == [("a", 1), ("a", 3), ("b", 2)]
    assert {r.part: r.pieces for r in table.pieces(spark).collect()} == {"a": 2, "b": 1}
    table.replace(frame(spark, a=[9]))
    table.add(frame(spark, a=[10], c=[4]))
    assert state(spark, table) == [("a", 9), ("a", 10), ("b", 2), ("c", 4)]
    assert state(spark, table, F.col("part") == "a") == [("a", 9), ("a", 10)]


def test_only_folders_of_wanted_partitions_are_opened(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"), SCHEMA, ("part",))
    table.replace(frame(spark, a=[1]))
    table.replace(frame(spark, b=[2]))
    files = [f for f in table.read(spark, F.col("part") == "b").inputFiles() if "_manifests" not in f]
    assert {f.split("/part=")[1][0] for f in files} == {"b"}


def test_manifests_stay_few(spark, tmp_path, monkeypatch):
    """Manifests of single partitions until one names all again; those before the last two such are removed."""
    monkeypatch.setattr(versions, "ALL_EVERY", 2)
    table = VersionedTable(str(tmp_path / "t"), SCHEMA, ("part",))
    names = [f"p{i}" for i in range(4)]
    table.replace(frame(spark, **{n: [0] for n in names}))
    for i in range(9):
        table.replace(frame(spark, **{names[i % 4]: [i + 1]}))
    assert len(table._committed(spark)) <= 6
    assert state(spark, table) == sorted({names[i % 4]: i + 1 for i in range(9)}.items())
