"""Results written with counters, results in order, and lines kept with a reason."""

import random

import pytest
from pyspark.sql import functions as F

import followgraph as fg
from conftest import rows


def test_save_counted(spark, graph, tmp_path):
    path = str(tmp_path / "out")
    e = graph([(1, 2), (3, 2), (4, 5)])
    lines = e.select(F.concat_ws(",", "follower", "followee").alias("value"))
    assert fg.save_counted(lines, path, longest=F.max(F.length("value"))) == {"rows": 3, "longest": 3}
    with pytest.raises(FileExistsError):
        fg.save_counted(lines, path)
    assert fg.save_counted(lines.limit(1), path, overwrite=True)["rows"] == 1
    assert spark.read.text(path).count() == 1
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_a_failed_write_leaves_the_old_result(spark, graph, tmp_path):
    path = str(tmp_path / "out")
    fg.save_counted(spark.sql("SELECT 'old' AS value"), path)
    broken = spark.range(20).select(F.when(F.col("id") == 17, F.raise_error(F.lit("no"))).otherwise("new").cast("string").alias("value"))
    with pytest.raises(Exception, match="no"):
        fg.save_counted(broken, path, overwrite=True)
    assert [r.value for r in spark.read.text(path).collect()] == ["old"]
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_positions_follow_the_order(spark, graph, tmp_path, partitions):
    rng = random.Random(partitions)
    pairs = [(rng.randrange(1000), 0 if rng.random() < 0.4 else rng.randrange(20)) for _ in range(500)]
    got = fg.save_in_order(graph(pairs).repartition(4), str(tmp_path / "o"), "followee", "follower", partitions=partitions)
    found = [(r.followee, r.follower) for r in got.orderBy("position").collect()]
    assert found == sorted((b, a) for a, b in pairs)
    assert sorted(r.position for r in got.collect()) == list(range(1, 501))


def test_a_hot_key_gets_several_ranges(graph):
    e = graph([(i, 0) for i in range(4000)] + [(i, 1 + i % 50) for i in range(1000)])
    parts = fg.in_key_order(e, "followee", "follower", partitions=10).withColumn("part", F.spark_partition_id())
    sizes = [r["count"] for r in parts.groupBy("part").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 1500


def test_nothing_to_save(graph, tmp_path):
    none = graph([(1, 1)]).limit(0)
    assert fg.save_in_order(none, str(tmp_path / "o"), "followee").count() == 0
    assert fg.save_counted(none, str(tmp_path / "c"), form="parquet") == {"rows": 0}


@pytest.mark.parametrize("id_type", ["bigint", "string"])
def test_lines_with_reasons(spark, id_type):
    cases = [
        ("1,2", None), (" 3 ,\t4\r", None), ("5,6,7", None), ("", "blank"), ("  ", "blank"), (None, "blank"),
        ("8", "fields"), (",9", "follower"), ("10,", "followee"), (",", "both"), (" , ", "both"),
    ]
    if id_type == "bigint":
        cases += [("a,1", "follower"), ("1,1.5", "followee"), ("x,y", "both")]
    lines = spark.createDataFrame([(c, r) for c, r in cases], "value string, want string")
    got = fg.explain_lines(lines, id_type=id_type).collect()
    assert sorted((r.line or "", r.reason or "") for r in got) == sorted((c or "", r or "") for c, r in cases)
    assert all((r.follower is None) == (r.followee is None) == (r.reason is not None) for r in got)
    edges = fg.valid(fg.parse_lines(lines, id_type=id_type))
    assert rows(edges) == sorted((r.follower, r.followee) for r in got if r.reason is None)
