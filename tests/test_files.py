import pytest
from conftest import TOY, TOY2, brute_paths, brute_walks, rows

import followgraph as fg
from followgraph import jobs


@pytest.fixture
def write(tmp_path):
    def to_file(text, name="edges.csv"):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        return str(tmp_path / "in")

    return to_file


def lines(path):
    return sorted(
        line for part in path.glob("part-*") for line in part.read_text().splitlines()
    )


def test_blank_lines_and_big_ids(spark, write):
    assert rows(fg.read_edges(spark, write("1,3000000000\n\n2,100"))) == [(1, 3000000000), (2, 100)]


def test_bad_cells(spark, write):
    path = write("1,100\nx,200\n3,y\n,5\n6\n")
    assert rows(fg.read_edges(spark, path)) == [(1, 100)]
    assert rows(fg.read_edges(spark, path, mode="DROPMALFORMED")) == [(1, 100)]
    with pytest.raises(Exception, match="MALFORMED"):
        fg.read_edges(spark, path, mode="FAILFAST").collect()
    # the row is judged as a whole even when a query needs only one column
    assert rows(fg.follower_count(fg.read_edges(spark, path), None)) == [(100, 1)]


def test_extra_columns(spark, write):
    path = write("1,2,x\n2,100,y\n")
    assert rows(fg.read_edges(spark, path)) == [(1, 2), (2, 100)]
    with pytest.raises(Exception, match="MALFORMED"):
        fg.read_edges(spark, path, mode="FAILFAST").collect()


def test_blanks_and_fractions(spark, write):
    path = write(" 1, 100\n5.0,100\n2 ,\t7\n1;2\n")
    assert rows(fg.read_edges(spark, path)) == [(1, 100), (2, 7)]
    lines = fg.read_lines(spark, path)
    assert [tuple(r) for r in fg.dropped_lines(lines).collect()] == [(4, 2)]
    assert rows(fg.read_edges(spark, path, sep=";")) == [(1, 2)]


def test_fractions_are_no_ids(spark):
    df = spark.createDataFrame([(100.9, 2)], "a double, b int")
    with pytest.raises(ValueError, match="double"):
        fg.from_table(df, "a", "b")
    assert rows(fg.from_table(df.select(df.a.cast("decimal(5,0)"), "b"), "a", "b")) == [(101, 2)]


def test_nested_directories(spark, write):
    write("1,2\n", "top.csv")
    path = write("3,4\n", "deep/er/more.csv")
    assert rows(fg.read_edges(spark, path)) == [(1, 2)]
    assert rows(fg.read_edges(spark, path, recursive=True)) == [(1, 2), (3, 4)]


def test_text_ids(spark, write):
    assert rows(fg.read_edges(spark, write("a,01\n"), id_type="string")) == [("a", "01")]


def test_from_table(spark):
    df = spark.createDataFrame([("1", 2), ("x", 3), (None, 4), ("7", None)], "a string, b int")
    e = fg.from_table(df, "a", "b")
    assert rows(e) == [(1, 2)]
    assert e.dtypes == [("follower", "bigint"), ("followee", "bigint")]


def test_existing_output(spark, graph, tmp_path):
    out = str(tmp_path / "out")
    counts = fg.follower_count(graph([(1, 100), (2, 100), (1, 200)]))
    fg.write_csv(counts, out)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        fg.write_csv(counts, out)
    assert lines(tmp_path / "out") == ["100,2", "200,1"]
    fg.write_pairs(counts, out, mode="overwrite")
    assert lines(tmp_path / "out") == ["(100,2)", "(200,1)"]


def test_paths_round_trip(spark, graph, tmp_path):
    paths = fg.two_paths(graph(TOY2))
    fg.write_tsv(paths, str(tmp_path / "paths"))
    assert "1\t2 3" in lines(tmp_path / "paths")
    assert rows(fg.read_walks(spark, str(tmp_path / "paths"), paths.columns)) == brute_paths(TOY2)


def test_triangle_lines(graph, tmp_path):
    e = fg.under_max(graph(TOY), 6)
    fg.write_tsv(fg.triangles(e), str(tmp_path / "t"), key="n3", values=["n1", "n2", "n3", "n1"])
    assert lines(tmp_path / "t") == ["1\t3 2 1 3", "2\t1 3 2 1", "3\t2 1 3 2"]


def test_scalar(graph, tmp_path):
    fg.write_scalar(fg.triangle_count(graph(TOY2), "closed"), str(tmp_path / "n"))
    assert lines(tmp_path / "n") == ["5"]
    with pytest.raises(ValueError, match="one column"):
        fg.write_scalar(fg.degrees(graph(TOY2)), str(tmp_path / "m"))


def test_metrics_ride_along_with_a_write(graph, tmp_path):
    walks, seen = fg.with_metrics(fg.triangles(graph(TOY2), "closed"), "walks")
    fg.write_tsv(walks, str(tmp_path / "w"))
    assert seen.get["rows"] == 17


TOY_TEXT = "\n".join(f"{a},{b}" for a, b in TOY2)


@pytest.mark.parametrize(
    "options, result",
    [
        (["two-path-exact"], 24),
        (["two-path-list", "--max", "6"], len(brute_paths([p for p in TOY2 if max(p) < 6]))),
        (["two-path-list", "--walks", "no_loop"], 16),
        (["two-path-count", "--max", "6"], len(brute_paths([p for p in TOY2 if max(p) < 6]))),
        (["two-path-count"], 24),
        (["two-path-count", "--walks", "no_loop", "--wide"], 16),
        (["triangle-list", "--max", "10000"], 4),
        (["triangle-list", "--walks", "closed", "--strategy", "broadcast"], 5),
        (["triangle-count", "--max", "10000", "--strategy", "shuffle"], 4),
        (["triangle-count", "--walks", "closed", "--strategy", "broadcast"], 5),
        (["triangle-count", "--max", "3", "--walks", "strict"], 0),
    ],
)
def test_jobs(spark, write, tmp_path, options, result):
    out = tmp_path / "out"
    job, *rest = options
    assert jobs.run(spark, [job, write(TOY_TEXT), str(out), *rest]) == result
    assert (out / "_SUCCESS").exists()


def test_job_output_lines(spark, write, tmp_path):
    source = write("1,100\n2,100\n3,200\n3,1\n")
    jobs.run(spark, ["follower-count", source, str(tmp_path / "csv")])
    jobs.run(spark, ["follower-count", source, str(tmp_path / "pairs"), "--format", "pairs"])
    jobs.run(spark, ["follower-count", source, str(tmp_path / "all"), "--modulus", "0"])
    assert lines(tmp_path / "csv") == ["100,2", "200,1"]
    assert lines(tmp_path / "pairs") == ["(100,2)", "(200,1)"]
    assert lines(tmp_path / "all") == ["1,1", "100,2", "200,1"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        jobs.run(spark, ["follower-count", source, str(tmp_path / "csv")])
    jobs.run(spark, ["two-path-exact", write(TOY_TEXT), str(tmp_path / "csv"), "--overwrite"])
    assert lines(tmp_path / "csv") == ["1\t3", "11\t1", "2\t15", "3\t4", "5\t1"]


def test_listed_triangles_match(spark, write, tmp_path):
    jobs.run(spark, ["triangle-list", write(TOY_TEXT), str(tmp_path / "t"), "--walks", "closed"])
    got = rows(fg.read_walks(spark, str(tmp_path / "t"), ["key", "n1", "n2", "n3", "back"]))
    assert [r[1:4] for r in got] == brute_walks(TOY2, "closed")


def test_sample_counts(spark, write, tmp_path):
    source = write("\n".join(f"{a},{b}" for a, b in TOY))
    assert jobs.run(spark, ["two-path-count", source, str(tmp_path / "a"), "--max", "6"]) == 8
    assert jobs.run(spark, ["two-path-count", source, str(tmp_path / "b")]) == 13
    with pytest.raises(ValueError, match="no_loop"):
        jobs.run(spark, ["two-path-list", source, str(tmp_path / "c"), "--walks", "strict"])


def test_dropped_lines_are_told(spark, write, tmp_path, capsys):
    source = write("1,100\nx,1\n\n2,\n")
    jobs.run(spark, ["follower-count", source, str(tmp_path / "out")])
    assert "2 lines are no edge" in capsys.readouterr().err
    assert lines(tmp_path / "out") == ["100,1"]
