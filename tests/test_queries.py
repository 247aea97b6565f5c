import os

import duckdb
import pytest

import __spark_entry__ as entry_file

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{name}'")
    return con


def own(found):
    """Names of the graph queries; those of the training-data operators have tests of their own."""
    other = set(entry_file.llm.queries()) | {"pipeline"} if entry_file.llm else set()
    return sorted(set(found) - other)


def test_every_query_has_sql():
    assert own(entry_file.queries()) == own(entry_file.oracle_sql())


@pytest.mark.parametrize("name", [n for n in own(entry_file.queries()) if n.endswith("_split")])
def test_split_queries_split(spark, name):
    """The plans of these queries have slots."""
    import followgraph as fg

    assert "slot" in fg.plan_text(entry_file.queries()[name](spark, SF), "simple")


def test_cut_offs_cut(spark):
    """At the scale of the correctness run; smaller tables have ids below the cut-offs."""
    data = SF.replace("0.001", "0.01")
    found = entry_file.queries()
    for cut, whole in (
        ("edges_under_low_max", "edges_valid"),
        ("two_path_count_low_max", "two_path_count_exact"),
        ("triangle_count_low_max", "triangle_count_no_loop"),
    ):
        assert sorted(map(tuple, found[cut](spark, data).collect())) != sorted(map(tuple, found[whole](spark, data).collect()))


def test_entry(spark):
    df = entry_file.entry(spark)
    assert df.dtypes == [("triangle_count", "bigint")] and df.count() == 1


@pytest.mark.parametrize("name", own(entry_file.queries()))
def test_query(spark, duck, name):
    got = entry_file.queries()[name](spark, SF).toArrow()
    want = duck.sql(entry_file.oracle_sql()[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)
    assert [got.schema.field(c).type for c in columns] == [want.schema.field(c).type for c in columns]
    order = [(c, "ascending") for c in columns]
    assert got.select(columns).sort_by(order).to_pydict() == want.select(columns).sort_by(order).to_pydict()
