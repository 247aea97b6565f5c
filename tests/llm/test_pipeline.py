import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F
from test_leaks_and_licenses import brute as brute_leaks
from test_near_duplicates import brute as brute_copies

import __spark_entry__ as entry_file
import corpus_pipeline as C
from followgraph.llm import queries as llm
from followgraph.llm import secret_scan
from followgraph.llm.common import discard, stored

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage keeps of the smallest tables, beginning with the documents."""
    out = [C.table(spark, SF, "documents")]
    for name, stage in C.STAGES:
        out.append(stored(stage(spark, out[-1], SF), name))
    return [{r.doc_id: r for r in df.collect()} for df in out]


def test_stages():
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "tokens"]


def test_quality_stage(spark, kept):
    labels = {r.doc_id: r.quality for r in C.table(spark, SF, "labels").collect()}
    before, after = kept[0], kept[1]
    good = [i for i in before if labels.get(i) == 1]
    bad = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in good) >= 0.95 * len(good)
    assert sum(i in after for i in bad) <= 0.2 * len(bad)
    assert all(after[i] == before[i] for i in after)


def test_quality_stage_keeps_no_copy_of_the_texts(spark, monkeypatch):
    """What it stores lies on disk until the last stage has ended: numbers only, and these go too."""
    made, gone = [], []
    monkeypatch.setattr(C, "stored", lambda df, name: made.append(stored(df, name)) or made[-1])
    monkeypatch.setattr(C, "discard", lambda *tables: gone.extend(tables) or discard(*tables), raising=False)
    docs = C.table(spark, SF, "documents")
    good = C.keep_quality(spark, docs, SF)
    assert made and all("text" not in df.columns for df in made) and gone == made
    assert good.columns == docs.columns and 0 < good.count() < docs.count()


def test_near_duplicate_stage(kept):
    before, after = kept[1], kept[2]
    roots = {i: root for i, _, root in brute_copies([(i, r.text) for i, r in before.items()], 80)}
    assert set(after) == set(roots.values()) and len(after) < len(before)
    assert all(after[i] == before[i] for i in after)


def test_decontamination_stage(spark, kept):
    before, after = kept[2], kept[3]
    items = [(r.item_id, r.text) for r in C.table(spark, SF, "benchmark").collect()]
    clean = {i for i, _, hit, _ in brute_leaks([(i, r.text) for i, r in before.items()], items) if not hit}
    assert set(after) == clean and all(after[i] == before[i] for i in after)


def test_secret_stage(kept):
    before, after = kept[3], kept[4]
    assert set(before) == set(after)
    for i, r in after.items():
        assert r.text == secret_scan.redact_text(before[i].text, "[SECRET]") and r.n_chars == len(r.text)
        assert (r.lang, r.source) == (before[i].lang, before[i].source)
        assert not re.search("[0-9a-f]{24}|AKIA[A-Z0-9]{16}", r.text)


def test_token_stage(kept):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(llm.tokenizer_path())
    assert set(kept[4]) == set(kept[5])
    for i, r in kept[5].items():
        want = library.encode(kept[4][i].text, add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want) and r.decoded == library.decode(want, skip_special_tokens=False)


def test_odd_rows(spark, tmp_path):
    text = " ".join(f"word{i} of" for i in range(40)) + "."
    rows = [(1, text, None, None, None), (2, text, "en", "s", 5), (2, text + " more", "en", "s", 5), (None, text, None, "s", 1), (None, None, None, None, None)]
    rows += [(3, "", "x", "y", 0), (4, None, None, None, None), (5, "w " * 50_000, None, None, 100_000), (6, "key: token=abcdefgh", "en", "s", 19)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("key", F.lit("clash"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(None, None), (1, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(C.STAGES)
    # without labels every score is 0.5, which is under the threshold
    assert stages["quality"](spark, docs, str(tmp_path)).count() == 0
    once = stages["near_duplicates"](spark, docs, str(tmp_path))
    assert once.columns == docs.columns
    assert sorted((r.doc_id for r in once.collect()), key=str) == [1, 3, 4, 5, 6, None, None]
    clean = stages["decontamination"](spark, once, str(tmp_path))
    assert clean.columns == docs.columns and clean.count() == 7
    masked = stages["secrets"](spark, clean, str(tmp_path))
    assert masked.columns == docs.columns
    assert [tuple(r) for r in masked.where("doc_id = 6").select("text", "n_chars").collect()] == [("key: [SECRET]", 13)]
    coded = stages["tokens"](spark, masked, str(tmp_path))
    assert coded.count() == 7 and {r.n_tokens for r in coded.where("doc_id = 4").collect()} == {0}
    for name, stage in C.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_against_sql(spark, duck, name):
    got = entry_file.queries()[name](spark, SF).toArrow()
    want = duck.sql(entry_file.oracle_sql()[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)
    assert [got.schema.field(c).type for c in columns] == [want.schema.field(c).type for c in columns]
    order = [(c, "ascending") for c in columns]
    assert got.select(columns).sort_by(order).to_pydict() == want.select(columns).sort_by(order).to_pydict()


def test_registered():
    names = set(entry_file.queries())
    assert {"pipeline", *llm.queries()} <= names
    assert [n.split("_")[0] for n in llm.queries()] == [f"op{i}" for i in range(1, 14)]
