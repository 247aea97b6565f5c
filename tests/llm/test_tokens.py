import random
from array import array

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from followgraph.llm import bpe
from followgraph.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def model():
    return bpe.load_bpe(tokenizer_path())


ODD = [
    "", " ", "\n\t", "a<|startoftext|>B <|ENDOFTEXT|> <|endoftext|>", "it's we'll I'M don'T", "ΑΣ Σ ΟΔΟΣ", "\x1c\x85x y",
    "İstanbul é ﬁ ½²³ é", "漢字かな\U0001f600‍", "x" * 5000, "a " * 5000, "1234 56", "...!!! --",
]


def test_as_the_library(library, model):
    encoder = bpe.Encoder(model)
    rng = random.Random(3)
    letters = "aAbé <|>'sΣ\n\t0½漢\U0001f600é‍qzxj-_.startofend"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(3000)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        ids, shown = encoder.encode(text)
        assert array("I", ids).tolist() == want, text
        assert shown == library.decode(want, skip_special_tokens=False), text


def test_certain_cuts_change_nothing(model):
    """A word encoded whole and piece by piece has the same tokens."""
    encoder = bpe.Encoder(model)
    rng = random.Random(4)
    split = 0
    for _ in range(2000):
        symbols = [encoder.bytes[b] for b in bytes(rng.choice(b"aeiouthnrsqxzjk") for _ in range(rng.randrange(1, 20)))]
        symbols[-1] += model.suffix
        pieces = encoder.split(symbols)
        split += len(pieces) > 1
        assert [t for p in pieces for t in encoder.merge(p)] == encoder.merge(tuple(symbols))
    assert split > 100


def test_table(spark, library, model):
    rows = [(i, t, "clash") for i, t in enumerate(ODD)] + [(99, None, None), (99, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("__x", F.lit(1))
    coded = bpe.encode(df, model)
    assert coded.columns == ["doc_id", "text", "__x", "ids", "n_tokens", "decoded"]
    got = bpe.decode(coded.withColumnRenamed("decoded", "first"), model).collect()
    assert len(got) == len(rows)
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want) and r.first == r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.encode(df.limit(0), model).collect() == []
