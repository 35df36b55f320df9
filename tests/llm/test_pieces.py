from collections import Counter

import pytest

from tests.llm.conftest import ODD
from wicketflow.llm import pieces, queries


@pytest.fixture(scope="module")
def model():
    return queries.tokenizer_file("piece_bpe_32k.model")


def test_whole_table(spark, small, documents):
    got = queries.op10_sentencepiece(spark, small).collect()
    assert len(got) == documents.count()
    assert all(r.lossless for r in got)


def test_odd_rows_are_lossless_and_reproducible(odd, model):
    texts = odd.withColumn("ids", odd.fp)  # a clashing column
    first = pieces.encode(texts, model)
    back = pieces.decode(first, model).collect()
    assert len(back) == len(ODD) + 1
    for r in back:
        assert r.decoded == r.text
        assert (r.ids is None) == (r.text is None)
        assert r.text != "" or r.ids == []

    def ids(df):
        return sorted((str(r.doc_id), str(r.text), str(r.ids)) for r in df.collect())

    assert ids(first) == ids(pieces.encode(texts.repartition(5), model))
    assert ids(first) != ids(pieces.encode(texts, model, seed=1))


def test_marks_and_unknown_characters(spark, model):
    rows = [(i, t) for i, t in enumerate(["▁", "a▁b", " a", "  a  b ", "\u0000͸", "😀😀"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = pieces.decode(pieces.encode(docs, model), model).collect()
    assert all(r.decoded == r.text for r in got)


def segmentations(text, known):
    if not text:
        return [()]
    return [(text[:n], *rest) for n in range(1, len(text) + 1)
            if text[:n] in known.ids for rest in segmentations(text[n:], known)]


@pytest.mark.parametrize("word", ["then", "hello"])
def test_samples_follow_the_lattice(spark, model, word):
    known = pieces.Pieces(model, 0.3)
    weight = {}
    for way in segmentations(" " + word, known):
        product = 1.0
        for p in way:
            product *= known.weight[p]
        weight[tuple(known.ids[p] for p in way)] = product
    total = sum(weight.values())
    n = 20_000
    docs = spark.range(n).selectExpr("id doc_id", f"'{word}' text")
    seen = Counter(tuple(r.ids) for r in pieces.encode(docs, model, alpha=0.3).collect())
    assert set(seen) <= set(weight)
    for way, w in weight.items():
        p = w / total
        assert abs(seen[way] - n * p) <= 5 * (n * p * (1 - p)) ** 0.5 + 3


def test_decoding_of_bad_ids(spark, model):
    docs = spark.createDataFrame(
        [(1, None), (2, []), (3, [-1]), (4, [10 ** 6]), (5, [0])], "doc_id int, ids array<int>")
    got = {r.doc_id: r.decoded for r in pieces.decode(docs, model).collect()}
    assert got == {1: None, 2: "", 3: None, 4: None, 5: None}


def test_empty_table(odd, model):
    assert pieces.decode(pieces.encode(odd.where("false"), model), model).count() == 0
