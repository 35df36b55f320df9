import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wicketflow.llm import bpe, queries

MIXED = [*"abc  \n\t x1é漢😀'st.!\x1c\x85̀", "<|endoftext|>", "  ", "   ", "\n\n", " '", "ing",
         "꟎", "\U0003d000", " the"]


@pytest.fixture(scope="module")
def path():
    return queries.tokenizer_file("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def wanted(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


def test_whole_table_equals_the_library(spark, small, documents, library):
    made = {r.doc_id: r for r in queries.op11_bpe(spark, small).collect()}
    rows = documents.collect()
    assert len(made) == len(rows)
    for r in rows:
        ids, text = wanted(library, r.text)
        assert (made[r.doc_id].n_tokens, made[r.doc_id].ids_sha256) == (
            len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert made[r.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(odd, path, library):
    df = odd.withColumn("ids", F.lit("a column of that name")).withColumn("decoded", F.lit(1))
    made = bpe.decode(bpe.encode(df, path), path)
    assert sorted(made.columns) == sorted(df.columns)
    rows = made.collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r.ids, r.decoded) == wanted(library, r.text)
    empty = bpe.decode(bpe.encode(odd.where("false"), path), path)
    assert empty.count() == 0


def test_random_texts_and_every_token(path, library):
    mine, rng = bpe.Encoder(path), random.Random(4)
    texts = ["".join(rng.choices(MIXED, k=rng.randrange(40))) for _ in range(4000)]
    texts += [library.decode([i], skip_special_tokens=False) for i in range(50257)]
    for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(mine.encode(t), "<u4").tolist() == e.ids, t


def test_long_texts_in_parts(path, library, monkeypatch):
    monkeypatch.setattr(bpe, "PART", 7)
    mine = bpe.Encoder(path)
    for t in ["x" * 40_000, "ab" * 9_000, " " * 20_000, "z é  \n q" * 3_000]:
        assert mine.encode(t) == wanted(library, t)[0]


def test_forgetting_changes_nothing(path, documents, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 40_000)
    mine = bpe.Encoder(path)
    for r in documents.limit(40).collect():
        assert mine.encode(r.text or "") == wanted(library, r.text)[0]
    assert mine.held <= 40_000 and mine.held == sum(
        len(p) + len(ids) + bpe.ENTRY_BYTES for p, ids in mine.known.items())


def test_merges_against_the_plain_rule():
    """Merge the pair of lowest rank, leftmost first, until none is left."""
    rng = random.Random(2)
    for _ in range(60):
        letters, made, merges = list("abc"), set("abc"), []
        for _ in range(14):
            a, b = rng.choice(letters), rng.choice(letters)
            if a + b not in made and len(a + b) < 8:
                merges.append((a, b))
                made.add(a + b)
                letters.append(a + b)
        rank = {m: i for i, m in enumerate(merges)}

        def plain(text):
            parts = list(text)
            while True:
                pairs = [(rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank]
                if not pairs:
                    return parts
                i = min(pairs)[1]
                parts[i:i + 2] = [parts[i] + parts[i + 1]]

        whole = [m for m in merges if plain(m[0] + m[1]) == [m[0] + m[1]]]
        if len(whole) < len(merges):  # a token that its own text does not give
            continue
        names = bpe.byte_letters() + [a + b for a, b in merges]
        model = bpe.Merges({t: i for i, t in enumerate(names)}, merges)
        for _ in range(60):
            text = "".join(rng.choices("abc", k=rng.randrange(1, 30)))
            assert [model.texts[t] for t in model.encode(text)] == plain(text)


def test_decoding_any_ids(spark, path, library):
    rng = random.Random(3)
    lists = [[rng.randrange(50257) for _ in range(9)] for _ in range(300)]
    rows = [(i, bytearray(np.array(v, "<u4").tobytes())) for i, v in enumerate(lists)]
    df = spark.createDataFrame(rows + [(None, None)], "i long, ids binary")
    for r in bpe.decode(df, path).collect():
        ids = lists[r.i] if r.i is not None else []
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.Encoder(queries.tokenizer_file("word_bpe_49k.json"))


def test_ascii_pieces_are_those_of_the_general_pattern(path, library):
    rng, mine = random.Random(4), bpe.Encoder(path)
    letters = [chr(i) for i in range(128)] + list("   aAsStTlL''..\n\n\t\x1c\x1d\x1f")
    for _ in range(2000):
        text = "".join(rng.choices(letters, k=rng.randrange(60)))
        assert bpe._ASCII_PIECES.findall(text) == bpe._PIECES.findall(text)
        assert mine.encode(text) == wanted(library, text)[0]
