import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from wicketflow.llm import packing, queries


def load():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))


def test_whole_table(spark, small, documents):
    pieces = queries.op8_packing(spark, small).collect()
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert brute.check_packing(rows, pieces, load()) == 0


def test_odd_rows(odd):
    df = odd.where("doc_id is not null").dropDuplicates(["doc_id"]).repartition(3)
    path = queries.tokenizer_file("word_bpe_49k.json")
    pieces = packing.pack(df, path, length=64, open_windows=2).withColumn(
        "ids_crc32", F.crc32("ids")).collect()
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert brute.check_packing(rows, pieces, load(), 64) == 0
    total = sum(p.length for p in packing.pack(odd, path).collect())
    assert total == sum(len(load().encode(r.text or "", add_special_tokens=False).ids) + 1
                        for r in odd.collect())
    assert packing.pack(odd.where("false"), path).count() == 0


def test_chunked_ids_equal_the_tokenizers(documents):
    whole, mine = load(), packing.ChunkTokenizer(queries.tokenizer_file("word_bpe_49k.json"))
    texts = [r.text for r in documents.collect()]
    texts += ["it's. IT'S! o'clock; 'tis 'll ... x?!y. 3.14, 7th. É! é. J̌. Ǩ! "
              "ǅ. İ! ß? K. a b.  x. Ⅷ. ²! naïve. 😀. <|endoftext|>. <|startoftext|>"]
    for t, ids in zip(texts, mine.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_windows_are_full():
    rng = random.Random(1)
    packer, sizes = packing.Packer(100, 4), [rng.randrange(1, 250) for _ in range(300)]
    out = [w for i, n in enumerate(sizes) for w in packer.place(i, 0, b"abcd" * n)]
    assert all(w.filled == 100 for w in out) and len(packer.windows) <= 4
    left = [p for w in packer.windows for p in packing.powers_of_two(w)]
    assert all(w.filled & (w.filled - 1) == 0 for w in left)
    assert sum(w.filled for w in out + left) == sum(sizes)


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="white space"):
        packing.ChunkTokenizer(queries.tokenizer_file("byte_bpe_50k.json"))
