import random

import numpy as np

from tests.llm import brute
from wicketflow.llm import quality as q
from wicketflow.llm import queries

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "kept", "covered_words", "longest_repeat"]


def want(text):
    return brute.quality(text, q.LIMITS.min_words, q.LIMITS.max_covered, q.LIMITS.max_longest)


def test_whole_table(spark, small, documents):
    got = {r.doc_id: tuple(r[c] for c in COLUMNS)
           for r in queries.op4_quality_rules(spark, small).collect()}
    short = [r for r in documents.collect() if len(r.text.split()) < 700]
    assert len(got) == documents.count() and len(short) > 100
    for r in short:
        assert got[r.doc_id] == want(r.text), r.doc_id


def test_odd_rows(odd):
    rows = q.quality(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == want(r.text), r.text
    assert q.quality(odd.where("false")).count() == 0


def test_longest_repeats_against_every_pair():
    rng = random.Random(2)
    for _ in range(60):
        texts = [[rng.randrange(rng.choice((1, 2, 5))) for _ in range(rng.randrange(0, 25))]
                 for _ in range(rng.randrange(1, 5))]
        flat = np.array([x + 100 * d for d, t in enumerate(texts) for x in t], np.int64)
        sizes = np.array([len(t) for t in texts])
        got = q.longest_repeats(flat, np.repeat(np.cumsum(sizes), sizes)).tolist()
        expected = []
        for t in texts:
            for i in range(len(t)):
                best = 0
                for j in range(len(t)):
                    k = 0
                    while i != j and max(i, j) + k < len(t) and t[i + k] == t[j + k]:
                        k += 1
                    best = max(best, k)
                expected.append(best)
        assert got == expected


def test_chunks_do_not_matter(monkeypatch):
    texts = ["a b c d e f g h i " * 20, None, "one two three " * 9, "x y z"]
    whole = q.measure(texts, 8)
    monkeypatch.setattr(q, "CHUNK_WORDS", 10)
    assert q.measure(texts, 8) == whole
