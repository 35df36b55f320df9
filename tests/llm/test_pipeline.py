import corpus_pipeline
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from wicketflow.llm import linededup, quality, queries
from wicketflow.session import stage


def test_stages_one_by_one(spark, small, documents):
    docs, seen = documents, []
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = stage(apply(spark, docs, small), name)
        assert docs.columns == documents.columns
        seen.append(docs.collect())
    raw, (good, lines, single, clean) = documents.collect(), seen
    limits = quality.LIMITS
    kept = {r.doc_id for r in quality.quality(documents, limits=limits).where("kept").collect()}
    assert {r.doc_id for r in good} == kept and 0 < len(good) < len(raw)
    want = brute.line_dedup([(r.doc_id, r.source, r.text) for r in good], linededup.RATIO,
                            linededup.MIN_PAGES)
    assert sorted((r.doc_id, r.text) for r in lines) == sorted((w[0], w[1]) for w in want)
    groups = brute.near_duplicates([(r.doc_id, r.text) for r in lines])
    assert sorted(r.doc_id for r in single) == sorted({g[2] for g in groups})
    assert sorted(r.doc_id for r in clean) == sorted(r.doc_id for r in single)
    assert all(r.n_chars == len(r.text) for r in clean)
    pieces = (corpus_pipeline.STAGES[-1][1](spark, docs, small)
              .withColumn("ids_crc32", F.crc32("ids")).collect())
    tokenizer = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json"))
    brute.check_packing([(r.doc_id, r.text) for r in clean], pieces, tokenizer)


def test_run(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 0
