import pytest

from tests.llm import brute
from wicketflow.llm import linededup


def check(df, **limits):
    rows = [(r.doc_id, r.source, r.text) for r in df.collect()]
    got = [(r.doc_id, r.clean_text, r.n_lines, r.n_dropped)
           for r in linededup.drop_boilerplate(df, **limits).collect()]
    wanted = brute.line_dedup(rows, limits.get("ratio", linededup.RATIO),
                              limits.get("min_pages", linededup.MIN_PAGES))
    assert sorted(got, key=str) == sorted(wanted, key=str)
    return got


def test_whole_table(documents):
    check(documents)
    assert sum(r[3] for r in check(documents, ratio=0.1, min_pages=2)) > 0


def test_odd_rows(odd):
    check(odd)
    check(odd, ratio=0.0, min_pages=1)
    check(odd, ratio=0.3, min_pages=1)
    check(odd.where("false"))


def test_a_line_at_the_ratio_stays(spark):
    rows = [(i, "h", ("menu\n" if i < 10 else "") + f"text {i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert sum(r[3] for r in check(df, ratio=0.5)) == 0
    assert sum(r[3] for r in check(df, ratio=0.49)) == 10


def test_clashing_names_are_refused(odd):
    with pytest.raises(ValueError):
        linededup.drop_boilerplate(odd.withColumnRenamed("fp", "n_lines"))
