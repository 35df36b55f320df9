from pyspark.sql import functions as F

from tests.llm import brute
from wicketflow.llm import queries, secrets
from wicketflow.session import fresh_path


def digest_rows(found):
    kinds = tuple(r.kind for r in secrets.RULES)
    counts = [F.size(secrets.of_kinds((k,))).cast("long") for k in kinds]
    rows = found.select("doc_id", *counts, F.sha2(secrets.digest(kinds), 256), secrets.digest())
    return sorted((tuple(r) for r in rows.collect()), key=str)


def expected(docs):
    return sorted(((r.doc_id, *brute.secrets(r.text)) for r in docs.collect()), key=str)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    got = sorted((tuple(r) for r in queries.op1_secret_scans(spark, sf).collect()), key=str)
    assert got == expected(spark.read.parquet(f"{sf}/documents.parquet"))
    assert sum(r[1] + r[2] + r[3] for r in got) > 0


def test_odd_rows(odd):
    assert digest_rows(secrets.scan(odd)) == expected(odd)


def test_empty_table(odd):
    assert secrets.scan(odd.where("false")).count() == 0


def test_only_unseen_pairs_are_scanned(spark, odd):
    ledger = fresh_path(spark, "ledger")
    part = odd.where("doc_id < 15")
    secrets.scan_new(part, ledger)
    first = {bytes(r.blob) for r in secrets.read_ledger(spark, ledger).collect()}
    secrets.scan_new(part, ledger)
    assert secrets.read_ledger(spark, ledger).count() == len(first)
    secrets.scan_new(odd, ledger)
    entries = secrets.read_ledger(spark, ledger)
    assert entries.count() == entries.select("blob").distinct().count() > len(first)
    assert digest_rows(secrets.findings(odd, ledger)) == expected(odd)
    newer = (secrets.RULES[0], secrets.Rule("access", "AKIA[A-Z0-9]{12,}", 0, 17, version=2),
             secrets.RULES[2])
    secrets.scan_new(odd, ledger, newer)
    added = secrets.read_ledger(spark, ledger).where("rules = array('access@2')")
    assert added.count() == entries.select("blob").distinct().count()
    spans = secrets.findings(odd, ledger, newer).selectExpr("explode(secrets) s").where(
        "s.kind = 'access'").collect()
    assert spans and all(r.s.end - r.s.start >= 17 for r in spans)


def test_redaction(odd):
    rows = secrets.scan(odd).select("text", "secrets", secrets.redacted(F.col("text")).alias("out"))
    hits = 0
    for r in rows.collect():
        if not r.secrets:
            assert r.out == r.text
            continue
        hits += 1
        hidden = set().union(*(range(s.start, s.end) for s in r.secrets))
        rest = "".join(c for i, c in enumerate(r.text) if i not in hidden)
        assert r.out.replace("[SECRET]", "") == rest
    assert hits > 3


def test_no_python_in_the_plan(documents):
    plan = secrets.scan(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
