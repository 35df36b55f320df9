"""Secret scans: an incremental ledger of content-addressed blobs, in built-in functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wicketflow.session import fresh_path


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of `pattern` whose group `group` has `least` characters.

    Raise `version` with every change: blobs are then scanned again for this rule alone.
    """

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed values of the base rules. A run of exactly these characters is found whole or not
#: at all, so the least length can stand in the pattern of `access` and `hex`.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
         r"([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
SPAN = "struct<rule:string,start:bigint,end:bigint>"
LEDGER = "blob binary, rules array<string>, spans array<%s>" % SPAN


def blob_key(text: Column) -> Column:
    """The content address; a null text is an empty blob."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def rule_spans(text: Column, rule: Rule) -> Column:
    """Spans (code points, end exclusive) of one rule in one text.

    The pieces between the matches and the matches take turns, so the starts are running
    sums of their lengths. A text without any match is not split.
    """
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    pieces = F.transform(F.split(text, rule.pattern, -1), F.length)
    parts = F.arrays_zip(pieces.alias("gap"), F.transform(whole, F.length).alias("size"),
                         F.transform(group, F.length).alias("checked"))
    none = F.array().cast(f"array<{SPAN}>")

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + F.coalesce(part["size"], F.lit(0))
        span = F.struct(F.lit(rule.key).alias("rule"), start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(
            F.coalesce(part["checked"], F.lit(0)) >= rule.least,
            F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    first = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))
    walked = F.aggregate(parts, first, step, lambda s: s["spans"])
    return F.when(text.rlike(rule.pattern), walked).otherwise(none)


def scan_new(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES,
             text: str = "text") -> None:
    """Scan each blob of `versions` for the rule versions that the ledger lacks, and append.

    `versions` holds every historical version of every path, one row each. Equal texts are
    one blob, combined before the shuffle. A blob of which all pairs are in the ledger is not
    scanned; a new rule version scans all blobs for that rule only. A run that was broken off
    leaves no entries, so it is simply run again; entries that come twice do no harm.
    """
    wanted = F.array(*[F.lit(r.key) for r in rules])
    body = F.coalesce(F.col(text), F.lit(""))
    blobs = (versions.select(blob_key(F.col(text)).alias("blob"), body.alias("body"))
             .groupBy("blob").agg(F.first("body").alias("body")))
    seen = (read_ledger(versions.sparkSession, ledger)
            .select("blob", F.explode("rules").alias("rule"))
            .groupBy("blob").agg(F.collect_set("rule").alias("seen")))
    pending = F.array_except(wanted, F.coalesce(F.col("seen"), F.array().cast("array<string>")))
    todo = (blobs.join(seen, "blob", "left").select("blob", "body", pending.alias("rules"))
            .where(F.size("rules") > 0))
    none = F.array().cast(f"array<{SPAN}>")
    spans = F.concat(*[
        F.when(F.array_contains("rules", r.key), rule_spans(F.col("body"), r)).otherwise(none)
        for r in rules])
    todo.select("blob", "rules", spans.alias("spans")).write.mode("append").parquet(ledger)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's entries; a ledger that does not exist yet is an empty one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def findings(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES,
             text: str = "text") -> DataFrame:
    """`versions` with `secrets`: the ledger's spans of each row's blob, joined to all paths.

    `secrets` is an array of (start, order, kind, end), sorted; `order` is the place of the
    rule in `rules`. Rows of a hot blob are split by adaptive execution.
    """
    spark = versions.sparkSession
    order = spark.createDataFrame([(r.key, i, r.kind) for i, r in enumerate(rules)],
                                  "key string, order int, kind string")
    place = F.broadcast(order)  # one row for each rule
    found = (read_ledger(spark, ledger).select("blob", F.explode("spans").alias("s"))
             .join(place, F.col("s.rule") == F.col("key"))
             .groupBy("blob").agg(F.array_sort(F.collect_set(F.struct(
                 F.col("s.start").alias("start"), "order", "kind", F.col("s.end").alias("end")
             ))).alias("secrets"))
             .withColumnRenamed("blob", "__blob"))
    if "secrets" in versions.columns:
        raise ValueError("versions has a column called secrets")
    joined = versions.join(found, blob_key(versions[text]) == F.col("__blob"), "left")
    empty = F.array().cast("array<struct<start:bigint,order:int,kind:string,end:bigint>>")
    return joined.withColumn("secrets", F.coalesce("secrets", empty)).drop("__blob")


def scan(versions: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES,
         text: str = "text") -> DataFrame:
    """Bring the ledger up to date with `versions` and return their findings.

    Null and empty texts have no findings; repeated rows each get theirs; other columns pass
    through; an empty table gives an empty one. Without `ledger` a fresh one is made in the
    shared folder.
    """
    ledger = ledger or fresh_path(versions.sparkSession, "ledger")
    scan_new(versions, ledger, rules, text)
    return findings(versions, ledger, rules, text)


def of_kinds(kinds: tuple[str, ...]) -> Column:
    return F.filter("secrets", lambda s: s["kind"].isin(*kinds))


def digest(kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of the secrets, comma-joined, in their order."""
    chosen = F.col("secrets") if kinds is None else of_kinds(kinds)
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping secrets replaced by `mark`."""

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        apart = span["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(apart, F.concat(state["out"], gap, F.lit(mark)))
            .otherwise(state["out"]).alias("out"))

    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = F.aggregate("secrets", first, step, lambda s: F.concat(
        s["out"], F.substring(text, s["at"] + 1, F.length(text) - s["at"])))
    return F.when(F.size("secrets") > 0, rest).otherwise(text)
