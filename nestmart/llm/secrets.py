"""Secret scans with an incremental blob ledger, in DataFrame operations only.

Texts are content-addressed by SHA-256. The ledger, a Parquet folder in shared
storage, has a row for every blob and increment: the rule versions scanned and
the spans found. A run scans only those pairs of blob and rule version that
the ledger lacks, appends what it finds, and joins all findings back to every
row (path) that holds the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestmart.session import path_exists, scratch_path


@dataclass(frozen=True)
class Rule:
    """``min_value``: least length of ``value`` (a group of the pattern), else the match is dropped."""

    kind: str
    version: int
    pattern: str
    value: int = 0
    min_value: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}/{self.version}"


#: The base rules' patterns and lengths, then rules that add spans.
RULES = (
    Rule("assign", 1, r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                      r"([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
)
BASE_KINDS = ("assign", "access", "hex")


def _all(text: Column, rule: Rule, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group))


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule's matches in code points, from what matches and what lies between."""
    found = F.arrays_zip(_all(text, rule, 0).alias("hit"), _all(text, rule, rule.value).alias(
        "value"), F.split(text, rule.pattern, -1).alias("gap"))
    none = F.struct(F.lit(0).alias("at"), F.array().cast(
        "array<struct<start:int,rank:int,end:int>>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(F.coalesce(x["hit"], F.lit("")))
        keep = x["hit"].isNotNull() & (F.length(x["value"]) >= rule.min_value)
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(keep, F.array_append(state["out"], span)).otherwise(
            state["out"]).alias("out"))

    return F.aggregate(found, none, step, lambda s: s["out"])


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, rules, spans) of blobs (blob, text, done: rule versions scanned before)."""
    empty = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    todo = [~F.array_contains("done", r.key) for r in rules]
    spans = [F.when(t & F.col("text").rlike(r.pattern), _spans(F.col("text"), r, k)).otherwise(
        empty) for k, (r, t) in enumerate(zip(rules, todo, strict=True))]
    ran = F.array_compact(F.array(*(F.when(t, F.lit(r.key)) for r, t in
                                    zip(rules, todo, strict=True))))
    return blobs.select("blob", ran.alias("rules"), F.concat(*spans).alias("spans"))


def secret_spans(docs: DataFrame, ledger: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Spans of secrets in every row's text, by way of the ledger in folder ``ledger``.

    Returns id_col, blob and spans (array of kind, start, end in code points,
    end exclusive; sorted by start, then by the rules' order); one row for
    each input row. Without a folder, the ledger is a new one.

    * NULL text counts as the empty text. Empty texts have no spans.
    * Repeated rows and copies share one scan; each row gets the findings.
    * A blob that stands in the ledger twice (two runs at once, or an append
      that was tried again) has its findings once.
    * NULL ids are ordinary rows. An empty table gives no rows. Other columns
      are not read.
    * Findings of rule versions that are not in ``rules`` stay in the ledger
      and are not returned.
    """
    spark = docs.sparkSession
    ledger = ledger or scratch_path(spark, "secret-ledger")
    schema = ("blob binary, rules array<string>, "
              "spans array<struct<start:int,rank:int,end:int,kind:string,rule:string>>")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), F.unhex(F.sha2(text, 256)).alias("blob"),
                       text.alias("text"))
    none = F.array().cast("array<string>")
    blobs = rows.groupBy("blob").agg(F.first("text").alias("text"))
    if path_exists(spark, ledger):
        done = spark.read.schema(schema).parquet(ledger).groupBy("blob").agg(
            F.flatten(F.collect_list("rules")).alias("done"))
        blobs = blobs.join(done, "blob", "left").withColumn("done", F.coalesce("done", none))
    else:
        blobs = blobs.withColumn("done", none)
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    keys = F.array(*(F.lit(r.key) for r in rules))
    scan(blobs, rules).filter(F.size("rules") > 0).withColumn("spans", F.transform(
        "spans", lambda s: F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"),
            F.get(kinds, s["rank"]).alias("kind"), F.get(keys, s["rank"]).alias("rule")))
    ).write.mode("append").parquet(ledger)
    known = spark.read.schema(schema).parquet(ledger).filter(F.size("spans") > 0)
    found = known.groupBy("blob").agg(F.array_distinct(
        F.flatten(F.collect_list("spans"))).alias("spans")).select(
        "blob", F.transform(
            F.sort_array(F.filter("spans", lambda s: F.array_contains(keys, s["rule"]))),
            lambda s: F.struct(
                s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
        ).alias("spans"))
    return rows.select(id_col, "blob").join(found, "blob", "left").select(
        id_col, "blob", F.coalesce("spans", F.array().cast(
            "array<struct<kind:string,start:int,end:int>>")).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kinds(spans: Column | str, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
