"""Secret scans over an incremental blob ledger.

Every version of every text is addressed by the SHA-256 of its bytes (a blob).
The ledger holds, per blob, which rule versions have been run and what they
found. A scan looks only at unseen pairs of blob and rule version, adds a
ledger row for them, and joins the findings back to all paths of the blob.
DataFrame functions only: matches are fenced with a control character that no
rule can match, the text is split there, and lengths give the positions.

Spans are in code points, end exclusive. Defined results: a null text is the
empty blob; rows with equal texts share one scan; null and repeated paths stay
as they are; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import written
from tickweave.plans.small import bounded_broadcast

FENCE, OTHER = "\x01", "\x02"  # a fence in the text itself is read as the other one


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has at
    least ``least`` characters. A new pattern needs a new version."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def found(self, text: Column) -> Column:
        """array<struct<kind, start, end>> in one text."""
        fenced = F.regexp_replace(text, self.pattern, f"{FENCE}$0{FENCE}")
        parts = F.split(fenced, FENCE, -1)  # every second part is a match
        value = lambda m: F.regexp_extract(m, self.pattern, self.group) if self.group else m
        none = F.array().cast("array<struct<kind:string,start:long,end:long>>")
        start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(False).alias("odd"), none.alias("spans"))

        def step(s: Column, part: Column) -> Column:
            end = s["at"] + F.length(part)
            span = F.array(F.struct(F.lit(self.kind).alias("kind"), s["at"].alias("start"), end.alias("end")))
            keep = s["odd"] & (F.length(value(part)) >= self.least)
            return F.struct(end.alias("at"), (~s["odd"]).alias("odd"), F.when(keep, F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

        return F.when(text.rlike(self.pattern), F.aggregate(parts, start, step, lambda s: s["spans"])).otherwise(none)


# The base kinds, in the order in which they are listed.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # maximal runs: asking for the length in the pattern finds the same ones
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Added by the scanner: kinds with a fixed beginning.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE + MORE


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...], ledger: DataFrame | None) -> DataFrame:
    """Ledger rows (blob, scanned array<struct<rule, spans>>) for the unseen
    pairs of the distinct ``blobs`` (blob, text) and the rule versions."""
    every = F.array(*[F.lit(r.key) for r in rules])
    if ledger is None:
        due = blobs.withColumn("due", every)
    else:
        seen = ledger.groupBy("blob").agg(F.flatten(F.collect_list("scanned.rule")).alias("seen"))
        due = blobs.join(seen, "blob", "left").withColumn("due", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))))
        due = due.filter(F.size("due") > 0)
    clean = due.withColumn("text", F.translate("text", FENCE, OTHER))
    runs = [F.when(F.array_contains("due", r.key), F.struct(F.lit(r.key).alias("rule"), r.found(F.col("text")).alias("spans"))) for r in rules]
    return clean.select("blob", F.filter(F.array(*runs), lambda x: x.isNotNull()).alias("scanned"))


def scan(versions: DataFrame, path: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES,
         ledger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings, new ledger rows). Findings: one row per row of ``versions``,
    with path, blob and spans (array<struct<kind, start, end>>, by start, then
    in the order of ``rules``). Append the ledger rows to ``ledger`` for the
    next scan: what is in it is not scanned again."""
    rows = versions.select(F.col(path).alias("path"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", blob_of(F.col("text")))
    blobs = rows.groupBy("blob").agg(F.first("text").alias("text"))
    fresh = written(scan_blobs(blobs, rules, ledger), "secret-ledger")
    known = fresh if ledger is None else fresh.unionByName(ledger.select("blob", "scanned"))
    per_blob = spans_of(known, rules).filter(F.size("spans") > 0)
    none = F.array().cast("array<struct<kind:string,start:long,end:long>>")
    found = rows.select("path", "blob").join(per_blob, "blob", "left").select("path", "blob", F.coalesce("spans", none).alias("spans"))
    return found, fresh


def spans_of(ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, spans) of the current rule versions, from all ledger rows."""
    keys = [r.key for r in rules]
    order = reduce(lambda e, r: e.when(F.col("s.kind") == r[1].kind, F.lit(r[0])), enumerate(rules), F.when(F.lit(False), F.lit(-1)))
    hits = ledger.select("blob", F.explode("scanned").alias("x")).filter(F.col("x.rule").isin(keys))
    hits = hits.select("blob", F.explode("x.spans").alias("s")).distinct()
    hits = hits.select("blob", F.struct(F.col("s.start").alias("start"), order.alias("o"), F.col("s.end").alias("end"), F.col("s.kind").alias("kind")).alias("s"))
    # the spans of one text, so no larger than a text
    return hits.groupBy("blob").agg(F.transform(F.sort_array(F.collect_list("s")), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, hash of the base spans, all spans."""
    found, _ = scan(docs)
    spans, kinds = F.col("spans"), [r.kind for r in BASE]
    base = F.filter(spans, lambda s: s["kind"].isin(kinds))
    of = lambda k: F.filter(spans, lambda s: s["kind"] == k)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select(F.col("path").alias("doc_id"), *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(spans).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every found span replaced by ``mark`` (overlapping spans by
    one), and ``n_chars``, if there, counted anew. Texts without findings and
    null texts stay as they are."""
    _, ledger = scan(docs, rules=rules)
    hits = written(spans_of(ledger, rules).withColumnRenamed("blob", "__blob").withColumnRenamed("spans", "__spans"), "secret-hits")
    cols = docs.columns
    rows = docs.withColumn("__blob", blob_of(F.col("text"))).join(bounded_broadcast(hits, materialize=False), "__blob", "left")
    text = F.col("text").cast("string")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, span: Column) -> Column:
        gap = F.substring(text, s["at"].cast("int") + 1, (span["start"] - s["at"]).cast("int"))
        fresh = span["start"] >= s["at"]
        return F.struct(F.greatest(s["at"], span["end"]).alias("at"),
                        F.when(fresh, F.concat(s["out"], F.array(gap, F.lit(mark)))).otherwise(s["out"]).alias("out"))

    def rest(s: Column) -> Column:
        tail = F.substring(text, s["at"].cast("int") + 1, F.length(text))
        return F.array_join(F.concat(s["out"], F.array(tail)), "")

    rows = rows.withColumn("text", F.when(F.col("__spans").isNull(), text).otherwise(F.aggregate("__spans", start, step, rest)))
    if "n_chars" in cols:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return rows.select(*[F.col(f"`{c}`") for c in cols])
