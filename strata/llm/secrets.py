"""Secret scans over an incremental blob ledger (DataFrame functions only).

Every historical version of a path is addressed by the SHA-256 of its content. The ledger is a table in the shared
folder with one row per (blob, rule version) that was scanned, findings or not. A scan
takes the distinct blobs of the given versions, drops the pairs the ledger holds, reads each
remaining blob once for all rules it still lacks, appends the new pairs, and joins the findings back to
every path that has the blob. A new rule version re-scans blobs for that rule alone.

Positions without Python: the matches of a rule and the pieces between them (``split`` on the same
pattern) alternate through the text, so the running sum of their lengths gives each
match's start in code points. These arrays are made only for texts with a match long enough; all others pay for one regular
expression per rule. The join that brings each blob its text ends in a written table, which the scan reads.

Defined cases: NULL text equals empty text and has no spans. NULL paths keep their row. Rows that repeat path
and text each get the findings. An empty table gives an empty result. Texts of any length
are scanned whole. Only path and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.common import documents, filled, scratch, stored
from strata.sources.storage import empty_frame

SPANS = "array<struct<s:int,k:int,e:int>>"
LEDGER = f"blob string, rule string, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is matched leftmost, without overlap; a match stays if its ``group`` has
    ``at_least`` characters. ``needs`` is found in every text that has a match long enough."""

    kind: str
    version: int
    pattern: str
    group: int
    at_least: int
    needs: str

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


RULES = (
    Rule(
        "assign", 1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6, r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}""",
    ),
    # A run that is too short has no long enough part, so the length can stand in the pattern.
    Rule("access", 1, "AKIA[A-Z0-9]{16,}", 0, 20, "AKIA[A-Z0-9]{16}"),
    Rule("hex", 1, "[0-9a-f]{24,}", 0, 24, "[0-9a-f]{24}"),
)


def spans(text: Column, rule: Rule, order: int) -> Column:
    """Start, rule order and end of the rule's matches, in code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.slice(F.split(text, rule.pattern, -1), 1, F.size(found))
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast(SPANS).alias("out"))
    steps = F.arrays_zip(
        F.transform(between, F.length).alias("gap"),
        F.transform(found, F.length).alias("len"),
        F.transform(judged, F.length).alias("judged"),
    )

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        span = F.struct(begin.alias("s"), F.lit(order).alias("k"), (begin + x["len"]).alias("e"))
        out = F.when(x["judged"] >= rule.at_least, F.array_append(F.coalesce(acc["out"], F.array().cast(SPANS)), span))
        return F.struct((begin + x["len"]).alias("at"), out.otherwise(acc["out"]).alias("out"))

    every = F.aggregate(steps, start.cast(f"struct<at:int,out:{SPANS}>"), step, lambda acc: acc["out"])
    return F.when(text.rlike(rule.needs), every)


def scan_blobs(pending: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows of ``(blob, text, todo)``; ``todo`` holds the names of the rules to run."""
    scanned = [
        F.when(
            F.array_contains("todo", r.name),
            F.struct(F.lit(r.name).alias("rule"), spans(F.col("text"), r, i).alias("spans")),
        )
        for i, r in enumerate(rules)
    ]
    return (
        pending.select("blob", F.explode(F.filter(F.array(*scanned), lambda x: x.isNotNull())).alias("x"))
        .select("blob", "x.rule", F.coalesce(F.col("x.spans"), F.array().cast(SPANS)).alias("spans"))
    )


class Ledger:
    """The scanned (blob, rule version) pairs, as Parquet files under ``path``; scans only append."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return empty_frame(self.spark, StructType.fromDDL(LEDGER))
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def scan(
        self, versions: DataFrame, path_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
    ) -> DataFrame:
        """Scan what is new among ``versions``; the paths with their blobs, ``(path, blob)``, stored."""
        text = filled(F.col(text_col))
        index = stored(versions.select(F.col(path_col).alias("path"), F.sha2(text, 256).alias("blob")), "blob-index")
        names = F.array(*[F.lit(r.name) for r in rules])
        blobs = index.groupBy("blob").agg(F.min("path").alias("reader"))
        seen = self.read().select("blob", "rule").distinct().groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        pending = (
            blobs.join(seen, "blob", "left")
            .withColumn("todo", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))))
            .where(F.size("todo") > 0)
            .select("blob", "reader", "todo")
        )
        # One path reads the blob; its other paths get the findings later.
        texts = versions.select(F.col(path_col).alias("path"), text.alias("text"))
        # A merge join at every size: the ids grow with the corpus, so broadcasting them is no plan.
        readers = texts.join(pending.hint("merge"), F.col("path").eqNullSafe(F.col("reader")))
        readers = readers.where(F.sha2("text", 256) == F.col("blob")).select("blob", "text", "todo")
        fresh = scan_blobs(stored(readers, "pending-blobs"), rules)
        fresh.write.mode("append").option("compression", "zstd").parquet(self.path)
        return index

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """``(blob, spans)`` of the blobs with findings under these rule versions, by start then rule."""
        return (
            self.read()
            .where(F.col("rule").isin([r.name for r in rules]) & (F.size("spans") > 0))
            .groupBy("blob")
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"))
        )


def secret_scan(
    versions: DataFrame, ledger: Ledger, path_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``(path, blob, spans)``: one row per version, every path of a blob with all its findings."""
    index = ledger.scan(versions, path_col, text_col, rules)
    findings = stored(ledger.findings(rules), "blob-findings")  # so that AQE can split a blob that many paths share
    found = index.join(findings, "blob", "left")
    return found.select("path", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(documents(spark, sf_dir), Ledger(spark, scratch(spark, "secret-ledger")))
    kinds = F.array(*[F.lit(r.kind) for r in RULES])
    shown = F.array_join(
        F.transform("spans", lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ","
    )

    def count(order: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["k"] == order)).cast("long")

    counts = [count(i).alias(f"n_{r.kind}") for i, r in enumerate(RULES)]
    return found.select(
        F.col("path").alias("doc_id"), *counts, F.sha2(shown, 256).alias("base_sha256"), shown.alias("spans")
    )


def _oracle() -> str:
    either = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    words = "|".join([*(either(w) for w in ("password", "passwd", "secret", "token")), either("api") + "_?" + either("key")])
    assign = rf"""({words})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    kinds = (("assign", assign, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24))
    parts = " UNION ALL ".join(
        f"""SELECT doc_id, {k} AS k, '{kind}' AS kind, unnest(regexp_extract_all(t, '{p}')) AS m,
            unnest(regexp_extract_all(t, '{p}', {g})) AS judged,
            unnest(string_split_regex(t, '{p}')[:-2]) AS gap, {least} AS least,
            unnest(generate_series(1, len(regexp_extract_all(t, '{p}')))) AS i FROM d"""
        for k, (kind, p, g, least) in enumerate(kinds)
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({parts}),
p AS (
  SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, k ORDER BY i) - length(m) AS s FROM m),
g AS (
  SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
         count(*) FILTER (WHERE k = 2) AS n_hex,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + length(m) AS BIGINT), ',' ORDER BY s, k) AS spans
  FROM p WHERE length(judged) >= least GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


ORACLE = _oracle()
