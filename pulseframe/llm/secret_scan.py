"""Secrets in every version of a corpus, by a ledger of what was scanned already.

Each version of a text is named by the digest of its content, its blob. The ledger holds the spans
that each version of a rule found in each blob, also where there are none. A scan reads only the
blobs for which the ledger lacks one of the rules, once whatever the number of their copies, and
looks the spans up for all paths.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseframe.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """What to look for. A rule that changes gets a new version, so all blobs are scanned for it again.

    A match counts if the ``group`` of its pattern has ``least`` characters.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}/{self.version}"


# Fixed values. Shorter runs after AKIA, or of hexadecimal digits, hold no longer ones, so the least length is in the pattern.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}"),
)
# Beyond these: heads of private keys, and signed web tokens of three parts.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = (*BASE, *MORE)

SPANS = "blob binary, rule string, spans array<struct<start: long, end: long>>, batch string"


def address(text: Column) -> Column:
    """Digest of a text's bytes; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(blob, rule, spans, batch): what was scanned so far, one row for each blob and version of a rule."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], SPANS)
    return spark.read.schema(SPANS).parquet(path)


def _matches(rule: Rule) -> Column:
    """(gap, whole, part) of each match of a text: what lies before it, itself, its group.

    What follows the last match is a gap without a match. Null if there is none.
    """
    found = [F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(g)) for g in (0, rule.group)]
    zipped = F.arrays_zip(
        F.split("text", rule.pattern, -1).alias("gap"), found[0].alias("whole"), found[1].alias("part")
    )
    return F.when(F.col("text").rlike(rule.pattern), zipped)


def _spans(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, rule, spans) for the rules in ``todo`` of each (blob, text, todo)."""
    each = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.least).alias("least"),
                F.when(F.array_contains("todo", r.name), _matches(r)).alias("found"),
                F.array_contains("todo", r.name).alias("due"),
            )
            for r in rules
        ]
    )
    # the outer form: the other one would compute the matches twice, once to see whether there are any
    by_rule = texts.select("blob", F.explode_outer(each).alias("r")).select("blob", "r.*").filter("due")
    items = by_rule.select("blob", "rule", "least", F.posexplode_outer("found").alias("i", "m"))
    lengths = items.select(
        "blob", "rule", "i",
        (F.length("m.part") >= F.col("least")).alias("counts"),
        F.length("m.whole").cast("long").alias("size"),
        (F.length("m.gap") + F.coalesce(F.length("m.whole"), F.lit(0))).cast("long").alias("step"),
    )
    so_far = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = lengths.withColumn("end", F.sum("step").over(so_far))
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "end")
    spans = F.array_sort(F.collect_list(F.when(F.col("counts"), span)))
    return placed.groupBy("blob", "rule").agg(spans.alias("spans"))


def scan(
    history: DataFrame,
    path: Sequence[str],
    ledger_path: str,
    batch: str,
    text: str = "text",
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """(path columns.., blob, findings) for every row of ``history``, with the ledger brought up to date.

    ``findings`` lists (start, end, kind) in code points, end exclusive, by start, then in the
    order of ``rules``. What this scan adds to the ledger is its part ``batch``; a scan that is
    repeated under the same name writes that part again, so one that broke off leaves nothing twice.

    A null text counts as empty. Repeated rows, and paths with the same content, are rows of their own
    with the same findings. An empty table gives no rows. Columns other than ``path`` and ``text`` are
    left out, whatever their names.
    """
    spark = history.sparkSession
    content = F.col(f"`{text}`").cast("string")
    named = history.select(
        F.struct(*[F.col(f"`{c}`") for c in path]).alias("path"),
        address(content).alias("blob"),
        F.coalesce(content, F.lit("")).alias("text"),
    )
    # Copies of a blob are dealt out by salt. It is written with the rows, so it is the same whenever they are read.
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = scratch_path(spark, "secret-paths")
    named.select("path", "blob", (F.monotonically_increasing_id() % salts).cast("int").alias("salt")).write.parquet(at)
    paths = spark.read.parquet(at)

    known = ledger(spark, ledger_path).filter(F.col("batch") != batch).select("blob", "rule", "spans")
    seen = known.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    every = F.array(*[F.lit(r.name) for r in rules])
    todo = paths.select("blob").distinct().join(seen, "blob", "left")
    todo = todo.select("blob", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo"))
    # one text for each blob, taken in the map tasks first
    texts = named.groupBy("blob").agg(F.first("text").alias("text"))
    new = _spans(texts.join(todo.filter(F.size("todo") > 0), "blob"), rules)
    new.write.mode("overwrite").parquet(f"{ledger_path}/batch={batch}")

    order = {r.name: k for k, r in enumerate(rules)}
    current = ledger(spark, ledger_path).filter(F.col("rule").isin(*order)).filter(F.size("spans") > 0)
    once = current.groupBy("blob", "rule").agg(F.first("spans").alias("spans"))
    rank = F.create_map(*[F.lit(x) for r in rules for x in (r.name, order[r.name])])
    lists = F.transform(
        "spans", lambda s: F.struct(s["start"].alias("start"), rank[F.col("rule")].alias("rank"), s["end"].alias("end"))
    )
    by_blob = once.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list(lists))).alias("findings"))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    findings = F.transform(
        "findings", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), kinds[s["rank"]].alias("kind"))
    )
    by_blob = by_blob.select("blob", findings.alias("findings"))
    # a blob has one row here for each salt, so the second join has no hot key
    dealt = paths.select("blob", "salt").distinct().join(by_blob, "blob")
    found = paths.join(dealt, ["blob", "salt"], "left")
    empty = F.array().cast(by_blob.schema["findings"].dataType)
    return found.select("path.*", F.lower(F.hex("blob")).alias("blob"), F.coalesce("findings", empty).alias("findings"))


def listed(findings: Column, kinds: Sequence[str]) -> Column:
    """Findings of these kinds as text: kind:start:end, joined by commas."""
    own = F.filter(findings, lambda f: f["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def count(findings: Column, kind: str) -> Column:
    return F.size(F.filter(findings, lambda f: f["kind"] == kind)).cast("long")
