"""Secret scans with an incremental blob ledger, in DataFrame operations only.

Every version of every text is addressed by its content (SHA-256: the *blob*).
The ledger, a Parquet table, records which rule versions a blob was scanned
with and what they found.  An update scans a blob only with the rule versions
it has not met, once per blob however many paths hold it, appends to the
ledger, and joins the findings back to all paths.

Offsets come from the lengths of matches and of the pieces between them; the
running sums are a window over the few rows that have matches.  No match spans
a line end, and matches of one rule never overlap.

Cases: a null text is the empty text; an empty table gives an empty result; a
repeated row is another path of the same blob; a null doc_id is a path of its
own; extra columns are ignored by the scan and kept by ``redact``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.session import scratch_dir


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if ``group`` (0: all of it) has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


BASE = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("hubtoken", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = BASE + MORE
SPREAD = 8
LEDGER = "blob string, scanned array<string>, found array<struct<start:int,kind:string,version:int,end:int>>"


def new_ledger(spark) -> str:
    """Path of a fresh ledger in the shared folder."""
    path = f"{scratch_dir(spark)}/llm-ledger-{uuid.uuid4().hex}"
    spark.createDataFrame([], LEDGER).write.parquet(path)
    return path


def _blob() -> Column:
    return F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)


def _paths(docs: DataFrame) -> DataFrame:
    rows = common.narrow(docs, doc_id="long", text="string").withColumn("blob", _blob())
    return rows.withColumn("path", F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), "blob")))


def update(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger lacks, append it, and return (doc_id, path, blob) of all rows."""
    spark = docs.sparkSession
    versions = common.stash(_paths(docs).select("doc_id", "path", "blob"), "versions")
    seen = (
        spark.read.schema(LEDGER).parquet(ledger).select("blob", F.explode("scanned").alias("rule"))
        .groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    )
    wanted = F.array(*[F.lit(r.key) for r in rules])
    pending = (
        versions.groupBy("blob").agg(F.min("path").alias("path")).join(seen, "blob", "left")
        .withColumn("todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
        .filter(F.size("todo") > 0).select("blob", "path", "todo")
    )
    # one row carries each blob's text; the narrow side is built into a hash table
    texts = _paths(docs).select("path", "blob", F.coalesce("text", F.lit("")).alias("text")).join(pending.hint("shuffle_hash"), ["path", "blob"])
    hits = texts.select(
        "blob", "todo", "text",
        *[F.when(F.array_contains("todo", r.key), F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))).alias(f"hit_{r.kind}") for r in rules],
    )
    raw = common.stash(
        hits.select("blob", F.col("todo").alias("scanned"), F.array_compact(F.array(*[_lengths(r) for r in rules])).alias("raw")), "raw-hits",
    )
    # a carrier may be repeated in the input: its copies have equal findings
    order = Window.partitionBy("blob", "kind").orderBy("i")
    spans = (
        raw.filter(F.size("raw") > 0).dropDuplicates(["blob"]).select("blob", F.explode("raw").alias("r"))
        .select("blob", "r.kind", "r.version", F.posexplode("r.hits").alias("i", "hit"))
        .withColumn("start", (F.sum(F.col("hit.gap") + F.col("hit.size")).over(order) - F.col("hit.size")).cast("int"))
        .filter("hit.counts")
        .select("blob", F.struct("start", "kind", "version", (F.col("start") + F.col("hit.size")).alias("end")).alias("span"))
        .groupBy("blob").agg(F.collect_list("span").alias("found"))
    )
    scanned = raw.select("blob", "scanned").dropDuplicates(["blob"])
    empty = F.array().cast("array<struct<start:int,kind:string,version:int,end:int>>")
    scanned.join(spans, "blob", "left").select("blob", "scanned", F.coalesce("found", empty).alias("found")).write.mode("append").parquet(ledger)
    return versions


def _lengths(rule: Rule) -> Column:
    """Of the rule's matches: the gap before, the size and whether it counts; null without a match."""
    hit = F.col(f"hit_{rule.kind}")
    gaps = F.transform(F.split("text", rule.pattern, -1), lambda s: F.length(s))
    sizes = F.transform(hit, lambda s: F.length(s))
    if rule.group:
        counts = F.transform(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)), lambda s: F.length(s) >= rule.least)
    else:
        counts = F.transform(hit, lambda s: F.length(s) >= rule.least)
    zipped = F.zip_with(
        F.zip_with(sizes, counts, lambda s, c: F.struct(s.alias("size"), c.alias("counts"))), F.slice(gaps, 1, F.size(hit)),
        lambda h, g: F.struct(g.alias("gap"), h["size"].alias("size"), h["counts"].alias("counts")),
    )
    return F.when(F.size(hit) > 0, F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), zipped.alias("hits")))


def findings(spark, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, found) of the blobs with findings of these rule versions: spans by
    start, then by the rules' order."""
    current = F.array(*[F.lit(r.key) for r in rules])
    rank = F.create_map(*[F.lit(v) for i, r in enumerate(rules) for v in (r.kind, i)])
    return (
        spark.read.schema(LEDGER).parquet(ledger).select("blob", F.explode("found").alias("s"))
        .filter(F.array_contains(current, F.concat_ws("@", "s.kind", "s.version")))
        .select("blob", F.struct(F.col("s.start").alias("start"), rank[F.col("s.kind")].alias("rank"), F.col("s.end").alias("end"), F.col("s.kind").alias("kind")).alias("s"))
        .groupBy("blob").agg(F.sort_array(F.collect_set("s")).alias("found"))
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, counts and digest of the base rules' spans, and all spans of each path."""
    spark = docs.sparkSession
    ledger = ledger or new_ledger(spark)
    versions = update(docs, ledger, rules)
    base = [r.kind for r in BASE]
    found = F.coalesce("found", F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>"))
    rows = versions.join(findings(spark, ledger, rules), "blob", "left").withColumn("found", found)
    count = [F.expr(f"cast(size(filter(found, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in base]
    return rows.select(
        "doc_id", *count,
        F.sha2(_joined(F.filter("found", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"), "blob",
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents with every finding replaced by ``[kind]``, all columns kept, whatever
    their names; n_chars, where the table has it, follows the text."""
    spark = docs.sparkSession
    ledger = new_ledger(spark)
    with common.temporary_tables(spark):
        update(docs, ledger, rules)
    found = findings(spark, ledger, rules)
    text = F.col("row.text").cast("string")
    cut = F.aggregate(
        "found", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(
                F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("["), s["kind"], F.lit("]")))).alias("out")),
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))),
    )
    blob = F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
    # a blob with findings may hold a third of the rows: its copies are dealt to SPREAD places
    spread = found.select("blob", "found", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("place"))
    rows = common.packed(docs).select("row", blob.alias("blob"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SPREAD)).cast("int").alias("place"))
    row = F.col("row").withField("text", F.when(F.col("found").isNull(), text).otherwise(cut))
    out = rows.join(spread, ["blob", "place"], "left").select(row.alias("row"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.length(F.coalesce(F.col("row.text"), F.lit(""))).cast(kind)
        out = out.select(F.col("row").withField("n_chars", F.when(F.col("row.n_chars").isNull(), F.col("row.n_chars")).otherwise(length)).alias("row"))
    return out.select("row.*")


def oracle_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL for ``scan``."""
    parts = []
    for i, r in enumerate(rules):
        p = r.pattern.replace("'", "''")
        parts.append(f"""
  SELECT doc_id, t, '{r.kind}' AS kind, {i} AS rnk, regexp_extract_all(t, '{p}') AS hits,
         regexp_extract_all(t, '{p}', {r.group}) AS parts, string_split_regex(t, '{p}') AS gaps, {r.least} AS least FROM d""")
    base = ", ".join(f"'{r.kind}'" for r in BASE)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(parts)}),
e AS (
  SELECT doc_id, kind, rnk, least, hits, parts, gaps, unnest(range(1, len(hits) + 1)) AS i FROM m WHERE len(hits) > 0),
s AS (
  SELECT doc_id, kind, rnk, length(hits[i]) AS size,
         list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start
  FROM e WHERE length(parts[i]) >= least),
g AS (
  SELECT doc_id, {counts},
         string_agg(kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT, ',' ORDER BY start, rnk) FILTER (WHERE kind IN ({base})) AS base_spans,
         string_agg(kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT, ',' ORDER BY start, rnk) AS spans
  FROM s GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in BASE)},
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(t) AS blob
FROM d LEFT JOIN g USING (doc_id)"""
