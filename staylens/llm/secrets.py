r"""Secret scans with an incremental blob ledger.

Every version of a text is addressed by the SHA-256 of its content. The ledger
keeps, for each blob, the rule versions that have read it and the spans they
found. A scan reads one copy of each blob with only the rule versions the ledger
lacks, appends the result, and joins findings back to every path of the blob.

Null text counts as the empty text. A null or repeated key keeps its rows: the
result has one row per input row. Spans are code point offsets, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.session import configure, scratch_path

# Fixed rules: kind, pattern, capturing group that is measured, least length, version.
# The first three are the base kinds; the others add well-known key formats.
RULES = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6, 1),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20, 1),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24, 1),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, 1),
    ("pem", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", 0, 27, 1),
)
BASE = ("assign", "access", "hex")
SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"
ARROW_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("kind", pa.string())]))
LEDGER = f"blob binary, rules array<string>, spans {SPAN}"


def rule_ids(rules=RULES) -> list[str]:
    return [f"{kind}@{version}" for kind, _, _, _, version in rules]


def find(text: str, wanted, rules=RULES) -> list[tuple]:
    """Spans of the wanted rule versions, by start and rule order."""
    found = []
    for rank, ((kind, pattern, group, least, _), name) in enumerate(zip(rules, rule_ids(rules))):
        if name in wanted:
            for m in re.finditer(pattern, text, re.ASCII):
                if m.end(group) - m.start(group) >= least:
                    found.append((m.start(), rank, m.end(), kind))
    return sorted(found)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """What the ledger holds; a path without files is an empty ledger."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # A list would be read by Python workers of another kind, which stay beside those of the scan.
        return spark.range(0).select(F.from_json(F.lit(None).cast("string"), LEDGER).alias("row")).select("row.*")


def versions(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("path"), F.unhex(F.sha2(body.cast("binary"), 256)).alias("blob"), body.alias("body"))


def unseen(paths: DataFrame, ledger: DataFrame, rules=RULES) -> DataFrame:
    """One path of each blob that some rule version has not read, with those rule versions."""
    every = F.array(*[F.lit(r) for r in rule_ids(rules)])
    blobs = paths.groupBy("blob").agg(F.min(F.struct("path")).alias("one"))
    seen = ledger.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    todo = F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", "one.path", todo.alias("todo")).where(F.size("todo") > 0)


def scan(spark: SparkSession, docs: DataFrame, ledger_path: str, key: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """Scan what the ledger has not seen, append it, and return (path, blob, spans) for every row of ``docs``."""
    configure(spark)
    every = versions(docs, key, text)
    paths = every.select("path", "blob")
    todo = unseen(paths, read_ledger(spark, ledger_path), rules)
    # The text of one copy travels by its path, so a blob with very many copies loads no task.
    spread = F.coalesce(F.xxhash64("path"), F.lit(0))
    todo = todo.select(spread.alias("one_key"), F.col("path").alias("one"), F.col("blob").alias("one_blob"), "todo")
    same = (F.col("path_key") == F.col("one_key")) & F.col("path").eqNullSafe(F.col("one")) & (F.col("blob") == F.col("one_blob"))
    texts = every.withColumn("path_key", spread).join(todo, same)

    def read(batches) -> Iterator[pa.RecordBatch]:
        # Arrow alone: a worker that loads pandas holds it for the rest of its life.
        for batch in batches:
            bodies, wanted = batch.column("body"), batch.column("todo")
            spans = [[dict(zip(("start", "rank", "end", "kind"), s)) for s in find(t.as_py(), set(w.as_py()), rules)] for t, w in zip(bodies, wanted)]
            yield pa.RecordBatch.from_arrays([batch.column("blob"), wanted, pa.array(spans, ARROW_SPAN)], names=["blob", "rules", "spans"])

    found = texts.select("blob", "todo", "body").mapInArrow(read, LEDGER)
    found.write.mode("append").parquet(ledger_path)
    known = _known(read_ledger(spark, ledger_path), rules).withColumnRenamed("blob", "of")
    return paths.join(known, F.col("blob") == F.col("of"), "left").select(
        "path", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans")
    )


def _known(ledger: DataFrame, rules) -> DataFrame:
    """All spans of the given rule versions for each blob with any; a blob read twice counts once."""
    names = [r.split("@")[0] for r in rule_ids(rules)]
    rows = ledger.where(F.size("spans") > 0).select("blob", F.explode("rules").alias("rule"), "spans")
    rows = rows.where(F.col("rule").isin(rule_ids(rules))).select(
        "blob", F.explode(F.filter("spans", lambda s: s["kind"] == F.substring_index("rule", "@", 1))).alias("s")
    )
    rank = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("s.kind")).cast("int")
    return rows.groupBy("blob").agg(
        F.array_sort(F.collect_set(F.struct("s.start", rank.alias("rank"), "s.end", "s.kind"))).alias("spans")
    )


def spelled(spans):
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(spark: SparkSession, docs: DataFrame, ledger_path: str, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret of ``text`` replaced by ``mark``; all rows and columns stay, n_chars follows the text.

    Findings are joined by path, then cut out of the whole text; overlapping
    spans become one mark.
    """
    found = scan(spark, docs, ledger_path).where(F.size("spans") > 0).select("path", "blob", "spans").dropDuplicates(["path", "blob"])
    body = F.col("row.text")
    rows = docs.select(F.struct(*docs.columns).alias("row"))  # keeps its columns apart from those of the findings
    rows = rows.withColumn("row_blob", F.unhex(F.sha2(F.coalesce(body, F.lit("")).cast("binary"), 256)))
    joined = rows.join(found, F.col("row.doc_id").eqNullSafe(F.col("path")) & (F.col("row_blob") == F.col("blob")), "left")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    one = F.lit(1).cast("int")

    def cut(acc, s):
        before = F.when(
            s["start"] >= acc["at"],
            F.concat(acc["out"], F.substring(body, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark)),
        ).otherwise(acc["out"])
        return F.struct(before.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    clean = F.aggregate(
        "spans", start, cut, lambda acc: F.concat(acc["out"], F.substring(body, (acc["at"] + one).cast("int"), F.lit(2**31 - 1)))
    )
    clean = F.when(F.col("spans").isNull(), body).otherwise(clean)
    new = {"text": clean, "n_chars": F.coalesce(F.length(clean), F.lit(0))}
    return joined.select(*[(new[c].cast(docs.schema[c].dataType) if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _of_kinds(*kinds: str):
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from staylens.llm.words import documents

    rows = scan(spark, documents(spark, sf_dir), scratch_path(spark, "secret-ledger"))
    count = [F.size(_of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in BASE]
    base = _of_kinds(*BASE)
    return rows.select(F.col("path").alias("doc_id"), *count, F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))
