"""The tables a scan and an encoder bring along start no Python workers of their own."""

from staylens.llm import pieces, secrets


def plan(frame):
    return frame._jdf.queryExecution().toString()


def test_an_absent_ledger_is_empty_without_python(spark, tmp_path):
    ledger = secrets.read_ledger(spark, f"{tmp_path}/none")
    assert ledger.count() == 0 and ledger.dtypes == [("blob", "binary"), ("rules", "array<string>"), ("spans", secrets.SPAN)]
    assert "ExistingRDD" not in plan(ledger) and "LogicalRDD" not in plan(ledger)


def test_a_scan_reads_texts_without_pandas(spark, tmp_path):
    docs = spark.createDataFrame([(1, "token=abcdef é token=ghijkl"), (2, None), (3, "plain")], "doc_id long, text string")
    rows = {r["path"]: [s["kind"] for s in r["spans"]] for r in secrets.scan(spark, docs, f"{tmp_path}/ledger").collect()}
    assert rows == {1: ["assign", "assign"], 2: [], 3: []}
    assert "pandas" not in vars(secrets) and "pd" not in vars(secrets)


def test_the_piece_table_is_no_python_rdd(spark):
    held = pieces.Pieces()
    table = held.table(spark)
    assert "ExistingRDD" not in plan(table) and "LogicalRDD" not in plan(table)
    assert sorted(map(tuple, table.collect())) == sorted(held.rows)
