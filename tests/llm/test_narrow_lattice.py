"""SentencePiece encoding stays in the tasks that read the texts."""

import os
import random

import pyarrow as pa

from staylens.llm import pieces
from staylens.session import shared_folder

from .test_queries import best_path

ODD = ["", None, " ", "\n\n x", "tab\tand  two", "é日本語 ﬁ_9", "a▁ b", "  \n  end  ", "12ab-cd ", "x" * 60, "\U0001f600 smile now"]


def test_units_are_cut_as_the_pattern_finds_them():
    random.seed(3)
    texts = ODD + ["".join(random.choices(" \nab.é1日▁", k=random.randint(0, 40))) for _ in range(400)]
    for names in ([p for p, _, _ in pieces.Pieces().rows], ["ab", "a-b", "².", "▁c"], ["a▁b"], ["x1"]):
        pattern = pieces.finer_units(names)
        found, counts = pieces.cut(pa.array(texts), pieces.kinds(names))
        assert found.to_pylist() == [u for t in texts for u in pieces.units(t, pattern)]
        assert counts.tolist() == [len(pieces.units(t, pattern)) for t in texts]


def test_nothing_is_shuffled_and_only_the_result_is_written(spark):
    rng = random.Random(4)
    texts = ODD + [" ".join(rng.choice(["lattice", "pieces", "unit", "日本", "x="]) + str(rng.randint(0, 99)) for _ in range(60)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    folder = os.path.join(shared_folder(spark), "staylens")
    os.makedirs(folder, exist_ok=True)
    before = set(os.listdir(folder))
    limits = {key: spark.conf.get(key) for key in pieces.BATCHES}
    found = pieces.encode(spark, docs)
    assert [name.split("-")[0] for name in set(os.listdir(folder)) - before] == ["encoded"]
    assert {key: spark.conf.get(key) for key in pieces.BATCHES} == limits
    table = pieces.Pieces()
    rows = {r["doc_id"]: r for r in found.collect()}
    for i, text in enumerate(texts):
        assert rows[i]["ids"] == best_path(text or "", table) and rows[i]["n_ids"] == len(rows[i]["ids"]) and rows[i]["round_trip"]


def test_a_task_may_forget_its_units(spark, monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_UNITS", 30)
    monkeypatch.setattr(pieces, "CHUNK_BYTES", 200)
    monkeypatch.setattr(pieces, "SOLVED_EDGES", 50)
    rng = random.Random(5)
    texts = [" ".join(f"word{rng.randint(0, 60)}" for _ in range(12)) + "y" * (55 if i % 7 == 0 else 0) for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    table = pieces.Pieces()
    for r in pieces.encode(spark, docs, table).collect():
        assert r["ids"] == best_path(texts[r["doc_id"]], table) and r["round_trip"]
