"""op1 over many small chunks: texts are cut once, packed lists travel, counts of other chunks come back."""

import math
import random
from collections import Counter

import pytest

from staylens.llm import brown

from .test_queries import LOWER, WORD, remainder


def test_chunks_share_their_counts_and_no_text_travels(spark, monkeypatch):
    monkeypatch.setattr(brown, "COUNT_BYTES", 600)
    monkeypatch.setattr(brown, "KINDS_A_BUCKET", 40)
    rng = random.Random(6)
    words = [f"w{i}" for i in range(90)] + ["The", "THE", "é", "#"]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) + f" only{i}") for i in range(120)]
    texts += [(None, "the w1 w2"), (7, "the \n"), (7, None), (200, ""), (201, " \t ")]
    docs = brown.blocked(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5).sortWithinPartitions("doc_id"))
    assert "text" not in docs.columns
    docs = brown.stored(spark, docs, "test-chunks")
    assert docs.count() > 8 and docs.count() == docs.select("chunk").distinct().count()
    counted = brown.count_words(spark, docs)
    model = brown.learn(spark, docs, counted)
    out = brown.score(docs, model)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()

    lines = [(i, WORD.findall((t or "").translate(LOWER))) for i, t in texts]
    learnt = [ws for i, ws in lines if remainder(i, 5) != 1]
    counts = Counter(w for ws in learnt for w in ws)
    assert counted.count() == len(counts) and model.kinds == len(counts) + 1
    total = sum(counts.values()) + len(learnt)
    lower = math.log10(total + 0.5 * (len(counts) + 2))
    want = sorted((-1 if i is None else i, remainder(i, 5) == 1, len(ws) + 1, sum(counts[w] > 0 for w in ws) + 1, round(sum(math.log10(counts[w] + 0.5) - lower for w in ws) + math.log10(len(learnt) + 0.5) - lower, 8)) for i, ws in lines)
    rows = out.collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 8)) for r in rows)
    assert [g[:4] for g in got] == [w[:4] for w in want] and {r["train_tokens"] for r in rows} == {total}
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want], abs=1e-6)
