"""Toxic words that no fixed list holds are learnt from the labels."""

import random

import numpy as np
import pyarrow as pa

from staylens.llm import toxicity
from staylens.llm import words as W

from .test_queries import remainder, rows_of
from .test_resampling_toxicity_variants import with_labels


def coined_rows(n=600):
    """Every fourth text holds words of two coined stems with endings of their own; no ending occurs in two texts."""
    random.seed(11)
    letters = "abcdefghijklmnopqrst"
    rows, labels = [], []
    for i in range(n):
        words = ["".join(random.choices(letters, k=random.randint(2, 8))) for _ in range(60)]
        ending = "".join(letters[i // 20**k % 20] for k in range(3))
        if i % 4 == 0:
            for stem in ("zuvex", "wyxo"):
                words.insert(random.randrange(len(words)), stem + ending)
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


def test_coined_stems_are_found_in_held_out_texts(spark, tmp_path):
    rows, labels = coined_rows()
    learning = [(i, v) for i, v in labels if remainder(i, toxicity.FOLDS) != toxicity.HELD]
    got = {r["doc_id"]: r["predicted"] for r in rows_of(spark, "op11_toxicity", with_labels(tmp_path, rows, learning))}
    held = [(i, v) for i, v in labels if remainder(i, toxicity.FOLDS) == toxicity.HELD]
    assert sum(v for _, v in held) > 20
    assert [got[i] for i, _ in held] == [v for _, v in held]


def test_entry_counts_agree_with_plain_sets():
    texts = ["Zuvexab idiot größe", "zuvexcd Zuvexab", "", "größer x1y2 abcd", "x"]
    toxic = np.array([True, True, False, False, False])
    value, ill, well, _ = toxicity._entry_counts(*W.raw(pa.array(texts)), toxic)
    got = {v: (int(a), int(b)) for v, a, b in zip(value.view(np.uint64), ill, well)}

    def key(word, seed):
        data = word.encode()
        return W.hashes(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]), seed)[0]

    assert got[key("zuve", 1)] == got[key("zuvexa", 1)] == got[key("zuvexab", 0)] == (2, 0) and got[key("zuvexc", 1)] == (1, 0) and got[key("größ", 1)] == (1, 1)
    assert got[key("größe", 0)] == (1, 0) and got[key("größe", 1)] == (1, 1) and got[key("abcd", 1)] == (0, 1)
    assert key("x1y2", 1) not in got


def test_copies_of_one_toxic_text_teach_nothing(spark):
    random.seed(3)
    word = lambda: "".join(random.choices("abcdefghij", k=7))
    once = " ".join(word() for _ in range(200))
    rows = [(i, f"{once} {word()}" if i < 30 else " ".join(word() for _ in range(200))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame([(i, int(i < 30)) for i, _ in rows], "doc_id bigint, toxic int")
    assert len(toxicity.learnt_lexicon(docs, known)) == 0
