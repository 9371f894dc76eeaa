"""Toxicity, importance resampling and spelling variants against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from staylens.llm import crc, importance, toxicity, variants
from staylens.llm import words as W
from staylens.llm.queries import QUERIES

from .test_queries import ITEM_WORD, ITEMS, LOWER, PAGES, ROWS, WORD, folder, keyed, nothing, remainder, rows_of, same_rows, write  # noqa: F401


def test_crc_of_spans_and_joins():
    random.seed(4)
    parts = [bytes(random.randrange(256) for _ in range(random.choice([0, 1, 3, 8, 63, 64, 65, 700]))) for _ in range(400)]
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - np.array([len(p) for p in parts])
    data = np.frombuffer(b"".join(parts), np.uint8)
    got = crc.of_spans(data, starts, ends)
    assert got.tolist() == [zlib.crc32(p) for p in parts]
    assert crc.then(got[:-1], got[1:], (ends - starts)[1:]).tolist() == [zlib.crc32(a + b) for a, b in zip(parts, parts[1:])]


# ---- importance resampling


def plain_importance(rows, items):
    def features(text):
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = Counter(), Counter()
    for _, text, _ in rows:
        s.update(map(bucket, features(text)[1]))
    for _, text in items:
        t.update(map(bucket, features(text)[1]))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for i, text, _ in rows:
        n_words, fs = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in map(bucket, fs))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words, None])
    may = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for rank, r in enumerate(may[: 5 * len(may) // 100], 1):
        r[5] = rank
    return Counter((*r[:4], r[5]) for r in out)


def found_importance(spark, sf_dir):
    return Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in rows_of(spark, "op12_importance_resampling", sf_dir))


def test_op12(spark, folder):  # noqa: F811
    want = plain_importance(ROWS, ITEMS)
    assert found_importance(spark, folder) == want
    assert any(r[4] for r in want)


def test_op12_same_with_any_head(spark, folder, monkeypatch):  # noqa: F811
    docs = W.documents(spark, folder)
    texts = pa.array([t for _, t, _ in ROWS])
    full = importance.Head(importance.frequent_words(spark, docs))
    want = [a.tolist() for a in importance.buckets(full, texts)]
    monkeypatch.setattr(importance, "PAIRS", 3)
    for head in ([], importance.frequent_words(spark, docs, 1), importance.frequent_words(spark, docs, 40)):
        assert [a.tolist() for a in importance.buckets(importance.Head(head), texts)] == want


def test_op12_ties_and_hot_keys(spark, tmp_path):
    """A third of all rows has one key and text; all others tie in pairs."""
    text = " ".join(f"w{k % 7}" for k in range(30))
    rows = [(7, text, None)] * 120 + [(None, text, None)] * 30 + [(1000 + i // 2, text, None) for i in range(240)] + [(5000, "one two", None)]
    folder = write(tmp_path, rows, [], ITEMS[:1])  # noqa: F811
    assert found_importance(spark, folder) == plain_importance(rows, ITEMS[:1])


# ---- spelling variants


def plain_variants(rows):
    count = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    out, forms = {}, {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 5 * n else None
        out[w] = [forms[w], None, n, len(others), words[forms[w]] if forms[w] else None]
    for w, row in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        row[1] = root
    return {w: tuple(r) for w, r in out.items()}


def spelling_rows():
    random.seed(8)
    rows, i = [], 0
    bases = ["receive", "separate", "Élève" + "ment", "naïveté", "ßtraße", "aaaaaa", "abcdef"]
    for base in bases:
        for n, word in ((150, base), (30, base[:-1] + "x"), (6, base[:-2] + "xx"), (8, base[1:]), (7, base[:3] + "é" + base[3:]), (7, base[:3] + "q" + base[3:]), (4, "z" + base)):
            for _ in range(n):
                rows.append((i, f"{word} 12 {word.upper() if n == 30 else ''}", "en"))
                i += 1
    for k in range(40):  # names of one reduced form, near one another in a chain
        rows += [(i + k, " ".join(["qwertz" + "abcdefgh"[k % 8] * (1 + k // 8)] * 6), None)]
    return rows + [(None, "receive " * 700, None), (None, None, None), (900000, "", None), (900001, "x" * 4000 + "y", None)] + [(900002, "x" * 4000, None)] * 5


def test_op13(spark, tmp_path):
    rows = spelling_rows()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows_of(spark, "op13_spelling_variants", write(tmp_path, rows, [], []))}
    want = plain_variants(rows)
    assert got == want
    assert any(f and r != f for f, r, *_ in want.values()), "no form has a form"


def test_op13_fixture(spark, folder):  # noqa: F811
    rows = rows_of(spark, "op13_spelling_variants", folder)
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows} == plain_variants(ROWS)


def test_variants_do_not_depend_on_the_number_of_symbols(spark, tmp_path):
    docs = W.documents(spark, write(tmp_path, spelling_rows(), [], []))
    sets = [{tuple(r) for r in variants.variants(spark, docs, n).collect()} for n in (2, 11)]
    assert sets[0] == sets[1] and sets[0]


# ---- toxicity


def toxic_rows(n=420):
    random.seed(5)
    plain = "the of and house tree river walk green early paper window small garden song idea stone".split()
    rows, labels = [], {}
    for i in range(n):
        words = [random.choice(plain) for _ in range(random.choice([8, 30, 90, 400]))]
        bad = i % 5 == 0
        if bad:
            for _ in range(2):
                words.insert(random.randrange(len(words)), random.choice(["idiot", "m0r0n", "STUPID!!", "you pathetic", "l.o.s.e.r", "s c u m"]))
        rows.append((i, " ".join(words), "en"))
        labels[i] = int(bad)
    return rows, labels


def with_labels(path, rows, labels):
    import pyarrow.parquet as pq

    out = write(path, rows, [], [])
    keys = [k for k, _ in labels]
    table = {"doc_id": pa.array(keys, pa.int64()), "quality": pa.array([1] * len(keys), pa.int32()), "toxic": pa.array([v for _, v in labels], pa.int32())}
    pq.write_table(pa.table(table | {"score": pa.array(["x"] * len(keys)), "features": pa.array([3] * len(keys)), "text": pa.array(["t"] * len(keys))}), f"{out}/labels.parquet")
    return out


def test_op11_finds_held_out_rows(spark, tmp_path):
    rows, labels = toxic_rows()
    known = [(k, v) for k, v in labels.items()] + [(3, None), (None, 1), (5, 1), (5, 0), (10**9, 1)]
    got = rows_of(spark, "op11_toxicity", with_labels(tmp_path, rows, known))
    assert len(got) == len(rows)
    for r in got:
        assert r["held_out"] == (remainder(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    held = [r for r in got if r["held_out"]]
    assert len(held) > 60 and sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.98 * len(held)


def test_op11_held_labels_are_not_read(spark, tmp_path):
    rows, labels = toxic_rows(200)
    one = [(k, v) for k, v in labels.items()]
    two = [(k, 1 - v if remainder(k, 4) == 2 else v) for k, v in labels.items()]
    results = []
    for name, known in (("a", one), ("b", two)):
        (tmp_path / name).mkdir()
        results.append({r["doc_id"]: r["score"] for r in rows_of(spark, "op11_toxicity", with_labels(tmp_path / name, rows, known))})
    assert results[0] == results[1]


def test_op11_without_both_labels(spark, folder):  # noqa: F811
    rows = rows_of(spark, "op11_toxicity", folder)
    assert same_rows(rows) and {r["score"] for r in rows} == {0.0}


def plain_features(text):
    """The numbers of one text, word by word."""

    def undone(word, single):
        table = toxicity.LOOKALIKES if single else {}
        out = []
        for b in word.encode():
            c = table.get(chr(b), chr(b).lower() if b < 128 and chr(b).isalpha() else "")
            c = bytes([b]) if b >= 128 else c.encode()
            if c and not (single and out and out[-1] == c):
                out.append(c)
        return b"".join(out)

    lists = {n: {s + e for s in stems for e in toxicity.ENDINGS} for n, stems in (("insults", toxicity.INSULTS), ("profanity", toxicity.PROFANITY), ("threats", toxicity.THREATS))}
    words = WORD.findall(text)
    cores = []
    for w in words:
        found = re.search(r"[A-Za-z0-9@$\u0080-\U0010ffff]", w), re.search(r"[A-Za-z0-9\u0080-\U0010ffff](?=[^A-Za-z0-9\u0080-\U0010ffff]*$)", w)
        cores.append(w[found[0].start() : found[1].end()] if all(found) and found[1].end() > found[0].start() else "")
    letters = lambda w: re.findall(r"[A-Za-z\u0080-\U0010ffff]", w)
    hit, disguised, per = [False] * len(words), [False] * len(words), Counter()
    for k, c in enumerate(cores):
        for name, stems in lists.items():
            seen = c and len(letters(c)) == len(c) and undone(c, False).decode() in stems
            odd = 0 < len(letters(c)) < len(c) or re.search(r"([A-Za-z])\1\1", c)
            hidden = not seen and odd and undone(c, True) in {undone(s, True) for s in stems}
            if seen or hidden:
                per[name] += 1
                hit[k] = True
            disguised[k] |= bool(hidden)
    you = [undone(c, False).decode() in toxicity.SECOND_PERSON for c in cores]
    near = [h and any(you[max(0, k - 5) : k + 6]) for k, h in enumerate(hit)]
    peak = max((sum(hit[max(0, k - 49) : k + 1]) for k in range(len(hit))), default=0)
    rate = lambda n: min(100 * n / max(len(words), 1), 100)
    return {
        "insults": rate(per["insults"]), "profanity": rate(per["profanity"]), "threats": rate(per["threats"]), "hits": math.log1p(sum(hit)), "peak": peak,
        "addressed": rate(sum(near)), "second_person": rate(sum(you)), "disguised": rate(sum(disguised)),
        "mixed": rate(sum(bool(letters(c) and re.search("[0-9]", c)) for c in cores)),
        "exclaims": text.count("!") / max(len(words), 1), "asks": text.count("?") / max(len(words), 1), "words": math.log1p(len(words)),
        "shouted": rate(sum(len(c) > 2 and all("A" <= x <= "Z" for x in c) for c in cores)),
    }


def test_op11_features():
    random.seed(6)
    pool = "You idiot! st0pid; L.O.S.E.R tree $cum (kill) hate?? your stuuupid moron's f**k **** @ $ été 12 a1 SCUM ÉTÉ! töte dich shit!!".split()
    texts = [" ".join(random.choice(pool) for _ in range(n)) for n in (1, 2, 5, 20, 60, 200)] + ["", " \n", "...", "you " + "tree " * 60 + "idiot idiot"]
    rows = toxicity.text_features(*W.raw(pa.array(texts)))
    for text, row in zip(texts, rows):
        got = dict(zip(toxicity.NAMES, row))
        for name, want in plain_features(text).items():
            assert got[name] == pytest.approx(want), (name, text)


def test_op11_spelled_words():
    rows = toxicity.text_features(*W.raw(pa.array(["so i d i o t go", "so a b c d go", "i d i", "o t"])))
    got = [dict(zip(toxicity.NAMES, r)) for r in rows]
    assert got[0]["insults"] > 0 and got[0]["disguised"] > 0
    assert got[1]["insults"] == 0 and got[1]["spelled"] > 0
    assert got[2]["spelled"] == got[3]["spelled"] == 0
