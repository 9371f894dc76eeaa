"""Every query against a plain version, over a fixture with nulls, repeats, long texts and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from staylens.llm import html_blocks, jaccard, pieces, secrets
from staylens.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen".split()


def make_texts():
    random.seed(3)
    syllables = {"en": "th er on an re ing ou ha".split(), "fr": "eau è ou re çon ier lle é".split()}
    rows = []

    def prose(lang, n):
        parts = syllables[lang]
        return [random.choice(parts) + random.choice(parts) + random.choice(parts) for _ in range(n)]

    for i in range(48):
        lang = "en" if i % 3 else "fr"
        words = prose(lang, random.choice([4, 9, 30, 60, 120]))
        if i % 7 == 0:
            words[2:2] = PASSAGE
        if i % 11 == 0:
            words.append("password: hunter2secret")
        text = "\n".join(" ".join(words[a : a + 12]) for a in range(0, len(words), 12))
        if i % 8 == 5:
            text = text.upper() + " ### $$$ %%% *** &&& ###" * 8
        rows.append((i, text, lang))
    base = prose("en", 200)
    for i in range(48, 54):  # near copies
        copy = list(base)
        copy[random.randrange(200)] = f"changed{i}"
        copy[random.randrange(200)] = f"other{i}"
        rows.append((i, " ".join(copy), "en"))
    rows += [
        (60, None, "en"),
        (61, "", None),
        (62, "  \n\t ", "en"),
        (63, "one", "en"),
        (64, "one", "en"),
        (65, "a b", None),
        (66, " ".join(prose("en", 30_000)), "en"),
        (67, "x" * 5000 + " é▁ " + " token=abcdef0123 AKIA" + "Z9" * 9 + " " + "0af" * 12, "fr"),
        (68, "1234 !!! 5678", "en"),
        (70, rows[7][1], "en"),
        (70, rows[7][1], "en"),  # a repeated row
        (71, rows[7][1], "en"),
        (None, rows[7][1], "en"),
    ]
    return rows


ROWS = make_texts()
PAGES = [
    (1, "u", "<html><body><nav><a>Menu</a></nav><article><h1>T&amp;t</h1><p>One<br>two\n three<p>Four<!-- c --></article><footer>F</footer></body></html>"),
    (2, "u", None),
    (3, None, ""),
    (4, "u", "<div class='ad'>Buy</div><p>" + "long text " * 30 + "</p><p>short</p><script>var x='<p>';</script><form>f</form>"),
    (4, "u", "<div class='ad'>Buy</div><p>" + "long text " * 30 + "</p><p>short</p><script>var x='<p>';</script><form>f</form>"),
    (5, "u", "<article><p>a</p><div class='comments'><p>reader</p></div><aside>s</aside><p>b</article>" + "<b>" * 3000),
]


def write(folder, rows, pages, items):
    n = len(rows)
    ids, texts, langs = ([r[k] for r in rows] for k in range(3))
    extra = {c: pa.array([7] * n, pa.int64()) for c in ("block", "n", "path", "word", "print", "text_key", "component_id", "score", "a", "node")}
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "lang": pa.array(langs, pa.string()), "source": pa.array(["s"] * n, pa.string()), "n_chars": pa.array([len(t or "") for t in texts], pa.int64()), **extra}), f"{folder}/documents.parquet")
    known = [(i, int(t == t.lower())) for i, t, _ in rows if i is not None and t and i < 48]
    pq.write_table(pa.table({"doc_id": pa.array([k[0] for k in known] + [None] * (n > 0), pa.int64()), "quality": pa.array([k[1] for k in known] + [1] * (n > 0), pa.int32()), "toxic": pa.array([0] * (len(known) + (n > 0)), pa.int32())}), f"{folder}/labels.parquet")
    pq.write_table(pa.table({"item_id": pa.array([i for i, _ in items], pa.int64()), "text": pa.array([t for _, t in items], pa.string())}), f"{folder}/benchmark.parquet")
    pq.write_table(pa.table({"page_id": pa.array([p[0] for p in pages], pa.int64()), "url": pa.array([p[1] for p in pages], pa.string()), "html": pa.array([p[2] for p in pages], pa.string())}), f"{folder}/pages.parquet")
    return str(folder)


ITEMS = [(1, " ".join(PASSAGE)), (2, "a b"), (10, None), (11, "!!"), (12, "Seven, EIGHT nine ten eleven twelve thirteen fourteen fifteen zzz"), (13, " ".join(PASSAGE[3:14]))]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return write(tmp_path_factory.mktemp("edge"), ROWS, PAGES, ITEMS)


@pytest.fixture(scope="module")
def nothing(tmp_path_factory):
    return write(tmp_path_factory.mktemp("none"), [], [], [])


def rows_of(spark, name, sf_dir):
    return [r.asDict() for r in QUERIES[name](spark, sf_dir).collect()]


def keyed(rows, key="doc_id"):
    return {(-1 if r[key] is None else r[key]): r for r in rows}


def same_rows(rows):
    return Counter(-1 if r["doc_id"] is None else r["doc_id"] for r in rows) == Counter(-1 if i is None else i for i, _, _ in ROWS)


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables(spark, nothing, name):
    assert rows_of(spark, name, nothing) == []


def remainder(key, n):
    return zlib.crc32(("" if key is None else str(key)).encode()) % n


def test_op1(spark, folder):
    rows = rows_of(spark, "op1_lm_scoring", folder)
    assert same_rows(rows)
    texts = [(i, WORD.findall((t or "").translate(LOWER)) + [None]) for i, t, _ in ROWS]
    counts = Counter(w for i, ws in texts if remainder(i, 5) != 1 for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    found = keyed(rows)
    for i, words in texts:
        r = found[-1 if i is None else i]
        want = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in words)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(words), sum(counts[w] > 0 for w in words), total, remainder(i, 5) == 1)
        assert r["base_score"] == pytest.approx(want, rel=1e-9) and r["score"] < 0
    held = [r for r in rows if r["held_out"] and r["n_tokens"] > 5]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_op1_distribution_sums_to_one(spark, folder):
    from staylens.llm import brown, words

    docs = brown.blocked(words.documents(spark, folder))
    counted = brown.count_words(spark, docs)
    model = brown.learn(spark, docs, counted)
    vocabulary = counted.where("first AND c > 0").select("word", "ending", "c").toPandas()
    classes = model.classes[model.items.of(vocabulary["word"].to_numpy("int64").view("uint64"), vocabulary["ending"].to_numpy())]
    for before in (0, brown.CLASSES - 1):
        step = 10 ** model.step[before]
        words_ = sum(step[c] * (n + 0.5) / 10 ** model.emit[c] for c, n in zip(classes, vocabulary["c"]))
        unseen = sum(step[c] * 0.5 / 10 ** model.emit[c] for c in range(brown.CLASSES - 1))
        assert words_ + unseen + step[brown.CLASSES - 1] == pytest.approx(1, abs=1e-6)


def test_op1_many_words_at_once_as_one_by_one():
    import numpy as np
    from staylens.llm import brown

    rng = np.random.default_rng(4)
    size, wide = 60, 2 * brown.CLASSES + 1
    table = rng.poisson(0.05, (size, wide)).astype(float)
    now = rng.integers(0, brown.CLASSES - 1, size)
    m = rng.integers(20, 90, (brown.CLASSES, brown.CLASSES)).astype(float)
    row, cell = np.nonzero(table)
    found = brown.best_classes(m, row, cell, table[row, cell], now)
    for i, c in enumerate(now):
        follow, before, own = table[i, : brown.CLASSES], table[i, brown.CLASSES : -1], table[i, -1]
        alone = m.copy()
        alone[c] -= follow
        alone[:, c] -= before
        alone[c, c] -= own
        assert found[i] == brown.best_class(alone, follow, before, own)


def test_op1_rare_words_of_one_ending_get_their_own_classes(spark):
    import numpy as np
    from staylens.llm import brown

    def hashed(words):
        return brown.words_of(pa.array([" ".join(words)]))[0]

    items = brown.Items(hashed(["the", "is", "to", "it"]))
    classes = np.full(brown.END + 1, 4)  # all endings in class 4
    classes[:4], classes[brown.END] = range(4), brown.CLASSES - 1
    nouns, verbs = [f"n{i}zzzz" for i in range(40)], [f"v{i}zzzz" for i in range(40)]
    texts = [f"the {w} is" for w in nouns] * 10 + [f"to {w} it" for w in verbs] * 10
    docs = brown.blocked(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    counts = np.ones((brown.CLASSES, brown.CLASSES))
    counts[0, 5] = counts[5, 1] = counts[2, 6] = counts[6, 3] = 3000
    counts[[0, 4, 2, 4], [4, 1, 4, 3]] = 400
    own = {r["word"]: r["class"] for r in brown.word_classes(brown.contexts(docs, items, classes, 8), classes, counts).collect()}
    assert {own[w] for w in hashed(nouns).view("int64").tolist()} == {5}
    assert {own[w] for w in hashed(verbs).view("int64").tolist()} == {6}


def test_op2(spark, folder):
    rows = rows_of(spark, "op2_substring_dedup", folder)
    assert same_rows(rows)
    least: dict = {}
    big = 1 << 62
    texts = [(big if i is None else i, WORD.findall(t or "")) for i, t, _ in ROWS]
    for i, ws in texts:
        for k in range(len(ws) - 12):
            w = tuple(ws[k : k + 13])
            least[w] = min(i, least.get(w, big))
    found = keyed(rows)
    for i, ws in texts:
        gone = {p for k in range(len(ws) - 12) if least[tuple(ws[k : k + 13])] < i for p in range(k, k + 13)}
        kept = " ".join(w for p, w in enumerate(ws) if p not in gone)
        r = found[-1 if i == big else i]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest())


def test_op2_hot_minimisers_change_nothing(spark, folder):
    import numpy as np

    from staylens.llm import superkmers, words

    docs = superkmers.blocked(words.documents(spark, folder))
    kind = "doc_id bigint, n_words bigint, n_removed bigint, kept string"
    results = []
    for hot in (np.zeros(0, np.uint64), None):
        if hot is None:
            t = superkmers.Text(np.frombuffer(" ".join(PASSAGE).encode(), np.uint8), np.array([0, len(" ".join(PASSAGE))]))
            hot = np.unique(superkmers.super_kmers(t.hash, t.text, np.zeros(0, np.uint64))[2])
        results.append(sorted(map(str, superkmers.cut(docs, superkmers.answer(superkmers.pack(docs, 8, hot)), hot, kind).collect())))
    assert results[0] == results[1]


def base_spans(text):
    found = []
    for rank, (kind, pattern, group, least, flags) in enumerate(
        [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, re.I | re.A), ("access", "AKIA[A-Z0-9]+", 0, 20, 0), ("hex", "[0-9a-f]+", 0, 24, 0)]
    ):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text, flags) if len(m.group(group)) >= least]
    return sorted(found)


def test_op3(spark, folder):
    rows = rows_of(spark, "op3_secret_scan", folder)
    assert same_rows(rows)
    found = keyed(rows)
    for i, t, _ in ROWS:
        spans = base_spans(t or "")
        r = found[-1 if i is None else i]
        text = ",".join(f"{k}:{a}:{e}" for a, _, e, k in spans)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")]


def test_ledger_reads_each_blob_and_rule_version_once(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    first = spark.createDataFrame([(1, "token=abcdef"), (2, "token=abcdef"), (3, "plain")], "doc_id long, text string")
    more = first.union(spark.createDataFrame([(4, "AKIA" + "A" * 16), (5, "plain")], "doc_id long, text string"))
    assert {r["path"]: len(r["spans"]) for r in secrets.scan(spark, first, path).collect()} == {1: 1, 2: 1, 3: 0}
    assert secrets.read_ledger(spark, path).count() == 2
    assert {r["path"]: len(r["spans"]) for r in secrets.scan(spark, more, path).collect()} == {1: 1, 2: 1, 3: 0, 4: 1, 5: 0}
    assert secrets.read_ledger(spark, path).count() == 3
    newer = tuple(r[:4] + (2,) if r[0] == "hex" else r for r in secrets.RULES)
    assert sum(len(r["spans"]) for r in secrets.scan(spark, more, path, rules=newer).collect()) == 3
    ledger = secrets.read_ledger(spark, path)
    assert ledger.count() == 6 and ledger.where("array_contains(rules, 'hex@2') AND size(rules) = 1").count() == 3


def test_masked_cuts_every_span(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = secrets.masked(spark, docs, f"{tmp_path}/ledger")
    assert out.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    for i, t, _ in ROWS:
        if t and base_spans(t):
            assert "[SECRET]" in got[i] and "hunter2secret" not in got[i] and "abcdef0123" not in got[i]
        elif i is not None:
            assert got[i] == t


def test_op4(spark, folder):
    rows = rows_of(spark, "op4_decontamination", folder)
    assert same_rows(rows)
    windows: dict = {}
    for item, text in ITEMS:
        ws = ITEM_WORD.findall((text or "").translate(LOWER))
        size = min(10, len(ws))
        for k in range(len(ws) - size + 1 if ws else 0):
            windows.setdefault(tuple(ws[k : k + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    found = keyed(rows)
    assert any(r["contaminated"] for r in rows)
    for i, t, _ in ROWS:
        ws = ITEM_WORD.findall((t or "").translate(LOWER))
        hit, items = set(), set()
        for size in sizes:
            for k in range(len(ws) - size + 1):
                if (w := tuple(ws[k : k + size])) in windows:
                    hit |= set(range(k, k + size))
                    items |= windows[w]
        r = found[-1 if i is None else i]
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (len(ws), len(hit), len(items), digest, bool(hit))


def test_op5(spark, folder):
    rows = rows_of(spark, "op5_language_id", folder)
    assert same_rows(rows)
    found = keyed(rows)
    right = [found[i]["lang_pred"] == lang for i, t, lang in ROWS if i is not None and i < 48 and remainder(i, 3) == 1]
    assert sum(right) >= 0.9 * len(right)
    for i in (60, 61, 62, 68):
        assert found[i]["lang_pred"] == "und" and found[i]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_op6(spark, folder):
    rows = rows_of(spark, "op6_jaccard_join", folder)
    assert same_rows(rows)
    sets, parent = {}, {}
    for i, t, _ in ROWS:
        if i is not None:
            ws = WORD.findall((t or "").translate(LOWER))
            sets[i] = {tuple(ws[k : k + 4]) for k in range(len(ws) - 3)} if len(ws) >= 4 else ({tuple(ws)} if ws else set())
            parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    found = keyed(rows)
    assert any(find(i) != i for i in sets)
    for i, s in sets.items():
        assert (found[i]["n_shingles"], found[i]["component_id"]) == (len(s), find(i))
    assert found[-1]["component_id"] is None


def test_repeated_and_null_keys_lose_no_link(spark):
    rng = random.Random(8)
    small, large, other = ([f"{a}{rng.randrange(10**6)}" for _ in range(n)] for a, n in (("s", 100), ("l", 300), ("o", 80)))

    def near(words):
        return " ".join(["changed", *words[1:]])

    rows = [(1, " ".join(small)), (1, " ".join(large)), (2, near(small)), (3, near(large)), (4, " ".join(other)), (4, " ".join(other)), (None, near(other)), (None, "a b c d"), (None, "a b c d"), (5, None), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r["doc_id"], r["n"]): r["component_id"] for r in jaccard.by_key(spark, docs).collect()}
    assert found == {(1, 97): 1, (1, 297): 1, (2, 97): 1, (3, 297): 1, (4, 77): 4, (None, 77): None, (None, 1): None, (5, 0): 5}
    kept = [tuple(r) for r in jaccard.one_of_each(spark, docs).collect()]
    assert Counter(kept) == Counter([(1, " ".join(small)), (1, " ".join(large)), (4, " ".join(other)), (None, "a b c d"), (5, None), (5, None)])


def test_small_sets_share_every_subset_they_must():
    for s in range(1, jaccard.LIGHT + 1):
        for t in range(s, jaccard.LIGHT + 1):
            for both in range(s + 1):
                if 100 * both >= 85 * (s + t - both):
                    need = -(-85 * (s + t) // 185)
                    assert need <= both and need in jaccard.shared_sizes(s, jaccard.LIGHT) and need in jaccard.shared_sizes(t, jaccard.LIGHT)


def test_op7(spark, folder):
    rows = rows_of(spark, "op7_sentencepiece", folder)
    assert same_rows(rows) and all(r["round_trip"] for r in rows)
    table = pieces.Pieces()
    score = {p: (s, i) for p, i, s in table.rows}

    def plain(unit):
        text = unit.replace(pieces.SPACE, pieces.OWN).replace(" ", pieces.SPACE)
        best = [(0.0, [])]
        for e in range(1, len(text) + 1):
            choices = []
            for s in range(max(0, e - table.longest), e):
                if text[s:e] in score:
                    value, i = score[text[s:e]]
                    choices.append((best[s][0] + value, s, [i]))
                elif s == e - 1:
                    choices.append((best[s][0] + table.worst, s, [table.byte + b for b in unit[s:e].encode()]))
            value, s, ids = max(choices)
            best.append((value, best[s][1] + ids))
        return best[-1][1]

    found = keyed(rows)
    for i, t, _ in ROWS:
        if len(t or "") < 6000:
            assert found[-1 if i is None else i]["ids"] == [x for u in pieces.units(t) for x in plain(u)]
    frame = QUERIES["op7_sentencepiece"](spark, folder)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(frame).collect()}
    assert all(back[i] == (t or "") for i, t, _ in ROWS)


def test_units_listed_by_several_tasks(spark):
    texts = {i: "shared words, shared words " + "more " * i for i in range(6)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(6, "doc_id")
    found = pieces.encode(spark, docs)
    assert all(r["round_trip"] for r in found.collect())
    assert {r["doc_id"]: r["text"] for r in pieces.decode(found).collect()} == texts


def test_no_piece_crosses_a_cut():
    cut = pieces.finer_units(["ab", "a-b", "².", "▁c"])
    assert cut.findall(" xy, a-by ².") == [" xy", ",", " a-b", "y", " ²."]
    table = pieces.Pieces()
    for name, _, _ in table.rows:
        unit = " " + name.removeprefix(pieces.SPACE)
        assert table.units.findall(unit) in ([unit], [" ", unit[1:]])


def best_path(text, table):
    """Ids and score of the best path over a whole uncut text, the shorter last piece on equal scores."""
    score = {p: (s, i) for p, i, s in table.rows}
    text = " " + text
    lattice = text.replace(pieces.SPACE, pieces.OWN).replace(" ", pieces.SPACE)
    best = [(0.0, 0, [])]
    for e in range(1, len(lattice) + 1):
        choices = []
        for s in range(max(0, e - table.longest), e):
            if lattice[s:e] in score:
                value, i = score[lattice[s:e]]
                choices.append((best[s][0] + value, s, [i]))
            elif s == e - 1:
                choices.append((best[s][0] + table.worst, s, [table.byte + b for b in text[s:e].encode()]))
        best.append(max(choices))
    ids, e = [], len(lattice)
    while e:
        _, s, last = best[e]
        ids, e = last + ids, s
    return ids


def against_whole_texts(spark, texts):
    table = pieces.Pieces()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in pieces.encode(spark, docs, table).collect()}
    for i, text in enumerate(texts):
        assert found[i]["ids"] == best_path(text, table), text
        assert found[i]["round_trip"]


def test_runs_of_spaces_take_the_best_path_of_the_whole_text(spark):
    code = "def f(x):\n    if x:\n        return  x\n\n  \n\tend   "
    against_whole_texts(spark, ["x:    return", code, "   ", "a  \u2581  b", " " * 40 + "|  cell   |", "\u2581\u2581  \u2581x"])
    assert pieces.finer_units(["a\u2581b"]).findall(" a b\nc") == [" a b\nc"]


def test_long_runs_take_the_best_path_of_the_whole_text(spark):
    rng = random.Random(5)
    base64 = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=900))
    script = "".join(rng.choices("\u4e2d\u56fd\u4eba\u6c11\u5927\u5b66\U0001f600\u2581", k=300))
    letters = "internationalization" * 12
    against_whole_texts(spark, [base64, script, letters, "https://example.org/" + letters + "?q=" + base64, " " * 200, "x" + " " * 120 + letters])


def test_op8(spark, folder):
    rows = rows_of(spark, "op8_html_extraction", folder)
    assert len(rows) == len(PAGES)
    text = {r["page_id"]: r["text"] for r in rows}
    assert text[1] == "T&t\n\nOne two three\n\nFour"
    assert text[2] == "" and text[3] == ""
    assert text[4] == ("long text " * 30).strip() + "\n\nshort"
    assert text[5] == "a\n\nb"
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_html_blocks_keep_long_runs():
    page = "<p>x</p><div></div>" + "<p>" + "word " * 40 + "</p>" * 1 + "<p>tail</p>"
    assert html_blocks.main_text(page).endswith("tail")


def test_noise_words_do_not_drop_the_article():
    body = "<p>" + "word " * 40 + "</p><p>end</p>"
    want = ("word " * 40).strip() + "\n\nend"
    for page in (
        f"<div class='layout has-sidebar'><article>{body}</article></div>",
        f"<article class='post no-comments'>{body}</article>",
        f"<div id='content-header-wrap'><article>{body}</article><div class='sidebar'>side</div></div>",
        f"<div class='banner'><main>{body}<div class='comments'>reader</div></main></div><p>left over</p>",
        f"<div class='page widget'>{body}</div><div class='footer'>f</div>",
        f"<div id='nav-open'>{body}<ul class='menu'><li>m</li></ul></div>",
    ):
        assert html_blocks.main_text(page) == want, page
    two = html_blocks.main_text(f"<article class='no-comments'>{body}</article><article class='no-comments'>{body}</article>")
    assert two == want + "\n\n" + want


def test_noise_words_still_drop_noise():
    body = "<p>" + "word " * 40 + "</p>"
    want = ("word " * 40).strip()
    reader = "<article class='comment-body'><p>" + "reader " * 60 + "</p></article>"
    for page in (
        f"<div class='content'>{body}</div><div id='comments'>{reader * 3}</div>",
        f"<div>{body}</div><div class='related-posts'><article>teaser one</article><article>teaser two</article></div>",
        f"<article>{body}</article><div class='site-footer'>foot</div><div class='cookie'>{'cookies ' * 90}</div>",
    ):
        assert html_blocks.main_text(page) == want, page
    assert html_blocks.main_text("<div class='footer'>foot</div>") == ""


def test_windows_pass_over_noise_lines():
    menu = "<ul class='menu'>" + "<li>item</li>" * 5 + "</ul>"
    page = "<p>" + "word " * 40 + "</p>" + menu + "<p>the short end</p>"
    assert html_blocks.main_text(page) == ("word " * 40).strip() + "\n\nthe short end"


def test_op9(spark, folder):
    rows = rows_of(spark, "op9_quality_rules", folder)
    assert same_rows(rows)
    found = keyed(rows)
    for i, t, _ in ROWS:
        t = t or ""
        ws = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        spots: dict = {}
        for k in range(len(ws) - 4):
            spots.setdefault(tuple(ws[k : k + 5]), []).append(k)
        again = {p for ks in spots.values() if len(ks) > 1 for k in ks for p in range(k, k + 5)}
        failed = len(ws) < 10 or 100 * len(again) > 20 * len(ws)
        r = found[-1 if i is None else i]
        want = (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), failed)
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == want
        assert not (failed and r["kept"])


def test_viterbi_is_the_best_labelling():
    import itertools

    import numpy as np

    from staylens.llm import line_crf

    random_ = np.random.default_rng(1)
    text = np.array([0, 0, 0, 0, 2, 2, 2, 3])
    gain, step = random_.normal(size=8), random_.normal(size=(2, 2))
    got = line_crf.viterbi(gain, step, text, 4)
    for t in (0, 2, 3):
        at = np.flatnonzero(text == t)
        best = max(itertools.product((0, 1), repeat=len(at)), key=lambda ys: sum(g * y for g, y in zip(gain[at], ys)) + sum(step[a, b] for a, b in zip(ys, ys[1:])))
        assert tuple(got[at]) == best


def test_op10(spark, folder):
    rows = rows_of(spark, "op10_quality_classifier", folder)
    assert same_rows(rows) and all(0 <= r["score"] <= 1 for r in rows)
    found = keyed(rows)
    right = [found[i]["predicted"] == int(t == t.lower()) for i, t, _ in ROWS if i is not None and i < 48]
    assert sum(right) >= 0.9 * len(right)
    assert all(r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] == (remainder(r["doc_id"], 5) == 0) for r in rows)


def test_pipeline_stages(spark, folder, nothing):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.count() <= docs.count(), name
    assert corpus_pipeline.run(spark, nothing).count() == 0
