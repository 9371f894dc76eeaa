r"""N-gram Jaccard join: size-aware, heavy and light sets.

A document's set holds its distinct four-word shingles (A-Z lower-cased words
``[^\x20\x09-\x0D]+``); with fewer words the whole sequence is the one shingle.
Two documents link when 100 * intersection >= 85 * union.

Light sets are small: all subsets of the sizes that two linked sets must share are
enumerated, and equal subsets meet. Heavy sets go to inverted lists: the range of
shingle hashes is cut into more parts than two linked sets can differ by, so at
least one part is equal, and the list of that part holds both (a list for each
single shingle would hold a third of all documents for a common passage). The
boundary is the largest size for which enumeration costs less than lists.

Equal sets are one class. In each list and size band every class is compared with
the smallest one; then lists that still hold several components are scanned pair
by pair, where a lower bound of the difference (counts of hash buckets) leaves few
pairs, and these are compared exactly. Nothing is sampled and no list is cut, so no
link is lost; pairs inside a component are not enumerated.

Null text has no shingles; such rows link with nothing. Rows whose key is null or
repeated get an id from key and text, so each text has its own set, signature and
comparison. op6 gives a null key no part and no component, and rows that share a key
one component; ``one_of_each`` goes by rows and keeps one of each group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import words as W
from staylens.llm.components import components, stored
from staylens.llm.superkmers import run_keys
from staylens.session import configure

SHINGLE = 4
PERCENT = 85
LIST_COST = 4  # what a list entry costs next to an enumerated subset: its list still has to be compared
BLOCK_DOCS = 2048
CHUNK = 2 << 20
BUCKET_BYTES = 6 << 20
PAIRS_A_BUCKET = 300
SIGNATURE = 512  # buckets at most; a coarser signature only leaves more pairs to compare exactly
BROADCAST_PAIRS = 500_000  # two keys each: 8 MB
LIST_PART = 2048  # a longer list is scanned in pairs of parts
HASHED = -(1 << 62)  # ids below are made from key and text
_EMPTY = np.uint64(0xA0761D6478BD642F)


def parts(scheme: int) -> tuple[int, int]:
    """Number of hash ranges for sets of less than 2 ** (scheme + 1), and how many of them may be empty unheeded."""
    differ = (100 - PERCENT) * 2 * (2 ** (scheme + 1) - 1) // (100 + PERCENT)
    spare = max(2, differ // 32)
    return differ + 1 + spare, spare


def shared_sizes(size: int, most: int) -> list[int]:
    """Sizes of the intersection that two linked sets must reach, for partners of at most ``most``."""
    partners = range(ceil(size * PERCENT / 100), min(most, size * 100 // PERCENT) + 1)
    need = {-(-PERCENT * (size + t) // (100 + PERCENT)): None for t in partners if -(-PERCENT * (size + t) // (100 + PERCENT)) <= min(size, t)}
    return sorted(need)


def schemes(size: int) -> list[int]:
    own = size.bit_length() - 1
    return [own, own + 1] if 100 * size >= PERCENT * 2 ** (own + 1) else [own]


def light_limit() -> int:
    """Largest size whose subsets are cheaper to enumerate than its list entries."""
    size = 1
    while sum(comb(size + 1, o) for o in shared_sizes(size + 1, size + 1)) <= LIST_COST * sum(min(parts(j)[0], size + 1) for j in schemes(size + 1)):
        size += 1
    return size


LIGHT = light_limit()


class Sets:
    """Shingle sets of some texts: hashes by text, sorted."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        n = len(off) - 1
        data = W.LOWER[data]
        start, end, text = W.spans(data, off)
        word = W.hashes(data, start, end)
        value, first = W.windows(word, text, SHINGLE)
        count = np.bincount(text, minlength=n)
        begin = np.cumsum(count) - count
        short = np.flatnonzero((count > 0) & (count < SHINGLE))
        whole = W.mix(run_keys(word, begin[short], begin[short] + count[short]) + np.uint64(1)) if len(short) else np.zeros(0, np.uint64)
        value, owner = np.concatenate((value, whole)), np.concatenate((text[first], short))
        order = np.lexsort((value, owner))
        value, owner = value[order], owner[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        self.value, self.text = value[new], owner[new]
        self.size = np.bincount(self.text, minlength=n)
        self.begin = np.cumsum(self.size) - self.size

    def sums(self, salt: int) -> np.ndarray:
        total = np.zeros(len(self.size), np.uint64)
        some = self.size > 0
        if some.any():
            total[some] = np.add.reduceat(W.mix(self.value + np.uint64(salt)), self.begin[some])
        return total

    def list_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the inverted lists that each heavy set belongs to, with its text."""
        keys, owners = [], []
        size = self.size[self.text]
        heavy = 100 * size > PERCENT * LIGHT
        for scheme in range(int(size.max(initial=1)).bit_length() + 1):
            low = 2**scheme
            inside = heavy & (size < 2 * low) & ((size >= low) | (100 * size >= PERCENT * low))
            if not inside.any():
                continue
            n_parts, spare = parts(scheme)
            value, text = self.value[inside], self.text[inside]
            part = ((value >> np.uint64(32)) * np.uint64(n_parts)) >> np.uint64(32)
            new = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (text[1:] != text[:-1]))))
            tag = W.mix(part[new] + np.uint64(scheme << 32) + np.uint64(1))
            keys.append(W.mix(np.add.reduceat(W.mix(value + _EMPTY), new) + tag))
            at = text[new]
            owners.append(at)
            full = np.bincount(at, minlength=len(self.size))
            for t in np.flatnonzero((full > 0) & (n_parts - full > spare)):
                missing = np.setdiff1d(np.arange(n_parts, dtype=np.uint64), part[new][at == t])
                keys.append(W.mix(W.mix(missing + np.uint64(scheme << 32) + np.uint64(1)) + _EMPTY))
                owners.append(np.full(len(missing), t))
        for t in np.flatnonzero((self.size > 0) & (self.size <= LIGHT)):
            values = W.mix(self.value[self.begin[t] : self.begin[t] + self.size[t]] + _EMPTY)
            with np.errstate(over="ignore"):
                for o in shared_sizes(len(values), LIGHT):
                    picks = np.array([np.sum(values[list(c)], dtype=np.uint64) for c in combinations(range(len(values)), o)])
                    keys.append(W.mix(picks + W.mix(np.array([o], np.uint64) + np.uint64(1 << 50))))
                    owners.append(np.full(len(picks), t))
        if not keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(keys), np.concatenate(owners)


def signature(values: np.ndarray) -> bytes:
    """Counts of a set's hashes by bucket; two sets differ by the sum of count differences at least."""
    n = min(SIGNATURE, max(16, 2 ** len(values).bit_length()))
    return np.minimum(np.bincount((values >> np.uint64(5)).astype(np.int64) % n, minlength=n), 255).astype(np.uint8).tobytes()


def fold(sign: bytes, n: int) -> np.ndarray:
    """A signature over ``n`` buckets, fewer than it has or as many."""
    counts = np.frombuffer(sign, np.uint8).astype(np.int16)
    return counts if len(counts) == n else np.minimum(counts.reshape(-1, n).sum(0), 255).astype(np.int16)


def may_link(a: bytes, b: bytes, na: int, nb: int) -> bool:
    """Whether the signatures leave room for a link."""
    n = min(len(a), len(b))
    return int(np.abs(fold(a, n) - fold(b, n)).sum()) * (100 + PERCENT) <= (100 - PERCENT) * (na + nb)


def block_of(id):
    """Neighbouring keys share a block; ids made from a hash are dealt to 4,096."""
    return F.when(id < HASHED, -1 - F.pmod(id, F.lit(4096))).otherwise(F.floor(id / BLOCK_DOCS))


def blocked(docs: DataFrame) -> DataFrame:
    return docs.select(block_of(F.col("doc_id")).alias("block"), "doc_id", "text")


def with_ids(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with ``row_id``: the key where one row alone has it, else a hash of key and text below ``HASHED``."""
    key = F.col("doc_id").cast("bigint")
    made = F.lit(HASHED - 1) - F.shiftrightunsigned(F.xxhash64(key, "text"), 2)
    again = docs.where("doc_id IS NOT NULL").groupBy(key.alias("again")).agg(F.count("*").alias("rows")).where("rows > 1").select("again")
    again = stored(spark, again, "set-again")
    n = again.count()
    if not n:
        return docs.withColumn("row_id", F.coalesce(key, made))
    both = docs.join(F.broadcast(again) if n <= BROADCAST_PAIRS else again, key == F.col("again"), "left")
    return both.withColumn("row_id", F.when(F.col("again").isNull(), F.coalesce(key, made)).otherwise(made)).drop("again")


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, n, k1, k2, sig) for every row: size, identity and signature of its set."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches, limit=CHUNK):
            s = Sets(*W.raw(batch.column("text")))
            signs = [signature(s.value[b : b + n]) for b, n in zip(s.begin.tolist(), s.size.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s.size), *(pa.array(s.sums(x).view(np.int64)) for x in (1, 2)), pa.array(signs, pa.binary())], names=["doc_id", "n", "k1", "k2", "sig"])

    return docs.select("doc_id", "text").mapInArrow(read, "doc_id bigint, n bigint, k1 bigint, k2 bigint, sig binary")


def possible(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) that signatures (doc, size, sig) do not rule out."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column("na").to_pylist(), batch.column("nb").to_pylist()
            keep = [may_link(*x) for x in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), na, nb)]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    both = pairs.join(signs.select(F.col("doc").alias("a"), F.col("size").alias("na"), F.col("sig").alias("sa")), "a")
    both = both.join(signs.select(F.col("doc").alias("b"), F.col("size").alias("nb"), F.col("sig").alias("sb")), "b")
    return both.mapInArrow(read, "a bigint, b bigint")


def lists(docs: DataFrame, buckets: int) -> DataFrame:
    """(list, doc, n): entries of every list that two or more documents share."""

    def read(batches) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in W.chunks(batches, limit=CHUNK):
            s = Sets(*W.raw(batch.column("text")))
            key, owner = s.list_keys()
            doc = batch.column("doc_id").to_numpy()[owner]
            bucket = (key >> np.uint64(32)) % np.uint64(buckets)
            low = key.astype(np.uint32)  # a rare chance meeting in a list is no link
            order = np.lexsort((doc, low, bucket))
            key, doc, bucket, n = low[order], doc[order], bucket[order], s.size[owner][order].astype(np.uint32)
            edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(bucket) else []
            rows = [(int(bucket[a]), *(squeeze(x.tobytes()) for x in (key[a:b], doc[a:b], n[a:b]))) for a, b in zip(edge[:-1], edge[1:])]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), *[pa.binary()] * 3))], names=["bucket", "keys", "docs", "sizes"])

    def meet(table: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor().decompress
        key, doc, n = (np.concatenate([np.frombuffer(expand(x.as_py()), k) for x in table.column(c)]) for c, k in (("keys", np.uint32), ("docs", np.int64), ("sizes", np.uint32)))
        bucket = table.column("bucket")[0].as_py()
        order = np.lexsort((doc, key))
        key, doc, n = key[order], doc[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        last = np.append(first[1:], len(key)) - 1
        shared = np.repeat(doc[first] != doc[last], last - first + 1)
        return pa.table({"list": (key[shared].astype(np.int64) + (bucket << 32)), "doc": doc[shared], "n": n[shared].astype(np.int64)})

    packed = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(read, "bucket bigint, keys binary, docs binary, sizes binary")
    return packed.groupBy("bucket").applyInArrow(meet, "list bigint, doc bigint, n bigint")


def compare(spark: SparkSession, docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, na, nb, both): exact intersections of the stored ``pairs`` (a, b); each a also with itself.

    Only texts in a pair travel; then sets of b go to those of a, and an a with very
    many partners is split and its set repeated.
    """
    counts = pairs.groupBy("a").agg(F.count("*").alias("n")).select("a", F.ceil(F.col("n") / PAIRS_A_BUCKET).cast("int").alias("salts"))
    n_pairs = pairs.count()
    buckets = max(32, n_pairs // PAIRS_A_BUCKET + 1)
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    docs = docs.join(F.broadcast(ids) if n_pairs <= BROADCAST_PAIRS else ids, "doc_id", "left_semi")
    salted = pairs.join(counts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
    wants = salted.select(F.col("b").alias("doc"), "a", "salt").unionByName(counts.select(F.col("a").alias("doc"), "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")))
    wants = wants.select(block_of(F.col("doc")).alias("block"), "doc", "a", F.pmod(F.xxhash64("a", "salt"), F.lit(buckets)).alias("bucket"), "salt")

    def gather(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        names, kinds = ["a", "doc", "bucket", "salt", "values"], [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        asked = wanted.sort_by([("doc", "ascending"), ("a", "ascending"), ("salt", "ascending")])
        ids = asked.column("doc").to_numpy()
        out = [pa.table({c: pa.array([], k) for c, k in zip(names, kinds)})]
        done = np.zeros(len(ids), bool)
        texts = texts.filter(pc.is_in(texts.column("doc_id"), pa.array(np.unique(ids)))) if len(ids) else texts.slice(0, 0)
        for batch in W.chunks(texts.to_batches(), limit=CHUNK):
            s = Sets(*W.raw(batch.column("text")))
            doc = batch.column("doc_id").to_numpy()
            order = np.lexsort((s.size, doc))
            order = order[s.size[order] > 0]
            row = np.searchsorted(doc[order], ids) if len(order) else np.zeros(len(ids), np.int64)
            hit = np.flatnonzero((row < len(order)) & ~done)
            hit = hit[doc[order][row[hit]] == ids[hit]] if len(order) else hit[:0]
            done[hit] = True
            at = order[row[hit]] if len(order) else hit
            values = [s.value[b : b + n].tobytes() for b, n in zip(s.begin[at].tolist(), s.size[at].tolist())]
            part = asked.take(pa.array(hit))
            out.append(pa.table([part.column("a"), part.column("doc"), part.column("bucket"), part.column("salt"), pa.array(values, pa.binary())], names=names))
        return pa.concat_tables(out)

    sets = docs.groupBy("block").cogroup(wants.groupBy("block")).applyInArrow(gather, "a bigint, doc bigint, bucket bigint, salt int, values binary")

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by([("a", "ascending"), ("salt", "ascending")])
        a, doc, salt = (table.column(c).to_numpy() for c in ("a", "doc", "salt"))
        values = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("values")]
        edge = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (salt[1:] != salt[:-1]), [True])))
        both, na = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        for lo, hi in zip(edge[:-1], edge[1:]):
            own = next((values[i] for i in range(lo, hi) if doc[i] == a[i]), None)
            if own is None or not len(own):
                continue
            na[lo:hi] = len(own)
            for i in range(lo, hi):
                at = np.minimum(np.searchsorted(own, values[i]), len(own) - 1)
                both[i] = np.count_nonzero(own[at] == values[i])
        return pa.table({"a": a, "b": doc, "na": na, "nb": np.array([len(v) for v in values], np.int64), "both": both})

    return sets.groupBy("bucket").applyInArrow(meet, "a bigint, b bigint, na bigint, nb bigint, both bigint")


def linked(found: DataFrame) -> DataFrame:
    return found.where((F.col("a") != F.col("b")) & (100 * F.col("both") >= PERCENT * (F.col("na") + F.col("nb") - F.col("both")))).select("a", "b")


def scan(entries: DataFrame, signs: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components in lists that the signature bound cannot rule out.

    Stored ``entries`` have list, doc, n, lead, label and the list's length m. Pairs with a lead are known already.
    """
    n_parts = F.ceil(F.col("m") / LIST_PART).cast("int")
    mine = F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int")
    rows = entries.join(signs.select("doc", "sig"), "doc").withColumn("parts", n_parts).withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("list", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "mine", "doc", "n", "lead", "label", "sig")
    buckets = F.pmod(F.xxhash64("list", "p", "q"), F.lit(max(64, entries.count() // 20_000 + 1)))

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by([("list", "ascending"), ("p", "ascending"), ("q", "ascending"), ("n", "ascending"), ("doc", "ascending")])
        key, p, q, mine, doc, n, lead, label = (table.column(c).to_numpy() for c in ("list", "p", "q", "mine", "doc", "n", "lead", "label"))
        sig = table.column("sig").to_pylist()
        edge = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1]), [True])))
        left, right = [], []
        for lo, hi in zip(edge[:-1], edge[1:]):
            if hi - lo < 2 or (label[lo:hi] == label[lo]).all():
                continue
            d, size, lab, led = doc[lo:hi], n[lo:hi], label[lo:hi], lead[lo:hi]
            stop = np.searchsorted(size, size * 100 // PERCENT, side="right")  # sizes ascend: partners of i end at stop[i]
            signs = sig[lo:hi]
            least = min(map(len, signs))
            rough = np.stack([fold(x, least) for x in signs])
            for i in range(hi - lo - 1):
                j = np.arange(i + 1, stop[i])
                j = j[(lab[j] != lab[i]) & (led[j] != d[i]) & (d[j] != led[i])]
                if p[lo] != q[lo]:
                    j = j[mine[lo + j] != mine[lo + i]]
                if not len(j):
                    continue
                differ = np.abs(rough[j] - rough[i]).sum(1, dtype=np.int64)
                for k in j[differ * (100 + PERCENT) <= (100 - PERCENT) * (size[j] + size[i])].tolist():
                    if may_link(signs[i], signs[k], int(size[i]), int(size[k])):
                        left.append(min(d[i], d[k]))
                        right.append(max(d[i], d[k]))
        pairs = np.unique(np.array([left, right], np.int64).T.reshape(-1, 2), axis=0)
        return pa.table({"a": pairs[:, 0].copy(), "b": pairs[:, 1].copy()})

    return rows.withColumn("bucket", buckets).groupBy("bucket").applyInArrow(meet, "a bigint, b bigint").distinct()


def representatives(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """One row (block, doc_id, text) of each class: ``copies`` (doc_id, rep) leave, and of rows that share an id made from key and text one stays."""
    rest = docs.where("doc_id IS NOT NULL").join(copies.where("doc_id <> rep").select("doc_id"), "doc_id", "left_anti").select("block", "doc_id", "text")
    made = rest.where(F.col("doc_id") < HASHED).groupBy("block", "doc_id").agg(F.max("text").alias("text"))
    return rest.where(F.col("doc_id") >= HASHED).unionByName(made)


def grouped(spark: SparkSession, docs: DataFrame, ties: DataFrame | None = None) -> DataFrame:
    """(doc_id, n, component_id) for every row of ``docs`` (doc_id, text), where equal ids mean equal texts; ``ties`` (a, b) link as well."""
    docs = blocked(docs)
    text_bytes = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    rows = stored(spark, sizes(docs), "set-sizes")  # with signatures: a byte for each hash bucket, most of them 0 or 1
    some = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = some.groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    copies = stored(spark, some.join(classes.where("rep < last"), ["n", "k1", "k2"]).select("doc_id", "rep").distinct(), "set-copies")
    # Lists and comparisons over one row of each class: copies leave before anything is made of their texts.
    docs = representatives(docs, copies)
    entries = lists(docs, max(32, text_bytes // BUCKET_BYTES + 1)).distinct()
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / PERCENT))).cast("int")
    entries = stored(spark, entries.withColumn("band", band), "set-lists")
    leads = entries.groupBy("list", "band").agg(F.min("doc").alias("lead"))
    total = entries.groupBy("list").agg(F.count("*").alias("m")).where("m > 1")
    entries = stored(spark, entries.join(leads, ["list", "band"]).join(total, "list"), "set-leads")
    signs = some.groupBy(F.col("doc_id").alias("doc")).agg(F.max(F.struct("n", "sig")).alias("s")).select("doc", F.col("s.n").alias("size"), "s.sig")
    stars = entries.where("doc <> lead").select(F.col("lead").alias("a"), F.col("doc").alias("b")).distinct()
    stars = stored(spark, possible(stars, signs), "set-stars")
    found = stored(spark, linked(compare(spark, docs, stars)), "set-links")
    labels = components(spark, found)
    # Lists that hold several components still.
    named = entries.join(labels, F.col("doc") == F.col("node"), "left").withColumn("label", F.coalesce("label", "doc")).drop("node")
    named = stored(spark, named, "set-labels")
    mixed = named.groupBy("list").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("list")
    rest = stored(spark, scan(stored(spark, named.join(mixed, "list"), "set-mixed"), signs), "set-rest")
    more = linked(compare(spark, docs, rest))
    edges = found.union(more).union(copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    edges = edges.union(ties) if ties is not None else edges
    final = components(spark, edges)
    return rows.join(final, F.col("doc_id") == F.col("node"), "left").select("doc_id", "n", F.coalesce("label", "doc_id").alias("component_id"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return by_key(spark, W.documents(spark, sf_dir)).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def by_key(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n, component_id) for every row of ``docs`` (doc_id, text); the component is named by its smallest key."""
    rows = with_ids(spark, docs.select("doc_id", "text"))
    # Rows without key have sizes, but no part in the links.
    part = rows.select(F.when(F.col("doc_id").isNotNull(), F.col("row_id")).alias("doc_id"), "text")
    keys = stored(spark, rows.where(F.col("doc_id").isNotNull() & (F.col("row_id") < HASHED)).select("doc_id", "row_id").distinct(), "set-keys")
    least = keys.groupBy("doc_id").agg(F.min("row_id").alias("a"))
    ties = keys.join(least, "doc_id").where("a <> row_id").select("a", F.col("row_id").alias("b"))
    found = grouped(spark, part, ties).select(F.col("doc_id").alias("row_id"), "n", F.col("component_id").alias("label"))
    found = stored(spark, found.join(keys, "row_id", "left").withColumn("doc_id", F.coalesce("doc_id", "row_id")), "set-rows")
    names = found.where(F.col("label") < HASHED).groupBy("label").agg(F.min("doc_id").alias("name"))
    return found.join(names, "label", "left").select("doc_id", "n", F.coalesce("name", "label").alias("component_id"))


def one_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of each group of ``docs``, with all columns: that of the smallest key, rows without key last; rows without words stay."""
    columns = docs.columns
    docs = with_ids(spark, docs)
    found = stored(spark, grouped(spark, docs.select(F.col("row_id").alias("doc_id"), "text")), "set-rows")
    made = stored(spark, docs.where(F.col("row_id") < HASHED).select("row_id", F.col("doc_id").cast("bigint").alias("key")).distinct(), "set-made")
    named = found.where("n > 0").select("doc_id", "component_id").distinct().join(made, F.col("doc_id") == F.col("row_id"), "left")
    order = F.when(F.col("row_id").isNull(), F.col("doc_id")).otherwise(F.col("key"))
    named = named.select("doc_id", "component_id", F.struct(order.isNull().alias("none"), order.alias("key"), F.col("doc_id").alias("id")).alias("place"))
    first = named.groupBy("component_id").agg(F.min("place").alias("first"))
    gone = stored(spark, named.join(first.select("component_id", "first"), "component_id").where(F.col("doc_id") != F.col("first.id")).select(F.col("doc_id").alias("row_id")), "set-gone")
    kept = docs.join(gone, "row_id", "left_anti")
    if made.isEmpty():
        return kept.select(*columns)
    # Equal rows share an id: one of them stays, but for rows without words, which link with nothing.
    bare = found.where("n = 0").select(F.col("doc_id").alias("row_id")).distinct()
    again = kept.where(F.col("row_id") < HASHED)
    one = again.join(bare, "row_id", "left_anti").groupBy("row_id").agg(F.min(F.struct(*columns)).alias("row")).select("row.*")
    return kept.where(F.col("row_id") >= HASHED).select(*columns).unionByName(again.join(bare, "row_id", "left_semi").select(*columns)).unionByName(one)
