r"""SentencePiece encoding and decoding as a relational lattice.

A text gets a leading space and is cut into units, `` *[^ \n]+``, a run of spaces or a
line feed; where no piece of the table holds a letter next to another character, units
are cut there as well. No piece crosses a cut, so the best paths of the units are the
best path of the text; a table with pieces over a space's left side or over a line feed
leaves the text whole. A task solves each distinct unit once, as long as it remembers
it: the substrings of bounded length are exploded and joined to the broadcast piece
table, and the best-scoring paths of all units of a chunk are folded end by end (on
equal scores the shorter last piece).
A unit of more than ``MAX_UNIT`` characters is walked alone instead, each end looking
back over the longest piece only, with the same choice.
A space is written as U+2581 in the piece table; a character that no piece covers,
and a U+2581 of the text itself, becomes its UTF-8 bytes. Decoding joins pieces and
bytes and drops the leading space, which gives back the whole text.

The plan is narrow: texts, edges and ids stay in the task that reads the texts, so nothing
is shuffled. A chunk of texts sends its new units ahead and itself behind them, as numbers
of units. Null text is empty: its only unit is the leading space.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from math import inf

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import words as W
from staylens.llm.components import stored
from staylens.session import configure

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_UNIT = 48  # a longer unit is solved outside the lattice: its paths would grow with the square of its length
CHUNK_BYTES = 1 << 20  # text that is cut at once
SOLVED_EDGES = 1 << 16  # edges gathered before their units are solved
KNOWN_UNITS = 400_000  # units a task remembers; beyond, it forgets all
# Rows and bytes that go to Python at once: an edge is a few bytes, a text may be megabytes.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "8192", "spark.sql.execution.arrow.maxBytesPerBatch": "1m"}
# An edge is one number, which sorts by end, unit and start: 6, 26, 6 and 25 bits. A unit that is walked has the end 0.
END_BIT, UNIT_BIT, START_BIT = 57, 31, 25
UNIT_MASK = (1 << END_BIT - UNIT_BIT) - 1
UNCOVERED = (1 << START_BIT) - 1  # in place of a piece id
CHUNK = -1  # in place of an edge: a chunk of texts
SPACE = "▁"
OWN = "\ue000"  # stands for a U+2581 of the text, which is no space
FALLBACK = 10.0  # how much worse than the worst piece an uncovered character is
_UNITS = re.compile(r" *[^ \n]+| +|\n")
_WHOLE = re.compile(r".+", re.S)


def units(text: str | None, pattern: re.Pattern = _UNITS) -> list[str]:
    return pattern.findall(" " + (text or ""))


def uncrossed(names: list[str]) -> set[str] | None:
    """The letters that no piece joins to another character; None where a piece holds a space after another character, or a line feed next to one."""
    if any(SPACE in name.lstrip(SPACE) or ("\n" in name and len(name) > 1) for name in names):
        return None
    letters = {c for c in map(chr, range(1 << 16)) if c.isalpha()}
    while True:
        crossed = set()
        for name in names:
            name = name.lstrip(SPACE)
            inside = [c in letters for c in name]
            crossed |= {c for i, c in enumerate(name) if inside[i] and not all(inside[max(i - 1, 0) : i + 2])}
        if not crossed:
            return letters
        letters -= crossed


def finer_units(names: list[str]) -> re.Pattern:
    """Units cut between a letter and another character as well, leaving out letters that a piece joins to another.

    Whole texts where :func:`uncrossed` finds that a cut at spaces would part a piece.
    """
    letters = uncrossed(names)
    if not letters:
        return _WHOLE if letters is None else _UNITS
    # Spelled as ranges: one look into a table for each character.
    codes = sorted(map(ord, letters))
    first = [c for c, before in zip(codes, [-2, *codes]) if c != before + 1]
    last = [c for c, after in zip(codes, [*codes[1:], -2]) if after != c + 1]
    spelled = "".join(rf"\u{a:04x}-\u{b:04x}" for a, b in zip(first, last))
    return re.compile(r" *[%s]+| *[^ \n%s]+| +|\n" % (spelled, spelled))


def kinds(names: list[str]) -> np.ndarray | None:
    """What each code point is to :func:`finer_units`: 0 a space, 1 a line feed, 2 a letter, 3 another; None for whole texts."""
    letters = uncrossed(names)
    if letters is None:
        return None
    table = np.full(0x110000, 3, np.uint8)
    table[np.fromiter(map(ord, letters), np.int64, len(letters))] = 2
    table[[ord(" "), ord("\n")]] = 0, 1
    return table


def cut(column: pa.Array, kind: np.ndarray | None) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts one after another, as the pattern of :func:`finer_units` finds them, and how many each text has."""
    texts = column.cast(pa.large_string()).fill_null("")
    data, off = W.raw(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))
    begins = np.zeros(len(data), bool)
    begins[off[:-1]] = True
    if kind is not None:
        k = kind[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)]
        before, now = k[:-1], k[1:]
        first = np.flatnonzero((data & 0xC0) != 0x80)[1:]
        begins[first[(now == 1) | ((now != before) & (before != 0))]] = True
    start = np.flatnonzero(begins)
    ends = pa.py_buffer(np.append(start, len(data)).astype(np.int64))
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, ends, pa.py_buffer(np.ascontiguousarray(data))]), np.diff(np.searchsorted(start, off))


class Pieces:
    """The piece table of a model file: text, id and score of every ordinary piece, and the id of byte 0."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.rows = [(model.id_to_piece(i), i, float(model.get_score(i))) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        byte_ids = [i for i in ids if model.is_byte(i)]
        if [model.id_to_piece(i) for i in byte_ids] != [f"<0x{b:02X}>" for b in range(256)] or byte_ids[-1] - byte_ids[0] != 255:
            raise ValueError("the model needs one byte piece for each byte, in order")
        self.byte = byte_ids[0]
        self.units = finer_units([p for p, _, _ in self.rows])
        self.kinds = kinds([p for p, _, _ in self.rows])
        self.longest = max((len(p) for p, _, _ in self.rows), default=1)
        self.worst = min((s for _, _, s in self.rows), default=0.0) - FALLBACK

    def table(self, spark: SparkSession) -> DataFrame:
        kinds = (("piece", pa.string()), ("id", pa.int32()), ("score", pa.float64()))
        # An Arrow table needs no Python workers beside those of the encoder, a list does.
        held = pa.table({name: pa.array([row[i] for row in self.rows], kind) for i, (name, kind) in enumerate(kinds)})
        return F.broadcast(spark.createDataFrame(held))

    def bytes_of(self) -> dict[int, bytes]:
        known = {i: p.replace(SPACE, " ").encode() for p, i, _ in self.rows}
        return known | {self.byte + b: bytes([b]) for b in range(256)}


def lattice(listed: DataFrame, pieces: Pieces, table: DataFrame) -> DataFrame:
    """One row for each edge of the lattices of ``listed`` units, in order; a row without a unit becomes one ``CHUNK``.

    A unit's first row carries its bytes. A unit that is walked has this row alone.
    """
    short = F.char_length("unit") <= MAX_UNIT
    # One explode for the start and one for the length: both run in generated code.
    starts = listed.withColumn("lattice", F.when(short, F.translate("unit", " " + SPACE, SPACE + OWN)).otherwise(""))
    starts = starts.withColumn("s", F.explode(F.sequence(F.lit(0), F.greatest(F.char_length("lattice") - 1, F.lit(0)))))
    starts = starts.withColumn("tail", F.substring("lattice", F.col("s") + 1, F.lit(pieces.longest)))
    edges = starts.withColumn("length", F.explode(F.sequence(F.least(F.char_length("tail"), F.lit(1)), F.char_length("tail"))))
    edges = edges.withColumn("piece", F.substring("tail", F.lit(1), F.col("length")))
    joined = edges.join(table.select("piece", "id"), "piece", "left").where("id IS NOT NULL OR length <= 1")

    def bits(value, place):
        return F.shiftleft(value.cast("bigint"), place)

    edge = bits(F.when(F.col("length") > 0, F.col("s") + F.col("length")).otherwise(0), END_BIT).bitwiseOR(bits(F.col("number"), UNIT_BIT))
    edge = edge.bitwiseOR(bits(F.col("s"), START_BIT)).bitwiseOR(F.coalesce("id", F.lit(UNCOVERED)).cast("bigint"))
    # No nulls: Arrow counts the bytes of a batch row by row, and would pass over a run of nulls each time.
    spelled = F.when((F.col("s") == 0) & (F.col("length") <= 1), F.coalesce(F.col("unit").cast("binary"), "chunk")).otherwise(F.lit(b""))
    return joined.select(F.coalesce(edge, F.lit(CHUNK)).alias("edge"), spelled.alias("bytes"))


def best_paths(edges: np.ndarray, n: int, score: np.ndarray, worst: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best paths of units 0 to ``n`` - 1, one after another: unit, start and piece id (or ``UNCOVERED``) of each edge on them.

    ``edges`` as numbers; ends rise, so each edge meets the settled best path to its start.
    """
    edges = np.sort(edges)
    end, unit = edges >> END_BIT, (edges >> UNIT_BIT) & UNIT_MASK
    start, piece = (edges >> START_BIT) & ((1 << UNIT_BIT - START_BIT) - 1), edges & UNCOVERED
    gain = np.where(piece == UNCOVERED, worst, score[np.minimum(piece, len(score) - 1)])
    size = np.zeros(n, np.int64)
    np.maximum.at(size, unit, end)
    row = np.cumsum(size + 1) - (size + 1)
    total, last = np.zeros(int((size + 1).sum())), np.zeros(int((size + 1).sum()), np.int64)
    level = np.searchsorted(end, np.arange(1, MAX_UNIT + 2))
    for e, (a, b) in enumerate(zip(level[:-1], level[1:]), 1):
        if a == b:
            continue
        u = unit[a:b]
        value = total[row[u] + start[a:b]] + gain[a:b]
        begin = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1])))
        top = np.repeat(np.maximum.reduceat(value, begin), np.diff(np.append(begin, len(u))))
        best = np.flatnonzero(value == top)
        best = best[np.append(u[best[1:]] != u[best[:-1]], True)]  # of equal ones the latest start
        total[row[u[best]] + e] = value[best]
        last[row[u[best]] + e] = a + best
    here = np.flatnonzero(size)
    at, taken = size[here], []
    while len(here):
        taken.append(last[row[here] + at])
        at = start[taken[-1]]
        here, at = here[at > 0], at[at > 0]
    taken = np.concatenate(taken or [np.zeros(0, np.int64)])
    taken = taken[np.lexsort((start[taken], unit[taken]))]
    return unit[taken], start[taken], piece[taken]


def walk(unit: str, known: dict[str, tuple[float, int]], pieces: Pieces) -> list[int]:
    """The ids of the best path over a unit of any length, as :func:`solve` finds it."""
    lattice = unit.translate({ord(" "): SPACE, ord(SPACE): OWN})
    score, last = array("d", [0.0]), array("l", [0])
    for e in range(1, len(lattice) + 1):
        best, size = -inf, 1
        for s in range(max(0, e - pieces.longest), e):
            found = known.get(lattice[s:e])
            if found is None and s < e - 1:
                continue
            value = score[s] + (found[0] if found else pieces.worst)
            if value >= best:
                best, size = value, e - s
        score.append(best)
        last.append(size)
    ids, e = [], len(lattice)
    while e:
        s = e - last[e]
        found = known.get(lattice[s:e])
        ids.extend([found[1]] if found else [pieces.byte + b for b in reversed(unit[s:e].encode())])
        e = s
    return ids[::-1]


class Edges:
    """Edges as they come in, unit after unit, and the bytes of the units."""

    def __init__(self):
        self.edges, self.units, self.size, self.solved = [], [], 0, 0

    def add(self, edges: np.ndarray, spelled: pa.Array) -> None:
        self.edges.append(edges)
        self.units.append(spelled.filter(pc.greater(pc.binary_length(spelled), 0)))
        self.size += len(edges)

    def take(self, whole: bool = True) -> tuple[np.ndarray, pa.Array]:
        """All edges and units held, or those whose edges are surely complete; units are numbered from 0."""
        edges, units = np.concatenate(self.edges), pa.concat_arrays(self.units)
        unit = (edges >> UNIT_BIT) & UNIT_MASK
        n = len(units) if whole or not len(units) else len(units) - 1  # the last one may go on
        at = np.searchsorted(unit, self.solved + n)
        self.edges, self.units, self.size = [edges[at:].copy()], [units[n:]], len(edges) - at
        taken = edges[:at] - (self.solved << UNIT_BIT)
        self.solved += n
        return taken, units[:n].cast(pa.large_string())


class Answers:
    """The ids of numbered units, and whether the ids of each give it back."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.known = {p: (s, i) for p, i, s in pieces.rows}
        self.score = np.zeros(max((i for _, i, _ in pieces.rows), default=0) + 1)
        for _, i, s in pieces.rows:
            self.score[i] = s
        back = pieces.bytes_of()
        spelled = [back.get(i, b"") for i in range(max(back) + 1)]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_end = np.cumsum([0, *map(len, spelled)])
        self.forget(0)

    def forget(self, first: int) -> None:
        self.first, self.flat = first, np.zeros(0, np.int32)
        self.size, self.whole = np.zeros(0, np.int64), np.zeros(0, bool)

    def solve(self, edges: np.ndarray, units: pa.Array) -> None:
        """Add the next ``units``, given all edges of theirs."""
        unit, start, ids = best_paths(edges[edges >> END_BIT > 0], len(units), self.score, self.pieces.worst)
        many = np.ones(len(ids), np.int64)
        odd = np.flatnonzero(ids == UNCOVERED)
        plain = [units[u].as_py()[s].encode() for u, s in zip(unit[odd].tolist(), start[odd].tolist())]
        many[odd] = [len(x) for x in plain]
        unit, ids = np.repeat(unit, many), np.repeat(ids, many)
        where, _ = W.flat((np.cumsum(many) - many)[odd], np.cumsum(many)[odd])
        ids[where] = np.frombuffer(b"".join(plain), np.uint8) + self.pieces.byte
        for u in ((edges[edges >> END_BIT == 0] >> UNIT_BIT) & UNIT_MASK).tolist():
            path = walk(units[u].as_py(), self.known, self.pieces)
            unit, ids = np.append(unit, np.full(len(path), u)), np.append(ids, path)
        order = np.argsort(unit, kind="stable")
        unit, ids = unit[order], ids[order]
        size = np.bincount(unit, minlength=len(units))
        # Do the ids give the units back?
        data, off = W.raw(units)
        length = self.spelled_end[ids + 1] - self.spelled_end[ids]
        where, _ = W.flat(self.spelled_end[ids], self.spelled_end[ids + 1])
        spelled, ends = self.spelled[where], np.cumsum(np.bincount(unit, weights=length, minlength=len(units)).astype(np.int64))
        if np.array_equal(ends, off[1:]) and np.array_equal(spelled, data):
            whole = np.ones(len(units), bool)
        else:
            whole = np.array([spelled[a:b].tobytes() == data[c:d].tobytes() for a, b, c, d in zip(np.append(0, ends), ends, off, off[1:])], bool)
        self.flat = np.concatenate((self.flat, ids.astype(np.int32)))
        self.size, self.whole = np.concatenate((self.size, size)), np.concatenate((self.whole, whole))

    def texts(self, codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of texts made of the units ``codes``, ``counts`` units a text; where each text's ids end; whether it comes back."""
        every = codes - self.first
        if len(every) and not 0 <= every.min() <= every.max() < len(self.size):
            raise ValueError("a text came ahead of its units")
        begin = np.cumsum(self.size) - self.size
        where, _ = W.flat(begin[every], begin[every] + self.size[every])
        to = np.cumsum(counts)
        ends = np.concatenate(([0], np.cumsum(self.size[every])))[to]
        lost = np.concatenate(([0], np.cumsum(~self.whole[every])))
        return self.flat[where], ends, lost[to] == lost[to - counts]


OUT = pa.schema([("doc_id", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())])


def encode(spark: SparkSession, docs: DataFrame, pieces: Pieces | None = None) -> DataFrame:
    """doc_id, n_ids, ids, round_trip for every row of ``docs`` (doc_id, text); round_trip: decoding gives the text back."""
    pieces = pieces or Pieces()
    kind = pieces.kinds
    layout = pa.schema([("number", pa.int32()), ("unit", pa.string()), ("chunk", pa.binary())])

    def listed(batches) -> Iterator[pa.RecordBatch]:
        """The new units of a chunk of texts, numbered from 0, then the chunk: its units as numbers that run through the task, of which those from ``first`` on are known."""
        first, known = 0, pa.array([], pa.large_string())
        for batch in W.chunks(batches, limit=CHUNK_BYTES):
            found, counts = cut(batch.column("text"), kind)
            found = found.dictionary_encode()
            names = found.dictionary
            place = pc.index_in(names, value_set=known)
            if len(known) + place.null_count > KNOWN_UNITS:
                first, known = first + len(known), known[:0]
                place = pa.nulls(len(names), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(([None], [None], [np.array([first, 0]).tobytes()]), layout)], schema=layout)
            new = np.flatnonzero(place.is_null().to_numpy(zero_copy_only=False))
            number = place.fill_null(0).to_numpy().astype(np.int64)
            number[new] = len(known) + np.arange(len(new))
            fresh = names.take(pa.array(new))
            known = pa.concat_arrays([known, fresh])
            for at in range(0, len(fresh), 1 << 15):
                part = fresh[at : at + (1 << 15)].cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + len(part)), pa.int32()), part, pa.nulls(len(part), pa.binary())], schema=layout)
            keys = batch.column("doc_id")
            chunk = (np.array([first, batch.num_rows]), keys.is_valid().cast(pa.int64()), keys.fill_null(0), counts, first + number[found.indices.to_numpy()])
            packed = np.concatenate([np.asarray(x, np.int64) for x in chunk]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(([None], [None], [packed]), layout)], schema=layout)
            pa.default_memory_pool().release_unused()

    def put_together(batches) -> Iterator[pa.RecordBatch]:
        answers, held = Answers(pieces), Edges()
        for batch in batches:
            edge, spelled, at = batch.column("edge").to_numpy(), batch.column("bytes"), 0
            for text in [*np.flatnonzero(edge == CHUNK).tolist(), len(edge)]:
                held.add(edge[at:text], spelled[at:text])
                if text == len(edge):
                    break
                answers.solve(*held.take())
                held, at = Edges(), text + 1
                chunk = np.frombuffer(spelled[text].as_buffer(), np.int64)
                first, n = chunk[:2].tolist()
                if first != answers.first:
                    answers.forget(first)
                if n:
                    valid, keys, counts = chunk[2 : 2 + 3 * n].reshape(3, n)
                    ids, ends, trip = answers.texts(chunk[2 + 3 * n :], counts)
                    lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids))
                    yield pa.RecordBatch.from_arrays([pa.array(keys, mask=valid == 0), pa.array(np.diff(ends, prepend=0)), lists, pa.array(trip)], schema=OUT)
                    pa.default_memory_pool().release_unused()
            if held.size > SOLVED_EDGES:
                answers.solve(*held.take(whole=False))

    joined = lattice(docs.select("doc_id", "text").mapInArrow(listed, "number int, unit string, chunk binary"), pieces, pieces.table(spark))
    before = {key: spark.conf.get(key) for key in BATCHES}
    try:
        for key, value in BATCHES.items():
            spark.conf.set(key, value)
        return stored(spark, joined.mapInArrow(put_together, "doc_id bigint, n_ids bigint, ids array<int>, round_trip boolean"), "encoded")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def decode(encoded: DataFrame, pieces: Pieces | None = None) -> DataFrame:
    """doc_id, text for rows of ids; an id that the table lacks decodes to nothing, null ids to null."""
    back = (pieces or Pieces()).bytes_of()

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if ids is None else b"".join([back.get(i, b"") for i in ids])[1:].decode("utf-8", "replace") for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(read, "doc_id bigint, text string")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return encode(spark, W.documents(spark, sf_dir))
