"""Sequence packing by cutting-stock column generation.

Every document is tokenised and cut into full pieces of ``capacity`` tokens and
one rest. Piece lengths go into classes of ``unit`` tokens (rounded up), whose
counts -- a histogram of at most capacity/unit rows, whatever the corpus -- are
the demands of a cutting-stock problem: cover all classes with the fewest
patterns (multisets of classes that fit a sequence). A revised simplex solves
its linear relaxation; an unbounded-knapsack dynamic program over the dual prices
proposes the next pattern until Farley's bound, or the
filled length itself, is within ``gap``. Patterns are
used floor(x) times; what is left (a bounded number of pieces) is filled largest
first. The plan is a list of rank ranges per class; pieces are ranked within
their class, and rank -> sequence is arithmetic.

Only the histogram reaches the driver. Ranks use salted groups (class, salt) with
offsets, so a class that holds a third of all pieces (copies, full pieces) is
spread over many tasks. The pieces are written to the checkpoint folder once, so
ranks do not depend on recomputation.

Defined results. Null text: empty, one piece holding the end id. Repeated rows
are packed each; equal (doc_id, start) pieces are ranked in the order of length
and checksum, ties are interchangeable. Null ids are kept. Empty table: no
pieces. Other columns are ignored. A sequence whose tokens fill a power of two
needs no padding.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, materialise, ship

CAPACITY, UNIT, GAP = 4096, 8, 5e-4
END_ID = 2
MEMO_WORDS = 1_200_000
MEMO_WORD_BYTES = 64
_BLANKS = b" \t\n\x0b\x0c\r"  # what ``bytes.split`` cuts at
_TAIL = b".,;:!?%&#$*|()\"'-"
_IS_BLANK, _IS_TAIL = (np.isin(np.arange(256), list(some)) for some in (_BLANKS, _TAIL))
_IS_ALNUM = np.array([chr(c).isalnum() and chr(c).lower().isalnum() for c in range(0x250)])  # lower case of U+0130 ends in a mark
_ONE_PIECE = re.compile("[a-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+").fullmatch  # Latin letters


class WordIds:
    """Ids of texts by a lower-casing ``tokenizers`` file whose pieces never span
    white space, nor letters and punctuation: the ids of a text are those of its
    blank-separated stretches in order, and those of a stretch are its stem's and
    its closing punctuation's. The stems and closings of many texts are numbered at
    once (Arrow's dictionary encoding); each different one is encoded once and kept in
    a bounded memo as little-endian bytes. The file's added tokens (``<|endoftext|>``) get their own id
    where a text holds them as written, as the library has it; they are matched
    before lower-casing, so stretches that may hold one are not lower-cased here."""

    def __init__(self, vocab: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(vocab)
        added = self.tok.get_added_tokens_decoder().items()
        marks = [(t.content.encode(), i) for i, t in sorted(added) if len(t.content) > 2 and not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.between = marks[0] if marks and all(t.content.encode()[:2] == marks[0][0][:2] for _, t in added) else None
        suffix = json.loads(vocab)["model"].get("end_of_word_suffix")
        known = self.tok.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(known.values()) + 1, bool) if suffix else None
        if suffix:
            self.closes[[i for t, i in known.items() if t.endswith(suffix)]] = True
        self.memo: dict[bytes, bytes] = {}

    def _encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word. Words of Latin letters are one piece each, whose last id alone
        is one that ends a word: they go to the library as one text with blanks between
        them. Others that cannot hold an added token go as one text with an added token
        between them, which it matches before all else."""
        out = {}
        latin = [w for w in words if _ONE_PIECE(w.decode())] if self.closes is not None else []
        if latin:
            raw = array("I", self.tok.encode_batch_fast([b" ".join(latin).decode()], add_special_tokens=False)[0].ids)
            ends = np.flatnonzero(self.closes[np.frombuffer(raw, np.uint32)]) + 1
            if len(ends) == len(latin) and ends[-1] == len(raw):
                data, ends = raw.tobytes(), (4 * ends).tolist()
                out = {w: data[lo:hi] for w, lo, hi in zip(latin, [0, *ends], ends)}  # noqa: B905
        plain = [w for w in words if w not in out and self.between is not None and self.between[0][:2] not in w]
        if plain:
            text, mark = self.between
            raw = array("I", self.tok.encode_batch_fast([text.join(plain).decode()], add_special_tokens=False)[0].ids)
            at = 0
            for w, end in zip(plain, [*np.flatnonzero(np.frombuffer(raw, np.uint32) == mark).tolist(), len(raw)], strict=True):
                out[w] = raw[at:end].tobytes()
                at = end + 1
        rest = [w for w in words if w not in out]
        found = self.tok.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False) if rest else []
        out.update((w, array("I", e.ids).tobytes()) for w, e in zip(rest, found, strict=True))
        return [out[w] for w in words]

    @staticmethod
    def _stem_ends(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where the stem of each stretch ends: before closing ASCII punctuation that
        follows a Latin letter or digit, else at the stretch's end."""
        out = end.copy()
        some = np.flatnonzero(_IS_TAIL[buf[end - 1]])
        cut = end[some] - 1
        for _ in range(8):
            more = np.flatnonzero((cut > start[some]) & _IS_TAIL[buf[cut - 1]])
            if not len(more):
                break
            cut[more] -= 1
        else:  # long runs, one by one
            for i in more:
                s = start[some[i]]
                cut[i] = s + len(buf[s : cut[i]].tobytes().rstrip(_TAIL))
        last, lead = buf[cut - 1].astype(np.int64), buf[np.maximum(cut - 2, 0)].astype(np.int64)
        two = (last >= 0x80) & (lead >= 0xC2) & (lead < 0xE0)
        char = np.where(two, (lead & 0x1F) << 6 | last & 0x3F, last)
        latin = (cut > start[some]) & (two | (last < 0x80)) & (char < 0x250) & _IS_ALNUM[np.minimum(char, 0x24F)]
        out[some[latin]] = cut[latin]
        return out

    def ids(self, text: bytes) -> bytes:
        return next(self.ids_of([text]))

    def ids_of(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of each text; the words of all ``texts`` that the memo lacks are encoded in one call."""
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        lowered = [self._lowered(t) for t in texts]
        joined = b"".join(x for t in lowered for x in (t, b"\n"))
        buf = np.frombuffer(joined, np.uint8)
        blank = _IS_BLANK[buf]
        start = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
        end = np.flatnonzero(blank & ~np.concatenate([[True], blank[:-1]]))
        stem = self._stem_ends(buf, start, end)
        closed = stem < end
        at = np.arange(len(start)) + np.cumsum(closed) - closed
        first = np.empty(len(start) + int(closed.sum()), np.int64)
        first[at], first[at[closed] + 1] = start, stem[closed]
        size = np.empty(len(first) + 1, np.int64)
        size[0], size[at + 1], size[at[closed] + 2] = 0, stem - start, (end - stem)[closed]
        places = pa.py_buffer(np.cumsum(size))
        parts = pa.Array.from_buffers(pa.large_binary(), len(first), [None, places, pa.py_buffer(joined.translate(None, _BLANKS))]).dictionary_encode()
        words = parts.dictionary.to_pylist()
        found = list(map(memo.get, words))
        new = [w for w, i in zip(words, found, strict=True) if i is None]
        if new:
            fresh = dict(zip(new, self._encode(new), strict=True))
            found = [fresh[w] if i is None else i for w, i in zip(words, found, strict=True)]
            memo.update((w, i) for w, i in fresh.items() if len(w) <= MEMO_WORD_BYTES)
        ids = pa.array(found, pa.large_binary()).take(parts.indices)
        _, ends, data = ids.buffers()
        begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)])
        cuts = np.frombuffer(ends, np.int64, len(ids) + 1)[np.searchsorted(first, begin)].tolist() if len(ids) else [0] * len(begin)
        held = memoryview(data) if data is not None else b""
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            yield bytes(held[lo:hi])

    @staticmethod
    def _lowered(text: bytes) -> bytes:
        low = text.lower()  # of bytes: A-Z
        if b"<|" in text:
            low = b" ".join([raw if b"<|" in raw else w for raw, w in zip(text.split(), low.split(), strict=True)])
        return low


_IDS: dict[str, WordIds] = {}


def cut_documents(docs: DataFrame, vocab_path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces (key, start, length, ids_crc32, doc_tokens[, ids]) of every row."""
    spark = docs.sparkSession
    ship(spark)
    with open(vocab_path, encoding="utf-8") as f:
        vocab = spark.sparkContext.broadcast(f.read())
    sel = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("_text"))
    kind = sel.schema["key"].dataType.simpleString()
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _IDS.get(vocab_path)
        if enc is None:
            enc = _IDS[vocab_path] = WordIds(vocab.value)
        end = END_ID.to_bytes(4, "little")
        for part, texts in chunks(batches, "_text", 4_000_000):
            row, start, length, crc, total, pieces = [], [], [], [], [], []
            for i, ids in enumerate(enc.ids_of(texts)):
                ids += end
                for at in range(0, len(ids), step):
                    piece = ids[at : at + step]
                    row.append(i)
                    start.append(at // 4)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(len(ids) // 4)
                    if with_ids:
                        pieces.append(np.frombuffer(piece, "<i4"))
            cols = [part.column(0).take(pa.array(row, pa.int64()))] + [pa.array(c, pa.int64()) for c in (start, length, crc, total)]
            names = ["key", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                cols, names = [*cols, pa.array(pieces, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    extra = ", ids array<int>" if with_ids else ""
    return sel.mapInArrow(run, f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long{extra}")


@dataclass
class Plan:
    """Per class, ranges of ranks: from ``lo``, ``per`` pieces go to each of the
    sequences ``seq``, ``seq`` + 1, ..."""

    cls: np.ndarray
    lo: np.ndarray
    per: np.ndarray
    seq: np.ndarray
    n_sequences: int


def best_pattern(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Knapsack dynamic program: the most valuable multiset of classes in ``room``."""
    value, pick = np.zeros(room + 1), np.full(room + 1, -1)
    for w in range(1, room + 1):
        value[w], pick[w] = value[w - 1], -1
        n = int(np.searchsorted(sizes, w, side="right"))
        if n:
            gain = value[w - sizes[:n]] + prices[:n]
            k = int(np.argmax(gain))
            if gain[k] > value[w]:
                value[w], pick[w] = gain[k], k
    out, w = np.zeros(len(sizes), np.int64), room
    while w > 0:
        if pick[w] < 0:
            w -= 1
        else:
            out[pick[w]] += 1
            w -= sizes[pick[w]]
    return float(value[room]), out


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Column generation: (patterns as columns, how often each is used, real)."""
    m = len(sizes)
    basis = np.diag(room // sizes).astype(float)
    inverse = np.diag(1.0 / (room // sizes))
    x = inverse @ demand
    floor = sizes @ demand / room  # no packing needs fewer sequences
    for step in range(60 * m):
        if x.sum() <= (1 + gap) * floor:
            break
        prices = np.maximum(inverse.sum(axis=0), 0.0)  # every pattern costs one sequence
        value, pattern = best_pattern(prices, sizes, room)
        if value <= 1 + 1e-9 or x.sum() <= (1 + gap) * (prices @ demand) / value:
            break
        column = inverse @ pattern
        ratio = np.where(column > 1e-9, x / np.where(column > 1e-9, column, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = pattern
        if step % 100 == 99:
            inverse = np.linalg.inv(basis)
        else:
            row = inverse[out] / column[out]
            inverse -= np.outer(column, row)
            inverse[out] = row
        x = np.maximum(inverse @ demand, 0.0)
    return basis.astype(np.int64), x


def plan_sequences(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP) -> Plan:
    """Round the patterns and turn them into rank ranges that cover each class."""
    sizes, demand = np.asarray(sizes, np.int64), np.asarray(demand, np.int64)
    patterns, x = solve_patterns(sizes, demand.astype(float), room, gap)
    uses = np.floor(x + 1e-6).astype(np.int64)
    rows: list[tuple[int, int, int, int]] = []
    done, seq = np.zeros(len(sizes), np.int64), 0

    def use(pattern: np.ndarray, times: int) -> None:
        nonlocal seq
        for c in np.flatnonzero(pattern):
            rows.append((int(sizes[c]), int(done[c]), int(pattern[c]), seq))
            done[c] += pattern[c] * times
        seq += times

    for p in np.flatnonzero(uses):
        pattern = patterns[:, p]
        fits = (demand - done)[pattern > 0] // pattern[pattern > 0]
        if len(fits) and (times := int(min(uses[p], fits.min()))) > 0:
            use(pattern, times)
    while (left := demand - done).any():  # a bounded rest, largest first
        pattern, free = np.zeros(len(sizes), np.int64), room
        for c in np.flatnonzero(left)[::-1]:
            pattern[c] = min(left[c], free // sizes[c])
            free -= pattern[c] * sizes[c]
        some = pattern > 0
        use(pattern, int((left[some] // pattern[some]).min()))
    cls, lo, per, at = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 4
    order = np.lexsort((lo, cls))
    return Plan(cls[order], lo[order], per[order], at[order], seq)


def pack(docs: DataFrame, vocab_path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, unit: int = UNIT, gap: float = GAP, with_ids: bool = False) -> DataFrame:
    """Pieces with sequence_id and offset (gapless from 0 within a sequence)."""
    spark = docs.sparkSession
    pieces = cut_documents(docs, vocab_path, key, text, capacity, with_ids)
    pieces = materialise(pieces.withColumn("cls", F.expr(f"(length + {unit - 1}) div {unit}")), "pack-pieces")
    hist = pieces.groupBy("cls").count().toPandas().sort_values("cls")
    n = int(hist["count"].sum())
    plan = plan_sequences(hist["cls"].to_numpy(), hist["count"].to_numpy(), -(-capacity // unit), gap)
    shared = spark.sparkContext.broadcast(plan)  # capacity/unit classes, as many patterns: bounded
    n_salts = max(64, n // 20_000)
    ranked = pieces.withColumn("salt", F.pmod(F.xxhash64("key", "start", "ids_crc32"), F.lit(n_salts)))
    counts = ranked.groupBy("cls", "salt").count()
    before = Window.partitionBy("cls").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("cls", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("cls", "salt").orderBy("key", "start", "length", "ids_crc32")
    ranked = ranked.withColumn("nth", F.row_number().over(within) - 1).join(first, ["cls", "salt"])

    @F.pandas_udf("long")
    def sequence_of(cls: pd.Series, rank: pd.Series) -> pd.Series:
        p = shared.value
        wide = int(p.lo.max(initial=0)) + n + 1
        k = np.searchsorted(p.cls * wide + p.lo, cls.to_numpy() * wide + rank.to_numpy(), side="right") - 1
        return pd.Series(p.seq[k] + (rank.to_numpy() - p.lo[k]) // p.per[k])

    out = ranked.withColumn("rank", F.col("first") + F.col("nth")).withColumn("sequence_id", sequence_of("cls", "rank"))
    line = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "cls", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = out.withColumn("offset", F.sum("length").over(line) - F.col("length"))
    return out.select(F.col("key").alias(key), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else []))
