"""Byte-level BPE encoding and decoding with a rank vocabulary.

A piece's bytes are read as Latin-1 text, so that a pyahocorasick automaton over
the vocabulary finds every token in it in one pass; from these the longest token
at each place is known. Encoding goes left to right, takes the longest token that
is compatible with the token before it, and steps back where none is. Two tokens
are compatible when the merges would never have joined bytes across their
border: this is decided by undoing the later of both merges again and again
(memoised per pair). The compatible sequence is unique and is what applying the
merges in rank order gives, in time linear in the piece.

``BpeTables`` is built once on the driver (its size is that of the vocabulary)
and broadcast; tasks build the automaton from it. Pieces come from the
tokenizer's split pattern. Each task keeps a bounded memo of pieces with their
ids in decimal and the bytes that these ids decode to, in two generations: a
full one becomes the older, and pieces found there move to the younger.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, ship

MEMO_PIECES = 400_000  # in each of two generations
MEMO_PAIRS = 1_000_000
MEMO_PIECE_CHARS = 64


class BpeTables:
    """Tables derived from ranks: token bytes, the two parts of each merge, and
    the next shorter token that starts a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: b for b, i in ranks.items()}
        self.split: dict[int, tuple[int, int]] = {}
        self.pair: dict[tuple[int, int], int] = {}
        merged: set[int] = set()
        for tok, i in sorted(ranks.items(), key=lambda x: x[1]):
            parts = _merge(tok, ranks, i)
            if len(parts) == 1:
                self.split[i] = (i, i)
            elif len(parts) == 2:
                self.split[i] = (ranks[parts[0]], ranks[parts[1]])
                self.pair[self.split[i]] = i
            else:
                continue  # no sequence of merges gives it: only a whole piece can be this token
            merged.add(i)
        self.shorter: dict[int, int] = {}
        for i in merged:
            tok = self.token[i]
            for n in range(len(tok) - 1, 0, -1):
                j = ranks.get(tok[:n])
                if j is not None and j in merged:
                    self.shorter[i] = j
                    break
        self.merged = merged


def _merge(tok: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """Apply merges of rank under ``below`` to the bytes of ``tok``."""
    parts = [tok[i : i + 1] for i in range(len(tok))]
    while len(parts) > 1:
        best, at = below, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1], below)
            if r < best:
                best, at = r, i
        if at < 0:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class BpeCodec:
    """Encoder and decoder of one task."""

    def __init__(self, tables: BpeTables, pattern: str):
        self.t = tables
        self.split = regex.compile(pattern).findall
        self.auto = ahocorasick.Automaton()
        for i in tables.merged:
            self.auto.add_word(tables.token[i].decode("latin-1"), (i, len(tables.token[i])))
        if len(self.auto):
            self.auto.make_automaton()
        self.sizes = {i: len(b) for i, b in tables.token.items()}
        self.fits: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}
        self.digits = {i: str(i).encode() for i in tables.token}

    def compatible(self, a: int, b: int) -> bool:
        key = (a, b)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= MEMO_PAIRS:
                self.fits.clear()
            known = self.fits[key] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        pair, split = self.t.pair, self.t.split
        limit = float("inf")  # merges of this rank or later had not been made when the border was decided
        while True:
            joined = pair.get((a, b))
            if joined is not None and joined < limit:
                return False
            # undo the later merge; when it is a single byte, the other one
            for side in (("a", "b") if a > b else ("b", "a")):
                if side == "a":
                    limit, inner = a, split[a][1]
                    if inner != a:
                        a = inner
                        break
                else:
                    limit, inner = b + 1, split[b][0]
                    if inner != b:
                        b = inner
                        break
            else:
                return True

    def piece(self, raw: bytes) -> tuple[int, ...]:
        whole = self.t.ranks.get(raw)
        if whole is not None:
            return (whole,)
        n = len(raw)
        longest = [-1] * n
        for end, (i, size) in self.auto.iter(raw.decode("latin-1")):
            longest[end - size + 1] = i  # ends rise, so the last written is the longest
        out: list[int] = []
        dead = bytearray(n + 1)
        pos, cand = 0, longest[0]
        sizes, shorter = self.sizes, self.t.shorter
        while pos < n:
            while True:
                if cand < 0:
                    raise ValueError("a byte of the text is not in the vocabulary")
                end = pos + sizes[cand]
                if not dead[end] and (not out or self.compatible(out[-1], cand)):
                    out.append(cand)
                    pos = end
                    cand = longest[pos] if pos < n else -1
                    break
                nxt = shorter.get(cand)
                if nxt is not None:
                    cand = nxt
                    continue
                if not out:
                    raise ValueError("the vocabulary cannot encode this text")
                dead[pos] = 1
                cand = out.pop()
                pos -= sizes[cand]
        return tuple(out)

    def _look_up(self, p: str) -> tuple[bytes, bytes]:
        """Decimal ids and decoded bytes of a piece that the memo lacks."""
        known = self.older.get(p)
        if known is None:
            ids = self.piece(p.encode())
            known = b",".join(map(self.digits.__getitem__, ids)), self.decode(ids)
        if len(p) <= MEMO_PIECE_CHARS:
            self.memo[p] = known
        return known

    def written(self, text: str) -> tuple[bytes, bytes]:
        """(ids in decimal, joined by commas; decoded bytes) of a text."""
        if len(self.memo) >= MEMO_PIECES:
            self.older, self.memo = self.memo, {}
        get, look_up = self.memo.get, self._look_up
        found = [get(p) or look_up(p) for p in self.split(text)]
        return b",".join([ids for ids, _ in found]), b"".join([raw for _, raw in found])

    def encode(self, text: str) -> list[int]:
        ids, _ = self.written(text)
        return list(map(int, ids.split(b","))) if ids else []

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.t.token.__getitem__, ids))


_CODEC: dict[str, BpeCodec] = {}


def encode_documents(docs: DataFrame, vocab_path: str, pattern: str, key: str = "doc_id", text: str = "text", digests_only: bool = False) -> DataFrame:
    """(key, n_tokens, ids, decoded, ids_sha256, decoded_sha256) of every row; a
    null text is empty. ``digests_only`` leaves out ids and decoded. Rows keep
    their number and the key its type; other columns are ignored. One narrow
    pass: no shuffle, memory bounded by an Arrow slice or one text."""
    spark = docs.sparkSession
    ship(spark)
    tables = spark.sparkContext.broadcast(BpeTables(load_ranks(vocab_path)))
    name = uuid.uuid4().hex
    sel = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    kind = sel.schema["_key"].dataType.simpleString()
    extra = "" if digests_only else ", ids array<int>, decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _CODEC.get(name)
        if codec is None:
            _CODEC.clear()
            codec = _CODEC[name] = BpeCodec(tables.value, pattern)
        for part, texts in chunks(batches, "_text"):
            n, ids_hex, dec_hex, all_ids, all_dec = [], [], [], [], []
            for raw in texts:
                ids, back = codec.written(raw.decode())
                n.append(ids.count(b",") + 1 if ids else 0)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                dec_hex.append(hashlib.sha256(back).hexdigest())
                if not digests_only:
                    all_ids.append(list(map(int, ids.split(b","))) if ids else [])
                    all_dec.append(back)
            cols = [part.column(0), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(dec_hex, pa.string())]
            names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
            if not digests_only:
                cols += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(all_dec, pa.binary())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return sel.mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}").withColumnRenamed("key", key)
