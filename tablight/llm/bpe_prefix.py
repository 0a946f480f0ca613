"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a piece has one encoding, so it has one last token; storing that
token for each prefix is enough to write the encoding of the whole piece. An
automaton over the vocabulary, whose suffix links give all tokens that end at a
place, is run over the piece once. A token t that ends at place e is the last
token of that prefix exactly if it starts the piece, or if it is compatible with
the last token of the prefix before it: the merges of both tokens, made in rank
order, never join across their border. Compatibility is decided by undoing the
later of the two merges again and again, and kept per pair. Following the stored
tokens back from the end gives the ids. The work is linear in the piece (times
the tokens that can end at one place).

The vocabulary is a ``tokenizers`` file of kind byte-level BPE. Pieces come from
its own pre-tokenizer, so that the classes of letters, digits and white space are
those of its Unicode tables; its added tokens are cut out of a text first, as
written, and get their own id. Tokens are kept in the alphabet of the file, which
has one character a byte.

A text is cut into stretches (blank space with the word after it) where a word
ends: no piece spans that place. Tasks keep bounded memos of stretches and pieces,
with the ids and the bytes decoded from these ids. Texts with blank space beyond
ASCII are one stretch each.

Defined results. Null text: empty, no ids. Rows keep their number and the key its
type (null and repeated keys too); other columns are ignored; an empty table gives
no rows. Memory is bounded by an Arrow slice or one text.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, ship

MEMO_STRETCHES, MEMO_PIECES, MEMO_PAIRS = 400_000, 400_000, 1_000_000
MEMO_BYTES = 48
_STRETCH = re.compile(rb"[\x09-\x0d\x20]*[^\x09-\x0d\x20]+|[\x09-\x0d\x20]+").findall
#: A line break or none, a word of Latin letters after a blank or none, and closing punctuation: its pieces
#: are these parts under any Unicode tables.
_SIMPLE = re.compile(rb"(\n?)( ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([.,;:!?]*)").fullmatch
#: Blank space beyond ASCII's (and control characters that some tables count as such), in UTF-8; its first bytes.
_OTHER_FIRST = (b"\xc2", b"\xe1", b"\xe2", b"\xe3", b"\x1c", b"\x1d", b"\x1e", b"\x1f")
_OTHER_SPACE = re.compile(
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8b\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
).search


def byte_alphabet() -> list[str]:
    """The character of each byte: printable ones stand for themselves, the others,
    in order, for the characters from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, after = [], 256
    for b in range(256):
        out.append(chr(b if b in own else after))
        after += b not in own
    return out


class PrefixTables:
    """What the tasks need of a ``tokenizers`` file: ids, bytes of ids, merges by
    pair, the parts of a token's merge, and the added tokens."""

    def __init__(self, text: str):
        file = json.loads(text)
        model, split = file["model"], file["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or file["normalizer"] or model["ignore_merges"]:
            raise ValueError("not a byte-level BPE file without normaliser")
        added = file["added_tokens"]
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in added):
            raise ValueError("added tokens that strip, match whole words or normalised text are not supported")
        self.split = {"add_prefix_space": split["add_prefix_space"], "use_regex": split["use_regex"]}
        self.added = {a["content"].encode(): a["id"] for a in added}
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        vocab: dict[str, int] = model["vocab"]
        self.bytes = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items() if t.encode() not in self.added}
        self.bytes.update((i, t) for t, i in self.added.items())
        self.pair: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        self.tokens = {t: i for t, i in vocab.items() if len(t) == 1}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, made = vocab[left], vocab[right], vocab[left + right]
            self.pair.setdefault((a, b), rank)
            self.parts.setdefault(made, (rank, a, b))
            self.tokens[left + right] = made


class PrefixCodec:
    """Encoder and decoder of one task."""

    def __init__(self, tables: PrefixTables):
        from tokenizers import pre_tokenizers

        self.t = tables
        self.split = pre_tokenizers.ByteLevel(**tables.split).pre_tokenize_str
        #: pieces are those of the usual pattern, and no blank is put before a text
        self.standard = tables.split == {"add_prefix_space": False, "use_regex": True}
        self.auto = ahocorasick.Automaton()
        for token, i in tables.tokens.items():
            self.auto.add_word(token, (i, len(token)))
        self.auto.make_automaton()
        added = sorted(tables.added, key=len, reverse=True)
        self.cut = re.compile(b"|".join(map(re.escape, added))) if added else None
        self.alphabet = {b: c for b, c in enumerate(byte_alphabet())}
        self.packed = {i: i.to_bytes(4, "little") for i in tables.bytes}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[bytes, tuple[bytes, bytes]] = {}
        self.stretches: dict[bytes, tuple[bytes, bytes]] = {}

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        """Whether no merge of rank below ``limit`` joins the tokens that meet at the
        border, while the later merge beside it is undone. Of two equal merges the
        left one is made first."""
        pair, parts = self.t.pair, self.t.parts
        single = (-1, 0, 0)
        limit = len(pair) + 1
        while pair.get((a, b), limit) >= limit:
            left, right = parts.get(a, single), parts.get(b, single)
            if left[0] < 0 and right[0] < 0:
                return True
            if left[0] > right[0]:
                limit, a = min(limit, left[0]), left[2]
            else:
                limit, b = min(limit, right[0] + 1), right[1]
        return False

    def last_tokens(self, piece: str) -> list[tuple[int, int]]:
        """(last token, its size) of every prefix; the empty prefix has none."""
        last: list[tuple[int, int] | None] = [None] * (len(piece) + 1)
        compatible = self.compatible
        for end, token in self.auto.iter(piece):
            end += 1
            if last[end] is None:
                start = end - token[1]
                if not start:
                    last[end] = token
                elif (before := last[start]) is not None and compatible(before[0], token[0]):
                    last[end] = token
        return last

    def ids_of(self, piece: bytes) -> list[int]:
        """Ids of one piece, by following the last tokens back."""
        last, at, out = self.last_tokens(piece.decode("latin-1").translate(self.alphabet)), len(piece), []
        while at:
            token = last[at]
            if token is None:
                raise ValueError("the vocabulary cannot encode this text")
            out.append(token[0])
            at -= token[1]
        out.reverse()
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.t.bytes.__getitem__, ids))

    def piece(self, piece: bytes) -> tuple[bytes, bytes]:
        known = self.pieces.get(piece)
        if known is None:
            ids = self.ids_of(piece)
            known = b"".join(map(self.packed.__getitem__, ids)), self.decode(ids)
            if len(piece) <= MEMO_BYTES:
                if len(self.pieces) >= MEMO_PIECES:
                    self.pieces.clear()
                self.pieces[piece] = known
        return known

    def stretch(self, raw: bytes) -> tuple[bytes, bytes]:
        """Ids (little-endian, 4 bytes each) and the bytes that they decode to."""
        simple = _SIMPLE(raw) if self.standard else None
        if simple:
            parts = [p for p in simple.groups() if p]
        elif self.standard:
            text = raw.decode()
            parts = [text[a:b].encode() for _, (a, b) in self.split(text)]
        else:  # the pre-tokenizer may add a blank
            back = {c: b for b, c in self.alphabet.items()}
            parts = [bytes(map(back.__getitem__, p)) for p, _ in self.split(raw.decode())]
        found = [self.piece(p) for p in parts]
        if len(found) == 1:
            return found[0]
        return b"".join([x for x, _ in found]), b"".join([x for _, x in found])

    def encode(self, raw: bytes) -> tuple[bytes, bytes]:
        """Ids of a whole text and the bytes that they decode to."""
        if self.cut is None or not self.cut.search(raw):
            return self._plain(raw)
        found, at = [], 0
        for m in self.cut.finditer(raw):
            i = self.t.added[m.group()]
            found += [self._plain(raw[at : m.start()]), (self.packed[i], self.t.bytes[i])]
            at = m.end()
        found.append(self._plain(raw[at:]))
        return b"".join([x for x, _ in found]), b"".join([x for _, x in found])

    def _plain(self, raw: bytes) -> tuple[bytes, bytes]:
        if not raw:
            return b"", b""
        if not self.standard or (any(b in raw for b in _OTHER_FIRST) and _OTHER_SPACE(raw)):
            return self.stretch(raw)
        parts, known = _STRETCH(raw), self.stretches
        try:
            found = [known[p] for p in parts]
        except KeyError:
            if len(known) >= MEMO_STRETCHES:
                known.clear()
            found = []
            for p in parts:
                pair = known.get(p)
                if pair is None:
                    pair = self.stretch(p)
                    if len(p) <= MEMO_BYTES:
                        known[p] = pair
                found.append(pair)
        return b"".join([x for x, _ in found]), b"".join([x for _, x in found])


_CODEC: dict[str, PrefixCodec] = {}


def prefix_encode(docs: DataFrame, vocab_path: str, key: str = "doc_id", text: str = "text", digests_only: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) of every row: ids
    hashed as little-endian unsigned 32-bit integers, the decoded text as UTF-8. One
    narrow pass without a shuffle; the tables (the size of the vocabulary file) are
    broadcast."""
    spark = docs.sparkSession
    ship(spark)
    with open(vocab_path, encoding="utf-8") as f:
        tables = spark.sparkContext.broadcast(PrefixTables(f.read()))
    name = uuid.uuid4().hex
    sel = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    kind = sel.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _CODEC.get(name)
        if codec is None:
            _CODEC.clear()
            codec = _CODEC[name] = PrefixCodec(tables.value)
        for part, texts in chunks(batches, "_text"):
            n, ids_hex, back_hex, all_ids, all_text = [], [], [], [], []
            for raw in texts:
                ids, back = codec.encode(raw)
                n.append(len(ids) // 4)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                decoded = back.decode("utf-8", "replace")
                back_hex.append(hashlib.sha256(decoded.encode()).hexdigest())
                if not digests_only:
                    all_ids.append(np.frombuffer(ids, "<i4"))
                    all_text.append(decoded)
            cols = [part.column(0), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(back_hex, pa.string())]
            names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
            if not digests_only:
                cols += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(all_text, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    extra = "" if digests_only else ", ids array<int>, decoded string"
    out = sel.mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}")
    return out.withColumnRenamed("key", key)
