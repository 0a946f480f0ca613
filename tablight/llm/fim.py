"""Fill-in-the-middle rearrangement with a compressed set of cut places.

The places where a text may be cut -- the ends of its units -- are kept as a set
of containers, one for each stretch of 65,536 offsets: a sorted array of 16-bit
offsets while there are at most 4096, a bitmap beyond, or runs (first offset and
length) where these take the least room. Cumulative cardinalities over the
containers turn "the end of unit k" into a binary search for the container and a
select inside it: an array look-up, a search over cumulative word popcounts and
then over the bits of one word, or a search over cumulative run lengths. One call
gives both cuts of a text.

Units are tokens (blank space with the word after it, or blank space at the end),
single characters, or lines. Offsets count bytes of the UTF-8 text and always lie
between characters; lengths are reported in code points.

The draw is a hash of the seed and the id, so it does not depend on partitions:
h1 to h4 are the first four 32-bit groups of sha256("<seed>:<id>"). The prefix ends
after the smaller of h1 % (n+1) and h2 % (n+1) units and the middle after the
larger; h3 % 100 decides whether the text is rearranged and h4 % 100 which way. A
text that is empty or holds a sentinel stays plain, so the output can be read back.

Defined results. Null text: empty, plain. A null id is hashed as the empty text.
Repeated ids get the same draw. Rows keep their number; other columns are ignored;
an empty table gives no rows. One narrow pass, memory bounded by an Arrow slice or
one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, ship

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BITS, ARRAY_MAX = 16, 4096


class ArrayContainer:
    """Sorted 16-bit offsets."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """A bit for each of 65,536 offsets, with cumulative popcounts of its words."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << _BITS, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.upto = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        w = int(np.searchsorted(self.upto, k, side="right"))
        left, word = k - (int(self.upto[w - 1]) if w else 0), int(self.words[w])
        for _ in range(left):
            word &= word - 1  # without its lowest bit
        return w * 64 + (word & -word).bit_length() - 1


class RunContainer:
    """First offsets of runs, with cumulative lengths."""

    def __init__(self, first: np.ndarray, upto: np.ndarray):
        self.first, self.upto = first.astype(np.uint16), upto

    def select(self, k: int) -> int:
        r = int(np.searchsorted(self.upto, k, side="right"))
        return int(self.first[r]) + k - (int(self.upto[r - 1]) if r else 0)


class BoundarySet:
    """A set of offsets in containers of 65,536, each in its smallest form."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> _BITS
        at = np.flatnonzero(np.diff(high, prepend=-1))
        self.keys = high[at]
        self.upto = np.append(at[1:], len(offsets)) if len(at) else np.zeros(0, np.int64)
        self.containers = [self._container(offsets[a:b] & 0xFFFF) for a, b in zip(at, self.upto, strict=True)]

    @staticmethod
    def _container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
        starts = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        if 4 * len(starts) < min(2 * len(low), 8192):
            return RunContainer(low[starts], np.append(starts[1:], len(low)))
        return ArrayContainer(low) if len(low) <= ARRAY_MAX else BitmapContainer(low)

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def select(self, *ranks: int) -> list[int]:
        """The offsets with these ranks (from 0)."""
        out = []
        for k, c in zip(ranks, np.searchsorted(self.upto, ranks, side="right"), strict=True):
            inside = k - (int(self.upto[c - 1]) if c else 0)
            out.append((int(self.keys[c]) << _BITS) + self.containers[c].select(inside))
        return out


def boundaries(raw: bytes, unit: str = "token") -> BoundarySet:
    """Ends of the units of a UTF-8 text, as byte offsets."""
    if not raw:
        return BoundarySet(np.zeros(0, np.int64))
    buf = np.frombuffer(raw, np.uint8)
    if unit == "token":
        space = _SPACE[buf]
        ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    elif unit == "char":
        ends = np.flatnonzero((buf[1:] & 0xC0) != 0x80) + 1
    elif unit == "line":
        ends = np.flatnonzero(buf[:-1] == 0x0A) + 1
    else:
        raise ValueError(f"no unit {unit!r}: token, char or line")
    return BoundarySet(np.append(ends, len(raw)))


def rearrange(raw: bytes, key: str, seed: int = 42, fim_percent: int = 50, spm_percent: int = 80, unit: str = "token") -> tuple[int, str, int, int, bytes]:
    """(n units, form, prefix bytes, middle bytes, output) of one text."""
    places = boundaries(raw, unit)
    n = len(places)
    h = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(h[i : i + 4], "big") for i in (0, 4, 8, 12))
    if not raw or PREFIX in raw or SUFFIX in raw or MIDDLE in raw or h3 % 100 >= fim_percent:
        return n, "plain", 0, 0, raw
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, second = places.select(max(a - 1, 0), max(b - 1, 0))
    first, second = first if a else 0, second if b else 0
    prefix, middle, suffix = raw[:first], raw[first:second], raw[second:]
    if h4 % 100 < spm_percent:
        return n, "spm", first, second - first, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", first, second - first, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def restore(output: bytes, form: str) -> bytes:
    """The text that ``rearrange`` was given, from its output and form alone."""
    if form == "plain":
        return output
    head, middle = output.split(MIDDLE)
    if form == "psm":
        prefix, suffix = head[len(PREFIX) :].split(SUFFIX)
    else:
        suffix, prefix = head[len(SUFFIX) :].split(PREFIX)
    return prefix + middle + suffix


def _chars(raw: bytes) -> int:
    return len(raw) if raw.isascii() else len(raw.decode())


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, fim_percent: int = 50, spm_percent: int = 80,
    unit: str = "token", digests_only: bool = False,
) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256[,
    output]) of every row; the restored text is read back from the output."""
    ship(docs.sparkSession)
    sel = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_id"), F.col(text).cast("string").alias("_text"))
    kind = sel.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "_text"):
            n, forms, prefix, middle, out_hex, back_hex, outs = [], [], [], [], [], [], []
            for raw, k in zip(texts, part.column(1).to_pylist(), strict=True):
                units, form, p, m, out = rearrange(raw, k, seed, fim_percent, spm_percent, unit)
                n.append(units)
                forms.append(form)
                prefix.append(None if form == "plain" else _chars(raw[:p]))
                middle.append(None if form == "plain" else _chars(raw[p : p + m]))
                out_hex.append(hashlib.sha256(out).hexdigest())
                back_hex.append(hashlib.sha256(restore(out, form)).hexdigest())
                if not digests_only:
                    outs.append(out.decode())
            cols = [part.column(0), pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
            cols += [pa.array(out_hex, pa.string()), pa.array(back_hex, pa.string())]
            names = ["key", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
            if not digests_only:
                cols, names = [*cols, pa.array(outs, pa.string())], [*names, "output"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    extra = "" if digests_only else ", output string"
    schema = f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string{extra}"
    return sel.mapInArrow(run, schema).withColumnRenamed("key", key)
