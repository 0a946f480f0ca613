"""Fill-in-the-middle, prefix BPE and collocations against brute force and the
tokenizer library, with their results on awkward rows."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablight.llm import fim
from tablight.llm.bpe_prefix import PrefixCodec, PrefixTables, prefix_encode
from tablight.llm.collocations import collocations, score

VOCAB = P.path("byte_bpe_50k.json")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = [
    (1, "the cat sat on the mat and the dog sat on the log"),
    (2, None),
    (3, ""),
    (4, " \t\n"),
    (1, "the cat sat on the mat and the dog sat on the log"),
    (None, "a text without an id"),
    (5, "\u00e9t\u00e9 \u00e7a na\u00efve \u65e5\u672c \u0661\u0662 \u00b23 x\u00a0 y\u3000<|endoftext|> don't 'S !!  "),
    (6, "word " * 30000),
    (7, "with a <P> inside"),
    (8, "\n\nNot <M> so, <S>.\n"),
    (9, "caf\u00e9\u0301 \U0001f600 \x1c\x85 end"),
]
TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def frame(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.lit(7).alias(c) for c in ("key", "n", "form", "_key", "block", "word", "w", "rank", "output")])


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def fim_by_hand(key, text):
    text = text or ""
    units = TOKEN.findall(text)
    n = len(units)
    h = sha(f"42:{'' if key is None else key}")
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (key, n, "plain", None, None, sha(text), sha(text))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (key, n, form, len(p), len(m), sha(out), sha(text))


@pytest.mark.parametrize("kind", ["sparse", "dense", "runs", "mixed"])
def test_boundary_set_selects_as_a_sorted_list(kind):
    rng = np.random.default_rng(5)
    dense = np.flatnonzero(rng.random(200_000) < 0.3)
    picks = {
        "sparse": np.unique(rng.integers(0, 900_000, 900)),
        "dense": dense,
        "runs": np.arange(10, 180_000),
        "mixed": np.concatenate([dense, 300_000 + np.arange(70_000), 500_000 + np.unique(rng.integers(0, 90_000, 50))]),
    }[kind]
    held = fim.BoundarySet(picks)
    assert len(held) == len(picks)
    ranks = sorted({0, len(picks) - 1, *rng.integers(0, len(picks), 500).tolist()})
    assert held.select(*ranks) == picks[ranks].tolist()
    names = {type(c).__name__ for c in held.containers}
    assert {"sparse": {"ArrayContainer"}, "dense": {"BitmapContainer"}, "runs": {"RunContainer"}}.get(kind, names) <= names
    assert len(fim.BoundarySet(np.zeros(0, np.int64))) == 0


def test_fim_equals_a_plain_version(spark):
    rows = ROWS + [(i, " x".join(str(j) for j in range(i % 40)) + " " * (i % 3)) for i in range(100, 400)]
    got = fim.fill_in_middle(frame(spark, rows)).drop("output").collect()
    want = [fim_by_hand(k, t) for k, t in rows]
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(frame(spark, []), digests_only=True).count() == 0


@pytest.mark.parametrize("unit", ["char", "line"])
def test_fim_units_cut_between_characters_and_read_back(unit):
    text = "z\u00e9ro \U0001f600\nun\n\ndeux " * 9000
    whole = list(text) if unit == "char" else text.splitlines(keepends=True)
    forms = set()
    for k in range(30):
        n, form, p, m, out = fim.rearrange(text.encode(), str(k), fim_percent=100, unit=unit)
        assert n == len(whole) and fim.restore(out, form).decode() == text
        h = hashlib.sha256(f"42:{k}".encode()).digest()
        a, b = sorted(int.from_bytes(h[i : i + 4], "big") % (n + 1) for i in (0, 4))
        assert text.encode()[:p].decode() == "".join(whole[:a]) and text.encode()[p : p + m].decode() == "".join(whole[a:b])
        forms.add(form)
    assert forms == {"psm", "spm"}


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCAB)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def codec():
    with open(VOCAB, encoding="utf-8") as f:
        return PrefixCodec(PrefixTables(f.read()))


def test_prefix_bpe_equals_the_library_on_random_texts(codec, library):
    rng = random.Random(3)
    some = "aAbB e\u00e9\u65e5\u3000 \t\n\r\x1c\x85 '\u2019s't12\u00b2\u00bd.!!##<|endoftext|>\U0001f600\u0301\u2003\u180e"
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["a" * 3000, " " * 700, "the" * 999, "<|endoftext|><|endoftext|> x", "".join(map(chr, range(0x20, 0xD800, 3)))]
    texts += ["".join(chr(rng.randrange(0xE000, 0x110000)) for _ in range(5000))]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        mine, back = codec.encode(text.encode())
        assert np.frombuffer(mine, "<u4").tolist() == ids
        assert back.decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False) == text


def test_each_prefix_stores_the_last_token_of_its_own_encoding(codec):
    for piece in (b" unbelievably", b" internationalization", b"aaaaaaaaaaaaaaa", b"===========------"):
        last = codec.last_tokens(piece.decode("latin-1").translate(codec.alphabet))
        for n in range(1, len(piece) + 1):
            assert last[n][0] == codec.ids_of(piece[:n])[-1]


def test_prefix_bpe_of_awkward_rows(spark, library):
    got = prefix_encode(frame(spark), VOCAB).collect()
    want = []
    for key, text in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((key, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(back), tuple(ids), back))
    assert collections.Counter((*r[:4], tuple(r["ids"]), r["decoded"]) for r in got) == collections.Counter(want)
    assert prefix_encode(frame(spark, []), VOCAB, digests_only=True).count() == 0


def phrases_by_hand(rows, min_count, max_words, limit):
    n, f = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            w = tuple(x for x in re.split("[ \t]+", piece) if x)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f.update((lang, w[i : i + k]) for i in range(len(w) - k + 1))
    cand = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= min_count}
    covered = {
        (lang, w[i : i + k]) for (lang, w), c in cand.items() for k in range(2, len(w)) for i in range(len(w) - k + 1)
        if 100 * c >= 100 * cand[lang, w[i : i + k]]
    }
    out = collections.defaultdict(list)
    for (lang, w), a in cand.items():
        if (lang, w) not in covered:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            s, k = min(cuts)
            out[lang].append((-s, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {
        (lang, i + 1, p.decode(), -a, l, r, n[lang], -s)
        for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:limit])
    }


def phrase_rows(seed=1):
    rng = random.Random(seed)
    words = ["a", "b", "C", "\u00c9", "dd", "e", "f"]
    rows = [(" ".join(rng.choice(words[: rng.randrange(2, 8)]) for _ in range(rng.randrange(30))), rng.choice(["en", "fr", None])) for _ in range(300)]
    rows += [("the very same line, of some words; it repeats", "en")] * 40  # copies, one covered phrase after another
    rows += [(None, "en"), ("", "de"), (" \t.\n", "de"), ("a", "de"), ("x" * 400 + " y " + "x" * 400 + " y", "en"), ("tab\tand  blanks\x0bsplit " * 30, "fr")]
    return rows


@pytest.mark.parametrize("dictionary, pairs", [(500_000, 4_000_000), (500_000, 3), (4, 4_000_000), (0, 4_000_000)])
def test_collocations_equal_brute_force(spark, dictionary, pairs, monkeypatch):
    monkeypatch.setattr("tablight.llm.collocations.PAIRS", pairs)
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(7).withColumn("w", F.lit(1)).withColumn("n", F.lit(2)).withColumn("block", F.lit(3))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that phrases and their parts lie in different partitions
    try:
        got = collocations(docs, min_count=3, limit=60, dictionary=dictionary).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    want = phrases_by_hand(rows, 3, 5, 60)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert any(r["phrase"] == "the very same line" for r in got)


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations(empty).count() == 0
    assert collocations(spark.createDataFrame([("a b", None), (None, None)], "text string, lang string")).count() == 0


def test_scores_are_exact_beyond_64_bits():
    a, total = 10**12 + 7, 10**14 + 3
    assert score((1, 2), a, total, [a], [a + 1])[0] == 1000 * a * total // (a * (a + 1))
    # equal scores after flooring: the shortest first part
    assert score((1, 2, 3), 10, 20, [10, 10], [10, 10]) == (2000, 10, 10)
