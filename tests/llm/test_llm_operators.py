"""The operators against brute force, round trips and held-out accuracy, and their
results on nulls, empty and long texts, ties, repeats, empty tables and other columns."""

import base64
import collections
import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablight.llm import bpe, hmm, langid, licenses, llr_rules, packing, quality_pu, queries, topk
from tablight.llm.chat import escape, format_chat, loss_text, read_turns, text_part, unescape
from tablight.llm.jaccard import near_duplicates

WORDS = P.path("word_bpe_49k.json")
BYTES = P.path("byte_bpe_multi_50k.tiktoken")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# rows of every awkward kind; "key", "token", "bucket", "cid" clash with inner names
DIRTY = [
    (1, "the cat sat on the mat and the dog sat on the log"),
    (2, None),
    (3, ""),
    (4, " \t\n"),
    (1, "the cat sat on the mat and the dog sat on the log"),
    (None, "a text without an id"),
    (5, "été ça naïve 日本 ١٢ ²3 é x y <|endoftext|> don't 'S !!"),
    (6, "word " * 6000),
    (7, "42 --- 17"),
    (8, "two words"),
]


def dirty(spark, rows=DIRTY):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", F.lit("x").alias("key"), F.lit(0).alias("token"), F.lit(1).alias("bucket"), F.lit(2).alias("cid"), F.lit(3).alias("score"))


def words(t):
    return [w for w in (t or "").translate(LOW).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]


@pytest.fixture(scope="module")
def codec():
    return bpe.BpeCodec(bpe.BpeTables(bpe.load_ranks(BYTES)), P.PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTES, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60))
def test_bpe_equals_tiktoken(codec, reference, text):
    ids = codec.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_bpe_on_long_pieces(codec, reference):
    rng = random.Random(1)
    for alphabet in ("a", "ab", "thenon", "0", "é日"):
        text = "".join(rng.choice(alphabet) for _ in range(3000))
        assert codec.encode(text) == reference.encode_ordinary(text)


def test_bpe_rows(spark, reference):
    out = bpe.encode_documents(dirty(spark), BYTES, P.PATTERN)
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, list(r.ids), bytes(r.decoded).decode()) for r in out.collect())
    want = []
    for d, t in DIRTY:
        ids = reference.encode_ordinary(t or "")
        want.append((d or 0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), ids, t or ""))
    assert got == sorted(want)
    assert bpe.encode_documents(dirty(spark, []), BYTES, P.PATTERN).count() == 0


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=40))
def test_word_ids_equal_the_library(text):
    if not hasattr(test_word_ids_equal_the_library, "both"):
        tok = Tokenizer.from_file(WORDS)
        test_word_ids_equal_the_library.both = tok, packing.WordIds(open(WORDS, encoding="utf-8").read())
    tok, mine = test_word_ids_equal_the_library.both
    assert list(np.frombuffer(mine.ids(text.encode()), "<u4")) == tok.encode(text, add_special_tokens=False).ids


def test_added_tokens_get_the_ids_of_the_library():
    tok, mine = Tokenizer.from_file(WORDS), packing.WordIds(open(WORDS, encoding="utf-8").read())
    texts = ["end of doc <|endoftext|> next", "A<|endoftext|>B.", "<|ENDOFTEXT|> <|EndOfText|>", "<|startoftext|><|endoftext|>,", "<|a <| end|> <|endoftext|", "X<<|endoftext|>>!? Y", "It's <|endoftext|>'S <|Endoftext|>"]
    for text in [*texts, " ".join(texts), "\n".join(texts * 2)]:
        assert list(np.frombuffer(mine.ids(text.encode()), "<u4")) == tok.encode(text, add_special_tokens=False).ids
    assert 49407 in np.frombuffer(mine.ids(texts[0].encode()), "<u4") and 49407 not in np.frombuffer(mine.ids(texts[2].encode()), "<u4")


def test_many_texts_at_once_get_the_ids_of_the_library():
    tok, mine = Tokenizer.from_file(WORDS), packing.WordIds(open(WORDS, encoding="utf-8").read())
    rng = random.Random(3)
    alphabet = "abé.,;'-(1ßɐ一\u0301 \n\x0b\u0085<|Aİ"
    texts = ["", " ", "İ. x", "İstanbul, İ!", "a" + "." * 40, "." * 40 + " b", "\x0b\x0c a\tb\r\n", *("".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(3000))]
    for found, text in zip(mine.ids_of([t.encode() for t in texts]), texts, strict=True):
        assert list(np.frombuffer(found, "<u4")) == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_word_is_encoded_once_whatever_closes_it():
    mine = packing.WordIds(open(WORDS, encoding="utf-8").read())
    tok, sent = mine.tok, []

    class Counted:
        def encode_batch_fast(self, texts, **more):
            sent.extend(texts)
            return tok.encode_batch_fast(texts, **more)

    mine.tok = Counted()
    words = ["plain", "words", "été", "straße"]
    list(mine.ids_of([" ".join(w + e for w in words for e in ("", ".", ",", "?!")).encode()] * 50))
    assert sorted(" ".join(t for t in sent if t[0].isalpha()).split()) == sorted(words)  # blanks between them, nothing else
    sent.clear()
    list(mine.ids_of(["été, plain? words!".encode()]))
    assert not any(w in t for w in words for t in sent)  # only closings that are new


def test_packing_covers_every_id_once(spark):
    tok = Tokenizer.from_file(WORDS)
    rows = DIRTY + [(100 + i, "some more words here " * (i * 7 % 90 + 1)) for i in range(200)]
    out = packing.pack(dirty(spark, rows), WORDS).collect()
    want = collections.Counter()
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        for at in range(0, len(ids), 4096):
            part = ids[at : at + 4096]
            want[(d, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)), len(ids))] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == want
    at = collections.defaultdict(int)
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id]
        at[r.sequence_id] += r.length
    assert max(at.values()) <= 4096
    assert sum(4096 - n for n in at.values()) < 4096 + 0.02 * sum(at.values())
    assert packing.pack(dirty(spark, []), WORDS).count() == 0


def test_plan_meets_demand_within_the_bound():
    rng = np.random.default_rng(0)
    sizes, demand = np.unique(-(-np.clip(rng.lognormal(6, 1, 20_000).astype(int), 1, 4096) // 64), return_counts=True)
    plan = packing.plan_sequences(sizes, demand, 64)
    assert plan.n_sequences <= 1.01 * math.ceil((sizes * demand).sum() / 64) + len(sizes)
    value, pattern = packing.best_pattern(np.array([1.0, 2.1, 3.0]), np.array([3, 5, 8]), 13)
    assert (pattern @ [3, 5, 8], round(value, 6)) == (13, 5.2) or value >= 5.2


def test_chat_round_trip_parts_and_mask(spark):
    texts = ["\\### Assistant: </turn> ok", "<|end|>", "a\\<|b", "<\\|", "\\\\<\\\\|", "", None, "x<", "|y"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)] + [(1, 3, "assistant", "<|end|>"), (None, 0, "user", "no id"), (2, 0, None, "r")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    out = format_chat(df.withColumn("parts", text_part(F.col("text"))))
    got = {r.conv_id: r for r in out.select("conv_id", "n_turns", read_turns(F.col("formatted")).alias("t"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("l")).collect()}
    mine = sorted((r for r in rows if r[0] == 1), key=lambda r: (r[1], r[2], r[3] or ""))
    assert [(x.role, x.text) for x in got[1].t] == [(r[2], r[3] or "") for r in mine]
    assert got[1].l == "".join(r[3] or "" for r in mine if r[2] == "assistant")
    assert got[None].n_turns == 1 and got[2].t[0].role == ""
    assert format_chat(df.where("turn < 0").withColumn("parts", text_part(F.col("text")))).count() == 0


def test_chat_attachments(spark):
    kinds = [("text", "see <|image|>", None, 0), ("image", None, "a.png", 3), ("audio", None, "b.wav", 2), ("video", "other", "c", 1)]
    kind = "conv_id long, turn long, role string, parts array<struct<kind: string, text: string, ref: string, units: long>>"
    df = spark.createDataFrame([(0, 0, "user", kinds)], kind)
    r = format_chat(df).first()
    assert r.formatted == "<|turn|>user<|text|>see <\\|image|><|image|><|audio|>other<|end|>"
    assert [(a.place, a.kind, a.ref, a.tokens) for a in r.attachments] == [(0, "image", "a.png", 768), (1, "audio", "b.wav", 50)]
    assert r.attachment_tokens == 818 and r.loss_spans == []


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.text(alphabet="\\<|a", max_size=12), min_size=20, max_size=40))
def test_escape_is_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and "<|" not in r.e


@pytest.mark.parametrize("big", [False, True])
def test_top_k_equals_brute_force(spark, big):
    rng = np.random.default_rng(3)
    vecs = rng.normal(size=(300, 6)) * (1e6 if big else 1)  # big: products beyond 2^53
    vecs[40:120] = vecs[7]  # a group of copies: ties by id
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vecs)] + [(1000, None, 0), (1001, [1.0, None], 0), (1002, [float("nan")] * 6, 0), (1003, [float("inf")] * 6, 0), (1020, [0.5, 0.25], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = collections.defaultdict(list)
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    ok = {i: [math.floor(64 * x) for x in v] for i, v, _ in rows if v and all(x is not None and math.isfinite(x) for x in v)}
    want = {}
    for q in ok:
        if q % 20 == 0:
            s = [(-sum(a * b for a, b in zip(ok[q], v, strict=False)), i) for i, v in ok.items() if i != q]
            want[q] = [(i, -x) for x, i in sorted(s)[:20]]
    assert dict(got) == want
    assert topk.top_k(df.where("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_repeated_and_null_ids(spark):
    rows = [(20, [1.0, 0.0])] * 3 + [(None, [9.0, 9.0])] + [(i, [float(i), 1.0]) for i in range(1, 9)] + [(5, [5.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.rank, r.vec_id) for r in topk.top_k(df, F.col("vec_id") == 20, k=6).orderBy("rank").collect()]
    assert got == list(enumerate([8, 7, 6, 5, 5, 4], 1))
    with pytest.raises(TypeError):
        topk.top_k(df.withColumn("vec_id", F.col("vec_id").cast("string")), F.lit(True))


def brute_components(rows, width=5):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d if d is not None else -1), len(sets[i]), least.get(find(i), -1) if sets[i] else (d if d is not None else -1)) for i, (d, _) in enumerate(rows))


def test_jaccard_join_equals_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows, n = list(DIRTY), 100
    for _ in range(12):  # families whose members lie around the threshold
        base = [rng.choice(vocab) for _ in range(rng.choice([6, 30, 80]))] + (passage if rng.random() < 0.5 else [])
        for _ in range(rng.choice([1, 3, 15])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((n, " ".join(w) if rng.random() < 0.8 else " \n".join(w).upper()))
            n += 1
    out = near_duplicates(dirty(spark, rows))
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.n_shingles, (r.component_id if r.component_id is not None else -1)) for r in out.collect())
    assert got == brute_components(rows)
    assert near_duplicates(dirty(spark, [])).count() == 0


def test_hmm_base_and_likelihood(spark):
    rows = DIRTY + [(200 + i, f"the old cat {i} saw a dog.") for i in range(40)]
    train = {i for i, (d, _) in enumerate(rows) if d is None or d % 3}
    out = hmm.hmm_scores(dirty(spark, rows), F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True)), n_top=6, n_suffix=16)
    got = sorted((r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out.collect())
    count = collections.Counter(x for i in train for x in [*words(rows[i][1]), "\n"])
    total, distinct = sum(count.values()), len(count)
    want = []
    for d, t in rows:
        toks = [*words(t), "\n"]
        base = sum(math.log10((count[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in toks)
        want.append((d or 0, len(toks), sum(count[x] > 0 for x in toks), total, round(base, 6)))
    assert got == sorted(want)
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in out.collect())
    assert hmm.hmm_scores(dirty(spark, []), F.lit(True)).count() == 0
    assert {r.score for r in hmm.hmm_scores(dirty(spark), F.lit(False)).collect()} == {0.0}


def test_forward_and_counts_equal_path_sums():
    p = hmm.random_params(3, np.full(4, 0.25), seed=1)
    p.move = np.random.default_rng(2).dirichlet(np.ones(3), 3)
    seqs = [[0, 1, 2, 3, 1], [2, 2], [3]]
    cls, sizes = np.concatenate(seqs), np.array([len(s) for s in seqs])

    def prob(s):
        a = p.start * p.emit[:, s[0]]
        for x in s[1:]:
            a = (a @ p.move) * p.emit[:, x]
        return math.log10(a.sum())

    assert np.allclose(hmm.forward(cls, sizes, p), [prob(s) for s in seqs])
    n = hmm.expected_counts(cls, np.cumsum(sizes) - sizes, sizes, p)
    assert np.isclose(n.start.sum(), 3) and np.isclose(n.move.sum(), 5, atol=1e-4) and np.allclose(n.emit.sum(axis=0), np.bincount(cls), atol=1e-4)
    before = hmm.forward(cls, sizes, p).sum()
    better = hmm.Params(n.start / n.start.sum(), n.move / n.move.sum(axis=1, keepdims=True), n.emit / n.emit.sum(axis=1, keepdims=True))
    assert hmm.forward(cls, sizes, better).sum() > before


def test_every_round_counts_all_training_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    train = F.col("doc_id") % 5 != 1
    coded = hmm.code_texts(docs, "doc_id", "text", train, 64, 400_000)
    classes = hmm.learn_classes(hmm.token_counts(coded), 500, 64)
    parts = [hmm._train_part(r.asDict(), classes) for r in coded.collect()]
    assert len(parts) > 3
    cls, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
    assert np.array_equal(classes.counts, np.bincount(cls, minlength=classes.size))
    begin, ln = hmm.segments(cls, sizes, hmm.SEGMENT)
    unigram = (classes.counts + 0.01) / (classes.total + 0.01 * classes.size)
    want = hmm.random_params(4, unigram)
    for _ in range(3):
        want = hmm.re_estimate(hmm.expected_counts(cls, begin, ln, want), unigram)
    got = hmm.fit_hmm(coded, classes, 4, 3)
    assert np.allclose(got.start, want.start, atol=1e-3) and np.allclose(got.move, want.move, atol=1e-3) and np.allclose(got.emit, want.emit, rtol=0.02, atol=1e-6)
    # without a number of rounds it goes on until the likelihood of all texts settles
    last = hmm.fit_hmm(coded, classes, 4)
    n = hmm.expected_counts(cls, begin, ln, last)
    more = hmm.expected_counts(cls, begin, ln, hmm.re_estimate(n, unigram))
    assert n.loglik > hmm.expected_counts(cls, begin, ln, got).loglik and more.loglik - n.loglik <= 5 * hmm.SETTLED * abs(n.loglik)


def test_hmm_beats_its_base_on_held_out_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    r = hmm.hmm_scores(docs, F.col("doc_id") % 5 != 1).where("not trained").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    print("held-out log10 per token:", r[0] / r[2], "base:", r[1] / r[2])
    assert r[0] > r[1] + 0.1 * r[2]


def test_language_filter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = F.col("doc_id") % 4 == 2
    model = langid.fit_language_filter(docs.where(~held))
    right = langid.predict_language(docs.where(held), model, ["doc_id", "lang"]).where("lang = lang_pred").count()
    assert right >= 0.97 * docs.where(held).count()
    odd = {r.doc_id: r for r in langid.predict_language(dirty(spark), model, ["doc_id"]).collect()}
    assert odd[2].lang_pred == odd[3].lang_pred == odd[7].lang_pred == "und" and odd[7].score == 0
    assert langid.fit_language_filter(docs.where("doc_id < 0")) is None
    none = langid.predict_language(dirty(spark), None, ["doc_id"]).collect()
    assert len(none) == len(DIRTY) and {r.lang_pred for r in none} == {"und"}
    hits = model.masks(np.array([1, 2, 3], np.uint64))  # n-grams of no language: nearly no false positives
    assert hits.shape == (1, 3)


def test_quality_on_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = quality_pu.fit_quality(docs, labels, ~held)
    assert 0.6 < model.prior < 0.98
    out = quality_pu.score_quality(docs.where(held), model, ["doc_id"]).join(labels, "doc_id").toPandas()
    assert (out["predicted"] == out["quality"]).mean() >= 0.95
    odd = quality_pu.score_quality(dirty(spark), model, ["doc_id"]).collect()
    assert len(odd) == len(DIRTY) and all(0 <= r.score <= 1 for r in odd)
    assert quality_pu.fit_quality(docs, labels.where("quality = 7"), ~held) is None
    assert {r.predicted for r in quality_pu.score_quality(dirty(spark), None, ["doc_id"]).collect()} == {0}


def test_rules_equal_python(spark):
    rng = random.Random(9)
    rows = DIRTY + [(300 + i, "\n".join(" ".join(rng.choice(["a", "b", "c#", "d"]) for _ in range(rng.randrange(9))) for _ in range(rng.randrange(12)))) for i in range(60)]
    out = llr_rules.quality_rules(dirty(spark, rows), F.lit(True)).collect()
    want = []
    for d, t in rows:
        t = t or ""
        w = [x for x in t.replace("\t", " ").replace("\n", " ").split(" ") if x]
        lines = [x for x in t.split("\n") if x.strip(" \t\x0b\x0c\r")]
        grams = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        rep = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        want.append((d or 0, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w)))
    assert sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out) == sorted(want)
    assert not any(r.kept and r.base_failed for r in out)
    assert llr_rules.quality_rules(dirty(spark, []), F.lit(True)).count() == 0


@pytest.mark.parametrize("n, buckets", [(1, 64), (2, 64), (2, 1 << 17)])
def test_kept_equals_a_plain_log_ratio(spark, n, buckets):
    rng = random.Random(n + buckets)
    rows = [*DIRTY, *DIRTY[:2]]
    for i in range(80):
        pool = [f"{'good' if i % 3 else 'spam'}{rng.randrange(40)}" for _ in range(30)] + ["the", "of", "\u00e9t\u00e9"]
        rows.append((400 + i, " ".join(rng.choice(pool) for _ in range(rng.randrange(40, 120))) + rng.choice(["", " ", "\n"])))
    trusted = F.coalesce((F.col("doc_id") >= 400) & (F.pmod("doc_id", F.lit(3)) != 400 % 3), F.lit(False))

    def grams(text):
        w = [x.encode() for x in re.split("[ \t\n\x0b\x0c\r]+", text or "") if x]
        found = [xxhash.xxh64_intdigest(a, seed=42) for a in w]
        if n == 2:
            found += [xxhash.xxh64_intdigest(b, seed=xxhash.xxh64_intdigest(a, seed=42)) for a, b in zip(w, w[1:], strict=False)]
        return [(h - (1 << 64) if h >> 63 else h) % buckets for h in found]

    raw, target = collections.Counter(), collections.Counter()
    for d, t in rows:
        raw.update(grams(t))
        if d is not None and d >= 400 and d % 3 != 400 % 3:
            target.update(grams(t))
    share = target.total() / raw.total()
    weight = {b: math.log((target[b] + 10) / (raw[b] * share + 10)) for b in raw}
    want = []
    for d, t in rows:
        g = grams(t)
        want.append((d or 0, round(sum(weight[b] for b in g) / len(g), 9) if g else 0.0))
    out = llr_rules.quality_rules(dirty(spark, rows), trusted, n=n, n_buckets=buckets).collect()
    assert sorted((r.doc_id or 0, round(r.llr, 9)) for r in out) == sorted(want)
    assert all(r.kept == (not r.base_failed and r.llr >= llr_rules.THRESHOLD) for r in out)
    assert buckets == 64 or {r.kept for r in out if not r.base_failed} == {True, False}


def test_license_rules(spark):
    t = licenses.TEXTS
    rows = [
        *DIRTY,
        (20, "Intro.\nLicensed under the Apache License, Version 2.0.\nMore text."),
        (21, f"{t['bsd-permit'].capitalize()}:\n{t['bsd-source']}.\n{t['bsd-binary']}.\n{t['bsd-name']}."),
        (22, f"{t['bsd-permit']}:\n{t['bsd-source']}.\n{t['bsd-binary']}."),
        (23, "This work is licensed under the GNU General\nPublic License, version 3. All rights reserved."),
        (24, "Released under the MIT Licence."),
        (25, "It is not licensed to anyone under any software."),
    ]
    got = collections.defaultdict(list)
    for r in licenses.scan_licenses(dirty(spark, rows)).collect():
        got[r.doc_id].append(",".join(r.licenses))
    assert [got[i] for i in range(20, 26)] == [["Apache-2.0"], ["BSD-3-Clause"], ["BSD-2-Clause"], ["GPL-3.0,NOASSERTION"], ["MIT"], [""]]
    assert got[1] == ["", ""] and got[2] == got[None] == [""]
    assert licenses.scan_licenses(dirty(spark, [])).count() == 0


def test_pipeline_equals_its_operators(spark, sf_dir):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one = cp.language_id(spark, docs, sf_dir)
    assert one.columns == docs.columns and one.count() >= 0.99 * docs.count()
    two = cp.quality_classifier(spark, one, sf_dir)
    kept = {r.doc_id for r in two.select("doc_id").collect()}
    bad = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    good = set(bad.loc[bad["quality"] == 1, "doc_id"])
    assert len(good & kept) >= 0.97 * len(good) and len(set(bad.loc[bad["quality"] == 0, "doc_id"]) & kept) <= 0.05 * (len(bad) - len(good))
    rows = [(r.doc_id, r.text) for r in two.select("doc_id", "text").collect()]
    three = cp.near_duplicate_join(spark, two, sf_dir)
    assert three.columns == docs.columns
    four = cp.packing(spark, three, sf_dir)
    assert {r.doc_id for r in four.select("doc_id").distinct().collect()} == {r.doc_id for r in three.select("doc_id").collect()} <= {d for d, _ in rows}


def test_one_row_of_a_near_duplicate_group_stays(spark, sf_dir):
    import corpus_pipeline as cp

    def text(name, *ends):
        return [" ".join([f"{name}{i}" for i in range(60)] + [end]) for end in ends]

    (a,), (b, b1), (c, c1), (d, d1, d2), (e,), (f,) = text("a", "x"), text("b", "x", "y"), text("c", "x", "y"), text("d", "x", "y", "z"), text("e", "x"), text("f", "x")
    rows = [(5, a), (5, b), (3, b1), (7, c1), (7, c), (None, d), (None, d1), (9, d2), (None, e), (None, e), (11, f), (11, f), (None, None)]
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, _row long").withColumn("a.b", F.lit(1))
    out = cp.near_duplicate_join(spark, df.repartition(4), sf_dir)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == sorted([(5, a), (3, b1), (7, c), (9, d2), (0, e), (11, f), (0, "")])


def test_linked_sets_share_the_prefix_tokens_that_the_bound_asks_for():
    from tablight.llm.jaccard import DEN, NUM, needed

    rng = np.random.default_rng(9)
    linked = tight = 0
    for _ in range(4000):
        n = int(rng.integers(1, 60))
        m = int(rng.integers(-(-NUM * n // DEN), DEN * n // NUM + 1))
        both = max(0, min(n, m) - int(rng.integers(0, 1 + n // 6)))
        if DEN * both < NUM * (n + m - both):
            continue
        linked += 1
        order = rng.permutation(n + m - both)
        x, y = np.sort(order[:n]), np.sort(np.r_[order[:both], order[n:]])
        prefixes = [set(s[: len(s) - -(-NUM * len(s) // DEN) + 1].tolist()) for s in (x, y)]
        shared = len(prefixes[0] & prefixes[1])
        spread = int(rng.integers(0, 4))
        for a, b in ((n, m), (m, n)):
            least = int(needed(np.array([a]), max(1, b - spread), b + spread)[0])
            assert 1 <= least <= shared
            tight += least == shared
    assert linked > 500 and tight > 50


def test_trusted_documents_are_merge_joined_at_every_size(spark, sf_dir):
    """A broadcast of the labels at small sizes would hide the shuffle of the texts."""
    docs = queries.trusted_documents(spark, sf_dir)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    assert {r.doc_id for r in docs.where("_good").select("doc_id").collect()} == good & {r.doc_id for r in docs.select("doc_id").collect()}
    assert docs.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
