"""Exact n-gram Jaccard join with a token-group matrix.

Tokens are the distinct ``width``-word shingles of a text, as 64-bit hashes. Texts
with equal token sets are one class; classes are nodes, texts only members.

1. *Groups.* Classes with an equal min-hash pair (``KEYS`` pairs) are likely
   similar. Each is compared with a leader of its bucket (smallest class, found
   per salt and then per bucket), not with every other: links are linear in the
   bucket. Linked classes form components.
2. *Token-group matrix.* A class's prefix is its |x| - ceil(t |x|) + 1 first tokens
   in a global order, rare tokens first; two classes with Jaccard >= t share a
   prefix token. Tokens of one component only are dropped. Classes, linked or
   not, are cut into groups of about ``GROUP`` similar ones (by their component's most
   frequent token and by size). The matrix holds one row (token, group) with the
   group's classes that have the token: thousands of similar texts add a
   token once per group.
3. *Bound and open.* Two groups meet if they share a prefix token and their sizes
   allow a link. The prefix tokens that a class shares with the other group's union
   bound those it shares with any member; classes below what a link needs
   (``needed``) are left out before texts are fetched. Then the overlap of all tokens
   of a class with the other group's union bounds its overlap with every member;
   only classes whose bound reaches ceil(t |x|) tokens are compared, and of each only
   one link to a component is kept.

Components of the links are the result: no pair within a component is ever
listed. The order (rare first) comes from a table of ``SLOTS`` hashed document
frequencies, counted over all texts and of fixed size; it decides cost only, any
fixed order gives the same links.

Defined results. Null or blank text: no tokens, its own component. Fewer than
``width`` words: the whole sequence is the one token. Null ids: the row is
returned, and counts as member; a component id is the smallest non-null id. Rows
repeating an id are members each. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablight.functions.components import connected_components

from .common import chunks, materialise, release, ship
from .wordhash import mix, shingles, words

WIDTH, NUM, DEN = 5, 75, 100  # 100 * |intersection| >= 75 * |union|
KEYS, SKETCH, LIKELY = 8, 64, 0.55
SLOTS, SHARDS = 1 << 24, 64
GROUP, QUERIES, SALTS = 32, 128, 32
COLUMNS = 1 << 14
_U = np.uint64
_SEEDS = mix(np.arange(1, 2 * KEYS + 1, dtype=_U))


def token_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, starts, tokens): the sorted distinct tokens of each text."""
    doc, h = shingles(words(texts), width)
    sizes = np.bincount(doc, minlength=len(texts)).astype(np.int64)
    return sizes, np.cumsum(sizes) - sizes, h


def class_ids(sizes: np.ndarray, starts: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One 64-bit id per token set (0 for the empty set), from two sums of mixed tokens."""
    a, b = np.zeros(len(sizes), _U), np.zeros(len(sizes), _U)
    full = sizes > 0
    if full.any():
        a[full] = np.add.reduceat(mix(h ^ _U(0x2545F4914F6CDD1D)), starts[full])
        b[full] = np.add.reduceat(mix(h + _U(0x369DEA0F31A53F85)), starts[full])
    return np.where(full, mix(a ^ mix(b + sizes.astype(_U))) | _U(1), _U(0)).view(np.int64)


def _min_hashes(sizes: np.ndarray, starts: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: KEYS keys (pairs of min-hashes) and a sketch of SKETCH bytes
    (one permutation, least byte of each bin's minimum)."""
    n = len(sizes)
    keys, sketch = np.zeros((n, KEYS), _U), np.zeros((n, SKETCH), np.uint8)
    full = np.flatnonzero(sizes)
    if not len(full):
        return keys.view(np.int64), sketch
    at = starts[full]
    for k in range(KEYS):
        one = np.minimum.reduceat(mix(h + _SEEDS[2 * k]), at)
        two = np.minimum.reduceat(mix(h + _SEEDS[2 * k + 1]), at)
        keys[full, k] = mix(one ^ mix(two + _U(k)))
    r = mix(h ^ _U(0xC2B2AE3D27D4EB4F))
    doc = np.repeat(np.arange(n), sizes)
    least = np.full(n * SKETCH, np.iinfo(np.uint64).max, _U)
    np.minimum.at(least, doc * SKETCH + (r % _U(SKETCH)).astype(np.int64), r)
    sketch = ((least >> _U(20)) & _U(0xFF)).astype(np.uint8).reshape(n, SKETCH)
    return keys.view(np.int64), sketch


def describe(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """kind 0: (key, cid, n, keys, blob = sketch) per row; kind 1: one shard
    (cid = number) of this task's token counts by slot, in blob."""
    sel = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("_text"))
    ktype = sel.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        slots, kind = np.zeros(SLOTS, np.uint8), None
        for part, texts in chunks(batches, "_text"):
            sizes, starts, h = token_sets(texts, width)
            cid = class_ids(sizes, starts, h)
            keys, sketch = _min_hashes(sizes, starts, h)
            new = np.array([c not in seen for c in cid.tolist()], bool)
            seen.update(cid.tolist())
            u, c = np.unique((h[np.repeat(new, sizes)] >> _U(40)).astype(np.int64), return_counts=True)
            slots[u] = np.minimum(slots[u].astype(np.int64) + c, 255)
            kind = part.column(0).type
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(cid), np.int32)), part.column(0), pa.array(cid), pa.array(sizes), pa.array(list(keys), pa.list_(pa.int64())), pa.array([s.tobytes() for s in sketch], pa.binary())],
                names=["kind", "key", "cid", "n", "keys", "blob"],
            )
        if kind is not None:
            wide = SLOTS // SHARDS
            used = [i for i in range(SHARDS) if slots[i * wide : (i + 1) * wide].any()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ones(len(used), np.int32)),
                    pa.nulls(len(used), kind),
                    pa.array(np.array(used, np.int64)),
                    pa.nulls(len(used), pa.int64()),
                    pa.nulls(len(used), pa.list_(pa.int64())),
                    pa.array([zlib.compress(slots[i * wide : (i + 1) * wide].tobytes(), 1) for i in used], pa.binary()),
                ],
                names=["kind", "key", "cid", "n", "keys", "blob"],
            )

    return materialise(sel.mapInArrow(run, f"kind int, key {ktype}, cid long, n long, keys array<long>, blob binary"), "jaccard-rows")


def rarity(rows: DataFrame) -> np.ndarray:
    """Level of each slot (SLOTS bytes): eight steps per doubling of its count."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = SLOTS // SHARDS
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for s, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums.setdefault(s, np.zeros(wide, np.int64))
                sums[s] += np.frombuffer(zlib.decompress(blob), np.uint8)
        for s, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([s]), pa.array([zlib.compress(np.minimum(8 * np.log2(1.0 + v), 255).astype(np.uint8).tobytes(), 1)], pa.binary())], names=["shard", "blob"])

    level = np.zeros(SLOTS, np.uint8)
    wide = SLOTS // SHARDS
    shards = rows.where("kind = 1").select("cid", "blob").repartition("cid").mapInArrow(add, "shard long, blob binary")
    for r in shards.toLocalIterator():
        level[r["shard"] * wide : (r["shard"] + 1) * wide] = np.frombuffer(zlib.decompress(r["blob"]), np.uint8)
    return level


def likely_pairs(classes: DataFrame) -> DataFrame:
    """(a, b): class and leader of a shared bucket whose sketches look similar: the
    leader of the class's salt, and of a salt's leader the bucket's."""
    rows = classes.select("cid", F.posexplode("keys").alias("place", "k")).withColumn("salt", F.pmod(F.xxhash64("cid"), F.lit(SALTS)))
    # another order for each key, so that a class in several buckets meets several leaders
    first = rows.groupBy("k", "salt").agg(F.min(F.struct(F.xxhash64("cid", "place").alias("h"), "cid")).alias("best"))
    first = first.select("k", "salt", F.col("best.cid").alias("lead"), F.col("best.h").alias("h"))
    near = rows.join(first, ["k", "salt"]).where("cid != lead").select(F.col("cid").alias("a"), F.col("lead").alias("b"))
    best = first.groupBy("k").agg(F.min_by("lead", F.struct("h", "lead")).alias("b"))
    far = first.join(best, "k").where("lead != b").select(F.col("lead").alias("a"), "b")
    pairs = near.unionByName(far).distinct()
    sk = classes.select("cid", "blob")
    both = pairs.join(sk.select(F.col("cid").alias("a"), F.col("blob").alias("x")), "a").join(sk.select(F.col("cid").alias("b"), F.col("blob").alias("y")), "b")

    @F.pandas_udf("double")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        p = np.frombuffer(b"".join(x), np.uint8).reshape(-1, SKETCH)
        q = np.frombuffer(b"".join(y), np.uint8).reshape(-1, SKETCH)
        return pd.Series((p == q).mean(axis=1))

    return both.where(alike("x", "y") >= LIKELY).select("a", "b")


def prefix_tokens(docs: DataFrame, text: str, width: int, level: np.ndarray) -> DataFrame:
    """(token, cid): prefix tokens of each class, once per task."""
    table = docs.sparkSession.sparkContext.broadcast(level)  # SLOTS bytes, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, texts in chunks(batches, "_text"):
            sizes, starts, h = token_sets(texts, width)
            cid = class_ids(sizes, starts, h)
            new = np.array([c not in seen and c != 0 for c in cid.tolist()], bool)
            new[new] = np.isin(np.flatnonzero(new), np.unique(cid, return_index=True)[1])
            seen.update(cid.tolist())
            take = np.repeat(new, sizes)
            doc, tok = np.repeat(np.arange(len(sizes)), sizes)[take], h[take]
            order = np.lexsort((tok, table.value[(tok >> _U(40)).astype(np.int64)], doc))
            doc, tok = doc[order], tok[order]
            per = np.where(new, sizes, 0)
            place = np.arange(len(doc)) - (np.cumsum(per) - per)[doc]
            ok = place < sizes[doc] - -(-NUM * sizes[doc] // DEN) + 1
            yield pa.RecordBatch.from_arrays([pa.array(tok[ok].view(np.int64)), pa.array(cid[doc[ok]])], names=["token", "cid"])

    return docs.select(F.col(text).cast("string").alias("_text")).mapInArrow(run, "token long, cid long")


def shared_tokens(prefixes: DataFrame) -> DataFrame:
    """(token, cid) of the tokens that occur in two classes or more. Streams over
    sorted partitions, so a token's rows never have to fit in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_t = last_c = None
        shown = True  # the last row was written
        for b in batches:
            t, c = b.column(0).to_numpy(), b.column(1).to_numpy()
            if not len(t):
                continue
            if last_t is not None:
                t, c = np.concatenate([[last_t], t]), np.concatenate([[last_c], c])
            fresh = np.ones(len(t), bool)
            fresh[1:] = (t[1:] != t[:-1]) | (c[1:] != c[:-1])
            first_shown = shown and last_t is not None
            t, c = t[fresh], c[fresh]
            same = t[1:] == t[:-1]
            multi = np.zeros(len(t), bool)
            multi[1:] |= same
            multi[:-1] |= same
            out = multi.copy()
            if first_shown:
                out[0] = False
                multi[0] = True
            last_t, last_c, shown = t[-1], c[-1], bool(multi[-1])
            yield pa.RecordBatch.from_arrays([pa.array(t[out]), pa.array(c[out])], names=["token", "cid"])

    return prefixes.repartition("token").sortWithinPartitions("token", "cid").mapInArrow(run, "token long, cid long")


def _tokens_of(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The token set of each text, some 2 MB of text at a time."""
    found: list[np.ndarray] = []
    ends = np.cumsum([len(t) + 1 for t in texts]) // 2_000_000
    for run in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends)) + 1):
        sizes, starts, h = token_sets([texts[i] for i in run], width)
        found += [h[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
    return found


def _side(sets: list[np.ndarray], common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set number, place in ``common``) of the tokens that are in ``common``."""
    doc, tok = np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.concatenate(sets)
    at = np.minimum(np.searchsorted(common, tok), len(common) - 1)
    hit = common[at] == tok
    return doc[hit], at[hit]


def linked_pairs(left: list[np.ndarray], right: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the linked token sets of a query group and a member group.

    The token-group matrix bounds first: a set goes on only if it shares
    ceil(t |x|) tokens with the union of the other group. What is left is
    multiplied out, ``COLUMNS`` tokens at a time."""
    none = np.zeros(0, np.int64)
    common = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    if not len(common):
        return none, none
    sides, counts, kept = [], [], []
    for sets in (left, right):
        doc, at = _side(sets, common)
        n = np.array([len(x) for x in sets], np.int64)
        keep = np.bincount(doc, minlength=len(sets)) >= -(-NUM * n // DEN)
        if not keep.any():
            return none, none
        place = np.cumsum(keep) - 1
        ok = keep[doc]
        sides.append((place[doc[ok]], at[ok]))
        counts.append(n[keep])
        kept.append(np.flatnonzero(keep))
    both = np.zeros((len(kept[0]), len(kept[1])), np.float32)  # counts below 2^24 are exact
    for lo in range(0, len(common), COLUMNS):
        part = []
        for (doc, at), k in zip(sides, kept, strict=True):
            here = (at >= lo) & (at < lo + COLUMNS)
            m = np.zeros((len(k), min(COLUMNS, len(common) - lo)), np.float32)
            m[doc[here], at[here] - lo] = 1
            part.append(m)
        both += part[0] @ part[1].T
    shared = both.astype(np.int64)
    i, j = np.nonzero(DEN * shared >= NUM * (counts[0][:, None] + counts[1][None, :] - shared))
    return kept[0][i], kept[1][j]


def open_groups(queries: DataFrame, members: DataFrame, width: int, tasks: int) -> DataFrame:
    """queries and members (grp, part, cid, comp, text) of the same (grp, part)
    -> links (a, b) between different components: of each query, one to each
    component. Groups are dealt to ``tasks`` tasks, each reads a text once."""

    def meet(q: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        if len(q) and len(m):
            m.columns = q.columns
            every = pd.concat([q[["cid", "text"]], m[["cid", "text"]]]).drop_duplicates("cid")
            sets = dict(zip(every["cid"], _tokens_of([t.encode() for t in every["text"]], width), strict=True))
            right = dict(iter(m.groupby(["grp", "part"])))
            for at, x in q.groupby(["grp", "part"]):
                y = right.get(at)
                if y is None:
                    continue
                xc, yc, xo, yo = x["cid"].to_numpy(), y["cid"].to_numpy(), x["comp"].to_numpy(), y["comp"].to_numpy()
                i, j = linked_pairs([sets[c] for c in xc], [sets[c] for c in yc])
                other = xo[i] != yo[j]
                first = {(a, c): (a, b) for a, b, c in zip(xc[i[other]].tolist(), yc[j[other]].tolist(), yo[j[other]].tolist(), strict=True)}
                out += first.values()
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    task = F.pmod(F.xxhash64("grp", "part"), F.lit(max(1, tasks))).alias("task")
    left = queries.select("grp", "part", "cid", "comp", "text", task)
    right = members.select("grp", "part", "cid", "comp", "text", task).toDF("m_grp", "m_part", "m_cid", "m_comp", "m_text", "m_task")
    return left.groupBy("task").cogroup(right.groupBy("m_task")).applyInPandas(meet, "a long, b long")


def _texts_of(docs: DataFrame, key: str, text: str, rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(cid, text) of the wanted classes, one text each. The list of them is written
    first: Spark then knows its size when it plans the join, and texts are shuffled
    only if the list is too large to broadcast."""
    pick = rows.where("kind = 0").join(wanted.select("cid").distinct(), "cid").groupBy("cid").agg(F.min("key").alias("_k"))
    pick = materialise(pick, "jaccard-pick")
    here = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    found = here.join(pick, F.col("_key").eqNullSafe(F.col("_k"))).select("_text", "cid")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "_text"):
            same = class_ids(*token_sets(texts, width)) == part.column(1).to_numpy()  # an id may have several texts
            kept = part.filter(pa.array(same))
            yield pa.RecordBatch.from_arrays([kept.column(1), kept.column(0)], names=["cid", "text"])

    texts = materialise(found.mapInArrow(check, "cid long, text string"), "jaccard-texts")
    release(pick)
    return texts


def _compare(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Links among (class, leader) pairs; a leader's classes are salted into
    parts of bounded size."""
    per = pairs.groupBy("b").count().select("b", F.ceil(F.col("count") / QUERIES).alias("parts"))
    asked = pairs.join(per, "b").withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")))
    q = asked.select(F.col("b").alias("grp"), "part", F.col("a").alias("cid"), F.col("a").alias("comp")).join(texts, "cid")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    lead = per.select(F.col("b").alias("cid"), F.col("b").alias("comp"), F.col("b").alias("grp"), each.alias("part")).join(texts, "cid")
    return open_groups(q, lead, width, pairs.count() // QUERIES)


def token_groups(shared: DataFrame, comp: DataFrame, classes: DataFrame) -> DataFrame:
    """The token-group matrix: (token, grp, held, lo, hi, least, most) with the group's
    classes (cid, n) that have the token in their prefix, their sizes and components.

    Only tokens of several components are needed. A component's home is its most
    frequent such token: similar classes, linked or not, share a home, and are
    cut by size band into groups of about ``GROUP``, the classes of a component together."""
    size = comp.groupBy("comp").agg(F.count(F.lit(1)).alias("members"))
    mine = comp.select(F.col("node").alias("cid"), "comp").join(size, "comp").join(classes.select("cid", "n"), "cid")
    tokens = shared.join(mine, "cid")
    facts = tokens.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("f"))
    live = materialise(tokens.join(facts.where("x != y").select("token", "f"), "token"), "jaccard-live")
    home = live.groupBy("comp").agg(F.max(F.struct("f", "token")).alias("home"))
    chunk = F.xxhash64("comp", F.pmod(F.xxhash64("cid"), F.ceil(F.col("members") / GROUP)))
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(DEN / NUM)))
    each = live.select("cid", "comp", "members", "n").distinct().join(home, "comp")
    each = each.select("cid", F.xxhash64("home.token", band).alias("family"), chunk.alias("chunk"))
    parts = each.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("parts"))
    grp = each.join(parts, "family").select("cid", F.xxhash64("family", F.pmod("chunk", "parts")).alias("grp"))
    matrix = live.join(grp, "cid").groupBy("token", "grp").agg(
        F.collect_list(F.struct("cid", "n")).alias("held"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("comp").alias("least"), F.max("comp").alias("most")
    )
    matrix = materialise(matrix, "jaccard-matrix")
    release(live)
    return matrix


def needed(n: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Fewest prefix tokens that a set of ``n`` tokens shares with a linked set of
    ``lo`` to ``hi`` tokens. An overlap of o puts the k-th shared token at place
    k + |x| - o or before in either set, so the first o - ceil(t max(|x|, |y|)) + 1 are
    in both prefixes. That number rises with |y| up to |x| and falls beyond."""
    low, high = np.minimum(lo, n), np.maximum(hi, n)
    small = -(-NUM * (n + low) // (NUM + DEN)) + (-NUM * n // DEN) + 1
    large = (NUM * DEN * (n + high) - NUM * (NUM + DEN) * high) // (DEN * (NUM + DEN)) + 1
    return np.maximum(1, np.minimum(small, large))


def group_pairs(matrix: DataFrame) -> DataFrame:
    """(ga, gb, a, b): groups that may hold a link, with the classes of each that share
    enough prefix tokens with the other group's token union."""
    x, y = (matrix.select("token", *[F.col(c).alias(f"{c}_{side}") for c in matrix.columns[1:]]) for side in "xy")
    met = x.join(y, "token").where(
        (F.col("grp_x") <= F.col("grp_y"))
        & (DEN * F.col("hi_x") >= NUM * F.col("lo_y"))
        & (DEN * F.col("hi_y") >= NUM * F.col("lo_x"))
        & ((F.col("least_x") != F.col("most_y")) | (F.col("most_x") != F.col("least_y")))
    )
    ranges = [f(f"{c}_{side}").alias(f"{c}_{side}") for side in "xy" for c, f in (("lo", F.min), ("hi", F.max))]
    flat = [F.flatten(F.collect_list(f"held_{side}")).alias(name) for side, name in (("x", "a"), ("y", "b"))]
    met = met.groupBy(F.col("grp_x").alias("ga"), F.col("grp_y").alias("gb")).agg(*flat, *ranges)

    def enough(cid: np.ndarray, n: np.ndarray, lo: int, hi: int) -> np.ndarray:
        one, at, times = np.unique(cid, return_index=True, return_counts=True)
        return one[times >= needed(n[at], lo, hi)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo_x, hi_x, lo_y, hi_y = (batch.column(c).to_pylist() for c in ("lo_x", "hi_x", "lo_y", "hi_y"))
            kept, a, b = [], [], []
            for i in range(batch.num_rows):
                left, right = ([f.to_numpy(zero_copy_only=False) for f in batch.column(c)[i].values.flatten()] for c in "ab")
                p, q = enough(*left, lo_y[i], hi_y[i]), enough(*right, lo_x[i], hi_x[i])
                if len(p) and len(q):
                    kept.append(i)
                    a.append(p)
                    b.append(q)
            some = pa.array(kept, pa.int64())
            ids = [batch.column(c).take(some) for c in ("ga", "gb")]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(a, pa.list_(pa.int64())), pa.array(b, pa.list_(pa.int64()))], names=["ga", "gb", "a", "b"])

    return met.mapInArrow(run, "ga long, gb long, a array<long>, b array<long>")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(key, n_shingles, component_id, n_links) of every row; n_links counts the links
    found between the row's class and others (enough to connect its component)."""
    spark = docs.sparkSession
    ship(spark)
    rows = describe(docs, key, text, width)
    per_row = rows.where("kind = 0")
    classes = materialise(per_row.where("n > 0").groupBy("cid").agg(F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("blob").alias("blob")), "jaccard-classes")
    pairs = materialise(likely_pairs(classes), "jaccard-pairs")
    shared = materialise(shared_tokens(prefix_tokens(docs, text, width, rarity(rows))), "jaccard-tokens")
    wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).union(shared.select("cid"))
    texts = _texts_of(docs, key, text, rows, wanted, width)

    # components to begin with: classes compared with the leaders of their buckets
    nodes = classes.select(F.col("cid").alias("node"))
    near = materialise(_compare(pairs, texts, width), "jaccard-near")
    comp = materialise(connected_components(nodes, near), "jaccard-comp")

    # matrix: groups of similar classes, and the pairs of groups that share a prefix token
    matrix = token_groups(shared, comp, classes)
    meets = materialise(group_pairs(matrix), "jaccard-meets")
    held = texts.join(comp.select(F.col("node").alias("cid"), "comp"), "cid")
    q, m = (meets.select(F.col("ga").alias("grp"), F.col("gb").alias("part"), F.explode(c).alias("cid")).join(held, "cid") for c in "ab")
    rows_met = meets.agg(F.sum(F.size("a") + F.size("b"))).first()[0] or 0
    cross = materialise(open_groups(q, m, width, rows_met // QUERIES), "jaccard-cross")

    links = near.unionByName(cross)
    joined = cross.join(comp.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a").join(comp.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b")
    over = connected_components(comp.select(F.col("comp").alias("node")), joined.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    final = comp.join(over.select(F.col("node").alias("comp"), F.col("comp").alias("root")), "comp").select(F.col("node").alias("cid"), "root")
    final = materialise(final, "jaccard-final")
    member = per_row.where("n > 0").groupBy("cid").agg(F.min("key").alias("least"))
    least = final.join(member, "cid").groupBy("root").agg(F.min("least").alias("least"))
    ends = links.select(F.col("a").alias("cid")).unionByName(links.select(F.col("b").alias("cid"))).groupBy("cid").agg(F.count(F.lit(1)).alias("links"))
    labels = materialise(final.join(least, "root").join(ends, "cid", "left").select("cid", "least", "links"), "jaccard-labels")
    release(pairs, shared, texts, near, comp, matrix, meets, cross, final, classes)
    return (
        per_row.select("key", "cid", "n")
        .join(labels, "cid", "left")
        .select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("key")).alias("component_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))
    )
