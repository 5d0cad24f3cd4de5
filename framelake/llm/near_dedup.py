"""Near duplicates by ProbMinHash over weighted shingles, banding and verification.

A text is the set of its five-word shingles, each weighted by how often it occurs (a text of fewer words is one
shingle). Each shingle is a Poisson process of rate its weight, seeded by its hash; its arrivals fall on random
registers, and a register keeps the earliest arrival. Arrivals later than the latest register are never generated:
that ends the processes early. Two texts have equal registers with the probability Jaccard similarity of their
weighted shingles. A text that repeats shingles has a second set of registers with all weights 1 (that of other texts
is the first one), equal with the plain Jaccard similarity. Bands of registers of both sets are buckets. Pairs are verified on the shingles themselves: two documents are
linked if the probability Jaccard similarity or the plain Jaccard similarity of their shingles is SIMILAR or more.

Copies (equal texts) are one text from the start, so a group of copies never meets itself. In a bucket every text is
first held against one hub, the text with the least hash for that band; links make components. A small bucket that
still has several components is then compared pair by pair across them. Texts of large buckets are held against the
consensus of their crowd instead, see ``dense_links``: that leaves out no link between texts that share a bucket.
Sketches of two 64-bit words, a bit for each register, drop pairs that are far from
similar by both sets of registers before texts are fetched.

Documents without words (null, empty, blank) have no shingles; each is a class of its own, as are rows without a key. A class is named by its
least key. Rows that share a key count as one document: its texts' classes are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.common import WORD, checkpointed, counted, release, slices, table
from framelake.session import share_code

WORDS, SIMILAR = 5, 0.8
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
#: Bits in which the sketches of two texts of similarity SIMILAR may differ: 120 * (1 - 0.8) / 2 = 12 on average, 3.3 standard deviation; this is five above.
MOST_BITS = 29
SKETCH = ("s0", "s1", "p0", "p1")
#: Buckets of so many texts at most are compared pair by pair where components differ: a bounded number for each text.
MOST_PAIRED = 32
#: Texts of a crowd, about, that tell its consensus.
SAMPLED, MOST_HOT = 128, 4096
#: Component rounds are bounded by the logarithm of the longest chain; this only stops an endless loop.
MOST_ROUNDS = 60
#: Edges whose components one task finds.
AT_ONCE = 1_000_000

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


class WordHashes(dict):
    """64-bit hashes of words, kept while they fit."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return value


@lru_cache(1)
def word_hashes() -> WordHashes:
    return WordHashes()


def split_words(text: str | None) -> list[str]:
    """Words are runs of anything but ASCII white space."""
    return [w for w in (text or "").translate(BLANKS).split(" ") if w]


BLANKS = {c: " " for c in (9, 10, 11, 12, 13)}


def shingles(words: list[str]) -> np.ndarray:
    """Hashes of the five-word shingles, in order; of all words if there are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    own = word_hashes()
    h = np.fromiter(map(own.__getitem__, words), np.uint64, len(words))
    return shingle_hashes(h, np.array([len(h)]))[0]


def shingle_hashes(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From the word hashes of texts one after the other: shingle hashes, and how many each text has."""
    n = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    first = np.repeat(starts - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    length = np.repeat(np.minimum(counts, WORDS), n)
    out = np.repeat(U(0x9E3779B97F4A7C15), len(first))
    with np.errstate(over="ignore"):
        for k in range(WORDS):
            part = h[np.minimum(first + k, max(len(h) - 1, 0))]
            step = out * U(0x100000001B3) + part
            out = np.where(k < length, step, out)
    return mix(out), n


def weighted(hashes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text number, hash, weight. Sorted by text and hash."""
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(first)
    return doc[at], hashes[at], np.diff(np.append(at, len(doc)))


def registers(doc: np.ndarray, hashes: np.ndarray, weight: np.ndarray, texts: int, m: int = REGISTERS) -> np.ndarray:
    """ProbMinHash: for each text (all have shingles) and register a hash of the shingle with the earliest arrival.

    In round k all processes that may still win make their k-th arrival: an exponential time after the last, on a
    register that is random with replacement. A process ends when its arrival comes after its text's latest register.
    """
    times = np.full(texts * m, np.inf)
    winner = np.zeros(texts * m, np.uint64)
    at, h, rate = doc.copy(), hashes.copy(), weight.astype(float)
    clock = np.zeros(len(at))
    k = 0
    while len(at):
        k += 1
        with np.errstate(over="ignore"):
            r = mix(h + U(k) * U(0xD1342543DE82EF95))
            slot = at * m + ((mix(r ^ U(0xA0761D6478BD642F)) >> U(33)) % U(m)).astype(np.int64)
        clock = clock - np.log(((r >> U(11)).astype(float) + 0.5) / float(1 << 53)) / rate
        before = times.copy() if k == 1 else None
        np.minimum.at(times, slot, clock)
        won = times[slot] == clock
        winner[slot[won]] = h[won]
        del before
        latest = times.reshape(texts, m).max(axis=1)
        live = clock < latest[at]
        at, h, rate, clock = at[live], h[live], rate[live], clock[live]
    return winner.reshape(texts, m)


def sketch(batch: list[str | None]) -> list[tuple[int, ...] | None]:
    """For each text (None without words): two words of a bit per weighted register, two of plain ones, then the hashes of its buckets."""
    words = [split_words(t) for t in batch]
    counts = np.array([len(w) for w in words], np.int64)
    some = np.flatnonzero(counts)
    out: list[tuple[int, ...] | None] = [None] * len(batch)
    if not len(some):
        return out
    own = word_hashes()
    h = np.fromiter((own[w] for i in some for w in words[i]), np.uint64, int(counts.sum()))
    doc, hashes, weight = weighted(*shingle_hashes(h, counts[some]))
    found = registers(doc, hashes, weight, len(some))
    plain = found.copy()
    # without repeats both are the same
    repeats = np.unique(doc[weight > 1])
    if len(repeats):
        own_rows = np.isin(doc, repeats)
        plain[repeats] = registers(np.searchsorted(repeats, doc[own_rows]), hashes[own_rows], np.ones(own_rows.sum()), len(repeats))
    halves = [*bit_words(found), *bit_words(plain)]
    both = np.hstack([band_hashes(found), band_hashes(plain)])
    fresh = np.ones(both.shape, bool)
    fresh[:, BANDS:] = both[:, BANDS:] != both[:, :BANDS]
    for j, i in enumerate(some):
        out[i] = (*(int(x[j]) for x in halves), *both[j][fresh[j]].tolist())
    return out


def bit_words(found: np.ndarray) -> list[np.ndarray]:
    """Two words of a bit for each register."""
    bits = (mix(found) & U(1)).astype(np.uint64)
    return [(part << np.arange(60, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).astype(np.int64) for part in (bits[:, :60], bits[:, 60:])]


def band_hashes(found: np.ndarray) -> np.ndarray:
    """BANDS bucket hashes of each text."""
    buckets = np.tile(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(found), 1))
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            buckets = mix(buckets * U(0x100000001B3) + found[:, r::ROWS][:, :BANDS] + U(r + 1))
    return buckets.astype(np.int64)


def similarity(a: str | None, b: str | None) -> float:
    """The greater of probability Jaccard (weighted) and plain Jaccard similarity of two texts' shingles."""
    x, y = (np.unique(shingles(split_words(t)), return_counts=True) for t in (a, b))
    if not len(x[0]) or not len(y[0]):
        return 0.0
    return alike(x, y)


def alike(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    (h, v), (g, w) = x, y
    both, i, j = np.intersect1d(h, g, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    plain = len(both) / (len(h) + len(g) - len(both))
    if plain >= SIMILAR or v.max() == 1 and w.max() == 1:
        return plain
    return max(plain, probability_jaccard(v, w, i, j))


def probability_jaccard(v: np.ndarray, w: np.ndarray, i: np.ndarray, j: np.ndarray) -> float:
    """Sum over the shared shingles of 1 / sum over all shingles of max(v' / v, w' / w)."""
    ratio = (w[j] / v[i]).astype(float)  # at shared shingles; infinite or zero elsewhere
    only_v, only_w = v.sum() - v[i].sum(), w.sum() - w[j].sum()
    order = np.argsort(ratio)
    vs, ws = v[i][order].astype(float), w[j][order].astype(float)
    # against shingle d a shingle e with ratio w/v below d's counts v'/v, above it w'/w
    low_v = np.cumsum(vs)
    high_w = ws.sum() - np.cumsum(ws)
    total = (only_v + low_v) / vs + (only_w + high_w) / ws
    return float((1 / total).sum())


def _near(other: str, kinds: str = "sp"):
    """Whether a row's sketch, weighted (s) or plain (p), is near the one in columns of prefix ``other``."""
    near = [F.bit_count(F.col(f"{k}0").bitwiseXOR(F.col(f"{other}{k}0"))) + F.bit_count(F.col(f"{k}1").bitwiseXOR(F.col(f"{other}{k}1"))) <= MOST_BITS for k in kinds]
    return near[0] if len(near) == 1 else near[0] | near[1]


def union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, root) from all edges (a, b) of a bounded graph."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(parent.setdefault(a, a)), find(parent.setdefault(b, b))
            if a != b:
                parent[max(a, b)] = min(a, b)
    ids = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([find(x) for x in ids], pa.int64())], names=["id", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for the ids of edges (a, b): every component's ids with its least id.

    Up to AT_ONCE edges go through one task by union-find (16 MB of edges); more are settled in rounds. Each round an id
    takes the least of its own root, its neighbours' roots and its root's root, so ways shorten by half. A round is one
    written table that tells by itself how many roots changed.
    """
    counted = Observation()
    edges = checkpointed(edges.select("a", "b").observe(counted, F.count("*").alias("n")))
    if counted.get["n"] <= AT_ONCE:
        return checkpointed(edges.coalesce(1).mapInArrow(union_find, "id long, root long"))
    both = checkpointed(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    state = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.min("a")).alias("root"))
    state = checkpointed(state)
    for _ in range(MOST_ROUNDS):
        near = both.join(state.select(F.col("id").alias("b"), "root"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        up = state.select(F.col("id").alias("root"), F.col("root").alias("up"))
        told = Observation()
        stepped = state.join(near, "id").join(up, "root").select("id", F.least("root", "near", "up").alias("root"), F.col("root").alias("old"))
        stepped = checkpointed(stepped.observe(told, F.count_if(F.col("root") != F.col("old")).alias("changed")).select("id", "root"))
        state = stepped
        if not told.get["changed"]:
            return state
    raise RuntimeError("components did not settle")


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those pairs (a, b) of text ids whose texts are similar."""
    share_code(pairs.sparkSession)
    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    full = left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def of(t: str) -> tuple[np.ndarray, np.ndarray]:
            if t not in kept:
                if len(kept) > 200:
                    kept.clear()
                kept[t] = np.unique(shingles(split_words(t)), return_counts=True)
            return kept[t]

        for batch in slices(batches, "text_b"):
            x, y = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
            yield batch.select(["a", "b"]).filter(pa.array([alike(of(s), of(t)) >= SIMILAR for s, t in zip(x, y, strict=True)], pa.bool_()))
        release(kept, word_hashes())

    return full.mapInArrow(check, "a long, b long")


def sketches(texts: DataFrame) -> DataFrame:
    """(id, s0, s1, p0, p1, keys) for the distinct ids of (id, text) with words; keys hold the buckets of both sets of registers."""
    share_code(texts.sparkSession)
    schema = T.StructType([*(T.StructField(c, T.LongType()) for c in ("id", *SKETCH)), T.StructField("keys", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            found = [(i, *x) for i, x in zip(batch.column("id").to_pylist(), sketch(batch.column("text").to_pylist()), strict=True) if x is not None]
            if found:
                fixed = 1 + len(SKETCH)
                rows = np.array([x[:fixed] for x in found], np.int64)
                ends = np.cumsum([0, *(len(x) - fixed for x in found)], dtype=np.int32)
                keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.array(x[fixed:], np.int64) for x in found])))
                yield pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(rows[:, k])) for k in range(fixed)), keys], names=schema.names)
        release(word_hashes())

    found = texts.select("id", "text").mapInArrow(run, schema)
    return checkpointed(found.groupBy("id").agg(*(F.first(c).alias(c) for c in (*SKETCH, "keys"))))


def links(found: DataFrame, texts_of) -> DataFrame:
    """(id, root) of all linked texts, from ``sketches``; ``texts_of(ids)`` fetches (id, text)."""
    sketched = found.select("id", *SKETCH)
    dealt = found.select("id", F.explode("keys").alias("key"))
    # buckets of one text lead nowhere: counted with partial sums and dropped
    shared = dealt.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    rows = checkpointed(dealt.join(shared, "key").join(sketched, "id"))
    texts = checkpointed(texts_of(rows.select("id").distinct()))
    hubs = rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("id", "key").alias("h"), "id", *SKETCH)).alias("hub"))
    starred = rows.join(hubs, "key").where(F.col("id") != F.col("hub.id"))
    near = starred.where(_near("hub."))
    tried = checkpointed(near.select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct())
    edges = checkpointed(verify(tried, texts))
    roots = components(edges)
    known = checkpointed(rows.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")))
    # buckets of one component are done
    mixed = known.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    left = checkpointed(known.join(mixed, "key"))
    few = left.where(F.col("members") <= MOST_PAIRED)
    other = few.select("key", F.col("id").alias("i"), *(F.col(c).alias(f"o_{c}") for c in SKETCH), F.col("root").alias("r"))
    cross = few.join(other, "key").where((F.col("i") < F.col("id")) & (F.col("r") != F.col("root")) & _near("o_"))
    pairs = cross.select(F.least("i", "id").alias("a"), F.greatest("i", "id").alias("b"))
    many = left.where(F.col("members") > MOST_PAIRED)
    sure, maybe = dense_links(many.select("id", "key", "root", *SKETCH), texts)
    new = checkpointed(pairs.unionByName(maybe).distinct().join(tried, ["a", "b"], "left_anti"))
    return components(edges.unionByName(sure).unionByName(verify(new, texts)))


def dense_links(many: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For large buckets, rows (id, key, root, s0, s1, p0, p1): sure links and pairs still to verify, as (a, b).

    Texts that share large buckets are a crowd. Its consensus H is the set of shingles that half of some of its texts
    have (about SAMPLED, by a hash), so it is about twice as large as a text at most. What follows holds for any set as
    H; a good one makes the rest of the texts small. A text s has n shingles, j of them in H, and lacks m = |H| - j.
    Similar texts share 0.8 n shingles at least, for the n of either. So

    - texts that share no shingle beyond H and lack none of H in common share exactly |H| - m - m' shingles, all others
      more. Pairs for which that would do are linked for sure; as it falls in m and n, holding each text against those
      of the crowd that no other beats in both joins all that such pairs join;
    - other similar texts share 0.8 n - j shingles beyond H at least. Any two sets in one order that share t elements
      share one of their first size - t + 1: of a text's shingles beyond H the first 0.2 n + 1 will do;
    - or they share none beyond H, then j is 0.8 n or more for both, and they lack m - (j' - 0.8 n') of H in common at
      least: of the shingles that such a text lacks, the first 0.25 n + 1 will do, from the one on that most texts have.

    Of the texts that meet by a shingle, those outside the largest component among them are held against the others.

    Weighted links need at least one text that repeats shingles; crowds without one are done. By weights, normalised to 1
    for each text, similar texts share 0.8 at least (the sum of the lesser weights). Shingles of H, and MOST_HOT more
    that two of the sampled texts have, are hot, the others cold: again any choice would do. V is a text's weight on hot ones, a that on cold ones. So

    - similar texts that share a cold shingle share one of those that come first in one order, up to a weight of 0.2
      (hot ones last in that order);
    - others have a similarity of 1 / (1 + a / V + a' / V') at most, and just that if they have the same hot weights (the
      same profile). It falls in a: a text linked so to any text of a profile is linked to the profile's text of least a.
      So each text is held against those alone; of the pairs, one text at least is outside the crowd's largest component.

    Only where most texts of a crowd differ in profile and component, or in component though they share
    shingles beyond H, does that come near all its pairs. Crowds are found over the buckets' stars, whatever their texts'
    similarity. What is known of a crowd (its size, consensus, front, largest component) is a row or a few: it is
    broadcast where its counted size allows, so that a crowd's texts stay where they are; else Spark splits the join.
    """
    share_code(many.sparkSession)
    hubs = many.groupBy("key").agg(F.min("id").alias("hub"))
    stars = many.join(hubs, "key").where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    crowds = components(stars).select("id", F.col("root").alias("crowd"))
    members = many.groupBy("id").agg(F.first("root").alias("root"), *(F.first(c).alias(c) for c in SKETCH)).join(crowds, "id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            found = [np.unique(shingles(split_words(t)), return_counts=True) for t in batch.column("text").to_pylist()]
            ends = pa.array(np.cumsum([0, *(len(x) for x, _ in found)], dtype=np.int32))
            held = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([x.view(np.int64) for x, _ in found])))
            weights = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([w for _, w in found]).astype(np.int32)))
            repeats = pa.array([bool(w.max() > 1) for _, w in found])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("crowd"), held, weights, repeats], names=["id", "crowd", "s", "w", "repeats"])

    held = checkpointed(texts.join(members.select("id", "crowd"), "id").mapInArrow(sets, "id long, crowd long, s array<long>, w array<int>, repeats boolean"))
    sizes = counted(held.groupBy("crowd").agg(F.count("*").alias("size")))
    # any set would do as H; some texts of low hash tell well enough what most of a crowd have
    some = held.join(sizes, "crowd").where((F.xxhash64("id").cast("double") + 2.0**63) * F.col("size") < 2.0**64 * SAMPLED).select("crowd", "s")
    asked = some.groupBy("crowd").agg(F.count("*").alias("size"))
    often = some.select("crowd", F.explode("s").alias("g")).groupBy("crowd", "g").agg(F.count("*").alias("n")).join(asked, "crowd").where("n >= 2")
    core = often.groupBy("crowd").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "g", (F.col("n") * 2 >= F.col("size")).alias("most")))).alias("x"))
    core = core.select("crowd", F.filter("x", lambda y: y["most"])["g"].alias("c"), F.col("x.g").alias("x"))
    consensus = counted(core.select("crowd", "c", F.slice("x", F.lit(1), F.size("c") + MOST_HOT).alias("hot")), F.size("hot"))
    none = F.array().cast("array<bigint>")
    facts = held.join(consensus, "crowd", "left").withColumns({"c": F.coalesce("c", none), "hot": F.coalesce("hot", none)})
    facts = facts.select("id", "crowd", F.size("s").alias("n"), F.size("c").alias("h"), F.array_except("s", "c").alias("beyond"), F.array_except("c", "s").alias("lacks"), F.array_except("s", "hot").alias("cold"))
    # what a text lacks stays in the order of c: first what most have
    facts = facts.withColumns({"m": F.size("lacks"), "u": F.size("beyond"), "j": F.col("h") - F.size("lacks")})
    first = lambda c, share: F.slice(c, F.lit(1), F.floor(F.col("n") / share).cast("int") + 1)
    facts = facts.select("id", "crowd", "n", "h", "m", "u", "cold", first("beyond", 5).alias("beyond"), F.when(F.col("j") * 5 >= F.col("n") * 4, first("lacks", 4)).otherwise(none).alias("lacks")).join(members.drop("crowd"), "id")
    facts = checkpointed(facts)

    def would_do(shared, n1, n2):
        # shared / (n1 + n2 - shared) >= 4 / 5, in whole numbers
        return shared * 9 >= (n1 + n2) * 4

    # texts that no other beats in m and n: for each m the least n, if it is under those of all smaller m
    steps = facts.groupBy("crowd", "m").agg(F.min(F.struct("n", "id")).alias("x"))
    front = steps.withColumn("best", F.min("x.n").over(Window.partitionBy("crowd").orderBy("m").rowsBetween(Window.unboundedPreceding, -1))).where("best is null or x.n < best")
    front = counted(front.select("crowd", F.col("m").alias("m2"), F.col("x.n").alias("n2"), F.col("x.id").alias("b")))
    sure = facts.join(front, "crowd").where((F.col("id") != F.col("b")) & would_do(F.col("h") - F.col("m") - F.col("m2"), F.col("n"), F.col("n2"))).select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()
    weights = weighted_facts(held, facts.select("id", "cold"))
    # the same profile: 1 / (1 + (a + a2) / v) is above 0.8; just 0.8 is left to verification
    least = weights.where("a * 4 <= v").groupBy("crowd", "profile").agg(F.min(F.struct("a", "id", "repeats", "v")).alias("x"))
    least = counted(least.select("crowd", "profile", F.col("x.a").alias("a2"), F.col("x.id").alias("b"), F.col("x.repeats").alias("repeats2"), F.col("x.v").alias("v2")))
    alike_on_h = weights.join(least, ["crowd", "profile"]).where("id <> b and (repeats or repeats2) and (a + a2) * 4 < v")
    sure = checkpointed(sure.unionByName(alike_on_h.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()))
    # what is linked for sure needs no more: components so far
    joined = components(sure.unionByName(facts.where("id <> root").select(F.col("root").alias("a"), F.col("id").alias("b"))))
    facts = facts.join(joined.withColumnRenamed("root", "joined"), "id", "left").withColumn("root", F.coalesce("joined", "root")).drop("joined")
    mark = lambda c, kind: F.transform(c, lambda g, i: F.struct(g.alias("g"), F.lit(kind).alias("kind"), i.alias("at")))
    marks = facts.select("id", "crowd", "root", *SKETCH, "n", "h", "m", "u", F.explode(F.concat(mark("beyond", 1), mark("lacks", 0))).alias("x")).select("*", "x.g", "x.kind", "x.at").drop("x")
    # only shingles that texts of two components have can link anything; texts outside the largest of these are held against all
    marks = checkpointed(marks)
    by_root = marks.groupBy("crowd", "g", "kind", "root").agg(F.count("*").alias("k"))
    worth = by_root.groupBy("crowd", "g", "kind").agg(F.max(F.struct("k", "root"))["root"].alias("main"), F.count("*").alias("roots")).where("roots > 1").drop("roots")
    marks = checkpointed(marks.join(worth, ["crowd", "g", "kind"]))
    two = marks.select("crowd", "g", "kind", F.col("id").alias("i"), F.col("root").alias("r"), *(F.col(c).alias(f"o_{c}") for c in SKETCH), F.col("n").alias("n2"), F.col("m").alias("m2"), F.col("u").alias("u2"), F.col("at").alias("at2"))
    # so many shingles similar texts share, and so many of them beyond H, or lacked in common, must be shared; if a pair meets by the
    # first of these, no more than what comes after it in either list can follow
    shared = F.ceil((F.col("n") + F.col("n2")) * 4 / 9 - 1e-9)
    due = F.when(F.col("kind") == 1, shared - F.col("h") + F.greatest("m", "m2")).otherwise(F.col("m") + F.col("m2") - F.col("h") + shared)
    after = F.when(F.col("kind") == 1, F.least(F.col("u") - F.col("at"), F.col("u2") - F.col("at2"))).otherwise(F.least(F.col("m") - F.col("at"), F.col("m2") - F.col("at2")))
    could = (after >= due) & ((F.col("kind") == 1) | would_do(F.col("h") - F.greatest("m", "m2"), F.col("n"), F.col("n2")))
    once = (F.col("r") == F.col("main")) | (F.col("i") < F.col("id"))
    maybe = marks.where("root <> main").join(two, ["crowd", "g", "kind"]).where(once & (F.col("r") != F.col("root")) & could & _near("o_", "p"))
    maybe = maybe.select(F.least("i", "id").alias("a"), F.greatest("i", "id").alias("b"))
    roots = facts.select("id", "root", "s0", "s1")
    return sure, maybe.unionByName(weighted_pairs(weights.join(roots, "id"), least.join(roots.withColumnsRenamed({"id": "b", "root": "r", "s0": "o_s0", "s1": "o_s1"}), "b"))).distinct()


def weighted_facts(held: DataFrame, cold: DataFrame) -> DataFrame:
    """(id, crowd, repeats, a, v, profile, first) for crowds in which a text repeats shingles: its weights on cold and hot ones, a hash of the latter, and the first cold shingles.

    ``held`` has each text's shingles and weights, ``cold`` which of them are not hot.
    """
    worth = counted(held.where("repeats").select("crowd").distinct())
    rows = held.join(worth, "crowd", "left_semi").join(cold, "id").select("id", "crowd", "repeats", "s", "w", "cold")
    names = ["id", "crowd", "repeats", "a", "v", "profile", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for s, w, cold in zip(batch.column("s"), batch.column("w"), batch.column("cold"), strict=True):
                g, weight = s.values.to_numpy().view(np.uint64), w.values.to_numpy().astype(np.int64)
                few = np.isin(g, cold.values.to_numpy().view(np.uint64))
                own, light = g[few].view(np.int64), weight[few]
                order = np.argsort(own)
                own, light = own[order], light[order]
                with np.errstate(over="ignore"):
                    profile = np.bitwise_xor.reduce(mix(g[~few] + mix(weight[~few].astype(np.uint64))), initial=U(0))
                # a shingle is among the first if those before it weigh 0.2 of the text at most
                first = own[(np.cumsum(light) - light) * 5 <= weight.sum()]
                for column, value in zip(out, (int(light.sum()), int(weight.sum() - light.sum()), int(profile.view(np.int64)), first.tolist()), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in names[:3]), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names=names)

    return checkpointed(rows.mapInArrow(run, "id long, crowd long, repeats boolean, a long, v long, profile long, first array<long>"))


def weighted_pairs(weights: DataFrame, least: DataFrame) -> DataFrame:
    """Pairs (a, b) of two components that may be similar by weights, see ``dense_links``; both tables with root and weighted sketch."""
    weights, least = checkpointed(weights), counted(least)
    # share a cold shingle
    marks = weights.select("id", "crowd", "root", "s0", "s1", "repeats", F.explode("first").alias("g"))
    worth = marks.groupBy("crowd", "g").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("repeats").alias("any")).where("low <> high and any").select("crowd", "g")
    marks = checkpointed(marks.join(worth, ["crowd", "g"]))
    two = marks.select("crowd", "g", F.col("id").alias("b"), F.col("root").alias("r"), F.col("repeats").alias("repeats2"), F.col("s0").alias("o_s0"), F.col("s1").alias("o_s1"))
    meet = marks.join(two, ["crowd", "g"]).where(F.expr("id < b and root <> r and (repeats or repeats2)") & _near("o_", "s"))
    # share none
    light = weights.where("a * 4 <= v")
    largest = counted(light.groupBy("crowd", "root").agg(F.count("*").alias("n")).groupBy("crowd").agg(F.max(F.struct("n", "root"))["root"].alias("largest")))
    light, heads = light.join(largest, "crowd"), least.join(largest, "crowd").drop("profile")
    heads = heads.withColumnRenamed("largest", "head_largest")
    # a / v + a2 / v2 <= 1 / 4, in whole numbers
    close = F.expr("root <> r and (repeats or repeats2) and (cast(a as decimal(18)) * v2 + cast(a2 as decimal(18)) * v) * 4 <= cast(v as decimal(18)) * v2") & _near("o_", "s")
    outside = light.where("root <> largest").join(heads, "crowd").where(close)
    inside = light.where("root = largest").join(heads.where("r <> head_largest"), "crowd").where(close)
    pairs = [x.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")) for x in (meet, outside, inside)]
    return pairs[0].unionByName(pairs[1]).unionByName(pairs[2])


def classes(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, class_size): one row for each key, null among them (for all rows without a key, each a class of its own)."""
    # a text's number is a 64-bit hash: of n texts about n * n / 2**65 pairs share one by chance
    rows = documents.select(F.col(key).alias("k"), F.col(text).alias("text")).where(F.col("text").rlike(WORD)).withColumn("id", F.xxhash64("text"))
    ids = checkpointed(rows.select("k", "id").distinct())
    # the least key of a group of copies stands for it
    reps = ids.where("k is not null").groupBy("id").agg(F.min("k").alias("k"))

    def texts_of(wanted: DataFrame) -> DataFrame:
        return rows.select("k", "id", "text").join(reps.join(wanted, "id"), ["k", "id"]).select("id", "text").dropDuplicates(["id"])

    roots = links(sketches(rows.select("id", "text")), texts_of)
    named = reps.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    by_text = named.join(named.groupBy("root").agg(F.min("k").alias("class_id")), "root").select("id", "class_id")
    found = ids.where("k is not null").join(by_text, "id").groupBy("k").agg(F.min("class_id").alias("class_id"))
    everyone = documents.select(F.col(key).alias("k")).distinct()
    out = everyone.join(found, "k", "left").withColumn("class_id", F.coalesce("class_id", "k"))
    sizes = out.groupBy("class_id").agg(F.count("*").alias("class_size"))
    return out.join(sizes, "class_id", "left").select(F.col("k").alias(key), "class_id", F.coalesce("class_size", F.lit(1)).alias("class_size"))


def deduplicate(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class stays, the one with the least key; of rows that share a key all stay, and all rows without one."""
    kept = classes(documents, key, text).where(F.col(key) == F.col("class_id")).select(key)
    return documents.join(kept, key, "left_semi").select(*documents.columns).unionByName(documents.where(F.col(key).isNull()))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near duplicates."""
    return classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
