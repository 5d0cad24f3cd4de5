"""Operators that look at texts together, and the pipeline: brute force on small corpora."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from framelake.llm import mixing, near_dedup, suffix_dedup
from framelake.llm.common import checkpointed, checkpointed_alone, shuffles

DATA = "/root/testdata/sf0.001"


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n)]


# --- near duplicates


def copies(rng, size, length, most):
    base, out = words(rng, length), []
    for _ in range(size):
        b = list(base)
        for _ in range(rng.randint(1, most)):
            b[rng.randrange(length)] = words(rng, 1)[0]
        if rng.random() < 0.15:
            b = b[: rng.randint(length * 3 // 4, length)]
        out.append(" ".join(b))
    return out


def brute_classes(texts):
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if near_dedup.split_words(texts[i]) and near_dedup.split_words(texts[j]) and near_dedup.similarity(texts[i], texts[j]) >= near_dedup.SIMILAR:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize(("paired", "sampled"), [(3, 128), (3, 4), (1000, 128)])
def test_classes_are_brute_forces(spark, monkeypatch, paired, sampled):
    """With few pairs allowed all groups go the way of crowds."""
    monkeypatch.setattr(near_dedup, "MOST_PAIRED", paired)
    monkeypatch.setattr(near_dedup, "SAMPLED", sampled)
    rng = random.Random(5)
    texts = [*copies(rng, 40, 150, 7), *copies(rng, 25, 40, 3), *copies(rng, 8, 12, 2), *(" ".join(words(rng, rng.randint(1, 60))) for _ in range(20))]
    texts += [texts[0], texts[0], "", None, "  ", "one two", "one two", "one  two"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, class_id string")
    out = {r.doc_id: r.class_id for r in near_dedup.classes(df).collect()}
    assert [out[i] for i in range(len(texts))] == brute_classes(texts)
    kept = {r.doc_id for r in near_dedup.deduplicate(df).collect()}
    assert kept == set(brute_classes(texts))


def test_registers_estimate_similarity():
    rng, errors = np.random.default_rng(0), []
    base = [f"w{i}" for i in range(300)]
    for _ in range(40):
        other = list(base)
        for j in rng.integers(0, 300, 8):
            other[j] = f"x{rng.integers(1e6)}"
        found = [near_dedup.registers(*near_dedup.weighted(h, np.array([len(h)])), 1)[0] for h in (near_dedup.shingles(base), near_dedup.shingles(other))]
        errors.append((found[0] == found[1]).mean() - near_dedup.similarity(" ".join(base), " ".join(other)))
    assert abs(np.mean(errors)) < 0.02


def test_probability_jaccard():
    a, b = "a b c d e f g h i j " * 5 + "k l m n o p", "a b c d e f g h i j " * 3 + "k l m n o p q r s"
    x, y = (np.unique(near_dedup.shingles(near_dedup.split_words(t)), return_counts=True) for t in (a, b))
    v, w = dict(zip(*x, strict=True)), dict(zip(*y, strict=True))
    every = set(v) | set(w)
    want = sum(1 / sum(max(v.get(e, 0) / v[d], w.get(e, 0) / w[d]) for e in every) for d in set(v) & set(w))
    _, i, j = np.intersect1d(x[0], y[0], return_indices=True)
    assert np.isclose(near_dedup.probability_jaccard(x[1], y[1], i, j), want)


def test_repeats_of_a_line_do_not_part_plain_copies(spark):
    """Alike as sets, far apart by weights."""
    rng, texts = random.Random(8), []
    for few, many in [(1, 200)] * 6 + [(2, 60)] * 6:
        base, line = " ".join(words(rng, 300)), " ".join(words(rng, 6)) + " "
        texts += [f"{line * few}{base}", f"{line * many}{base}"]
    out = {r.doc_id: r.class_id for r in near_dedup.classes(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()}
    assert [out[i] for i in range(len(texts))] == brute_classes(texts) == [i - i % 2 for i in range(len(texts))]


def repeated_lines(rng):
    """Crowds around lines that repeat, with few and many own words, in other numbers, of two lines, by shared passages."""
    one, other, third = (" ".join(words(rng, 5)) for _ in range(3))
    passages = [" ".join(words(rng, 30)) for _ in range(3)]
    own = lambda n: " ".join(words(rng, n))
    texts = [f"{one} " * 50 + own(20) for _ in range(10)] + [f"{one} " * 50 + own(60) for _ in range(60)]
    texts += [own(rng.randint(0, 25)) + f" {one}" * rng.randint(30, 90) + " " + own(rng.randint(5, 40)) for _ in range(30)]
    texts += [f"{one} " * rng.randint(5, 40) + f"{other} " * rng.randint(5, 40) + own(rng.randint(0, 12)) for _ in range(40)]
    texts += [f"{third} " * 20 + rng.choice(passages) + " " + own(rng.randint(3, 12)) for _ in range(30)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("paired", "sampled"), [(3, 128), (3, 4), (1000, 128)])
def test_weighted_links_of_crowds(spark, monkeypatch, paired, sampled):
    monkeypatch.setattr(near_dedup, "MOST_PAIRED", paired)
    monkeypatch.setattr(near_dedup, "SAMPLED", sampled)
    texts = repeated_lines(random.Random(6))
    out = {r.doc_id: r.class_id for r in near_dedup.classes(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()}
    assert [out[i] for i in range(len(texts))] == brute_classes(texts)


def test_few_weighted_links_in_large_buckets(spark):
    """Hubs hardly ever are the few texts that are linked."""
    rng, texts, want = random.Random(9), [], []
    for _ in range(5):
        line, first = " ".join(words(rng, 5)) + " ", len(texts)
        texts += [line * 50 + " ".join(words(rng, n)) for n in [20] * 3 + [60] * 200]
        want += [first] * 3 + list(range(first + 3, first + 203))
    assert near_dedup.similarity(texts[0], texts[1]) >= near_dedup.SIMILAR > near_dedup.similarity(texts[0], texts[3])
    out = {r.doc_id: r.class_id for r in near_dedup.classes(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()}
    assert [out[i] for i in range(len(texts))] == want


def test_near_duplicates_of_odd_tables(spark):
    schema = "doc_id long, text string"
    assert near_dedup.classes(spark.createDataFrame([], schema)).count() == 0
    out = near_dedup.classes(spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, None)], schema)).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in out) == [("1", "1"), ("2", "2"), ("None", "None")]


def test_rows_without_a_key_stay(spark):
    rows = [(None, "a b c"), (None, "a b c"), (None, None), (1, "a b c"), (2, "a b c"), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(str, near_dedup.deduplicate(df).collect())) == sorted(str(r) for r in df.collect() if r.doc_id != 2)
    assert {r.doc_id: r.class_size for r in near_dedup.classes(df).collect()} == {None: 1, 1: 2, 2: 2, 3: 1}


# --- repeated strings


def brute_removal(texts, length):
    seen = collections.Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        cover = np.zeros(len(t) + 1, int)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                cover[p] += 1
                cover[p + length] -= 1
        gone = np.cumsum(cover)[: len(t)] > 0
        out.append((len(t), int(gone.sum()), len(suffix_dedup._runs(gone)), hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize(("most", "length"), [(512, 400), (3, 400), (512, 240), (3, 131)])
def test_removal_is_brute_forces(spark, monkeypatch, most, length):
    """With few contexts allowed in an index, hot anchors go the way of counted windows."""
    monkeypatch.setattr(suffix_dedup, "MOST_CONTEXTS", most)
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdé fgh ") for _ in range(n))
    passages = [text(n) for n in (130, 240, 250, 390, 400, 405, 450, 700, 1500)]
    docs = []
    for _ in range(130):
        k = rng.random()
        if k < 0.3:
            t = text(rng.randint(0, 300)) + rng.choice(passages) + text(rng.randint(0, 300))
        elif k < 0.5:
            t = text(rng.randint(0, 50)) + rng.choice(passages)[rng.randint(0, 60) :] + rng.choice(passages) + text(rng.randint(0, 5))
        elif k < 0.6 and docs:
            t = rng.choice(docs)
        elif k < 0.7:
            t = "ab" * rng.randint(0, 600)
        elif k < 0.75:
            t = text(100) + "x" * rng.randint(300, 900)
        elif k < 0.8:
            t = text(30) * rng.randint(5, 40)
        else:
            t = text(rng.randint(0, 1500))
        docs.append(t)
    docs[3] = ""
    df = spark.createDataFrame([*enumerate(docs), (1000, None)], "doc_id long, text string").repartition(5)
    out = {r.q_key: (r.q_bytes, sum(x.b - x.a for x in r.q_spans), len(r.q_spans), hashlib.sha256(bytes(r.q_kept)).hexdigest()) for r in suffix_dedup.cleaned(df, length=length).collect()}
    assert out.pop(1000)[:3] == (0, 0, 0)
    assert [out[i] for i in range(len(docs))] == brute_removal([t.encode() for t in docs], length)


def test_removal_of_odd_tables(spark):
    schema = "doc_id long, text string, a string"
    assert suffix_dedup.cleaned(spark.createDataFrame([], schema), keep=("a",)).count() == 0
    rows = [(None, "q" * 500, "1"), (None, "r" * 30, None), (7, None, "x"), (7, "unlike " + "".join(map(str, range(200))), "y")]
    out = suffix_dedup.cleaned(spark.createDataFrame(rows, schema), keep=("a",)).collect()
    assert sorted((r.q_bytes, sum(x.b - x.a for x in r.q_spans)) for r in out) == sorted([(500, 500), (30, 0), (0, 0), (497, 0)])


def test_long_texts_in_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    text = bytes(rng.integers(97, 107, 50_000, dtype=np.uint8))
    (whole,) = suffix_dedup.document_anchors([text], suffix_dedup.Shape())
    monkeypatch.setattr(suffix_dedup, "PIECE", 9000)
    (parts,) = suffix_dedup.document_anchors([text], suffix_dedup.Shape())
    assert whole[1].tolist() == parts[1].tolist() and whole[2].tolist() == parts[2].tolist()


def shuffled(spark, act):
    """Bytes that the stages of ``act`` write for exchanges."""
    context, group = spark.sparkContext, f"shuffled-{random.getrandbits(64)}"
    context.setJobGroup(group, group)
    try:
        act()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    context._jsc.sc().listenerBus().waitUntilEmpty()
    tracker, store = context.statusTracker(), context._jsc.sc().statusStore()
    stages = {i for j in tracker.getJobIdsForGroup(group) for i in tracker.getJobInfo(j).stageIds}
    return sum(x.shuffleWriteBytes() for x in map(store.lastStageAttempt, stages))


@pytest.mark.parametrize("most", [512, 3])
def test_texts_are_exchanged_once(spark, monkeypatch, most):
    """Contexts of few and of hot anchors and the last join share one exchange of the whole texts."""
    monkeypatch.setattr(suffix_dedup, "MOST_CONTEXTS", most)
    rng = random.Random(12)
    passage = rng.randbytes(300).hex()
    texts = [rng.randbytes(900).hex() + (passage if i % 8 == 0 else "") + rng.randbytes(900).hex() for i in range(80)]
    df = checkpointed(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(4))
    whole = shuffled(spark, lambda: df.select(F.xxhash64("doc_id").alias("h"), "text").repartition("h").write.format("noop").mode("overwrite").save())
    out = []
    every = shuffled(spark, lambda: out.extend(suffix_dedup.cleaned(df).collect()))
    want = brute_removal([t.encode() for t in texts], 400)
    assert [(r.q_bytes, sum(x.b - x.a for x in r.q_spans)) for r in sorted(out, key=lambda r: r.q_key)] == [x[:2] for x in want]
    assert whole < every < 2 * whole


def test_written_shuffles_go_at_once(spark):
    """What an exchange wrote is gone once its result is written; rows whose own exchanges went are still there."""
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    rows = spark.sparkContext.parallelize([(i % 50, "x" * i) for i in range(200)], 4).groupByKey(3).mapValues(len)
    df = spark.createDataFrame(rows, "k long, n long")
    counted = lambda: df.join(df.groupBy("n").count(), "n").repartition(5, "k")
    kept, alone = counted(), counted()
    checkpointed(kept)
    lineage = lambda x: shuffles(x._jdf.queryExecution().executedPlan().execute())
    left = lineage(kept)
    assert len(left) >= 3 and all(map(tracker.containsShuffle, left))
    out = checkpointed_alone(alone)
    gone = lineage(alone)
    assert gone and not any(map(tracker.containsShuffle, gone))
    assert out.count() == 50 and rows.count() == 50 and not shuffles(out._jdf.queryExecution().executedPlan().execute())


def test_indexes_leave_few_files(spark):
    """Of the exchanges before the texts', none is left when the last query runs, and spans go through theirs as numbers."""
    texts = [random.Random(i // 2).randbytes(600).hex() for i in range(20)]
    df = checkpointed(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(4))
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    first = spark.sparkContext._jsc.sc().newShuffleId()
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the shuffles of small broadcast sides stay
    try:
        _, found = suffix_dedup.spans(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert not any(map(tracker.containsShuffle, range(first, spark.sparkContext._jsc.sc().newShuffleId())))
    assert dict(found.dtypes)["q_spans"] == "array<bigint>"


@pytest.mark.parametrize(("spans", "runs"), [([(0, 400)], [(0, 400)]), ([(300, 900), (5, 405), (405, 500), (5, 450)], [(5, 900)]), ([(700, 1100), (0, 400), (10, 30)], [(0, 400), (700, 1000)])])
def test_packed_spans_merge(spark, spans, runs):
    numbers = [r[0] for r in spark.createDataFrame(spans, "a long, b long").select(suffix_dedup.packed(F.col("a"), F.col("b"))).collect()]
    assert suffix_dedup.merged(np.array(numbers), 1000) == runs


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(2)
    passage = bytes(rng.integers(97, 100, 400, dtype=np.uint8))
    found = []
    for k in (0, 13, 777):
        t = bytes(rng.integers(97, 100, k, dtype=np.uint8)) + passage + bytes(rng.integers(97, 100, 500, dtype=np.uint8))
        ((_, pos, h),) = suffix_dedup.document_anchors([t], suffix_dedup.Shape())
        found.append({(p - k, x) for p, x in zip(pos.tolist(), h.tolist(), strict=True) if k <= p <= k + 400 - suffix_dedup.GRAM})
    assert found[0] & found[1] & found[2]


# --- mixing


def brute_targets(sizes):
    weight, total = [(5, 2, 1)[i % 3] for i in range(len(sizes))], sum(sizes)
    out, fixed, rest = [0.0] * len(sizes), set(), float(total)
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        share = sum(weight[i] for i in free)
        over = [i for i in free if rest * weight[i] / share > 3 * sizes[i]]
        if not over:
            for i in free:
                out[i] = rest * weight[i] / share
            return out
        for i in over:
            out[i] = 3.0 * sizes[i]
        rest -= sum(3.0 * sizes[i] for i in over)
        fixed.update(over)


def test_targets():
    rng = random.Random(1)
    for _ in range(200):
        sizes = [rng.choice([0, 1, 10, rng.randint(1, 5000)]) for _ in range(rng.randint(1, 9))]
        assert np.allclose(mixing.targets(sizes), brute_targets(sizes)) if sum(sizes) else mixing.targets(sizes) == [0] * len(sizes)


def test_splitting_tree_has_exact_quotas():
    rng = np.random.default_rng(0)
    counts = np.array([100, 7, 0, 33])
    for shards in (1, 2, 7, 16):
        q = mixing.split(counts, shards, rng)
        assert q.shape == (shards, 4) and (q.sum(axis=0) == counts).all() and np.ptp(q.sum(axis=1)) <= 1 and (q >= 0).all()


def test_mix(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r for r in mixing.op9_mixing(spark, "/root/testdata/sf0.01").collect()}
    again = {r.doc_id: r.taken for r in mixing.op9_mixing(spark, "/root/testdata/sf0.01").collect()}
    assert {k: r.taken for k, r in rows.items()} == again
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for d in df.collect():
        r = rows[d.doc_id]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", d.text)) and 0 <= r.taken <= 3 * r["size"]
        size[d.source] += r["size"]
        taken[d.source] += r.taken
        target[d.source] = r.target
    names = sorted(size)
    assert np.allclose([target[n] for n in names], brute_targets([size[n] for n in names]))
    assert all(abs(taken[n] - target[n]) < 0.01 * target[n] for n in names)
    mixed = collections.defaultdict(list)
    out = mixing.mix(df).select("doc_id", "mix_shard", "mix_rank", F.spark_partition_id().alias("p")).collect()
    for x in out:
        mixed[x.doc_id].append(x.mix_shard)
    assert all(len(mixed[k]) * r["size"] == r.taken and sorted(mixed[k]) == r.shards for k, r in rows.items())
    # rows are in the order of shard and rank over all partitions
    assert [(x.mix_shard, x.mix_rank) for x in out] == sorted((x.mix_shard, x.mix_rank) for x in out)
    # the tree's quotas: shards have equal numbers of blocks, and each source's blocks lie in all that it gives quotas
    _, drawn, _, (shards, _) = mixing.draw(df)
    blocks = collections.Counter(x.mix_shard for x in drawn.collect())
    assert 1 < len(blocks) == shards and max(blocks.values()) - min(blocks.values()) <= 1
    assert {s for r in rows.values() for s in r.shards} == set(range(shards))


def test_mix_of_repeated_rows(spark, tmp_path):
    """Every row is a document: 205 in, 205 out."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    some = docs.limit(4)
    odd = some.limit(1).withColumn("text", F.lit("other words of one key"))
    docs.unionByName(some).unionByName(odd).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = mixing.op9_mixing(spark, str(tmp_path)).collect()
    assert len(rows) == docs.count() == 205
    want = sorted((d.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", d.text or ""))) for d in docs.collect())
    assert sorted((r.doc_id, r["size"]) for r in rows) == want and all(0 <= r.taken <= 3 * r["size"] for r in rows)
    assert sum(len(r.shards) for r in rows) == mixing.mix(docs).count()


def test_mix_with_long_documents(spark, tmp_path):
    """One document of each source is longer than the others of some blocks together; the others can still meet the target."""
    rng = random.Random(3)
    rows = [(i * 1000 + j, "w " * (20_000 if j == 0 else rng.randint(5, 60)), f"s{i}") for i in range(9) for j in range(700)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    taken, target = collections.Counter(), {}
    for r in mixing.op9_mixing(spark, str(tmp_path)).collect():
        taken[f"s{r.doc_id // 1000}"] += r.taken
        target[f"s{r.doc_id // 1000}"] = r.target
    assert all(abs(taken[n] - target[n]) < 0.01 * target[n] for n in target), (taken, target)


def test_mix_of_odd_tables(spark):
    schema = "doc_id long, text string, source string, size string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, None, None, "a"), (2, "one two", None, "b"), (3, "x y z", "b", "c"), (4, "", "a", "d"), (4, "q", "a", "e")]
    df = spark.createDataFrame(rows, schema)
    placed, *_ = mixing.draw(df)
    found = {r.key: r for r in placed.collect()}
    assert found[2].source is None and found[4]["size"] == 1 and found[1]["size"] == 0
    assert mixing.mix(df).columns[:4] == df.columns


# --- pipeline


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "suffix_array_dedup", "mixing", "sentencepiece"] and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns
        out = out.cache()
        counts.append((docs.count(), out.count()))
        docs = out
    assert counts[0][1] <= counts[0][0] and counts[1][1] < counts[1][0] and counts[2][0] == counts[2][1] and counts[3][1] > 0
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    assert labels
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert last.count() == docs.count() and all(r.n_tokens == len(r.ids) for r in last.collect())


def test_stages_take_odd_rows(spark):
    """Null texts, sources and keys, empty texts and repeated rows through all stages; no rows at all."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "some text without a key", "en", "s", 23), (10**9, None, "en", None, None), (10**9 + 1, "", None, "s", 0), (10**9 + 1, "", None, "s", 0)], docs.schema)
    rows = docs.limit(60).unionByName(docs.limit(5)).unionByName(odd)
    for given in (rows, rows.limit(0)):
        kept = given
        for _, stage in corpus_pipeline.STAGES:
            kept = stage(spark, kept, DATA).cache()
        assert (kept.count() > 0) == (given.count() > 0) and kept.where("n_tokens <> size(ids)").count() == 0


@pytest.mark.parametrize("at_once", [-1, 1000])
def test_components(spark, monkeypatch, at_once):
    """In rounds and in one task: a chain, a star, a pair."""
    monkeypatch.setattr(near_dedup, "AT_ONCE", at_once)
    chain = [(i, i + 1) for i in range(100, 117)]
    edges = [*chain, *((50, 50 + i) for i in range(1, 9)), (7, 3)]
    random.Random(1).shuffle(edges)
    out = dict(near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert out == {**dict.fromkeys(range(100, 118), 100), **dict.fromkeys(range(50, 59), 50), 3: 3, 7: 3}
    assert near_dedup.components(spark.createDataFrame([], "a long, b long")).count() == 0
