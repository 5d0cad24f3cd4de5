"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents are dealt to blocks by a hash, up to ``MOST_BLOCKS`` blocks for each source; a document larger than a block's
usual size is a block of its own. A source's target is cut into whole passes over it, those blocks of a random order
that still fit (see ``fill``), and one last block of several documents, of which documents are picked so that the
source comes as near to its target as they allow. The drawn blocks of all sources are then split among the output
shards: a node of a binary tree over the shards hands its left half a multivariate-hypergeometric draw of its
blocks' counts, which leaves each shard exact quotas of every source. Quotas take consecutive, so disjoint, parts of
the source's permuted blocks; inside a shard documents are ordered by a hash.

The driver sees a row for each block, never documents: ALL_BLOCKS blocks of several documents over all sources and one
more for each source, as many long documents at most. All draws follow from hashes and a seed, so reruns agree.

Null texts have size 0; a document of size 0 goes with its block. A null source is a source of its own, last in order.
Every row is a document, repeated ones too: rows of equal key, source and text go together, other rows that share a
key go each their own way. Rows are told apart by a 64-bit hash of these three: of n rows with one key about
n * n / 2**65 pairs share one by chance. No rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelake.llm.common import WORD, checkpointed, table
from framelake.session import share_code

WEIGHTS = (5.0, 2.0, 1.0)
MOST_TIMES = 3
MOST_BLOCKS, BLOCK_DOCUMENTS = 4096, 64
#: Blocks of several documents over all sources, shared out by their numbers of documents.
ALL_BLOCKS = 1 << 18
#: Words of an output shard (about 64 MB of text) and of a task's part of one.
SHARD_WORDS, PART_WORDS = 1 << 23, 1 << 24
#: Shards at least, if there are as many blocks, and at most; the driver's table of quotas has a cell for each shard and source.
LEAST_SHARDS, MOST_SHARDS, MOST_QUOTAS = 16, 1 << 14, 1 << 24
#: An assignment table of so many rows at most is broadcast (under 10 MB); a larger one is joined by shuffling.
MOST_BROADCAST = 100_000


def targets(sizes: list[float], weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: float = MOST_TIMES) -> list[float]:
    """Targets of sources in order: ``share`` of all sizes by repeating weights, none above ``most`` times its size."""
    size = np.asarray(sizes, float)
    weight = np.array([weights[i % len(weights)] for i in range(len(size))])
    out, free, rest = np.zeros(len(size)), np.ones(len(size), bool), share * size.sum()
    while free.any():
        due = rest * weight / weight[free].sum()
        over = free & (due > most * size)
        if not over.any():
            out[free] = due[free]
            break
        out[over] = most * size[over]
        rest -= out[over].sum()
        free &= ~over
    return out.tolist()


def split(counts: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Quotas (shards x sources) whose columns sum to ``counts`` and whose rows differ by one at most."""
    if shards == 1:
        return counts[None, :]
    left = shards // 2
    n = int(counts.sum())
    # of n blocks over the shards, the first n % shards get one more
    to_left = left * (n // shards) + min(left, n % shards)
    drawn = rng.multivariate_hypergeometric(counts, to_left, method="marginals")
    return np.vstack([split(drawn, left, rng), split(counts - drawn, shards - left, rng)])


def fill(blocks: list[tuple[int, int]], due: float) -> tuple[list[tuple[int, int]], list[tuple[int, int]], float]:
    """Of (block, size) in order those that still fit, the others of several documents, and the words still due.

    If only long documents are left, the least of them is taken before the blocks of several documents, which then
    fill what remains; if it's too long for that, it is taken instead of them if that comes nearer.
    """

    def fitting(blocks: list[tuple[int, int]], left: float) -> tuple[list[tuple[int, int]], list[tuple[int, int]], float]:
        taken, over = [], []
        for x in blocks:
            if x[1] > left:
                over.append(x)
            else:
                taken.append(x)
                left -= x[1]
        return taken, over, left

    taken, over, left = fitting(blocks, due)
    several = [x for x in over if x[0] < MOST_BLOCKS]
    if several or not over or left < 0.5:
        return taken, several, left
    long = [*(x for x in taken if x[0] >= MOST_BLOCKS), min(over, key=lambda x: (x[1], x[0]))]
    room = due - sum(size for _, size in long)
    if room >= 0:
        return fitting([*long, *(x for x in blocks if x[0] < MOST_BLOCKS)], due)
    return (long, [], 0.0) if -room < left else (taken, [], left)


def plan(blocks: list[tuple[str | None, int, int]], shards: int, seed: int, weights: tuple[float, ...] = WEIGHTS) -> tuple[list[tuple], list[tuple]]:
    """From (source, block, size): (source, size, target, passes, last block, words due from it) in order, and drawn (source, block, pass, shard)."""
    rng = np.random.default_rng(seed)
    own: dict[str | None, list[tuple[int, int]]] = {}
    for source, block, size in blocks:
        own.setdefault(source, []).append((block, size))
    order = sorted(own, key=lambda x: (x is None, x or ""))  # Python compares strings by code point
    sizes = [sum(size for _, size in own[x]) for x in order]
    sources, drawn = [], []
    for source, total, target in zip(order, sizes, targets(sizes, weights), strict=True):
        mixed = [sorted(own[source])[i] for i in rng.permutation(len(own[source]))]
        passes = int(target // total) if total else 0
        due = target - passes * total if total else 0.0
        last, rest, some = -1, 0.0, []
        if due >= 0.5:
            taken, over, left = fill(mixed, due)
            if left >= 0.5 and over:
                last, rest = over[0][0], left
            some = [(block, passes) for block, _ in taken] + [(last, passes)] * (last >= 0)
        sources.append((source, total, target, passes, last, rest))
        drawn.append([(block, p) for p in range(passes) for block, _ in mixed] + some)
    if not order:
        return [], []
    quotas = split(np.array([len(x) for x in drawn], np.int64), shards, rng)
    out = []
    for i, source in enumerate(order):
        shard = np.repeat(np.arange(shards), quotas[:, i])
        out += [(source, *drawn[i][k], int(shard[j])) for j, k in enumerate(rng.permutation(len(drawn[i])).tolist())]
    return sources, out


def pick(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of a source's last block the documents to take: by falling size, each that still fits what is left to take.

    One more is taken if that comes nearer.
    """
    pdf = pdf.sort_values(["size", "h", "q_row"], ascending=[False, True, True], ignore_index=True)
    left, taken = float(pdf["rest"].iloc[0]), np.zeros(len(pdf), bool)
    for i, size in enumerate(pdf["size"]):
        if size <= left:
            taken[i], left = True, left - size
    others = np.flatnonzero(~taken)
    if len(others):
        i = others[np.argmin(pdf["size"].to_numpy()[others])]
        if pdf["size"][i] - left < left:
            taken[i] = True
    return pdf.assign(taken=taken)[["key", "q_row", "taken"]]


def shards_for(words: float, blocks: int, sources: int) -> int:
    """Output shards: about SHARD_WORDS words each, within the limits above."""
    return int(max(1, min(max(LEAST_SHARDS, -(-words // SHARD_WORDS)), blocks, MOST_SHARDS, MOST_QUOTAS // max(1, sources))))


def units(documents: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """``documents`` as (key, source, size, q_row): what tells rows apart."""
    size = F.coalesce(F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)), F.lit(0)).cast("long")
    return documents.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), size.alias("size"), _row(key, source, text).alias("q_row"))


def _row(key: str, source: str, text: str) -> Column:
    # nulls leave a hash as it is, so each column says whether it is one
    return F.xxhash64(F.col(key), F.col(source).isNull(), F.col(source).cast("string"), F.col(text).isNull(), F.col(text))


def draw(
    documents: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", shards: int | None = None, seed: int = 11, weights: tuple[float, ...] = WEIGHTS
) -> tuple[DataFrame, DataFrame, DataFrame, tuple[int, int]]:
    """What the mix takes: (key, q_row, n, source, size, block, source_size, target, passes, last) with n equal rows of ``size`` words together, its
    blocks' shards, the picked (key, q_row) of last blocks, and the numbers of shards and of words taken."""
    spark = documents.sparkSession
    share_code(spark)
    slim = units(documents, key, source, text).groupBy("key", "q_row", "source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    slim = checkpointed(slim.withColumn("h", F.xxhash64(F.lit(seed), "q_row", F.col("key").cast("string"))))
    counts = checkpointed(slim.groupBy("source").agg(F.count("*").alias("units"), F.sum("size").alias("words")))
    total = counts.agg(F.count("*").alias("sources"), F.sum("units").alias("units")).first()
    share = F.ceil(F.col("units") * F.lit(ALL_BLOCKS) / F.lit(max(1, total["units"] or 1)))
    dealt = F.greatest(F.lit(1), F.least(F.lit(MOST_BLOCKS), share, F.ceil(F.col("units") / BLOCK_DOCUMENTS)))
    few = total["sources"] <= MOST_BROADCAST
    sized = _by_source(slim, counts.withColumnRenamed("source", "c_source"), "c_source", few).withColumn("dealt", dealt)
    # fewer than a source has blocks
    large = F.col("size") * F.col("dealt") > F.col("words")
    alone = sized.where((F.col("dealt") > 1) & large).withColumn("block", (F.lit(MOST_BLOCKS - 1) + F.row_number().over(Window.partitionBy("source").orderBy("h", "key", "q_row"))).cast("int"))
    placed = sized.where((F.col("dealt") == 1) | ~large).withColumn("block", F.pmod("h", "dealt").cast("int")).unionByName(alone).drop("units", "words", "dealt")
    placed = checkpointed(placed)
    blocks = placed.groupBy("source", "block").agg(F.sum("size").alias("size")).collect()  # a bounded row for each block
    taken = sum(x["size"] for x in blocks)
    shards = shards or shards_for(taken, len(blocks), total["sources"])
    sources, drawn = plan([(x["source"], x["block"], x["size"]) for x in blocks], shards, seed, weights)
    sources_df = spark.createDataFrame(sources, "s_source string, source_size long, target double, passes int, last int, rest double")
    drawn_df = spark.createDataFrame(drawn, "d_source string, d_block int, mix_pass int, mix_shard int")
    if len(drawn) <= MOST_BROADCAST:
        drawn_df = F.broadcast(drawn_df)
    placed = _by_source(placed, sources_df, "s_source", len(sources) <= MOST_BROADCAST)
    picked = placed.where(F.col("block") == F.col("last")).select("key", "q_row", F.coalesce("source", F.lit("")).alias("source"), F.col("source").isNull().alias("nosource"), "size", "h", "rest")
    picked = checkpointed(picked.groupBy("source", "nosource").applyInPandas(lambda pdf: pick(pdf), f"key {documents.schema[key].dataType.simpleString()}, q_row long, taken boolean"))
    return placed, drawn_df, picked.where("taken"), (shards, taken)


def _by_source(rows: DataFrame, other: DataFrame, name: str, few: bool) -> DataFrame:
    return rows.join(F.broadcast(other) if few else other, F.col("source").eqNullSafe(F.col(name))).drop(name)


def takings(placed: DataFrame, drawn: DataFrame, picked: DataFrame) -> DataFrame:
    """(key, q_row, mix_pass, mix_shard): a row for each time that the mix takes a unit, with null passes and shards for units that it leaves."""
    rows = placed.join(drawn, F.col("source").eqNullSafe(F.col("d_source")) & (F.col("block") == F.col("d_block")), "left")
    one = picked.select(F.col("key").alias("p_key"), F.col("q_row").alias("p_row"), F.lit(True).alias("one"))
    rows = rows.join(one, (F.col("q_row") == F.col("p_row")) & F.col("key").eqNullSafe(F.col("p_key")), "left")
    # of a last block, the last pass takes picked documents alone
    left = (F.col("block") == F.col("last")) & (F.col("mix_pass") == F.col("passes")) & F.col("one").isNull()
    return rows.withColumns({c: F.when(~left, F.col(c)) for c in ("mix_pass", "mix_shard")}).drop("d_source", "d_block", "p_key", "p_row", "one")


def mix(documents: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", shards: int | None = None, seed: int = 11) -> DataFrame:
    """``documents``' rows once for each time that the mix takes them, with mix_shard, mix_pass and mix_rank, the order inside a shard.

    Shards follow the words taken (see ``shards_for``) unless ``shards`` says how many. Rows are in the order of shard and
    rank over all partitions; a shard is cut into as many partitions as its words need.
    """
    placed, drawn, picked, (shards, words) = draw(documents, key, source, text, shards, seed)
    rows = takings(placed, drawn, picked).where("mix_pass is not null")
    taken = rows.select(F.col("key").alias("q_key"), "q_row", "mix_shard", "mix_pass", F.xxhash64(F.lit(seed + 1), "h", "mix_pass").alias("mix_rank"))
    own = documents.drop("mix_shard", "mix_pass", "mix_rank", "q_key", "q_row")
    out = own.withColumn("q_own", _row(key, source, text)).join(taken, (F.col("q_own") == F.col("q_row")) & F.col(key).eqNullSafe(F.col("q_key"))).drop("q_key", "q_own", "q_row")
    # ranks are even over 64 bits: equal ranges of them are equal parts of a shard
    parts = max(1, -(-int(words) // (shards * PART_WORDS)))
    part = F.least(F.floor((F.col("mix_rank").cast("double") + 2.0**63) * (parts / 2.0**64)), F.lit(parts - 1))
    return out.repartitionById(shards * parts, (F.col("mix_shard") * parts + part).cast("int")).sortWithinPartitions("mix_shard", "mix_rank")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes, and into which shards."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    placed, drawn, picked, _ = draw(documents)
    found = takings(placed, drawn, picked).groupBy("key", "q_row", "source").agg(
        F.first("size").alias("size"), F.first("n").alias("n"), F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.array_sort(F.collect_list("mix_shard")).alias("shards")
    )
    # of n equal rows together, each
    rows = found.select("*", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("q_i"))
    own = (F.col("size") / F.col("n")).cast("long")
    return rows.select(F.col("key").alias("doc_id"), own.alias("size"), "source_size", "target", (F.size("shards") * own).cast("long").alias("taken"), "shards")
