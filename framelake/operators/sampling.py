"""Samples of frames and files. Random choice is by rank of an md5 of seed and key, so it is the same on any engine and partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.operators.temporal import keyed

#: A list of so many indices at most is broadcast (some MB).
MOST_BROADCAST = 100_000


def draw(seed: int, *keys: str) -> Column:
    """The sort key of a random order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))


def random_rows(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """Exactly ``n`` random rows (all if there are fewer): a top-k, each task keeps n rows."""
    return df.withColumn("q_r", draw(seed, *keys)).orderBy("q_r", *keys).limit(n).drop("q_r")


def per_group(df: DataFrame, n: int | Column, seed: int, by: str | list[str], *keys: str) -> DataFrame:
    """``n`` random rows of each group."""
    w = Window.partitionBy(*keyed(by)).orderBy(draw(seed, *keyed(by), *keys), *keys)
    return df.withColumn("q_n", F.row_number().over(w)).where(F.col("q_n") <= n).drop("q_n")


def uniform(df: DataFrame, k: int, by: str | list[str] = "session", order: str = "frame_idx") -> DataFrame:
    """Every (count // k)-th frame, from that one on."""
    counts = df.groupBy(*keyed(by)).agg(F.count("*").alias("q_n"))
    step = F.greatest(F.lit(1), F.floor(F.col("q_n") / k))
    return df.join(counts, keyed(by)).where((F.col(order) >= step) & (F.col(order) % step == 0)).drop("q_n")


def listed(df: DataFrame, indices: list[int], order: str = "frame_idx") -> DataFrame:
    """Rows at given indices, each as often as it is listed, with its ``place`` in the list."""
    wanted = df.sparkSession.createDataFrame([(i, int(x)) for i, x in enumerate(indices)], f"place int, {order} long")
    return df.join(F.broadcast(wanted) if len(indices) <= MOST_BROADCAST else wanted, order)


def split(df: DataFrame, share: float, seed: int, *keys: str, into: str = "fold") -> DataFrame:
    """A random train and test fold, exactly ``int(n * share)`` rows for training.

    Ranks are counted in two steps, by the first two digits of the md5 and inside each of these 256 parts, so no task
    sorts all rows.
    """
    r = df.withColumn("q_r", draw(seed, *keys)).withColumn("q_p", F.substring("q_r", 1, 2))
    sizes = r.groupBy("q_p").agg(F.count("*").alias("q_c"))
    before = sizes.select("q_p", (F.sum("q_c").over(Window.orderBy("q_p").rowsBetween(Window.unboundedPreceding, 0)) - F.col("q_c")).alias("q_b"), F.sum("q_c").over(Window.partitionBy()).alias("q_all"))
    ranked = r.withColumn("q_i", F.row_number().over(Window.partitionBy("q_p").orderBy("q_r", *keys))).join(F.broadcast(before), "q_p")
    train = F.col("q_b") + F.col("q_i") <= F.floor(F.col("q_all") * share)
    return ranked.withColumn(into, F.when(train, F.lit("train")).otherwise(F.lit("test"))).drop("q_r", "q_p", "q_i", "q_b", "q_all")


def diverse(frames: DataFrame, pixels: str, n: int, clusters: int, seed: int, by: str = "session", order: str = "frame_idx") -> DataFrame:
    """Random members of k-means clusters of mean-centred frames, max(n // clusters, 1) of each."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    mean = F.aggregate(pixels, F.lit(0.0), lambda a, v: a + v) / F.size(pixels)
    rows = frames.withColumn("q_v", array_to_vector(F.transform(pixels, lambda v: v - mean)))
    model = KMeans(k=clusters, seed=seed, maxIter=50, tol=1e-3, featuresCol="q_v", predictionCol="cluster").fit(rows)
    return per_group(model.transform(rows).drop("q_v"), max(n // clusters, 1), seed, "cluster", by, order)


def per_file(n: int, files: Column) -> Column:
    """Samples to take of each file so that ``n`` come together."""
    return F.ceil(F.lit(n) / files)
