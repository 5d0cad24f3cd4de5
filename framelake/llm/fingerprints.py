"""Canonical exact digests of documents, in DataFrame operations alone.

A text's canonical form is its Unicode NFKC form, lower case, with each run of white space as one space and none at
the ends. Its fingerprint is 128 bits wide: two 64-bit xxhash values of the canonical form's bytes, with different
seeds, as 32 hexadecimal digits. Documents with equal fingerprints share a bucket; within a bucket only those whose
canonical bytes are equal form a class.

Null texts count as empty, and all blank texts are equal. Every row gives a row, repeated ones too. Rows that share a
key stand together in the order of keys: the document after them is the next key's, of several that with the least
beginning, then the least fingerprint. A row without a key has no place in that order: nothing follows it, so its
edited text is its own and ``near_next`` is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelake.llm.common import checkpointed, table


def canonical(text: Column) -> Column:
    """NFKC, lower case, white space folded. Plain ASCII needs no normalisation."""
    t = F.coalesce(text, F.lit(""))
    # the JVM's Unicode library, called by name: compose(text, true) is NFKC
    nfkc = F.when(F.octet_length(t) == F.length(t), t).otherwise(F.call_function("reflect", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), t, F.lit(True)))
    return F.trim(F.regexp_replace(F.lower(nfkc), r"(?U)\s+", " "))


def wide_hash(text: Column) -> Column:
    """128 bits as 32 hexadecimal digits."""
    part = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    return F.concat(part(F.xxhash64(text)), part(F.xxhash64(F.lit(0x5BD1E995), text)))


def fingerprint(text: Column) -> Column:
    return wide_hash(canonical(text))


def likeness(a: Column, b: Column) -> Column:
    """An exact digest tells equal from different: 1 or 0."""
    return (a == b).cast("double")


def classes(documents: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(fingerprint, class_id, n_copies) of buckets of several rows with equal bytes, named by their least key, and (fingerprint, q_digest, class_id, n_copies) of collided ones.

    Rows meet by fingerprint; texts are fetched by key, and only those of shared buckets. The least and the greatest
    canonical text of a bucket are kept as the tasks' partial results, so a large group of copies never gathers; only
    a bucket in which these two differ (a hash collision) is grouped by its texts; ``q_digest`` is the SHA-512
    of their canonical text. Buckets without a key have no class.
    """
    ids = checkpointed(documents.select(F.col(key).alias("q_id"), fingerprint(F.col(text)).alias("fingerprint")))
    shared = ids.groupBy("fingerprint").agg(F.count("*").alias("n_copies"), F.min("q_id").alias("class_id")).where("n_copies > 1 and class_id is not null")
    wanted = ids.join(shared.select("fingerprint"), "fingerprint").where("q_id is not null").select(F.col("q_id").alias(key)).distinct()
    rows = documents.select(key, text).join(wanted.hint("shuffle_hash"), key).select(F.col(key).alias("q_id"), canonical(F.col(text)).alias("q_text"))
    rows = rows.withColumn("fingerprint", wide_hash(F.col("q_text")))
    ends = rows.groupBy("fingerprint").agg(F.min("q_text").alias("q_low"), F.max("q_text").alias("q_high")).select("fingerprint", (F.col("q_low") != F.col("q_high")).alias("q_torn"))
    marked = shared.join(ends, "fingerprint", "left")
    whole = marked.where("not coalesce(q_torn, false)").select("fingerprint", "class_id", "n_copies")
    # n rows have n * n / 2**129 collisions by chance: next to none, whatever the input
    collided = F.broadcast(ends.where("q_torn").select("fingerprint"))
    torn = rows.join(collided, "fingerprint", "left_semi").groupBy("fingerprint", F.sha2("q_text", 512).alias("q_digest")).agg(F.min("q_id").alias("class_id"), F.count("*").alias("n_copies"))
    return whole, torn


def neighbours(ids: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """(key, next): the key that follows in ascending order, after the last the first; every key once, null ones left out.

    Keys are dealt by ranges and numbered within them; only the ends of the ranges, a row for each partition, are put
    in order in one task. Numbers come from the written table, so a repeated task can't change them.
    """
    spark = ids.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = ids.where(F.col(key).isNotNull()).select(key).distinct().repartitionByRange(n, key).sortWithinPartitions(key)
    placed = checkpointed(placed.select(key, F.monotonically_increasing_id().alias("q_at")))
    after = placed.select(F.col(key).alias("next"), (F.col("q_at") - 1).alias("q_at"))
    ends = placed.groupBy(F.shiftright("q_at", 33).alias("q_part")).agg(F.min(key).alias("q_first"), F.max("q_at").alias("q_at"))
    order = Window.orderBy("q_part")
    around = F.first("q_first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.select("q_at", F.coalesce(F.lead("q_first").over(order), around).alias("q_wrapped"))
    return placed.join(after, "q_at", "left").join(F.broadcast(ends), "q_at", "left").select(key, F.coalesce("next", "q_wrapped").alias("next"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, how like they are to each other and to the next document's, and the class of equal documents."""
    return edited(table(spark, sf_dir, "documents"))


def edited(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row the fingerprints of its text and of its text with the last quarter replaced by the beginning of the next document's, and its class."""
    # a column renamed to its own name would make each use of the exchange below a plan of its own
    documents = documents.select(F.col(key) if key == "doc_id" else F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    placed = documents.where("doc_id is not null")
    quarter = lambda n: F.floor(n / 4).cast("int")
    sizes = placed.groupBy("doc_id").agg(F.max(quarter(F.length("text"))).alias("q_n"))
    order = neighbours(placed.select("doc_id"), "doc_id")
    # texts are dealt by doc_id once; all joins read that exchange. A quarter of a text moves to its predecessor
    wanted = order.join(sizes, "doc_id").select(F.col("doc_id").alias("q_for"), F.col("next").alias("doc_id"), "q_n")
    heads = placed.join(wanted.hint("shuffle_hash"), "doc_id").select(F.col("q_for").alias("doc_id"), F.struct(F.substring("text", F.lit(1), F.col("q_n")).alias("head"), fingerprint(F.col("text")).alias("fingerprint")).alias("x"))
    joined = placed.join(heads.groupBy("doc_id").agg(F.min("x").alias("x")).hint("shuffle_hash"), "doc_id")
    n = F.length("text")
    new = F.concat(F.substring("text", F.lit(1), n - quarter(n)), F.substring(F.col("x.head"), F.lit(1), quarter(n)))
    facts = lambda rows, new, following: rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(new, 256).alias("edited_sha256"), canonical(F.col("text")).alias("q_text"), canonical(new).alias("q_edited"), following.alias("q_next")
    )
    found = facts(joined, new, F.col("x.fingerprint")).unionByName(facts(documents.where("doc_id is null"), F.col("text"), F.lit(None).cast("string")))
    found = found.select("doc_id", "n_chars", "edited_sha256", wide_hash(F.col("q_text")).alias("fingerprint"), wide_hash(F.col("q_edited")).alias("edited_fingerprint"), F.sha2("q_text", 512).alias("q_digest"), "q_next")
    whole, torn = classes(placed)
    torn = F.broadcast(torn.withColumnsRenamed({"class_id": "t_class", "n_copies": "t_copies"}))
    found = found.join(whole, "fingerprint", "left").join(torn, ["fingerprint", "q_digest"], "left")
    return found.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        F.coalesce(likeness(F.col("fingerprint"), F.col("q_next")), F.lit(0.0)).alias("near_next"), F.coalesce("class_id", "t_class", "doc_id").alias("class_id"), F.coalesce("n_copies", "t_copies", F.lit(1)).alias("n_copies"),
    )
