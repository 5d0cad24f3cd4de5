"""Quality rules by distribution divergence, in DataFrame operations alone.

A document's histograms of character classes and of common words are held against a reference histogram for each
language, by the Jensen-Shannon distance (square root of the divergence to base 2, 0 to 1). References are summed
over all documents with a language; the languages are few, so the table of references has a bounded size:
languages x (classes + common words), under a kilobyte for each language. A document is kept
if it passes the base rules and, by either histogram, comes near enough to some language's reference. Documents under ``LEAST_CHARS``
characters or ``LEAST_WORDS`` words are too short for their histograms to say anything and pass the method.

Null texts count as empty: no words, base_failed true, kept false. Repeated rows are judged each on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm.common import SPACE, checkpointed, table

#: Character classes in order; a character is of the first class that has it, or an accented letter or the like, or none of these.
SYMBOLS = "#*$%&|<>"
CLASSES = {
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "space": " \t\n\x0b\x0c\r",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "mark": ".,;:!?'\"-()",
    "symbol": SYMBOLS,
    "digit": "0123456789",
    "sign": "+=@/\\_~^`{}[]",
}
N_CLASSES = len(CLASSES) + 2
#: Function words whose shares make the second histogram, for each language; the rest of a text's words is one more bin.
COMMON_WORDS = {
    "en": "the of and to in is that for it with".split(),
    "de": "der die und in den von zu das mit ist".split(),
    "fr": "de la le et les des en un du que".split(),
    "es": "de la que el en y los se del por".split(),
}
#: Distances over which a document is held to be unlike every language.
MOST_CHAR_DISTANCE, MOST_WORD_DISTANCE = 0.3, 0.6
LEAST_CHARS, LEAST_WORDS = 200, 40
LEAST_BASE_WORDS, MOST_REPEATED = 10, 20
VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words})


def words_of(text: Column) -> Column:
    """The words of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def window_hashes(words: Column) -> Column:
    """A 64-bit hash for each five-word window."""
    return F.when(F.size(words) >= 5, F.transform(F.sequence(F.lit(1), F.size(words) - 4), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(-1, 4))))).otherwise(F.array().cast("array<bigint>"))


def repeated_words(words: Column, hashes: Column) -> Column:
    """Words inside five-word windows that occur twice or more in the text.

    Texts whose window hashes all differ are done at once. In the others the windows are sorted by hash; a window
    counts if its neighbour has the same hash and the same words.
    """
    window = lambda i: F.slice(words, i, 5)
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i"))))

    def starts(p: Column) -> Column:
        near = lambda a, b: (a["h"] == b["h"]) & (window(a["i"]) == window(b["i"]))
        same = F.filter(F.transform(p, lambda x, k: F.when(((k > 0) & near(x, F.get(p, k - 1))) | ((k + 1 < F.size(p)) & near(x, F.get(p, k + 1))), x["i"])), lambda i: i.isNotNull())
        return F.array_sort(same)

    def covered(s: Column) -> Column:
        return F.aggregate(F.transform(s, lambda i, k: F.when(k + 1 < F.size(s), F.least(F.get(s, k + 1) - i, F.lit(5))).otherwise(F.lit(5))), F.lit(0), lambda a, x: a + x)

    # one-element transforms bind an expression once, so that it isn't computed again wherever it is used
    bound = F.transform(F.transform(F.array(pairs), lambda p: starts(p)), lambda s: F.when(F.size(s) > 0, covered(s)).otherwise(F.lit(0)))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(F.get(bound, 0)).cast("long")


def bind(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it and inside whatever lambda."""
    return F.get(F.transform(F.array(value), f), 0)


def _class_counts(text: Column) -> list[Column]:
    """Characters of each class of CLASSES, of other multi-byte characters, and of none."""
    left, out = text, []
    for chars in CLASSES.values():
        rest = F.translate(left, chars, "")
        out.append(F.length(left) - F.length(rest))
        left = rest
    accents = F.least(F.octet_length(left) - F.length(left), F.length(left))
    return [*out, accents, F.length(left) - accents]


def _common(words: Column) -> Column:
    """The common words of a list, lower case and without punctuation at the end, each between spaces, as one string."""
    known = F.array(*(F.lit(w) for w in VOCABULARY))
    longest = max(map(len, VOCABULARY))
    short = F.transform(F.filter(words, lambda w: F.length(w) <= longest + 3), lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))))
    return F.concat(F.lit(" "), F.array_join(F.filter(short, lambda w: F.array_contains(known, w)), "  "), F.lit(" "))


def _word_counts(common: Column) -> list[Column]:
    """How often each word of VOCABULARY stands in a string of ``_common``."""
    return [((F.length(common) - F.length(F.replace(common, F.lit(f" {w} "), F.lit("")))) / F.lit(len(w) + 2)).cast("int") for w in VOCABULARY]


def statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base counts, ``q_chars`` (characters by class) and ``q_words`` (counts of VOCABULARY's words)."""
    # each select computes what later ones use more than once
    out = documents.select(*documents.columns, F.coalesce(F.col(text), F.lit("")).alias("q_text"), words_of(F.col(text)).alias("q_list"))
    lines = F.filter(F.split("q_text", "\n"), lambda x: F.length(F.trim(x, F.lit(" \t\x0b\x0c\r"))) > 0)
    out = out.select(*documents.columns, "q_text", "q_list", window_hashes(F.col("q_list")).alias("q_hashes"), lines.alias("q_lines"), _common(F.col("q_list")).alias("q_common"), F.array(*_class_counts(F.col("q_text"))).alias("q_chars"))
    at = {name: i for i, name in enumerate(CLASSES)}
    return out.select(
        *documents.columns,
        F.size("q_list").cast("long").alias("n_words"),
        (F.length("q_text") - F.get("q_chars", F.lit(at["space"]))).cast("long").alias("word_chars"),
        F.get("q_chars", F.lit(at["symbol"])).cast("long").alias("n_symbols"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("q_list"), F.col("q_hashes")).alias("n_repeat_words"),
        "q_chars",
        F.array(*_word_counts(F.col("q_common"))).alias("q_words"),
    )


def shares(counts: Column, total: Column | None = None) -> Column:
    """A histogram of sum 1; with ``total``, one more bin has what is left of it. Empty histograms are all null."""
    add = lambda h: F.aggregate(h, F.lit(0.0), lambda a, x: a + x)
    numbers = F.transform(counts, lambda x: x.cast("double"))
    if total is not None:
        numbers = bind(numbers, lambda h: F.concat(h, F.array(F.greatest(total.cast("double") - add(h), F.lit(0.0)))))
    return bind(numbers, lambda h: bind(add(h), lambda t: F.transform(h, lambda x: F.when(t > 0, x / t))))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of sum 1 and equal length; null if either is empty."""
    part = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(a)
    divergence = F.aggregate(F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a)), F.lit(0.0), lambda a, x: a + x) / 2
    return bind(divergence, lambda d: F.when(d < 0, F.lit(0.0)).otherwise(F.sqrt(d)))


def references(found: DataFrame, lang: str = "lang") -> DataFrame:
    """From ``statistics`` one row with ``refs``, an array of (lang, chars, words): histograms summed over a language's documents."""
    sums = lambda c, n: [F.sum(F.get(c, F.lit(i)).cast("long")).alias(f"{c}{i}") for i in range(n)]
    one = found.where(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("lang")).agg(F.sum("n_words").alias("total"), *sums("q_chars", N_CLASSES), *sums("q_words", len(VOCABULARY)))
    array = lambda c, n: F.array(*(F.col(f"{c}{i}") for i in range(n)))
    rows = one.select("lang", "total", shares(array("q_chars", N_CLASSES)).alias("chars"), shares(array("q_words", len(VOCABULARY)), F.col("total")).alias("words"))
    return rows.agg(F.array_sort(F.collect_list(F.struct("lang", "chars", "words"))).alias("refs"))


def judge(found: DataFrame, refs: DataFrame) -> DataFrame:
    """From ``statistics`` the distances to the nearest language, base_failed and kept."""
    out = found.crossJoin(F.broadcast(refs))  # one row of bounded size
    nearest = lambda own, field: F.coalesce(bind(own, lambda h: F.array_min(F.transform("refs", lambda r: distance(h, r[field])))), F.lit(0.0))
    out = out.withColumn("char_distance", nearest(shares(F.col("q_chars")), "chars"))
    out = out.withColumn("word_distance", nearest(shares(F.col("q_words"), F.col("n_words")), "words"))
    out = out.withColumn("base_failed", (F.col("n_words") < LEAST_BASE_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    short = (F.col("word_chars") < LEAST_CHARS) | (F.col("n_words") < LEAST_WORDS)
    near = (F.col("char_distance") <= MOST_CHAR_DISTANCE) & (F.col("word_distance") <= MOST_WORD_DISTANCE)
    return out.withColumn("kept", ~F.col("base_failed") & (short | near)).drop("refs", "q_chars", "q_words")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict for every document. Counts are written once; references and verdicts read them."""
    found = checkpointed(statistics(table(spark, sf_dir, "documents").select("doc_id", "lang", "text")).drop("text"))
    judged = judge(found, references(found))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("char_distance", 4).alias("char_distance"), F.round("word_distance", 4).alias("word_distance"))


def oracle() -> str:
    """op2's rows in SQL."""
    words = ", ".join(f"('{w}', {j})" for j, w in enumerate(VOCABULARY))
    longest = max(map(len, VOCABULARY)) + 3
    classes = [r"[a-z]", r"[\x20\x09-\x0D]", r"[A-Z]", r"""[-.,;:!?''"()]""", r"[#*$%&|<>]", r"[0-9]", r"[+=@/\\_~^`{}\[\]]"]
    counts = []
    for i, c in enumerate(classes):
        counts.append(f"c{i} AS (SELECT *, regexp_replace(r{i}, '{c}', '', 'g') AS r{i + 1} FROM {'d' if i == 0 else f'c{i - 1}'})")
    n = len(classes)
    bins = [f"length(r{i}) - length(r{i + 1})" for i in range(n)] + [f"least(strlen(r{n}) - length(r{n}), length(r{n}))", f"length(r{n}) - least(strlen(r{n}) - length(r{n}), length(r{n}))"]
    char = " UNION ALL ".join(f"SELECT doc_id, lang, 0 AS kind, {i} AS bin, {b} AS n FROM c{n - 1}" for i, b in enumerate(bins))
    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS r0, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
{", ".join(counts)},
v AS (SELECT * FROM (VALUES {words}) v(word, bin)),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
rep AS (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM win WHERE (doc_id, g) IN (SELECT (doc_id, g) FROM win GROUP BY doc_id, g HAVING count(*) > 1)),
reps AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM rep GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(r0, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
base AS (SELECT doc_id, len(w) AS n_words, length(r0) - length(regexp_replace(r0, '[\x20\x09-\x0D]', '', 'g')) AS n_space, length(r0) AS n, length(r0) - length(regexp_replace(r0, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d JOIN lines USING (doc_id) LEFT JOIN reps USING (doc_id)),
tok AS (SELECT doc_id, lang, lower(rtrim(x, '.,;:!?')) AS word FROM (SELECT doc_id, lang, unnest(w) AS x FROM d) WHERE length(x) <= {longest}),
cnt AS (SELECT doc_id, bin, count(*) AS n FROM tok JOIN v USING (word) GROUP BY 1, 2),
word AS (SELECT d.doc_id, d.lang, 1 AS kind, v.bin, coalesce(cnt.n, 0) AS n FROM d CROSS JOIN v LEFT JOIN cnt ON cnt.doc_id = d.doc_id AND cnt.bin = v.bin),
more AS (SELECT d.doc_id, d.lang, 1 AS kind, {len(VOCABULARY)} AS bin, greatest(len(any_value(w)) - sum(word.n), 0) AS n FROM d JOIN word ON word.doc_id = d.doc_id GROUP BY 1, 2),
hist AS ({char} UNION ALL SELECT * FROM word UNION ALL SELECT * FROM more),
own AS (SELECT doc_id, kind, bin, n / nullif(sum(n) OVER (PARTITION BY doc_id, kind), 0) AS p FROM hist),
ref AS (SELECT lang, kind, bin, sum(n) AS n FROM hist WHERE lang IS NOT NULL GROUP BY 1, 2, 3),
refs AS (SELECT lang, kind, bin, n / nullif(sum(n) OVER (PARTITION BY lang, kind), 0) AS q FROM ref),
js AS (SELECT doc_id, kind, lang, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS x FROM own JOIN refs USING (kind, bin) WHERE p IS NOT NULL GROUP BY 1, 2, 3),
near AS (SELECT doc_id, min(x) FILTER (kind = 0) AS cd, min(x) FILTER (kind = 1) AS wd FROM js GROUP BY doc_id),
j AS (SELECT doc_id, n_words, n - n_space AS word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {LEAST_BASE_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed, coalesce(cd, 0) AS cd, coalesce(wd, 0) AS wd FROM base LEFT JOIN near USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND (word_chars < {LEAST_CHARS} OR n_words < {LEAST_WORDS} OR (cd <= {MOST_CHAR_DISTANCE} AND wd <= {MOST_WORD_DISTANCE})) AS kept, round(cd, 4) + 0.0 AS char_distance, round(wd, 4) + 0.0 AS word_distance FROM j"""
