"""Exact token counts by prefix dynamic programming.

For each prefix of a unit (spaces and the word after them) the last piece of the prefix's encoding is found from
those of shorter prefixes, so the count of a prefix is that of a shorter one plus one. Units don't influence each
other, so a text's prefix counts are sums over its units. They answer how many tokens a text has, how many its
first n characters have, and how much of it fits a budget, without encoding anything again.

Null texts count as empty: no tokens, within every budget. Rows are counted one by one, repeated or not; all other
columns are left as they are, and a column that has the name of a new one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm.common import groups, release, table
from framelake.llm.pieces import Cache, Model, Words, default_path, load, units, words
from framelake.session import share_code


class PrefixCounts:
    """Counts of the prefixes of units, kept for units seen before."""

    def __init__(self, model: Model):
        self.model = model
        self.unit = Cache(self._prefixes, 100_000)
        self.total = Words(model, lambda _part, tokens, _last, _ids: tokens[-1], sum)

    def _prefixes(self, unit: str) -> tuple[int, ...]:
        """Tokens of each prefix of a unit, from one character on."""
        model = self.model
        if model.kind != "bpe" or unit.startswith("  "):
            return tuple(sum(map(model.size, model.pieces_of(unit[:end]))) for end in range(1, len(unit) + 1))
        return next(tuple(tokens[1:]) for _, tokens, _, _ in model.prefixes([unit]))

    def _tokens(self, unit: str) -> int:
        return sum(map(self.model.size, self.model.pieces_of(unit)))

    def count_all(self, texts: list[str | None]) -> list[int]:
        """Tokens of texts. The words of all are looked at together."""
        texts = [(t or "").replace("▁", " ") for t in texts]
        fast = self.model.lines_part and self.model.kind == "bpe"
        parts = [words(t) if fast and t else None for t in texts]
        self.total.learn(parts)
        total = self.total.__getitem__
        return [sum(map(self._tokens, units(t))) if p is None else sum(map(total, p)) for t, p in zip(texts, parts, strict=True)]

    def count(self, text: str | None) -> int:
        """Tokens of a text."""
        return self.count_all([text])[0]

    def prefixes(self, text: str) -> list[int]:
        """Tokens of the text's first n characters, for n from 0 to all."""
        out, done = [0], 0
        for k, unit in enumerate(units(text)):
            counts = self.unit[unit]
            # the space before the text is no character of it: a prefix ends after the next character
            out += [done + c for c in counts[1 if k == 0 else 0 :]]
            done += counts[-1]
        return out

    def fits(self, text: str | None, budget: int) -> int:
        """The most characters from the text's start on that have at most ``budget`` tokens."""
        done = at = best = 0
        for k, unit in enumerate(units(text or "")):
            counts = self.unit[unit][1 if k == 0 else 0 :]
            if done + min(counts, default=0) > budget and done > budget:
                break
            for i, c in enumerate(counts, 1):
                if done + c <= budget:
                    best = at + i
            at += len(counts)
            done += self.unit[unit][-1]
        return best


@lru_cache(4)
def counter(path: str, kind: str = "bpe") -> PrefixCounts:
    return PrefixCounts(load(path, kind))


def with_counts(documents: DataFrame, text: str = "text", into: str = "n_tokens", path: str | None = None, budget: int | None = None, fits: str = "fits_chars") -> DataFrame:
    """Adds the tokens of ``text``; with ``budget`` also how many characters from the start on have so many at most."""
    share_code(documents.sparkSession)
    path = path or default_path()

    @F.pandas_udf("long")
    def tokens(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = counter(path)
        for part in parts:
            yield pd.Series([n for some in groups(part.tolist()) for n in own.count_all(some)], index=part.index, dtype="int64")
        release(own.total, own.unit)

    @F.pandas_udf("long")
    def most(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fit = counter(path).fits
        for part in parts:
            yield pd.Series([fit(x, budget) for x in part], index=part.index, dtype="int64")

    out = documents.withColumn(into, tokens(F.col(text)))
    return out if budget is None else out.withColumn(fits, most(F.col(text)))


LIMIT = 4096


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether there are more than LIMIT."""
    documents = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_counts(documents).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
