"""Toxicity by Levenshtein automata over a lexicon trie, with the context of each hit.

The lexicon is learned from labelled rows: terms (whole words) and stems (how words begin) that stand in far more
toxic documents of a bounded sample than in clean ones, and more than chance would give any of all the words looked
at. So a small sample needs a word in few documents, a large one in hardly more, and a rare term counts like a
frequent one. The terms' Levenshtein automata are intersected with their trie into one deterministic automaton, which
all words of a text run through at once, a character a step; most words reach its dead state after a few. The
``MOST_FUZZY`` terms that most toxic documents have are matched with edits; further ones, and those that several words
of clean documents come near to, as they are. A misspelled term counts if clean documents of the sample don't have
that very word.

Each hit is weighed by a window of words around it: between quotation marks, or after a word that reports speech, it
counts as quotation, else as abuse. A logistic model over the counts gives the score.

Null and empty texts have no hits and get the score of any text without hits. Without labels, or without a toxic
label, every score is 0. Labels, languages, sources and ids are no inputs of a score.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelake.llm.common import checkpointed, table
from framelake.session import share_code

#: The bounded sample: so many toxic and clean labelled rows at most, by a hash of the key, and of these texts of so many bytes together at most.
FIT_TOXIC, FIT_CLEAN, FIT_BYTES = 2000, 4000, 48 << 20
#: A term or stem must stand in so many toxic documents of the sample, be so many times likelier in them (a stem's hits are also
#: weighed by their density), and, of all words and stems as frequent, chance may be expected to let so many through.
LEAST_COVER, LEAST_RATIO, LEAST_STEM_RATIO, MOST_BY_CHANCE = 4, 20.0, 5.0, 0.02
#: Terms matched with edits (their automaton has some hundred states for each), and clean words that may come near to one.
MOST_FUZZY, MOST_NEAR = 200, 2
#: A stem of whose documents one word has a greater share is no stem.
MOST_OF_STEM = 0.6
LEAST_TERM, STEMS = 4, (4, 5, 6)
#: Edits by the length of a term.
EDITS = ((9, 2), (5, 1), (0, 0))
WINDOW = 8
MISSPELLED = 0.8
THRESHOLD = 0.3
QUOTES = "\"“”„«»‘’"
REPORTING = frozenset("said says say wrote writes called calling quote quoted quotes quoting word term insult dijo escribió llamó dit écrit appelé sagte schrieb nannte".split())

TOKEN = re.compile(r"[^\W_]+")


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 4 == 2


def edits(term: str) -> int:
    return next(e for n, e in EDITS if len(term) >= n)


@dataclass
class Automaton:
    """``step[state, class]``; state 0 is dead, 1 the start. ``term`` and ``cost`` tell what a state accepts at a word's end."""

    classes: np.ndarray
    step: np.ndarray
    term: np.ndarray
    cost: np.ndarray
    stem: np.ndarray
    others: frozenset[str] = frozenset()


def compile_lexicon(terms: list[str], stems: list[str], clean: Iterable[str] = (), exact: Iterable[str] = ()) -> Automaton:
    """The intersection of the terms' Levenshtein automata with the lexicon's trie, made deterministic; terms in ``exact`` have no edits."""
    exact = frozenset(exact)
    allowed = [0 if t in exact else edits(t) for t in terms]
    children: list[dict[str, int]] = [{}]
    ends: dict[int, int] = {}
    roots: set[int] = set()
    reach = [0]  # most edits of any term below a node
    for i, word in enumerate([*terms, *stems]):
        node = 0
        most = allowed[i] if i < len(terms) else 0
        reach[0] = max(reach[0], most)
        for c in word:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                reach.append(0)
            node = children[node][c]
            reach[node] = max(reach[node], most)
        if i < len(terms):
            ends[node] = i
        else:
            roots.add(node)
    alphabet = sorted({c for x in children for c in x})

    # a state is its (node, edits) as packed numbers in order: there are thousands, and sets of pairs take ten times the room
    def unpacked(state: bytes) -> list[tuple[int, int]]:
        return [(x >> 3, x & 7) for x in array("I", state)]

    def closed(pairs: dict[int, int]) -> bytes:
        queue = list(pairs.items())
        while queue:
            node, e = queue.pop()
            if pairs.get(node, 99) < e:
                continue
            for child in children[node].values():  # a character of the term left out
                if e + 1 <= reach[child] and pairs.get(child, 99) > e + 1:
                    pairs[child] = e + 1
                    queue.append((child, e + 1))
        return array("I", sorted(node << 3 | e for node, e in pairs.items())).tobytes()

    start = closed({0: 0})
    names: dict[bytes, int] = {b"": 0, start: 1}
    order, table_ = [b"", start], []
    stem_state: set[int] = set()
    at = 0
    while at < len(order):
        state, row = unpacked(order[at]), array("i")
        for c in [*alphabet, None]:
            to: dict[int, int] = {}
            for node, e in state:
                moves = [(children[node][c], e)] if c in children[node] else []
                if e < reach[node]:
                    moves.append((node, e + 1))  # a character too many
                    moves += [(child, e + 1) for child in children[node].values()]  # another character
                for child, cost in moves:
                    if cost <= reach[child] and cost < to.get(child, 99) or child in roots and cost == 0:
                        to[child] = min(cost, to.get(child, 99))
            new = closed(to)
            if new not in names:
                names[new] = len(order)
                order.append(new)
            row.append(names[new])
        table_.append(row)
        at += 1
    term, cost = np.full(len(order), -1, np.int32), np.zeros(len(order), np.int8)
    for i, state in enumerate(map(unpacked, order)):
        hits = [(e, ends[node]) for node, e in state if node in ends and e <= allowed[ends[node]]]
        if hits:
            cost[i], term[i] = min(hits)
        if any(node in roots and e == 0 for node, e in state):
            stem_state.add(i)
    classes = np.full(65536, 0, np.int16)
    letters = np.frombuffer("".join(chr(i) if chr(i).isalnum() else " " for i in range(65536) if not 0xD800 <= i < 0xE000).encode("utf-32-le", "surrogatepass"), "<u4")
    classes[letters[letters != 32]] = len(alphabet) + 1
    for i, c in enumerate(alphabet):
        if ord(c) < 65536:
            classes[ord(c)] = i + 1
    stem = np.zeros(len(order), bool)
    stem[list(stem_state)] = True
    return Automaton(classes, np.array(table_, np.int32).reshape(len(order), len(alphabet) + 1), term, cost, stem, frozenset(clean))


def hits(auto: Automaton, text: str) -> list[tuple[int, int, int, str]]:
    """(begin, end, edits, kind) of the lexicon's words in a lower-case text; kind is term or stem."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    cls = np.append(auto.classes[np.minimum(codes, 65535)], 0)
    word = cls > 0
    starts = np.flatnonzero(word & ~np.concatenate(([False], word[:-1])))
    state, pos = np.ones(len(starts), np.int32), starts.copy()
    found: list[tuple[int, int, int, str]] = []
    while len(starts):
        c = cls[pos]
        over = c == 0
        accept = over & (auto.term[state] >= 0)
        for i in np.flatnonzero(accept):
            found.append((int(starts[i]), int(pos[i]), int(auto.cost[state[i]]), "term"))
        live = ~over
        starts, pos = starts[live], pos[live]
        state = auto.step[state[live], c[live] - 1]
        done = auto.stem[state]
        for i in np.flatnonzero(done):
            found.append((int(starts[i]), int(pos[i]) + 1, 0, "stem"))
        live = (state > 0) & ~done
        starts, pos, state = starts[live], pos[live] + 1, state[live]
    out = []
    for begin, end, cost, kind in sorted(found):
        if cost and text[begin:end] in auto.others:
            continue  # a word that clean documents have
        out.append((begin, end, cost, kind))
    return out


def quoted(text: str, begin: int, end: int, window: int = WINDOW) -> bool:
    """Whether a hit stands between quotation marks, or closely after a word that reports speech."""
    before, after = text[max(0, begin - 12 * window) : begin], text[end : end + 12 * window]
    before, after = " ".join(before.split(" ")[-window:]), " ".join(after.split(" ")[:window])
    opened = sum(before.count(q) for q in QUOTES)
    if opened % 2 and any(q in after for q in QUOTES):
        return True
    return bool(REPORTING & set(TOKEN.findall(before)[-3:]))


def features(auto: Automaton | None, text: str | None) -> tuple[float, float, float, float, float]:
    """Abusive terms, misspelled ones, stems and quoted hits (damped), and hits by length."""
    if not text or auto is None:
        return (0.0,) * 5
    text = text.lower()
    plain = miss = stem = quote = 0
    for begin, end, cost, kind in hits(auto, text):
        if quoted(text, begin, end):
            quote += 1
        elif kind == "stem":
            stem += 1
        elif cost:
            miss += 1
        else:
            plain += 1
    words = max(1, text.count(" ") + 1)
    return tuple(np.log1p([plain, miss, stem, quote]).tolist()) + (min(1.0, 20 * (plain + miss + stem) / words),)


@dataclass
class Toxicity:
    """Lexicon and weights. ``auto`` is compiled where it is used."""

    terms: list[str]
    stems: list[str]
    clean: list[str]
    exact: list[str] = field(default_factory=list)
    weights: list[float] = field(default_factory=lambda: [0.0] * 6)
    fitted: bool = False
    _auto: Automaton | None = None

    @property
    def auto(self) -> Automaton | None:
        if self._auto is None and (self.terms or self.stems):
            self._auto = compile_lexicon(self.terms, self.stems, self.clean, self.exact)
        return self._auto

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_auto": None}

    def score(self, text: str | None) -> float:
        if not self.fitted:
            return 0.0
        z = self.weights[0] + float(np.dot(self.weights[1:], features(self.auto, text)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def by_chance(bad: int, good: int, toxic_n: int, clean_n: int) -> float:
    """Chance that of ``bad + good`` documents so many or more are toxic ones, were they drawn without regard to labels."""
    n, p = bad + good, toxic_n / (toxic_n + clean_n)
    if p >= 1:
        return 1.0
    term = lambda k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log(1 - p)
    return sum(math.exp(term(k)) for k in range(bad, n + 1))


def distance(a: str, b: str) -> int:
    """Levenshtein distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def mine(texts: list[str], toxic: list[bool]) -> tuple[list[str], list[str], list[str], list[str]]:
    """Terms (most frequent first) and stems, the clean texts' words near a term, and the terms matched as they are."""

    def keys(text: str) -> set[tuple[str, bool]]:
        words = {w for w in TOKEN.findall(text.lower()) if len(w) >= LEAST_TERM and not w.isdigit()}
        return {(w, False) for w in words} | {(w[:n], True) for w in words for n in STEMS if len(w) > n}

    toxic_n, clean_n = sum(toxic), sum(not x for x in toxic)
    # most keys stand in a text or two: they are counted first, and only the others get sets of their texts
    counts: Counter = Counter()
    for text, is_toxic in zip(texts, toxic, strict=True):
        if is_toxic:
            counts.update(keys(text))
    # a stem of whose documents one word has most is but that word
    spent = {(w[:n], True) for (w, is_stem), v in counts.items() if not is_stem for n in STEMS if len(w) > n and counts[w[:n], True] >= LEAST_COVER and v > MOST_OF_STEM * counts[w[:n], True]}
    cover = {k for k, v in counts.items() if v >= LEAST_COVER and k not in spent}
    del counts, spent
    bad: dict[tuple[str, bool], set[int]] = defaultdict(set)
    for i, (text, is_toxic) in enumerate(zip(texts, toxic, strict=True)):
        if is_toxic:
            for key in keys(text) & cover:
                bad[key].add(i)
    # clean texts are only asked for what is left, so nothing else of them is kept
    good: Counter = Counter()
    for text, is_toxic in zip(texts, toxic, strict=True):
        if not is_toxic:
            good.update(keys(text) & bad.keys())
    usable = {k: v for k, v in bad.items() if len(v) / max(1, toxic_n) >= (LEAST_STEM_RATIO if k[1] else LEAST_RATIO) * (good[k] + 0.5) / max(1, clean_n)}
    usable = {k: v for k, v in usable.items() if by_chance(len(v), good[k], toxic_n, clean_n) * len(bad) <= MOST_BY_CHANCE}
    # stems by greedy cover, a longer one before a shorter of as many documents: each must have words that earlier ones don't
    stems: list[str] = []
    left = {k[0]: v for k, v in usable.items() if k[1]}
    while left:
        stem = max(left, key=lambda s: (len(left[s]), len(s), s))
        if len(left[stem]) < LEAST_COVER:
            break
        stems.append(stem)
        new = set(left[stem])
        left = {s: rest for s, v in left.items() if (rest := v - new) and not s.startswith(stem)}
    stems = [s for s in stems if not any(s != x and s.startswith(x) for x in stems)]
    terms = sorted((k[0] for k in usable if not k[1] and not k[0].startswith(tuple(stems))), key=lambda w: (-len(usable[w, False]), w))
    near: set[str] = set()
    exact = terms[MOST_FUZZY:]
    if terms:
        probe = compile_lexicon(terms, [], exact=exact)
        for text, is_toxic in zip(texts, toxic, strict=True):
            if not is_toxic:
                low = text.lower()
                near.update(low[b:e] for b, e, cost, _ in hits(probe, low) if cost)
        crowded = [t for t in terms[:MOST_FUZZY] if sum(abs(len(t) - len(w)) <= edits(t) and distance(t, w) <= edits(t) for w in near) > MOST_NEAR]
        exact = crowded + exact
    return terms, sorted(stems), sorted(near), exact


def fit(texts: list[str], labels: list[int]) -> Toxicity:
    """Lexicon, then a logistic model by Newton's steps. Copies of a text count once."""
    seen = dict(zip([t or "" for t in texts], labels, strict=True))
    texts, toxic = list(seen), [bool(x) for x in seen.values()]
    if not any(toxic):
        return Toxicity([], [], [])
    model = Toxicity(*mine(texts, toxic))
    x = np.array([(1.0, *features(model.auto, t)) for t in texts])
    y = np.array(toxic, float)
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-3, *[0.05] * (x.shape[1] - 1)])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge + 1e-9 * np.eye(len(w)), x.T @ (p - y) + ridge @ w)
        w -= np.clip(step, -3, 3)
        if abs(step).max() < 1e-6:
            break
    # misspellings mostly stand beside terms, so a sample hardly weighs them alone, and quotations are rarer still: unless texts with
    # misspellings alone are mostly clean, one counts as a share of a term; quotations that the sample doesn't show count a little
    alone = (x[:, 2] > 0) & (x[:, 1] == 0) & (x[:, 3] == 0)
    if 2 * y[alone].sum() >= alone.sum():
        w[2] = max(w[2], MISSPELLED * w[1])
    if not x[:, 4].any():
        w[4] = 0.1 * w[1]
    model.weights, model.fitted = w.tolist(), True
    return model


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Toxicity:
    """Fits on labelled rows that aren't held out: FIT_TOXIC and FIT_CLEAN of them at most, the lowest by hash, with FIT_BYTES of text at most."""
    rows = labels.select(F.col(key).alias("q_key"), F.col(label).cast("int").alias("q_label")).where(F.col("q_label").isNotNull() & F.col("q_key").isNotNull() & ~held_out(F.col("q_key")))
    order = F.xxhash64(F.col("q_key").cast("string"))
    some = rows.where("q_label = 1").orderBy(order, "q_key").limit(FIT_TOXIC).unionByName(rows.where("q_label = 0").orderBy(order, "q_key").limit(FIT_CLEAN))
    found = documents.select(F.col(key).alias("q_key"), F.coalesce(F.col(text), F.lit("")).alias("q_text")).join(F.broadcast(some), "q_key").select("q_key", "q_text", "q_label")
    # written once; the bound is found from lengths alone. A text that takes an eighth of it is left out
    found = checkpointed(found.withColumns({"q_size": F.octet_length("q_text"), "q_hash": F.xxhash64(F.col("q_key").cast("string"), "q_text")}))
    turns = found.select("q_label", "q_hash", "q_size").withColumn("q_turn", F.row_number().over(Window.partitionBy("q_label").orderBy("q_hash")))
    running = turns.where(F.col("q_size") <= FIT_BYTES // 8).withColumn("q_sum", F.sum("q_size").over(Window.orderBy("q_turn", "q_label").rowsBetween(Window.unboundedPreceding, 0)))
    last = running.where(F.col("q_sum") <= FIT_BYTES).agg(F.max(F.struct("q_turn", "q_label")).alias("x")).first()["x"] or (0, 0)
    # toxic and clean rows in turn, as far as the last that fits
    inside = (F.col("q_turn") < last[0]) | (F.col("q_turn") == last[0]) & (F.col("q_label") <= last[1])
    kept = found.withColumn("q_turn", F.row_number().over(Window.partitionBy("q_label").orderBy("q_hash"))).where(inside & (F.col("q_size") <= FIT_BYTES // 8))
    found = kept.select("q_key", "q_text", "q_label").toPandas()
    found = found.sort_values(["q_key", "q_label"])
    return fit(found.q_text.tolist(), found.q_label.tolist())


def score(documents: DataFrame, model: Toxicity, text: str = "text", into: str = "score") -> DataFrame:
    """Adds the score of ``text``; a column of that name is replaced."""
    share_code(documents.sparkSession)

    @F.pandas_udf("double")
    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = model
        for part in parts:
            yield pd.Series([own.score(x) for x in part], index=part.index, dtype="float64")

    return documents.withColumn(into, scores(F.col(text)))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by what the labelled rows outside the held-out quarter teach."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(documents, table(spark, sf_dir, "labels"))
    found = score(documents, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
