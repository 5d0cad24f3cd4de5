"""SentencePiece encoding and decoding by a max-plus scan over chunks.

A text of more than ``CHUNK`` characters is cut into chunks at fixed offsets, whatever stands there. The state at a cut is the piece over it: where it ends and, for byte-pair models, which it is. Each
chunk gives a transfer matrix: for every state at its start and every state at its end the best score of a way
between them, minus infinity (no entry) if there is none. Ways of byte-pair models score 0, as only one way through
the whole text exists; those of unigram models score the sum of their pieces. Matrices combine by (max, +), which is
associative, so a text's entry states come from prefix and suffix products, and each chunk is then traced back on
its own between the two states at its ends.

A unit (spaces and the word after them) ends where no piece can cross, so a chunk with such a place has a matrix of
rank one: a column up to the first place and a row from the last. Only a chunk without one needs its whole
matrix, as in texts without spaces.

The chunks of a text of up to ``GIANT`` characters stay in one task, which learns the words of all texts of a batch
together; there a text with a chunk without a unit's end is encoded as one, whole matrices being the dearer way. A
giant text's larger chunks go to many tasks.

Null texts give null ids, empty ones no ids. Texts are encoded by content: repeated rows get equal ids.
"""

from __future__ import annotations

import pickle
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.common import release, slices, table
from framelake.llm.pieces import Model, Words, default_path, load, units, words
from framelake.session import share_code

CHUNK = 1 << 12
#: Characters over which a text's chunks are dealt to tasks, and of such a chunk.
GIANT, GIANT_CHUNK = 1 << 18, 1 << 16
#: Characters of its neighbours that a chunk carries: pieces are shorter.
AROUND = 64

State = tuple[int, str]  # characters of the piece beyond the cut, the piece ("" in unigram models, and at a unit's end)
Matrix = dict[State, dict[State, float]]


class Encoder:
    def __init__(self, model: Model):
        self.model = model
        self.word = Words(model, self._cut, b"".join)

    def _pack(self, unit: str) -> bytes:
        ids = [i for p in self.model.pieces_of(unit) for i in self.model.ids(p)]
        return struct.pack(f"<{len(ids)}i", *ids)

    def _cut(self, unit: str, _tokens: list[int], last: list[int], ids: list[int]) -> bytes:
        out, end = [], len(unit)
        while end:
            i = ids[end]
            if i < 0:
                out += reversed(self.model.ids(unit[end - 1]))
            else:
                out.append(i)
            end -= last[end]
        return struct.pack(f"<{len(out)}i", *out[::-1])

    def encode_all(self, texts: list[str | None]) -> list[bytes | None]:
        """Texts' ids as little-endian 32-bit integers; null for null. The words of all are looked at together."""
        clean = [(t or "").replace("▁", " ") for t in texts]
        fast = self.model.lines_part and self.model.kind == "bpe"
        parts = [words(t) if fast and t else None for t in clean]
        self.word.learn(parts)
        word = self.word.__getitem__
        return [None if t is None else b"".join(map(self._pack, units(c)) if p is None else map(word, p)) for t, c, p in zip(texts, clean, parts, strict=True)]

    def encode_scanned(self, texts: list[str | None], chunk: int = CHUNK) -> list[bytes | None]:
        """The same by matrices, scan and traces for every text of more than ``chunk`` characters whose chunks all have a unit's end."""
        flat: list[str | None] = []
        plans: list[tuple[int, list[Fragment]]] = []
        for t in texts:
            parts = fragments(t, chunk) if t is not None and len(t) > chunk else []
            if any(self._breaks(x.text, x.start, x.stop)[0] < 0 for x in parts):
                parts = []
            plans.append((len(flat), parts))
            flat += [self.inner(x.text, x.start, x.stop) for x in parts] or [t]
        known, out = self.encode_all(flat), []
        for at, parts in plans:
            states = scan([self.matrix(x.text, x.start, x.stop) for x in parts]) if parts else []
            out.append(b"".join(self.trace(x.text, x.start, x.stop, states[k], states[k + 1], known[at + k]) for k, x in enumerate(parts)) if parts else known[at])
        return out

    def encode(self, text: str) -> bytes:
        """A text's ids as little-endian 32-bit integers."""
        return self.encode_all([text])[0]

    # a chunk is text[start:stop] of a text that begins with its added space; borders are offsets in it

    def _breaks(self, text: str, start: int, stop: int) -> tuple[int, int]:
        """The first and last offsets in [start, stop] where a unit begins, or (-1, -1)."""
        first = last = -1
        at = start
        while (at := text.find(" ", at, stop + 1)) >= 0:
            if at == 0 or text[at - 1] != " ":
                first = at if first < 0 else first
                last = at
                break
            at += 1
        if first >= 0:
            at = min(stop, len(text) - 1)
            while (at := text.rfind(" ", start, at + 1)) >= 0:
                if at == 0 or text[at - 1] != " ":
                    last = at
                    break
                at -= 1
        if stop == len(text):
            first, last = (first if first >= 0 else stop), stop
        return first, last

    def states(self, text: str, cut: int) -> list[State]:
        """All states that a cut may have."""
        if cut in (0, len(text)) or text[cut] == " " and text[cut - 1] != " ":
            return [(0, "")]
        found = set()
        for begin in range(max(0, cut - self.model.longest), cut):
            for end in range(cut, min(len(text), begin + self.model.longest) + 1):
                piece = text[begin:end]
                if self.model.has(piece) and " " not in piece.lstrip(" "):
                    found.add((end - cut, piece if self.model.kind == "bpe" else ""))
        return sorted(found)

    def ways(self, text: str, start: int, state: State, stop: int) -> dict[tuple[int, str], tuple[float, tuple[int, str] | None]]:
        """Best scores and predecessors of (end, piece) from a state at ``start`` until pieces reach ``stop``."""
        model, bpe = self.model, self.model.kind == "bpe"
        begin = (start + state[0], state[1])
        best: dict[tuple[int, str], tuple[float, tuple[int, str] | None]] = {begin: (0.0, None)}
        at: dict[int, list[tuple[int, str]]] = {begin[0]: [begin]}
        for pos in range(begin[0], stop):
            for node in at.pop(pos, ()):
                score, before = best[node][0], node[1] or None
                fresh = pos == 0 or text[pos] == " " and text[pos - 1] != " "
                for end in range(pos + 1, min(len(text), pos + model.longest) + 1):
                    piece = text[pos:end]
                    if not model.has(piece) or " " in piece.lstrip(" "):
                        continue
                    if bpe and not model.follows(None if fresh else before, piece):
                        continue
                    to = (end, piece if bpe else "")
                    value = score + (0.0 if bpe else model.score.get(piece, model.worst - 10))
                    if to not in best or value > best[to][0]:
                        if to not in best:
                            at.setdefault(end, []).append(to)
                        best[to] = (value, node)
        return best

    def _exits(self, text: str, best: dict, stop: int) -> dict[State, float]:
        whole = stop == len(text) or text[stop] == " " and text[stop - 1] != " "
        out: dict[State, float] = {}
        for (end, piece), (value, _) in best.items():
            if end >= stop:
                key = (0, "") if whole and end == stop else (end - stop, piece)
                out[key] = max(value, out.get(key, -np.inf))
        return out

    def matrix(self, text: str, start: int, stop: int) -> Matrix:
        """The chunk's transfer matrix. Runs of spaces, whose pieces have no local test, never make a break here."""
        first, last = self._breaks(text, start, stop)
        if first < 0:
            return {s: out for s in self.states(text, start) if (out := self._exits(text, self.ways(text, start, s, stop), stop))}
        row = {(0, ""): 0.0} if last == stop else self._exits(text, self.ways(text, last, (0, ""), stop), stop)
        inner = 0.0 if self.model.kind == "bpe" else sum(self.model.score.get(p, self.model.worst - 10) for u in units(text[first + 1 : last]) for p in self.model.pieces_of(u)) if first < last else 0.0
        out: Matrix = {}
        for s in self.states(text, start):
            to = {(0, ""): 0.0} if first == start else self._exits(text[:first] if first < len(text) else text, self.ways(text[:first] if first < len(text) else text, start, s, first), first)
            if (0, "") in to:
                out[s] = {e: to[(0, "")] + inner + v for e, v in row.items()}
        return out

    def inner(self, text: str, start: int, stop: int) -> str | None:
        """The units between a chunk's first and last place where one begins, without their space; None if there are none."""
        first, last = self._breaks(text, start, stop)
        return text[first + 1 : last] if 0 <= first < last - 1 else None

    def trace(self, text: str, start: int, stop: int, entry: State, leave: State, inner: bytes | None = None) -> bytes:
        """Ids of the pieces that begin in the chunk, on the best way between two states; ``inner`` has those of its inner units if known."""
        first, last = self._breaks(text, start, stop)
        out: list[bytes] = []

        def between(a: int, state: State, b: int, to: State, whole: str) -> list[int]:
            best = self.ways(whole, a, state, b)
            node = max((n for n in best if n[0] == b + to[0] and (not to[1] or n[1] == to[1])), key=lambda n: best[n][0])
            ids: list[list[int]] = []
            while (before := best[node][1]) is not None:
                ids.append(self.model.ids(whole[before[0] : node[0]]))
                node = before
            return [i for part in reversed(ids) for i in part]

        pack = lambda ids: np.array(ids, "<i4").tobytes()
        if first < 0:
            return pack(between(start, entry, stop, leave, text))
        if first > start + entry[0] or first > start:
            out.append(pack(between(start, entry, first, (0, ""), text[:first])))
        if last > first:
            out.append(self._pack(" ") if last == first + 1 else self.encode(text[first + 1 : last]) if inner is None else inner)
        if last < stop:
            out.append(pack(between(last, (0, ""), stop, leave, text)))
        return b"".join(out)


def combine(a: Matrix, b: Matrix) -> Matrix:
    """The (max, +) product."""
    out: Matrix = {}
    for s, row in a.items():
        to: dict[State, float] = {}
        for mid, x in row.items():
            for e, y in b.get(mid, {}).items():
                if x + y > to.get(e, -np.inf):
                    to[e] = x + y
        if to:
            out[s] = to
    return out


def scan(matrices: list[Matrix]) -> list[State]:
    """The state at each cut, the text's ends included, of the best way through all chunks."""
    n = len(matrices)
    rear: list[dict[State, float]] = [{} for _ in range(n)] + [{(0, ""): 0.0}]
    for k in range(n - 1, -1, -1):  # rear[k]: best score from a state at cut k to the end
        for s, row in matrices[k].items():
            if values := [x + rear[k + 1][e] for e, x in row.items() if e in rear[k + 1]]:
                rear[k][s] = max(values)
    states: list[State] = [(0, "")]
    for k in range(n):
        row = matrices[k][states[-1]]
        states.append(max((e for e in row if e in rear[k + 1]), key=lambda e: (row[e] + rear[k + 1][e], e)))
    return states


def encode_long(encoder: Encoder, text: str, chunk: int = CHUNK) -> bytes:
    """A long text's ids through its chunks, as the distributed form does it."""
    text = " " + text.replace("▁", " ")
    cuts = cuts_of(text, chunk)
    states = scan([encoder.matrix(text, a, b) for a, b in zip(cuts, cuts[1:], strict=False)])
    return b"".join(encoder.trace(text, a, b, states[k], states[k + 1]) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)))


@dataclass(frozen=True)
class Fragment:
    """A chunk, ``text[start:stop]``, with a little of its neighbours."""

    text: str
    start: int
    stop: int


def fragments(text: str, chunk: int) -> list[Fragment]:
    text = " " + text.replace("▁", " ")
    cuts, out = cuts_of(text, chunk), []
    for a, b in zip(cuts, cuts[1:], strict=False):
        left = max(0, a - AROUND)
        out.append(Fragment(text[left : b + AROUND], a - left, b - left))
    return out


def cuts_of(text: str, chunk: int) -> list[int]:
    """Offsets of the cuts; one inside a run of spaces moves to the run's start, where a unit begins."""
    cuts = [0]
    for at in range(chunk, len(text), chunk):
        while at > 0 and at < len(text) and text[at] == " " and text[at - 1] == " ":
            at -= 1
        if at < len(text) and text[at - 1] == " " and at > 1 and text[at - 2] == " ":
            at -= 1
            while at > 0 and text[at - 1] == " ":
                at -= 1
        if at > cuts[-1] + 64 and len(text) - at > 64:
            cuts.append(at)
    return [*cuts, len(text)]


@lru_cache(4)
def encoder(path: str, kind: str = "bpe") -> Encoder:
    return Encoder(load(path, kind))


def _ids(parts: list[bytes | None]) -> pa.Array:
    sizes = np.cumsum([0, *(len(x) // 4 if x else 0 for x in parts)], dtype="int32")
    values = pa.array(np.frombuffer(b"".join(x for x in parts if x), "<i4"), pa.int32())
    return pa.ListArray.from_arrays(pa.array(sizes), values, mask=pa.array([x is None for x in parts], pa.bool_()))


def decode_ids(model: Model, ids: bytes | np.ndarray) -> str:
    """The text of ids; bytes that make no text become replacement characters."""
    numbers = np.frombuffer(ids, "<i4") if isinstance(ids, bytes) else ids
    return b"".join(map(model.surface.__getitem__, numbers.tolist())).decode("utf-8", "replace")[1:]


def encode(
    documents: DataFrame, text: str = "text", into: str = "ids", path: str | None = None, chunk: int = CHUNK, kind: str = "bpe", check: str | None = None, giant_chunk: int = GIANT_CHUNK, giant: int = GIANT
) -> DataFrame:
    """Adds ``into``, the text's ids as array<int>, and with ``check`` whether they decode to the text (its "▁" as spaces); columns of those names are replaced."""
    share_code(documents.sparkSession)
    path = path or default_path()
    new = [into, *([check] if check else [])]
    keep = [c for c in documents.columns if c not in new]
    fields = [T.StructField(into, T.ArrayType(T.IntegerType())), *([T.StructField(check, T.BooleanType())] if check else [])]
    schema = T.StructType([*documents.select(*keep).schema.fields, *fields])
    at = keep.index(text)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, kind)
        for batch in slices(batches, text, 8 << 20):
            texts = batch.column(at).to_pylist()
            found = own.encode_scanned(texts, chunk)
            same = [pa.array([None if t is None else decode_ids(own.model, x) == t.replace("▁", " ") for t, x in zip(texts, found, strict=True)], pa.bool_())] if check else []
            yield pa.RecordBatch.from_arrays([*batch.columns, _ids(found), *same], names=[*keep, *new])
        release(own.word)

    rows = documents.select(*keep)
    small = rows.where(F.col(text).isNull() | (F.length(text) <= giant)).mapInArrow(inside, schema)
    large = rows.where(F.length(text) > giant).withColumn("q_key", F.sha2(text, 256))
    ids = encode_chunks(large.select("q_key", F.col(text).alias("q_text")).dropDuplicates(["q_key"]), path, giant_chunk, kind)
    large = large.join(ids, "q_key").withColumnRenamed("q_ids", into)
    if check:
        large = decode(large, into, "q_decoded", path, kind).withColumn(check, F.col("q_decoded") == F.replace(F.col(text), F.lit("▁"), F.lit(" ")))
    return small.unionByName(large.select(*keep, *new))


def encode_chunks(texts: DataFrame, path: str, chunk: int, kind: str) -> DataFrame:
    """(q_key, q_text) to (q_key, q_ids) by the three steps: matrices, scan, traces.

    What one text gathers in a task is its chunks' matrices (a few KB for each 65,536 characters) and, at the end,
    its ids, which make one value of the result.
    """
    def split(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for key, text in zip(pdf.q_key, pdf.q_text, strict=True):
                yield pd.DataFrame([(key, k, x.text, x.start, x.stop) for k, x in enumerate(fragments(text, chunk))], columns=["q_key", "q_k", "q_part", "q_a", "q_b"])

    chunks = texts.mapInPandas(split, "q_key string, q_k int, q_part string, q_a int, q_b int")
    chunks = chunks.repartition(F.col("q_key"), F.col("q_k"))

    def matrices(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(path, kind)
        for pdf in parts:
            yield pd.DataFrame({"q_key": pdf.q_key, "q_k": pdf.q_k, "q_matrix": [pickle.dumps(e.matrix(x, a, b)) for x, a, b in zip(pdf.q_part, pdf.q_a, pdf.q_b, strict=True)]})

    def states(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("q_k")
        found = scan([pickle.loads(x) for x in pdf.q_matrix])
        return pd.DataFrame({"q_key": pdf.q_key, "q_k": pdf.q_k, "q_in": [pickle.dumps(x) for x in found[:-1]], "q_out": [pickle.dumps(x) for x in found[1:]]})

    entries = chunks.mapInPandas(matrices, "q_key string, q_k int, q_matrix binary").groupBy("q_key").applyInPandas(states, "q_key string, q_k int, q_in binary, q_out binary")

    def traces(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(path, kind)
        for pdf in parts:
            # the inner units of many chunks share their words' work
            known = e.encode_all([e.inner(x.q_part, x.q_a, x.q_b) for x in pdf.itertuples()])
            found = [e.trace(x.q_part, x.q_a, x.q_b, pickle.loads(x.q_in), pickle.loads(x.q_out), ids) for x, ids in zip(pdf.itertuples(), known, strict=True)]
            yield pd.DataFrame({"q_key": pdf.q_key, "q_k": pdf.q_k, "q_ids": [np.frombuffer(x, "<i4") for x in found]})
        release(e.word)

    traced = chunks.join(entries, ["q_key", "q_k"]).mapInPandas(traces, "q_key string, q_k int, q_ids array<int>")
    ordered = traced.groupBy("q_key").agg(F.array_sort(F.collect_list(F.struct("q_k", "q_ids"))).alias("q"))
    return ordered.select("q_key", F.flatten(F.transform("q", lambda x: x["q_ids"])).alias("q_ids"))


def decode(rows: DataFrame, ids: str = "ids", into: str = "decoded", path: str | None = None, kind: str = "bpe") -> DataFrame:
    """Adds the text of the ids; null ids give null. Bytes that make no text become replacement characters."""
    share_code(rows.sparkSession)
    path = path or default_path()

    @F.pandas_udf("string")
    def text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load(path, kind)
        for part in parts:
            yield pd.Series([None if x is None else decode_ids(model, x) for x in part], index=part.index, dtype="object")

    return rows.withColumn(into, text(F.col(ids)))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: how many ids, their digest, and whether the text came back."""
    documents = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = encode(documents, check="round_trip")
    digest = F.lpad(F.lower(F.hex(F.xxhash64("ids"))), 16, "0")
    return found.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_xxhash64"), "round_trip")
