"""Removal of every byte that a repeated string of ``length`` bytes covers, by run-length indexes of aligned contexts.

One index over a whole corpus has no place in bounded memory, so the corpus is dealt to many small ones that together
see every match. Of each window of ``length`` bytes one 64-byte gram, its rightmost of least hash, is an anchor; equal
windows have equal anchors at equal places. An anchor's context is what windows around it may cover: ``length`` - 64
bytes to either side, as far as the document goes.

Occurrences of an anchor with equal contexts cover them whole; they are counted, not compared. Contexts that differ
meet by anchor. Aligned at the anchor they form a positional Burrows-Wheeler transform, column by column from the
right: rows in the order of what follows, the preceding byte for each row, coded in runs. Inside a run neighbours stay
neighbours; only at the ends of runs new neighbours meet, and for these the end of their match is sampled. So each
column streams the matching statistics: how far a row's text at that column agrees with its nearest others. Where
that is ``length`` bytes or more, the window is marked. All of this compares bytes, not hashes.

An anchor with more than ``MOST_CONTEXTS`` different contexts (a passage set in many texts) has no index in one task.
How far each context agrees with any other to the left and to the right is found by counting hashes of growing
extents; only windows between those bounds can be repeated. These are counted by two 64-bit hashes each, with partial
sums, however many they are.

Rows are told apart by a 64-bit hash of key and text: among n rows about n * n / 2**65 pairs share one by chance.
Documents with equal texts have equal results. Null texts are empty. A text of under ``length`` bytes loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm.common import checkpointed_alone, slices, table
from framelake.session import share_code

LENGTH, GRAM = 400, 64
MOST_CONTEXTS = 512
#: Rows of contexts that are indexed together, bytes hashed together (they fit a core's cache) and in one piece of a long text.
TOGETHER, CACHED, PIECE = 8192, 256 << 10, 8 << 20
#: Bytes between the extents by which hot anchors' windows are sifted.
GRID = 28


@dataclass(frozen=True)
class Shape:
    """What follows from the length of the strings sought."""

    length: int = LENGTH

    def __post_init__(self) -> None:
        if self.length <= GRAM:
            raise ValueError(f"strings must be longer than {GRAM} bytes")

    @property
    def reach(self) -> int:
        """Bytes of context to either side of an anchor."""
        return self.length - GRAM

    @property
    def grams(self) -> int:
        """Grams of a window."""
        return self.reach + 1

    @property
    def width(self) -> int:
        return 2 * self.reach + GRAM


U = np.uint64
BYTES = np.random.default_rng(2718).integers(0, 1 << 64, 256, dtype=np.uint64)
STEPS = np.random.default_rng(3141).integers(0, 1 << 63, 6, dtype=np.uint64) * U(2) + U(1)
LOW = U((1 << 24) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each position on."""
    v = BYTES[data]
    with np.errstate(over="ignore"):
        for k in range(6):
            n = 1 << k
            w = v[:-n] * STEPS[k]
            w += v[n:]
            w ^= w >> U(29)
            v = w
    return v


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of all windows inside the documents [starts, ends) of ``data`` (under 16 MB)."""
    length, grams = shape.length, shape.grams
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    v = gram_hashes(data)
    n = len(v)
    # least hash, of equal ones the rightmost: the position, counted from the right, is the key's low part
    key = (v & ~LOW) | (LOW - np.arange(n, dtype=np.uint64))
    blocks = -(-n // grams)
    padded = np.full(blocks * grams, ~U(0), np.uint64)
    padded[:n] = key
    padded = padded.reshape(blocks, grams)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(data) - length + 1
    least = np.minimum(behind[:windows], ahead[grams - 1 : grams - 1 + windows])
    inside = np.zeros(len(data) + 1, np.int32)  # windows that begin and end in one document
    long = ends - starts >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    found = (LOW - (least[np.cumsum(inside)[:windows] > 0] & LOW)).astype(np.int64)
    if not len(found):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    found = found[np.concatenate(([True], found[1:] != found[:-1]))]
    return found, v[found]


def document_anchors(texts: list[bytes], shape: Shape) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(text number, positions, hashes) for texts one by one; texts longer than a piece are taken in pieces."""
    small: list[int] = []
    length = shape.length
    total = 0

    def together(some: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        sizes = np.array([len(texts[i]) for i in some])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        pos, h = anchors(np.frombuffer(b"".join(texts[i] for i in some), np.uint8), starts, ends, shape)
        cut = np.searchsorted(pos, ends)
        a = 0
        for j, i in enumerate(some):
            if cut[j] > a:
                yield i, pos[a : cut[j]] - starts[j], h[a : cut[j]]
            a = cut[j]

    for i, t in enumerate(texts):
        if len(t) < length:
            continue
        if len(t) > PIECE:
            data, found = np.frombuffer(t, np.uint8), {}
            for a in range(0, len(t) - length + 1, PIECE):
                part = data[a : a + PIECE + length - 1]
                pos, h = anchors(part, np.array([0]), np.array([len(part)]), shape)
                found.update(zip((pos + a).tolist(), h.tolist(), strict=True))
            at = sorted(found)
            yield i, np.array(at), np.array([found[p] for p in at], np.uint64)
            continue
        if total + len(t) > CACHED and small:
            yield from together(small)
            small, total = [], 0
        small.append(i)
        total += len(t)
    if small:
        yield from together(small)


def context(text: bytes, pos: int, shape: Shape) -> bytes:
    return text[max(0, pos - shape.reach) : pos + GRAM + shape.reach]


def matching_windows(group: np.ndarray, rows: np.ndarray, left: np.ndarray, right: np.ndarray, shape: Shape) -> np.ndarray:
    """For contexts (sorted by ``group``, aligned at the anchor) whether the window from each of the first ``grams`` columns on also begins in another row of its group.

    ``rows`` is (n, ``width``); a row's text is in columns [left, right).
    """
    n, width, grams, length = len(group), shape.width, shape.grams, shape.length
    out = np.zeros((grams, n), bool)
    if n < 2:
        return out.T
    columns = np.ascontiguousarray(rows.T).astype(np.uint16)
    at = np.arange(width)[:, None]
    columns[(at < left) | (at >= right)] = 256
    _, g = np.unique(group, return_inverse=True)
    g = g.astype(np.uint16)
    order = np.arange(n)
    same = np.concatenate(([False], g[1:] == g[:-1]))  # by place: groups keep their places in every order
    end = np.where(same, width, 0).astype(np.int32)  # where the match with the row before ends
    begins = ~same
    for c in range(width - 1, -1, -1):
        byte = columns[c][order]
        run = np.concatenate(([True], byte[1:] != byte[:-1])) | begins  # runs of the preceding byte
        if run.sum() > begins.sum():
            # stable by byte, then by group
            by = np.argsort(byte, kind="stable")
            perm = by[np.argsort(g[order][by], kind="stable")]
            moved = end[perm]
            after = byte[perm]
            joined = np.concatenate(([False], after[1:] == after[:-1])) & same
            heads = np.flatnonzero(joined & run[perm])  # a run's first row, now next to another run's last
            if len(heads):
                pairs = np.empty(2 * len(heads), np.int64)
                pairs[::2], pairs[1::2] = perm[heads - 1] + 1, perm[heads] + 1
                moved[heads] = np.minimum.reduceat(np.append(end, 0), pairs)[::2]
            end = np.where(joined, moved, np.where(same, c, 0)).astype(np.int32)
            order, byte = order[perm], after
        end[same & (byte == 256)] = c  # outside a document nothing matches
        if c < grams:
            hit = np.flatnonzero(end >= c + length)
            out[c, order[hit]] = True
            out[c, order[hit - 1]] = True
    return out.T


def packed(a: Column, b: Column) -> Column:
    """A span [a, b) as one number: an exchange of many spans takes a fraction of what structs take. Texts are under 2 GB."""
    return F.shiftleft(a, 32).bitwiseOR(b - a)


def merged(spans: np.ndarray, size: int) -> list[tuple[int, int]]:
    """The runs that packed spans cover in a text of ``size`` bytes; spans that touch are one run."""
    spans = np.sort(spans)
    a = spans >> 32
    b = np.maximum.accumulate(np.minimum(a + (spans & 0xFFFFFFFF), size))
    first = np.flatnonzero(np.concatenate(([True], a[1:] > b[:-1])))
    return list(zip(a[first].tolist(), b[np.append(first[1:], len(a)) - 1].tolist(), strict=True))


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def window_hashes(data: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Two 64-bit hashes of the ``length`` bytes from each position on, as (windows, 2)."""
    out = []
    bits = length.bit_length()
    with np.errstate(over="ignore"):
        for seed in (1, 2):
            v = (BYTES[data] ^ U(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * U(0xD6E8FEB86659FD93)
            done, total, have = 0, None, v
            for k in range(bits):  # a part for each power of two in the length
                n = 1 << k
                if length >> k & 1:
                    size = len(data) - length + 1
                    part = have[done : done + size]
                    total = part.copy() if total is None else (total * U(0xFF51AFD7ED558CCD) + part) ^ (total >> U(31))
                    done += n
                if k < bits - 1:
                    w = have[:-n] * STEPS[k % 6] + have[n:]
                    have = w ^ (w >> U(27 + seed))
            out.append(total)
    return np.stack(out, axis=1).view(np.int64)


def pieces(h: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of sorted groups into ranges of whole groups: at most 65,536 groups and, beyond one group, about TOGETHER rows."""
    if not len(h):
        return
    borders = [*np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))).tolist(), len(h)]
    start, k = 0, 0
    for i in range(1, len(borders)):
        if i == len(borders) - 1 or borders[i + 1] - start > TOGETHER or i - k >= 65_000:
            yield start, borders[i]
            start, k = borders[i], i


def extents(data: bytes, left: int) -> list[tuple[int, int]]:
    """(level, hash) of a context's extents: level k > 0 goes k * GRID bytes to the left of the anchor, k < 0 to the right."""
    import xxhash

    right = len(data) - left - GRAM
    out = [(k, xxhash.xxh3_64_intdigest(data[left - k * GRID : left + GRAM], k)) for k in range(1, left // GRID + 1)]
    return out + [(-k, xxhash.xxh3_64_intdigest(data[left : left + GRAM + k * GRID], k + 64)) for k in range(1, right // GRID + 1)]


def spans(documents: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(rows, found): the documents' (q_row, q_key, q_text, kept columns), and (q_row, q_spans) of those with removed bytes, the spans ``packed``."""
    share_code(documents.sparkSession)
    shape = Shape(length)
    reach, width = shape.reach, shape.width
    rows = documents.select(F.col(key).alias("q_key"), F.coalesce(F.col(text), F.lit("")).alias("q_text"), *keep)
    rows = rows.withColumn("q_row", F.xxhash64("q_key", "q_text"))
    long = rows.where(F.octet_length("q_text") >= length)
    signed = lambda x: pa.array(np.asarray(x, np.uint64).view(np.int64))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "q_text", 1 << 20):
            found = [h for _, _, h in document_anchors([t.encode("utf-8", "replace") for t in batch.column("q_text").to_pylist()], shape)]
            if found:
                yield pa.RecordBatch.from_arrays([signed(np.concatenate(found))], names=["h"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for batch in slices(batches, "q_text", 1 << 20):
            texts = [t.encode("utf-8", "replace") for t in batch.column("q_text").to_pylist()]
            take, hs, cs, ps = [], [], [], []
            for i, pos, h in document_anchors(texts, shape):
                t, own = texts[i], {}
                # where a document cuts a context off is part of it; equal contexts of one text (a period) are one row
                for p, x in zip(pos.tolist(), h.tolist(), strict=True):
                    own.setdefault((x, digest(t[max(0, p - reach) : p + GRAM + reach], min(p, reach))), []).append(p)
                take += [i] * len(own)
                hs += [x for x, _ in own]
                cs += [c for _, c in own]
                ps += own.values()
            if take:
                yield pa.RecordBatch.from_arrays([signed(hs), signed(cs), batch.column("q_row").take(pa.array(take)), pa.array(ps, pa.list_(pa.int64()))], names=["h", "c", "q_row", "pos"])

    # most anchors stand once; their contexts are never looked at
    often = checkpointed_alone(long.select("q_text").mapInArrow(hashes, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    found = checkpointed_alone(long.select("q_row", "q_text").mapInArrow(scan, "h long, c long, q_row long, pos array<long>").join(often, "h"))
    by_context = found.groupBy("h", "c").agg(F.sum(F.size("pos")).alias("n"), F.min(F.struct("q_row", F.get("pos", F.lit(0)).alias("pos"))).alias("first"))
    by_context = checkpointed_alone(by_context.select("h", "c", "n", "first.q_row", "first.pos"))
    equal = found.join(by_context.where("n > 1").select("h", "c"), ["h", "c"])
    equal = equal.select("q_row", F.explode("pos").alias("pos")).select("q_row", F.greatest(F.col("pos") - reach, F.lit(0)).alias("a"), (F.col("pos") + GRAM + reach).alias("b"))

    different = by_context.groupBy("h").agg(F.count("*").alias("contexts"), F.min("n").alias("least")).where("contexts > 1 and least = 1").select("h", "contexts")
    wanted = by_context.join(different, "h").select("h", (F.col("n") > 1).alias("repeated"), "contexts", "q_row", "pos")
    texts = rows.select("q_row", "q_key", "q_text", *keep)
    context_schema = "h long, q_row long, pos long, repeated boolean, contexts long, q_left int, q_context binary"
    names = [x.split(" ")[0] for x in context_schema.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.binary())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "q_text", 1 << 20):
            out: list[list] = [[] for _ in kinds]
            seen = set()  # rows with equal keys and texts have equal contexts: one will do
            for row, t, w in zip(*(batch.column(c).to_pylist() for c in ("q_row", "q_text", "w")), strict=True):
                if row in seen:
                    continue
                seen.add(row)
                data = t.encode("utf-8", "replace")
                for x in w:
                    for column, value in zip(out, (x["h"], row, x["pos"], x["repeated"], x["contexts"], min(x["pos"], reach), context(data, x["pos"], shape)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], names=names)

    def contexts(some: Column) -> DataFrame:
        """The contexts wanted of ``some`` anchors. Texts come with all columns of the last join and in the same query, so that all read one exchange of them."""
        lists = wanted.where(some).groupBy("q_row").agg(F.collect_list(F.struct("h", "pos", "repeated", "contexts")).alias("w"))
        return texts.join(lists, "q_row").mapInArrow(cut, context_schema)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        size = 0

        def run(t: pa.Table) -> Iterator[pa.RecordBatch]:
            h = t.column("h").to_numpy()
            data, left = t.column("q_context").to_pylist(), t.column("q_left").to_numpy().astype(np.int64)
            lengths = np.array([len(x) for x in data], np.int64)
            begin = reach - left
            m = np.zeros((len(h), width), np.uint8)
            for i, x in enumerate(data):
                m[i, begin[i] : begin[i] + lengths[i]] = np.frombuffer(x, np.uint8)
            marks = matching_windows(h, m, begin, begin + lengths, shape)
            repeated, pos, row = (t.column(c).to_pylist() for c in ("repeated", "pos", "q_row"))
            out = [(row[i], pos[i] - reach + x, pos[i] - reach + y - 1 + length) for i in np.flatnonzero(marks.any(axis=1)).tolist() if not repeated[i] for x, y in _runs(marks[i])]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out, strict=True)], names=["q_row", "a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rest.append(batch)
            size += batch.num_rows
            if size >= TOGETHER:
                t = pa.Table.from_batches(rest)
                h = t.column("h").to_numpy()
                last = int(np.flatnonzero(h != h[-1])[-1]) + 1 if h[0] != h[-1] else 0
                for a, b in pieces(h[:last]):
                    yield from run(t.slice(a, b - a))
                rest, size = t.slice(last).to_batches(), len(h) - last
        if size:
            t = pa.Table.from_batches(rest)
            for a, b in pieces(t.column("h").to_numpy()):
                yield from run(t.slice(a, b - a))

    few = contexts(F.col("contexts") <= MOST_CONTEXTS).repartition("h").sortWithinPartitions("h").mapInArrow(index, "q_row long, a long, b long")

    hot = contexts(F.col("contexts") > MOST_CONTEXTS)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(h, row, pos, k, e) for h, row, pos, left, x in zip(*(batch.column(c).to_pylist() for c in ("h", "q_row", "pos", "q_left", "q_context")), strict=True) for k, e in extents(x, left)]
            if out:
                h, row, pos, k, e = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(row, pa.int64()), pa.array(pos, pa.int64()), pa.array(k, pa.int32()), signed(e)], names=["h", "q_row", "pos", "k", "e"])

    extended = hot.mapInArrow(extend, "h long, q_row long, pos long, k int, e long")
    shared = extended.groupBy("h", "k", "e").agg(F.count("*").alias("n")).where("n > 1").select("h", "k", "e")
    bounds = extended.join(shared, ["h", "k", "e"]).groupBy("h", "q_row", "pos").agg(F.max("k").alias("to_left"), F.min("k").alias("to_right"))
    sifted = hot.join(bounds, ["h", "q_row", "pos"]).withColumns({"to_left": (F.greatest("to_left", F.lit(0)) + 1) * GRID - 1, "to_right": (F.greatest(-F.col("to_right"), F.lit(0)) + 1) * GRID - 1})
    sifted = sifted.where(F.col("to_left") + F.col("to_right") >= reach)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                at, first, w = [], [], []
                for i, (x, left, pos, to_left, to_right) in enumerate(zip(*(part.column(c).to_pylist() for c in ("q_context", "q_left", "pos", "to_left", "to_right")), strict=True)):
                    # windows begin so many bytes left of the anchor
                    low, high = max(reach - to_right, left + length - len(x), 0), min(to_left, left, reach)
                    if low > high:
                        continue
                    begin = left - high
                    found = window_hashes(np.frombuffer(x, np.uint8)[begin : left - low + length], length)
                    at.append(np.full(len(found), i))
                    first.append(pos - left + begin + np.arange(len(found)))
                    w.append(found)
                if at:
                    at, w = pa.array(np.concatenate(at)), np.concatenate(w)
                    yield pa.RecordBatch.from_arrays([pa.array(w[:, 0].copy()), pa.array(w[:, 1].copy()), part.column("q_row").take(at), part.column("repeated").take(at), pa.array(np.concatenate(first).astype(np.int64))], names=["w1", "w2", "q_row", "repeated", "a"])

    windows = sifted.mapInArrow(expand, "w1 long, w2 long, q_row long, repeated boolean, a long")
    # one window may be reached from the anchors of both its ends: a place counts once
    twice = windows.groupBy("w1", "w2").agg(F.min(F.struct("q_row", "a")).alias("low"), F.max(F.struct("q_row", "a")).alias("high")).where("low <> high").select("w1", "w2")
    many = windows.where("not repeated").join(twice, ["w1", "w2"]).select("q_row", "a", (F.col("a") + length).alias("b"))

    parts = equal.unionByName(few).unionByName(many)
    # windows come one by one, some from two anchors
    return texts, parts.groupBy("q_row").agg(F.collect_set(packed(F.col("a"), F.col("b"))).alias("q_spans"))


def cleaned(documents: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), length: int = LENGTH) -> DataFrame:
    """(q_key, ``keep``, q_bytes, q_spans, q_kept): each row's key, kept columns, bytes in its text, removed runs [a, b) and the bytes left."""
    texts, found = spans(documents, key, text, keep, length)
    joined = texts.join(found, "q_row", "left").select("q_key", *keep, "q_text", "q_spans")
    runs = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
    carried = ["q_key", *keep]
    schema = T.StructType([*joined.select(*carried).schema.fields, T.StructField("q_bytes", T.LongType()), T.StructField("q_spans", runs), T.StructField("q_kept", T.BinaryType())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "q_text"):
            size, runs, kept = [], [], []
            for t, x in zip(batch.column("q_text").to_pylist(), batch.column("q_spans"), strict=True):
                data = t.encode("utf-8", "replace")
                gone = merged(x.values.to_numpy(), len(data)) if x.is_valid else []
                size.append(len(data))
                runs.append([{"a": a, "b": b} for a, b in gone])
                edges = [0, *(e for run in gone for e in run), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if gone else data)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(size, pa.int64()), pa.array(runs, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), pa.array(kept, pa.binary())],
                names=schema.names,
            )

    return joined.mapInArrow(remove, schema)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to repeated strings."""
    found = cleaned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("q_spans", F.lit(0).cast("long"), lambda n, x: n + x["b"] - x["a"])
    return found.select(F.col("q_key").alias("doc_id"), F.col("q_bytes").alias("n_bytes"), removed.alias("n_removed"), F.size("q_spans").cast("long").alias("n_spans"), F.sha2("q_kept", 256).alias("kept_sha256"))
