"""A SentencePiece model as data: its pieces, and which pieces may stand side by side.

Byte-pair encoding has a local test: a text's encoding is the only way to cut it into pieces of which each encodes
to itself and each two neighbours, joined, encode to the same two. So the last piece of a prefix's encoding can be
found from those of shorter prefixes. Runs of more than one space are the exception, because the pieces made of
spaces alone have scores out of order; they are merged step by step.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

SPACE = "▁"
#: Units of so many characters at most are kept in dictionaries.
SHORT = 64
UNIT = re.compile(" +[^ ]*")


class Cache(dict):
    """A dictionary that computes what it lacks and starts anew when full."""

    def __init__(self, make, most: int = 300_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self.make(key)
        if len(key) <= SHORT:
            self[key] = value
        return value


class Words(dict):
    """Values of words (see ``words``), learned a batch at a time.

    A word falls apart where two characters stand side by side that do so in no piece: nothing joins across. ``value``
    makes a part's value from its prefixes, ``join`` a word's from its parts'.
    """

    def __init__(self, model: Model, value, join, most: int = 300_000):
        super().__init__()
        self.model, self.value, self.join, self.most = model, value, join, most
        self.parts: dict = {}
        self.old: dict = {}

    def split(self, word: str) -> list[str]:
        unit = word if word[:1] == "\n" else " " + word
        if word.isalpha():
            return [unit]
        bigrams, out, start = self.model.bigrams, [], 0
        for i in range(1, len(unit)):
            if unit[i - 1 : i + 1] not in bigrams:
                out.append(unit[start:i])
                start = i
        out.append(unit[start:])
        return out

    def learn(self, batch: list[list[str] | None]) -> None:
        """Takes in what a batch's words lack, sorted so that parts share their prefixes' work."""
        new = set().union(*(x for x in batch if x is not None)).difference(self)
        if len(self) + len(new) > self.most:
            # what isn't seen again until the next time is forgotten
            self.old = dict(self)
            super().clear()
            new = set().union(*(x for x in batch if x is not None))
        old = self.old
        for word in new & old.keys():
            self[word] = old[word]
            new.discard(word)
        split = {word: self.split(word) for word in new if len(word) < SHORT}
        parts = self.parts
        if len(parts) > self.most:
            parts.clear()
        whole = {x[0]: word for word, x in split.items() if len(x) == 1}
        lack = {part for x in split.values() if len(x) > 1 for part in x if part not in parts}
        for found in self.model.prefixes(sorted(lack.union(whole))):
            value = self.value(*found)
            if found[0] in whole:
                self[whole[found[0]]] = value
            if found[0] in lack:
                parts[found[0]] = value
        known, join = parts.__getitem__, self.join
        for word, x in split.items():
            if len(x) > 1:
                self[word] = join(map(known, x))

    def clear(self) -> None:
        super().clear()
        self.parts.clear()
        self.old = {}

    def __missing__(self, word: str):
        """A word too long to keep."""
        unit = word if word[:1] == "\n" else " " + word
        return next(self.value(*x) for x in self.model.prefixes([unit]))


class Model:
    """Pieces of a model file; ``kind`` bpe follows merges, unigram the best sum of scores."""

    def __init__(self, path: str, kind: str = "bpe"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.kind, self.id, self.score, self.byte = kind, {}, {}, {}
        self.surface: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.surface.append(b"" if model.is_control(i) else " ⁇ ".encode())
            else:
                piece = piece.replace(SPACE, " ")
                self.id[piece], self.score[piece] = i, model.get_score(i)
                self.surface.append(piece.encode())
        self.longest = max(map(len, self.id))
        self.pair = Cache(lambda ab: self.stand(*ab) if "  " not in ab[0] + ab[1] else self.merge(ab[0] + ab[1]) == [*ab], 50_000)
        self.alone = Cache(lambda a: len(a) == 1 or self.merge(a) == [a])
        # when a piece is made: single characters are there from the start, the others come by falling score
        made = sorted((p for p in self.id if len(p) > 1), key=lambda p: -self.score[p])
        self.order = {p: i for i, p in enumerate(made, 1)}
        self.halves = Cache(self._halves, 100_000)
        self.worst = min(self.score.values())
        self.pairs: dict[int, bool] = {}
        # pieces by their characters from the last on; under None the id of the piece that begins there
        self.endings: dict = {}
        for piece, i in self.id.items():
            node = self.endings
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[None] = i
        #: Characters that stand side by side in some piece.
        self.bigrams = frozenset(piece[i : i + 2] for piece in self.id for i in range(len(piece) - 1))
        #: Whether a line end is in no piece of two characters or more, so that what follows it starts anew.
        self.lines_part = not any("\n" in piece for piece in self.id)

    def has(self, piece: str) -> bool:
        """Single characters always stand, as bytes if need be."""
        return piece in self.id or len(piece) == 1

    def ids(self, piece: str) -> list[int]:
        found = self.id.get(piece)
        return [found] if found is not None else [self.byte[b] for b in piece.encode("utf-8", "replace")]

    def merge(self, text: str) -> list[str]:
        """Byte-pair merges step by step: the best score first, the leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, before: str | None, piece: str) -> bool:
        """Whether ``piece`` may come after ``before`` (None: at the start of a unit)."""
        if self.kind != "bpe":
            return True
        return self.alone[piece] if before is None else self.pair[before, piece]

    def _halves(self, piece: str) -> tuple[str, str]:
        """The two pieces that the last merge joins to ``piece``."""
        if len(piece) == 1:
            return piece, piece
        parts, score = list(piece), self.score
        while len(parts) > 2:
            ranked = [(-score[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in score]
            if not ranked:
                break
            i = min(ranked)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts[0], parts[-1]

    def stand(self, a: str, b: str) -> bool:
        """Whether ``a`` and ``b``, each its own encoding, stay two pieces side by side.

        They don't if, at any point of their making, the pieces at the border would have joined before the next merge on either side. The
        making is run backwards: of the two border pieces the later one is taken apart.
        """
        order, limit = self.order, 1 << 30
        while True:
            if order.get(a + b, 1 << 30) < limit:
                return False
            x, y = order.get(a, 0), order.get(b, 0)
            if not x and not y:
                return True
            if x > y:
                limit, a = x, self.halves[a][1]
            else:
                limit, b = y + 1, self.halves[b][0]

    def prefixes(self, units: Iterable[str]) -> Iterator[tuple[str, list[int], list[int], list[int]]]:
        """For each unit in order, of every prefix from the empty one on: tokens, length and id of the last piece (-1: a character by its bytes).

        The lists go on being used: prefixes that a unit shares with the one before are not computed again, so units
        should come sorted.
        """
        root, pairs, size = self.endings, self.pairs, self.size
        tokens, last, ids, before = [0], [0], [0], ""
        for unit in units:
            shared = 0
            for shared, (x, y) in enumerate(zip(unit, before, strict=False)):  # noqa: B007
                if x != y:
                    break
            else:
                shared = min(len(unit), len(before))
            del tokens[shared + 1 :], last[shared + 1 :], ids[shared + 1 :]
            before = unit
            for end in range(shared + 1, len(unit) + 1):
                node, at, found = root, end, []
                while at:
                    node = node.get(unit[at - 1])
                    if node is None:
                        break
                    at -= 1
                    if None in node:
                        found.append((at, node[None]))
                for at, piece in reversed(found):
                    if at:
                        key = ids[at] << 17 | piece
                        fits = pairs.get(key)
                        if fits is None:
                            if len(pairs) > 250_000:
                                pairs.clear()
                            fits = pairs[key] = self.follows(unit[at - last[at] : at], unit[at:end])
                    else:
                        fits = self.alone[unit[:end]]
                    if fits:
                        tokens.append(tokens[at] + 1)
                        last.append(end - at)
                        ids.append(piece)
                        break
                else:
                    if found and found[0][0] == end - 1:
                        raise ValueError(f"no encoding of {unit[:end]!r}")
                    tokens.append(tokens[end - 1] + size(unit[end - 1]))
                    last.append(1)
                    ids.append(-1)
            yield unit, tokens, last, ids

    def _cut(self, unit: str, last: list[int]) -> list[str]:
        out, end = [], len(unit)
        while end:
            n = last[end]
            out.append(unit[end - n : end])
            end -= n
        return out[::-1]

    def size(self, piece: str) -> int:
        return 1 if piece in self.id else len(piece.encode("utf-8", "replace"))

    def merge_run(self, unit: str) -> list[str]:
        """Pieces of a unit that starts with a run of spaces. The last joins the word if it can, those before it are merged by themselves."""
        n = len(unit) - len(unit.lstrip(" "))
        if n == len(unit):
            return self.blank(n)
        word = self.pieces_of(unit[n - 1 :])
        if word[0] == " ":
            return [*self.blank(n), *word[1:]]
        return [*self.blank(n - 1), *word]

    @lru_cache(10_000)  # noqa: B019  a model lives as long as its worker
    def blank(self, n: int) -> tuple[str, ...]:
        return tuple(self.merge(" " * n))

    def pieces_of(self, unit: str) -> list[str]:
        """A unit's pieces, best path for unigram models."""
        if self.kind == "bpe" and unit.startswith("  "):
            return self.merge_run(unit)
        if self.kind == "bpe":
            return next(self._cut(unit, last) for _, _, last, _ in self.prefixes([unit]))
        best: list[tuple[float, str]] = [(0.0, "")]
        for end in range(1, len(unit) + 1):
            best.append(max((best[end - n][0] + self.score.get(unit[end - n : end], self.worst - 10), unit[end - n : end]) for n in range(1, min(self.longest, end) + 1) if self.has(unit[end - n : end])))
        out, end = [], len(unit)
        while end:
            out.append(best[end][1])
            end -= len(out[-1])
        return out[::-1]


def units(text: str) -> list[str]:
    """A text's units: spaces and the word after them; no piece crosses their borders. A space goes before the text."""
    return UNIT.findall(" " + text.replace(SPACE, " ")) if text else []


def words(text: str) -> list[str] | None:
    """A text's units without their one space, those after a line end beginning with it; None if there are runs of spaces."""
    if "  " in text or " \n" in text or text[0] == " " or text[-1] == " " or text[0] == "\n":
        return None
    return text.replace("\n", " \n").split(" ")


@lru_cache(4)
def load(path: str, kind: str = "bpe") -> Model:
    return Model(path, kind)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
