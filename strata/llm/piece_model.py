"""A SentencePiece model as a weighted finite-state transducer.

Three machines are compiled from the model file and composed with each input:

* the normaliser: one state, mapping space to U+2581, with U+2581 added in front (if the model says so);
* the lexicon: a trie of the pieces whose leaves lead back to its root, reading characters and writing piece ids; a character
  that starts no path of its own is read as a piece of one character and written as its UTF-8 bytes' ids;
* the weights, in the tropical semiring. Unigram models weigh a piece by minus its score. For BPE models a pair of neighbouring
  pieces weighs 0 if merging the two pieces' characters gives the pair back, else infinity; a segmentation is the one
  that merging gives just when all its neighbours do so, hence exactly one path is finite.

``encode`` relaxes the composition in the order of the positions and follows the shortest path back. With BPE weights one piece
is left at most for every prefix, so the state is the position alone.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
INFINITE = float("inf")
#: Words kept with their ids, and weights of neighbouring pieces, in each process (about 100 MB); a table is emptied when full.
CACHE = 400_000
#: Longer words are not kept.
CACHED_CHARS = 48


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a protocol-buffer message."""

    def number(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            shift += 7
            i += 1
            if data[i - 1] < 128:
                return value, i

    i = 0
    while i < len(data):
        key, i = number(i)
        kind = key & 7
        if kind == 0:
            value, i = number(i)
        elif kind == 2:
            size, i = number(i)
            value, i = data[i : i + size], i + size
        else:
            size = 4 if kind == 5 else 8
            value, i = struct.unpack("<f" if size == 4 else "<d", data[i : i + size])[0], i + size
        yield key >> 3, value


@dataclass(frozen=True)
class Spec:
    """What the model file says: pieces in the order of their ids, and the flags of the normaliser."""

    pieces: tuple[tuple[str, float, int], ...]
    kind: int
    byte_fallback: bool
    add_prefix: bool


def read_spec(data: bytes) -> Spec:
    pieces, kind, fallback, prefix, squeeze, escape, chars = [], UNIGRAM, False, True, True, True, b""
    for field, value in _fields(data):
        if field == 1:
            piece = {1: b"", 2: 0.0, 3: NORMAL} | dict(_fields(value))
            pieces.append((piece[1].decode(), piece[2], piece[3]))
        elif field == 2:
            trainer = dict(_fields(value))
            kind, fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
        elif field == 3:
            rules = dict(_fields(value))
            chars, prefix, squeeze, escape = rules.get(2, b""), rules.get(3, 1), rules.get(4, 1), rules.get(5, 1)
    if chars or squeeze or not escape or kind not in (UNIGRAM, BPE):
        raise ValueError("only identity normalisers that keep and escape spaces, and BPE or unigram models, are compiled")
    return Spec(tuple(pieces), kind, fallback, bool(prefix))


class PieceModel:
    def __init__(self, spec: Spec):
        self.spec = spec
        usable = {p: i for i, (p, _, kind) in enumerate(spec.pieces) if kind in (NORMAL, USER)}
        self.rank = {p: -spec.pieces[i][1] for p, i in usable.items()}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(spec.pieces) if kind == BYTE}
        self.unknown = next((i for i, p in enumerate(spec.pieces) if p[2] == UNKNOWN), None)
        self.bpe = spec.kind == BPE
        self.worst = max(self.rank.values(), default=0.0) + 10.0  # unknown characters in unigram models
        if self.bpe:
            tree = {p: self._merges(p) for p in usable}
            usable = {p: i for p, i in usable.items() if len(p) == 1 or tree[p] is not None}
            self.right = {p: self._spine(p, tree, 1) for p in usable}
            self.left = {p: self._spine(p, tree, 0) for p in usable}
        self.ids = usable
        self.trie: dict = {}
        for p in usable:
            node = self.trie
            for c in p[:-1]:
                node = node.setdefault(c, [None, {}])[1]
            node.setdefault(p[-1], [None, {}])[0] = p
        self.width = 2 if len(spec.pieces) <= 1 << 16 else 4
        #: A line break that no piece holds keeps what stands around it apart.
        self.by_lines = self.bpe and not any("\n" in p for p in usable)
        self.by_words = self.bpe and not any(SPACE in p.lstrip(SPACE) for p in usable)
        self._texts = [self._text(i) for i in range(len(spec.pieces))]
        self._words: dict[str, bytes] = {}
        self._pairs: dict[str, dict[str, float]] = {}
        self._n_pairs = 0
        self._break = self._ids("\n")

    # -- BPE weights ---------------------------------------------------------------------------------------------

    def _merges(self, piece: str) -> tuple[str, str] | None:
        """The last merge that makes ``piece`` from its characters (best score first, then leftmost); None if they end otherwise."""
        parts, last = list(piece), None
        while len(parts) > 1:
            best = min(((self.rank.get(a + b, INFINITE), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))))
            if best[0] == INFINITE:
                return None
            i = best[1]
            last = (parts[i], parts[i + 1])
            parts[i : i + 2] = ["".join(last)]
        return last

    def _spine(self, piece: str, tree: dict, side: int) -> list[tuple[str, float]]:
        """The parts of ``piece`` that reach its right (1) or left (0) end, each with the rank of the merge that used it up."""
        out, used = [], INFINITE
        while True:
            out.append((piece, used))
            if len(piece) == 1 or tree[piece] is None:
                return out
            used = self.rank[piece]
            piece = tree[piece][side]

    def weight(self, before: str, piece: str) -> float:
        """Of ``piece`` after ``before`` ("": at the start)."""
        if not self.bpe:
            return self.rank.get(piece, self.worst)
        # The pair falls apart if some merge across the seam comes before both sides' own merges.
        for a, used_a in self.right.get(before, [(before, INFINITE)] if before else []):
            for b, used_b in self.left.get(piece, [(piece, INFINITE)]):
                r = self.rank.get(a + b, INFINITE)
                if r < used_a and r <= used_b and r < INFINITE:
                    return INFINITE
        return 0.0

    # -- shortest path ---------------------------------------------------------------------------------------------

    def shortest_path(self, text: str) -> list[str]:
        """The pieces of the least path through the composition with ``text`` (already normalised)."""
        back = self._finite_path(text) if self.bpe else self._least_path(text)
        path, n = [], len(text)
        while n:
            path.append(back[n])
            n -= len(back[n])
        return path[::-1]

    def _least_path(self, text: str) -> list[str]:
        """The last piece of the least path to each position; weights of pieces."""
        n = len(text)
        cost, back = [INFINITE] * (n + 1), [""] * (n + 1)
        cost[0] = 0.0

        def relax(i: int, j: int, piece: str) -> None:
            total = cost[i] + self.weight(back[i], piece)
            if total < cost[j]:
                cost[j], back[j] = total, piece

        for i in range(n):
            node, j = self.trie, i
            while j < n and (arc := node.get(text[j])) is not None:
                piece, node = arc
                j += 1
                if piece is not None:
                    relax(i, j, piece)
            if text[i] not in self.ids:  # byte fallback
                relax(i, i + 1, text[i])
        return back

    def _finite_path(self, text: str) -> list[str | None]:
        """The same for weights of pairs, 0 or infinite: relaxing is to reach a position for the first time."""
        n, ids, pairs = len(text), self.ids, self._pairs
        back: list[str | None] = [None] * (n + 1)
        back[0] = ""
        for i in range(n):
            before = back[i]
            if before is None:
                continue
            weights = pairs.get(before)
            if weights is None:
                if self._n_pairs >= CACHE:
                    pairs.clear()
                    self._n_pairs = 0
                weights = pairs[before] = {}
            node, j = self.trie, i
            while j < n:
                arc = node.get(text[j])
                if arc is None:
                    break
                piece, node = arc
                j += 1
                if piece is not None and back[j] is None:
                    w = weights.get(piece)
                    if w is None:
                        w = weights[piece] = self.weight(before, piece)
                        self._n_pairs += 1
                    if not w:
                        back[j] = piece
            if back[i + 1] is None and text[i] not in ids and not self.weight(before, text[i]):  # byte fallback
                back[i + 1] = text[i]
        return back

    def _ids(self, text: str) -> bytes:
        """The ids of ``text``, little-endian."""
        out: list[int] = []
        for piece in [text] if text in self.ids else self.shortest_path(text):
            if piece in self.ids:
                out.append(self.ids[piece])
            elif self.spec.byte_fallback:
                out += [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
        return struct.pack(f"<{len(out)}{'H' if self.width == 2 else 'I'}", *out)

    def _word(self, word: str) -> bytes:
        """The ids of ``word`` after one space."""
        got = self._ids(SPACE + word)
        if len(word) <= CACHED_CHARS:
            if len(self._words) >= CACHE:
                self._words.clear()
            self._words[word] = got
        return got

    def _line(self, line: str, prefix: bool, out: list[bytes]) -> None:
        """``line`` in parts that no piece crosses."""
        if not self.by_words:
            out.append(self._ids((SPACE if prefix else "") + line.replace(" ", SPACE)))
            return
        words = line.split(" ")
        if "" not in words:
            if not prefix:
                out.append(self._ids(words.pop(0)))
            got = list(map(self._words.get, words))
            if None in got:
                got = [self._word(w) if g is None else g for g, w in zip(got, words, strict=True)]
            out.extend(got)
            return
        spaces = SPACE if prefix else ""  # a run of spaces stays with the word behind it
        for i, word in enumerate(words):
            if i:
                spaces += SPACE
            if word:
                out.append(self._ids(spaces + word))
                spaces = ""
        if spaces:
            out.append(self._ids(spaces))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian uint16 (uint32 for over 65,536 pieces)."""
        if not text:
            return b""
        text = text.replace(SPACE, " ")  # the normaliser makes them one
        lines = text.split("\n") if self.by_lines else [text]
        out: list[bytes] = []
        for i, line in enumerate(lines):
            if i:
                out.append(self._break)
            self._line(line, self.spec.add_prefix and not i, out)
        return b"".join(out)

    # -- decoding ---------------------------------------------------------------------------------------------------

    def _text(self, i: int) -> bytes:
        piece, _, kind = self.spec.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return piece.replace(SPACE, " ").encode()

    def decode(self, ids: bytes) -> str:
        numbers = memoryview(ids).cast("H" if self.width == 2 else "I")
        raw = b"".join(map(self._texts.__getitem__, numbers))
        text = raw.decode("utf-8", "replace")
        return text[1:] if self.spec.add_prefix and text.startswith(" ") else text

    def count(self, ids: bytes) -> int:
        return len(ids) // self.width


@lru_cache(2)
def load(data: bytes) -> PieceModel:
    """The compiled model of a model file's content, once per process."""
    return PieceModel(read_spec(data))
