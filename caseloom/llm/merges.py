"""Merge-type SentencePiece encoding with seeded merge-dropout, and lossless decoding.

Encoding starts from single characters and keeps an agenda of neighbours that form a piece;
the best-scored candidate, the leftmost of equals, is merged first.  With dropout, a
candidate is skipped if a hash of the seed, the document, the word's position in it and the
candidate's own place falls below the rate, so equal seeds give equal ids on any cluster, and
every occurrence of a word is segmented on its own.  With rate 0 the ids are those of the
library.

Words are independent, because no piece goes on over the start of a run of spaces.  Every
occurrence goes through its own merges and none is kept: short words are merged together,
many occurrences in step; long ones by an agenda of their own.
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame

from caseloom.llm.batches import add_columns

SPACE = "▁"
SHIFT = 21  # symbols are pieces, or characters without a piece after all pieces
NONE = (1 << 31) - 1
LONG = 64  # characters of a word that is merged by itself; its ids are the same either way
STEP = 50_000  # occurrences merged at once
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _draw(key: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number from 0 to 1 for each candidate: where it starts, where its halves meet, where it ends."""
    with np.errstate(over="ignore"):
        return _mixed(key + _place(start, mid, end))


def _place(start: np.ndarray, mid: np.ndarray, end: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return start.astype(np.uint64) * _C[0] + mid.astype(np.uint64) * _C[1] + end.astype(np.uint64) * _C[2]


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _C[3]
        x = (x ^ (x >> np.uint64(27))) * _C[4]
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


class Merges:
    """The merges of a model file, and its pieces as bytes."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(n)]
        self.ids = {p.replace(SPACE, " "): i for i, p in enumerate(pieces) if not special[i]}
        self.bytes_at = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.plain = [b"" if special[i] else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        for b, i in enumerate(self.bytes_at.tolist()):
            self.plain[i] = bytes([b])
        # a run of spaces starts a word, and so may characters that are in no piece
        apart = "".join(c for c in "\n\t\r" if not any(c in p for p in self.ids))
        inside = any(" " in p.lstrip(" ") for p in self.ids)
        self.word = re.compile(r"(?s).+") if inside else re.compile(rf" *[^ {re.escape(apart)}]+| +|[{re.escape(apart)}]+" if apart else r" *[^ ]+| +")
        order = {s: r for r, s in enumerate(sorted({model.get_score(i) for i in range(n)}, reverse=True))}
        keys, ranks, made = [], [], []
        for p, i in self.ids.items():
            for cut in range(1, len(p)):
                a, b = self._symbol(p[:cut]), self._symbol(p[cut:])
                if a is not None and b is not None:
                    keys.append(a << SHIFT | b)
                    ranks.append(order[model.get_score(i)])
                    made.append(i)
        at = np.argsort(np.array(keys, np.int64))
        self.keys, self.ranks, self.made = np.array(keys, np.int64)[at], np.array(ranks, np.int64)[at], np.array(made, np.int64)[at]
        self._spread()
        self.chars = np.arange(0x110000, dtype=np.int32) + n
        for p, i in self.ids.items():
            if len(p) == 1:
                self.chars[ord(p)] = i

    def _symbol(self, part: str) -> int | None:
        return self.ids.get(part, self.size + ord(part) if len(part) == 1 else None)

    def _spread(self) -> None:
        """Places the pairs in a table by a hash of theirs, the next free place if it is taken."""
        self.shift = 64 - max(4, (4 * len(self.keys)).bit_length())
        self.slots = np.full(1 << 64 - self.shift, -1, np.int64)  # which pair, -1 where none is
        free = np.arange(len(self.keys))
        at = self._slot(self.keys)
        while len(free):
            at[free] %= len(self.slots)
            some = free[self.slots[at[free]] < 0]
            self.slots[at[some]] = some  # of several for one place, one gets it
            free = free[self.slots[at[free]] != free]
            at[free] += 1
        held = self.slots >= 0
        self.slot_keys = np.where(held, self.keys[self.slots], -1) if len(self.keys) else np.full(len(self.slots), -1, np.int64)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (key.astype(np.uint64) * _C[0] >> np.uint64(self.shift)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of the merge of each pair of neighbours, -1 where they form no piece."""
        key = left.astype(np.int64) << SHIFT | right
        at = self._slot(key)
        found = self.slot_keys[at]
        out = np.where(found == key, self.slots[at], -1)
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.slots)
            found = self.slot_keys[at[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.slots[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def to_ids(self, symbols: np.ndarray) -> np.ndarray:
        return self.ids_of(symbols, np.array([0, len(symbols)]))[0]

    def ids_of(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, and the bounds among them; characters without a piece become their bytes."""
        odd = symbols >= self.size
        if not odd.any():
            return symbols.astype("<i4"), bounds
        chars = "".join(map(chr, (symbols[odd] - self.size).tolist()))
        each = np.ones(len(symbols), np.int64)
        each[odd] = [len(c.encode()) for c in chars]
        out = np.repeat(symbols, each).astype("<i4")
        out[np.repeat(odd, each)] = self.bytes_at[np.frombuffer(chars.encode(), np.uint8)]
        return out, np.concatenate([[0], np.cumsum(each)])[bounds]

    def agenda(self, word: str, key: int, rate: float) -> np.ndarray:
        """One word by a priority queue of candidates."""
        sym = self.chars[np.array([ord(c) for c in word], np.int64)].tolist()
        n = len(sym)
        start, end = list(range(n)), list(range(1, n + 1))
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(lefts: list[int]) -> None:
            lefts = [i for i in lefts if i >= 0 and after[i] >= 0]
            if not lefts:
                return
            rights = [after[i] for i in lefts]
            a, b = np.array([sym[i] for i in lefts], np.int64), np.array([sym[j] for j in rights], np.int64)
            merge = self.look_up(a, b)
            rank, made = np.where(merge >= 0, self.ranks[merge], NONE), self.made[merge]
            places = [np.array(x) for x in ([start[i] for i in lefts], [start[j] for j in rights], [end[j] for j in rights])]
            skipped = _draw(np.full(len(lefts), key, np.uint64), *places) < rate
            for i, j, r, m, s in zip(lefts, rights, rank.tolist(), made.tolist(), skipped.tolist()):
                if r < NONE and not s:
                    heapq.heappush(heap, (r, i, sym[i], sym[j], m))

        offer(list(range(n)))
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue  # one of them was merged meanwhile
            sym[i], end[i], after[i], sym[j] = m, end[j], after[j], -1
            if after[i] >= 0:
                before[after[i]] = i
            offer([before[i], i])
        return np.array([s for s in sym if s >= 0], np.int64)

    def in_step(self, words: list[str], keys: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
        """Many words at once: each round does the next merge of every word that has one.

        All symbols, and where those of each word begin and end.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.chars[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]
        of = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        end = (np.arange(1, len(sym) + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        left, done = np.zeros(len(words), np.int64), []

        def candidates(i: np.ndarray) -> np.ndarray:
            """Rank of each symbol with its right neighbour, which is of the same word."""
            merge = self.look_up(sym[i], sym[i + 1])
            out = np.full(len(i), NONE, np.int32)
            some = np.flatnonzero(merge >= 0)
            rank = self.ranks[merge[some]]
            if rate > 0 and len(some):
                x = i[some]
                start = np.where((x > 0) & (of[x - 1] == of[x]), end[x - 1], 0)
                rank[_draw(keys[of[x]], start, end[x], end[x + 1]) < rate] = NONE
            out[some] = rank
            return out

        rank = np.full(len(sym), NONE, np.int32)
        pairs = np.flatnonzero(of[1:] == of[:-1])
        rank[pairs] = candidates(pairs)
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            best = np.minimum.reduceat(rank.astype(np.int64) << 32 | np.arange(len(sym)), first)
            going = best < NONE << 32
            each = np.diff(np.append(first, len(sym)))
            keep = np.repeat(going, each)
            if not going.all():
                done.append((sym[~keep], of[~keep], (np.arange(len(sym)) - np.repeat(first, each))[~keep]))
                left[of[first[~going]]] = each[~going]
            at = (best & 0xFFFFFFFF)[going]
            sym[at], end[at] = self.made[self.look_up(sym[at], sym[at + 1])], end[at + 1]
            keep[at + 1] = False
            fresh = (np.cumsum(keep) - 1)[at]
            sym, of, end, rank = sym[keep], of[keep], end[keep], rank[keep]
            rank[fresh] = NONE
            again = np.concatenate([fresh[fresh > 0] - 1, fresh[fresh + 1 < len(sym)]])  # one merge a word, so none is named twice
            again = again[of[again] == of[again + 1]]
            rank[again] = candidates(again)
        bounds = np.concatenate([[0], np.cumsum(left)])
        out = np.zeros(bounds[-1], np.int32)
        for part, word, place in done:
            out[bounds[word] + place] = part
        return out, bounds


def word_keys(docs: np.ndarray, position: np.ndarray) -> np.ndarray:
    """The key of each word of a document, by the document's hash and the word's position."""
    with np.errstate(over="ignore"):
        x = docs + position.astype(np.uint64) * _C[2]
        x = (x ^ (x >> np.uint64(29))) * _C[4]
        x = (x ^ (x >> np.uint64(32))) * _C[3]
        return x ^ (x >> np.uint64(31))


class Segmenter:
    """Ids of texts for one rate and seed, ``step`` occurrences of words merged at once."""

    def __init__(self, path: str, rate: float, seed: int, step: int | None = None):
        self.merges, self.rate, self.seed, self.step = Merges(path), rate, seed & (1 << 64) - 1, step or STEP

    def encode(self, keys: list, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids; the key of a text picks the draws of its words."""
        split = [self.merges.word.findall(" " + t) if t else [] for t in texts]
        sizes = np.array([len(w) for w in split], np.int64)
        docs = np.array([xxhash.xxh64_intdigest(repr(k), self.seed) for k in keys], np.uint64)
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        every = word_keys(np.repeat(docs, sizes), place)
        words = [w for part in split for w in part]
        made, ends, total = [], [np.zeros(1, np.int64)], 0
        for lo in range(0, len(words), self.step):
            ids, bounds = self._flat(words[lo : lo + self.step], every[lo : lo + self.step])
            made.append(ids)
            ends.append(bounds[1:] + total)
            total += len(ids)
        raw = b"".join(x.tobytes() for x in made)
        cuts = (4 * np.concatenate(ends)[np.concatenate([[0], np.cumsum(sizes)])]).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def _occurrences(self, words: list[str], keys: np.ndarray) -> list[bytes]:
        """Ids of each occurrence of a word, drawn by its own key."""
        ids, bounds = self._flat(words, keys)
        cuts = bounds.tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def _flat(self, words: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each by its key, and the bounds of each word's."""
        long = [i for i, w in enumerate(words) if len(w) > LONG]
        if not long:
            return self.merges.ids_of(*self.merges.in_step(words, keys, self.rate))
        made, sizes, last = [], [], 0
        for i in [*long, len(words)]:
            ids, bounds = self.merges.ids_of(*self.merges.in_step(words[last:i], keys[last:i], self.rate))
            made.append(ids)
            sizes.append(np.diff(bounds))
            if i < len(words):
                ids = self.merges.to_ids(self.merges.agenda(words[i], int(keys[i]), self.rate))
                made.append(ids)
                sizes.append(np.array([len(ids)]))
            last = i + 1
        return np.concatenate(made), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])

    def decode(self, raw: bytes) -> str:
        text = b"".join(map(self.merges.plain.__getitem__, np.frombuffer(raw, "<i4").tolist())).decode()
        return text[1:]


_MADE: dict[tuple, Segmenter] = {}


def segmenter(path: str, rate: float, seed: int) -> Segmenter:
    """The worker's segmenter for these settings."""
    key = (path, rate, seed)
    if key not in _MADE:
        _MADE[key] = Segmenter(*key)
    return _MADE[key]


def encode(docs: DataFrame, model: str, rate: float = 0.1, seed: int = 0, keep_text: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds ``pieces``, the little-endian 32-bit ids of each whole text, to every row and column of ``docs``.

    Null and empty texts have no ids.  Rows of equal id and text get equal ids; a null id is
    a key like any other.  Very long texts are merged whole, so many words at a time.  An
    empty table gives no rows; other columns are kept, but for one called ``pieces``.
    """

    def ids(batch: pa.RecordBatch) -> list[pa.Array]:
        made = segmenter(model, rate, seed).encode(batch.column(id_col).to_pylist(), batch.column(text_col).to_pylist())
        return [pa.array(made, pa.binary())]

    return add_columns(docs, ids, "pieces binary", text_col, keep_text)


def decode(rows: DataFrame, model: str, name: str = "decoded", keep_pieces: bool = True) -> DataFrame:
    """Adds the text of ``pieces``; what :func:`encode` made of a text is that text again, of null the empty one."""

    def texts(batch: pa.RecordBatch) -> list[pa.Array]:
        s = segmenter(model, 0.0, 0)
        return [pa.array([s.decode(x or b"") for x in batch.column("pieces").to_pylist()], pa.string())]

    return add_columns(rows, texts, f"{name} string", "pieces", keep_pieces)


def round_trip(docs: DataFrame, model: str, rate: float = 0.1, seed: int = 0) -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, lossless`` of every document, each encoded and decoded again."""

    def check(batch: pa.RecordBatch) -> list[pa.Array]:
        s = segmenter(model, rate, seed)
        plain = batch.column("text").to_pylist()
        made = s.encode(batch.column("doc_id").to_pylist(), plain)
        same = [s.decode(x) == (t or "") for x, t in zip(made, plain)]
        return [pa.array([len(x) // 4 for x in made], pa.int64()), pa.array([zlib.crc32(x) for x in made], pa.int64()), pa.array(same)]

    return add_columns(docs.select("doc_id", "text"), check, "n_pieces long, ids_crc32 long, lossless boolean", "text", keep_text=False)
