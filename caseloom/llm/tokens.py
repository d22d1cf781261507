"""Token ids of whole texts, by a tokenizer file of the ``tokenizers`` library.

A byte-level BPE never merges over the start of a run of spaces, so texts are cut there
and equal pieces are encoded once per task.  New pieces are joined into long strings for
the library and cut again by the ids' byte lengths.  Texts with unusual spaces or special
tokens go through the library whole, so that the ids are always those of the whole text.
"""

from __future__ import annotations

import os
import re

import numpy as np
from tokenizers import Tokenizer

from caseloom.llm import batches

#: Runs of spaces with the word that follows.
PIECE = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
#: What a text has where there is more than one space or line end between words, or another space.
RUNS = ("\t", "\r", "\0", "  ", " \n", "\n ", "\n\n")
#: Characters that some definition calls a space and PIECE does not.
CONTROLS = "\x0b\x0c\x1c\x1d\x1e\x1f"
UNUSUAL = re.compile("[\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200f\\u2028-\\u202f\\u205f-\\u2064\\u3000\\ufeff]")
KEPT_PIECES = 1_000_000  # in each of two generations, of some 250 bytes each
JOINED_CHARS = 1 << 17


def _unusual(text: str) -> bool:
    return any(c in text for c in CONTROLS) if text.isascii() else bool(UNUSUAL.search(text))


def _runs(text: str) -> bool:
    """Whether a text has runs of spaces, or one at either end; plain searches are faster than a pattern."""
    return any(r in text for r in RUNS) or text[:1] in ("", " ", "\n") or text[-1] in " \n"


def _pieces(text: str, lead: str = "") -> list[str]:
    """``lead``, which is nothing or a space, and the text, cut before each run of spaces, by names: of a piece
    ``" word"`` it is the word, of one that begins with a line end the piece itself, of any other the piece after a NUL."""
    if _runs(text):
        return [p[1:] if p[0] == " " and p[1:2] not in ("", *" \n\t\r\0") else "\0" + p for p in PIECE.findall(lead + text)]
    return (("" if lead else "\0") + text.replace("\n", " \n")).split(" ")


def _positions(ids: list) -> list[int]:
    """Where None stands."""
    out, at = [], -1
    try:
        while True:
            at = ids.index(None, at + 1)
            out.append(at)
    except ValueError:
        return out


def _piece(name: str) -> str:
    return name[1:] if name[0] == "\0" else name if name[0] == "\n" else " " + name


class Encoder:
    """Encodes texts to little-endian ids of ``dtype``; one per worker process.

    ``plain``: the strings of special tokens in a text are text like any other.
    """

    def __init__(self, path: str, kept: int = KEPT_PIECES, plain: bool = False):
        self.kept = kept
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        kind = type(self.tokenizer.pre_tokenizer).__name__ if self.tokenizer.pre_tokenizer else ""
        self.by_piece = kind == "ByteLevel" and self.tokenizer.normalizer is None
        self.tokenizer.encode_special_tokens = plain
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content for t in added if not (plain and t.special)]
        self.widths = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the generation before; what is still used moves to known

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, names: list[str]) -> None:
        alone = [n for n in names if n[0] == "\0"]
        self.known.update(zip(alone, self._whole([n[1:] for n in alone])))
        chunk, chars = [], 0
        for n in names:
            if n[0] != "\0":
                chunk.append(n)
                chars += len(n)
                if chars > JOINED_CHARS:
                    self._joined(chunk)
                    chunk, chars = [], 0
        self._joined(chunk)

    def _joined(self, names: list[str]) -> None:
        """Learns pieces that each begin with a space, in one call."""
        if not names:
            return
        pieces = list(map(_piece, names))
        ids = np.frombuffer(self._whole(["".join(pieces)])[0], self.dtype)
        ends = np.cumsum(self.widths[ids])
        cuts = (np.searchsorted(ends, np.cumsum([len(p.encode()) for p in pieces])) + 1) * self.dtype.itemsize
        raw, at = ids.tobytes(), 0
        for n, cut in zip(names, cuts.tolist()):
            self.known[n] = raw[at:cut]
            at = cut

    def encode(self, texts: list[str | None], lead: str = "") -> list[bytes]:
        """The ids of ``lead`` (nothing or a space) and each text, None counting as empty."""
        plain = [t or "" for t in texts]
        if not self.by_piece:
            return self._whole([lead + t for t in plain])
        whole = [i for i, t in enumerate(plain) if _unusual(t) or any(s in t for s in self.special)]
        odd = set(whole)
        get, out = self.known.get, [b""] * len(plain)
        missed = {}
        for i, t in enumerate(plain):
            if i not in odd:
                parts = _pieces(t, lead)
                ids = list(map(get, parts))
                if None in ids:
                    missed[i] = (parts, ids, _positions(ids))
                else:
                    out[i] = b"".join(ids)
        if missed:
            new = {parts[k] for parts, _, at in missed.values() for k in at}
            self.known.update((p, self.older[p]) for p in new & self.older.keys())
            self._learn(list(new - self.older.keys()))
            for i, (parts, ids, at) in missed.items():
                for k in at:
                    ids[k] = get(parts[k])
                out[i] = b"".join(ids)
            if len(self.known) > self.kept:
                self.older, self.known = self.known, {}
        for i, ids in zip(whole, self._whole([lead + plain[i] for i in whole]) if whole else []):
            out[i] = ids
        return out


_MADE: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, kept: int = KEPT_PIECES, plain: bool = False) -> Encoder:
    """The worker's encoder for a file that every machine has at ``path``; fewer kept pieces take less memory and more time."""
    key = path, plain
    if key not in _MADE:
        _MADE[key] = Encoder(path, plain=plain)
    _MADE[key].kept = kept
    return _MADE[key]


def _forget() -> None:
    for made in _MADE.values():
        made.known, made.older = {}, {}


batches.CACHES["tokens"] = _forget
