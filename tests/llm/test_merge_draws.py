"""Draws of merge-dropout for each occurrence of a word."""

import numpy as np
import public_tokenizers
import xxhash

from caseloom.llm import merges as M

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_every_occurrence_is_drawn():
    s = M.Segmenter(MODEL, 0.3, 1, None)
    word = " transformation"
    made = s.encode(list(range(300)), ["transformation of information"] * 300)
    assert len(set(made)) > 100
    within = s._occurrences([word] * 200, M.word_keys(np.full(200, 7, np.uint64), np.arange(200)))
    assert len(set(within)) > 20
    assert made[:9] == M.Segmenter(MODEL, 0.3, 1, None).encode(list(range(9)), ["transformation of information"] * 9)


def test_kept_results_are_the_agenda():
    texts = ["hello transformation of unbelievable information \u6f22\u5b57 " * 30, "", None, "x" * 90 + " " + "internationalization" * 3, "a\n\tb " * 9] * 3
    s = M.Segmenter(MODEL, 0.2, 5, None)
    made = s.encode(list(range(len(texts))), texts)
    assert [s.decode(x) for x in made] == [t or "" for t in texts]
    for k, (text, got) in enumerate(zip(texts, made)):
        words = s.merges.word.findall(" " + text) if text else []
        keys = M.word_keys(np.full(len(words), xxhash.xxh64_intdigest(repr(k), 5), np.uint64), np.arange(len(words)))
        assert got == b"".join(s.merges.to_ids(s.merges.agenda(w, int(x), 0.2)).tobytes() for w, x in zip(words, keys))
