"""Hashed n-grams of the bytes of lower-cased texts, and repeatable samples of rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def gram_hashes(text: str, lengths: range, bits: int) -> list[np.ndarray]:
    """For each length, the bucket of ``2^bits`` of every n-gram of the text between two spaces."""
    raw = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint32)
    out, h = [], np.zeros(len(raw) + 1, np.uint32)
    with np.errstate(over="ignore"):
        for n in range(1, lengths.stop):
            if n > len(raw):
                break
            h = h[:-1] * np.uint32(0x01000193) + raw[n - 1 :] + np.uint32(1)
            if n in lengths:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                mixed = (mixed ^ (mixed >> np.uint32(12))) * np.uint32(0x297A2D39)
                out.append(((mixed ^ (mixed >> np.uint32(15))) >> np.uint32(32 - bits)).astype(np.int32))
    return out


def crc_of_id(doc_id: Column) -> Column:
    """Unsigned crc32 of an id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


SHARES = 1 << 30


def drawn(doc_id: Column, fraction: Column, seed: int) -> Column:
    """Whether a row is among the fraction of rows that a hash of its id draws."""
    return F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(SHARES)) < fraction * SHARES
