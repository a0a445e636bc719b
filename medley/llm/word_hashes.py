"""64-bit word hashes of whole Arrow text columns, without Python strings.

A word's hash is a polynomial in its bytes modulo 2^64, read off one prefix sum
over a block of bytes, then mixed with the word's length. Words end at x20,
x09-x0D and at the end of a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19         # bytes handled at once; a longer word makes a longer block
BASE = 0x9DDFEA08EB382D69
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
MIX = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def powers(n: int, base: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for the next block."""
    kept = _POWERS.get(base)
    if kept is None or len(kept) < n:
        size = max(n, BLOCK + 4096)
        kept = np.full(size, np.uint64(base))
        kept[0] = 1
        with np.errstate(over="ignore"):
            kept = np.cumprod(kept)
        if n <= BLOCK + 4096:
            _POWERS[base] = kept
    return kept[:n]


INVERSE = pow(BASE, -1, 2**64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without NULLs; offsets start at 0."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_hashes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, number of words of each text)."""
    data, offsets = text_bytes(column)
    found, at_text = [], []
    begins = np.unique(offsets[:-1])
    lo = 0
    with np.errstate(over="ignore"):
        while lo < len(data):
            hi = min(len(data), lo + BLOCK)
            while hi < len(data):                    # cut at white space or between texts
                cut = np.flatnonzero(SPACES[data[hi:hi + 4096]])
                nxt = np.searchsorted(begins, hi)
                text_end = int(begins[nxt]) if nxt < len(begins) else len(data)
                stop = min(hi + int(cut[0]) if len(cut) else hi + 4096, text_end, len(data))
                found_cut = bool(len(cut)) or stop == text_end
                hi = stop
                if found_cut:
                    break
            block = data[lo:hi]
            if lower:
                block = LOWER[block]
            inside = ~SPACES[block]
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            here = begins[np.searchsorted(begins, lo):np.searchsorted(begins, hi)] - lo
            first[here] = inside[here]
            last = inside.copy()
            last[:-1] &= ~inside[1:]
            here = here[here > 0] - 1
            last[here] |= inside[here]
            start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
            values = (block.astype(np.uint64) + np.uint64(1)) * powers(len(block), BASE)
            sums = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(values, out=sums[1:])
            h = (sums[end] - sums[start]) * powers(len(block) + 1, INVERSE)[start]
            found.append(mixed(h + (end - start).astype(np.uint64) * MIX))
            at_text.append(np.searchsorted(offsets, start + lo, side="right") - 1)
            lo = hi
    if not found:
        return np.empty(0, np.uint64), np.zeros(len(column), np.int64)
    counts = np.bincount(np.concatenate(at_text), minlength=len(column)).astype(np.int64)
    return np.concatenate(found), counts


__all__ = ["word_hashes", "text_bytes", "mixed", "powers"]
