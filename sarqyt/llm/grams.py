"""Word runs as 64-bit numbers, computed for whole Arrow batches with numpy.

A word is a lower-cased run of letters and digits. A run of k words is hashed from the hashes of its words; two runs
are taken as equal if their hashes are. Where runs are stored, 48 bits are kept: two records of 100 runs each meet by
chance in one of 3 * 10**10 pairs.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\W_]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """Hashes words, remembering those seen; the memory is bounded."""

    def __init__(self, most: int = 400_000) -> None:
        self.seen: dict[str, int] = {}
        self.most = most

    def hashes(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint64)
        seen, out = self.seen, []
        for w in WORD.findall(text.lower()):
            h = seen.get(w)
            if h is None:
                if len(seen) >= self.most:
                    seen.clear()
                h = seen[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        return np.array(out, np.uint64)


    def column(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All words of a column: the row of each and its hash."""
        seen, out, sizes, find = self.seen, [], [], WORD.findall
        if len(seen) >= self.most:
            seen.clear()
        for t in texts:
            ws = find(t.lower()) if t else ()
            sizes.append(len(ws))
            out.extend(ws)
        try:
            h = [seen[w] for w in out]
        except KeyError:
            for w in set(out).difference(seen):
                seen[w] = xxhash.xxh3_64_intdigest(w)
            h = [seen[w] for w in out]
        return np.repeat(np.arange(len(texts)), sizes), np.array(h, np.uint64)


def column_runs(rows: np.ndarray, words: np.ndarray, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The row and the hash of every run of k words inside one row."""
    h = runs(words, k, salt)
    inside = rows[: len(h)] == rows[k - 1 : k - 1 + len(h)]
    return rows[: len(h)][inside], h[inside]


def sorted_sets(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes per row, sorted, as one flat array and n + 1 offsets."""
    order = np.argsort(hashes)
    # a stable sort of 16-bit numbers is a radix sort
    order = order[np.argsort(rows[order].astype(np.uint16 if n <= 65536 else np.int64), kind="stable")]
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    rows, hashes = rows[new], hashes[new]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32)


def packed(hashes: np.ndarray) -> np.ndarray:
    """The upper 48 bits of each hash, as bytes: what a run is stored as."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].ravel()


def unpacked(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = raw.reshape(-1, 6)
    return out.view(">u8").ravel().astype(np.uint64)


def runs(words: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """The hash of every run of k consecutive words, in text order."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.full(n, np.uint64(salt * 2 + 1), np.uint64)
        for i in range(k):
            h = (h ^ words[i : i + n]) * _MULT
            h ^= h >> np.uint64(29)
    return h
