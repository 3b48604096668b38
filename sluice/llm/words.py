"""Words, n-gram hashes and sets of whole texts, for a batch of texts at a time in numpy.

A word is a run of bytes other than space and tab to carriage return; A-Z are lower-cased. Words and
n-grams are represented by 64-bit hashes. Used inside Arrow batches that Spark deals out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
CHUNK = 4_000_000  # bytes of text handled at once; a longer text is handled alone


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def numbers(n: int, seed: int) -> np.ndarray:
    """The first n numbers of a fixed pseudo-random sequence."""
    step = np.uint64(0x9E3779B97F4A7C15)
    return mix((np.arange(n, dtype=np.uint64) + np.uint64(1)) * step + mix(np.array([seed], np.uint64)))


_BYTE = numbers(256, 1)
_PLACE = numbers(256, 2) | np.uint64(1)
_ROLE = numbers(64, 3) | np.uint64(1)


def chunks(texts: list, limit: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts) of runs of texts of about `limit` bytes. Null: empty."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = b"" if text is None else text if isinstance(text, bytes) else text.encode()
        if held and size + len(raw) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield first, held


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of each text and their total): words of text i are
    hashes[starts[i]:starts[i + 1]]."""
    global _PLACE
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1)))
    begin, end = edge[0::2], edge[1::2]
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    starts = np.concatenate([[0], np.searchsorted(begin, ends)])
    if not len(begin):
        return np.zeros(0, np.uint64), starts
    size = end - begin
    if size.max() > len(_PLACE):
        _PLACE = numbers(int(size.max()) * 2, 2) | np.uint64(1)
    inside = np.flatnonzero(~space)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    place = np.arange(len(inside)) - np.repeat(first, size)
    return mix(np.add.reduceat(_BYTE[data[inside]] * _PLACE[place], first)), starts


def ngram_hashes(words: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words inside one text, and the first run of each text and their
    total. A text of fewer words has its whole sequence as one run; one without words has none."""
    count = np.diff(starts)
    runs = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    first = np.concatenate([[0], np.cumsum(runs)])
    total = int(first[-1])
    if not total:
        return np.zeros(0, np.uint64), first
    text = np.repeat(np.arange(len(count)), runs)
    at = np.arange(total) - np.repeat(first[:-1], runs) + starts[text]
    left = starts[text + 1] - at
    out = np.zeros(total, np.uint64)
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    for k in range(n):
        out += np.where(left > k, (padded[at + k] ^ _ROLE[k + 8]) * _ROLE[k], np.uint64(0))
        out = mix(out) if k + 1 == n else out
    return out, first


def sets(hashes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct hashes of each text."""
    return [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:])]
