"""Words of many texts at once: boundaries and 64-bit hashes by array operations."""

from __future__ import annotations

import numpy as np

# Bytes hashed at once.
STRETCH = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_MARKS = np.ones(256, bool)
_MARKS[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = False
#: Bytes that end a word, by kind of word.
BREAKS = {"space": _SPACES, "mark": _MARKS}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_FORWARD = _powers(1 << 16, int(_BASE))
_INVERSE = _powers(1 << 16, pow(int(_BASE), -1, 1 << 64))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _FORWARD, _INVERSE
    if n > len(_FORWARD):
        size = 1 << (n - 1).bit_length()
        _FORWARD, _INVERSE = _powers(size, int(_BASE)), _powers(size, pow(int(_BASE), -1, 1 << 64))
    return _FORWARD, _INVERSE


def word_spans(data: np.ndarray, breaks: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in an array of bytes."""
    inside = np.empty(len(data) + 2, np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~BREAKS[breaks][data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, the same wherever the span stands.

    Long data is hashed in stretches of bounded size: spans are in order and
    do not overlap.
    """
    if len(data) <= STRETCH:
        return _span_hashes(data, starts, ends)
    out, i = [np.empty(0, np.uint64)], 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + STRETCH, "right")))
        out.append(_span_hashes(data[lo : ends[j - 1]], starts[i:j] - lo, ends[i:j] - lo))
        i = j
    return np.concatenate(out)


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.empty(0, np.uint64)
    forward, inverse = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    # Byte values are spread first: sums of small terms would meet too often.
    np.cumsum(_SPREAD[data] * forward[: len(data)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(raw ^ mix((ends - starts).astype(np.uint64)))


_SPREAD = mix(np.arange(1, 257, dtype=np.uint64))


def word_hashes(text: bytes, breaks: str) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    return span_hashes(data, *word_spans(data, breaks))


def batch_words(texts: list[bytes], breaks: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, first word of each text, closed by the count) of joined texts."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    starts, ends = word_spans(data, breaks)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    return data, starts, ends, np.searchsorted(starts, begins[:-1]).astype(np.int64).tolist() + [len(starts)]


def text_bytes(text: str | None) -> bytes:
    """UTF-8 of a text, empty for null; lone surrogates are kept as they are."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")
