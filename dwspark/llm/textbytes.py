"""Words, shingles and polynomial hashes of many texts at once, over the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20  # bytes handled at a time; a longer text is handled alone

_rng = np.random.default_rng(7)
BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
ROLL = _rng.integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE ** i`` and its inverse modulo 2**64 for i below ``n``."""
    if len(_powers.get("up", ())) < max(n, 1):
        size = max(n, CHUNK + 2)
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def column(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text or binary column (null: empty) and its rows' offsets."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = pc.fill_null(array, b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    array = array.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8)
    data = np.frombuffer(array.buffers()[2], np.uint8) if array.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, min(end, n)
        row = min(end, n)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums whose differences, times the inverse power of the start, hash any substring."""
    up, _ = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * up, out=total[1:])
    return total


def hash_slices(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(total))
    return mix((total[end] - total[start]) * down[start])


def word_spans(data: np.ndarray, offsets: np.ndarray, is_gap: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that lie side by side, and each text's first word."""
    word = ~is_gap[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)


def window_sums(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` neighbours of ``h``."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = h[:n] * ROLL[0]
    for k in range(1, width):
        total += h[k:k + n] * ROLL[k]
    return mix(total)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted, and their offsets. Bytes A-Z count as lower
    case. A text of fewer words than ``width`` has its whole word sequence as its one shingle; a text
    without words has none."""
    offsets = offsets - offsets[0]
    parts = list(chunks(offsets))
    if len(parts) > 1:  # working memory follows one part, not all texts
        done = [shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1], width) for i, j in parts]
        return np.concatenate([g for g, _ in done]), np.append(0, np.cumsum(np.concatenate([np.diff(at) for _, at in done])))
    low = LOWER[data]
    start, end, first = word_spans(low, offsets)
    words = hash_slices(prefix_hash(low), start, end)
    n_words = np.diff(first)
    grams = window_sums(words, width)
    # A window belongs to a text if it begins and ends there.
    text = np.repeat(np.arange(len(n_words)), n_words)
    inside = text[: len(grams)] == text[width - 1:] if len(grams) else np.zeros(0, bool)
    owner, grams = text[: len(grams)][inside], grams[inside]
    short = np.flatnonzero((n_words > 0) & (n_words < width))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = n_words[short] > k
            whole[has] += words[first[short[has]] + k] * ROLL[32 + k]
        owner, grams = np.concatenate([owner, short]), np.concatenate([grams, mix(whole + n_words[short].astype(np.uint64))])
    order = np.lexsort((grams, owner))
    owner, grams = owner[order], grams[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    owner, grams = owner[new], grams[new]
    return grams, np.searchsorted(owner, np.arange(len(n_words) + 1))
