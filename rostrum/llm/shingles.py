"""Columnar word-shingle hashing: whole Arrow batches, no Python loop over rows or words.

A word is an unbroken run of a-z / 0-9 of the lower-cased text.  A shingle is a
run of ``k`` consecutive words of one text, represented by a 64-bit mix of its
word hashes.  All functions work on one Arrow string array at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_WORD_TABLE = np.zeros(256, np.uint64)
for _c in range(256):
    _low = _c + 32 if 65 <= _c <= 90 else _c
    if 97 <= _low <= 122 or 48 <= _low <= 57:
        _WORD_TABLE[_c] = _low
_IS_WORD = _WORD_TABLE > 0
_MUL = np.uint64(0x9E3779B97F4A7C15)

#: The only non-ASCII characters whose lower case holds an a-z letter
#: (KELVIN SIGN, LATIN CAPITAL I WITH DOT ABOVE), as UTF-8.
_FOLDS_TO_ASCII = (b"\xe2\x84\xaa", b"\xc4\xb0")


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer, so that low and high bits are both usable."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and the n + 1 offsets of the texts (NULL: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    raw = data.tobytes()
    if any(x in raw for x in _FOLDS_TO_ASCII):
        return _utf8(pa.array([t.lower() for t in texts.to_pylist()], pa.large_string()))
    return data, offsets - offsets[0]


_BLOCK = 1 << 18

_POWER_BASE = np.uint64(0x100000001B3)
_POWER_BACK = np.uint64(pow(0x100000001B3, -1, 1 << 64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i (mod 2 ** 64) for i < n, kept between calls."""
    have = _powers.__dict__.get("have")
    if have is None or len(have[0]) < n:
        size = 1 << max(16, n.bit_length())
        have = []
        for base in (_POWER_BASE, _POWER_BACK):
            p = np.full(size, base)
            p[0] = 1
            have.append(np.multiply.accumulate(p))
        _powers.have = have
    return have[0], have[1]


def _places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word and the byte behind it."""
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.take(_IS_WORD, data, out=inside[1:-1])
    starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    # a word that touches the next text's first byte is cut at the border
    edge = offsets[1:-1]
    edge = np.unique(edge[(edge > 0) & (edge < len(data))])
    edge = edge[inside[edge] & inside[edge + 1]]
    if len(edge):
        starts, ends = np.sort(np.append(starts, edge)), np.sort(np.append(ends, edge))
    return starts, ends


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, number of words before each text; n + 1 entries).

    The hash of a word is a difference of one running polynomial sum over a block
    of bytes, scaled back by the power at the word's start.
    """
    return _hashed(*_utf8(texts))[:2]


def words_and_pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``words``, and a hash each of the first and the last three letters of every word (0 for words of less than five), as two columns."""
    data, offsets = _utf8(texts)
    hashed, before, starts, ends = _hashed(data, offsets)
    out = np.zeros((len(starts), 2), np.uint64)
    long = ends - starts >= 5
    for column, at in enumerate((starts[long], ends[long] - 3)):
        code = np.full(len(at), np.uint64(column + 1))
        for j in range(3):
            code = (code << np.uint64(8)) | _WORD_TABLE[data[at + j]]
        out[long, column] = mix64(code)
    return hashed, before, out


def _hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash of each word, words before each text, first byte of each word, byte behind it)."""
    starts, ends = _places(data, offsets) if len(data) else (np.zeros(0, np.int64),) * 2
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), starts, ends
    hashed = np.empty(len(starts), np.uint64)
    # blocks of bounded size, however long a text is; a word belongs to the block it starts in
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(data), _BLOCK)), len(starts)))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        first, last = starts[a], ends[b - 1]
        power, back = _powers(int(last - first) + 1)
        total = np.empty(last - first + 1, np.uint64)
        total[0] = 0
        np.cumsum(_WORD_TABLE[data[first:last]] * power[: last - first], out=total[1:])
        hashed[a:b] = (total[ends[a:b] - first] - total[starts[a:b] - first]) * back[starts[a:b] - first]
    return mix64(hashed + (ends - starts).astype(np.uint64) * _MUL), np.searchsorted(starts, offsets), starts, ends


def shingle_sets(texts: pa.Array, k: int = 3, least_words: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, for at most 2 ** 20 texts at a time.

    Returns (values, bounds, n_words): the sorted distinct 40-bit shingles of text
    i are ``values[bounds[i]:bounds[i + 1]]``.  Texts with fewer than
    ``least_words`` words have none.
    """
    hashes, start = words(texts)
    n_words = np.diff(start)
    n = len(n_words)
    bits = max(1, int(n - 1).bit_length()) if n else 1
    if bits > 20:
        raise ValueError("too many texts in one batch")
    size = max(0, len(hashes) - k + 1)
    h = np.zeros(size, np.uint64)
    for j in range(k):
        h *= np.uint64(0xC2B2AE3D27D4EB4F)
        h += hashes[j : j + size]
    h = mix64(h)
    count = np.where(n_words >= max(least_words, k), n_words - k + 1, 0)
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64), n_words
    # positions at which a whole run of k words of a long enough text begins
    turn = np.zeros(len(hashes) + 1, np.int32)
    np.add.at(turn, start[:-1][count > 0], 1)
    np.add.at(turn, (start[:-1] + count)[count > 0], -1)
    h = h[np.cumsum(turn[:size]) > 0]
    # One sort of (text, hash): the text's number takes the top bits.
    packed = (np.repeat(np.arange(n, dtype=np.uint64), count) << np.uint64(40)) | (h >> np.uint64(24))
    packed.sort()
    keep = np.empty(total, bool)
    keep[0] = True
    np.not_equal(packed[1:], packed[:-1], out=keep[1:])
    packed = packed[keep]
    bounds = np.searchsorted(packed, np.arange(n + 1, dtype=np.uint64) << np.uint64(40))
    return packed & np.uint64((1 << 40) - 1), bounds, n_words
