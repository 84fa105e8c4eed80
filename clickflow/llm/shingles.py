"""Word shingles as 64-bit hashes, in numpy over many texts at a time.

Words are runs of bytes outside space and \\x09-\\x0D after lower-casing A-Z. A shingle is
``WIDTH`` words that follow each other; a text with fewer words is one shingle."""

from __future__ import annotations

import numpy as np

WIDTH = 5
_U = np.uint64
_ODD = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)
#: Masks of the first 0 to 8 bytes of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
#: Bytes from which a word is hashed by the library instead of in steps of eight.
_LONG_WORD = 64


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective mix of 64-bit numbers (splitmix64), by ``salt``."""
    x = x + _U((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def hashed_lines(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and per line its number of words, its text and
    its number within the text."""
    import xxhash

    low = _LOWER[np.frombuffer(b"\n".join([b"", *texts]) + b"\n" * 8, dtype=np.uint8)]
    space = _SPACE[low]
    cuts = np.flatnonzero(space[1:] != space[:-1]) + 1  # words begin and end in turn
    starts, length = cuts[0::2], cuts[1::2] - cuts[0::2]
    # eight bytes at a time: words of up to eight bytes have no collisions among their length
    eight = np.ndarray(len(low) - 7, dtype="<u8", buffer=low, strides=(1,))
    h = mixed((length.astype(np.uint64) * _ODD[0]) ^ (eight[starts] & _FIRST[np.minimum(length, 8)]), 6)
    k, at = 8, np.flatnonzero(length > 8)
    while len(at) and k < _LONG_WORD:
        h[at] = mixed(h[at] ^ (eight[starts[at] + k] & _FIRST[np.minimum(length[at] - k, 8)]), 6)
        k += 8
        at = at[length[at] > k]
    for i in at:
        h[i] = xxhash.xxh3_64_intdigest(low[starts[i]:starts[i] + length[i]])
    lines = np.flatnonzero(low[:-8] == 10)  # one before each line
    sizes = np.diff(np.r_[np.searchsorted(starts, lines), len(starts)])
    per_text = np.array([t.count(b"\n") + 1 for t in texts], dtype=np.int64)
    of = np.repeat(np.arange(len(texts)), per_text)
    number = np.arange(len(of)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    return h, sizes, of, number


def hashed_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and the number of words of each text."""
    words, sizes, of, _ = hashed_lines(texts)
    total = np.zeros(len(texts), dtype=np.int64)
    np.add.at(total, of, sizes)
    return words, total


def shingle_sets(w: np.ndarray, sizes: np.ndarray, rank=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each group of words, given the hashes of all words and the words of
    each group: (hashes, the group of each hash, sizes). The hashes stand group by group,
    in order within a group; ``rank`` (a function of the hashes, 16 bits) goes
    before the value."""
    sizes = np.asarray(sizes, dtype=np.int64)
    total = int(sizes.sum())
    of = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    length = np.repeat(sizes, sizes)
    at = np.flatnonzero(place + WIDTH <= length)
    h = np.zeros(max(0, total - WIDTH + 1), dtype=np.uint64)
    for k in range(WIDTH):
        h += w[k:k + len(h)] * _ODD[k]
    h = h[at]
    short_at = np.flatnonzero((length < WIDTH) & (place == 0))
    s = mixed(length[short_at].astype(np.uint64), 5)
    for k in range(WIDTH - 1):
        inside = length[short_at] > k
        s[inside] += w[short_at[inside] + k] * _ODD[k]
    values = mixed(np.r_[h, s], 7)
    owner = np.r_[of[at], of[short_at]]
    order = _order(values, owner, len(sizes), rank)
    values, owner = values[order], owner[order]
    if len(values):
        keep = np.r_[True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])]
        values, owner = values[keep], owner[keep]
    return values, owner, np.bincount(owner, minlength=len(sizes)).astype(np.int64)


def _order(values: np.ndarray, owner: np.ndarray, n: int, rank) -> np.ndarray:
    """Order by (owner, rank, value): one sort of all in 64 bits, or three where that loses bits."""
    bits = max(1, int(n).bit_length())
    key = owner.astype(np.uint64) << _U(64 - bits)
    ranks = None if rank is None else rank(values).astype(np.uint64)
    if ranks is not None and bits + 16 < 64:
        key |= ranks << _U(48 - bits)
        key |= values >> _U(bits + 16)
    else:
        key |= values >> _U(bits)
    order = np.argsort(key)
    key, in_order = key[order], values[order]
    if np.any((key[1:] == key[:-1]) & (in_order[1:] != in_order[:-1])):
        return np.lexsort((values, owner) if ranks is None else (values, ranks, owner))
    return order


def fingerprints(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit fingerprints of each group's set (sums of mixed members); the
    groups stand in order."""
    ends = np.searchsorted(owner, np.arange(n + 1))
    out = []
    for salt in (11, 12):
        run = np.r_[np.zeros(1, dtype=np.uint64), np.cumsum(mixed(values, salt))]
        out.append((run[ends[1:]] - run[ends[:-1]]).view(np.int64))
    return out[0], out[1]


def portions(items, weight, limit: int = 1 << 19):
    """Runs of ``items`` (texts, by characters) whose weights add up to about ``limit``."""
    held, size = [], 0
    for x in items:
        held.append(x)
        size += weight(x)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def pieces(texts: list[bytes], limit: int = 1 << 20):
    """(text, number of its first line, bytes) of each text, cut at line ends into pieces of
    about ``limit`` bytes; a longer line stays whole."""
    for i, t in enumerate(texts):
        at, line = 0, 0
        while True:
            end = t.find(b"\n", at + limit) if len(t) - at > limit else -1
            yield i, line, t[at:] if end < 0 else t[at:end]
            if end < 0:
                break
            line += t.count(b"\n", at, end) + 1
            at = end + 1
