"""Whole texts as arrays of word hashes, without a Python object per word.

A batch of texts is one byte buffer with offsets, as Arrow holds it. Word hashes are
differences of prefix sums over the buffer, so their cost is a few array operations per
byte, for any length of text. Work goes through the buffer in blocks that end between
words, which bounds memory even for one very long text.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20  # bytes of text hashed at once

_rng = np.random.Generator(np.random.PCG64(20240229))
_LETTER = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER[65:91] = _LETTER[97:123]  # A-Z hash as a-z
#: Letters for words that are compared as they are.
EXACT = np.random.Generator(np.random.PCG64(20240301)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = {}

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of words set off by white space only.
PLAIN = ~SPACE
#: Bytes of words set off by white space or ASCII punctuation: letters, digits, non-ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x):
    """A bijective 64-bit finaliser on an array of uint64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n):
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if _POWERS.get("n", 0) < n:
        n = max(n, BLOCK * 2)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            out = np.full(n, base, dtype=np.uint64)
            out[0] = 1
            _POWERS[name] = np.multiply.accumulate(out)
        _POWERS["n"] = n
    return _POWERS["up"], _POWERS["down"]


def buffers(column):
    """The bytes and the offsets (n + 1, from 0) of an Arrow column of texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None and data.size \
        else np.zeros(0, dtype=np.uint8)
    return data, offsets - offsets[0]


def blocks(data, offsets, word, size=BLOCK):
    """Cut the buffer into [a, b) that end between words; a longer word is not cut."""
    a, n = 0, len(data)
    while a < n:
        b = min(a + size, n)
        step = 4096
        while b < n:
            ahead = data[b:b + step]
            stop = np.flatnonzero(~word[ahead])
            limit = offsets[np.searchsorted(offsets, b)]
            found = b + stop[0] if len(stop) else n + 1
            if min(found, limit) <= b + len(ahead):
                b = int(min(found, limit))
                break
            b, step = b + len(ahead), step * 2
        yield a, b
        a = b


def words(data, offsets, word=PLAIN, spans=False, prefixes=(), letters=_LETTER):
    """Hashes of all words and the text each lies in, in order of the buffer.

    With ``spans`` also the byte where each word starts and ends. For each length in
    ``prefixes``, also the hash of the word's first bytes (0 where the word is shorter).
    ``letters`` gives each byte its number: A-Z as a-z, or ``EXACT``.
    """
    hashes, docs, starts, ends = [], [], [], []
    heads = [[] for _ in prefixes]
    opens = np.zeros(0, dtype=bool)
    for a, b in blocks(data, offsets, word):
        part = data[a:b]
        inside = word[part]
        first = np.zeros(b - a + 1, dtype=bool)
        own = offsets[np.searchsorted(offsets, a):np.searchsorted(offsets, b, side="right")] - a
        first[own] = True
        opens = inside.copy()
        opens[1:] &= ~inside[:-1] | first[1:-1]
        begin = np.flatnonzero(opens)
        if not len(begin):
            continue
        closes = inside.copy()
        closes[:-1] &= ~inside[1:] | first[1:-1]
        end = np.flatnonzero(closes) + 1
        up, down = _powers(b - a)
        sums = np.empty(b - a + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(letters[part] * up[:b - a], out=sums[1:])
        low, back = sums[begin], down[begin]
        hashes.append(mix((sums[end] - low) * back))
        docs.append((np.searchsorted(offsets, begin + a, side="right") - 1).astype(np.int32))
        if spans:
            starts.append(begin + a)
            ends.append(end + a)
        for out, length in zip(heads, prefixes):
            stop = begin + length
            fits = stop <= end
            out.append(np.where(fits, mix((sums[np.where(fits, stop, end)] - low) * back + np.uint64(length)), 0))
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
    out = [join(hashes, np.uint64), join(docs, np.int32)]
    if spans:
        out += [join(starts, np.int64), join(ends, np.int64)]
    if prefixes:
        out.append([join(h, np.uint64) for h in heads])
    return tuple(out)


def word_hash(text, word=PLAIN):
    """The hashes of the words of one Python string."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    return words(raw, np.array([0, len(raw)]), word)[0]


def shingles(hashes, docs, k):
    """Hashes of k consecutive words and the text of each; a shorter text gives its whole sequence.

    Returned in order of the text; the first word's index is given as well.
    """
    n = len(hashes)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
    total = np.zeros(n, dtype=np.uint64)
    odd = [np.uint64(((2 * i + 3) * 0xD6E8FEB86659FD93) & ((1 << 64) - 1) | 1) for i in range(k)]
    whole = np.ones(n, dtype=bool)
    for i in range(k):
        same = np.zeros(n, dtype=bool)
        shifted = np.zeros(n, dtype=np.uint64)
        if i < n:
            same[:n - i] = docs[i:] == docs[:n - i]
            shifted[:n - i] = hashes[i:]
        total += np.where(same, shifted, np.uint64(0)) * odd[i]
        whole &= same
    begins = np.ones(n, dtype=bool)
    begins[1:] = docs[1:] != docs[:-1]
    at = np.flatnonzero(whole | (begins & ~whole))
    # only the first word of a short text opens a shingle that is not whole
    return mix(total[at] + np.uint64(k)), docs[at], at


def runs(docs, n):
    """Start of each text's run in a sorted array of text numbers, n + 1 entries."""
    return np.searchsorted(docs, np.arange(n + 1))
