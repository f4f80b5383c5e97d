"""Token ids of whole texts by a public byte-level BPE vocabulary, in batches.

The vocabulary's own pattern never lets a token span the place where white space follows
other characters, so a text is cut there and each distinct piece of a batch is encoded
once. Distinct pieces are found by hash, put together into one text, encoded in one call
and cut apart by the tokens' lengths; ids of all texts are then gathered by array
operations.
"""

import base64

import numpy as np

from tillcast.llm import text

_rng = np.random.Generator(np.random.PCG64(50257))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPECIAL = b"<|endoftext|>"
_loaded = {}


class Encoder:
    """``vocabulary`` names the tokenizer's file; the file of its ranks lies beside it."""

    def __init__(self, vocabulary, ranks, pattern):
        import tiktoken

        found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
        self._fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=found, special_tokens={})
        self._lengths = np.zeros(max(found.values()) + 1, dtype=np.int64)
        for token, number in found.items():
            self._lengths[number] = len(token)
        self._file, self._slow = vocabulary, None

    @classmethod
    def load(cls, name="byte_bpe_50k"):
        if name not in _loaded:
            import public_tokenizers

            _loaded[name] = cls(public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"),
                                public_tokenizers.PATTERN)
        return _loaded[name]

    def exact(self, content):
        """Ids of one text by the tokenizer itself, which also knows its special tokens."""
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self._file)
        return self._slow.encode(content, add_special_tokens=False).ids

    def encode(self, data, offsets):
        """Ids (uint32) of all texts in a buffer, and the run of each text (n + 1)."""
        data = np.ascontiguousarray(data)
        raw = data.tobytes()
        starts = _piece_starts(data, offsets)
        stops = np.append(starts[1:], len(data))
        hashes = _hashes(data, starts, stops)
        _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        pool, sizes = self._pieces(raw, data, starts[first], stops[first])
        place = np.cumsum(sizes) - sizes
        many = sizes[inverse]
        ends = np.cumsum(many)
        ids = pool[np.repeat(place[inverse] - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)]
        # pieces of a text are consecutive
        begin = np.concatenate([[0], ends])[np.searchsorted(starts, offsets)]
        if _SPECIAL in raw:
            parts = []
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                own = raw[a:b]
                parts.append(np.array(self.exact(own.decode()), dtype=np.uint32) if _SPECIAL in own
                             else ids[begin[i]:begin[i + 1]])
            begin = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
            ids = np.concatenate(parts)
        return ids, begin

    def _pieces(self, raw, data, starts, stops):
        """Ids of distinct pieces one after another, and how many each has."""
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        # a piece that opens or closes a text may lack the white space that sets it apart
        joins = text.SPACE[data[starts]] & ~_space_before(data, stops)
        own = [None] * len(starts)
        at = np.flatnonzero(joins)
        content = b"".join([raw[a:b] for a, b in zip(starts[at].tolist(), stops[at].tolist())])
        together = np.array(self._fast.encode_ordinary(content.decode()), dtype=np.uint32)
        ends = np.cumsum(self._lengths[together])
        cuts = np.searchsorted(ends, np.cumsum(stops[at] - starts[at]), side="left") + 1
        sizes = np.zeros(len(starts), dtype=np.int64)
        sizes[at] = np.diff(np.concatenate([[0], cuts]))
        if joins.all():
            return together, sizes
        for i in np.flatnonzero(~joins).tolist():
            own[i] = self._fast.encode_ordinary(raw[starts[i]:stops[i]].decode())
            sizes[i] = len(own[i])
        pool = np.zeros(int(sizes.sum()), dtype=np.uint32)
        place = np.cumsum(sizes) - sizes
        begin = np.cumsum(sizes[at]) - sizes[at]
        pool[np.repeat(place[at] - begin, sizes[at]) + np.arange(len(together))] = together
        for i in np.flatnonzero(~joins).tolist():
            pool[place[i]:place[i] + sizes[i]] = own[i]
        return pool, sizes


def _space_before(data, at):
    """Whether white space, also beyond ASCII, stands before each place (never before place 0)."""
    one = data[np.maximum(at - 1, 0)]
    two, three = data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    wide = ((two == 0xC2) & ((one == 0xA0) | (one == 0x85))) | (
        (three >= 0xE1) & (three <= 0xE3) & ((two == 0x9A) | (two == 0x80) | (two == 0x81)))
    return text.SPACE[one] | wide


def _piece_starts(data, offsets):
    space = text.SPACE[data]
    space[1:] &= ~space[:-1]
    at = np.flatnonzero(space)
    at = at[(at > 0) & ~_space_before(data, at)]
    return np.union1d(at, offsets[:-1][offsets[:-1] < offsets[1:]]).astype(np.int64)


def _hashes(data, starts, stops):
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(stops, starts[i] + text.BLOCK, side="right")))
        a, b = int(starts[i]), int(stops[j - 1])
        up, down = text._powers(b - a)
        sums = np.empty(b - a + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[data[a:b]] * up[:b - a], out=sums[1:])
        begin = starts[i:j] - a
        out[i:j] = text.mix((sums[stops[i:j] - a] - sums[begin]) * down[begin])
        i = j
    return out
