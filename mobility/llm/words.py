"""Words of many texts at once, as NumPy arrays.

A word is a run of bytes other than space and ``\\x09-\\x0D`` (of UTF-8, so the
same runs as of characters). A piece of texts is one byte buffer; words are
places in it, and equal words have equal 64-bit hashes.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa

from mobility.llm.common import binary_values

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_RNG = np.random.default_rng(12_013)
#: A random odd factor and a random value of each byte: fixed, so hashes of a
#: word are equal in all tasks.
_STEP = np.uint64(int(_RNG.integers(1, 1 << 62)) * 2 + 1)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each value."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


#: Bytes that are hashed in one go; a longer word goes in several.
_BLOCK = 1 << 17
_UP = _powers(_STEP, _BLOCK)
_DOWN = _powers(np.uint64(pow(int(_STEP), -1, 1 << 64)), _BLOCK)


class Words:
    """The words of the texts of a string column, or of a list of UTF-8 texts (null: no words).

    ``buffer``: the texts' bytes, each text followed by a space; ``start`` and
    ``size``: each word's bytes; ``first``: each text's first word, and the end;
    ``text_of``: each word's text.
    """

    def __init__(self, column: pa.Array | list[bytes | None]):
        texts = [t or b"" for t in (column if isinstance(column, list) else binary_values(column))]
        self.buffer = b" ".join(texts) + b" "
        self.raw = np.frombuffer(self.buffer, dtype=np.uint8)
        text_ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
        space = _SPACE[self.raw]
        before = np.concatenate([[True], space[:-1]])
        self.start = np.flatnonzero(before & ~space)
        self.size = np.flatnonzero(~before & space) - self.start
        self.first = np.concatenate([[0], np.searchsorted(self.start, text_ends)])
        self.text_of = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: of its bytes' values times rising powers, and its size."""
        out = np.zeros(len(self.start), dtype=np.uint64)
        ends = self.start + self.size
        a = 0
        while a < len(out):
            low = int(self.start[a])
            b = int(np.searchsorted(ends, low + _BLOCK, side="right"))
            if b == a:  # one word longer than a block
                value, power = 0, 1
                for at in range(low, int(ends[a]), _BLOCK):
                    part = _BYTE[self.raw[at: min(at + _BLOCK, int(ends[a]))]]
                    value += power * int((part * _UP[: len(part)]).sum(dtype=np.uint64))
                    power = power * pow(int(_STEP), _BLOCK, 1 << 64) % (1 << 64)
                out[a] = value % (1 << 64)
                a += 1
                continue
            # sums from the block's first byte on; what stands before a word is taken off, and its power
            part = _BYTE[self.raw[low: int(ends[b - 1])]]
            part *= _UP[: len(part)]
            sums = np.empty(len(part) + 1, dtype=np.uint64)
            sums[0] = 0
            np.cumsum(part, out=sums[1:])
            first = self.start[a:b] - low
            out[a:b] = (sums[ends[a:b] - low] - sums[first]) * _DOWN[first]
            a = b
        return mix(out + self.size.astype(np.uint64))

    def distinct(self) -> tuple[list[bytes], np.ndarray]:
        """(the different words, each word's place among them)"""
        import pandas as pd

        if not len(self):
            return [], np.zeros(0, dtype=np.int64)
        code, _ = pd.factorize(self.hashes().view(np.int64))
        first = np.full(int(code.max()) + 1, len(self), dtype=np.int64)
        np.minimum.at(first, code, np.arange(len(self)))
        buffer = self.buffer
        return [buffer[a: a + n] for a, n in zip(self.start[first].tolist(), self.size[first].tolist(), strict=True)], code

    def joined(self, text: int, keep: np.ndarray | None = None) -> bytes:
        """The words of a text (those of ``keep``, a flag a word) joined by one space."""
        a, b = int(self.first[text]), int(self.first[text + 1])
        if a == b:
            return b""
        whole = self.buffer[int(self.start[a]): int(self.start[b - 1] + self.size[b - 1])]
        words = whole.split()
        if keep is not None:
            words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
        return b" ".join(words)
