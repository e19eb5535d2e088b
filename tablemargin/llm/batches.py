"""Words of many texts at once, as arrays: what the numeric operators share.

A word is a longest run of bytes outside 0x20 and 0x09-0x0D. Every function works on one Arrow batch, a bounded number
of rows that Spark has dealt to the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

# Odd multiplier of the byte-wise polynomial and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of a common 64-bit mixer: spreads the bits of each value."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of a batch of texts: `data` holds all bytes, each text followed by a line feed.

    `start` and `end` are the words' offsets in `data`; `of` is the row of each word; words of row r are
    `first[r]:first[r + 1]`. NULL texts have no words.
    """

    def __init__(self, texts: pa.Array, lower: bool = True):
        values = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts.to_pylist()]
        self.rows = len(values)
        raw = np.frombuffer(b"\n".join([*values, b""]), dtype=np.uint8)
        self.text_end = np.cumsum(np.fromiter((len(v) + 1 for v in values), np.int64, len(values)))
        self.raw = raw
        self.data = LOWER[raw] if lower else raw
        space = SPACE[raw]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        self.of = np.searchsorted(self.text_end, self.start, side="right")
        self.first = np.searchsorted(self.of, np.arange(self.rows + 1))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit fingerprint of each word, the same in every process."""
        if not len(self):
            return np.empty(0, np.uint64)
        width = int((self.end - self.start).max())
        n = len(self.data)
        # Blocks keep the powers few and the temporary arrays in cache.
        out = np.empty(len(self), np.uint64)
        block = max(1 << 16, 2 * width)
        power = _powers(BASE, block + width + 2)
        inverse = _powers(INVERSE, block + width + 2)
        at = 0
        while at < len(self):
            lo = self.start[at]
            upto = max(at + 1, int(np.searchsorted(self.start, lo + block)))
            hi = self.end[upto - 1]
            piece = self.data[lo:hi].astype(np.uint64) + np.uint64(1)
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(piece * power[:hi - lo], out=sums[1:])
            a, b = self.start[at:upto] - lo, self.end[at:upto] - lo
            out[at:upto] = (sums[b] - sums[a]) * inverse[a]
            at = upto
        return mix(out ^ (self.end - self.start).astype(np.uint64))

    def shingles(self, size: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of each row's runs of `size` words (a shorter row: its whole sequence), and their rows."""
        h = self.hashes() if hashes is None else hashes
        n = len(h)
        count = np.diff(self.first)
        run = h.copy()
        for k in range(1, size):
            follow = np.zeros(n, np.uint64)
            follow[:max(0, n - k)] = h[k:]
            inside = np.arange(n) + k < self.first[1:][self.of]
            run = np.where(inside, mix(run * np.uint64(BASE) + follow + np.uint64(k)), run)
        place = np.arange(n) - self.first[:-1][self.of]
        keep = place < np.maximum(count - size + 1, 1)[self.of]
        return run[keep], self.of[keep]


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(n, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        _POWERS[base] = have[:1 << 18]
    return have


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Set the session's Arrow batches to a few MB: its workers hold several copies of one."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark


def distinct_by_row(values: np.ndarray, rows: np.ndarray, n_rows: int) -> list[np.ndarray]:
    """Each row's distinct values in ascending order; `rows` ascends."""
    at = np.searchsorted(rows, np.arange(n_rows + 1))
    out = []
    for a, b in zip(at, at[1:]):
        ordered = np.sort(values[a:b])
        out.append(ordered[np.append(True, ordered[1:] != ordered[:-1])] if b > a else ordered)
    return out


def slices(texts: pa.Array, most_bytes: int = 4 << 20) -> Iterator[pa.Array]:
    """The batch in runs of about `most_bytes` of text (a longer text stands alone), so that arrays stay small."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(size, dtype=np.int64) // most_bytes
    cut = np.flatnonzero(np.diff(run)) + 1
    for a, b in zip([0, *cut], [*cut, len(texts)]):
        if b > a:
            yield texts.slice(a, b - a)
