"""Passages that occur in an earlier document, by prefix doubling on sampled positions.

Every byte that a string of `length` bytes covers is removed if that string also starts in a document with a smaller
id; matches do not cross documents and are judged on the input.

Prefix doubling ranks positions by their first 1, 2, 4 ... bytes, each round from a pair of ranks of the round before,
and drops positions whose rank is unique.  Sorting every position would move far more than the input, so ranks are kept
at sampled positions only, one at least inside every string of `length` bytes, chosen by the string's own bytes: equal
strings have theirs at the same place.

- Ranks of up to 32 bytes are fingerprints, doubled within a task.
- First round between documents: the ranks of each chunk of texts, sorted and packed by range, meet in buckets; back go
  bits that say which of them other chunks hold as well.  About two thirds are unique here and fall out.
- Last round, past the threshold: ranks that are left meet again, each with the bytes around its position, and pairs of
  rank and surrounding bytes tell all strings of `length` bytes over that position apart.  The least document of each
  string keeps it.

What meets is bounded.  Texts lie in chunks of `CHUNK` bytes (a longer text alone in one).  A chunk sends a rank once
in the first round.  In the last, of equal surroundings inside a chunk only those of its least document are sent; the
others are known to go.  So a passage that a third of all documents hold makes one row a chunk.  Buckets follow from
the size of the input.  Chunks are staged once and joined with what comes back.

NULL texts are empty.  Documents with NULL id are neither earlier nor later than others: nothing is removed from them,
nor because of them.  Rows with the same id are one document for this purpose, each with a row in the result; the order
of rows does not matter.  An empty table gives an empty result.  Only the two named columns are read.  Ranks and
surroundings are compared by 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tablemargin.llm.batches import BASE, mix
from tablemargin.sources.tables import stage

#: Bytes a repeated string has at least.
LENGTH = 50
#: Bytes a rank tells apart, and those that choose the sampled positions.
RANKED, CHOOSER = 32, 13
#: Bytes of text in a chunk.
CHUNK = 2 << 20
#: Ranks a bucket of the first round gets, about.
BUCKET = 1_000_000
#: Bits of a rank that the first round compares.
SHORT = np.uint64(16)

CHUNKS = "chunk long, ids array<long>, ends array<int>, n int, packed binary"
KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _pack(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=n, codec="zstd", asbytes=True), np.uint8) if n else np.empty(0, np.uint8)


def _planes(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane, compressed."""
    return _pack(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes())


def _values(data: bytes, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(_unpack(data, n * width).reshape(width, n).T).reshape(-1).view(kind)


def _joined(a: np.ndarray, b: np.ndarray, far: int) -> np.ndarray:
    """Fingerprints of strings from those of a string and of the one of `far` bytes that follows `far` bytes on."""
    out = a.copy()
    out[:-far] = a[:-far] * np.uint64(pow(BASE, far, 1 << 64)) + b[far:]
    return out


def sampled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Sampled positions in ascending order and the ranks of the bytes there.

    The position of a string follows from where its least CHOOSER-byte string stands, modulo the number of places that
    RANKED bytes can take in it.
    """
    places, span = length - RANKED + 1, length - CHOOSER + 1
    turn = np.zeros(len(data) + 1, np.int8)
    long = ends - starts >= length
    turn[starts[long]] += 1
    turn[ends[long] - length + 1] -= 1
    inside = np.cumsum(turn, dtype=np.int8)[:-1].astype(bool)
    at, ranks = [], []
    step = 1 << 17
    for begin in range(0, len(data), step):
        if not inside[begin:begin + step].any():
            continue
        part = data[begin:begin + step + 2 * length]
        h1 = part.astype(np.uint64) + np.uint64(1)
        h2 = _joined(h1, h1, 1)
        h4 = _joined(h2, h2, 2)
        h8 = _joined(h4, h4, 4)
        h16 = _joined(h8, h8, 8)
        chooser = h8.copy()
        chooser[:-8] = chooser[:-8] * np.uint64(pow(BASE, 5, 1 << 64)) + _tail(h4, h1)[8:]
        least = ((chooser * np.uint64(0xD6E8FEB86659FD93)) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(part), dtype=np.uint64)
        size = 1
        while size < span:
            by = min(size, span - size)
            least[:-by] = np.minimum(least[:-by], least[by:])
            size += by
        starting = np.flatnonzero(inside[begin:begin + step])
        found = (least[starting] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        found = starting + (found - starting) % places
        found = np.unique(found[np.append(True, found[1:] != found[:-1])])
        at.append(found + begin)
        ranks.append(mix(h16[found] * np.uint64(pow(BASE, 16, 1 << 64)) + h16[found + 16]))
    if not at:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at, first = np.unique(np.concatenate(at), return_index=True)
    return at, np.concatenate(ranks)[first]


def _tail(h4: np.ndarray, h1: np.ndarray) -> np.ndarray:
    """Fingerprints of five bytes."""
    out = h4.copy()
    out[:-4] = out[:-4] * np.uint64(BASE) + h1[4:]
    return out


class Chunk:
    """Texts of a chunk: all bytes, ends, ids (0 where NULL), and which texts take part."""

    def __init__(self, row: dict):
        self.number = row["chunk"]
        self.data = _unpack(row["packed"], row["n"])
        self.ends = np.array(row["ends"], np.int64)
        self.starts = np.concatenate(([0], self.ends[:-1]))
        self.null = np.array([i is None for i in row["ids"]], bool)
        self.ids = np.array([i or 0 for i in row["ids"]], np.int64)

    def sampled(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions, ranks and texts."""
        at, ranks = sampled(self.data, self.starts[~self.null], self.ends[~self.null], length)
        return at, ranks, np.searchsorted(self.ends, at, side="right")

    def around(self, at: np.ndarray, of: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes before (nearest first) and after the ranked ones as far as strings of `length` reach, and how many the text has."""
        reach = length - RANKED
        offset = np.arange(reach)
        before, after = np.minimum(at - self.starts[of], reach), np.minimum(self.ends[of] - at - RANKED, reach)
        left = np.where(offset < before[:, None], self.data[np.maximum(at[:, None] - 1 - offset, 0)], 0).astype(np.uint8)
        right = np.where(offset < after[:, None], self.data[np.minimum(at[:, None] + RANKED + offset, len(self.data) - 1)], 0).astype(np.uint8)
        return left, before.astype(np.uint8), right, after.astype(np.uint8)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}


def _buckets(short: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each 48-bit rank; ascending ranks have ascending buckets."""
    return ((short >> np.uint64(24)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _groups(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, from, to) of each run of equal keys."""
    cut = np.flatnonzero(np.diff(keys)) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(keys)]):
        if b > a:
            yield int(keys[a]), a, b


def chunks_of(documents: DataFrame, key: str, text: str) -> DataFrame:
    """The texts in chunks, staged."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, ends, parts, n = TaskContext.get().partitionId() << 32, [], [], [], 0

        def chunk() -> pa.RecordBatch:
            columns = [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int32())),
                       pa.array([n], pa.int32()), pa.array([_pack(b"".join(parts))], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "ends", "n", "packed"])

        for batch in batches:
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                value = value or b""
                if ids and n + len(value) > CHUNK:
                    yield chunk()
                    number, ids, ends, parts, n = number + 1, [], [], [], 0
                ids.append(i)
                parts.append(value)
                n += len(value)
                ends.append(n)
        if ids:
            yield chunk()

    return stage(documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(gather, CHUNKS), "repeat-chunks")


def _first_round(chunks: DataFrame, length: int, buckets: int) -> DataFrame:
    """(chunk, found): for each bucket bits of the chunk's distinct ranks, set where another chunk has the rank."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk(row)
            short = np.unique(chunk.sampled(length)[1] >> SHORT)
            out = [(b, chunk.number, hi - lo, _planes(np.diff(short[lo:hi], prepend=np.uint64(0))))
                   for b, lo, hi in _groups(_buckets(short, buckets))]
            yield pa.RecordBatch.from_pylist([dict(zip(("bucket", "chunk", "n", "ranks"), r)) for r in out], schema=sent)

    def meet(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        ranks = [np.cumsum(_values(r["ranks"], r["n"], np.uint64), dtype=np.uint64) for r in rows]
        ordered = np.sort(np.concatenate(ranks))
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        bits = [np.packbits(np.isin(x, twice, assume_unique=True)).tobytes() for x in ranks]
        return pa.table({"chunk": [r["chunk"] for r in rows], "bucket": [r["bucket"] for r in rows], "bits": bits},
                        schema=pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("bits", pa.binary())]))

    sent = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("ranks", pa.binary())])
    met = chunks.mapInArrow(send, "bucket int, chunk long, n int, ranks binary").groupBy("bucket").applyInArrow(
        meet, "chunk long, bucket int, bits binary")
    return met.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("found"))


def _whole(before: np.ndarray, after: np.ndarray, reach: int) -> np.ndarray:
    """Bit r is set where a string may begin r bytes before the ranked ones."""
    low, high = reach - np.minimum(after, reach).astype(np.int64), before.astype(np.int64)
    return np.where(high >= low, (np.int64(2) << high) - (np.int64(1) << np.minimum(low, high + 1)), 0)


def _surroundings(left: np.ndarray, right: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Fingerprints of the first r bytes before and after, for each r."""
    out = []
    for side in (left, right):
        h = [np.full(len(side), 7, np.uint64)]
        for k in range(side.shape[1]):
            h.append(h[-1] * np.uint64(BASE) + side[:, k].astype(np.uint64) + np.uint64(1))
        out.append(h)
    return out[0], out[1]


def _least(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least id among the rows with each row's key."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(np.minimum.reduceat(ids[order], first), np.diff(np.append(first, len(keys))))
    return out


def _same(ranks: np.ndarray, left: np.ndarray, before: np.ndarray, right: np.ndarray, after: np.ndarray) -> np.ndarray:
    """A fingerprint of the rank with all bytes around it."""
    lefts, rights = _surroundings(left, right)
    return mix(mix(ranks ^ lefts[-1]) * np.uint64(BASE) + rights[-1] + (before.astype(np.uint64) << np.uint64(8)) + after.astype(np.uint64))


def _last_round(chunks: DataFrame, met: DataFrame, length: int, buckets: int) -> DataFrame:
    """(chunk, gone): positions and bits of the strings over them that an earlier document has.

    Rows for the next round carry ranks with their surroundings; those with a bucket below 0 carry what is known already.
    """
    reach = length - RANKED

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk(row)
            at, ranks, of = chunk.sampled(length)
            if not len(at):
                continue
            short, inverse = np.unique(ranks >> SHORT, return_inverse=True)
            elsewhere = np.zeros(len(short), bool)
            bits = {f["bucket"]: f["bits"] for f in row["found"] or ()}
            for b, lo, hi in _groups(_buckets(short, buckets)):
                elsewhere[lo:hi] = np.unpackbits(np.frombuffer(bits[b], np.uint8), count=hi - lo).astype(bool)
            ids = chunk.ids[of]
            most, least = np.full(len(short), np.iinfo(np.int64).min), np.full(len(short), np.iinfo(np.int64).max)
            np.maximum.at(most, inverse, ids)
            np.minimum.at(least, inverse, ids)
            left_over = (elsewhere | (most != least))[inverse]
            at, ranks, of, ids = at[left_over], ranks[left_over], of[left_over], ids[left_over]
            if not len(at):
                continue
            around = chunk.around(at, of, length)
            go = ids > _least(_same(ranks, *around), ids)
            out = []
            if go.any():
                out.append((-1 - chunk.number % buckets, chunk.number, int(go.sum()), at[go].astype(np.uint32).tobytes(),
                            _whole(around[1][go], around[3][go], reach).astype(np.uint32).tobytes(), b"", b""))
            order = np.flatnonzero(~go)
            order = order[np.argsort(ranks[order], kind="stable")]
            at, ranks, ids = at[order], ranks[order], ids[order]
            around = np.hstack([around[0][order], around[1][order, None], around[2][order], around[3][order, None]])
            for b, lo, hi in _groups(_buckets(ranks >> SHORT, buckets)):
                out.append((b, chunk.number, hi - lo, at[lo:hi].astype(np.uint32).tobytes(), _planes(np.diff(ranks[lo:hi], prepend=np.uint64(0))),
                            _planes(ids[lo:hi]), _pack(around[lo:hi].tobytes())))
            yield pa.RecordBatch.from_pylist([dict(zip(sent.names, r)) for r in out], schema=sent)

    def meet(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        if rows[0]["bucket"] < 0:
            return pa.table({"chunk": [r["chunk"] for r in rows], "at": [r["at"] for r in rows], "bits": [r["ranks"] for r in rows]}, schema=back)
        sizes = [r["n"] for r in rows]
        ranks = np.concatenate([np.cumsum(_values(r["ranks"], r["n"], np.uint64), dtype=np.uint64) for r in rows])
        ids = np.concatenate([_values(r["ids"], r["n"], np.int64) for r in rows])
        around = np.concatenate([_unpack(r["around"], r["n"] * (2 * reach + 2)).reshape(r["n"], -1) for r in rows])
        left, before, right, after = around[:, :reach], around[:, reach], around[:, reach + 1:-1], around[:, -1]
        same = _same(ranks, left, before, right, after)
        gone = np.where(ids > _least(same, ids), _whole(before, after, reach), 0)
        # One row for each rank and surroundings; ranks with one of these only are settled.
        one, group = np.unique(same, return_index=True, return_inverse=True)[1:]
        by_rank = np.sort(ranks[one])
        several = by_rank[1:][by_rank[1:] == by_rank[:-1]]
        open_ = np.isin(ranks[one], several)
        rep = one[open_]
        if len(rep):
            least = _least(same, ids)[rep]
            lefts, rights = _surroundings(left[rep], right[rep])
            bits = np.zeros(len(rep), np.int64)
            for r in range(reach + 1):
                can = (before[rep] >= r) & (after[rep] >= reach - r)
                key = mix(mix(ranks[rep] ^ lefts[r]) * np.uint64(BASE) + rights[reach - r])
                if can.any():
                    bits[can] |= np.where(least[can] > _least(key[can], least[can]), np.int64(1) << r, 0)
            of_group = np.zeros(len(one), np.int64)
            of_group[open_] = bits
            gone |= of_group[group]
        at = np.concatenate([np.frombuffer(r["at"], np.uint32) for r in rows])
        out, begin = [], 0
        for r, n in zip(rows, sizes):
            hit = begin + np.flatnonzero(gone[begin:begin + n])
            if len(hit):
                out.append({"chunk": r["chunk"], "at": at[hit].tobytes(), "bits": gone[hit].astype(np.uint32).tobytes()})
            begin += n
        return pa.Table.from_pylist(out, schema=back)

    sent = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("at", pa.binary()), ("ranks", pa.binary()),
                      ("ids", pa.binary()), ("around", pa.binary())])
    back = pa.schema([("chunk", pa.int64()), ("at", pa.binary()), ("bits", pa.binary())])
    known = chunks.join(met, "chunk").mapInArrow(send, "bucket int, chunk long, n int, at binary, ranks binary, ids binary, around binary")
    told = known.groupBy("bucket").applyInArrow(meet, "chunk long, at binary, bits binary")
    return told.groupBy("chunk").agg(F.collect_list(F.struct("at", "bits")).alias("gone"))


def remove_repeats(documents: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and `kept`, the remaining bytes.

    `length` lies between 33 and 62.
    """
    if not RANKED < length <= RANKED + 30:
        raise ValueError(f"length must be from {RANKED + 1} to {RANKED + 30}")
    chunks = chunks_of(documents, key, text)
    size = chunks.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    buckets = min(1 << 24, max(1, -(-size * 2 // (length - RANKED + 2) // BUCKET)))
    gone = _last_round(chunks, _first_round(chunks, length, buckets), length, buckets)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk(row)
            turn = np.zeros(len(chunk.data) + 1, np.int32)
            for part in row["gone"] or ():
                at, bits = np.frombuffer(part["at"], np.uint32).astype(np.int64), np.frombuffer(part["bits"], np.uint32)
                for r in range(length - RANKED + 1):
                    begin = at[bits >> np.uint32(r) & np.uint32(1) == 1] - r
                    np.add.at(turn, begin, 1)
                    np.add.at(turn, begin + length, -1)
            stays = np.cumsum(turn)[:-1] == 0
            # A removed run begins at a removed byte after one that stays, or at a text's start.
            begins = ~stays
            begins[1:] &= stays[:-1]
            heads = chunk.starts[chunk.starts < chunk.ends]
            begins[heads] = ~stays[heads]
            removed = np.concatenate(([0], np.cumsum(~stays)))
            spans = np.concatenate(([0], np.cumsum(begins)))
            kept = [chunk.data[a:b][stays[a:b]].tobytes() for a, b in zip(chunk.starts, chunk.ends)]
            yield pa.RecordBatch.from_arrays([
                pa.array(row["ids"], pa.int64()), pa.array(chunk.ends - chunk.starts), pa.array(removed[chunk.ends] - removed[chunk.starts]),
                pa.array(spans[chunk.ends] - spans[chunk.starts]), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return chunks.join(gone, "chunk", "left").mapInArrow(cut, KEPT)


def digests(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """`remove_repeats` with a digest in place of the remaining bytes."""
    done = remove_repeats(documents, length)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
