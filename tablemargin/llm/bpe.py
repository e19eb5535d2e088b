"""Byte-pair encoding and decoding with forced boundaries.

A byte pair that occurs inside no vocabulary token can never be joined by a merge, so a cut between those two bytes
is certain.  Every piece of the pre-tokenizer is split at such pairs first; the fragments are encoded independently
and their ids concatenated, which gives the ids of the whole piece.  A space between two characters that are not
white space starts a new piece too, so a text is first cut into words there.  A bounded cache answers words that came
before; the new ones of a slice of texts are cut into fragments and merged together, a merge of every fragment in each
round, as arrays.

Encoding follows a byte-level BPE file of the `tokenizers` library (no normalizer, the usual contraction-and-space
pattern); an added token that occurs in a text gets its own id.  NULL and empty texts have no ids and decode to the
empty text.  Rows are independent: repeated rows, ties and extra columns do not matter; an output column replaces an
input column of the same name.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the pre-tokenizer pattern that byte-level BPE files of this kind imply. White space is the Unicode
# property, as in the library, not the wider class of Python's own \s.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
          r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

# Entries a worker keeps of each cache; twice as many live at most (an old and a young generation).
CACHED = 500_000
# Longer words are not kept, which bounds the caches in bytes, too.
LONGEST_KEPT = 40
# Characters of text whose new words are merged together; a merge's arrays take about a hundred bytes for each new one.
SLICE = 2 << 20
# Longer fragments are merged with a heap instead of repeated scans.
SCAN_BELOW = 48
# Above every rule.
NO_MERGE = 1 << 62
# Stands for words beside which a cut is uncertain; every other word has ids.
LOOSE = b""


def read_tokenizer(path: str) -> dict:
    """What encoding needs of a byte-level BPE file: token bytes by id, merges in order, added tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    if model["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel":
        raise ValueError(f"{path} is not a plain byte-level BPE file")
    shown = _printable_bytes()
    byte_of = {char: byte for byte, char in shown.items()}
    vocab: list[bytes] = [b""] * (max(model["vocab"].values()) + 1)
    for text, token_id in model["vocab"].items():
        vocab[token_id] = bytes(byte_of[c] for c in text) if all(c in byte_of for c in text) else text.encode()
    ids = model["vocab"]
    merges = []
    for merge in model["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        merges.append((ids[left], ids[right], ids[left + right]))
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    for content, token_id in added.items():
        vocab.extend([b""] * (token_id + 1 - len(vocab)))
        vocab[token_id] = content.encode()
    return {"vocab": vocab, "merges": merges, "added": added, "byte_ids": [ids[shown[b]] for b in range(256)],
            "prefix_space": bool(spec["pre_tokenizer"].get("add_prefix_space"))}


def _printable_bytes() -> dict[int, str]:
    """The visible character that stands for each byte in such a file: itself where printable, else from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Cache(dict):
    """A dictionary that forgets its older half instead of growing without bound."""

    def __init__(self, make: Callable, most: int | None = None):
        super().__init__()
        self.make, self.old, self.most = make, {}, most

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(key) <= LONGEST_KEPT:
            self.make_room(1)
            self[key] = value

    def make_room(self, entries: int) -> None:
        if len(self) + entries > (self.most or CACHED):
            self.old = dict(self)
            self.clear()


def _loose(word: str) -> bool:
    """Whether a cut beside `word` is uncertain. (Python's white space is wider than the tokenizer's; that does no harm.)"""
    return not word or word[0].isspace() or word[-1].isspace()


class Encoder:
    """`spec` is that of `read_tokenizer`; `cached` and `slice` in it take the place of CACHED and SLICE."""

    def __init__(self, spec: dict):
        self.slice = spec.get("slice") or SLICE
        self.vocab = spec["vocab"]
        self.byte_ids = spec["byte_ids"]
        self.vocab_array = pa.array(self.vocab, pa.large_binary())
        self.added = spec["added"]
        self.prefix_space = spec["prefix_space"]
        # By left id, then right id: rank of the merge and id it makes as one integer, ordered by rank
        none: dict[int, int] = {}
        self.rules = [none] * len(self.vocab)
        for rank, (left, right, made) in enumerate(spec["merges"]):
            if self.rules[left] is none:
                self.rules[left] = {}
            self.rules[left].setdefault(right, rank << 32 | made)
        seen = np.zeros(65536, dtype=bool)
        for token in self.vocab:
            for a, b in zip(token, token[1:]):
                seen[a << 8 | b] = True
        #: Pairs of bytes with a certain cut between them.
        self.forced = {(a, b) for a in range(256) for b in range(256) if not seen[a << 8 | b]}
        #: The same as arrays: rank and id made of byte pairs, and of pairs of ids in ascending order.
        self.byte_array = np.array(self.byte_ids, np.int64)
        self.uncut = seen
        pairs = sorted((left << 32 | right, found) for left, rights in enumerate(self.rules) for right, found in rights.items())
        self.pair_keys = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.pair_rules = np.array([r for _, r in pairs] or [NO_MERGE], np.int64)
        self.byte_rules = self._rule_array(np.repeat(self.byte_array, 256), np.tile(self.byte_array, 256))
        self.pieces = regex.compile(PIECES)
        self.specials = regex.compile("|".join(regex.escape(a) for a in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.fragments = _Cache(self._merge, spec.get("cached"))
        self.words = _Cache(self._word, spec.get("cached"))
        self.marks = {m: self._pieces(m) for m in ".,;:!?"}

    def _rule_array(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and id made of each pair, NO_MERGE where none fits."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_rules[at], NO_MERGE)

    def merge_together(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of many pieces: cut at forced boundaries, then in each round every fragment's best merge."""
        data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        piece = np.repeat(np.arange(len(pieces)), lengths)
        pair = data[:-1] << 8 | data[1:]
        cut = np.append(True, (piece[1:] != piece[:-1]) | ~self.uncut[pair])
        ids, fragment = self.byte_array[data], np.cumsum(cut) - 1
        rules = np.append(np.where(cut[1:], NO_MERGE, self.byte_rules[pair]), NO_MERGE)
        done_ids, done_pieces, done_at, at = [], [], [], np.arange(len(data))
        while len(ids):
            head = np.append(True, fragment[1:] != fragment[:-1])
            best = np.minimum.reduceat(rules, np.flatnonzero(head))[np.cumsum(head) - 1]
            going = best != NO_MERGE
            if not going.all():
                rest = ~going
                done_ids.append(ids[rest])
                done_pieces.append(piece[rest])
                done_at.append(at[rest])
                ids, fragment, rules, piece, at, best = (x[going] for x in (ids, fragment, rules, piece, at, best))
                if not len(ids):
                    break
            hit = np.flatnonzero(rules == best)
            hit = hit[np.append(True, fragment[hit[1:]] != fragment[hit[:-1]])]
            ids[hit] = rules[hit] & 0xFFFFFFFF
            # The pair after the merged one, and the pair before it.
            after = np.minimum(hit + 2, len(ids) - 1)
            more = (hit + 2 < len(ids)) & (fragment[after] == fragment[hit])
            rules[hit] = np.where(more, self._rule_array(ids[hit], ids[after]), NO_MERGE)
            inner = hit[(hit > 0) & (fragment[np.maximum(hit - 1, 0)] == fragment[hit])]
            rules[inner - 1] = self._rule_array(ids[inner - 1], ids[inner])
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            ids, fragment, rules, piece, at = (x[keep] for x in (ids, fragment, rules, piece, at))
        order = np.argsort(np.concatenate(done_at)) if done_at else np.empty(0, np.int64)
        packed = np.concatenate([np.empty(0, np.int64), *done_ids])[order].astype(np.int32).tobytes()
        sizes = np.bincount(np.concatenate(done_pieces), minlength=len(pieces)) if done_pieces else np.zeros(len(pieces), np.int64)
        ends = (np.cumsum(sizes) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, texts: list[str]) -> None:
        """Put the words in `texts` that are not known yet into the cache, their pieces merged together."""
        words, new = self.words, set()
        for text in texts:
            new.update(text.split(" "))
        new.difference_update(words)
        own, pieces, counts = [], [], []
        for word in new:
            if len(word) > LONGEST_KEPT or _loose(word):
                continue
            if not word.isalpha():
                if word[-1] in self.marks and word[:-1].isalpha():
                    # Letters, then one mark: the first piece is known, or is learnt here.
                    word = word[:-1]
                    if word in new or word in words:
                        continue
                else:
                    parts = [p.encode("utf-8", "surrogatepass") for p in self.pieces.findall(" " + word)]
                    own.append(word)
                    pieces += parts
                    counts.append(len(parts))
                    continue
            own.append(word)
            pieces.append(b" " + word.encode())
            counts.append(1)
        if not own:
            return
        words.make_room(len(own))
        merged, at = self.merge_together(pieces), 0
        for word, count in zip(own, counts):
            words[word] = merged[at] if count == 1 else b"".join(merged[at:at + count])
            at += count

    def cuts(self, piece: bytes) -> list[int]:
        """Offsets at which `piece` is certainly cut."""
        forced, pairs = self.forced, zip(piece, piece[1:])
        return [] if forced.isdisjoint(pairs) else [i for i, pair in enumerate(zip(piece, piece[1:]), 1) if pair in forced]

    def _word(self, word: str) -> bytes:
        """Packed ids of a word with the space before it; LOOSE if white space touches a space there."""
        if word.isalpha():
            return self._piece(b" " + word.encode())
        if _loose(word):
            return LOOSE
        mark = self.marks.get(word[-1])
        if mark and word[:-1].isalpha():
            # Letters, then one mark: two pieces, of which the first is likely known.
            return self.words[word[:-1]] + mark
        return self._pieces(" " + word)

    def _pieces(self, text: str) -> bytes:
        return b"".join([self._piece(p.encode("utf-8", "surrogatepass")) for p in self.pieces.findall(text)])

    def _piece(self, piece: bytes) -> bytes:
        cuts = self.cuts(piece)
        if not cuts:
            return self._merge(piece)
        fragments = self.fragments
        return b"".join([fragments[piece[a:b]] for a, b in zip([0, *cuts], [*cuts, len(piece)])])

    def _merge(self, fragment: bytes) -> bytes:
        ids = [self.byte_ids[b] for b in fragment]
        ids = self._scan(ids) if len(ids) < SCAN_BELOW else self._heap(ids)
        return array("i", ids).tobytes()

    def _scan(self, ids: list[int]) -> list[int]:
        """Apply the lowest-ranked merge, leftmost first, until none fits."""
        rules = self.rules
        found = [rules[a].get(b, NO_MERGE) for a, b in zip(ids, ids[1:])]
        while found and (best := min(found)) != NO_MERGE:
            i = found.index(best)
            made = ids[i] = best & 0xFFFFFFFF
            del ids[i + 1], found[i]
            if i:
                found[i - 1] = rules[ids[i - 1]].get(made, NO_MERGE)
            if i < len(found):
                found[i] = rules[made].get(ids[i + 1], NO_MERGE)
        return ids

    def _heap(self, ids: list[int]) -> list[int]:
        """The same in n log n: candidate merges in a heap over a linked list of symbols."""
        rules, n = self.rules, len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(f, i, ids[i], ids[i + 1]) for i in range(n - 1) if (f := rules[ids[i]].get(ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            f, i, left, right = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] != left or ids[j] != right:
                continue
            made = f & 0xFFFFFFFF
            ids[i], ids[j] = made, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (f := rules[made].get(ids[k])) is not None:
                    heapq.heappush(heap, (f, i, made, ids[k]))
            h = before[i]
            if h >= 0 and (f := rules[ids[h]].get(made)) is not None:
                heapq.heappush(heap, (f, h, ids[h], made))
        return [x for x in ids if x >= 0]

    def _ordinary(self, text: str) -> bytes:
        if self.prefix_space and text and not text[0].isspace():
            text = " " + text
        first, *rest = text.split(" ")
        words = self.words
        ids = list(map(words.get, rest))
        if None in ids:
            ids = [words[w] if x is None else x for w, x in zip(rest, ids)]
        if LOOSE in ids or (rest and _loose(first)):
            return self._pieces(text)
        return b"".join([self._pieces(first), *ids])

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text."""
        if not text:
            return np.empty(0, dtype=np.int32)
        if self.specials is None or not self.specials.search(text):
            return np.frombuffer(self._ordinary(text), dtype=np.int32)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [self._ordinary(text[at:m.start()]), np.int32(self.added[m.group()]).tobytes()]
            at = m.end()
        return np.frombuffer(b"".join([*out, self._ordinary(text[at:])]), dtype=np.int32)

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """`encode` of each text, new words of about `slice` characters together."""
        out, begin, size = [], 0, 0
        for end, text in enumerate(texts, 1):
            size += len(text or "")
            if size >= self.slice or end == len(texts):
                part = texts[begin:end]
                self.learn([t for t in part if t])
                out += map(self.encode, part)
                begin, size = end, 0
        return out

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of lists of ids, laid end to end, with the lists' offsets."""
        taken = self.vocab_array.take(pa.array(ids))
        begin = taken.offset
        ends = np.frombuffer(taken.buffers()[1], np.int64)[begin:begin + len(taken) + 1]
        data = np.frombuffer(taken.buffers()[2], np.uint8)[ends[0]:ends[-1]] if len(ids) else np.empty(0, np.uint8)
        bounds = ends[offsets] - ends[0] if len(ids) else np.zeros(len(offsets), np.int64)
        whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])
        starts = bounds[:-1][bounds[:-1] < len(data)]
        if not (data[starts] >> 6 == 2).any():
            try:
                # Valid as a whole, and no text begins inside a character: valid text by text.
                return whole.cast(pa.large_string()).cast(pa.string())
            except pa.ArrowInvalid:
                pass
        return pa.array([v.decode("utf-8", "replace") for v in whole.to_pylist()], pa.string())

    def decode(self, ids: list[int]) -> str:
        """Text of ids; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.vocab.__getitem__, ids)).decode("utf-8", "replace")


_BROADCAST: dict = {}


def _encoder(spec) -> Encoder:
    """One encoder for each worker process and broadcast tokenizer."""
    if spec.value is not _BROADCAST.get("spec"):
        _BROADCAST.clear()
        _BROADCAST.update(spec=spec.value, encoder=Encoder(spec.value))
    return _BROADCAST["encoder"]


@lru_cache(maxsize=4)
def _shared(context, path: str, cached: int | None = None, slice_chars: int | None = None):
    """One broadcast for all columns of a tokenizer, so that a worker builds one encoder for encoding and decoding."""
    return context.broadcast(read_tokenizer(path) | {"cached": cached, "slice": slice_chars})


class BpeTokenizer:
    """Columns that encode and decode with the tokenizer file at `path`.

    The driver reads the file and broadcasts vocabulary and merges: their size is that of the tokenizer (one entry
    for each id), whatever the data.  `cached` and `slice_chars` (by default CACHED and SLICE) bound what a worker
    holds: less of both takes less memory and more time, and gives the same ids.
    """

    def __init__(self, spark, path: str, cached: int | None = None, slice_chars: int | None = None):
        spec = _shared(spark.sparkContext, path, cached, slice_chars)

        @F.arrow_udf("array<int>")
        def encode(texts: pa.Array) -> pa.Array:
            encoder = _encoder(spec)
            ids = encoder.encode_all(texts.to_pylist())
            offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            values = np.concatenate([np.empty(0, np.int32), *ids])
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))

        @F.arrow_udf("string")
        def decode(ids: pa.Array) -> pa.Array:
            encoder = _encoder(spec)
            lengths = np.array([len(x) if x.is_valid else 0 for x in ids], np.int64) if ids.null_count else np.diff(ids.offsets.to_numpy())
            return encoder.decode_all(ids.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(lengths))))

        self.encode: Callable[[Column | str], Column] = encode
        self.decode: Callable[[Column | str], Column] = decode


def encode_texts(df: DataFrame, path: str, text: str = "text", ids: str = "token_ids", **bounds: int) -> DataFrame:
    """`df` with the token ids of each whole text; NULL texts have an empty list.  `bounds` as in `BpeTokenizer`."""
    return df.withColumn(ids, BpeTokenizer(df.sparkSession, path, **bounds).encode(F.col(text)))


def decode_ids(df: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded_text", **bounds: int) -> DataFrame:
    """`df` with the text of each list of ids, special tokens included; with the `bounds` of the encoding they share an encoder."""
    return df.withColumn(text, BpeTokenizer(df.sparkSession, path, **bounds).decode(F.col(ids)))


def digest_columns(ids: str = "token_ids", text: str = "decoded_text") -> list[Column]:
    """Number of ids, SHA-256 of the decimal ids joined by commas, and of the decoded text."""
    joined = F.concat_ws(",", F.col(ids).cast("array<string>"))
    return [F.size(ids).cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
            F.sha2(F.col(text).cast("binary"), 256).alias("decoded_sha256")]


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the digests of its ids and of what they decode to."""
    return decode_ids(encode_texts(df.select(key, text), path, text), path).select(key, *digest_columns())
