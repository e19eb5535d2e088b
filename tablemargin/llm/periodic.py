"""Periodic runs of words, found word by word on the diagonals of a text against itself.

The diagonal of lag q holds the words that equal the word q places before.  A run of period q is a stretch of such
matches at least q long, together with the q words before it.  Texts are read once: every active diagonal counts its
match length on with each word; when a word breaks it, the diagonal ends, and emits its run there and then if it is
long enough.

The table of diagonals is sparse.  A diagonal can only emit a run if it matches max(q, least - q) words in a row, so it
is opened where the following words (half of `least` for small lags, else the power of two up to q) also stand q places
earlier and the words before the two places differ.  Places with equal following words are looked up by fingerprint,
each only against earlier ones less than twice that far; in a repetitive stretch neighbours share the word before, so
few are opened.  A diagonal whose lag is a multiple of an active one with the same beginning would emit the same stretch
with a period that is not the smallest, and is not opened.  Time is about n log n for the worst texts, memory a few
arrays a text; batches are cut at 4 MB of text, and a longer text stands alone.

NULL and empty texts, and texts without words, have no runs and collapse to the empty text.  Rows are independent, so
repeated rows, ties, empty tables and extra columns do not matter; the result columns replace input columns of their
name.  Words are compared by 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablemargin.llm.batches import BASE, Words, mix, slices
from tablemargin.llm.names import unused

#: Words a run has at least; it holds its period twice at least, too.
LEAST = 12
RESULT = "struct<runs:array<struct<start:long,length:long,period:long>>,collapsed:string>"


def _double(gram: np.ndarray, by: int) -> np.ndarray:
    """From fingerprints of runs of words those of runs `by` longer; what crosses the end of the array is meaningless."""
    out = gram.copy()
    if by < len(gram):
        out[:-by] = mix(gram[:-by] * np.uint64(BASE) + gram[by:])
    return out


def _births(at: np.ndarray, key: np.ndarray, left: np.ndarray, edge: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and lags in [low, high) of equal keys with different words before them; `at` ascends within a key.

    `edge` marks places with no word before them.
    """
    every = np.arange(len(at))
    other = np.append(True, key[1:] != key[:-1])
    group = np.maximum.accumulate(np.where(other, every, 0))
    other[1:] |= (left[1:] != left[:-1]) | edge[1:] | edge[:-1]
    block = np.maximum.accumulate(np.where(other, every, 0))
    late, early = every, block - 1
    while True:
        near = early >= group[late]
        near[near] = at[late[near]] - at[early[near]] < high
        late, early = late[near], early[near]
        if not len(late):
            return
        differ = edge[early] | (left[early] != left[late])
        lag = at[late] - at[early]
        born = differ & (lag >= low)
        yield at[late[born]], lag[born]
        # Of places that share the word before only the block's end matters.
        early = np.where(differ, early - 1, block[early] - 1)


def openings(hashes: np.ndarray, first: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Where diagonals open, and their lags, by place and lag; row r has the words `first[r]:first[r + 1]`."""
    size = max(1, -(-least // 2))
    low, high = 1, 2
    level, gram = 1, hashes
    while level * 2 <= size:
        gram, level = _double(gram, level), level * 2
    while high <= size:
        high *= 2
    count = np.diff(first)
    of = np.repeat(np.arange(len(count)), count)
    start, end = np.repeat(first[:-1], count), np.repeat(first[1:], count)
    place, word = np.arange(len(hashes)), hashes
    context = _double(gram, size - level) if size > level else gram
    places, lags = [], []
    while True:
        at = np.flatnonzero(place + size <= end)
        key = mix(context[at] ^ mix(of[at].astype(np.uint64) + np.uint64(1)))
        ordered = np.sort(key)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            break
        hit = twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key
        at, key = at[hit], key[hit]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        edge = place[at] == start[at]
        left = np.where(edge, np.uint64(0), word[np.maximum(at - 1, 0)])
        for a, lag in _births(place[at], key, left, edge, low, high):
            places.append(a)
            lags.append(lag)
        # Longer contexts can only repeat where shorter ones do, and a period is half a text at most.
        alive = np.zeros(len(count), dtype=bool)
        alive[of[at]] = True
        keep = alive[of] & (end - start >= 2 * high)
        while level < high:
            gram, level = _double(gram, level), level * 2
        word, of, start, end, place, gram = word[keep], of[keep], start[keep], end[keep], place[keep], gram[keep]
        low, high, size, context = high, 2 * high, high, gram
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place, lag = np.concatenate(places), np.concatenate(lags)
    order = np.lexsort((lag, place))
    return place[order], lag[order]


def follow(words: list[int], opened: list[tuple[int, int]], least: int = LEAST) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one text by start and period; `opened` has (place, lag) in ascending order."""
    runs: list[tuple[int, int, int]] = []
    active: dict[int, int] = {}

    def end(lag: int, at: int) -> None:
        begun = active.pop(lag)
        if at - begun >= lag and at - begun + lag >= least:
            runs.append((begun - lag, at - begun + lag, lag))

    i, k = opened[0][0], 0
    while i < len(words):
        while k < len(opened) and opened[k][0] == i:
            lag = opened[k][1]
            if not any(lag % q == 0 and begun - q == i - lag for q, begun in active.items()):
                active[lag] = i
            k += 1
        word = words[i]
        for lag in [q for q in active if words[i - q] != word]:
            end(lag, i)
        i += 1
        if not active:
            if k == len(opened):
                break
            i = opened[k][0]
    for lag in list(active):
        end(lag, len(words))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of(words: Words, least: int = LEAST) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of the rows that have any."""
    hashes = words.hashes()
    place, lag = openings(hashes, words.first, least)
    row = np.searchsorted(words.first, place, side="right") - 1
    cut = np.flatnonzero(np.diff(row)) + 1
    found = {}
    for a, b in zip([0, *cut], [*cut, len(row)]):
        if b > a:
            r = int(row[a])
            begin = words.first[r]
            runs = follow(hashes[begin:words.first[r + 1]].tolist(), list(zip((place[a:b] - begin).tolist(), lag[a:b].tolist())), least)
            if runs:
                found[r] = runs
    return found


def without(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def run_column(text: Column, least: int = LEAST) -> Column:
    """Struct of a text's runs and the text without their repetitions, words joined by one space."""
    @F.arrow_udf(RESULT)
    def find(texts: pa.Array) -> pa.Array:
        sizes, starts, lengths, periods, collapsed = [], [], [], [], []
        for part in slices(texts):
            words = Words(part, lower=False)
            found = runs_of(words, least)
            data, begin = words.raw.tobytes(), 0
            for r, end in enumerate(words.text_end.tolist()):
                runs = found.get(r, ())
                sizes.append(len(runs))
                for start, length, period in runs:
                    starts.append(start)
                    lengths.append(length)
                    periods.append(period)
                # Splits at the same six bytes as `Words`.
                split = data[begin:end - 1].split()
                collapsed.append(b" ".join(without(split, runs) if runs else split))
                begin = end
        runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (starts, lengths, periods)], names=["start", "length", "period"])
        listed = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), runs)
        return pa.StructArray.from_arrays([listed, pa.array(collapsed, pa.binary()).cast(pa.string())], names=["runs", "collapsed"])

    return find(text)


def collapse_runs(df: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """`df` with `runs` (start, length and period in words, by start, then period) and `collapsed`."""
    [found] = unused(df, "_found")
    done = df.withColumn(found, run_column(F.col(text), least))
    return done.withColumns({"runs": F.col(f"{found}.runs"), "collapsed": F.col(f"{found}.collapsed")}).drop(found)


def planted_tails(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) with the words of every tenth key's text replaced from some place on by a repeated passage.

    With h the crc32 of the key as text and g = floor(h / 10), texts with h % 10 = 0 keep the words before a = g % n;
    then the first p = 1 + floor((n - a) / (3 + g % 8)) words from there on repeat to the old length.  Other texts,
    those of NULL keys and those without words stay as they are.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    words = F.array_remove(F.split(F.col(text), r"[\x20\x09-\x0D]+"), "")
    # No function with a lambda: the planner does not take a Python function's argument that holds one.
    docs = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.floor(h / 10).alias("g"),
                            F.when(h % 10 == 0, words).alias("words")).withColumn("n", F.size("words"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    docs = docs.withColumn("p", (F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    rewritten = F.array_join(F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), F.lit(1), F.col("n")), " ")
    return docs.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(rewritten).alias("text"))


def digests(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the number of runs, its longest run, and digests of all runs and of the collapsed text."""
    found = collapse_runs(planted_tails(documents, key, text)).drop("text")
    line = F.transform("runs", lambda r: F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"), F.floor(F.col("longest.length") * 1000 / -F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
