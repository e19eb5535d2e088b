"""Near-duplicate groups by SetSketch registers.

A document's set are its distinct runs of `SHINGLE` words. Its sketch has `REGISTERS` registers: for each one every
element has an exponentially distributed hash, and the register keeps the smallest, on an exponentially spaced scale
and truncated to 16 bits. Registers of a union are the maxima of the registers, and two registers agree about as often
as the sets overlap.

1. Documents with equal sets are one class; everything below works on classes.
2. Bands of `BAND` registers: classes that agree in a whole band share a bucket. Two sets with a Jaccard similarity of
   0.8 share none of the 40 buckets with a probability of about 1e-9.
3. First round: in every bucket the class that sits in the fullest buckets is the hub, and each other member is a
   candidate with the hub. So a bucket of n classes gives n - 1 candidates. Candidates are estimated from their
   registers (likelihood of the joint registers given both set sizes), and confirmed on the full sets if the estimate
   is not far below the threshold (4.5 standard deviations). Confirmed links give components.
4. Second round: in buckets that still hold several components every member outside the largest one is compared with
   all members of other components, in blocks of `BLOCK` by `BLOCK` sketches, and becomes a candidate with the one of each
   block that it most resembles. This joins what can be joined, by few pairs a member.
5. Third round: the same blocks, but now all pairs that pass the estimate count, each in the first bucket that it
   shares. Only the members of such pairs leave a block. Their full sets come to the block, which confirms all its pairs
   and hands out links that join components: at most one for each member, however many pairs it confirmed or refused.

In the first two rounds pairs to confirm are dealt to blocks of about `TOGETHER` by `TOGETHER` sets, and a set goes once
to each block that has a pair of it. So a link can only be lost to the two error bounds above, however large a bucket
is, and no bucket's pairs are all written out.

Defined results: a NULL text, or one without words, has an empty set and is linked with nothing. With fewer words than
a shingle the whole sequence is the one element. The representative of a component is its smallest key; rows without
key belong to components like others but represent none, unless all rows of one lack a key. Repeated rows have equal
sets and thus one component. Extra columns stay; output columns replace columns of that name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablemargin.llm.batches import Words, distinct_by_row, slices
from tablemargin.llm.components import roots_of_others
from tablemargin.session import scratch_path, scratch_scope
from tablemargin.sources.tables import stage, write_table

REGISTERS, BAND = 160, 4
#: Base of the register scale, and the rate that places it.
BASE, RATE = 1.001, 20.0
BLOCK = 256
#: Keys of the documents to confirm go to every executor up to this number (8 bytes each); beyond it texts are shuffled.
BROADCAST_KEYS = 1_000_000
#: Pairs to confirm are dealt to blocks of about so many sets on either side.
TOGETHER = 64
DEVIATIONS = 4.5
RESULTS = ["n_shingles", "component_id", "kept"]

MULTIPLIERS = np.random.default_rng(20).integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingle fingerprints of each text."""
    out = []
    for part in slices(texts, 1 << 20):
        words = Words(part)
        out += distinct_by_row(*words.shingles(shingle), words.rows)
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of non-empty sets, one row each."""
    values = np.concatenate(sets)
    begin = np.cumsum([0, *map(len, sets[:-1])])
    least = np.empty((len(sets), REGISTERS), np.uint64)
    for i, m in enumerate(MULTIPLIERS):
        least[:, i] = np.minimum.reduceat(values * m, begin)
    exponential = -np.log1p(-((least >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53)
    return np.clip(np.floor(1 - np.log(exponential / RATE) / math.log(BASE)), 0, 65535).astype(np.uint16)


def likely(floor: float, larger: np.ndarray, smaller: np.ndarray, equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether the most likely Jaccard similarity is `floor` at least.

    Given are in how many registers a is larger, smaller and equal, and both set sizes. The likelihood has one maximum,
    so its slope at `floor` tells on which side of it that lies.
    """
    u = n_a / (n_a + n_b)
    v = 1 - u
    shrink, log_b = (BASE - 1) / BASE, math.log(BASE)

    def p(x: np.ndarray) -> np.ndarray:
        return np.maximum(-np.log1p(-x * shrink) / log_b, 1e-12)

    def slope(x: np.ndarray) -> np.ndarray:
        return shrink / (log_b * (1 - x * shrink))

    x, y = np.maximum(u - v * floor, 0), np.maximum(v - u * floor, 0)
    rest = np.maximum(1 - p(x) - p(y), 1e-12)
    up = equal * (v * slope(x) + u * slope(y)) / rest - larger * v * slope(x) / p(x) - smaller * u * slope(y) / p(y) > 0
    return up & (np.minimum(u / v, v / u) >= floor)


def floor_of(threshold: float) -> float:
    """Estimates from here on are confirmed on the full sets."""
    return threshold - DEVIATIONS * math.sqrt(threshold * (1 - threshold) / REGISTERS)


def sketches(df: DataFrame, text: str, shingle: int) -> DataFrame:
    """`df` with _n (set size), _class (fingerprint of the set, NULL if empty) and _sketch."""
    @F.arrow_udf("struct<n:long,class:long,sketch:binary>")
    def sketch(texts: pa.Array) -> pa.Array:
        sizes, classes, out = [], [], []
        for part in slices(texts, 1 << 20):
            words = Words(part)
            sets = distinct_by_row(*words.shingles(shingle), words.rows)
            full = [s for s in sets if len(s)]
            rows = iter(registers(full)) if full else iter(())
            for s in sets:
                sizes.append(len(s))
                classes.append(_class_of(s))
                out.append(next(rows).tobytes() if len(s) else None)
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.array(out, pa.binary())],
                                          names=["n", "class", "sketch"])

    done = df.withColumn("_s", sketch(F.col(text)))
    return done.withColumns({"_n": F.col("_s.n"), "_class": F.col("_s.class"), "_sketch": F.col("_s.sketch")}).drop("_s")


def _class_of(values: np.ndarray) -> int | None:
    if not len(values):
        return None
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """A key for each band of each sketch (rows of registers): the band's registers and its number, mixed."""
    grid = np.ascontiguousarray(sketch).view(np.uint64)
    number = np.arange(1, grid.shape[-1] + 1, dtype=np.uint64)
    keys = (grid * np.uint64(0x9E3779B97F4A7C15)) ^ (number * np.uint64(0xD6E8FEB86659FD93))
    keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (keys ^ (keys >> np.uint64(32))).view(np.int64)


@F.arrow_udf(T.ArrayType(T.LongType()))
def _buckets(sketch: pa.Array) -> pa.Array:
    keys = band_keys(np.frombuffer(b"".join(sketch.to_pylist()), np.uint16).reshape(len(sketch), -1))
    offsets = np.arange(len(sketch) + 1, dtype=np.int32) * keys.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))


def _likely(threshold: float, *columns: str) -> Column:
    floor = floor_of(threshold)

    @F.arrow_udf(T.BooleanType())
    def tell(a: pa.Array, b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
        return _likely_pairs(floor, a, b, n_a, n_b)

    return tell(*columns)


def _likely_pairs(floor: float, a: pa.Array, b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
    x = np.frombuffer(b"".join(a.to_pylist()), np.uint16).reshape(len(a), -1)
    y = np.frombuffer(b"".join(b.to_pylist()), np.uint16).reshape(len(b), -1)
    larger, smaller = (x > y).sum(1), (x < y).sum(1)
    return pa.array(likely(floor, larger, smaller, x.shape[1] - larger - smaller, n_a.to_numpy().astype(float), n_b.to_numpy().astype(float)))


def _near_size(threshold: float) -> Column:
    """Two sets can only be that similar if their sizes are."""
    return F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * threshold


def _hub_candidates(members: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b): each bucket's members with the bucket's hub, estimated."""
    hubs = members.groupBy("class").agg(F.sum("size").alias("fullness"))
    hub = members.join(hubs, "class").groupBy("bucket").agg(F.max(F.struct("fullness", "class")).alias("hub"))
    pairs = (members.join(hub.select("bucket", F.col("hub.class").alias("hub")), "bucket").filter(F.col("class") != F.col("hub"))
             .select(F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b")).distinct())
    sized = (pairs.join(classes.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a")), "a")
             .join(classes.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b")), "b")
             .filter(_near_size(threshold)))
    return sized.filter(_likely(threshold, "s_a", "s_b", "n_a", "n_b")).select("a", "b")


def _full_sets(needed: DataFrame, classes: DataFrame, documents: DataFrame, key: str, text: str, shingle: int) -> tuple[DataFrame, int]:
    """(class, set) of the classes in `needed`, where they may repeat, and the number of classes.

    Nothing is made distinct before a semi-join, which does not ask how often a class or key occurs.
    """
    keys = stage(classes.select("class", "key").join(needed, "class", "left_semi").select("key"), "neardup-keys")
    n_keys = keys.count()
    if n_keys <= BROADCAST_KEYS:
        keys = F.broadcast(keys)

    @F.arrow_udf("struct<class:long,set:binary>")
    def full_set(texts: pa.Array) -> pa.Array:
        sets = shingle_sets(texts, shingle)
        return pa.StructArray.from_arrays([pa.array([_class_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                          names=["class", "set"])

    # A key may have several texts: the set's own fingerprint says which one is meant.
    texts = (documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
             .join(keys, F.col("_key").eqNullSafe(F.col("key")), "left_semi"))
    sets = texts.select(full_set("_text").alias("s")).select("s.class", "s.set").join(needed, "class", "left_semi").dropDuplicates(["class"])
    return stage(sets, "neardup-sets"), n_keys


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _confirm(pairs: DataFrame, classes: DataFrame, documents: DataFrame, key: str, text: str, shingle: int,
             threshold: float) -> DataFrame:
    """The pairs (a, b) whose full sets are at least that similar."""
    needed = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class")))
    sets, n_keys = _full_sets(needed, classes, documents, key, text, shingle)

    # A set goes once to each block of pairs that needs it, not once to each pair.
    blocks = F.lit(-(-n_keys // TOGETHER) or 1)
    placed = pairs.select("a", "b", F.pmod(F.xxhash64("a"), blocks).alias("i"), F.pmod(F.xxhash64("b"), blocks).alias("j"))
    sent = placed.select("i", "j", F.col("a").alias("class")).unionByName(placed.select("i", "j", F.col("b").alias("class"))).distinct()
    rows = (sent.join(sets, "class").select("i", "j", "class", F.lit(None).cast("long").alias("other"), "set")
            .unionByName(placed.select("i", "j", F.col("a").alias("class"), F.col("b").alias("other"), F.lit(None).cast("binary").alias("set"))))
    percent = round(100 * threshold)

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each block the sets, then the pairs."""
        block, known = None, {}
        for batch in batches:
            found = []
            for i, j, one, other, values in zip(*(column.to_pylist() for column in batch.columns)):
                if block != (i, j):
                    block, known = (i, j), {}
                if values is not None:
                    known[one] = np.frombuffer(values, np.uint64)
                    continue
                if _alike(known[one], known[other], percent):
                    found.append((one, other))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return rows.repartition("i", "j").sortWithinPartitions("i", "j", "other").mapInArrow(similar, "a long, b long")


def _blocks(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, i, j, class, root, probe): the pairs of blocks of buckets that hold several components."""
    placed = members.join(roots.select(F.col("node").alias("class"), "root"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    parts = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    # In a bucket of two both were compared in the first round.
    open_ = (parts.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("parts"), F.sum("n").alias("size"))
             .filter("parts > 1 and size > 2"))
    inside = placed.drop("size").join(open_.select("bucket", F.col("most.root").alias("main"), F.col("most.n").alias("n_main"), "size"), "bucket")
    inside = (inside.withColumn("blocks", F.ceil(F.col("size") / BLOCK)).withColumn("out_blocks", F.ceil((F.col("size") - F.col("n_main")) / BLOCK))
              .withColumn("outside", F.col("root") != F.col("main")))
    own = F.pmod(F.xxhash64("class", "bucket"), F.col("blocks"))
    own_out = F.pmod(F.xxhash64("class", "bucket", F.lit(1)), F.col("out_blocks"))
    base = inside.select("bucket", "class", "root", own.alias("i"), own_out.alias("j"), "blocks", "out_blocks", "outside")
    dealt = base.select("bucket", "class", "root", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("out_blocks") - 1)).alias("j"),
                        F.lit(False).alias("probe"))
    probes = base.filter("outside").select("bucket", "class", "root", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("i"), "j",
                                           F.lit(True).alias("probe"))
    return dealt.unionByName(probes)


def _candidates(pdf: pd.DataFrame, threshold: float, best: bool = False) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(from, to, member, others): of whole block pairs each probe with the members of other components that it may be linked with.

    All are row numbers, the first two those of the block pair. With `best` only the most similar other one counts.
    """
    grid = np.frombuffer(b"".join(pdf["sketch"]), np.uint16).reshape(len(pdf), -1)
    bands, (n, root, probe) = grid.view(np.uint64), (pdf[c].to_numpy() for c in ("n", "root", "probe"))
    probe, least = probe.astype(bool), floor_of(threshold)
    for (bucket, _, _), lo, hi in _pairs_of_blocks(pdf):
        others = lo + np.flatnonzero(~probe[lo:hi])
        for one in (lo + np.flatnonzero(probe[lo:hi]) if len(others) else ()):
            able = others[(root[others] != root[one]) & (np.minimum(n[others], n[one]) >= threshold * np.maximum(n[others], n[one]))]
            equal = (grid[one] == grid[able]).sum(1)
            # Far below what the estimate asks for, so only the plainly different are left out early.
            enough = equal >= (threshold - 0.3) * REGISTERS
            able, equal = able[enough], equal[enough]
            if not len(able):
                continue
            # Only in the first bucket that both share.
            first = (bands[able] == bands[one]).argmax(axis=1)
            here = band_keys(grid[one])[first] == bucket
            able, equal = able[here], equal[here]
            larger = (grid[one] > grid[able]).sum(1)
            near = likely(least, larger, REGISTERS - equal - larger, equal, np.full(len(able), float(n[one])), n[able].astype(float))
            able, equal = able[near], equal[near]
            if best and len(able):
                able = able[[np.argmax(equal)]]
            if len(able):
                yield lo, hi, one, able


def _by_blocks(rows: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """`work` on whole block pairs. They have at most 2 * BLOCK rows, and most have a few, so that they are streamed."""
    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in frames:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            last = max((lo for _, lo, _ in _pairs_of_blocks(pdf)), default=0)
            # The next frame may go on with the last pair of blocks.
            rest = pdf.iloc[last:]
            if last:
                yield work(pdf.iloc[:last])
        if rest is not None and len(rest):
            yield work(rest)

    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInPandas(stream, schema)


def _best_candidates(blocks: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b): each outside member with its most similar one of another component in each block, estimated."""
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf["class"].to_numpy()
        pairs = np.array([(ids[one], ids[able[0]]) for _, _, one, able in _candidates(pdf, threshold, best=True)], dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)})

    return _by_blocks(blocks.join(classes.select("class", "n", "sketch"), "class"), compare, "a long, b long").distinct()


def _members_of_candidates(blocks: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The rows of `blocks` that are in a pair of different components that passes the estimate."""
    columns = blocks.columns

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        found = np.zeros(len(pdf), bool)
        for _, _, one, able in _candidates(pdf, threshold):
            found[one] = True
            found[able] = True
        return pdf.loc[found, columns]

    rows = blocks.join(classes.select("class", "n", "sketch"), "class")
    return _by_blocks(rows, compare, "bucket long, i long, j long, class long, root long, probe boolean").select(columns)


def _links_of_blocks(blocks: DataFrame, classes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b): confirmed links that join all components that a block pair of `blocks` can join."""
    percent = round(100 * threshold)

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, root, values = (pdf[c].to_numpy() for c in ("class", "root", "set"))
        out, block, parent = [], None, {}

        def find(x: int) -> int:
            while (above := parent.get(x, x)) != x:
                parent[x] = parent.get(above, above)
                x = above
            return x

        for lo, hi, one, able in _candidates(pdf, threshold):
            if block != lo:
                block, parent, known = lo, {}, {}
            for k in (one, *able):
                if k not in known:
                    known[k] = np.frombuffer(values[k], np.uint64)
            for other in able:
                a, b = find(root[one]), find(root[other])
                # Joined already: one more link would change no component.
                if a != b and _alike(known[one], known[other], percent):
                    parent[b] = a
                    out.append((ids[one], ids[other]))
        pairs = np.array(out, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)})

    rows = blocks.join(classes.select("class", "n", "sketch"), "class").join(sets, "class")
    return _by_blocks(rows, link, "a long, b long").distinct()


def _pairs_of_blocks(pdf: pd.DataFrame) -> Iterator[tuple[tuple, int, int]]:
    """(bucket, i, j), from and to of each run of rows."""
    keys = pdf[["bucket", "i", "j"]].to_numpy(np.int64)
    cut = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
    for lo, hi in zip([0, *cut], [*cut, len(keys)]):
        if hi > lo:
            yield tuple(keys[lo].tolist()), lo, hi


def near_duplicates(documents: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 4,
                    threshold: float = 0.8, keep_text: bool = True, root: str | None = None) -> DataFrame:
    """`documents` (without text unless `keep_text`) with n_shingles, component_id and kept.

    `root` names a further column that tells components apart where they have no key; NULL for texts without words.
    """
    own = [c for c in documents.columns if c not in RESULTS and (keep_text or c != text)]
    drawn = sketches(documents, text, shingle).select(*dict.fromkeys([*own, key]), "_n", "_class", "_sketch")
    drawn = stage(drawn, "neardup-sketches")
    classes = stage(drawn.filter("_class is not null").groupBy(F.col("_class").alias("class")).agg(
        F.min(key).alias("key"), F.min("_n").alias("n"), F.min("_sketch").alias("sketch")), "neardup-classes")
    # The rounds leave their links only: what they staged may be longer than the documents.
    path = scratch_path(documents.sparkSession, "neardup-roots")
    with scratch_scope(documents.sparkSession):
        buckets = classes.select("class", F.explode(_buckets("sketch")).alias("bucket"))
        shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
        members = stage(buckets.join(shared, "bucket"), "neardup-members")

        # Roots are left out as nodes: what is no node is its own root.
        pairs = stage(_hub_candidates(members, classes, threshold), "neardup-pairs")
        roots = roots_of_others(_confirm(pairs, classes, documents, key, text, shingle, threshold))

        tree = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        pairs = stage(_best_candidates(_blocks(members, roots), classes, threshold), "neardup-pairs")
        links = _confirm(pairs, classes, documents, key, text, shingle, threshold)
        roots = roots_of_others(tree.unionByName(links))

        tree = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        blocks = stage(_members_of_candidates(_blocks(members, roots), classes, threshold), "neardup-blocks")
        sets, _ = _full_sets(blocks.select("class"), classes, documents, key, text, shingle)
        links = _links_of_blocks(blocks, classes, sets, threshold)
        write_table(roots_of_others(tree.unionByName(links)), path)
    joined = documents.sparkSession.read.schema("node long, root long").parquet(path)

    # The smallest key of a component; classes without links are their own.
    rooted = classes.select("class", "key").join(joined.withColumnRenamed("node", "class"), "class", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "class"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("key").alias("_component")), "root").select(F.col("class").alias("_class"), "_component", F.col("root").alias("_root"))
    result = drawn.join(named, "_class", "left")
    component = F.when(F.col("_class").isNull(), F.col(key)).otherwise(F.col("_component"))
    return result.select(*own, F.col("_n").alias("n_shingles"), component.alias("component_id"),
                         F.coalesce(F.col(key) == component, F.lit(False)).alias("kept"), *([F.col("_root").alias(root)] if root else []))
