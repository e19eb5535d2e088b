"""Benchmark decontamination by a prefix-filtered set join, in columns only.

A window is a run of `WINDOW` words of a benchmark item (a shorter item is one window). The shingles of a window (runs
of three words) are ordered by how often they occur in the corpus. For exact containment a document must hold every
shingle of a window, so one shingle is a sufficient prefix: the rarest. Documents are joined on it alone; the place it
was found at must leave room for the window on both sides (positional and length bounds), and the words there are then
compared with the window's.

Windows and their prefixes are written once. If that table is at most `broadcast_bytes` long it goes to every executor
and documents are not shuffled; beyond it the join is by shuffle on shingle hashes, with candidates verified in a
second join. Both give the same rows.

Defined results: NULL or empty texts have no words, so they are never hit and no item without words has a window. A
benchmark row without item_id cannot be listed, but its windows count as hits. Repeated rows of an item are one item;
repeated documents are judged one by one. Extra columns stay; output columns replace columns of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablemargin.llm.urlfilter import LOWER, UPPER
from tablemargin.sources.tables import input_bytes, scratch_path, stage, write_table

WINDOW, SHINGLE = 10, 3
BROADCAST_BYTES = 64 << 20
#: Everything that is not part of a word, after lower-casing A-Z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RESULTS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), lambda w: w != "")


def shingle_keys(words: Column, size: int) -> Column:
    """Hash of the run of `size` words at each place; the last places have shorter runs."""
    return F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, size)]))


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(win, len, items): the distinct windows, their number of words, and the items that have them."""
    items = benchmark.select(F.col(item).alias("item"), words_of(F.col(text)).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(1)))
    return (items.select("item", F.explode(F.transform(starts, lambda i: F.slice(F.col("words"), i, WINDOW))).alias("win"))
            .groupBy("win").agg(F.collect_set("item").alias("items"))
            .withColumn("len", F.size("win")))


def prefixes(wins: DataFrame, documents: DataFrame, words: str = "_words") -> DataFrame:
    """(key, size, offset, win, len, items): each window under its rarest shingle in the corpus."""
    size = F.least(F.col("len"), F.lit(SHINGLE))
    placed = wins.withColumn("size", size).select(
        "win", "len", "items", "size", F.posexplode(F.slice(_sized_keys(F.col("win"), size), F.lit(1), F.col("len") - size + 1)).alias("offset", "key"))
    placed = stage(placed, "benchmark-shingles")
    sizes = [r["size"] for r in placed.select("size").distinct().collect()]
    wanted = stage(placed.select("key", "size").distinct(), "benchmark-keys")
    seen = _exploded(documents.select(words), sizes, words).join(wanted, ["key", "size"]).groupBy("key", "size").count()
    ranked = placed.join(seen, ["key", "size"], "left").fillna(0, ["count"])
    whole = ranked.groupBy("win").agg(
        F.min(F.struct(F.col("count"), F.col("offset"), "key", "size", "len", "items")).alias("best"))
    # A window with a shingle that the corpus lacks is in no text.
    return (whole.filter("best.count > 0")
            .select("best.key", "best.size", "best.offset", "win", "best.len", "best.items"))


def _sized_keys(words: Column, size: Column) -> Column:
    """Shingle hashes of the size a window has, at most SHINGLE words."""
    keys = shingle_keys(words, SHINGLE)
    for k in range(SHINGLE - 1, 0, -1):
        keys = F.when(size == k, shingle_keys(words, k)).otherwise(keys)
    return keys


def _exploded(documents: DataFrame, sizes: list[int], words: str) -> DataFrame:
    """A row for each place in a text and each shingle size in use."""
    keep = [c for c in documents.columns]
    parts = None
    for k in sorted(sizes):
        part = documents.select(*keep, F.posexplode(shingle_keys(F.col(words), k)).alias("pos", "key")).withColumn("size", F.lit(k))
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        parts = documents.select(*keep, F.lit(0).alias("pos"), F.lit(0).cast("long").alias("key"), F.lit(0).alias("size")).limit(0)
    return parts.drop(words) if keep == [words] else parts


def _matches(tokens: DataFrame, prefix_path: str, broadcast_bytes: int) -> DataFrame:
    """(_row, start, len, items): the places of texts where a window occurs."""
    spark = tokens.sparkSession
    prefix = spark.read.parquet(prefix_path)
    sizes = [r["size"] for r in prefix.select("size").distinct().collect()]
    start = F.col("pos") - F.col("offset")
    bounds = (start >= 0) & (start + F.col("len") <= F.col("n_words"))
    equal = F.slice(F.col("_words"), start + 1, F.col("len")) == F.col("win")
    if input_bytes(spark, prefix_path) <= broadcast_bytes:
        found = _exploded(tokens.select("_row", "n_words", "_words"), sizes, "_words").join(F.broadcast(prefix), ["key", "size"])
        return found.filter(bounds).filter(equal).select("_row", start.alias("start"), "len", "items")
    places = _exploded(tokens.select("_row", "n_words", "_words"), sizes, "_words").drop("_words")
    candidates = places.join(prefix, ["key", "size"]).filter(bounds).select("_row", "pos", "offset", "win", "len", "items")
    return (candidates.join(tokens.select("_row", "_words"), "_row").filter(equal)
            .select("_row", start.alias("start"), "len", "items"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                  benchmark_text: str = "text", broadcast_bytes: int = BROADCAST_BYTES,
                  keep_text: bool = True) -> DataFrame:
    """`documents` (without its text unless `keep_text`) with n_words, n_hit, n_items, items_sha256 and contaminated."""
    spark = documents.sparkSession
    own = [c for c in documents.columns if c not in RESULTS and (keep_text or c != text)]
    tokens = documents.select(*own, words_of(F.col(text)).alias("_words")).withColumns(
        {"n_words": F.size("_words").cast("long"), "_row": F.monotonically_increasing_id()})
    tokens = stage(tokens, "decontaminate-words")
    prefix_path = scratch_path(spark, "benchmark-prefixes")
    write_table(prefixes(windows(benchmark, item, benchmark_text), tokens), prefix_path)
    # Overlapping windows: add up the lengths of the union of their places.
    union = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "len"))),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(x["start"] + x["len"] - F.greatest(acc["end"], x["start"]), F.lit(0))).alias("n"),
            F.greatest(acc["end"], x["start"] + x["len"]).alias("end")), lambda acc: acc["n"])
    hits = _matches(tokens, prefix_path, broadcast_bytes).groupBy("_row").agg(
        union.cast("long").alias("n_hit"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("_items"))
    ids = F.array_sort(F.coalesce(F.col("_items"), F.array()).cast("array<string>"))
    judged = tokens.drop("_words").join(hits, "_row", "left").withColumns({
        "n_hit": F.coalesce("n_hit", F.lit(0).cast("long")),
        "n_items": F.size(ids).cast("long"),
        "items_sha256": F.sha2(F.array_join(ids, ",").cast("binary"), 256)})
    return judged.withColumn("contaminated", F.col("n_hit") > 0).select(*own, *RESULTS)
