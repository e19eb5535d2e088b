"""Main text of web pages: block structure, and a host suffix array that finds boilerplate.

Each page becomes blocks of text. What stands in an element whose name, role or class says menu, header, footer, side
bar, notice, advert, form, comment and the like is boilerplate by its markup, and `<article>` or `<main>` is wanted
text by its markup, also inside a wrapper that only its class or id makes boilerplate. All remaining loose blocks, on pages
that mark an article and on those that do not, are decided by repetition: the token streams of a host's pages, with all
their blocks, are concatenated and sorted as a suffix array; long runs of tokens that occur on several distinct pages are
boilerplate, the loose blocks they cover are removed and the unique runs stay.

A host may hold a third of all pages, so its pages are dealt to shards and each shard has a suffix array of its own.
Where a host has several, a shard reports every distinct run of `RUN` tokens with its number of pages, the shards' numbers
are added up, and the runs that reach `PAGES` pages go back to the shards that ask for them. Pages are in one shard each, so
the sums are exact and the number of shards changes no result. Runs travel as fingerprints of 128 bits.

Repetition never removes text inside an article: copies of an article are the same text on several pages, not
boilerplate. For the same reason pages of a host that are alike in article and loose blocks are copies of one page: the
first of them stands for all, in the suffix array and in the number of pages.

Defined results: NULL or empty html gives the empty text. Broken markup (unclosed elements, a page cut off anywhere,
a lone "<") is read as far as it goes. Repeated rows of a page count as one page. A host is what follows "://"; pages
without one share the empty host. Extra columns stay; `text` and `n_chars` replace columns of that name.
"""

from __future__ import annotations

import hashlib
import html
import re
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tablemargin.llm.urlfilter import host_of
from tablemargin.session import shuffles_deleted
from tablemargin.sources.tables import stage

#: Tokens of a repeated run, and distinct pages of a host that make it boilerplate.
RUN, PAGES = 8, 3
#: Pages and characters of a shard, about.
SHARD_PAGES, SHARD_CHARS = 2000, 8 << 20
#: Parts the shards are worked on in, one after the other, so that only one part's text is in shuffle files at a time.
PARTS = 4

# Elements that are never main text, that hold it, that end a block, and whose content is not markup.
CHROME = set("nav header footer aside form dialog menu button select textarea noscript template svg iframe object "
             "canvas audio video map head title fieldset".split())
MAIN = {"article", "main"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
            "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
            "optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
#: Block elements that what follows may close, so they have no rank of their own.
LEAVES = set("p li dt dd tr td th option h1 h2 h3 h4 h5 h6".split())
CHROME_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner\w*|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumb\w*|header|masthead|footer|"
    r"side-?bar|widget\w*|cookie\w*|consent|gdpr|notice\w*|popup|modal|overlay|comment\w*|reply|replies|disqus|share|"
    r"sharing|social\w*|related|recommend\w*|newsletter|subscribe\w*|signup|login|pagination|pager|skip-link|toolbar)"
    r"(?:$|[\s_-])", re.I)
# Names of places where other articles than the page's own stand, and names that say what an element has, not what it is.
OTHERS_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|widget\w*|comment\w*|reply|replies|disqus|related|recommend\w*)"
    r"(?:$|[\s_-])|(?:^|\s)side-?bar(?:$|[\s_-])", re.I)
HAS_NAME = re.compile(r"(?:^|(?<=[\s_-]))(?:has|no|with|without)[_-]\S*", re.I)
CHROME_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}
COMMENT = re.compile(r"\bclass\s*=\s*[\"']?(?:[^\"'>]*\s)?(?:comment|reply)(?:[\s\"'_-]|$)", re.I)
MAIN_NAME = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story)[_-]?(?:body|content|text)(?:$|[\s_-])", re.I)

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|[\"'])*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WHITE = re.compile(r"\s+")

DROP, LOOSE, KEEP = 0, 1, 2
#: Ranks of elements only: dropped for the class or id alone, so that an article inside is wanted text all the same;
#: dropped alike, but as a place of other articles, where only `<main>` is wanted; and `<main>` itself.
NAMED, OTHERS, WHOLE = -1, -2, 3


def _rank(name: str, attributes: str) -> int | None:
    """The rank an element claims for itself, or None."""
    if name in CHROME:
        return DROP
    if name in MAIN:
        return DROP if COMMENT.search(attributes) else WHOLE if name == "main" else KEEP
    named, role = None, None
    if attributes:
        for m in ATTRIBUTE.finditer(attributes):
            key, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                return DROP
            if key == "role":
                if value.lower() in CHROME_ROLE:
                    return DROP
                role = WHOLE if value.lower() == "main" else KEEP if value.lower() == "article" else role
            if key in ("class", "id") and named is None:
                own = HAS_NAME.sub(" ", value)
                if name not in ("body", "html") and CHROME_NAME.search(own):
                    named = OTHERS if OTHERS_NAME.search(own) else NAMED
                elif MAIN_NAME.search(own):
                    named = KEEP
    return role if role == WHOLE or named is None else named


def _inside(own: int | None, around: int) -> int:
    """Rank inside an element that claims `own` in one of rank `around`."""
    if DROP in (own, around):
        return DROP
    if own == WHOLE or own == KEEP and around != OTHERS:
        return KEEP
    dropped = min(own or LOOSE, around)
    return dropped if dropped < DROP else around


class _Reader:
    """Text parts of the block being read, finished blocks, and the open elements that matter."""

    def __init__(self) -> None:
        self.out: list[tuple[int, str]] = []
        self.parts: list[str] = []
        #: (name, rank inside, parts of the block around an inline element that is dropped)
        self.open: list[tuple[str, int, list[str] | None]] = []

    @property
    def rank(self) -> int:
        return self.open[-1][1] if self.open else LOOSE

    def flush(self) -> None:
        text = WHITE.sub(" ", html.unescape("".join(self.parts))).strip()
        self.parts = []
        if text:
            self.out.append((max(self.rank, DROP), text))

    def begin(self, name: str, attributes: str) -> None:
        own = _rank(name, attributes)
        block = name in BLOCK or name in CHROME
        if own in (DROP, NAMED, OTHERS) and not block:
            self.open.append((name, _inside(own, self.rank), self.parts))
            self.parts = []
            return
        if block or own is not None:
            self.flush()
        if block and self.open and self.open[-1][0] in ("p", "li") and name in ("p", self.open[-1][0]):
            self.open.pop()
        if own is not None or (block and name not in LEAVES):
            self.open.append((name, _inside(own, self.rank), None))

    def end(self, name: str) -> None:
        if name in BLOCK or name in CHROME:
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name:
                self.close(i)
                return

    def close(self, upto: int) -> None:
        while len(self.open) > upto:
            around = self.open[-1][2]
            if around is None:
                self.flush()
            else:
                self.parts = around
            self.open.pop()


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(rank, text) of the page's blocks in page order, without empty ones."""
    page = page or ""
    read, at, size = _Reader(), 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            read.parts.append(page[at:])
            break
        if lt > at:
            read.parts.append(page[at:lt])
        m = MARKUP.match(page, lt)
        if not m:
            read.parts.append("<")
            at = lt + 1
            continue
        at = m.end()
        name = (m.group(2) or "").lower()
        if not name:
            if m.group().startswith("<![CDATA["):
                read.parts.append(m.group()[9:].removesuffix("]]>"))
        elif m.group(1):
            read.end(name)
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
        elif name == "br":
            read.parts.append(" ")
        elif name == "hr":
            read.flush()
        elif name not in VOID and not m.group(3).endswith("/"):
            read.begin(name, m.group(3))
    read.flush()
    read.close(0)
    read.flush()
    return read.out


@F.arrow_udf(T.StructType([T.StructField("ranks", T.ArrayType(T.IntegerType())), T.StructField("texts", T.ArrayType(T.StringType()))]))
def _parse(pages: pa.Array) -> pa.Array:
    """Ranks and texts of the page's blocks."""
    found = [blocks(page) for page in pages.to_pylist()]
    return pa.StructArray.from_arrays(
        [pa.array([[r for r, _ in page] for page in found], pa.list_(pa.int32())),
         pa.array([[t for _, t in page] for page in found], pa.list_(pa.string()))], names=["ranks", "texts"])


def suffix_array(tokens: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by prefix doubling; a round sorts what is not told apart yet."""
    n = len(tokens)
    if not n:
        return np.empty(0, np.int64)
    order = np.argsort(tokens, kind="stable")
    first = np.concatenate(([True], np.diff(tokens[order]) != 0))
    # A suffix ranks by the first place of those alike so far.
    rank, step = np.empty(n, np.int64), 1
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    while step < n:
        alike = np.flatnonzero(~(first & np.append(first[1:], True)))
        if not len(alike):
            break
        at = order[alike]
        follow = np.where(at + step < n, rank[np.minimum(at + step, n - 1)], -1)
        by = np.lexsort((follow, rank[at]))
        at, follow = at[by], follow[by]
        own = rank[at]
        begins = np.concatenate(([True], (own[1:] != own[:-1]) | (follow[1:] != follow[:-1])))
        order[alike], first[alike] = at, begins
        rank[at] = np.maximum.accumulate(np.where(begins, alike, 0))
        step *= 2
    return order


def common_prefixes(tokens: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length, at most `most`, of what each suffix has in common with the one before it in order."""
    n = len(tokens)
    out = np.zeros(n, np.int64)
    same = np.ones(max(0, n - 1), bool)
    for k in range(most):
        a, b = order[:-1] + k, order[1:] + k
        inside = same & (a < n) & (b < n)
        same = inside & (tokens[np.minimum(a, n - 1)] == tokens[np.minimum(b, n - 1)])
        out[1:] += same
    return out


class Shard:
    """Token streams of a shard's pages, one after the other, and their suffix array."""

    def __init__(self, texts: list[list[str]], ranks: list[list[int]], pages: np.ndarray, run: int):
        self.run, self.texts, self.ranks = run, texts, ranks
        names: dict[str, int] = {}
        sizes: list[int] = []
        flat: list[int] = []
        ends: list[int] = []
        for i, page in enumerate(texts):
            for text in page:
                words = text.split()
                sizes.append(len(words))
                flat += [names.setdefault(w, len(names)) for w in words]
            # A token of its own ends each page, so no run spans two of them.
            ends.append(len(flat))
            flat.append(-1 - i)
        self.block_words = np.array(sizes, dtype=np.int64)
        self.loose = np.array([r == LOOSE for page in ranks for r in page], dtype=bool)
        self.tokens, self.ends, self.names = np.array(flat, dtype=np.int64), np.array(ends, dtype=np.int64), names
        page_at = np.searchsorted(self.ends, np.arange(len(flat)))
        order = suffix_array(self.tokens)
        # Suffixes that share their first `run` tokens stand together: one group for each distinct run.
        group = np.cumsum(common_prefixes(self.tokens, order, run) < run) if len(order) else order
        whole = order + run <= self.ends[page_at[order]]
        #: Positions at which a whole run begins, which of the distinct runs that is, and a position of each of these.
        self.order = order[whole]
        _, self.first, self.of = np.unique(group[whole], return_index=True, return_inverse=True)
        pairs = np.unique(np.stack([self.of, np.asarray(pages, dtype=np.int64)[page_at[self.order]]], axis=1), axis=0)
        #: Distinct pages of each run.
        self.n_pages = np.bincount(pairs[:, 0], minlength=len(self.first))

    def asked(self) -> np.ndarray:
        """Which distinct runs reach into a loose block."""
        at = np.zeros(len(self.tokens) + 1, np.int64)
        page_ends = np.repeat(np.arange(len(self.texts)), [len(page) for page in self.texts])
        begins = np.concatenate(([0], np.cumsum(self.block_words)))[:-1] + page_ends
        np.add.at(at, begins[self.loose], 1)
        np.add.at(at, (begins + self.block_words)[self.loose], -1)
        upto = np.concatenate(([0], np.cumsum(np.cumsum(at) > 0)))
        out = np.zeros(len(self.first), bool)
        out[self.of[upto[self.order + self.run] > upto[self.order]]] = True
        return out

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each distinct run, which are the same in every shard."""
        digests = b"".join([hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=16).digest() for w in self.names])
        of_word = np.frombuffer(digests, dtype="<u8").reshape(-1, 2)
        out = []
        for half, factor in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
            mark = np.zeros(len(self.first), np.uint64)
            for k in range(self.run):
                mark = mark * np.uint64(factor) + of_word[self.tokens[self.order[self.first] + k], half]
            out.append(mark.view(np.int64))
        return out[0], out[1]

    def kept(self, boilerplate: np.ndarray) -> list[str]:
        """The text of each page: its article, and the loose blocks that do not lie wholly under runs of `boilerplate`."""
        begins = self.order[boilerplate[self.of]]
        size = len(self.tokens) + 1
        cover = np.bincount(begins, minlength=size) - np.bincount(begins + self.run, minlength=size)
        under = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
        out, block, token = [], 0, 0
        for texts, ranks in zip(self.texts, self.ranks):
            page = []
            for text, rank in zip(texts, ranks):
                size = self.block_words[block]
                if rank == KEEP or rank == LOOSE and not (size and under[token + size] - under[token] == size):
                    page.append(text)
                token += size
                block += 1
            token += 1
            out.append("\n".join(page))
        return out


def _shard(pdf: pd.DataFrame, run: int) -> Shard:
    return Shard([list(t) for t in pdf["_texts"]], [list(r) for r in pdf["_ranks"]], pd.factorize(pdf["_key"])[0], run)


def _open_texts(pdf: pd.DataFrame, texts: list[str]) -> dict[str, object]:
    """`_row` and `text` of the pages that have loose blocks."""
    is_open = pdf["_open"].to_numpy(bool)
    return {"_row": pdf["_row"].to_numpy()[is_open], "text": pd.Series(texts, dtype=object)[is_open].to_numpy()}


def _sharded(streams: DataFrame, shard_pages: int) -> tuple[DataFrame, int]:
    """Each host's pages dealt to as many shards as their number and length ask for, and how many full shards all are."""
    hosts = stage(streams.groupBy("_host").agg(
        F.greatest(F.ceil(F.count("*") / shard_pages), F.ceil(F.sum("_chars") / SHARD_CHARS), F.lit(1)).alias("_shards"),
        F.max("_open").alias("_asks"), F.sum("_chars").alias("_size")), "html-hosts")
    size = hosts.agg(F.sum("_size")).first()[0] or 0
    dealt = streams.join(hosts.drop("_size"), "_host").withColumn("_shard", F.pmod(F.xxhash64("_key"), F.col("_shards")))
    return dealt, -(-size // SHARD_CHARS)


def unique_blocks(streams: DataFrame, run: int = RUN, pages: int = PAGES, shard_pages: int = SHARD_PAGES) -> DataFrame:
    """(_row, text) of the pages with loose blocks: their article, and the loose blocks that no repeated runs cover."""
    # Groups of copies only, which are few: the text is neither shuffled to find them nor to leave them out.
    copies = stage(streams.groupBy("_host", "_stream").agg(F.min(F.struct("_key", "_row")).alias("_first"), F.count("*").alias("_n"))
                   .filter("_n > 1").select("_host", "_stream", F.col("_first._row").alias("_first")), "html-copies")
    others = stage(streams.select("_host", "_stream", "_row", "_open").join(copies, ["_host", "_stream"])
                   .filter("_row <> _first").select("_row", "_first", "_open"), "html-others")
    found = _unique_of(*_sharded(streams.join(others.select("_row"), "_row", "left_anti"), shard_pages), run, pages)
    texts = others.filter("_open").join(found.withColumnRenamed("_row", "_first"), "_first").select("_row", "text")
    return found.unionByName(texts)


def _spread(dealt: DataFrame, shards: int) -> DataFrame:
    """Tasks grow in number, not in size: more of them than usual where there are more full shards."""
    usual = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(shards, "_host", "_shard") if shards > usual else dealt


def _unique_of(sharded: DataFrame, size: int, run: int, pages: int) -> DataFrame:
    """(_row, text) as of `unique_blocks` for pages dealt to shards (`size` full ones), no two alike."""
    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        """The texts of a host that is one shard; of others the distinct runs."""
        shard, host = _shard(pdf, run), pdf["_host"].iloc[0]
        if pdf["_shards"].iloc[0] == 1:
            out = _open_texts(pdf, shard.kept(shard.n_pages >= pages))
            return pd.DataFrame({"_host": host, "_shard": np.int64(0), "a": np.int64(0), "b": np.int64(0), "n_pages": np.int64(0),
                                 "asked": False, **out}, columns=columns)
        if not pdf["_asks"].iloc[0]:
            return pd.DataFrame(columns=columns)
        a, b = shard.fingerprints()
        return pd.DataFrame({"_host": host, "_shard": pdf["_shard"].iloc[0], "a": a, "b": b, "n_pages": shard.n_pages,
                             "asked": shard.asked(), "_row": np.int64(-1), "text": None}, columns=columns)

    def settle(pdf: pd.DataFrame, repeated: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame({"_row": np.empty(0, np.int64), "text": np.empty(0, object)})
        shard = _shard(pdf, run)
        a, b = shard.fingerprints()
        marks = pd.MultiIndex.from_arrays([a, b])
        return pd.DataFrame(_open_texts(pdf, shard.kept(marks.isin(pd.MultiIndex.from_frame(repeated[["a", "b"]])))))

    columns = ["_host", "_shard", "a", "b", "n_pages", "asked", "_row", "text"]
    schema = "_host string, _shard long, a long, b long, n_pages long, asked boolean, _row long, text string"
    part = F.pmod(F.xxhash64("_host", "_shard"), F.lit(PARTS))
    with shuffles_deleted(sharded.sparkSession):
        first = reduce(DataFrame.unionByName, [
            stage(_spread(sharded.filter(part == k), size // PARTS).groupBy("_host", "_shard").applyInPandas(decide, schema), "html-shards")
            for k in range(PARTS)])
        runs = first.filter("_row = -1")
        repeated = stage(runs.groupBy("_host", "a", "b").agg(F.sum("n_pages").alias("n"), F.max("asked").alias("any"))
                         .filter((F.col("n") >= pages) & F.col("any")).select("_host", "a", "b"), "html-repeated")
        wanted = stage(runs.filter("asked").join(repeated, ["_host", "a", "b"]).select("_host", "_shard", "a", "b"), "html-wanted")
        rest = _spread(sharded.filter("_shards > 1 AND _asks"), size)
        settled = stage(rest.groupBy("_host", "_shard").cogroup(wanted.groupBy("_host", "_shard"))
                        .applyInPandas(settle, "_row long, text string"), "html-settled")
    return first.filter("_row <> -1").select("_row", "text").unionByName(settled)


def extract(df: DataFrame, html_col: str = "html", url: str = "url", key: str = "page_id", run: int = RUN,
            pages: int = PAGES, shard_pages: int = SHARD_PAGES) -> DataFrame:
    """`df` without its html, with the page's main `text` and its `n_chars`.

    The suffix arrays hold all blocks of all pages of every host.
    """
    own = [c for c in df.columns if c not in (html_col, "text", "n_chars")]

    def of_rank(rank: int):
        return F.filter("_page.texts", lambda _, i: F.get("_page.ranks", i) == rank)

    with shuffles_deleted(df.sparkSession):
        parsed = stage(df.select(*own, _parse(F.col(html_col)).alias("_page"), host_of(F.col(url)).alias("_host"),
                                 F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"),
                                 F.monotonically_increasing_id().alias("_row")).withColumns({
            "_stream": F.sha2(F.concat_ws("\n", F.lit("main:"), of_rank(KEEP), F.lit("loose:"), of_rank(LOOSE)), 256),
            "_open": F.exists("_page.ranks", lambda r: r == LOOSE),
            "_chars": F.aggregate("_page.texts", F.lit(0).cast("bigint"), lambda n, t: n + F.length(t))}), "html-pages")
        unique = unique_blocks(parsed.select("_host", "_key", "_row", "_stream", "_open", "_chars", F.col("_page.ranks").alias("_ranks"),
                                             F.col("_page.texts").alias("_texts")), run, pages, shard_pages)
    settled = parsed.filter(~F.col("_open")).select(*own, F.array_join(of_rank(KEEP), "\n").alias("text"))
    decided = (parsed.filter("_open").select(*own, "_row").join(unique, "_row", "left")
               .select(*own, F.coalesce("text", F.lit("")).alias("text")))
    return settled.unionByName(decided).withColumn("n_chars", F.length("text").cast("long"))
