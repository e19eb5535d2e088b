"""Toxic spans by a linear-chain conditional random field; document scores from its marginals.

Tokens (words between white space) carry the labels "toxic" and "other"; a chain is a run of tokens up to the end of a
sentence. Labelled tokens for fitting come from document labels: word shapes (a word, its prefixes) that are far
more frequent in toxic documents than in clean ones are picked, and the tokens of toxic documents that have a picked
shape are labelled toxic. The field is then fitted to those tokens, and decides
by all features of a token and by its neighbours. Forward-backward marginals give each token's probability; offsets of
the likely ones are the spans, and a small calibrated unit turns the marginals of a document into its score.

Fitting uses a bounded sample on the driver; documents are scored whole, in Arrow batches.

Defined results: a NULL or empty text has no tokens, no spans and the calibrated score of a text without toxic tokens.
Rows are scored one by one: repeated rows agree, extra columns stay, output columns replace columns of that name.
Without labels every score is 0.5. Language, source and key are never inputs.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablemargin.llm.samples import fold, labelled_sample

#: Bounds of the fitting sample: documents of each class, and characters of a document (longer ones are not sampled).
PER_CLASS, CHARACTERS = 1200, 20_000
#: Clean chains the field is fitted to, beside all that hold a toxic token.
CLEAN_CHAINS = 10_000
#: Tokens of a chain: a longer sentence is cut into several chains, which only ends the influence of neighbours there.
CHAIN = 64
BUCKETS = 1 << 17
#: Words a worker remembers the features of.
REMEMBERED = 400_000
EDGE = ".,;:!?\"'()[]{}<>*_-…«»¿¡“”‘’"


#: A shape labels tokens if it is this many times as frequent in toxic documents as in clean ones: on its own, or to
#: explain documents that nothing else explains.
STRONG, WEAK = 25, 6


def shapes(word: str) -> list[str]:
    """The word without case and outer punctuation, and its prefixes."""
    bare = word.strip(EDGE).lower()
    return [f"w {bare}", *(f"p{n} {bare[:n]}" for n in range(4, 10) if len(bare) >= n)] if bare else []


def features(word: str) -> list[int]:
    """Buckets of what the field sees of a token: its first bytes, up to ten, all of it, its ending and its case."""
    data = word.strip(EDGE).lower().encode("utf-8", "surrogatepass")
    crc, out = zlib.crc32(data[:3]), []
    for n in range(4, min(10, len(data)) + 1):
        crc = zlib.crc32(data[n - 1:n], crc)
        out.append((crc + n) % BUCKETS)
    out += [zlib.crc32(data, 1) % BUCKETS, zlib.crc32(data[-3:], 2) % BUCKETS, 3 + word.isupper() + 2 * (not data)]
    return out


def chains(tokens: list[str]) -> list[int]:
    """Lengths of the consecutive chains of a token list."""
    if not tokens:
        return []
    ends = np.flatnonzero([t[-1] in ".!?" for t in tokens]) + 1
    if not len(ends) or ends[-1] < len(tokens):
        ends = np.append(ends, len(tokens))
    lengths = np.diff(ends, prepend=0)
    if lengths.max() <= CHAIN:
        return lengths.tolist()
    return [n for whole in lengths.tolist() for n in [CHAIN] * ((whole - 1) // CHAIN) + [(whole - 1) % CHAIN + 1]]


def pick_shapes(toxic: list[list[str]], clean: list[list[str]]) -> set[str]:
    """Shapes whose tokens count as toxic in toxic documents.

    A shape qualifies if two token lists and one in a hundred have it, if it is far more frequent in toxic lists than
    in clean ones, and if what follows it varies: copies of one toxic text share all their words, but always in the same
    place. All STRONG shapes are picked, and of all greedily those that newly explain most lists.
    """
    least = max(2, len(toxic) // 100)
    in_toxic: Counter = Counter(s for tokens in toxic for s in {s for w in set(tokens) for s in shapes(w)})
    common = {s for s, n in in_toxic.items() if n >= least}
    in_clean: Counter = Counter(s for tokens in clean for s in {s for w in set(tokens) for s in shapes(w)} & common)
    share = len(toxic) / max(1, len(clean))
    ratio = {s: in_toxic[s] / ((in_clean[s] + 1) * share) for s in common}
    able = {s for s in common if ratio[s] >= WEAK}
    where: dict[str, set[int]] = defaultdict(set)
    follows: dict[str, set[str]] = defaultdict(set)
    for i, tokens in enumerate(toxic):
        for word, after in zip(tokens, [*tokens[1:], ""]):
            for shape in able.intersection(shapes(word)):
                where[shape].add(i)
                follows[shape].add(after)
    able = {s for s in able if 2 * len(follows[s]) >= len(where[s])}
    picked = {s for s in able if ratio[s] >= STRONG}
    explained: set[int] = set()
    # Gains only shrink, so a shape whose fresh gain is still the largest is the best one.
    queue = [(-len(where[s]), s) for s in able]
    heapq.heapify(queue)
    while queue:
        gain, shape = heapq.heappop(queue)
        fresh = len(where[shape] - explained)
        if fresh < -gain:
            if fresh >= least:
                heapq.heappush(queue, (-fresh, shape))
            continue
        picked.add(shape)
        explained |= where[shape]
    return picked


class ChainField:
    """Two-state linear-chain field: a weight for each feature of the toxic state, and the transition weights."""

    def __init__(self) -> None:
        self.emit = np.zeros(BUCKETS)
        self.step = np.zeros((2, 2))
        self.bias = -4.0
        self.calibration = np.array([0.0, 0.0, 0.0])
        self._known: dict[str, float] = {}

    def marginals(self, toxic_weight: np.ndarray, lengths: np.ndarray, pairs: bool = False):
        """Probability of the toxic state of each token, by forward-backward over all chains at once.

        `toxic_weight` holds the emission weights of consecutive chains. With `pairs` also the expected number of each
        transition.
        """
        n_chains = len(lengths)
        out = np.zeros(len(toxic_weight))
        expected = np.zeros((2, 2))
        if not n_chains:
            return (out, expected) if pairs else out
        begin = np.cumsum(lengths) - lengths
        move = np.exp(self.step)
        by_length = np.argsort(-lengths, kind="stable")
        begin, lengths = begin[by_length], lengths[by_length]
        longest = int(lengths[0])
        # active[t]: chains longer than t come first.
        active = np.searchsorted(-lengths, -np.arange(longest), side="left")
        odds = np.exp(np.clip(toxic_weight, -30, 30))
        ahead = np.zeros((longest, n_chains, 2))
        for t in range(longest):
            k = active[t]
            e = odds[begin[:k] + t]
            a = np.ones((k, 2)) if t == 0 else ahead[t - 1, :k] @ move
            a[:, 1] *= e
            ahead[t, :k] = a / a.sum(axis=1, keepdims=True)
        back = np.ones((n_chains, 2))
        for t in range(longest - 1, -1, -1):
            k = active[t]
            p = ahead[t, :k] * back[:k]
            p /= p.sum(axis=1, keepdims=True)
            out[begin[:k] + t] = p[:, 1]
            if t:
                b = back[:k].copy()
                b[:, 1] *= odds[begin[:k] + t]
                if pairs:
                    joint = ahead[t - 1, :k, :, None] * move * b[:, None, :]
                    expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                b = b @ move.T
                back[:k] = b / b.sum(axis=1, keepdims=True)
        return (out, expected) if pairs else out

    def fit(self, tokens: list[list[str]], tags: list[np.ndarray], rounds: int = 45, rate: float = 0.3,
            decay: float = 2e-4) -> "ChainField":
        """Adam on the conditional likelihood of the tags; each element of `tokens` is one chain."""
        lengths = np.array([len(c) for c in tokens])
        feats = [features(w) for chain in tokens for w in chain]
        token_of = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
        used, local = np.unique(np.concatenate([np.array(f) for f in feats]), return_inverse=True)
        gold = np.concatenate(tags).astype(float)
        flat = gold.astype(int)
        inner = np.ones(len(flat), bool)
        inner[np.cumsum(lengths) - lengths] = False
        seen = np.zeros((2, 2))
        np.add.at(seen, (flat[:-1][inner[1:]], flat[1:][inner[1:]]), 1)
        w = np.zeros(len(used) + 5)
        w[-5] = self.bias
        m, v, total = np.zeros_like(w), np.zeros_like(w), max(1.0, gold.sum())
        for i in range(1, rounds + 1):
            self.step = w[-4:].reshape(2, 2)
            weight = np.bincount(token_of, w[local], len(feats)) + w[-5]
            p, expected = self.marginals(weight, lengths, pairs=True)
            miss = p - gold
            g = np.concatenate((np.bincount(local, miss[token_of], len(used)), [miss.sum()], (expected - seen).ravel()))
            g = g / total + decay * w
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w = w - rate * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.99 ** i)) + 1e-9)
        self.emit[used], self.bias, self.step = w[:len(used)], w[-5], w[-4:].reshape(2, 2)
        return self

    def weights(self, tokens: list[str]) -> list[float]:
        """Emission weight of each token's toxic state."""
        known = self._known
        if len(known) > REMEMBERED:
            known.clear()
        try:
            return [known[t] for t in tokens]
        except KeyError:
            emit = self.emit
            for t in set(tokens):
                if t not in known:
                    known[t] = float(sum([emit[f] for f in features(t)]) + self.bias)
            return [known[t] for t in tokens]

    def tag(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Marginal probabilities of the tokens of each text."""
        weight = np.array([w for tokens in texts for w in self.weights(tokens)])
        lengths = np.array([n for tokens in texts for n in chains(tokens)], dtype=np.int64)
        ends = np.cumsum([len(tokens) for tokens in texts])
        return np.split(self.marginals(weight, lengths), ends[:-1]) if texts else []

    def document_score(self, marginals: np.ndarray) -> float:
        x = evidence(marginals)
        return float(1 / (1 + np.exp(-np.clip(self.calibration @ x, -30, 30))))

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_known": {}}


def evidence(marginals: np.ndarray) -> np.ndarray:
    """Log-odds of the likeliest token, logarithm of the number of likely toxic tokens, and a constant.

    Unlikely tokens do not add up, so a text does not become toxic by its length.
    """
    top = np.clip(marginals.max(initial=0), 1e-4, 1 - 1e-4)
    return np.array([np.log(top / (1 - top)), np.log1p(marginals[marginals > 0.2].sum()), 1.0])


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Logistic unit on the evidence, by gradient descent with a light pull towards zero."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= 0.1 * (x.T @ ((p - y) * weight) / weight.sum() + 1e-4 * w)
    return w


def train(documents: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", key: str = "doc_id",
          text: str = "text", per_class: int = PER_CLASS) -> ChainField | None:
    """Fit on at most `per_class` labelled documents of each class among those that `learn` allows."""
    sample, counts = labelled_sample(documents, labels, label, learn, per_class, key, text)
    rows = sample.filter(F.length(text) <= CHARACTERS).select(text, "label").distinct().orderBy(text, "label").collect()
    if not counts:
        return None
    return fit_documents([(r[text].split(), r.label) for r in rows], counts)


def fit_documents(labelled: list[tuple[list[str], int]], counts: dict[int, int]) -> ChainField:
    """Field fitted to three of four token lists, and calibrated on the fourth, which it has not seen.

    `counts` says how many documents each class has beyond the sample.
    """
    held = labelled[3::4]
    fitted = [x for i, x in enumerate(labelled) if i % 4 != 3]
    picked = pick_shapes([t for t, y in fitted if y == 1], [t for t, y in fitted if y == 0])
    field = ChainField()
    with_toxic, without = [], []
    for tokens, y in fitted:
        at = 0
        for n in chains(tokens):
            chain = tokens[at:at + n]
            at += n
            tags = np.array([y == 1 and not picked.isdisjoint(shapes(w)) for w in chain])
            (with_toxic if tags.any() else without).append((chain, tags))
    if with_toxic:
        chosen = with_toxic + without[::max(1, -(-len(without) // CLEAN_CHAINS))]
        field.fit([c for c, _ in chosen], [t for _, t in chosen])
    held = held if len({y for _, y in held}) == 2 else labelled
    if held:
        x = np.array([evidence(m) for m in field.tag([t for t, _ in held])])
        y = np.array([y for _, y in held], dtype=float)
        taken = {c: max(1, int((y == c).sum())) for c in (0, 1)}
        field.calibration = calibrate(x, y, np.array([counts.get(int(c), 1) / taken[int(c)] for c in y]))
    return field


def spans(text: str, probabilities: np.ndarray, threshold: float = 0.5) -> list[tuple[int, int]]:
    """Character offsets of the runs of neighbouring toxic tokens."""
    out: list[tuple[int, int]] = []
    previous = False
    for match, p in zip(re.finditer(r"\S+", text), probabilities):
        if p >= threshold:
            out.append((out.pop()[0] if previous else match.start(), match.end()))
        previous = p >= threshold
    return out


def tag_documents(df: DataFrame, field: ChainField | None, text: str = "text") -> DataFrame:
    """`df` with score, n_toxic_tokens and toxic_spans (start and end offsets in characters)."""
    kind = "struct<score:double,n_toxic_tokens:long,toxic_spans:array<struct<begin:int,end:int>>>"
    if field is None:
        found = F.struct(F.lit(0.5).alias("score"), F.lit(0).cast("long").alias("n_toxic_tokens"),
                         F.array().cast("array<struct<begin:int,end:int>>").alias("toxic_spans"))
    else:
        @F.arrow_udf(kind)
        def tag(texts: pa.Array) -> pa.Array:
            scores, counts, found = [], [], []
            for at in range(0, len(texts), 512):
                part = [t or "" for t in texts.slice(at, 512).to_pylist()]
                for body, p in zip(part, field.tag([t.split() for t in part])):
                    n = int((p >= 0.5).sum())
                    scores.append(field.document_score(p))
                    counts.append(n)
                    found.append([{"begin": a, "end": b} for a, b in spans(body, p)] if n else [])
            return pa.StructArray.from_arrays(
                [pa.array(scores, pa.float64()), pa.array(counts, pa.int64()),
                 pa.array(found, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))],
                names=["score", "n_toxic_tokens", "toxic_spans"])

        found = tag(F.col(text))
    names = ("score", "n_toxic_tokens", "toxic_spans")
    tagged = df.withColumn("_toxicity", found)
    return tagged.withColumns({n: F.col(f"_toxicity.{n}") for n in names}).drop("_toxicity")


def classify(documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", folds: int = 3,
             held_fold: int = 1, threshold: float = 0.7) -> DataFrame:
    """`documents` with held_out, score, predicted and the spans; learns only outside the held-out fold."""
    field = train(documents, labels, fold(F.col(key), folds) != held_fold, key=key, text=text)
    tagged = tag_documents(documents, field, text).withColumn("held_out", fold(F.col(key), folds) == held_fold)
    return tagged.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
