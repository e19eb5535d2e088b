"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE` words. Every passage is encoded from what can be counted in it (letters,
symbols, repetition, word lengths), a gated attention learnt from document labels alone weighs the encodings, and a
logistic unit scores the weighted sum. The network is fitted on the driver on a bounded sample; whole documents are
scored where they lie, in Arrow batches.

Defined results: a NULL or empty text, or one without words, is one passage of zeros, so it has a score too. Rows are
scored one by one: repeated rows agree and extra columns stay; `score` and `predicted` replace columns of that name.
Without any labels every score is 0.5. Labels, language, source and key are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablemargin.llm.batches import Words, slices
from tablemargin.llm.samples import fold, labelled_sample

PASSAGE = 64
#: Bounds of the fitting sample: documents of each class, passages of a document (evenly spaced).
PER_CLASS, PASSAGES_FITTED = 1500, 48
HIDDEN, GATE = 16, 8
FEATURES = 12

SYMBOL, UPPER, DIGIT, STOP, WIDE, SHOUT = (np.zeros(256, bool) for _ in range(6))
SYMBOL[list(b"#*$%&|<>{}=_~^\\@")] = True
UPPER[ord("A"):ord("Z") + 1] = True
DIGIT[ord("0"):ord("9") + 1] = True
STOP[list(b".,;:?")] = True
SHOUT[ord("!")] = True
WIDE[128:] = True


def passages(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages, document after document, and the offset of each document's first."""
    count = np.diff(words.first)
    parts = np.maximum(1, -(-count // PASSAGE))
    offsets = np.concatenate(([0], np.cumsum(parts)))
    out = np.zeros((offsets[-1], FEATURES))
    if not len(words):
        return out, offsets
    place = np.arange(len(words)) - words.first[:-1][words.of]
    passage = offsets[words.of] + place // PASSAGE
    begins = np.flatnonzero(np.diff(passage, prepend=-1))
    filled = passage[begins]
    n = np.diff(np.append(begins, len(words)))
    # Bytes from the first word of a passage up to the next passage's first word.
    bytes_at = words.start[begins]
    size = np.add.reduceat(words.end - words.start, begins).astype(float)

    def share(kind: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.add.reduceat(kind[words.raw], bytes_at, dtype=np.int64) / of

    grid = np.zeros((len(begins), PASSAGE), np.uint64)
    hashes = words.hashes()
    row = np.searchsorted(begins, np.arange(len(words)), side="right") - 1
    col = np.arange(len(words)) - begins[row]
    grid[row, col] = hashes | np.uint64(1)
    pairs = np.zeros((len(begins), PASSAGE), np.uint64)
    pairs[:, :-1] = np.where(grid[:, 1:] > 0, grid[:, :-1] * np.uint64(3) + grid[:, 1:], 0)
    same = ((grid[:, 1:] == grid[:, :-1]) & (grid[:, 1:] > 0)).sum(axis=1)
    out[filled] = np.stack([
        np.log1p(n), size / n / 10, share(UPPER, size), share(DIGIT, size), share(SYMBOL, size), share(SHOUT, size),
        share(STOP, n), share(WIDE, size), _distinct(grid) / n, _distinct(pairs) / np.maximum(n - 1, 1), same / n,
        np.ones(len(n))], axis=1)
    return out, offsets


def _distinct(grid: np.ndarray) -> np.ndarray:
    """Number of distinct values other than 0 in each row."""
    ordered = np.sort(grid, axis=1)
    return ((ordered[:, 1:] != ordered[:, :-1]) & (ordered[:, 1:] > 0)).sum(axis=1) + (ordered[:, 0] > 0)


class GatedAttention:
    """The network: encode, weigh by gated attention, score; with its gradient for fitting."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        init = lambda *shape: rng.normal(0, 0.3, shape)
        self.p = {"w": init(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "v": init(HIDDEN, GATE), "u": init(HIDDEN, GATE),
                  "a": init(GATE), "o": init(HIDDEN), "c": np.zeros(1)}
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)

    def forward(self, x: np.ndarray, offsets: np.ndarray) -> dict:
        p, begins = self.p, offsets[:-1]
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * g) @ p["a"]
        bag = np.repeat(np.arange(len(begins)), np.diff(offsets))
        e = np.exp(e - np.maximum.reduceat(e, begins)[bag])
        weight = e / np.add.reduceat(e, begins)[bag]
        z = np.add.reduceat(weight[:, None] * h, begins, axis=0)
        score = 1 / (1 + np.exp(-np.clip(z @ p["o"] + p["c"], -30, 30)))
        return {"x": x, "h": h, "t": t, "g": g, "weight": weight, "bag": bag, "z": z, "score": score}

    def gradient(self, f: dict, y: np.ndarray, bag_weight: np.ndarray, begins: np.ndarray) -> dict:
        p = self.p
        d = (f["score"] - y) * bag_weight
        dz = d[:, None] * p["o"]
        dh = f["weight"][:, None] * dz[f["bag"]]
        along = (f["h"] * dz[f["bag"]]).sum(axis=1)
        de = f["weight"] * (along - np.add.reduceat(f["weight"] * along, begins)[f["bag"]])
        dt, dg = de[:, None] * p["a"] * f["g"] * (1 - f["t"] ** 2), de[:, None] * p["a"] * f["t"] * f["g"] * (1 - f["g"])
        dh += dt @ p["v"].T + dg @ p["u"].T
        da = dh * (1 - f["h"] ** 2)
        return {"w": f["x"].T @ da, "b": da.sum(0), "v": f["h"].T @ dt, "u": f["h"].T @ dg,
                "a": (f["t"] * f["g"]).T @ de, "o": f["z"].T @ d, "c": np.array([d.sum()])}

    def fit(self, x: np.ndarray, offsets: np.ndarray, y: np.ndarray, bag_weight: np.ndarray,
            rounds: int = 250, rate: float = 0.02, decay: float = 1e-4) -> "GatedAttention":
        """Adam over the whole sample; bag weights sum to 1."""
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-3)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for i in range(1, rounds + 1):
            grads = self.gradient(self.forward(x, offsets), y, bag_weight, offsets[:-1])
            for k, g in grads.items():
                g = g + decay * self.p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                self.p[k] = self.p[k] - rate * (first[k] / (1 - 0.9 ** i)) / (np.sqrt(second[k] / (1 - 0.999 ** i)) + 1e-8)
        return self


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _sample_features(texts: pa.Array) -> pa.Array:
    """Features of at most PASSAGES_FITTED evenly spaced passages of each text, flattened."""
    out = []
    for part in slices(texts):
        x, offsets = passages(Words(part))
        for a, b in zip(offsets, offsets[1:]):
            take = np.unique(np.linspace(a, b - 1, min(PASSAGES_FITTED, b - a)).astype(int))
            out.append(x[take].ravel())
    return pa.array(out, pa.list_(pa.float64()))


def train(documents: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", key: str = "doc_id",
          text: str = "text", per_class: int = PER_CLASS) -> GatedAttention | None:
    """Fit on at most `per_class` labelled documents of each class among those that `learn` allows."""
    sample, counts = labelled_sample(documents, labels, label, learn, per_class, key, text)
    rows = sample.select("label", _sample_features(text).alias("x")).collect()
    if not rows:
        return None
    bags = [np.array(r.x).reshape(-1, FEATURES) for r in rows]
    y = np.array([r.label for r in rows], dtype=float)
    taken = {c: max(1, int((y == c).sum())) for c in counts}
    weight = np.array([counts[r.label] / taken[r.label] for r in rows])
    offsets = np.concatenate(([0], np.cumsum([len(b) for b in bags])))
    return GatedAttention().fit(np.concatenate(bags), offsets, y, weight / weight.sum())


def score_column(model: GatedAttention | None, text: Column) -> Column:
    """Probability that the document is of quality 1, from all its passages."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        found: Iterator[np.ndarray] = (model.forward(*passages(Words(part)))["score"] for part in slices(texts))
        return pa.array(np.concatenate([np.empty(0), *found]))

    return score(text)


def classify(documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", folds: int = 5,
             held_fold: int = 0, threshold: float = 0.3) -> DataFrame:
    """`documents` with held_out, score and predicted; learns only from keys outside the held-out fold."""
    model = train(documents, labels, fold(F.col(key), folds) != held_fold, key=key, text=text)
    scored = documents.withColumns({"held_out": fold(F.col(key), folds) == held_fold,
                                    "score": score_column(model, F.col(text))})
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
