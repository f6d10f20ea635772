"""Toxicity by a classifier chain: one linear model per category, in order, each fed the probabilities of those before it.

The models are fitted on a bounded sample: for each combination of labels the PER_CLASS rows with the smallest hashes, weighted
to the combination's share of all labelled rows. In training, a later model sees out-of-fold probabilities of the earlier
categories (FOLDS folds), as it will meet them on new texts; in use it sees those of the models fitted on the whole sample.

Features are the words of the whole text, in lower case without marks at their ends, and their beginnings of PREFIXES characters.
Those that occur in MIN_DOCS sampled texts and whose rates in the two classes differ by MIN_Z standard errors are kept, scaled by
the logarithm of the rates' ratio, and weighted by logistic regression. The fit runs in one task, over the sample alone; scoring is one
pass without a shuffle, the model (no more features than the bounded sample has) going along.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain as joined

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import aside, scratch

PER_CLASS, FOLDS, SEED = 4000, 3, 5
MIN_DOCS, MIN_Z = 5, 4.5
PREFIXES = (4, 5, 6)
STEPS, RIDGE = 300, 1e-3
CACHED_WORDS = 500_000
MARKS = ".,;:!?()[]{}<>\"'`*#%&$-_"


def word_features(word: str) -> list[int]:
    word = word.strip(MARKS).lower()
    parts = [word] + [f"{word[:n]}\x00" for n in PREFIXES if len(word) > n]
    return [xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass")) - (1 << 63) for p in parts if p]


class _Features(dict):
    """Features of a word; with `known` (feature -> number), the numbers of those that the model has."""

    def __init__(self, known: dict[int, int] | None = None):
        self.known = known

    def __missing__(self, word: str):
        if len(self) > CACHED_WORDS:
            self.clear()
        found = word_features(word)
        out = self[word] = tuple(found if self.known is None else (self.known[f] for f in found if f in self.known))
        return out

    def of(self, text: str) -> set[int]:
        return set(joined.from_iterable(map(self.__getitem__, set(text.split()))))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(rows: np.ndarray, columns: np.ndarray, n: int, width: int, dense: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """(weights of columns, of dense columns, intercept) for the binary matrix with ones at (rows, columns) beside `dense`."""
    pos, neg = max(y.sum(), 1e-9), max((1 - y).sum(), 1e-9)
    with_pos = np.bincount(columns, y[rows], width)
    with_any = np.bincount(columns, minlength=width)
    a, b, both = with_pos / pos, (with_any - with_pos) / neg, with_any / n
    z = (a - b) / np.sqrt(np.maximum(both * (1 - both), 1 / n) * (1 / pos + 1 / neg))
    use = (np.abs(z) >= MIN_Z) & (with_any >= MIN_DOCS)
    scale = np.where(use, np.log((with_pos + 1) / (pos + 2)) - np.log((with_any - with_pos + 1) / (neg + 2)), 0.0)
    at = use[columns]
    rows, columns = rows[at], (np.cumsum(use) - 1)[columns[at]]
    scale, width = scale[use], int(use.sum())
    value = scale[columns]

    def forward(w, d, c):
        return np.bincount(rows, value * w[columns], n) + dense @ d + c

    def back(r):
        return np.bincount(columns, value * r[rows], width), dense.T @ r, r.sum()

    v = np.ones(width), np.ones(dense.shape[1]), 1.0
    for _ in range(12):  # largest curvature, by power iteration
        norm = np.sqrt((v[0] ** 2).sum() + (v[1] ** 2).sum() + v[2] ** 2)
        v = back(weight * forward(*(p / norm for p in v)) / n)
    most = 0.25 * 1.2 * np.sqrt((v[0] ** 2).sum() + (v[1] ** 2).sum() + v[2] ** 2) + RIDGE
    now = last = np.zeros(width), np.zeros(dense.shape[1]), 0.0
    for t in range(STEPS):  # accelerated gradient steps
        ahead = tuple(p + t / (t + 3) * (p - q) for p, q in zip(now, last, strict=True))
        g = back(weight * (_sigmoid(forward(*ahead)) - y) / n)
        last, now = now, tuple(p - (h + RIDGE * p * (i < 2)) / most for i, (p, h) in enumerate(zip(ahead, g, strict=True)))
    weights = np.zeros(len(use))
    weights[use] = now[0] * scale
    return weights, now[1], now[2]


def _logit(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-4, 1 - 1e-4) / np.clip(1 - p, 1e-4, 1 - 1e-4))


def fit_chain(sets: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, fold: np.ndarray):
    """(features, weights per category, chain weights, intercepts) from feature sets and labels (rows x categories)."""
    n, k = labels.shape
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    features, columns = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.int64), return_inverse=True)
    weights, links, start = np.zeros((k, len(features))), np.zeros((k, k)), np.zeros(k)
    out_of_fold = np.zeros((n, k))
    for c in range(k):
        before = _logit(out_of_fold[:, :c])
        y = labels[:, c].astype(float)
        for f in range(FOLDS):
            train, test = fold != f, fold == f
            if not train.any() or not test.any():
                continue
            keep, number = train[rows], np.cumsum(train) - 1
            w, d, b = fit_linear(number[rows[keep]], columns[keep], int(train.sum()), len(features), before[train], y[train], weight[train])
            score = np.bincount(rows, w[columns], n) + before @ d + b
            out_of_fold[test, c] = _sigmoid(score[test])
        w, d, b = fit_linear(rows, columns, n, len(features), before, y, weight)
        weights[c], links[c, :c], start[c] = w, d, b
    used = np.abs(weights).sum(0) > 0
    return features[used], weights[:, used], links, start


@dataclass
class Chain:
    categories: list[str]
    known: dict[int, int]
    weights: np.ndarray  # categories x features
    links: np.ndarray
    start: np.ndarray

    def probabilities(self, found: set[int]) -> np.ndarray:
        z = self.start + (self.weights[:, list(found)].sum(1) if found else 0.0)
        p = np.zeros(len(z))
        for c in range(len(z)):
            p[c] = _sigmoid(z[c] + self.links[c, :c] @ _logit(p[:c]))
        return p


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], key: str = "doc_id") -> Chain | None:
    """Fits the chain. `categories`: name -> SQL condition over the columns of `labels` (key, ..), in chain order. Rows with a null
    key or label are left out; several labels of one key count as one, a category holding if any of them says so. None without both
    classes in the last category."""
    names = list(categories)
    marks = labels.where(f"{key} IS NOT NULL").groupBy(key).agg(*[F.max(F.expr(f"cast({c} as int)")).alias(f"_y{i}")
                                                                  for i, c in enumerate(categories.values())])
    ys = [f"_y{i}" for i in range(len(names))]
    marks = scratch(marks.dropna().withColumn("_h", F.xxhash64(key, F.lit(SEED))), "labels")
    counts = marks.groupBy(*ys).agg(F.count("*").alias("n")).collect()  # a row per combination of labels
    if len({r[ys[-1]] for r in counts}) < 2:
        return None
    parts = [marks.where(" AND ".join(f"{y} = {r[y]}" for y in ys)).orderBy("_h", key).limit(PER_CLASS).withColumn(
        "_w", F.lit(max(1.0, r.n / PER_CLASS))) for r in counts]
    sample = parts[0]
    for p in parts[1:]:
        sample = sample.unionByName(p)
    chosen = docs.select(key, "text").join(F.broadcast(scratch(sample, "sample")), key)  # PER_CLASS rows per combination at most

    def features(batches):
        words = _Features()
        for batch in batches:
            found = [sorted(words.of(t.as_py() or "")) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.list_(pa.int64()))], names=[*batch.schema.names[1:], "found"])

    types = "_h long, _w double, " + ", ".join(f"{y} int" for y in ys)
    sets = scratch(chosen.select("text", "_h", "_w", *ys).mapInArrow(features, f"{types}, found array<long>"), "features")

    def fit(table):
        h = table.column("_h").to_numpy()
        order = np.argsort(h, kind="stable")
        found = [np.array(table.column("found")[int(i)].as_py() or [], np.int64) for i in order]
        y = np.stack([table.column(c).to_numpy()[order] for c in ys], 1)
        w = table.column("_w").to_numpy()[order]
        f, weights, links, start = fit_chain(found, y, w / w.mean(), (h[order] % FOLDS).astype(int))
        return pa.table({"features": pa.array([f.tolist()], pa.list_(pa.int64())), "weights": pa.array([weights.ravel().tolist()], pa.list_(pa.float64())),
                         "links": pa.array([links.ravel().tolist()], pa.list_(pa.float64())), "start": pa.array([start.tolist()], pa.list_(pa.float64()))})

    model = sets.groupBy(F.lit(0).alias("one")).applyInArrow(
        fit, "features array<long>, weights array<double>, links array<double>, start array<double>").head()
    k = len(names)
    return model and Chain(names, {f: i for i, f in enumerate(model.features)}, np.array(model.weights).reshape(k, -1),
                           np.array(model.links).reshape(k, k), np.array(model.start))


def score(docs: DataFrame, model: Chain | None, reject: str, threshold: float = 0.5) -> DataFrame:
    """Adds p_<category> for each category and `rejected` (the probability of `reject` reaches `threshold`) to `docs`, which keeps its
    rows and other columns (text included). Null text is empty. Without a model all probabilities are null, and nothing is rejected."""
    if model is None:
        return docs.withColumns({f"p_{reject}": F.lit(None).cast("double"), "rejected": F.lit(False)})
    names = docs.columns
    new = [f"p_{c}" for c in model.categories]
    at = model.categories.index(reject)

    def work(batches):
        words = _Features(model.known)
        for batch in batches:
            p = [np.round(model.probabilities(words.of(t.as_py() or "")), 9) for t in batch.column(names.index("text"))]
            p = np.array(p).reshape(-1, len(new))
            columns = [pa.array(p[:, i]) for i in range(len(new))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns, pa.array(p[:, at] >= threshold)], names=[*names, *new, "rejected"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(work, fields + "".join(f", {c} double" for c in new) + ", rejected boolean")


CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, p_low_quality, p_toxic, rejected) per row of `docs` (key, text): the chain low quality, then toxic, fitted on `labels`.

    Null and empty texts are judged by the intercepts; equal texts get equal results; an empty table gives no rows; other
    columns are not read. Reruns agree: the sample goes by hashes.
    """
    model = train(docs, labels, CATEGORIES, key)
    out = score(docs.select(key, "text"), model, "toxic").drop("text")
    return out if model else out.withColumn("p_low_quality", F.lit(None).cast("double"))


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of `docs` that the chain does not reject, with all their columns, whatever these are called. Null and empty texts are judged
    by the intercepts; equal texts share their fate; an empty table gives no rows; without both classes among the labels all rows stay."""
    plain, back = aside(docs, [key, "text"])
    model = train(plain, labels, CATEGORIES, key)
    return back(score(plain, model, "toxic").where("NOT rejected"))
