"""Document quality by a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins.  Boosting goes round the features in turn: each turn fits one
shallow tree to the gradient over that feature's bins and adds it, shrunken, to the feature's look-up table.
Afterwards the pairs of features that explain most of what is left get two-dimensional tables the same way.
A text's score is the sum of its bins' entries, through a logistic curve.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlink.llm.common import crc_mod, fresh, map_texts

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_SPACE = b" \t\n\r\x0b\x0c"
_STOPS = b".,;:?!'\"()-"
_ASCII = bytes(range(128))
_MARKS = bytes(b for b in range(33, 127) if b not in _UPPER + _LOWER + _DIGITS + _STOPS)
FEATURES = [
    "log_bytes",
    "log_words",
    "word_bytes",
    "upper",
    "digits",
    "stops",
    "marks",
    "beyond_ascii",
    "spaces",
    "distinct_words",
    "doubled_words",
    "distinct_lines",
    "words_per_line",
    "capitals",
    "marked_words",
    "longest_word",
]


def features(text: str) -> list[float]:
    """Numbers about a whole text; zeros for an empty one."""
    raw = text.encode()
    n, words = len(raw), text.split()
    if not words:
        return [float(np.log1p(n))] + [0.0] * (len(FEATURES) - 1)
    share = lambda some: (n - len(raw.translate(None, some))) / n
    k = len(words)
    lines = text.split("\n")
    sizes = list(map(len, words))
    return [
        float(np.log1p(n)),
        float(np.log1p(k)),
        sum(sizes) / k,
        share(_UPPER),
        share(_DIGITS),
        share(_STOPS),
        share(_MARKS),
        1 - share(_ASCII),
        share(_SPACE),
        len(set(words)) / k,
        sum(map(operator.eq, words, words[1:])) / k,
        len(set(lines)) / len(lines),
        float(np.log1p(k / len(lines))),
        sum(map(str.istitle, words)) / k,
        sum(w[-1] in "*$%&#|!" for w in words) / k,
        float(np.log1p(max(sizes))),
    ]


@dataclass
class Settings:
    bins: int = 64
    rounds: int = 150
    rate: float = 0.1
    leaves: int = 4
    pairs: int = 6
    pair_bins: int = 12
    pair_rounds: int = 60
    ridge: float = 1.0
    least: int = 8  # rows on each side of a split


@dataclass
class Gam:
    """``edges`` and ``tables`` by feature; ``pairs``: (i, j, edges of i, edges of j, table)."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            out += table[np.searchsorted(edges, x[:, f], side="right")]
        for i, j, ei, ej, table in self.pairs:
            out += table[
                np.searchsorted(ei, x[:, i], side="right"), np.searchsorted(ej, x[:, j], side="right")
            ]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts at quantiles, so that equal values share a bin."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray, s: Settings) -> tuple[float, int]:
    """The cut of a run of bins that gains most: (gain, first bin of the right side)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
    gain = gl**2 / (hl + s.ridge) + gr**2 / (hr + s.ridge) - g.sum() ** 2 / (h.sum() + s.ridge)
    gain = np.where((nl >= s.least) & (nr >= s.least), gain, 0)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    """A shallow tree over the bins of one feature: a value for each bin."""
    leaves = [(0, len(g))]
    while len(leaves) < s.leaves:
        cuts = [(*_best_cut(g[a:b], h[a:b], n[a:b], s), a, b) for a, b in leaves]
        gain, k, a, b = max(cuts)
        if gain <= 1e-9:
            break
        leaves.remove((a, b))
        leaves += [(a, a + k), (a + k, b)]
    out = np.zeros(len(g))
    for a, b in leaves:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + s.ridge)
    return out


def _cross(g: np.ndarray, h: np.ndarray, n: np.ndarray, s: Settings) -> tuple[float, np.ndarray]:
    """A tree over a grid: one cut along the rows, then one of the columns on either side."""
    best, out = 0.0, np.zeros_like(g)
    for flip in (False, True):
        a, b, c = (x.T if flip else x for x in (g, h, n))
        gain, k = _best_cut(a.sum(1), b.sum(1), c.sum(1), s)
        if gain <= 1e-9:
            k = len(a) // 2
        leaf, total = np.zeros_like(a), 0.0
        for lo, hi in ((0, k), (k, len(a))):
            ga, ha, na = a[lo:hi].sum(0), b[lo:hi].sum(0), c[lo:hi].sum(0)
            _, m = _best_cut(ga, ha, na, s)
            for x, y in ((0, m), (m, len(ga))) if m else ((0, len(ga)),):
                total += ga[x:y].sum() ** 2 / (ha[x:y].sum() + s.ridge)
                leaf[lo:hi, x:y] = -ga[x:y].sum() / (ha[x:y].sum() + s.ridge)
        if total > best:
            best, out = total, leaf.T if flip else leaf
    return best, out


def fit(x: np.ndarray, y: np.ndarray, s: Settings | None = None) -> Gam:
    """A model of y (0 or 1) by the columns of x.  Without rows, or with one label only, a constant."""
    s = s or Settings()
    model = Gam(edges=[np.empty(0)] * x.shape[1], tables=[np.zeros(1)] * x.shape[1])
    mean = (y.sum() + 0.5) / (len(y) + 1)
    model.base = float(np.log(mean / (1 - mean)))
    if not len(y) or y.min() == y.max():
        return model
    cuts = [_edges(x[:, f], s.bins) for f in range(x.shape[1])]
    own = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(cuts)]
    tables = [np.zeros(len(e) + 1) for e in cuts]
    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(own, tables)]
    margin = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-margin))
        return p - y, p * (1 - p)

    for _ in range(s.rounds):
        for f, b in enumerate(own):
            g, h = slopes()
            k = len(tables[f])
            add = s.rate * _tree(np.bincount(b, g, k), np.bincount(b, h, k), counts[f], s)
            tables[f] += add
            margin += add[b]
    model.edges, model.tables = cuts, tables

    coarse = [_edges(x[:, f], s.pair_bins) for f in range(x.shape[1])]
    small = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(coarse)]

    def grid(i, j, w=None):
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        return np.bincount(small[i] * shape[1] + small[j], w, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    gains = [
        (_cross(grid(i, j, g), grid(i, j, h), grid(i, j), s)[0], -i, -j)
        for i in range(x.shape[1])
        for j in range(i)
    ]
    chosen = [(-i, -j) for _, i, j in sorted(gains, reverse=True)[: s.pairs]]
    both = {ij: np.zeros((len(coarse[ij[0]]) + 1, len(coarse[ij[1]]) + 1)) for ij in chosen}
    for _ in range(s.pair_rounds):
        for i, j in chosen:
            g, h = slopes()
            add = s.rate * _cross(grid(i, j, g), grid(i, j, h), grid(i, j), s)[1]
            both[i, j] += add
            margin += add[small[i], small[j]]
    model.pairs = [(i, j, coarse[i], coarse[j], t) for (i, j), t in both.items()]
    return model


# --- over tables ---------------------------------------------------------------------------------------------

#: At most about so many labelled documents are learnt from: those with the smallest hash of their id.
SAMPLE = 20_000


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, settings: Settings | None = None) -> Gam:
    """A model of ``labels.quality`` by the texts of ``docs``, from ids whose crc32 modulo 5 is not 0.

    Rows without an id or a label are left out; an id that is labelled more than once counts as good if
    all its labels are; one label is 1 if above 0.
    """
    own = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    own = own.groupBy("doc_id").agg(F.min((F.col("quality") > 0).cast("int")).alias("y"))
    own = own.where(crc_mod(F.col("doc_id"), 5) != 0)
    n = own.count()
    span = 2**31
    if n > sample:
        own = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < int(span * sample / n))
    own = F.broadcast(own)  # about ``sample`` short rows at most
    texts = docs.select("doc_id", "text").join(own, "doc_id").select("text", "y")
    rows = with_features(texts, keep=["y"]).select("y", "x").toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(-1, len(FEATURES))
    y = rows["y"].to_numpy(float)
    order = np.lexsort([*x.T, y])  # sums do not depend on how the rows arrive
    return fit(x[order], y[order], settings)


def _features_of(part: pa.Array) -> np.ndarray:
    return np.array([features(t) for t in part.to_pylist()], float).reshape(-1, len(FEATURES))


def with_features(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    keep = [c for c in (docs.columns if keep is None else keep) if c != "x"]

    def make():
        return lambda part: [pa.array(list(_features_of(part)), pa.list_(pa.float64()))]

    return map_texts(docs, text, keep, [T.StructField("x", T.ArrayType(T.DoubleType()))], make)


def score_quality(
    docs: DataFrame, model: Gam, text: str = "text", keep: list[str] | None = None, out: str = "score"
) -> DataFrame:
    """``docs`` with a score from 0 to 1 for every whole text; null counts as empty, repeated rows stay."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != out]

    def make():
        return lambda part: [pa.array(model.score(_features_of(part)), pa.float64())]

    return map_texts(docs, text, keep, [T.StructField(out, T.DoubleType())], make)


def quality_report(docs: DataFrame, labels: DataFrame, good_from: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    scored = score_quality(docs, train(docs, labels), keep=["doc_id"])
    return scored.select(
        "doc_id",
        (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= good_from).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, good_from: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, columns as they are."""
    score = fresh(docs, "_score")
    scored = score_quality(docs, train(docs, labels), out=score)
    return scored.where(F.col(score) >= good_from).select(*docs.columns)
