"""Quality classifier: a generalised additive model with pairwise interactions.

Text features (counts and ratios, no words of any language) are cut into
quantile bins.  Cyclic boosting visits one feature after the other, each time
fitting a shallow tree of at most four leaves to the logistic loss; the sum
of a feature's trees is one lookup table.  The strongest pairs of the
residual then get two-dimensional tables in the same way.  A score is the
logistic of the intercept plus one table entry per feature and pair, looked
up for a whole Arrow batch at once.

The model is fitted on the driver on a bounded sample: the features of at
most ``max_rows`` labelled rows (those with the smallest hash of their id, however
often an id stands).
Everything else covers all rows.

Nulls and ties: a null text counts as empty and gets the score of an empty
text; rows without a label, or with a label that is not 0 or 1, teach
nothing; repeated labels of an id count as often as they stand; a null id is
held out (it has no crc32) and scored like any other;
without any labels every score is 0.5; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmarts.llm.common import field_type

MAX_TRAINING_ROWS = 20_000
KEEP_AT = 0.3
FEATURES = ("log_words", "log_chars", "word_length", "long_words", "distinct_words", "top_word", "stutter",
            "distinct_bigrams", "upper", "digits", "symbols", "odd_endings", "pipes", "brackets", "commas",
            "lines_per_word", "repeated_lines", "sentence_ends", "short_words", "high_bytes")

_LETTER_UPPER = bytes(range(65, 91))
_DIGIT = b"0123456789"
_SYMBOL = b"#$%&*+/<=>@\\^_`{|}~!"
_BRACKET = b"()[]{}<>"
_ENDINGS = tuple(bytes([c]) for c in _SYMBOL)


def _count(text: bytes, of: bytes) -> int:
    return len(text) - len(text.translate(None, of))


def features(text: bytes) -> tuple[float, ...]:
    """One value per name in FEATURES; all zero for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * len(FEATURES)
    chars = sum(map(len, words))
    kinds = set(words)
    per: dict[bytes, int] = {}
    for w in words:
        per[w] = per.get(w, 0) + 1
    lines = [x for x in text.split(b"\n") if x]
    pairs = len(set(zip(words, words[1:]))) / (n - 1) if n > 1 else 1.0
    lengths = list(map(len, words))
    return (np.log1p(n), np.log1p(len(text)), chars / n, sum(x > 14 for x in lengths) / n, len(kinds) / n,
            max(per.values()) / n, sum(a == b for a, b in zip(words, words[1:])) / n, pairs,
            _count(text, _LETTER_UPPER) / chars, _count(text, _DIGIT) / chars, _count(text, _SYMBOL) / chars,
            sum(w.endswith(_ENDINGS) for w in words) / n, text.count(b"|") / n, _count(text, _BRACKET) / n,
            text.count(b",") / n, len(lines) / n, 1 - len(set(lines)) / len(lines) if lines else 0.0,
            _count(text, b".?") / n, sum(x <= 3 for x in lengths) / n,
            len(text.decode("utf-8", "replace")) / len(text))


def feature_matrix(texts: pa.Array) -> np.ndarray:
    rows = [features(t.as_py() or b"") for t in texts.cast(pa.binary())]
    return np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


@dataclass
class Model:
    """Bin edges and lookup tables; scoring is a sum of table entries."""

    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            out += table[np.searchsorted(edges, x[:, f], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            out += table[np.searchsorted(self.pair_edges[i], x[:, i], side="right"),
                         np.searchsorted(self.pair_edges[j], x[:, j], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _best_cut(g: np.ndarray, h: np.ndarray, least: float, ridge: float) -> tuple[float, int]:
    """(gain, cut) of the best split of a histogram; cut 0 if none."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    gain = np.where((hl >= least) & (hr >= least), gain, 0.0)
    if not len(gain) or gain.max() <= 1e-9:
        return 0.0, 0
    return float(gain.max()), int(gain.argmax()) + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray, rate: float, least: float, ridge: float) -> np.ndarray:
    """Two levels of splits over the bins of one feature, as a table."""
    out = np.zeros(len(g))
    _, cut = _best_cut(g, h, least, ridge)
    for lo, hi in ((0, cut), (cut, len(g))) if cut else ((0, len(g)),):
        _, inner = _best_cut(g[lo:hi], h[lo:hi], least, ridge) if cut else (0, 0)
        for a, b in ((lo, lo + inner), (lo + inner, hi)) if inner else ((lo, hi),):
            out[a:b] = -rate * g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, rate: float, least: float, ridge: float) -> tuple[float, np.ndarray]:
    """One split along the first axis and one along the second on either side (or the other way round)."""
    best = (0.0, np.zeros(g.shape))
    for turn in (False, True):
        gg, hh = (g.T, h.T) if turn else (g, h)
        for cut in range(1, gg.shape[0]):
            out, gain = np.zeros(gg.shape), 0.0
            for lo, hi in ((0, cut), (cut, gg.shape[0])):
                sg, sh = gg[lo:hi].sum(axis=0), hh[lo:hi].sum(axis=0)
                got, inner = _best_cut(sg, sh, least, ridge)
                gain += got + sg.sum() ** 2 / (sh.sum() + ridge)
                for a, b in ((0, inner), (inner, len(sg))) if inner else ((0, len(sg)),):
                    out[lo:hi, a:b] = -rate * sg[a:b].sum() / (sh[a:b].sum() + ridge)
            if gain > best[0]:
                best = (gain, out.T if turn else out)
    return best


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, pair_bins: int = 8, rounds: int = 120, pair_rounds: int = 40,
        n_pairs: int = 6, rate: float = 0.15, least: float = 2.0, ridge: float = 1.0) -> Model:
    """Cyclic boosting; a constant 0.5 without rows, a clipped prior with one class only."""
    width = x.shape[1]
    if not len(y):
        return Model([np.empty(0)] * width, 0.0, [np.zeros(1)] * width, [], [np.empty(0)] * width, [])
    prior = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = Model([_edges(x[:, f], bins) for f in range(width)], float(np.log(prior / (1 - prior))), [], [],
                  [_edges(x[:, f], pair_bins) for f in range(width)], [])
    spot = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    margin = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for f in range(width):
            g, h = slopes()
            n = len(model.tables[f])
            step = _shallow_tree(np.bincount(spot[f], g, n), np.bincount(spot[f], h, n), rate, least, ridge)
            model.tables[f] += step
            margin += step[spot[f]]

    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.pair_edges)]
    wide = [len(e) + 1 for e in model.pair_edges]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        cell = coarse[i] * wide[j] + coarse[j]
        shape = (wide[i], wide[j])
        return (np.bincount(cell, g, wide[i] * wide[j]).reshape(shape),
                np.bincount(cell, h, wide[i] * wide[j]).reshape(shape))

    gains = sorted(((_pair_tree(*grid(i, j), rate, least, ridge)[0], i, j) for i, j in combinations(range(width), 2)
                    if wide[i] > 1 and wide[j] > 1), reverse=True)
    model.pairs = [(i, j) for gain, i, j in gains[:n_pairs] if gain > 0]
    model.pair_tables = [np.zeros((wide[i], wide[j])) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(model.pairs):
            step = _pair_tree(*grid(i, j), rate, least, ridge)[1]
            model.pair_tables[k] += step
            margin += step[coarse[i], coarse[j]]
    return model


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from training: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")), F.lit(0)) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = MAX_TRAINING_ROWS, **how) -> Model:
    """Fit on the features of at most ``max_rows`` labelled rows outside the held-out fold, in the order of their ids' hashes."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
             .filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
             .orderBy(F.xxhash64("id"), "id", "y").limit(max_rows))
    # the sample has at most max_rows (id, label) pairs, so it may be broadcast
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(known), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = feature_matrix(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("id").cast(pa.string()), b.column("y").cast(pa.float64()), *(pa.array(c) for c in x.T)],
                names=["id", "y", *FEATURES])

    # an id can stand on any number of rows: the bound holds for what reaches the driver
    order = [F.xxhash64("id"), "id", "y", *FEATURES]
    sample = (rows.mapInArrow(run, "id string, y double, " + ", ".join(f"{f} double" for f in FEATURES))
              .orderBy(*order).limit(max_rows).toArrow())
    table = sample.sort_by([(c, "ascending") for c in ("id", "y", *FEATURES)])
    x = np.column_stack([table.column(f).to_numpy() for f in FEATURES]) if len(table) else np.empty((0, len(FEATURES)))
    return fit(x, table.column("y").to_numpy(), **how)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """id, held_out, score and predicted of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(feature_matrix(b.column(1))))],
                                             names=["id", "score"])

    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {field_type(docs, id_col)}, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                         (F.col("score") >= keep_at).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that score at least ``keep_at``, with all their columns; no shuffle."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.score(feature_matrix(b.column(at).cast(pa.string()))) >= keep_at))

    return docs.mapInArrow(run, docs.schema)
