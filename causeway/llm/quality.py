"""Quality rules (operator 7): document statistics, fixed base rules, and boosted trees over the statistics.

The statistics are computed on whole texts with numpy, a chunk of texts at a time. The trees are fitted on the driver to at
most ``SAMPLE`` labelled rows, with histograms, logistic loss and monotonic constraints (more symbols, repeats, capitals,
exclamation marks or table bars never raise a document's score). They are flattened into arrays of nodes, so that scoring
walks all rows of a batch down all trees at once.

Defined results: a null text counts as empty, has no words and fails the base rules, as an empty one does. Each row is judged
by itself: repeated rows and ids get repeated verdicts, null ids stay null. Very long texts are read whole. An empty table
gives no rows. Without labelled rows of both kinds the base rules decide alone. Labels that are null are not used, and of
several for one document each counts. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, textvec

#: Labelled rows that the trees are fitted to, those of smallest hash.
SAMPLE = 20_000
MIN_WORDS = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim", "n_bars", "n_digits", "n_chars")
#: Features and their constraints: -1, the score must not rise with the feature; 0, free.
FEATURES = {"symbols": -1, "dup_lines": -1, "repeats": -1, "upper": -1, "exclaims": -1, "bars": -1, "digits": -1, "word_length": 0, "log_words": 0, "line_words": 0}


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOLS, _UPPER, _DIGITS = _flags(b"#*$%&|<>"), _flags(bytes(range(65, 91))), _flags(b"0123456789")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(flags)
    return np.diff(np.searchsorted(at, offsets))


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of keys that occur twice or more, and of those equal to an earlier one."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = s[1:] == s[:-1]
    again, several = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    several[order[1:][same]] = True
    several[order[:-1][same]] = True
    return several, again


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """COUNTS of each text of a chunk, one row per text."""
    n = len(offsets) - 1
    start, end, owner = textvec.word_bounds(data, offsets)
    slices = textvec.Slices(data)
    words = slices.hash(start, end)
    n_words = np.bincount(owner, minlength=n)
    lead = (data & 0xC0) != 0x80
    visible = lead & ~textvec.SPACE[data]

    triples, at = textvec.windows(words, owner, 3)
    several, _ = _repeated(textvec.mix(triples + owner[at].astype(np.uint64)))
    covered = np.zeros(len(words) + 2, bool)
    for k in range(3):
        covered[at[several] + k] = True
    repeat_words = np.bincount(owner[covered[: len(words)]], minlength=n)

    a, b, of = textvec.line_bounds(data, offsets)
    full = np.searchsorted(start, b) > np.searchsorted(start, a)
    a, b, of = a[full], b[full], of[full]
    _, again = _repeated(textvec.mix(slices.hash(a, b) + of.astype(np.uint64)))
    return np.stack(
        [
            n_words, _per_text(visible, offsets), _per_text(_SYMBOLS[data], offsets), np.bincount(of[again], minlength=n), repeat_words,
            np.bincount(of, minlength=n), _per_text(_UPPER[data], offsets), _per_text(data == 33, offsets), _per_text(data == 124, offsets),
            _per_text(_DIGITS[data], offsets), _per_text(lead, offsets),
        ],
        1,
    ).astype(np.int64)


def features(c: np.ndarray) -> np.ndarray:
    c = dict(zip(COUNTS, c.T.astype(np.float64)))
    words, chars, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_chars"], 1), np.maximum(c["n_lines"], 1)
    return np.stack(
        [
            c["n_symbols"] / words, c["n_dup_lines"] / lines, c["n_repeat_words"] / words, c["n_upper"] / chars, c["n_exclaim"] / words, c["n_bars"] / words,
            c["n_digits"] / chars, c["word_chars"] / words, np.log1p(c["n_words"]), c["n_words"] / lines,
        ],
        1,
    )


def base_failed(c: np.ndarray) -> np.ndarray:
    return (c[:, 0] < MIN_WORDS) | (100 * c[:, 4] > 50 * c[:, 0])


class Trees:
    """Boosted regression trees for a probability, as flat arrays of nodes."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, least: float = 5.0, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.least, self.ridge = trees, depth, rate, bins, least, ridge

    def fit(self, x: np.ndarray, y: np.ndarray, monotone: np.ndarray) -> Trees:
        n, m = x.shape
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1], method="lower")) for j in range(m)]
        binned = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(m)], 1)
        rate = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.start = float(np.log(rate / (1 - rate)))
        score = np.full(n, self.start)
        feature, threshold, left, right, value, roots = [], [], [], [], [], []

        def node(rows: np.ndarray, depth: int, low: float, high: float) -> int:
            at = len(feature)
            g, h = grad[rows].sum(), hess[rows].sum()
            for out, v in ((feature, 0), (threshold, 0.0), (left, at), (right, at), (value, self.rate * float(np.clip(g / (h + self.ridge), low, high)))):
                out.append(v)
            if not depth or len(rows) < 2 * self.least:
                return at
            best, gain = None, 1e-6 + g * g / (h + self.ridge)
            for j in range(m):
                if not len(edges[j]):
                    continue
                b = binned[rows, j]
                size = len(edges[j]) + 1
                gl, hl, nl = (np.cumsum(np.bincount(b, w, size))[:-1] for w in (grad[rows], hess[rows], None))
                gr, hr, nr = g - gl, h - hl, len(rows) - nl
                vl, vr = np.clip(gl / (hl + self.ridge), low, high), np.clip(gr / (hr + self.ridge), low, high)
                gains = 2 * (gl * vl + gr * vr) - (hl + self.ridge) * vl * vl - (hr + self.ridge) * vr * vr
                gains[(nl < self.least) | (nr < self.least) | (monotone[j] * (vr - vl) < 0)] = -np.inf
                k = int(gains.argmax())
                if gains[k] > gain:
                    best, gain = (j, k, vl[k], vr[k]), gains[k]
            if best is None:
                return at
            j, k, vl, vr = best
            mid = (vl + vr) / 2
            bounds = {0: ((low, high), (low, high)), -1: ((mid, high), (low, mid)), 1: ((low, mid), (mid, high))}[int(monotone[j])]
            feature[at], threshold[at] = j, float(edges[j][k])
            below = binned[rows, j] <= k
            left[at] = node(rows[below], depth - 1, *bounds[0])
            right[at] = node(rows[~below], depth - 1, *bounds[1])
            return at

        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            roots.append(node(np.arange(n), self.depth, -4.0, 4.0))
            self._flatten(feature, threshold, left, right, value, roots)
            score += self.value[self._leaves(x, self.roots[-1:])][:, 0]
        return self

    def _flatten(self, feature, threshold, left, right, value, roots) -> None:
        self.feature, self.threshold, self.value = np.array(feature), np.array(threshold), np.array(value)
        self.child, self.roots = np.array([right, left]), np.array(roots)

    def _leaves(self, x: np.ndarray, roots: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(roots, (len(x), len(roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):  # a leaf is its own child
            at = self.child[(x[rows, self.feature[at]] <= self.threshold[at]).astype(np.int8), at]
        return at

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.start - self.value[self._leaves(x, self.roots)].sum(1)))


class Judge:
    """Trees and the score from which a document is kept."""

    def __init__(self, x: np.ndarray, y: np.ndarray, loss: float = 0.002):
        self.trees = Trees().fit(x, y, np.array(list(FEATURES.values())))
        #: At most ``loss`` of the good documents it was fitted to fall below.
        self.threshold = min(0.5, float(np.quantile(self.trees.score(x[y == 1]), loss, method="lower")))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.trees.score(x) >= self.threshold


def _counted(batches, at: int = 1):
    """Batches and the counts of the texts in column ``at``, a chunk at a time."""
    for batch in batches:
        for i, data, offsets in common.text_chunks(batch.column(at)):
            yield batch.slice(i, len(offsets) - 1), counts(data, offsets)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Judge | None:
    """A judge fitted to ``sample`` labelled documents; None without labels of both kinds."""
    chosen = labels.select("doc_id", F.col("quality").cast("double").alias("y")).where("y in (0, 1) and doc_id is not null")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("y", "text")

    def run(batches):
        for batch, c in _counted(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(features(c)), pa.list_(pa.float64()))], ["y", "x"])

    # ids may repeat, so there may be more rows than labels: those of smallest hash are taken
    found = rows.mapInArrow(run, "y double, x array<double>").orderBy(F.xxhash64("y", "x"), "y", "x").limit(sample).toPandas()
    if found.y.nunique() < 2:
        return None
    order = np.lexsort((found.y.to_numpy(), *np.array([*found.x]).T))
    return Judge(np.array([*found.x])[order], found.y.to_numpy()[order])


def judge(docs: DataFrame, labels: DataFrame | None, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every document."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample) if labels is not None else None)

    def run(batches):
        for batch, c in _counted(batches):
            failed = base_failed(c)
            kept = ~failed if model.value is None else ~failed & model.value(features(c))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c[:, k]) for k in range(5)), pa.array(failed), pa.array(kept)], ["doc_id", *COUNTS[:5], "base_failed", "kept"])

    schema = "doc_id bigint, " + ", ".join(f"{k} bigint" for k in COUNTS[:5]) + ", base_failed boolean, kept boolean"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame | None, sample: int = SAMPLE) -> DataFrame:
    """The documents that are kept, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample) if labels is not None else None)
    at = common.place_of(docs, "text")

    def run(batches):
        for batch, c in _counted(batches, at):
            kept = ~base_failed(c)
            if model.value is not None:
                kept &= model.value(features(c))
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
