"""Language identification (operator 6): interpolated Kneser-Ney character models.

One model of order 4 per language is fitted on the driver to a bounded sample (at most ``DOCS`` labelled documents and
``CHARS`` characters a language). The models are stored together: for each order, a sorted array of n-gram hashes with one
column of log probabilities per language, and a sorted array of context hashes with the log weights of backing off. A text's
cross-entropy in every language is a few binary searches per character; the lowest, divided by the number of characters, wins.

A fifth of the sample is held back to calibrate: the sharpness of the score, and for each language the cross-entropy
above which a text is rejected as none of the languages.

Defined results: a null text, and one without any letter, is ``und`` with score 0 and rejected. Ties go to the language that
sorts first. Repeated rows and ids get repeated results; null ids are not held out and never learned from, as are null
languages. Very long texts are scored whole. Without anything to learn from, all is ``und``. An empty table gives no rows.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common, pretok
from .textvec import mix

ORDER = 4
#: Bounds of the sample for each language.
DOCS, CHARS = 400, 1_500_000
#: Nats by which a text's cross-entropy may exceed the highest usual one of its language.
MARGIN = 1.25
BLANK = 32

_folded: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """Each code point as a 16-bit symbol: letters and marks in lower case, all else blank."""
    if not _folded:
        import unicodedata

        out = np.zeros(0x110000, np.uint16)
        out[:] = np.arange(0x110000) & 0xFFFF
        for c in range(0x10000):
            ch = chr(c)
            low = ch.lower()
            out[c] = (ord(low) if len(low) == 1 and ord(low) < 0x10000 else c) if unicodedata.category(ch)[0] in "LM" else BLANK
        astral = pretok.class_table()[0x10000:] != pretok.L
        out[0x10000:][astral] = BLANK
        _folded.append(out)
    return _folded[0]


def symbols(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded symbols of a chunk with ORDER - 1 blanks before each text, the positions to score, and the text of each."""
    pad = ORDER - 1
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    out = np.full(len(points) + pad * (len(offsets) - 1), BLANK, np.uint16)
    at = np.arange(len(points)) + pad * (owner + 1)
    out[at] = fold_table()[points]
    wanted = (out[at] != BLANK) | (out[at - 1] != BLANK) if len(at) else np.zeros(0, bool)
    return out, at[wanted], owner[wanted]


def grams(x: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Packed n-grams that end at positions ``at``."""
    key = np.zeros(len(at), np.uint64)
    for k in range(n):
        key = (key << np.uint64(16)) | x[at - (n - 1) + k].astype(np.uint64)
    return key


def hashed(packed: np.ndarray, n: int) -> np.ndarray:
    return mix(packed + np.uint64(n << 56))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Model:
    """languages; for each order n: grams[n] and logp[n], contexts[n] and backoff[n] (of the n-1 symbols before the last)."""

    def __init__(self, texts: dict[str, list[np.ndarray]]):
        """``texts``: for each language the pairs of symbols and positions of its texts, see ``symbols``."""
        self.languages = sorted(texts)
        orders = range(1, ORDER + 1)
        raw = {lang: np.unique(np.concatenate([grams(x, at, ORDER) for x, at in texts[lang]]), return_counts=True) for lang in self.languages}
        counts: dict[str, dict[int, tuple[np.ndarray, np.ndarray]]] = {}
        for lang, (keys, n) in raw.items():
            own = {ORDER: (keys, n.astype(np.float64))}
            for k in range(ORDER - 1, 0, -1):  # of how many symbols each shorter gram is a continuation
                shorter = own[k + 1][0] & np.uint64((1 << 16 * k) - 1)
                keys, n = np.unique(shorter, return_counts=True)
                own[k] = keys, n.astype(np.float64)
            counts[lang] = own
        alphabet = len(np.unique(np.concatenate([counts[lang][1][0] for lang in self.languages]))) + 1
        self.floor = np.zeros(len(self.languages))
        self.grams, self.logp, self.contexts, self.backoff = {}, {}, {}, {}
        lower = None
        for k in orders:
            keys = np.unique(np.concatenate([counts[lang][k][0] for lang in self.languages]))
            contexts = np.unique(keys >> np.uint64(16))
            p = np.zeros((len(keys), len(self.languages)))
            gamma = np.ones((len(contexts), len(self.languages)))
            for j, lang in enumerate(self.languages):
                own, n = counts[lang][k]
                n1, n2 = (n == 1).sum(), (n == 2).sum()
                discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
                at = np.searchsorted(contexts, own >> np.uint64(16))
                total = np.bincount(at, n, len(contexts))
                kinds = np.bincount(at, minlength=len(contexts))
                seen = total > 0
                gamma[seen, j] = discount * kinds[seen] / total[seen]
                p[np.searchsorted(keys, own), j] = (n - discount) / total[at]
            of = np.searchsorted(contexts, keys >> np.uint64(16))
            if lower is None:
                base = np.full((len(keys), len(self.languages)), 1 / alphabet)
                self.floor = np.log(gamma[0] / alphabet)
            else:
                base = lower[1][np.searchsorted(lower[0], keys & np.uint64((1 << 16 * (k - 1)) - 1))]
            p += gamma[of] * base
            lower = keys, p
            for name, raw_keys, value in (("grams", keys, p), ("contexts", contexts, gamma)):
                h = hashed(raw_keys, k)
                order = np.argsort(h)
                getattr(self, name)[k] = h[order]
                {"grams": self.logp, "contexts": self.backoff}[name][k] = np.log(value[order]).astype(np.float32)

    def log_probabilities(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A row per position, a column per language."""
        out = np.zeros((len(at), len(self.languages)), np.float32)
        rows = np.arange(len(at))
        for k in range(ORDER, 0, -1):
            here = grams(x, at[rows], k)
            found, hit = _find(self.grams[k], hashed(here, k))
            out[rows[hit]] += self.logp[k][found[hit]]
            rows, here = rows[~hit], here[~hit]
            if not len(rows):
                return out
            if k > 1:
                found, hit = _find(self.contexts[k], hashed(here >> np.uint64(16), k))
                out[rows[hit]] += self.backoff[k][found[hit]]
        out[rows] += self.floor.astype(np.float32)
        return out

    def cross_entropy(self, points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Nats per scored character of each text in each language; infinite where there is none."""
        n = len(offsets) - 1
        x, at, owner = symbols(points, offsets)
        bounds = np.searchsorted(owner, np.arange(n + 1))
        total = np.zeros((n, len(self.languages)))
        step = max(1, 2_000_000 // len(self.languages))
        for a in range(0, len(at), step):
            logp = self.log_probabilities(x, at[a : a + step]).astype(np.float64)
            own = owner[a : a + step]
            begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            total[own[begin]] -= np.add.reduceat(logp, begin, axis=0)
        size = np.diff(bounds)[:, None]
        return np.where(size > 0, total / np.maximum(size, 1), np.inf)


def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return points, np.cumsum([0, *map(len, texts)])


class Identifier:
    """A model with its calibration."""

    def __init__(self, rows: list[tuple[str, str]]):
        """``rows``: (language, text), in an order that does not depend on the cluster."""
        usable = [(lang, text) for lang, text in rows if any(map(str.isalpha, text))]
        by: dict[str, list[str]] = {}
        for lang, text in usable:
            by.setdefault(lang, []).append(text)
        kept = {lang: [t for i, t in enumerate(own) if i % 5 or len(own) < 10] for lang, own in by.items()}
        held = [(lang, t) for lang, own in by.items() for i, t in enumerate(own) if not (i % 5 or len(own) < 10)]
        self.model = Model({lang: [symbols(*_flat(own))[:2]] for lang, own in kept.items()})
        self.sharpness = 25.0
        names = self.model.languages
        self.most = np.full(len(names), np.inf)
        if held:
            entropy = self.model.cross_entropy(*_flat([t for _, t in held]))
            truth = np.array([names.index(lang) for lang, _ in held])
            grid = [5.0, 10.0, 25.0, 50.0, 100.0]
            self.sharpness = min(grid, key=lambda k: -np.log(np.maximum(self._share(entropy, k)[np.arange(len(truth)), truth], 1e-9)).sum())
            for j in range(len(names)):
                own = entropy[truth == j, j]
                if len(own):
                    self.most[j] = np.quantile(own, 0.999) + MARGIN

    @staticmethod
    def _share(entropy: np.ndarray, sharpness: float) -> np.ndarray:
        e = np.exp(-sharpness * (entropy - entropy.min(1, keepdims=True)))
        return e / e.sum(1, keepdims=True)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text of a chunk."""
        _, points, offsets = common.codepoints(data, offsets)
        letters = np.diff(np.searchsorted(np.flatnonzero(pretok.class_table()[points] == pretok.L), offsets)) > 0
        entropy = self.model.cross_entropy(points, offsets)
        entropy[~letters] = 0
        best = entropy.argmin(1)
        score = np.where(letters, self._share(entropy, self.sharpness).max(1), 0.0)
        rejected = ~letters | (entropy[np.arange(len(best)), best] > self.most[best])
        names = self.model.languages
        return [names[k] if ok else "und" for k, ok in zip(best.tolist(), letters.tolist())], score, rejected


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, docs_each: int = DOCS, chars_each: int = CHARS) -> Identifier | None:
    """An identifier learned from a bounded sample of the rows that are not held out; None without such rows."""
    known = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    rows = docs.where(known & ~held_out()).select(F.col("doc_id").alias("id"), "lang", F.substring("text", 1, chars_each).alias("text"), F.xxhash64("doc_id").alias("hash"))
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    scale = 1 << 40
    share = F.create_map(*(x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(scale, scale * docs_each * 2 // n)))))
    near = rows.where(F.pmod("hash", F.lit(scale)) < share[F.col("lang")])  # about twice as many as wanted; repeated ids may make them many more
    order = [F.pmod("hash", F.lit(scale)), F.col("hash"), F.col("id"), F.col("text")]
    first = Window.partitionBy("lang").orderBy(*order)
    chosen = near.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= docs_each).withColumn("before", F.sum(F.length("text")).over(first.rowsBetween(Window.unboundedPreceding, -1)))
    chosen = chosen.where(F.coalesce("before", F.lit(0)) < chars_each)
    by: dict[str, list[str]] = {}
    for row in sorted(chosen.select("lang", "nth", "text").collect(), key=lambda r: (r["lang"], r["nth"])):  # at most twice chars_each a language
        by.setdefault(row["lang"], []).append(row["text"])
    if not any(any(map(str.isalpha, t)) for own in by.values() for t in own):
        return None
    return Identifier([(lang, t) for lang in sorted(by) for t in by[lang]])


def _none(offsets: np.ndarray):
    n = len(offsets) - 1
    return ["und"] * n, np.zeros(n), np.ones(n, bool)


def identify(docs: DataFrame, model: Identifier | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for i, data, offsets in common.text_chunks(batch.column(2)):
                lang, score, rejected = shared.value(data, offsets) if shared.value else _none(offsets)
                n = len(lang)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), batch.column(1).slice(i, n), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: Identifier | None) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = common.place_of(docs, "text")

    def run(batches):
        for batch in batches:
            for i, data, offsets in common.text_chunks(batch.column(at)):
                rejected = (shared.value(data, offsets) if shared.value else _none(offsets))[2]
                yield batch.slice(i, len(rejected)).filter(pa.array(~rejected))

    return docs.mapInArrow(run, docs.schema)
