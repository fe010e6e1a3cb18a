"""Language of texts by interpolated Kneser-Ney models over characters.

Training counts the character 4-grams of every labelled text in Spark. The counts of lower orders are
continuation counts, which follow from the 4-grams. Each language has one sorted array
of hashes and one of log probabilities per order. A text gets the language with the lowest
cross-entropy per character; calibration on rows that took no part in the counts turns
the lead over the second language into a probability, and gives the cross-entropy above which
a text is rejected as none of the languages.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from arbolytics.llm.common import bare, slices, texts_of
from arbolytics.llm.packed import positions
from arbolytics.llm.words import mix
from arbolytics.session import stage

ORDER = 4
#: Rows in the calibration sample, of the tenth of the labelled rows that is not counted.
CALIBRATION_ROWS = 3_000
#: Standard deviations above a language's usual cross-entropy that a text may have.
REJECT_AT = 12.0
UNKNOWN = "und"
BLANK = 1
SLICE_CHARS = 1_000_000
CACHE = 1_000_000


@lru_cache(maxsize=1)
def symbols() -> np.ndarray:
    """The 16-bit symbol of each code point: letters and marks are themselves, the rest is blank.

    Code points that need more than 16 bits share one symbol.
    """
    out = np.full(sys.maxunicode + 1, BLANK, np.uint16)
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] in "LM":
            out[c] = c if c < 0xFFFD else 0xFFFD
    return out


def packed_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram that ends at each symbol, and the texts' cuts. Runs of blanks are one blank.

    Each text starts after blanks; its own symbols follow, and one blank at its end.
    """
    table = symbols()
    joined = "\0".join(t.lower() for t in texts) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    marks = table[codes]
    ends = codes == 0
    if ends.sum() != len(texts):  # a text holds the character itself
        joined = "\0".join(t.replace("\0", " ").lower() for t in texts) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
        marks, ends = table[codes], codes == 0
    blank = marks == BLANK
    first = np.concatenate([[True], ends[:-1]])
    keep = ends | ~blank | ~(np.concatenate([[True], blank[:-1]]) | first)
    # The end of a text is a blank of its own, unless it has one.
    keep &= ~(blank & ~ends & np.concatenate([ends[1:], [True]]))
    marks, ends = marks[keep], ends[keep]
    cuts = np.concatenate([[0], np.flatnonzero(ends) + 1])
    place = np.arange(len(marks)) - np.repeat(cuts[:-1], np.diff(cuts))
    gram = marks.astype(np.uint64)
    for back in range(1, ORDER):
        earlier = np.full(len(marks), BLANK, np.uint64)
        earlier[back:] = marks[:-back] if len(marks) > back else earlier[back:]
        gram |= np.where(place >= back, earlier, np.uint64(BLANK)) << np.uint64(16 * back)
    return gram, cuts


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _low(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & np.uint64((1 << 16 * order) - 1)


@dataclass
class Table:
    """Sorted hashes with a value each."""

    hashes: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Table:
        hashes = mix(keys)
        order = np.argsort(hashes)
        return cls(hashes[order], values[order].astype(np.float32))

    def find(self, keys: np.ndarray, otherwise: np.ndarray | float) -> np.ndarray:
        at = positions(mix(keys), self.hashes)
        return np.where(at >= 0, self.values[at] if len(self.values) else 0, otherwise)


@dataclass
class Language:
    """Log probabilities of known n-grams and log back-off weights of known contexts, per order."""

    name: str
    probabilities: list[Table]
    weights: list[Table]
    unseen: float

    @classmethod
    def fit(cls, name: str, keys: np.ndarray, counts: np.ndarray) -> Language:
        """Interpolated Kneser-Ney from the counts of the highest order."""
        levels = [(keys, counts.astype(np.float64))]
        for order in range(ORDER - 1, 0, -1):
            low, continuations = np.unique(_low(levels[0][0], order), return_counts=True)
            levels.insert(0, (low, continuations.astype(np.float64)))
        probabilities, weights, below, below_keys = [], [], None, None
        uniform = 1.0 / (1 << 16)  # over all symbols there are
        unseen = 0.0
        for order, (grams, count) in enumerate(levels, 1):
            ones, twos = (count == 1).sum(), (count == 2).sum()
            discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5
            context, at = np.unique(grams >> np.uint64(16), return_inverse=True)
            total, kinds = np.bincount(at, count), np.bincount(at)
            weight = discount * kinds / total
            lower = uniform if order == 1 else below[np.searchsorted(below_keys, _low(grams, order - 1))]
            p = (count - discount) / total[at] + weight[at] * lower
            if order == 1:
                unseen = float(np.log(weight[0] * uniform))
            probabilities.append(Table.of(grams, np.log(p)))
            weights.append(Table.of(context, np.log(weight)))
            below, below_keys = p, grams
        return cls(name, probabilities, weights, unseen)

    def score(self, keys: np.ndarray) -> np.ndarray:
        """Log probability of the last symbol of each 4-gram after the ones before it."""
        out = self.probabilities[0].find(_low(keys, 1), self.unseen)
        for order in range(2, ORDER + 1):
            gram = _low(keys, order)
            out = self.probabilities[order - 1].find(gram, out + self.weights[order - 1].find(gram >> np.uint64(16), 0.0))
        return out


@dataclass
class Model:
    """All languages, with what calibration found."""

    languages: list[Language]
    usual: np.ndarray = field(default_factory=lambda: np.zeros((0, 3)))  # mean, variance of texts, variance of symbols
    lead: tuple[float, float] = (0.0, 1.0)
    reject_at: float = REJECT_AT
    _keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    _scores: np.ndarray | None = None

    def _known(self, keys: np.ndarray) -> np.ndarray:
        """Scores of distinct ascending 4-grams in each language; those seen before come from a bounded cache."""
        if self._scores is None or len(self._keys) > CACHE:
            self._keys, self._scores = np.empty(0, np.uint64), np.empty((0, len(self.languages)), np.float32)
        at = positions(keys, self._keys)
        new = keys[at < 0]
        if len(new):
            scores = np.stack([x.score(new) for x in self.languages], 1).astype(np.float32)
            merged = np.concatenate([self._keys, new])
            order = np.argsort(merged, kind="stable")
            self._keys, self._scores = merged[order], np.concatenate([self._scores, scores])[order]
            at = positions(keys, self._keys)
        return self._scores[at]

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per symbol of each text in each language, and the texts' numbers of symbols."""
        grams, cuts = packed_grams(texts)
        keys, at = np.unique(grams, return_inverse=True)
        known = self._known(keys)
        sizes = np.diff(cuts)
        total = np.stack([np.add.reduceat(known[:, k][at].astype(np.float64), cuts[:-1]) for k in range(len(self.languages))], 1)
        return -total / sizes[:, None], sizes

    def decide(self, entropies: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its probability, whether it is rejected, and its cross-entropy."""
        best = entropies.argmin(1)
        lowest = entropies[np.arange(len(best)), best]
        lead = self._lead(entropies, best) * np.sqrt(sizes)
        score = 1 / (1 + np.exp(-np.clip(self.lead[0] + self.lead[1] * lead, -30, 30)))
        rejected = np.zeros(len(best), bool)
        if len(self.usual):
            mean, texts, symbols_ = self.usual[best].T
            rejected = lowest > mean + self.reject_at * np.sqrt(texts + symbols_ / sizes)
        return best, score, rejected, lowest

    def calibrate(self, entropies: np.ndarray, sizes: np.ndarray, names: list[str]) -> None:
        """Fits the probability of a lead and the usual cross-entropies on labelled texts."""
        index = {x.name: k for k, x in enumerate(self.languages)}
        usual = np.tile([2.0, 0.25, 4.0], (len(self.languages), 1))  # with too few rows to calibrate
        if names:
            truth = np.array([index.get(n, -1) for n in names])
            best, _, _, _ = self.decide(entropies, sizes)
            for k in range(len(self.languages)):
                mine, n = entropies[(truth == k) & (best == k), k], sizes[(truth == k) & (best == k)]
                if len(mine) >= 20:
                    weight = np.minimum(n, 1000)
                    mean = np.average(mine, weights=weight)
                    off = (mine - mean) ** 2
                    # Variance between texts plus that of symbols over the length, by least squares, each with a floor.
                    slope, base = np.polyfit(1 / n, off, 1, w=weight ** 0.5) if len(np.unique(n)) > 1 else (4.0, off.mean())
                    usual[k] = mean, max(base, 0.1 ** 2), max(slope, 4.0)
            self.lead = _logistic(self._lead(entropies, best) * np.sqrt(sizes), (best == truth).astype(float))
        self.usual = usual

    @staticmethod
    def _lead(entropies: np.ndarray, best: np.ndarray) -> np.ndarray:
        """How far the second language is behind the best; 1 if there is no second."""
        rows = np.arange(len(best))
        others = entropies.copy()
        others[rows, best] = np.inf
        second = others.min(1)
        return np.where(np.isfinite(second), second - entropies[rows, best], 1.0)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic fit with a weak prior (Newton steps)."""
    scale = x.std() or 1.0
    design, w = np.stack([np.ones(len(x)), x / scale], 1), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (y - p) - 0.1 * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        w = w + np.linalg.solve(curve, grad)
    return float(w[0]), float(max(w[1], 1e-3) / scale)


def held_out(doc_id: Column) -> Column:
    """Rows kept out of training: the remainder of the id's CRC is 1. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the 4-grams of each language, summed over all that a task reads."""
    sums: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def squeeze(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return [(keys, np.bincount(at, np.concatenate([c for _, c in parts])).astype(np.int64))]

    for batch in batches:
        texts, langs = texts_of(batch.column("text")), batch.column("lang").to_pylist()
        for lang in dict.fromkeys(langs):
            mine = [t for t, x in zip(texts, langs, strict=True) if x == lang and t]
            for a, b in slices(mine, SLICE_CHARS):
                sums.setdefault(lang, []).append(np.unique(packed_grams(mine[a:b])[0], return_counts=True))
                if len(sums[lang]) > 8:
                    sums[lang] = squeeze(sums[lang])
    for lang, parts in sums.items():
        keys, counts = squeeze(parts)[0]
        for a in range(0, len(keys), 100_000):
            n = len(keys[a:a + 100_000])
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * n, pa.string()), "gram": keys[a:a + n].view(np.int64), "n": counts[a:a + n]})


def train(df: DataFrame, learn: Column | None = None, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          calibration_rows: int = CALIBRATION_ROWS) -> Model:
    """A model from the rows with a text and a language (and ``learn``, a condition on ``doc_id``).

    All rows are counted but a tenth (by a hash of the id), of which ``calibration_rows`` rows calibrate.
    Discounts and lower orders follow from all n-grams of a language, and all are kept: the tables are fitted on the
    driver one language after the other and broadcast whole, so memory follows the distinct n-grams.
    """
    rows = bare(df, doc_id=id_col, text=text_col, lang=lang_col).select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string"))
    rows = rows.filter("text is not null and lang is not null")
    if learn is not None:
        rows = rows.filter(learn)
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("calibration"))
    counts = (rows.filter(F.pmod(order, F.lit(10)) != 0).select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    counts = stage(counts, "language-counts")
    languages = []
    for lang in sorted(r.lang for r in counts.select("lang").distinct().collect()):
        found = counts.filter(F.col("lang") == lang).select("gram", "n").toArrow()
        keys = found.column("gram").to_numpy().view(np.uint64)
        at = np.argsort(keys)
        languages.append(Language.fit(lang, keys[at], found.column("n").to_numpy()[at]))
    model = Model(languages)
    if languages:
        shared = df.sparkSession.sparkContext.broadcast(model)

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, langs = texts_of(batch.column("text")), batch.column("lang").to_pylist()
                at = [i for i, t in enumerate(texts) if has_letter(t)]
                for a, b in slices([texts[i] for i in at], SLICE_CHARS):
                    entropies, sizes = shared.value.cross_entropies([texts[i] for i in at[a:b]])
                    yield pa.RecordBatch.from_pydict({"lang": [langs[i] for i in at[a:b]], "h": list(entropies), "n": sizes})

        # The smallest hashes are found without texts; their rows are then measured where they lie.
        tenth = rows.withColumn("o", order).filter(F.pmod("o", F.lit(10)) == 0)
        last = tenth.select("o").orderBy("o").limit(calibration_rows).agg(F.max("o")).first()[0]
        found = tenth.filter(F.col("o") <= F.lit(last)).select("text", "lang").mapInArrow(measure, "lang string, h array<double>, n long").collect()
        model.calibrate(np.array([r.h for r in found]).reshape(-1, len(languages)), np.array([r.n for r in found]), [r.lang for r in found])
    return model


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, rejection and cross-entropy of each text."""
    n = len(texts)
    names, scores, rejected, lowest = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool), np.full(n, np.nan)
    known = [i for i, t in enumerate(texts) if t and has_letter(t)] if model.languages else []
    for a, b in slices([texts[i] for i in known], SLICE_CHARS):
        part = known[a:b]
        best, score, no, entropy = model.decide(*model.cross_entropies([texts[i] for i in part]))
        for i, k in zip(part, best, strict=True):
            names[i] = model.languages[k].name
        scores[part], rejected[part], lowest[part] = score, no, entropy
    return names, scores, rejected, lowest


def language_column(df: DataFrame, model: Model, text: Column) -> Column:
    """A struct column: lang_pred, score, rejected, cross_entropy.

    ``lang_pred`` is ``und`` with score 0, and rejected, if the text is null or has no letter (or no
    language was learned). A rejected text keeps its nearest language. Texts are scored whole.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean, cross_entropy double")
    def run(texts: pd.Series) -> pd.DataFrame:
        names, scores, rejected, lowest = predict(shared.value, list(texts))
        return pd.DataFrame({"lang_pred": names, "score": scores, "rejected": rejected, "cross_entropy": lowest})

    return run(text)


def identify(df: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, lang_pred, score, rejected and cross_entropy of every row; the model is trained on the same table.

    Rows may repeat, ids and labels may be null, extra columns are left out, an empty table gives none.
    """
    model = train(df, learn, text_col, lang_col, id_col)
    rows = bare(df, doc_id=id_col, text=text_col)
    return rows.select("doc_id", language_column(rows, model, F.col("text").cast("string")).alias("r")).select("doc_id", "r.*")
