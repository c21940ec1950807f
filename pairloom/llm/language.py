"""Language identification in two steps: the family first, then duels of the languages within it.

Texts become hashed counts of one to three letters, over the whole text. A softmax model predicts the family;
within it, a linear support vector machine for every pair of languages votes. Both are learnt from a sample of
labelled documents with a documented bound, features are made where the data is.

Both always name a learnt language. Whether a text is in it at all is told by its distance: how much less likely the
text's n-grams are, by the frequencies of that language in the sample, than those of the sample's own documents.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import set_aside
from pairloom.llm.hashing import mix, tidy

UNKNOWN = "und"
# The family of some languages. A language that isn't listed is a family of its own.
FAMILIES = {
    "af": "germanic", "da": "germanic", "de": "germanic", "en": "germanic", "is": "germanic", "nl": "germanic",
    "no": "germanic", "sv": "germanic",
    "ca": "romance", "es": "romance", "fr": "romance", "gl": "romance", "it": "romance", "pt": "romance", "ro": "romance",
    "be": "slavic", "bg": "slavic", "cs": "slavic", "hr": "slavic", "pl": "slavic", "ru": "slavic", "sk": "slavic",
    "sl": "slavic", "sr": "slavic", "uk": "slavic",
    "et": "uralic", "fi": "uralic", "hu": "uralic",
}
# Labelled documents to learn from, about, of each language and of all together; hashes of the ids choose them. Of more
# labels than this, the most frequent are learnt.
SAMPLE, SAMPLE_TOTAL = 1000, 8000
MOST_LANGUAGES = 200
DIMENSIONS = 2048
# Code points that are looked at in one go; n-grams across the cut are counted in the next piece.
PIECE = 1 << 20
MIN_SCORE = 0.25
# A text may be so many times as far from its language as all but this share of the sample, each document left out of
# the frequencies that it is compared with. Short texts may be farther by so many standard deviations of their length.
FAR, FAR_SHARE, FAR_DEVIATIONS = 3.0, 0.01, 4.0


def _letters() -> np.ndarray:
    """For each code point of the first plane: itself if a letter, else a space."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(1 << 16)], np.uint32)


def features(text: str, letters: np.ndarray, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, float] | None:
    """Square roots of hashed n-gram counts, of length one, and the sum of the counts; None for a text without letters."""
    counts = np.zeros(dimensions)
    low = text.lower()
    for begin in range(0, len(low), PIECE):
        points = np.frombuffer(low[max(begin - 2, 0) : begin + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        # Above the first plane, everything counts as a letter but what Python calls none.
        high = points > 0xFFFF
        points = np.where(high, points, letters[np.minimum(points, 0xFFFF)]).astype(np.uint32)
        if high.any():
            rare = [p for p in np.unique(points[high]) if not chr(p).isalpha()]
            points[np.isin(points, rare)] = 32
        points = points[np.append(True, (points[1:] != 32) | (points[:-1] != 32))].astype(np.uint64)
        for n in (1, 2, 3):
            gram = points[: len(points) - n + 1] if len(points) >= n else points[:0]
            for k in range(1, n):
                gram = gram << np.uint64(21) | points[k : len(points) - n + 1 + k]
            gram = gram[gram != 32] if n == 1 else gram
            slots = (mix(gram + np.uint64(n)) & np.uint64(dimensions - 1)).astype(np.int64)
            counts += np.bincount(slots, minlength=dimensions)
            if n == 1 and begin == 0 and len(low) <= PIECE and not len(gram):
                return None
    if not any(c.isalpha() for c in low):
        return None
    root = np.sqrt(counts)
    return root / np.linalg.norm(root), float(counts.sum())


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def _descend(gradient, shape: tuple, steps: int = 300, rate: float = 20.0) -> np.ndarray:
    """Accelerated gradient descent from zero."""
    w, v = np.zeros(shape), np.zeros(shape)
    for k in range(steps):
        step = w - rate * gradient(w)
        w, v = step + k / (k + 3) * (step - v), step
    return v


def _products(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``x`` times weights, whose last row is that of a feature that is always one. ``x`` is neither copied nor widened."""
    return (x @ w[:-1].astype(x.dtype)).astype(np.float64) + w[-1]


def _back(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """The transposed product, with the same last feature."""
    return np.concatenate([(x.T @ r.astype(x.dtype)).astype(np.float64), r.sum(axis=0, keepdims=True)])


def fit_softmax(x: np.ndarray, classes: np.ndarray, count: int, decay: float = 1e-5) -> np.ndarray:
    wanted = np.eye(count)[classes] / np.bincount(classes, minlength=count)[classes][:, None] / count

    def gradient(w):
        z = _products(x, w)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return _back(x, p * wanted.sum(axis=1, keepdims=True) - wanted) + decay * w

    return _descend(gradient, (x.shape[1] + 1, count))


def fit_svm(x: np.ndarray, sides: np.ndarray, decay: float = 1e-5) -> np.ndarray:
    """Linear support vector machine with squared hinge loss; both sides weigh the same."""
    weight = np.where(sides > 0, 0.5 / max((sides > 0).sum(), 1), 0.5 / max((sides < 0).sum(), 1))

    def gradient(w):
        slack = np.maximum(1 - sides * _products(x, w), 0)
        return -_back(x, sides * weight * slack) + decay * w

    return _descend(gradient, (x.shape[1] + 1,), rate=1.0)


class LanguageModel:
    """Families, the softmax between them, and the duels within each."""

    def __init__(self, x: np.ndarray, langs: list[str], families: dict[str, str]):
        self._calibrate(x, np.array(langs))
        names = sorted(set(langs))
        self.families: dict[str, list[str]] = {}
        for name in names:
            self.families.setdefault(families.get(name, name), []).append(name)
        kinds = sorted(self.families)
        langs = np.array(langs)
        self.kinds = kinds
        own = np.array([kinds.index(families.get(n, n)) for n in langs])
        self.between = fit_softmax(x, own, len(kinds)) if len(kinds) > 1 else np.zeros((x.shape[1] + 1, len(kinds)))
        self.duels = {}
        for a, b in (pair for members in self.families.values() for pair in combinations(members, 2)):
            rows = (langs == a) | (langs == b)
            self.duels[a, b] = fit_svm(x[rows], np.where(langs[rows] == a, 1.0, -1.0))

    def _calibrate(self, x: np.ndarray, langs: np.ndarray) -> None:
        """Logarithms of n-gram shares by language, and what they are like for the documents of the sample."""
        self.shares, self.typical, self.deviation, far = {}, {}, {}, []
        for lang in sorted(set(langs)):
            own = x[langs == lang].astype(np.float64) ** 2
            total = own.sum(axis=0) + 1 / x.shape[1]
            log = np.log(total / total.sum())
            # Each document by the shares of all others.
            alone = np.array([d @ np.log((total - d).clip(1e-12) / (total.sum() - d.sum())) for d in own])
            self.shares[lang], self.typical[lang] = log, float(np.median(alone))
            share = total / total.sum()
            self.deviation[lang] = float(np.sqrt(share @ (log - share @ log) ** 2))
            far.append(self.typical[lang] - alone)
        self.spread = max(float(np.quantile(np.concatenate(far), 1 - FAR_SHARE)), 0.0)

    def distances(self, x: np.ndarray, grams: np.ndarray, langs: list[str]) -> np.ndarray:
        """How far texts are from their languages, as a share of what is allowed; over 1 is too far."""
        below = np.array([self.typical[lang] - row**2 @ self.shares[lang] for row, lang in zip(x, langs)])
        # Three n-grams begin at each letter.
        short = np.array([self.deviation[lang] for lang in langs]) / np.sqrt(np.maximum(grams / 3, 1))
        return below.clip(0) / (FAR * self.spread + FAR_DEVIATIONS * short + 1e-9)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        z = _products(x, self.between)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        kind = p.argmax(axis=1)
        langs, scores = np.empty(len(x), object), p.max(axis=1)
        for k, name in enumerate(self.kinds):
            rows = np.flatnonzero(kind == k)
            members = self.families[name]
            if not len(rows):
                continue
            # Votes decide, margins between equal votes.
            won, margin = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            sure = np.ones((len(rows), len(members)))
            for i, j in combinations(range(len(members)), 2):
                m = _products(x[rows], self.duels[members[i], members[j]])
                won[:, i] += m > 0
                won[:, j] += m <= 0
                margin[:, i] += np.tanh(m)
                margin[:, j] -= np.tanh(m)
                sure[:, i] = np.minimum(sure[:, i], 1 / (1 + np.exp(-4 * m)))
                sure[:, j] = np.minimum(sure[:, j], 1 / (1 + np.exp(4 * m)))
            best = (won + margin / (4 * len(members))).argmax(axis=1)
            langs[rows] = [members[b] for b in best]
            scores[rows] *= sure[np.arange(len(rows)), best]
        return list(langs), np.clip(scores, 0, 1)


def _featured(rows: DataFrame, dimensions: int) -> DataFrame:
    @tidy
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = _letters()
        for batch in batches:
            found = [features(t, letters, dimensions) for t in batch["text"]]
            out = pd.DataFrame({"lang": batch["lang"], "x": [None if f is None else f[0].astype("<f4").tobytes() for f in found]})
            yield out[out["x"].notna()]

    return rows.mapInPandas(make, "lang string, x binary")


def fit_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
    families: dict[str, str] = FAMILIES,
    dimensions: int = DIMENSIONS,
    total: int = SAMPLE_TOTAL,
    most_languages: int = MOST_LANGUAGES,
) -> LanguageModel | None:
    """Learns from the labelled documents that aren't held out; None if there are none.

    Of each language, about ``sample`` documents are used, those with the smallest hashes of their ids, and of all together
    about ``total``. With more than ``most_languages`` labels, only the most frequent are learnt.
    """
    learn = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    learn = learn.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    learn = learn.where(~held_out("doc_id"))
    counts = learn.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    if not counts:
        return None
    share = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    each = min(sample, total // len(counts))
    limits = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], float(each / r["n"]))])
    chosen = learn.where(share < F.try_element_at(limits, "lang"))
    # Columns, not row objects: the features are the driver's only large array.
    found = _featured(chosen, dimensions).withColumn("key", F.xxhash64("x")).toArrow()
    if not found.num_rows:
        return None
    langs = found.column("lang").to_pylist()
    # Ordered, as sums of floating numbers depend on the order.
    order = sorted(range(len(langs)), key=list(zip(langs, found.column("key").to_pylist())).__getitem__)
    x, at = np.empty((len(langs), dimensions), np.float32), 0
    for part in found.column("x").chunks:
        for value in part:
            x[at] = np.frombuffer(value.as_buffer(), "<f4")
            at += 1
    del found
    return LanguageModel(x[order], [langs[k] for k in order], families)


def predict_languages(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``distance``; input columns with these names are replaced.

    Texts that are null or have no letter are ``und`` with score 0, as are all if nothing could be learnt. A distance
    over 1 says that the text is in none of the learnt languages.
    """
    @F.pandas_udf("lang_pred string, score double, distance double")
    @tidy
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = _letters()
        dimensions = model.between.shape[0] - 1 if model else DIMENSIONS
        for batch in texts:
            langs, scores = np.full(len(batch), UNKNOWN, object), np.zeros(len(batch))
            distances = np.full(len(batch), np.inf)
            for begin in range(0, len(batch) if model else 0, 256):
                part = [None if t is None else features(t, letters, dimensions) for t in batch.iloc[begin : begin + 256]]
                rows = [k for k, f in enumerate(part) if f is not None]
                if rows:
                    at = np.array(rows) + begin
                    x, grams = np.array([part[k][0] for k in rows]), np.array([part[k][1] for k in rows])
                    found, scores[at] = model.predict(x)
                    langs[at], distances[at] = found, model.distances(x, grams, found)
            yield pd.DataFrame({"lang_pred": langs, "score": scores, "distance": distances})

    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "distance")]
    docs, own = set_aside(docs)
    found = docs.withColumn("found", predict(F.col(own[text_col])))
    return found.select(*[F.col(own[c]).alias(c) for c in keep], "found.lang_pred", "found.score", "found.distance")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every document; null ids aren't held out."""
    model = fit_languages(docs, id_col, text_col, lang_col, **options)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return predict_languages(narrow, model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def keep_identified(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_score: float = MIN_SCORE, **options
) -> DataFrame:
    """The documents whose language is known with ``min_score`` at least, with their own columns.

    The least possible score depends on the number of families and languages, so a low ``min_score`` may reject nothing;
    texts in languages that weren't learnt and letters without sense go by their distance.
    """
    model = fit_languages(docs, id_col, text_col, lang_col, **options)
    columns = docs.columns
    docs, own = set_aside(docs)
    found = predict_languages(docs, model, own[text_col])
    good = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score) & (F.col("distance") <= 1))
    return good.drop("lang_pred", "score", "distance").toDF(*columns)
