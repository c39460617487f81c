"""Language identification by hierarchical discrimination: family first, then languages one against one."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartframes.llm.common import give_back, labelled_sample, take

#: Families of languages that are close to each other; any other language is a family of its own.
FAMILIES = {
    "da": "germanic", "de": "germanic", "en": "germanic", "nl": "germanic", "no": "germanic", "sv": "germanic",
    "ca": "romance", "es": "romance", "fr": "romance", "it": "romance", "pt": "romance", "ro": "romance",
    "bg": "slavic", "cs": "slavic", "pl": "slavic", "ru": "slavic", "sk": "slavic", "uk": "slavic",
}
UNKNOWN = "und"
#: Score below which a text counts as in no learned language: the confidence of even odds.
LEAST_SCORE = 0.5
#: Hashed features of a text, and documents that the fit reads at most (in equal shares of the languages).
WIDTH = 4096
SAMPLE_ROWS = 2000
SLICE = 1 << 20

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def features(text: str) -> np.ndarray | None:
    """Unit vector of square roots of hashed counts of 1 to 3 letters, runs of other characters as one blank.

    None if no letter is in the text. A long text is counted in slices of ``SLICE`` characters.
    """
    counts = np.zeros(WIDTH, np.int64)
    found = False
    for at in range(0, len(text), SLICE):
        codes = np.frombuffer(text[at : at + SLICE].lower().encode("utf-32-le", "replace"), np.uint32)
        letter = _letters()[codes]
        if not letter.any():
            continue
        found = True
        codes = np.where(letter, codes, 32)[letter | np.r_[True, letter[:-1]]].astype(np.uint64)
        gram = codes.copy()
        for n in range(3):
            if n:
                gram = gram[:-1] * np.uint64(0x100000001B3) + codes[n:]
            mixed = (gram + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            counts += np.bincount((mixed >> np.uint64(52)).astype(np.int64), minlength=WIDTH)
    if not found:
        return None
    vector = np.sqrt(counts).astype(np.float32)
    return vector / np.linalg.norm(vector)


def svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 150) -> tuple[np.ndarray, float, float]:
    """A linear SVM (squared hinge, accelerated gradient) for y = ±1: weights, bias, slope of its confidence.

    The last column of ``x`` is 1.
    """
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    ahead, t = w.copy(), 1.0
    for _ in range(rounds):
        short = np.maximum(0, 1 - y * (x @ ahead))
        gradient = penalty * ahead - 2 * (x.T @ (share * y * short))
        new, t_new = ahead - gradient / (4 + penalty), (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    margin, slope = y * (x @ w), 1.0
    for _ in range(30):  # a logistic fit of one parameter, by damped Newton steps
        p = 1 / (1 + np.exp(-np.clip(slope * margin, -30, 30)))
        slope += np.clip((share @ ((1 - p) * margin) - 1e-3 * slope) / (share @ (p * (1 - p) * margin**2) + 1e-3), -2, 2)
    return w[:-1], float(w[-1]), float(max(slope, 0.1))


class Model:
    """One-versus-one machines between families, and between the languages of each family."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, families: Mapping[str, str]):
        self.languages = sorted(set(labels))
        family = np.array([families.get(v, v) for v in labels])
        self.members = {f: sorted(set(labels[family == f])) for f in sorted(set(family))}
        self.levels = {"": (list(self.members), self._fit(x, family))}
        for name, members in self.members.items():
            rows = family == name
            self.levels[name] = (members, self._fit(x[rows], labels[rows]))

    @staticmethod
    def _fit(x: np.ndarray, labels: np.ndarray) -> list[tuple[int, int, np.ndarray, float, float]]:
        names = sorted(set(labels))
        out = []
        for (i, a), (j, b) in combinations(enumerate(names), 2):
            rows = (labels == a) | (labels == b)
            out.append((i, j, *svm(x[rows], np.where(labels[rows] == a, 1, -1).astype(np.float32))))
        return out

    def _choose(self, level: str, x: np.ndarray) -> tuple[str, float]:
        names, machines = self.levels[level]
        total = np.zeros(len(names))
        for i, j, w, bias, slope in machines:
            p = 1 / (1 + np.exp(-np.clip(slope * (float(x @ w) + bias), -30, 30)))
            total[i] += p
            total[j] += 1 - p
        best = int(total.argmax())
        return names[best], float(total[best] / max(len(names) - 1, 1)) if machines else 1.0

    def predict(self, text: str | None) -> tuple[str, float]:
        x = features(text) if text and self.languages else None
        if x is None:
            return UNKNOWN, 0.0
        family, sure = self._choose("", x)
        language, within = self._choose(family, x)
        return language, sure * within


def fit(docs: DataFrame, learn: Column, families: Mapping[str, str] = FAMILIES, rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most ``rows`` documents for which ``learn`` holds: equal shares of the languages, by hash of the id.

    Only (doc_id, text, lang) are read. Features come from the executors; the driver holds ``rows`` vectors.
    """
    labelled = docs.where(learn & F.col("lang").isNotNull()).select("doc_id", F.col("lang").alias("label"))
    sample = labelled_sample(docs.select("doc_id", "text"), labelled, rows)

    def encode(frames):
        for f in frames:
            vectors = [features(t or "") for t in f["text"]]
            yield pd.DataFrame({"label": f["label"], "x": [None if v is None else v.astype(np.float16).tobytes() for v in vectors]}).dropna()

    found = sample.select("text", "label").mapInPandas(encode, "label string, x binary").toPandas()
    found = found.sort_values(["label", "x"], kind="stable") if len(found) else found
    x = np.ones((len(found), WIDTH + 1), np.float32)  # the last column is for the bias
    for i, v in enumerate(found["x"]):
        x[i, :WIDTH] = np.frombuffer(v, np.float16)
    return Model(x, found["label"].to_numpy(str), families)


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row (doc_id, lang_pred, score) per document; only the text is looked at, all of it.

    ``lang_pred`` is a learned language, or ``und`` with score 0 if the text is null, has no letter or nothing
    was learned. ``score`` is the product of the two levels' confidences. Repeated rows come out once each,
    an empty table gives no rows, other columns are not read.
    """
    plain = take(docs, doc_id=id_column, text=text_column)
    return plain.select("doc_id", predictor(docs, model)("text").alias("p")).select("doc_id", "p.lang_pred", "p.score")


def predictor(docs: DataFrame, model: Model):
    """The prediction as a function of a text column, a struct (lang_pred, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages squared times WIDTH numbers at most

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])
        give_back()
        return out

    return predict


@F.pandas_udf(T.BooleanType())
def has_letter(texts: pd.Series) -> pd.Series:
    return pd.Series([any(c.isalpha() for c in t or "") for t in texts], dtype="bool")


def known_language(docs: DataFrame, learn: Column, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang and others) whose language is told with a score of at least ``least``.

    Texts that are null or have no letter go, and those in no learned language, which score low. If there is
    nothing to learn from, no score can be had, and every text with a letter stays.
    """
    model = fit(docs, learn)
    if not model.languages:
        return docs.where(has_letter("text"))
    told = F.col("__told")
    found = docs.withColumn("__told", predictor(docs, model)("text"))
    return found.where((told["lang_pred"] != UNKNOWN) & (told["score"] >= least)).drop("__told")
