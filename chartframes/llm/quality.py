"""Quality scores by attention-based multiple-instance learning over the passages of a document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartframes.llm.common import labelled_sample, pin, take

PASSAGE_WORDS = 64
#: Hashed three-byte strings per passage, and kinds of bytes whose shares are counted.
BINS = 512
KINDS = 7
WIDTH = BINS + KINDS + 2
CODE, GATE = 24, 16
#: The fit reads at most so many labelled documents, and of each so many passages, spread over its whole length.
SAMPLE_ROWS = 3000
SAMPLE_PASSAGES = 64
#: Passages that are held at once while a document is scored.
PORTION = 256

#: blank, lower-case letter, upper-case letter, digit, sentence stop, other sign, byte beyond ASCII
_KIND = np.array([0 if c in b" \t\n\r\x0b\x0c" else 1 if 97 <= c <= 122 else 2 if 65 <= c <= 90 else 3 if 48 <= c <= 57 else 4 if c in b".,;:!?'\"-()" else 6 if c >= 128 else 5 for c in range(256)])


def passages(text: str) -> Iterator[np.ndarray]:
    """Vectors of the consecutive passages of ``PASSAGE_WORDS`` words, in portions; an empty text is one empty passage."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    blank = _KIND[data] == 0
    starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]]) if len(data) else np.zeros(0, np.int64)
    if not len(starts):
        yield np.zeros((1, WIDTH), np.float32)
        return
    cuts = np.r_[starts[::PASSAGE_WORDS], len(data)]
    for i in range(0, len(cuts) - 1, PORTION):
        own = cuts[i : i + PORTION + 1]
        yield _vectors(data[own[0] : own[-1]], own - own[0], starts[i * PASSAGE_WORDS : (i + PORTION) * PASSAGE_WORDS] - own[0])


def _vectors(data: np.ndarray, cuts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    n = len(cuts) - 1
    size = np.diff(cuts)
    row = np.repeat(np.arange(n), size)
    wide = data.astype(np.uint32)
    gram = (wide[:-2] << np.uint32(16) | wide[1:-1] << np.uint32(8) | wide[2:]) * np.uint32(0x9E3779B1) >> np.uint32(23)
    inside = row[:-2] == row[2:] if len(row) > 2 else np.zeros(0, bool)
    counts = np.bincount(row[: len(gram)][inside] * BINS + gram[inside], minlength=n * BINS).reshape(n, BINS).astype(np.float32)
    total = np.maximum(counts.sum(1), 1)
    out = np.empty((n, WIDTH), np.float32)
    out[:, :BINS] = np.sqrt(counts / total[:, None])
    kinds = np.bincount(row * KINDS + _KIND[data], minlength=n * KINDS).reshape(n, KINDS)
    out[:, BINS : BINS + KINDS] = 4 * kinds / np.maximum(size, 1)[:, None]
    # how many different strings there are, for repeated words; and the mean length of a word
    out[:, -2] = np.log(np.maximum(total**2 / np.maximum((counts**2).sum(1), 1), 1)) / 4
    words = np.bincount(np.searchsorted(cuts, starts, side="right") - 1, minlength=n)
    out[:, -1] = np.log(np.maximum(size, 1) / np.maximum(words, 1))
    return out


def spread(portions: Iterator[np.ndarray], most: int) -> np.ndarray:
    """At most ``most`` passages at even distances; no more than twice as many and a portion are held at once."""
    kept, step, seen = np.zeros((0, WIDTH), np.float32), 1, 0
    for x in portions:
        kept = np.concatenate([kept, x[-seen % step :: step]])
        seen += len(x)
        while len(kept) > 2 * most:
            kept, step = kept[::2], 2 * step
    if len(kept) <= most:
        return kept
    return kept[np.linspace(0, len(kept) - 1, most).round().astype(int)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Attention:
    """Encoder, gated attention and classifier, trained together on document labels."""

    def __init__(self, bags: list[np.ndarray], labels: np.ndarray, prior: float, rounds: int = 20, seed: int = 7):
        rng = np.random.default_rng(seed)
        normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {
            "w": normal(WIDTH, CODE), "wb": np.zeros(CODE, np.float32), "v": normal(CODE, GATE), "u": normal(CODE, GATE),
            "a": normal(GATE, 1)[:, 0], "c": normal(CODE, 1)[:, 0], "cb": np.zeros(1, np.float32),
        }
        share = float(labels.mean()) if len(labels) else 0.0
        odds = lambda x: np.log(np.clip(x, 1e-3, 1 - 1e-3) / (1 - np.clip(x, 1e-3, 1 - 1e-3)))
        self.shift = float(odds(prior) - odds(share))  # the sample has equal shares, the corpus has not
        if not 0 < share < 1:
            self.p = {k: np.zeros_like(v) for k, v in self.p.items()}  # nothing to tell apart
            self.shift = float(odds(prior))
            return
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step = 0
        for _ in range(rounds):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), 48):
                batch = order[at : at + 48]
                gradient = self._gradient([bags[i] for i in batch], labels[batch])
                step += 1
                for k, g in gradient.items():
                    g = g + 1e-4 * self.p[k]
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    rate = 3e-3 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                    self.p[k] -= rate * first[k] / (np.sqrt(second[k]) + 1e-8)

    def _gradient(self, bags: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        x = np.concatenate(bags)
        size = np.array([len(b) for b in bags])
        start, bag = np.cumsum(size) - size, np.repeat(np.arange(len(bags)), size)
        h = np.tanh(x @ p["w"] + p["wb"])
        t, s = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        e = (t * s) @ p["a"]
        weight = np.exp(e - np.maximum.reduceat(e, start)[bag])
        weight /= np.add.reduceat(weight, start)[bag]
        z = np.add.reduceat(weight[:, None] * h, start)
        error = (_sigmoid(z @ p["c"] + p["cb"]) - labels) / len(bags)
        dz = error[:, None] * p["c"]
        dweight = (dz[bag] * h).sum(1)
        de = weight * (dweight - np.add.reduceat(weight * dweight, start)[bag])
        dt, ds = de[:, None] * p["a"] * s * (1 - t * t), de[:, None] * p["a"] * t * s * (1 - s)
        dh = (weight[:, None] * dz[bag] + dt @ p["v"].T + ds @ p["u"].T) * (1 - h * h)
        return {
            "w": x.T @ dh, "wb": dh.sum(0), "v": h.T @ dt, "u": h.T @ ds,
            "a": (t * s).T @ de, "c": z.T @ error, "cb": error.sum(keepdims=True),
        }

    def score(self, text: str | None) -> float:
        """The probability of label 1; attention is summed up portion by portion, so a long text takes no more memory."""
        p = self.p
        top, weights, z = -np.inf, 0.0, np.zeros(CODE)
        for x in passages(text or ""):
            h = np.tanh(x @ p["w"] + p["wb"])
            e = (np.tanh(h @ p["v"]) * _sigmoid(h @ p["u"])) @ p["a"]
            new = max(top, float(e.max()))
            weight = np.exp(e - new)
            kept = np.exp(top - new)
            z, weights, top = z * kept + weight @ h, weights * kept + float(weight.sum()), new
        return float(_sigmoid(z / weights @ p["c"] + p["cb"][0] + self.shift))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = SAMPLE_ROWS, most: int = SAMPLE_PASSAGES) -> Attention:
    """Learn from at most ``rows`` labelled documents for which ``learn`` holds, from at most ``most`` passages of each.

    ``docs`` is (doc_id, text), ``labels`` (doc_id, quality); equal shares of the labels are chosen by hash of
    the id, and of a repeated id one text. The passages are spread over the whole text, however long; null and empty texts are
    one empty passage. The share of label 1 that scores are set to is counted over all labelled ids. Of a document
    with several different labels the smallest counts. Other columns are not read.
    """
    labelled = pin(labels.where(learn & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("label")))
    prior = labelled.agg(F.avg("label")).first()[0]
    there = labelled.join(docs.select("doc_id"), "doc_id", "left_semi")
    sample = labelled_sample(docs.select("doc_id", "text"), there, rows)

    def encode(frames):
        for f in frames:
            bags = [spread(passages(t or ""), most).astype(np.float16).tobytes() for t in f["text"]]
            yield pd.DataFrame({"label": f["label"], "x": bags})

    found = sample.select("text", "label").mapInPandas(encode, "label int, x binary").toPandas()
    found = found.sort_values(["label", "x"], kind="stable") if len(found) else found
    bags = [np.frombuffer(x, np.float16).reshape(-1, WIDTH).astype(np.float32) for x in found["x"]]
    return Attention(bags, found["label"].to_numpy(np.float32), 0.5 if prior is None else float(prior))


def score(docs: DataFrame, model: Attention, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row (doc_id, score) per document, from its whole text alone.

    Null and empty texts are one empty passage and get that passage's score. Repeated rows come out once each,
    an empty table gives no rows, a model without two labels gives every document the share of label 1.
    Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # about 60 kB whatever it was trained on

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    return take(docs, doc_id=id_column, text=text_column).select("doc_id", of("text").alias("score"))
