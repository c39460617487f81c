"""Token counts under a unigram vocabulary, without making the tokens."""

from __future__ import annotations

import re
from collections.abc import Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartframes.llm.common import take

BLANK = "▁"
#: What an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0
#: Text parts whose counts a worker remembers.
CACHE_PARTS = 400_000


def read_pieces(model: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a sentencepiece file with their scores; its byte pieces must be complete."""
    from sentencepiece import SentencePieceProcessor

    m = SentencePieceProcessor(model_file=model)
    ids = range(m.get_piece_size())
    if sum(m.is_byte(i) for i in ids) != 256:
        raise ValueError("the vocabulary must have all byte pieces, as unknown characters are counted in bytes")
    return [(m.id_to_piece(i), m.get_score(i)) for i in ids if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]


class Viterbi:
    """Best score and number of pieces of a text.

    An Aho-Corasick automaton gives the pieces that end at each character; of the ways to get there only the
    best score and its count are kept. As in the tokenizer, a later way must be strictly better, so
    the longest last piece wins a tie. A character that is no piece itself may stand for its UTF-8
    bytes, with a score ``UNKNOWN_PENALTY`` below all pieces.

    If no piece has a blank after another character and sums of scores are exact (whole numbers), nothing that
    happens on one side of a blank's left edge matters to the other, and parts are counted once and remembered.
    """

    def __init__(self, pieces: Sequence[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for text, score in pieces:
            self.automaton.add_word(text, (len(text), score))
        self.automaton.make_automaton()
        self.single = {text for text, _ in pieces if len(text) == 1}
        self.longest = max((len(text) for text, _ in pieces), default=1)
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY
        whole = all(score == int(score) for _, score in pieces)
        inner = any(re.search(f"[^{BLANK}]{BLANK}", text) for text, _ in pieces)
        lines = any("\n" in text for text, _ in pieces)
        self.parts = None if inner or not whole else re.compile(rf"{BLANK}*[^{BLANK}]+|{BLANK}+" if lines else rf"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")
        self.known: dict[str, tuple[float, int]] = {}

    def best(self, text: str) -> tuple[float, int]:
        """Score and count of the best segmentation; only the last ``longest`` characters' states are held."""
        ring = self.longest + 1
        scores, counts = [0.0] * ring, [0] * ring
        done = 0  # characters with a state

        def alone(end: int) -> None:
            """The state at ``end`` if its last character is unknown."""
            char = text[end - 1]
            if char not in self.single:
                i, j = (end - 1) % ring, end % ring
                scores[j], counts[j] = scores[i] + self.unknown, counts[i] + len(char.encode("utf-8", "replace"))

        last = 0
        top, way, start = 0.0, 0, -1
        for at, (size, score) in self.automaton.iter(text):
            end = at + 1
            if end != last:
                if last:
                    self._close(text, last, top, way, start, scores, counts, ring)
                    done = last
                for skipped in range(done + 1, end):
                    alone(skipped)
                done, last, start = end - 1, end, -1
            i = (end - size) % ring
            value = scores[i] + score
            if start < 0 or value > top or (value == top and end - size < start):
                top, way, start = value, counts[i] + 1, end - size
        if last:
            self._close(text, last, top, way, start, scores, counts, ring)
            done = last
        for skipped in range(done + 1, len(text) + 1):
            alone(skipped)
        return scores[len(text) % ring], counts[len(text) % ring]

    def _close(self, text, end, top, way, start, scores, counts, ring) -> None:
        """The state at ``end``: the best piece that ends there, or its last character as unknown if strictly better."""
        char = text[end - 1]
        if char not in self.single:
            i = (end - 1) % ring
            value = scores[i] + self.unknown
            if value > top:
                top, way = value, counts[i] + len(char.encode("utf-8", "replace"))
        scores[end % ring], counts[end % ring] = top, way

    def __call__(self, text: str | None) -> tuple[float, int]:
        """Score and count of a whole text: a blank before it, and blanks for spaces."""
        if not text:
            return 0.0, 0
        text = BLANK + text.replace(" ", BLANK)
        if self.parts is None:
            return self.best(text)
        known, score, count = self.known, 0.0, 0
        if len(known) > CACHE_PARTS:
            known.clear()
        for part in self.parts.findall(text):
            found = known.get(part)
            if found is None:
                found = known[part] = self.best(part)
            score += found[0]
            count += found[1]
        return score, count


_VITERBI: dict[int, Viterbi] = {}


def token_counts(docs: DataFrame, pieces: Sequence[tuple[str, float]], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row (doc_id, n_tokens, score) per document: pieces of the best segmentation of the whole text, and its score.

    Null and empty texts have no tokens and score 0. Repeated rows come out once each, null doc_ids like any
    other, an empty table gives no rows, other columns are not read. The vocabulary is broadcast; it is a file of
    a tokenizer and does not grow with the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(list(pieces))

    @F.pandas_udf("n_tokens long, score double")
    def count(texts: pd.Series) -> pd.DataFrame:
        key = hash(tuple(shared.value))
        if key not in _VITERBI:
            _VITERBI.clear()
            _VITERBI[key] = Viterbi(shared.value)
        found = [_VITERBI[key](t) for t in texts]
        return pd.DataFrame({"n_tokens": [c for _, c in found], "score": [s for s, _ in found]})

    plain = take(docs, doc_id=id_column, text=text_column)
    return plain.select("doc_id", count("text").alias("c")).select("doc_id", "c.n_tokens", "c.score")
