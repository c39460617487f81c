"""Packing of token pieces into sequences: exact complements first, best fit for what is left."""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartframes.llm.common import frugal, pin, take

CAPACITY = 2048
#: Parts of texts whose tokens a worker remembers, in each of two generations.
CACHE_PARTS = 150_000
#: The same for packing, which is one of several stages that share their workers' memory.
PACKING_PARTS = 40_000
#: Bytes of texts whose different words are merged together; a longer text is alone. Words of more letters are merged one by one.
PORTION, LETTERS = 4 << 20, 64
#: Pieces of one length are numbered in parts of about so many, so that no task numbers a whole length.
PART_ROWS = 100_000

#: A word of Latin-1 letters with or without stops after it. These letters have one form each in NFC.
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,]*)")


def _byte_letter(b: int) -> str:
    """The letter that stands for a byte in a byte-level vocabulary: printable ones themselves, others from 256 on."""
    if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
        return chr(b)
    return chr(256 + b if b <= 32 else 162 + b if b <= 160 else 323)


BYTE_LETTERS = [_byte_letter(b) for b in range(256)]
# fixed values: how files that ``word_merges`` knows normalise a text and split it before merging
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {
    "type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True,
}
#: The same split for lower-case words of printable ASCII and Latin-1 letters, each with a line feed after it.
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|\n|[^0-9a-z\u00df-\u00f6\u00f8-\u00ff\n]+")
_PRINTABLE = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
#: Stands in ``word_merges`` for the suffix that a vocabulary puts after the last letter of what was split.
END = "\x01"


def word_merges(path: str):
    """``tiktoken`` with the merges of a file of ``tokenizers``, for what was split, with ``END`` after each part.

    It joins the neighbours whose joint bytes have the lowest id, the leftmost first. That is the same if ids are numbered by
    merge, after all bytes without and with a suffix, and each longer token has one merge; for other files there is None.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        settings = json.load(f)
    model, pre = settings["model"], (settings.get("pre_tokenizer") or {}).get("pretokenizers", [])
    known = (settings.get("normalizer") or {}).get("normalizers") == NORMALIZER and [x["type"] for x in pre] == ["Split", "ByteLevel"]
    known = known and pre[0] == SPLIT and not pre[1]["use_regex"] and not pre[1]["add_prefix_space"]
    known = known and all("<|" in t["content"] for t in settings.get("added_tokens", []))
    suffix, vocabulary = model.get("end_of_word_suffix"), model.get("vocab")
    if not known or model.get("type") != "BPE" or not suffix or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges")):
        return None
    byte = {letter: b for b, letter in enumerate(BYTE_LETTERS)}
    ranks = {}
    for token, i in vocabulary.items():
        letters = token.removesuffix(suffix)
        if all(c in byte for c in letters):
            ranks[bytes([byte[c] for c in letters]) + (END.encode() if letters != token else b"")] = i
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    single = [ranks.get(bytes([b]) + end, len(vocabulary)) for b in range(256) for end in (b"", END.encode())]
    ascending = all(a < b for a, b in zip([max(single), *merged], merged, strict=False))
    if not ascending or len(ranks) != len(vocabulary) or len(vocabulary) != len(single) + len(merged):
        return None
    return tiktoken.Encoding("words", pat_str=r"[^\x01]+\x01", mergeable_ranks=ranks, special_tokens={})


class WordEncoder(dict):
    """Token ids of texts by a tokenizer that drops white space and merges within words only.

    Such a tokenizer treats the parts between blanks independently, so the ids of a part are looked up here and
    made when they are missing. The parts used last are remembered in two generations. A-Z are lowered first,
    as the tokenizer does it too, unless ``<|`` is in the text, which may begin a special token. A plain word goes to
    the tokenizer's merges directly, without normaliser and splitting; it is tried out whether that gives the same.

    With ``together``, ``each`` encodes the different words of many texts by one call of ``word_merges``, if the file allows
    it, and only words of other characters, or long ones, are looked up here. That takes half the time, and more memory.
    """

    def __init__(self, path: str, parts: int | None = None, together: bool = False):
        from tokenizers import Tokenizer

        super().__init__()
        self.parts = parts or CACHE_PARTS
        self.tokenizer = Tokenizer.from_file(path)
        self.older: dict[bytes, bytes] = {}
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.merges = self.tokenizer.model.tokenize
        self.direct = True
        probes = [b"the", b"within", b"\xc3\xa9t\xc3\xa9", b"stra\xc3\x9fe,", b"a.,"]
        self.direct = [self._ids(p) for p in probes] == [self._whole(p.decode()) for p in probes]
        self.words = word_merges(path) if together else None
        if self.words:
            self.mark = self.words.encode_single_token(f"\n{END}")
            if list(self.each(PROBES)) != [self._whole(p) for p in PROBES]:
                self.words = None
        self.forget()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _merged(self, letters: str) -> bytes:
        packed = self.packed
        return b"".join([packed[t.id] for t in self.merges(letters)])

    def _ids(self, part: bytes) -> bytes:
        if self.direct:  # ASCII first, as most parts are
            if part.isalpha():
                return self._merged(part.decode("ascii").lower())
            word = part.rstrip(b".,")
            if word != part and word.isalpha():
                return self[word] + self[part[len(word) :]]
        text = part.decode("utf-8")
        plain = _PLAIN.fullmatch(text) if self.direct else None
        if not plain:
            return self._whole(text)
        word, stops = plain.groups()
        if stops:
            return self[word.encode()] + self[stops.encode()]
        return self._merged("".join([BYTE_LETTERS[b] for b in word.lower().encode()]))

    def __missing__(self, part: bytes) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = self._ids(part)
        if len(self) >= self.parts:
            self.older = dict(self)
            self.clear()
        self[part] = ids
        return ids

    def forget(self) -> None:
        self.older = {}
        self.clear()

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self.__getitem__, _lowered(text).split()))

    def each(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, those of a portion being made together."""
        if not self.words:
            yield from map(self, texts)
            return
        portion: list[bytes] = []
        size = 0
        for data in map(_lowered, texts):
            if portion and size + len(data) > PORTION:
                yield from self._portion(portion)
                portion, size = [], 0
            portion.append(data)
            size += len(data)
        if portion:
            yield from self._portion(portion)

    def _portion(self, portion: list[bytes]) -> Iterator[bytes]:
        lists = pc.ascii_split_whitespace(pa.array(portion, pa.string()))
        words = lists.flatten().dictionary_encode()
        first, count, ids = self._different(words.dictionary.to_pylist())
        which, ends = words.indices.to_numpy(), lists.offsets.to_numpy()
        for a, b in zip(ends, ends[1:], strict=False):
            n = count[which[a:b]]
            yield ids[np.repeat(first[which[a:b]] - np.cumsum(n) + n, n) + np.arange(n.sum())].tobytes()

    def _different(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each word's ids begin, how many they are, and all ids."""
        fast = [len(w) <= LETTERS and "<|" not in w and _PRINTABLE.fullmatch(w) is not None for w in words]
        lines = "\n".join([w if f else "" for w, f in zip(words, fast, strict=True)] + [""]).lower()
        ids = np.array(self.words.encode_ordinary(END.join([*_SPLIT.findall(lines), ""])), "<u4")
        last = np.flatnonzero(ids == self.mark)
        first = np.r_[0, last + 1][: len(words)]
        count = last - first
        slow = [i for i, f in enumerate(fast) if not f]
        if slow:
            other = [np.frombuffer(self[words[i].encode()], "<u4") for i in slow]
            count[slow] = [len(x) for x in other]
            first[slow] = len(ids) + np.cumsum(count[slow]) - count[slow]
            ids = np.concatenate([ids, *other])
        return first, count, ids


def _lowered(text: str) -> bytes:
    data = text.encode("utf-8", "replace")
    return data if b"<|" in data else data.lower()


#: Texts that are tried out.
PROBES = ["The theme, within.. 'it's 2024!?' y'all've", "", " \u00c9t\u00e9, Stra\u00dfe... a.,b ((x)) \u4e2d <|endoftext|> it'd", "x"]


_ENCODERS: dict[tuple[str, int | None, bool], WordEncoder] = {}


def word_encoder(path: str, parts: int | None = None, together: bool = False) -> WordEncoder:
    """The worker's encoder for a tokenizer file, kept between tasks."""
    key = (path, parts, together)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(*key)
    return _ENCODERS[key]


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = 0, with_ids: bool = True, together: bool = True
) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32 and ids if asked for): each document's ids and ``end``, cut at ``capacity``."""
    kind = dict(docs.dtypes)["doc_id"]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]

    def cut(frames):
        encode = word_encoder(tokenizer, PACKING_PARTS, together)
        try:
            yield from pieces(frames, encode)
        finally:
            encode.forget()  # the worker is kept for stages that have no use of it

    def pieces(frames, encode):
        tail = np.array([end], "<u4").tobytes()
        for f in frames:
            out = []
            for doc, ids in zip(f["doc_id"], encode.each(t or "" for t in f["text"]), strict=True):
                ids = ids + tail
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part)[: len(columns)])
            frame = pd.DataFrame(out, columns=columns)
            frame["doc_id"] = frame["doc_id"].astype(f["doc_id"].dtype)
            yield frame

    kinds = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.mapInPandas(frugal(cut), f"{kinds}, ids binary" if with_ids else kinds)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is used, so that every piece is used once.

    Starting at the longest length left, its gap is filled exactly by one, two or three lengths that are
    available, longest first; a whole batch is used at once, as far as the counts go. If no such sum fits, the best
    fitting length takes its share of the gap and the search goes on with what remains of it. Each batch uses
    up a length or leaves too few of it for another, so the work depends on the number of lengths only.
    """
    left = {k: v for k, v in counts.items() if v > 0}
    lengths = sorted(left)
    out = []
    sums: list[int] = []  # the sums of two available lengths, as one bit each

    def enough(parts: tuple[int, ...], base: tuple[int, ...]) -> bool:
        need = base + parts
        return all(left.get(x, 0) >= need.count(x) for x in set(parts))

    def exact(gap: int, base: tuple[int, ...]) -> tuple[int, ...] | None:
        """One, two or three available lengths with sum ``gap``, found by looking up the complement."""
        if enough((gap,), base):
            return (gap,)
        below = lengths[: bisect_right(lengths, gap - 1)]
        for x in reversed(below):
            if 2 * x < gap:
                break
            if gap - x in left and enough((x, gap - x), base):
                return x, gap - x
        if not sums:
            singles = sum(1 << x for x in lengths)
            pairs = 0
            for x in lengths:
                pairs |= singles << x
            sums.append(pairs & ((1 << (capacity + 1)) - 1))
        for x in reversed(below):
            if 3 * x < gap:
                break
            rest = gap - x
            if not sums[0] >> rest & 1:
                continue
            for y in reversed(below[: bisect_right(below, min(x, rest - 1))]):
                if 2 * y < rest:
                    break
                if rest - y in left and enough((x, y, rest - y), base):
                    return x, y, rest - y
        return None

    while lengths:
        pattern: tuple[int, ...] = (lengths[-1],)
        gap = capacity - pattern[0]
        while gap:
            parts = exact(gap, pattern)
            if parts:
                pattern += parts
                break
            for x in reversed(lengths[: bisect_right(lengths, gap)]):
                if enough((x,), pattern):
                    pattern += (x,)
                    gap -= x
                    break
            else:
                break
        times = min(left[x] // pattern.count(x) for x in set(pattern))
        out.append((pattern, times))
        for x in pattern:
            left[x] -= times
        for x in set(pattern):
            if not left[x]:
                del left[x]
                lengths.remove(x)
                sums.clear()
    return out


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length the rows (first number, first sequence, offset): where the pieces of that length go, by number."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for x in pattern:
            out.setdefault(x, []).append((used.get(x, 0), sequence, offset))
            used[x] = used.get(x, 0) + times
            offset += x
        sequence += times
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a pinned table with doc_id, piece, length) with columns sequence_id and offset.

    Only the counts of the lengths, at most ``capacity`` numbers, and of their parts reach the driver, and so does the plan.
    A length has as many parts by hash as its count asks for; its pieces are numbered in each from where the parts before it end.
    """
    total = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    parts = F.lit([max(-(-total.get(x, 0) // PART_ROWS), 1) for x in range(capacity + 1)])
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.element_at(parts, (F.col("length") + 1).cast("int"))).cast("int")
    pieces = pieces.withColumn("__part", part)
    found = pieces.groupBy("length", "__part").count().collect()  # rows / PART_ROWS + capacity rows at most
    counts: dict[int, int] = {}
    base: dict[tuple[int, int], int] = {}
    for r in sorted(found, key=lambda r: (r["length"], r["__part"])):
        base[r["length"], r["__part"]] = counts.get(r["length"], 0)
        counts[r["length"]] = counts.get(r["length"], 0) + r["count"]
    shared = pieces.sparkSession.sparkContext.broadcast((base, places(plan(counts, capacity))))
    order = Window.partitionBy("length", "__part").orderBy("doc_id", "piece", "ids_crc32")
    numbered = pieces.withColumn("__n", F.row_number().over(order) - 1)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, part: pd.Series, n: pd.Series) -> pd.DataFrame:
        base, where = shared.value
        out = np.zeros((len(length), 2), np.int64)
        frame = pd.DataFrame({"length": length.to_numpy(), "part": part.to_numpy(), "n": n.to_numpy(np.int64)})
        for (x, p), rows in frame.groupby(["length", "part"]).groups.items():
            number = frame["n"].to_numpy()[rows] + base[x, p]
            first, sequence, offset = where[x].T
            row = np.searchsorted(first, number, side="right") - 1
            out[rows, 0] = sequence[row] + number - first[row]
            out[rows, 1] = offset[row]
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    return numbered.withColumn("__at", place("length", "__part", "__n")).withColumns(
        {"sequence_id": F.col("__at.sequence_id"), "offset": F.col("__at.offset")}
    ).drop("__part", "__n", "__at")


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = 0, id_column: str = "doc_id",
    text_column: str = "text", with_ids: bool = False, together: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids if asked for).

    A document is its token ids and the id ``end``; only longer ones than ``capacity`` are cut, all pieces but the
    last are full then. Null and empty texts are the end token alone. Repeated rows are packed once each and
    may swap places with each other; a null doc_id is packed like any other; other columns are not read; an empty table
    gives no rows. Without ``together`` words are encoded one by one, with the same ids: twice the time, tens of MB less a worker.
    """
    pieces = token_pieces(take(docs, doc_id=id_column, text=text_column), tokenizer, capacity, end, with_ids, together)
    return pack(pin(pieces), capacity)
