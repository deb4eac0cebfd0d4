"""SentencePiece encoding and decoding by a shared-prefix forward pass.

Texts are marked as the model's normaliser does it (a space becomes U+2581, one stands before the text) and cut into
marked words, which no piece crosses. The distinct words of a batch, sorted, are the depth-first order of their trie:
going from one word to the next, the forward states of the common prefix stay on the stack and only the rest is
computed. A state holds the last piece of the best segmentation of its prefix and where that piece starts.

What "best" means is the model's own rule:

* unigram models: the largest sum of piece scores (Viterbi proper);
* BPE models: scores are merge ranks, whose sum is not the model's segmentation. There a prefix's segmentation ends in
  the one piece that keeps its neighbour when the two are merged by rank, so the forward step tests pieces that end
  here against the state where they start. The result equals merging the whole text by rank.

Characters without a piece become byte pieces, or the unknown piece if the model has no bytes. Decoding is exact: it
gives back the text, but for U+2581 itself, which comes back as a space, and characters lost to the unknown piece.

Defined results: a null or empty text has no ids and decodes to the empty text; null ids decode to the empty text;
very long words need memory in proportion to their length only; repeated rows are encoded each by itself. Only the
id and text columns are read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.llm.batches import bounded
from corpusloom.session import spread

MARK = "▁"
#: Words kept with their ids in a task, pairs of pieces kept with their test in a worker, characters encoded at once.
WORDS_KEPT, PAIRS_KEPT, CHARS_AT_ONCE = 300_000, 400_000, 2_000_000
UNIGRAM, BPE = 1, 2
#: Kinds of piece, as the format numbers them.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        size = {1: 8, 5: 4}.get(key & 7)
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        if size is None:
            size = varint()
        yield key >> 3, data[at : at + size]
        at += size


class _Suffix:
    """The longest end of a prefix that some piece begins with: its text, the pieces that end here as (length, piece, its fitting
    neighbours), the longest first, and where each character leads."""

    __slots__ = ("ending", "next", "text")

    def __init__(self, text: str, ending: list[tuple[int, int, dict[int, bool]]]):
        self.text, self.ending, self.next = text, ending, {}


class Vocabulary:
    """Pieces with scores and kinds, and the forward pass over marked words."""

    def __init__(self, pieces: list[tuple[str, float, int]], model_type: int):
        self.pieces, self.model_type = pieces, model_type
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED)}
        if any(kind == USER_DEFINED for _, _, kind in pieces):
            raise ValueError("models with user-defined pieces are not read")
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses words")
        self.scores = [s for _, s, _ in pieces]
        self.unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.unknown_score = min([self.scores[i] for i in self.ids.values()], default=0.0) - 10
        self.begins = {p[:n] for p in self.ids for n in range(1, len(p) + 1)}
        self.suffixes: dict[str, _Suffix] = {}  # made as texts need them
        self.empty = self._suffix("")
        self.fitting: dict[int, dict[int, bool]] = {}  # by piece, which left neighbours it stays beside
        self.pairs = 0
        self.alone = {i: self.merged(p) == [i] for p, i in self.ids.items()} if model_type == BPE else {}
        raw = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else p.replace(MARK, " ").encode() for p, _, kind in pieces]
        self.raw_sizes = np.array([len(x) for x in raw], np.int64)
        self.raw_starts = np.cumsum(self.raw_sizes) - self.raw_sizes
        self.raw = np.frombuffer(b"".join(raw), np.uint8)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a model file; only the identity normaliser with marks and a dummy prefix is read."""
        with open(path, "rb") as file:
            model = list(_fields(file.read()))
        pieces = []
        for number, value in model:
            if number == 1:
                one = dict(_fields(value))
                pieces.append((one[1].decode(), float(np.frombuffer(one[2], "<f4")[0]) if 2 in one else 0.0, one.get(3, NORMAL)))
        trainer = dict(_fields(next((v for k, v in model if k == 2), b"")))
        rules = dict(_fields(next((v for k, v in model if k == 3), b"")))
        if rules.get(2) or not rules.get(3, 1) or rules.get(4, 1) or not rules.get(5, 1):
            raise ValueError("only the identity normaliser with a dummy prefix and kept white space is read")
        return cls(pieces, trainer.get(3, UNIGRAM))

    def merged(self, text: str) -> list[int]:
        """The pieces of a short text by merging neighbours in the order of rank, leftmost first among equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = self.ids.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.scores[k] > best):
                    best, at = self.scores[k], i
            if best is None:
                return [self.ids.get(p, self.unknown) for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _suffix(self, text: str) -> _Suffix:
        known = self.suffixes.get(text)
        if known is None:
            pieces = ((n, self.ids.get(text[len(text) - n :])) for n in range(len(text), 0, -1))
            known = self.suffixes[text] = _Suffix(text, [(n, k, self.fitting.setdefault(k, {})) for n, k in pieces if k is not None])
        return known

    def _step(self, at: _Suffix, c: str) -> _Suffix:
        """Where the character leads; every step is worked out once."""
        text = at.text + c
        while text and text not in self.begins:
            text = text[1:]
        found = self._suffix(text)
        if text or c in self.begins:  # characters of no piece are not remembered, as there may be many
            at.next[c] = found
        return found

    def _fits(self, left: int, right: int) -> bool:
        """Whether the two pieces stay as they are when their characters are merged by rank."""
        if left < 0:  # a character without a piece merges with nothing
            return self.alone[right]
        fits = self.merged(self.pieces[left][0] + self.pieces[right][0]) == [left, right]
        if self.pairs >= PAIRS_KEPT:
            for known in self.fitting.values():
                known.clear()
            self.pairs = 0
        self.fitting[right][left] = fits
        self.pairs += 1
        return fits

    def forward(self, words: Iterable[str]) -> Iterator[list[int]]:
        """The ids of each of the sorted words, sharing states across common prefixes."""
        extend = self._extend_merged if self.model_type == BPE else self._extend_scored
        last, start, score, ends = [-1], [0], [0.0], [self.empty]  # by length of prefix
        before = ""
        for word in words:
            same, most = 0, min(len(before), len(word))
            while same < most and before[same] == word[same]:
                same += 1
            del last[same + 1 :], start[same + 1 :], score[same + 1 :], ends[same + 1 :]
            extend(word, last, start, score, ends)
            before = word
            out, j = [], len(word)
            while j:
                k = last[j]
                if k >= 0:
                    out.append(k)
                elif len(self.bytes) == 256:
                    out.extend(self.bytes[b] for b in reversed(chr(-1 - k).encode("utf-8", "replace")))
                else:
                    out.append(self.unknown)
                j = start[j]
            out.reverse()
            yield out

    def _extend_scored(self, word: str, last: list[int], start: list[int], score: list[float], ends: list[_Suffix]) -> None:
        """Unigram states of the word's longer prefixes: the largest sum of scores, the longest last piece among equals."""
        at = ends[-1]
        for j in range(len(last), len(word) + 1):
            c = word[j - 1]
            at = at.next.get(c) or self._step(at, c)
            best = (score[j - 1] + self.unknown_score, j - 1, -1 - ord(c))
            for n, k, _ in at.ending:
                if best[2] < 0 and n == 1 or score[j - n] + self.scores[k] > best[0]:
                    best = (score[j - n] + self.scores[k], j - n, k)
            score.append(best[0])
            start.append(best[1])
            last.append(best[2])
            ends.append(at)

    def _extend_merged(self, word: str, last: list[int], start: list[int], score: list[float], ends: list[_Suffix]) -> None:
        """BPE states of the word's longer prefixes: the one last piece that stays beside its neighbour."""
        fits, at = self._fits, ends[-1]
        for j in range(len(last), len(word) + 1):
            c = word[j - 1]
            at = at.next.get(c) or self._step(at, c)
            ends.append(at)
            for n, k, known in at.ending:
                left = last[j - n]
                fit = known.get(left)
                if fit or fit is None and fits(left, k):
                    start.append(j - n)
                    last.append(k)
                    break
            else:
                start.append(j - 1)
                last.append(-1 - ord(c))


def marked_words(text: str) -> list[str]:
    """The text's marked words, each without its first mark."""
    if not text:
        return []
    if "  " not in text and text[0] != " " and MARK not in text:
        return text.split(" ")
    return [w[1:] for w in re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))]


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)] if total else flat[:0]


class Encoder:
    """Encodes batches of texts and keeps the ids of words it has seen, up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.flat, self.starts, self.sizes = array("i"), array("q"), array("q")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offset of each text's."""
        if len(self.at) > WORDS_KEPT:
            self._clear()
        words = [marked_words(t) for t in texts]
        new = sorted(set().union(*words).difference(self.at))
        for w, ids in zip(new, self.vocabulary.forward(MARK + w for w in new), strict=True):
            self.at[w] = len(self.starts)
            self.starts.append(len(self.flat))
            self.sizes.append(len(ids))
            self.flat.extend(ids)
        counts = np.fromiter(map(len, words), np.int64, len(words))
        index = np.fromiter(map(self.at.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
        flat, starts, sizes = np.array(self.flat, np.int32), np.array(self.starts, np.int64), np.array(self.sizes, np.int64)
        lengths = sizes[index]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return _gather(flat, starts[index], lengths), upto[np.concatenate([[0], np.cumsum(counts)])]


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The texts of the id lists between the offsets."""
    sizes = vocabulary.raw_sizes[ids]
    data = _gather(vocabulary.raw, vocabulary.raw_starts[ids], sizes).tobytes()
    upto = np.concatenate([[0], np.cumsum(sizes)])[offsets].tolist()
    texts = (data[a:b] for a, b in zip(upto[:-1], upto[1:], strict=True))
    return [(t[1:] if t[:1] == b" " else t).decode("utf-8", "replace") for t in texts]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The model of a path, read once in each worker."""
    return Vocabulary.load(path)


def _runs(weights: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose weights sum to ``most`` at the most, or single ones."""
    start, held = 0, 0
    for i, w in enumerate(weights.tolist()):
        if i > start and held + w > most:
            yield start, i
            start, held = i, 0
        held += w
    if start < len(weights):
        yield start, len(weights)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``id`` and ``ids`` of every text; on demand also the ``text`` that the ids give back, decoded by the same task."""
    bounded(docs.sparkSession)
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    kind = plain.schema["id"].dataType
    names = ["id", "ids", "text"] if decoded else ["id", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(model_path)
        encoder = Encoder(known)  # its words go with the task
        for batch in batches:
            for a, b in _runs(np.array(pc.utf8_length(batch.column(1))), CHARS_AT_ONCE):
                part = batch.slice(a, b - a)
                ids, offsets = encoder.encode(part.column(1).to_pylist())
                columns = [part.column(0), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]
                if decoded:
                    columns.append(pa.array(decode_ids(known, ids, offsets), pa.string()))
                yield pa.record_batch(columns, names=names)

    return spread(plain).mapInArrow(run, f"id {kind.simpleString()}, ids array<int>" + ", text string" * decoded)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with the decoded ``text`` beside every other column; an older ``text`` goes."""
    bounded(encoded.sparkSession)
    encoded = encoded.drop("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    at = encoded.columns.index(ids_col)
    types, names = [to_arrow_type(f.dataType) for f in encoded.schema], [*encoded.columns, "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(model_path)
        for batch in batches:
            lists = batch.column(at)
            sizes = np.array(lists.value_lengths().fill_null(0), np.int64)
            for a, b in _runs(sizes, CHARS_AT_ONCE):
                part = batch.slice(a, b - a)
                ids = np.asarray(part.column(at).flatten().fill_null(known.unknown), np.int64)
                texts = decode_ids(known, ids, np.concatenate([[0], np.cumsum(sizes[a:b])]))
                columns = [c if c.type == t else c.cast(t) for c, t in zip(part.columns, types, strict=True)]
                yield pa.record_batch([*columns, pa.array(texts, pa.string())], names=names)

    return encoded.mapInArrow(run, f"{schema}, text string")
