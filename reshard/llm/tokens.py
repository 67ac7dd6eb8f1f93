"""Tokenizers inside tasks: their files travel by broadcast, and words that come again are not encoded again."""

from __future__ import annotations

import os
import string
from array import array
from collections.abc import Callable
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession

# Words whose encoding a worker keeps: when so many have come, those that none of the last ones was equal to go. Longer words
# are never kept.
KEPT_WORDS = 400_000
KEPT_CHARS = 100

_LOADED: dict[tuple, object] = {}


def shipped(spark: SparkSession, path: str) -> Broadcast:
    """Bytes of a tokenizer's file, which only the driver has to reach. Their size is that of a vocabulary."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def loaded(kind: str, content: bytes, build: Callable[[bytes], object]) -> object:
    """What a worker has made from a shipped file; made once per worker."""
    key = (kind, sha256(content).digest())
    if key not in _LOADED:
        _LOADED[key] = build(content)
    return _LOADED[key]


def bpe_tokenizer(content: bytes, plain_specials: bool = False) -> object:
    """A tokenizer of the ``tokenizers`` library; with ``plain_specials`` its special tokens' strings are ordinary text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content.decode())
    tokenizer.encode_special_tokens = plain_specials
    return tokenizer


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, start + length), one range after the other."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts.astype(np.int64) - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


def strings(values: pa.Array, between: str) -> list[str]:
    """Python strings of the values: cut from one text, unless ``between`` occurs in a value."""
    if not len(values):
        return []
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values), between)[0].as_py()
    out = joined.split(between)
    return out if len(out) == len(values) else values.to_pylist()


def byte_classes(*sets: bytes) -> np.ndarray:
    """Class of each byte: the number of the set it is in, counted from 0, or the number of sets."""
    table = np.full(256, len(sets), np.uint8)
    for i, members in enumerate(sets):
        table[list(members)] = i
    return table


def words_of(texts: pa.Array, classes: np.ndarray, cuts: tuple[tuple[int, int], ...] = ()) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of texts: the runs of bytes whose class is not 0, also cut between bytes of the pairs of classes in ``cuts``.

    Returns the words, the byte at which each begins, and where each text's words begin (and the end). NULL has no words.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]] if len(texts) else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    raw = data.tobytes()
    kinds = np.frombuffer(raw.translate(classes.tobytes()), np.uint8)
    k = int(classes.max()) + 1
    opens = np.zeros((k, k), bool)
    opens[0, 1:] = True
    for before, after in cuts:
        opens[before, after] = True
    step = kinds.copy()
    step[1:] += k * kinds[:-1]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    step[first] = kinds[first]  # nothing stands before a text
    starts = np.flatnonzero(np.frombuffer(step.tobytes().translate(np.resize(opens.reshape(-1), 256).tobytes()), bool))
    kept = raw.translate(None, np.flatnonzero(classes == 0).astype(np.uint8).tobytes())
    places = np.cumsum(kinds != 0, dtype=np.int32)
    edges = np.append(places[starts] - 1, len(kept)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(kept))
    return words, starts, np.searchsorted(starts, bounds)


class Kept:
    """Values of words, in two generations: a word that is asked for again moves to the newer one."""

    def __init__(self, most: int = KEPT_WORDS) -> None:
        self.most = most
        self.new: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def of(self, words: list[str], make: Callable[[list[str]], list]) -> list:
        """The value of each of these different words; those that are not known are made together."""
        if len(self.new) > self.most // 2:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        found = list(map(new.get, words))
        missing = [i for i, v in enumerate(found) if v is None]
        unknown = []
        for i in missing:
            value = old.get(words[i])
            if value is None:
                unknown.append(i)
            else:
                found[i] = new[words[i]] = value
        for i, value in zip(unknown, make([words[i] for i in unknown]) if unknown else []):
            found[i] = value
            if len(words[i]) <= KEPT_CHARS:
                new[words[i]] = value
        return found


# White space, letters, signs that are not part of contractions or special tokens, digits; other bytes are the last class.
WORD_CLASSES = byte_classes(
    b" \t\n\v\f\r", string.ascii_letters.encode(), b".,;:!?*$&#%+=~^@()[]{}/\\\"_-`", string.digits.encode()
)
WORD_CUTS = ((1, 2), (2, 1), (1, 3), (3, 1), (2, 3), (3, 2), (3, 3))
# Lower-case letters before this one are in normal form, alone and side by side.
PLAIN_END = "\u0250"
# Plain words that are encoded as one text.
JOINED = 256


class WordIds:
    """Ids of texts by a tokenizer of the tokenizers library, word by word or text by text.

    ``by_word`` is right for tokenizers that bring texts to normal form and lower case, drop white space, split there, between
    letters, signs and digits and at each digit, and then take bytes. Words that come again then cost a lookup instead of
    an encoding, and lower-case Latin words skip the steps that would not change them. Texts in which a special token
    might stand keep their case.
    """

    def __init__(self, tokenizer: object, by_word: bool) -> None:
        self.tokenizer, self.by_word, self.kept = tokenizer, by_word, Kept()
        if by_word:
            from tokenizers import Tokenizer
            from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit, Sequence

            self.plain = Tokenizer(tokenizer.model)
            steps = [CharDelimiterSplit(" "), ByteLevel(add_prefix_space=False, use_regex=False)]
            self.plain.pre_tokenizer = Sequence(steps)

    def encoded(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, 32 bits each."""
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: list[str]) -> list[bytes]:
        """The same for words."""
        plain = [i for i, w in enumerate(words) if w.isalpha() and w == w.lower() and max(w) < PLAIN_END]
        out: list = [None] * len(words)
        joined = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        encodings = self.plain.encode_batch([" ".join([words[i] for i in part]) for part in joined], add_special_tokens=False)
        for part, encoding in zip(joined, encodings):
            ids, ends = array("I", encoding.ids).tobytes(), np.searchsorted(encoding.word_ids, range(len(part)), "right")
            start = 0
            for i, end in zip(part, (4 * ends).tolist()):
                out[i] = ids[start:end]
                start = end
        others = [i for i, v in enumerate(out) if v is None]
        for i, ids in zip(others, self.encoded([words[i] for i in others])):
            out[i] = ids
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and how many each has."""
        if not self.by_word:
            found = self.encoded(["" if t is None else t for t in texts.to_pylist()])
            return np.frombuffer(b"".join(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found)) // 4
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        words, _, offsets = words_of(texts, WORD_CLASSES, WORD_CUTS)
        words = words.dictionary_encode()
        codes = words.indices.to_numpy(zero_copy_only=False)
        found = self.kept.of(strings(words.dictionary, " "), self.words)
        ids = np.frombuffer(b"".join(found), np.uint32)
        each = np.fromiter(map(len, found), np.int64, len(found)) // 4
        lengths = each[codes]
        sums = np.concatenate(([0], np.cumsum(lengths)))
        return ids[ranges((np.cumsum(each) - each)[codes], lengths)], np.diff(sums[offsets])
