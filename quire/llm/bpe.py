"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The frequent words of the whole corpus (counted by Spark) are merged once and
compiled into a minimal acyclic automaton over their UTF-8 bytes: equal
suffixes share their states, and every arc carries an output number whose sum
along a word is the word's place in the table of token ids. The automaton is
one file of plain arrays, shipped with ``addFile`` and memory-mapped by the
Python workers, so all workers of a machine share its pages. A word that the
automaton does not hold is merged exactly by the rules of the vocabulary
(lowest rank first, leftmost first) with a heap, O(n log n) for a word of n
bytes.

The text rules are those of the tokenizer file: strings of added tokens first,
then NFC, lower case per code point, words by the file's pattern, bytes as
characters, ``</w>`` on a word's last piece. Decoding joins the pieces' texts
with one space, as the file names no decoder.

Defined results: NULL and empty texts have no tokens and decode to an empty
text; very long words take the exact path; an empty table gives no rows;
repeated rows are encoded alike; other columns ride along in ``row``.
"""

from __future__ import annotations

import gc
import heapq
import json
import mmap
import os
import re
import struct
import tempfile
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType
from tokenizers import Regex, normalizers, pre_tokenizers

from quire.llm.common import materialise, packed, small_batches, stretches

LEXICON_WORDS = 50_000
LEXICON_BYTES = 64       # longer words take the exact path
MEMO_WORDS = 120_000     # per worker; forgotten beyond that, but for those of the last texts
LEAST_COUNT = 3          # rarer words are not in the lexicon
FLUSH_WORDS = 150_000
SIDE_BY_SIDE = 4096      # words merged together
TOGETHER = 1 << 18       # characters of the texts that are encoded together
# White space as in Unicode, without the separators U+001C..U+001F.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SHORT = "'(?:s|t|re|ve|m|ll|d)"
WORDS = regex.compile(rf"\p{{L}}+|\p{{N}}|{SHORT}|[^{SPACE}\p{{L}}\p{{N}}]+")
# The same for texts of Latin-1 characters, which most are.
LETTERS, NUMBERS = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
WORDS_LATIN = re.compile(f"[{LETTERS}]+|[{NUMBERS}]|{SHORT}|[^\\t-\\r \x85\xa0{LETTERS}{NUMBERS}]+")
# Letters and numbers that are newer than ``unicodedata``: whether they are
# letters to the tokenizer, and their lower case, is asked of its library.
_NEWER = "".join(c for c in regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, [*range(0xd800), *range(0xe000, 0x110000)])))
                 if unicodedata.category(c) == "Cn")
_LETTER = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]"), "removed", invert=True)
_LOWER = {ord(c): low for c in _NEWER if (low := normalizers.Lowercase().normalize_str(c)) != c}


def _ranges(chars: str) -> str:
    """The inside of a character class."""
    out: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in out) or "\0"


NEWER = re.compile(f"[{_ranges(_NEWER)}]")


@lru_cache(maxsize=1)
def _words_newer() -> regex.Pattern:
    symbols = _ranges("".join(c for c in _NEWER if not _LETTER.pre_tokenize_str(c)))
    return regex.compile(rf"(?:(?![{symbols}])\p{{L}})+|(?![{symbols}])\p{{N}}|{SHORT}"
                         rf"|(?:[{symbols}]|[^{SPACE}\p{{L}}\p{{N}}])+")


def words_of(text: str) -> list[str]:
    try:
        text.encode("latin-1")  # the quick way to see which characters occur
    except UnicodeEncodeError:
        return _words_newer().findall(text.translate(_LOWER)) if NEWER.search(text) else WORDS.findall(text)
    return WORDS_LATIN.findall(text)


# ------------------------------------------------------------------ vocabulary

@lru_cache(maxsize=1)
def _byte_chars() -> list[str]:
    """The usual printable stand-in of each byte."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(other)) for b in range(256)]


NEW = (1 << 32) - 1


class Vocabulary:
    """A tokenizer file: BPE with word ends, over byte characters."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.suffix = spec["model"]["end_of_word_suffix"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        named = {i: p for p, i in vocab.items()} | {i: p for p, i in self.added.items()}
        self.pieces = [named.get(i, "") for i in range(max(named) + 1)]
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) \
            if self.added else None
        self.inner = [vocab[c] for c in _byte_chars()]
        self.last = [vocab[c + self.suffix] for c in _byte_chars()]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a], vocab[b]] = rank << 32 | vocab[a + b]  # rank and new id in one number

    def merge(self, word: bytes) -> list[int]:
        """Token ids of one word by exact merging."""
        ids = [self.inner[b] for b in word[:-1]] + [self.last[word[-1]]]
        if len(ids) <= LEXICON_BYTES:
            return self._merge_short(ids)
        n = len(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = nxt[i]
            if j < n and (found := self.merges.get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (found, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            found, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one side has gone into another piece
            ids[i], ids[j] = found & NEW, -1
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            if prv[i] >= 0:
                offer(prv[i])
            offer(i)
        return [x for x in ids if x >= 0]

    @cached_property
    def _sorted_pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pair keys in order, their ranks, and the new ids by rank."""
        size = len(self.pieces)
        keys = np.array([a * size + b for a, b in self.merges], np.int64)
        found = np.fromiter(self.merges.values(), np.int64, len(self.merges))
        order, ranks = np.argsort(keys), found >> 32
        new = np.zeros(int(ranks.max(initial=-1)) + 1, np.int64)
        new[ranks] = found & NEW
        return keys[order], ranks[order], new

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` of many words side by side, words of like lengths
        together: in each step every word does its best merge."""
        out: list[list[int]] = [[]] * len(words)
        left = [i for i, w in enumerate(words) if 0 < len(w) <= LEXICON_BYTES]
        for i, w in enumerate(words):
            if len(w) > LEXICON_BYTES:
                out[i] = self.merge(w)
        low, high = 0, 8
        while left and low < LEXICON_BYTES:
            some = [i for i in left if low < len(words[i]) <= high]
            for at in range(0, len(some), SIDE_BY_SIDE):
                part = some[at:at + SIDE_BY_SIDE]
                for i, ids in zip(part, self._merge_block([words[i] for i in part])):
                    out[i] = ids
            low, high = high, 2 * high
        return out

    def _merge_block(self, words: list[bytes]) -> list[list[int]]:
        keys, ranks, new = self._sorted_pairs
        size, none = len(self.pieces), len(new)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        width = int(lengths.max())
        columns = np.arange(width)
        ids = np.full((len(words), width), -1, np.int64)
        ids[columns < lengths[:, None]] = np.array(self.inner)[np.frombuffer(b"".join(words), np.uint8)]
        ids[np.arange(len(words)), lengths - 1] = np.array(self.last)[[w[-1] for w in words]]
        done: list[list[int]] = [[]] * len(words)

        def rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            key = np.where((a < 0) | (b < 0), -1, a * size + b)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            return np.where(keys[at] == key, ranks[at], none) if len(keys) else np.full(key.shape, none)

        beyond = np.full((len(words), 1), -1, np.int64)
        rest, found = np.arange(len(words)), rank(ids, np.hstack([ids[:, 1:], beyond]))
        while len(rest):
            row = np.arange(len(rest))
            at = found.argmin(axis=1)  # the leftmost of the lowest rank
            best = found[row, at]
            over = best == none
            if over.any():
                for i, word in zip(rest[over].tolist(), ids[over].tolist()):
                    done[i] = [x for x in word if x >= 0]
                go = ~over
                rest, ids, found, at, best = rest[go], ids[go], found[go], at[go], best[go]
                row = np.arange(len(rest))
                if not len(rest):
                    break
            ids[row, at] = new[best]
            take = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids, found = np.take_along_axis(ids, take, 1), np.take_along_axis(found, take, 1)
            ids[:, -1], found[:, -1] = -1, none
            found[row, at] = rank(ids[row, at], np.where(at + 1 < width, ids[row, np.minimum(at + 1, width - 1)], -1))
            before = np.maximum(at - 1, 0)
            found[row, before] = rank(ids[row, before], ids[row, np.minimum(before + 1, width - 1)])
        return done

    def _merge_short(self, ids: list[int]) -> list[int]:
        """The same by a list of the pairs' ranks."""
        get, none = self.merges.get, 1 << 62
        found = [get(p, none) for p in zip(ids, ids[1:])]
        while found and (best := min(found)) != none:
            i = found.index(best)
            ids[i:i + 2] = [best & NEW]
            del found[i]
            if i:
                found[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(found):
                found[i] = get((ids[i], ids[i + 1]), none)
        return ids

    def parts(self, text: str) -> Iterator[str | int]:
        """Normalised stretches of text, and ids of added tokens."""
        at = 0
        if self.split is not None and "<" in text:
            for m in self.split.finditer(text):
                yield normalise(text[at:m.start()])
                yield self.added[m[0]]
                at = m.end()
        yield normalise(text[at:] if at else text)


def normalise(text: str) -> str:
    out = unicodedata.normalize("NFC", text)
    if "Σ" in out:  # per code point: no final form
        out = out.replace("Σ", "σ")
    return out.lower()


# ------------------------------------------------------- the acyclic transducer

MAGIC = b"QMAT"


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """Minimal acyclic automaton of the words, in sorted order: a state that
    cannot change any more is replaced by an equal one if there is one."""
    register: dict[tuple, int] = {}
    states: list[tuple[bool, list[tuple[int, int]]]] = []  # final, arcs (label, state)
    counts: list[int] = []

    def freeze(node) -> int:
        final, arcs = node
        key = final, tuple(arcs)
        if key not in register:
            register[key] = len(states)
            states.append((final, arcs))
            counts.append(final + sum(counts[s] for _, s in arcs))
        return register[key]

    path: list[list] = [[False, []]]  # open states along the last word

    def close(depth: int, word: bytes) -> None:
        while len(path) > depth + 1:
            done = freeze(path.pop())
            path[-1][1].append((word[len(path) - 1], done))

    last, ids, offsets = b"", [], [0]
    for word in sorted(entries):
        common = len(os.path.commonprefix([last, word]))
        close(common, last)
        path.extend([False, []] for _ in word[common:])
        path[-1][0] = True
        ids.extend(entries[word])
        offsets.append(len(ids))
        last = word
    close(0, last)
    root = freeze(path[0])
    first, labels, targets, outputs = [0], [], [], []
    for final, arcs in states:
        out = int(final)
        for label, s in arcs:
            labels.append(label)
            targets.append(s)
            outputs.append(out)
            out += counts[s]
        first.append(len(labels))
    blocks = [np.array(x, "<i4") for x in (first, targets, outputs, [f for f, _ in states], offsets, ids)]
    return MAGIC + struct.pack("<i7i", root, *map(len, blocks), len(labels)) + b"".join(b.tobytes() for b in blocks) \
        + bytes(labels)


class Lexicon:
    """The compiled automaton, memory-mapped."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        if self.map[:4] != MAGIC:
            raise ValueError(f"not a lexicon: {path}")
        self.root, *sizes, labels = struct.unpack("<i7i", self.map[4:36])
        view, at, blocks = memoryview(self.map), 36, []
        for n in sizes:
            blocks.append(view[at:at + 4 * n].cast("i"))
            at += 4 * n
        self.first, self.targets, self.outputs, self.final, self.offsets, self.ids = blocks
        self.labels = at  # one byte for each arc, to the end of the file

    def find(self, word: bytes) -> list[int] | None:
        """The ids of the word, or None: follow its bytes, add the outputs."""
        return self.find_all([word])[0]

    @cached_property
    def _arcs(self) -> tuple[np.ndarray, ...]:
        """The arcs' keys (state, then label; they are in this order), their
        targets and outputs, and which states are final."""
        first = np.asarray(self.first)
        labels = np.frombuffer(self.map, np.uint8, len(self.targets), self.labels)
        keys = np.repeat(np.arange(len(first) - 1), np.diff(first)) << 8 | labels
        return keys, np.asarray(self.targets), np.asarray(self.outputs), np.asarray(self.final) > 0

    def find_all(self, words: list[bytes]) -> list[list[int] | None]:
        """The same for many words, byte by byte side by side."""
        keys, targets, outputs, final = self._arcs
        out: list[list[int] | None] = [None] * len(words)
        order = sorted((i for i, w in enumerate(words) if len(w) <= LEXICON_BYTES), key=lambda i: -len(words[i]))
        if not order or not len(keys):
            return out
        lengths = np.array([len(words[i]) for i in order])
        starts = np.cumsum(lengths) - lengths
        raw = np.frombuffer(b"".join([words[i] for i in order]), np.uint8)
        state, place, on = np.full(len(order), self.root, np.int64), np.zeros(len(order), np.int64), np.arange(len(order))
        for k in range(int(lengths[0])):
            on = on[lengths[on] > k]
            key = state[on] << 8 | raw[starts[on] + k]
            arc = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            there = keys[arc] == key
            state[on[~there]] = -1
            on, arc = on[there], arc[there]
            state[on], place[on] = targets[arc], place[on] + outputs[arc]
        held = np.flatnonzero(state >= 0)
        held = held[final[state[held]]]
        for i, at in zip(held.tolist(), place[held].tolist()):
            out[order[i]] = self.ids[self.offsets[at]:self.offsets[at + 1]].tolist()
        return out


class Memo(dict):
    """word -> place; a new word gets the next one."""

    def __init__(self):
        self.words: list[str | int] = []

    def __missing__(self, word: str | int) -> int:
        self[word] = place = len(self.words)
        self.words.append(word)
        return place


class Encoder:
    """Texts to ids (little-endian bytes) and back, many texts together. The
    words that a bounded memo does not know go through the automaton, and the
    others are merged exactly; the memo keeps a word's ids and their text."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.memo, self.ids, self.texts = Memo(), [], []

    def _learn(self) -> None:
        """Ids and texts of the words that are new in the memo."""
        new = self.memo.words[len(self.ids):]
        raws = [w.encode("utf-8") if isinstance(w, str) else b"" for w in new]
        found = self.lexicon.find_all(raws) if self.lexicon is not None else [None] * len(new)
        for i, w in enumerate(new):
            if isinstance(w, int):  # the id of an added token
                found[i] = [w]
        others = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(others, self.vocabulary.merge_all([raws[i] for i in others])):
            found[i] = ids
        name = self.vocabulary.pieces.__getitem__
        self.ids += [struct.pack(f"<{len(ids)}I", *ids) for ids in found]
        self.texts += [" ".join(map(name, ids)) for ids in found]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0][0]

    def encode_all(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """(ids, the text they decode to) of each text."""
        place, places = self.memo.__getitem__, []
        for text in texts:
            at: list[int] = []
            for part in self.vocabulary.parts(text or ""):
                at += map(place, (part,) if isinstance(part, int) else words_of(part))
            places.append(at)
        self._learn()
        ids, decoded = self.ids.__getitem__, self.texts.__getitem__
        out = [(b"".join(map(ids, at)), " ".join(map(decoded, at))) for at in places]
        if len(self.ids) > MEMO_WORDS:  # what the last texts held stays, within the bound
            old, used = self.memo.words, sorted(set().union(*places))
            used = [i for i in used if isinstance(old[i], int) or len(old[i]) <= LEXICON_BYTES][:MEMO_WORDS // 2]
            self.memo = Memo()
            for i in used:
                self.memo[old[i]]
            self.ids, self.texts = [self.ids[i] for i in used], [self.texts[i] for i in used]
        return out

    def decode(self, ids: bytes | None) -> str:
        return " ".join(map(self.vocabulary.pieces.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


# ----------------------------------------------------------------- Spark side

CODED = StructType([StructField("ids", BinaryType()), StructField("decoded", StringType())])


@lru_cache(maxsize=1)
def _vocabulary(tokenizer: str) -> Vocabulary:
    return Vocabulary(SparkFiles.get(tokenizer))


@lru_cache(maxsize=1)
def _encoder(tokenizer: str, lexicon: str | None) -> Encoder:
    """One per worker process, the last one used; the names are those of
    files added to the job."""
    gc.collect()
    gc.freeze()  # the memo's many small objects are not worth looking through
    return Encoder(_vocabulary(tokenizer), Lexicon(SparkFiles.get(lexicon)) if lexicon else None)


def _ship(spark: SparkSession, path: str) -> str:
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def frequent_words(df: DataFrame, tokenizer_path: str, text_col: str = "text", words: int = LEXICON_WORDS) -> list[str]:
    """The ``words`` most frequent words over all texts (ties by word); each
    task counts what it has read before anything is shuffled, and only the
    chosen words reach the driver."""
    tokenizer = _ship(df.sparkSession, tokenizer_path)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary, seen = _vocabulary(tokenizer), Counter()

        def out():
            got = [(w, n) for w, n in seen.items() if len(w) <= LEXICON_BYTES]
            return pd.DataFrame(got, columns=["word", "n"]).astype({"n": "int64"})

        for pdf in batches:
            for text in pdf["text"]:
                for part in vocabulary.parts(text or ""):
                    if not isinstance(part, int):
                        seen.update(words_of(part))
            if len(seen) > FLUSH_WORDS:
                yield out()
                seen.clear()
        yield out()

    counted = materialise(
        df.select(F.col(text_col).alias("text")).mapInPandas(count, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).where(f"n >= {LEAST_COUNT}"))
    # all words of the high bins (64 to a power of two, so few whatever the
    # counts are) and the best of the bin in which the number is reached
    size = F.floor(F.log2("n") * 64)
    total, left, at = 0, 0, None
    for r in counted.groupBy(size.alias("size")).count().orderBy(F.col("size").desc()).collect():
        if total + r["count"] > words:
            at, left = r["size"], words - total
            break
        total += r["count"]
    if at is None:
        return sorted(r.word for r in counted.select("word").collect())
    high = counted.where(size > at).select("word").collect()
    last = counted.where(size == at).orderBy(F.desc("n"), "word").limit(left).select("word").collect()
    return sorted(r.word for r in high + last)


def build_lexicon(df: DataFrame, tokenizer_path: str, text_col: str = "text", words: int = LEXICON_WORDS) -> str:
    """Compiles the frequent words; returns the path of the file."""
    vocabulary = Vocabulary(tokenizer_path)
    entries = {raw: vocabulary.merge(raw) for raw in
               (w.encode("utf-8") for w in frequent_words(df, tokenizer_path, text_col, words))
               if len(raw) <= LEXICON_BYTES}
    path = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), f"lexicon-{uuid.uuid4().hex}.bin")
    with open(path, "wb") as f:
        f.write(compile_lexicon(entries))
    return path


def encode(df: DataFrame, tokenizer_path: str, text_col: str = "text", words: int = LEXICON_WORDS,
           decoded: bool = False) -> DataFrame:
    """``row`` (the input row), ``ids`` (binary: little-endian unsigned
    32-bit token ids); with ``decoded`` also the text that the ids decode to,
    made in the same pass."""
    spark = df.sparkSession
    small_batches(spark)
    lexicon = _ship(spark, build_lexicon(df, tokenizer_path, text_col, words))
    tokenizer = os.path.basename(tokenizer_path)

    @F.pandas_udf(CODED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer, lexicon)
        for texts in batches:
            out = []
            for some in stretches(texts, TOGETHER):
                out += encoder.encode_all(some)
            yield pd.DataFrame({"ids": [i for i, _ in out], "decoded": [t if decoded else None for _, t in out]})

    out = packed(df).withColumn("coded", run(F.col("row")[text_col])).select("row", "coded.*")
    return out if decoded else out.drop("decoded")


def decode(df: DataFrame, tokenizer_path: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded``: the text of the ids."""
    tokenizer = _ship(df.sparkSession, tokenizer_path)

    @F.pandas_udf(StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(_vocabulary(tokenizer), None)
        for ids in batches:
            yield pd.Series([encoder.decode(x) for x in ids], dtype="object")

    return df.withColumn("decoded", run(F.col(ids_col)))


def digests(df: DataFrame) -> list:
    """Columns that sum up ``ids`` and ``decoded``."""
    return [(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
            F.sha2(F.col("ids"), 256).alias("ids_sha256"),
            F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")]
