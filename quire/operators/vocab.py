"""Vocabularies and tokenisation as corpus jobs.

* Word counts are a partial+final hash aggregate over exploded words.
* A vocabulary is a table ``(id, piece, score, origin)``; position = id.
* Encoding with a vocabulary that is measured small is a broadcast lookup per
  row (no shuffle); otherwise exploded tokens are joined with the vocabulary,
  hot pieces split by salt, and regrouped per row in position order.
* BPE training works on the distinct weighted pre-tokens: pairs are counted
  once, then only the words that hold a merged pair change the counts; a job
  settles many merges (``train_bpe``). Ties: count desc, left, right.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import text as tx
from quire.operators.joins import split_join
from quire.operators.order import with_row_index
from quire.session import broadcast_if_small, cut_lineage, fits_broadcast

VOCAB_BROADCAST_ROWS = 2_000_000
# Fixed value: the SentencePiece word-boundary marker (U+2581).
SP_SPACE = "▁"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ws_tokens(text) -> Column:
    """Whitespace tokens (Python ``str.split()``); '' -> []."""
    t = tx.strip_py(_c(text))
    return F.when(F.length(t) == 0, F.array().cast("array<string>")).otherwise(F.split(t, tx.WS_CLASS + "+"))


def word_freq(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, freq) over a corpus."""
    return (df.select(F.explode(ws_tokens(text_col)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("freq")))


def word_freq_by(df: DataFrame, group_col: str, text_col: str = "text") -> DataFrame:
    """A14 per group: (group, word, freq) in one scan; sums over the groups
    give the counts of the corpus."""
    return (df.select(group_col, F.explode(ws_tokens(text_col)).alias("word"))
            .groupBy(group_col, "word").agg(F.count(F.lit(1)).alias("freq")))


def top_words(freq: DataFrame, k: int, tie_cols=("word",)) -> DataFrame:
    """K most frequent words, frequency descending, ties by ``tie_cols``
    (file line order when read from a frequency file)."""
    return freq.orderBy(F.desc("freq"), *tie_cols).limit(k)


def vocab_from_words(words: DataFrame, order_cols, specials=(), origin: str = "words") -> DataFrame:
    """Vocabulary table: specials first, then words in ``order_cols`` order.

    Ids come from a window over the (bounded) word list; vocabularies are
    tens of thousands of rows, not corpus-sized."""
    spark = words.sparkSession
    n_sp = len(specials)
    w = Window.orderBy(*order_cols)
    body = words.select(F.col("word").alias("piece"), (F.row_number().over(w) - 1 + n_sp).alias("id"))
    sp = spark.createDataFrame([(i, s) for i, s in enumerate(specials)], "id int, piece string")
    out = sp.select(F.col("id").cast("long"), "piece").unionByName(body.select(F.col("id").cast("long"), "piece"))
    return out.select("id", "piece", F.lit(0.0).alias("score"), F.lit(origin).alias("origin"))


def new_pieces(candidates: DataFrame, *existing: DataFrame, col: str = "piece",
               bounds=None) -> DataFrame:
    """Candidates not present in any of ``existing`` (left anti).
    ``bounds`` (one per existing table, None = unknown) lets a vocabulary of
    proven size be broadcast without counting it."""
    out = candidates
    bounds = list(bounds) if bounds is not None else [None] * len(existing)
    for ex, b in zip(existing, bounds):
        side = ex.select(F.col(col)).distinct()
        side = broadcast_if_small(side, VOCAB_BROADCAST_ROWS, bound=b) if b is not None else side
        out = out.join(side, col, "left_anti")
    return out


def merge_vocab(base: DataFrame, domain: DataFrame, cjk_words: DataFrame | None = None,
                top: DataFrame | None = None, base_rows: int | None = None,
                domain_rows: int | None = None) -> DataFrame:
    """Append to ``base`` (id, piece, score) in order: domain pieces not
    in base (domain order), then all-Han words not in base or added (code
    point order), then top words not in base or added (frequency rank).
    New pieces get score 0. Returns (id, piece, score, origin, step)."""
    b = base.select("id", "piece", "score", F.lit("base").alias("origin"), F.lit(0).alias("step"),
                    F.col("id").cast("long").alias("__o"))
    parts = [b]
    d = new_pieces(domain.select("piece", F.col("id").alias("__o")), base, bounds=[base_rows])
    parts.append(d.select(F.lit(None).cast("long").alias("id"), "piece", F.lit(0.0).alias("score"),
                          F.lit("domain").alias("origin"), F.lit(1).alias("step"), F.col("__o").cast("long")))
    added = d.select("piece")
    if cjk_words is not None:
        c = cjk_words.select(F.col("word").alias("piece")).where(tx.is_cjk_word(F.col("piece"))).distinct()
        c = new_pieces(c, base, added, bounds=[base_rows, domain_rows])
        parts.append(c.select(F.lit(None).cast("long").alias("id"), "piece", F.lit(0.0).alias("score"),
                              F.lit("cjk").alias("origin"), F.lit(2).alias("step"), F.lit(0).cast("long").alias("__o")))
        added = added.unionByName(c.select("piece"))
    if top is not None:
        t = top.select(F.col("word").alias("piece"), F.col("rank").cast("long").alias("__o"))
        t = new_pieces(t, base, added, bounds=[base_rows, None])
        parts.append(t.select(F.lit(None).cast("long").alias("id"), "piece", F.lit(0.0).alias("score"),
                              F.lit("top").alias("origin"), F.lit(3).alias("step"), "__o"))
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    # the all-Han words can be corpus-sized: numbered by ranges, not by one window
    return with_row_index(allp.drop("id"), ["step", "__o", "piece"], name="id") \
        .select("id", "piece", "score", "origin", "step")


# ------------------------------------------------------------- encoding ---

def encode(df: DataFrame, key_cols, tokens: Column, vocab: DataFrame, unk_id: int,
           out: str = "ids", lookup_rows: int = VOCAB_BROADCAST_ROWS) -> DataFrame:
    """J6/T4 (word level): token strings -> ids in position order.

    A vocabulary that is measured small (rows and bytes) is looked up in an
    Arrow batch function (no shuffle). A larger one of any size is joined with
    the exploded tokens, the tokens of a hot piece split by salt, and rows are
    regrouped by key in the order of positions. Rows with no tokens come back
    with []."""
    key_cols = list(key_cols)
    pieces = vocab.select("piece", F.col("id").cast("int").alias("__id"))
    if fits_broadcast(pieces, lookup_rows):
        return df.withColumn(out, encode_lookup(tokens, vocab, unk_id))
    ex = df.select(*key_cols, F.posexplode(tokens).alias("__pos", "piece"))
    looked = split_join(ex, pieces, "piece", "left", lookup_rows=lookup_rows).select(
        *key_cols, "__pos", F.coalesce("__id", F.lit(unk_id)).alias("__id"))
    grouped = looked.groupBy(*key_cols).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__pos", "__id"))), lambda s: s["__id"]).alias(out))
    return df.join(grouped, key_cols, "left").withColumn(
        out, F.coalesce(F.col(out), F.array().cast("array<int>")))


def encode_lookup(tokens: Column, vocab: DataFrame, unk_id: int) -> Column:
    """J6/T4 for a vocabulary that has been measured small: the piece -> id
    table is collected once, broadcast to the executors, and looked up per
    token inside an Arrow batch function. Unlike the join path this needs
    no shuffle of tokens and no shuffle of the rows to regroup them."""
    spark = vocab.sparkSession
    table = {r["piece"]: int(r["id"]) for r in vocab.select("piece", "id").collect()}
    bc = spark.sparkContext.broadcast(table)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def _lookup(toks: pd.Series) -> pd.Series:
        m = bc.value
        return pd.Series([None if t is None else [m.get(x, unk_id) for x in t] for t in toks])
    return _lookup(tokens)


def decode(df: DataFrame, key_cols, ids: str, vocab: DataFrame, skip_ids=(), out: str = "text",
           sep: str = " ", lookup_rows: int = VOCAB_BROADCAST_ROWS) -> DataFrame:
    """Ids -> pieces (specials in ``skip_ids`` dropped) joined by
    ``sep``, stripped; the lookup as in ``encode``."""
    key_cols = list(key_cols)
    ex = df.select(*key_cols, F.posexplode(F.col(ids)).alias("__pos", "__id"))
    if skip_ids:
        ex = ex.where(~F.col("__id").isin(list(skip_ids)))
    looked = split_join(ex, vocab.select(F.col("id").cast("int").alias("__id"), "piece"), "__id", "left",
                        lookup_rows=lookup_rows)
    grouped = looked.groupBy(*key_cols).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__pos", F.coalesce("piece", F.lit("")).alias("p")))),
                    lambda s: s["p"]).alias("__p"))
    return df.join(grouped, key_cols, "left").withColumn(
        out, tx.strip_py(F.array_join(F.coalesce(F.col("__p"), F.array().cast("array<string>")), sep))).drop("__p")


def decode_pieces(pieces) -> Column:
    """T5: concatenate pieces, marker -> space, strip the leading space."""
    return F.regexp_replace(F.regexp_replace(F.array_join(_c(pieces), ""), SP_SPACE, " "), "^ ", "")


def fertility(freq: DataFrame, group_col: str, vocabs: dict[str, DataFrame], vocab_rows: int | None = None) -> DataFrame:
    """Tokens per word by group for several vocabularies at once, from
    word counts (group, word, freq): a known word is one token, an unknown
    word falls back to one token per character. Adds ``words`` and a column
    per vocabulary name."""
    known = None
    for name, v in vocabs.items():
        one = v.select(F.col("piece").alias("word")).distinct().withColumn(name, F.lit(1))
        known = one if known is None else known.join(one, "word", "full")
    side = known if vocab_rows is None else broadcast_if_small(known, VOCAB_BROADCAST_ROWS, bound=vocab_rows)
    seen = freq.join(side, "word", "left")
    tokens = [F.sum(F.col("freq") * F.when(F.col(name).isNotNull(), 1).otherwise(F.length("word"))) / F.sum("freq") for name in vocabs]
    return seen.groupBy(group_col).agg(*[t.alias(n) for t, n in zip(tokens, vocabs)], F.sum("freq").alias("words"))


# ------------------------------------------------------------------ BPE ---

_NFKC_CACHE = {}


def nfkc() -> Column:
    """NFKC normalisation (no Catalyst built-in): Arrow-batched UDF."""
    if "f" not in _NFKC_CACHE:
        @F.pandas_udf(T.StringType())
        def _nfkc(s: pd.Series) -> pd.Series:
            return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))
        _NFKC_CACHE["f"] = _nfkc
    return _NFKC_CACHE["f"]


# Scripts whose change ends a pre-token; the East Asian ones are mixed within
# words and count as one.
SCRIPTS = (("Han", "Hiragana", "Katakana"), ("Latin",), ("Greek",), ("Cyrillic",), ("Arabic",), ("Hebrew",),
           ("Devanagari",), ("Hangul",), ("Thai",))


def pretoken_pattern(script_prefix: str = "Is") -> str:
    """Words of one script, single digits, runs of other characters, each
    with the boundary marker that stands before it (``script_prefix``: how
    the regex dialect spells a script)."""
    names = [[f"\\p{{{script_prefix}{n}}}" for n in group] for group in SCRIPTS]
    words = [f"{SP_SPACE}?[{''.join(g)}\\p{{M}}]+" for g in names]
    known = "".join(n for g in names for n in g)
    other = f"{SP_SPACE}?[^{known}\\p{{M}}\\p{{N}}\\p{{P}}\\p{{S}}\\p{{Z}}\\p{{C}}{SP_SPACE}]+"
    return "|".join([*words, other, f"{SP_SPACE}?\\p{{N}}",
                     f"{SP_SPACE}?[^{known}\\p{{L}}\\p{{M}}\\p{{N}}{SP_SPACE}]+", SP_SPACE])


def pretokens(text: Column, normalise: bool = True) -> Column:
    """Pre-tokens for BPE: NFKC, spaces -> marker with a leading marker,
    split before every marker, every digit alone, and where the script or
    the kind of character changes."""
    t = nfkc()(text) if normalise else text
    t = F.concat(F.lit(SP_SPACE), F.regexp_replace(t, " ", SP_SPACE))
    return F.regexp_extract_all(t, F.lit(f"({pretoken_pattern()})"), 1)


def text_lines(corpus: DataFrame, text_col: str = "text", keep=(), max_bytes: int | None = None) -> DataFrame:
    """The non-empty lines of every text (``keep`` columns, line_no, line).
    ``max_bytes`` leaves out longer lines; by default none is left out."""
    lines = corpus.select(*keep, F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line")).where("line <> ''")
    return lines if max_bytes is None else lines.where(F.octet_length("line") <= max_bytes)


def skipped_lines(corpus: DataFrame, max_bytes: int, text_col: str = "text") -> DataFrame:
    """How many lines, and bytes of them, a limit of ``max_bytes`` leaves out."""
    n = F.octet_length("line")
    return text_lines(corpus, text_col).where(n > max_bytes).agg(
        F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("bytes"))


def bpe_words(corpus: DataFrame, text_col: str = "text", max_bytes: int | None = None,
              normalise: bool = True) -> DataFrame:
    """Distinct weighted pre-tokens of all lines (those over ``max_bytes``
    UTF-8 bytes only if a limit is asked for) with their symbol arrays (one
    symbol per character)."""
    line = nfkc()(F.col("line")) if normalise else F.col("line")
    # no pre-token goes on behind a marker, so each run between markers is split once
    runs = text_lines(corpus, text_col, max_bytes=max_bytes) \
        .select(F.explode(F.split(line, f"[ {SP_SPACE}]")).alias("run")) \
        .groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    w = runs.select(F.explode(pretokens(F.col("run"), normalise=False)).alias("word"), "n") \
        .groupBy("word").agg(F.sum("n").alias("freq"))
    return w.select("word", "freq", tx.chars(F.col("word")).alias("syms"))


def pair_counts(words: DataFrame) -> DataFrame:
    """Adjacent symbol pair counts weighted by word frequency."""
    pairs = words.where(F.size("syms") >= 2).select(
        "freq", F.explode(F.arrays_zip(F.slice("syms", 1, F.size("syms") - 1).alias("l"),
                                       F.slice("syms", 2, F.size("syms")).alias("r"))).alias("p"))
    return pairs.groupBy(F.col("p.l").alias("l"), F.col("p.r").alias("r")).agg(F.sum("freq").alias("cnt"))


# BPE training packs the distinct words into arrays of symbol numbers: a
# character is its code point, a merged symbol the next free number.
END = ord("\n")      # after each word (no word holds it, as lines are split there)
MADE = 0x110000      # the first number of a merged symbol
PACKED = 1 << 18     # symbols of a packed row, about
PACKED_WORDS = 200_000  # of a partition
SPECULATED = 192     # merges whose effect one job counts at most
PENDING = 128        # merges that a job applies to the stored words before they are stored anew
HEAD_PAIRS = 1_000_000
SAMPLE_WORDS = 100_000  # on the driver, to guess the next merges; results do not depend on it
LOW = (1 << 32) - 1


def _places(s: np.ndarray, left: int, right: int) -> np.ndarray:
    """Where a merge applies, left to right and not overlapping."""
    at = np.flatnonzero(s[:-1] == left)
    at = at[s[at + 1] == right]
    if left == right and len(at) > 1:  # every second place of a run
        first = np.r_[True, np.diff(at) != 1]
        at = at[(at - np.maximum.accumulate(np.where(first, at, 0))) % 2 == 0]
    return at


def _merged(s: np.ndarray, at: np.ndarray, made: int) -> np.ndarray:
    keep = np.ones(len(s), bool)
    keep[at + 1] = False
    s = s[keep]
    s[at - np.arange(len(at))] = made
    return s


def _rewritten(s: np.ndarray, merges: list[tuple[int, int, int]]) -> np.ndarray:
    for left, right, made in merges:
        if len(at := _places(s, left, right)):
            s = _merged(s, at, made)
    return s


def _summed(pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of ``n`` by pair, without zeros."""
    if not len(pairs):
        return pairs, n
    order = np.argsort(pairs, kind="stable")
    pairs, n = pairs[order], n[order]
    first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    pairs, n = pairs[first], np.add.reduceat(n, first)
    return pairs[n != 0], n[n != 0]


def _summed_parts(parts: list) -> tuple[np.ndarray, np.ndarray]:
    return _summed(np.concatenate([p for p, _ in parts]), np.concatenate([n for _, n in parts]))


def _pairs_at(s: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that begin at places, each with its weight; none over the end
    of a word."""
    inside = at >= 0
    at, n = at[inside], n[inside]
    left, right = s[at].astype(np.int64), s[at + 1].astype(np.int64)
    inside = (left != END) & (right != END)
    return (left[inside] << 32) | right[inside], n[inside]


def _change(s: np.ndarray, at: np.ndarray, new: np.ndarray, freq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a merge at places changes in the pair counts: the pairs before,
    at and behind each place go, those before and behind the new symbol come."""
    n = freq[np.searchsorted(np.flatnonzero(s == END), at)]
    apart = np.r_[True, np.diff(at) != 2]  # else the pair between two places counts once
    now = at - np.arange(len(at))
    gone = [_pairs_at(s, at[apart] - 1, -n[apart]), _pairs_at(s, at, -n), _pairs_at(s, at + 1, -n)]
    come = [_pairs_at(new, now[apart] - 1, n[apart]), _pairs_at(new, now, n)]
    return _summed_parts(gone + come)


def _unpacked(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for s, freq in zip(pdf["s"], pdf["freq"]):
        yield np.frombuffer(s, np.int32), np.frombuffer(freq, np.int64)


def _packed(words: DataFrame) -> DataFrame:
    """(s, freq): many words a row, each with END behind it, and their counts."""
    def pack(held):
        word = pd.concat([w for w, _ in held])
        return pd.DataFrame({"s": ["\n".join([*word, ""]).encode("utf-32-le")],
                             "freq": [np.concatenate([f for _, f in held]).astype(np.int64).tobytes()]})

    def run(batches):
        held, n = [], 0
        for pdf in batches:
            if len(pdf):
                held.append((pdf["word"], pdf["freq"].to_numpy()))
                n += int(pdf["word"].str.len().sum()) + len(pdf)
            if n > PACKED:
                yield pack(held)
                held, n = [], 0
        if held:
            yield pack(held)
    return words.select("word", "freq").mapInPandas(run, "s binary, freq binary")


def _stored(words: DataFrame, merges: list[tuple[int, int, int]]) -> DataFrame:
    """The words after the merges, in the shared folder; those of one symbol
    have no pair any more and go."""
    def run(batches):
        for pdf in batches:
            for s, freq in _unpacked(pdf):
                s = _rewritten(s, merges)
                size = np.diff(np.r_[-1, np.flatnonzero(s == END)])  # with END
                some = size > 2
                yield pd.DataFrame({"s": [s[np.repeat(some, size)].tobytes()], "freq": [freq[some].tobytes()]})
    return cut_lineage(words.mapInPandas(run, "s binary, freq binary").where(F.octet_length("s") > 0))


def _pair_table(words: DataFrame) -> DataFrame:
    """(pair, n) of all adjacent symbols (the left one in the upper half of the
    number); each task adds up its own first."""
    def run(batches):
        parts, held = [], 0
        for pdf in batches:
            for s, freq in _unpacked(pdf):
                size = np.diff(np.r_[-1, np.flatnonzero(s == END)])
                parts.append(_summed(*_pairs_at(s, np.arange(len(s) - 1), np.repeat(freq, size)[:-1])))
                held += len(parts[-1][0])
                if held > HEAD_PAIRS:
                    parts = [_summed_parts(parts)]
                    held = len(parts[0][0])
                    if held > HEAD_PAIRS:
                        yield pd.DataFrame(dict(zip(("pair", "n"), parts.pop())))
                        held = 0
        if parts:
            yield pd.DataFrame(dict(zip(("pair", "n"), _summed_parts(parts))))
    return words.mapInPandas(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _changes(words: DataFrame, pending: list[tuple[int, int, int]], picked: list[tuple[int, int, int]]) -> list:
    """What each picked merge, one after the other, changes in the pair
    counts: (pairs, changes) per merge. The words themselves stay as they are."""
    def run(batches):
        parts = [[] for _ in picked]
        for pdf in batches:
            for s, freq in _unpacked(pdf):
                s = _rewritten(s, pending)
                for own, (left, right, made) in zip(parts, picked):
                    if len(at := _places(s, left, right)):
                        new = _merged(s, at, made)
                        own.append(_change(s, at, new, freq))
                        s = new
                        if len(own) == 32:
                            own[:] = [_summed_parts(own)]
        some = [(i, *_summed_parts(own)) for i, own in enumerate(parts) if own]
        if some:
            yield pd.DataFrame({"merge": np.repeat(np.array([i for i, _, _ in some], np.int32), [len(p) for _, p, _ in some]),
                                "pair": np.concatenate([p for _, p, _ in some]), "n": np.concatenate([n for _, _, n in some])})
    got = (words.mapInPandas(run, "merge int, pair long, n long").groupBy("merge", "pair").agg(F.sum("n").alias("n"))
           .where("n <> 0").toArrow())
    merge, pair, n = (got[c].to_numpy() for c in ("merge", "pair", "n"))
    order = np.argsort(merge, kind="stable")
    cuts = np.searchsorted(merge[order], np.arange(len(picked) + 1))
    return [(pair[order[a:b]], n[order[a:b]]) for a, b in zip(cuts, cuts[1:])]


class _Pairs:
    """The head of the pair table on the driver: the pairs of the highest
    counts, and every pair that a merge has made since. Counts of old pairs
    never rise, so a pair that is not here stays at or below ``floor``; when the
    best one here is no longer above it, the head is counted anew. At most
    ``HEAD_PAIRS`` pairs and those that the merges make, whatever the corpus."""

    def __init__(self):
        self.name: dict[int, str] = {}   # merged symbol -> its text
        self.order: dict[int, int] = {}  # merged symbol -> its place among equals
        self.counts: dict[int, int] = {}
        self.heap: list[tuple] = []
        self.floor = 0

    def text(self, symbol: int) -> str:
        return self.name[symbol] if symbol >= MADE else chr(symbol)

    def entry(self, pair: int, n: int) -> tuple:
        left, right = pair >> 32, pair & LOW
        return -n, self.text(left), self.text(right), self.order.get(left, left), self.order.get(right, right), pair

    def start(self, words: DataFrame, head: int) -> None:
        top = _pair_table(words).orderBy(F.desc("n")).limit(head).collect()
        self.counts = {r["pair"]: r["n"] for r in top}
        self.floor = min(self.counts.values()) if len(top) == head else 0
        self._heap_anew()

    def _heap_anew(self) -> None:
        self.heap = [self.entry(pair, n) for pair, n in self.counts.items() if n > 0]
        heapq.heapify(self.heap)

    def add(self, pairs: list[int], changes: list[int], made: int) -> None:
        """Changes of counts; pairs that are neither known nor just made lie
        below the floor and are not followed."""
        for pair, change in zip(pairs, changes):
            if pair in self.counts or made in (pair >> 32, pair & LOW):
                n = self.counts[pair] = self.counts.get(pair, 0) + change
                if n > 0:
                    heapq.heappush(self.heap, self.entry(pair, n))
        if len(self.heap) > 4 * len(self.counts) + 1000:
            self._heap_anew()

    def best(self, k: int = 1) -> list[tuple[int, int]]:
        """The k best pairs by (count, texts); fewer if the head is used up."""
        out, seen = [], set()
        while self.heap and len(out) < k:
            entry = heapq.heappop(self.heap)
            n, pair = entry[0], entry[-1]
            if self.counts.get(pair) == -n and pair not in seen:
                if -n <= self.floor:
                    heapq.heappush(self.heap, entry)
                    break
                seen.add(pair)
                out.append((pair, -n, entry))
        for _, _, entry in out:
            heapq.heappush(self.heap, entry)
        return [(pair, n) for pair, n, _ in out]


def _disjoint(best: list[tuple[int, int]], k: int) -> list[int]:
    """Up to k pairs that share no symbol."""
    held, some = set(), []
    for pair, _ in best:
        if held.isdisjoint((pair >> 32, pair & LOW)):
            held.update((pair >> 32, pair & LOW))
            some.append(pair)
    return some[:k]


def _sample(words: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """At most k words, drawn with chances that follow their counts (priority
    sampling: by count / u, with the weight that keeps sums unbiased)."""
    u = (F.pmod(F.xxhash64("word"), F.lit(1 << 30)) + 1) / F.lit(float(1 << 30))
    rows = words.select("word", "freq", (F.col("freq") / u).alias("q")).orderBy(F.desc("q")).limit(k).collect()
    low = int(rows[-1]["q"]) if len(rows) == k else 0
    return (np.frombuffer("\n".join([*(r["word"] for r in rows), ""]).encode("utf-32-le"), np.int32),
            np.array([max(r["freq"], low) for r in rows], np.int64))


def _guess(pairs: _Pairs, sample: tuple, queue: list[int], k: int, merges_per_round: int, free: int) -> list[tuple[int, int, int]]:
    """The next merges, the first of them for certain: the table's best pairs,
    with the changes that the sample tells of (scaled to the table's count)."""
    best = pairs.best(max(4 * k, 8 * merges_per_round))
    known = dict(best)
    low = best[-1][1] if len(best) == max(4 * k, 8 * merges_per_round) else 0
    heap, queue, out, (s, freq) = [pairs.entry(*x) for x in best], list(queue), [], sample
    heapq.heapify(heap)

    def top(most: int) -> list[tuple[int, int]]:
        some = {}
        while heap and len(some) < most:
            entry = heapq.heappop(heap)
            if known.get(entry[-1]) == -entry[0]:
                some[entry[-1]] = entry
        for entry in some.values():
            heapq.heappush(heap, entry)
        return [(pair, -entry[0]) for pair, entry in some.items()]

    while len(out) < k:
        if not queue:
            queue = [p for p, _ in top(1)] if merges_per_round == 1 else _disjoint(top(8 * merges_per_round), merges_per_round)
        if not queue:
            break
        pair, made = queue.pop(0), free + len(out)
        left, right = pair >> 32, pair & LOW
        pairs.name[made] = pairs.text(left) + pairs.text(right)
        out.append((left, right, made))
        n = known.pop(pair, 0)
        if not len(at := _places(s, left, right)):
            continue
        new = _merged(s, at, made)
        other, change = _change(s, at, new, freq)
        s, scale = new, n / max(1, -int(change[other == pair].sum()))
        fresh = ((other >> 32) == made) | ((other & LOW) == made)
        for p, x, isnew in zip(other.tolist(), (change * scale).tolist(), fresh.tolist()):
            if p in known or isnew:
                known[p] = known.get(p, 0) + int(x)
                if known[p] > low:
                    heapq.heappush(heap, pairs.entry(p, known[p]))
    return out


def train_bpe(corpus: DataFrame, num_merges: int, text_col: str = "text", normalise: bool = True,
              merges_per_round: int = 1, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """BPE merges over the distinct weighted pre-tokens; best pair by
    (count desc, left, right). Returns (rank, left, right, merged, count).

    Pairs are counted once. A job then takes up to ``SPECULATED`` merges that a
    bounded sample of words makes likely and counts, over all words, what each
    would change after the ones before. The driver replays the changes: as long
    as the merge that is due by the table is among them, it is final and its
    changes enter the table. It may come before others of the list if they do not
    touch it anywhere: neither changes the count of the other's pair, nor the
    pairs of the other's new symbol. So each merge is the one that a recount
    would pick (exact mode, ``merges_per_round=1``); the words are rewritten as
    arrays, stored anew every ``PENDING`` merges.

    With ``merges_per_round`` k > 1 a round takes up to k best pairs that share
    no symbol without looking at the pairs made in between, which may differ from
    exact mode there."""
    return _train(cut_lineage(bpe_words(corpus, text_col, normalise=normalise).select("word", "freq")),
                  num_merges, merges_per_round, head_pairs)


def _train(counted: DataFrame, num_merges: int, merges_per_round: int = 1, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """``train_bpe`` over stored (word, freq)."""
    spark = counted.sparkSession
    long = counted.where(F.length("word") >= 2)
    parts = max(2 * spark.sparkContext.defaultParallelism, long.count() // PACKED_WORDS + 1)
    words = cut_lineage(_packed(long.repartition(parts)))
    sample = _sample(long, SAMPLE_WORDS)
    pairs, merges, pending, free, tried, queue = _Pairs(), [], [], MADE, 64, []

    def due() -> int | None:
        """The pair that a recount would merge next."""
        if merges_per_round == 1:
            return next((pair for pair, _ in pairs.best()), None)
        if not queue:
            queue.extend(_disjoint(pairs.best(8 * merges_per_round), merges_per_round))
        return queue[0] if queue else None

    pairs.start(words, head_pairs)
    while len(merges) < num_merges:
        if due() is None:
            if not pairs.floor:
                break  # no pair is left
            words, pending = _stored(words, pending), []
            pairs.start(words, head_pairs)
            if not pairs.best():  # as many ties as the head is long
                head_pairs *= 2
            continue
        picked = _guess(pairs, sample, queue or [due()], min(tried, num_merges - len(merges)), merges_per_round, free)
        changes = _changes(words, pending, picked)
        place = {(left << 32) | right: i for i, (left, right, _) in enumerate(picked)}
        met = [set(np.concatenate([p >> 32, p & LOW]).tolist()) for p, _ in changes]  # symbols
        hits = [{x for x in p.tolist() if x in place} for p, _ in changes]            # other picked pairs
        open_ = dict.fromkeys(range(len(picked)))
        while len(merges) < num_merges and (pair := due()) in place:
            k = place.pop(pair)
            if any(picked[i][2] in met[k] or pair in hits[i] for i in open_ if i < k):
                break
            del open_[k]
            made, n = picked[k][2], int(pairs.counts[pair])
            pairs.order[made] = MADE + len(merges)
            merges.append((len(merges), pairs.text(pair >> 32), pairs.text(pair & LOW), pairs.name[made], n))
            pending.append(picked[k])
            sample = _rewritten(sample[0], [picked[k]]), sample[1]
            if queue:
                queue.pop(0)
            pairs.add(changes[k][0].tolist(), changes[k][1].tolist(), made)
        free += len(picked)
        tried = min(SPECULATED, max(32, 2 * (len(picked) - len(open_))))
        if len(pending) >= PENDING:
            words, pending = _stored(words, pending), []
    return spark.createDataFrame(merges, "rank int, left string, right string, merged string, count long")


def bpe_vocab(merges: DataFrame, alphabet: DataFrame, specials=("<unk>", "<s>", "</s>", "<pad>"),
              byte_fallback: bool = True) -> DataFrame:
    """Vocabulary table from merges: specials, 256 byte pieces, then merged
    pieces in merge order, then single characters of the alphabet."""
    spark = merges.sparkSession
    sp = [(i, s, 0.0, "special") for i, s in enumerate(specials)]
    bytes_ = [(len(sp) + b, f"<0x{b:02X}>", 0.0, "byte") for b in range(256)] if byte_fallback else []
    head = spark.createDataFrame(sp + bytes_, "id long, piece string, score double, origin string")
    base = len(sp) + len(bytes_)
    m = merges.select((F.col("rank") + base).cast("long").alias("id"), F.col("merged").alias("piece"),
                      (-F.col("rank").cast("double")).alias("score"), F.lit("merge").alias("origin"))
    n_m = merges.count()
    a = alphabet.select("char").distinct()
    a = a.select((F.row_number().over(Window.orderBy("char")) - 1 + base + n_m).cast("long").alias("id"),
                 F.col("char").alias("piece"), F.lit(-1e9).alias("score"), F.lit("char").alias("origin"))
    return head.unionByName(m).unionByName(a)


def train_vocab(corpus: DataFrame, vocab_size: int, text_col: str = "text", normalise: bool = True,
                merges_per_round: int = 1, specials=("<unk>", "<s>", "</s>", "<pad>"),
                byte_fallback: bool = True) -> tuple[DataFrame, DataFrame]:
    """A vocabulary of ``vocab_size`` pieces (specials, byte pieces, the
    merges that fit, the corpus' characters) and its merges. A size that
    leaves no room for a merge is an error."""
    words = cut_lineage(bpe_words(corpus, text_col, normalise=normalise).select("word", "freq"))
    chars = cut_lineage(words.select(F.explode(tx.chars(F.col("word"))).alias("char")).distinct())
    room = vocab_size - len(specials) - (256 if byte_fallback else 0) - chars.count()
    if room <= 0:
        raise ValueError(f"vocabulary of {vocab_size} pieces: {1 - room} more are needed for one merge beside the "
                         "specials, bytes and characters")
    merges = cut_lineage(_train(words, room, merges_per_round))
    return bpe_vocab(merges, chars, specials, byte_fallback), merges


MERGE_BLOCK = 100_000  # merges broadcast at once


def _ranked(syms: list[str], table: dict) -> list[str]:
    """BPE by rank: the lowest-ranked pair, leftmost first, until none is left."""
    syms = list(syms)
    none = len(table) + (1 << 40)
    ranks = [table.get(p, none) for p in zip(syms, syms[1:])]
    while ranks and (best := min(ranks)) != none:
        i = ranks.index(best)
        syms[i:i + 2] = [syms[i] + syms[i + 1]]
        del ranks[i]
        if i:
            ranks[i - 1] = table.get((syms[i - 1], syms[i]), none)
        if i < len(ranks):
            ranks[i] = table.get((syms[i], syms[i + 1]), none)
    return syms


def bpe_encode_words(words: DataFrame, merges: DataFrame, block: int = MERGE_BLOCK) -> DataFrame:
    """T4: encode each distinct pre-token once. Up to ``block`` merges are
    broadcast; longer lists go block by block in rank order, again until no
    word changes (a later block may join symbols that an earlier one
    continues), so any number of merges is handled."""
    spark = words.sparkSession
    n = merges.count()

    def pass_over(df: DataFrame, lo: int) -> DataFrame:
        part = merges.where(F.col("rank").between(lo, lo + block - 1)).select("left", "right", "rank").collect()
        bc = spark.sparkContext.broadcast({(r["left"], r["right"]): r["rank"] for r in part})

        def enc(it):
            table = bc.value
            for pdf in it:
                yield pd.DataFrame({"word": pdf["word"], "pieces": [_ranked(p, table) for p in pdf["pieces"]]})
        return df.mapInPandas(enc, "word string, pieces array<string>")
    out = words.select("word", tx.chars(F.col("word")).alias("pieces"))
    if n <= block:
        return pass_over(out, 0)
    size = None
    while True:
        for lo in range(0, n, block):
            out = pass_over(out, lo)
        out = cut_lineage(out)
        total = out.agg(F.sum(F.size("pieces"))).first()[0]
        if total == size:
            return out
        size = total


def bpe_encode_texts(df: DataFrame, key_cols, merges: DataFrame, vocab: DataFrame | None = None,
                     text_col: str = "text", normalise: bool = True) -> DataFrame:
    """T4 for a corpus: (key, line_no, pieces[, ids]) of every line; a piece
    outside the vocabulary falls back to its UTF-8 byte pieces. With merges and
    a vocabulary that are measured small, lines are encoded where they are, a
    distinct pre-token of a batch once (no shuffle); otherwise distinct
    pre-tokens are encoded once and joined back. Lines of rows that share a key
    go together in any case."""
    keys = list(key_cols)
    small = _small_tables(merges, vocab)
    if small is None:
        return _encode_by_join(df, keys, merges, vocab, text_col, normalise)
    same = [F.col(k).eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)]
    twice = cut_lineage(df.groupBy(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)])
                        .agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n"))
    if twice.isEmpty():
        return _encode_in_place(df, keys, *small, text_col, normalise)
    once = _encode_in_place(df.join(twice, same, "left_anti"), keys, *small, text_col, normalise)
    return once.unionByName(_encode_by_join(df.join(twice, same, "left_semi"), keys, merges, vocab, text_col, normalise))


def _small_tables(merges: DataFrame, vocab: DataFrame | None) -> tuple[dict, dict | None] | None:
    """(pair -> rank, piece -> id), if they fit a broadcast and no piece comes
    twice."""
    if not fits_broadcast(merges, MERGE_BLOCK) or vocab is not None and not fits_broadcast(
            vocab.select("piece", "id"), VOCAB_BROADCAST_ROWS):
        return None
    ranks = {(r["left"], r["right"]): r["rank"] for r in merges.select("left", "right", "rank").collect()}
    if vocab is None:
        return ranks, None
    rows = vocab.select("piece", F.col("id").cast("long").alias("id")).collect()
    ids = {r["piece"]: r["id"] for r in rows}
    return (ranks, ids) if len(ids) == len(rows) else None


MEMO_WORDS = 500_000  # of a task


def _encode_in_place(df: DataFrame, keys: list[str], ranks: dict, ids: dict | None, text_col: str,
                     normalise: bool) -> DataFrame:
    toks = text_lines(df, text_col, keep=keys).select(
        *keys, "line_no", pretokens(F.col("line"), normalise).alias("toks")).where(F.size("toks") > 0)
    tables = df.sparkSession.sparkContext.broadcast((ranks, ids))

    def encode_word(word: str) -> tuple[list, list]:
        ranks, ids = tables.value
        pieces = _ranked(list(word), ranks)
        if ids is None:
            return pieces, []
        out = []
        for p in pieces:
            out += [p] if p in ids else [f"<0x{b:02X}>" for b in p.encode("utf-8")]
        return out, [ids.get(p) for p in out]

    def run(batches):
        memo = {}
        for batch in batches:
            words = batch.column("toks").flatten().dictionary_encode()
            if len(memo) > MEMO_WORDS:
                memo.clear()
            coded = []
            for w in words.dictionary.to_pylist():
                if w not in memo:
                    memo[w] = encode_word(w)
                coded.append(memo[w])
            sizes = np.array([len(p) for p, _ in coded], np.int64)
            ends = np.r_[0, np.cumsum(sizes[words.indices.to_numpy()])]
            lengths = pc.list_value_length(batch.column("toks")).to_numpy()
            cuts = pa.array(ends[np.r_[0, np.cumsum(lengths)]], pa.int32())
            columns = [batch.column(c) for c in (*keys, "line_no")]
            for k, kind in enumerate((pa.string(), pa.int64())[:1 if ids is None else 2]):
                parts = pa.array([c[k] for c in coded], pa.list_(kind)).take(words.indices)
                columns.append(pa.ListArray.from_arrays(cuts, parts.flatten()))
            yield pa.RecordBatch.from_arrays(columns, names=names)
    schema = T.StructType(toks.schema.fields[:-1]).add("pieces", T.ArrayType(T.StringType()))
    if ids is not None:
        schema = schema.add("ids", T.ArrayType(T.LongType()))
    names = schema.names
    return toks.mapInArrow(run, schema)


def _encode_by_join(df: DataFrame, keys: list[str], merges: DataFrame, vocab: DataFrame | None, text_col: str,
                    normalise: bool) -> DataFrame:
    toks = (text_lines(df, text_col, keep=keys)
            .select(*keys, "line_no", F.posexplode(pretokens(F.col("line"), normalise)).alias("pos", "word")))
    enc = bpe_encode_words(toks.select("word").distinct(), merges)
    if vocab is not None:
        enc = _with_ids(enc, vocab)
    more = [] if vocab is None else ["ids"]
    joined = split_join(toks, cut_lineage(enc), "word").groupBy(*keys, "line_no").agg(
        F.array_sort(F.collect_list(F.struct("pos", "pieces", *more))).alias("w"))
    return joined.select(*keys, "line_no", *[F.flatten(F.col(f"w.{c}")).alias(c) for c in ["pieces", *more]])


def _with_ids(enc: DataFrame, vocab: DataFrame) -> DataFrame:
    """ids of the pieces of each distinct word; shuffles by piece, so the
    vocabulary may have any size."""
    flat = enc.select("word", "pieces", F.posexplode("pieces").alias("i", "piece"))
    v = vocab.select("piece", F.col("id").cast("long").alias("id"))
    known = flat.join(v, "piece", "left")
    raw = F.hex(F.encode(F.col("piece"), "UTF-8"))
    parts = F.when(F.col("id").isNotNull(), F.array("piece")).otherwise(F.transform(
        F.regexp_extract_all(raw, F.lit("(..)"), 1), lambda h: F.concat(F.lit("<0x"), h, F.lit(">"))))
    units = known.select("word", "i", F.posexplode(parts).alias("j", "piece"))
    byte_ids = units.join(v, "piece", "left").groupBy("word").agg(
        F.array_sort(F.collect_list(F.struct("i", "j", "piece", "id"))).alias("u"))
    return byte_ids.select("word", F.col("u.piece").alias("pieces"), F.col("u.id").alias("ids"))


def decode_byte_pieces(pieces) -> Column:
    """T5 with byte fallback: runs of ``<0xNN>`` become the characters that
    their bytes spell."""
    @F.pandas_udf(T.StringType())
    def run(col: pd.Series) -> pd.Series:
        out = []
        for parts in col:
            if "<0x" not in (plain := "".join(parts)):
                out.append(plain.replace(SP_SPACE, " ").removeprefix(" "))
                continue
            text = bytearray()
            for p in parts:
                text += bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.encode("utf-8")
            out.append(text.decode("utf-8", "replace").replace(SP_SPACE, " ").removeprefix(" "))
        return pd.Series(out)
    return run(_c(pieces))
