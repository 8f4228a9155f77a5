"""Repair of conversation structure by dynamic programming over a grammar.

Rows of a conversation are taken by turn (NULL first; equal turns by role, then
the first 64 characters of the text, then its SHA-256; equal rows stand side by
side). The first fault of a row counts: ``blank`` (nothing but white space),
``duplicate`` (role and text seen earlier in the conversation), ``truncated``
(the last character that is not white space is none of ``.!?``).

The cheapest edits make the roles' initials match (s?(ua)+)?: Keep 0, Rerole to
user or assistant 3, Delete 4 (required for blank and duplicate rows), Insert an
empty user or assistant row anywhere 3; a truncated row that stays costs 3 more.
The audit is the edits' initials in order; of equally cheap ones the least in
ASCII order. (For the same rows and the same states at both ends, no audit is
the beginning of another of equal cost, as the letters of the rows settle their
cost. So comparing pieces is enough: the order survives concatenation.)

1. One pass turns rows into symbols: role initial, forced deletion, truncation.
   Equal rows are counted before anything is shuffled; texts travel as SHA-256.
   Rows are range-partitioned by conversation and position, so a conversation of
   any size is spread over tasks, each of which emits pieces of at most
   ``PIECE`` symbols with their counts.
2. Re-Pair: the pairs of adjacent symbols are counted over all distinct pieces,
   weighted by how often a piece occurs; in each round the most frequent pairs
   whose occurrences cannot overlap (no symbol ends one and begins another)
   become rules, until no pair occurs twice or there are ``RULES`` rules. (The
   grammar only shortens the work; results do not depend on it.)
3. Each symbol has a min-plus transfer matrix over the pattern's states, whose
   entries are a cost and an audit rope; a rule's matrix is the product of its
   two symbols', evaluated bottom-up once. Every piece of every conversation is
   a product of a few shared matrices.
4. Pieces and texts of a conversation meet in order in one task, which streams
   them: the edits come first, then rows are rewritten one by one and hashed as
   they pass. A text is held only while its row is written.

SHA-256 runs over the whole conversation, so this last pass is one task for one
conversation; its memory is a batch of rows and the letters of the audit.

Defined results: NULL roles and texts count as one space (so such a text is
blank); a NULL turn comes first; rows with a NULL conversation form one
conversation; very long texts pass whole; repeated rows are duplicates of the
first; an empty table gives no rows; other columns are not read. Conversation
ids come back through their text form, so any type that has one will do.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import materialise

SPACE = " \t\n\x0b\x0c\r"
HEAD = 64        # characters of a text that order rows of one turn
PIECE = 1 << 16  # symbols of a piece at most
RULES = 128      # rules of the grammar at most
MEMO = 1 << 16   # pieces whose edits a worker remembers
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3    # more for a truncated row that stays
TASK_SYMBOLS = 1 << 24  # of the distinct pieces that one task of a round counts
LEAF = 256       # audit ropes up to this many letters are plain strings

# ------------------------------------------------- min-plus matrices with ropes
#
# States: 0 nothing yet, 1 behind the system row, 2 behind a user row, 3 behind
# an assistant row. A rope is a string or a pair of ropes; an entry is (cost,
# rope) or None.

STATES, ACCEPTED = 4, (0, 3)
USER, ASSISTANT = {0: 2, 1: 2, 3: 2}, {2: 3}
FORCED = "x"
FIRST_RULE = 0xE000  # rules are characters of their own behind the symbols


def _letters(rope) -> Iterator:
    """The leaves of a rope, from left to right."""
    stack = [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, tuple):
            stack += [top[1], top[0]]
        else:
            yield top


def flat(rope) -> str:
    return rope if isinstance(rope, str) else "".join(_letters(rope))


def _joined(a, b):
    if not a or not b:
        return a or b
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= LEAF:
        return a + b
    return (a, b)


def _less(a, b) -> bool:
    """Whether rope a stands before rope b."""
    if a is b:
        return False
    left, right = [a], [b]
    x = y = ""
    while True:
        if not x and not y and left and right and left[-1] is right[-1]:
            left.pop(), right.pop()  # a shared rope at the same place
            continue
        while not x and left:
            top = left.pop()
            if isinstance(top, tuple):
                left += [top[1], top[0]]
            else:
                x = top
        while not y and right:
            top = right.pop()
            if isinstance(top, tuple):
                right += [top[1], top[0]]
            else:
                y = top
        if not x or not y:
            return bool(y)
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


def _better(a, b) -> bool:
    return b is None or a[0] < b[0] or a[0] == b[0] and _less(a[1], b[1])


def _times_row(row: list, matrix: list) -> list:
    out = [None] * STATES
    for k, a in enumerate(row):
        if a is not None:
            for j, b in enumerate(matrix[k]):
                if b is not None:
                    cost = a[0] + b[0]
                    if out[j] is None or cost <= out[j][0]:
                        new = (cost, _joined(a[1], b[1]))
                        if _better(new, out[j]):
                            out[j] = new
    return out


def times(a: list, b: list) -> list:
    return [_times_row(row, b) for row in a]


def _closure() -> list:
    """Inserts: none, one, or two of them."""
    out = [[None] * STATES for _ in range(STATES)]
    for i in range(STATES):
        at = i
        out[i][i] = (0, "")
        for k in (1, 2):
            at = (USER | ASSISTANT)[at]
            if out[i][at] is None:
                out[i][at] = (k * INSERT, "I" * k)
    return out


INSERTS = _closure()


def symbol(initial: str, forced: bool, truncated: bool) -> str:
    """What the edits of a row depend on, as one character."""
    if forced:
        return FORCED
    kind = initial if initial in ("s", "u", "a") else "o"
    return kind.upper() if truncated else kind


def _edit(sign: str) -> list:
    """The matrix of one row, with the inserts before it."""
    out = [[None] * STATES for _ in range(STATES)]

    def offer(i, j, cost, letter):
        if _better((cost, letter), out[i][j]):
            out[i][j] = (cost, letter)

    for i in range(STATES):
        offer(i, i, DELETE, "D")
        if sign == FORCED:
            continue
        more = TRUNCATED if sign.isupper() else 0
        kept = {"s": {0: 1}, "u": USER, "a": ASSISTANT, "o": {}}[sign.lower()]
        if i in kept:
            offer(i, kept[i], KEEP + more, "K")
        offer(i, (USER | ASSISTANT)[i], REROLE + more, "R")
    return times(INSERTS, out)


SYMBOLS = {s: _edit(s) for s in "suaoSUAO" + FORCED}


class Grammar:
    """The rules' matrices, and the cheapest edits of whole sequences."""

    def __init__(self, rules: list[str]):
        self.rules = [(pair, chr(FIRST_RULE + k)) for k, pair in enumerate(rules)]
        self.matrices = dict(SYMBOLS)
        for pair, name in self.rules:  # bottom-up: a rule's symbols come before it
            self.matrices[name] = times(self.matrices[pair[0]], self.matrices[pair[1]])
        self.memo: dict[str, tuple[int, str]] = {}

    def compressed(self, sequence: str) -> str:
        for pair, name in self.rules:
            if pair[0] in sequence:
                sequence = sequence.replace(pair, name)
        return sequence

    def edits(self, pieces: list[str]) -> tuple[int, str]:
        """(cost, audit) of a conversation's pieces."""
        key = pieces[0] if len(pieces) == 1 and len(pieces[0]) <= LEAF else None
        if key in self.memo:
            return self.memo[key]
        row = [(0, ""), None, None, None]
        for piece in pieces:
            for s in self.compressed(piece):
                row = _times_row(row, self.matrices[s])
        row, best = _times_row(row, INSERTS), None
        for j in ACCEPTED:
            if row[j] is not None and _better(row[j], best):
                best = row[j]
        found = best[0], flat(best[1])
        if key is not None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[key] = found
        return found


def learn_grammar(sequences: DataFrame, rules: int = RULES) -> list[str]:
    """Re-Pair over (seq, n): sequences with how often they occur. A round
    is one job that sends at most ``rules`` counted pairs to the driver."""
    found: list[str] = []
    while len(found) < rules:
        known = [(pair, chr(FIRST_RULE + k)) for k, pair in enumerate(found)]

        def count(batches: Iterator[pd.DataFrame], known=known) -> Iterator[pd.DataFrame]:
            seen: Counter = Counter()
            for pdf in batches:
                for seq, n in zip(pdf["seq"], pdf["n"]):
                    for pair, name in known:
                        if pair[0] in seq:
                            seq = seq.replace(pair, name)
                    last = ""
                    for pair in map("".join, zip(seq, seq[1:])):
                        # of three equal symbols the two pairs overlap: one counts
                        same = pair == last and pair[0] == pair[1]
                        last = "" if same else pair
                        if not same:
                            seen[pair] += n
            yield pd.DataFrame({"pair": list(seen), "n": list(seen.values())}).astype({"pair": str, "n": "int64"})

        pairs = (sequences.mapInPandas(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
                 .where("n >= 2").orderBy(F.desc("n"), "pair").limit(rules - len(found)).collect())
        left: set[str] = set()   # symbols that begin a chosen pair,
        right: set[str] = set()  # and those that end one
        for r in pairs:
            a, b = r.pair
            if b not in left and a not in right and (a != b or a not in left):
                left.add(a)
                right.add(b)
                found.append(r.pair)
        if not pairs:
            break
    return found


# ------------------------------------------------------------ rows to symbols

def _rows(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(" "))
    return df.select(F.col(conv_col).cast("string").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                     F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), text.alias("text"),
                     F.left(text, F.lit(HEAD)).alias("head"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))


ORDER = ["conv", "turn", "role", "head", "digest"]


def _flagged(rows: DataFrame) -> DataFrame:
    """Distinct rows without their texts: ``n`` (how often), initial, blank,
    truncated, again (role and text stand at an earlier turn)."""
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    thin = (rows.select(*ORDER, F.left("role", F.lit(1)).alias("initial"), (F.length(end) == 0).alias("blank"),
                        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
            .groupBy(*ORDER, "initial", "blank", "truncated").agg(F.count(F.lit(1)).alias("n")))
    first = (thin.where(~F.col("blank")).groupBy("conv", "role", "digest")
             .agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("places")).where("places > 1")
             .select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"))
    return (thin.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                      & (F.col("digest") == F.col("d")), "left")
            .withColumn("again", F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first")["turn"]))
            .drop("c", "r", "d", "first"))


PIECES = T.StructType([
    T.StructField("conv", T.StringType()), T.StructField("part", T.LongType()), T.StructField("seq", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in ("blank", "duplicate", "truncated", "illegal")],
    T.StructField("first", T.StringType()), T.StructField("last", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in ("low", "high", "turns")]])
LEGAL = ("su", "ua", "au")


class _Piece:
    def __init__(self, conv):
        self.conv, self.seq, self.size = conv, [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn, initial: str, blank: bool, again: bool, truncated: bool, n: int) -> None:
        """``n`` equal rows."""
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        if n > 1 and initial + initial not in LEGAL:
            self.illegal += n - 1
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        rest = n
        if blank:
            self.blank += n
        elif again:
            self.duplicate += n
        else:
            self.seq.append(symbol(initial, False, truncated))
            self.truncated += truncated
            self.duplicate += n - 1
            rest = n - 1
        self.seq.append(FORCED * rest)
        self.size += n

    def row(self, part: int) -> tuple:
        return (self.conv, part, "".join(self.seq), self.blank, self.duplicate, self.truncated, self.illegal,
                self.first, self.last, self.low, self.high, self.turns)


def _table(rows: list, schema: T.StructType, types: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=schema.names)


PIECE_TYPES = [pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.string(), pa.string(), *[pa.int64()] * 3]


def _pieces(flagged: DataFrame) -> DataFrame:
    """Pieces of symbols, numbered along the order of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32  # ranges are numbered in order
        piece, out = None, []
        for batch in batches:
            d = batch.to_pydict()
            for conv, turn, initial, blank, again, truncated, n in zip(*[d[c] for c in SIGNS]):
                while n:
                    if piece is None or piece.conv != conv or piece.size >= PIECE:
                        if piece is not None:
                            out.append(piece.row(number))
                            number += 1
                        piece = _Piece(conv)
                    m = min(n, PIECE)
                    piece.add(turn, initial, blank, again, truncated, m)
                    n, again = n - m, True  # equal rows behind the first one
            yield _table(out, PIECES, PIECE_TYPES)
            out = []
        yield _table([piece.row(number)] if piece is not None else [], PIECES, PIECE_TYPES)

    ordered = flagged.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).select(*SIGNS)
    return ordered.mapInArrow(run, PIECES)


SIGNS = ["conv", "turn", "initial", "blank", "again", "truncated", "n"]


# ------------------------------------------------------------ the edited rows

class Repaired:
    """One conversation while its rows pass: the summary of its pieces, then
    row after row what the audit makes of it."""

    def __init__(self, conv):
        self.conv, self.pieces = conv, []
        self.counts = [0, 0, 0, 0]
        self.last = self.low = self.high = None
        self.turns = 0
        self.cost, self.audit, self.at, self.state = 0, None, 0, 0

    def piece(self, seq, blank, duplicate, truncated, illegal, first, last, low, high, turns) -> None:
        self.pieces.append(seq)
        if self.last is not None and self.last + first not in LEGAL:
            illegal += 1
        self.last = last
        self.counts = [a + b for a, b in zip(self.counts, (blank, duplicate, truncated, illegal))]
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low, self.high = low if self.low is None else self.low, high

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns

    def solve(self, grammar: Grammar) -> None:
        self.cost, self.audit = grammar.edits(self.pieces)
        self.pieces = []

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            yield "I", self._role(), ""
            self.at += 1

    def _role(self) -> str:
        self.state = (USER | ASSISTANT)[self.state]
        return "user" if self.state == 2 else "assistant"

    def edit(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(letter, role, text) of the rows up to and with this one."""
        yield from self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "R":
            role = self._role()
        elif letter == "K":
            self.state = {"s": 1, "u": 2, "a": 3}[role[:1]]
        yield letter, role, text


MEETING = T.StructType([T.StructField("conv", T.StringType()), T.StructField("part", T.LongType()),
                        T.StructField("piece", T.StructType(PIECES.fields[2:])), T.StructField("role", T.StringType()),
                        T.StructField("text", T.StringType())])


def _conversations(batches: Iterator[pa.RecordBatch], rules: list[str]) -> Iterator[tuple]:
    """Events of the ordered stream: ("row", repaired, letter, role, text)
    and, behind a conversation's last row, ("end", repaired)."""
    grammar, one = Grammar(rules), None

    def close():
        if one is not None:
            if one.audit is None:
                one.solve(grammar)
            for made in one.inserts():
                yield ("row", one, *made)
            yield "end", one

    for batch in batches:
        d = batch.to_pydict()
        for conv, piece, role, text in zip(d["conv"], d["piece"], d["role"], d["text"]):
            if one is None or one.conv != conv:
                yield from close()
                one = Repaired(conv)
            if piece is not None:
                one.piece(**piece)
            else:
                if one.audit is None:
                    one.solve(grammar)
                for made in one.edit(role, text):
                    yield ("row", one, *made)
    yield from close()


def _prepared(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, list[str]]:
    """Pieces and rows of each conversation side by side, in order; the
    grammar."""
    rows = _rows(df, conv_col, turn_col, role_col, text_col)
    pieces = materialise(_pieces(_flagged(rows)))
    distinct = pieces.groupBy("seq").agg(F.count(F.lit(1)).alias("n"))
    size = pieces.select(F.sum(F.length("seq"))).first()[0] or 0
    # as many tasks as the symbols are worth: each round of the grammar reads them once
    rules = learn_grammar(materialise(distinct.coalesce(size // TASK_SYMBOLS + 1)))
    none = F.lit(None)
    heads = pieces.select("conv", "part", F.struct(*PIECES.names[2:]).alias("piece"), none.cast("long").alias("turn"),
                          none.cast("string").alias("role"), none.cast("string").alias("text"),
                          none.cast("string").alias("head"), none.cast("binary").alias("digest"))
    texts = rows.select("conv", F.lit(1 << 62).alias("part"), none.cast(T.StructType(PIECES.fields[2:])).alias("piece"),
                        "turn", "role", "text", "head", "digest")
    met = (heads.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "part", *ORDER[1:])
           .select(*MEETING.names))
    return met, rules


def _back(conv: Column, df: DataFrame, conv_col: str) -> Column:
    return conv.cast(df.schema[conv_col].dataType)


SUMMARY = T.StructType([
    T.StructField("conv", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
    T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
SUMMARY_TYPES = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
EDITS = T.StructType([T.StructField("conv", T.StringType()), T.StructField("at", T.LongType()),
                      *[T.StructField(c, T.StringType()) for c in ("edit", "role", "text")]])
EDIT_TYPES = [pa.string(), pa.int64(), *[pa.string()] * 3]
OUT_ROWS, OUT_CHARS = 1024, 1 << 22  # of an output batch


def summaries(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256), one row per conversation; the digest is over the
    repaired ``role:text``, joined by newlines."""
    met, rules = _prepared(df, conv_col, turn_col, role_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest, between = [], hashlib.sha256(), b""
        for kind, one, *made in _conversations(batches, rules):
            if kind == "end":
                out.append((one.conv, one.gaps, *one.counts, one.cost, one.audit, digest.hexdigest()))
                digest, between = hashlib.sha256(), b""
                if len(out) >= OUT_ROWS:
                    yield _table(out, SUMMARY, SUMMARY_TYPES)
                    out = []
            elif made[0] != "D":
                digest.update(between + f"{made[1]}:{made[2]}".encode())
                between = b"\n"
        yield _table(out, SUMMARY, SUMMARY_TYPES)

    found = met.mapInArrow(run, SUMMARY)
    return found.select(_back(F.col("conv"), df, conv_col).alias("conv_id"), *SUMMARY.names[1:])


def edits(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv_id, at, edit, role, text): every row with its edit and the
    inserted ones, in order; those whose edit is not ``D`` are the repaired
    conversation."""
    met, rules = _prepared(df, conv_col, turn_col, role_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, chars = [], 0, 0
        for kind, one, *made in _conversations(batches, rules):
            if kind == "end":
                at = 0
                continue
            out.append((one.conv, at, *made))
            at, chars = at + 1, chars + len(made[2])
            if len(out) >= OUT_ROWS or chars >= OUT_CHARS:
                yield _table(out, EDITS, EDIT_TYPES)
                out, chars = [], 0
        yield _table(out, EDITS, EDIT_TYPES)

    found = met.mapInArrow(run, EDITS)
    return found.select(_back(F.col("conv"), df, conv_col).alias("conv_id"), *EDITS.names[1:])
