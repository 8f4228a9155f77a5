"""Toxicity by a weighted finite-state pattern grammar.

Five small transducers read the words of a clause: insult, threat, target,
negation and reported speech. Their composition is one machine whose state is
the tuple of the component states and whose transitions carry weights, so a
matched clause is scored in its context: an insult counts more when a person
is addressed, less within the scope of a negation, less when it is reported;
a threat counts only together with a target. Clauses end at ``. ! ? ; :`` and
line ends. A document's score is a calibrated logistic of its heaviest clause
and the sum of its clauses.

The insult transducer reads stems (a prefix and any ending, or a whole word).
Besides hand-written seeds it is learned from labelled rows: for every word
and word beginning the distinct left contexts in toxic and other documents
are counted (contexts, not occurrences, so that copies of one document do not
vote many times); those whose contexts are toxic enough become entries with
their log odds as weight. A seed that the labels contradict is dropped.

The labelled sample is bounded (``SAMPLE_ROWS`` rows in expectation, chosen
by a hash of the id); scoring reads every whole text of every row.

Defined results: NULL and empty texts have no clause and get the score of a
document without matches; ids, languages, sources and labels are no inputs of
a score; without labels the seeds and default calibration are used; an empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import hash_share, materialise, packed, small_batches

SAMPLE_ROWS = 12_000
MIN_CONTEXTS = 5
MIN_PRECISION = 0.8
STEM_LENGTHS = (3, 4, 5, 6)
LEXICON_ROWS = 5_000
SEED_WEIGHT = 4.0

# Hand-written seeds (fixed values).
INSULTS = ("idiot moron stupid scum loser trash worthless pathetic disgusting clown dumb imbecile dimwit "
           "vermin scumbag dumbass cretin halfwit").split()
THREATS = "kill hurt destroy smash burn shoot stab murder punch strangle crush beat attack hang".split()
TARGETS = ("you your yours yourself they them their he him his she her people everyone tu te toi vous votre "
           "du dich dir ihr euch usted ustedes ti").split()
NEGATIONS = "not no never none nobody nor isn aren wasn weren don doesn didn won cannot nicht kein keine nie ne pas jamais nunca sin".split()
REPORTS = ("said says say told tells called calls wrote writes claimed claims quoted quotes reported reports "
           "sagte sagt schrieb dit disait dijo dice escribió").split()
MATCH = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("matches", T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("pattern", T.StringType()), T.StructField("weight", T.DoubleType())])))])

WORD = re.compile(r"[^\W\d_]+|[.!?;:\n]")
SCOPE = 3  # words that a negation reaches


# ---------------------------------------------------------------- the grammar

def _negation(state: int, symbol: str) -> int:
    return SCOPE if symbol == "N" else max(0, state - 1)


def _report(state: int, symbol: str) -> int:
    return 1 if symbol == "R" else state


def _target(state: int, symbol: str) -> int:
    return 1 if symbol == "T" else state


def _insult(state: int, symbol: str) -> int:
    return min(2, state + 1) if symbol == "I" else state


def _threat(state: int, symbol: str) -> int:
    return 1 if symbol == "H" else state


COMPONENTS = ((_negation, SCOPE + 1), (_report, 2), (_target, 2), (_insult, 3), (_threat, 2))


@lru_cache(maxsize=1)
def machine() -> dict[tuple[tuple[int, ...], str], tuple[tuple[int, ...], float, float]]:
    """The composition: (state, symbol) -> (state, factor of the symbol's own
    weight, weight added). States are tuples of component states."""
    out = {}
    for state in product(*(range(n) for _, n in COMPONENTS)):
        negated, reported, aimed, insults, _ = state
        scale = (0.3 if negated else 1.0) * (0.5 if reported else 1.0)
        for symbol in "INTRHO":
            after = tuple(step(s, symbol) for (step, _), s in zip(COMPONENTS, state))
            own = scale * (1.3 if aimed else 1.0) * (1.15 if insults else 1.0) if symbol == "I" else 0.0
            extra = 0.0
            if symbol == "T" and not aimed and insults:
                extra = 0.3 * scale          # the person is named after the insult
            if (symbol == "H" and aimed) or (symbol == "T" and not aimed and state[4]):
                extra += 2.5 * scale         # threat and target meet
            out[state, symbol] = after, own, extra
    return out


START = (0,) * len(COMPONENTS)


@dataclass
class Grammar:
    """``stems``: beginnings, ``words``: whole words, each with a weight."""
    words: dict[str, float] = field(default_factory=lambda: dict.fromkeys(INSULTS, SEED_WEIGHT))
    stems: dict[str, float] = field(default_factory=dict)
    bias: float = -3.0
    slopes: tuple[float, float] = (2.0, 1.5)

    def __post_init__(self):
        self.symbols = {w: "T" for w in TARGETS} | {w: "N" for w in NEGATIONS} | {w: "R" for w in REPORTS} \
            | {w: "H" for w in THREATS}
        self.lengths = sorted({len(s) for s in self.stems})

    def weight(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        for n in self.lengths:
            found = max(found, self.stems.get(word[:n], 0.0))
        return found

    def clauses(self, text: str) -> list[tuple[int, int, str, float]]:
        """Matched clauses: start, end (code points), pattern, weight."""
        low = text.lower()
        heads = {w for w in set(re.findall(r"[^\W\d_]+", low)) if self.weight(w) or self.symbols.get(w) == "H"}
        if not heads:
            return []
        table, out = machine(), []
        state, total, pattern, start = START, 0.0, [], None
        end = 0
        for m in WORD.finditer(low):
            w = m[0]
            if w in ".!?;:\n":
                if total > 0:
                    out.append((start, end, "".join(pattern), total))
                state, total, pattern, start = START, 0.0, [], None
                continue
            if start is None:
                start = m.start()
            end = m.end()
            own = self.weight(w) if w in heads else 0.0
            symbol = "I" if own else self.symbols.get(w, "O")
            state, factor, extra = table[state, symbol]
            total += factor * own + extra
            if symbol != "O" and len(pattern) < 32:
                pattern.append(symbol)
        if total > 0:
            out.append((start, end, "".join(pattern), total))
        return out

    def score(self, clauses) -> float:
        a, b = features(clauses)
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.slopes[0] * a + self.slopes[1] * b, -30, 30))))


def features(clauses) -> tuple[float, float]:
    weights = [c[3] for c in clauses]
    return float(np.log1p(max(weights, default=0.0))), float(np.log1p(sum(weights)))


# ------------------------------------------------------------------- learning

def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, toxic) of a bounded sample of the labelled rows that are not
    held out; the ids are broadcast (about ``rows`` of them), the texts stay."""
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    share = min(1.0, rows / max(1, usable.count()))
    chosen = usable.where(hash_share(share, id_col)) \
        .select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("toxic")) \
        .groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    return materialise(df.select(F.col(id_col).alias("text_id"), F.col(text_col).alias("text"))
                       .join(F.broadcast(chosen), F.col("text_id") == F.col("label_id"))
                       .select(F.coalesce("text", F.lit("")).alias("text"), "toxic"))


def _entries(sample: DataFrame) -> tuple[list, int, int]:
    """Words and beginnings by their distinct left contexts in toxic and
    other documents, those that are toxic enough or seeds, heaviest first."""
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != "")
    pairs = (sample.select("toxic", words.alias("ws"))
             .select("toxic", F.explode(F.transform("ws", lambda w, i: F.struct(
                 w.alias("word"), F.xxhash64(F.get("ws", i - 1)).alias("left")))).alias("p"))
             .select("toxic", "p.word", "p.left").where(F.length("word") <= 64)
             .groupBy("toxic", "word", "left").agg(F.lit(1).alias("one")))
    by_word = materialise(pairs.groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("toxic") == 1, 0).otherwise(1)).alias("neg")))
    total = by_word.agg(F.sum("pos"), F.sum("neg")).first()
    keys = F.array(F.concat("word", F.lit("$")),
                   *[F.when(F.length("word") >= n, F.substring("word", 1, n)) for n in STEM_LENGTHS])
    found = (by_word.select(F.explode(keys).alias("entry"), "pos", "neg").where("entry IS NOT NULL")
             .groupBy("entry").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    toxic = F.col("pos") >= MIN_PRECISION * (F.col("pos") + F.col("neg"))
    seeds = F.col("entry").isin([w + "$" for w in INSULTS])
    found = materialise(found.where(((F.col("pos") >= MIN_CONTEXTS) & toxic) | seeds).withColumn("seed", seeds))
    # every seed, whatever its counts, and the others up to the lexicon's size
    rows = found.where("seed").collect() + (found.where("NOT seed").orderBy(F.col("pos").desc(), "entry")
                                            .limit(LEXICON_ROWS).collect())
    rows.sort(key=lambda r: (-r.pos, r.entry))
    return rows, total[0] or 0, total[1] or 0


def _lexicon(rows, pos_all: int, neg_all: int) -> tuple[dict[str, float], dict[str, float]]:
    """Of nested beginnings the most specific one that keeps 95 % of the
    contexts of the shortest."""
    def weight(r):
        odds = (r.pos + 0.5) / (pos_all + 1) / ((r.neg + 0.5) / (neg_all + 1))
        return float(np.clip(np.log(max(odds, 1e-9)), 0.0, 8.0))

    words = dict.fromkeys(INSULTS, SEED_WEIGHT)
    stems: dict[str, float] = {}
    for r in rows:  # a seed with enough evidence takes its learned weight, or goes
        w = r.entry[:-1]
        if r.entry.endswith("$") and w in words and r.pos + r.neg >= MIN_CONTEXTS:
            words[w] = weight(r) if r.pos >= 0.5 * (r.pos + r.neg) else 0.0
    good = [r for r in rows if r.pos >= MIN_CONTEXTS and r.pos >= MIN_PRECISION * (r.pos + r.neg)]
    good.sort(key=lambda r: (len(r.entry.rstrip("$")), r.entry.endswith("$")))
    taken: list[str] = []
    for r in good:
        head = r.entry
        if any(head.startswith(t) for t in taken):
            continue
        taken.append(head.rstrip("$") if head.endswith("$") else head)
        best = r
        for x in good:
            if x.entry.startswith(head.rstrip("$")) and x.pos >= 0.95 * r.pos and len(x.entry) >= len(best.entry):
                best = x
        if best.entry.endswith("$"):
            words[best.entry[:-1]] = max(weight(best), words.get(best.entry[:-1], 0.0))
        else:
            stems[best.entry] = weight(best)
    return {w: x for w, x in words.items() if x > 0}, {s: x for s, x in stems.items() if x > 0}


def _calibrate(points: np.ndarray, labels: np.ndarray) -> tuple[float, tuple[float, float]]:
    """Logistic regression of two features by Newton steps with a weak prior."""
    x = np.column_stack([np.ones(len(points)), points])
    w = np.zeros(3)
    prior = np.diag([0.01, 0.1, 0.1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + prior, x.T @ (labels - p) - prior @ w)
        w += step
    return float(w[0]), (float(w[1]), float(w[2]))


def learn(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", rows: int = SAMPLE_ROWS) -> Grammar:
    small_batches(df.sparkSession)
    sample = labelled_sample(df, labels, id_col, text_col, label_col, rows)
    words, stems = _lexicon(*_entries(sample))
    draft = Grammar(words, stems)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [features(draft.clauses(t)) for t in pdf["text"]]
            yield pd.DataFrame({"a": [g[0] for g in got], "b": [g[1] for g in got], "toxic": pdf["toxic"].to_numpy()})

    seen = sample.mapInPandas(measure, "a double, b double, toxic int") \
        .groupBy(F.round("a", 3).alias("a"), F.round("b", 3).alias("b"), "toxic").count().collect()  # <= the sample
    if len({r.toxic for r in seen}) < 2:
        return draft
    points = np.repeat([[r.a, r.b] for r in seen], [r["count"] for r in seen], axis=0)
    truth = np.repeat([float(r.toxic == 1) for r in seen], [r["count"] for r in seen])
    bias, slopes = _calibrate(points, truth)
    return Grammar(words, stems, bias, slopes)


# -------------------------------------------------------------------- scoring

def scorer(grammar: Grammar):
    """A column function: text -> struct(score, matches)."""
    @F.pandas_udf(MATCH)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [grammar.clauses(t) if t else [] for t in texts]
            yield pd.DataFrame({
                "score": [grammar.score(c) for c in found],
                "matches": [[dict(zip(("start", "end", "pattern", "weight"), m)) for m in c] for c in found]})
    return run


def annotate(df: DataFrame, grammar: Grammar, text_col: str = "text") -> DataFrame:
    """``row`` (the input row), ``toxicity`` (score, matched clauses)."""
    small_batches(df.sparkSession)
    return packed(df).withColumn("toxicity", scorer(grammar)(F.col("row")[text_col]))


def clean(df: DataFrame, grammar: Grammar, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows whose score is below ``limit``, with the input's columns."""
    return annotate(df, grammar, text_col).where(F.col("toxicity")["score"] < limit).select("row.*")
