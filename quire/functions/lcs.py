"""Longest-common-subsequence length, the one piece of ROUGE with no Catalyst
expression. Arrow-batched pandas UDF; the per-pair kernel is the
bit-parallel recurrence (Allison & Dix 1986; Crochemore et al. 2001;
Hyyro 2004), O(m * ceil(n/w)) word operations and O(n) memory instead of
the O(n*m) dictionary table.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs_length(a, b) -> int:
    """LCS length of two sequences of hashable tokens."""
    if a is None or b is None:
        return None
    if len(a) == 0 or len(b) == 0:
        return 0
    if len(a) > len(b):
        a, b = b, a
    masks = _masks(a)
    full = (1 << len(a)) - 1
    v = full
    for tok in b:
        m = masks.get(tok)
        if m is None:
            continue
        u = v & m
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def lcs_table(a, b):
    """Full DP table: the plain definition that tests compare with."""
    n, m = len(a), len(b)
    t = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        ai = a[i - 1]
        row, prev = t[i], t[i - 1]
        for j in range(1, m + 1):
            if ai == b[j - 1]:
                row[j] = prev[j - 1] + 1
            else:
                row[j] = prev[j] if prev[j] >= row[j - 1] else row[j - 1]
    return t


def _masks(a) -> dict:
    masks: dict = {}
    for i, tok in enumerate(a):
        masks[tok] = masks.get(tok, 0) | (1 << i)
    return masks


def lcs_tokens(a, b):
    """Tokens of one LCS of ``a`` (reference) and ``b`` (hypothesis).

    On a tie the walk back moves along ``b`` (it goes to i-1 only when that
    cell is strictly greater), which fixes which LCS is returned. Instead of
    the table of lengths the bit vectors of its columns are used: bit i of
    column j is 0 where length(i+1, j) = length(i, j) + 1, so a length is the
    number of zeros in a prefix. Every sqrt(len(b))-th column is kept and the
    columns of one such block are made again when the walk enters it:
    O(len(a) * sqrt(len(b))) bits of memory."""
    n, m = len(a), len(b)
    if not n or not m:
        return []
    masks, full, block = _masks(a), (1 << n) - 1, math.isqrt(m) + 1

    def column(v, tok):
        u = v & masks.get(tok, 0)
        return ((v + u) | (v - u)) & full
    kept, v = [full], full  # columns 0, block, 2 * block, ...
    for j, tok in enumerate(b, 1):
        v = column(v, tok)
        if j % block == 0:
            kept.append(v)
    i, j, out = n, m, []
    base, columns = m + 1, []
    while i > 0 and j > 0:
        if j - 1 < base:  # columns j - 1 and j are wanted
            base = (j - 1) // block * block
            columns = [kept[base // block]]
            for tok in b[base:min(base + block, m)]:
                columns.append(column(columns[-1], tok))
        if a[i - 1] == b[j - 1]:
            out.append(a[i - 1])
            i -= 1
            j -= 1
            continue
        here, left = columns[j - base], columns[j - 1 - base]
        prefix = (1 << (i - 1)) - 1
        up = i - 1 - (here & prefix).bit_count()            # length(i - 1, j)
        back = i - (left & (prefix << 1 | 1)).bit_count()   # length(i, j - 1)
        if up > back:
            i -= 1
        else:
            j -= 1
    out.reverse()
    return out


@F.pandas_udf(T.IntegerType())
def lcs_len_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    out = [lcs_length(x, y) for x, y in zip(a, b)]
    return pd.Series(out, dtype="Int32")


def union_lcs(ref_sentence_words, hyp_sentences_words, prev_union=None, exclusive=True):
    """Union of the LCS tokens of one reference sentence against every
    hypothesis sentence, carried over ``prev_union``. Returns
    (new_count, union) where new_count = len(union) - len(prev_union)."""
    if not hyp_sentences_words:
        raise ValueError("no hypothesis sentence to compare with")
    union = list(prev_union or [])
    if exclusive:
        union = list(dict.fromkeys(union))
    prev = len(union)
    for hyp in hyp_sentences_words:
        toks = lcs_tokens(ref_sentence_words, hyp)
        if exclusive:
            seen = set(union)
            for tok in toks:
                if tok not in seen:
                    union.append(tok)
                    seen.add(tok)
        else:
            union.extend(toks)
    return len(union) - prev, union


_CARRIED_SCHEMA = T.StructType([
    T.StructField("new_counts", T.ArrayType(T.IntegerType())),
    T.StructField("union", T.ArrayType(T.StringType())),
])


def union_lcs_carried(exclusive: bool = True):
    """R7 over all reference sentences: the union of one sentence is the
    start of the next. NULL or no hypothesis sentences give NULL."""
    @F.pandas_udf(_CARRIED_SCHEMA)
    def _f(refs: pd.Series, hyps: pd.Series) -> pd.DataFrame:
        counts, unions = [], []
        for rs, hs in zip(refs, hyps):
            if rs is None or hs is None or len(hs) == 0:
                counts.append(None)
                unions.append(None)
                continue
            union, new = [], []
            words = [list(h) for h in hs]
            for r in rs:
                n, union = union_lcs(list(r), words, prev_union=union, exclusive=exclusive)
                new.append(n)
            counts.append(new)
            unions.append(union)
        return pd.DataFrame({"new_counts": counts, "union": unions})
    return _f
