"""DuckDB SQL fragments for the oracle queries (independent re-statement of
the rules in plain SQL + list lambdas; used only by ``oracle_sql``)."""

from __future__ import annotations

from quire.functions.text import SENTENCE_RULES

# RE2 spelling of the Python whitespace class (see quire.functions.text).
WS = ("[\\x{9}-\\x{d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
      "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")
HAN = "[\\x{4e00}-\\x{9fa5}]"


def r4(x: str) -> str:
    """Round to 4 digits half-even on the shortest decimal form of the
    double, as Spark's ``bround`` does (Python's ``round`` differs only when
    that form is an exact tie while the binary value is not)."""
    return f"CAST(round_even(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), 4) AS DOUBLE)"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sentences(expr: str) -> str:
    t = expr
    for rule in SENTENCE_RULES:
        t = f"regexp_replace({t}, {lit(rule)}, {lit(chr(92) + '1' + chr(10) + chr(92) + '2')}, 'g')"
    t = f"regexp_replace({t}, {lit(WS + '+$')}, '')"
    return f"string_split({t}, chr(10))"


def collapse(expr: str) -> str:
    return f"trim(regexp_replace({expr}, {lit(WS + '+')}, ' ', 'g'), ' ')"


def norm_sentences(expr: str) -> str:
    return f"list_transform(list_filter({sentences(expr)}, lambda s: length(s) > 0), lambda s: {collapse('s')})"


def words(expr: str) -> str:
    """ROUGE word list; NULL when there is no sentence."""
    ns = norm_sentences(expr)
    return f"(CASE WHEN len({ns}) > 0 THEN string_split(array_to_string({ns}, ' '), ' ') END)"


def word_count(expr: str) -> str:
    c = collapse(f"array_to_string({norm_sentences(expr)}, ' ')")
    return f"(CASE WHEN length({c}) = 0 THEN 0 ELSE len(string_split({c}, ' ')) END)"


def segment(expr: str) -> str:
    return collapse(f"regexp_replace({expr}, {lit('(' + HAN + ')')}, ' \\1 ', 'g')")


def ngrams(w: str, n: int) -> str:
    if n == 1:
        return w
    return (f"(CASE WHEN len({w}) >= {n} THEN list_transform(range(0, len({w}) - {n - 1}), "
            f"lambda i: array_to_string({w}[i + 1:i + {n}], ' ')) ELSE []::VARCHAR[] END)")


def set_overlap(a: str, b: str) -> str:
    return f"len(list_intersect(list_distinct({a}), list_distinct({b})))"


def multiset_overlap(a: str, b: str) -> str:
    """sum over distinct g of min(count in a, count in b), via histograms
    (the second histogram is built once, outside the lambda)."""
    return (f"(SELECT coalesce(list_sum(list_transform(map_entries(list_aggregate({a}, 'histogram')), "
            f"lambda e: least(e.value, coalesce(map_extract_value(hb, e.key), 0)))), 0) "
            f"FROM (SELECT list_aggregate({b}, 'histogram') AS hb))")


def lcs(h: str, r: str) -> str:
    """LCS length by the DP recurrence, one row per token of ``h``."""
    return (f"CAST(list_reduce({h}, lambda row, x: list_reduce(range(1, len({r}) + 1), lambda acc, j: "
            f"list_append(acc, CASE WHEN x = {r}[j] THEN row[j] + 1 ELSE greatest(row[j + 1], acc[j]) END), [0]), "
            f"list_transform(range(0, len({r}) + 1), lambda k: 0))[-1] AS BIGINT)")


def prf(h: str, r: str, o: str) -> dict:
    p = f"(CASE WHEN ({h}) = 0 THEN 0.0 ELSE ({o})::DOUBLE / ({h}) END)"
    rc = f"(CASE WHEN ({r}) = 0 THEN 0.0 ELSE ({o})::DOUBLE / ({r}) END)"
    f = f"(2.0 * (({p}) * ({rc})) / (({p}) + ({rc}) + 1e-8))"
    return {"p": p, "r": rc, "f": f}


def char_ngrams(t: str, n: int) -> str:
    return (f"(CASE WHEN length({t}) >= {n} THEN list_transform(range(1, length({t}) - {n - 2}), "
            f"lambda i: substring({t}, i, {n})) ELSE []::VARCHAR[] END)")


def bleu_counts(h: str, r: str) -> str:
    """[(num, den)] for n = 1..4 (computed once per row in a CTE)."""
    items = [f"{{'num': {multiset_overlap(char_ngrams(h, n), char_ngrams(r, n))}, "
             f"'den': greatest(1, len({char_ngrams(h, n)}))}}" for n in range(1, 5)]
    return "[" + ", ".join(items) + "]"


def bleu_from_counts(nd: str, h: str, r: str) -> str:
    terms, zeros = [], "0"
    for i in range(1, 5):
        num, den = f"{nd}[{i}].num", f"{nd}[{i}].den"
        z = f"({zeros} + CASE WHEN {num} = 0 THEN 1 ELSE 0 END)"
        p = f"(CASE WHEN {num} = 0 THEN 1.0 / (pow(2.0, {z}) * {den}) ELSE {num}::DOUBLE / {den} END)"
        terms.append(f"ln({p}) * 0.25")
        zeros = z
    hl, rl = f"length({h})::DOUBLE", f"length({r})::DOUBLE"
    bp = f"(CASE WHEN {hl} > {rl} THEN 1.0 WHEN {hl} = 0 THEN 0.0 ELSE exp(1.0 - {rl} / {hl}) END)"
    return f"(CASE WHEN {nd}[1].num = 0 THEN 0.0 ELSE {bp} * exp({' + '.join(terms)}) END)"


INSTRUCTION_PAIRS = """
instruction_pairs AS (
  SELECT conv_id, turn, query, answer,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pair_idx
  FROM (
    SELECT conv_id, turn, role, text AS query,
           lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
           lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer
    FROM conversations WHERE role <> 'system') t
  WHERE role = 'user' AND next_role = 'assistant')"""

PREFERENCE_PAIRS = """
ranked AS (
  SELECT d.doc_id, d.text, d.lang, d.n_chars, l.quality,
         row_number() OVER (PARTITION BY d.lang, l.quality ORDER BY d.doc_id) - 1 AS rk
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
preference_pairs AS (
  SELECT g.doc_id AS pair_id, g.lang,
         array_to_string(string_split(g.text, ' ')[1:8], ' ') AS question,
         g.text AS response_chosen, b.text AS response_rejected,
         g.doc_id AS chosen_id, b.doc_id AS rejected_id,
         (g.n_chars % 97)::DOUBLE / 10 - 4 AS score_chosen,
         (b.n_chars % 97)::DOUBLE / 10 - 4 AS score_rejected
  FROM ranked g JOIN ranked b ON g.lang = b.lang AND g.rk = b.rk AND g.quality = 1 AND b.quality = 0)"""
