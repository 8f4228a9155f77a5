"""Text expressions (Catalyst, JVM side): sentence split, whitespace
normalisation, words, n-grams, segmentation, script tests.

Every function takes and returns ``Column`` objects so it composes into one
projection inside whole-stage codegen / interpreted higher-order functions;
nothing here leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour).
# Sentence-split rewrites, applied in this order; each inserts a newline
# between the two groups:
#   1. a Chinese full stop, exclamation or question mark (or ASCII "?")
#      followed by anything but a closing curly quote
#   2. six ASCII dots followed by anything but a closing curly quote
#   3. two ellipsis characters followed by anything but a closing curly quote
#   4. one of the marks of rule 1 plus a closing curly quote, followed by
#      anything but a Chinese comma or one of the marks of rule 1
SENTENCE_RULES = [
    "([。！？\\?])([^”’])",
    "(\\.{6})([^”’])",
    "(…{2})([^”’])",
    "([。！？\\?][”’])([^，。！？\\?])",
]
# Whitespace exactly as Python's str.isspace()/str.split() see it:
# U+0009..U+000D, U+001C..U+0020, U+0085, U+00A0, U+1680, U+2000..U+200A,
# U+2028, U+2029, U+202F, U+205F, U+3000. Java's Unicode \s covers all but
# U+001C..U+001F, which are added to the class.
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")
WS_CLASS = "(?U)[\\s\\x{1c}-\\x{1f}]"
# Han range used for "is a Chinese word": U+4E00 .. U+9FA5 inclusive.
HAN_CLASS = "[\\x{4e00}-\\x{9fa5}]"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_sentences(text) -> Column:
    """Four ordered rewrites, right-strip, split on newline."""
    t = _c(text)
    for rule in SENTENCE_RULES:
        t = F.regexp_replace(t, rule, "$1\n$2")
    t = rstrip_py(t)
    return F.split(t, "\n", -1)


def collapse_ws(s) -> Column:
    """Python ``" ".join(s.split())``: whitespace runs to one space, ends trimmed."""
    return F.btrim(F.regexp_replace(_c(s), f"{WS_CLASS}+", " "), F.lit(" "))


def normalise_sentences(sentences) -> Column:
    """R2: drop empty sentences, collapse whitespace inside each.

    A whitespace-only sentence survives the emptiness test and becomes ''.
    """
    return F.transform(F.filter(_c(sentences), lambda s: F.length(s) > 0), collapse_ws)


def words(sentences) -> Column:
    """Words of all sentences joined, split on a single space ('' -> [''])."""
    return F.split(F.array_join(_c(sentences), " "), " ", -1)


def rouge_words(text) -> Column:
    """R1 + R2 + word split: the token list ROUGE scores on.

    NULL when the text has no sentence at all (the reference raises)."""
    sents = normalise_sentences(split_sentences(text))
    return F.when(F.size(sents) > 0, words(sents))


def ngrams(words_col, n: int) -> Column:
    """Contiguous n-grams as space-joined strings (words hold no space,
    so the join is injective). Empty when there are fewer than n words.

    Built from n shifted slices zipped together, so the word array is never
    referenced inside a lambda (a lambda reference would re-evaluate the
    whole word expression per element)."""
    w = _c(words_col)
    if n == 1:
        return w
    k = F.size(w) - n + 1
    parts = [F.slice(w, i + 1, F.greatest(k, F.lit(1))).alias(f"g{i}") for i in range(n)]
    zipped = F.arrays_zip(*parts)
    grams = F.transform(zipped, lambda s: F.concat_ws(" ", *[s[f"g{i}"] for i in range(n)]))
    return F.when(k >= 1, grams).otherwise(F.array().cast("array<string>"))


def word_count(text) -> Column:
    """``len(" ".join(sents).split())`` -- whitespace tokens."""
    c = collapse_ws(F.array_join(normalise_sentences(split_sentences(text)), " "))
    return F.when(F.length(c) == 0, F.lit(0)).otherwise(F.size(F.split(c, " ", -1)))


def segment(text, segmenter=None) -> Column:
    """Words joined by single spaces. ``segmenter`` is the plug-in: a
    function of a string column that gives an array of words (a Catalyst
    expression or a pandas UDF around a user's segmenter). By default every
    Han character is its own word and other text splits on whitespace."""
    if segmenter is not None:
        return F.array_join(F.filter(segmenter(_c(text)), lambda w: w != ""), " ")
    spaced = F.regexp_replace(_c(text), f"({HAN_CLASS})", " $1 ")
    return collapse_ws(spaced)


def is_cjk_word(word) -> Column:
    """Every character in U+4E00..U+9FA5; true for ''."""
    return _c(word).rlike(f"\\A{HAN_CLASS}*\\z")


def chars(text) -> Column:
    """Unicode code points of a string as an array of 1-char strings."""
    return F.regexp_extract_all(_c(text), F.lit("(?s)(.)"), 1)


def strip_py(s) -> Column:
    """Python ``str.strip()`` (Unicode whitespace incl. U+001C..U+001F);
    a character-set trim, no regex."""
    return F.btrim(_c(s), F.lit(WS_CHARS))


def rstrip_py(s) -> Column:
    """Python ``str.rstrip()``: SQL ``rtrim(trimStr, str)``."""
    return F.call_function("rtrim", F.lit(WS_CHARS), _c(s))


# Characters escaped inside a fenced code block of a chat
# transcript, applied in this order.
HTML_CODE_ESCAPES = [
    ("`", "\\`"), ("<", "&lt;"), (">", "&gt;"), (" ", "&nbsp;"), ("*", "&ast;"),
    ("_", "&lowbar;"), ("-", "&#45;"), (".", "&#46;"), ("!", "&#33;"), ("(", "&#40;"),
    (")", "&#41;"), ("$", "&#36;"),
]
FENCE = "```"


def escape_code(line) -> Column:
    out = _c(line)
    for a, b in HTML_CODE_ESCAPES:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def render_transcript_html(text) -> Column:
    """Chat text -> HTML: empty lines dropped; a line holding a fence opens
    ``<pre><code class="language-X">`` (X = text after the last backtick)
    or closes the block; every later line gets ``<br>`` in front and is
    escaped while inside a block; the first line is left untouched."""
    from quire.functions.arrays import let
    return let(F.filter(F.split(_c(text), "\n", -1), lambda l: l != ""), _render_lines)


def _render_lines(lines: Column) -> Column:
    init = F.struct(F.lit(0).alias("cnt"), F.array().cast("array<string>").alias("out"))

    def step(acc, i):
        line = F.element_at(lines, i + 1)
        fence = F.instr(line, FENCE) > 0
        cnt = acc["cnt"] + F.when(fence, 1).otherwise(0)
        lang = F.element_at(F.split(line, "`", -1), -1)
        fenced = F.when(cnt % 2 == 1, F.concat(F.lit('<pre><code class="language-'), lang, F.lit('">'))) \
            .otherwise(F.lit("<br></code></pre>"))
        body = F.when(i > 0, F.concat(F.lit("<br>"), F.when(cnt % 2 == 1, escape_code(line)).otherwise(line))) \
            .otherwise(line)
        rendered = F.when(fence, fenced).otherwise(body)
        return F.struct(cnt.alias("cnt"), F.concat(acc["out"], F.array(rendered)).alias("out"))
    html = F.array_join(F.aggregate(F.sequence(F.lit(0), F.size(lines) - 1), init, step,
                                    lambda a: a["out"]), "")
    return F.when(F.size(lines) == 0, F.lit("")).otherwise(html)
