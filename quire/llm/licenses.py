"""License scan by ordered signature rules, with DataFrame functions only.

Base phrases are looked for among a text's words (runs of ASCII letters and
digits and of all other non-ASCII characters, A-Z lower-cased); every place is
counted. The signature rules are regexes in the order of their table: each
license gives a tag (also as an operand of a tag's expression), a package
field, a grant, an address, a name and an identifier form, with falling
priority; the hand-written signatures of ``signatures.py`` (sentences of the
licenses, headers, names) follow. A text is scanned by a rule only when it
holds the rule's two keywords; rules of one first keyword stand behind one
gate, so a text without it never looks at them.
A match is suppressed when it lies inside that of an earlier rule form of at
least its priority (equal spans: the higher priority, then the earlier rule
stays), so "Apache License" inside a full grant is not reported again.

Everything happens within a row, so nothing is shuffled and no group of rows
meets anywhere. Matches of one text are folded once from left to right.

Defined results: a NULL text counts as empty: no words, no places, empty
labels, score 0; first and last word are NULL without a base phrase; repeated
rows are scanned alike; an empty table gives no rows; other columns ride along
in ``row``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.arrays import let
from quire.llm.common import packed
from quire.llm.signatures import signature_rules

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_WEIGHT = 0.5
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WEIGHTS = {1: 0.6, 2: 0.8, 3: 0.9, 4: 0.95}

V = r"(?:,?\s+(?:version\s+|v\.?\s*)?|[ -]v?)"  # before a version number
# Hand-written table (fixed values): label, identifier, name, keyword of the
# identifier, keyword of the name, address ("" where there is none). A keyword
# stands, without blanks, in every text that its pattern can match.
LICENSES = [
    ("apache-2.0", r"Apache-2\.0", rf"Apache\s+(?:Software\s+)?License{V}2(?:\.0)?", "apache", "apache", r"apache\.org/licenses/LICENSE-2\.0"),
    ("apache-1.1", r"Apache-1\.1", rf"Apache\s+(?:Software\s+)?License{V}1\.1", "apache", "apache", r"apache\.org/licenses/LICENSE-1\.1"),
    ("mit", r"MIT-License", r"(?:MIT|Expat)\s+License", "mit-license", "licen", r"opensource\.org/licenses?/mit"),
    ("mit-0", r"MIT-0", r"MIT\s+No\s+Attribution", "mit-0", "attribution", r"opensource\.org/licenses?/mit-0"),
    ("x11", r"X11-distribute", r"X11\s+License", "x11", "x11", r"x\.org/licenses"),
    ("bsd-2-clause", r"BSD-2-Clause", r"(?:Simplified|2-Clause|Two-Clause)\s+BSD\s+License", "bsd", "bsd", r"opensource\.org/licenses?/bsd-2-clause"),
    ("bsd-3-clause", r"BSD-3-Clause", r"(?:New|Modified|Revised|3-Clause|Three-Clause)\s+BSD\s+License", "bsd", "bsd", r"opensource\.org/licenses?/bsd-3-clause"),
    ("bsd-4-clause", r"BSD-4-Clause", r"(?:Original|Old|4-Clause|Four-Clause)\s+BSD\s+License", "bsd", "bsd", ""),
    ("0bsd", r"0BSD", r"Zero[ -]Clause\s+BSD(?:\s+License)?", "0bsd", "bsd", r"opensource\.org/licenses?/0bsd"),
    ("isc", r"ISC-License", r"ISC\s+License", "isc-license", "isc", r"opensource\.org/licenses?/isc"),
    ("zlib", r"Zlib-License", r"zlib(?:/libpng)?\s+License", "zlib", "zlib", r"opensource\.org/licenses?/zlib"),
    ("gpl-2.0", r"GPL-2\.0(?:-only|-or-later)?", rf"(?:GNU\s+)?General\s+Public\s+License{V}2(?:\.0)?", "gpl-2.0", "public", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-3.0", r"GPL-3\.0(?:-only|-or-later)?", rf"(?:GNU\s+)?General\s+Public\s+License{V}3(?:\.0)?", "gpl-3.0", "public", r"gnu\.org/licenses/gpl-3\.0"),
    ("gpl-any", r"GNU-GPL", r"GNU\s+General\s+Public\s+License", "gnu-gpl", "public", r"gnu\.org/licenses/gpl\.html"),
    ("lgpl-2.1", r"LGPL-2\.1(?:-only|-or-later)?", rf"(?:GNU\s+)?Lesser\s+General\s+Public\s+License{V}2\.1", "lgpl-2.1", "lesser", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("lgpl-3.0", r"LGPL-3\.0(?:-only|-or-later)?", rf"(?:GNU\s+)?Lesser\s+General\s+Public\s+License{V}3(?:\.0)?", "lgpl-3.0", "lesser", r"gnu\.org/licenses/lgpl-3\.0"),
    ("agpl-3.0", r"AGPL-3\.0(?:-only|-or-later)?", rf"(?:GNU\s+)?Affero\s+General\s+Public\s+License{V}3(?:\.0)?", "agpl", "affero", r"gnu\.org/licenses/agpl-3\.0"),
    ("gfdl-1.3", r"GFDL-1\.3(?:-only|-or-later)?", rf"(?:GNU\s+)?Free\s+Documentation\s+License{V}1\.3", "gfdl", "documentation", r"gnu\.org/licenses/fdl-1\.3"),
    ("mpl-1.1", r"MPL-1\.1", rf"Mozilla\s+Public\s+License{V}1\.1", "mpl-1.1", "mozilla", r"mozilla\.org/MPL/1\.1"),
    ("mpl-2.0", r"MPL-2\.0", rf"Mozilla\s+Public\s+License{V}2(?:\.0)?", "mpl-2.0", "mozilla", r"mozilla\.org/MPL/2\.0"),
    ("epl-1.0", r"EPL-1\.0", rf"Eclipse\s+Public\s+License{V}1(?:\.0)?", "epl-1.0", "eclipse", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", r"EPL-2\.0", rf"Eclipse\s+Public\s+License{V}2(?:\.0)?", "epl-2.0", "eclipse", r"eclipse\.org/legal/epl-2\.0"),
    ("cddl-1.0", r"CDDL-1\.0", rf"Common\s+Development\s+and\s+Distribution\s+License{V}1(?:\.0)?", "cddl", "distribution", r"opensource\.org/licenses?/cddl"),
    ("cpl-1.0", r"CPL-1\.0", rf"Common\s+Public\s+License{V}1(?:\.0)?", "cpl-1.0", "common", r"opensource\.org/licenses?/cpl1"),
    ("eupl-1.2", r"EUPL-1\.2", rf"European\s+Union\s+Public\s+Licen[cs]e{V}1\.2", "eupl", "european", r"eupl\.eu/1\.2"),
    ("bsl-1.0", r"BSL-1\.0", rf"Boost\s+Software\s+License{V}1(?:\.0)?", "bsl-1.0", "boost", r"boost\.org/LICENSE_1_0"),
    ("artistic-2.0", r"Artistic-2\.0", rf"Artistic\s+License{V}2(?:\.0)?", "artistic", "artistic", r"opensource\.org/licenses?/artistic-2\.0"),
    ("unlicense", r"Unlicense", r"The\s+Unlicense", "unlicense", "unlicense", r"unlicense\.org"),
    ("wtfpl", r"WTFPL", r"Do\s+What\s+The\s+F\w+\s+You\s+Want\s+To\s+Public\s+License", "wtfpl", "public", r"wtfpl\.net"),
    ("cc0-1.0", r"CC0-1\.0", r"(?:Creative\s+Commons\s+)?CC0(?:\s+1\.0)?(?:\s+Universal)?", "cc0", "cc0", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc-by-3.0", r"CC-BY-3\.0", r"(?:CC\s+BY|Creative\s+Commons\s+Attribution)\s+3\.0", "cc-by", "3.0", r"creativecommons\.org/licenses/by/3\.0"),
    ("cc-by-4.0", r"CC-BY-4\.0", r"(?:CC\s+BY|Creative\s+Commons\s+Attribution)\s+4\.0", "cc-by", "4.0", r"creativecommons\.org/licenses/by/4\.0"),
    ("cc-by-sa-3.0", r"CC-BY-SA-3\.0", r"CC\s+BY-SA\s+3\.0", "cc-by", "by-sa", r"creativecommons\.org/licenses/by-sa/3\.0"),
    ("cc-by-sa-4.0", r"CC-BY-SA-4\.0", r"CC\s+BY-SA\s+4\.0", "cc-by", "by-sa", r"creativecommons\.org/licenses/by-sa/4\.0"),
    ("cc-by-nd-4.0", r"CC-BY-ND-4\.0", r"CC\s+BY-ND\s+4\.0", "cc-by", "by-nd", r"creativecommons\.org/licenses/by-nd/4\.0"),
    ("cc-by-nc-4.0", r"CC-BY-NC-4\.0", r"CC\s+BY-NC\s+4\.0", "cc-by", "by-nc", r"creativecommons\.org/licenses/by-nc/4\.0"),
    ("cc-by-nc-sa-4.0", r"CC-BY-NC-SA-4\.0", r"CC\s+BY-NC-SA\s+4\.0", "cc-by", "by-nc", r"creativecommons\.org/licenses/by-nc-sa/4\.0"),
    ("cc-by-nc-nd-4.0", r"CC-BY-NC-ND-4\.0", r"CC\s+BY-NC-ND\s+4\.0", "cc-by", "by-nc", r"creativecommons\.org/licenses/by-nc-nd/4\.0"),
    ("ofl-1.1", r"OFL-1\.1", rf"SIL\s+Open\s+Font\s+License{V}1\.1", "ofl-1.1", "font", r"scripts\.sil\.org/OFL"),
    ("odbl-1.0", r"ODbL-1\.0", r"Open\s+(?:Data\s+Commons\s+Open\s+)?Database\s+License", "odbl", "database", r"opendatacommons\.org/licenses/odbl"),
    ("psf-2.0", r"PSF-2\.0", r"Python\s+Software\s+Foundation\s+License", "psf-2.0", "python", r"docs\.python\.org/3/license"),
    ("postgresql", r"PostgreSQL-License", r"PostgreSQL\s+License", "postgresql", "postgresql", r"opensource\.org/licenses?/postgresql"),
    ("openssl", r"OpenSSL-License", r"OpenSSL\s+License", "openssl", "openssl", r"openssl\.org/source/license"),
    ("ms-pl", r"MS-PL", r"Microsoft\s+Public\s+License", "ms-pl", "microsoft", r"opensource\.org/licenses?/ms-pl"),
    ("ncsa", r"NCSA-License", r"University\s+of\s+Illinois/NCSA\s+Open\s+Source\s+License", "ncsa", "ncsa", r"opensource\.org/licenses?/ncsa"),
]
# SPDX ids of tags where the bare identifier above is a longer form, as the id
# alone is an everyday word or a project's name: label -> id, its keyword.
TAGS = {
    "mit": (r"MIT(?:-License)?", "mit"),
    "x11": (r"X11(?:-distribute(?:-modifications-variant)?)?", "x11"),
    "isc": (r"ISC(?:-License)?", "isc"),
    "zlib": (r"Zlib(?:-License)?", "zlib"),
    "postgresql": (r"PostgreSQL(?:-License)?", "postgresql"),
    "openssl": (r"OpenSSL(?:-License)?", "openssl"),
    "ncsa": (r"NCSA(?:-License)?", "ncsa"),
}
GRANT = r"(?:licen[sc]ed|released|distributed|published|available|provided)\s+under\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?"

# An operand of a tag's expression: only in texts that name SPDX at all, the
# one rule form with a keyword that its pattern does not hold.
OPERAND = r"(?i)(?<![\w])(?:AND|OR)\s+\(*"


def _rules() -> list[tuple[str, str, int, str, str]]:
    """(label, pattern, priority, first keyword, second keyword), in order."""
    out = []
    for label, ident, name, ident_key, name_key, address in LICENSES:
        tag, tag_key = TAGS.get(label, (ident, ident_key))
        out.append((label, rf"(?i)SPDX-License-Identifier:\s*\(*{tag}(?![\w.-])", 4, "spdx", tag_key))
        out.append((label, rf"{OPERAND}{tag}(?![\w.-])", 4, "spdx", tag_key))
        out.append((label, rf"(?i)(?<![\w-])licen[sc]e[\"']?\s*[:=]\s*[\"']?{tag}(?![\w.-])", 3, "licen", tag_key))
        out.append((label, rf"(?i){GRANT}{name}(?![\w])", 3, name_key, "under"))
        if address:
            host = address.split("/")[0].replace("\\", "").lower()
            out.append((label, rf"(?i)(?:https?://)?(?:www\.)?{address}", 3, host, host))
        out.append((label, rf"(?i)(?<![\w]){name}(?![\w])", 2, name_key, name_key))
        out.append((label, rf"(?i)(?<![\w.-]){ident}(?![\w-])", 1, ident_key, ident_key))
    return out + signature_rules()


RULES = _rules()
DETECTION = "struct<start:int,before:int,less:int,rule:int,stop:int,label:string,priority:int>"


def _gates() -> Column:
    """The rules behind their first keywords."""
    behind: dict[str, list[dict]] = {}
    for k, (label, pattern, priority, one, two) in enumerate(RULES):
        behind.setdefault(one, []).append(dict(rule=k, label=label, pattern=pattern, priority=priority, two=two))
    # one literal, folded when the query is planned
    return F.from_json(F.lit(json.dumps([dict(one=one, rules=rules) for one, rules in behind.items()])),
                       "array<struct<one:string,rules:array<struct<rule:int,label:string,pattern:string,priority:int,two:string>>>>")


def _spans(text: Column, rule: Column) -> Column:
    """All matches of one rule: the text between matches and the matches add
    up to their places."""
    def fold(s: Column) -> Column:
        steps = F.transform(s["found"], lambda m, i: F.struct(
            F.length(F.get(s["pieces"], i)).alias("gap"), F.length(m).alias("n")))
        empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{DETECTION}>").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            start, stop = acc["at"] + x["gap"], acc["at"] + x["gap"] + x["n"]
            found = F.struct(start.alias("start"), (-stop).alias("before"), (-rule["priority"]).alias("less"),
                             rule["rule"].alias("rule"), stop.alias("stop"), rule["label"].alias("label"),
                             rule["priority"].alias("priority"))
            return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(found)).alias("out"))
        return F.aggregate(steps, empty, step)["out"]

    both = F.struct(F.regexp_extract_all(text, rule["pattern"], F.lit(0)).alias("found"),
                    F.split(text, rule["pattern"]).alias("pieces"))
    return let(both, fold)


def _resolved(found: Column) -> Column:
    """Drops matches that lie inside an earlier one of at least their
    priority. Sorted by start, then longest, then priority, a match can only
    lie inside one before it; the furthest end so far is kept per priority."""
    levels = sorted(WEIGHTS)
    empty = F.struct(*[F.lit(-1).alias(f"end{p}") for p in levels],
                     F.array().cast(f"array<{DETECTION}>").alias("kept"))

    def step(acc: Column, d: Column) -> Column:
        reach = F.lit(-1)
        for p in levels:
            reach = F.when(d["priority"] == p, acc[f"end{p}"]).otherwise(reach)
        return F.struct(
            *[F.when(d["priority"] >= p, F.greatest(acc[f"end{p}"], d["stop"])).otherwise(acc[f"end{p}"]).alias(f"end{p}")
              for p in levels],
            F.when(reach >= d["stop"], acc["kept"]).otherwise(F.concat(acc["kept"], F.array(d))).alias("kept"))
    return F.aggregate(F.sort_array(found), empty, step)["kept"]


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def scan(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (the input row), ``n_words``, ``n_base``, ``first_word``,
    ``last_word``, ``base_labels`` (array), ``detections`` (array of label,
    start, stop in code points, priority), ``labels`` (array), ``score``."""
    phrases = list(BASE.items())
    out = packed(df).withColumn("text", F.coalesce(F.col("row")[text_col], F.lit(""))) \
        .withColumn("low", F.lower("text")) \
        .withColumn("words", F.btrim(F.regexp_replace("text", NO_WORD, " "))) \
        .withColumn("n_words", F.when(F.col("words") == "", F.lit(0)).otherwise(_spaces(F.col("words")) + 1).cast("long"))
    # a phrase's words can stand in the text only if each of them occurs in it
    for k, (phrase, _) in enumerate(phrases):
        may = F.lit(True)
        for w in phrase.split(" "):
            may = may & F.contains("low", F.lit(w))
        out = out.withColumn(f"cut{k}", F.when(may, F.split("words", f"(?i)(?<![^ ]){phrase}(?![^ ])")).otherwise(F.array(F.lit(""))))
    places = [F.size(f"cut{k}") - 1 for k in range(len(phrases))]
    firsts = [F.when(n > 0, _spaces(F.element_at(f"cut{k}", 1))) for k, n in enumerate(places)]
    lasts = [F.when(n > 0, F.col("n_words") - _spaces(F.element_at(f"cut{k}", -1)) - len(phrases[k][0].split(" ")))
             for k, n in enumerate(places)]
    # checked in two steps: first keywords once each, then second ones behind them
    opened = F.filter(_gates(), lambda g: F.contains(F.col("low"), g["one"]))
    hit = F.flatten(F.transform(opened, lambda g: F.filter(g["rules"], lambda r: F.contains(F.col("low"), r["two"]))))
    found = F.flatten(F.transform(hit, lambda r: _spans(F.col("text"), r)))
    out = (out.withColumn("kept", _resolved(found))
           .withColumn("n_base", sum(places, F.lit(0)).cast("long"))
           .withColumn("first_word", F.least(*firsts).cast("long"))
           .withColumn("last_word", F.greatest(*lasts).cast("long"))
           .withColumn("base_labels", F.array_sort(F.array_compact(F.array(
               *[F.when(n > 0, F.lit(label)) for n, (_, label) in zip(places, phrases)])))))
    weight = F.lit(0.0)
    for p, w in WEIGHTS.items():
        weight = F.when(F.array_contains(F.transform("kept", lambda d: d["priority"]), p), F.lit(w)).otherwise(weight)
    return out.select(
        "row", "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.transform("kept", lambda d: F.struct(d["label"].alias("label"), d["start"].alias("start"),
                                               d["stop"].alias("stop"), d["priority"].alias("priority"))).alias("detections"),
        F.array_sort(F.array_distinct(F.concat("base_labels", F.transform("kept", lambda d: d["label"])))).alias("labels"),
        F.greatest(weight, F.when(F.col("n_base") > 0, F.lit(BASE_WEIGHT)).otherwise(F.lit(0.0))).alias("score"))
