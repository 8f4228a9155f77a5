"""License scan against a brute-force version."""

import functools
import random
import re
from re import _constants as C
from re import _parser as P

from quire.llm import licenses as lic
from quire.llm import signatures as sig

SCHEMA = "doc_id long, text string, kept string, low int"
LINES = ["All rights reserved.", "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0.",
         "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License.",
         "SPDX-License-Identifier: GPL-2.0-or-later", "see https://www.apache.org/licenses/LICENSE-2.0 and CC0 1.0 Universal",
         "cc by cc BY CC-by cc  by; all rights\nreserved all rights reserved", "general public licensee", "acc by", "cc byé",
         "BSD-3-Clause or 3-Clause BSD License", "mit", "Apache-2.0", "GNU Lesser General Public License v2.1", "cc-by-sa-4.0"]


@functools.cache
def compiled():
    return [(label, re.compile(pattern.replace("(?i)", ""), re.I | re.A), priority, pattern.startswith(lic.OPERAND))
            for label, pattern, priority, *_ in lic.RULES]


def brute(text):
    text = text or ""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, base = [], set()
    for phrase, label in lic.BASE.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                base.add(label)
    found = []
    for k, (label, pattern, priority, operand) in enumerate(compiled()):
        for m in pattern.finditer(text) if not operand or "spdx" in low else ():
            found.append((m.start(), m.end(), priority, k, label))
    kept = []
    for d in found:
        inside = any(o is not d and o[0] <= d[0] and o[1] >= d[1] and o[2] >= d[2]
                     and not ((o[0], o[1]) == (d[0], d[1]) and (-o[2], o[3]) > (-d[2], d[3])) for o in found)
        if not inside:
            kept.append(d)
    weights = [lic.WEIGHTS[d[2]] for d in kept] + [lic.BASE_WEIGHT] * bool(base)
    return (len(words), len(places), min(places, default=None), max(places, default=None), sorted(base),
            sorted((d[4], d[0], d[1], d[2]) for d in kept), sorted(base | {d[4] for d in kept}), max(weights, default=0.0))


def rows():
    rng = random.Random(3)
    out = [(i, t, "k", i) for i, t in enumerate([None, "", " \n", "...", *LINES])]
    for i in range(150):
        parts = [rng.choice(LINES) if rng.random() < .4 else rng.choice(["Der die mit", "été 12", "K İ ß", "x_y-z", "🙂 a"])
                 for _ in range(rng.randrange(1, 9))]
        out.append((100 + i, rng.choice([" ", "\n", ", ", ""]).join(parts), "k", 1))
    out += [(900, "word " * 100_000 + "All rights reserved " * 500 + "Apache-2.0 " * 500, "k", 1), (None, "cc by", "k", 1)]
    return out + [out[-3]]


def test_scan_matches_brute_force(spark):
    data = rows()
    got = lic.scan(spark.createDataFrame(data, SCHEMA).repartition(4)).collect()
    assert len(got) == len(data)
    for r in got:
        mine = (r.n_words, r.n_base, r.first_word, r.last_word, list(r.base_labels), sorted(map(tuple, r.detections)),
                list(r.labels), r.score)
        if r.row.doc_id == 900:
            assert mine[:5] == brute(r.row.text)[:5] and mine[6:] == (["apache-2.0", "reserved"], 0.6)
        else:
            assert mine == brute(r.row.text), r.row.text
    assert lic.scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_rule_table():
    assert len(lic.RULES) > 500 and len(sig.NOTICES) + len(sig.NAMES) > 170
    samples = {"apache-2.0": "Apache License 2.0", "gpl-3.0": "GPL-3.0"}
    for label, text in samples.items():
        assert label in brute(text)[6]
    for label, pattern, priority, one, two in lic.RULES:
        assert priority in lic.WEIGHTS and one == one.lower() and two == two.lower() and " " not in one + two, (label, pattern)


def one_per_choice(parsed):
    """Texts that a parsed pattern matches: the first choice everywhere, then
    every other alternative, repeat count, blank and set member once."""
    options = []
    for op, arg in parsed:
        if op is C.LITERAL:
            options.append([chr(arg)])
        elif op is C.IN:
            options.append([t for kind, x in arg for t in
                            ([" ", "\n", "  "] if kind is C.CATEGORY and x is C.CATEGORY_SPACE else
                             ["w"] if kind is C.CATEGORY else [chr(x)])])
        elif op is C.SUBPATTERN:
            options.append(one_per_choice(arg[3]))
        elif op is C.BRANCH:
            options.append([t for way in arg[1] for t in one_per_choice(way)])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, inner = arg
            options.append([""] * (low == 0) + one_per_choice(inner))
        else:
            assert op in (C.ASSERT_NOT, C.ASSERT), op
    first = [o[0] for o in options]
    return ["".join(first)] + ["".join([*first[:i], t, *first[i + 1:]])
                               for i, o in enumerate(options) for t in o[1:]]


def samples():
    for rule in lic.RULES:
        # one kind of blank for long signatures; the others have a test of their own
        for t in one_per_choice(P.parse(rule[1].replace("(?i)", "").replace(sig.BLANK, r"\ "))):
            yield rule, ("SPDX: " if rule[1].startswith(lic.OPERAND) else "") + t


def test_every_alternative_holds_the_keywords():
    for (label, pattern, _, one, two), t in samples():
        assert re.search(pattern, t), (label, t)
        assert one in t.lower() and two in t.lower(), (label, t, one, two)


def test_scan_matches_brute_force_on_every_alternative(spark):
    texts = sorted({t for _, t in samples()} | {"Creative Commons Attribution 4.0", "CC\nBY 4.0", "CC  BY 3.0"})
    got = lic.scan(spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], SCHEMA).repartition(8)).collect()
    for r in got:
        want = brute(r.row.text)
        assert sorted(map(tuple, r.detections)) == want[5] and list(r.labels) == want[6], r.row.text


def test_real_spdx_ids(spark):
    ids = {"MIT": "mit", "X11": "x11", "ISC": "isc", "Zlib": "zlib", "PostgreSQL": "postgresql", "OpenSSL": "openssl",
           "NCSA": "ncsa", "MIT-0": "mit-0", "MIT-License": "mit", "Apache-2.0": "apache-2.0"}
    data = [(i, f"# SPDX-License-Identifier: {k}\n", v, 1) for i, (k, v) in enumerate(ids.items())]
    data += [(100, "mit zlib isc openssl", "", 1)]
    for r in lic.scan(spark.createDataFrame(data, SCHEMA)).collect():
        assert list(r.labels) == [r.row.kept] * bool(r.row.kept), r.row.text
        assert [d.priority for d in r.detections] == [4] * bool(r.row.kept)


NOTICES = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and associated documentation files": {"mit"},
    "Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that": {"bsd-any"},
    "Neither the name of the University nor the names of its contributors may be used to endorse": {"bsd-3-clause"},
    "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that": {"isc"},
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.": {"0bsd"},
    "BSD 3-Clause License": {"bsd-3-clause"},
    "License: MIT": {"mit"},
    '"license": "Apache-2.0",': {"apache-2.0"},
    "Creative Commons Attribution-ShareAlike 4.0 International": {"cc-by-sa-4.0"},
    "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License": {"cc-by-nc-nd-4.0"},
    "Creative Commons Attribution 2.5 Generic": {"cc-by-2.5"},
    "https://creativecommons.org/licenses/by-nc/2.0/": {"cc-by-nc-2.0"},
    "under the terms of the GNU General Public License as published by\n// the Free Software Foundation, either version 3 of the License, or\n// (at your option) any later version.": {"gpl-3.0"},
    "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License": {"lgpl-2.1"},
    "SPDX-License-Identifier: (MIT OR Apache-2.0)": {"mit", "apache-2.0"},
    "SPDX-License-Identifier: MIT AND (GPL-2.0-or-later OR ISC)": {"mit", "gpl-2.0", "isc"},
    "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0.": {"mpl-2.0"},
    "License :: OSI Approved :: MIT License": {"mit"},
    "This is free and unencumbered software released into the public domain.": {"unlicense"},
    "To the extent possible under law, Jane Doe has waived all copyright and related or neighboring rights": {"cc0-1.0"},
    "Non-Profit Open Software License version 3.0": {"nposl-3.0"},
    "The permission slip was granted to any person under the notice of advertising.": set(),
    "We license software in good faith; a public notice about evil materials and distribution.": set(),
    "Creative people in the House of Commons 4.0": set(),
}


def test_notices_of_real_licenses(spark):
    data = [(i, t, ",".join(sorted(want)), 1) for i, (t, want) in enumerate(NOTICES.items())]
    for r in lic.scan(spark.createDataFrame(data, SCHEMA)).collect():
        want = brute(r.row.text)
        assert ",".join(sorted({d.label for d in r.detections})) == r.row.kept, r.row.text
        assert sorted(map(tuple, r.detections)) == want[5] and list(r.labels) == want[6]
