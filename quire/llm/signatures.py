"""Hand-written license signatures: sentences of the licenses' own texts,
file headers, package fields and names, one regex each.

A blank in a signature matches any run of white space and comment marks, so
that a notice is found in a source file's comment, too.
"""

from __future__ import annotations

BLANK = r"[\s*#/]+"
SOME = r"(?:[\w.,'&()-]+ ){1,20}"  # the name of a holder

# Label, signature, two keywords that every match holds.
NOTICES = [
    ("mit", r"Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation", "permission", "charge"),
    ("mit", r"The above copyright notice and this permission notice (?:\(including the next paragraph\) )?shall be included in all copies or substantial portions", "permission", "substantial"),
    ("x11", rf"Except as contained in this notice, the names? of {SOME}shall not be used in advertising", "notice", "advertising"),
    ("bsl-1.0", r"Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation", "permission", "organization"),
    ("unicode-dfs-2016", r"Permission is hereby granted, free of charge, to any person obtaining a copy of the Unicode data files", "permission", "unicode"),
    ("upl-1.0", r"Subject to the condition set forth below, permission is hereby granted to any person obtaining a copy of this software, associated documentation", "permission", "condition"),
    ("ncsa", r"to deal with the Software without restriction, including without limitation", "software", "restriction"),
    ("json", r"The Software shall be used for Good, not Evil", "software", "evil"),
    ("isc", r"Permission to use, copy, modify,? (?:and|and/or) distribute this software for any purpose with or without fee is hereby granted, provided that", "permission", "purpose"),
    ("0bsd", r"Permission to use, copy, modify,? (?:and|and/or) distribute this software for any purpose with or without fee is hereby granted\.", "permission", "purpose"),
    ("postgresql", r"Permission to use, copy, modify,? and distribute this software and its documentation for any purpose, without fee, and without a written agreement", "permission", "agreement"),
    ("hpnd", r"Permission to use, copy, modify,? and distribute this software and its documentation for any purpose and without fee is hereby granted", "permission", "documentation"),
    ("ntp", r"Permission to use, copy, modify,? and distribute this software and its documentation for any purpose with or without fee is hereby granted", "permission", "documentation"),
    ("libtiff", r"Permission to use, copy, modify, distribute, and sell this software and its documentation for any purpose is hereby granted without fee", "permission", "documentation"),
    ("tcl", r"The authors hereby grant permission to use, copy, modify, distribute, and license this software and its documentation", "permission", "authors"),
    ("bsd-any", r"Redistribution and use in source and binary forms, with or without modification, are permitted", "redistribution", "binary"),
    ("bsd-2-clause", r"materials provided with the distribution\. THIS SOFTWARE IS PROVIDED BY", "distribution", "materials"),
    ("bsd-3-clause", rf"Neither the names? of {SOME}nor the names of (?:its|their|any|other) contributors may be used to endorse", "neither", "contributors"),
    ("bsd-3-clause", r"The name of the author may not be used to endorse or promote products derived from this software", "author", "endorse"),
    ("bsd-4-clause", r"All advertising materials mentioning features or use of this software must display the following acknowledge?ment", "advertising", "materials"),
    ("bsd-3-clause-clear", r"NO EXPRESS OR IMPLIED LICENSES TO ANY PARTY'S PATENT RIGHTS ARE GRANTED", "licen", "patent"),
    ("sleepycat", r"Redistributions in any form must be accompanied by information on how to obtain complete source code", "redistribution", "accompanied"),
    ("zlib", r"Altered source versions must be plainly marked as such", "altered", "plainly"),
    ("zlib", r"The origin of this software must not be misrepresented", "software", "misrepresented"),
    ("libpng", r"The origin of this source code must not be misrepresented", "source", "misrepresented"),
    ("apache-2.0", r"Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"?AS IS\"? BASIS", "licen", "applicable"),
    ("apache-2.0", r"Licensed under the Apache License, Version 2\.0 \(the \"?License\"?\)", "licen", "apache"),
    ("apache-2.0", r"hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license", "licen", "irrevocable"),
    ("apache-2.0", r"How to apply the Apache License to your work", "licen", "apache"),
    ("apache-1.1", r"The names \"?Apache\"? and \"?Apache Software Foundation\"? must not be used to endorse", "software", "apache"),
    ("apache-1.0", r"This product includes software developed by the Apache Group", "software", "apache"),
    ("gpl-1.0", r"GNU General Public License as published by the Free Software Foundation[,;:] (?:either )?version 1(?![\w.])", "licen", "foundation"),
    ("gpl-2.0", r"GNU General Public License as published by the Free Software Foundation[,;:] (?:either )?version 2(?:\.0)?(?: of the License)?", "licen", "foundation"),
    ("gpl-3.0", r"GNU General Public License as published by the Free Software Foundation[,;:] (?:either )?version 3(?:\.0)?(?: of the License)?", "licen", "foundation"),
    ("gpl-2.0", r"either version 2 of the License, or \(at your option\) any later version", "licen", "option"),
    ("gpl-3.0", r"either version 3 of the License, or \(at your option\) any later version", "licen", "option"),
    ("gpl-2.0", r"the GNU General Public License is intended to guarantee your freedom to share and change free software", "licen", "freedom"),
    ("gpl-3.0", r"the GNU General Public License is intended to guarantee your freedom to share and change all versions of a program", "licen", "freedom"),
    ("gpl-3.0", r"The GNU General Public License is a free, copyleft license for software and other kinds of works", "licen", "copyleft"),
    ("agpl-3.0", r"GNU Affero General Public License as published by the Free Software Foundation[,;:] (?:either )?version 3(?: of the License)?", "licen", "affero"),
    ("agpl-3.0", r"The GNU Affero General Public License is a free, copyleft license", "licen", "affero"),
    ("lgpl-2.0", r"GNU (?:Lesser|Library) General Public License as published by the Free Software Foundation[,;:] (?:either )?version 2(?![\w.])", "licen", "foundation"),
    ("lgpl-2.1", r"GNU Lesser General Public License as published by the Free Software Foundation[,;:] (?:either )?version 2\.1(?: of the License)?", "licen", "lesser"),
    ("lgpl-3.0", r"GNU Lesser General Public License as published by the Free Software Foundation[,;:] (?:either )?version 3(?: of the License)?", "licen", "lesser"),
    ("lgpl-2.0", r"This is the first released version of the library GPL", "released", "library"),
    ("lgpl-2.1", r"This is the first released version of the Lesser GPL", "released", "lesser"),
    ("lgpl-3.0", r"This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3", "licen", "incorporates"),
    ("gfdl-1.1", r"modify this document under the terms of the GNU Free Documentation License, Version 1\.1", "licen", "documentation"),
    ("gfdl-1.2", r"modify this document under the terms of the GNU Free Documentation License, Version 1\.2", "licen", "documentation"),
    ("gfdl-1.3", r"modify this document under the terms of the GNU Free Documentation License, Version 1\.3", "licen", "documentation"),
    ("classpath-exception-2.0", r"give you permission to link this library with independent modules to produce an executable", "permission", "independent"),
    ("gcc-exception-3.1", r"GCC Runtime Library Exception", "exception", "runtime"),
    ("autoconf-exception-2.0", r"contains a configuration script generated by Autoconf", "configuration", "autoconf"),
    ("bison-exception-2.2", r"you may create a larger work that contains part or all of the Bison parser skeleton", "bison", "skeleton"),
    ("mpl-2.0", r"This Source Code Form is subject to the terms of the Mozilla Public License, v\. 2\.0", "licen", "mozilla"),
    ("mpl-2.0-no-copyleft-exception", r"This Source Code Form is \"?Incompatible With Secondary Licenses\"?", "licen", "incompatible"),
    ("mpl-1.0", r"The contents of this file are subject to the Mozilla Public License Version 1\.0", "licen", "mozilla"),
    ("mpl-1.1", r"The contents of this file are subject to the Mozilla Public License Version 1\.1", "licen", "mozilla"),
    ("npl-1.1", r"The contents of this file are subject to the Netscape Public License Version 1\.1", "licen", "netscape"),
    ("epl-1.0", r"made available under the terms of the Eclipse Public License v1\.0", "licen", "eclipse"),
    ("epl-2.0", r"made available under the terms of the Eclipse Public License(?: v\.?)? ?2\.0", "licen", "eclipse"),
    ("cddl-any", r"The contents of this file are subject to the terms of the Common Development and Distribution License", "licen", "distribution"),
    ("unlicense", r"This is free and unencumbered software released into the public domain", "software", "unencumbered"),
    ("wtfpl", r"You just do what the f\w+ you want to", "just", "want"),
    ("cc0-1.0", rf"To the extent possible under law, {SOME}(?:has|have) waived all copyright and related or neighboring rights", "copyright", "neighboring"),
    ("ofl-1.1", r"This Font Software is licensed under the SIL Open Font License, Version 1\.1", "licen", "font"),
    ("psf-2.0", r"PSF hereby grants Licensee a nonexclusive, royalty-free, world-?wide license", "licen", "nonexclusive"),
    ("openssl", r"This product includes software developed by the OpenSSL Project", "software", "openssl"),
    ("ssleay", r"This product includes cryptographic software written by Eric Young", "software", "cryptographic"),
    ("artistic-1.0", r"such that the Copyright Holder maintains some semblance of artistic control", "copyright", "artistic"),
    ("perl", r"you can redistribute it and/or modify it under the same terms as Perl itself", "redistribute", "perl"),
    ("ruby", r"You may make and give away verbatim copies of the source form of the software without restriction", "software", "verbatim"),
    ("php-3.01", r"This source file is subject to version 3\.01 of the PHP license", "licen", "3.01"),
    ("php-3.0", r"This source file is subject to version 3\.0 of the PHP license", "licen", "php"),
    ("zend-2.0", r"This source file is subject to version 2\.00 of the Zend license", "licen", "zend"),
    ("beerware", r"If we meet some day, and you think this stuff is worth it, you can buy me a beer", "stuff", "beer"),
    ("w3c", r"By obtaining,? using and/or copying this work, you \(the licensee\) agree", "licen", "obtaining"),
    ("ftl", r"Portions of this software are copyright (?:[\w(),-]+ ){0,4}The FreeType Project", "software", "freetype"),
    ("ijg", r"This software is based in part on the work of the Independent JPEG Group", "software", "jpeg"),
    ("bzip2-1.0.6", r"This program, \"?bzip2\"?, the associated library \"?libbzip2\"?", "program", "bzip2"),
    ("blessing", r"May you do good and not evil", "good", "evil"),
    ("eupl-1.1", r"Licensed under the EUPL, Version 1\.1", "licen", "eupl"),
    ("eupl-1.2", r"Licensed under the EUPL(?:,? Version| V\.?)? ?1\.2", "licen", "eupl"),
    ("qpl-1.0", r"This file may be distributed under the terms of the Q Public License", "licen", "public"),
    ("lppl-1.3c", r"under the conditions of the LaTeX Project Public License, either version 1\.3", "licen", "latex"),
    ("commons-clause", r"the grant of rights under the License will not include, and the License does not grant to you, the right to Sell the Software", "licen", "sell"),
]
# License names (label, signature, keyword beside "licen").
NAMES = [
    ("bsd-2-clause", r"BSD[ -](?:2|Two)[ -]Clause(?: \"?(?:Simplified|FreeBSD)\"?)? License", "clause"),
    ("bsd-3-clause", r"BSD[ -](?:3|Three)[ -]Clause(?: \"?(?:New|Revised|Modified)\"?)? License", "clause"),
    ("bsd-4-clause", r"BSD[ -](?:4|Four)[ -]Clause(?: \"?(?:Original|Old)\"?)? License", "clause"),
    ("bsd-1-clause", r"BSD[ -](?:1|One)[ -]Clause License", "clause"),
    ("0bsd", r"BSD Zero[ -]Clause License", "clause"),
    ("gpl-1.0", r"General Public License,? (?:version |v\.? ?)1(?:\.0)?(?![\w.])", "public"),
    ("lgpl-2.0", r"(?:Library|Lesser) General Public License,? (?:version |v\.? ?)2(?:\.0)?(?![\w.])", "public"),
    ("gfdl-1.1", r"Free Documentation License,? (?:version |v\.? ?)1\.1", "documentation"),
    ("gfdl-1.2", r"Free Documentation License,? (?:version |v\.? ?)1\.2", "documentation"),
    ("edl-1.0", r"Eclipse Distribution License(?: -)? (?:version |v\.? ?)1\.0", "eclipse"),
    ("cddl-1.1", r"Common Development and Distribution License(?: \(CDDL\))?,? (?:version |v\.? ?)1\.1", "distribution"),
    ("ipl-1.0", r"IBM Public License", "ibm"),
    ("ms-rl", r"Microsoft Reciprocal License", "reciprocal"),
    ("clartistic", r"Clarified Artistic License", "clarified"),
    ("artistic-1.0", r"Artistic License,? (?:version |v\.? ?)?1\.0", "artistic"),
    ("php-3.01", r"PHP License,? (?:version |v\.? ?)3\.01", "3.01"),
    ("php-3.0", r"PHP License,? (?:version |v\.? ?)3\.0(?!1)", "php"),
    ("curl", r"curl License", "curl"),
    ("vim", r"Vim License", "vim"),
    ("icu", r"ICU License", "icu"),
    ("w3c", r"W3C Software (?:and Document )?Notice and License", "w3c"),
    ("ftl", r"(?:The )?FreeType (?:Project )?License", "freetype"),
    ("imagemagick", r"ImageMagick License", "imagemagick"),
    ("info-zip", r"Info-ZIP License", "info-zip"),
    ("odc-by-1.0", r"Open Data Commons Attribution License", "commons"),
    ("pddl-1.0", r"Open Data Commons Public Domain Dedication (?:and|&) License", "dedication"),
    ("cdla-permissive-1.0", r"Community Data License Agreement(?: -)? Permissive,?(?: -)? Version 1\.0", "community"),
    ("cdla-permissive-2.0", r"Community Data License Agreement(?: -)? Permissive,?(?: -)? Version 2\.0", "community"),
    ("cdla-sharing-1.0", r"Community Data License Agreement(?: -)? Sharing,?(?: -)? Version 1\.0", "community"),
    ("busl-1.1", r"Business Source License,? (?:version |v\.? ?)?1\.1", "business"),
    ("sspl-1.0", r"Server Side Public License", "server"),
    ("elastic-2.0", r"Elastic License,? (?:version |v\.? ?)?2\.0", "elastic"),
    ("commons-clause", r"Commons Clause\"? License Condition", "clause"),
    ("polyform-noncommercial-1.0.0", r"PolyForm Noncommercial License", "polyform"),
    ("polyform-small-business-1.0.0", r"PolyForm Small Business License", "polyform"),
    ("polyform-shield-1.0.0", r"PolyForm Shield License", "polyform"),
    ("prosperity", r"Prosperity Public License", "prosperity"),
    ("parity", r"Parity Public License", "parity"),
    ("fsl-1.1", r"Functional Source License,? Version 1\.1", "functional"),
    ("openrail-m", r"CreativeML Open RAIL(?:\+\+)?-M License", "rail"),
    ("bigscience-rail-1.0", r"BigScience RAIL License", "rail"),
    ("llama-2", r"Llama 2 Community License", "llama"),
    ("llama-3", r"Llama 3(?:\.[123])? Community License", "llama"),
    ("cecill-2.1", r"CeCILL Free Software License Agreement", "cecill"),
    ("osl-3.0", r"Open Software License,? (?:version |v\.? ?)3\.0", "open"),
    ("osl-2.1", r"Open Software License,? (?:version |v\.? ?)2\.1", "open"),
    ("nposl-3.0", r"Non-Profit Open Software License(?:,? (?:version |v\.? ?)3\.0)?", "profit"),
    ("afl-3.0", r"Academic Free License,? (?:version |v\.? ?)3\.0", "academic"),
    ("afl-2.1", r"Academic Free License,? (?:version |v\.? ?)2\.1", "academic"),
    ("ecl-2.0", r"Educational Community License,? (?:version |v\.? ?)2\.0", "educational"),
    ("upl-1.0", r"Universal Permissive License", "permissive"),
    ("mulanpsl-2.0", r"Mulan Permissive Software License,? (?:version |v\.? ?)2", "mulan"),
    ("lppl-1.3c", r"LaTeX Project Public License,? (?:version |v\.? ?)1\.3", "latex"),
    ("rpl-1.5", r"Reciprocal Public License(?:,? (?:version |v\.? ?)?1\.5)?", "reciprocal"),
    ("apsl-2.0", r"Apple Public Source License", "apple"),
    ("sissl", r"Sun Industry Standards Source License", "industry"),
    ("spl-1.0", r"Sun Public License", "sun"),
    ("watcom-1.0", r"Sybase Open Watcom Public License", "watcom"),
    ("nokia", r"Nokia Open Source License", "nokia"),
    ("intel", r"Intel Open Source License", "intel"),
    ("rpsl-1.0", r"RealNetworks Public Source License", "realnetworks"),
    ("lpl-1.02", r"Lucent Public License", "lucent"),
    ("cpal-1.0", r"Common Public Attribution License", "attribution"),
    ("erlpl-1.1", r"Erlang Public License", "erlang"),
    ("zpl-2.1", r"Zope Public License(?: \(ZPL\))?,? (?:version |v\.? ?)2\.1", "zope"),
    ("zpl-2.0", r"Zope Public License(?: \(ZPL\))?,? (?:version |v\.? ?)2\.0", "zope"),
    ("oldap-2.8", r"OpenLDAP Public License", "openldap"),
    ("oclc-2.0", r"OCLC Research Public License", "oclc"),
    ("ogtsl", r"Open Group Test Suite License", "suite"),
    ("simpl-2.0", r"Simple Public License", "simple"),
    ("aal", r"Attribution Assurance License", "assurance"),
    ("apl-1.0", r"Adaptive Public License", "adaptive"),
    ("cnri-python", r"CNRI Python License", "cnri"),
    ("bittorrent-1.1", r"BitTorrent Open Source License", "bittorrent"),
    ("eudatagrid", r"EU DataGrid Software License", "datagrid"),
    ("entessa", r"Entessa Public License", "entessa"),
    ("frameworx-1.0", r"Frameworx Open License", "frameworx"),
    ("naumen", r"Naumen Public License", "naumen"),
    ("vsl-1.0", r"Vovida Software License", "vovida"),
    ("motosoto", r"Motosoto Open Source License", "motosoto"),
    ("miros", r"MirOS Licen[cs]e", "miros"),
    ("multics", r"Multics License", "multics"),
    ("cua-opl-1.0", r"CUA Office Public License", "office"),
    ("dsl", r"Design Science License", "science"),
    ("lal-1.3", r"Free Art License", "art"),
    ("opubl-1.0", r"Open Publication License", "publication"),
    ("ogl-uk-3.0", r"Open Government Licen[cs]e,? (?:version |v\.? ?)?3\.0", "government"),
    ("ogl-uk-2.0", r"Open Government Licen[cs]e,? (?:version |v\.? ?)?2\.0", "government"),
    ("apache-2.0", r"License :: OSI Approved :: Apache Software License", "approved"),
    ("bsd-any", r"License :: OSI Approved :: BSD License", "approved"),
    ("mit", r"License :: OSI Approved :: MIT License", "approved"),
    ("isc", r"License :: OSI Approved :: ISC License", "approved"),
    ("gpl-2.0", r"License :: OSI Approved :: GNU General Public License v2", "approved"),
    ("gpl-3.0", r"License :: OSI Approved :: GNU General Public License v3", "approved"),
    ("lgpl-3.0", r"License :: OSI Approved :: GNU Lesser General Public License v3", "approved"),
    ("agpl-3.0", r"License :: OSI Approved :: GNU Affero General Public License v3", "approved"),
    ("mpl-2.0", r"License :: OSI Approved :: Mozilla Public License 2\.0", "approved"),
    ("psf-2.0", r"License :: OSI Approved :: Python Software Foundation License", "approved"),
    ("proprietary", r"License :: Other/Proprietary License", "proprietary"),
]
# The six kinds of Creative Commons licenses with their long names.
COMMONS = [
    ("by", r"Attribution(?![- ](?:Non|Share|No))"), ("by-sa", r"Attribution[- ]Share ?Alike"),
    ("by-nd", r"Attribution[- ]No ?Deriv(?:ative)?s"), ("by-nc", r"Attribution[- ]Non-?Commercial(?![- ](?:Share|No))"),
    ("by-nc-sa", r"Attribution[- ]Non-?Commercial[- ]Share ?Alike"),
    ("by-nc-nd", r"Attribution[- ]Non-?Commercial[- ]No ?Deriv(?:ative)?s"),
]
COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


def blanks(signature: str) -> str:
    """A blank of a signature is any run of white space and comment marks;
    " ?" is an optional one, and blanks within brackets stay."""
    out, depth = [], 0
    for ch in signature:
        depth += (ch == "[") - (ch == "]")
        out.append(rf"(?:{BLANK})" if ch == " " and not depth else ch)
    return "".join(out)


def signature_rules() -> list[tuple[str, str, int, str, str]]:
    """(label, pattern, priority, first keyword, second keyword), in order."""
    out = [(label, rf"(?i){blanks(s)}", 4, one, two) for label, s, one, two in NOTICES]
    out += [(label, rf"(?i)(?<![\w]){blanks(s)}(?![\w])", 2, "licen", key) for label, s, key in NAMES]
    for kind, name in COMMONS:
        for v in COMMONS_VERSIONS:
            point = v.replace(".", r"\.")
            out.append((f"cc-{kind}-{v}", rf"(?i)(?<![\w])Creative{BLANK}Commons{BLANK}{blanks(name)}"
                        rf"(?:{BLANK}(?:International|Unported|Generic))?(?:{BLANK}Licen[cs]e)?(?:,?{BLANK}version)?{BLANK}{point}"
                        rf"(?:{BLANK}(?:International|Unported|Generic))?(?![\w])", 2, "commons", v))
            out.append((f"cc-{kind}-{v}", rf"(?i)creativecommons\.org/licenses/{kind}/{point}", 3, "commons", v))
    return out
