"""License scans by ordered signature rules.

A text is read as its words: runs of ASCII digits and letters and of characters
beyond ASCII, A-Z in lower case. Each rule is a regular expression over the words
joined by single spaces. Rules come from a table of licenses and a table of
wordings, from short forms that stand without the word license, and from sentences of
license bodies and file headers; a rule is tried only if its keyword is among the text's words.
Detections are taken in order of priority; one that lies within a taken one is
suppressed. The four base phrases are always reported.

Detections and their word numbers take n log n steps for n detections, so one text may hold any number.

Defined cases: a null text counts as empty. Rows with equal or null ids are
scanned each by itself. Columns named like an output column are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeretrieve.llm.registry import ORACLES, QUERIES, table

# Fixed phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label, keyword (a word every match has), expression over words.
LICENSES = [
    ("gpl", "gnu", r"gnu (?:general public|gpl)"),
    ("gpl", "gpl", r"gpl(?: ?v?[123](?: 0)?)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public"),
    ("lgpl", "library", r"gnu library general public"),
    ("lgpl", "lgpl", r"lgpl(?: ?v?[23](?: [01])?)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public"),
    ("agpl", "agpl", r"agpl(?: ?v?3(?: 0)?)?"),
    ("gfdl", "documentation", r"gnu free documentation"),
    ("apache", "apache", r"apache(?: software)?(?: ?2(?: 0)?)?"),
    ("mit", "mit", r"mit(?: x11| expat)?"),
    ("mit", "expat", r"expat"),
    ("x11", "x11", r"x11"),
    ("bsd-2-clause", "freebsd", r"freebsd"),
    ("bsd-2-clause", "simplified", r"(?:simplified|2 clause) bsd"),
    ("bsd-3-clause", "revised", r"(?:new|revised|modified|3 clause) bsd"),
    ("bsd", "bsd", r"bsd(?: [234] clause)?"),
    ("0bsd", "0bsd", r"0bsd"),
    ("isc", "isc", r"isc"),
    ("mpl", "mozilla", r"mozilla public(?: [12] [01])?"),
    ("mpl", "mpl", r"mpl(?: ?[12](?: [01])?)?"),
    ("epl", "eclipse", r"eclipse public(?: v?[12](?: 0)?)?"),
    ("epl", "epl", r"epl(?: ?v?[12](?: 0)?)?"),
    ("cddl", "cddl", r"cddl(?: 1 [01])?"),
    ("cddl", "distribution", r"common development and distribution"),
    ("cpl", "common", r"common public(?: 1 0)?"),
    ("eupl", "eupl", r"eupl(?: ?v?1 [0-2])?"),
    ("eupl", "european", r"european union public"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by", "attribution", r"creative commons attribution(?: [1-4] [05])?(?: international| unported)?"),
    ("cc-by-sa", "sharealike", r"(?:creative commons )?attribution (?:sharealike|share alike)"),
    ("cc-by-nc", "noncommercial", r"(?:creative commons )?attribution (?:noncommercial|non commercial)"),
    ("cc-by-nd", "noderivatives", r"(?:creative commons )?attribution (?:noderivatives|no derivatives|noderivs)"),
    ("cc", "commons", r"creative commons"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("libpng", "libpng", r"libpng(?: 2)?"),
    ("boost", "boost", r"boost software(?: 1 0)?"),
    ("boost", "bsl", r"bsl 1 [01]"),
    ("artistic", "artistic", r"artistic(?: [12] 0)?"),
    ("perl", "perl", r"perl"),
    ("python", "psf", r"(?:psf|python software foundation)"),
    ("python", "python", r"python"),
    ("php", "php", r"php(?: 3 01)?"),
    ("ruby", "ruby", r"ruby"),
    ("openssl", "openssl", r"openssl"),
    ("postgresql", "postgresql", r"postgresql"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?"),
    ("ofl", "ofl", r"(?:sil )?ofl(?: 1 1)?"),
    ("ofl", "font", r"(?:sil )?open font"),
    ("odbl", "odbl", r"odbl(?: 1 0)?"),
    ("odbl", "database", r"open (?:data commons open )?database"),
    ("odc-by", "odc", r"odc by(?: 1 0)?"),
    ("ms-pl", "microsoft", r"microsoft public"),
    ("ms-rl", "reciprocal", r"microsoft reciprocal"),
    ("osl", "osl", r"osl(?: 3 0)?"),
    ("osl", "open", r"open software"),
    ("afl", "academic", r"academic free"),
    ("qpl", "qpl", r"qpl|q public"),
    ("sleepycat", "sleepycat", r"sleepycat"),
    ("vim", "vim", r"vim"),
    ("w3c", "w3c", r"w3c(?: software)?"),
    ("upl", "upl", r"upl(?: 1 0)?|universal permissive"),
    ("llvm", "llvm", r"llvm(?: exception)?"),
    ("busl", "busl", r"busl 1 1"),
    ("busl", "business", r"business source"),
    ("sspl", "sspl", r"sspl(?: ?v?1)?|server side public"),
    ("elastic", "elastic", r"elastic(?: 2 0)?"),
    ("openrail", "openrail", r"(?:creativeml )?openrail(?: m)?"),
    ("cc-by-nc-sa", "sharealike", r"(?:creative commons )?attribution (?:noncommercial|non commercial) (?:sharealike|share alike)"),
    ("cc-by-nc-nd", "noderivatives", r"(?:creative commons )?attribution (?:noncommercial|non commercial) (?:noderivatives|no derivatives|noderivs)"),
    ("proprietary", "proprietary", r"proprietary"),
    ("proprietary", "commercial", r"commercial"),
]

# Name, priority (higher is taken first), weight of the evidence, wording around a license's expression.
WORDINGS = [
    ("tag", 5, 0.95, r"spdx licen[sc]e identifier (?:{0})(?: only| or later)?"),
    ("grant", 4, 0.9, r"(?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?(?:{0}) licen[sc]e(?: v(?:ersion)? ?\d(?: \d)?)?"),
    ("terms", 3, 0.85, r"(?:under|by|to) the (?:terms|conditions)(?: and conditions)? of (?:the |an? )?(?:{0}) licen[sc]e"),
    ("field", 2, 0.8, r"licen[sc]e(?:s|d)?(?: under| is| type)? (?:the )?(?:{0})"),
    ("title", 1, 0.7, r"(?:{0}) licen[sc]es?(?: v(?:ersion)? ?\d(?: \d)?)?"),
]
# Every wording has a word with this in it.
WORDING_HAS = b"licen"

# Label, keyword, expression of names that are clear without the word license; wordings apply to them too.
_CC_VERSION = r"(?: [1-4] [05](?: international| unported)?)?"
SHORT = [
    *[
        (f"cc-by{kind}", keyword, name + r" by" + kind.replace("-", " ") + _CC_VERSION)
        for kind in ("", "-sa", "-nc", "-nd", "-nc-sa", "-nc-nd")
        for keyword, name in (("cc", "cc"), ("commons", "creative commons"))
    ],
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0", "zero", r"(?:creative commons|cc) zero(?: v?1 0)?"),
    *[("gpl", f"gpl{v}{n}", rf"(?:gnu )?gpl{v}{n}(?: 0)?(?: only| or later)?") for v in ("v", "") for n in "123"],
    ("gpl", "gpl", r"(?:gnu )?gpl(?: v(?:ersion)?)? ?[123](?: 0)?(?: only| or later)?"),
    ("gpl", "gpl", r"gpl v[123](?: 0)?(?: only| or later)?"),
    ("gpl", "gpl", r"gnu gpl"),
    *[("lgpl", f"lgpl{v}{n}", rf"(?:gnu )?lgpl{v}{n}(?: [01])?(?: only| or later)?") for v in ("v", "") for n in "23"],
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?:(?: v| version)? ?[23](?: [01])?)?(?: only| or later)?"),
    ("lgpl", "lgpl", r"lgpl v[23](?: [01])?(?: only| or later)?"),
    *[("agpl", f"agpl{v}3", rf"(?:gnu )?agpl{v}3(?: 0)?(?: only| or later)?") for v in ("v", "")],
    ("agpl", "agpl", r"(?:gnu )?agpl(?: v?3(?: 0)?)?(?: only| or later)?"),
    ("gfdl", "gfdl", r"(?:gnu )?gfdl(?: 1 [1-3])?(?: only| or later)?"),
    ("apache", "apache", r"apache(?: v| version)? ?2 0"),
    ("apache", "apache", r"apache v2(?: 0)?"),
    ("apache", "apache2", r"apache2"),
    ("bsd-2-clause", "bsd", r"bsd 2 clause|2 clause bsd"),
    ("bsd-3-clause", "bsd", r"bsd 3 clause|3 clause bsd"),
    ("bsd-4-clause", "bsd", r"bsd 4 clause|4 clause bsd"),
    ("0bsd", "0bsd", r"0bsd"),
    *[("mpl", f"mpl{v}", rf"mpl{v}(?: 0)?") for v in ("2", "v2")],
    ("mpl", "mpl", r"mpl v?[12] [01]"),
    *[("epl", f"epl{v}", rf"epl{v}(?: 0)?") for v in ("1", "2", "v1", "v2")],
    ("epl", "epl", r"epl v?[12] 0"),
    ("cddl", "cddl", r"cddl(?: 1 [01])?"),
    ("eupl", "eupl", r"eupl(?: v?1 [0-2])?"),
    ("odbl", "odbl", r"odbl(?: v?1 0)?"),
    ("ofl", "ofl", r"(?:sil )?ofl 1 [01]"),
    ("boost", "bsl", r"bsl 1 0"),
    ("busl", "busl", r"busl 1 1"),
    ("osl", "osl", r"osl 3 0"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("sspl", "sspl", r"sspl(?: v?1(?: 0)?)?"),
    ("unlicense", "unlicense", r"unlicense"),
]
SHORT_PRIORITY, SHORT_WEIGHT = 0, 0.75

# Label, keyword, sentence of a license's body or of the header that it asks for.
_GRANT = r"permission is hereby granted free of charge to any person obtaining a copy"
_FEE = r"permission to use copy modify (?:and )?(?:or )?distribute this software for any purpose with or without fee is hereby granted"
_MODIFY = r"you (?:can|may) redistribute it and or modify it under the terms of the gnu "
_DETAILS = r"merchantability or fitness for a particular purpose see the gnu "
SENTENCES = [
    ("mit", "hereby", _GRANT),
    ("mit", "hereby", _GRANT + r" of this software and associated documentation files(?: the software)? to deal in the software"),
    ("mit", "substantial", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("ncsa", "hereby", _GRANT + r" of this software and associated documentation files(?: the software)? to deal with the software"),
    ("ofl", "hereby", _GRANT + r" of the font software"),
    ("boost", "hereby", r"permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("isc", "hereby", _FEE),
    ("isc", "hereby", _FEE + r" provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd", "hereby", _FEE + r" the software is provided"),
    ("postgresql", "hereby", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms(?: with or without modification)?(?: are permitted)?(?: provided that the following conditions are met)?"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-3-clause", "endorse", r"neither the names? of(?: [^ ]+){1,12} nor the names? of(?: [^ ]+){1,6} may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache", "compliance", r"you may not use this (?:file|work|software|project|code) except in compliance with the license"),
    ("apache", "applicable", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache", "asf", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("gpl", "redistribute", _MODIFY + r"general public"),
    ("lgpl", "redistribute", _MODIFY + r"(?:lesser|library) general public"),
    ("agpl", "redistribute", _MODIFY + r"affero general public"),
    ("gpl", "merchantability", _DETAILS + r"general public"),
    ("lgpl", "merchantability", _DETAILS + r"(?:lesser|library) general public"),
    ("agpl", "merchantability", _DETAILS + r"affero general public"),
    ("gfdl", "document", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation"),
    ("mpl", "mozilla", r"this source code form is subject to the terms of the mozilla public"),
    ("epl", "eclipse", r"made available under the terms of the eclipse public"),
    ("cddl", "distribution", r"subject to the terms of the common development and distribution"),
    ("zlib", "liable", r"in no event will the authors? be held liable for any damages arising from the use of this software"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", "fuck", r"do what the fuck you want to"),
    ("cc0", "waived", r"waived all copyright and related or neighbou?ring rights"),
    ("cc", "redistribute", r"copy and redistribute the material in any medium or format"),
    ("cc", "remix", r"remix transform and build upon the material"),
    ("cc-by", "credit", r"you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by-nc", "commercial", r"you may not use the material for commercial purposes"),
    ("cc-by-sa", "contributions", r"you must distribute your contributions under the same license as the original"),
    ("cc-by-nd", "remix", r"if you remix transform or build upon the material you may not distribute the modified material"),
    ("cc0", "dedicated", r"(?:has|have) dedicated the work to the public domain by waiving"),
    ("gpl", "warranty", r"this program comes with absolutely no warranty"),
    ("gpl", "received", r"you should have received a copy of the gnu general public"),
    ("lgpl", "received", r"you should have received a copy of the gnu (?:lesser|library) general public"),
    ("agpl", "received", r"you should have received a copy of the gnu affero general public"),
    ("gpl", "everyone", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl", "freedom", r"the gnu general public license is intended to guarantee your freedom to share and change"),
    ("gpl", "copyleft", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("agpl", "remotely", r"all users interacting with it remotely through a computer network"),
    ("lgpl", "combined", r"you may convey a combined work under terms of your choice"),
    ("gfdl", "invariant", r"with no invariant sections no front cover texts and no back cover texts"),
    ("apache", "contributor", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("apache", "prominent", r"you must cause any modified files to carry prominent notices stating that you changed the files"),
    ("bsd", "binary", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "regents", r"this software is provided by the regents and contributors as is"),
    ("bsd", "holders", r"this software is provided by the copyright holders and contributors as is"),
    ("bsd-2-clause", "freebsd", r"the views and conclusions contained in the software and documentation are those of the authors(?: [^ ]+){0,12} freebsd project"),
    ("mit", "noninfringement", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("x11", "consortium", r"the name of the x consortium shall not be used in advertising or otherwise to promote"),
    ("isc", "disclaims", r"the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("mpl", "mpl", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl", "incompatible", r"this source code form is incompatible with secondary licenses"),
    ("mpl", "mozilla", r"the contents of this file are subject to the mozilla public"),
    ("epl", "accompanying", r"this program and the accompanying materials are made available under the terms of the eclipse public"),
    ("epl", "accompanying", r"the accompanying program is provided under the terms of this eclipse public"),
    ("cpl", "accompanying", r"the accompanying program is provided under the terms of this common public"),
    ("cddl", "cddl", r"the contents of this file are subject to the terms of the cddl"),
    ("eupl", "eupl", r"licensed under the eupl"),
    ("zlib", "altered", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "commercial", r"permission is granted to anyone to use this software for any purpose including commercial applications"),
    ("libpng", "png", r"the png reference library is supplied as is"),
    ("boost", "machine", r"unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor"),
    ("artistic", "artistic", r"this (?:is free software|program is free software) you can redistribute it and or modify it under (?:the terms of )?the artistic"),
    ("perl", "perl", r"under the same terms as perl(?: itself)?"),
    ("python", "psf", r"psf is making python available to licensee on an as is basis"),
    ("python", "psf", r"this license agreement is between the python software foundation psf and the individual or organization"),
    ("php", "php", r"this product includes php software freely available from"),
    ("openssl", "openssl", r"this product includes software developed by the openssl project"),
    ("openssl", "cryptographic", r"this product includes cryptographic software written by"),
    ("postgresql", "california", r"in no event shall the university of california be liable to any party for direct indirect special incidental or consequential damages"),
    ("ncsa", "neither", r"neither the names of(?: [^ ]+){1,12} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("ofl", "reserved", r"no modified version of the font software may use the reserved font name"),
    ("ofl", "font", r"this font software is licensed under the sil open font"),
    ("odbl", "database", r"is made available under the open database license"),
    ("odc-by", "commons", r"is made available under the open data commons attribution"),
    ("ms-pl", "contribution", r"each contributor grants you a non exclusive worldwide royalty free copyright license to reproduce its contribution"),
    ("w3c", "w3c", r"this work is distributed under the w3c software"),
    ("upl", "lrgrwrks", r"any piece of software and or hardware listed in the lrgrwrks"),
    ("vim", "vim", r"there are no restrictions on distributing unmodified copies of vim"),
    ("sleepycat", "accompanied", r"redistributions in any form must be accompanied by information on how to obtain complete source code"),
    ("llvm", "llvm", r"under the apache license v2 0 with llvm exceptions"),
    ("busl", "production", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("sspl", "service", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("elastic", "hosted", r"you may not provide the software to third parties as a hosted or managed service"),
    ("openrail", "derivatives", r"you agree not to use the model or derivatives of the model"),
    ("proprietary", "confidential", r"(?:this (?:file|document|software) is |proprietary and )confidential(?: and proprietary)?"),
    ("proprietary", "unauthorized", r"unauthorized copying of this (?:file|software|document) via any medium is strictly prohibited"),
    ("proprietary", "reproduced", r"no part of this (?:publication|document|work|book) may be reproduced(?: [^ ]+){0,12} without(?: the)? prior written permission"),
]
SENTENCE_PRIORITY, SENTENCE_WEIGHT = 6, 0.9

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    keyword: bytes
    priority: int
    weight: float
    expression: re.Pattern[bytes]
    needs: bytes = b""  # what a text with a match contains besides the keyword


def _expression(words: str) -> re.Pattern[bytes]:
    return re.compile(rb"(?<![^ ])(?:" + words.encode() + rb")(?![^ ])")


@lru_cache(maxsize=1)
def rules() -> list[Rule]:
    """Every license in every wording, short forms and sentences, highest priority first."""
    made = [
        Rule(f"{label}-{keyword}-{name}", label, keyword.encode(), priority, weight, _expression(wording.format(body)), WORDING_HAS)
        for label, keyword, body in [*LICENSES, *SHORT]
        for name, priority, weight, wording in WORDINGS
    ]
    made += [Rule(f"{label}-{keyword}-short", label, keyword.encode(), SHORT_PRIORITY, SHORT_WEIGHT, _expression(body)) for label, keyword, body in SHORT]
    made += [Rule(f"{label}-{keyword}-sentence", label, keyword.encode(), SENTENCE_PRIORITY, SENTENCE_WEIGHT, _expression(body)) for label, keyword, body in SENTENCES]
    return sorted(made, key=lambda r: -r.priority)


@lru_cache(maxsize=1)
def _by_keyword() -> dict[bytes, list[Rule]]:
    found: dict[bytes, list[Rule]] = {}
    for rule in rules():
        found.setdefault(rule.keyword, []).append(rule)
    return found


@lru_cache(maxsize=1)
def _base() -> list[tuple[str, re.Pattern[bytes]]]:
    return [(label, _expression(phrase)) for phrase, label in BASE.items()]


@lru_cache(maxsize=1)
def _gate() -> frozenset[bytes]:
    """Words of which a text has one if any rule or base phrase matches."""
    return frozenset(_by_keyword()) | {phrase.split()[0].encode() for phrase in BASE}


def _outermost(intervals: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends, both ascending, of the intervals that lie in no other one."""
    starts, ends = [], []
    for a, b in sorted(intervals, key=lambda i: (i[0], -i[1])):
        if not ends or b > ends[-1]:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _unsuppressed(found: list[tuple[Rule, int, int]]) -> list[tuple[Rule, int, int]]:
    """Detections not contained in one of higher priority, or in a longer or earlier one of the same.

    What lies in a suppressed detection lies in the one that suppressed it, so each is compared
    with all before it: by search among the outermost intervals of higher priorities, and by the
    furthest end so far among its own.
    """
    taken: list[tuple[Rule, int, int]] = []
    starts, ends = [], []
    ordered = sorted(found, key=lambda d: (-d[0].priority, d[1], -d[2], d[0].name))
    for _, equals in groupby(ordered, key=lambda d: d[0].priority):
        kept, furthest = [], -1
        for rule, a, b in equals:
            over = bisect_right(starts, a) - 1
            if b > furthest and (over < 0 or ends[over] < b):
                kept.append((rule, a, b))
            furthest = max(furthest, b)
        taken += kept
        starts, ends = _outermost([*zip(starts, ends), *[(a, b) for _, a, b in kept]])
    return sorted(taken, key=lambda d: (d[1], d[2], d[0].name))


def scan(text: bytes | None) -> tuple:
    """Words, base places and labels, and the detections of one text given in UTF-8."""
    low = (text or b"").lower()  # of bytes, so A-Z only
    words = _WORDS.findall(low)
    known = _gate().intersection(words)
    if not known:
        return len(words), 0, None, None, "", "", 0.0, []
    joined = b" ".join(words)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == ord(" "))
    place = lambda at: int(np.searchsorted(spaces, at))
    base = [(label, m.start()) for label, expression in _base() for m in expression.finditer(joined)]
    starts = [at for _, at in base]
    tried = [rule for keyword in known & _by_keyword().keys() for rule in _by_keyword()[keyword] if rule.needs in low]
    found = _unsuppressed([(rule, m.start(), m.end()) for rule in tried for m in rule.expression.finditer(joined)])
    base_labels = {label for label, _ in base}
    doubt = 1.0
    for label in base_labels | {rule.label for rule, _, _ in found}:
        doubt *= 1 - max([0.9 * (label in base_labels), *[rule.weight for rule, _, _ in found if rule.label == label]])
    return (
        len(words),
        len(base),
        place(min(starts)) if starts else None,
        place(max(starts)) if starts else None,
        ",".join(sorted(base_labels)),
        ",".join(sorted(base_labels | {rule.label for rule, _, _ in found})),
        round(1 - doubt, 6),
        [(rule.label, rule.name, place(a), place(b) + 1) for rule, a, b in found],
    )


FOUND = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "detections array<struct<label:string, rule:string, first_word:long, after_word:long>>"
)
COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]


def with_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text and with the columns of :data:`COLUMNS`."""
    kept = [f for f in docs.schema if f.name != text and f.name not in COLUMNS]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = pd.DataFrame([scan(t) for t in rows["__text"]], columns=COLUMNS)
            whole_numbers = {c: "Int64" for c in COLUMNS[:4]}
            yield pd.concat([rows[[f.name for f in kept]].reset_index(drop=True), found.astype(whole_numbers)], axis=1)

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], FOUND])
    return docs.select(*[f.name for f in kept], F.col(text).cast("binary").alias("__text")).mapInPandas(run, schema)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("detections")


QUERIES["op1_license_scan"] = op1_license_scan
