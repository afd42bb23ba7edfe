"""License scans: ordered signature rules behind a keyword prefilter.

A text is lower-cased in A-Z and cut into words; rules are regular expressions over the words
joined by single blanks.  One Aho-Corasick pass finds the keywords; a rule runs only on texts that
hold its keyword, so most texts run none.  Detections that overlap are settled by rank: a rule of
higher priority, then the longer match, then the earlier rule suppresses what lies inside it.

Rules come in families: license names with their spellings and versions under several sentence
patterns ("licensed under …", SPDX identifiers, web addresses), and sentences typical of one text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

#: Upper-case ASCII letters to lower case, and nothing else.
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

# The phrases and labels of the contract.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    keyword: str
    priority: int
    score: float
    base: bool = False


# One line per license: label; spellings of its name, as regular expressions over blank-joined
# words; the words of its SPDX identifier.  The longest literal of a spelling becomes its keyword.
NAMES = """
mit; mit(?: expat)? licen[cs]e|expat licen[cs]e|mit x11 licen[cs]e; mit
mit-0; mit no attribution(?: licen[cs]e)?; mit 0
apache-1; apache(?: software)? licen[cs]e v?(?:ersion )?1(?: [01])?; apache 1 [01]
apache-2; apache(?: software)? licen[cs]e(?: version| v)? ?2(?: 0)?|apache 2(?: 0)? licen[cs]e; apache 2 0
gpl-1; (?:gnu )?general public licen[cs]e v?(?:ersion )?1(?: 0)?|gnu gpl ?v?1(?: 0)?; gpl 1 0
gpl-2; (?:gnu )?general public licen[cs]e v?(?:ersion )?2(?: 0)?|gnu gpl ?v?2(?: 0)?|gplv2; gpl 2 0
gpl-3; (?:gnu )?general public licen[cs]e v?(?:ersion )?3(?: 0)?|gnu gpl ?v?3(?: 0)?|gplv3; gpl 3 0
lgpl-2; (?:gnu )?(?:library|lesser) general public licen[cs]e v?(?:ersion )?2(?: 0)?|lgplv2; lgpl 2 0
lgpl-2.1; (?:gnu )?lesser general public licen[cs]e v?(?:ersion )?2 1|lgplv2 1; lgpl 2 1
lgpl-3; (?:gnu )?lesser general public licen[cs]e v?(?:ersion )?3(?: 0)?|lgplv3; lgpl 3 0
agpl-3; (?:gnu )?affero general public licen[cs]e(?: v?(?:ersion )?3(?: 0)?)?|agplv3; agpl 3 0
fdl; gnu free documentation licen[cs]e(?: v?(?:ersion )?1 [1-3])?; gfdl 1 [1-3]
bsd-2; (?:simplified|freebsd) bsd licen[cs]e|bsd 2 clause licen[cs]e|2 clause bsd licen[cs]e; bsd 2 clause
bsd-3; (?:new|revised|modified) bsd licen[cs]e|bsd 3 clause licen[cs]e|3 clause bsd licen[cs]e; bsd 3 clause
bsd-4; original bsd licen[cs]e|bsd 4 clause licen[cs]e|4 clause bsd licen[cs]e; bsd 4 clause
0bsd; zero clause bsd licen[cs]e|bsd zero clause licen[cs]e; 0bsd
isc; isc licen[cs]e|internet systems consortium licen[cs]e; isc
mpl-1; mozilla public licen[cs]e v?(?:ersion )?1(?: [01])?; mpl 1 [01]
mpl-2; mozilla public licen[cs]e(?: v?(?:ersion )?2(?: 0)?)?|mplv2; mpl 2 0
epl-1; eclipse public licen[cs]e v?(?:ersion )?1(?: 0)?; epl 1 0
epl-2; eclipse public licen[cs]e(?: v?(?:ersion )?2(?: 0)?)?; epl 2 0
cddl; common development and distribution licen[cs]e(?: v?(?:ersion )?1(?: [01])?)?; cddl 1 [01]
cpl; common public licen[cs]e(?: v?(?:ersion )?1(?: 0)?)?; cpl 1 0
eupl; european union public licen[cs]e(?: v?(?:ersion )?1(?: [12])?)?; eupl 1 [12]
artistic-1; artistic licen[cs]e v?(?:ersion )?1(?: 0)?; artistic 1 0
artistic-2; artistic licen[cs]e(?: v?(?:ersion )?2(?: 0)?)?; artistic 2 0
zlib; zlib(?: libpng)? licen[cs]e; zlib
boost; boost software licen[cs]e(?: v?(?:ersion )?1(?: 0)?)?; bsl 1 0
python; python software foundation licen[cs]e(?: v?(?:ersion )?2(?: 0)?)?|psf licen[cs]e; psf 2 0|python 2 0
php; php licen[cs]e(?: v?(?:ersion )?3(?: 01?)?)?; php 3 01?
ruby; ruby licen[cs]e; ruby
perl; same terms as perl(?: itself)?|perl artistic licen[cs]e; artistic 1 0 perl
postgresql; postgresql licen[cs]e; postgresql
openssl; openssl licen[cs]e; openssl
ofl; sil open font licen[cs]e(?: v?(?:ersion )?1(?: 1)?)?; ofl 1 1
unlicense; the unlicense|unlicense licen[cs]e; unlicense
wtfpl; do what the fuck you want to public licen[cs]e; wtfpl
ms-pl; microsoft public licen[cs]e; ms pl
ms-rl; microsoft reciprocal licen[cs]e; ms rl
ncsa; university of illinois ncsa(?: open source licen[cs]e)?|ncsa open source licen[cs]e; ncsa
afl; academic free licen[cs]e(?: v?(?:ersion )?[123](?: [012])?)?; afl [123] [012]
osl; open software licen[cs]e(?: v?(?:ersion )?[123](?: [01])?)?; osl [123] [01]
qpl; q public licen[cs]e; qpl 1 0
sleepycat; sleepycat licen[cs]e; sleepycat
upl; universal permissive licen[cs]e; upl 1 0
vim; vim licen[cs]e; vim
w3c; w3c software(?: notice and)? licen[cs]e; w3c
x11; x11 licen[cs]e; x11
curl; curl licen[cs]e; curl
intel; intel open source licen[cs]e; intel
json; json licen[cs]e; json
lppl; latex project public licen[cs]e; lppl 1 [0-3]c?
odbl; open database licen[cs]e|open data commons open database; odbl 1 0
odc-by; open data commons attribution; odc by 1 0
pddl; open data commons public domain dedication; pddl 1 0
cc0; creative commons zero|cc0(?: 1 0)?(?: universal)?; cc0 1 0
cc-by; creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?|cc by(?: [1-4] [05])?; cc by [1-4] [05]
cc-by-sa; creative commons attribution share ?alike(?: [1-4] [05])?|cc by sa(?: [1-4] [05])?; cc by sa [1-4] [05]
cc-by-nd; creative commons attribution no ?deriv(?:s|atives)(?: [1-4] [05])?|cc by nd(?: [1-4] [05])?; cc by nd [1-4] [05]
cc-by-nc; creative commons attribution non ?commercial(?: [1-4] [05])?|cc by nc(?: [1-4] [05])?; cc by nc [1-4] [05]
cc-by-nc-sa; creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?|cc by nc sa(?: [1-4] [05])?; cc by nc sa [1-4] [05]
cc-by-nc-nd; creative commons attribution non ?commercial no ?deriv(?:s|atives)(?: [1-4] [05])?|cc by nc nd(?: [1-4] [05])?; cc by nc nd [1-4] [05]
sspl; server side public licen[cs]e; sspl 1 0
busl; business source licen[cs]e; busl 1 1
elastic; elastic licen[cs]e(?: 2 0)?; elastic 2 0
polyform; polyform (?:noncommercial|small business|shield|strict) licen[cs]e; polyform \\w+ 1 0
""".strip().splitlines()

# Sentences and addresses that belong to one license: label; pattern; keyword; score.
SENTENCES = """
mit; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files; hereby granted; 1
mit; the software is provided as is without warranty of any kind express or implied; without warranty; 0.7
mit; the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software; permission notice; 0.9
mit; opensource org licenses mit; opensource; 0.95
mit; released under mit|mit licensed; mit; 0.8
apache-2; www apache org licenses license 2 0; apache; 1
apache-2; you may not use this file except in compliance with the license; compliance with; 0.9
apache-2; unless required by applicable law or agreed to in writing software distributed under the license; applicable law; 0.9
gpl; gnu general public licen[cs]e|gnu gpl; gnu; 0.8
gpl; www gnu org licenses gpl; gnu; 0.9
gpl; either version [123] of the license or at your option any later version; later version; 0.85
gpl; this program is free software you can redistribute it and or modify; free software; 0.9
gpl; you should have received a copy of the gnu general public license; gnu; 0.9
lgpl; gnu (?:lesser|library) general public licen[cs]e; gnu; 0.8
lgpl; www gnu org licenses lgpl; gnu; 0.9
agpl-3; www gnu org licenses agpl; gnu; 0.9
agpl-3; remote network interaction use with the gnu general public license; gnu; 0.9
fdl; www gnu org licenses fdl; gnu; 0.9
fdl; with no invariant sections no front cover texts and no back cover texts; invariant sections; 0.95
bsd; redistribution and use in source and binary forms with or without modification are permitted; redistribution and use; 0.9
bsd; bsd style licen[cs]e|bsd licen[cs]e; bsd; 0.7
bsd-2; redistributions in binary form must reproduce the above copyright notice this list of conditions; redistributions in binary; 0.7
bsd-3; neither the name of .{1,120}? nor the names of its contributors may be used to endorse or promote products; neither the name; 0.95
bsd-4; all advertising materials mentioning features or use of this software must display; advertising materials; 0.95
bsd-3; opensource org licenses bsd 3 clause; opensource; 0.95
bsd-2; opensource org licenses bsd 2 clause; opensource; 0.95
isc; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted; hereby granted; 1
mpl-2; this source code form is subject to the terms of the mozilla public license; mozilla; 1
mpl-2; mozilla org mpl 2 0; mozilla; 0.95
mpl-1; the contents of this file are subject to the mozilla public license; mozilla; 0.95
epl-1; www eclipse org legal epl v10; eclipse; 0.95
epl-2; www eclipse org legal epl 2 0; eclipse; 0.95
cddl; subject to the terms of the common development and distribution license; common development; 1
zlib; this software is provided as is without any express or implied warranty in no event will the authors be held liable; in no event; 0.95
zlib; altered source versions must be plainly marked as such; altered source; 0.95
boost; www boost org license 1 0; boost; 0.95
boost; boost software license; boost; 0.9
unlicense; this is free and unencumbered software released into the public domain; unencumbered; 1
unlicense; unlicense org; unlicense; 0.95
public-domain; released into the public domain|dedicated to the public domain; public domain; 0.8
public-domain; this (?:work|file|text|software) is in the public domain; public domain; 0.9
cc0; to the extent possible under law .{1,120}? waived all copyright; waived all; 0.95
cc0; creativecommons org publicdomain zero 1 0; creativecommons; 1
cc-by; creativecommons org licenses by [1-4] [05]; creativecommons; 1
cc-by-sa; creativecommons org licenses by sa [1-4] [05]; creativecommons; 1
cc-by-nd; creativecommons org licenses by nd [1-4] [05]; creativecommons; 1
cc-by-nc; creativecommons org licenses by nc [1-4] [05]; creativecommons; 1
cc-by-nc-sa; creativecommons org licenses by nc sa [1-4] [05]; creativecommons; 1
cc-by-nc-nd; creativecommons org licenses by nc nd [1-4] [05]; creativecommons; 1
cc-by; cc by licen[cs]e; cc by; 0.8
creative-commons; creative commons licen[cs]e; creative commons; 0.6
creative-commons; some rights reserved; rights reserved; 0.6
ofl; this font software is licensed under the sil open font license; open font; 1
ofl; scripts sil org ofl; ofl; 0.9
wtfpl; you just do what the fuck you want to; fuck you want; 0.95
wtfpl; www wtfpl net; wtfpl; 0.95
python; psf is making python available to licensee on an as is basis; psf; 1
php; this product includes php software; php; 0.9
openssl; this product includes software developed by the openssl project; openssl; 1
proprietary; all rights reserved; rights reserved; 0.5
proprietary; proprietary and confidential; proprietary; 0.8
proprietary; unauthorized copying of this (?:file|work|document) via any medium is strictly prohibited; unauthorized copying; 0.9
proprietary; no part of this (?:publication|work|book) may be reproduced; may be reproduced; 0.9
proprietary; may not be (?:copied|reproduced|redistributed|distributed) without (?:prior )?(?:written )?permission; without; 0.8
proprietary; for internal use only; internal use; 0.6
non-commercial; for non ?commercial use only; use only; 0.8
non-commercial; not for commercial use; commercial use; 0.8
permissive; permission is granted to (?:copy|use|distribute)(?: and distribute)?; permission is; 0.5
permissive; free to use for any purpose; any purpose; 0.5
""".strip().splitlines()

# Sentence patterns around a license's name: pattern with {}, priority, score.
AROUND = (
    (r"(?:licensed|released|distributed|available|published|provided|covered|governed) under (?:the |an? )?(?:terms of |conditions of )?(?:the )?(?:{})", 40, 0.95),
    (r"(?:under|subject to|according to|pursuant to) the (?:terms of the |terms and conditions of the )?(?:{})", 35, 0.9),
    (r"(?:{})", 20, 0.8),
)


def _keyword(pattern: str) -> str:
    """The longest literal that every match of the pattern holds; the pattern has no top-level choice."""
    bare, before = pattern, None
    while bare != before:  # groups, innermost first
        before, bare = bare, re.sub(r"\((?:\?:)?[^()]*\)\??", "\n", bare)
    bare = re.sub(r"\[.*?\]\??|\\w\+|[^\n]\?", "\n", bare)
    return max((x.strip() for x in bare.split("\n")), key=len)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, in the order that settles ties."""
    out = [Rule(label, phrase, phrase, 100, 1.0, True) for phrase, label in PHRASES]
    for line in NAMES:
        label, names, spdx = (x.strip() for x in line.split(";"))
        for name in re.split(r"\|(?![^(]*\))", names):
            for around, priority, score in AROUND:
                out.append(Rule(label, around.format(name), _keyword(name), priority, score))
        out.append(Rule(label, rf"spdx license identifier (?:{spdx})(?: only| or later)?", "spdx license", 60, 1.0))
    for line in SENTENCES:
        label, pattern, keyword, score = (x.strip() for x in line.split(";"))
        out.append(Rule(label, pattern, keyword, 30 if float(score) < 1 else 50, float(score)))
    return tuple(out)


class Scanner:
    """The rules compiled, with the keyword automaton."""

    def __init__(self, chosen: tuple[Rule, ...]):
        self.rules = chosen
        self.compiled = [re.compile(rf"(?<![^ ])(?:{r.pattern})(?![^ ])") for r in chosen]
        of: dict[str, list[int]] = {}
        for k, rule in enumerate(chosen):
            of.setdefault(rule.keyword, []).append(k)
        self.finder = ahocorasick.Automaton()
        for word, numbers in of.items():
            self.finder.add_word(word, numbers)
        self.finder.make_automaton()

    def places(self, joined: str) -> tuple[list[tuple[int, int, Rule]], list[tuple[int, int, Rule]]]:
        """(every match of a base phrase, matches of all rules that none suppresses) as spans."""
        wanted: set[int] = set()
        for _, numbers in self.finder.iter(joined):
            wanted.update(numbers)
        base, found = [], []
        for k in sorted(wanted):
            rule = self.rules[k]
            for match in self.compiled[k].finditer(joined):
                found.append((match.start(), match.end(), k))
                if rule.base:
                    base.append((match.start(), match.end(), rule))
        return base, [(a, b, self.rules[k]) for a, b, k in self._settled(found)]

    def _settled(self, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Detections that lie inside none of better rank.

        Only detections that overlap can meet, so each run of overlapping ones is settled alone:
        best rank first, dropping what a kept one contains.
        """
        kept, run, reach = [], [], -1
        for one in [*sorted(found), None]:
            if one is None or one[0] >= reach:
                kept += self._best(run)
                run = []
            if one is not None:
                run.append(one)
                reach = max(reach, one[1])
        return kept

    def _best(self, run: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        kept: list[tuple[int, int, int]] = []
        for one in sorted(run, key=lambda x: (-self.rules[x[2]].priority, x[0] - x[1], x[2])):
            if not any(a <= one[0] and one[1] <= b for a, b, _ in kept):
                kept.append(one)
        return kept


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner(rules())


def scan_text(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score) of one text."""
    words = WORD.findall((text or "").translate(LOWER))
    joined = " ".join(words)
    base, found = scanner().places(joined)
    starts = [joined.count(" ", 0, a) for a in (min(b[0] for b in base), max(b[0] for b in base))] if base else [None, None]
    base_labels = {r.label for _, _, r in base}
    labels = base_labels | {r.label for _, _, r in found}
    score = max([1.0] * bool(base) + [r.score for _, _, r in found], default=0.0)
    return len(words), len(base), starts[0], starts[1], ",".join(sorted(base_labels)), ",".join(sorted(labels)), score


def scan(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``df``: the ``keep`` columns and what its text declares.

    Null and empty texts have no words, empty label lists and score 0.  The score is that of the
    surest rule that remains.
    """
    names = [*keep, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(scan_text(t) for t in batch.column(0).to_pylist()))) or [()] * 7
            made = [pa.array(c, k) for c, k in zip(rows, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], names)

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    own = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    chosen = [df[c] for c in keep]
    return df.select(df[text].alias("_text"), *chosen).mapInArrow(run, ", ".join([*fields, own]))
