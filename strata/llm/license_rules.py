"""Signature rules of the license scan (operator 6).

A rule is an order number, a label, a regular expression over normalised words
(lower-cased, one space between words) and a keyword that any match holds. The
base phrases come first. Then each license has signatures of its own, and its
names fill the frames below (a frame says how a license is referred to). Lower
order wins where detections overlap; ``weight`` is the confidence.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from strata.llm.license_texts import SENTENCES


class Rule(NamedTuple):
    order: int
    label: str
    pattern: str
    keyword: str
    weight: float
    base: bool


#: Phrases that are reported wherever their words stand consecutively.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

#: label, names (regexes over words), SPDX identifier as words.
NAMED = (
    ("mit", ("mit", "expat", "mit expat"), "mit"),
    ("apache-2", (r"apache 2(?: 0)?", r"apache software license 2(?: 0)?", r"asl 2(?: 0)?"), "apache 2 0"),
    ("apache-1.1", (r"apache (?:software )?license version 1 1", "apache 1 1"), "apache 1 1"),
    ("bsd-2-clause", (r"bsd 2 clause", r"simplified bsd", r"freebsd"), "bsd 2 clause"),
    ("bsd-3-clause", (r"bsd 3 clause", r"(?:new|modified|revised) bsd"), "bsd 3 clause"),
    ("bsd-4-clause", (r"bsd 4 clause", r"original bsd"), "bsd 4 clause"),
    ("0bsd", (r"zero clause bsd", "0bsd"), "0bsd"),
    ("gpl-2", (r"gpl ?v?2(?: 0)?", r"gnu (?:general public license|gpl) (?:version |v )?2(?: 0)?"), "gpl 2 0"),
    ("gpl-3", (r"gpl ?v?3(?: 0)?", r"gnu (?:general public license|gpl) (?:version |v )?3(?: 0)?"), "gpl 3 0"),
    ("lgpl-2.1", (r"lgpl ?v?2 1", r"gnu (?:lesser|library) general public license (?:version |v )?2 1"), "lgpl 2 1"),
    ("lgpl-3", (r"lgpl ?v?3(?: 0)?", r"gnu lesser general public license (?:version |v )?3(?: 0)?"), "lgpl 3 0"),
    ("agpl-3", (r"agpl ?v?3(?: 0)?", r"gnu affero general public license (?:version |v )?3(?: 0)?"), "agpl 3 0"),
    ("mpl-1.1", (r"mozilla public license (?:version |v )?1 1", r"mpl ?v?1 1"), "mpl 1 1"),
    ("mpl-2", (r"mozilla public license (?:version |v )?2(?: 0)?", r"mpl ?v?2(?: 0)?"), "mpl 2 0"),
    ("epl-1", (r"eclipse public license (?:version |v )?1(?: 0)?", r"epl ?v?1(?: 0)?"), "epl 1 0"),
    ("epl-2", (r"eclipse public license (?:version |v )?2(?: 0)?", r"epl ?v?2(?: 0)?"), "epl 2 0"),
    ("cddl-1", (r"common development and distribution license", r"cddl ?v?1(?: 0)?"), "cddl 1 0"),
    ("cpl-1", (r"common public license (?:version |v )?1(?: 0)?",), "cpl 1 0"),
    ("eupl-1.2", (r"european union public licen[cs]e", r"eupl ?v?1 2"), "eupl 1 2"),
    ("isc", (r"isc",), "isc"),
    ("zlib", (r"zlib(?: libpng)?",), "zlib"),
    ("boost-1", (r"boost software license", r"boost software"), "bsl 1 0"),
    ("artistic-2", (r"artistic license (?:version |v )?2(?: 0)?", r"artistic 2(?: 0)?"), "artistic 2 0"),
    ("unlicense", (r"the unlicense",), "unlicense"),
    ("wtfpl", (r"wtfpl", r"do what the fuck you want to public"), "wtfpl"),
    ("ms-pl", (r"microsoft public", r"ms pl"), "ms pl"),
    ("ofl-1.1", (r"sil open font", r"open font license (?:version |v )?1 1"), "ofl 1 1"),
    ("postgresql", (r"postgresql",), "postgresql"),
    ("psf-2", (r"python software foundation", r"psf"), "python 2 0"),
    ("php-3", (r"php license (?:version |v )?3(?: 01)?",), "php 3 01"),
    ("openssl", (r"openssl",), "openssl"),
    ("odbl-1", (r"open database license", r"odbl"), "odbl 1 0"),
    ("pddl-1", (r"public domain dedication and license", r"pddl"), "pddl 1 0"),
    ("upl-1", (r"universal permissive",), "upl 1 0"),
    ("afl-3", (r"academic free license (?:version |v )?3(?: 0)?",), "afl 3 0"),
    ("osl-3", (r"open software license (?:version |v )?3(?: 0)?",), "osl 3 0"),
    ("ncsa", (r"university of illinois ncsa(?: open source)?",), "ncsa"),
    ("elastic-2", (r"elastic license (?:version |v )?2(?: 0)?",), "elastic 2 0"),
    ("bsl-1.1", (r"business source license (?:version |v )?1 1",), "busl 1 1"),
    ("sspl-1", (r"server side public license",), "sspl 1 0"),
    ("cc0-1", (r"cc0(?: 1 0)?", r"creative commons zero"), "cc0 1 0"),
    ("cc-by", (r"creative commons attribution(?: [234] 0| international)?",), "cc by 4 0"),
    ("cc-by-sa", (r"creative commons attribution share ?alike", r"cc by sa"), "cc by sa 4 0"),
    ("cc-by-nd", (r"creative commons attribution no ?deriv(?:ative)?s", r"cc by nd"), "cc by nd 4 0"),
    ("cc-by-nc", (r"creative commons attribution non ?commercial",), "cc by nc 4 0"),
    ("cc-by-nc-sa", (r"creative commons attribution non ?commercial share ?alike", r"cc by nc sa"), "cc by nc sa 4 0"),
    ("cc-by-nc-nd", (r"creative commons attribution non ?commercial no ?deriv(?:ative)?s", r"cc by nc nd"), "cc by nc nd 4 0"),
)

#: How a text refers to a license: frame with {name}, weight.
FRAMES = (
    (r"(?:released|distributed|licensed|available|published) under (?:the )?(?:terms of (?:the )?)?{name}(?: licen[cs]e)?", 1.0),
    (r"under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{name} licen[cs]e", 0.95),
    (r"licen[cs]ed?(?: is| as)? (?:the )?{name}(?: licen[cs]e)?", 0.8),
    (r"{name} licen[cs]e(?:d|s)?", 0.8),
)
SPDX_FRAME = (r"spdx license identifier {name}(?: or later| only)?", 1.0)

#: Sentences of license texts: label, pattern, keyword, weight.
TEXTS = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby", 1.0),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies", "permission", 0.9),
    ("apache-2", r"you may not use this file except in compliance with the license", "compliance", 0.9),
    ("apache-2", r"apache org licenses license 2 0", "apache", 1.0),
    ("bsd-3-clause", r"neither the name of .{1,80}? nor the names of its contributors may be used", "neither", 0.95),
    ("bsd-2-clause", r"redistribution and use in source and binary forms with or without modification", "redistribution", 0.8),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display", "advertising", 0.95),
    ("gpl", r"gnu general public license", "gnu", 0.8),
    ("lgpl", r"gnu (?:lesser|library) general public license", "gnu", 0.8),
    ("agpl", r"gnu affero general public license", "affero", 0.8),
    ("gpl", r"you can redistribute it and or modify it under the terms of the gnu general public license", "gnu", 0.9),
    ("mpl-2", r"this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla", 1.0),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee", "permission", 0.9),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors", "implied", 0.8),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered", 1.0),
    ("wtfpl", r"you just do what the fuck you want to", "fuck", 1.0),
    ("cc0-1", r"creativecommons org publicdomain zero 1 0", "creativecommons", 1.0),
    ("cc-by", r"creativecommons org licenses by [1234]", "creativecommons", 1.0),
    ("cc-by-sa", r"creativecommons org licenses by sa", "creativecommons", 1.0),
    ("cc-by-nd", r"creativecommons org licenses by nd", "creativecommons", 1.0),
    ("cc-by-nc", r"creativecommons org licenses by nc [1234]", "creativecommons", 1.0),
    ("cc-by-nc-sa", r"creativecommons org licenses by nc sa", "creativecommons", 1.0),
    ("cc-by-nc-nd", r"creativecommons org licenses by nc nd", "creativecommons", 1.0),
    ("proprietary", r"proprietary and confidential", "proprietary", 0.8),
    ("proprietary", r"unauthori[sz]ed copying of this (?:file|document|text)", "copying", 0.8),
)


def literal(pattern: str) -> str:
    """The longest run of plain characters that every match of ``pattern`` holds."""
    gap = "\0"
    while (shorter := re.sub(r"\(\?:[^()]*\)\??", gap, pattern)) != pattern:
        pattern = shorter
    pattern = re.sub(r"\.\{\d+,\d+\}\??", gap, pattern)
    return max(re.sub(r"\[[^\]]*\]\??|.\?|\\.", gap, pattern).split(gap), key=len).strip()


def rules() -> tuple[Rule, ...]:
    """All rules in order: base phrases, license texts, identifiers, then each
    frame over all names (longer names first, so the narrower license wins)."""
    made: list[Rule] = []

    def add(label: str, pattern: str, keyword: str, weight: float, base: bool = False) -> None:
        made.append(Rule(len(made), label, pattern, keyword, weight, base))

    for label, phrase in BASE:
        add(label, phrase, phrase, 1.0, True)
    for label, pattern, keyword, weight in TEXTS:
        add(label, pattern, keyword, weight)
    for label, weight, sentence in SENTENCES:
        add(label, sentence, literal(sentence), weight)
    for label, _, spdx in sorted(NAMED, key=lambda x: -len(x[2])):
        add(label, SPDX_FRAME[0].format(name=re.escape(spdx).replace(r"\ ", " ")), "spdx",
            SPDX_FRAME[1])
    for frame, weight in FRAMES:
        for label, name in sorted(((a, n) for a, names, _ in NAMED for n in names),
                                  key=lambda x: -len(x[1])):
            add(label, frame.format(name=f"(?:{name})"), literal(name), weight)
    return tuple(made)
