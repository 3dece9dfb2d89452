"""License scans by ordered signature rules.

A rule is a regular expression over the text's words (lower case, joined by
single spaces) with a priority and the keywords that it can't match without.
A text's words gate the rules; the gated rules run in order of priority, and a
detection that lies within one already accepted is suppressed, by a search among
the accepted ones, so time grows with the text.  Places of the base phrases are
always kept.

Defined results: a null or empty text has no words, no labels and score 0;
repeated rows are scanned each; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import pick

#: Base phrases and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: The rules, one a line, written by hand.  Label, priority, keywords
#: (words that every match's text holds, all needed), expression over the words.
#: Earlier lines come first within a priority.
RULES = r"""
# SPDX tags
mit|95|spdx|spdx license identifier (?:mit|expat|x11)
mit-0|95|spdx|spdx license identifier mit 0
apache-2|95|spdx apache|spdx license identifier apache 2 0
apache-1.1|95|spdx apache|spdx license identifier apache 1 1
gpl-3|95|spdx gpl|spdx license identifier gpl 3 0(?: only| or later)?
gpl-2|95|spdx gpl|spdx license identifier gpl 2 0(?: only| or later)?
gpl-1|95|spdx gpl|spdx license identifier gpl 1 0(?: only| or later)?
lgpl-3|95|spdx lgpl|spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-2.1|95|spdx lgpl|spdx license identifier lgpl 2 [01](?: only| or later)?
agpl-3|95|spdx agpl|spdx license identifier agpl 3 0(?: only| or later)?
gfdl|95|spdx gfdl|spdx license identifier gfdl 1 [123](?: only| or later)?
bsd-2-clause|95|spdx bsd|spdx license identifier bsd 2 clause(?: patent| views)?
bsd-3-clause|95|spdx bsd|spdx license identifier bsd 3 clause(?: clear)?
bsd-4-clause|95|spdx bsd|spdx license identifier bsd 4 clause
0bsd|95|spdx 0bsd|spdx license identifier 0bsd
mpl-2|95|spdx mpl|spdx license identifier mpl 2 0
mpl-1.1|95|spdx mpl|spdx license identifier mpl 1 [01]
epl-2|95|spdx epl|spdx license identifier epl 2 0
epl-1|95|spdx epl|spdx license identifier epl 1 0
cddl|95|spdx cddl|spdx license identifier cddl 1 [01]
isc|95|spdx isc|spdx license identifier isc
zlib|95|spdx zlib|spdx license identifier zlib
boost-1|95|spdx bsl|spdx license identifier bsl 1 0
unlicense|95|spdx unlicense|spdx license identifier unlicense
wtfpl|95|spdx wtfpl|spdx license identifier wtfpl
artistic-2|95|spdx artistic|spdx license identifier artistic 2 0
python-2|95|spdx|spdx license identifier (?:python|psf) 2 0
postgresql|95|spdx postgresql|spdx license identifier postgresql
ofl-1.1|95|spdx ofl|spdx license identifier ofl 1 [01]
eupl-1.2|95|spdx eupl|spdx license identifier eupl 1 [012]
odbl|95|spdx odbl|spdx license identifier odbl 1 0
cc0|95|spdx cc0|spdx license identifier cc0 1 0
cc-by-nc-nd|95|spdx cc|spdx license identifier cc by nc nd \d 0
cc-by-nc-sa|95|spdx cc|spdx license identifier cc by nc sa \d 0
cc-by-nc|95|spdx cc|spdx license identifier cc by nc \d 0
cc-by-nd|95|spdx cc|spdx license identifier cc by nd \d 0
cc-by-sa|95|spdx cc|spdx license identifier cc by sa \d 0
cc-by|95|spdx cc|spdx license identifier cc by \d 0
# Sentences of the license texts themselves
mit|90|hereby granted charge|permission is hereby granted free of charge to any person obtaining a copy
mit|90|merge publish sublicense|to use copy modify merge publish distribute sublicense and or sell copies of the software
mit|90|portions permission notice|the above copyright notice and this permission notice shall be included in all copies or substantial portions
apache-2|90|apache compliance license|you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0
apache-2|90|apache license january|apache license version 2 0 january 2004
apache-2|90|perpetual irrevocable patent|a perpetual worldwide non exclusive no charge royalty free irrevocable except as stated in this section patent license
gpl-3|90|gnu general 29|gnu general public license version 3 29 june 2007
gpl-2|90|gnu general june|gnu general public license version 2 june 1991
gpl-3|90|redistribute gnu version|redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3
gpl-2|90|redistribute gnu version|redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2
gpl|90|redistribute gnu general|you can redistribute it and or modify it under the terms of the gnu general public license
lgpl-3|90|gnu lesser 29|gnu lesser general public license version 3 29 june 2007
lgpl-2.1|90|gnu lesser february|gnu lesser general public license version 2 1 february 1999
lgpl|90|redistribute gnu lesser|you can redistribute it and or modify it under the terms of the gnu lesser general public license
lgpl-2|90|gnu library june|gnu library general public license version 2 june 1991
agpl-3|90|gnu affero november|gnu affero general public license version 3 19 november 2007
agpl-3|90|redistribute gnu affero|you can redistribute it and or modify it under the terms of the gnu affero general public license
gfdl|90|permission gnu documentation|permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
bsd|90|redistribution source binary|redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause|90|neither endorse promote|neither the name of (?:\w+ ){1,12}may be used to endorse or promote products derived from this software
bsd-4-clause|90|advertising acknowledgement display|all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd-2-clause|90|retain conditions disclaimer|redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
isc|90|permission purpose fee|permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided
0bsd|90|permission purpose fee|permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?! provided)
zlib|90|event liable arising|in no event will the authors be held liable for any damages arising from the use of this software
zlib|90|altered misrepresented source|altered source versions must be plainly marked as such and must not be misrepresented
boost-1|90|boost august 2003|boost software license version 1 0 august 17th 2003
mpl-2|90|mozilla subject terms|this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1|90|mozilla subject contents|the contents of this file are subject to the mozilla public license version 1 1
epl-2|90|accompanying eclipse terms|this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0
epl-1|90|accompanying eclipse terms|this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
cddl|90|contents common development|the contents of this file are subject to the terms of the common development and distribution license
unlicense|90|unencumbered released domain|this is free and unencumbered software released into the public domain
wtfpl|90|fuck public want|do what the fuck you want to public license
artistic-2|90|artistic foundation copyright|the artistic license 2 0 copyright c 2000 2006 the perl foundation
ofl-1.1|90|font sil open|this font software is licensed under the sil open font license version 1 1
postgresql|90|written documentation fee|permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
ncsa|90|illinois open source|university of illinois ncsa open source license
json|90|software good evil|the software shall be used for good not evil
cc0|90|waived neighboring rights|has waived all copyright and related or neighboring rights to this work
cc-by|90|free share redistribute|you are free to share copy and redistribute the material in any medium or format
openssl|90|product openssl toolkit|this product includes software developed by the openssl project for use in the openssl toolkit
all-rights-reserved|90|copyright rights reserved|copyright (?:c )?(?:\d{4} )?(?:\w+ ){0,6}all rights reserved
public-domain|90|public domain|(?:dedicated|released|placed) (?:to|in|into) the public domain
# Grants
mit|80|licensed mit|licen[sc]ed under (?:the )?(?:terms of (?:the )?)?(?:mit|expat)(?: licen[sc]e)?
mit|80|released mit|released under (?:the )?(?:terms of (?:the )?)?mit licen[sc]e
mit|80|distributed mit|distributed under (?:the )?(?:terms of (?:the )?)?mit licen[sc]e
mit|80|available mit|(?:made )?available under (?:the )?(?:terms of (?:the )?)?mit licen[sc]e
mit|80|provided mit|provided under (?:the )?(?:terms of (?:the )?)?mit licen[sc]e
mit|80|subject mit|subject to the (?:terms of the )?mit licen[sc]e
mit|80|mit|under the terms of the mit licen[sc]e
apache-2|80|licensed apache|licen[sc]ed under (?:the )?(?:terms of (?:the )?)?apache(?: software)?(?: licen[sc]e)?(?: version| v)? ?2(?: 0)?(?: the license| license)?
apache-2|80|released apache|released under (?:the )?(?:terms of (?:the )?)?apache(?: licen[sc]e)?(?: version)? 2(?: 0)?
apache-2|80|distributed apache|distributed under (?:the )?(?:terms of (?:the )?)?apache(?: licen[sc]e)?(?: version)? 2(?: 0)?
apache-2|80|available apache|available under (?:the )?(?:terms of (?:the )?)?apache(?: licen[sc]e)?(?: version)? 2(?: 0)?
apache-2|80|apache|under the terms of the apache licen[sc]e version 2(?: 0)?
apache-1.1|80|licensed apache|licen[sc]ed under (?:the )?apache(?: software)? licen[sc]e version 1 1
gpl-3|80|licensed gpl|licen[sc]ed under (?:the )?(?:terms of (?:the )?)?(?:gnu )?gpl(?: version| v)? ?3(?: 0)?(?: or (?:any )?later)?
gpl-3|80|licensed gplv3|licen[sc]ed under (?:the )?(?:gnu )?gplv3(?: or later)?
gpl-3|80|licensed general|licen[sc]ed under (?:the )?(?:terms of (?:the )?)?gnu general public licen[sc]e(?: version| v)? ?3(?: 0)?
gpl-3|80|released gpl|released under (?:the )?(?:gnu )?gpl(?: version| v)? ?3(?: 0)?
gpl-3|80|distributed general|distributed under (?:the )?(?:terms of (?:the )?)?gnu general public licen[sc]e(?: version| v)? ?3(?: 0)?
gpl-2|80|licensed gpl|licen[sc]ed under (?:the )?(?:terms of (?:the )?)?(?:gnu )?gpl(?: version| v)? ?2(?: 0)?(?: or (?:any )?later)?
gpl-2|80|licensed gplv2|licen[sc]ed under (?:the )?(?:gnu )?gplv2(?: or later)?
gpl-2|80|licensed general|licen[sc]ed under (?:the )?(?:terms of (?:the )?)?gnu general public licen[sc]e(?: version| v)? ?2(?: 0)?
gpl-2|80|released gpl|released under (?:the )?(?:gnu )?gpl(?: version| v)? ?2(?: 0)?
gpl-2|80|distributed general|distributed under (?:the )?(?:terms of (?:the )?)?gnu general public licen[sc]e(?: version| v)? ?2(?: 0)?
gpl|70|licensed gpl|licen[sc]ed under (?:the )?(?:terms of (?:the )?)?(?:gnu )?gpl
gpl|70|licensed general|licen[sc]ed under (?:the )?(?:terms of (?:the )?)?gnu general public licen[sc]e
gpl|70|released gpl|released under (?:the )?(?:gnu )?gpl
lgpl-3|80|licensed lgpl|licen[sc]ed under (?:the )?(?:gnu )?lgpl(?: version| v)? ?3(?: 0)?
lgpl-3|80|licensed lgplv3|licen[sc]ed under (?:the )?lgplv3
lgpl-3|80|licensed lesser|licen[sc]ed under (?:the )?(?:terms of (?:the )?)?gnu lesser general public licen[sc]e(?: version| v)? ?3(?: 0)?
lgpl-2.1|80|licensed lgpl|licen[sc]ed under (?:the )?(?:gnu )?lgpl(?: version| v)? ?2(?: 1)?
lgpl-2.1|80|licensed lesser|licen[sc]ed under (?:the )?(?:terms of (?:the )?)?gnu lesser general public licen[sc]e(?: version| v)? ?2(?: 1)?
lgpl|70|licensed lgpl|licen[sc]ed under (?:the )?(?:gnu )?lgpl
lgpl|70|licensed lesser|licen[sc]ed under (?:the )?(?:terms of (?:the )?)?gnu lesser general public licen[sc]e
agpl-3|80|licensed agpl|licen[sc]ed under (?:the )?(?:gnu )?agpl(?:(?: version| v)? ?3(?: 0)?)?
agpl-3|80|licensed agplv3|licen[sc]ed under (?:the )?(?:gnu )?agplv3
agpl-3|80|licensed affero|licen[sc]ed under (?:the )?(?:terms of (?:the )?)?gnu affero general public licen[sc]e(?:(?: version| v)? ?3(?: 0)?)?
gfdl|80|gnu documentation|under (?:the )?(?:terms of (?:the )?)?gnu free documentation licen[sc]e
bsd-2-clause|80|licensed bsd|licen[sc]ed under (?:the |a )?(?:terms of (?:the )?)?(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[sc]e)?
bsd-3-clause|80|licensed bsd|licen[sc]ed under (?:the |a )?(?:terms of (?:the )?)?(?:new bsd|revised bsd|modified bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[sc]e)?
bsd|70|licensed bsd|licen[sc]ed under (?:the |a )?(?:terms of (?:the )?)?bsd(?: style)?(?: licen[sc]e)?
bsd|70|released bsd|released under (?:the |a )?(?:terms of (?:the )?)?bsd(?: style)? licen[sc]e
bsd|70|distributed bsd|distributed under (?:the |a )?(?:terms of (?:the )?)?bsd(?: style)? licen[sc]e
mpl-2|80|licensed mozilla|licen[sc]ed under (?:the )?(?:terms of (?:the )?)?mozilla public licen[sc]e(?: version| v)? ?2(?: 0)?
mpl-2|80|licensed mpl|licen[sc]ed under (?:the )?mpl(?: version| v)? ?2(?: 0)?
mpl-2|80|released mozilla|released under (?:the )?mozilla public licen[sc]e(?: version| v)? ?2(?: 0)?
mpl-1.1|80|licensed mozilla|licen[sc]ed under (?:the )?mozilla public licen[sc]e(?: version| v)? ?1 1
epl-2|80|licensed eclipse|licen[sc]ed under (?:the )?eclipse public licen[sc]e(?: version| v)? ?2(?: 0)?
epl-1|80|licensed eclipse|licen[sc]ed under (?:the )?eclipse public licen[sc]e(?: version| v)? ?1(?: 0)?
cddl|80|licensed cddl|licen[sc]ed under (?:the )?cddl(?: 1 [01])?
isc|80|licensed isc|licen[sc]ed under (?:the )?(?:terms of (?:the )?)?isc licen[sc]e
isc|80|released isc|released under (?:the )?isc licen[sc]e
zlib|80|licensed zlib|licen[sc]ed under (?:the )?zlib(?: libpng)?(?: licen[sc]e)?
boost-1|80|licensed boost|licen[sc]ed under (?:the )?boost(?: software)? licen[sc]e(?: version 1 0)?
boost-1|80|distributed boost|distributed under the boost software licen[sc]e version 1 0
unlicense|80|under unlicense|(?:released|licensed) under the unlicense
wtfpl|80|wtfpl|(?:released|licensed) under the wtfpl(?: licen[sc]e)?
artistic-2|80|licensed artistic|licen[sc]ed under (?:the )?(?:terms of (?:the )?)?artistic licen[sc]e(?: 2 0)?
perl-5|80|same terms perl|under the same terms as perl(?: 5| itself)?
python-2|80|licensed python|licen[sc]ed under (?:the )?python software foundation licen[sc]e(?: version 2)?
postgresql|80|under postgresql|(?:released|licensed) under (?:the )?postgresql licen[sc]e
ofl-1.1|80|licensed font|licen[sc]ed under (?:the )?(?:sil )?open font licen[sc]e(?: version)?(?: 1 1)?
eupl-1.2|80|licensed eupl|licen[sc]ed under (?:the )?eupl(?: version)?(?: 1 2)?
eupl-1.2|80|licensed european|licen[sc]ed under (?:the )?european union public licen[sc]e
odbl|80|available database|(?:made )?available under the open database licen[sc]e
odbl|80|licensed odbl|licen[sc]ed under (?:the )?odbl
cc0|80|under cc0|(?:released|licensed) under (?:the )?cc0(?: 1 0)?(?: licen[sc]e)?
cc0|80|creative zero|creative commons zero(?: v)?(?: 1 0)?(?: universal)?
cc-by-nc-nd|80|cc nc nd|(?:licen[sc]ed|released|published|available|distributed) under (?:a |the )?cc by nc nd(?: \d 0)?(?: licen[sc]e)?
cc-by-nc-sa|80|cc nc sa|(?:licen[sc]ed|released|published|available|distributed) under (?:a |the )?cc by nc sa(?: \d 0)?(?: licen[sc]e)?
cc-by-nc|80|cc nc|(?:licen[sc]ed|released|published|available|distributed) under (?:a |the )?cc by nc(?! (?:nd|sa))(?: \d 0)?(?: licen[sc]e)?
cc-by-nd|80|cc nd|(?:licen[sc]ed|released|published|available|distributed) under (?:a |the )?cc by nd(?: \d 0)?(?: licen[sc]e)?
cc-by-sa|80|cc sa|(?:licen[sc]ed|released|published|available|distributed) under (?:a |the )?cc by sa(?: \d 0)?(?: licen[sc]e)?
cc-by|80|cc|(?:licen[sc]ed|released|published|available|distributed) under (?:a |the )?cc by(?! (?:nc|nd|sa))(?: \d 0)?(?: licen[sc]e)?
cc-by-nc-nd|80|creative attribution commercial|creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: \d 0)?
cc-by-nc-sa|80|creative attribution commercial|creative commons attribution non ?commercial share ?alike(?: \d 0)?
cc-by-nc-nd|80|creative attribution noncommercial|creative commons attribution noncommercial no ?deriv(?:ative)?s(?: \d 0)?
cc-by-nc-sa|80|creative attribution noncommercial|creative commons attribution noncommercial share ?alike(?: \d 0)?
cc-by-nd|80|creative attribution|creative commons attribution no ?deriv(?:ative)?s(?: \d 0)?
cc-by-sa|80|creative attribution|creative commons attribution share ?alike(?: \d 0)?
cc-by-nc|75|creative attribution commercial|creative commons attribution non commercial(?: \d 0)?
cc-by-nc|75|creative attribution noncommercial|creative commons attribution noncommercial(?: \d 0)?
cc-by|70|creative attribution|creative commons attribution(?: \d 0)?(?: international)?(?: licen[sc]e)?
ms-pl|80|microsoft public|(?:released|licensed) under (?:the )?microsoft public licen[sc]e
proprietary|80|proprietary confidential|(?:this (?:software|document|file) is )?proprietary and confidential
# Names
mit|60|mit license|(?:the )?mit licen[sc]e
mit|60|mit licence|(?:the )?mit licence
mit|60|mit license|(?:the )?expat licen[sc]e
apache-2|60|apache license|(?:the )?apache(?: software)? licen[sc]e(?: version)? 2(?: 0)?
apache-2|60|apache|apache 2(?: 0)? licen[sc]e
gpl-3|60|gplv3|(?:gnu )?gplv3
gpl-2|60|gplv2|(?:gnu )?gplv2
gpl-3|60|gpl|(?:gnu )?gpl(?: version| v) ?3
gpl-2|60|gpl|(?:gnu )?gpl(?: version| v) ?2
lgpl-3|60|lgplv3|(?:gnu )?lgplv3
lgpl-2.1|60|lgplv2|(?:gnu )?lgplv2(?: 1)?
agpl-3|60|agplv3|(?:gnu )?agplv3
bsd-3-clause|60|bsd clause|(?:3 clause bsd|bsd 3 clause)(?: licen[sc]e)?
bsd-2-clause|60|bsd clause|(?:2 clause bsd|bsd 2 clause)(?: licen[sc]e)?
mpl-2|60|mozilla|mozilla public licen[sc]e(?: version)? 2(?: 0)?
isc|60|isc license|(?:the )?isc licen[sc]e
zlib|60|zlib license|(?:the )?zlib(?: libpng)? licen[sc]e
boost-1|60|boost license|(?:the )?boost software licen[sc]e
artistic-2|60|artistic license|(?:the )?artistic licen[sc]e 2 0
ofl-1.1|60|font license|(?:sil )?open font licen[sc]e
postgresql|60|postgresql license|(?:the )?postgresql licen[sc]e
cc0|60|cc0|cc0 1 0
cc-by-nc-nd|60|cc nc nd|cc by nc nd(?: \d 0)?
cc-by-nc-sa|60|cc nc sa|cc by nc sa(?: \d 0)?
cc-by-nc|60|cc nc|cc by nc(?! (?:nd|sa))(?: \d 0)?
cc-by-sa|60|cc sa|cc by sa(?: \d 0)?
cc-by-nd|60|cc nd|cc by nd(?: \d 0)?
cc-by|50|cc 4|cc by 4 0
gpl|40|gnu general|(?:the )?gnu general public licen[sc]e
gpl|40|gnu gpl|gnu gpl
lgpl|40|gnu lesser|(?:the )?gnu lesser general public licen[sc]e
agpl-3|40|gnu affero|(?:the )?gnu affero general public licen[sc]e
gfdl|40|gnu documentation|gnu free documentation licen[sc]e
mpl|40|mozilla public|mozilla public licen[sc]e
epl|40|eclipse public|eclipse public licen[sc]e
cddl|40|common development|common development and distribution licen[sc]e
bsd|40|bsd license|(?:the )?bsd(?: style)? licen[sc]e
apache|30|apache license|(?:the )?apache licen[sc]e
creative-commons|30|creative commons|creative commons licen[sc]e
"""
#: How sure a detection is, by the least priority.
CONFIDENCE = ((95, 1.0), (90, 0.95), (80, 0.95), (70, 0.9), (60, 0.8), (0, 0.6))


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keywords: frozenset
    expression: re.Pattern

    @property
    def confidence(self) -> float:
        return next(c for p, c in CONFIDENCE if self.priority >= p)


@functools.lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, highest priority first.  Expressions start with the blank
    before a match, so that those with a plain beginning are searched for it."""
    out = []
    for line in RULES.split("\n"):
        if line and not line.startswith("#"):
            label, priority, keywords, expression = line.split("|", 3)
            out.append(Rule(label, int(priority), frozenset(w.encode() for w in keywords.split()),
                            re.compile(rf" (?:{expression})(?= )".encode())))
    return tuple(sorted(out, key=lambda r: -r.priority))


@functools.lru_cache(maxsize=1)
def keywords() -> frozenset:
    """Keywords, with the other spelling of those that have two."""
    return frozenset().union(*(r.keywords for r in rules())) | SPELLINGS.keys()


#: Spellings that a keyword stands for as well.
SPELLINGS = {b"licenced": b"licensed", b"licence": b"license", b"gpl2": b"gpl", b"gpl3": b"gpl", b"lgpl2": b"lgpl", b"lgpl3": b"lgpl",
             b"agpl3": b"agpl", b"mpl2": b"mpl", b"apache2": b"apache", b"expat": b"mit", b"freebsd": b"bsd", b"noncommercial": b"commercial"}


class Accepted:
    """Accepted spans in order of their start, with the running largest end: a
    span lies in one of them if the largest end among those that start no later
    reaches its own."""

    def __init__(self):
        self.start = np.zeros(0, dtype=np.int64)
        self.end = np.zeros(0, dtype=np.int64)
        self.reach = self.end

    def add(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Take the spans (ascending, disjoint) that lie in none; which they are."""
        at = np.searchsorted(self.start, start, side="right") - 1
        new = np.ones(len(start), dtype=bool)
        if len(self.start):
            new = (at < 0) | (self.reach[np.maximum(at, 0)] < end)
        if new.any():
            place = np.searchsorted(self.start, start[new], side="right")
            self.start = np.insert(self.start, place, start[new])
            self.end = np.insert(self.end, place, end[new])
            self.reach = np.maximum.accumulate(self.end)
        return new


_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def scan(text: str | None) -> dict:
    """Detections of one text."""
    ws = (text or "").encode().translate(_TO_WORDS).split()
    line = b" ".join(ws)
    padded = b" " + line + b" "
    base, accepted = [], []
    for phrase, label in BASE:
        sought, at = b" " + phrase.encode() + b" ", -1
        while (at := padded.find(sought, at + 1)) >= 0:
            base.append((at, at + len(phrase), label))
    found = keywords().intersection(ws)
    gate = found | {SPELLINGS[w] for w in found if w in SPELLINGS}
    if gate:
        spans = Accepted()
        for r in rules():
            if r.keywords <= gate:
                got = [m.span() for m in r.expression.finditer(padded)]
                if got:
                    # the blank before a match is not part of it
                    a, b = np.array(got, dtype=np.int64).T - [[0], [1]]
                    new = spans.add(a, b)
                    accepted += [(int(x), int(y), r) for x, y in zip(a[new], b[new])]
    blanks = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)
    word = lambda at: int(np.searchsorted(blanks, at))                                # noqa: E731
    starts = [word(a) for a, _, _ in base]
    names = {label for _, _, label in base}
    return {
        "n_words": len(ws), "n_base": len(base), "first_word": min(starts, default=None),
        "last_word": max(starts, default=None), "base_labels": ",".join(sorted(names)),
        "labels": ",".join(sorted(names | {r.label for _, _, r in accepted})),
        "score": 1.0 if base else max((r.confidence for _, _, r in accepted), default=0.0),
        "spans": ",".join(f"{r.label}:{word(a)}:{word(b) + 1}"
                          for a, b, r in sorted(accepted, key=lambda x: x[:2])),
    }


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, spans string")


def _scan_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    fields = [c.split() for c in SCHEMA.split(", ")]
    for batch in batches:
        got = [scan(t.as_py()) for t in batch.column("text")]
        cols = [batch.column("doc_id") if n == "doc_id" else pa.array([g[n] for g in got], kinds[k]) for n, k in fields]
        yield pa.RecordBatch.from_arrays(cols, names=[n for n, _ in fields])


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, spans (label:first word:end word of the rules' detections)."""
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(_scan_task, SCHEMA)
