r"""Signature rules for licence scans.

A rule is (id, label, priority, keyword, regex, confidence). Regexes run over
normalised text: words in lower case, one space between them (so "CC BY-NC 4.0" reads
"cc by nc 4 0"). Every regex keeps to bounded repeats, which bounds a match's length
by MAX_MATCH_CHARS; the scanner relies on that when it looks for what suppresses a match.
The rules are ordered: a smaller priority is the stronger statement. Families give a
label, keywords of which any match holds one (split by |; a leading space is a word's start, "&licen"
behind a keyword says that a match which holds it also holds that), the regex of the name as people write it,
and the identifier in SPDX spelling (normalised); forms wrap a name into statements.
"""

from __future__ import annotations

import re
from typing import NamedTuple

MAX_MATCH_CHARS = 400


class Rule(NamedTuple):
    id: str
    label: str
    priority: int
    keyword: str
    regex: str
    confidence: float


#: The phrases whose places are counted, with their labels, in priority 0: they are never suppressed.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

_V = r"(?:v|version|ver)? ?"

#: label, keyword, name, SPDX identifier
FAMILIES = (
    ("mit", "mit&licen|expat&licen|x11&licen", r"(?:mit|expat|x11)(?: style)?(?: open source)? licen[cs]e", r"mit"),
    ("mit-0", "mit", r"mit no attribution(?: licen[cs]e)?", r"mit 0"),
    ("apache-1", "apache&licen", r"apache(?: software)? licen[cs]e " + _V + r"1(?: [01])?", r"apache 1 [01]"),
    ("apache-2", "apache", r"apache(?: software)?(?: licen[cs]e)? " + _V + r"2(?: 0)?", r"apache 2 0"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[cs]e)?", r"bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|revised bsd|modified bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[cs]e)?", r"bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd)(?: licen[cs]e)?", r"bsd 4 clause"),
    ("0bsd", "bsd", r"(?:zero clause bsd|bsd zero clause|0bsd)(?: licen[cs]e)?", r"0bsd"),
    ("bsd", "bsd&licen", r"bsd(?: style)? licen[cs]e", r"bsd"),
    ("gpl-1", "gpl|general public", r"(?:gnu )?(?:gpl|general public licen[cs]e) " + _V + r"1(?: 0)?", r"gpl 1 0(?: only| or later)?"),
    ("gpl-2", "gpl|general public", r"(?:gnu )?(?:gpl|general public licen[cs]e) ?" + _V + r"2(?: 0)?", r"gpl 2 0(?: only| or later)?"),
    ("gpl-3", "gpl|general public", r"(?:gnu )?(?:gpl|general public licen[cs]e) ?" + _V + r"3(?: 0)?", r"gpl 3 0(?: only| or later)?"),
    ("gpl", "gnu", r"gnu (?:gpl|general public licen[cs]e)", r"gpl"),
    ("lgpl-2", "lgpl|general public", r"(?:gnu )?(?:lgpl|library general public licen[cs]e) ?" + _V + r"2(?: 0)?", r"lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", "lgpl|general public", r"(?:gnu )?(?:lgpl|lesser general public licen[cs]e) ?" + _V + r"2 1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-3", "lgpl|general public", r"(?:gnu )?(?:lgpl|lesser general public licen[cs]e) ?" + _V + r"3(?: 0)?", r"lgpl 3 0(?: only| or later)?"),
    ("lgpl", "lgpl|general public", r"(?:gnu )?(?:lgpl|lesser general public licen[cs]e)", r"lgpl"),
    ("agpl-3", "agpl|affero", r"(?:gnu )?(?:agpl|affero general public licen[cs]e) ?" + _V + r"3(?: 0)?", r"agpl 3 0(?: only| or later)?"),
    ("agpl", "agpl|affero", r"(?:gnu )?(?:agpl|affero general public licen[cs]e)", r"agpl"),
    ("gfdl-1.2", "free documentation&licen", r"(?:gnu )?free documentation licen[cs]e " + _V + r"1 2", r"gfdl 1 2(?: only| or later)?"),
    ("gfdl-1.3", "free documentation&licen", r"(?:gnu )?free documentation licen[cs]e " + _V + r"1 3", r"gfdl 1 3(?: only| or later)?"),
    ("gfdl", "free documentation&licen", r"(?:gnu )?free documentation licen[cs]e", r"gfdl"),
    ("mpl-1.1", " mpl|mozilla&licen", r"(?:mozilla public licen[cs]e|mpl) ?" + _V + r"1 1", r"mpl 1 1"),
    ("mpl-2", " mpl|mozilla&licen", r"(?:mozilla public licen[cs]e|mpl) ?" + _V + r"2(?: 0)?", r"mpl 2 0"),
    ("mpl", "mozilla&licen", r"mozilla public licen[cs]e", r"mpl"),
    ("epl-1", " epl|eclipse&licen", r"(?:eclipse public licen[cs]e|epl) ?" + _V + r"1(?: 0)?", r"epl 1 0"),
    ("epl-2", " epl|eclipse&licen", r"(?:eclipse public licen[cs]e|epl) ?" + _V + r"2(?: 0)?", r"epl 2 0"),
    ("cddl-1", "cddl|common development&licen", r"(?:common development and distribution licen[cs]e|cddl)(?: " + _V + r"1 [01])?", r"cddl 1 [01]"),
    ("cpl-1", "common public&licen", r"common public licen[cs]e(?: " + _V + r"1 0)?", r"cpl 1 0"),
    ("eupl-1.2", "eupl|european union&licen", r"(?:european union public licen[cs]e|eupl)(?: " + _V + r"1 [12])?", r"eupl 1 [12]"),
    ("artistic-1", "artistic&licen", r"artistic licen[cs]e " + _V + r"1(?: 0)?", r"artistic 1 0"),
    ("artistic-2", "artistic&licen", r"artistic licen[cs]e " + _V + r"2(?: 0)?", r"artistic 2 0"),
    ("isc", "isc&licen", r"isc licen[cs]e", r"isc"),
    ("zlib", "zlib&licen", r"zlib(?: libpng)? licen[cs]e", r"zlib"),
    ("libpng", "libpng&licen", r"libpng licen[cs]e(?: " + _V + r"2)?", r"libpng(?: 2 0)?"),
    ("boost-1", " bsl|boost&licen", r"(?:boost software licen[cs]e|bsl)(?: " + _V + r"1 0)?", r"bsl 1 0"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", r"unlicense"),
    ("wtfpl", "wtfpl|want to public&licen", r"(?:do what the f[uc*]{1,3}k you want to public licen[cs]e|wtfpl)", r"wtfpl"),
    ("python-2", "python&licen", r"python(?: software foundation)? licen[cs]e(?: " + _V + r"2)?", r"(?:python|psf) 2 0"),
    ("php-3", "php&licen", r"php licen[cs]e(?: " + _V + r"3(?: 01)?)?", r"php 3 01"),
    ("ruby", "ruby&licen", r"ruby licen[cs]e", r"ruby"),
    ("openssl", "openssl&licen", r"openssl licen[cs]e", r"openssl"),
    ("postgresql", "postgresql&licen", r"postgresql licen[cs]e", r"postgresql"),
    ("ofl-1.1", "open font&licen", r"(?:sil )?open font licen[cs]e(?: " + _V + r"1 1)?", r"ofl 1 1"),
    ("ms-pl", "microsoft&licen", r"microsoft public licen[cs]e", r"ms pl"),
    ("ms-rl", "microsoft&licen", r"microsoft reciprocal licen[cs]e", r"ms rl"),
    ("osl-3", "open software&licen", r"open software licen[cs]e(?: " + _V + r"3(?: 0)?)?", r"osl 3 0"),
    ("afl-3", "academic&licen", r"academic free licen[cs]e(?: " + _V + r"3(?: 0)?)?", r"afl 3 0"),
    ("odbl-1", "database|odbl", r"(?:open (?:data commons open )?database licen[cs]e|odbl)(?: " + _V + r"1 0)?", r"odbl 1 0"),
    ("odc-by-1", "data commons&licen", r"open data commons attribution licen[cs]e(?: " + _V + r"1 0)?", r"odc by 1 0"),
    ("pddl-1", "dedication&licen", r"(?:open data commons )?public domain dedication and licen[cs]e", r"pddl 1 0"),
    ("cc0", "cc0|cc zero|commons zero", r"(?:cc0|cc zero|creative commons zero)(?: " + _V + r"1(?: 0)?)?(?: universal)?", r"cc0 1 0"),
    ("cc-by", "cc by|creative commons", r"(?:cc by|creative commons attribution)(?: licen[cs]e)?(?: [1-4] [05])?(?: international)?", r"cc by [1-4] [05]"),
    ("cc-by-sa", "cc by|creative commons", r"(?:cc by sa|creative commons attribution share ?alike)(?: licen[cs]e)?(?: [1-4] [05])?", r"cc by sa [1-4] [05]"),
    ("cc-by-nd", "cc by|creative commons", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?)(?: licen[cs]e)?(?: [1-4] [05])?", r"cc by nd [1-4] [05]"),
    ("cc-by-nc", "cc by|creative commons", r"(?:cc by nc|creative commons attribution non ?commercial)(?: licen[cs]e)?(?: [1-4] [05])?", r"cc by nc [1-4] [05]"),
    ("cc-by-nc-sa", "cc by|creative commons", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: licen[cs]e)?(?: [1-4] [05])?", r"cc by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "cc by|creative commons", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?)(?: licen[cs]e)?(?: [1-4] [05])?", r"cc by nc nd [1-4] [05]"),
    ("public-domain", "public domain", r"public domain", r"(?:licenseref )?public domain"),
    ("busl-1.1", "business source&licen", r"business source licen[cs]e(?: " + _V + r"1 1)?", r"busl 1 1"),
    ("sspl-1", "sspl|server side&licen", r"(?:server side public licen[cs]e|sspl)(?: " + _V + r"1)?", r"sspl 1 0"),
    ("elastic-2", "elastic&licen", r"elastic licen[cs]e(?: " + _V + r"2(?: 0)?)?", r"elastic 2 0"),
    ("commons-clause", "commons clause", r"commons clause", r"licenseref commons clause"),
    ("openrail-m", "openrail", r"(?:creativeml |bigscience |bigcode )?openrail(?: m)?(?: licen[cs]e)?", r"openrail(?: m)?"),
    ("upl-1", "universal permissive&licen", r"universal permissive licen[cs]e(?: " + _V + r"1 0)?", r"upl 1 0"),
    ("ncsa", "ncsa&licen", r"(?:university of illinois )?ncsa open source licen[cs]e", r"ncsa"),
    ("json", "json&licen", r"json licen[cs]e", r"json"),
    ("vim", "vim&licen", r"vim licen[cs]e", r"vim"),
    ("curl", "curl&licen", r"curl licen[cs]e", r"curl"),
    ("blueoak-1", "blue oak&licen", r"blue oak model licen[cs]e(?: 1 0 0)?", r"blueoak 1 0 0"),
    ("proprietary", "proprietary&licen", r"proprietary(?: and confidential| software)? licen[cs]e", r"licenseref proprietary"),
)

#: What one family says in four strengths: an identifier line, a grant, a pointer, a bare name.
_GRANT = r"(?:dual |re|sub)?(?:licen[cs]ed|released|distributed|available|published|provided|covered|redistributed|made available) (?:under|according to|subject to) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?"
_POINTER = r"(?:see|read|refer to|consult|as stated in|governed by|obtain a copy of|accept) (?:the )?(?:full )?(?:text of (?:the )?)?"

#: Statements that belong to no family: label, priority, keyword, regex, confidence.
OTHER = (
    ("all-rights-reserved", 4, "rights reserved", r"all rights reserved", 0.9),
    ("all-rights-reserved", 4, "rights reserved", r"no rights reserved except", 0.5),
    ("copyright-notice", 6, "copyright", r"copyright (?:c |© )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?", 0.6),
    ("copyright-notice", 6, "copyright", r"(?:c )?copyright (?:by|of) [a-z0-9]{1,40}", 0.4),
    ("proprietary", 4, "confidential", r"proprietary and confidential", 0.8),
    ("proprietary", 4, "permission", r"without (?:the )?(?:prior )?(?:express )?written permission", 0.7),
    ("proprietary", 4, "unauthori", r"unauthori[sz]ed (?:copying|use|reproduction|distribution)", 0.7),
    ("mit", 3, "permission", r"permission is hereby granted free of charge to any person obtaining a copy", 0.95),
    ("mit", 3, "permission notice", r"the above copyright notice and this permission notice shall be included", 0.9),
    ("bsd", 3, "redistribution", r"redistribution and use in source and binary forms with or without modification", 0.9),
    ("bsd-3-clause", 3, "endorse", r"used to endorse or promote products derived from this software", 0.85),
    ("isc", 3, "permission", r"permission to use copy modify and or distribute this software for any purpose", 0.95),
    ("zlib", 3, "as is", r"this software is provided as is without any express or implied warranty in no event", 0.85),
    ("boost-1", 3, "permission", r"permission is hereby granted free of charge to any person or organization", 0.95),
    ("gpl", 3, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e", 0.9),
    ("gpl-2", 2, "version 2", r"gnu general public licen[cs]e as published by the free software foundation either version 2", 0.95),
    ("gpl-3", 2, "version 3", r"gnu general public licen[cs]e as published by the free software foundation either version 3", 0.95),
    ("lgpl", 3, "lesser", r"modify it under the terms of the gnu lesser general public licen[cs]e", 0.9),
    ("agpl", 3, "affero", r"modify it under the terms of the gnu affero general public licen[cs]e", 0.9),
    ("mpl-2", 3, "mozilla", r"subject to the terms of the mozilla public licen[cs]e v 2 0", 0.95),
    ("apache-2", 3, "apache", r"http ?s? (?:www )?apache org licen[cs]es licen[cs]e 2 0", 0.95),
    ("unlicense", 3, "unencumbered", r"free and unencumbered software released into the public domain", 0.95),
    ("cc0", 3, "creativecommons", r"creativecommons org publicdomain zero 1 0", 0.95),
    ("cc-by", 3, "creativecommons", r"creativecommons org licen[cs]es by [1-4] [05]", 0.95),
    ("cc-by-sa", 3, "creativecommons", r"creativecommons org licen[cs]es by sa [1-4] [05]", 0.95),
    ("cc-by-nc", 3, "creativecommons", r"creativecommons org licen[cs]es by nc [1-4] [05]", 0.95),
    ("cc-by-nd", 3, "creativecommons", r"creativecommons org licen[cs]es by nd [1-4] [05]", 0.95),
    ("cc-by-nc-sa", 3, "creativecommons", r"creativecommons org licen[cs]es by nc sa [1-4] [05]", 0.95),
    ("cc-by-nc-nd", 3, "creativecommons", r"creativecommons org licen[cs]es by nc nd [1-4] [05]", 0.95),
    ("warranty-disclaimer", 6, "warrant", r"without warrant(?:y|ies) of any kind", 0.3),
    ("gpl", 3, "redistribute", r"this (?:program|library|file|software) is free software you can redistribute it", 0.8),
    ("gpl", 4, "hope that", r"distributed in the hope that it will be useful but without any warranty", 0.6),
    ("gpl", 3, "general public", r"you should have received a copy of the gnu general public licen[cs]e", 0.9),
    ("gpl", 3, "general public", r"see the gnu general public licen[cs]e for more details", 0.85),
    ("lgpl", 3, "general public", r"you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e", 0.9),
    ("lgpl", 3, "general public", r"see the gnu (?:lesser|library) general public licen[cs]e for more details", 0.85),
    ("agpl", 3, "affero", r"you should have received a copy of the gnu affero general public licen[cs]e", 0.9),
    ("agpl", 3, "affero", r"see the gnu affero general public licen[cs]e for more details", 0.85),
    ("gfdl", 3, "documentation", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e", 0.95),
    ("gfdl", 3, "invariant", r"with no invariant sections(?: no| with no) front cover texts and no back cover texts", 0.85),
    ("copyleft-later", 6, "later version", r"or at your option any later version", 0.4),
    ("apache-2", 3, "in compliance", r"you may not use this file except in compliance with the licen[cs]e", 0.9),
    ("apache-2", 3, "applicable law", r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e", 0.9),
    ("apache-2", 3, "governing", r"see the licen[cs]e for the specific language governing permissions and limitations", 0.9),
    ("apache-2", 3, "contributor", r"licensed to the apache software foundation asf under one or more contributor licen[cs]e agreements", 0.95),
    ("mit", 3, "publish", r"to use copy modify merge publish distribute sublicen[cs]e and or sell copies of the software", 0.95),
    ("mit", 4, "authors", r"in no event shall the authors or copyright holders be liable for any claim", 0.6),
    ("mit-0", 3, "hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", 0.6),
    ("bsd", 3, "redistribution", r"redistributions of source code must retain the above copyright notice", 0.9),
    ("bsd", 3, "redistribution", r"redistributions in binary form must reproduce the above copyright notice", 0.9),
    ("bsd", 4, "as is", r"this software is provided by the (?:copyright holders|author|authors|regents)(?: and contributors)? as is", 0.7),
    ("bsd-3-clause", 3, "neither the name", r"neither the name of (?:the )?(?:[a-z0-9]{1,40} ){1,6}nor the names of its contributors", 0.9),
    ("bsd-4-clause", 3, "advertising", r"all advertising materials mentioning features or use of this software must display", 0.95),
    ("0bsd", 3, "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 0.7),
    ("isc", 3, "appear in all", r"provided that the above copyright notice and this permission notice appear in all copies", 0.9),
    ("zlib", 3, "misrepresented", r"the origin of this software must not be misrepresented", 0.9),
    ("zlib", 3, "plainly marked", r"altered source versions must be plainly marked as such", 0.9),
    ("zlib", 3, "removed or altered", r"this notice may not be removed or altered from any source distribution", 0.9),
    ("mpl-2", 3, "source code form", r"this source code form is subject to the terms of the mozilla public licen[cs]e", 0.95),
    ("mpl-2", 3, "mpl was not", r"if a copy of the mpl was not distributed with this file you can obtain one at", 0.9),
    ("mpl-1.1", 3, "mozilla", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1", 0.95),
    ("epl-2", 3, "eclipse", r"available under the terms of the eclipse public licen[cs]e 2 0", 0.95),
    ("epl-1", 3, "eclipse", r"available under the terms of the eclipse public licen[cs]e v1 0", 0.95),
    ("cddl-1", 3, "common development", r"subject to the terms of the common development and distribution licen[cs]e", 0.95),
    ("boost-1", 3, "derivative works", r"use reproduce display distribute execute and transmit the software and to prepare derivative works", 0.9),
    ("unlicense", 3, "anyone is free", r"anyone is free to copy modify publish use compile sell or distribute this software", 0.95),
    ("unlicense", 3, "unlicense org", r"refer to https? unlicense org", 0.9),
    ("wtfpl", 3, "you just do", r"you just do what the f[uc*]{1,3}k you want to", 0.95),
    ("cc-by", 4, "creative commons", r"this work is licensed under a creative commons attribution [1-4] [05]", 0.9),
    ("creative-commons", 4, "creative commons", r"(?:this work|this content|the text|this article|this image) is (?:licensed|available|released) under (?:a |the )?creative commons", 0.6),
    ("cc0", 3, "waived", r"waived all copyright and related or neighboring rights", 0.95),
    ("public-domain", 4, "public domain", r"(?:placed|released|dedicated) (?:into|in|to) the public domain", 0.85),
    ("public-domain", 4, "no copyright", r"no copyright (?:is )?(?:claimed|protection)", 0.7),
    ("ofl-1.1", 3, "font software", r"this font software is licensed under the sil open font licen[cs]e", 0.95),
    ("ofl-1.1", 4, "reserved font", r"with reserved font name", 0.8),
    ("openssl", 3, "openssl", r"this product includes software developed by the openssl project", 0.9),
    ("python-2", 3, "psf", r"psf is making python available to licensee on an as is basis", 0.95),
    ("php-3", 3, "php software", r"this product includes php software freely available from", 0.95),
    ("artistic-1", 3, "intent of this", r"the intent of this document is to state the conditions under which a package may be copied", 0.95),
    ("ncsa", 3, "illinois", r"developed by (?:[a-z0-9]{1,40} ){1,6}university of illinois", 0.6),
    ("json", 3, "good not evil", r"the software shall be used for good not evil", 0.95),
    ("beerware", 3, "beer", r"you can buy me a beer in return", 0.9),
    ("busl-1.1", 3, "additional use", r"additional use grant", 0.6),
    ("openrail-m", 4, "based restrictions", r"use based restrictions as referenced in", 0.7),
    ("proprietary", 4, "confidential", r"(?:is|contains) (?:the )?confidential and proprietary information", 0.85),
    ("proprietary", 4, "reproduced", r"no part of this (?:publication|document|book|work|software) may be reproduced", 0.8),
    ("proprietary", 4, "reproduced", r"may not be reproduced (?:distributed|copied|transmitted|published)", 0.7),
    ("proprietary", 5, "internal use", r"for internal use only", 0.6),
    ("proprietary", 5, "evaluation", r"for evaluation (?:purposes )?only", 0.6),
    ("proprietary", 5, "end user", r"end user licen[cs]e agreement", 0.6),
    ("proprietary", 5, "trade secret", r"trade secrets? of", 0.6),
    ("non-commercial", 5, "commercial", r"(?:for )?non ?commercial (?:use|purposes)(?: only)?", 0.5),
    ("non-commercial", 5, "personal use", r"for personal use only", 0.5),
    ("research-only", 5, "research", r"for (?:academic |non ?commercial )?research (?:use|purposes) only", 0.6),
    ("no-redistribution", 5, "redistribution", r"redistribution (?:is )?(?:strictly )?(?:prohibited|forbidden|not (?:permitted|allowed))", 0.7),
    ("no-derivatives", 5, "derivative", r"no derivative works(?: are)? (?:permitted|allowed)", 0.6),
    ("no-ai-training", 4, "not be used", r"(?:may|must|shall) not be used (?:for|to) (?:the )?(?:train|training)(?: of)?", 0.7),
    ("no-ai-training", 4, "text and data", r"text and data mining (?:is )?(?:reserved|prohibited|not permitted)", 0.7),
    ("share-alike", 5, "same licen", r"under the same licen[cs]e(?: as the original)?", 0.5),
)


def _whole(regex: str) -> str:
    """Whole words only. Spaces are the only borders in normalised text."""
    return rf"(?<![^ ])(?:{regex})(?![^ ])"


def build_rules() -> tuple[Rule, ...]:
    """All rules in order: base phrases, then families form by form, then the rest."""
    rules = [Rule(f"base:{label}", label, 0, phrase, _whole(phrase), 1.0) for phrase, label in BASE_PHRASES]
    for label, keyword, name, spdx in FAMILIES:
        rules.append(Rule(f"spdx:{label}", label, 1, "identifier", _whole(rf"spdx licen[cs]e identifier {spdx}"), 1.0))
    for label, keyword, name, _ in FAMILIES:
        rules.append(Rule(f"grant:{label}", label, 2, keyword, _whole(_GRANT + name), 0.95))
    for label, keyword, name, _ in FAMILIES:
        rules.append(Rule(f"pointer:{label}", label, 3, keyword, _whole(_POINTER + name), 0.8))
    rules += [Rule(f"text:{i}:{label}", label, priority, keyword, _whole(regex), confidence) for i, (label, priority, keyword, regex, confidence) in enumerate(OTHER)]
    for label, keyword, name, _ in FAMILIES:
        rules.append(Rule(f"name:{label}", label, 5, keyword, _whole(name), 0.7))
    return tuple(rules)


RULES = build_rules()
