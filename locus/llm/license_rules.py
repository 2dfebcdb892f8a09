"""Signature rules of licences, over lower-cased words joined by single spaces.

Every licence has hand-written expressions for its name, its notices, its address and phrases of its text; an
expression must hold one of its licence's keywords, which gate it. Earlier rules have priority.
"""

from __future__ import annotations

from dataclasses import dataclass

#: What an expression's kind is worth as evidence, strongest first.
WEIGHTS = {"text": 1.0, "spdx": 0.95, "address": 0.9, "notice": 0.8, "name": 0.6}


@dataclass(frozen=True)
class Rule:
    label: str
    kind: str
    keyword: str
    pattern: str


#: label: (keyword, SPDX words, name, address words, phrases of the text).
LICENSES: dict[str, tuple[str, str, str, str, tuple[str, ...]]] = {
    "mit": ("mit", r"mit", r"(?:the )?mit (?:x11 )?licen[cs]es?", r"(?:opensource org|mit) licen[cs]es? mit(?: license)?(?: php)?", (r"permission is hereby granted free of charge to any person obtaining a copy of this software", r"the above copyright notice and this permission notice shall be included in all copies")),
    "mit-0": ("mit", r"mit 0", r"mit no attribution(?: licen[cs]e)?", r"spdx org licenses mit 0", ()),
    "x11": ("x11", r"x11", r"x11 licen[cs]e", r"x org licen[cs]e", (r"except as contained in this notice the name of the x consortium shall not be used",)),
    "isc": ("isc", r"isc", r"isc licen[cs]e", r"opensource org licenses isc", (r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",)),
    "bsd-2-clause": ("bsd", r"bsd 2 clause(?: simplified| freebsd)?", r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[cs]e)?", r"opensource org licenses bsd 2 clause", (r"redistributions in binary form must reproduce the above copyright notice",)),
    "bsd-3-clause": ("bsd", r"bsd 3 clause(?: clear| lbnl)?", r"(?:new bsd|revised bsd|modified bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[cs]e)?", r"opensource org licenses bsd 3 clause", (r"neither the name of .{1,80} nor the names of its contributors may be used to endorse",)),
    "bsd-4-clause": ("bsd", r"bsd 4 clause(?: uc)?", r"(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)(?: licen[cs]e)?", r"directory fsf org wiki license bsd 4clause", (r"all advertising materials mentioning features or use of this software must display",)),
    "0bsd": ("bsd", r"0bsd", r"(?:0bsd|zero clause bsd)(?: licen[cs]e)?", r"landley net toybox license", ()),
    "bsd": ("bsd", r"bsd", r"bsd(?: style)? licen[cs]ed?", r"opensource org licenses bsd license", ()),
    "apache-1.1": ("apache", r"apache 1 1", r"apache(?: software)? licen[cs]e (?:version |v )?1 1", r"apache org licenses license 1 1", (r"this product includes software developed by the apache software foundation",)),
    "apache-2.0": ("apache", r"apache 2 0", r"apache(?: software)? licen[cs]e(?: version)? (?:v ?)?2(?: 0)?", r"apache org licenses license 2 0(?: txt| html)?", (r"licensed under the apache license version 2 0 the license you may not use this file except in compliance",)),
    "apache": ("apache", r"apache", r"(?:the )?apache(?: software)? licen[cs]e", r"apache org licenses", (r"apache license version \d+",)),
    "gpl-1.0": ("gpl", r"gpl 1 0(?: only| or later)?", r"(?:gnu )?gpl ?v?1(?: 0)?", r"gnu org licenses (?:old licenses )?gpl 1 0", ()),
    "gpl-2.0": ("gpl", r"gpl 2 0(?: only| or later)?", r"(?:gnu )?gpl ?v?2(?: 0)?(?: only| or later)?", r"gnu org licenses (?:old licenses )?gpl 2 0", ()),
    "gpl-3.0": ("gpl", r"gpl 3 0(?: only| or later)?", r"(?:gnu )?gpl ?v?3(?: 0)?(?: only| or later)?", r"gnu org licenses gpl 3 0", ()),
    "gpl": ("general", r"gpl", r"(?:gnu )?general public licen[cs]e", r"gnu org licenses gpl", (r"you can redistribute it and or modify it under the terms of the gnu general public license", r"you should have received a copy of the gnu general public license")),
    "lgpl-2.1": ("lgpl", r"lgpl 2 1(?: only| or later)?", r"(?:gnu )?lgpl ?v?2(?: 1)?(?: only| or later)?", r"gnu org licenses (?:old licenses )?lgpl 2 1", ()),
    "lgpl-3.0": ("lgpl", r"lgpl 3 0(?: only| or later)?", r"(?:gnu )?lgpl ?v?3(?: 0)?(?: only| or later)?", r"gnu org licenses lgpl 3 0", ()),
    "lgpl": ("general", r"lgpl", r"(?:gnu )?(?:lesser|library) general public licen[cs]e", r"gnu org licenses lgpl", (r"you should have received a copy of the gnu (?:lesser|library) general public license",)),
    "agpl-3.0": ("agpl", r"agpl 3 0(?: only| or later)?", r"(?:gnu )?agpl ?v?3(?: 0)?(?: only| or later)?", r"gnu org licenses agpl 3 0", ()),
    "agpl": ("affero", r"agpl", r"(?:gnu )?affero general public licen[cs]e", r"affero org oagpl html", (r"you should have received a copy of the gnu affero general public license",)),
    "gfdl": ("documentation", r"gfdl 1 \d(?: only| or later)?", r"(?:gnu )?free documentation licen[cs]e", r"gnu org licenses fdl", (r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license",)),
    "mpl-1.1": ("mpl", r"mpl 1 1", r"mpl ?v?1 1", r"mozilla org mpl mpl 1 1", ()),
    "mpl-2.0": ("mpl", r"mpl 2 0", r"mpl ?v?2(?: 0)?", r"mozilla org mpl 2 0", ()),
    "mpl": ("mozilla", r"mpl", r"mozilla public licen[cs]e", r"mozilla org mpl", (r"this source code form is subject to the terms of the mozilla public license",)),
    "epl-1.0": ("epl", r"epl 1 0", r"epl ?v?1(?: 0)?", r"eclipse org legal epl v10", ()),
    "epl-2.0": ("epl", r"epl 2 0", r"epl ?v?2(?: 0)?", r"eclipse org legal epl 2 0", ()),
    "epl": ("eclipse", r"epl", r"eclipse (?:public|distribution) licen[cs]e", r"eclipse org legal epl", (r"this program and the accompanying materials are made available under the terms of the eclipse public license",)),
    "cddl": ("distribution", r"cddl 1 [01]", r"common development and distribution licen[cs]e", r"opensource org licenses cddl1", ()),
    "cpl": ("common", r"cpl 1 0", r"common public licen[cs]e", r"opensource org licenses cpl1", ()),
    "eupl": ("eu", r"eupl 1 [12]", r"(?:european union public licen[cs]e|eupl)", r"joinup ec europa eu .{0,40}eupl", ()),
    "artistic": ("artistic", r"artistic [12] 0", r"artistic licen[cs]e", r"perlfoundation org artistic license", (r"the intent of this document is to state the conditions under which a package may be copied",)),
    "zlib": ("zlib", r"zlib", r"zlib(?: libpng)? licen[cs]e", r"zlib net zlib license", ()),
    "libpng": ("png", r"libpng(?: 2 0)?", r"(?:libpng|png reference library) licen[cs]e", r"libpng org .{0,30}license", ()),
    "boost": ("boost", r"bsl 1 0", r"boost software licen[cs]e", r"boost org license 1 0", (r"distributed under the boost software license version 1 0",)),
    "unlicense": ("unlicense", r"unlicense", r"the unlicense", r"unlicense org", ()),
    "public-domain": ("domain", r"public domain", r"(?:in|into|to) the public domain", r"creativecommons org (?:licenses )?publicdomain", (r"this is free and unencumbered software released into the public domain", r"dedicated to the public domain")),
    "cc0": ("cc0", r"cc0 1 0", r"cc0(?: 1 0)?(?: universal)?", r"creativecommons org publicdomain zero 1 0", (r"cc0 public domain dedication",)),
    "cc-by": ("cc", r"cc by [1-4] \d", r"cc by(?: [1-4] \d)?", r"creativecommons org licenses by [1-4] \d", ()),
    "cc-by-sa": ("cc", r"cc by sa [1-4] \d", r"cc by sa(?: [1-4] \d)?", r"creativecommons org licenses by sa [1-4] \d", ()),
    "cc-by-nd": ("cc", r"cc by nd [1-4] \d", r"cc by nd(?: [1-4] \d)?", r"creativecommons org licenses by nd [1-4] \d", ()),
    "cc-by-nc": ("cc", r"cc by nc [1-4] \d", r"cc by nc(?: [1-4] \d)?", r"creativecommons org licenses by nc [1-4] \d", ()),
    "cc-by-nc-sa": ("cc", r"cc by nc sa [1-4] \d", r"cc by nc sa(?: [1-4] \d)?", r"creativecommons org licenses by nc sa [1-4] \d", ()),
    "cc-by-nc-nd": ("cc", r"cc by nc nd [1-4] \d", r"cc by nc nd(?: [1-4] \d)?", r"creativecommons org licenses by nc nd [1-4] \d", ()),
    "creative-commons": ("commons", r"cc", r"creative commons(?: attribution)?(?: (?:share ?alike|non ?commercial|no ?derivatives))*(?: [1-4] \d)?(?: (?:international|unported|generic))?(?: public)?(?: licen[cs]e)?", r"creativecommons org licenses", ()),
    "wtfpl": ("wtfpl", r"wtfpl", r"wtfpl", r"wtfpl net", ()),
    "openssl": ("openssl", r"openssl", r"openssl(?: ssleay)? licen[cs]e", r"openssl org source license", (r"this product includes software developed by the openssl project",)),
    "python": ("python", r"(?:python|psf) 2 0", r"(?:python software foundation|python) licen[cs]e", r"docs python org .{0,12}license", ()),
    "php": ("php", r"php 3 01?", r"php licen[cs]e", r"php net license", ()),
    "ruby": ("ruby", r"ruby", r"ruby licen[cs]e", r"ruby lang org .{0,12}license", ()),
    "ofl": ("font", r"ofl 1 [01]", r"(?:sil )?open font licen[cs]e", r"openfontlicense org", ()),
    "odbl": ("database", r"odbl 1 0", r"open (?:data commons )?(?:open )?database licen[cs]e", r"opendatacommons org licenses odbl", ()),
    "vim": ("vim", r"vim", r"vim licen[cs]e", r"vimdoc sourceforge net .{0,40}license", ()),
    "ms-pl": ("microsoft", r"ms (?:pl|rl)", r"microsoft (?:public|reciprocal) licen[cs]e", r"opensource org licenses ms pl", ()),
    "commercial": ("rights", r"licenseref (?:commercial|proprietary)", r"all rights reserved", r"commercial licen[cs]e agreement", (r"unauthorized copying of this file via any medium is strictly prohibited",)),
}

#: Labels whose name is no licence that something is under.
NO_NOTICE = ("public-domain", "commercial")

#: Further phrases of licence texts and notices, by label.
PHRASES: dict[str, tuple[str, ...]] = {
    "mit": (
        r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies",
        r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability",
        r"in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract",
    ),
    "isc": (r"the software is provided as is and the author disclaims all warranties with regard to this software",),
    "bsd": (
        r"redistribution and use in source and binary forms with or without modification are permitted",
        r"redistributions of source code must retain the above copyright notice",
        r"this software is provided by the (?:copyright holders|authors?|regents)(?: and contributors)? as is and any express or implied warranties",
    ),
    "bsd-3-clause": (r"the names? of (?:its|the) contributors may not be used to endorse or promote products derived from this software",),
    "bsd-4-clause": (r"this product includes software developed by the university of california berkeley and its contributors",),
    "apache-1.1": (r"the names apache (?:server )?and apache (?:group|software foundation) must not be used to endorse or promote products",),
    "apache-2.0": (
        r"you may obtain a copy of the license at (?:https? )?(?:www )?apache org licenses license 2 0",
        r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
        r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) license",
    ),
    "gpl-2.0": (
        r"general public license as published by the free software foundation either version 2 of the license",
        r"gnu general public license version 2(?: only)? as published by the free software foundation",
    ),
    "gpl-3.0": (
        r"general public license as published by the free software foundation either version 3 of the license",
        r"gnu general public license version 3(?: only)? as published by the free software foundation",
    ),
    "gpl": (
        r"the licenses for most software (?:and other practical works )?are designed to take away your freedom to share and change",
        r"this program comes with absolutely no warranty",
        r"this program is distributed in the hope that it will be useful but without any warranty",
    ),
    "lgpl-2.1": (r"as published by the free software foundation either version 2 1 of the license",),
    "lgpl": (r"this license the lesser general public license applies to some specially designated software packages",),
    "agpl": (r"your modified version must prominently offer all users interacting with it remotely through a computer network",),
    "gfdl": (r"with no invariant sections no front cover texts and no back cover texts",),
    "mpl-1.1": (r"the contents of this file are subject to the mozilla public license version 1 1",),
    "mpl-2.0": (r"if a copy of the mpl was not distributed with this file you can obtain one at",),
    "epl-1.0": (r"the accompanying program is provided under the terms of this eclipse public license agreement",),
    "epl-2.0": (r"eclipse public license v ?2 0 which (?:is available|accompanies)",),
    "cddl": (r"the contents of this file are subject to the terms of the common development and distribution license",),
    "cpl": (r"the accompanying program is provided under the terms of this common public license agreement",),
    "eupl": (r"licensed under the eupl(?: version)? 1 [12]",),
    "artistic": (
        r"you may (?:copy|make) and (?:distribute|give away) verbatim copies of the source form of the standard version of this package",
        r"the copyright holder maintains some semblance of artistic control over the development of the package",
    ),
    "zlib": (
        r"the origin of this software must not be misrepresented you must not claim that you wrote the original software",
        r"altered source versions must be plainly marked as such",
        r"in no event will the authors be held liable for any damages arising from the use of this software",
    ),
    "libpng": (r"the png reference library is supplied as is",),
    "boost": (r"any person or organization obtaining a copy of the software and accompanying documentation covered by this license",),
    "unlicense": (
        r"anyone is free to copy modify publish use compile sell or distribute this software",
        r"for more information please refer to (?:https? )?unlicense org",
    ),
    "cc0": (
        r"the person who associated a work with this deed has dedicated the work to the public domain",
        r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives",
    ),
    "cc-by": (r"licensed under (?:a |the )?creative commons attribution [1-4] \d",),
    "cc-by-sa": (r"licensed under (?:a |the )?creative commons attribution share ?alike(?: [1-4] \d)?",),
    "cc-by-nd": (r"licensed under (?:a |the )?creative commons attribution no ?deriv(?:ative|ative ?work)?s(?: [1-4] \d)?",),
    "cc-by-nc": (r"licensed under (?:a |the )?creative commons attribution non ?commercial [1-4] \d",),
    "cc-by-nc-sa": (r"licensed under (?:a |the )?creative commons attribution non ?commercial share ?alike(?: [1-4] \d)?",),
    "creative-commons": (r"some rights reserved", r"you are free to share copy and redistribute the material in any medium or format"),
    "wtfpl": (
        r"do what the fuck you want to public license",
        r"everyone is permitted to copy and distribute verbatim or modified copies of this license document",
    ),
    "openssl": (r"redistributions of any form whatsoever must retain the following acknowledgment",),
    "python": (r"psf is making python available to licensee on an as is basis",),
    "php": (r"this product includes php software freely available from",),
    "ruby": (r"you may make and give away verbatim copies of the source form of the software without restriction",),
    "ofl": (
        r"this font software is licensed under the sil open font license",
        r"the fonts and derivatives however cannot be released under any other type of license",
    ),
    "odbl": (r"any rights in individual contents of the database are licensed under the database contents license",),
    "vim": (r"vim is charityware",),
    "ms-pl": (r"this license governs use of the accompanying software if you use the software you accept this license",),
    "commercial": (
        r"this software is the confidential and proprietary information of",
        r"no part of this (?:publication|book|document|work|site) may be (?:reproduced|copied)",
        r"reproduction in whole or in part without (?:prior |written |express )*permission is prohibited",
        r"may not be (?:copied|reproduced) (?:or|and) (?:re)?distributed without (?:prior |written |express )*permission",
        r"you may not reverse engineer decompile or disassemble the software",
        r"this license agreement is a legal agreement between you and",
    ),
}

#: A text that holds none of these, lower-cased, has no place of any rule or base phrase.
GATES = ("licen", "attribution", "permission", "distribut", "copyright", "gpl", "gnu", "bsd", "apache", "mozilla", "mpl", "epl", "eclipse", "eupl", "commons", "cc0", "cc", "domain", "zlib", "boost", "wtfpl", "openssl", "copied", "rights", "copying", "advertising", "consortium", "contributors", "warrant", "invariant", "modified version", "artistic control", "misrepresented", "altered source", "png reference", "held liable", "unconditionally", "charityware", "php software", "verbatim", "proprietary", "reproduced", "decompile", "endorse")


def rules() -> tuple[Rule, ...]:
    """All rules by priority: kinds from strong to weak, licences in the order above."""
    found: list[Rule] = []
    for label, (keyword, spdx, name, address, texts) in LICENSES.items():
        found += [Rule(label, "text", "", t) for t in (*texts, *PHRASES.get(label, ()))]
        found.append(Rule(label, "spdx", "spdx", rf"spdx license identifier {spdx}"))
        found.append(Rule(label, "address", "", address))
        if label not in NO_NOTICE:
            found.append(Rule(label, "notice", keyword, rf"(?:released|licensed|distributed|available|published|provided|covered) (?:under|by) (?:the )?(?:terms of )?(?:the )?{name}"))
        found.append(Rule(label, "name", keyword, name))
    rank = {k: i for i, k in enumerate(WEIGHTS)}
    return tuple(sorted(found, key=lambda r: rank[r.kind]))
