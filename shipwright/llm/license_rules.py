"""Signature rules of the license scan, in priority order inside each list.

Texts are matched as lower-case words with one blank between them, marks removed: ``Apache License,
Version 2.0`` reads ``apache license version 2 0``. A rule has a label, a priority (3: a grant or the
license's own wording, 2: the license's name with the word license, 1: a weaker hint), a
keyword that every match of the regex holds (so a text without it needn't be tried), and the regex. ``rules()`` builds the list:
every named license gives a grant, a notice, a title, an identifier and an address form; the
license texts' own wordings follow.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str
    regex: str


# label, keyword, regex of the name (without the word license at its end)
NAMES = [
    ("mit", "mit", r"mit(?: x11| expat)?"),
    ("mit-0", "mit", r"mit(?: no attribution| 0)"),
    ("x11", "x11", r"x11"),
    ("isc", "isc", r"isc"),
    ("apache-1.0", "apache", r"apache(?: software)?(?: license)?(?: version| v)? ?1 0"),
    ("apache-1.1", "apache", r"apache(?: software)?(?: license)?(?: version| v)? ?1 1"),
    ("apache-2.0", "apache", r"apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("apache", "apache", r"apache(?: software)?"),
    ("gpl-1.0", "general public", r"(?:gnu )?general public license(?: gpl)?(?: version| v) ?1(?: 0)?"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public license(?: gpl)?(?: version| v) ?2(?: 0)?"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public license(?: gpl)?(?: version| v) ?3(?: 0)?"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl ?(?:version |v ?)?2(?: 0)?"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl ?(?:version |v ?)?3(?: 0)?"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("gpl", "general public", r"gnu general public"),
    ("lgpl-2.0", "general public", r"(?:gnu )?library general public license(?: version| v) ?2(?: 0)?"),
    ("lgpl-2.1", "general public", r"(?:gnu )?lesser general public license(?: lgpl)?(?: version| v) ?2 1"),
    ("lgpl-3.0", "general public", r"(?:gnu )?lesser general public license(?: lgpl)?(?: version| v) ?3(?: 0)?"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl ?(?:version |v ?)?2 1"),
    ("lgpl-3.0", "lgpl", r"(?:gnu )?lgpl ?(?:version |v ?)?3(?: 0)?"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl"),
    ("lgpl", "general public", r"(?:gnu )?(?:lesser|library) general public"),
    ("agpl-3.0", "general public", r"(?:gnu )?affero general public license(?: agpl)?(?: version| v) ?3(?: 0)?"),
    ("agpl-3.0", "agpl", r"(?:gnu )?agpl ?(?:version |v ?)?3(?: 0)?"),
    ("agpl", "general public", r"(?:gnu )?affero general public"),
    ("gfdl-1.3", "free documentation", r"(?:gnu )?free documentation license(?: version| v) ?1 3"),
    ("gfdl-1.2", "free documentation", r"(?:gnu )?free documentation license(?: version| v) ?1 2"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|(?:4|four) clause bsd|bsd (?:4|four) clause)"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|(?:3|three) clause bsd|bsd (?:3|three) clause)"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|freebsd|(?:2|two) clause bsd|bsd (?:2|two) clause)"),
    ("bsd-0-clause", "bsd", r"(?:0bsd|zero clause bsd|bsd zero clause)"),
    ("bsd", "bsd", r"(?:berkeley )?bsd(?: style)?"),
    ("mpl-1.0", "mozilla", r"mozilla public license(?: version| v) ?1 0"),
    ("mpl-1.1", "mozilla", r"mozilla public license(?: version| v) ?1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public license(?: version| v) ?2(?: 0)?"),
    ("mpl-2.0", "mpl", r"mpl ?(?:version |v ?)?2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public"),
    ("epl-1.0", "eclipse", r"eclipse public license(?: version| v)? ?1(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public license(?: version| v)? ?2(?: 0)?"),
    ("epl", "eclipse", r"eclipse public"),
    ("edl-1.0", "eclipse", r"eclipse distribution license(?: version| v)? ?1(?: 0)?"),
    ("eupl-1.1", "european union", r"european union public licen[cs]e(?: version| v)? ?1 1"),
    ("eupl-1.2", "european union", r"european union public licen[cs]e(?: version| v)? ?1 2"),
    ("eupl", "european union", r"european union public"),
    ("cddl-1.0", "common development", r"common development and distribution license(?: cddl)?(?: version| v)? ?1(?: 0)?"),
    ("cddl-1.1", "common development", r"common development and distribution license(?: cddl)?(?: version| v)? ?1 1"),
    ("cddl", "common development", r"common development and distribution"),
    ("cpl-1.0", "common public", r"common public license(?: version| v)? ?1(?: 0)?"),
    ("cpal-1.0", "common public", r"common public attribution"),
    ("osl-3.0", "open software", r"open software license(?: version| v)? ?3(?: 0)?"),
    ("afl-3.0", "academic free", r"academic free license(?: version| v)? ?3(?: 0)?"),
    ("artistic-1.0", "artistic", r"artistic license(?: version| v)? ?1(?: 0)?"),
    ("artistic-2.0", "artistic", r"artistic license(?: version| v)? ?2(?: 0)?"),
    ("artistic", "artistic", r"artistic"),
    ("bsl-1.0", "boost", r"boost software license(?: version| v)? ?1(?: 0)?"),
    ("bsl-1.0", "boost", r"boost(?: software)?"),
    ("busl-1.1", "business source", r"business source license(?: version| v)? ?1 1"),
    ("elastic-2.0", "elastic", r"elastic license(?: version| v)? ?2(?: 0)?"),
    ("sspl-1.0", "server side", r"server side public"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("libpng", "libpng", r"libpng"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("unlicense", "unlicense", r"the unlicense"),
    ("ms-pl", "microsoft public", r"microsoft public"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?"),
    ("ofl-1.1", "open font", r"(?:sil )?open font license(?: version| v)? ?1 1"),
    ("ofl", "open font", r"(?:sil )?open font"),
    ("openssl", "openssl", r"openssl"),
    ("php-3.01", "php", r"php license(?: version| v)? ?3 0 ?1"),
    ("php", "php", r"php"),
    ("python-2.0", "python", r"python(?: software foundation)?"),
    ("ruby", "ruby", r"ruby"),
    ("vim", "vim", r"vim"),
    ("w3c", "w3c", r"w3c(?: software)?"),
    ("postgresql", "postgresql", r"postgresql"),
    ("qpl-1.0", "q public", r"q public"),
    ("zpl-2.1", "zope", r"zope public license(?: version| v)? ?2 1"),
    ("zpl", "zope", r"zope public"),
    ("sleepycat", "sleepycat", r"sleepycat"),
    ("upl-1.0", "universal permissive", r"universal permissive"),
    ("odbl-1.0", "open database", r"(?:odc )?open database"),
    ("odc-by-1.0", "open data commons", r"open data commons attribution"),
    ("ecl-2.0", "educational community", r"educational community license(?: version| v)? ?2(?: 0)?"),
    ("ipl-1.0", "ibm public", r"ibm public"),
    ("nposl-3.0", "non profit open", r"non profit open software"),
    ("beerware", "beerware", r"beerware"),
    ("hpnd", "historical permission", r"historical permission notice"),
    ("openrail", "openrail", r"(?:creativeml )?openrail(?: m)?"),
    ("llama-community", "community", r"llama(?: 2| 3)? community"),
    ("proprietary", "proprietary", r"proprietary"),
    ("commercial", "commercial", r"commercial"),
]

# Creative Commons: kind, its code and its words
CC_KINDS = [
    ("by", r"attribution"),
    ("by-sa", r"attribution share ?alike"),
    ("by-nd", r"attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("by-nc", r"attribution non ?commercial"),
    ("by-nc-sa", r"attribution non ?commercial share ?alike"),
    ("by-nc-nd", r"attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

# The licenses' own wordings and common notices
WORDINGS = [
    ("mit", 3, "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 2, "substantial portions", r"copyright notice and this permission notice shall be included in all copies or substantial portions"),
    ("isc", 3, "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("hpnd", 3, "permission", r"permission to use copy modify and distribute this software and its documentation for any purpose"),
    ("bsd", 2, "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", 2, "redistributions", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-3-clause", 3, "endorse", r"may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", 3, "advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", 3, "in compliance", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", 2, "apache", r"www apache org licenses license 2 0"),
    ("apache-2.0", 2, "contributor", r"subject to the terms and conditions of this license each contributor hereby grants to you a perpetual"),
    ("gpl", 3, "general public", r"redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", 3, "general public", r"redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", 3, "general public", r"redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl-2.0-or-later", 3, "general public", r"general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", 3, "general public", r"general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl", 2, "gnu org", r"www gnu org licenses(?: gpl)?"),
    ("gpl", 2, "general public", r"you should have received a copy of the gnu general public license"),
    ("lgpl", 2, "general public", r"you should have received a copy of the gnu lesser general public license"),
    ("mpl-2.0", 3, "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", 2, "mozilla", r"mozilla org mpl 2 0"),
    ("mpl-1.1", 3, "mozilla", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-1.0", 2, "eclipse", r"www eclipse org legal epl v10"),
    ("epl-2.0", 2, "eclipse", r"www eclipse org legal epl(?: v20| 2 0)"),
    ("bsl-1.0", 2, "boost", r"www boost org license 1 0"),
    ("unlicense", 3, "public domain", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", 2, "unlicense", r"unlicense org"),
    ("public-domain", 2, "public domain", r"(?:released|dedicated|placed) (?:in ?to|to|in) the public domain"),
    ("public-domain", 1, "public domain", r"(?:is|are) in the public domain"),
    ("cc0-1.0", 3, "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", 2, "creative commons", r"creative commons (?:zero|public domain dedication)"),
    ("zlib", 3, "permission", r"permission is granted to anyone to use this software for any purpose including commercial applications"),
    ("wtfpl", 3, "public license", r"do what the fuck you want to public license"),
    ("ofl-1.1", 2, "sil org", r"scripts sil org ofl"),
    ("ncsa", 3, "without restriction", r"to deal with the software without restriction including without limitation the rights to use copy"),
    ("artistic", 2, "perl itself", r"same terms as perl itself"),
    ("artistic", 2, "artistic", r"under the artistic license"),
    ("python-2.0", 3, "psf", r"psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("openssl", 3, "openssl", r"this product includes software developed by the openssl project"),
    ("x11", 2, "x consortium", r"name of the x consortium shall not be used in advertising"),
    ("php", 3, "php", r"this product includes php software freely available from"),
    ("w3c", 2, "w3c", r"w3c software notice and license"),
    ("beerware", 3, "beer", r"you can buy me a beer in return"),
    ("ms-pl", 2, "microsoft", r"microsoft public license ms pl"),
    ("proprietary", 3, "confidential", r"proprietary and confidential"),
    ("proprietary", 2, "all rights reserved", r"all rights reserved"),
    ("proprietary", 3, "written permission", r"may not be (?:reproduced|copied|distributed)(?: in any form)? without (?:the )?(?:prior )?written permission"),
    ("no-warranty", 1, "warrant", r"without warrant(?:y|ies) (?:of any kind|or conditions of any kind)"),
    ("no-warranty", 1, "as is", r"(?:software|work|material) is provided as is"),
    ("copyright-notice", 1, "copyright", r"copyright (?:c )?[0-9]{4}"),
    ("copyleft", 1, "copyleft", r"copyleft"),
    ("open-source", 1, "open source", r"open source licen[cs]e"),
    ("license-reference", 1, "licen", r"see (?:the )?(?:accompanying )?licen[cs]e(?: file| txt| md)?"),
    ("license-reference", 1, "licen", r"licen[cs]ed under"),
]

#: Phrases of the base scan: words, label.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

_GRANT = r"(?:licen[cs]ed|released|distributed|available|provided|published|covered|dual licen[cs]ed) (?:to you )?(?:under|by|with) (?:the )?(?:terms of )?(?:the )?"
_NOTICE = r"(?:this (?:file|work|project|program|software|library|package|document) is )"


def rules() -> list[Rule]:
    """All rules in order; of two equal matches the earlier rule wins."""
    out = [Rule(*w) for w in WORDINGS]
    names = [(label, keyword, regex) for label, keyword, regex in NAMES]
    for kind, words in CC_KINDS:
        for version in CC_VERSIONS:
            v = version.replace(".", " ")
            code = f"cc {kind.replace('-', ' ')}"
            names.append((f"cc-{kind}-{version}", "cc by", rf"{code} {v}"))
            names.append((f"cc-{kind}-{version}", "creative commons", rf"creative commons {words} {v}"))
        names.append((f"cc-{kind}", "creative commons", rf"creative commons {words}"))
    for label, keyword, regex in names:
        out.append(Rule(label, 3, keyword, rf"{_NOTICE}?{_GRANT}{regex}(?: licen[cs]e)?(?: or later| or any later version)?"))
        out.append(Rule(label, 2, keyword, rf"(?:the )?{regex} licen[cs]e" + (r"|" + regex + r"(?= or later| only)" if "gpl" in keyword else "")))
        out.append(Rule(label, 2, keyword, rf"spdx license identifier {regex}(?: only| or later)?"))
        if keyword in ("cc by", "creative commons") or "license" in regex:    # the name says it is a license
            out.append(Rule(label, 2, keyword, regex))
    return out


def gate(found: list[Rule]) -> list[str]:
    """The rules' keywords without those that hold another one: a text with none of them has no rule to try."""
    keywords = {r.keyword for r in found}
    return sorted(k for k in keywords if not any(o != k and o in k for o in keywords))


GATE = gate(rules())
