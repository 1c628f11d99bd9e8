"""The signatures of the license scan: ordered rules over words.

A rule is a regex on the words from its anchor on, lower case and each followed
by one space. ``anchors`` are the spellings of its first word; ``gate`` is a further
keyword that must be near before the regex is tried. Among overlapping
detections the larger priority wins, then the longer match, then the earlier
rule.
"""

from __future__ import annotations

from typing import NamedTuple

# Longest signature in words: what follows an anchor beyond is not looked at.
REACH = 32

IDENTIFIER, ADDRESS, NOTICE, GRANT, NAMED, FAMILY, HINT = 90, 80, 75, 70, 50, 40, 20


class Rule(NamedTuple):
    order: int
    label: str
    priority: int
    anchors: tuple[str, ...]
    gate: str
    pattern: str


# Label; name as anchor, then a regex of the further words;
# words of its SPDX identifier; words of its address. "-" is none.
NAMES = """
apache-2.0; apache (?:software )?licen[sc]e (?:version |v)?2(?: 0)?; apache 2 0; apache org licenses license 2 0
apache-1.1; apache (?:software )?licen[sc]e (?:version |v)?1 1; apache 1 1; apache org licenses license 1 1
apache-1.0; apache (?:software )?licen[sc]e (?:version |v)?1 0; apache 1 0; apache org licenses license 1 0
mit; mit (?:x11 )?licen[sc]e; mit; opensource org licen[sc]es?(?: php)? mit(?: license)?
mit; expat licen[sc]e; -; -
mit-0; mit no attribution(?: licen[sc]e)?; mit 0; opensource org licenses mit 0
bsd-2-clause; simplified bsd licen[sc]e; bsd 2 clause; opensource org licenses bsd 2 clause
bsd-2-clause; bsd (?:2|two) clause(?: licen[sc]e)?; -; -
bsd-2-clause; freebsd licen[sc]e; bsd 2 clause freebsd; -
bsd-3-clause; bsd (?:3|three) clause(?: licen[sc]e)?; bsd 3 clause; opensource org licenses bsd 3 clause
bsd-3-clause; revised bsd licen[sc]e; bsd 3 clause clear; -
bsd-3-clause; modified bsd licen[sc]e; -; -
bsd-4-clause; bsd (?:4|four) clause(?: licen[sc]e)?; bsd 4 clause; -
bsd-4-clause; original bsd licen[sc]e; bsd 4 clause uc; -
0bsd; zero clause bsd(?: licen[sc]e)?; 0bsd; opensource org licenses 0bsd
isc; isc licen[sc]e; isc; opensource org licenses isc
gpl-1.0; gnu general public licen[sc]e (?:version |v)1(?: 0)?; gpl 1 0(?: only| or later)?; gnu org licenses (?:old licenses )?gpl 1 0
gpl-2.0; gnu general public licen[sc]e (?:version |v)2(?: 0)?; gpl 2 0(?: only| or later)?; gnu org licenses (?:old licenses )?gpl 2 0
gpl-2.0; gnu gpl (?:version |v)2(?: 0)?; gplv2; -
gpl-2.0; gplv2 (?:licen[sc]e|or later|only); -; -
gpl-3.0; gnu general public licen[sc]e (?:version |v)3(?: 0)?; gpl 3 0(?: only| or later)?; gnu org licenses gpl 3 0
gpl-3.0; gnu gpl (?:version |v)3(?: 0)?; gplv3; -
gpl-3.0; gplv3 (?:licen[sc]e|or later|only); -; -
lgpl-2.0; gnu library general public licen[sc]e (?:version |v)2(?: 0)?; lgpl 2 0(?: only| or later)?; gnu org licenses (?:old licenses )?lgpl 2 0
lgpl-2.1; gnu lesser general public licen[sc]e (?:version |v)2 1; lgpl 2 1(?: only| or later)?; gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3.0; gnu lesser general public licen[sc]e (?:version |v)3(?: 0)?; lgpl 3 0(?: only| or later)?; gnu org licenses lgpl 3 0
agpl-3.0; gnu affero general public licen[sc]e (?:version |v)3(?: 0)?; agpl 3 0(?: only| or later)?; gnu org licenses agpl 3 0
agpl-3.0; affero general public licen[sc]e(?: (?:version |v)3(?: 0)?)?; agplv3; -
gfdl-1.1; gnu free documentation licen[sc]e (?:version |v)1 1; gfdl 1 1(?: only| or later)?; -
gfdl-1.2; gnu free documentation licen[sc]e (?:version |v)1 2; gfdl 1 2(?: only| or later)?; gnu org licenses (?:old licenses )?fdl 1 2
gfdl-1.3; gnu free documentation licen[sc]e (?:version |v)1 3; gfdl 1 3(?: only| or later)?; gnu org licenses fdl 1 3
mpl-1.0; mozilla public licen[sc]e (?:version |v)?1 0; mpl 1 0; mozilla org mpl 1 0
mpl-1.1; mozilla public licen[sc]e (?:version |v)?1 1; mpl 1 1; mozilla org mpl 1 1
mpl-2.0; mozilla public licen[sc]e (?:version |v)?2(?: 0)?; mpl 2 0; mozilla org (?:en us )?mpl 2 0
epl-1.0; eclipse public licen[sc]e (?:version |v)?1(?: 0)?; epl 1 0; eclipse org legal epl v10
epl-2.0; eclipse public licen[sc]e (?:version |v)?2(?: 0)?; epl 2 0; eclipse org legal epl 2 0
edl-1.0; eclipse distribution licen[sc]e(?: (?:version |v)?1(?: 0)?)?; edl 1 0; eclipse org org documents edl v10
cddl-1.0; common development and distribution licen[sc]e(?: (?:version |v)?1 0)?; cddl 1 0; opensource org licenses cddl 1 0
cddl-1.1; common development and distribution licen[sc]e (?:version |v)?1 1; cddl 1 1; -
cpl-1.0; common public licen[sc]e(?: (?:version |v)?1(?: 0)?)?; cpl 1 0; opensource org licenses cpl1 0
ipl-1.0; ibm public licen[sc]e(?: (?:version |v)?1(?: 0)?)?; ipl 1 0; opensource org licenses ipl 1 0
artistic-1.0; artistic licen[sc]e (?:version |v)?1(?: 0)?; artistic 1 0; opensource org licenses artistic 1 0
artistic-2.0; artistic licen[sc]e (?:version |v)?2(?: 0)?; artistic 2 0; opensource org licenses artistic 2 0
zlib; zlib licen[sc]e; zlib; zlib net zlib license(?: html)?
zlib; zlib libpng licen[sc]e; -; -
libpng; libpng licen[sc]e; libpng; libpng org pub png src libpng license
bsl-1.0; boost software licen[sc]e(?: (?:version |v)?1(?: 0)?)?; bsl 1 0; boost org license 1 0
unlicense; unlicense licen[sc]e; unlicense; unlicense org
wtfpl; do what the fuck you want to public licen[sc]e; wtfpl; wtfpl net
wtfpl; wtfpl licen[sc]e; -; -
ofl-1.1; sil open font licen[sc]e(?: (?:version |v)?1 1)?; ofl 1 1; scripts sil org ofl
ofl-1.0; sil open font licen[sc]e (?:version |v)?1 0; ofl 1 0; -
eupl-1.1; european union public licen[sc]e (?:version |v)?1 1; eupl 1 1; -
eupl-1.2; european union public licen[sc]e(?: (?:version |v)?1 2)?; eupl 1 2; joinup ec europa eu collection eupl
osl-3.0; open software licen[sc]e(?: (?:version |v)?3(?: 0)?)?; osl 3 0; opensource org licenses osl 3 0
afl-3.0; academic free licen[sc]e(?: (?:version |v)?3(?: 0)?)?; afl 3 0; opensource org licenses afl 3 0
ecl-2.0; educational community licen[sc]e(?: (?:version |v)?2(?: 0)?)?; ecl 2 0; opensource org licenses ecl 2 0
ms-pl; microsoft public licen[sc]e; ms pl; opensource org licenses ms pl
ms-rl; microsoft reciprocal licen[sc]e; ms rl; opensource org licenses ms rl
postgresql; postgresql licen[sc]e; postgresql; opensource org licenses postgresql
psf-2.0; python software foundation licen[sc]e(?: (?:version |v)?2(?: 0)?)?; psf 2 0; docs python org 3 license
python-2.0; python licen[sc]e (?:version |v)?2(?: 0)?; python 2 0; opensource org licenses python 2 0
ruby; ruby licen[sc]e; ruby; ruby lang org en about license txt
php-3.01; php licen[sc]e(?: (?:version |v)?3 01)?; php 3 01; php net license 3 01 txt
openssl; openssl licen[sc]e; openssl; openssl org source license
x11; x11 licen[sc]e; x11; -
w3c; w3c software (?:notice and )?licen[sc]e; w3c; w3 org consortium legal copyright software
json; json licen[sc]e; json; json org license html
ncsa; university of illinois ncsa open source licen[sc]e; ncsa; opensource org licenses ncsa
cecill-2.1; cecill licen[sc]e(?: (?:version |v)?2 1)?; cecill 2 1; cecill info licences licence cecill v2 1
cecill-b; cecill b licen[sc]e; cecill b; cecill info licences licence cecill b
cecill-c; cecill c licen[sc]e; cecill c; cecill info licences licence cecill c
odbl-1.0; open database licen[sc]e(?: odbl)?(?: (?:version |v)?1 0)?; odbl 1 0; opendatacommons org licenses odbl
odc-by-1.0; open data commons attribution licen[sc]e; odc by 1 0; opendatacommons org licenses by
pddl-1.0; open data commons public domain dedication(?: and licen[sc]e)?; pddl 1 0; opendatacommons org licenses pddl
beerware; beer ware licen[sc]e; beerware; -
vim; vim licen[sc]e; vim; vimhelp org uganda txt
tcl; tcl tk licen[sc]e; tcl; -
curl; curl licen[sc]e; curl; curl se docs copyright
imagemagick; imagemagick licen[sc]e; imagemagick; imagemagick org script license php
hpnd; historical permission notice and disclaimer; hpnd; opensource org licenses hpnd
upl-1.0; universal permissive licen[sc]e(?: (?:version |v)?1 0)?; upl 1 0; oss oracle com licenses upl
blueoak-1.0.0; blue oak model licen[sc]e(?: 1 0 0)?; blueoak 1 0 0; blueoakcouncil org license 1 0 0
mulanpsl-2.0; mulan psl v2; mulanpsl 2 0; license coscl org cn mulanpsl2
sspl-1.0; server side public licen[sc]e(?: (?:version |v)?1)?; sspl 1 0; mongodb com licensing server side public license
busl-1.1; business source licen[sc]e(?: (?:version |v)?1 1)?; busl 1 1; mariadb com bsl11
elastic-2.0; elastic licen[sc]e(?: (?:version |v)?2(?: 0)?)?; elastic 2 0; elastic co licensing elastic license
polyform-nc-1.0.0; polyform noncommercial licen[sc]e(?: 1 0 0)?; polyform noncommercial 1 0 0; polyformproject org licenses noncommercial 1 0 0
commons-clause; commons clause licen[sc]e condition(?: v1 0)?; -; commonsclause com
apsl-2.0; apple public source licen[sc]e(?: (?:version |v)?2(?: 0)?)?; apsl 2 0; opensource apple com apsl
qpl-1.0; q public licen[sc]e(?: (?:version |v)?1(?: 0)?)?; qpl 1 0; opensource org licenses qpl 1 0
sleepycat; sleepycat licen[sc]e; sleepycat; opensource org licenses sleepycat
lppl-1.3c; latex project public licen[sc]e(?: (?:version |v)?1 3c?)?; lppl 1 3c; latex project org lppl
ijg; independent jpeg group licen[sc]e; ijg; -
bzip2; bzip2 licen[sc]e; bzip2 1 0 6; -
unicode-3.0; unicode licen[sc]e(?: v3)?; unicode 3 0; unicode org license txt
ntp; ntp licen[sc]e; ntp; opensource org licenses ntp
nasa-1.3; nasa open source agreement(?: (?:version |v)?1 3)?; nasa 1 3; opensource org licenses nasa1 3
rpl-1.5; reciprocal public licen[sc]e(?: (?:version |v)?1 5)?; rpl 1 5; opensource org licenses rpl 1 5
spl-1.0; sun public licen[sc]e(?: (?:version |v)?1 0)?; spl 1 0; opensource org licenses spl 1 0
ncgl-uk-2.0; non commercial government licen[sc]e; ncgl uk 2 0; -
ogl-uk-3.0; open government licen[sc]e(?: (?:version |v)?3 0)?; ogl uk 3 0; nationalarchives gov uk doc open government licence version 3
etalab-2.0; licence ouverte(?: (?:version |v)?2 0)?; etalab 2 0; etalab gouv fr licence ouverte
dl-de-by-2.0; datenlizenz deutschland namensnennung (?:version )?2 0; dl de by 2 0; govdata de dl de by 2 0
openrail-m; creativeml open rail m(?: licen[sc]e)?; openrail m; -
"""

# Label; priority; signature as anchor, then a regex; gate.
NOTICES = """
mit; NOTICE; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files; hereby
isc; NOTICE; permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted; hereby
hpnd; NOTICE; permission to use copy modify and distribute this software and its documentation for any purpose (?:and without fee )?is hereby granted; hereby
x11; NOTICE; except as contained in this notice the names? of (?:\\S+ ){1,8}shall not be used in advertising; advertising
bsl-1.0; NOTICE; permission is hereby granted free of charge to any person or organization obtaining a copy of the software; organization
ofl-1.1; NOTICE; permission is hereby granted free of charge to any person obtaining a copy of the font software; font
bsd; NOTICE; redistribution and use in source and binary forms with or without modification are permitted; redistribution
bsd; NOTICE; redistributions of source code must retain the above copyright notice; redistributions
bsd; NOTICE; redistributions in binary form must reproduce the above copyright notice; redistributions
bsd-3-clause; NOTICE; neither the names? of (?:\\S+ ){1,12}(?:nor the names of )?(?:its |their )?contributors may be used to endorse or promote; endorse
bsd-4-clause; NOTICE; advertising materials mentioning features or use of this software must display the following acknowledge?ment; mentioning
zlib; NOTICE; origin of this software must not be misrepresented; misrepresented
zlib; NOTICE; altered source versions must be plainly marked as such; plainly
apache-2.0; NOTICE; you may not use this file except in compliance with the license you may obtain a copy of the license at; compliance
apache-2.0; NOTICE; unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis; applicable
gpl; NOTICE; free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e; redistribute
gpl-2.0; NOTICE; general public licen[sc]e as published by the free software foundation (?:either )?version 2(?: of the licen[sc]e)?; published
gpl-3.0; NOTICE; general public licen[sc]e as published by the free software foundation (?:either )?version 3(?: of the licen[sc]e)?; published
lgpl-2.1; NOTICE; lesser general public licen[sc]e as published by the free software foundation (?:either )?version 2 1; published
lgpl-3.0; NOTICE; lesser general public licen[sc]e as published by the free software foundation (?:either )?version 3; published
agpl-3.0; NOTICE; affero general public licen[sc]e as published by the free software foundation (?:either )?version 3; published
gfdl; NOTICE; permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e; documentation
mpl-2.0; NOTICE; source code form is subject to the terms of the mozilla public licen[sc]e; mozilla
mpl-1.1; NOTICE; contents of this file are subject to the mozilla public licen[sc]e(?: version 1 1)?; mozilla
epl-1.0; NOTICE; program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e v1 0; eclipse
epl-2.0; NOTICE; program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e (?:v |v)?2 0; eclipse
cddl-1.0; NOTICE; contents of this file are subject to the terms of the common development and distribution licen[sc]e; distribution
unlicense; NOTICE; free and unencumbered software released into the public domain; unencumbered
wtfpl; NOTICE; everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed; verbatim
gpl; NOTICE; everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed; verbatim
beerware; NOTICE; you can do whatever you want with this stuff if we meet some day; stuff
json; NOTICE; software shall be used for good not evil; evil
public-domain; NOTICE; dedicated? (?:this work |it )?to the public domain; domain
public-domain; GRANT; released into the public domain; domain
public-domain; GRANT; placed (?:in|into) the public domain; domain
public-domain; NAMED; public domain (?:dedication|work|mark); domain
commercial; GRANT; commercial licen[sc]es? (?:is|are) (?:available|required); commercial
proprietary; NOTICE; proprietary and confidential(?: unauthorized copying)?; confidential
proprietary; NOTICE; unauthorized (?:copying|reproduction|use|distribution) (?:of this file |of this software )?(?:\\S+ ){0,4}strictly prohibited; prohibited
proprietary; NAMED; proprietary licen[sc]e; proprietary
proprietary; GRANT; may not be (?:reproduced|copied|distributed|redistributed|published|broadcast|rewritten)(?: or (?:\\S+) ){0,4}without (?:the )?(?:prior )?(?:express )?(?:written )?(?:permission|consent); without
proprietary; GRANT; reproduction (?:in whole or in part )?(?:without (?:written )?permission )?is (?:strictly )?(?:prohibited|forbidden); reproduction
proprietary; GRANT; no part of this (?:publication|book|work|site|website|document) may be (?:reproduced|copied|stored|transmitted|used); part
eula; NAMED; end user licen[sc]e agreement; agreement
eula; GRANT; by (?:installing|using|downloading|copying) (?:this|the) software you agree; agree
shareware; NAMED; shareware (?:licen[sc]e|version); shareware
freeware; NAMED; freeware (?:licen[sc]e|version); freeware
warranty-disclaimer; HINT; provided as is without (?:any )?warranty(?: of any kind)?; warranty
warranty-disclaimer; HINT; without warranties or conditions of any kind; warranties
warranty-disclaimer; HINT; without any warranty without even the implied warranty of merchantability; merchantability
copyright; HINT; copyright (?:c |© )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?; copyright
copyright; HINT; copyrighted (?:material|work|software); copyrighted
copyright; HINT; rights reserved; reserved
gpl; FAMILY; gnu general public licen[sc]e; gnu
gpl; FAMILY; gnu gpl; gpl
gpl; FAMILY; gpl licen[sc]ed?; gpl
lgpl; FAMILY; gnu (?:lesser|library) general public licen[sc]e; public
lgpl; FAMILY; lgpl licen[sc]ed?; lgpl
agpl; FAMILY; gnu affero general public licen[sc]e; affero
gfdl; FAMILY; gnu free documentation licen[sc]e; documentation
bsd; FAMILY; bsd (?:style )?licen[sc]e; bsd
apache; FAMILY; apache (?:software )?licen[sc]e; apache
mpl; FAMILY; mozilla public licen[sc]e; mozilla
epl; FAMILY; eclipse public licen[sc]e; eclipse
artistic; FAMILY; artistic licen[sc]e; artistic
eupl; FAMILY; european union public licen[sc]e; european
creative-commons; FAMILY; creative commons(?: public)?(?: licen[sc]e)?; commons
creative-commons; FAMILY; creativecommons org licenses; creativecommons
unknown-license; HINT; licen[sc]ed under (?:the )?(?:\\S+ ){1,6}?licen[sc]e; under
unknown-license; HINT; released under (?:the )?(?:\\S+ ){1,6}?licen[sc]e; under
unknown-license; HINT; distributed under (?:the )?(?:\\S+ ){1,6}?licen[sc]e; under
unknown-license; HINT; subject to (?:the )?(?:\\S+ ){1,6}?licen[sc]e; subject
unknown-license; HINT; see (?:the )?(?:file )?(?:licen[sc]e|copying)(?: md| txt)?(?: file)? for (?:more )?(?:details|terms|information); see
unknown-license; HINT; spdx licen[sc]e identifier; identifier
"""

# Words of the Creative Commons licenses beyond "attribution".
CC_TERMS = {
    "by": "", "by-sa": " share ?alike", "by-nd": " no ?derivat(?:ive)?s?(?: works)?", "by-nc": " non ?commercial",
    "by-nc-sa": " non ?commercial share ?alike", "by-nc-nd": " non ?commercial no ?derivat(?:ive)?s?(?: works)?",
}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# How a text puts itself under a license, as first words and what follows them.
GRANTS = (
    (("licensed", "licenced", "released", "distributed", "available", "published", "provided"), "under"),
    (("covered", "governed"), "by"),
    (("subject",), "to"),
)
_THE = "(?:the )?(?:terms (?:and conditions )?of )?(?:the )?"

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def _rows(text: str) -> list[list[str]]:
    return [[cell.strip() for cell in line.split(";")] for line in text.strip().splitlines()]


def _anchors(word: str) -> tuple[str, ...]:
    """The spellings of a signature's first word."""
    if "[sc]" in word:
        return tuple(a for letter in "sc" for a in _anchors(word.replace("[sc]", letter)))
    return (word[:-2], word[:-1]) if word.endswith("d?") else (word,)


def build_rules() -> list[Rule]:
    """Every rule, in order: identifiers, addresses, grants and names of each license, then notices."""
    rules: list[Rule] = []

    def add(label: str, priority: int, signature: str, gate: str, firsts: tuple[str, ...] = ()) -> None:
        first, _, rest = signature.partition(" ")
        anchors = firsts or _anchors(first)
        pattern = f"^(?:{'|'.join(anchors)}) " + (f"{rest} " if rest else "")
        rules.append(Rule(len(rules), label, priority, anchors, gate, pattern))

    for label, name, identifier, address in _rows(NAMES):
        gate = name.partition(" ")[0]
        if identifier != "-":
            add(label, IDENTIFIER, f"spdx licen[sc]e identifier {identifier}", "identifier")
        if address != "-":
            add(label, ADDRESS, address, address.split(" ")[1])
        for firsts, link in GRANTS:
            add(label, GRANT, f"{firsts[0]} {link} {_THE}{name}", gate, firsts)
        add(label, NAMED, name, gate)
    for terms, words in CC_TERMS.items():
        path = terms.replace("-", " ")
        for version in (*CC_VERSIONS, ""):
            digits = version.replace(".", " ")
            label, above = (f"cc-{terms}-{version}", 1) if version else (f"cc-{terms}", 0)
            number = f" (?:version |v)?{digits}" if version else ""
            add(label, NAMED + above, f"creative commons attribution{words}{number}", "attribution")
            add(label, NAMED + above, f"cc {path}{number}", "by")
            add(label, ADDRESS + above, f"creativecommons org licenses {path}{' ' + digits if version else ''}", "creativecommons")
            if version:
                add(label, IDENTIFIER, f"spdx licen[sc]e identifier cc {path} {digits}", "identifier")
    add("cc0-1.0", NAMED, "cc0 1 0(?: universal)?", "cc0")
    add("cc0-1.0", NAMED, "cc0 (?:universal|licen[sc]e|dedication)", "cc0")
    add("cc0-1.0", ADDRESS, "creativecommons org publicdomain zero 1 0", "publicdomain")
    add("cc0-1.0", IDENTIFIER, "spdx licen[sc]e identifier cc0 1 0", "identifier")
    levels = {"NOTICE": NOTICE, "GRANT": GRANT, "NAMED": NAMED, "FAMILY": FAMILY, "HINT": HINT}
    for label, level, signature, gate in _rows(NOTICES):
        add(label, levels[level], signature, gate)
    return rules


RULES = build_rules()
