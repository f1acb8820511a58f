"""Hand-written licence signatures, one rule a line: ``label | priority | keywords | pattern``.

A pattern is read over the text's lower-case words with single blanks between them ("Apache-2.0" reads ``apache 2 0``) and
must begin and end at a word.  Every keyword must be among the text's words before the pattern is tried.  Priorities: 100 a
machine-readable tag, 90 a sentence of the licence itself, 80 a notice with its version, 60 a name with its version, 40 a
bare name, 20 a mere claim of rights.
"""

from __future__ import annotations

TEXT = r"""
apache-2.0 | 100 | spdx apache | spdx license identifier apache 2 0
apache-2.0 | 90 | apache compliance | licensed under the apache license version 2 0(?: the license)? you may not use this file except in compliance
apache-2.0 | 90 | apache january | apache license version 2 0 january 2004
apache-2.0 | 90 | reproduction distribution | terms and conditions for use reproduction and distribution
apache-2.0 | 80 | apache | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?apache(?: software)? licen[sc]e(?: version)? (?:v)?2(?: 0)?
apache-2.0 | 60 | apache | apache(?: software)? licen[sc]e(?: version)? v?2(?: 0)?
apache-2.0 | 60 | apache | apache v?2 0
apache-2.0 | 60 | asl | asl v?2 0
apache-2.0 | 60 | apache | www apache org licenses license 2 0(?: html| txt)?
apache-1.1 | 90 | apache foundation | this product includes software developed by the apache software foundation
apache-1.1 | 60 | apache | apache(?: software)? licen[sc]e(?: version)? v?1 1
apache-1.0 | 60 | apache | apache(?: software)? licen[sc]e(?: version)? v?1 0
apache | 40 | apache | apache(?: software)? licen[sc]e
mit | 100 | spdx mit | spdx license identifier mit
mit | 90 | permission hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 90 | copyright liability | in no event shall the authors or copyright holders be liable for any claim damages or other liability
mit | 90 | substantial portions | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | 80 | mit | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?mit(?: x11| expat)? licen[sc]e
mit | 60 | mit | (?:the )?mit x11 licen[sc]e
mit | 60 | expat | expat licen[sc]e
mit | 60 | mit | opensource org licenses mit(?: license)?(?: php)?
mit | 40 | mit | mit licen[sc]ed?
mit | 40 | mit | licen[sc]e mit
mit-0 | 100 | spdx mit | spdx license identifier mit 0
mit-0 | 60 | mit | mit no attribution
mit-0 | 60 | mit | mit 0 licen[sc]e
x11 | 100 | spdx x11 | spdx license identifier x11
x11 | 90 | consortium | x consortium be liable for any claim
x11 | 40 | x11 | x11 licen[sc]e
isc | 100 | spdx isc | spdx license identifier isc
isc | 90 | permission fee | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
isc | 80 | isc | (?:licensed|released|distributed|available) under (?:the )?isc licen[sc]e
isc | 40 | isc | isc licen[sc]e
0bsd | 100 | spdx 0bsd | spdx license identifier 0bsd
0bsd | 60 | 0bsd | 0bsd licen[sc]e
0bsd | 60 | bsd | (?:zero|0) clause bsd(?: licen[sc]e)?
bsd-2-clause | 100 | spdx bsd | spdx license identifier bsd 2 clause
bsd-2-clause | 80 | bsd | (?:licensed|released|distributed) under (?:the )?(?:2|two) clause bsd(?: licen[sc]e)?
bsd-2-clause | 60 | bsd | (?:2|two) clause bsd(?: licen[sc]e)?
bsd-2-clause | 60 | bsd | bsd 2 clause(?: licen[sc]e)?
bsd-2-clause | 60 | simplified bsd | simplified bsd(?: licen[sc]e)?
bsd-2-clause | 60 | freebsd | freebsd licen[sc]e
bsd-3-clause | 100 | spdx bsd | spdx license identifier bsd 3 clause
bsd-3-clause | 90 | endorse promote | neither the name of(?: \S+){1,20}? nor the names of its contributors may be used to endorse or promote products
bsd-3-clause | 80 | bsd | (?:licensed|released|distributed) under (?:the )?(?:3|three) clause bsd(?: licen[sc]e)?
bsd-3-clause | 60 | bsd | (?:3|three) clause bsd(?: licen[sc]e)?
bsd-3-clause | 60 | bsd | bsd 3 clause(?: licen[sc]e)?
bsd-3-clause | 60 | bsd | (?:new|modified|revised) bsd(?: licen[sc]e)?
bsd-4-clause | 100 | spdx bsd | spdx license identifier bsd 4 clause
bsd-4-clause | 90 | advertising acknowledgement | all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd-4-clause | 60 | bsd | (?:4|four) clause bsd(?: licen[sc]e)?
bsd-4-clause | 60 | bsd | original bsd(?: licen[sc]e)?
bsd | 90 | redistributions retain | redistributions of source code must retain the above copyright notice this list of conditions
bsd | 90 | redistributions binary | redistributions in binary form must reproduce the above copyright notice
bsd | 80 | bsd | (?:licensed|released|distributed) under (?:the )?bsd licen[sc]e
bsd | 40 | bsd | bsd(?: style)? licen[sc]ed?
gpl-1.0 | 100 | spdx gpl | spdx license identifier gpl 1 0(?: only| or later)?
gpl-1.0 | 60 | general public | gnu general public licen[sc]e version 1(?: 0)?
gpl-2.0 | 100 | spdx gpl | spdx license identifier gpl 2 0(?: only| or later)?
gpl-2.0 | 90 | general public june | gnu general public licen[sc]e version 2 june 1991
gpl-2.0 | 80 | general public | (?:licensed|released|distributed) under the(?: terms of the)? gnu general public licen[sc]e version 2(?: 0)?
gpl-2.0 | 80 | general public | gnu general public licen[sc]e(?: as published by the free software foundation)? (?:either )?version 2(?: of the licen[sc]e)?
gpl-2.0 | 80 | general public | version 2 of the gnu general public licen[sc]e
gpl-2.0 | 60 | gplv2 | gplv2
gpl-2.0 | 60 | gpl | (?:gnu )?gpl(?: version)? v?2(?: 0)?
gpl-2.0-or-later | 100 | spdx gpl later | spdx license identifier gpl 2 0 or later
gpl-2.0-or-later | 90 | general public later | general public licen[sc]e as published by the free software foundation either version 2 of the licen[sc]e or at your option any later version
gpl-2.0-or-later | 80 | general public later | general public licen[sc]e version 2 or (?:at your option )?any later version
gpl-3.0 | 100 | spdx gpl | spdx license identifier gpl 3 0(?: only| or later)?
gpl-3.0 | 90 | general public june | gnu general public licen[sc]e version 3 29 june 2007
gpl-3.0 | 80 | general public | (?:licensed|released|distributed) under the(?: terms of the)? gnu general public licen[sc]e version 3(?: 0)?
gpl-3.0 | 80 | general public | gnu general public licen[sc]e(?: as published by the free software foundation)? (?:either )?version 3(?: of the licen[sc]e)?
gpl-3.0 | 80 | general public | version 3 of the gnu general public licen[sc]e
gpl-3.0 | 60 | gplv3 | gplv3
gpl-3.0 | 60 | gpl | (?:gnu )?gpl(?: version)? v?3(?: 0)?
gpl-3.0-or-later | 100 | spdx gpl later | spdx license identifier gpl 3 0 or later
gpl-3.0-or-later | 90 | general public later | general public licen[sc]e as published by the free software foundation either version 3 of the licen[sc]e or at your option any later version
gpl-3.0-or-later | 80 | general public later | general public licen[sc]e version 3 or (?:at your option )?any later version
gpl | 90 | general public received | you should have received a copy of the gnu general public licen[sc]e along with this program
gpl | 40 | general public | gnu general public licen[sc]e
gpl | 40 | gpl | gnu gpl
gpl | 40 | gpl | gpl licen[sc]ed?
gpl-classpath-exception | 90 | classpath exception | gpl (?:v?2(?: 0)? )?with(?: the)? classpath exception
gpl-classpath-exception | 90 | independent modules | as a special exception the copyright holders of this library give you permission to link this library with independent modules
agpl-3.0 | 100 | spdx agpl | spdx license identifier agpl 3 0(?: only| or later)?
agpl-3.0 | 90 | affero november | gnu affero general public licen[sc]e version 3 19 november 2007
agpl-3.0 | 80 | affero | gnu affero general public licen[sc]e(?: as published by the free software foundation)? (?:either )?version 3(?: of the licen[sc]e)?
agpl-3.0 | 60 | agplv3 | agplv3
agpl-3.0 | 60 | agpl | (?:gnu )?agpl(?: version)? v?3(?: 0)?
agpl-1.0 | 60 | affero | affero general public licen[sc]e version 1(?: 0)?
agpl | 40 | affero | (?:gnu )?affero general public licen[sc]e
agpl | 40 | affero | affero gpl
lgpl-2.0 | 100 | spdx lgpl | spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.0 | 80 | library public | gnu library general public licen[sc]e(?: version 2(?: 0)?)?
lgpl-2.1 | 100 | spdx lgpl | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-2.1 | 90 | lesser february | gnu lesser general public licen[sc]e version 2 1 february 1999
lgpl-2.1 | 80 | lesser | gnu lesser general public licen[sc]e(?: as published by the free software foundation)? (?:either )?version 2 1(?: of the licen[sc]e)?
lgpl-2.1 | 60 | lgpl | (?:gnu )?lgpl(?: version)? v?2 1
lgpl-3.0 | 100 | spdx lgpl | spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-3.0 | 90 | lesser june | gnu lesser general public licen[sc]e version 3 29 june 2007
lgpl-3.0 | 80 | lesser | gnu lesser general public licen[sc]e(?: as published by the free software foundation)? (?:either )?version 3(?: of the licen[sc]e)?
lgpl-3.0 | 60 | lgplv3 | lgplv3
lgpl-3.0 | 60 | lgpl | (?:gnu )?lgpl(?: version)? v?3(?: 0)?
lgpl | 40 | lesser | gnu lesser general public licen[sc]e
lgpl | 40 | lgpl | lgpl licen[sc]ed?
gfdl-1.1 | 100 | spdx gfdl | spdx license identifier gfdl 1 1(?: only| or later)?
gfdl-1.2 | 100 | spdx gfdl | spdx license identifier gfdl 1 2(?: only| or later)?
gfdl-1.2 | 80 | documentation free | gnu free documentation licen[sc]e version 1 2
gfdl-1.3 | 100 | spdx gfdl | spdx license identifier gfdl 1 3(?: only| or later)?
gfdl-1.3 | 80 | documentation free | gnu free documentation licen[sc]e version 1 3
gfdl | 90 | invariant | with no invariant sections no front cover texts and no back cover texts
gfdl | 40 | documentation free | gnu free documentation licen[sc]e
gfdl | 40 | gfdl | gfdl
mpl-1.0 | 60 | mozilla | mozilla public licen[sc]e version 1 0
mpl-1.1 | 100 | spdx mpl | spdx license identifier mpl 1 1
mpl-1.1 | 90 | mozilla contents | the contents of this file are subject to the mozilla public licen[sc]e version 1 1
mpl-1.1 | 60 | mozilla | mozilla public licen[sc]e version 1 1
mpl-1.1 | 60 | mpl | mpl(?: version)? v?1 1
mpl-2.0 | 100 | spdx mpl | spdx license identifier mpl 2 0
mpl-2.0 | 90 | mozilla form | this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0
mpl-2.0 | 60 | mozilla | mozilla public licen[sc]e(?: version)? v? ?2 0
mpl-2.0 | 60 | mpl | mpl(?: version)? v?2 0
mpl | 40 | mozilla | mozilla public licen[sc]e
epl-1.0 | 100 | spdx epl | spdx license identifier epl 1 0
epl-1.0 | 60 | eclipse | eclipse public licen[sc]e(?: version)? v? ?1 0
epl-2.0 | 100 | spdx epl | spdx license identifier epl 2 0
epl-2.0 | 90 | eclipse accompanying | this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e(?: v)? 2 0
epl-2.0 | 60 | eclipse | eclipse public licen[sc]e(?: version)? v? ?2 0
epl | 40 | eclipse | eclipse public licen[sc]e
edl-1.0 | 60 | eclipse | eclipse distribution licen[sc]e(?: version)? v? ?1 0
cpl-1.0 | 60 | common public | common public licen[sc]e(?: version)? v? ?1 0
ipl-1.0 | 60 | ibm | ibm public licen[sc]e(?: version)? v? ?1 0
cddl-1.0 | 100 | spdx cddl | spdx license identifier cddl 1 0
cddl-1.0 | 60 | common development | common development and distribution licen[sc]e(?: cddl)?(?: version)? v? ?1 0
cddl-1.1 | 60 | common development | common development and distribution licen[sc]e(?: cddl)?(?: version)? v? ?1 1
cddl | 40 | common development | common development and distribution licen[sc]e
eupl-1.1 | 60 | european union | european union public licen[sc]e(?: version)? v? ?1 1
eupl-1.2 | 100 | spdx eupl | spdx license identifier eupl 1 2
eupl-1.2 | 60 | european union | european union public licen[sc]e(?: version)? v? ?1 2
eupl-1.2 | 60 | eupl | eupl(?: version)? v? ?1 2
eupl | 40 | european union | european union public licen[sc]e
cc0-1.0 | 100 | spdx cc0 | spdx license identifier cc0 1 0
cc0-1.0 | 90 | neighboring waived | to the extent possible under law(?: \S+){1,20}? (?:has|have) waived all copyright and related or neighboring rights
cc0-1.0 | 80 | cc0 | cc0 1 0(?: universal)?(?: public domain dedication)?
cc0-1.0 | 60 | commons zero | creative commons zero(?: v?1 0)?
cc0-1.0 | 60 | publicdomain | creativecommons org publicdomain zero 1 0
cc0-1.0 | 40 | cc0 | cc0
cc-by-1.0 | 60 | cc by | cc by 1 0
cc-by-2.0 | 60 | cc by | cc by 2 0
cc-by-2.5 | 60 | cc by | cc by 2 5
cc-by-3.0 | 60 | cc by | cc by 3 0
cc-by-4.0 | 100 | spdx cc by | spdx license identifier cc by 4 0
cc-by-4.0 | 60 | cc by | cc by 4 0
cc-by-4.0 | 60 | creativecommons by | creativecommons org licenses by 4 0
cc-by-3.0 | 60 | creativecommons by | creativecommons org licenses by 3 0
cc-by-4.0 | 80 | commons attribution | creative commons attribution 4 0(?: international)?(?: public)?(?: licen[sc]e)?
cc-by-3.0 | 80 | commons attribution | creative commons attribution 3 0(?: unported)?(?: licen[sc]e)?
cc-by | 40 | commons attribution | creative commons attribution(?: licen[sc]e)?
cc-by-sa-2.0 | 60 | cc by sa | cc by sa 2 0
cc-by-sa-2.5 | 60 | cc by sa | cc by sa 2 5
cc-by-sa-3.0 | 60 | cc by sa | cc by sa 3 0
cc-by-sa-4.0 | 100 | spdx cc sa | spdx license identifier cc by sa 4 0
cc-by-sa-4.0 | 60 | cc by sa | cc by sa 4 0
cc-by-sa-4.0 | 60 | creativecommons sa | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | 60 | creativecommons sa | creativecommons org licenses by sa 3 0
cc-by-sa-4.0 | 80 | commons sharealike | creative commons attribution sharealike 4 0(?: international)?(?: licen[sc]e)?
cc-by-sa-3.0 | 80 | commons sharealike | creative commons attribution sharealike 3 0(?: unported)?(?: licen[sc]e)?
cc-by-sa | 60 | cc by sa | cc by sa
cc-by-sa | 60 | commons attribution | creative commons attribution share ?alike
cc-by-nc-2.0 | 60 | cc by nc | cc by nc 2 0
cc-by-nc-3.0 | 60 | cc by nc | cc by nc 3 0
cc-by-nc-4.0 | 100 | spdx cc nc | spdx license identifier cc by nc 4 0
cc-by-nc-4.0 | 60 | cc by nc | cc by nc 4 0
cc-by-nc-4.0 | 60 | creativecommons nc | creativecommons org licenses by nc 4 0
cc-by-nc-4.0 | 80 | commons attribution | creative commons attribution non ?commercial 4 0(?: international)?(?: licen[sc]e)?
cc-by-nc | 50 | cc by nc | cc by nc
cc-by-nc | 50 | commons attribution | creative commons attribution non ?commercial
cc-by-nd-4.0 | 60 | cc by nd | cc by nd 4 0
cc-by-nd-3.0 | 60 | cc by nd | cc by nd 3 0
cc-by-nd | 50 | cc by nd | cc by nd
cc-by-nd | 50 | commons attribution | creative commons attribution no ?derivatives
cc-by-nc-sa-3.0 | 70 | cc nc sa | cc by nc sa 3 0
cc-by-nc-sa-4.0 | 100 | spdx cc nc sa | spdx license identifier cc by nc sa 4 0
cc-by-nc-sa-4.0 | 70 | cc nc sa | cc by nc sa 4 0
cc-by-nc-sa-4.0 | 80 | commons attribution | creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: licen[sc]e)?
cc-by-nc-sa | 60 | cc nc sa | cc by nc sa
cc-by-nc-sa | 60 | commons attribution | creative commons attribution non ?commercial share ?alike
cc-by-nc-nd-3.0 | 70 | cc nc nd | cc by nc nd 3 0
cc-by-nc-nd-4.0 | 100 | spdx cc nc nd | spdx license identifier cc by nc nd 4 0
cc-by-nc-nd-4.0 | 70 | cc nc nd | cc by nc nd 4 0
cc-by-nc-nd | 60 | cc nc nd | cc by nc nd
cc-by-nc-nd | 60 | commons attribution | creative commons attribution non ?commercial no ?derivatives
cc | 30 | commons | (?:licensed|released|available|published) under (?:a |the )?creative commons licen[sc]e
cc | 30 | commons | creative commons licen[sc]e
unlicense | 100 | spdx unlicense | spdx license identifier unlicense
unlicense | 90 | unencumbered | this is free and unencumbered software released into the public domain
unlicense | 40 | unlicense | (?:the )?unlicense
wtfpl | 100 | spdx wtfpl | spdx license identifier wtfpl
wtfpl | 90 | fuck public | do what the fuck you want to public licen[sc]e
wtfpl | 40 | wtfpl | wtfpl
zlib | 100 | spdx zlib | spdx license identifier zlib
zlib | 90 | misrepresented origin | the origin of this software must not be misrepresented
zlib | 90 | altered plainly | altered source versions must be plainly marked as such
zlib | 40 | zlib | zlib(?: libpng)? licen[sc]e
libpng | 40 | libpng | libpng licen[sc]e
boost-1.0 | 100 | spdx bsl | spdx license identifier bsl 1 0
boost-1.0 | 90 | boost august | boost software licen[sc]e version 1 0 august 17th 2003
boost-1.0 | 60 | boost | boost software licen[sc]e(?: version)? v? ?1 0
boost | 40 | boost | boost(?: software)? licen[sc]e
artistic-1.0 | 60 | artistic | artistic licen[sc]e(?: version)? v? ?1 0
artistic-2.0 | 100 | spdx artistic | spdx license identifier artistic 2 0
artistic-2.0 | 60 | artistic | artistic licen[sc]e(?: version)? v? ?2 0
artistic | 40 | artistic | artistic licen[sc]e
perl | 60 | perl | same terms as perl(?: \S+)? itself
python-2.0 | 60 | python | python software foundation licen[sc]e(?: version 2)?
python-2.0 | 40 | psf | psf licen[sc]e
ruby | 40 | ruby | ruby licen[sc]e
php-3.01 | 60 | php | php licen[sc]e(?: version)? v? ?3 01
php | 40 | php | php licen[sc]e
postgresql | 60 | postgresql | postgresql licen[sc]e
openssl | 90 | openssl | this product includes software developed by the openssl project
openssl | 40 | openssl | openssl licen[sc]e
openldap | 40 | openldap | openldap public licen[sc]e
curl | 40 | curl | curl licen[sc]e
icu | 40 | icu | icu licen[sc]e
unicode | 60 | unicode | unicode licen[sc]e(?: agreement)?(?: v3)?
w3c | 60 | w3c | w3c software(?: and document)?(?: notice and)? licen[sc]e
vim | 40 | vim | vim licen[sc]e
ncsa | 60 | ncsa | (?:university of illinois )?ncsa(?: open source)? licen[sc]e
afl-3.0 | 60 | academic | academic free licen[sc]e(?: version)? v? ?3 0
afl | 40 | academic | academic free licen[sc]e
osl-3.0 | 60 | open software | open software licen[sc]e(?: version)? v? ?3 0
ecl-2.0 | 60 | educational | educational community licen[sc]e(?: version)? v? ?2 0
ms-pl | 60 | microsoft | microsoft public licen[sc]e
ms-rl | 60 | microsoft | microsoft reciprocal licen[sc]e
ofl-1.1 | 100 | spdx ofl | spdx license identifier ofl 1 1
ofl-1.1 | 90 | sil font | this font software is licensed under the sil open font licen[sc]e
ofl-1.1 | 60 | sil | sil open font licen[sc]e(?: version)? v? ?1 1
ofl | 40 | sil | sil open font licen[sc]e
odbl-1.0 | 60 | open database | open (?:data commons open )?database licen[sc]e(?: version)? v? ?1 0
odbl | 40 | open database | open (?:data commons open )?database licen[sc]e
odc-by | 60 | commons attribution data | open data commons attribution licen[sc]e
pddl | 60 | public domain dedication data | open data commons public domain dedication and licen[sc]e
ogl-uk | 60 | open government | open government licen[sc]e(?: v? ?[123] 0)?
cdla-permissive | 60 | community data | community data licen[sc]e agreement permissive
cdla-sharing | 60 | community data | community data licen[sc]e agreement sharing
llama | 60 | llama community | llama [23](?: \d)? community licen[sc]e
openrail | 60 | openrail | (?:creativeml |bigscience |bigcode )?openrail(?: m)?(?: licen[sc]e)?
openrail | 60 | rail | (?:creativeml |bigscience |bigcode )?open rail(?: m)?(?: licen[sc]e)
bigscience-rail | 60 | responsible ai | responsible ai licen[sc]e
elastic-2.0 | 60 | elastic | elastic licen[sc]e(?: version)? v? ?2(?: 0)?
sspl-1.0 | 60 | server side | server side public licen[sc]e(?: version)?(?: v? ?1)?
busl-1.1 | 60 | business | business source licen[sc]e(?: version)?(?: v? ?1 1)?
commons-clause | 60 | commons clause | commons clause(?: licen[sc]e)? condition(?: v1 0)?
polyform-nc | 60 | polyform | polyform non ?commercial licen[sc]e
json | 90 | good evil | the software shall be used for good not evil
beerware | 60 | beer | the beer ware licen[sc]e
upl-1.0 | 60 | universal permissive | universal permissive licen[sc]e(?: v? ?1 0)?
bsl-hippocratic | 60 | hippocratic | hippocratic licen[sc]e
blueoak-1.0 | 60 | blue oak | blue oak model licen[sc]e
sleepycat | 40 | sleepycat | sleepycat licen[sc]e
qpl-1.0 | 60 | q public | q public licen[sc]e(?: version 1 0)?
naist | 40 | nara | nara institute of science and technology
zpl-2.1 | 60 | zope | zope public licen[sc]e(?: zpl)?(?: version 2 1)?
tcl | 40 | tcl | tcl tk licen[sc]e
imagemagick | 40 | imagemagick | imagemagick licen[sc]e
cecill-2.1 | 60 | cecill | cecill(?: free software licen[sc]e agreement)?(?: version)?(?: 2 1)?
mulan-2.0 | 60 | mulan | mulan permissive software licen[sc]e(?: version 2)?
nasa-1.3 | 60 | nasa | nasa open source agreement(?: version 1 3)?
public-domain | 60 | public domain | (?:released|placed|dedicated|put) (?:in|into|to) the public domain
public-domain | 40 | public domain | (?:this (?:work|file|code|text) is )?in the public domain
public-domain | 40 | public domain | public domain dedication
copyright | 20 | copyright | copyright(?: c| ©)? (?:19|20)\d\d(?: (?:19|20)\d\d)?
copyright | 20 | © | © (?:19|20)\d\d
copyright | 20 | copyright | copyright notice
warranty-disclaimer | 30 | without kind | without (?:any )?warrant(?:y|ies) (?:or conditions )?of any kind
warranty-disclaimer | 30 | warranties merchantability | implied warranties of merchantability(?: and| or)? fitness for a particular purpose
proprietary | 50 | confidential proprietary | proprietary and confidential
proprietary | 50 | unauthorized copying | unauthorized (?:copying|reproduction|distribution) of this (?:file|document|work|text)
proprietary | 50 | reproduced part | no part of this (?:publication|book|work|document) may be reproduced
non-commercial | 30 | commercial | (?:for )?non commercial (?:use|purposes) only
personal-use | 30 | personal | for personal use only
no-derivatives | 30 | derivative | no derivative works? (?:are )?(?:permitted|allowed)
terms-of-use | 20 | terms | subject to (?:the|our) terms of (?:use|service)
"""

#: Phrases that count as places of their own, whatever surrounds them (phrase -> label, priority).
BASE = {"cc by": ("cc-by", 40), "general public license": ("gpl", 30), "all rights reserved": ("reserved", 20)}


def rules() -> list[tuple[str, int, frozenset[str], str]]:
    """(label, priority, keywords, pattern) of every line, in order."""
    out = []
    for line in TEXT.strip().splitlines():
        label, priority, words, pattern = (x.strip() for x in line.split("|", 3))
        out.append((label, int(priority), frozenset(words.split()), pattern))
    return out
