"""Signature rules of the license scan, written by hand.

One rule a line: ``label | priority | gate words | pattern``. Patterns are
regular expressions over a text's words in lower case, one blank between
words (so "CC-BY 4.0" reads "cc by 4 0"); a match starts and ends at word
borders. A rule is tried only where all its gate words occur in the text, so
a gate holds only words that every match of its pattern contains.
``#`` starts a comment. Priorities: 90 machine-readable tags, 70 notices
that name license and version, 60 titles with version, 50 titles, 40 URLs,
30 short names, 20 phrases quoted from a license's body, 10 general hints.
"""

RULES = r"""
# Machine-readable tags
mit | 90 | spdx mit | spdx license identifier mit
mit-0 | 91 | spdx mit | spdx license identifier mit 0
apache-2.0 | 90 | spdx apache | spdx license identifier apache 2 0
apache-1.1 | 90 | spdx apache | spdx license identifier apache 1 1
gpl-2.0-only | 90 | spdx gpl | spdx license identifier gpl 2 0(?: only)?
gpl-2.0-or-later | 91 | spdx gpl | spdx license identifier gpl 2 0 or later
gpl-3.0-only | 90 | spdx gpl | spdx license identifier gpl 3 0(?: only)?
gpl-3.0-or-later | 91 | spdx gpl | spdx license identifier gpl 3 0 or later
lgpl-2.1-only | 90 | spdx lgpl | spdx license identifier lgpl 2 1(?: only)?
lgpl-2.1-or-later | 91 | spdx lgpl | spdx license identifier lgpl 2 1 or later
lgpl-3.0-only | 90 | spdx lgpl | spdx license identifier lgpl 3 0(?: only)?
lgpl-3.0-or-later | 91 | spdx lgpl | spdx license identifier lgpl 3 0 or later
agpl-3.0-only | 90 | spdx agpl | spdx license identifier agpl 3 0(?: only)?
agpl-3.0-or-later | 91 | spdx agpl | spdx license identifier agpl 3 0 or later
bsd-2-clause | 90 | spdx bsd | spdx license identifier bsd 2 clause
bsd-3-clause | 90 | spdx bsd | spdx license identifier bsd 3 clause
bsd-4-clause | 90 | spdx bsd | spdx license identifier bsd 4 clause
0bsd | 90 | spdx 0bsd | spdx license identifier 0bsd
mpl-2.0 | 90 | spdx mpl | spdx license identifier mpl 2 0
mpl-1.1 | 90 | spdx mpl | spdx license identifier mpl 1 1
epl-1.0 | 90 | spdx epl | spdx license identifier epl 1 0
epl-2.0 | 90 | spdx epl | spdx license identifier epl 2 0
cddl-1.0 | 90 | spdx cddl | spdx license identifier cddl 1 0
isc | 90 | spdx isc | spdx license identifier isc
unlicense | 90 | spdx unlicense | spdx license identifier unlicense
zlib | 90 | spdx zlib | spdx license identifier zlib
bsl-1.0 | 90 | spdx bsl | spdx license identifier bsl 1 0
wtfpl | 90 | spdx wtfpl | spdx license identifier wtfpl
artistic-2.0 | 90 | spdx artistic | spdx license identifier artistic 2 0
eupl-1.2 | 90 | spdx eupl | spdx license identifier eupl 1 2
cc0-1.0 | 90 | spdx cc0 | spdx license identifier cc0 1 0
cc-by-4.0 | 90 | spdx cc by | spdx license identifier cc by 4 0
cc-by-sa-4.0 | 90 | spdx cc sa | spdx license identifier cc by sa 4 0
ofl-1.1 | 90 | spdx ofl | spdx license identifier ofl 1 1
postgresql | 90 | spdx postgresql | spdx license identifier postgresql
python-2.0 | 90 | spdx identifier 2 | spdx license identifier (?:python|psf) 2 0
busl-1.1 | 90 | spdx busl | spdx license identifier busl 1 1
sspl-1.0 | 90 | spdx sspl | spdx license identifier sspl 1 0

# Creative Commons: deeds and short names with elements and versions
cc-by-4.0 | 70 | cc by 4 | (?:licen[sc]ed under |under )?(?:the )?cc by 4 0
cc-by-3.0 | 70 | cc by 3 | (?:licen[sc]ed under |under )?(?:the )?cc by 3 0
cc-by-2.0 | 70 | cc by 2 | (?:licen[sc]ed under |under )?(?:the )?cc by 2 0
cc-by-2.5 | 70 | cc by 5 | (?:licen[sc]ed under |under )?(?:the )?cc by 2 5
cc-by-sa-4.0 | 70 | cc by sa 4 | (?:licen[sc]ed under |under )?(?:the )?cc by sa 4 0
cc-by-sa-3.0 | 70 | cc by sa 3 | (?:licen[sc]ed under |under )?(?:the )?cc by sa 3 0
cc-by-sa-2.0 | 70 | cc by sa 2 | (?:licen[sc]ed under |under )?(?:the )?cc by sa 2 0
cc-by-nc-4.0 | 70 | cc by nc 4 | (?:licen[sc]ed under |under )?(?:the )?cc by nc 4 0
cc-by-nc-3.0 | 70 | cc by nc 3 | (?:licen[sc]ed under |under )?(?:the )?cc by nc 3 0
cc-by-nc-2.0 | 70 | cc by nc 2 | (?:licen[sc]ed under |under )?(?:the )?cc by nc 2 0
cc-by-nd-4.0 | 70 | cc by nd 4 | (?:licen[sc]ed under |under )?(?:the )?cc by nd 4 0
cc-by-nd-3.0 | 70 | cc by nd 3 | (?:licen[sc]ed under |under )?(?:the )?cc by nd 3 0
cc-by-nc-sa-4.0 | 70 | cc nc sa 4 | (?:licen[sc]ed under |under )?(?:the )?cc by nc sa 4 0
cc-by-nc-sa-3.0 | 70 | cc nc sa 3 | (?:licen[sc]ed under |under )?(?:the )?cc by nc sa 3 0
cc-by-nc-sa-2.0 | 70 | cc nc sa 2 | (?:licen[sc]ed under |under )?(?:the )?cc by nc sa 2 0
cc-by-nc-nd-4.0 | 70 | cc nc nd 4 | (?:licen[sc]ed under |under )?(?:the )?cc by nc nd 4 0
cc-by-nc-nd-3.0 | 70 | cc nc nd 3 | (?:licen[sc]ed under |under )?(?:the )?cc by nc nd 3 0
cc-by-sa | 60 | cc by sa | cc by sa
cc-by-nc | 60 | cc by nc | cc by nc
cc-by-nd | 60 | cc by nd | cc by nd
cc-by-nc-sa | 61 | cc by nc sa | cc by nc sa
cc-by-nc-nd | 61 | cc by nc nd | cc by nc nd
cc0-1.0 | 70 | cc0 | cc0 (?:version )?1 0(?: universal)?
cc0-1.0 | 60 | zero | (?:creative commons|cc) zero(?: 1 0)?
cc0-1.0 | 30 | cc0 | cc0
cc-by-4.0 | 70 | creative attribution 4 | creative commons attribution 4 0(?: international)?(?: (?:public )?licen[sc]e)?
cc-by-3.0 | 70 | creative attribution 3 | creative commons attribution 3 0(?: unported)?(?: (?:public )?licen[sc]e)?
cc-by-sa-4.0 | 70 | creative sharealike 4 | creative commons attribution sharealike 4 0(?: international)?(?: (?:public )?licen[sc]e)?
cc-by-sa-3.0 | 70 | creative sharealike 3 | creative commons attribution sharealike 3 0(?: unported)?(?: (?:public )?licen[sc]e)?
cc-by-sa-4.0 | 70 | creative share alike 4 | creative commons attribution share alike 4 0(?: international)?(?: (?:public )?licen[sc]e)?
cc-by-nc-4.0 | 70 | creative noncommercial 4 | creative commons attribution noncommercial 4 0(?: international)?(?: (?:public )?licen[sc]e)?
cc-by-nc-4.0 | 70 | creative non commercial 4 | creative commons attribution non commercial 4 0(?: international)?(?: (?:public )?licen[sc]e)?
cc-by-nc-sa-4.0 | 71 | creative noncommercial sharealike 4 | creative commons attribution noncommercial sharealike 4 0(?: international)?(?: (?:public )?licen[sc]e)?
cc-by-nc-nd-4.0 | 71 | creative noncommercial noderivatives 4 | creative commons attribution noncommercial noderivatives 4 0(?: international)?(?: (?:public )?licen[sc]e)?
cc-by-nd-4.0 | 70 | creative noderivatives 4 | creative commons attribution noderivatives 4 0(?: international)?(?: (?:public )?licen[sc]e)?
cc-by | 50 | creative attribution | creative commons attribution(?: licen[sc]e)?
cc-by-4.0 | 40 | creativecommons by 4 | creativecommons org licen[sc]es by 4 0
cc-by-3.0 | 40 | creativecommons by 3 | creativecommons org licen[sc]es by 3 0
cc-by-sa-4.0 | 41 | creativecommons sa 4 | creativecommons org licen[sc]es by sa 4 0
cc-by-sa-3.0 | 41 | creativecommons sa 3 | creativecommons org licen[sc]es by sa 3 0
cc-by-nc-4.0 | 41 | creativecommons nc 4 | creativecommons org licen[sc]es by nc 4 0
cc-by-nc-sa-4.0 | 42 | creativecommons nc sa 4 | creativecommons org licen[sc]es by nc sa 4 0
cc-by-nc-nd-4.0 | 42 | creativecommons nc nd 4 | creativecommons org licen[sc]es by nc nd 4 0
cc0-1.0 | 40 | creativecommons zero | creativecommons org publicdomain zero 1 0
cc-pdm-1.0 | 40 | creativecommons mark | creativecommons org publicdomain mark 1 0
cc | 30 | creative commons | creative commons

# GNU licenses
gpl-3.0 | 70 | gnu general public 3 | gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version|v) 3(?: 0)?
gpl-2.0 | 70 | gnu general public 2 | gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version|v) 2(?: 0)?
gpl-1.0 | 70 | gnu general public 1 | gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version|v) 1(?: 0)?
gpl-3.0-or-later | 72 | gnu general public 3 later | gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version|v) 3(?: 0)?(?: of the licen[sc]e)? or (?:at your option )?any later version
gpl-2.0-or-later | 72 | gnu general public 2 later | gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version|v) 2(?: 0)?(?: of the licen[sc]e)? or (?:at your option )?any later version
gpl | 50 | gnu general public | gnu general public licen[sc]e
gpl-3.0 | 60 | gplv3 | gplv3
gpl-3.0-or-later | 62 | gplv3 later | gplv3 or (?:any )?later
gpl-2.0 | 60 | gplv2 | gplv2
gpl-2.0-or-later | 62 | gplv2 later | gplv2 or (?:any )?later
gpl-3.0 | 60 | gpl 3 | gpl (?:v )?3(?: 0)?
gpl-2.0 | 60 | gpl 2 | gpl (?:v )?2(?: 0)?
gpl-3.0 | 60 | gpl v3 | gpl v3
gpl-2.0 | 60 | gpl v2 | gpl v2
gpl-3.0 | 60 | gpl version 3 | gpl version 3
gpl-2.0 | 60 | gpl version 2 | gpl version 2
gpl | 30 | gpl | gpl
gpl | 30 | gpled | gpled
gpl | 40 | gnu org gpl | gnu org (?:licen[sc]es|copyleft) gpl(?: \d(?: \d)?)?(?: html)?
lgpl-3.0 | 70 | lesser general public 3 | (?:gnu )?lesser general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version|v) 3(?: 0)?
lgpl-2.1 | 70 | lesser general public 2 | (?:gnu )?lesser general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version|v) 2 1
lgpl-2.0 | 70 | library general public 2 | (?:gnu )?library general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version|v) 2(?: 0)?
lgpl | 55 | lesser general public | (?:gnu )?lesser general public licen[sc]e
lgpl | 55 | library general public | (?:gnu )?library general public licen[sc]e
lgpl-3.0 | 60 | lgplv3 | lgplv3
lgpl-2.1 | 60 | lgpl 2 1 | lgpl (?:v |version )?2 1
lgpl-3.0 | 60 | lgpl 3 | lgpl (?:v |version )?3(?: 0)?
lgpl | 30 | lgpl | lgpl
agpl-3.0 | 70 | affero general public 3 | (?:gnu )?affero general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version|v) 3(?: 0)?
agpl | 55 | affero general public | (?:gnu )?affero general public licen[sc]e
agpl-3.0 | 60 | agplv3 | agplv3
agpl-3.0 | 60 | agpl 3 | agpl (?:v |version )?3(?: 0)?
agpl | 30 | agpl | agpl
gfdl-1.3 | 70 | free documentation 1 3 | (?:gnu )?free documentation licen[sc]e (?:version )?1 3
gfdl-1.2 | 70 | free documentation 1 2 | (?:gnu )?free documentation licen[sc]e (?:version )?1 2
gfdl | 55 | gnu free documentation | gnu free documentation licen[sc]e
gfdl | 30 | gfdl | gfdl
classpath-exception | 70 | classpath exception | classpath exception(?: 2 0)?

# Permissive families
mit | 70 | mit released | released under the mit licen[sc]e
mit | 70 | mit under | (?:licen[sc]ed|distributed|available|provided) under (?:the )?(?:terms of the )?mit licen[sc]e
mit | 50 | mit | (?:the )?mit licen[sc]e
mit | 50 | expat | (?:the )?expat licen[sc]e
mit | 50 | x11 | (?:the )?x11 licen[sc]e
mit | 40 | opensource mit | opensource org licen[sc]es mit(?: licen[sc]e)?(?: php| html)?
mit | 20 | permission hereby granted charge obtaining | permission is hereby granted free of charge to any person obtaining a copy of this software
mit-0 | 60 | mit attribution | mit no attribution(?: licen[sc]e)?
apache-2.0 | 72 | apache under version 2 | licen[sc]ed under the apache licen[sc]e version 2 0
apache-2.0 | 70 | apache 2 | apache (?:software )?licen[sc]e (?:version |v )2(?: 0)?
apache-2.0 | 60 | apache 2 | apache (?:licen[sc]e |software licen[sc]e )?2(?: 0)?(?: licen[sc]e)?
apache-2.0 | 60 | apache v2 | apache (?:licen[sc]e )?v2(?: 0)?
apache-1.1 | 70 | apache 1 | apache (?:software )?licen[sc]e (?:version |v )?1 1
apache-1.0 | 70 | apache 1 0 | apache (?:software )?licen[sc]e (?:version |v )?1 0
apache | 50 | apache | apache (?:software )?licen[sc]e
apache-2.0 | 40 | apache org 2 | apache org licen[sc]es licen[sc]e 2 0(?: txt| html)?
apache-2.0 | 20 | unless applicable basis | unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis
bsd-2-clause | 70 | bsd 2 | (?:the )?bsd 2 clause(?: licen[sc]e)?
bsd-3-clause | 70 | bsd 3 | (?:the )?bsd 3 clause(?: licen[sc]e)?
bsd-4-clause | 70 | bsd 4 | (?:the )?bsd 4 clause(?: licen[sc]e)?
bsd-2-clause | 70 | bsd clause | (?:two|2) clause bsd(?: licen[sc]e)?
bsd-3-clause | 70 | bsd clause | (?:three|3) clause bsd(?: licen[sc]e)?
bsd-4-clause | 70 | bsd clause | (?:four|4) clause bsd(?: licen[sc]e)?
bsd-2-clause | 60 | bsd simplified | simplified bsd(?: licen[sc]e)?
bsd-2-clause | 60 | freebsd | freebsd licen[sc]e
bsd-3-clause | 60 | bsd | (?:new|revised|modified) bsd(?: licen[sc]e)?
bsd-3-clause-clear | 70 | bsd clear | clear bsd(?: licen[sc]e)?
0bsd | 70 | bsd zero | (?:bsd zero clause|zero clause bsd)(?: licen[sc]e)?
0bsd | 30 | 0bsd | 0bsd
bsd | 50 | bsd | (?:the )?bsd (?:style )?licen[sc]e
bsd | 20 | redistribution binary | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | 20 | endorse promote | may be used to endorse or promote products derived from this software without specific prior written permission
isc | 50 | isc | (?:the )?isc licen[sc]e
isc | 20 | copy modify distribute fee | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
zlib | 50 | zlib | (?:the )?zlib(?: libpng)? licen[sc]e
zlib | 20 | authors held liable | in no event will the authors be held liable for any damages arising from the use of this software
libpng | 50 | libpng | (?:the )?libpng licen[sc]e
bsl-1.0 | 70 | boost 1 | boost software licen[sc]e (?:version )?1 0
bsl-1.0 | 50 | boost | boost software licen[sc]e
unlicense | 50 | unlicense | (?:the )?unlicense
unlicense | 20 | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | 30 | wtfpl | wtfpl
ncsa | 60 | ncsa | (?:university of illinois )?ncsa open source licen[sc]e
artistic-2.0 | 70 | artistic 2 | artistic licen[sc]e (?:version )?2 0
artistic-1.0 | 70 | artistic 1 | artistic licen[sc]e (?:version )?1 0
artistic | 50 | artistic | (?:the )?artistic licen[sc]e
postgresql | 50 | postgresql | postgresql licen[sc]e
python-2.0 | 60 | python software foundation | python software foundation licen[sc]e(?: (?:version )?2)?
python-2.0 | 60 | psf 2 | psf licen[sc]e (?:version )?2
psf | 50 | psf | psf licen[sc]e
php-3.01 | 70 | php 3 | php licen[sc]e (?:version )?3 01
php | 50 | php | (?:the )?php licen[sc]e
ruby | 50 | ruby | (?:the )?ruby licen[sc]e
openssl | 50 | openssl | (?:the )?openssl licen[sc]e
curl | 50 | curl | (?:the )?curl licen[sc]e
hpnd | 50 | historical permission notice | historical permission notice and disclaimer
afl-3.0 | 60 | academic free | academic free licen[sc]e(?: (?:version |v )?3 0)?
ecl-2.0 | 60 | educational community | educational community licen[sc]e(?: (?:version )?2 0)?
unicode | 50 | unicode | unicode (?:data files and software )?licen[sc]e(?: agreement)?
beerware | 50 | beer ware | beer ware licen[sc]e
beerware | 50 | beerware | beerware licen[sc]e
beerware | 30 | beerware | beerware

# Weak copyleft and vendor licenses
mpl-2.0 | 70 | mozilla 2 | mozilla public licen[sc]e (?:version |v )?2 0
mpl-1.1 | 70 | mozilla 1 | mozilla public licen[sc]e (?:version |v )?1 1
mpl-1.0 | 70 | mozilla 1 0 | mozilla public licen[sc]e (?:version |v )?1 0
mpl | 50 | mozilla | mozilla public licen[sc]e
mpl-2.0 | 60 | mpl 2 | mpl (?:v |version )?2(?: 0)?
mpl-1.1 | 60 | mpl 1 | mpl (?:v |version )?1 1
mpl-2.0 | 40 | mozilla mpl 2 | mozilla org mpl 2 0
epl-2.0 | 70 | eclipse 2 | eclipse public licen[sc]e (?:version |v )?2 0
epl-1.0 | 70 | eclipse 1 | eclipse public licen[sc]e (?:version |v )?1 0
epl | 50 | eclipse | eclipse public licen[sc]e
edl-1.0 | 60 | eclipse distribution | eclipse distribution licen[sc]e(?: (?:version |v )?1 0)?
cddl-1.0 | 70 | development distribution 1 | common development and distribution licen[sc]e (?:cddl )?(?:version )?1 0
cddl-1.1 | 70 | development distribution 1 | common development and distribution licen[sc]e (?:cddl )?(?:version )?1 1
cddl | 50 | development distribution | common development and distribution licen[sc]e
cddl | 30 | cddl | cddl
cpl-1.0 | 60 | common public | common public licen[sc]e(?: (?:version )?1 0)?
ipl-1.0 | 60 | ibm public | ibm public licen[sc]e(?: (?:version )?1 0)?
eupl-1.2 | 70 | european union 1 2 | european union public licen[sc]e (?:version |v )?1 2
eupl-1.1 | 70 | european union 1 1 | european union public licen[sc]e (?:version |v )?1 1
eupl | 50 | european union public | european union public licen[sc]e
eupl | 30 | eupl | eupl
osl-3.0 | 60 | open software 3 | open software licen[sc]e (?:version |v )?3 0
ms-pl | 60 | microsoft public | microsoft public licen[sc]e
ms-rl | 60 | microsoft reciprocal | microsoft reciprocal licen[sc]e
apsl-2.0 | 60 | apple public source | apple public source licen[sc]e(?: (?:version )?2 0)?
qpl-1.0 | 60 | q public | q public licen[sc]e(?: (?:version )?1 0)?
lppl-1.3c | 60 | latex project public | latex project public licen[sc]e(?: (?:version )?1 3c?)?
cecill | 60 | cecill | cecill(?: (?:b|c|2 1|2 0))?
upl-1.0 | 60 | universal permissive | universal permissive licen[sc]e(?: (?:version |v )?1 0)?

# Data, fonts, models, source-available
odbl-1.0 | 60 | open database | open (?:data commons open )?database licen[sc]e(?: (?:version |v )?1 0)?
odc-by-1.0 | 60 | data commons attribution | open data commons attribution licen[sc]e(?: (?:version |v )?1 0)?
pddl-1.0 | 60 | domain dedication | (?:open data commons )?public domain dedication and licen[sc]e(?: 1 0)?
cdla-permissive-2.0 | 60 | community data permissive | community data licen[sc]e agreement permissive(?: (?:version )?2 0)?
cdla-sharing-1.0 | 60 | community data sharing | community data licen[sc]e agreement sharing(?: (?:version )?1 0)?
ogl-uk-3.0 | 60 | open government | open government licen[sc]e(?: (?:version |v )?3 0| v3 0)?
ofl-1.1 | 60 | open font | (?:sil )?open font licen[sc]e(?: (?:version )?1 1)?
openrail | 60 | openrail | (?:creativeml )?openrail(?: m)?(?: licen[sc]e)?
openrail | 60 | open rail | (?:creativeml )?open rail(?: m)?(?: licen[sc]e)?
busl-1.1 | 60 | business source | business source licen[sc]e(?: 1 1)?
sspl-1.0 | 60 | server side public | server side public licen[sc]e(?: (?:version |v )?1)?
elastic-2.0 | 60 | elastic | elastic licen[sc]e(?: 2 0)?
commons-clause | 60 | commons clause | commons clause(?: licen[sc]e)?(?: condition)?
polyform | 60 | polyform | polyform (?:noncommercial|shield|strict|small business|perimeter)(?: licen[sc]e)?(?: 1 0 0)?
free-art-1.3 | 60 | free art | free art licen[sc]e(?: 1 3)?
confluent-community-1.0 | 60 | confluent community | confluent community licen[sc]e(?: agreement)?(?: version 1 0)?

# Rights statements and hints
public-domain | 50 | public domain | (?:released |dedicated |placed |donated )?(?:in|into|to) the public domain
public-domain | 30 | public domain | public domain
reserved | 50 | rights reserved | all rights reserved
reserved | 50 | rights reserved | some rights reserved
no-redistribution | 40 | redistribution prohibited | redistribution (?:of this \w+ )?is (?:strictly )?prohibited
proprietary | 40 | proprietary confidential | proprietary and confidential
proprietary | 40 | copying medium prohibited | unauthori[sz]ed copying of this file via any medium is strictly prohibited
no-commercial-use | 40 | commercial use | (?:not for|no) commercial use
no-commercial-use | 40 | personal use only | for personal use only
academic-use | 40 | purposes only | for (?:academic|research|non commercial research) purposes only
used-with-permission | 40 | with permission | (?:used|reprinted|reproduced) with permission
copyright-notice | 30 | copyright | copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?
see-license-file | 20 | see file | see (?:the )?(?:accompanying )?licen[sc]e(?: txt| md)? file
license-hint | 10 | licensed under | licensed under
license-hint | 10 | licenced under | licenced under
license-hint | 10 | released under | released under
license-hint | 10 | terms license | terms of (?:the|this) license
license-hint | 10 | terms licence | terms of (?:the|this) licence
license-hint | 10 | end user agreement | end user licen[sc]e agreement
"""
