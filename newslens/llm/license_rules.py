"""Signature rules of the licence scan, written by hand, in order.

A line of a section reads ``label | keyword | pattern``. Patterns are regular expressions
over words in lower case with one blank between them: an optional word ends in its own
blank, as in ``(the )?``, ``[^ ]+`` is any word. The keyword is one word that every match contains;
a rule is only tried on a text that has it. Only constructs that Java and RE2 read alike
are used: groups, alternatives, classes and bounded repeats.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: A text without any of these holds no match of any rule. Every pattern contains one.
ROOTS = (
    "licen", "spdx", "copyright", "copyleft", "reserved", "creative", "permission", "redistribut",
    "warrant", "domain", "proprietary", "opensource", "gnu", "apache", "mozilla", "openssl",
    "misrepresented", "endorse", "advertising",
)

#: How sure a rule of each section is.
CONFIDENCE = {1: 1.0, 2: 0.95, 3: 0.9, 4: 0.6, 5: 0.75}
BASE = 5

# Section 1: sentences of the licence texts and of the notices they prescribe.
TEXTS = """
mit | charge | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | noninfringement | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
mit | substantial | the above copyright notice and this permission notice (including the next paragraph )?shall be included in all copies or substantial portions of the software
mit-0 | restriction | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
isc | permission | permission to use copy modify and (or )?distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
0bsd | permission | permission to use copy modify and (or )?distribute this software for any purpose with or without fee is hereby granted the software is provided
hpnd | permission | permission to use copy modify (and )?distribute (and sell )?this software and its documentation for any purpose (is hereby granted without fee|and without fee is hereby granted)
bsd | redistributions | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd | redistributions | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation
bsd-2-clause | redistribution | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-3-clause | endorse | neither the name of (the )?([^ ]+ ){1,8}nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display the following (acknowledgement|acknowledgment)
apache-2.0 | apache | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0 | apache | you may obtain a copy of the license at (http |https )?(www )?apache org licenses license 2 0
apache-2.0 | conditions | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind
apache-1.1 | apache | products derived from this software may not be called apache nor may apache appear in their name without prior written permission
gpl-2.0-or-later | gnu | you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or (at your option )?any later version
gpl-3.0-or-later | gnu | you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or (at your option )?any later version
gpl-2.0-only | gnu | you can redistribute it and or modify it under the terms of the gnu general public license (as published by the free software foundation )?version 2
gpl-3.0-only | gnu | you can redistribute it and or modify it under the terms of the gnu general public license (as published by the free software foundation )?version 3
gpl | gnu | you should have received a copy of the gnu general public license along with this (program|software|library|file|package|work)
gpl | copyleft | the gnu general public license is a free copyleft license for software and other kinds of works
lgpl-2.1-or-later | lesser | under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or (at your option )?any later version
lgpl-3.0-or-later | lesser | under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or (at your option )?any later version
lgpl-2.0-or-later | library | under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or (at your option )?any later version
agpl-3.0-or-later | affero | under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or (at your option )?any later version
gfdl | documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | mozilla | the contents of this file are subject to the mozilla public license version 1 1
mpl-1.0 | mozilla | the contents of this file are subject to the mozilla public license version 1 0
epl-1.0 | eclipse | made available under the terms of the eclipse public license v1 0
epl-2.0 | eclipse | made available under the terms of the eclipse public license (v )?2 0
cddl | development | the contents of this file are subject to the terms of the common development and distribution license
zlib | warranty | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software
unlicense | domain | this is free and unencumbered software released into the public domain
wtfpl | license | everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed
bsl-1.0 | boost | distributed under the boost software license version 1 0
bsl-1.0 | permission | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
ofl-1.1 | font | this font software is licensed under the sil open font license version 1 1
cc0-1.0 | waived | has waived all copyright and related or neighboring rights
artistic-2.0 | artistic | you can redistribute it and or modify it under the terms of the artistic license 2 0
perl | perl | you can redistribute it and or modify it under the same terms as perl
ncsa | illinois | licensed under the university of illinois ncsa open source license
openssl | openssl | this product includes software developed by the openssl project for use in the openssl toolkit
proprietary | prohibited | (unauthori[sz]ed|any) (copying|use|distribution|reproduction|redistribution) of this (file|software|document|work|code) ([^ ]+ ){0,6}is strictly prohibited ([^ ]+ ){0,8}(proprietary|reserved|copyright)
proprietary | proprietary | (this|the) (software|document|information|source code) (is|contains) ([^ ]+ ){0,4}proprietary (and confidential )?(information|property|material|software)
proprietary | permission | no part of this (publication|book|work|document) may be reproduced ([^ ]+ ){0,24}without (the )?(prior |express )?(written )?permission
"""

# Section 2: tags and addresses. {id} lines are made from IDENTIFIERS below.
TAGS = """
{label} | spdx | spdx license identifier {words}
mit | opensource | opensource org licenses? mit
apache-2.0 | apache | apache org licenses license 2 0
apache-1.1 | apache | apache org licenses license 1 1
bsd-2-clause | opensource | opensource org licenses? bsd 2 clause
bsd-3-clause | opensource | opensource org licenses? bsd 3 clause
isc | opensource | opensource org licenses? isc
mpl-2.0 | mozilla | mozilla org (en us )?mpl 2 0
gpl-2.0 | gnu | gnu org licenses (old licenses )?gpl 2 0
gpl-3.0 | gnu | gnu org licenses gpl 3 0
gpl | gnu | gnu org licenses gpl
lgpl-2.1 | gnu | gnu org licenses (old licenses )?lgpl 2 1
lgpl-3.0 | gnu | gnu org licenses lgpl 3 0
lgpl | gnu | gnu org licenses lgpl
agpl-3.0 | gnu | gnu org licenses agpl 3 0
gfdl | gnu | gnu org licenses fdl
cc0-1.0 | creativecommons | creativecommons org publicdomain zero 1 0
public-domain | creativecommons | creativecommons org publicdomain mark 1 0
cc-by | creativecommons | creativecommons org licenses by
cc-by-1.0 | creativecommons | creativecommons org licenses by 1 0
cc-by-2.0 | creativecommons | creativecommons org licenses by 2 0
cc-by-2.5 | creativecommons | creativecommons org licenses by 2 5
cc-by-3.0 | creativecommons | creativecommons org licenses by 3 0
cc-by-4.0 | creativecommons | creativecommons org licenses by 4 0
cc-by-sa | creativecommons | creativecommons org licenses by sa
cc-by-sa-2.0 | creativecommons | creativecommons org licenses by sa 2 0
cc-by-sa-2.5 | creativecommons | creativecommons org licenses by sa 2 5
cc-by-sa-3.0 | creativecommons | creativecommons org licenses by sa 3 0
cc-by-sa-4.0 | creativecommons | creativecommons org licenses by sa 4 0
cc-by-nc | creativecommons | creativecommons org licenses by nc
cc-by-nc-2.0 | creativecommons | creativecommons org licenses by nc 2 0
cc-by-nc-3.0 | creativecommons | creativecommons org licenses by nc 3 0
cc-by-nc-4.0 | creativecommons | creativecommons org licenses by nc 4 0
cc-by-nd | creativecommons | creativecommons org licenses by nd
cc-by-nd-3.0 | creativecommons | creativecommons org licenses by nd 3 0
cc-by-nd-4.0 | creativecommons | creativecommons org licenses by nd 4 0
cc-by-nc-sa | creativecommons | creativecommons org licenses by nc sa
cc-by-nc-sa-3.0 | creativecommons | creativecommons org licenses by nc sa 3 0
cc-by-nc-sa-4.0 | creativecommons | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd | creativecommons | creativecommons org licenses by nc nd
cc-by-nc-nd-3.0 | creativecommons | creativecommons org licenses by nc nd 3 0
cc-by-nc-nd-4.0 | creativecommons | creativecommons org licenses by nc nd 4 0
bsl-1.0 | boost | boost org license 1 0 txt
zlib | zlib | zlib net zlib license html
unlicense | unlicense | unlicense org
ofl-1.1 | openfontlicense | openfontlicense org
odbl-1.0 | opendatacommons | opendatacommons org licenses odbl
odc-by-1.0 | opendatacommons | opendatacommons org licenses by
pddl-1.0 | opendatacommons | opendatacommons org licenses pddl
"""

#: Identifiers that stand after a tag, as label and as words.
IDENTIFIERS = """
0bsd afl-3.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0 apache-1.1 apache-2.0 apsl-2.0 artistic-1.0
artistic-2.0 blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-3-clause bsd-4-clause bsl-1.0 busl-1.1 cc-by-3.0
cc-by-4.0 cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0
cddl-1.1 cecill-2.1 cecill-b cecill-c cpl-1.0 curl ecl-2.0 efl-2.0 elastic-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2
ftl gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-1.0-only gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0
gpl-3.0-only gpl-3.0-or-later hpnd icu ijg imagemagick ipl-1.0 isc json lgpl-2.0 lgpl-2.0-only lgpl-2.0-or-later
lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later libpng lppl-1.3c mit mit-0
mpl-1.0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa ntp ofl-1.1 openssl osl-3.0 php-3.01 postgresql psf-2.0
python-2.0 qpl-1.0 ruby sleepycat sspl-1.0 unicode-3.0 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1
"""

# Section 3: names of licences, with a version or a word that says what they are used for.
NAMES = """
mit | mit | (licensed|released|distributed|available|published|provided) under (the )?(terms of the )?mit licen[cs]e
mit | mit | (the )?mit x11 licen[cs]e
mit | expat | expat licen[cs]e
mit | mit | mit style licen[cs]e
x11 | x11 | x11 licen[cs]e
apache-2.0 | apache | apache (software )?licen[cs]e (version |v )?(2 0|2)
apache-2.0 | apache | apache (2|2 0) licen[cs]e
apache-2.0 | apache | licensed under (the )?apache (2|2 0|v2)
apache-1.1 | apache | apache (software )?licen[cs]e (version |v )?1 1
apache-1.0 | apache | apache (software )?licen[cs]e (version |v )?1 0
gpl-1.0 | public | gnu general public licen[cs]e (version |v )?1
gpl-2.0 | public | gnu general public licen[cs]e (version |v )?(2|2 0)
gpl-2.0 | public | gnu general public licen[cs]e v2
gpl-2.0 | gnu | (under|by) (the )?gnu (gpl v2|gplv2|gpl 2|gpl version 2)
gpl-3.0 | public | gnu general public licen[cs]e (version |v )?(3|3 0)
gpl-3.0 | public | gnu general public licen[cs]e v3
gpl-3.0 | gnu | (under|by) (the )?gnu (gpl v3|gplv3|gpl 3|gpl version 3)
gpl-2.0 | licensed | licensed under (the )?(gpl v2|gplv2|gpl 2|gpl version 2)
gpl-3.0 | licensed | licensed under (the )?(gpl v3|gplv3|gpl 3|gpl version 3)
lgpl-2.0 | library | gnu library general public licen[cs]e (version |v )?(2|2 0)
lgpl-2.1 | lesser | (gnu )?lesser general public licen[cs]e (version |v )?2 1
lgpl-3.0 | lesser | (gnu )?lesser general public licen[cs]e (version |v )?(3|3 0)
lgpl | licensed | licensed under (the )?(gnu )?lgpl
lgpl-2.1 | licensed | licensed under (the )?(gnu )?(lgpl v2 1|lgplv2 1|lgpl 2 1|lgpl version 2 1)
lgpl-3.0 | licensed | licensed under (the )?(gnu )?(lgpl v3|lgplv3|lgpl 3|lgpl version 3)
agpl-3.0 | affero | (gnu )?affero general public licen[cs]e (version |v )?(3|3 0)
agpl-3.0 | licensed | licensed under (the )?(gnu )?(agpl v3|agplv3|agpl 3|agpl version 3)
gfdl-1.3 | documentation | gnu free documentation licen[cs]e (version )?1 3
gfdl-1.2 | documentation | gnu free documentation licen[cs]e (version )?1 2
bsd-2-clause | bsd | (2|two) clause bsd licen[cs]e
bsd-2-clause | bsd | bsd (2|two) clause licen[cs]e
bsd-2-clause | bsd | (simplified|freebsd) bsd licen[cs]e
bsd-3-clause | bsd | (3|three) clause bsd licen[cs]e
bsd-3-clause | bsd | bsd (3|three) clause licen[cs]e
bsd-3-clause | bsd | (new|modified|revised) bsd licen[cs]e
bsd-4-clause | bsd | (4|four) clause bsd licen[cs]e
bsd-4-clause | bsd | (original|old) bsd licen[cs]e
0bsd | bsd | (zero clause|0 clause|free public) bsd licen[cs]e
mpl-1.1 | mozilla | mozilla public licen[cs]e (version |v )?1 1
mpl-2.0 | mozilla | mozilla public licen[cs]e (version |v )?(2 0|2)
epl-1.0 | eclipse | eclipse public licen[cs]e (version |v )?(1 0|1)
epl-2.0 | eclipse | eclipse public licen[cs]e (version |v )?(2 0|2)
eupl-1.1 | european | european union public licen[cs]e (version |v )?1 1
eupl-1.2 | european | european union public licen[cs]e (version |v )?1 2
cddl-1.0 | development | common development and distribution licen[cs]e (version |v )?1 0
cddl-1.1 | development | common development and distribution licen[cs]e (version |v )?1 1
cpl-1.0 | common | common public licen[cs]e (version |v )?1 0
ipl-1.0 | ibm | ibm public licen[cs]e (version |v )?1 0
bsl-1.0 | boost | boost software licen[cs]e (version |v )?1 0
artistic-1.0 | artistic | artistic licen[cs]e (version |v )?1 0
artistic-2.0 | artistic | artistic licen[cs]e (version |v )?2 0
afl-3.0 | academic | academic free licen[cs]e (version |v )?3 0
osl-3.0 | open | open software licen[cs]e (version |v )?3 0
apsl-2.0 | apple | apple public source licen[cs]e (version |v )?2 0
ecl-2.0 | educational | educational community licen[cs]e (version |v )?2 0
psf-2.0 | python | python software foundation licen[cs]e (version |v )?2
php-3.01 | php | php licen[cs]e (version |v )?3 01
zpl-2.1 | zope | zope public licen[cs]e (version |v )?2 1
lppl-1.3c | latex | latex project public licen[cs]e (version |v )?1 3c?
ofl-1.1 | sil | sil open font licen[cs]e (version |v )?1 1
mulanpsl-2.0 | mulan | mulan permissive software licen[cs]e (version |v )?2
busl-1.1 | business | business source licen[cs]e (version |v )?1 1
sspl-1.0 | side | server side public licen[cs]e (version |v )?1
elastic-2.0 | elastic | elastic licen[cs]e (version |v )?2 0
upl-1.0 | universal | universal permissive licen[cs]e (version |v )?1 0
blueoak-1.0.0 | oak | blue oak model licen[cs]e (version |v )?1 0 0
cc-by-1.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution|by) 1 0
cc-by-2.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution|by) 2 0
cc-by-2.5 | licensed | licensed under (a |the )?(creative commons |cc )(attribution|by) 2 5
cc-by-3.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution|by) 3 0
cc-by-4.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution|by) 4 0
cc-by-sa-2.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution sharealike|attribution share alike|by sa) 2 0
cc-by-sa-3.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution sharealike|attribution share alike|by sa) 3 0
cc-by-sa-4.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution sharealike|attribution share alike|by sa) 4 0
cc-by-nc-2.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution noncommercial|attribution non commercial|by nc) 2 0
cc-by-nc-3.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution noncommercial|attribution non commercial|by nc) 3 0
cc-by-nc-4.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution noncommercial|attribution non commercial|by nc) 4 0
cc-by-nd-3.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution noderivatives|attribution noderivs|by nd) 3 0
cc-by-nd-4.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution noderivatives|attribution noderivs|by nd) 4 0
cc-by-nc-sa-3.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution noncommercial sharealike|by nc sa) 3 0
cc-by-nc-sa-4.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution noncommercial sharealike|by nc sa) 4 0
cc-by-nc-nd-3.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution noncommercial noderivatives|attribution noncommercial noderivs|by nc nd) 3 0
cc-by-nc-nd-4.0 | licensed | licensed under (a |the )?(creative commons |cc )(attribution noncommercial noderivatives|attribution noncommercial noderivs|by nc nd) 4 0
cc-by-4.0 | creative | creative commons attribution 4 0 (international )?(public )?licen[cs]e
cc-by-3.0 | creative | creative commons attribution 3 0 (unported |[^ ]+ )?licen[cs]e
cc-by-sa-4.0 | creative | creative commons attribution (sharealike|share alike) 4 0 (international )?(public )?licen[cs]e
cc-by-sa-3.0 | creative | creative commons attribution (sharealike|share alike) 3 0 (unported |[^ ]+ )?licen[cs]e
cc-by-nc-4.0 | creative | creative commons attribution (noncommercial|non commercial) 4 0 (international )?(public )?licen[cs]e
cc-by-nd-4.0 | creative | creative commons attribution (noderivatives|no derivatives) 4 0 (international )?(public )?licen[cs]e
cc-by-nc-sa-4.0 | creative | creative commons attribution (noncommercial|non commercial) (sharealike|share alike) 4 0 (international )?(public )?licen[cs]e
cc-by-nc-nd-4.0 | creative | creative commons attribution (noncommercial|non commercial) (noderivatives|no derivatives) 4 0 (international )?(public )?licen[cs]e
cc0-1.0 | cc0 | cc0 (1 0 )?(universal )?(licen[cs]e|public domain)
cc0-1.0 | creative | creative commons zero
odbl-1.0 | database | open (data commons )?database licen[cs]e
odc-by-1.0 | attribution | open data commons attribution licen[cs]e
pddl-1.0 | dedication | (odc )?public domain dedication and licen[cs]e
ogl-uk-3.0 | government | open government licen[cs]e (v3 0|version 3 0|v 3 0|v3)
"""

# Section 4: names alone, and notices that say no more than that there are rights.
MENTIONS = """
bsd | bsd | bsd (style )?licen[cs]e
lgpl | lesser | (gnu )?lesser general public licen[cs]e
lgpl | library | gnu library general public licen[cs]e
agpl | affero | (gnu )?affero general public licen[cs]e
gfdl | documentation | gnu free documentation licen[cs]e
mpl | mozilla | mozilla public licen[cs]e
epl | eclipse | eclipse public licen[cs]e
eupl | european | european union public licen[cs]e
cddl | development | common development and distribution licen[cs]e
cpl | common | common public licen[cs]e
isc | isc | isc licen[cs]e
zlib | zlib | zlib (libpng )?licen[cs]e
libpng | libpng | libpng licen[cs]e
unlicense | unlicense | the unlicense
bsl-1.0 | boost | boost software licen[cs]e
artistic | artistic | artistic licen[cs]e
ofl | font | open font licen[cs]e
psf | python | python (software foundation )?licen[cs]e
php | php | php licen[cs]e
ruby | ruby | ruby (s )?licen[cs]e
perl | perl | perl licen[cs]e
vim | vim | vim licen[cs]e
w3c | w3c | w3c (software )?(notice and )?licen[cs]e
openssl | openssl | openssl licen[cs]e
postgresql | postgresql | postgresql licen[cs]e
ncsa | ncsa | ncsa (open source )?licen[cs]e
json | json | json licen[cs]e
icu | icu | icu licen[cs]e
unicode | unicode | unicode licen[cs]e
curl | curl | curl licen[cs]e
ftl | freetype | freetype (project )?licen[cs]e
ijg | jpeg | independent jpeg group licen[cs]e
imagemagick | imagemagick | imagemagick licen[cs]e
sleepycat | sleepycat | sleepycat licen[cs]e
qpl | q | q public licen[cs]e
lppl | latex | latex project public licen[cs]e
zpl | zope | zope public licen[cs]e
afl | academic | academic free licen[cs]e
osl | open | open software licen[cs]e
apsl | apple | apple public source licen[cs]e
ms-pl | microsoft | microsoft public licen[cs]e
ms-rl | microsoft | microsoft reciprocal licen[cs]e
nasa | nasa | nasa open source (agreement|licen[cs]e) ([^ ]+ ){0,6}licen[cs]e
cecill | cecill | cecill (free software )?licen[cs]e
wtfpl | fuck | do what the fuck you want to public licen[cs]e
beerware | beer | beer ware licen[cs]e
sspl | side | server side public licen[cs]e
busl | business | business source licen[cs]e
elastic | elastic | elastic licen[cs]e
polyform | polyform | polyform (noncommercial|small business|strict|shield) licen[cs]e
commons-clause | clause | commons clause (licen[cs]e )?condition ([^ ]+ ){0,4}licen[cs]e
openrail | rail | (open|bigscience|creativeml open) rail (m )?licen[cs]e
ogl-uk | government | open government licen[cs]e
upl | universal | universal permissive licen[cs]e
mulanpsl | mulan | mulan permissive software licen[cs]e
cc-by | creative | creative commons attribution licen[cs]e
cc-by-sa | creative | creative commons attribution (sharealike|share alike) licen[cs]e
cc-by-nc | creative | creative commons attribution (noncommercial|non commercial) licen[cs]e
cc-by-nd | creative | creative commons attribution (noderivatives|no derivatives) licen[cs]e
cc-by-nc-sa | creative | creative commons attribution (noncommercial|non commercial) (sharealike|share alike) licen[cs]e
cc-by-nc-nd | creative | creative commons attribution (noncommercial|non commercial) (noderivatives|no derivatives) licen[cs]e
cc | creative | (a |the )?creative commons licen[cs]e
public-domain | domain | (released|placed|dedicated|put) (in|into|to) the public domain
public-domain | domain | (is|are) in the public domain
copyleft | copyleft | copyleft licen[cs]e
proprietary | reserved | all rights reserved
proprietary | proprietary | proprietary (and confidential|software licen[cs]e|licen[cs]e)
proprietary | commercial | commercial licen[cs]e (agreement|is required|required)
proprietary | agreement | end user licen[cs]e agreement
proprietary | licensed | licensed not sold
"""

# The phrases that always count, wherever they stand.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))


@dataclass(frozen=True)
class Rule:
    """One signature. ``tier`` is the number of its section, lower ones win."""

    rule: int
    tier: int
    label: str
    keyword: str
    regex: str


def compiled(pattern: str) -> str:
    """A pattern over words as one over tokens: each word has a hyphen before and a blank after it."""
    return re.sub(r"(^|[ (|]|\)\?|\})(?=[a-z0-9\[])", r"\1-", pattern) + " "


def _lines(section: str) -> list[tuple[str, str, str]]:
    return [tuple(part.strip() for part in line.split(" | ")) for line in section.strip().splitlines()]


def _rules() -> tuple[Rule, ...]:
    first = TAGS.strip().splitlines()[0]
    tags = "\n".join(
        [first.format(label=i, words=re.sub(r"[^a-z0-9]+", " ", i)) for i in IDENTIFIERS.split()]
        + TAGS.strip().splitlines()[1:]
    )
    found = []
    for tier, section in ((1, TEXTS), (2, tags), (3, NAMES), (4, MENTIONS)):
        found += [(tier, *line) for line in _lines(section)]
    found += [(BASE, label, words.split()[-1], words) for label, words in PHRASES]
    return tuple(
        Rule(i, tier, label, f"-{keyword} ", compiled(pattern))
        for i, (tier, label, keyword, pattern) in enumerate(found)
    )


RULES = _rules()
