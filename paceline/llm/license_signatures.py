"""Signatures of licenses written by hand: notices, titles, addresses, names and body sentences.

Each group has a priority (smaller wins) and how surely one detection tells the license. A row is
label, gate and pattern. Patterns run over lower-cased words joined by single blanks, so "GPLv2+" is
"gplv2" and "MPL-2.0" is "mpl 2 0". A gate is a phrase, or several between bars, of which every match
holds one as whole words.
"""

from __future__ import annotations

#: The sentences by which a file is put under a license.
NOTICES = (
    ("gpl-1", "general public license as published", r"gnu general public license as published by the free software foundation (?:either )?version 1(?: of the license)?(?: or at your option any later version)?"),
    ("gpl-2", "general public license as published", r"gnu general public license as published by the free software foundation (?:either )?version 2(?: of the license)?(?: or at your option any later version)?"),
    ("gpl-3", "general public license as published", r"gnu general public license as published by the free software foundation (?:either )?version 3(?: of the license)?(?: or at your option any later version)?"),
    ("gpl-2", "as published by the free software foundation", r"gnu general public license version 2 as published by the free software foundation"),
    ("gpl-3", "as published by the free software foundation", r"gnu general public license version 3 as published by the free software foundation"),
    ("lgpl-2", "general public license as published", r"gnu (?:library|lesser) general public license as published by the free software foundation (?:either )?version 2(?! 1)(?: of the license)?(?: or at your option any later version)?"),
    ("lgpl-2.1", "general public license as published", r"gnu lesser general public license as published by the free software foundation (?:either )?version 2 1(?: of the license)?(?: or at your option any later version)?"),
    ("lgpl-3", "general public license as published", r"gnu lesser general public license as published by the free software foundation (?:either )?version 3(?: of the license)?(?: or at your option any later version)?"),
    ("lgpl-2.1", "as published by the free software foundation", r"gnu lesser general public license version 2 1 as published by the free software foundation"),
    ("lgpl-3", "as published by the free software foundation", r"gnu lesser general public license version 3 as published by the free software foundation"),
    ("agpl-3", "general public license as published", r"gnu affero general public license as published by the free software foundation (?:either )?version 3(?: of the license)?(?: or at your option any later version)?"),
    ("agpl-3", "as published by the free software foundation", r"gnu affero general public license version 3 as published by the free software foundation"),
    ("gfdl-1.1", "gnu free documentation license", r"distribute and or modify this document under the terms of the gnu free documentation license version 1 1"),
    ("gfdl-1.2", "gnu free documentation license", r"distribute and or modify this document under the terms of the gnu free documentation license version 1 2"),
    ("gfdl-1.3", "gnu free documentation license", r"distribute and or modify this document under the terms of the gnu free documentation license version 1 3"),
    ("apache-2", "apache license version 2 0", r"licensed under the apache license version 2 0 (?:the )?license you may not use this file except in compliance with the license"),
    ("apache-2", "contributor license agreements", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2-llvm", "llvm exceptions|llvm exception", r"(?:under the )?apache license v(?:ersion )?2 0 with llvm exceptions?"),
    ("mpl-2", "mozilla public license", r"this source code form is subject to the terms of the mozilla public license v(?:ersion)? ?2 0"),
    ("mpl-1.1", "mozilla public license", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1", "mozilla public license", r"the contents of this file are subject to the mozilla public license version 1 0"),
    ("npl-1.1", "netscape public license", r"the contents of this file are subject to the netscape public license version 1 1"),
    ("npl-1", "netscape public license", r"the contents of this file are subject to the netscape public license version 1 0"),
    ("epl-2", "eclipse public license", r"made available under the terms of the eclipse public license (?:v(?:ersion)? ?)?2 0"),
    ("epl-1", "eclipse public license", r"made available under the terms of the eclipse public license (?:v(?:ersion)? ?)?1 0"),
    ("edl-1", "eclipse distribution license", r"under the terms of the eclipse distribution license v(?:ersion)? ?1 0"),
    ("cddl-1", "common development and distribution license", r"subject to the terms of the common development and distribution license version 1 0"),
    ("cddl", "common development and distribution license", r"subject to the terms of the common development and distribution license"),
    ("cpl-1", "common public license", r"made available under the terms of the common public license v(?:ersion)? ?1 0"),
    ("eupl-1.2", "licensed under the eupl", r"licensed under the eupl (?:v(?:ersion)? ?)?1 2(?: or as soon they will be approved by the european commission)?"),
    ("eupl-1.1", "licensed under the eupl", r"licensed under the eupl (?:v(?:ersion)? ?)?1 1(?: or as soon they will be approved by the european commission)?"),
    ("ofl-1.1", "this font software is licensed", r"this font software is licensed under the sil open font license version 1 1"),
    ("ofl-1", "this font software is licensed", r"this font software is licensed under the sil open font license version 1 0"),
    ("bsl-1", "boost software license", r"(?:use modification and distribution (?:is|are) subject to|distributed under) the boost software license version 1 0"),
    ("zpl-2.1", "zope public license", r"subject to the provisions of the zope public license version 2 1"),
    ("zpl-2", "zope public license", r"subject to the provisions of the zope public license version 2 0"),
    ("apsl-2", "apple public source license", r"subject to the apple public source license version 2 0"),
    ("cecill", "cecill license", r"governed by the cecill license under french law"),
    ("cecill-b", "cecill b license", r"governed by the cecill b license under french law"),
    ("cecill-c", "cecill c license", r"governed by the cecill c license under french law"),
    ("perl", "same terms as perl", r"(?:redistribute it and or modify it )?under the same terms as perl(?: itself)?"),
    ("php-3.01", "php license", r"this source file is subject to version 3 01 of the php license"),
    ("php-3", "php license", r"this source file is subject to version 3 0 of the php license"),
    ("unlicense", "free and unencumbered software", r"this is free and unencumbered software released into the public domain"),
    ("cc0", "copyright and related or neighboring rights", r"has waived all copyright and related or neighboring rights"),
    ("lppl-1.3c", "latex project public license", r"conditions of the latex project public license (?:either )?version 1 3c?"),
    ("mulan-2", "mulan psl v2", r"licensed under mulan psl v2"),
    ("busl-1.1", "business source license", r"(?:use of this software is governed by|licensed under) the business source license(?: version)?(?: 1 1)?"),
    ("sspl-1", "server side public license", r"server side public license (?:version 1 )?as published by mongodb(?: inc)?"),
    ("elastic-2", "elastic license", r"licensed under the elastic license (?:v(?:ersion)? ?)?2 0"),
    ("bsd", "bsd style license", r"governed by a bsd style license that can be found in the license file"),
    ("mit", "mit style license", r"governed by an mit style license that can be found in the license file"),
)

#: The titles that stand above license texts.
TITLES = (
    ("gpl-1", "february 1989", r"gnu general public license version 1 february 1989"),
    ("gpl-2", "june 1991", r"gnu general public license version 2 june 1991"),
    ("gpl-3", "june 2007", r"gnu general public license version 3 29 june 2007"),
    ("lgpl-2", "june 1991", r"gnu library general public license version 2 june 1991"),
    ("lgpl-2.1", "february 1999", r"gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-3", "june 2007", r"gnu lesser general public license version 3 29 june 2007"),
    ("agpl-1", "march 2002", r"affero general public license version 1 march 2002"),
    ("agpl-3", "november 2007", r"gnu affero general public license version 3 19 november 2007"),
    ("gfdl-1.1", "march 2000", r"gnu free documentation license version 1 1 march 2000"),
    ("gfdl-1.2", "november 2002", r"gnu free documentation license version 1 2 november 2002"),
    ("gfdl-1.3", "november 2008", r"gnu free documentation license version 1 3 3 november 2008"),
    ("apache-2", "january 2004", r"apache license version 2 0 january 2004"),
    ("apache-1.1", "apache software license", r"the apache software license version 1 1"),
    ("bsl-1", "august 17th 2003", r"boost software license version 1 0 august 17th 2003"),
    ("ofl-1.1", "26 february 2007", r"sil open font license version 1 1 26 february 2007"),
    ("artistic-2", "artistic license", r"(?:the )?artistic license 2 0 copyright"),
    ("artistic-1-clarified", "clarified artistic license", r"(?:the )?clarified artistic license"),
    ("wtfpl-2", "december 2004", r"do what the fuck you want to public license version 2 december 2004"),
    ("eupl-1.2", "european union public licence", r"european union public licence v 1 2 eupl"),
    ("eupl-1.1", "european union public licence", r"european union public licence v 1 1 eupl"),
    ("cddl-1", "common development and distribution license", r"common development and distribution license cddl version 1 0"),
    ("cddl-1.1", "common development and distribution license", r"common development and distribution license cddl version 1 1"),
    ("ipl-1", "ibm public license", r"ibm public license (?:version |v ?)?1 0"),
    ("lpl-1.02", "lucent public license", r"lucent public license version 1 02"),
    ("ms-pl", "microsoft public license", r"microsoft public license ms pl"),
    ("ms-rl", "microsoft reciprocal license", r"microsoft reciprocal license ms rl"),
    ("ncsa", "ncsa open source license", r"university of illinois ncsa open source license"),
    ("upl-1", "universal permissive license", r"universal permissive license upl version 1 0"),
    ("python-2", "python software foundation license", r"python software foundation license version 2"),
    ("python-2", "license agreement is between", r"this license agreement is between the python software foundation psf"),
    ("cnri-python", "cnri", r"cnri (?:open source )?license agreement(?: for python)?"),
    ("beopen-python", "beopen python", r"beopen python open source license agreement"),
    ("odbl-1", "open database license", r"odc open database license odbl(?: v1 0)?"),
    ("odc-by-1", "open data commons attribution license|odc attribution license", r"(?:open data commons|odc) attribution license(?: odc by)?(?: v1 0)?"),
    ("pddl-1", "public domain dedication and license|public domain dedication and licence", r"(?:open data commons|odc) public domain dedication and licen[sc]e(?: pddl)?"),
    ("cdla-permissive-1", "community data license agreement", r"community data license agreement permissive version 1 0"),
    ("cdla-permissive-2", "community data license agreement", r"community data license agreement permissive version 2 0"),
    ("cdla-sharing-1", "community data license agreement", r"community data license agreement sharing version 1 0"),
    ("cc-by-4", "attribution 4 0 international", r"attribution 4 0 international"),
    ("cc-by-sa-4", "sharealike 4 0 international", r"attribution sharealike 4 0 international"),
    ("cc-by-nc-4", "noncommercial 4 0 international", r"attribution noncommercial 4 0 international"),
    ("cc-by-nc-sa-4", "sharealike 4 0 international", r"attribution noncommercial sharealike 4 0 international"),
    ("cc-by-nd-4", "noderivatives 4 0 international", r"attribution noderivatives 4 0 international"),
    ("cc-by-nc-nd-4", "noderivatives 4 0 international", r"attribution noncommercial noderivatives 4 0 international"),
    ("cc-by-3", "attribution 3 0 unported", r"attribution 3 0 unported"),
    ("cc-by-sa-3", "sharealike 3 0 unported", r"attribution sharealike 3 0 unported"),
    ("cc-by-nc-3", "noncommercial 3 0 unported", r"attribution noncommercial 3 0 unported"),
    ("cc-by-nc-sa-3", "sharealike 3 0 unported", r"attribution noncommercial sharealike 3 0 unported"),
    ("cc-by-nd-3", "noderivs 3 0 unported", r"attribution noderivs 3 0 unported"),
    ("cc-by-nc-nd-3", "noderivs 3 0 unported", r"attribution noncommercial noderivs 3 0 unported"),
    ("ogl-3", "open government licence", r"open government licence (?:for public sector information )?v(?:ersion )?3 0"),
    ("ogl-2", "open government licence", r"open government licence (?:for public sector information )?v(?:ersion )?2 0"),
    ("ogl", "open government licence", r"open government licence"),
    ("etalab-2", "licence ouverte|open licence", r"(?:etalab )?(?:licence ouverte|open licence) (?:version )?2 0"),
    ("dl-de-by-2", "datenlizenz deutschland|data licence germany", r"(?:datenlizenz deutschland namensnennung|data licence germany attribution) (?:version )?2 0"),
    ("mulan-2", "mulan permissive software license", r"mulan permissive software license version 2"),
    ("mulan-1", "mulan permissive software license", r"mulan permissive software license version 1"),
    ("sspl-1", "server side public license", r"server side public license(?: sspl)?(?: version 1| v1)?"),
    ("busl-1.1", "business source license", r"business source license (?:version )?1 1"),
    ("elastic", "elastic license agreement|elastic license", r"elastic license(?: agreement)?"),
    ("fsl-1.1", "functional source license", r"functional source license version 1 1"),
    ("blueoak-1", "blue oak model license", r"blue oak model license(?: 1 0 0)?"),
    ("parity", "parity public license", r"parity public license"),
    ("prosperity", "prosperity public license", r"prosperity public license"),
    ("polyform-noncommercial-1", "polyform noncommercial license", r"polyform noncommercial license(?: 1 0 0)?"),
    ("polyform-small-business-1", "polyform small business license", r"polyform small business license(?: 1 0 0)?"),
    ("polyform-shield-1", "polyform shield license", r"polyform shield license(?: 1 0 0)?"),
    ("polyform-strict-1", "polyform strict license", r"polyform strict license(?: 1 0 0)?"),
    ("hippocratic", "hippocratic license", r"hippocratic license(?: \d(?: \d)?)?"),
    ("anti-996", "anti 996 license", r"anti 996 license"),
    ("confluent-community", "confluent community license", r"confluent community license"),
    ("timescale", "timescale license", r"timescale license"),
    ("rsal", "redis source available license", r"redis source available license"),
    ("openrail-m", "openrail m|open rail m", r"(?:creativeml |bigscience |bigcode )?open ?rail m(?: license)?"),
    ("llama-community", "community license agreement", r"llama \d(?: \d)? community license agreement"),
    ("gemma-terms", "gemma terms of use", r"gemma terms of use"),
    ("cern-ohl", "cern open hardware licence", r"cern open hardware licence(?: version 2)?"),
    ("solderpad", "solderpad hardware license|solderpad hardware licence", r"solderpad hardware licen[sc]e"),
    ("tapr-ohl", "tapr open hardware license", r"tapr open hardware license"),
    ("free-art", "free art license|licence art libre", r"free art license|licence art libre"),
    ("lppl", "latex project public license", r"latex project public license"),
    ("oldap-2.8", "openldap public license", r"openldap public license version 2 8"),
    ("oldap", "openldap public license", r"openldap public license"),
    ("sleepycat", "sleepycat license", r"sleepycat license"),
    ("vim", "vim license", r"vim license"),
    ("ruby", "ruby license|ruby s license", r"ruby(?: s)? license"),
    ("php", "php license", r"php license"),
    ("zend", "zend engine license", r"zend engine license"),
    ("w3c", "w3c software", r"w3c software (?:and document )?(?:notice and )?license"),
    ("unicode", "unicode license agreement", r"unicode license agreement data files and software"),
    ("icu", "icu license", r"icu license"),
    ("freetype", "freetype project license", r"freetype project license"),
    ("imagemagick", "imagemagick license", r"imagemagick license"),
    ("libpng", "png reference library license|libpng license", r"(?:png reference library|libpng) license(?: version 2)?"),
    ("info-zip", "info zip license", r"info zip license"),
    ("sissl", "sun industry standards source license", r"sun industry standards source license"),
    ("spl-1", "sun public license", r"sun public license"),
    ("rpsl", "realnetworks public source license", r"realnetworks public source license"),
    ("rpl", "reciprocal public license", r"reciprocal public license"),
    ("cpal-1", "common public attribution license", r"common public attribution license"),
    ("erlang-1.1", "erlang public license", r"erlang public license"),
    ("nasa-1.3", "nasa open source agreement", r"nasa open source agreement(?: version 1 3)?"),
    ("watcom-1", "sybase open watcom public license", r"sybase open watcom public license"),
    ("wxwindows", "wxwindows library licence", r"wxwindows library licence"),
    ("zpl", "zope public license", r"zope public license"),
    ("apsl", "apple public source license", r"apple public source license"),
    ("npl", "netscape public license", r"netscape public license"),
    ("miros", "miros licence", r"miros licence"),
    ("eula", "end user license agreement", r"end user license agreement"),
    ("proprietary", "microsoft software license terms", r"microsoft software license terms"),
    ("proprietary", "oracle binary code license", r"oracle binary code license agreement"),
    ("proprietary", "oracle technology network license", r"oracle technology network license agreement"),
)

#: Where license texts are published.
ADDRESSES = (
    ("apache-2", "apache org licenses", r"(?:www )?apache org licenses license 2 0(?: html| txt)?"),
    ("apache-1.1", "apache org licenses", r"(?:www )?apache org licenses license 1 1"),
    ("gpl", "gnu org copyleft gpl|gnu org licenses gpl", r"(?:www )?gnu org (?:copyleft|licenses) gpl(?: html| txt)"),
    ("lgpl", "gnu org copyleft lesser|gnu org licenses lgpl", r"(?:www )?gnu org (?:copyleft lesser|licenses lgpl)(?: html| txt)"),
    ("mpl-2", "mozilla org mpl", r"(?:www )?mozilla org mpl 2 0"),
    ("mpl-1.1", "mozilla org mpl", r"(?:www )?mozilla org mpl mpl 1 1"),
    ("epl-2", "eclipse org legal epl", r"(?:www )?eclipse org legal epl (?:v20|2 0)"),
    ("epl-1", "eclipse org legal epl", r"(?:www )?eclipse org legal epl v10"),
    ("edl-1", "eclipse org org documents edl", r"(?:www )?eclipse org org documents edl v10"),
    ("bsl-1", "boost org license", r"(?:www )?boost org license 1 0(?: txt)?"),
    ("ofl", "scripts sil org ofl|openfontlicense org", r"scripts sil org ofl|openfontlicense org"),
    ("odbl-1", "opendatacommons org licenses odbl", r"opendatacommons org licenses odbl(?: 1 0| summary)?"),
    ("odc-by-1", "opendatacommons org licenses by", r"opendatacommons org licenses by(?: 1 0| summary)?"),
    ("pddl-1", "opendatacommons org licenses pddl", r"opendatacommons org licenses pddl(?: 1 0| summary)?"),
    ("bsd-3-clause", "opensource org", r"opensource org licenses? bsd 3 clause"),
    ("bsd-2-clause", "opensource org", r"opensource org licenses? bsd 2 clause"),
    ("wtfpl", "wtfpl net", r"(?:www )?wtfpl net"),
    ("ogl-3", "open government licence version 3", r"nationalarchives gov uk doc open government licence version 3"),
    ("upl-1", "oss oracle com licenses upl", r"oss oracle com licenses upl"),
    ("php-3.01", "php net license", r"(?:www )?php net license 3 01(?: txt)?"),
)

#: Short names, glued to their version or in catalogue form.
NAMES = (
    ("gpl-1", "gplv1|gpl1", r"(?:gnu )?gplv?1(?: 0)?(?: only| or later)?"),
    ("gpl-2", "gplv2|gpl2", r"(?:gnu )?gplv?2(?: 0)?(?: only| or later)?"),
    ("gpl-3", "gplv3|gpl3", r"(?:gnu )?gplv?3(?: 0)?(?: only| or later)?"),
    ("lgpl-2", "lgplv2|lgpl2", r"(?:gnu )?lgplv?2(?: 0)?(?! 1)(?: only| or later)?"),
    ("lgpl-2.1", "lgplv2 1|lgpl2 1|lgplv21|lgpl21", r"(?:gnu )?lgplv?2 ?1(?: only| or later)?"),
    ("lgpl-3", "lgplv3|lgpl3", r"(?:gnu )?lgplv?3(?: 0)?(?: only| or later)?"),
    ("agpl-3", "agplv3|agpl3", r"(?:gnu )?agplv?3(?: 0)?(?: only| or later)?"),
    ("apache-2", "apachev2|apache2|aslv2|asl2", r"(?:apache|asl)v?2(?: 0)?"),
    ("apache-2", "asl", r"asl 2 0"),
    ("mpl-2", "mplv2|mpl2", r"mplv?2(?: 0)?"),
    ("mpl-1.1", "mplv1|mpl1", r"mplv?1 1"),
    ("epl-2", "eplv2|epl2", r"eplv?2(?: 0)?"),
    ("epl-1", "eplv1|epl1", r"eplv?1(?: 0)?"),
    ("bsd-3-clause", "bsd 3 clause|bsd 3", r"bsd 3(?: clause)(?: licen[sc]e)?|bsd 3 licen[sc]e"),
    ("bsd-2-clause", "bsd 2 clause|bsd 2", r"bsd 2(?: clause)(?: licen[sc]e)?|bsd 2 licen[sc]e"),
    ("bsd-4-clause", "bsd 4 clause", r"bsd 4 clause(?: licen[sc]e)?"),
    ("bsd-1-clause", "bsd 1 clause", r"bsd 1 clause(?: licen[sc]e)?"),
    ("bsd-3-clause", "three clause bsd|new bsd|modified bsd|revised bsd", r"(?:three clause|new|modified|revised) bsd(?: style)? licen[sc]e"),
    ("bsd-2-clause", "two clause bsd|simplified bsd|freebsd license", r"(?:two clause|simplified) bsd(?: style)? licen[sc]e|freebsd license"),
    ("bsd-4-clause", "four clause bsd|original bsd|old bsd", r"(?:four clause|original|old) bsd licen[sc]e"),
    ("0bsd", "0bsd|zero clause bsd|bsd zero clause", r"0bsd(?: licen[sc]e)?|zero clause bsd(?: licen[sc]e)?|bsd zero clause licen[sc]e"),
    ("bsd-3-clause-clear", "clause clear bsd|bsd 3 clause clear", r"(?:the )?clause clear bsd licen[sc]e|bsd 3 clause clear(?: licen[sc]e)?"),
    ("bsd-2-clause-patent", "bsd 2 clause patent|patent license", r"bsd 2 clause patent|bsd 2 clause plus patent license"),
    ("mit-0", "mit no attribution|mit 0", r"mit no attribution(?: licen[sc]e)?|mit 0(?: licen[sc]e)"),
    ("x11", "x11 license|x11 licence", r"x11 licen[sc]e"),
    ("mit", "expat license|expat licence", r"expat licen[sc]e"),
    ("ms-pl", "ms pl", r"ms pl"),
    ("ms-rl", "ms rl", r"ms rl"),
    ("ms-lpl", "microsoft limited public license", r"microsoft limited public license"),
    ("busl-1.1", "busl|bsl 1 1", r"busl(?: 1 1)?|bsl 1 1"),
    ("sspl-1", "sspl|sspl v1|ssplv1", r"sspl(?: v1| 1 0)?|ssplv1"),
    ("commons-clause", "commons clause", r"commons clause(?: license condition)?(?: v1 0)?"),
    ("pddl-1", "pddl", r"pddl(?: v1 0| 1 0)?"),
    ("odc-by-1", "odc by", r"odc by(?: v1 0| 1 0)?"),
    ("cecill-2.1", "cecill v2 1|cecill 2 1", r"cecill (?:v2|2) 1"),
    ("cecill-b", "cecill b", r"cecill b"),
    ("cecill-c", "cecill c", r"cecill c"),
    ("cern-ohl-s-2", "cern ohl s", r"cern ohl s(?: v2| 2 0)?"),
    ("cern-ohl-w-2", "cern ohl w", r"cern ohl w(?: v2| 2 0)?"),
    ("cern-ohl-p-2", "cern ohl p", r"cern ohl p(?: v2| 2 0)?"),
    ("lppl-1.3c", "lppl 1 3c", r"lppl 1 3c"),
    ("unlicense", "unlicense", r"spdx license identifier unlicense|unlicense license"),
    ("zlib", "zlib acknowledgement", r"zlib acknowledgement"),
    ("gpl-classpath", "classpath exception", r"gpl (?:\S+ ){0,4}?with (?:the )?classpath exception"),
    ("gpl-gcc", "runtime library exception", r"gcc runtime library exception"),
)

#: Sentences of license bodies that tell the license without its name.
BODIES = (
    ("mit", "shall be included in all copies", r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    ("json", "good not evil", r"the software shall be used for good not evil"),
    ("x11", "shall not be used in advertising", r"the name of the (?:x consortium|copyright holders?|authors?) shall not be used in advertising or otherwise to promote the sale"),
    ("bsd-4-clause", "advertising materials mentioning", r"all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd-3-clause", "endorse or promote products", r"neither the names? of (?:\S+ ){1,14}?(?:nor|or) the names of (?:its|their|any) contributors may be used to endorse or promote products"),
    ("bsd-3-clause", "endorse or promote products", r"the names? of (?:the |its )?(?:authors?|contributors|copyright holders?) may not be used to endorse or promote products"),
    ("bsd", "must reproduce the above copyright notice", r"redistributions in binary form must reproduce the above copyright notice this list of conditions"),
    ("isc", "with or without fee is hereby granted", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("0bsd", "with or without fee is hereby granted", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software"),
    ("postgresql", "without a written agreement", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("hpnd", "and without fee is hereby granted", r"permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose (?:and )?(?:is hereby granted )?and without fee is hereby granted"),
    ("zlib", "must not be misrepresented", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("apache-2", "irrevocable copyright license", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("mpl-2", "copy of the mpl was not distributed", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-2", "incompatible with secondary licenses", r"this source code form is incompatible with secondary licenses"),
    ("ofl", "reserved font name|reserved font names", r"(?:with reserved font names?|the reserved font names?)"),
    ("openssl", "openssl project", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("openssl", "written by eric young", r"this product includes cryptographic software written by eric young"),
    ("apache-1.1", "developed by the apache software foundation", r"this product includes software developed by the apache software foundation"),
    ("wtfpl", "you just do what the fuck", r"you just do what the fuck you want to"),
    ("beerware", "buy me a beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("fsfap", "any medium without royalty", r"copying and distribution of this file with or without modification are permitted in any medium without royalty"),
    ("fair", "this instrument is retained", r"usage of the works is permitted provided that this instrument is retained with the works"),
    ("ijg", "independent jpeg group", r"this software is based in part on the work of the independent jpeg group"),
    ("gpl-bison", "bison parser skeleton", r"as a special exception you may create a larger work that contains part or all of the bison parser skeleton"),
    ("gpl-classpath", "link this library with independent modules", r"give you permission to link this library with independent modules"),
    ("gpl-autoconf", "configuration script generated by autoconf", r"distribute this file as part of a program that contains a configuration script generated by autoconf"),
    ("gpl-font", "embed this font", r"as a special exception if you create a document which uses this font and embed this font"),
    ("cc0", "no rights reserved", r"cc0 no rights reserved"),
    ("unlicense", "copy modify publish use compile sell", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("busl-1.1", "additional use grant", r"additional use grant"),
    ("proprietary", "unauthorized copying of this file", r"unauthorized copying of this file(?: via any medium)? is strictly prohibited"),
    ("proprietary", "for internal use only", r"confidential (?:and )?for internal use only"),
    ("proprietary", "confidential and proprietary", r"confidential and proprietary"),
)

#: Rows, priority and how surely a detection tells the license.
GROUPS = ((NOTICES, 5, 0.99), (TITLES, 19, 0.95), (ADDRESSES, 29, 0.95), (NAMES, 39, 0.85), (BODIES, 58, 0.9))
