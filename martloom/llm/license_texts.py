"""Sentences of license texts and notices, as ordered signature rules read them.

Patterns are over normalised words: lower case, one space for whatever stands between two words. The first anchor of every pattern
(``licenses.ANCHORS``, ``ANCHOR_PAIRS``, or a word that starts with ``licen``) is within 20 words of both of its ends.
"""

from __future__ import annotations

_LATER = r"(?: of the licen[sc]e)?(?: or at your option any later)?"
_FSF = r"general public licen[sc]e as published by the free software foundation(?: either)?"
_PRODUCT = "this product includes software developed by the"
_ENDORSE = "to endorse or promote products derived from"
_DEED = "bound by the terms and conditions of this creative commons"
_CC_VERSION = "(?: [1234](?: [05])?)?"

# Sentences of published license texts. Label, a word every match holds, pattern.
BODIES = (
    # MIT and its relatives
    ("mit", "obtaining", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "substantial", "and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    ("bsl-1", "organization", "any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("ofl-1.1", "obtaining", "permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ("x11", "advertising", "the name of the x consortium shall not be used in advertising or otherwise to promote the sale"),
    # ISC, 0BSD, HPND
    ("isc", "purpose", "distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("0bsd", "purpose", "distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("hpnd", "documentation", "distribute this software and its documentation for any purpose(?: and)? without fee is hereby granted provided that"),
    ("hpnd", "sell", "distribute and sell this software and its documentation for any purpose is hereby granted without fee"),
    ("postgresql", "agreement", "distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    # BSD
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause-clear", "limitations", "redistribution and use in source and binary forms with or without modification are permitted subject to the limitations in the disclaimer below"),
    ("bsd", "redistributions", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-3-clause", "endorse", f"nor the names of(?: its| the)?(?: contributors| authors) may be used {_ENDORSE} this software"),
    ("bsd-3-clause", "endorse", f"the name of the author may not be used {_ENDORSE} this software"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-4-clause", "california", f"{_PRODUCT} university of california"),
    ("ncsa", "disclaimers", "must retain the above copyright notice this list of conditions and the following disclaimers"),
    ("openssl", "toolkit", f"{_PRODUCT} openssl project for use in the openssl toolkit"),
    ("openssl", "cryptographic", "this product includes cryptographic software written by eric young"),
    # Apache
    ("apache-1.1", "apache", f"{_PRODUCT} apache software foundation"),
    ("apache-2", "compliance", "licensed under the apache license version 2 0 the license you may not use this file except in compliance"),
    ("apache-2", "agreed", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2", "perpetual", "conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("apache-2", "recipients", "you must give any other recipients of the work or derivative works a copy of this license"),
    ("apache-2", "trademarks", "this license does not grant permission to use the trade names trademarks service marks or product names of the licensor"),
    ("apache-2", "patent", "patent license to make have made use offer to sell sell import and otherwise transfer the work"),
    ("apache-2", "boilerplate", "to apply the apache license to your work attach the following boilerplate notice"),
    # GNU notices
    ("gpl-2", "foundation", f"gnu {_FSF} version 2{_LATER}"),
    ("gpl-3", "foundation", f"gnu {_FSF} version 3{_LATER}"),
    ("gpl-2", "foundation", r"gnu general public licen[sc]e version 2(?: only)? as published by the free software foundation"),
    ("gpl-3", "foundation", r"gnu general public licen[sc]e version 3(?: only)? as published by the free software foundation"),
    ("lgpl-2", "library", f"gnu library {_FSF} version 2 of the licen[sc]e(?: or at your option any later)?"),
    ("lgpl-2.1", "lesser", f"gnu lesser {_FSF} version 2 1{_LATER}"),
    ("lgpl-3", "lesser", f"gnu lesser {_FSF} version 3{_LATER}"),
    ("agpl-3", "affero", f"gnu affero {_FSF} version 3{_LATER}"),
    ("gpl", "details", r"see the gnu general public licen[sc]e for more details"),
    ("lgpl", "details", r"see the gnu (?:lesser|library) general public licen[sc]e for more details"),
    ("agpl", "details", r"see the gnu affero general public licen[sc]e for more details"),
    ("gpl", "received", r"you should have received a copy of the gnu general public licen[sc]e along with this"),
    ("lgpl", "received", r"you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e along with this"),
    ("agpl", "received", r"you should have received a copy of the gnu affero general public licen[sc]e along with this"),
    ("gfdl", "document", "distribute and or modify this document under the terms of the gnu free documentation license"),
    ("classpath-exception-2", "classpath", "gpl(?: version)? v?2(?: 0)?(?: only)? with(?: the)? classpath exception"),
    # GNU texts
    ("gpl-2", "guarantee", "the gnu general public license is intended to guarantee your freedom to share and change free software"),
    ("gpl-2", "program", "this license applies to any program or other work which contains a notice placed by the copyright holder"),
    ("gpl-3", "copyleft", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl-3", "guarantee", "the gnu general public license is intended to guarantee your freedom to share and change all versions of a program"),
    ("agpl-3", "copyleft", "the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("lgpl-2.1", "library", "this license(?: agreement)? applies to any software library or other program which contains a notice"),
    ("lgpl-2.1", "successor", "it also counts as the successor of the gnu library public license"),
    ("lgpl-3", "incorporates", "gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("fsfap", "royalty", "with or without modification are permitted in any medium without royalty provided the copyright notice and this notice are preserved"),
    # Mozilla, Sun, Eclipse
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2-no-copyleft", "incompatible", "this source code form is incompatible with secondary licenses as defined by the mozilla public license v 2 0"),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 0"),
    ("npl-1", "netscape", "the contents of this file are subject to the netscape public license version 1 [01]"),
    ("cpal-1", "attribution", "the contents of this file are subject to the common public attribution license version 1 0"),
    ("cddl-1", "contents", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("epl-1", "accompanying", "accompanying materials are made available under the terms of the eclipse public license(?: version)? v?1(?: 0)?"),
    ("epl-2", "accompanying", "accompanying materials are made available under the terms of the eclipse public license(?: version)? v?2(?: 0)?"),
    ("epl", "eclipse", "the accompanying program is provided under the terms of this eclipse public license"),
    ("cpl-1", "accompanying", "the accompanying program is provided under the terms of this common public license"),
    ("ipl-1", "ibm", "the accompanying program is provided under the terms of this ibm public license"),
    ("eupl-1.1", "eupl", "licensed under the eupl(?: version)? v?1 1"),
    ("eupl-1.2", "eupl", "licensed under the eupl(?: version)? v?1 2"),
    # Perl, Python, PHP, TeX
    ("perl-5", "perl", "redistribute it and or modify it under the same terms as perl itself"),
    ("artistic-2", "establishes", "this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("psf-2", "individual", "this license agreement is between the python software foundation psf and the individual or organization"),
    ("cnri-python", "corporation", "this license agreement is between the corporation for national research initiatives"),
    ("beopen-python", "beopen", "beopen python open source license agreement version 1"),
    ("php-3.01", "php", "this source file is subject to version 3 01 of the php license"),
    ("lppl-1.3c", "latex", "modified under the conditions of the latex project public license(?: either)?(?: version)? 1 3c?"),
    # zlib, Boost, fonts, others
    ("zlib", "arising", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("bsl-1", "accompanying", "see accompanying file license 1 0 txt"),
    ("ofl-1.1", "sil", "this font software is licensed under the sil open font license version 1 1"),
    ("ofl-1.1", "reserved", "no modified version of the font software may use the reserved font name"),
    ("ms-rl", "reciprocal", "microsoft reciprocal license"),
    ("json", "evil", "the software shall be used for good not evil"),
    ("beerware", "beer", r"beer ?ware licen[sc]e"),
    ("wtfpl", "fuck", "do what the fuck you want to public license"),
    ("wtfpl", "verbatim", "distribute verbatim or modified copies of this license document and changing it is allowed"),
    # Public domain
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("cc0-1", "deed", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0-1", "waived", "waived all copyright and related or neighboring rights"),
    ("public-domain", "domain", "(?:this|the) (?:software|code|file|program) (?:is|was|has been)(?: hereby)? (?:placed in|put in|released into|dedicated to) the public domain"),
    # Creative Commons, legal code
    ("cc-by-nc-nd", "deriv", rf"{_DEED} attribution non ?commercial no ?deriv(?:ative|atives|s) 4 0 international public license"),
    ("cc-by-nc-sa", "alike", rf"{_DEED} attribution non ?commercial share ?alike 4 0 international public license"),
    ("cc-by-nc", "commercial", rf"{_DEED} attribution non ?commercial 4 0 international public license"),
    ("cc-by-nd", "deriv", rf"{_DEED} attribution no ?deriv(?:ative|atives|s) 4 0 international public license"),
    ("cc-by-sa", "alike", rf"{_DEED} attribution share ?alike 4 0 international public license"),
    ("cc-by", "attribution", f"{_DEED} attribution 4 0 international public license"),
    # Data
    ("odbl-1", "database", "the open database license odbl is a license agreement intended to allow users to freely share modify and use this database"),
    ("pddl-1", "dedication", "public domain dedication and license(?: pddl)?"),
    ("odc-by-1", "commons", "open data commons attribution license"),
    ("cdla-permissive-2", "community", "community data license agreement permissive(?: version)? 2(?: 0)?"),
    ("ogl-uk-3", "government", r"open government licen[sc]e(?: version)? v?3(?: 0)?"),
    ("etalab-2", "ouverte", "licence ouverte(?: open licence)?(?: version)? 2(?: 0)?"),
)

# Names that only stand before "license" or with a number, and addresses of license texts.
NAMES = (
    ("php-3.01", "php", "php license(?: version)? 3 01"),
    ("apsl-2", "apple", "apple public source license(?: version)? v?2(?: 0)?"),
    ("osl-3", "open", r"open software licen[sc]e(?: version)? v?3(?: 0)?"),
    ("afl-3", "academic", r"academic free licen[sc]e(?: version)? v?3(?: 0)?"),
    ("qpl-1", "public", "q public license"),
    ("sspl-1", "server", "server side public license(?: version)?(?: v?1)?"),
    ("busl-1.1", "business", "business source license(?: version)? v?1 1"),
    ("elastic-2", "elastic", "elastic license(?: version)? v?2(?: 0)?"),
    ("commons-clause", "clause", "commons clause license condition"),
    ("polyform-noncommercial-1", "polyform", "polyform noncommercial license(?: version)?(?: 1 0 0)?"),
    ("polyform-small-business-1", "polyform", "polyform small business license(?: version)?(?: 1 0 0)?"),
    ("blueoak-1", "oak", "blue oak model license(?: version)?(?: 1 0 0)?"),
    ("mulanpsl-2", "mulan", "mulan permissive software license(?: version)? v?2"),
    ("upl-1", "universal", "universal permissive license(?: version)?(?: v?1(?: 0)?)?"),
    ("cecill-2", "cecill", "cecill free software license agreement"),
    ("lppl", "latex", "latex project public license"),
    ("w3c", "w3c", "w3c software(?: notice and)? license"),
    ("unicode", "unicode", "unicode license agreement data files and software"),
    ("ipl-1", "ibm", "ibm public license(?: version)? v?1(?: 0)?"),
    ("oldap-2.8", "openldap", "openldap public license(?: version)? 2 8"),
    ("zpl-2.1", "zope", "zope public license(?: zpl)?(?: version)? 2 1"),
    ("zpl-2", "zope", "zope public license(?: zpl)?(?: version)? 2 0"),
    ("sissl", "sun", "sun industry standards source license"),
    ("sgi-b-2", "sgi", "sgi free software license b"),
    ("sleepycat", "sleepycat", "sleepycat license"),
    ("vim", "vim", "vim license"),
    ("ruby", "ruby", "ruby(?: s)? license"),
    ("openrail", "openrail", "(?:bigcode |bigscience |creativeml )openrail(?: m)? license"),
    ("mit", "opensource", "opensource org licenses mit"),
    ("apache-2", "opensource", "opensource org licenses apache 2 0"),
    ("bsd-2-clause", "opensource", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "opensource", "opensource org licenses bsd 3 clause"),
    ("isc", "opensource", "opensource org licenses isc"),
    ("mpl-2", "opensource", "opensource org licenses mpl 2 0"),
    ("apache-2", "apache", "apache org licenses license 2 0"),
    ("gpl-2", "gnu", "gnu org licenses(?: old licenses)? gpl 2 0"),
    ("gpl-3", "gnu", "gnu org licenses gpl 3 0"),
    ("lgpl-2.1", "gnu", "gnu org licenses(?: old licenses)? lgpl 2 1"),
    ("lgpl-3", "gnu", "gnu org licenses lgpl 3 0"),
    ("agpl-3", "gnu", "gnu org licenses agpl 3 0"),
    ("gfdl", "gnu", "gnu org licenses fdl"),
    ("bsl-1", "boost", "boost org license 1 0 txt"),
    ("unlicense", "org", "unlicense org"),
    ("odbl-1", "opendatacommons", "opendatacommons org licenses odbl"),
    ("pddl-1", "opendatacommons", "opendatacommons org licenses pddl"),
    ("odc-by-1", "opendatacommons", "opendatacommons org licenses by"),
    ("cc-by-nc-nd", "creativecommons", f"creativecommons org licenses by nc nd{_CC_VERSION}"),
    ("cc-by-nc-sa", "creativecommons", f"creativecommons org licenses by nc sa{_CC_VERSION}"),
    ("cc-by-nc", "creativecommons", f"creativecommons org licenses by nc{_CC_VERSION}"),
    ("cc-by-nd", "creativecommons", f"creativecommons org licenses by nd{_CC_VERSION}"),
    ("cc-by-sa", "creativecommons", f"creativecommons org licenses by sa{_CC_VERSION}"),
    ("cc-by", "creativecommons", f"creativecommons org licenses by{_CC_VERSION}"),
    ("cc0-1", "publicdomain", "creativecommons org publicdomain zero(?: 1 0)?"),
    ("public-domain-mark", "publicdomain", "creativecommons org publicdomain mark(?: 1 0)?"),
)

#: Sentences of a text say more than any name in it; names of this module say as much as a name before "license".
BODY_PRIORITY, BODY_WEIGHT = 7, 0.98
NAME_PRIORITY, NAME_WEIGHT = 3, 0.85
