"""License scan: ordered signature rules over whole texts, in built-in expressions only.

Rules are regular expressions with a gate word, a keyword, a level (1 strongest)
and a label.  A text without any gate word is not looked at; a rule runs only
where its gate word and keyword occur.  Every match of a rule contains both, so
they save time and drop nothing; a name with alternatives that have no word in
common is a family for each.  A detection is dropped if the interval of another one of
the same or a stronger level contains it (of equal intervals the stronger, then
the earlier rule stays).  The scan is one projection: no shuffle, so neither
copies nor hot sources matter.

Null text counts as empty; repeated rows give repeated results; other columns
are left out unless named in ``keep``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GATE = "licen"  # in every match of a rule that asks for "license"
GRANT_GATE = "under"  # in every grant
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_COUNTED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
LEVEL_SCORE = (1.0, 0.95, 0.85, 0.7)


@dataclass(frozen=True)
class Rule:
    label: str
    level: int
    keyword: str
    pattern: str
    gate: str = GATE


# label, SPDX identifiers, name patterns, keyword of the names.
FAMILIES = (
    ("mit", ("mit", "mit-0", "x11"), r"mit", "mit"),
    ("mit", ("mit-modern-variant",), r"massachusetts\s+institute\s+of\s+technology", "massachusetts"),
    ("expat", ("mit-feh",), r"expat", "expat"),
    ("apache-2.0", ("apache-2.0",), r"apache(?:\s+software)?(?:\s+license)?,?\s+(?:version\s+|v\.?\s*)?2(?:\.0)?", "apache"),
    ("apache-1.1", ("apache-1.1",), r"apache(?:\s+software)?(?:\s+license)?,?\s+(?:version\s+|v\.?\s*)?1\.1", "apache"),
    ("apache", ("apache-1.0",), r"apache(?:\s+software)?", "apache"),
    ("agpl-3.0", ("agpl-3.0", "agpl-3.0-only", "agpl-3.0-or-later"), r"(?:gnu\s+)?affero\s+general\s+public", "affero"),
    ("agpl", ("agpl-1.0",), r"agpl", "agpl"),
    ("lgpl-2.1", ("lgpl-2.1", "lgpl-2.1-only", "lgpl-2.1-or-later"), r"(?:gnu\s+)?lesser\s+general\s+public", "lesser"),
    ("lgpl-2.0", ("lgpl-2.0", "lgpl-2.0-only"), r"(?:gnu\s+)?library\s+general\s+public", "library"),
    ("lgpl", ("lgpl-3.0", "lgpl-3.0-only"), r"(?:gnu\s+)?lgpl(?:\s*-?v?[23](?:\.[01])?)?", "lgpl"),
    ("gpl-2.0", ("gpl-2.0", "gpl-2.0-only", "gpl-2.0-or-later"), r"(?:gnu\s+)?gpl\s*-?\s*(?:v|version\s+)?2(?:\.0)?", "gpl"),
    ("gpl-3.0", ("gpl-3.0", "gpl-3.0-only", "gpl-3.0-or-later"), r"(?:gnu\s+)?gpl\s*-?\s*(?:v|version\s+)?3(?:\.0)?", "gpl"),
    ("gpl", ("gpl-1.0",), r"(?:gnu\s+)?general\s+public", "general"),
    ("gfdl", ("gfdl-1.3", "gfdl-1.2"), r"(?:gnu\s+)?free\s+documentation", "documentation"),
    ("bsd-2-clause", ("bsd-2-clause", "bsd-2-clause-patent"), r"(?:bsd\s+2-clause|2-clause\s+bsd|simplified\s+bsd)", "bsd"),
    ("bsd-3-clause", ("bsd-3-clause", "bsd-3-clause-clear"), r"(?:bsd\s+3-clause|3-clause\s+bsd|modified\s+bsd|new\s+bsd)", "bsd"),
    ("bsd-4-clause", ("bsd-4-clause",), r"(?:bsd\s+4-clause|4-clause\s+bsd|original\s+bsd)", "bsd"),
    ("bsd", ("0bsd", "bsd-1-clause"), r"bsd", "bsd"),
    ("isc", ("isc",), r"isc", "isc"),
    ("mpl-2.0", ("mpl-2.0",), r"mozilla\s+public(?:\s+license)?,?\s+(?:version\s+|v\.?\s*)?2(?:\.0)?", "mozilla"),
    ("mpl-1.1", ("mpl-1.1",), r"mozilla\s+public(?:\s+license)?,?\s+(?:version\s+|v\.?\s*)?1\.1", "mozilla"),
    ("mpl", ("mpl-1.0",), r"mozilla\s+public", "mozilla"),
    ("epl", ("epl-1.0", "epl-2.0"), r"eclipse\s+public", "eclipse"),
    ("edl", ("edl-1.0",), r"eclipse\s+distribution", "eclipse"),
    ("cddl", ("cddl-1.0", "cddl-1.1"), r"common\s+development\s+and\s+distribution", "common"),
    ("cpl", ("cpl-1.0",), r"common\s+public", "common"),
    ("eupl", ("eupl-1.1", "eupl-1.2"), r"european\s+union\s+public", "european"),
    ("artistic", ("artistic-1.0", "artistic-2.0"), r"artistic", "artistic"),
    ("zlib", ("zlib",), r"zlib(?:\s*/\s*libpng)?", "zlib"),
    ("libpng", ("libpng", "libpng-2.0"), r"libpng", "libpng"),
    ("boost", ("bsl-1.0",), r"boost(?:\s+software)?", "boost"),
    ("unlicense", ("unlicense",), r"unlicense", "unlicense"),
    ("unlicense", (), r"the\s+un", "un"),
    ("wtfpl", ("wtfpl",), r"do\s+what\s+the\s+fuck\s+you\s+want\s+to\s+public", "want"),
    ("python", ("psf-2.0", "python-2.0"), r"python(?:\s+software\s+foundation)?", "python"),
    ("postgresql", ("postgresql",), r"postgresql", "postgresql"),
    ("openssl", ("openssl",), r"openssl", "openssl"),
    ("openldap", ("oldap-2.8",), r"openldap\s+public", "openldap"),
    ("php", ("php-3.0", "php-3.01"), r"php", "php"),
    ("ruby", ("ruby",), r"ruby", "ruby"),
    ("w3c", ("w3c",), r"w3c(?:\s+software)?", "w3c"),
    ("unicode", ("unicode-3.0", "unicode-dfs-2016"), r"unicode", "unicode"),
    ("ncsa", ("ncsa",), r"university\s+of\s+illinois/?\s*ncsa(?:\s+open\s+source)?", "illinois"),
    ("ms-pl", ("ms-pl", "ms-rl"), r"microsoft\s+(?:public|reciprocal)", "microsoft"),
    ("osl", ("osl-3.0", "osl-2.1"), r"open\s+software", "open"),
    ("afl", ("afl-3.0", "afl-2.1"), r"academic\s+free", "academic"),
    ("ofl", ("ofl-1.1",), r"(?:sil\s+)?open\s+font", "font"),
    ("odbl", ("odbl-1.0",), r"open\s+database", "database"),
    ("cc-by-nc-nd", ("cc-by-nc-nd-4.0",), r"creative\s+commons\s+attribution-noncommercial-noderiv\w*", "noderiv"),
    ("cc-by-nc-nd", (), r"cc[\s-]by-nc-nd", "by-nc-nd"),
    ("cc-by-nc-sa", ("cc-by-nc-sa-4.0",), r"creative\s+commons\s+attribution-noncommercial-sharealike", "sharealike"),
    ("cc-by-nc-sa", (), r"cc[\s-]by-nc-sa", "by-nc-sa"),
    ("cc-by-nc", ("cc-by-nc-4.0",), r"creative\s+commons\s+attribution-noncommercial", "noncommercial"),
    ("cc-by-nc", (), r"cc[\s-]by-nc", "by-nc"),
    ("cc-by-sa", ("cc-by-sa-4.0", "cc-by-sa-3.0"), r"creative\s+commons\s+attribution-sharealike", "sharealike"),
    ("cc-by-sa", (), r"cc[\s-]by-sa", "by-sa"),
    ("cc-by-nd", ("cc-by-nd-4.0",), r"creative\s+commons\s+attribution-noderiv\w*", "noderiv"),
    ("cc-by-nd", (), r"cc[\s-]by-nd", "by-nd"),
    ("cc-by", ("cc-by-4.0", "cc-by-3.0"), r"creative\s+commons\s+attribution", "attribution"),
    ("cc-by", (), r"cc[\s-]by", "by"),
    ("cc0", ("cc0-1.0",), r"cc0", "cc0"),
    ("cc0", (), r"creative\s+commons\s+zero", "zero"),
    ("creative-commons", ("cc-pddc",), r"creative\s+commons", "creative"),
    ("proprietary", ("licenseref-proprietary",), r"proprietary", "proprietary"),
    ("proprietary", (), r"commercial", "commercial"),
)
# Wordings of the notices themselves, by hand: label, level, words in turn, and a keyword every match
# holds.  '*' stands for up to three words.
NOTICES = (
    ("mit", 2, "permission is hereby granted, free of charge, to any person obtaining a copy of this software", "obtaining"),
    ("mit", 3, "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "substantial"),
    ("mit", 3, "to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish", "restriction"),
    ("mit", 4, "the software is provided \"as is\", without warranty of any kind, express or implied", "warranty"),
    ("mit", 3, "in no event shall the authors or copyright holders be liable for any claim, damages or other liability", "liability"),
    ("mit-0", 3, "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"software\"), to deal in the software without restriction", "associated"),
    ("x11", 3, "shall not be used in advertising or otherwise to promote the sale, use or other dealings in this software without prior written authorization", "advertising"),
    ("bsd", 2, "redistribution and use in source and binary forms, with or without modification, are permitted", "redistribution"),
    ("bsd", 3, "redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer", "redistributions"),
    ("bsd", 3, "redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer", "redistributions"),
    ("bsd-3-clause", 2, "neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software", "endorse"),
    ("bsd-3-clause", 3, "the name of the author may not be used to endorse or promote products derived from this software", "endorse"),
    ("bsd-4-clause", 2, "all advertising materials mentioning features or use of this software must display the following acknowledgement", "acknowledgement"),
    ("bsd", 3, "this software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties", "contributors"),
    ("bsd", 4, "loss of use, data, or profits; or business interruption", "interruption"),
    ("bsd-2-clause-patent", 3, "subject to the terms and conditions of this license, each copyright holder and contributor hereby grants", "contributor"),
    ("bsd-3-clause-clear", 2, "no express or implied licenses to any party's patent rights are granted by this license", "patent"),
    ("0bsd", 3, "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. the software", "distribute"),
    ("isc", 2, "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "distribute"),
    ("isc", 2, "permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted", "distribute"),
    ("isc", 3, "the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness", "disclaims"),
    ("hpnd", 3, "permission to use, copy, modify, and distribute this software and its documentation for any purpose and without fee is hereby granted", "documentation"),
    ("ntp", 3, "the university of delaware makes no representations about the suitability this software for any purpose", "delaware"),
    ("zlib", 2, "this software is provided 'as-is', without any express or implied warranty. in no event will the authors be held liable", "as-is"),
    ("zlib", 3, "the origin of this software must not be misrepresented; you must not claim that you wrote the original software", "misrepresented"),
    ("zlib", 3, "altered source versions must be plainly marked as such, and must not be misrepresented as being the original software", "misrepresented"),
    ("libpng", 3, "the png reference library is supplied \"as is\"", "png"),
    ("libtiff", 3, "the names of sam leffler and silicon graphics may not be used in any advertising or publicity", "leffler"),
    ("ijg", 3, "this software is based in part on the work of the independent jpeg group", "jpeg"),
    ("curl", 3, "permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", "appear"),
    ("freetype", 3, "portions of this software are copyright * the freetype project", "freetype"),
    ("info-zip", 3, "this software is provided \"as is,\" without warranty of any kind, express or implied. in no event shall info-zip or its contributors", "info-zip"),
    ("bzip2", 3, "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission. julian seward", "seward"),
    ("unlicense", 2, "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("unlicense", 3, "anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary", "compile"),
    ("public-domain", 3, "the author or authors of this code dedicate any and all copyright interest in this code to the public domain", "dedicate"),
    ("public-domain", 3, "the author or authors of this software dedicate any and all copyright interest in the software to the public domain", "dedicate"),
    ("public-domain", 4, "this work is in the public domain", "domain"),
    ("public-domain", 4, "has been placed in the public domain", "domain"),
    ("public-domain", 4, "is hereby placed into the public domain", "domain"),
    ("public-domain", 3, "the author disclaims copyright to this source code", "disclaims"),
    ("blessing", 2, "may you do good and not evil. may you find forgiveness for yourself and forgive others", "forgiveness"),
    ("json", 2, "the software shall be used for good, not evil", "evil"),
    ("beerware", 2, "if we meet some day, and you think this stuff is worth it, you can buy me a beer in return", "beer"),
    ("boost", 2, "permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by", "organization"),
    ("boost", 3, "unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor", "machine-executable"),
    ("apache-2.0", 2, "you may not use this file except in compliance with the license. you may obtain a copy of the license at", "compliance"),
    ("apache-2.0", 3, "unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an \"as is\" basis", "agreed"),
    ("apache-2.0", 3, "see the license for the specific language governing permissions and limitations under the license", "governing"),
    ("apache-2.0", 2, "each contributor hereby grants to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license", "irrevocable"),
    ("apache-2.0", 2, "licensed to the apache software foundation (asf) under one or more contributor license agreements", "contributor"),
    ("apache-1.1", 3, "this product includes software developed by the apache software foundation", "developed"),
    ("apache-1.1", 3, "the names \"apache\" and \"apache software foundation\" must not be used to endorse or promote products", "endorse"),
    ("ecl-2.0", 3, "licensed under the educational community license, version 2.0", "educational"),
    ("gpl", 2, "this program is free software: you can redistribute it and/or modify it under the terms of the gnu general public", "redistribute"),
    ("gpl", 2, "this program is free software; you can redistribute it and/or modify it under the terms of the gnu general public", "redistribute"),
    ("gpl-2.0", 2, "either version 2 of the license, or (at your option) any later version", "option"),
    ("gpl-3.0", 2, "either version 3 of the license, or (at your option) any later version", "option"),
    ("lgpl-2.1", 2, "either version 2.1 of the license, or (at your option) any later version", "option"),
    ("gpl", 3, "you should have received a copy of the gnu general public license along with this program", "received"),
    ("lgpl", 3, "you should have received a copy of the gnu lesser general public license along with this", "received"),
    ("lgpl-2.0", 3, "you should have received a copy of the gnu library general public license along with this", "received"),
    ("agpl-3.0", 2, "you should have received a copy of the gnu affero general public license along with this program", "affero"),
    ("gpl", 4, "this program is distributed in the hope that it will be useful, but without any warranty", "hope"),
    ("gpl", 4, "without even the implied warranty of merchantability or fitness for a particular purpose. see the gnu", "merchantability"),
    ("gpl", 3, "everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed", "verbatim"),
    ("gpl-2.0", 3, "the licenses for most software are designed to take away your freedom to share and change it", "freedom"),
    ("gpl-3.0", 3, "the gnu general public license is a free, copyleft license for software and other kinds of works", "copyleft"),
    ("agpl-3.0", 3, "your modified version must prominently offer all users interacting with it remotely through a computer network", "remotely"),
    ("lgpl-3.0", 3, "this version of the gnu lesser general public license incorporates the terms and conditions of version 3", "incorporates"),
    ("lgpl", 2, "this library is free software; you can redistribute it and/or modify it under the terms of the gnu lesser general public", "redistribute"),
    ("lgpl-2.0", 2, "this library is free software; you can redistribute it and/or modify it under the terms of the gnu library general public", "redistribute"),
    ("agpl-3.0", 2, "under the terms of the gnu affero general public license as published by the free software foundation", "affero"),
    ("gpl-2.0-only", 2, "under the terms of the gnu general public license version 2 as published by the free software foundation", "foundation"),
    ("gpl-3.0-only", 2, "under the terms of the gnu general public license version 3 as published by the free software foundation", "foundation"),
    ("gpl-with-classpath", 2, "as a special exception, the copyright holders of this library give you permission to link this library with independent modules", "exception"),
    ("gpl-with-gcc-exception", 2, "under section 7 of gpl version 3, you are granted additional permissions described in the gcc runtime library exception", "runtime"),
    ("gpl-with-bison", 3, "as a special exception, you may create a larger work that contains part or all of the bison parser skeleton", "bison"),
    ("gpl-with-openssl", 3, "in addition, as a special exception, the copyright holders give permission to link the code of portions of this program with the openssl library", "openssl"),
    ("gfdl", 2, "permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation license", "documentation"),
    ("gfdl", 3, "with no invariant sections, no front-cover texts, and no back-cover texts", "invariant"),
    ("mpl-2.0", 2, "this source code form is subject to the terms of the mozilla public license, v. 2.0", "mozilla"),
    ("mpl-2.0", 3, "if a copy of the mpl was not distributed with this file, you can obtain one at", "mpl"),
    ("mpl-1.1", 2, "the contents of this file are subject to the mozilla public license version 1.1", "mozilla"),
    ("npl", 2, "the contents of this file are subject to the netscape public license", "netscape"),
    ("cddl", 2, "the contents of this file are subject to the terms of the common development and distribution license", "development"),
    ("epl-1.0", 2, "this program and the accompanying materials are made available under the terms of the eclipse public license v1.0", "eclipse"),
    ("epl-2.0", 2, "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0", "eclipse"),
    ("epl", 3, "which accompanies this distribution, and is available at * eclipse.org/legal", "eclipse.org"),
    ("cpl", 2, "this program and the accompanying materials are made available under the terms of the common public license", "common"),
    ("ipl", 3, "the accompanying program is provided under the terms of this ibm public license", "ibm"),
    ("eupl", 2, "you may not use this work except in compliance with the licence. you may obtain a copy of the licence at * joinup.ec.europa.eu", "europa"),
    ("cecill", 2, "this software is governed by the cecill license under french law and abiding by the rules of distribution of free software", "cecill"),
    ("artistic", 3, "the intent of this document is to state the conditions under which a package may be copied", "package"),
    ("artistic", 2, "you can redistribute it and/or modify it under the same terms as perl itself", "perl"),
    ("artistic-2.0", 3, "this is free software; you can redistribute it and/or modify it under the terms of the artistic license 2.0", "artistic"),
    ("python", 3, "this license agreement is between the python software foundation (\"psf\"), and the individual or organization", "psf"),
    ("python", 3, "beopen.com hereby grants licensee a non-exclusive, royalty-free, world-wide license", "beopen"),
    ("postgresql", 3, "in no event shall the university of california be liable to any party for direct, indirect, special, incidental, or consequential damages", "california"),
    ("openssl", 3, "this product includes software developed by the openssl project for use in the openssl toolkit", "openssl"),
    ("ssleay", 3, "this product includes cryptographic software written by eric young", "cryptographic"),
    ("openldap", 3, "openldap is a registered trademark of the openldap foundation", "openldap"),
    ("php", 3, "this product includes php software, freely available from", "php"),
    ("php", 3, "products derived from this software may not be called \"php\"", "php"),
    ("ruby", 3, "you may distribute the software in object code or binary form, provided that you do at least one of the following", "provided"),
    ("vim", 3, "vim is charityware. you can use and copy it as much as you like", "charityware"),
    ("tcl", 3, "the authors hereby grant permission to use, copy, modify, distribute, and license this software and its documentation for any purpose", "license"),
    ("w3c", 3, "permission to copy, modify, and distribute this software and its documentation, with or without modification, for any purpose and without fee or royalty is hereby granted", "royalty"),
    ("unicode", 3, "permission is hereby granted, free of charge, to any person obtaining a copy of the unicode data files", "unicode"),
    ("icu", 3, "to deal in the software without restriction, provided that the above copyright notice(s) and this permission notice appear in all copies", "appear"),
    ("ncsa", 3, "redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimers", "disclaimers"),
    ("ms-pl", 3, "this license governs use of the accompanying software. if you use the software, you accept this license", "governs"),
    ("osl", 3, "licensed under the open software license version", "open"),
    ("afl", 3, "licensed under the academic free license version", "academic"),
    ("qpl", 3, "the software is licensed under the q public license", "q"),
    ("sleepycat", 3, "redistributions in any form must be accompanied by information on how to obtain complete source code", "accompanied"),
    ("ofl", 2, "this font software is licensed under the sil open font license, version 1.1", "font"),
    ("ofl", 3, "the font software may not be sold by itself", "font"),
    ("bitstream-vera", 3, "the names \"bitstream\" and \"vera\" must not be used", "bitstream"),
    ("odbl", 2, "is made available under the open database license", "database"),
    ("odc-by", 3, "is made available under the open data commons attribution license", "commons"),
    ("cc0", 2, "to the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", "waived"),
    ("cc0", 3, "the person who associated a work with this deed has dedicated the work to the public domain", "deed"),
    ("cc-by", 3, "you must give appropriate credit, provide a link to the license, and indicate if changes were made", "credit"),
    ("cc-by-sa", 3, "if you remix, transform, or build upon the material, you must distribute your contributions under the same license as the original", "remix"),
    ("cc-by-nc", 3, "you may not use the material for commercial purposes", "commercial"),
    ("cc-by-nd", 3, "if you remix, transform, or build upon the material, you may not distribute the modified material", "remix"),
    ("cc-by-sa", 3, "text is available under the creative commons attribution-sharealike license", "sharealike"),
    ("wtfpl", 2, "you just do what the fuck you want to", "fuck"),
    ("commons-clause", 2, "the grant of rights under the license will not include, and the license does not grant to you, the right to sell the software", "sell"),
    ("busl-1.1", 2, "the licensor hereby grants you the right to copy, modify, create derivative works, redistribute, and make non-production use of the licensed work", "non-production"),
    ("sspl", 2, "if you make the functionality of the program or a modified version available to third parties as a service", "functionality"),
    ("elastic-2.0", 2, "you may not provide the software to third parties as a hosted or managed service", "hosted"),
    ("polyform", 2, "you may use the software for any noncommercial purpose is a permitted purpose", "noncommercial"),
    ("proprietary", 2, "unauthorized copying of this file, via any medium is strictly prohibited", "unauthorized"),
    ("proprietary", 3, "this software is confidential and proprietary information", "confidential"),
    ("proprietary", 3, "you shall not disclose such confidential information and shall use it only in accordance with the terms of the license agreement", "disclose"),
    ("proprietary", 3, "this document contains proprietary information which is protected by copyright", "proprietary"),
    ("proprietary", 3, "no part of this publication may be reproduced, stored in a retrieval system, or transmitted", "reproduced"),
    ("proprietary", 3, "no part of this document may be reproduced in any form without prior written permission", "reproduced"),
    ("proprietary", 3, "may not be reproduced or distributed without the express written consent", "consent"),
    ("proprietary", 3, "by installing, copying or otherwise using the software, you agree to be bound by the terms", "installing"),
    ("proprietary", 3, "you may not reverse engineer, decompile, or disassemble the software", "decompile"),
    ("proprietary", 3, "the software is licensed, not sold", "sold"),
    ("proprietary", 4, "this software is the property of", "property"),
    ("shareware", 3, "you may use this software for an evaluation period of", "evaluation"),
    ("freeware", 3, "this software is freeware and may be distributed freely", "freeware"),
    ("freeware", 4, "free for personal and non-commercial use", "personal"),
    ("us-government", 3, "this work was prepared by an officer or employee of the united states government as part of that person's official duties", "officer"),
    ("us-government", 4, "is not subject to copyright protection in the united states", "subject"),
)
# A notice without any of these words is gated by its keyword.
NOTICE_GATES = ("licen", "softw", "permi", "redistribut", "domain", "copyright", "distribut")


def default_rules(families=FAMILIES) -> list[Rule]:
    """The ordered rules: for each family identifiers, grants, titled names and references; then the notices."""
    rules = []
    for label, ids, name, keyword in families:
        for spdx in ids:
            rules.append(Rule(label, 1, spdx, rf"spdx-licen[cs]e-identifier\s*:\s*{spdx.replace('.', '[.]')}(?![\w.-])"))
        grant = r"(?<!\w)(?:re)?(?:licensed|distributed|released|available|published|redistributed)\s+(?:to\s+you\s+)?under\s+(?:the\s+)?(?:terms\s+(?:and\s+conditions\s+)?of\s+)?(?:the\s+|an?\s+)?"
        rules.append(Rule(label, 2, keyword, rf"{grant}(?:{name})(?!\w)(?:\s+licen[cs]e)?", GRANT_GATE))
        rules.append(Rule(label, 3, keyword, rf"(?<!\w)(?:{name})\s+(?:public\s+)?licen[cs]e(?:,?\s+(?:version\s+|v\.?\s*)\d+(?:\.\d+)*)?(?!\w)"))
        rules.append(Rule(label, 4, keyword, rf"(?<!\w)licen[cs]e\s*[:=]\s*[\"']?(?:{name})(?!\w)"))
    for label, level, words, keyword in NOTICES:
        gate = next((g for g in NOTICE_GATES if g in words), keyword)
        rules.append(Rule(label, level, keyword, notice_pattern(words), gate))
    return rules


def notice_pattern(words: str) -> str:
    """A wording with any white space between its words."""
    some = r"(?:\S+\s+){0,3}?"
    parts = [some if w == "*" else re.sub(r"([.()*+?\[\]{}^$|\\])", r"[\1]", w) + r"\s+" for w in words.split(" ")]
    body = "".join(parts).removesuffix(r"\s+")
    return rf"(?<![\w\"']){body}(?!\w)" if words[0].isalnum() else body


def _struct(rule: Rule, place: int) -> Column:
    return F.struct(F.lit(rule.label).alias("label"), F.lit(rule.level).alias("level"),
                    F.lit(place).alias("place"), F.lit(rule.keyword).alias("keyword"),
                    F.lit(rule.gate).alias("gate"), F.lit(rule.pattern).alias("pattern"))


def _intervals(text: Column, rule: Column) -> Column:
    """All matches of a rule, as (start, -end, level, place, label); places are characters."""
    pieces = F.split(text, rule["pattern"], -1)
    found = F.regexp_extract_all(text, rule["pattern"], F.lit(0))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(
        "array<struct<start:int,stop:int,level:int,place:int,label:string>>").alias("hits"))

    def step(acc, pair):
        start = acc["at"] + F.length(pair["piece"])
        stop = start + F.length(pair["match"])
        return F.struct(stop.alias("at"), F.concat(acc["hits"], F.array(F.struct(
            start.alias("start"), (-stop).alias("stop"), rule["level"].alias("level"),
            rule["place"].alias("place"), rule["label"].alias("label")))).alias("hits"))

    pairs = F.zip_with(F.slice(pieces, 1, F.size(found)), found,
                       lambda p, m: F.struct(p.alias("piece"), m.alias("match")))
    return F.when(F.size(found) == 0, zero["hits"]).otherwise(
        F.aggregate(pairs, zero, step, lambda acc: acc["hits"]))


def _surviving(hits: Column, levels: int = 4) -> Column:
    """Sorted distinct labels and the best score after containment suppression.

    In the order (start, longest first, level, rule) a container comes first, so
    a running largest end for each level decides in one pass.
    """
    zero = F.struct(*[F.lit(-1).alias(f"e{i}") for i in range(1, levels + 1)],
                    F.array().cast("array<string>").alias("labels"),
                    F.lit(levels + 1).alias("best"), F.lit(0).alias("n"))

    def step(acc, hit):
        stop = -hit["stop"]
        held = F.lit(-1)
        for i in range(1, levels + 1):
            held = F.greatest(held, F.when(F.lit(i) <= hit["level"], acc[f"e{i}"]).otherwise(F.lit(-1)))
        alive = stop > held
        return F.struct(
            *[F.when(alive & (hit["level"] == i), F.greatest(acc[f"e{i}"], stop))
              .otherwise(acc[f"e{i}"]).alias(f"e{i}") for i in range(1, levels + 1)],
            F.when(alive & ~F.array_contains(acc["labels"], hit["label"]),
                   F.concat(acc["labels"], F.array(hit["label"]))).otherwise(acc["labels"]).alias("labels"),
            F.when(alive, F.least(acc["best"], hit["level"])).otherwise(acc["best"]).alias("best"),
            (acc["n"] + F.when(alive, 1).otherwise(0)).alias("n"))

    return F.aggregate(hits, zero, step)


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def license_scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 rules: list[Rule] | None = None) -> DataFrame:
    """One row per row of ``docs``: word count, base phrase places, labels and score."""
    rules = rules or default_rules()
    table = F.array(*[_struct(r, i) for i, r in enumerate(rules)])
    gates = sorted({GATE} | {r.gate for r in rules})
    names, keep = keep, tuple(f"_keep{i}" for i in range(len(keep)))
    docs = docs.select(*[F.col(k).alias(c) for k, c in zip(names, keep)], F.col(text).cast("string").alias("_raw"))
    raw = F.coalesce(F.col("_raw"), F.lit(""))
    lower = F.lower(raw)
    base = "|".join(BASE_PHRASES)
    df = docs.select(
        *keep, F.regexp_count(raw, F.lit(_COUNTED)).cast("long").alias("n_words"),
        F.when(
            reduce(or_, [F.contains(lower, F.lit(g)) for g in gates]), lower).alias("_low"))
    norm = F.when(F.contains("_low", F.lit(GATE)), F.concat(
        F.lit(" "), F.trim(F.regexp_replace("_low", SEPARATORS, " ")), F.lit(" ")))
    df = df.withColumn("_norm", norm)
    df = df.withColumn("n_base", F.coalesce(F.regexp_count(
        "_norm", F.lit(f"(?<= )(?:{base})(?= )")), F.lit(0)).cast("long"))
    has = F.col("n_base") > 0
    before = F.regexp_instr("_norm", F.lit(f"(?<= )(?:{base})(?= )")) - 1
    last = F.regexp_extract("_norm", rf"(?s)^(.* )(?:{base}) ", 1)
    hits = F.array_sort(F.flatten(F.transform(
        F.filter(table, lambda r: F.contains(F.col("_low"), r["gate"]) & F.contains(F.col("_low"), r["keyword"])),
        lambda r: _intervals(F.col("_low"), r))))
    labels = F.array(*[F.when(F.contains("_norm", F.lit(f" {p} ")), F.lit(v)) for p, v in BASE_PHRASES.items()])
    df = df.select(
        *keep, "n_words", "n_base",
        F.when(has, _spaces(F.substring(F.col("_norm"), F.lit(1), before)) - 1).cast("long").alias("first_word"),
        F.when(has, _spaces(last) - 1).cast("long").alias("last_word"),
        F.when(has, F.array_sort(F.array_compact(labels))).otherwise(F.array().cast("array<string>")).alias("_base"),
        F.when(F.col("_low").isNotNull(), _surviving(hits)).alias("_found"))
    found = F.coalesce(F.col("_found.labels"), F.array().cast("array<string>"))
    score = F.coalesce(F.element_at(F.array(*[F.lit(s) for s in (*LEVEL_SCORE, 0.0)]), F.col("_found.best")), F.lit(0.0))
    return df.select(
        *[F.col(c).alias(k) for k, c in zip(names, keep)], "n_words", "n_base", "first_word", "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", found)), ",").alias("labels"),
        F.greatest(score, F.when(F.col("n_base") > 0, LEVEL_SCORE[2]).otherwise(0.0)).alias("score"),
        F.coalesce(F.col("_found.n"), F.lit(0)).cast("long").alias("n_hits"))
