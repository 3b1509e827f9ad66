"""Templates of public licences: passages of their texts, and the ways in which notices name them."""

from __future__ import annotations

# Passages of public licence texts and of the notices that they ask for, by label.
PASSAGES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("apache-2.0", "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2.0", "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work and such derivative works in source or object form"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program"),
    ("gpl", "there is no warranty for the program to the extent permitted by applicable law except when otherwise stated in writing the copyright holders and or other parties provide the program as is without warranty of any kind either expressed or implied"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("lgpl", "you should have received a copy of the gnu lesser general public license along with this library"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"),
    ("agpl", "you should have received a copy of the gnu affero general public license along with this program"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("cc-by", "you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by-sa", "if you remix transform or build upon the material you must distribute your contributions under the same license as the original"),
    ("reserved", "copyright all rights reserved"),
)

# The names of licences in notices, by label. Passages by Creative Commons follow a rule below.
NAMES = {
    "mit": ("mit license", "expat license"),
    "apache-2.0": ("apache license version 2.0", "apache license 2.0", "apache 2.0 license", "apache software license version 2.0"),
    "bsd": ("bsd license",),
    "bsd-2-clause": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license"),
    "bsd-3-clause": ("bsd 3 clause license", "3 clause bsd license", "new bsd license"),
    "isc": ("isc license",),
    "zlib": ("zlib license",),
    "bsl-1.0": ("boost software license version 1.0", "boost software license 1.0"),
    "mpl-2.0": ("mozilla public license version 2.0", "mozilla public license 2.0"),
    "epl-2.0": ("eclipse public license version 2.0", "eclipse public license 2.0"),
    "eupl-1.2": ("european union public licence version 1.2",),
    "ofl-1.1": ("sil open font license version 1.1",),
    "artistic-2.0": ("artistic license 2.0",),
    "gpl": ("gnu general public license", "gnu gpl"),
    "gpl-2.0": ("gnu general public license version 2", "gpl version 2"),
    "gpl-3.0": ("gnu general public license version 3", "gpl version 3"),
    "lgpl": ("gnu lesser general public license", "gnu library general public license"),
    "agpl": ("gnu affero general public license",),
    "cc0": ("cc0 license", "creative commons zero license"),
}
# Names that are a notice where they stand alone, as titles do.
TITLES = {
    "mit": ("mit license",), "apache-2.0": ("apache license 2.0", "apache license version 2.0", "apache software license"), "bsd": ("bsd license",), "bsd-2-clause": ("bsd 2 clause license", "simplified bsd license"),
    "bsd-3-clause": ("bsd 3 clause license", "new bsd license"), "isc": ("isc license",), "zlib": ("zlib license",), "bsl-1.0": ("boost software license",), "mpl-2.0": ("mozilla public license version 2.0", "mozilla public license 2.0"),
    "epl-2.0": ("eclipse public license 2.0",), "lgpl": ("gnu lesser general public license",), "agpl": ("gnu affero general public license",), "gpl": ("gnu general public license",),
}
IDENTIFIERS = ("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "Unlicense", "BSL-1.0", "MPL-2.0", "EPL-2.0", "EUPL-1.2", "OFL-1.1", "Artistic-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0")
FORMS = ("licensed under", "released under", "distributed under", "available under", "under the terms of")
# Short names, which are notices after a form or the word licence only; dedications.
SHORT_NAMES = {
    "mit": ("mit",), "apache-2.0": ("apache 2.0", "apache v2"), "bsd": ("bsd",), "isc": ("isc",), "zlib": ("zlib",), "mpl-2.0": ("mpl 2.0", "mplv2"), "epl-2.0": ("epl 2.0",), "wtfpl": ("wtfpl",),
    "gpl": ("gpl",), "gpl-2.0": ("gplv2", "gpl v2", "gpl 2.0"), "gpl-3.0": ("gplv3", "gpl v3", "gpl 3.0"), "lgpl": ("lgpl",), "lgpl-2.1": ("lgplv2.1",), "lgpl-3.0": ("lgplv3",), "agpl": ("agpl",), "agpl-3.0": ("agplv3",), "cc0": ("cc0", "cc0 1.0"),
}
LABELS = ("license", "licence", "osi approved")
PUBLIC_DOMAIN = ("released into the public domain", "released to the public domain", "placed in the public domain", "dedicated to the public domain")
TERMS = {"by": "attribution", "sa": "sharealike", "nc": "noncommercial", "nd": "noderivatives"}
CODES = ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")
VERSIONS = ("3.0", "4.0")


def _notices():
    for label, names in NAMES.items():
        for form in FORMS:
            yield from ((label, f"{form} the {name}") for name in names)
    for code in CODES:
        full = " ".join(TERMS[x] for x in code.split("-"))
        for form in FORMS:
            for version in VERSIONS:
                yield f"cc-{code}", f"{form} cc {code} {version}"
                yield f"cc-{code}", f"{form} a creative commons {full} {version}"
    for name in IDENTIFIERS:
        label = name.lower().removesuffix("-1.0" if name.startswith("CC0") else "-4.0")
        yield label, f"spdx license identifier {name}"
    for label, names in SHORT_NAMES.items():
        for name in names:
            for form in (*FORMS, *LABELS):
                yield label, f"{form} {name}"
            for form in FORMS:
                yield label, f"{form} the {name}"
    for label, names in TITLES.items():
        yield from ((label, name) for name in names)
    yield from (("public-domain", text) for text in PUBLIC_DOMAIN)


def _expressions():
    """Identifiers joined by OR or AND, once for the label of each side."""
    label = {name: name.lower().removesuffix("-1.0" if name.startswith("CC0") else "-4.0") for name in IDENTIFIERS}
    for a in IDENTIFIERS:
        for b in IDENTIFIERS:
            for sign in ("or", "and") if a != b else ():
                yield label[a], f"{a} {sign} {b}"
                yield label[b], f"{a} {sign} {b}"


#: Expressions of two identifiers: their words tell nothing of a label, for they name two.
EXPRESSIONS = tuple(_expressions())
#: (label, text) of every template: passages, then notices by rule, then expressions.
TEMPLATES = (*PASSAGES, *_notices(), *EXPRESSIONS)
