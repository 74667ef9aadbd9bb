"""Licence recognition by sentence rules.

A text is read as normalised words with places where a sentence may begin or end: behind ``.;:!?``, and at
line ends, which may also stand within one. Known licence sentences are looked up in a trie
of their words; slots of a sentence take a number, a holder, a subject or the name of a licence.
A text so becomes a short sequence of sentence identifiers with
gaps where other sentences stood. Ordered rules, each an identifier sequence that may be
broken by a few unknown sentences, are matched against it: of rules that fit at a place,
the one that comes first wins, longer rules standing before their parts. A rule marked
``closed`` fits only if nothing unknown stands where a longer rule's sentence would: a BSD text
with a clause of its own is no BSD-2-Clause.

Rows are independent: no shuffle, no limit on the text's length. Texts without any word of a licence
never leave the JVM. The tables are of a fixed size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import let, without

# Names of licences by identifier. `#` is a version; `a?` may be missing, `(a|b)` is one of both.
NAMES: dict[str, tuple[str, ...]] = {
    "MIT": ("mit (license|licence)?", "mit/x11 license?", "expat license?"),
    "Apache-#": ("apache (software|public)? (license|licence) (version|v)? #", "apache #", "apache-#", "asl #"),
    "Apache": ("apache (software|public)? (license|licence)?",),
    "GPL-#-or-later": (
        "gnu? general public license (version|v)? # or (any|newer)? later? version?", "gnu? gpl (version|v)? # or later version?",
        "gnu? gpl (version|v)? # or at your option any later version"),
    "GPL-#": ("gnu? general public license (version|v)? #", "gnu? gpl (version|v)? # license?"),
    "GPL": ("gnu general public license", "gnu? gpl license?"),
    "LGPL-#-or-later": ("gnu? (lesser|library) general public license (version|v)? # or later", "gnu? lgpl (version|v)? # or later"),
    "LGPL-#": ("gnu? (lesser|library) general public license (version|v)? #", "gnu? lgpl (version|v)? # license?"),
    "LGPL": ("gnu? (lesser|library) general public license", "gnu? lgpl license?"),
    "AGPL-#-or-later": ("gnu? affero general public license (version|v)? # or later", "gnu? agpl (version|v)? # or later"),
    "AGPL-#": ("gnu? affero general public license (version|v)? #", "gnu? agpl (version|v)? # license?"),
    "AGPL": ("gnu? affero general public license", "gnu? agpl license?"),
    "MPL-#": ("mozilla public license (version|v)? #", "mpl (version|v)? #"),
    "EPL-#": ("eclipse public license (version|v)? #", "eclipse public license - v #", "epl (version|v)? #"),
    "BSD-4-Clause": ("original bsd license", "4-clause bsd license?", "bsd 4-clause license?"),
    "BSD-3-Clause": ("(new|modified|revised|3-clause|three-clause) bsd license?", "bsd (3-clause|three-clause) license?"),
    "BSD-2-Clause": ("(simplified|freebsd|2-clause|two-clause) bsd license?", "bsd (2-clause|two-clause) license?"),
    "0BSD": ("zero-clause bsd license?", "bsd zero clause license"),
    "BSD": ("bsd license?", "bsd-style license"),
    "ISC": ("isc license?",),
    "Zlib": ("zlib license?", "zlib/libpng license?"),
    "BSL-#": ("boost software license (version|v|-)? #", "boost license #"),
    "Unlicense": ("unlicense",),
    "WTFPL": ("wtfpl", "do what the fuck you want to public license"),
    "Artistic-#": ("artistic license #",),
    "CDDL-#": ("common development and distribution license (version|v)? #", "cddl (version|v)? #"),
    "EUPL-#": ("european union public licence (version|v)? #", "eupl (version|v)? #"),
    "OFL-#": ("sil? open font license (version|v)? #",),
    "PSF": ("python software foundation license", "psf license"),
    "CC0-#": ("cc0 #", "cc0 # universal", "creative commons zero # universal?", "creative commons cc0 # universal? license?"),
    "CC-BY-NC-ND-#": ("cc by-nc-nd #", "cc-by-nc-nd #", "creative commons attribution-noncommercial-noderivatives # (international|unported)? license?"),
    "CC-BY-NC-SA-#": ("cc by-nc-sa #", "cc-by-nc-sa #", "creative commons attribution-noncommercial-sharealike # (international|unported)? license?"),
    "CC-BY-NC-#": ("cc by-nc #", "cc-by-nc #", "creative commons attribution-noncommercial # (international|unported)? license?"),
    "CC-BY-ND-#": ("cc by-nd #", "cc-by-nd #", "creative commons attribution-noderivatives # (international|unported)? license?"),
    "CC-BY-SA-#": ("cc by-sa #", "cc-by-sa #", "creative commons attribution-sharealike # (international|unported)? license?"),
    "CC-BY-#": ("cc by #", "cc-by #", "creative commons attribution # (international|unported|generic)? license?"),
    "Public-Domain": ("public domain",),
}

# Known sentences by identifier, in normal form (lower case, no marks between words).
# `<name>` is a licence's name, `<spdx>` an SPDX expression, `<N>` up to N words of any kind.
SENTENCES: dict[str, tuple[str, ...]] = {
    "SPDX": ("spdx-license-identifier <spdx>",),
    "NOTICE": (
        "(licensed|released|distributed|published|available) under the? terms? of? the? <name>", "licensed under the <name> the license",
        "(is|are) (licensed|released|distributed|published|available|provided|covered) under (the|a|an)? <name>",
        "<8> (is|are) (licensed|released|distributed|published|available|provided|covered) under (the|a|an)? <name>",
        "<8> (is|are) (licensed|released|distributed|available|published) under the terms of the? <name>",
        "<8> made available under (the|a)? <name>", "<8> (licensed|released) under (the|a|an) <name>", "(license|licence) <name>"),
    "NOTICE-FILE": (
        "use of this source code is governed by (a|an|the) <name> that can be found in the license file",),
    "TITLE": ("the? mit (license|licence) mit?", "isc license", "the? zlib license", "bsd 2-clause license", "bsd 3-clause license", "bsd zero clause license"),
    "MIT-GRANT": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and/or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions",),
    "MIT-NOTICE": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software"),
    "ASIS-MIT": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement",),
    "NOLIABILITY-MIT": (
        "in no event shall the <8> or copyright holders be liable for any claim damages or other liability whether in an "
        "action of contract tort or otherwise arising from out of or in connection with the software or the use or other "
        "dealings in the software",),
    "ISC-GRANT": (
        "permission to use copy modify (and/or|and) distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",),
    "0BSD-GRANT": ("permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted",),
    "ASIS-ISC": ("the software is provided as is and <8> disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",),
    "BSD-GRANT": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "BSD-SOURCE": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "redistributions of source code must retain the copyright notice this list of conditions and the following disclaimer"),
    "BSD-BINARY": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution",),
    "BSD-ADVERT": ("all advertising materials mentioning features or use of this software must display the following (acknowledgement|acknowledgment)",),
    "BSD-INCLUDES": ("this product includes software developed by <24>",),
    "BSD-ENDORSE": (
        "neither the name of <24> may be used to endorse or promote products derived from this software without <3> prior written permission",
        "neither the names? of <24> may be used to endorse or promote products derived from this software without <3> prior written permission",
        "the names? of <24> may not be used to endorse or promote products derived from this software without <3> prior written permission"),
    "ASIS-BSD": (
        "this software is provided by <12> as is and any express or implied warranties including but not limited to "
        "the implied warranties of merchantability and fitness for a particular purpose are disclaimed",),
    "NOLIABILITY-BSD": (
        "in no event shall <12> be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to "
        "procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability "
        "whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised "
        "of the possibility of such damage",),
    "APACHE-COMPLY": ("you may not use this <3> except in compliance with the license",),
    "APACHE-OBTAIN": ("you may obtain a copy of the license at <url>", "a copy of the license is available at <url>"),
    "APACHE-ASIS": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an "
        "as is basis without warranties or conditions of any kind either express or implied",),
    "APACHE-SEE": ("see the license for the specific language governing permissions and limitations under the license",),
    "APACHE-TITLE": ("apache license version # january 2004",),
    "APACHE-TERMS": ("terms and conditions for use reproduction and distribution",),
    "GPL-TITLE": ("gnu general public license version # <2> (1991|2007)",),
    "LGPL-TITLE": ("gnu (lesser|library) general public license version # <2> (1991|1999|2007)",),
    "AGPL-TITLE": ("gnu affero general public license version # <2> 2007",),
    "GPL-VERBATIM": ("everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed",),
    "GPL-FREE": ("<6> is free software",),
    **{f"{k}-{part}": tuple(t.replace("KIND", kind) for t in templates) for k, kind in (
        ("GPL", "gnu general public license"), ("LGPL", "gnu (lesser|library) general public license"), ("AGPL", "gnu affero general public license"))
       for part, templates in {
           "TERMS-LATER": ("you can redistribute it and/or modify it under the terms of the KIND as published by the free software foundation "
                           "either version # of the license or at your option any later version",),
           "TERMS-ONLY": ("you can redistribute it and/or modify it under the terms of the KIND version # as published by the free software foundation",
                          "you can redistribute it and/or modify it under the terms of version # of the KIND as published by the free software foundation",
                          "you can redistribute it and/or modify it under the terms of the KIND as published by the free software foundation version #"),
           "TERMS": ("you can redistribute it and/or modify it under the terms of the KIND as published by the free software foundation",),
           "SEE": ("see the KIND for more details",),
           "RECEIVED": ("you should have received a copy of the KIND along with <6>",)}.items()},
    "GPL-LATER": ("either version # of the license or at your option any later version",),
    "GPL-THIS": ("version # of the license",),
    "GPL-HOPE": ("<6> is distributed in the hope that it will be useful but without any warranty",),
    "GPL-EVEN": ("without even the implied warranty of merchantability or fitness for a particular purpose",),
    "MPL-HEADER": ("this source code form is subject to the terms of the mozilla public license (v|version) #",),
    "MPL-OBTAIN": ("if a copy of the mpl was not distributed with this file you can obtain one at <url>",),
    "MPL-TITLE": ("mozilla public license version #",),
    "EPL-HEADER": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license (version|v)? # which <8>",
        "this program and the accompanying materials are made available under the terms of the eclipse public license (version|v)? #"),
    "EPL-TITLE": ("eclipse public license - v #", "eclipse public license version #"),
    "ZLIB-ASIS": ("this software is provided as is without any express or implied warranty", "this software is provided as-is without any express or implied warranty"),
    "ZLIB-DAMAGES": ("in no event will the authors be held liable for any damages arising from the use of this software",),
    "ZLIB-GRANT": (
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and "
        "redistribute it freely subject to the following restrictions",),
    "ZLIB-ORIGIN": ("the origin of this software must not be misrepresented",),
    "ZLIB-ALTERED": ("altered source versions must be plainly marked as such and must not be misrepresented as being the original software",),
    "ZLIB-NOTICE": ("this notice may not be removed or altered from any source distribution",),
    "BSL-TITLE": ("boost software license - version # - august 17th 2003",),
    "BSL-SHORT": ("use modification and distribution are subject to the boost software license version #",
                  "distributed under the boost software license version # see accompanying file <8>"),
    "BSL-GRANT": (
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation "
        "covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works "
        "of the software and to permit third-parties to whom the software is furnished to do so all subject to the following",),
    "UNLICENSE": ("this is free and unencumbered software released into the public domain",),
    "PUBLIC-DOMAIN": ("<6> is in the public domain", "released into the public domain", "placed in the public domain", "<8> (released|placed|dedicated) (into|in|to) the public domain"),
    "ALL-RIGHTS": ("all rights reserved",),
}

# Fixed values: (licence, identifiers in order, closed). The first rule that fits at a place wins.
# A `#` in the licence takes the version of the sentence that has one; `*` is what the sentence names.
_GNU = [(f"{k}-#{later}", (*head, *tail), False) for k in ("AGPL", "LGPL", "GPL")
        for later, head in (("-or-later", ("GPL-FREE", f"{k}-TERMS-LATER")), ("-or-later", ("GPL-FREE", f"{k}-TERMS", "GPL-LATER")),
                            ("", ("GPL-FREE", f"{k}-TERMS-ONLY")), ("", ("GPL-FREE", f"{k}-TERMS", "GPL-THIS")))
        for tail in (("GPL-HOPE", "GPL-EVEN", f"{k}-SEE", f"{k}-RECEIVED"), ("GPL-HOPE", "GPL-EVEN"), ())]
RULES: tuple[tuple[str, tuple[str, ...], bool], ...] = (
    ("*", ("SPDX",), False),
    ("MIT", ("MIT-GRANT", "MIT-NOTICE", "ASIS-MIT", "NOLIABILITY-MIT"), False),
    ("MIT", ("MIT-GRANT", "MIT-NOTICE", "ASIS-MIT"), False),
    ("MIT", ("MIT-GRANT", "MIT-NOTICE"), False),
    ("ISC", ("ISC-GRANT", "ASIS-ISC"), False),
    ("ISC", ("ISC-GRANT",), False),
    ("0BSD", ("0BSD-GRANT", "ASIS-ISC"), False),
    ("BSD-4-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ADVERT", "BSD-INCLUDES", "BSD-ENDORSE", "ASIS-BSD", "NOLIABILITY-BSD"), False),
    ("BSD-4-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ADVERT", "BSD-INCLUDES", "BSD-ENDORSE", "ASIS-BSD"), False),
    ("BSD-4-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ADVERT", "BSD-INCLUDES", "BSD-ENDORSE"), False),
    ("BSD-3-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE", "ASIS-BSD", "NOLIABILITY-BSD"), False),
    ("BSD-3-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE", "ASIS-BSD"), False),
    ("BSD-3-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE"), False),
    ("BSD-2-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "ASIS-BSD", "NOLIABILITY-BSD"), True),
    ("BSD-2-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "ASIS-BSD"), True),
    ("BSD-2-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY"), True),
    ("BSD-Other", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY"), False),
    ("Apache-#", ("NOTICE", "APACHE-COMPLY", "APACHE-OBTAIN", "APACHE-ASIS", "APACHE-SEE"), False),
    ("Apache-#", ("NOTICE", "APACHE-COMPLY", "APACHE-OBTAIN"), False),
    ("Apache-#", ("NOTICE", "APACHE-COMPLY"), False),
    ("Apache-#", ("APACHE-TITLE", "APACHE-TERMS"), False),
    *_GNU,
    ("LGPL-#", ("LGPL-TITLE", "GPL-VERBATIM"), False),
    ("AGPL-#", ("AGPL-TITLE", "GPL-VERBATIM"), False),
    ("GPL-#", ("GPL-TITLE", "GPL-VERBATIM"), False),
    ("MPL-#", ("MPL-HEADER", "MPL-OBTAIN"), False),
    ("MPL-#", ("MPL-HEADER",), False),
    ("MPL-#", ("MPL-TITLE",), False),
    ("EPL-#", ("EPL-HEADER",), False),
    ("EPL-#", ("EPL-TITLE",), False),
    ("Zlib", ("ZLIB-ASIS", "ZLIB-DAMAGES", "ZLIB-GRANT", "ZLIB-ORIGIN", "ZLIB-ALTERED", "ZLIB-NOTICE"), False),
    ("Zlib", ("ZLIB-GRANT", "ZLIB-ORIGIN", "ZLIB-ALTERED", "ZLIB-NOTICE"), False),
    ("BSL-#", ("BSL-TITLE", "BSL-GRANT"), False),
    ("BSL-#", ("BSL-TITLE",), False),
    ("BSL-#", ("BSL-SHORT",), False),
    ("BSL-1.0", ("BSL-GRANT",), False),
    ("Unlicense", ("UNLICENSE",), False),
    ("*", ("NOTICE-FILE",), False),
    ("*", ("NOTICE",), False),
    ("*", ("TITLE",), False),
    ("Public-Domain", ("PUBLIC-DOMAIN",), False),
    ("All-Rights-Reserved", ("ALL-RIGHTS",), False),
)

#: Every known sentence has one of these words; texts without any have no licence.
HINT = (r"licen[cs]e|\b[al]?gpl|public\W+licence|permission|copyright|redistribut|warrant|liable|public\W+domain|rights\W+reserved|\bmpl\b|endorse|advertising|spdx|"
        r"free\W+software|use[, ]+reproduction|restrictions|damages|misrepresented|this notice|developed by|free software foundation")
#: Each text with a hint holds one of these in lower case; they are cheap to look for.
CORES = ("licen gpl permission copyright redistribut warrant liable domain reserved mpl endorse advertising spdx software reproduction "
         "restrictions damages misrepresented notice developed").split()
_LINES = re.compile(r"\r\n|[\n\r\x0b\x0c]")
_LEAD = re.compile(r"[ \t]*(?:(?:[#*/%;>|!-]+|REM\b|dnl\b|<!--)[ \t]*)*")
_ITEM = re.compile(r"(?:\(?(?:\d{1,2}|[a-z])[.)]|[*•-])(?=[ \t]+\S)[ \t]*", re.IGNORECASE)
_QUOTES = "\"'`‘’“”()<>[]{}*_|"
_NUMBER = re.compile(r"v?[._]?(\d+(?:\.\d+)*)\+?")
_GLUED = re.compile(r"(a?gpl|lgpl|epl|mpl|cc0|asl)-?(v?\d[\d.]*)\+?")
_SPDX = re.compile(r"[a-z0-9][a-z0-9.+-]*")


def expand(template: str) -> list[list[str]]:
    """All word sequences of a template."""
    choices = []
    for part in template.split(" "):
        optional = part.endswith("?") and len(part) > 1
        words = part.rstrip("?").strip("()").split("|") if part.startswith("(") else [part.rstrip("?") if optional else part]
        choices.append([*([""] if optional else []), *words])
    return [[w for w in words if w] for words in product(*choices)]


END = ""  # a trie's mark of a whole sentence: no word is empty


def _insert(trie: dict, words: list[str], value: str) -> None:
    for w in words:
        trie = trie.setdefault(w, {})
    trie.setdefault(END, value)


@cache
def tries() -> tuple[dict, dict]:
    """The words of all known sentences, and of all names."""
    names, sentences = {}, {}
    for table, trie in ((NAMES, names), (SENTENCES, sentences)):
        for value, templates in table.items():
            for t in templates:
                for words in expand(t):
                    _insert(trie, words, value)
    return sentences, names


class Words:
    """A text's normal words: ``word``; ``begins`` and ``ends`` (a sentence may); ``stop`` (one does end here), ``full`` (with
    a full stop or an empty line, which no sentence goes over); and ``item`` (a list item begins here)."""

    def __init__(self, text: str):
        self.word, self.raw, self.begins, self.ends, self.stop, self.full, self.item = [], [], [], [], [], [], []
        for line in _LINES.split(text):
            lead = _LEAD.match(line).end()
            mark = _ITEM.match(line, lead)
            at = mark.end() if mark else lead
            parts = line[at:].split()
            if not parts:
                if self.stop and self.word[-2:] != ["license", "at"]:  # an empty line ends a sentence, unless it sets off an address
                    self.stop[-1] = self.full[-1] = True
                continue
            item = mark is not None or (lead > 0 and line[:lead].rstrip()[-1:] in ("*", "-"))
            begins = True
            for raw in parts:
                bare = raw.strip(_QUOTES + ".,;:!?") or ""
                closing = raw.rstrip(_QUOTES)[-1:]
                ends = closing in (".", ";", ":", "!", "?")
                if not bare:
                    if raw.strip(_QUOTES) == "-":
                        bare = "-"
                    else:
                        if ends and self.stop:
                            self.stop[-1] = self.ends[-1] = begins = True
                            self.full[-1] |= closing in ".!?"
                        continue
                low = bare.lower().replace("“", "").replace("”", "").replace('"', "").replace("’", "").replace("'", "")
                glued = _GLUED.fullmatch(low)
                for w in glued.groups() if glued else (low,):
                    self.word.append(w)
                    self.raw.append(bare)
                    self.begins.append(begins)
                    self.item.append(begins and item)
                    self.ends.append(False)
                    self.stop.append(False)
                    self.full.append(False)
                    begins = item = False
                abbreviation = low in ("v", "no", "inc", "ltd", "co", "corp", "llc", "dr", "jr", "st")
                self.full[-1] = closing in (".", "!", "?") and not (abbreviation and closing == ".")
                self.ends[-1] = self.stop[-1] = begins = ends and not (abbreviation and closing == ".")
            self.ends[-1] = True
        if self.stop:
            self.stop[-1] = True


def _match(words: Words, trie: dict, names: dict, at: int, number: str, name: str, out: list) -> None:
    """Known sentences from ``at`` on: (end, identifier, number, name)."""
    stack = [(trie, at, number, name)]
    n = len(words.word)
    while stack:
        node, i, number, name = stack.pop()
        if END in node and i > at and words.ends[i - 1]:
            out.append((i, node[END], number, name))
        if i >= n or (i > at and words.full[i - 1]):
            continue
        w = words.word[i]
        for key, child in node.items():
            if key == END:
                continue
            if key == w:
                stack.append((child, i + 1, number, name))
            elif key == "#":
                if found := _NUMBER.fullmatch(w):
                    stack.append((child, i + 1, found[1], name))
            elif key == "<url>":
                if w.startswith(("http://", "https://", "www.")):
                    stack.append((child, i + 1, number, name))
            elif key == "<name>":
                found = []
                _names(words, names, i, found)
                stack += [(child, end, v or number, label) for end, label, v in found]
            elif key == "<spdx>":
                end = i + 1
                while end + 1 < n and words.word[end] in ("or", "and", "with"):
                    end += 2
                if all(_SPDX.fullmatch(x) for x in words.word[i:end]):
                    stack.append((child, end, number, " ".join(words.raw[i:end])))
            elif key[0] == "<" and key[1:-1].isdigit():
                most = min(n, i + int(key[1:-1]))
                stack += [(child, end, number, name) for end in range(i + 1, most + 1) if not any(words.stop[i: end - 1])]
    # The longest comes first; where two end alike, the one with a version.
    out.sort(key=lambda x: (-x[0], x[2] == "", x[3] == ""))


def _names(words: Words, node: dict, at: int, out: list) -> None:
    stack, n = [(node, at, "")], len(words.word)
    while stack:
        node, i, number = stack.pop()
        if END in node:
            out.append((i, node[END].replace("#", number), number))
        if i < n:
            if (child := node.get(words.word[i])) is not None:
                stack.append((child, i + 1, number))
            if (child := node.get("#")) is not None and (found := _NUMBER.fullmatch(words.word[i])):
                stack.append((child, i + 1, found[1]))


_HINT_WORD = re.compile(HINT, re.IGNORECASE)
#: Words that each known sentence has one of, near which sentences are looked for.
_NEAR = re.compile(
    r"licen[cs]e|licen[cs]ed|permission|copyright|redistributions?|warrant|liable|domain|reserved|mpl|endorse|advertising|spdx|software|reproduction|"
    r"restrictions|damages|misrepresented|notice|developed|redistribute|released|published|available|covered|provided|distributed|merchantability")


@cache
def _longest() -> int:
    size = lambda w: int(w[1:-1]) if w[0] == "<" and w[1:-1].isdigit() else 12 if w in ("<name>", "<spdx>") else 1
    return max(sum(map(size, words)) for known in SENTENCES.values() for t in known for words in expand(t))


def known_sentences(text: str) -> list[tuple[int, int, str, str, str, Words]]:
    """(first word, end, identifier, number, name, words) of the known sentences of a text, in order, none overlapping."""
    words = Words(text)
    trie, names = tries()
    reach, last, near = _longest(), -1, []
    for i, w in enumerate(words.word):
        if _NEAR.search(w):
            near.append(i)
    out, done, k = [], 0, 0
    for i, begins in enumerate(words.begins):
        if not begins or i < done:
            continue
        while k < len(near) and near[k] < i:
            k += 1
        if k == len(near):
            break
        if near[k] - i > reach:
            continue
        found: list = []
        _match(words, trie, names, i, "", "", found)
        if found:
            end, label, number, name = found[0]
            out.append((i, end, label, number, name, words))
            done = end
    return out


def licenses_of(text: str | None, max_gap: int = 2) -> list[dict]:
    """The matched rules in order: ``license``, ``first`` and ``last`` sentence (numbers from 0), ``sentences``."""
    if not text or not _HINT_WORD.search(text):
        return []
    found = known_sentences(text)
    if not found:
        return []
    words = found[0][5]
    number_of, n = [], 0  # sentence that each word stands in; a known sentence is one
    starts = {f[0] for f in found}
    within = {i for f in found for i in range(f[0], f[1] - 1)}
    for i in range(len(words.word)):
        if i in starts and i and number_of[-1] == n and not words.stop[i - 1]:
            n += 1
        number_of.append(n)
        if i not in within and (words.stop[i] or i + 1 in starts):
            n += 1
    sentence = lambda f: number_of[f[0]]
    out, at = [], 0
    while at < len(found):
        for name, ids, closed in RULES:
            some = found[at: at + len(ids)]
            if [f[2] for f in some] != list(ids):
                continue
            gaps = [sentence(b) - sentence(a) - 1 for a, b in zip(some, some[1:])]
            if any(g > max_gap for g in gaps):
                continue
            if closed:
                # Nothing of its own between its clauses, nor an unknown item or clause behind them.
                after = some[-1][1]
                follows = after < len(words.word) and number_of[after] not in {sentence(f) for f in found[at + len(ids): at + len(ids) + 1]}
                if any(gaps) or (follows and words.item[after]) or (follows and ids[-1] == "BSD-BINARY" and at + len(ids) < len(found)):
                    continue
            version = next((f[3] for f in some if f[3]), "")
            label = some[0][4] if name == "*" else name.replace("#", version)
            if name == "*" and ids == ("TITLE",):
                label = _title(words, some[0])
            if name.startswith("Apache") and ids[0] == "NOTICE" and not some[0][4].startswith("Apache"):
                continue
            out.append({"license": label, "first": sentence(some[0]), "last": sentence(some[-1]), "sentences": list(ids)})
            at += len(ids)
            break
        else:
            at += 1
    return out


def _title(words: Words, found: tuple) -> str:
    """The licence that a title names."""
    names: list = []
    _names(words, tries()[1], found[0] + (words.word[found[0]] == "the"), names)
    return max(names)[1] if names else ""


def scan(docs: DataFrame, text: str = "text", max_gap: int = 2) -> DataFrame:
    """``docs`` with ``licenses``, an array of (license, first, last, sentences): the matched rules
    in order, the numbers of their first and last sentence (from 0) and the identifiers.

    Between two sentences of a rule up to ``max_gap`` unknown ones may stand, a known one of
    another kind may not. A sentence serves one match. Null and empty texts, and texts without
    a known sentence, have an empty array. Rows are independent, repeated rows have equal results; a column ``licenses`` is
    replaced."""
    plain = without(docs, ["licenses"])
    kind = "array<struct<license:string,first:int,last:int,sentences:array<string>>>"
    arrow = pa.list_(pa.struct([("license", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("sentences", pa.list_(pa.string()))]))
    at = plain.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [licenses_of(v.as_py(), max_gap) for v in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, arrow)], [*batch.schema.names, "licenses"])

    cores = F.array(*[F.lit(c) for c in CORES])
    hinted = F.coalesce(let(F.lower(F.col(text)), lambda low: F.exists(cores, lambda c: F.contains(low, c))), F.lit(False))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    rest = plain.where(~hinted).withColumn("licenses", F.array().cast(kind))
    return plain.where(hinted).mapInArrow(run, f"{fields}, licenses {kind}").unionByName(rest)
