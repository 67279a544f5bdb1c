"""License scans by sentence rules.

A text is cut into sentences, normalised, and each that equals a known licence
sentence becomes that sentence's identifier, with the version it names. The
sequence of identifiers is then matched, from left to right, against ordered
licence rules: at each place the first rule whose identifiers come next takes
them, so the rules list longer sequences before their parts. Identifiers that
no rule takes are reported as unmatched.

A sentence may be broken over lines: a clause (up to a line or sentence end)
that begins a known sentence takes on the clauses after it as long as they
continue one. A known sentence may have gaps, which names of up to GAP words
fill. Sentences that only grant a licence by its name ("this work is licensed
under ...") are read as a lead-in, a verb and known names: one, either of
several, or one for the code and another for the rest, and a known tail ("see
LICENSE for details"). ``SPDX-License-Identifier`` tags are read as written.

What comes near leaves a trace: a sentence that begins like a known one for
NEAR_WORDS words but goes on otherwise, and a grant whose name is known but
whose tail is not, have identifiers that no rule takes.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from ledgerflow.llm.arrow import with_columns

#: Words that a gap ("*") in a known sentence takes at most.
GAP = 12
#: Words at the beginning of a known sentence that make another one a near miss.
NEAR_WORDS = 8
_FREE = "* is free software: you can redistribute it and/or modify it under the terms of the GNU {} General Public License "
_FSF = "as published by the Free Software Foundation"
# Known licence sentences. "#" stands for a version number, "*" for a name.
SENTENCES = {
    "gpl.work": "this work is licensed under the GNU General Public License, version #",
    "gpl.under": "licensed under the GNU General Public License, version #",
    "gpl.free": "this program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version # of the License, "
                "or (at your option) any later version",
    "gpl.only": "this program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License version # as published by the Free Software Foundation",
    "gpl.hope": "this program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl.see": "see the GNU General Public License for more details",
    "lgpl.under": "licensed under the GNU Lesser General Public License, version #",
    "agpl.under": "licensed under the GNU Affero General Public License, version #",
    "apache.under": "licensed under the Apache License, Version #",
    "apache.paren": "licensed under the Apache License, Version # (the \"License\")",
    "apache.asf": "the ASF licenses this file to you under the Apache License, Version # (the \"License\")",
    "apache.comply": "you may not use this file except in compliance with the License",
    "apache.asis": "unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "mit.released": "released under the MIT License",
    "mit.under": "licensed under the MIT License",
    "mit.grant": "permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
                 "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                 "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
                 "following conditions",
    "mit.notice": "the above copyright notice and this permission notice shall be included in all copies or substantial "
                  "portions of the Software",
    "bsd.grant": "redistribution and use in source and binary forms, with or without modification, are permitted provided "
                 "that the following conditions are met",
    "bsd.source": "redistributions of source code must retain the above copyright notice, this list of conditions and the "
                  "following disclaimer",
    "bsd.binary": "redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                  "following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd.endorse": "neither the name of * nor the names of its contributors may be used to endorse or "
                   "promote products derived from this software without specific prior written permission",
    "mpl.form": "this Source Code Form is subject to the terms of the Mozilla Public License, v. #",
    "cc.by": "licensed under CC BY #",
    "cc.bysa": "licensed under CC BY-SA #",
    "cc.bync": "licensed under CC BY-NC #",
    "cc.zero": "licensed under CC0 #",
    "bsd.author": "the name of * may not be used to endorse or promote products derived from this software without specific "
                  "prior written permission",
    "bsd.advert": "all advertising materials mentioning features or use of this software must display the following "
                  "acknowledgement",
    "any.hope": "* is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
                "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "lgpl.see": "see the GNU Lesser General Public License for more details",
    "agpl.see": "see the GNU Affero General Public License for more details",
    "isc.grant": "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                 "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc.and": "permission to use, copy, modify, and distribute this software for any purpose with or without fee is "
               "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mit.asis": "the Software is provided \"AS IS\", without warranty of any kind, express or implied, including but not limited to "
                "the warranties of merchantability, fitness for a particular purpose and noninfringement",
    "mit.event": "in no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in "
                 "an action of contract, tort or otherwise, arising from, out of or in connection with the Software or the use or "
                 "other dealings in the Software",
    "bsd.asis": "this software is provided by the copyright holders and contributors \"AS IS\" and any express or implied warranties, "
                "including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are "
                "disclaimed",
    "bsd.style": "use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
    "bsd.style2": "use of this source code is governed by a BSD style license that can be found in the LICENSE.txt file",
    "mit.style": "use of this source code is governed by an MIT-style license that can be found in the LICENSE file",
    "isc.asis": "the Software is provided \"AS IS\" and the author disclaims all warranties with regard to this software including all "
                "implied warranties of merchantability and fitness",
    "gpl.text2": "GNU General Public License Version #, June #",
    "gpl.text3": "GNU General Public License Version #, # June #",
    "lgpl.text2": "GNU Lesser General Public License Version #, February #",
    "lgpl.text3": "GNU Lesser General Public License Version #, # June #",
    "agpl.text": "GNU Affero General Public License Version #, # November #",
    "apache.text": "Apache License Version #, January #",
    "text.end": "end of terms and conditions",
    "mpl.text": "Mozilla Public License Version #",
    "epl.text": "Eclipse Public License - v #",
    "boost.text": "Boost Software License - Version # - August #th, #",
    "boost.grant": "permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                   "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
                   "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties "
                   "to whom the Software is furnished to do so, all subject to the following",
    "zlib.asis": "this software is provided 'as-is', without any express or implied warranty",
    "zlib.event": "in no event will the authors be held liable for any damages arising from the use of this software",
    "zlib.grant": "permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
                  "alter it and redistribute it freely, subject to the following restrictions",
    "ofl.text": "SIL Open Font License Version # - # February #",
    "unlicense.free": "this is free and unencumbered software released into the public domain",
} | {f"{kind}.{form}": _FREE.format(word) + text for kind, word in (("gpl2", ""), ("lgpl", "Lesser"), ("agpl", "Affero"))
     for form, text in (("free", f"{_FSF}, either version # of the License, or (at your option) any later version"),
                        ("only", f"version # {_FSF}"), ("only2", f"{_FSF}, version # of the License"))}
#: Ordered rules: the licence (with "#" for the version) and the identifiers that state it.
RULES = (
    ("GPL-#-or-later", ("gpl.free", "gpl.hope", "gpl.see")),
    ("GPL-#-or-later", ("gpl.free",)),
    ("GPL-#-only", ("gpl.only", "gpl.hope", "gpl.see")),
    ("GPL-#-only", ("gpl.only",)),
    ("GPL-#", ("gpl.work",)),
    ("GPL-#", ("gpl.under",)),
    ("LGPL-#", ("lgpl.under",)),
    ("AGPL-#", ("agpl.under",)),
    ("Apache-#", ("apache.paren", "apache.comply", "apache.asis")),
    ("Apache-#", ("apache.paren",)),
    ("Apache-#", ("apache.under",)),
    ("MIT", ("mit.grant", "mit.notice")),
    ("MIT", ("mit.released",)),
    ("MIT", ("mit.under",)),
    ("BSD-3-Clause", ("bsd.grant", "bsd.source", "bsd.binary", "bsd.endorse")),
    ("BSD-2-Clause", ("bsd.grant", "bsd.source", "bsd.binary")),
    ("MPL-#", ("mpl.form",)),
    ("CC-BY-#", ("cc.by",)),
    ("CC-BY-SA-#", ("cc.bysa",)),
    ("CC-BY-NC-#", ("cc.bync",)),
    ("CC0-#", ("cc.zero",)),
    ("ISC", ("isc.grant",)),
    ("ISC", ("isc.and",)),
    ("Unlicense", ("unlicense.free",)),
)
_BSD = ("bsd.grant", "bsd.source", "bsd.binary")
_GNU = tuple((f"{name}-#-{end}", (f"{kind}.{form}", *rest)) for kind, name in (("gpl", "GPL"), ("gpl2", "GPL"), ("lgpl", "LGPL"), ("agpl", "AGPL"))
             for form, end in (("free", "or-later"), ("only", "only"), ("only2", "only"))
             for rest in ((hope, f"{kind.rstrip('2')}.see") for hope in ("gpl.hope", "any.hope")))
RULES = (*(("Apache-#", (grant, "apache.comply", "apache.asis")) for grant in ("apache.under", "apache.asf")), ("Apache-#", ("apache.asf",)),
         *_GNU, *((name, (sequence,)) for name, (sequence, *_) in _GNU[::2]),
         ("BSD-4-Clause", (*_BSD, "bsd.advert", "bsd.endorse")), ("BSD-4-Clause", (*_BSD, "bsd.advert", "bsd.author")),
         ("BSD-3-Clause", (*_BSD, "bsd.author")), *RULES)

RULES = (*((f"{name}-#", (head, *end)) for end in (("text.end",), ()) for name, head in (
             ("GPL", "gpl.text2"), ("GPL", "gpl.text3"), ("LGPL", "lgpl.text2"), ("LGPL", "lgpl.text3"), ("AGPL", "agpl.text"), ("Apache", "apache.text"))),
         ("MPL-#", ("mpl.text",)), ("EPL-#", ("epl.text",)), ("OFL-#", ("ofl.text",)),
         ("BSL-#", ("boost.text", "boost.grant")), ("BSL-#", ("boost.text",)), ("BSL-1.0", ("boost.grant",)),
         ("Zlib", ("zlib.asis", "zlib.event", "zlib.grant")), ("Zlib", ("zlib.grant",)),
         ("MIT", ("mit.grant", "mit.notice", "mit.asis", "mit.event")), ("MIT", ("mit.grant", "mit.notice", "mit.asis")),
         ("ISC", ("isc.grant", "isc.asis")), ("ISC", ("isc.and", "isc.asis")),
         ("BSD-4-Clause", (*_BSD, "bsd.advert", "bsd.endorse", "bsd.asis")), ("BSD-3-Clause", (*_BSD, "bsd.endorse", "bsd.asis")),
         ("BSD-2-Clause", (*_BSD, "bsd.asis")), ("BSD", ("bsd.style",)), ("BSD", ("bsd.style2",)), ("MIT", ("mit.style",)), *RULES)

#: Names of licences in grants, in normalised words, by the identifier that they get.
NAMES: dict[str, list[str]] = {}
for _kind, _word, _short in (("gpl", "", "gpl"), ("lgpl", "lesser ", "lgpl"), ("agpl", "affero ", "agpl")):
    _long = f"{_word}general public license"
    _any = [f"{gnu}{name}{v}" for gnu in ("gnu ", "") for name in (_long, f"{_long} {_short}", _short) for v in (" version #", " #")]
    _later = (" or later", " or any later version", " or at your option any later version")
    NAMES |= {f"{_kind}.under": _any, f"{_kind}.later": [n + end for n in _any for end in _later],
              f"{_kind}.bare": [f"{gnu}{name}" for gnu in ("gnu ", "") for name in (_long, _short)]}
NAMES |= {
    "apache.under": [f"apache{x}{v} #{y}" for x in (" license", "") for v in (" version", "") for y in ("", " license", " the license")],
    "mit.under": ["mit license", "mit", "expat license"],
    "bsd2.under": ["# clause bsd license", "bsd # clause license", "bsd # clause"],
    "bsd.under": ["bsd license"],
    "isc.under": ["isc license"],
    "mpl.under": [f"{x}{v} #" for x in ("mozilla public license", "mpl") for v in (" version", "")],
    "epl.under": [f"{x}{v} #" for x in ("eclipse public license", "epl") for v in (" version", "")],
    "boost.under": [f"{x}{v} #" for x in ("boost software license", "boost license", "bsl") for v in (" version", "")],
    "zlib.under": ["zlib license", "zlib", "zlib libpng license"],
    "ofl.under": [f"{sil}{x}{v} #" for sil in ("sil ", "") for x in ("open font license", "ofl") for v in (" version", "")],
    "odbl.under": ["open database license", "open data commons open database license", "odbl", "open database license odbl",
                   "open database license #", "open data commons open database license #", "odbl #"],
    "unlicense.under": ["unlicense"],
    "cc.zero": [f"{x} #{y}" for x in ("cc0", "creative commons zero", "creative commons cc0", "creative commons zero version")
                for y in ("", " universal", " license", " universal license", " universal public domain dedication")],
}
_CC = (("by", "attribution", ""), ("bysa", "attribution sharealike", "SA-"), ("bync", "attribution noncommercial", "NC-"),
       ("bynd", "attribution noderivatives", "ND-"), ("byncsa", "attribution noncommercial sharealike", "NC-SA-"),
       ("byncnd", "attribution noncommercial noderivatives", "NC-ND-"))
for _kind, _word, _end in _CC:
    _short = "by " + _end.lower().replace("-", " ")
    _words = {_word, _word.replace("sharealike", "share alike").replace("noncommercial", "non commercial").replace("noderivatives", "no derivatives"),
              _word.replace("noderivatives", "noderivs")}
    NAMES[f"cc.{_kind}"] = [f"{name} #{y}" for name in (f"cc {_short}".strip(), f"creative commons {_short}".strip(),
                                                        *(f"creative commons {w}" for w in sorted(_words)))
                            for x in ("", " international", " unported", " generic") for y in (x, x + " license", x + " public license")]
RULES += tuple((f"{n}-#-or-later", (f"{n.lower()}.later",)) for n in ("GPL", "LGPL", "AGPL"))
RULES += tuple((n, (f"{n.lower()}.bare",)) for n in ("GPL", "LGPL", "AGPL"))
RULES += (("BSD-#-Clause", ("bsd2.under",)), ("BSD", ("bsd.under",)), ("ISC", ("isc.under",)), ("MPL-#", ("mpl.under",)),
          ("EPL-#", ("epl.under",)), ("BSL-#", ("boost.under",)), ("Zlib", ("zlib.under",)), ("OFL-#", ("ofl.under",)),
          ("ODbL-1.0", ("odbl.under",)), ("Unlicense", ("unlicense.under",)), ("#", ("spdx.tag",)), *((f"CC-BY-{end}#", (f"cc.{kind}",)) for kind, _, end in _CC))

#: Rules of identifiers that something gives.
RULES = tuple(r for r in RULES if all(n in SENTENCES or n in NAMES or n == "spdx.tag" for n in r[1]))

_GRANT = re.compile(r"(?:(?:except where|unless) otherwise (?:noted|stated|indicated) )?(?:(?:this|the|these|all|our)(?: \S+){0,5}? (?:is|are) )?"
                    r"(?:hereby )?(?:licensed|released|distributed|published|made available|available|provided) under "
                    r"(?:the terms (?:and conditions )?of )?(?:(?:the|a|an) )?(.*)")
#: What may stand before the first of several names, between them, and behind the last one.
_EITHER = re.compile(r"(?:either(?: of)?|both|dual|your choice of|one of)(?: the| an?)? ")
_NEXT = re.compile(r" (?:and or|and|or)(?: (?:(?:the|its|all|any|other) )?(?:\S+ ){1,3}(?:is |are )?(?:licensed |released )?under)?(?: the terms of)?(?: the| an?)? ")
_TAIL = re.compile(r" ?(?:the license|license terms|at your option|as found in .*|see .*|which (?:is available|accompanies|can be found|you can find) .*"
                   r"|that can be found in .*|found in .*|a copy of .*|available (?:at|from) .*|https? .*|copyright .*|all rights reserved)?")
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*(\(?[A-Za-z0-9][A-Za-z0-9.+-]*(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(?[A-Za-z0-9][A-Za-z0-9.+-]*\)*)*\)*)")
#: What may still become a grant by the clauses after it.
_LEADS = frozenset("except unless this the these all our hereby licensed released distributed published made available provided".split())
_LEAD_WORDS = 14

_VERSION = re.compile(r"(?<![^\W_])([al]?gpl|[me]pl)?v(?=[0-9])")
_V = re.compile("v[0-9]")
_ITEM = re.compile(r"\W*(?:[0-9]{1,2}|[a-z])\)\s")
_CLAUSE = re.compile(r"[\n\r]+|(?<=[.!?;:])[ \t]+")
_TOKEN = re.compile(r"[0-9]+(?:\.[0-9]+)*|[^\W\d_][^\W_]*")


def normalise(text: str) -> tuple[tuple[str, ...], list[str]]:
    """(words in lower case with "#" for every version number, those numbers); "v2" is "version 2"."""
    low = text.lower().replace("licence", "license")
    words = _TOKEN.findall(_VERSION.sub(r"\1 version ", low) if _V.search(low) else low)
    if "v" in words:
        words = ["version" if w == "v" else w for w in words]
    return tuple("#" if w[0].isdecimal() else w for w in words), [w for w in words if w[0].isdecimal()]


class SentenceIndex:
    """Known sentences by their words, and the beginnings that make it worth reading on."""

    def __init__(self, sentences: dict[str, str], names: dict[str, list[str]] | None = None):
        self.known: dict[tuple[str, ...], str] = {}
        self.gapped: dict[str, list[tuple[str, ...]]] = {}
        for name, text in sentences.items():
            # a "#" in the list is a number in a text
            if "*" in text:
                self.gapped[name] = [normalise(part.replace("#", "0"))[0] for part in text.split("*")]
                continue
            words = normalise(text.replace("#", "0"))[0]
            if words in self.known:
                raise ValueError(f"{name} and {self.known[words]} are one sentence")
            self.known[words] = name
        self.begun = {words[:n] for words in self.known for n in range(1, len(words) + 1)}
        self.near = {words[:NEAR_WORDS]: name for words, name in self.known.items() if len(words) > NEAR_WORDS}
        self.near_begun = {words[:3] for words in self.near}
        if names is None:
            names = NAMES if sentences is SENTENCES else {}
        self.names = {tuple(text.split()): name for name, texts in names.items() for text in texts}
        self.longest = max((len(words) for words in self.names), default=0)
        self.names_begun = {words[:n] for words in self.names for n in range(len(words) + 1)}

    def _exact(self, words: tuple[str, ...]) -> tuple[str | None, bool]:
        """(identifier if the words are a known sentence, whether more words may make one)."""
        return self.known.get(words), words in self.begun

    def _with_gaps(self, words: tuple[str, ...]) -> tuple[str | None, bool]:
        more = False
        for name, parts in self.gapped.items():
            if words[:len(parts[0])] != parts[0][:len(words)] or not (parts[0] or "free" in words or "distributed" in words):
                continue
            ends, whole = {len(parts[0])}, True
            for part in parts[1:]:
                starts = {at for end in ends for at in range(end, end + GAP + 1)}
                more = more or any(at >= len(words) or words[at:] == part[:len(words) - at] for at in starts)
                ends = {at + len(part) for at in starts if words[at:at + len(part)] == part}
                whole = bool(ends)
                if not whole:
                    break
            if whole and len(words) in ends:
                return name, True
        return None, more

    def _grant(self, words: tuple[str, ...]) -> tuple[list[tuple[str, int]] | None, bool]:
        """((identifier, place of the name's last word) of each name that the grant gives, whether more words may change it)."""
        if words[0] not in _LEADS:
            return None, False
        text = " ".join(words)
        found = _GRANT.match(text + " ")
        if not found:
            return None, len(words) < _LEAD_WORDS
        rest = found[1].rstrip()
        either = _EITHER.match(rest + " ")
        at = min(either.end(), len(rest)) if either else 0
        given: list[tuple[str, int]] = []
        before = len(text) - len(rest)
        while True:
            some = tuple(rest[at:].split())
            longest = next((n for n in range(min(len(some), self.longest), 0, -1) if some[:n] in self.names), 0)
            if not longest:
                # so far the words may still grow into a name, the first or the next one
                return given or None, some in self.names_begun
            at += len(" ".join(some[:longest]))
            given.append((self.names[some[:longest]], len(text[:before + at].split()) - 1))
            tail = rest[at:]
            following = _NEXT.match(tail + " ")
            if following and len(given) < 9:
                after = min(at + following.end(), len(rest))
                others = tuple(rest[after:].split())
                if not others or others in self.names_begun or any(others[:n] in self.names for n in range(1, self.longest + 1)):
                    at = after
                    if not others:
                        return given, True
                    continue
            if _TAIL.fullmatch(tail):
                return given, some in self.names_begun  # or a longer name begins with these words
            return [*given, ("grant.tail", given[-1][1])], False

    def _read(self, clauses: list, at: int, fits) -> tuple[list[tuple[str, str]], int] | None:
        """((identifier, version) of what the longest sentence from the clause ``at`` says, clause after it)."""
        words, numbers, found, given = (), [], None, None
        for stop in range(at, len(clauses)):
            more, further = clauses[stop]
            words, numbers = words + more, numbers + further
            if not words:
                break
            name, goes_on = fits(words)
            if name and found and fits == self._grant and (name[-1][0] == "grant.tail" or name == given):
                break  # the grant was whole before; what follows is another sentence
            given = name
            if name:
                if fits == self._grant:  # a name's version is the last number of its words
                    upto = [sum(w == "#" for w in words[:place + 1]) for _, place in name]
                    said = [(n, numbers[u - 1] if u > (upto[i - 1] if i else 0) else "") for i, ((n, _), u) in enumerate(zip(name, upto))]
                else:
                    said = [(name, numbers[0] if numbers else "")]
                found = said, stop + 1
            if not goes_on:
                break
        return found

    def _near_miss(self, clauses: list, at: int) -> str | None:
        """The known sentence that the words from the clause ``at`` begin like."""
        words = clauses[at][0]
        for more, _ in clauses[at + 1:at + NEAR_WORDS]:
            if len(words) >= NEAR_WORDS or words[:3] not in self.near_begun and len(words) >= 3:
                break
            words += more
        return self.near.get(words[:NEAR_WORDS])

    def identify(self, text: str | None) -> list[tuple[str, str]]:
        """(identifier, version or "") of each known sentence of the text, in order. An SPDX tag's expression stands for its version."""
        out: list[tuple[str, str]] = []
        at = 0
        if text and "SPDX-License-Identifier:" in text:
            for tag in _SPDX.finditer(text):
                out += self._identify(text[at:tag.start()])
                out.append(("spdx.tag", " ".join(tag[1].split())))
                at = tag.end()
        return out + self._identify(text[at:] if at else text)

    def _identify(self, text: str | None) -> list[tuple[str, str]]:
        out: list[tuple[str, str]] = []
        if not text:
            return out
        clauses = [normalise(_ITEM.sub("", c, 1) if _ITEM.match(c) else c) for c in _CLAUSE.split(text)]
        firsts = {parts[0][:n] for parts in self.gapped.values() if parts[0] for n in (1, 2)}
        at = 0
        while at < len(clauses):
            words, found = clauses[at][0], None
            if words:
                found = self._read(clauses, at, self._exact)
                # sentences that begin with a name show "is free" or "is distributed" within their first clause
                if not found and (words[:2] in firsts or "is" in words[:GAP + 1] and ("free" in words or "distributed" in words)):
                    found = self._read(clauses, at, self._with_gaps)
                if not found and self.names and words[0] in _LEADS:
                    found = self._read(clauses, at, self._grant)
                if not found and (words[:3] in self.near_begun or len(words) < 3 and words in self.begun):
                    near = self._near_miss(clauses, at)
                    found = ([(f"near:{near}", "")], at + 1) if near else None
            if found:
                out += found[0]
                at = found[1]
            else:
                at += 1
        return out


def match_rules(sentences: list[tuple[str, str]], rules=RULES) -> tuple[list[str], list[str]]:
    """(licences, identifiers that no rule takes), in order."""
    licences, unmatched, at = [], [], 0
    names = [name for name, _ in sentences]
    while at < len(names):
        for licence, sequence in rules:
            if tuple(names[at:at + len(sequence)]) == sequence:
                version = next((v for _, v in sentences[at:at + len(sequence)] if v), "")
                licences.append(licence.replace("#", version))
                at += len(sequence)
                break
        else:
            unmatched.append(names[at])
            at += 1
    return licences, unmatched


def scan(df: DataFrame, text_col: str = "text", carry: list[str] | None = None, sentences: dict[str, str] | None = None,
         rules=RULES) -> DataFrame:
    """Add ``n_sentences`` (licence sentences), ``sentences`` (identifiers), ``licenses`` and ``unmatched`` of each whole text.

    The three lists are comma-joined in text order, repeats included; empty strings where there are none, as for
    null and empty texts. Columns of these names give way. No shuffle.
    """
    index = SentenceIndex(SENTENCES if sentences is None else sentences)

    def compute(texts):
        out = {"n_sentences": [], "sentences": [], "licenses": [], "unmatched": []}
        for text in texts:
            found = index.identify(text)
            licences, rest = match_rules(found, rules)
            out["n_sentences"].append(len(found))
            out["sentences"].append(",".join(name for name, _ in found))
            out["licenses"].append(",".join(licences))
            out["unmatched"].append(",".join(rest))
        return out

    return with_columns(df, [text_col], carry, "n_sentences long, sentences string, licenses string, unmatched string", compute)
