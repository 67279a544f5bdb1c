from ledgerflow.llm import licenses as lic

INDEX = lic.SentenceIndex(lic.SENTENCES)


def found(text):
    return lic.match_rules(INDEX.identify(text))


def test_each_known_sentence_alone():
    for name, text in lic.SENTENCES.items():
        assert [n for n, _ in INDEX.identify(text.replace("#", "2.0") + ".")] == [name]


def test_rules():
    assert found("Released under the MIT License.") == (["MIT"], [])
    assert found("Some text. Licensed under CC BY-NC 4.0.\nMore") == (["CC-BY-NC-4.0"], [])
    assert found("LICENSED UNDER THE APACHE LICENSE, VERSION 2.0") == (["Apache-2.0"], [])
    assert found("a mention of the MIT License in a sentence.") == ([], [])
    bsd = ". ".join(lic.SENTENCES[n] for n in ("bsd.grant", "bsd.source", "bsd.binary"))
    assert found(bsd + ".") == (["BSD-2-Clause"], [])
    assert found(bsd + ". " + lic.SENTENCES["bsd.endorse"]) == (["BSD-3-Clause"], [])
    assert found(lic.SENTENCES["bsd.source"]) == ([], ["bsd.source"])
    gpl = lic.SENTENCES["gpl.free"].replace("#", "3") + ". " + lic.SENTENCES["gpl.hope"] + ". " + lic.SENTENCES["gpl.see"] + "."
    assert found(gpl) == (["GPL-3-or-later"], [])


def test_sentences_broken_over_lines():
    words = lic.SENTENCES["mit.grant"].split()
    text = "\n".join(" ".join(words[i:i + 7]) for i in range(0, len(words), 7)) + ":\n" + lic.SENTENCES["mit.notice"] + "."
    assert found("Title\n" + text) == (["MIT"], [])


def test_table(spark, make_docs):
    texts = [None, "", "x\nReleased under the MIT License.\nLicensed under the MIT License.", "word " * 30_000 + ". Licensed under CC0 1.0"]
    out = sorted(lic.scan(make_docs([*texts, texts[2]]).selectExpr("*", "1 AS Licenses")).collect(), key=lambda r: r["doc_id"])
    assert [r["licenses"] for r in out] == ["", "", "MIT,MIT", "CC0-1.0", "MIT,MIT"]
    assert [r["n_sentences"] for r in out] == [0, 0, 2, 1, 2]
    assert lic.scan(make_docs([])).count() == 0


def test_against_search_of_whole_texts(rng):
    """Brute force: every known sentence searched in the normalised lines."""
    names = ["mit.released", "cc.by", "apache.under", "gpl.work"]
    for _ in range(200):
        lines = [rng.choice([lic.SENTENCES[rng.choice(names)].replace("#", "3") + ".", "plain words here.", "# | * table", ""])
                 for _ in range(rng.randint(0, 8))]
        known = {lic.normalise(lic.SENTENCES[n].replace("#", "3"))[0]: n for n in names}
        want = [known[w] for w in (lic.normalise(x)[0] for x in lines) if w in known]
        assert [n for n, _ in INDEX.identify("\n".join(lines))] == want


REAL = {
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:

   * Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer.
   * Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the
distribution.
   * Neither the name of Google Inc. nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission.
""",
    "LGPL-2.1-or-later": """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.
 *
 * This library is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
 * Lesser General Public License for more details.
""",
    "AGPL-3-or-later": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU Affero General Public License as published
    by the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.
""",
    "GPL-3-or-later": """Foo is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

Foo is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
""",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-SA-3.0": "Except where otherwise noted, this work is licensed under a\nCreative Commons "
                       "Attribution-NonCommercial-ShareAlike 3.0 Unported License.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby "
           "granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
}


def test_real_texts():
    for licence, text in REAL.items():
        assert found("Copyright 2020 A. Person\n\n" + text + "\nMore text.") == ([licence], [])
    university = REAL["BSD-3-Clause"].replace("Google Inc.", "the University of California, Berkeley")
    assert found(university) == (["BSD-3-Clause"], [])
    assert found(REAL["BSD-3-Clause"].replace("Google Inc.", "x " * (lic.GAP + 1))) == (["BSD-2-Clause"], [])


def test_apache_headers():
    rest = """ you may not
use this file except in compliance with the License. Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied."""
    for grant in ('The ASF licenses this file\nto you under the Apache License, Version 2.0 (the "License");',
                  'This file is licensed under the Apache License, Version 2.0 (the "License");'):
        assert found("x\n" + grant + rest) == (["Apache-2.0"], [])


def test_grants_with_lead_ins():
    for text, licence in {"This work is licensed under CC BY 4.0.": "CC-BY-4.0", "This program is released under the MIT License.": "MIT",
                          "This file is licensed under the Apache License, Version 2.0": "Apache-2.0", "Licensed under the GPLv3": "GPL-3",
                          "All files in this repository are\ndistributed under the terms of the GNU Affero General Public\nLicense v3.0":
                          "AGPL-3.0", "Licensed under GPL v2 or later.": "GPL-2-or-later"}.items():
        assert found("Intro.\n" + text + "\nMore") == ([licence], []), text
    for text in ("This work is not licensed under the MIT License.", "This work is licensed under a licence of its own.", "The MIT License is short."):
        assert found(text) == ([], [])


SIGNALS = {
    "SPDX-License-Identifier: MIT": ["MIT"],
    "// SPDX-License-Identifier: Apache-2.0 OR MIT\nint main": ["Apache-2.0 OR MIT"],
    "/* SPDX-License-Identifier:GPL-2.0-only WITH Linux-syscall-note */": ["GPL-2.0-only WITH Linux-syscall-note"],
    "# SPDX-License-Identifier: (MIT OR  Apache-2.0) AND BSD-3-Clause\n": ["(MIT OR Apache-2.0) AND BSD-3-Clause"],
    "Licensed under the MIT License, see LICENSE for details.": ["MIT"],
    "Licensed under the MIT license. See LICENSE.txt in the project root.": ["MIT"],
    "This code is released under the MIT License and the docs under CC BY 4.0.": ["MIT", "CC-BY-4.0"],
    "Licensed under either of Apache License, Version 2.0 or MIT license at your option.": ["Apache-2.0", "MIT"],
    "licensed under either of\n\n * Apache License, Version 2.0\n * MIT license": ["Apache-2.0"],
    "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007": ["GPL-3"],
    "\t\t    GNU GENERAL PUBLIC LICENSE\n\t\t       Version 2, June 1991\n": ["GPL-2"],
    "                                 Apache License\n                           Version 2.0, January 2004\n"
    "                        http://www.apache.org/licenses/\n": ["Apache-2.0"],
    "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)": ["BSL-1.0"],
    "Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is hereby granted, free of charge, to any person or organization\n"
    "obtaining a copy of the software and accompanying documentation covered by\nthis license (the \"Software\") to use, reproduce, display, "
    "distribute,\nexecute, and transmit the Software, and to prepare derivative works of the\nSoftware, and to permit third-parties to whom the "
    "Software is furnished to\ndo so, all subject to the following:\n": ["BSL-1.0"],
    "This software is provided 'as-is', without any express or implied\nwarranty.  In no event will the authors be held liable for any damages\n"
    "arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial "
    "applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n": ["Zlib"],
    "This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0 which is available at\n"
    "https://www.eclipse.org/legal/epl-2.0/": ["EPL-2.0"],
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.\nThis license is copied below": ["OFL-1.1"],
    "This database is made available under the Open Database License: http://opendatacommons.org/licenses/odbl/1.0/.": ["ODbL-1.0"],
    "Use of this source code is governed by a BSD-style license that can be\nfound in the LICENSE file.": ["BSD"],
}


def test_signals_of_real_files():
    for text, licences in SIGNALS.items():
        assert found("Some words before.\n" + text + "\nMore words.") == (licences, []), text


def test_near_misses_leave_a_trace():
    odd = lic.SENTENCES["mit.notice"].replace("shall be included", "must be kept")
    assert found("x\n" + odd + ".") == ([], ["near:mit.notice"])
    assert found("Licensed under the MIT License but only on Sundays.") == (["MIT"], ["grant.tail"])
    assert found(lic.SENTENCES["mit.grant"] + ". " + odd + ".") == ([], ["mit.grant", "near:mit.notice"])


def as_text(name):
    if name in lic.SENTENCES:
        return lic.SENTENCES[name].replace("#", "7").replace("*", "Some Person")
    if name == "spdx.tag":
        return "SPDX-License-Identifier: Foo-7"
    return "Licensed under the " + lic.NAMES[name][0].replace("#", "7")


def brute_rules(names, versions):
    """At each place the first rule of the list whose identifiers come next."""
    out, rest, at = [], [], 0
    while at < len(names):
        taken = [(r, s) for r, s in lic.RULES if list(s) == names[at:at + len(s)]][:1]
        if not taken:
            rest.append(names[at])
            at += 1
        for r, s in taken:
            out.append(r.replace("#", next((v for v in versions[at:at + len(s)] if v), "")))
            at += len(s)
    return out, rest


def test_every_rule_and_every_sentence_by_brute_force(rng):
    for _, sequence in lic.RULES:  # every identifier of every rule can be read from a text
        text = "\n\n".join(as_text(n) + "." for n in sequence)
        assert [n for n, _ in INDEX.identify(text)] == list(sequence), sequence
    names = sorted({*lic.SENTENCES, *(n for _, s in lic.RULES for n in s)})
    plain = ["Plain words here.", "", "# | * table", "A sentence about software; it is short."]
    for _ in range(150):
        said = [rng.choice(names) if rng.random() < 0.7 else None for _ in range(rng.randint(0, 12))]
        text = "\n\n".join(rng.choice(plain) if n is None else as_text(n) + "." for n in said)
        got = INDEX.identify(text)
        want = [n for n in said if n]
        assert [n for n, _ in got] == want
        assert lic.match_rules(got) == brute_rules(want, [v for _, v in got])
