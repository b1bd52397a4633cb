"""Licences found by their sentences.

Known sentences have identifiers. A text is read as words (letters and digits, lower case);
where a line or sentence begins, the known sentence whose words follow, and which ends where
a sentence or line does, is recognised. The identifiers in text order are then matched
against rules, each a licence and a sequence of identifiers, in order: longer and more
telling ones first. A rule's identifiers must follow one another with at most GAP
characters of other text in between; what a rule has matched is used up. A sentence may
leave open the name of a holder. An SPDX tag counts as a sentence, and its expression is read
by the grammar: every identifier is a licence, with its exception if it has one.

Every known sentence holds a marker word; a text without any is passed over after one
search, and loses nothing by it.

Defined cases: a null or empty text has no licence; a sentence that no rule uses is counted,
not reported; a reference that leaves open which of a family is meant gives the family's name
(``BSD``); equal rows give equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import few_at_once

#: Characters of other text allowed between the sentences of a rule.
GAP = 400

#: Every known sentence holds one of these, in any case.
MARKER = re.compile(r"licen[sc]|permission|warrant|redistribut|unencumbered|may not be used|advertising materials", re.I)

WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> tuple[str, ...]:
    return tuple(w.lower() for w in WORD.findall(text))


#: Known sentences by identifier (fixed values: wording of the licences).
SENTENCES = {
    "mit-name": ("The MIT License", "MIT License", "The MIT License (MIT)"),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ),
    "mit-notice": (
        "The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software.",
    ),
    "mit-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT.",
    ),
    "mit-reference": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "This software is released under the MIT License.",
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    "isc-reference": ("Released under the ISC License.",),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    ),
    "bsd-endorse": (
        "Neither the name of <> nor the names of <> contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "Neither the name of <> nor the names of any contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "The name of <> may not be used to endorse or promote products derived from this software "
        "without specific prior written permission.",
        "The names of <> may not be used to endorse or promote products derived from this software "
        "without specific prior written permission.",
    ),
    "bsd-adverts": (
        "All advertising materials mentioning features or use of this software must display the "
        "following acknowledgement:",
    ),
    "bsd-reference": (
        "Released under the BSD License.",
        "Licensed under the BSD License.",
        "This project is licensed under the BSD License.",
    ),
    "apache-grant": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
    ),
    "apache-use": ("you may not use this file except in compliance with the License.",),
    "apache-basis": (
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied.",
    ),
    "gpl-grant-3": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ),
    "gpl-grant-2": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, "
        "or (at your option) any later version.",
    ),
    "gpl-reference-3": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
    ),
    "gpl-reference-2": (
        "This work is licensed under the GNU General Public License, version 2.",
    ),
    "gpl-warranty": (
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    "mpl-reference": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ),
    "cc-by-nd": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International "
        "License.",
    ),
    "cc-zero": ("Released under the CC0 1.0 Universal License.",),
    "apache-text": ("Apache License Version 2.0, January 2004",),
    "gpl-text-2": ("GNU General Public License Version 2, June 1991",),
    "gpl-text-3": ("GNU General Public License Version 3, 29 June 2007",),
    "lgpl-text-2": ("GNU Library General Public License Version 2, June 1991",),
    "lgpl-text-2.1": ("GNU Lesser General Public License Version 2.1, February 1999",),
    "lgpl-text-3": ("GNU Lesser General Public License Version 3, 29 June 2007",),
    "agpl-text-3": ("GNU Affero General Public License Version 3, 19 November 2007",),
    "mpl-text-2": ("Mozilla Public License Version 2.0", "Mozilla Public License, version 2.0"),
    "mpl-text-1.1": (
        "Mozilla Public License Version 1.1",
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the "
        "\"License\");",
    ),
    "epl-1": (
        "Eclipse Public License - v 1.0",
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License v1.0 which accompanies this distribution,",
    ),
    "epl-2": (
        "Eclipse Public License - v 2.0",
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at",
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License v. 2.0 which is available at",
    ),
    "cddl-1": (
        "Common Development and Distribution License (CDDL) Version 1.0",
        "Common Development and Distribution License Version 1.0",
    ),
    "cddl-1.1": (
        "Common Development and Distribution License (CDDL) Version 1.1",
        "Common Development and Distribution License Version 1.1",
    ),
    "zlib-warranty": (
        "This software is provided 'as-is', without any express or implied warranty.",
    ),
    "zlib-grant": (
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions:",
    ),
    "bsl": (
        "Boost Software License - Version 1.0 - August 17th, 2003",
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license (the "
        "\"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, "
        "and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following:",
    ),
    "business": ("Business Source License 1.1",),
    "ofl-text": ("SIL Open Font License Version 1.1 - 26 February 2007",),
    "artistic-text": ("The Artistic License 2.0", "Artistic License 2.0"),
    "eupl-text": (
        "European Union Public Licence v. 1.2",
        "European Union Public Licence v. 1.2 EUPL",
    ),
    "postgresql-text": (
        "PostgreSQL License",
        "PostgreSQL is released under the PostgreSQL License, a liberal Open Source license, "
        "similar to the BSD or MIT licenses.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
    ),
    "cc-by-nc-sa": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
        "International License.",
    ),
    "cc-by-nc-nd": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
        "International License.",
    ),
}

#: What references call a licence, beside its SPDX identifier.
CALLED = {
    "MIT": ("MIT License", "MIT licence"),
    "ISC": ("ISC License",),
    "Apache-2.0": (
        "Apache License 2.0",
        "Apache License, Version 2.0",
        "Apache 2.0 License",
        "Apache License v2.0",
        "Apache Software License 2.0",
        "Apache 2.0",
    ),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "2-clause BSD license"),
    "BSD-3-Clause": (
        "BSD 3-Clause License",
        "New BSD License",
        "Modified BSD License",
        "3-clause BSD license",
    ),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL 2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0"),
    "BSL-1.0": ("Boost Software License 1.0", "Boost Software License, Version 1.0"),
    "EUPL-1.2": ("European Union Public Licence 1.2", "EUPL 1.2", "EUPL v1.2"),
    "OFL-1.1": ("SIL Open Font License 1.1", "SIL Open Font License, Version 1.1"),
    "Artistic-2.0": ("Artistic License 2.0",),
    "PostgreSQL": ("PostgreSQL License",),
    "Zlib": ("zlib License",),
    "Unlicense": ("The Unlicense",),
    "CC0-1.0": ("CC0 1.0 Universal",),
}
#: How texts refer to a licence by name, or by name or identifier.
BY_NAME = (
    "Licensed under the {}.",
    "Released under the {}.",
    "Distributed under the {}.",
    "Available under the {}.",
    "This project is licensed under the {}.",
    "This project is licensed under the terms of the {}.",
    "This software is licensed under the {}.",
    "This software is released under the {}.",
    "This work is licensed under the {}.",
    "This file is licensed under the {}.",
)
BY_EITHER = ("License: {}", "Licence: {}", "Licensed under {}.", "Released under {}.")

#: Licences of the GNU family: their names, and the versions each has been given.
GNU = {
    "GPL": ("GNU General Public License", ("1", "2", "3")),
    "LGPL": ("GNU Lesser General Public License", ("2.1", "3")),
    "LGPL ": ("GNU Library General Public License", ("2",)),
    "AGPL": ("GNU Affero General Public License", ("3",)),
}


def _gnu() -> tuple[tuple[str, tuple[str, ...]], ...]:
    """Grants and references of the GNU family, into SENTENCES; their rules."""
    rules = []
    by = "as published by the Free Software Foundation"
    terms = "you can redistribute it and/or modify it under the terms of the"
    for short, (name, versions) in GNU.items():
        for v in versions:
            licence = f"{short.strip()}-{v if '.' in v else v + '.0'}"
            key = f"{short.strip().lower()}-{{}}-{v}"
            later = f"{terms} {name} {by}, either version {v} of the License, or"
            written = {v, v if "." in v else f"{v}.0"}
            sentences = {
                "grant": [f"{later} (at your option) any later version.", f"{later} any later version."],
                "only": [f"{terms} {name} {by}, version {v} of the License."]
                + [f"{terms} {name} version {w} {by}." for w in sorted(written)]
                + [f"{terms} {name} {by}, version {v}."],
                "reference": [
                    f"{start} under the {name}, version {w}."
                    for start in ("This work is licensed", "Licensed", "Released")
                    for w in sorted(written)
                ],
            }
            for what, wordings in sentences.items():
                own = SENTENCES.get(key.format(what), ())
                SENTENCES[key.format(what)] = own + tuple(w for w in wordings if w not in own)
            rules.append((f"{licence}-or-later", (key.format("grant"),)))
            rules.append((f"{licence}-only", (key.format("only"),)))
            rules.append((f"{licence}-only", (key.format("reference"),)))
    return tuple(rules)

#: Rules in order: licence and its sequence of identifiers.
RULES = (
    ("MIT", ("mit-name", "mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-adverts", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-grant", "apache-use", "apache-basis")),
    ("GPL-3.0-or-later", ("gpl-grant-3", "gpl-warranty")),
    ("GPL-2.0-or-later", ("gpl-grant-2", "gpl-warranty")),
    ("GPL-3.0-or-later", ("gpl-grant-3",)),
    ("GPL-2.0-or-later", ("gpl-grant-2",)),
    ("ISC", ("isc-grant",)),
    ("Apache-2.0", ("apache-grant",)),
    ("MIT", ("mit-reference",)),
    ("MIT", ("mit-name",)),
    ("ISC", ("isc-reference",)),
    ("BSD", ("bsd-reference",)),
    ("GPL-3.0-only", ("gpl-reference-3",)),
    ("GPL-2.0-only", ("gpl-reference-2",)),
    ("MPL-2.0", ("mpl-reference",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-ND-4.0", ("cc-by-nd",)),
    ("CC0-1.0", ("cc-zero",)),
    ("Unlicense", ("unlicense",)),
    ("Apache-2.0", ("apache-text",)),
    ("GPL-2.0-only", ("gpl-text-2",)),
    ("GPL-3.0-only", ("gpl-text-3",)),
    ("LGPL-2.0-only", ("lgpl-text-2",)),
    ("LGPL-2.1-only", ("lgpl-text-2.1",)),
    ("LGPL-3.0-only", ("lgpl-text-3",)),
    ("AGPL-3.0-only", ("agpl-text-3",)),
    ("MPL-2.0", ("mpl-text-2",)),
    ("MPL-1.1", ("mpl-text-1.1",)),
    ("EPL-1.0", ("epl-1",)),
    ("EPL-2.0", ("epl-2",)),
    ("CDDL-1.0", ("cddl-1",)),
    ("CDDL-1.1", ("cddl-1.1",)),
    ("Zlib", ("zlib-warranty", "zlib-grant")),
    ("Zlib", ("zlib-grant",)),
    ("BSL-1.0", ("bsl",)),
    ("BUSL-1.1", ("business",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd",)),
)


def _references() -> tuple[tuple[str, tuple[str, ...]], ...]:
    """References to licences by name or identifier, into SENTENCES; their rules."""
    for licence, names in CALLED.items():
        wordings = [told.format(name) for told in BY_NAME for name in names]
        wordings += [told.format(name) for told in BY_EITHER for name in (licence, *names)]
        known = {words_of(w) for own in SENTENCES.values() for w in own}
        SENTENCES[f"called-{licence}"] = tuple(
            w for w in wordings if MARKER.search(w) and words_of(w) not in known
        )
    return tuple((licence, (f"called-{licence}",)) for licence in CALLED)


RULES += _gnu()
RULES += (
    ("OFL-1.1", ("ofl-text",)),
    ("Artistic-2.0", ("artistic-text",)),
    ("EUPL-1.2", ("eupl-text",)),
    ("PostgreSQL", ("postgresql-text",)),
)

RULES += _references()

#: SPDX identifiers without a digit or hyphen, and ones written in other ways (lower case).
PLAIN = (
    "MIT ISC Zlib Unlicense Beerware WTFPL curl X11 NCSA PostgreSQL Ruby Vim JSON Intel Libpng "
    "OpenSSL Sleepycat TCL NTP Naumen HPND Artistic Xnet Zed Fair Glide ICU IJG Info-ZIP Libtiff"
).split()
NAMED = {name.lower(): name for name in PLAIN}
NAMED |= {x[0].lower(): x[0] for x in RULES}
NAMED |= {
    f"{short.strip()}-{v if '.' in v else v + '.0'}{end}".lower(): (
        f"{short.strip()}-{v if '.' in v else v + '.0'}-{'or-later' if end else 'only'}"
    )
    for short, (_, versions) in GNU.items()
    for v in versions
    for end in ("", "+")
}

#: The tag before an SPDX expression, and what follows on its line: a word or a bracket.
TAG = re.compile(r"SPDX-License-Identifier\W*?:", re.I)
PIECE = re.compile(r"[^\w\n()]*([A-Za-z0-9][\w.+:-]*|[()])")

#: Between two words: whether a line or sentence may end there.
END = re.compile(r"[.!?;:](?=\s|[^\w\s]|$)|\n|[!?]")


#: Words at most where a sentence leaves a name open, and the mark of that.
NAME_WORDS, OPEN = 16, "<>"


@lru_cache(maxsize=1)
def index() -> dict[tuple[str, ...], list[tuple[list[tuple[str, ...]], str]]]:
    """Known sentences by their first two words, longest first: the parts around open names."""
    found: dict = {}
    for name, wordings in SENTENCES.items():
        for wording in wordings:
            if not MARKER.search(wording):
                raise ValueError(f"no marker word: {wording}")
            parts = [words_of(part) for part in wording.split(OPEN)]
            found.setdefault(parts[0][:2], []).append((parts, name))
    for known in found.values():
        known.sort(key=lambda x: -sum(map(len, x[0])))
    return found


def follows(words: list[str], at: int, parts: list[tuple[str, ...]]) -> int:
    """Where the parts, with names between them, end in ``words``; 0 if they do not follow."""
    stop = at + len(parts[0])
    if tuple(words[at:stop]) != parts[0]:
        return 0
    if len(parts) == 1:
        return stop
    return next((e for n in range(1, NAME_WORDS + 1) if (e := follows(words, stop + n, parts[1:]))), 0)


def expression(text: str, at: int) -> tuple[list[str], int]:
    """The licences of the SPDX expression at ``at``, and where it ends."""
    out: list[str] = []
    end, depth, want = at, 0, True
    while found := PIECE.match(text, at):
        word = found[1]
        if word in "()":
            if (word == "(") != want or word == ")" and not depth:
                break
            depth += 1 if word == "(" else -1
        elif not want:
            if word.upper() not in ("AND", "OR", "WITH"):
                break
            want, after = True, word.upper()
            at = found.end()
            if after == "WITH":
                found = PIECE.match(text, at)
                if not found or found[1] in "()":
                    break
                out[-1] += f" WITH {found[1].rstrip('.:-')}"
                want, end = False, found.end()
                at = end
            continue
        else:
            name = word.rstrip(".:-")
            known = NAMED.get(name.lower())
            if not known and not re.search(r"[0-9-]", name):
                break
            out.append(known or name)
            want, end = False, found.end(1) - len(word) + len(name)
        at = found.end()
    return out, end


def sentences(text: str | None) -> list[tuple[str, int, int]]:
    """(identifier, start, end) of the known sentences of a text, in order."""
    if not text or not MARKER.search(text):
        return []
    out = []
    for tag in TAG.finditer(text):
        names, end = expression(text, tag.end())
        if names:
            out.append(("spdx:" + ",".join(names), tag.start(), end))
    tagged = bool(out)
    spans = [m.span() for m in WORD.finditer(text)]
    words = [text[a:b].lower() for a, b in spans]
    known = index()
    at, n = 0, len(words)
    while at < n:
        step = 1
        begins = not at or END.search(text, spans[at - 1][1], spans[at][0])
        if begins or text[spans[at - 1][1] : spans[at][0]].strip():
            for parts, name in known.get(tuple(words[at : at + 2]), ()):
                stop = follows(words, at, parts)
                if not stop:
                    continue
                after = spans[stop][0] if stop < n else len(text)
                if stop == n or END.search(text, spans[stop - 1][1], after) or "(" in text[
                    spans[stop - 1][1] : after
                ]:
                    out.append((name, spans[at][0], spans[stop - 1][1]))
                    step = stop - at
                    break
        at += step
    return sorted(out, key=lambda x: x[1]) if tagged else out


def matched(found: list[tuple[str, int, int]], gap: int = GAP) -> list[tuple[str, int, int]]:
    """(licence, start, end) of the rules that a text's known sentences fulfil."""
    out = []
    at = 0
    while at < len(found):
        name, start, end = found[at]
        if name.startswith("spdx:"):
            out += [(licence, start, end) for licence in name[5:].split(",")]
            at += 1
            continue
        for licence, names in RULES:
            part = found[at : at + len(names)]
            if tuple(x[0] for x in part) != names:
                continue
            if all(b[1] - a[2] <= gap for a, b in zip(part, part[1:])):
                out.append((licence, part[0][1], part[-1][2]))
                at += len(names)
                break
        else:
            at += 1
    return out


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences (known ones), licences (distinct, sorted) and their spans."""
    kind = pa.list_(
        pa.struct([("licence", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_at_once(batches):
            known = [sentences(t.as_py()) for t in batch.column("text")]
            hits = [matched(k) for k in known]
            spans = [[{"licence": a, "start": b, "end": c} for a, b, c in h] for h in hits]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([len(k) for k in known], pa.int64()),
                    pa.array([sorted({a for a, _, _ in h}) for h in hits], pa.list_(pa.string())),
                    pa.array(spans, kind),
                ],
                ["doc_id", "n_sentences", "licences", "spans"],
            )

    own = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {own}, n_sentences long, licences array<string>, "
        "spans array<struct<licence: string, start: bigint, end: bigint>>",
    )
