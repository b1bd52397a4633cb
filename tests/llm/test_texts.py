"""Encoding, token counts, language, licences and pseudonyms."""

import hashlib
import random
import re
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from volspark.llm import bpe, langid, licenses, pii, wordpiece

PARTS = "a e th ing é 日本 😀 12 !!! 's 'S <|endoftext|>   \x00 \r\n aaaa ñ � _  ".split(" ")


def odd_texts(n=400, seed=1):
    rng = random.Random(seed)
    made = ["".join(rng.choice([*PARTS, " ", "  ", "\n", "\t"]) for _ in range(rng.randint(0, 50))) for _ in range(n)]
    return [*made, "", "a" * 3000, " " * 2000, "ab" * 2000, "".join(map(chr, range(1, 3000)))]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def pairs():
    return bpe.BytePairs(open(bpe.default_vocabulary(), encoding="utf-8").read())


def test_encoding_equals_the_library(library, pairs):
    for text in odd_texts():
        ids, line = pairs.encode(text)
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == wanted
        assert line == ",".join(map(str, wanted))
        assert pairs.decode(ids) == library.decode(wanted, skip_special_tokens=False)


def test_decoding_ids_that_are_no_text(library, pairs):
    rng = random.Random(2)
    for _ in range(50):
        ids = [rng.randrange(50_257) for _ in range(rng.randint(1, 30))]
        wanted = library.decode(ids, skip_special_tokens=False)
        assert pairs.decode(np.array(ids, dtype=np.int32)) == wanted


def test_encoded_tables(library, some_docs, edge_docs, no_docs):
    for docs in (some_docs, edge_docs):
        texts = docs.select("doc_id", "text").collect()
        found = bpe.encoded(docs).collect()
        for r, out in zip(texts, found):
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            assert (out.doc_id, out.ids, out.n_tokens) == (r.doc_id, ids, len(ids))
            line = ",".join(map(str, ids))
            assert out.ids_sha256 == hashlib.sha256(line.encode()).hexdigest()
            assert out.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.encoded(no_docs).count() == 0


def greedy(word, pieces, rest):
    """Longest piece first; None if the word cannot be spelled."""
    count, at = 0, 0
    while at < len(word):
        known = pieces if not at else rest
        size = next((n for n in range(len(word) - at, 0, -1) if word[at : at + n] in known), 0)
        if not size:
            return None
        at, count = at + size, count + 1
    return count


def test_counts_equal_greedy_matching(some_docs, edge_docs, no_docs):
    vocabulary = wordpiece.byte_strings(bpe.default_vocabulary())
    pieces = set(vocabulary)
    for docs in (some_docs, edge_docs):
        found = wordpiece.token_counts(docs, vocabulary).collect()
        for r, out in zip(docs.select("doc_id", "text").collect(), found):
            words = (r.text or "").encode().split()
            counts = {w: greedy(b" " + w, pieces, pieces) for w in set(words)}
            assert tuple(out) == (r.doc_id, len(words), sum(counts[w] for w in words))
    assert wordpiece.token_counts(no_docs, vocabulary).count() == 0


def test_joined_pieces_and_unknown_words():
    rng = random.Random(3)
    for _ in range(60):
        strings = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(7)}
        first = {s for s in strings if rng.random() < 0.7}
        rest = {s for s in strings if rng.random() < 0.7}
        matcher = wordpiece.Matcher([s.encode() for s in first] + [b"##" + s.encode() for s in rest], joint=b"##")
        for _ in range(60):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
            assert matcher.count(word.encode()) == (greedy(word, first, rest) or 1), word


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.languages(docs, langid.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.filter(langid.held_out(F.col("doc_id"))).collect()
    assert len(rows) > 100
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def brute_path(scores, penalty):
    n = scores.shape[1]
    best, back = [scores[0]], []
    for row in scores[1:]:
        step = best[-1][:, None] - penalty * (1 - np.eye(n))
        back.append(step.argmax(axis=0))
        best.append(step.max(axis=0) + row)
    return best[-1].max()


def test_viterbi_is_best():
    rng = np.random.default_rng(1)
    made = [rng.normal(size=(n, 3)) * 4 for n in (0, 1, 5, 40, 2, 40, 17)]
    for scores, path in zip(made, langid.viterbi(made, 5.0)):
        assert len(path) == len(scores)
        if len(path):
            value = scores[np.arange(len(path)), path].sum() - 5.0 * (np.diff(path) != 0).sum()
            assert value == pytest.approx(brute_path(scores, 5.0))


def test_spans_of_mixed_text(spark):
    rows = []
    for i in range(200):
        rows += [(2 * i, "the house and the garden with the tree " * 3, "en"), (2 * i + 1, "дом и сад и большое дерево " * 3, "ru")]
        rows += [(1000 + i, "das Haus und der Garten mit dem Baum " * 3, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    text = "the house with the garden. " * 4 + "дом и сад. " * 3 + "und der Garten mit dem Haus " * 3
    (name, score, spans), *rest = langid.label([text, None, "", "12 !?", "日本"], model, True)
    assert [s["lang"] for s in spans] == ["en", "ru", "de"]
    assert name == "en" and 0 < score < 1
    assert text[spans[1]["start"] : spans[1]["end"]].startswith("дом")
    assert [r[0] for r in rest[:3]] == ["und"] * 3
    assert rest[3][0] in model.languages


def test_language_of_edge_rows(edge_docs, no_docs):
    model = langid.fit(edge_docs)
    rows = {r.doc_id: r for r in langid.languages(edge_docs, model).collect()}
    assert rows[3].lang_pred == rows[4].lang_pred == rows[8].lang_pred == rows[9].lang_pred == "und"
    kept = langid.with_language(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {1, 2, 6, 7, 10, 11} <= set(ids) and not {3, 4, 5, 8, 9} & set(ids) and ids.count(2) == 2
    assert langid.languages(no_docs, langid.fit(no_docs)).count() == 0
    assert langid.with_language(no_docs).count() == 0
    nothing = langid.languages(edge_docs, langid.fit(no_docs)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_score_of_what_was_never_learned(some_docs):
    model = langid.fit(some_docs)
    noise = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    foreign = [
        "这是一个完全用中文写成的文本，没有其他语言。",
        "Это текст, написанный только по-русски, без других языков.",
        "Talo on hyvin suuri ja puutarha on täynnä kukkia jotka kasvavat joka vuosi",
        " ".join("".join(noise.choices(letters, k=noise.randint(2, 9))) for _ in range(80)),
    ]
    assert all(score < 0.4 for _, score, _ in langid.label(foreign, model, False))
    rows = [r.text for r in some_docs.filter("lang IS NOT NULL").collect() if r.text]
    scores = [score for name, score, _ in langid.label(rows, model, False) if name != "und"]
    assert sum(score >= 0.4 for score in scores) >= 0.98 * len(scores)


def test_every_label_is_learned(spark):
    rows = [(i, f"wort{chr(97 + i // 26 % 26)}{chr(97 + i % 26)} " * 5, f"l{i // 2:03}") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    wanted = {r.lang for r in docs.filter(~langid.held_out(F.col("doc_id"))).collect()}
    assert set(model.languages) == wanted and len(wanted) > 256


def test_long_text_in_parts(monkeypatch):
    text = "ein langes Wort und noch eines, " * 40
    whole = [len(langid.Words(text).start), langid.Words(text).letters.sum()]
    monkeypatch.setattr(langid, "PART", 50)
    pieces = [(at, langid.Words(p)) for at, p in langid.parts(text)]
    assert [sum(len(w.start) for _, w in pieces), sum(w.letters.sum() for _, w in pieces)] == whole
    assert "".join(p for _, p in langid.parts(text)) == text


MIT = """MIT License

Copyright (c) someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""


def test_licence_rules():
    def found(text):
        return [x for x, _, _ in licenses.matched(licenses.sentences(text))]

    assert found(MIT) == ["MIT"] and len(licenses.sentences(MIT)) == 4
    assert found("Some text here\nLicensed under CC BY-NC 4.0.\nmore") == ["CC-BY-NC-4.0"]
    assert found("LICENSED!! UNDER!! CC!! BY-NC!! 4.0.") == ["CC-BY-NC-4.0"]
    assert found("Licensed under the Apache License, Version 2.0 (the \"License\"); you") == ["Apache-2.0"]
    assert found("They were not licensed under the Apache License, Version 2.0 then") == []
    assert found("Released under the MIT License. Licensed under CC BY 4.0.") == ["MIT", "CC-BY-4.0"]
    grant = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    assert found(grant) == [] and len(licenses.sentences(grant)) == 1


BSD = """Copyright (c) 2020, Example Org
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the Example Organisation, Ltd. nor the names of its
   contributors may be used to endorse or promote products derived from this
   software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS".
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
"""
LGPL = """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.
"""


def test_usual_licences_and_spdx_expressions():
    def found(text):
        return [x for x, _, _ in licenses.matched(licenses.sentences(text))]

    assert found(BSD) == ["BSD-3-Clause"] and found(ZLIB) == ["Zlib"]
    assert found(LGPL) == ["LGPL-2.1-or-later"]
    assert found(LGPL.replace("Lesser", "Affero").replace("2.1", "3")) == ["AGPL-3.0-or-later"]
    assert found("This is free and unencumbered software released into the public domain.\n") == ["Unlicense"]
    assert found("Eclipse Public License - v 2.0\n") == ["EPL-2.0"]
    assert found("COMMON DEVELOPMENT AND DISTRIBUTION LICENSE (CDDL) Version 1.0\n") == ["CDDL-1.0"]
    assert found("Boost Software License - Version 1.0 - August 17th, 2003\n") == ["BSL-1.0"]

    def tag(text):
        return found("# SPDX-License-Identifier: " + text + "\ncode MIT")

    assert tag("MIT OR Apache-2.0") == ["MIT", "Apache-2.0"]
    assert tag("(LGPL-2.1-or-later AND CC-BY-SA-4.0) or mit */") == ["LGPL-2.1-or-later", "CC-BY-SA-4.0", "MIT"]
    assert tag("GPL-2.0-only WITH Classpath-exception-2.0") == ["GPL-2.0-only WITH Classpath-exception-2.0"]
    assert tag("GPL-2.0") == ["GPL-2.0-only"] and tag("GPL-3.0+") == ["GPL-3.0-or-later"]
    assert tag("BSD-2-Clause.") == ["BSD-2-Clause"] and tag("see the file") == []


def test_licence_scan(some_docs, edge_docs, no_docs):
    names = {"GNU General Public License, version 3": "GPL-3.0-only", "MIT License": "MIT", "Apache License": "Apache-2.0", "CC BY-NC 4.0": "CC-BY-NC-4.0"}
    docs = some_docs.union(edge_docs.select(some_docs.columns))
    for r, out in zip(docs.collect(), licenses.scan(docs).collect()):
        assert out.licences == sorted(v for k, v in names.items() if k.lower() in (r.text or "").lower())
    assert licenses.scan(no_docs).count() == 0


def luhn(number):
    digits = [int(c) for c in reversed(re.sub(r"\D", "", number))]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_pseudonyms(spark):
    texts = [
        "pay 4111 1111 1111 1111 now",
        "4111111111111111",
        "4111111111111112 is no card",
        "call +1 (974) 555-3436, or +44 20 7946 0958.",
        "ssn 123-45-6789 but 666-45-6789 and 000-12-3456",
        "from 10.0.255.1 to 300.1.1.1",
        "on 2024-02-29, 2023-02-29, 31/12/1999 and 12/31/1999",
        "mail anna.01@mail3.example.com!",
        "4111111111111111 10.0.255.1 4111111111111111",
        None,
        "",
        "nothing",
        "+1!! (974)!! 555-3436!! +14155550123 +1 2 3 +1, 200 items",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.pseudonyms(docs, "k").collect()}
    out = [rows[i].text for i in range(len(texts))]
    assert out[2] == texts[2] and out[9] is None and out[10] == "" and out[11] == "nothing"
    card = re.fullmatch(r"pay (\d{4} \d{4} \d{4} \d{4}) now", out[0])[1]
    assert luhn(card) and card != "4111 1111 1111 1111"
    assert out[1] == card.replace(" ", "") and out[8].count(out[1]) == 2
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4}, or \+44 \d\d \d{4} \d{4}\.", out[3])
    assert "555-3436" not in out[3] and "7946 0958" not in out[3]
    assert re.fullmatch(r"ssn \d{3}-\d\d-\d{4} but 666-45-6789 and 000-12-3456", out[4])
    assert "123-45-6789" not in out[4] and "300.1.1.1" in out[5] and "10.0.255.1" not in out[5]
    assert all(int(x) < 256 for x in re.findall(r"\d+", out[5].split(" to ")[0]))
    days = re.findall(r"[\d/-]{10}", out[6])
    assert days[1] == "2023-02-29" and date.fromisoformat(days[0]) and days[0] != "2024-02-29"
    assert days[2][3:5] + "/" + days[2][:2] + days[2][5:] == days[3]
    assert "anna" not in out[7] and out[7].endswith("@mail3.example.com!")
    assert [rows[i].n_found for i in range(13)] == [1, 1, 0, 2, 1, 1, 3, 1, 3, 0, 0, 0, 2]
    other = {r.doc_id: r.text for r in pii.pseudonyms(docs, "another key").collect()}
    assert other[0] != out[0]


def test_pseudonyms_of_other_layouts(spark):
    phones = "+1 555 1234567|+49 151 12345678|+44 7700 900123|+33 1 23 45 67 89|+91 98765 43210|(555) 123-4567|555-123-4567|555.123.4567|020 7946 0958"
    days = "2024/03/05|05/03/2024|5/3/2024|5 March 2024|March 5, 2024|5. März 2024|5 de marzo de 2024|5-3-2024"
    texts = [*phones.split("|"), *days.split("|"), "+1 555 1234567 4111111111111111", "version 1.2.3 of 30/2/2024, 5 Maybe 2024"]
    docs = spark.createDataFrame([(i, f"see {t}, please") for i, t in enumerate(texts)], "doc_id long, text string")
    out = [(r.text[4:-8], r) for r in pii.pseudonyms(docs, "k").orderBy("doc_id").collect()]
    for text, (new, r) in zip(texts[:9], out):
        assert r.n_phone == r.n_found == 1 and new != text
        assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", text)
    digits = [re.sub(r"\D", "", new) for new, _ in out]
    assert digits[0] == "1" + digits[5] and digits[5] == digits[6] == digits[7]
    assert all(r.n_date == r.n_found == 1 for _, r in out[9:17])
    day = date.fromisoformat("-".join(f"{int(x):02}" for x in out[9][0].split("/")))
    assert out[10][0] == day.strftime("%d/%m/%Y") and out[11][0] == f"{day.day}/{day.month}/{day.year}"
    names = [pii.MONTHS[i][day.month - 1] for i in (0, 2, 3)]
    assert out[12][0] == f"{day.day} {names[0]} {day.year}" and out[13][0] == f"{names[0]} {day.day}, {day.year}"
    assert out[14][0] == f"{day.day}. {names[1]} {day.year}" and out[15][0] == f"{day.day} de {names[2]} de {day.year}"
    assert out[16][0] == f"{day.day}-{day.month}-{day.year}"
    assert (out[17][1].n_phone, out[17][1].n_card) == (1, 1) and out[18][0] == texts[18]


def test_permutations_are_bijections(spark):
    for first, second in ((3, 7), (10, 100), (1, 5), (16, 16)):
        rows = spark.range(first * second).select(
            pii.permuted(F.col("id"), F.lit(first), F.lit(second), "k", F.lit("x")).alias("to")
        )
        assert sorted(r.to for r in rows.collect()) == list(range(first * second))


def test_pseudonyms_of_tables(some_docs, edge_docs, no_docs):
    for docs in (some_docs, edge_docs, no_docs):
        rows = pii.pseudonyms(docs, "k").collect()
        texts = docs.select("doc_id", "text").collect()
        assert [r.doc_id for r in rows] == [r.doc_id for r in texts]
        for r, new in zip(texts, rows):
            assert (r.text == new.text) == (new.n_found == 0)
            for word in re.findall(r"(?<!\d)\d{16}(?!\d)", r.text or ""):
                assert (word in new.text) == (not luhn(word))
            for phone in re.findall(r"\b555-\d{4}\b", r.text or ""):
                assert phone not in new.text
            for mail in re.findall(r"\S+@mail\d+\.example\.com", r.text or ""):
                assert mail not in new.text
    plan = pii.pseudonyms(some_docs, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_vocabularies_of_one_session_are_kept_apart(spark):
    """They agree in length and in the first thousand tokens."""
    common = [f"<{i}>".encode() for i in range(1000)]
    docs = spark.createDataFrame([(1, "abab")], "doc_id long, text string").coalesce(1)
    for token, tokens in ((b"abab", 1), (b"ab", 2), (b"aba", 2), (b"zz", 4)):
        vocabulary = [*common, b"a", b"b", token]
        found = wordpiece.token_counts(docs, vocabulary, start=b"")
        assert found.first().n_tokens == tokens


def test_references_to_licences():
    def found(text):
        return [x for x, _, _ in licenses.matched(licenses.sentences(text))]

    assert found("Released under the BSD License.") == ["BSD"]
    assert found("Licensed under the Apache License 2.0") == ["Apache-2.0"]
    assert found("License: MIT") == ["MIT"] and found("## Licence: Apache-2.0\n") == ["Apache-2.0"]
    assert found("Licensed under Apache-2.0.") == ["Apache-2.0"]
    assert found("SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007\n") == ["OFL-1.1"]
    assert found("The Artistic License 2.0\n\nCopyright") == ["Artistic-2.0"]
    assert found("EUROPEAN UNION PUBLIC LICENCE v. 1.2\n") == ["EUPL-1.2"]
    assert found("This project is licensed under the terms of the PostgreSQL License.") == ["PostgreSQL"]
    assert found("Released under the New BSD License.") == ["BSD-3-Clause"]
    assert found("License: see the file") == [] and found("the license: mit and more words") == []


def test_sentences_equal_a_search_for_every_wording():
    """Known wordings without open names, among words, line ends and marks."""
    wordings = {}
    for name, own in licenses.SENTENCES.items():
        for wording in own:
            if licenses.OPEN not in wording:
                wordings.setdefault(licenses.words_of(wording), name)
    rng = random.Random(6)
    texts = list(wordings)
    for _ in range(300):
        pieces = []
        for _ in range(rng.randint(1, 6)):
            words = rng.choice([rng.choice(texts), tuple(rng.choice(["some", "license", "the", "mit"]) for _ in range(3))])
            pieces.append(rng.choice([" ", "\n", " * "]).join(words).title() + rng.choice([".", ".\n", "\n", " "]))
        text = "".join(pieces) + "\nlicense"
        spans = [m.span() for m in licenses.WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in spans]
        wanted, at = [], 0
        while at < len(words):
            before = text[spans[at - 1][1] : spans[at][0]] if at else "\n"
            best = 0
            if licenses.END.search(text, spans[at - 1][1] if at else 0, spans[at][0]) or before.strip() or not at:
                for size in range(len(words) - at, 1, -1):
                    stop = at + size
                    after = text[spans[stop - 1][1] : spans[stop][0]] if stop < len(words) else "\n"
                    ends = stop == len(words) or licenses.END.search(text, spans[stop - 1][1], spans[stop][0])
                    if tuple(words[at:stop]) in wordings and (ends or "(" in after):
                        wanted.append((wordings[tuple(words[at:stop])], spans[at][0], spans[stop - 1][1]))
                        best = size
                        break
            at += best or 1
        assert licenses.sentences(text) == wanted


def test_texts_that_repeat_are_encoded_once(spark, monkeypatch):
    rows = [(1, "same text"), (1, "same text"), (2, "other"), (3, None), (4, None), (5, ""), (6, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = bpe.encoded(docs).collect()
    alone = [bpe.encoded(docs.filter(F.col("doc_id") == r[0])).first() for r in rows]
    assert [r.asDict() for r in found] == [r.asDict() for r in alone]
