"""Chat, decontamination, licences and line rules against oracles and planted rows."""

import random
import time
from collections import defaultdict

import duckdb
import pytest
import regex

from pelagrid.llm import chat, decontaminate, licences, line_rules, oracles

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, host string"


def same(df, sql, digits=9, **tables):
    """A DataFrame against DuckDB SQL over pandas tables."""
    connection = duckdb.connect()
    for name, rows in tables.items():
        connection.register(name, rows.toArrow())
    wanted = connection.sql(sql)
    columns = sorted(wanted.columns)
    assert sorted(df.columns) == columns
    plain = lambda rows: sorted(
        (tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in rows), key=repr
    )
    assert plain(map(tuple, df.select(*columns).collect())) == plain(
        wanted.select(*[f'"{c}"' for c in columns]).fetchall()
    )


TALK = [
    (1, 0, "system", "Be brief."),
    (1, 1, "user", "Hi <|assistant|> there"),
    (1, 2, "assistant", "Hello"),
    (1, 3, "user", None),
    (2, 1, "anna", "One"),
    (2, 0, "bert", "Zero é"),
    (2, 1, "anna", "One"),
    (2, None, None, ""),
    (3, 0, "system", "alone"),
    (None, 0, "user", "no id"),
]
TURNS = "conv_id long, turn long, role string, text string"


def test_chat_equals_sql_on_odd_rows(frame):
    rows = frame([(*r, "x", 1) for r in TALK], TURNS + ", assistant string, part int")
    same(chat.digest(chat.perspectives(rows)), oracles.OP1, conversations=frame(TALK, TURNS))


def test_chat_masks_cover_the_speaker_only_and_parts_are_bounded(frame):
    rows = [(7, i, ("a", "b", "system")[i % 3], f"text {i} ü") for i in range(40)]
    views = chat.perspectives(frame(rows, TURNS), per_part=6).collect()
    assert {v.assistant for v in views} == {"a", "b"} and max(v.n_turns for v in views) == 6
    for v in views:
        own = [t for _, i, s, t in rows if s == v.assistant and i // 6 == v.part]
        assert [v.text[s.begin : s.end] for s in v.spans] == [t + chat.STOP for t in own]


def test_chat_of_an_empty_table(frame):
    assert chat.digest(chat.perspectives(frame([], TURNS))).count() == 0


ITEM = "Maria buys 12 apples for 3 dollars each and then sells 12 apples to Peter who pays 40 dollars in total today"
OTHER = "the quick brown fox jumps over the lazy dog while 7 cats watch it from the warm roof"


@pytest.fixture
def marked(frame):
    texts = {
        1: f"before it. {ITEM} and after it",
        2: ITEM.upper(),
        3: ITEM.replace("12", "15").replace("40", "55").replace("3 dollars", "8 dollars"),
        4: "then Anna " + ITEM.replace("Maria", "Zoe").replace("Peter", "Paul"),
        5: ITEM.replace("sells 12", "sells 99"),
        6: "nothing of the kind is said in this text at all, it is clean",
        7: None,
        8: "",
        9: ITEM[: len(ITEM) // 3],
        10: "word " * 3000 + OTHER + " word" * 3000,
    }
    rows = [(k, t, "en", "s", 0, True, "h") for k, t in texts.items()]
    rows += [rows[0], (None, ITEM, None, None, None, None, None)]
    return frame(rows, DOCS)


ITEMS = [(0, ITEM), (1, OTHER), (2, None), (3, "too short"), (None, "no id " + OTHER), (1, OTHER)]


def test_decontamination_finds_templates_with_consistent_slots(marked, frame):
    found = decontaminate.mark(marked, frame(ITEMS, "item_id long, text string")).collect()
    hit = {r.doc_id: (r.item_ids, r.changed) for r in found if r.contaminated}
    assert hit[1] == ([0], False) and hit[2] == ([0], False) and hit[10] == ([1], False)
    assert hit[3] == ([0], True) and hit[4] == ([0], True)  # other numbers, other names
    assert set(hit) == {1, 2, 3, 4, 10, None}  # 5: one value of the item stands for two
    assert len(found) == 12


TANK = "the tank holds {} parts water and {} parts salt when the pump stops"


def test_decontamination_tells_occurrences_of_a_template_apart(frame):
    item, longer = TANK.format(40, 9), ITEM + " before the market closes and the long way home begins for all of them"
    texts = {
        1: f"{item} or {TANK.format(50, 10)}",  # the item itself and a variant
        2: f"{TANK.format(50, 8)} or {TANK.format(60, 10)}",  # two variants
        3: " then ".join(TANK.format(50 + i, 30 - i) for i in range(20)),
        4: TANK.format(7, 7),  # two values of the item are one
        5: longer.replace("in total", "in small total").replace("40", "55") + ". He who pays 70 dollars in total today is lucky.",
        6: f"{TANK.format(7, 7)} or {TANK.format(8, 8)}",
    }
    docs = frame([(k, t, None, None, None, True, None) for k, t in texts.items()] * 2, DOCS)
    rows = decontaminate.mark(docs, frame([(0, item), (1, longer)], "item_id long, text string")).collect()
    assert len(rows) == 12
    found = {r.doc_id: (r.item_ids, r.changed) for r in rows if r.contaminated}
    assert found == {1: ([0], False), 2: ([0], True), 3: ([0], True), 5: ([1], True)}


QUESTION = (
    "Anna drives 12 kilometers to the old market. Bruno follows her with seven crates of fruit. "
    "Together they sell thirty two crates in 3 hours. How many kilometers does Anna drive back?"
)


def test_decontamination_types_names_at_sentence_starts_units_and_number_words(frame):
    other = (
        QUESTION.replace("Anna", "Mary Ann").replace("Bruno", "Theo").replace("12", "7").replace("kilometers", "miles")
        .replace("seven", "ninety-four").replace("thirty two", "5").replace("3 hours", "40 minutes").replace("Together", "Today")
    )
    texts = {
        1: other,
        2: '"' + other.replace(". ", '."\n(') + ")",  # after quotes, brackets and line breaks
        3: QUESTION.lower(),
        4: other.replace("drive back", "look like").replace("sell", "eat").replace("follows", "leaves").replace("old", "new"),
        5: QUESTION.replace("Anna drives", "Bruno drives"),  # one window changed
        6: "What is gravity?",
        7: "What is gravity? A long answer follows",
        8: "7 + 9",
        9: "Convert 80 miles please",
        10: "THE WHOLE " * 20_000,  # one run of capitals
    }
    docs = frame([(k, t, None, None, None, True, None) for k, t in texts.items()], DOCS)
    items = [(0, QUESTION), (1, "what is gravity"), (2, "2 + 2"), (3, "Convert 12 km please"), (4, "7 + 9"), (5, "?")]
    rows = decontaminate.mark(docs, frame(items, "item_id long, text string")).collect()
    found = {r.doc_id: (r.item_ids, r.changed) for r in rows if r.contaminated}
    assert found == {
        1: ([0], True), 2: ([0], True), 3: ([0], False), 5: ([0], True), 6: ([1], False), 8: ([4], False), 9: ([3], True),
    }


def test_decontamination_of_a_long_text_grows_with_its_words(frame):
    """Windows used to be made with the words of the whole text beside each of them."""
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    plain = " ".join("".join(rng.choices(letters, k=6)) for _ in range(120_000))
    docs = frame([(1, plain, *[None] * 5), (2, f"{plain} {TANK.format(50, 10)} {plain}", *[None] * 5)], DOCS)
    began = time.monotonic()
    rows = decontaminate.mark(docs, frame([(0, TANK.format(40, 9))], "item_id long, text string")).collect()
    assert {r.doc_id: (r.item_ids, r.changed) for r in rows} == {1: ([], False), 2: ([0], True)}
    assert time.monotonic() - began < 30


def test_decontamination_of_thousands_of_lines_of_one_template(frame):
    lines = "\n".join(TANK.format(1000 + i, 20000 + i) for i in range(5000))
    docs = frame([(1, lines, None, None, None, True, None)], DOCS)
    began = time.monotonic()
    rows = decontaminate.mark(docs, frame([(0, TANK.format(40, 9))], "item_id long, text string")).collect()
    assert [(r.item_ids, r.changed) for r in rows] == [([0], True)] and time.monotonic() - began < 60


def _plain_words(text, form):
    """(placeholder or word, value) of a text, read word by word."""
    number = set(decontaminate.NUMBER_WORDS)
    pieces = regex.findall(
        r"\d+(?:[.,:/]\d+)*|[$€£](?=\d)|(?<=\d|\d )(?:%|°[CFcf]?)|[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]", text if form else text.lower()
    )
    words, gap = [], ""
    for p in pieces:
        if not regex.match(r"[\p{L}\p{M}\p{N}$€£%°]", p):
            gap += p
            continue
        digits, low = regex.match(r"[0-9]", p) is not None, p.lower()
        capital = bool(form) and regex.match(r"\p{Lu}", p) is not None
        last = words[-1] if words else None
        if last and gap in (" ", "-") and low in number and last["number"]:
            last["value"] += gap + low
        elif last and gap == " " and capital and last["capital"] and not last["number"]:
            last["value"] += " " + low
        else:
            after = bool(last) and last["digits"]
            kind = (
                "#" if digits or low in number else "unit" if low in decontaminate.UNITS or (after and low in decontaminate.SHORT_UNITS)
                else "name" if form and low != p else None
            )
            words.append({"kind": kind, "value": low, "digits": digits, "capital": capital, "number": low in number and not digits})
        gap = ""
    return [(w["kind"], w["value"]) for w in words]


def _plain_windows(text, form):
    words = _plain_words(text, form)
    if len(words) < 5 and sum(k is None for k, _ in words) < 2:
        words = [(None, v) for _, v in words]
    for i in range(max(len(words) - 4, min(len(words), 1))):
        own = words[i : i + 5]
        yield i, tuple(k or v for k, v in own), tuple((k is None, v) for k, v in own), [v for k, v in own if k]


def _plain_found(text, item):
    """Whether an item stands in a text, comparing every window of one with every window of the other."""
    for form in (0, 1):
        if form and text == text.lower():
            continue
        wanted = [w for w in _plain_windows(item, form) if len(w[1]) < 5 or len(w[3]) <= 3]
        n = len({w[1] for w in wanted})
        enough = lambda k, n=n: n > 0 and (k >= 0.8 * n or k >= 46)
        own = defaultdict(list)
        for w in _plain_windows(text, form):
            own[w[1]].append(w)
        same, literal, groups = set(), set(), defaultdict(lambda: (set(), set()))
        for i, h, _, slots in wanted:
            for j, _, _, values in own.get(h, []):
                if not slots:
                    literal.add(h)
                else:
                    groups[j - i][0].add(h)
                    groups[j - i][1].update(zip(slots, values))
                if slots == values:
                    same.add(h)
        if enough(len(same)):
            return True
        single = lambda v: len({a for a, _ in v}) == len(v) == len({b for _, b in v})
        good = {o: g for o, g in groups.items() if single(g[1])}
        best = len(literal)
        for seed, (hs, values) in good.items():
            hs, values = set(hs), set(values)
            for o in sorted(good, key=lambda o: (abs(o - seed), o)):
                if single(values | good[o][1]):
                    values |= good[o][1]
                    hs |= good[o][0]
            best = max(best, len(literal) + len(hs))
        if enough(best):
            return True
    return False


def test_decontamination_against_brute_force(frame):
    rng = random.Random(5)
    vocabulary = (
        "the a tank pump holds fills with salt and water when Anna Bruno Theo 12 7 40 9 km miles hours seven twenty "
        "hundred Then Who one two for parts"
    ).split()
    said = lambda n: " ".join(w + rng.choice(["", "", "", ".", ",", ".\n", "-"]) for w in rng.choices(vocabulary, k=n))
    items = [said(rng.choice([1, 2, 3, 4, 5, 7, 12, 20, 30, 80])) for _ in range(40)]
    texts = []
    for _ in range(160):
        words = rng.choice(items).split(" ")
        swaps = dict(zip(vocabulary, vocabulary))
        for group in (["Anna", "Bruno", "Theo"], ["12", "7", "40", "9"], ["km", "miles", "hours"]):
            swaps.update(zip(group, rng.sample(group, len(group))))
        for i in range(len(words)):
            bare = regex.sub(r"[.,\n-]+$", "", words[i])
            if rng.random() < 0.9:
                words[i] = swaps.get(bare, bare) + words[i][len(bare) :]
            elif rng.random() < 0.2:
                words[i] = rng.choice(vocabulary)
        body = " ".join(words)
        texts.append(rng.choice([body, said(9) + " " + body + " " + said(9), body.upper(), body.lower()]))
    docs = frame([(k, t, None, None, None, True, None) for k, t in enumerate(texts)], DOCS)
    rows = decontaminate.mark(docs, frame(list(enumerate(items)), "item_id long, text string")).collect()
    expected = {k: [i for i, item in enumerate(items) if _plain_found(t, item)] for k, t in enumerate(texts)}
    assert {r.doc_id: r.item_ids for r in rows} == expected
    assert sum(map(bool, expected.values())) > 50 and sum(not v for v in expected.values()) > 20


def test_decontamination_keeps_rows_and_columns(marked, frame):
    kept = decontaminate.clean(marked, frame(ITEMS, "item_id long, text string"))
    assert kept.columns == marked.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6, 7, 8, 9]
    empty = frame([], "item_id long, text string")
    assert decontaminate.clean(marked, empty).count() == marked.count()
    assert decontaminate.mark(marked.limit(0), empty).count() == 0


def test_decontamination_at_sf001_finds_every_planted_item(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
    words = lambda t: (t or "").lower().split()
    items = {r.item_id: words(r.text) for r in read("benchmark").collect()}
    grams = lambda w: {tuple(w[i : i + 8]) for i in range(len(w) - 7)}
    planted = set()
    for r in read("documents").collect():
        own = grams(words(r.text))
        planted |= {(r.doc_id, i) for i, w in items.items() if grams(w) and len(grams(w) & own) >= 0.8 * len(grams(w))}
    marked = decontaminate.mark(read("documents"), read("benchmark")).collect()
    assert {(r.doc_id, i) for r in marked for i in r.item_ids} == planted


def test_every_known_sentence_has_a_mark():
    forms = licences.known()
    assert all(any(m in f for m in licences.MARKS) for f in forms)
    assert len(set(forms)) == len(forms)
    used = {i for _, _, ids in licences.RULES for i in ids}
    assert used <= set(licences.SENTENCES) | set(licences.SPDX)


GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""


def commented(text, mark):
    return "\n".join(f"{mark} {line}".rstrip() for line in text.split("\n"))


def test_licences_of_wrapped_headers_and_tags(frame):
    mit = ". ".join(licences.SENTENCES[i][0] for i in ("mit-grant", "mit-notice", "as-is")) + "."
    wanted = {}
    for name, text in (("GPL-3.0-or-later", GPL), ("MPL-2.0", MPL), ("Apache-2.0", APACHE)):
        for mark in ("", "#", " *", "//", ";;"):
            wanted[f"/*\n{commented(text, mark)}\n*/\ncode = 1\n"] = (name, name)
    wanted |= {
        "Code under MIT. SPDX-License-Identifier: MIT": ("MIT", "MIT"),
        "// SPDX-License-Identifier: MIT OR Apache-2.0\nint x;": ("MIT", "MIT,Apache-2.0"),
        "# SPDX-License-Identifier: (LGPL-2.1-or-later AND BSD-3-Clause)": ("BSD-3-Clause", "BSD-3-Clause,LGPL-2.1"),
        "/* SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 */": ("GPL-2.0", "GPL-2.0"),
        "SPDX-License-Identifier: Nobody-1.0": (None, ""),
        "SPDX-License-Identifier:": (None, ""),
        f"{mit}\nSPDX-License-Identifier: GPL-3.0-only": ("MIT", "MIT,GPL-3.0"),
        f"Released under the\n  MIT License. {commented(mit, '#')}": ("MIT", "MIT"),
        "We think the MIT License is short": (None, ""),
        "All rights-reserved": ("Proprietary", "Proprietary"),
        "The reserved seats: all rights reserved for guests": (None, ""),
    }
    docs = frame([(k, t, None, None, None, True, None) for k, t in enumerate(wanted)], DOCS)
    found = {r.doc_id: (r.licence, r.licences) for r in licences.scan(docs).collect()}
    assert [found[k] for k in range(len(wanted))] == list(wanted.values())
    same(licences.scan(docs), oracles.OP3, documents=docs)


def test_licences_equal_sql_and_follow_order(frame):
    mit = [licences.SENTENCES[i][0] for i in ("mit-grant", "mit-notice", "as-is")]
    wrapped = ". ".join(mit).replace(" and", "\nand").replace(" or", "\n   or") + "."
    texts = {
        1: f"My tool\n\nCopyright (c) 2020 A. Holder\n\n{wrapped}",
        2: ". ".join(reversed(mit)) + ".",
        3: "All is well.\nReleased under the MIT License.\nMore text.",
        4: "Licensed under CC BY-NC 4.0. All rights reserved.",
        5: "Licensed under the Apache License, Version 2.0.",
        6: "permission to licence nothing",
        7: None,
        8: "",
        9: "x" * 100_000 + "\nAll rights reserved.\n" + "y z " * 30_000,
    }
    rows = [(k, t, None, None, None, True, None) for k, t in texts.items()] * 2
    docs = frame(rows, DOCS)
    found = {r.doc_id: r for r in licences.scan(docs).collect()}
    assert [found[k].licence for k in range(1, 10)] == [
        "MIT", None, "MIT", "CC-BY-NC-4.0", "Apache-2.0", None, None, None, "Proprietary",
    ]
    assert found[4].licences == "CC-BY-NC-4.0,Proprietary"
    same(licences.scan(docs), oracles.OP3, documents=docs)
    assert licences.scan(docs.limit(0)).count() == 0


def odd_lines():
    common, tail = "Share this  page now\tplease", "and 12 more words that close the page for good and all"
    rows = [(i, f"{common}\nits own words of page {chr(97 + i % 26)}{i // 26} go on and on and on\n{tail}", "h") for i in range(30)]
    rows += [(100 + i, f"{common.upper()}\n{tail}", "h") for i in range(25)]  # copies: one document
    rows += [(200, None, "h"), (201, "", None), (202, "a b c d e a b c d e f g h i j k", None)]
    rows += [(203, "# * $ one|two <x>\none two\none two\n\n \n", "other"), (204, "w " * 20_000, "other")]
    rows += [(205, "é ü one two three four five six seven eight nine ten", None), rows[0]]
    return [(k, t, "en", s, 0, True, "x") for k, t, s in rows]


def test_line_rules_equal_sql(frame):
    docs = frame(odd_lines(), DOCS)
    same(line_rules.judge(docs), oracles.OP10, documents=docs)
    verdict = {r.doc_id: r for r in line_rules.judge(docs).collect()}
    assert verdict[3].kept and verdict[3].boilerplate_words > 0
    assert not verdict[100].kept and not verdict[100].base_failed  # nothing of its own is left
    assert not verdict[200].kept and verdict[204].n_repeat_words == 20_000
    assert line_rules.judge(docs.limit(0)).count() == 0


def test_a_lines_limit_does_not_grow_with_its_host(frame):
    common, short = "Share this page with all your friends", "Read on"
    named = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    rows = [(i, f"the page {named(i)} has words of its own such as {named(7 * i)} and some more", "h") for i in range(1000)]
    rows += [(2000 + i, f"{common}\n{short}\nitem {named(i)} and a few words", "h") for i in range(25)]
    docs = frame([(k, t, "en", s, 0, True, "x") for k, t, s in rows], DOCS)
    found = {r.doc_id: r for r in line_rules.judge(docs).collect()}
    assert all(found[i].kept and found[i].boilerplate_words == 0 for i in range(1000))
    assert all(found[2000 + i].boilerplate_words == 7 and not found[2000 + i].kept for i in range(25))
    same(line_rules.judge(docs), oracles.OP10, documents=docs)


def test_line_rules_take_the_lines_out(frame):
    docs = frame(odd_lines(), DOCS)
    cleaned = {r.doc_id: r.text for r in line_rules.without_frequent_lines(docs).collect()}
    assert cleaned[3] == "its own words of page d0 go on and on and on" and cleaned[100] == "" and cleaned[200] is None
    assert cleaned[203] == "# * $ one|two <x>\none two\none two\n\n \n"
