import brute
import pytest

from palate.llm import license_scan as ls

SCAN = ls.Scanner().scan


@pytest.mark.parametrize("text, labels", [
    ("Released under the MIT License.", "mit,mit-reference"),
    ("x Released under the terms of the MIT license y", "mit,mit-reference"),
    ("Released under the terms the MIT license", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache,apache-2.0-reference"),
    ("Copyright (c) 2020 Some Body. All rights reserved.", "all-rights-reserved"),
    ("Copyright " + "name " * 13 + "all rights reserved", ""),
    ("licensed under CC BY-NC 4.0", "cc-reference"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation", "gpl,gpl-reference"),
    ("", ""), ("nothing here", "")])
def test_templates(text, labels):
    found = SCAN(text.encode())
    assert found["labels"] == labels
    assert found["score"] == (0.75 if "-" in labels else 0.5 if labels else 0.0)


def written(template, filled="Some One", optional=True):
    """A license as somebody would put it: open parts filled in, optional ones there or not."""
    out, skipped = [], 0
    for place, piece in enumerate(ls._MARK.split(template)):
        if place % 2 == 0:
            out.append("" if skipped else piece)
        elif piece == "optional":
            skipped += not optional or skipped > 0
        elif piece == "/optional":
            skipped = max(0, skipped - 1)
        elif not skipped:
            out.append(" ".join(filled.split()[:int(piece.split()[1])]))
    return " ".join(" ".join(out).split())


@pytest.mark.parametrize("label, template", ls.TEXTS)
@pytest.mark.parametrize("filled, optional", [("Some One Else and Others", True), ("Software", False)])
def test_whole_licenses_in_any_layout(label, template, filled, optional):
    text = written(template, filled, optional)
    for shown in (text, text.upper(), text.replace(" ", "\n * "), f"Copyright 2020 Me\n\n{text}\n\nint main() {{}}"):
        found = SCAN(shown.encode())
        assert label in found["labels"].split(",") and found["score"] == 1.0
    texts = {x for x in SCAN(text.encode())["labels"].split(",") if x.endswith(("-text", "-header"))}
    assert texts == {label}


@pytest.mark.parametrize("label, template", ls.TEXTS)
def test_every_mandatory_word_counts(label, template):
    """With any one of its words left out, or another put in its place, a text is no whole license any more."""
    words, alone = written(template, "Holder").split(), {"1.", "2.", "3.", "/or", "Holder"}  # open, or an optional part by itself
    places = [i for i, w in enumerate(words) if w not in alone and any(c.isalnum() for c in w)]
    assert len(places) > 60
    for i in places:
        for changed in (words[:i] + words[i + 1:], words[:i] + ["another"] + words[i + 1:]):
            assert label not in SCAN(" ".join(changed).encode())["labels"].split(","), (i, words[i])


@pytest.mark.parametrize("label, clause", [
    ("mit-text", "subject to the following conditions: The above copyright notice and this permission notice (including the next paragraph) "
                 "shall be included in all copies or substantial portions of the Holder"),
    ("mit-text", "IN NO EVENT SHALL Holder BE LIABLE FOR ANY CLAIM"), ("isc-text", "provided that the above copyright notice"),
    ("bsd-2-clause-text", "2. Redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause-text", "may be used to endorse or promote products derived from this software"),
    ("apache-2.0-header", "either express or implied"), ("gpl-header", "WITHOUT ANY WARRANTY"), ("zlib-text", "must be plainly marked as such")])
def test_altered_conditions_lose_the_label(label, clause):
    text = written(dict(ls.TEXTS)[label], "Holder")
    assert clause in text
    found = SCAN(text.replace(clause, "").encode())
    assert label not in found["labels"].split(",") and found["score"] < 1.0
    assert label in SCAN(text.encode())["labels"].split(",")


def test_columns_of_result_names_and_names_with_dots(spark):
    docs = spark.createDataFrame([(1, "Released under the MIT License", "x", 7)], "doc_id int, `the.text` string, LABELS string, n_words int")
    row = ls.scan_licenses(docs, "the.text").first()
    assert (row["the.text"], row.n_words, row.labels, row.score) == ("Released under the MIT License", 5, "mit,mit-reference", 0.75)


def test_optional_and_open_parts():
    automaton = ls.compile_template("t", "one two<<optional>> three <<any 2>><</optional>> four")
    accepts = lambda text: automaton.accepts(text.encode().split(), 0)
    assert [accepts(t) for t in ("one two four", "one two three four", "one two three a b four", "one two three a b c four",
                                 "one two five", "one two")] == [True, True, True, False, False, False]


def test_malformed_templates():
    for bad in ("<<any 3>> x", "a <<optional>> b"):
        with pytest.raises(ValueError):
            ls.Scanner(references=(("bad", bad),))


def test_phrases_against_brute_force(tricky, spark):
    extra = spark.createDataFrame([(100, "MIT license mit-license, Apache LICENSE general public general public license")],
                                  "doc_id bigint, text string")
    for row in ls.scan_licenses(tricky.select("doc_id", "text").union(extra)).collect():
        words = brute.plain(row.text)
        at = [i for phrase, _ in ls.PHRASES for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
        assert (row.n_words, row.n_base) == (len(words), len(at))
        assert (row.first_word, row.last_word) == (min(at, default=None), max(at, default=None))
    assert ls.scan_licenses(tricky.limit(0)).count() == 0
