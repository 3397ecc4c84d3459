import pytest

from sluice.llm import license_scan, queries
from sluice.llm.license_scan import TEMPLATES, Matcher, Scan, wording

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, licenses string, name int"


@pytest.fixture(scope="module")
def matcher():
    return Matcher(Scan())


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_each_template_is_found_and_no_other(matcher, name):
    text = f"Some words before it.\n{TEMPLATES[name]}\nAnd words that follow in the text."
    found = matcher.find(text)
    assert [(n, d) for n, _, _, d in found] == [(name, "")]
    _, start, end, _ = found[0]
    assert text[start:end] == TEMPLATES[name].rstrip(".")


def test_wording():
    assert wording("a b c".split(), "x a b c y".split()) == (1, 4, [])
    assert wording("a b c d".split(), "a b x c d".split()) == (0, 5, ["+x"])
    assert wording("a b c d".split(), "a b d".split()) == (0, 3, ["-c"])
    i, j, differences = wording("a b c d e f".split(), "a b q d e f".split())
    assert (i, j, sorted(differences)) == (0, 6, ["+q", "-c"])


def test_small_differences_are_told_and_large_ones_refused(matcher):
    long = "Permission is hereby granted, free of charge, to any person getting a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"
    name, _, _, differences = matcher.find(long)[0]
    assert name == "MIT-permission" and sorted(differences.split()) == ["+getting", "-obtaining"]
    for text in ("Licensed under the Apache License, Version 1.1.", "the license was lost", "a driving licence", "copyright of the lore", "Licensed to drive"):
        assert matcher.find(text) == []


def test_several_notices_in_line_and_wrapped(matcher):
    text = "ë𝒳 x Released under the MIT License. more Licensed under\n  CC BY 4.0, then RELEASED UNDER THE MIT LICENSE"
    assert [(n, text[s:e]) for n, s, e, _ in matcher.find(text)] == [
        ("MIT", "Released under the MIT License"),
        ("CC-BY-4.0", "Licensed under\n  CC BY 4.0"),
        ("MIT", "RELEASED UNDER THE MIT LICENSE"),
    ]


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_wrapped_at_every_word_and_with_words_ahead(matcher, name):
    parts = TEMPLATES[name].split()
    for cut in range(1, len(parts)):
        text = " ".join(parts[:cut]) + "\n * " + " ".join(parts[cut:])
        assert [(n, d) for n, _, _, d in matcher.find(f"Before.\n * {text}\n * after it")] == [(name, "")], cut
    for ahead in range(51):
        assert [(n, d) for n, _, _, d in matcher.find("ahead " * ahead + TEMPLATES[name] + " and after")] == [(name, "")], ahead


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_one_added_word(matcher, name):
    parts = TEMPLATES[name].split()
    for cut in range(1, len(parts)):
        text = " ".join(parts[:cut]) + " entirely " + " ".join(parts[cut:])
        if len(matcher.cue.findall(text)) == len(matcher.cue.findall(TEMPLATES[name])):  # else it parts a cue's words
            assert name in [n for n, _, _, _ in matcher.find(text)], text


def test_usual_notices(matcher):
    for name, text in {
        "MIT-licensed": "this project is licensed under the MIT licence",
        "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy",
        "CC-BY-SA-4.0": "Licensed under CC-BY-SA-4.0",
        "GPL-program": "This program is free software; you can redistribute it and/or\nmodify it under the terms of the GNU General Public\nLicense.",
        "Unlicense": "This is free and unencumbered software released into the public\ndomain.",
        "Apache-2.0": "Licensed under the Apache License, v2.0",
    }.items():
        assert [n for n, _, _, _ in matcher.find(text)] == [name]
    for text in ("Licensed under CC BY-ND 4.0.", "Licensed under the Mozilla Public License 1.1.", "licensed under the GNU Library General Public License, version 2"):
        assert matcher.find(text) == []


def test_short_names_and_identifiers(matcher):
    for name, text in {
        "MIT-identifier": "// SPDX-License-Identifier: MIT",
        "Apache-2.0-identifier": "# SPDX-License-Identifier: Apache-2.0\nimport x",
        "GPL-3.0-identifier": "/* SPDX-License-Identifier: GPL-3.0-or-later */",
        "MIT-distributed": "Distributed under the terms of the MIT license.",
        "GPL-3.0-short": "Licensed under GPL-3.0.",
        "GPL-3.0-name": "It is licensed under the GNU General Public License v3 here",
    }.items():
        assert [n for n, _, _, _ in matcher.find(text)] == [name]
    for text in ("SPDX-License-Identifier: EUPL-1.2", "Licensed under GPL-4.0.", "the identifier of a license"):
        assert matcher.find(text) == []


def brute(matcher, text):
    """Every template's wording against every part about every cue, without compression: the one with most words that is confirmed."""
    placed, out, first, done = license_scan.words(text), [], 0, 0
    flat = [w for w, _, _ in placed]
    for cue in matcher.cue.finditer(text):
        if cue.start() < done:
            continue
        at = sum(s <= cue.start() for _, s, _ in placed) - 1
        fits = []
        for t in matcher.templates:
            for own in t.cues:
                low = max(first, at - own - t.allowed)
                i, j, d = wording(t.words, flat[low : max(low, at - own + len(t.words) + t.allowed)], t.fixed)
                if j > i and t.accepts(d):
                    fits.append((len(t.words) - 2 * len(d), t.name, low + i, low + j))
        if fits:
            _, name, i, j = max(fits, key=lambda x: (x[0], x[1]))
            out.append((name, placed[i][1], placed[j - 1][2]))
            first, done = j, placed[j - 1][2]
    return out


def test_ranking_by_saved_bytes_finds_what_brute_force_finds(matcher):
    """Other wordings too: words dropped, added and replaced at random places of every template."""
    import random

    rng = random.Random(7)
    names = alike = 0
    for name, template in sorted(TEMPLATES.items()):
        for _ in range(6):
            parts = template.split()
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(parts))
                parts[at : at + rng.randrange(2)] = rng.choice([[], ["entirely"], ["such"]])
            text = "Words ahead. " + " ".join(parts) + " Words behind."
            ours, theirs = [x[:3] for x in matcher.find(text)], brute(matcher, text)
            names += 1
            assert bool(ours) == bool(theirs), (ours, theirs, text)
            alike += ours == theirs
    assert alike >= 0.95 * names


def test_every_cue_has_a_template():
    for cue in ("licens", "copyright", "permission is hereby", "public domain", "redistribution and use"):
        assert any(cue in t.lower() for t in TEMPLATES.values())


def test_query_equals_exact_search(spark):
    rows = queries.op6_license_scan(spark, DATA).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        want = sorted((texts[r.doc_id].find(t.rstrip(".")), n) for n, t in TEMPLATES.items() if t.rstrip(".") in texts[r.doc_id])
        got = sorted((int(x.split(":")[1]), x.split(":")[0]) for x in r.licenses.split(",") if x)
        assert {n for _, n in want} <= {n for _, n in got}, (r, want)
    assert sum(r.n_licenses for r in rows) > 5


def test_edges(spark):
    notice = TEMPLATES["MIT"]
    rows = [(1, None), (2, ""), (3, notice), (3, notice), (None, notice), (4, "licensed " * 5000), (5, ("filler words " * 20_000) + notice)]
    docs = spark.createDataFrame([(*r, "l", 1) for r in rows], SCHEMA)
    found = license_scan.scanned(docs, out="found").collect()
    assert sorted((str(r.doc_id), len(r.found)) for r in found) == [("1", 0), ("2", 0), ("3", 1), ("3", 1), ("4", 0), ("5", 1), ("None", 1)]
    assert license_scan.scanned(docs.limit(0)).collect() == []
    clash = license_scan.scanned(docs.where("doc_id = 2"))
    assert clash.columns == ["doc_id", "text", "licenses_", "name", "licenses"] and clash.first()["licenses_"] == "l"
