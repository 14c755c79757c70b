"""Published license texts and notices, and all rules against a plain search of whole texts."""

import re

import pytest

from edge_cases import TEXTS
from martloom.llm.license_texts import BODIES, NAMES
from martloom.llm.licenses import ANCHOR_PAIRS, ANCHOR_START, ANCHORS, REACH, license_scan, signature_rules

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction. The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer."""
ENDORSE = """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""
GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public
License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.
You should have received a copy of the GNU {kind}General Public License along with this program."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software."""

NOTICES = [
    (MIT, "mit"),
    (BSD, "bsd"),
    (BSD + ENDORSE, "bsd,bsd-3-clause"),
    (APACHE, "apache-2"),
    (GNU.format(kind="", version="2"), "gpl,gpl-2"),
    (GNU.format(kind="", version="3"), "gpl,gpl-3"),
    (GNU.format(kind="Lesser ", version="2.1"), "lgpl,lgpl-2.1"),
    (GNU.format(kind="Affero ", version="3"), "agpl,agpl-3"),
    (ISC, "isc"),
    (ZLIB, "zlib"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2"),
    ("See accompanying file LICENSE_1_0.txt", "bsl-1"),
    ("see http://creativecommons.org/licenses/by-nc-sa/4.0/", "cc-by-nc-sa"),
    ("https://www.gnu.org/licenses/gpl-3.0.html", "gpl-3"),
    ("The Software shall be used for Good, not Evil.", "json"),
    ("you can redistribute it and/or modify it under the same terms as Perl itself", "perl-5"),
    ("A driving licence is granted in binary forms of permission, not evil but held in the public domain.", ""),
    ("They properly promote materials in advertising; the medium must retain its mark.", ""),
]


def scanned(spark, texts):
    rows = list(enumerate(texts))
    return {r["doc_id"]: r for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}


def test_license_texts_and_notices(spark):
    found = scanned(spark, [text for text, _ in NOTICES])
    assert [found[n]["labels"] for n in range(len(NOTICES))] == [labels for _, labels in NOTICES]
    assert [n for n in found if found[n]["n_base"]] == [3], "the base phrase of one notice"
    assert all((found[n]["score"] > 0.8) == bool(labels) for n, (_, labels) in enumerate(NOTICES))


def plain_search(text, rules):
    """Every match in the whole text, without those that a better one contains."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower())
    spaced = " " + "  ".join(words) + " "
    found = set()
    for rule, pattern in rules:
        for match in pattern.finditer(spaced) if rule["need"] in spaced else ():
            start = spaced.count(" ", 0, match.start()) // 2
            found.add((start, start + len(match.group().split()), rule["label"], rule["priority"]))

    def better(e, d):
        inside = e[0] <= d[0] and d[1] <= e[1]
        return inside and (e[3] > d[3] or (e[3] == d[3] and e[1] - e[0] > d[1] - d[0]))

    return {d for d in found if not any(better(e, d) for e in found)}


def test_detections_are_those_of_a_plain_search(spark):
    rules = [(rule, re.compile(rule["pattern"])) for rule in signature_rules()]
    notices = [text for text, _ in NOTICES]
    mixed = [f"{a} {'filler words ' * 12} {b}" for a, b in zip(notices, notices[5:] + notices[:5], strict=True)]
    texts = notices + mixed + [" ".join(notices), " and ".join(reversed(notices))] + [t for _, t in TEXTS if len(t or "") < 10_000]
    found = scanned(spark, texts)
    for n, text in enumerate(texts):
        detections = {(d["start"], d["end"], d["label"], d["priority"]) for d in found[n]["detections"]}
        assert detections == plain_search(text, rules), text


def anchored(words):
    """Numbers of the words at which rules are tried."""
    pairs = {(first, following) for following, firsts in ANCHOR_PAIRS.items() for first in firsts}
    following = [*words[1:], None]
    return [n for n, (w, f) in enumerate(zip(words, following, strict=True)) if w.startswith(ANCHOR_START) or w in ANCHORS or (w, f) in pairs]


@pytest.mark.parametrize("signature", [*BODIES, *NAMES], ids=lambda s: f"{s[0]}-{s[1]}")
def test_signatures_are_within_reach_of_an_anchor(signature):
    _, need, pattern = signature
    words = re.sub(r"\(\?:|\)\??|\[(.)[^]]*\]|\?", r"\1", pattern).replace("|", " ").split()
    assert need in " ".join(words)
    anchors = anchored(words)
    assert anchors, "a match holds an anchor"
    assert anchors[0] <= REACH, "a detection is taken at its first anchor"
    assert len(words) - 1 - anchors[0] <= REACH
