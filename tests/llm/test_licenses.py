"""Short forms, license bodies and headers, and the gate of the license scan."""

import random
import re
import time

import pytest

from lakeretrieve.llm import licenses


@pytest.mark.parametrize(
    "text, label",
    [
        ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
        ("Photo: CC-BY-SA 3.0", "cc-by-sa"),
        ("cc by-nd", "cc-by-nd"),
        ("Licensed under CC BY-NC-SA 4.0.", "cc-by-nc-sa"),
        ("CC BY-NC-ND", "cc-by-nc-nd"),
        ("released as CC0", "cc0"),
        ("the code is GPLv3", "gpl"),
        ("GPLv3 license", "gpl"),
        ("LGPL-2.1 or later", "lgpl"),
        ("under AGPLv3", "agpl"),
        ("Apache-2.0", "apache"),
        ("Permission is hereby granted, free of charge, to any person\n * obtaining a copy", "mit"),
        ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
        ("Neither the name of the Example Group nor the names of its contributors may be used to endorse or promote products derived from this software", "bsd-3-clause"),
        ("you can redistribute it and/or modify it under the terms of the GNU Affero General Public", "agpl"),
        ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ],
)
def test_short_forms_and_sentences(text, label):
    found = licenses.scan(text.encode())
    assert [d[0] for d in found[7]] == [label]
    assert label in found[5].split(",")


def test_every_match_has_the_keyword():
    """Gates are safe: rules of one name only match with their keyword, and plain prose has no license."""
    assert licenses.scan(b"the open window, a common bird and a python in the database")[5:] == ("", 0.0, [])
    assert licenses.scan("GNU General Public Licence".encode())[5] == "gpl"


def test_keywords_stand_in_their_sentences():
    """A sentence without its keyword could never match behind the gate."""
    for label, keyword, sentence in licenses.SENTENCES:
        required = re.sub(r"\(\?:[^()]*\)(?:\?|\{0,\d+\})", " ", sentence)
        assert keyword in re.findall("[0-9a-z]+", required), (label, keyword)


def test_suppression_against_all_pairs():
    r = random.Random(5)
    names = [licenses.Rule(f"r{i}", f"l{i}", b"", i % 3, 0.5, None) for i in range(9)]
    for _ in range(300):
        found = {(r.choice(names), a, a + r.randint(1, 9)) for a in (r.randint(0, 20) for _ in range(r.randint(0, 25)))}
        taken = []
        for d in sorted(found, key=lambda d: (-d[0].priority, d[1] - d[2], d[1], d[0].name)):
            if not any(a <= d[1] and d[2] <= b for _, a, b in taken):
                taken.append(d)
        assert licenses._unsuppressed(list(found)) == sorted(taken, key=lambda d: (d[1], d[2], d[0].name))


def test_words_and_places_against_tokens():
    """Base places, labels and word counts of whole texts against word lists."""
    r = random.Random(6)
    bits = ["MIT License", "Apache-License", "cc by", "GNU General\nPublic License", "GNU general", "license", "é", "a_b", ",", "mit", "\u212a"]
    for _ in range(300):
        text = " ".join(r.choice(bits) for _ in range(r.randint(0, 12)))
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        starts = [i for i, _ in places]
        got = licenses.scan(text.encode())
        assert got[:4] == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert got[4] == ",".join(sorted({label for _, label in places}))
        assert {label for _, label in places} <= set(got[5].split(",")) and 0 <= got[6] <= 1


def test_long_text_of_licenses():
    """Two MB of license lines: work grows with the text, not with its square."""
    text = b"mit license, apache license, " * 70_000
    began = time.monotonic()
    assert licenses.scan(text)[1] == 140_000
    assert time.monotonic() - began < 30
