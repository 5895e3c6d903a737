import random
import re

from llm_cases import ODD
from postflow.llm.license_scan import NOTICES, PHRASES, distance, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def expected(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)))


def test_places_against_brute_force(documents):
    texts = ODD + ["MIT-License, mit license mit", "Gnu General\nPublic License v3", "licence: CC BY 4.0 / cc-by",
                   "gnu general", "public license", "license", "xmit license", "mit licenses",
                   "mit license " * 3000]
    rows = list(enumerate(texts)) + [(5, "mit license"), (5, "mit license"), (None, "apache license")]
    got = scan_licenses(documents(rows)).collect()
    assert len(got) == len(rows)
    by_row = sorted((repr(r.doc_id), r.n_words, r.n_base, repr(r.first_word), repr(r.last_word), r.base_labels)
                    for r in got)
    assert by_row == sorted((repr(i), *(lambda e: (e[0], e[1], repr(e[2]), repr(e[3]), e[4]))(expected(t)))
                            for i, t in rows)
    for r in got:
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 1) >= (r.n_base > 0)


def test_fuzzy_notices(documents):
    texts = ["Released under the MIT Licence.", "the Apache Licence, v2", "GNU Genral Public Licence",
             "nothing of the kind", "Mozilla Public Lisense"]
    got = {r.doc_id: r for r in scan_licenses(documents(list(enumerate(texts)))).collect()}
    assert [got[i].labels for i in range(5)] == ["mit", "apache", "gpl", "", "mpl"]
    assert got[0].n_base == 0 and 0.8 < got[0].score < 1 and got[3].score == 0
    span = got[1].spans[0]
    assert span.edits == 1 and texts[1].lower()[span.start:span.end].startswith("apache lic")


def nearest(notice, text):
    """Fewest edits from the notice to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(notice, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (a != b)))
    return min(row)


def test_adjacent_inexact_notices_against_brute_force(documents):
    pick = random.Random(3)
    texts = ["mit licence mit license", "gnu generel public licence; gnu general public license",
             "mit licence " * 40 + "mit license", "mit license mit licence mit licens mit license"]
    for _ in range(60):
        words = []
        for _ in range(pick.randint(2, 7)):
            word = list(pick.choice(NOTICES[:4])[0])
            for _ in range(pick.choice((0, 0, 1, 1, 2, 3, 4))):
                at = pick.randrange(len(word))
                word[at:at + 1] = pick.choice(([], ["x"], [word[at], "e"]))
            words.append("".join(word))
        texts.append(pick.choice((" ", "; ", "")).join(words))
    got = {r.doc_id: r for r in scan_licenses(documents(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        for notice, label, edits in NOTICES:
            spans = [s for s in got[i].spans if s.label == label]
            for s in spans:
                part = text[s.start:s.end]
                assert nearest(part, notice) <= nearest(notice, part) == s.edits <= edits, (text, s)
            for most in range(edits + 1):
                ends = [(0, 0), *((s.start, s.end) for s in spans if s.edits <= most), (len(text),) * 2]
                for (_, low), (high, _) in zip(ends, ends[1:]):
                    assert low <= high and nearest(notice, text[low:high]) > most, (text, label, most)
    assert [(s.start, s.edits) for s in got[0].spans] == [(0, 1), (12, 0)]
    assert [(s.start, s.edits) for s in got[1].spans] == [(0, 2), (28, 0)]
    assert len(got[2].spans) == 41


def test_labels_need_whole_words(documents):
    texts = ["please submit licenses", "permit license", "with it license", "limit licence", "mit licenses", "(MIT licence)",
             "the mit license", "submit license, mit licence", "x" * 5000 + "mit license" + "y" * 5000, "mit license"]
    got = {r.doc_id: r for r in scan_licenses(documents(list(enumerate(texts)))).collect()}
    assert [got[i].labels for i in range(10)] == ["", "", "", "", "mit", "mit", "mit", "mit", "", "mit"]
    assert [got[i].score for i in (0, 1, 2, 3, 8)] == [0.0] * 5 and got[6].score == got[9].score == 1
    assert all(0.8 < got[i].score < 1 for i in (4, 5, 7))
    assert [s.whole for s in got[7].spans] == [None, 1]


def test_sentences_of_headers(documents):
    texts = ["Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software",
             "Licenced under the Apache License, Version 2.0 (the \"License\")",
             "Redistribution and use in source and binary forms, with or without modifications, are permitted",
             "redistribute it and/or modify it under the terms of the GNU Lesser General Public Licence",
             "you can redistribute it and/or modify it under the terms of the GNU General Public Licence",
             "Redistribution of water and use of sources"]
    got = {r.doc_id: r for r in scan_licenses(documents(list(enumerate(texts)))).collect()}
    assert [got[i].labels for i in range(6)] == ["mit", "apache", "bsd", "lgpl", "gpl", ""]
    assert 0.9 < got[0].score < 1 and got[5].score == 0


def test_distance_is_bounded():
    for a, b, most, want in ((b"abc", b"abc", 0, 0), (b"abc", b"axc", 1, 1), (b"abc", b"xyz", 2, 3), (b"abc", b"abcde", 1, 2), (b"abc", b"", 3, 3)):
        assert distance(a, b, most) == want


def test_empty_table(documents):
    assert scan_licenses(documents([(1, "a")]).filter("doc_id = 0")).collect() == []
