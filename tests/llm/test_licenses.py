import re

from tidedesk.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
       " documentation files (the \"Software\")")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def places(w, phrase):
    v = phrase.split()
    return [i for i in range(len(w) - len(v) + 1) if w[i:i + len(v)] == v]


def brute(doc_id, text):
    """Short templates by plain search; long ones by votes of a dictionary of places."""
    w, base, every, best = words(text), [], set(), 0.0
    for t, label in licenses.PHRASES:
        found = places(w, t)
        base += [(p, label) for p in found]
        every |= {label} if found else set()
    best = 1.0 if base else 0.0
    for t, label in licenses.MORE:
        v = t.split()
        if len(v) < 5:
            hit = 1.0 if places(w, t) else 0.0
        else:
            hit, diagonals = 0.0, {}
            for a in range(len(v) - 4):
                for p in places(w, " ".join(v[a:a + 5])):
                    diagonals.setdefault(p - a, []).append((p, a))
            groups = []
            for d in sorted(diagonals):
                if not groups or d - groups[-1][-1] > 3:
                    groups.append([])
                groups[-1].append(d)
            for g in groups:
                votes = [x for d in g for x in diagonals[d]]
                reached = len({a + i for _, a in votes for i in range(5)}) / len(v)
                length = max(p for p, _ in votes) + 5 - min(p for p, _ in votes)
                if reached >= 0.75 and length <= 1.5 * len(v):
                    hit = max(hit, reached)
        if hit:
            every.add(label)
            best = max(best, hit)
    starts = [p for p, _ in base]
    return (doc_id, len(w), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in base})), ",".join(sorted(every)), best)


DOCS = [
    (1, "Released under the MIT License."), (2, "This work is licensed under the GNU General Public License, version 3."),
    (3, "GNU general, public license; gnu General\nPublic_License mit"), (4, None), (5, ""), (6, "?!"), (7, "mit"), (8, "license mit license mit license"),
    (9, "Licensed under CC BY-NC 4.0."), (10, "gnu lesser general public license"), (11, MIT), (12, f"x y {MIT.replace('granted', 'now granted')} z"),
    (13, MIT.replace("free of charge", "gratis")), (14, "hereby granted free of charge to any"), (15, MIT[:60]),
    (16, "Redistribution and use in source and compiled forms, with or without modification, are permitted provided that the following conditions are met:"),
    (17, "mit license"), (17, "mit license"), (17, "other text under the apache license"), (None, "cc by"), (None, "cc by"), (None, None),
    (18, f"{MIT} {MIT} apache license"), (19, "gnu gnu general general public license license gnu general public license"),
    (20, "the " * 30_000 + "mit license " * 2_000 + "cc by"), (21, "ünder the mit licensé of ©mit license"),
]


def test_against_brute_force(make_docs, tuples):
    got = tuples(licenses.scan(make_docs(*DOCS).repartition(3)), *COLUMNS)
    assert got == sorted((brute(*d) for d in DOCS), key=str)


def test_templates_join_by_shuffle(make_docs, tuples, monkeypatch):
    monkeypatch.setattr(licenses, "BROADCAST_ROWS", -1)
    assert tuples(licenses.scan(make_docs(*DOCS)), *COLUMNS) == sorted((brute(*d) for d in DOCS), key=str)


def test_merged_diagonals(make_docs, tuples):
    text = MIT.replace("obtaining a copy", "who is obtaining any copy")
    spans = licenses.find_spans(make_docs((1, f"a b c {text}")))
    (start, cover), = tuples(spans, "start", "cover")
    assert start == 3 and 0.75 <= cover < 1


def test_own_templates(make_docs, tuples):
    found = licenses.find_spans(make_docs((1, "one two three"), (2, "two three one two")), [("one two", "a", True), ("two three", "b", False)])
    assert tuples(found, "doc_id", "label", "start") == [(1, "a", 0), (1, "b", 1), (2, "a", 2), (2, "b", 0)]


def test_empty_table_and_native_plan(make_docs):
    assert licenses.scan(make_docs()).count() == 0
    positions = licenses.template_positions(make_docs().sparkSession, licenses._templates())
    plan = licenses.report(make_docs(*DOCS), licenses.spans(licenses.diagonals(licenses.votes(make_docs(*DOCS), positions))))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "BroadcastHashJoin" in text
