import re

from tiergrain.llm import license_scan as L

BREAK = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in BREAK.split(low) if w]


def brute(text, theta=L.CONTAINMENT):
    ws = words(text)
    places, base = [], set()
    for phrase, label in L.PHRASES:
        p = phrase.split()
        for i in range(len(ws) - len(p) + 1):
            if ws[i:i + len(p)] == p:
                places.append(i)
                base.add(label)
    labels, score = set(base), 1.0 if places else 0.0
    for label, t, must, never in L.TEMPLATES:
        ts, run = set(words(t)), len(words(t)) + L.SLACK
        for i in range(max(1, len(ws) - run + 1)):
            b = set(ws[i:i + run])
            c = len(b & ts) / len(ts)
            if c >= theta - 1e-9 and b.issuperset(must.split()) and b.isdisjoint(never.split()):
                labels.add(label)
                score = max(score, c)
    return (len(ws), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 9))


def got_of(rows):
    return [(r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, ",".join(r.base_labels), ",".join(r.labels),
                        round(r.score, 9))) for r in rows]


def odd():
    t = [x for _, x, _, _ in L.TEMPLATES]
    out = [None, "", "!!", "MIT License mit license MIT-license", "cc by cc by", "apachelicense", "Kİ cć by",
           "GNU  General\nPublic License", " ".join(t), "\n".join(t), "x " * 30_000 + "MIT License", "the under license"]
    for x in t:
        ws = x.split()
        for drop in range(0, len(ws), 2):
            out.append("foo " + " ".join(ws[:drop] + ws[drop + 1:]).upper() + " bar")
        out.append(" ".join(ws[:len(ws) // 2]) + "\n" + " ".join(ws[len(ws) // 2:]))
    return out


GPL = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
       "Public License as published by the Free Software Foundation, either version 3 of the License, or later.")
NOTICES = [
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"), ("Licensed under CC BY 4.0", "cc-by"),
    ("Licensed under CC BY-SA 4.0", "cc-by,cc-by-sa"), (GPL, "gpl"),
    (GPL.replace("program", "library").replace("General", "Lesser General"), "lgpl"),
    ("Permission is hereby granted, free of charge, to any person obtaining\na copy of this software and associated "
     "documentation files (the\n\"Software\"), to deal in the Software without restriction.", "mit"),
    ("Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that "
     "the following conditions\n * are met:", "bsd"),
    ("licensed under the terms of the\nGNU Affero General Public License", "agpl"),
    ("This work is licensed under the Mozilla Public License version 3", ""),
    ("Er kommt mit dem Zug. The road goes under the bridge. A driving license.", ""),
]


def test_notices_get_the_labels_a_reader_gives(spark):
    rows = [(i, x + t + y) for i, (t, _) in enumerate(NOTICES) for x, y in (("", ""), ("Foo bar.\n\n", "\nfoo " * 40))]
    got = L.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, ",".join(r.labels)) for r in got} == {(i, want) for i, (_, want) in enumerate(NOTICES)}


def test_odd_texts_against_plain_code(spark):
    texts = odd()
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, places int")
    assert dict(got_of(L.scan_licences(df).collect())) == {i: brute(t) for i, t in enumerate(texts)}


def test_query_against_plain_code(spark):
    from tiergrain.llm.registry import op7_licences

    d = "/root/testdata/sf0.01"
    want = {r.doc_id: brute(r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9))
           for r in op7_licences(spark, d).collect()}
    assert got == want and any(v[1] for v in want.values())


def test_repeated_rows_null_ids_and_empty_table(spark):
    t = "Released under the MIT License."
    df = spark.createDataFrame([(1, t), (1, t), (None, t), (None, None), (1, "x")], "doc_id long, text string")
    got = L.scan_licences(df)
    assert sorted(got_of(got.collect()), key=str) == sorted(
        [(1, brute(t)), (1, brute(t)), (None, brute(t)), (None, brute(None)), (1, brute("x"))], key=str)
    assert L.scan_licences(df.limit(0)).count() == 0
