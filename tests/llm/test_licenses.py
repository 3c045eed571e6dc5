import math

from llm_rows import ODD

from marginflow.llm import licenses as lic
from marginflow.llm.common import read


def plain_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) > 127:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def plain_base(text):
    words = plain_words(text)
    found = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    starts = [i for i, _ in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in found})))


def plain_chain(steps):
    """Heaviest chain by trying every end."""
    steps, best = sorted(steps), []
    for n, (at, i, w) in enumerate(steps):
        best.append(w + max((best[m] for m in range(n) if steps[m][0] < at and steps[m][1] < i), default=0.0))
    return max(best, default=0.0)


def plain_method(text, idf, rare=0.5, least=0.8, slack=0.15):
    """Every start of every template tried, word by word, without an index."""
    words, found = plain_words(text), {}
    for t in lic.TEMPLATES:
        want = plain_words(t.text)
        if len(words) > 1000 and not set(want) & set(words):
            continue
        near = max(2, round(slack * len(want)))
        top = max(idf[w] for w in want)
        chosen = [(i, w) for i, w in enumerate(want) if idf[w] >= rare * top]
        total = sum(idf[w] for _, w in chosen)
        steps = [(at, i, idf[w]) for i, w in chosen for at in range(len(words)) if words[at] == w]
        for start in range(-len(want), len(words)):
            got = plain_chain([s for s in steps if abs(s[0] - s[1] - start) <= near])
            if got / total < least:
                continue
            low, high = max(0, start - near), min(len(words), start + len(want) + near)
            region = words[low:high]
            keys = [k.split() for k in t.keys]
            if all(any(region[i:i + len(k)] == k for i in range(len(region) - len(k) + 1)) for k in keys):
                found[t.label] = max(found.get(t.label, 0), min(1.0, got / total))
    return found


def expected(rows):
    sets = [set(plain_words(t)) for _, t in rows]
    idf = {w: math.log((max(1, len(rows)) + 1) / (sum(w in s for s in sets) + 0.5))
           for t in lic.TEMPLATES for w in plain_words(t.text)}
    out = []
    for i, text in rows:
        base, more = plain_base(text), plain_method(text, idf)
        labels = ",".join(sorted(({x for x in base[4].split(",") if x}) | more.keys()))
        out.append((i, *base, labels, round(1.0 if base[1] else max(more.values(), default=0.0), 9)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9))
                   for r in lic.scan(df).collect()), key=repr)


CASES = [
    (1, "Released under the MIT License. And again the mit-license!"), (2, "A mit. License"), (3, "mit licenses"),
    (4, "This program: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation"),
    (5, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction"),
    (6, "Permission is granted, hereby free of charge to any person obtaining a copy of this software and associated "
        "documentation files"), (7, "Licensed under CC BY-NC 4.0."), (8, "Licensed under CC BY 4.0."),
    (9, "All rights reserved."), (10, "all rights are reserved"), (11, "Apache License Apache License General Public License"),
    (12, "Redistribution and use in source and binary forms, with or without any modification, are permitted provided that "
         "the following conditions are met"), (13, "the use of source and binary forms"), (14, "ÉMIT license mit\xa0license"),
]


def test_cases_against_brute_force(spark):
    rows = CASES + [(100 + i, f"plain words number {i} of the and in to by") for i in range(40)]
    want = expected(rows)
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == want
    labels = {r[0]: r[6] for r in want}
    assert (labels[5], labels[7], labels[8], labels[9], labels[12]) == ("mit", "cc-by-nc", "", "all-rights-reserved", "bsd")


def test_full_notices_with_inserted_words(spark):
    """Every notice is found by its label, as it is and with three words put into its middle."""
    rows, label = [], {}
    for n, t in enumerate(lic.TEMPLATES):
        words = t.text.split()
        keys = [key.split() for key in t.keys]

        def cuts_a_key(k, words=words, keys=keys):
            before, after = (plain_words(" ".join(x)) for x in (words[:k], words[k:]))
            return any(before[-n:] + after[:len(key) - n] == key for key in keys for n in range(1, len(key)))

        middle = next((k for k in range(len(words) // 2, len(words)) if not cuts_a_key(k)), len(words))
        more = [*words[:middle], "quite", "other", "things", *words[middle:]]
        rows += [(n, "Before it. " + t.text + " After it."), (1000 + n, "Before it. " + " ".join(more) + " After it.")]
        label[n] = t.label
        if len(plain_words(t.text)) >= 20:
            label[1000 + n] = t.label
    rows += [(5000 + i, f"plain words number {i} of the and in to by this software copy") for i in range(60)]
    found = {r.doc_id: r.labels.split(",") for r in lic.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(want in found[n] for n, want in label.items()), [(n, w, found[n]) for n, w in label.items() if w not in found[n]]
    assert len(set(label.values())) >= 16 and sum(n >= 1000 for n in label) >= 12
    assert all(found[5000 + i] == [""] for i in range(60))


def test_heaviest_chain():
    import random

    rng = random.Random(1)
    for _ in range(300):
        steps = [(rng.randrange(12), rng.randrange(9), rng.choice([0.5, 1.0, 2.0])) for _ in range(rng.randint(1, 14))]
        steps = list({s[:2]: s for s in steps}.values())
        assert lic.heaviest_chain(steps) == plain_chain(steps)


def test_odd_rows(odd, nothing):
    assert got(odd) == expected([(i, t) for i, t in ODD if i != 8] + [x for x in ODD if x[0] == 8])
    assert lic.scan(nothing).count() == 0


def test_query(spark):
    from marginflow.llm.queries import op10_licenses

    dir_ = "/root/testdata/sf0.001"
    want = {r.doc_id: plain_base(r.text) for r in read(spark, dir_, "documents").collect()}
    rows = op10_licenses(spark, dir_).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows} == want
    for r in rows:
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
