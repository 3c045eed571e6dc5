import hashlib
import random
from collections import Counter

import pytest
from llm_rows import ODD, by_row

from marginflow.llm import substring

BLANKS = " \t\n\x0b\x0c\r"


def words(text):
    for b in BLANKS[1:]:
        text = (text or "").replace(b, " ")
    return [w for w in text.split(" ") if w]


def plain(rows, size):
    lists = [words(t) for _, t in rows]
    starts = Counter(tuple(w[i:i + size]) for w in lists for i in range(len(w) - size + 1))
    out = []
    for (doc, _), w in zip(rows, lists, strict=True):
        gone = {j for i in range(len(w) - size + 1) if starts[tuple(w[i:i + size])] > 1 for j in range(i, i + size)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), kept))
    return sorted(out, key=repr)


def got(df, size):
    return by_row(substring.remove_repeats(df, size), "doc_id", "n_words", "n_removed", "kept")


@pytest.mark.parametrize("size", [35, 9, 8, 3, 1])
def test_odd_rows(odd, size):
    assert got(odd, size) == plain([(i, t) for i, t in ODD], size)


@pytest.mark.parametrize("size", [12, 20])
def test_random_texts(spark, size):
    """Few words, many chance repeats, edited and overlapping copies."""
    rng = random.Random(size)
    rows, passages = [], [[f"p{k}_{i % 9}" if k % 2 else f"p{k}_{i}" for i in range(rng.randint(5, 60))] for k in range(8)]
    for doc in range(120):
        text = []
        for _ in range(rng.randint(0, 6)):
            p = list(rng.choice(passages))
            for _ in range(rng.choice([0, 0, 1, 2])):
                p[rng.randrange(len(p))] = "edit"
            text += p[rng.randint(0, 4):] + [rng.choice("abc") for _ in range(rng.choice([0, 3, 30]))]
        rows.append((doc, rng.choice(BLANKS).join(text)))
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), size) == plain(rows, size)


def test_one_word_over_and_over(spark):
    rows = [(1, "a " * 200), (2, "a " * 35), (3, "b " * 35), (4, "a " * 34)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), 35) == plain(rows, 35)


def test_empty_and_carried_columns(odd, nothing):
    assert substring.remove_repeats(nothing).count() == 0
    kept = substring.remove_repeats(odd.withColumn("source", odd.row), keep=("source",))
    assert {(r.doc_id, r.source) for r in kept.collect()} == {(i, None if i is None else f"row{i}") for i, _ in ODD}


def test_hash_of_nothing_left(spark):
    from marginflow.llm.queries import op4_substring

    rows = op4_substring(spark, "/root/testdata/sf0.001").collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert all((r.kept_sha256 == empty) == (r.n_words == r.n_removed) for r in rows)
