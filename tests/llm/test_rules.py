import numpy as np
from llm_rows import ODD
from pyspark.sql import functions as F

from marginflow.llm import rules
from marginflow.llm.common import read


def plain_counts(text):
    text = text or ""
    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered)


def test_counts_of_odd_rows(odd, nothing):
    got = sorted((tuple(r[c] for c in ("doc_id", *rules.COUNTS)) for r in rules.statistics(odd).collect()), key=repr)
    assert got == sorted(((i, *plain_counts(t)) for i, t in ODD), key=repr)
    assert rules.statistics(nothing).count() == 0


def test_query_counts_and_base(spark):
    from marginflow.llm.queries import op7_rules

    dir_ = "/root/testdata/sf0.001"
    want = {r.doc_id: plain_counts(r.text) for r in read(spark, dir_, "documents").collect()}
    for r in op7_rules(spark, dir_).collect():
        assert tuple(r[c] for c in rules.COUNTS) == want[r.doc_id]
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_held_out_labels(spark):
    """Learned on half of the labels, right about the other half."""
    dir_ = "/root/testdata/sf0.1"
    labels, stats = read(spark, dir_, "labels"), rules.statistics(read(spark, dir_, "documents"))
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = rules.learn(stats, labels.where(half))
    rows = stats.join(labels.where(~half), "doc_id").select((F.col("quality") == 1).alias("good"), found.keeps().alias("kept")).collect()
    right = [r.good == r.kept for r in rows]
    assert 1 <= len(found.rules) <= 12 and sum(right) >= 0.95 * len(right)
    assert sum(r.kept for r in rows if r.good) >= 0.98 * sum(r.good for r in rows)


def test_conjunction_is_found():
    rng = np.random.default_rng(4)
    table = {"a": rng.random(3000), "b": rng.random(3000), "c": rng.random(3000)}
    drop = (table["a"] >= 0.7) & (table["b"] <= 0.4)
    found = rules.cover(table, drop)
    out = np.zeros(3000, bool)
    for rule in found.rules:
        out |= rules._covered(rule, table, 3000)
    assert (out == drop).mean() > 0.98 and {c.name for r in found.rules for c in r} <= {"a", "b"}


def test_expression_equals_the_rules(spark):
    found = rules.DecisionList([[rules.Condition("x", True, 5.0), rules.Condition("y", False, 2.0)], [rules.Condition("x", False, 1.0)]])
    rows = spark.range(10).select(F.col("id").alias("x"), (F.col("id") % 4).alias("y")).select("x", "y", found.keeps().alias("kept"))
    for r in rows.collect():
        assert r.kept != (r.x >= 5 and r.y <= 2 or r.x <= 1)
    assert str(found).splitlines()[0] == "if x >= 5 and y <= 2: drop"


def test_labels_missing_or_of_one_kind(spark, odd):
    stats = rules.statistics(odd)
    for rows in ([], [(1, 1, 0)], [(1, None, 0), (99, 0, 0), (None, 0, 1)], [(1, 0, 0), (7, 0, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        assert rules.learn(stats, labels).rules == []
    assert rules.judge(odd, spark.createDataFrame([], "doc_id long, quality int")).count() == len(ODD)
