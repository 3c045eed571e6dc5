import numpy as np
from llm_rows import ODD, by_row
from pyspark.sql import functions as F

from marginflow.llm import language
from marginflow.llm.common import read

DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    from marginflow.llm.queries import op8_language

    rows = op8_language(spark, DIR).join(read(spark, DIR, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(held) > 200
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_mixed_documents_name_both_languages(spark):
    docs = read(spark, DIR, "documents")
    counts = language.learn(docs)
    names, table = language.probabilities(counts)
    whole = {r.lang: r.text for r in docs.where(F.length("text") > 1500).groupBy("lang").agg(F.first("text").alias("text")).collect()}
    for a in names:
        for b in names:
            if a < b:
                found, share = language.mixture(language.cells_of(whole[a][:900] + " " + whole[b][:500]), table)
                assert {names[i] for i in found[:2]} == {a, b} and names[found[0]] == a
                assert abs(share.sum() - 1) < 1e-9
    one, share = language.mixture(language.cells_of(whole["en"]), table)
    assert [names[i] for i in one] == ["en"] and share[0] == 1


def test_em_against_plain_loops():
    rng = np.random.default_rng(0)
    likelihood, weights = rng.random((30, 3)), rng.integers(1, 9, 30).astype(float)
    share = [1 / 3] * 3
    for _ in range(25):
        new = [0.0] * 3
        for g in range(30):
            total = sum(share[k] * likelihood[g, k] for k in range(3))
            for k in range(3):
                new[k] += weights[g] * share[k] * likelihood[g, k] / total
        done = max(abs(n / weights.sum() - s) for n, s in zip(new, share, strict=True)) < 1e-3
        share = [n / weights.sum() for n in new]
        if done:
            break
    got, level = language.proportions(weights, likelihood)
    assert np.allclose(got, share)
    assert np.isclose(level, (weights * np.log(likelihood @ np.array(share))).sum())


def test_sets_against_all_subsets(spark):
    """The set is the best penalised one of all, also where a poor candidate looks good at first."""
    import itertools
    import math

    docs = read(spark, DIR, "documents")
    names, table = language.probabilities(language.learn(docs))
    rows = docs.where("doc_id % 4 = 0 or doc_id in (191, 460, 661, 812, 972)").collect()
    assert len(names) == 4 and len(rows) > 250
    for r in rows:
        if not language.has_letter(r.text):
            continue
        cells = language.cells_of(r.text)
        weights = np.bincount(cells, minlength=language.CELLS)
        used = np.flatnonzero(weights)
        weights, cost = weights[used].astype(float), math.log(weights.sum() + 1)
        worth = {}
        for n in range(1, 5):
            for some in itertools.combinations(range(4), n):
                share, level = language.proportions(weights, table[used][:, list(some)])
                worth[some] = level - cost * (n - 1), share.max()
        best = max(worth, key=lambda s: worth[s][0])
        found, share = language.mixture(cells, table)
        assert tuple(sorted(found)) == best and abs(share[0] - worth[best][1]) < 0.01, r.doc_id


def test_odd_rows(spark, odd, nothing):
    counts = language.learn(read(spark, DIR, "documents"))
    got = {r.row: (r.lang_pred, r.score, r.languages) for r in language.predict(odd, counts, keep={"row": F.col("row")}).collect()}
    assert len(got) == len({i for i, _ in ODD})
    for i in (2, 3, 4, 5):
        assert got[f"row{i}"] == ("und", 0.0, [])
    assert got["row1"][0] == "en"
    assert language.predict(nothing, counts).count() == 0
    assert language.learn(nothing.withColumn("lang", F.lit("en"))) == {}
    assert {r.lang_pred for r in language.predict(odd, {}).collect()} == {"und"}


def test_null_languages_and_texts_teach_nothing(spark):
    rows = spark.createDataFrame([("some words", None), (None, "fr"), ("more words", "en"), ("...", "de")], "text string, lang string")
    assert list(language.learn(rows)) == ["en"]


def test_learning_adds_up_over_partitions(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    one, many = language.learn(docs.coalesce(1)), language.learn(docs.repartition(7))
    assert one.keys() == many.keys() and all((one[k] == many[k]).all() for k in one)
    assert by_row(language.predict(docs, one), "doc_id", "lang_pred") == by_row(language.predict(docs, many), "doc_id", "lang_pred")
