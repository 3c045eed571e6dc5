import ctypes
import math
import tracemalloc
import weakref
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import ODD
from pyspark.sql import functions as F

from marginflow.llm import hpylm
from marginflow.llm.common import crc_mod, give_back, read

DIR = "/root/testdata/sf0.001"


def words(text):
    return [w for w in (text or "").encode().lower().replace(b"\x0b", b" ").replace(b"\x0c", b" ").split() if w] + [None]


def plain(rows):
    """Base columns straight from the definition."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    return sorted(((i, held(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n,
                    round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)), 6)) for i, t in rows), key=repr)


def got(df, **options):
    rows = hpylm.score(df, crc_mod(F.col("doc_id"), 7) == 2, **options).collect()
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=repr)


@pytest.mark.parametrize("bucket_tokens", [5_000_000, 3_000])
def test_odd_rows(odd, bucket_tokens):
    assert got(odd, bucket_tokens=bucket_tokens) == plain(ODD)


def test_empty_and_nothing_to_learn_from(nothing, odd):
    assert got(nothing) == []
    rows = hpylm.score(odd, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens) for r in rows} == {(0, 0)} and all(r.score == r.base_score == 0.0 for r in rows)


def test_query(spark):
    from marginflow.llm.queries import op6_hpylm

    docs = [(r.doc_id, r.text) for r in read(spark, DIR, "documents").collect()]
    rows = op6_hpylm(spark, DIR).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=repr) == plain(docs)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_partitions_and_copies_change_nothing(spark):
    docs = read(spark, DIR, "documents")
    held = crc_mod(F.col("doc_id"), 7) == 2
    runs = [{r.doc_id: r.score for r in hpylm.score(d, held, bucket_tokens=b).collect()}
            for d, b in ((docs, 9_000), (docs.repartition(5), 9_000))]
    assert runs[0].keys() == runs[1].keys()
    assert all(math.isclose(runs[0][i], runs[1][i], rel_tol=1e-9) for i in runs[0])


def seats_are_sound(seats):
    for row in range(len(seats.room)):
        at = seats.at[seats.offset[row]:seats.offset[row] + seats.customers[row]]
        size = seats.size[seats.offset[row]:seats.offset[row] + seats.room[row]]
        assert (np.bincount(at, minlength=seats.room[row]) == size).all() and (size > 0).sum() == seats.tables[row]


def bucket_of_texts(texts, sweeps=3):
    token, context, _ = hpylm.tokens_of([t.encode() for t in texts])
    keys, counts = np.unique(hpylm.key_of(token, context), return_counts=True)
    settings = hpylm.Settings([0.5, 0.6, 0.7], [1.0, 1.0, 1.0], 1 / (len(np.unique(token)) + 1), sweeps, 1)
    blob = hpylm.pack(hpylm._steps(keys), counts)
    while len(settings.history) <= sweeps:
        b = hpylm.Bucket(0, blob, settings)
        for _ in b.states(len(settings.history)):
            pass
        n = [1 << hpylm._bits(level) for level in range(3)]
        settings.history.append(hpylm.Totals(
            [np.bincount(b.place[x], weights=b.levels[x].customers, minlength=n[x]) for x in range(3)],
            [np.bincount(b.place[x], weights=b.levels[x].tables, minlength=n[x]) for x in range(3)]))
    return blob, settings


TEXTS = ["the cat sat on the mat the cat ran", "a dog sat on a log a dog ran far", "the dog and the cat sat", "a a a a a b"] * 5


def test_seating_stays_sound_and_tables_are_customers_above():
    blob, settings = bucket_of_texts(TEXTS)
    b = hpylm.Bucket(0, blob, settings)
    for _ in b.states(3):
        for seats in b.levels:
            seats_are_sound(seats)
        assert (b.levels[2].customers == b.counts).all()
    for level in (0, 1):
        assert (b.levels[level].customers == b._tables_below(level)).all()


def test_probabilities_sum_to_one():
    """Over the vocabulary and one unknown word, in every context."""
    blob, settings = bucket_of_texts(TEXTS)
    scorer = hpylm.Scorer(hpylm.Bucket(0, blob, settings), settings)
    roots = np.concatenate([scorer.bucket.keys[0], [np.uint64(1 << 62)]])
    for context in [*np.unique(scorer.bucket.keys[2] & hpylm._LOW)[:12].tolist(), 5]:
        log, _ = scorer.log10(np.sort(roots) | np.uint64(context))
        assert math.isclose((10 ** log).sum(), 1, rel_tol=1e-9)


def test_seating_against_exact_chances():
    """One restaurant of three customers: Gibbs visits numbers of tables as the process asks."""
    d, weight, rng, seen = 0.5, 0.8, np.random.default_rng(3), Counter()
    rows = 4000
    seats = hpylm.Seating(np.full(rows, 3))
    seats.start(np.full(rows, 3), d)
    every = np.arange(rows)
    for step in range(30):
        seats.leave(every, rng)
        seats.enter(every, np.full(rows, weight), d, rng)
        if step >= 10:
            seen.update(seats.tables.tolist())
    seats_are_sound(seats)
    # Weight of a seating: weight per table, and (1 - d)(2 - d)... within a table.
    exact = {1: weight * (1 - d) * (2 - d), 2: 3 * weight ** 2 * (1 - d), 3: weight ** 3}
    for t, w in exact.items():
        assert abs(seen[t] / sum(seen.values()) - w / sum(exact.values())) < 0.02


def exact_moments(n, weight, d):
    """Mean and variance of the number of tables, by the recursion over customers."""
    w = np.zeros(n + 2)
    w[0], t = 1.0, np.arange(n + 2)
    for c in range(n):
        w = np.concatenate([[0], w[:-1] * weight]) + np.maximum(c - d * t, 0) * (t <= c) * w
        w /= w.sum()
    mean = (w * t).sum()
    return mean, (w * (t - mean) ** 2).sum()


@pytest.mark.parametrize("d", [0.5, 0.6, 0.7])
def test_tables_of_many_customers_against_exact_chances(d):
    rng = np.random.default_rng(1)
    for n in (2, 40, 200, 300, 3000):
        for weight in (1e-6, 0.01, 0.7, 9.0, 60.0, 800.0):
            mean, variance = exact_moments(n, weight, d)
            if n > hpylm.TABLED:
                got = hpylm.table_moments(np.array([n]), np.array([weight]), d)
                assert math.isclose(got[0][0], mean, rel_tol=1e-6)
                assert math.isclose(got[1][0], variance, rel_tol=1e-4, abs_tol=1e-8)
            drawn = hpylm.draw_tables(np.full(4000, n), np.full(4000, weight), d, rng)
            assert drawn.min() >= 1 and drawn.max() <= n
            assert abs(drawn.mean() - mean) < 5 * math.sqrt(variance / 4000) + 1e-3
            assert variance < 0.1 or 0.85 < drawn.var() / variance < 1.15


def test_every_customer_is_reseated():
    """All start at one table that nobody chooses again: after a sweep, no table is old."""
    seats = hpylm.Seating(np.array([5, 1, 64, 30]))
    seats.start(np.array([5, 1, 64, 30]), 1e-9)
    assert seats.tables.tolist() == [1, 1, 1, 1]
    seats.sweep(np.full(4, 1e15), 0.5, np.random.default_rng(2))
    seats_are_sound(seats)
    assert seats.tables.tolist() == [5, 1, 64, 30]


def test_a_row_does_not_grow_with_its_customers():
    for c in (10 ** 5, 10 ** 10):
        seats = hpylm.Seating(np.array([c, 3]))
        seats.start(np.array([c, 3]), 0.7)
        started = seats.tables[0]
        seats.sweep(np.array([50.0, 1.0]), 0.7, np.random.default_rng(3))
        assert len(seats.at) == 3 and 30 < seats.tables[0] < 130 and seats.tables[0] != started


def test_every_word_is_a_context_of_its_own():
    texts = [f"w{i:x}q z" for i in range(20_000)]
    _, context, _ = hpylm.tokens_of([t.encode() for t in texts])
    assert len(np.unique(context)) == 20_002  # with the start and z


def rows_of_pairs(spark):
    """Texts in which each of 300 words, all of one ending, is followed by a few words of its own."""
    rng = np.random.default_rng(5)
    rows = [(n, " ".join(f"a{i}ng b{(7 * i + rng.integers(3)) % 101}ed" for i in rng.integers(0, 300, 40)))
            for n in range(200)]
    return spark.createDataFrame([*rows, (200, None), (201, "new a1ng new A1NG a1ng")], "doc_id long, text string")


def pairs_of(text):
    found = words(text)
    return list(zip(["start", *found[:-1]], found, strict=True))


def test_scores_of_the_first_state_against_plain_sums_over_real_contexts(spark):
    docs = rows_of_pairs(spark)
    held = crc_mod(F.col("doc_id"), 7) == 2
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.score for r in hpylm.score(docs, held, sweeps=0, bucket_tokens=500).collect()}

    def parent(context):
        if context == "start":
            return hpylm.START >> 58
        return int(hpylm.tokens_of([context])[1][1]) >> 58

    learned = Counter(p for i, t in rows.items() if zlib.crc32(str(i).encode()) % 7 != 2 for p in pairs_of(t))
    levels, customers = [], {(b, parent(b), w): n for (b, w), n in learned.items()}
    for d, up in ((0.7, 1), (0.6, 2), (0.5, 3)):
        tables = {k: 1 if n == 1 else min(max(round(n ** d / 2), 1), n) for k, n in customers.items()}
        totals = Counter(), Counter()
        for k, n in customers.items():
            totals[0][k[:-1]] += n
            totals[1][k[:-1]] += tables[k]
        levels.append((d, customers, tables, *totals))
        customers = Counter()
        for k, t in tables.items():
            customers[k[1:]] += t
    vocabulary = len({w for _, w in learned})

    def chance(b, w):
        p, key = 1 / (vocabulary + 1), (b, parent(b), w)
        for cut, (d, c, t, all_c, all_t) in zip((2, 1, 0), levels[::-1], strict=True):
            k = key[cut:]
            p = (c.get(k, 0) - d * t.get(k, 0) + (1 + d * all_t[k[:-1]]) * p) / (1 + all_c[k[:-1]])
        return p

    for i, text in rows.items():
        assert math.isclose(got[i], sum(math.log10(chance(b, w)) for b, w in pairs_of(text)), rel_tol=1e-9)


def test_totals_of_real_contexts_over_all_buckets(spark):
    """After sweeps: customers are the followers, tables those of the buckets' states, chances sum to one."""
    hub = " ".join(f"hub a{i}ng hub b{i}ed" for i in range(300))  # before every word, so it meets all buckets
    more = spark.createDataFrame([(204, hub + " hub z z hub new hub hub")], "doc_id long, text string")
    docs, buckets = rows_of_pairs(spark).union(more).withColumn("held_out", F.col("doc_id") % 5 == 0), 9
    scratch = hpylm.Scratch(spark, "hpylm-test")
    counts = hpylm.training_counts(docs, buckets, scratch)
    n_words = counts.agg(F.sum("words")).first()[0]
    settings = hpylm.Settings([0.5, 0.6, 0.7], [1.0, 1.0, 1.0], 1 / (n_words + 1), 3, 1)
    sent = [r.asDict() for df in hpylm.learn(counts, settings, buckets, scratch) for r in df.collect()]
    scorers = [hpylm._scorer(r.bucket, [{"blob": r.counts, "asks": None}, *(x for x in sent if x["bucket"] == r.bucket)], settings, buckets)
               for r in counts.collect()]
    assert len(scorers) == buckets
    followers = Counter(p[0] for r in docs.where(~F.col("held_out")).collect() for p in pairs_of(r.text))
    for word in ("a1ng", "a77ng", "b3ed", "hub", "start"):
        context = hpylm.START if word == "start" else int(hpylm.tokens_of([word.encode()])[1][1])
        tables, total, seen = [0, 0], 0.0, 0
        for s in scorers:
            at = np.flatnonzero(s.bucket.own_contexts == np.uint64(context))
            if not len(at):
                continue
            assert {t.customers[2][at[0]] for t, _, _ in s.kept} == {followers[word.encode()] if word != "start" else followers[word]}
            mine = s.bucket.place[2] == at[0]
            for k, (_, _, t) in enumerate(s.kept):
                tables[k] += t[2][mine].sum()
            given = [t.tables[2][at[0]] for t, _, _ in s.kept]
            known = s.bucket.keys[0] | s.bucket.contexts[at[0]]
            total += (10 ** s.log10(known)[0]).sum()
            unknown = 10 ** s.log10(np.array([1 << 62], np.uint64) | s.bucket.contexts[at[0]])[0][0]
            seen += len(known)
        assert tables == given
        assert word != "hub" or seen == n_words and math.isclose(total + unknown, 1, rel_tol=1e-9)


def test_real_contexts_tell_words_apart_that_end_alike(spark):
    """Held-out pairs seen in training are likelier than pairs of a word with another word's followers."""
    rows = [(n, " ".join(f"a{i}ng b{7 * i}ed" for i in range(n % 2, 3000, 2))) for n in range(6)]
    rows += [(10, " ".join(f"a{i}ng b{7 * i}ed" for i in range(0, 3000, 100))),
             (11, " ".join(f"a{i}ng b{7 * (i + 2) % 21000}ed" for i in range(0, 3000, 100)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in hpylm.score(docs, F.col("doc_id") >= 10).collect()}
    assert got[10] - got[11] > 30 * 1.5


class Caught:
    """Stands for a DataFrame: hands out the function that Spark's tasks would run."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        return run


def test_a_block_of_tokens_is_dealt_in_bounded_memory():
    """The block is freed before its keys are sorted: beside its own 16 bytes a token, less than 20 are taken."""
    rng, n = np.random.default_rng(6), 1_000_000
    plain = rng.integers(0, 5000, n).astype(np.uint64), rng.integers(0, 300, n).astype(np.uint64)
    list(hpylm._dealt([x[:9] for x in plain], 3))  # what pyarrow imports at its first call is not counted
    tracemalloc.start()
    try:
        block = [x << np.uint64(40) for x in plain]
        tracemalloc.reset_peak()
        held = tracemalloc.get_traced_memory()[0]
        first = next(dealt := hpylm._dealt(block, 3))
        more = tracemalloc.get_traced_memory()[1] - held
    finally:
        tracemalloc.stop()
    dealt = [first, *dealt]
    assert block == [] and sum(int(x[2].sum()) for x in dealt) == n
    for _, keys, counts, at, words, contexts in dealt:
        first = counts.cumsum() - counts
        assert ((words >> np.uint64(40))[(keys >> np.uint64(32)).astype(int)] == plain[0][at[first]]).all()
        assert ((contexts >> np.uint64(40))[(keys & hpylm._PLACE).astype(int)] == plain[1][at[first]]).all()
    assert more < 20 * n


def test_a_bucket_is_freed_before_the_next_is_seated(monkeypatch):
    blob, settings = bucket_of_texts(TEXTS, sweeps=0)
    step, counts = hpylm.unpack(blob)
    leaf = hpylm._sums(step)
    contexts = np.unique(leaf & hpylm._LOW)
    keys = leaf & ~hpylm._LOW | hpylm.numbers(contexts << np.uint64(32))[np.searchsorted(contexts, leaf & hpylm._LOW)]
    blob = hpylm.pack(hpylm._steps(keys), counts, hpylm._steps(np.unique(keys >> np.uint64(32))), hpylm._steps(contexts << np.uint64(32)))
    seen = []

    class Watched(hpylm.Bucket):
        def __init__(self, *args):
            assert all(b() is None for b in seen)
            super().__init__(*args)
            seen.append(weakref.ref(self))

    monkeypatch.setattr(hpylm, "Bucket", Watched)
    run = hpylm._started(Caught(), settings, 2)
    shares = list(run(iter([pa.RecordBatch.from_pydict({"bucket": [0, 1, 2], "counts": [blob] * 3})])))
    assert len(seen) == 3 and len(shares) % 3 == 0


def test_freed_memory_goes_back_to_the_system():
    def resident():
        return int(next(x for x in Path("/proc/self/status").read_text().split("\n") if x.startswith("VmRSS")).split()[1]) / 1024

    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("not glibc")
    small = [bytes(50_000) for _ in range(4000)]  # 200 MB in pieces that an allocator keeps
    keep = small[::100]
    held = resident()
    del small
    give_back()
    assert held - resident() > 100 and len(keep) == 40
