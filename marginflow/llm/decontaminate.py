"""Benchmark decontamination: rare seeds join documents to items, then Smith-Waterman alignment.

Similarity.  A document and an item are compared by local alignment on words (match 2, mismatch -1,
gap -1).  The similarity is the best score over that of the item aligned with itself; a document
leaks an item from ``min_similarity`` on.

Seeds.  Which pairs are aligned follows from ``min_similarity`` alone, never from how frequent a
passage is.  An alignment of m matches and e other columns scores 2m - e and has at most e + 1 runs
of matches.  So a score of s, with an item of L >= m words, asks for at least s - L - 1 pairs of
neighbouring words that the document shares, within 3L - s words of the document.  Where that asks
for no pair (items of five words, or a low ``min_similarity``), single words are the seeds, and at
least s / 2 of them match.

Rarity.  Of an item's q seeds at least ``need`` match, so at most q - need don't: among its rarest
q - need + 1 seeds, by their number in all documents, one matches at least.  Only these rare seeds join
documents to items.  That is a prefix filter: it is exact, and common words join nothing.

Work.  One scan of the documents looks up which of their seeds any item has, in a bitmap of fixed size
(a false hit joins nothing).  These hits are counted, and joined to the rare seeds; documents with a
candidate get their items' words by a join, and are aligned many pairs side by side.  No task holds the
benchmark.  Hits, rare seeds and candidates are written, so that Spark splits the partition of a seed,
item or document that holds a large share of the rows; a row has the candidate items of one document.

Words are lower-cased runs of letters, digits and non-ASCII characters.  Defined results: items
shorter than ``n`` words never match; null or empty texts match nothing; repeated rows give one
result row for each document and item; no items give an empty result; very long texts are searched
whole; columns beside those named are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, mix, small_batches, texts

BITS = 1 << 26  # of the bitmap of the items' seeds: 8 MB for a task, whatever the benchmark's size
BUCKET = 1 << 15  # of these are one row of Spark's bitmap aggregate
SEEDS_AT_ONCE, CELLS_AT_ONCE = 2_000_000, 1_000_000  # they bound a worker's memory
_KEEP = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_KEEP).split()


def needed(size: np.ndarray, min_similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of items of ``size`` words: how many seeds a leak matches at least, within how many words of the
    document, and how many words a seed has."""
    score = np.maximum(1, np.ceil(2 * size * min_similarity - 1e-6)).astype(np.int64)
    pairs = score - size - 1
    return np.where(pairs > 0, pairs, (score + 1) // 2), 3 * size - score, np.where(pairs > 0, 2, 1)


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers start[i], ..., start[i] + n[i] - 1 of every i."""
    return np.repeat(start - (n.cumsum() - n), n) + np.arange(n.sum())


class Items:
    """Distinct items: their words as numbers, the least score of a leak, and their seeds.

    ``need[i]`` seeds of item i within ``reach[i]`` words are what a leak can't do without.
    """

    def __init__(self, found: dict[tuple[bytes, ...], list[int]], min_similarity: float):
        self.words, self.ids = list(found), list(found.values())
        self.code: dict[bytes, int] = {}
        self.symbols = [np.array([self.code.setdefault(w, len(self.code)) for w in x], np.int64) for x in self.words]
        size = np.array([len(x) for x in self.words], np.int64)
        self.need, self.reach, widths = needed(size, min_similarity)
        self.seeds = {}
        for width in (1, 2):
            chosen = np.flatnonzero(widths == width)
            if len(chosen):
                keys = [np.unique(self._keys(self.symbols[i], width)) for i in chosen]
                item = np.repeat(chosen, [len(k) for k in keys])
                key = np.concatenate(keys)
                order = np.argsort(key, kind="stable")
                unique, start, count = np.unique(key[order], return_index=True, return_counts=True)
                self.seeds[width] = unique, start, count, item[order]

    def _keys(self, symbols: np.ndarray, width: int) -> np.ndarray:
        return symbols if width == 1 else symbols[:-1] * len(self.code) + symbols[1:]

    def regions(self, symbols: np.ndarray, which: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Over documents laid end to end (``which`` is the document of each word): item, low and
        high of the regions that every alignment from the least score on lies in."""
        for width, (keys, start, count, items) in self.seeds.items():
            known = symbols >= 0
            if width == 2:
                known = known[:-1] & known[1:] & (which[:-1] == which[1:])
            at = np.flatnonzero(known)
            key = symbols[at] if width == 1 else symbols[at] * len(self.code) + symbols[at + 1]
            spot = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            at, spot = at[keys[spot] == key], spot[keys[spot] == key]
            # Documents are taken so many at once that their seeds have a bound.
            before = np.append(0, count[spot].cumsum())
            cuts, last = [0], np.flatnonzero(np.diff(which[at], append=-1)) + 1
            for stop, following in zip(last.tolist(), [*last[1:].tolist(), None][:len(last)], strict=True):
                if following is None or before[following] - before[cuts[-1]] > SEEDS_AT_ONCE:
                    cuts.append(stop)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                n = count[spot[a:b]]
                placed = items[_ranges(start[spot[a:b]], n)] * len(symbols) + np.repeat(at[a:b], n)
                placed.sort()
                yield self._near(placed // len(symbols), placed % len(symbols), which, width)

    def _near(self, item: np.ndarray, at: np.ndarray, which: np.ndarray,
              width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Regions around enough seeds of one item near each other; ``at`` ascends within an item."""
        first = np.arange(len(item))
        last = first + self.need[item] - 1
        first = first[last < len(item)]
        last = last[first]
        near = ((item[first] == item[last]) & (which[at[first]] == which[at[last]])
                & (at[last] + width - at[first] <= self.reach[item[first]]))
        first, last = first[near], last[near]
        item, doc = item[first], which[at[first]]
        low = np.maximum(at[last] + width - self.reach[item], np.searchsorted(which, doc))
        high = np.minimum(at[first] + self.reach[item], np.searchsorted(which, doc, "right"))
        new = np.ones(len(item), bool)
        new[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (low[1:] > high[:-1])
        return item[new], low[new], high[np.append(new[1:], True)[:len(new)]]


def smith_waterman(a: np.ndarray, b: np.ndarray, match: int = 2, mismatch: int = -1,
                   gap: int = 1) -> tuple[int, int, int]:
    """Best local score of two symbol sequences, and where its alignment ends in each."""
    best, ends = 0, (0, 0)
    row = np.zeros(len(b) + 1, np.int64)
    slope = gap * np.arange(len(b) + 1)
    for i, symbol in enumerate(a):
        step = np.zeros(len(b) + 1, np.int64)
        np.maximum(row[:-1] + np.where(b == symbol, match, mismatch), row[1:] - gap, out=step[1:])
        np.maximum(step, 0, out=step)
        row = np.maximum.accumulate(step + slope) - slope  # gaps along b
        top = int(row.argmax())
        if row[top] > best:
            best, ends = int(row[top]), (i + 1, top)
    return best, *ends


def align(item: list, passage: list) -> tuple[float, int, int]:
    """Similarity of an item and a passage, and the words [low, high) of the passage aligned."""
    code: dict = {}
    a = np.array([code.setdefault(w, len(code)) for w in item], np.int64)
    b = np.array([code.setdefault(w, len(code)) for w in passage], np.int64)
    score, i, j = smith_waterman(a, b)
    if not score:
        return 0.0, 0, 0
    _, _, back = smith_waterman(a[:i][::-1], b[:j][::-1])
    return score / (2 * len(a)), j - back, j


def best_scores(items: list[np.ndarray], passages: list[np.ndarray]) -> np.ndarray:
    """Best local score of each item and passage (numbered words, negative where no item has the
    word), for many pairs side by side."""
    out = np.zeros(len(items), np.int64)
    order = sorted(range(len(items)), key=lambda k: len(passages[k]))
    while order:
        longest = len(passages[order[-1]]) + 1
        n = max(1, CELLS_AT_ONCE // longest)
        group, order = order[-n:], order[:-n]
        tallest = max(len(items[k]) for k in group)
        # A cell holds a score, at most 2 for each word of the shorter side, plus the slope of its column.
        kind = np.int16 if 2 * min(tallest, longest) + longest < 1 << 15 else np.int32
        a = np.full((tallest, len(group)), -2, np.int32)
        b = np.full((longest - 1, len(group)), -1, np.int32)
        for column, k in enumerate(group):
            a[:len(items[k]), column] = items[k]
            b[:len(passages[k]), column] = passages[k]
        slope = np.arange(longest, dtype=kind)[:, None]
        row, best = np.zeros((longest, len(group)), kind), np.zeros(len(group), kind)
        for symbols in a:
            step = np.zeros_like(row)
            np.multiply(b == symbols, 3, out=step[1:], dtype=kind, casting="unsafe")
            step[1:] += row[:-1] - kind(1)
            np.maximum(step[1:], row[1:] - kind(1), out=step[1:])
            np.maximum(step, 0, out=step)
            step += slope
            np.maximum.accumulate(step, axis=0, out=step)  # gaps along the passage
            step -= slope
            row = step
            np.maximum(best, row.max(axis=0), out=best)
        out[group] = best
    return out


def _seed_keys(lists: list[list[bytes]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (64-bit hashes) of the seeds of texts laid end to end, and the text of each."""
    sizes = np.array([len(x) for x in lists], np.int64)
    code = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(lists)), np.uint64, int(sizes.sum()))
    which = np.repeat(np.arange(len(lists)), sizes)
    if width == 1:
        return mix(code).view(np.int64), which
    together = which[:-1] == which[1:]
    keys = mix(code[:-1] * np.uint64(0x9E3779B97F4A7C15) + code[1:])
    return keys[together].view(np.int64), which[:-1][together]


def _times(key: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, key) and how often each occurs."""
    order = np.lexsort((key, which))
    key, which = key[order], which[order]
    new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (which[1:] != which[:-1]))) if len(key) else np.zeros(0, np.int64)
    return which[new], key[new], np.diff(np.append(new, len(key)))


def _normal(items: DataFrame, least: int) -> DataFrame:
    """``item_id, words`` (joined by blanks) of items of at least ``least`` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [words_of(t) for t in batch.column("text").to_pylist()]
            keep = np.array([len(x) >= least for x in lists], bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").filter(pa.array(keep)),
                 pa.array([b" ".join(x) for x in lists if len(x) >= least], pa.binary())], ["item_id", "words"])

    return items.mapInArrow(run, "item_id long, words binary")


def _seeds(items: DataFrame, min_similarity: float) -> DataFrame:
    """``item, key, times, prefix``: an item's seeds, and how many of its occurrences are to be rare ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [x.split() for x in batch.column("words").to_pylist()]
            size = np.array([len(x) for x in lists], np.int64)
            need, _, widths = needed(size, min_similarity)
            prefix = size - widths + 1 - need + 1
            for width in (1, 2):
                chosen = np.flatnonzero(widths == width)
                if len(chosen):
                    which, key, times = _times(*_seed_keys([lists[i] for i in chosen], width))
                    own = chosen[which]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("item").take(pa.array(own)), pa.array(key), pa.array(times, pa.int64()),
                         pa.array(prefix[own]), pa.array(np.full(len(own), width), pa.int32())],
                        ["item", "key", "times", "prefix", "width"])

    return items.mapInArrow(run, "item long, key long, times long, prefix long, width int")


def _bitmap(seeds: DataFrame) -> bytes:
    """Which of ``BITS`` cells the seeds' keys fall into; at most that many bits reach the driver."""
    cell = F.pmod("key", F.lit(BITS)) + 1  # counted from 1
    rows = seeds.select(cell.alias("cell")).groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")).collect()
    out = np.zeros(max(BITS, BUCKET) // 8, np.uint8)
    for r in rows:
        at = (r.bucket - 1) * BUCKET // 8
        out[at:at + BUCKET // 8] = np.frombuffer(r.bits, np.uint8)[:len(out) - at]
    return out.tobytes()


def _hits(docs: DataFrame, bitmap: bytes, widths: list[int]) -> DataFrame:
    """``row, key, times``: seeds of documents that an item may have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, np.uint8)
        for batch in batches:
            lists = [words_of(t) for t in batch.column("text").to_pylist()]
            for width in widths:
                key, which = _seed_keys(lists, width)
                cell = key.view(np.uint64) % np.uint64(BITS)  # BITS divides 2**64: as pmod of the signed key
                found = (bits[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
                which, key, times = _times(key[found], which[found])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(pa.array(which)), pa.array(key), pa.array(times, pa.int64())], ["row", "key", "times"])

    return docs.mapInArrow(run, "row long, key long, times long")


def _rare(seeds: DataFrame, hits: DataFrame) -> DataFrame:
    """``key, item``: of each item, its rarest seeds by their number in all documents, as many as a leak
    can't do without one of."""
    number = hits.groupBy("key").agg(F.sum("times").alias("n"))
    # A window holds the seeds of one item, at most as many as it has words.
    before = F.sum("times").over(W.partitionBy("item").orderBy(F.coalesce("n", F.lit(0)), "key")
                                 .rowsBetween(W.unboundedPreceding, -1))
    ranked = seeds.join(number, "key", "left").withColumn("before", F.coalesce(before, F.lit(0)))
    return ranked.where(F.col("before") < F.col("prefix")).select("key", "item")


def _aligned(docs: DataFrame, min_similarity: float) -> DataFrame:
    """The alignments of documents (``doc_id, text, items``) that reach ``min_similarity``, region by region."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[bytes, ...], list[int]] = {}
            for x in batch.column("items").to_pylist():
                for item in x:
                    found.setdefault(tuple(item["words"].split()), [item["item"]])
            items = Items(found, min_similarity)
            lists = [words_of(t) for t in batch.column("text").to_pylist()]
            sizes = np.array([len(x) for x in lists], np.int64)
            symbols = np.fromiter((items.code.get(w, -1) for x in lists for w in x), np.int64, int(sizes.sum()))
            which, begin = np.repeat(np.arange(len(lists)), sizes), sizes.cumsum() - sizes
            rows = []
            for item, low, high in items.regions(symbols, which):
                places = list(zip(item.tolist(), low.tolist(), high.tolist(), strict=True))
                for at in range(0, len(places), 10_000):
                    some = places[at:at + 10_000]
                    scores = best_scores([items.symbols[i] for i, _, _ in some], [symbols[a:b] for _, a, b in some])
                    for (i, a, b), score in zip(some, scores.tolist(), strict=True):
                        if score / (2 * len(items.words[i])) >= min_similarity:
                            doc = int(which[a])
                            a, b = a - int(begin[doc]), b - int(begin[doc])
                            similarity, first, stop = align(list(items.words[i]), lists[doc][a:b])
                            rows += [(doc, k, similarity, a + first, a + stop - 1) for k in items.ids[i]]
            if rows:
                doc, item, similarity, first, last = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(doc)), pa.array(item, pa.int64()),
                     pa.array(similarity, pa.float64()), pa.array(first, pa.int64()), pa.array(last, pa.int64())],
                    ["doc_id", "item", "similarity", "first_word", "last_word"])

    return docs.mapInArrow(run, "doc_id long, item long, similarity double, first_word long, last_word long")


def leaks(docs: DataFrame, items: DataFrame, n: int = 5, min_similarity: float = 0.6,
          id_col: str = "doc_id", text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, similarity, first_word, last_word``: the best alignment of each item in
    each document that leaks it."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    small_batches(docs.sparkSession)
    wanted = (items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
              .where("item_id is not null and text is not null").distinct())
    named = scratch.table("named", _normal(wanted, max(1, n)))  # equal texts under many ids are one item
    each = scratch.table("items", named.select("words").distinct().select(F.monotonically_increasing_id().alias("item"), "words"))
    seeds = scratch.table("seeds", _seeds(each, min_similarity))
    widths = [r.width for r in seeds.select("width").distinct().collect()]  # 1, 2 or both

    rows = texts(docs, id_col, text_col).where("text is not null").withColumn("row", F.xxhash64("doc_id", "text"))
    hits = scratch.table("hits", _hits(rows.select("row", "text"), _bitmap(seeds), widths))
    rare = scratch.table("rare", _rare(seeds, hits))
    pairs = scratch.table("pairs", hits.join(rare, "key").select("row", "item").distinct())
    candidates = scratch.table("candidates", pairs.join(each, "item").groupBy("row").agg(
        F.collect_list(F.struct("item", "words")).alias("items")))
    found = scratch.table("found", _aligned(rows.join(candidates, "row").select("doc_id", "text", "items"), min_similarity))
    best = found.join(each, "item").join(named, "words")
    top = F.max_by(F.struct("first_word", "last_word"), F.struct("similarity", -F.col("first_word"))).alias("at")
    return (best.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"), top)
            .select("doc_id", "item_id", "similarity", "at.first_word", "at.last_word"))


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that leak an item; rows with a null ``doc_id`` stay."""
    return docs.join(leaks(docs, items, **options).select("doc_id").distinct(), "doc_id", "left_anti")
