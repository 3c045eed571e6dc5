"""Repeated passages by seed and extend.

Seeds.  Every window of ``min_words`` words has one anchor: its k-gram of least hash (the
rightmost of equals), which depends on the window's words alone, so equal windows have equal
anchors at the same place.  Winnowing makes one anchor serve a run of neighbouring windows; the
words which those windows cover, from the first window's start to the last one's end, are the
anchor's context.  Documents are joined on anchors that occur more than once.

Extension.  Occurrences of an anchor fall into classes of equal context.  A class of two or more
extends both ways over its whole context: all its windows repeat.  Where an anchor has several
classes and one of them stands alone, a match ends inside the context; then one member of each
class is laid open into its windows, and those in two classes repeat.  Adjoining repeated windows
unite into maximal repeats, each of at least ``min_words`` words.

No pair of occurrences is ever formed: classes and windows are counted with map-side combining,
so a passage shared by a third of all documents costs one row for each occurrence.  Anchors,
contexts and windows are compared by 64-bit hashes, always together with the anchor's own.

Defined results: a null text has no words; a row is known by its ``doc_id`` and text, so repeated
rows are occurrences of each other; texts under ``min_words`` words repeat nothing; very long texts
are cut whole; no rows give no rows; columns beside those named are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, Scratch, mix, rows_of, small_batches

ANCHOR_WORDS = 8
# Odd bases of the two independent rolling hashes.
ANCHOR_BASE, CONTEXT_BASE = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03


class Windows:
    """Anchors, contexts and windows of one word sequence."""

    def __init__(self, min_words: int, anchor_words: int = ANCHOR_WORDS):
        self.size, self.k = min_words, min(anchor_words, min_words)
        self.by_anchor, self.by_context = Rolling(ANCHOR_BASE), Rolling(CONTEXT_BASE)

    @staticmethod
    def symbols(words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))

    def anchors(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        """Anchor hash, context hash, first and last window start of each anchor occurrence."""
        symbols = self.symbols(words)
        first_gram = np.arange(len(words) - self.k + 1)
        grams = self.by_anchor.runs(self.by_anchor.prefix(symbols), first_gram, first_gram + self.k)
        span = self.size - self.k + 1
        views = np.lib.stride_tricks.sliding_window_view(grams, span)
        place = np.arange(len(views)) + span - 1 - views[:, ::-1].argmin(axis=1)
        new = np.flatnonzero(np.diff(place)) + 1
        low = np.concatenate([[0], new])
        high = np.concatenate([new - 1, [len(place) - 1]])
        at = place[low]
        context = self.by_context.runs(self.by_context.prefix(symbols), low, high + self.size)
        shape = (high - low).astype(np.uint64) << np.uint64(32) | (at - low).astype(np.uint64)
        return grams[at], mix(context ^ mix(shape)), low, high

    def hashes(self, words: list[bytes], starts: np.ndarray) -> np.ndarray:
        prefix = self.by_context.prefix(self.symbols(words))
        return self.by_context.runs(prefix, starts, starts + self.size)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _anchor_rows(docs: DataFrame, size: int) -> DataFrame:
    """``anchor, context, row, span``; span holds the first and last window start."""
    names = ["anchor", "context", "row", "span"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(size)
        for batch, raws in rows_of(batches):
            parts = []
            for row, text in zip(batch.column("row").to_pylist(), raws, strict=True):
                words = text.split()
                if len(words) >= size:
                    anchor, context, low, high = windows.anchors(words)
                    parts.append((anchor, context, np.full(len(low), row, np.int64), low << 32 | high))
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [_signed(np.concatenate(c)) for c in zip(*parts, strict=True)], names)

    return docs.mapInArrow(run, "anchor long, context long, row long, span long")


def _packed(docs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Texts compressed before they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch, raws in rows_of(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(map(pack, raws), pa.binary()),
                 *map(batch.column, carried)], ["row", "doc_id", "packed", *carried])

    return docs.mapInArrow(run, "row long, doc_id long, packed binary" + _types(docs, carried))


def _types(docs: DataFrame, carried: tuple[str, ...]) -> str:
    return "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)


def _open(probes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """``anchor, window, row, start`` of every window of the probed occurrences."""
    names = ["anchor", "window", "row", "start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, unpack = Windows(size), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row, packed, probe in zip(*(batch.column(c).to_pylist() for c in ("row", "packed", "probe")),
                                          strict=True):
                anchor = np.array([p["anchor"] for p in probe], np.int64)
                span = np.array([p["span"] for p in probe], np.int64)
                low, n = span >> 32, (span & 0xFFFFFFFF) - (span >> 32) + 1
                starts = np.repeat(low - np.concatenate([[0], n.cumsum()[:-1]]), n) + np.arange(n.sum())
                found = windows.hashes(unpack(packed).split(), starts)
                yield pa.RecordBatch.from_arrays(
                    [_signed(x) for x in (np.repeat(anchor, n), found, np.full(len(starts), row), starts)], names)

    lists = probes.groupBy("row").agg(F.collect_list(F.struct("anchor", "span")).alias("probe"))
    return (_packed(docs).join(lists.hint("shuffle_hash"), "row").select("row", "packed", "probe")
            .mapInArrow(run, "anchor long, window long, row long, start long"))


def repeats(docs: DataFrame, min_words: int = 35, scratch: Scratch | None = None) -> DataFrame:
    """``row, low, high``: word ranges [low, high) covered by repeated windows of a row's text.

    ``docs`` has ``row, doc_id, text``.  Ranges of a row may overlap; their union is its maximal
    repeats.
    """
    scratch = scratch or Scratch(docs.sparkSession, "substring")
    small_batches(docs.sparkSession)
    found = scratch.table("anchors", _anchor_rows(docs, min_words))
    # Counts are written before they are joined: Spark then splits a hot anchor's occurrences.
    often = scratch.table("often", found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
                          .where("n > 1").select("anchor"))
    seeds = scratch.table("seeds", found.join(often, "anchor", "left_semi"))
    scratch.drop("anchors", "often")
    classes = scratch.table("classes", seeds.groupBy("anchor", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "span")).alias("one")))
    whole = (seeds.join(classes.where("n > 1"), ["anchor", "context"], "left_semi")
             .select("row", F.shiftright("span", 32).alias("low"),
                     (F.col("span").bitwiseAND(0xFFFFFFFF) + min_words).alias("high")))
    ending = scratch.table("ending", classes.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("classes"), F.min("n").alias("least"))
        .where("classes > 1 and least = 1").select("anchor"))
    probes = classes.join(ending, "anchor", "left_semi").select("anchor", "one.row", "one.span")
    windows = scratch.table("windows", _open(probes, docs, min_words))
    shared = scratch.table("shared", windows.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("n"))
                           .where("n > 1").select("anchor", "window"))
    partial = (windows.join(shared, ["anchor", "window"], "left_semi")
               .select("row", F.col("start").alias("low"), (F.col("start") + min_words).alias("high")))
    return whole.union(partial)


def _cut(docs: DataFrame, ranges: DataFrame, carried: tuple[str, ...]) -> DataFrame:
    names = ["doc_id", "n_words", "n_removed", "kept", *carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            total, removed, kept = [], [], []
            for packed, spans in zip(batch.column("packed").to_pylist(), batch.column("spans"), strict=True):
                words = unpack(packed).split()
                total.append(len(words))
                if spans.is_valid:
                    span = spans.values.to_numpy(zero_copy_only=False)
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, span >> 32, 1)
                    np.add.at(edge, span & 0xFFFFFFFF, -1)
                    stay = np.flatnonzero(edge.cumsum()[:-1] == 0).tolist()
                    words = [words[i] for i in stay]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string()), *map(batch.column, carried)], names)

    lists = ranges.groupBy("row").agg(
        F.collect_list(F.shiftleft("low", 32).bitwiseOR(F.col("high"))).alias("spans"))
    return (_packed(docs, carried).join(lists.hint("shuffle_hash"), "row", "left")
            .select("doc_id", "packed", "spans", *carried)
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string" + _types(docs, carried)))


def remove_repeats(docs: DataFrame, min_words: int = 35, id_col: str = "doc_id",
                   text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the words outside all repeats, joined by one space.

    ``keep`` names further columns of ``docs`` that are carried through.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *keep)
    rows = rows.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text", *keep)
    return _cut(rows, repeats(rows.select("row", "doc_id", "text"), min_words), keep)


