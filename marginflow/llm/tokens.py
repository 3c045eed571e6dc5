"""Token ids as Parquet files for training.

A file holds documents in ascending ``doc_id`` order: ``doc_id, part, at, n_tokens, ids``, where
``ids`` is a list column and ``at`` counts the tokens of the same part before the document.  Files
have row groups and pages of stated size, dictionary or delta encoded lists and page indexes, so a
reader of some documents or of the metadata alone leaves the other pages unread.

Texts are dealt to parts by ranges of ``doc_id`` and, within one, of how a text begins.  A part's tokens are counted while it is
written; the start of a document among all tokens is ``at`` plus the totals of the parts before,
one row a part.

Texts are encoded by the tokenizers library.  White space divides a text into stretches that are
encoded alone with the same result, as do the ASCII symbols after a word.  Each distinct stretch of a
batch is looked up once, and ids are laid out by NumPy; the ids of words seen before are kept in a
dictionary of bounded size.

Defined results: a null or empty text has the end id alone; a null ``doc_id`` comes first; rows of
one ``doc_id`` are ordered by text, repeated rows all stay; no rows make an empty table; a very long
text is one list in one row; columns beside the two named are not read, whatever their names.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Known, per_process, small_batches, texts

KEPT_ENTRIES = 400_000
# ASCII symbols but the apostrophe: no rule of the tokenizer joins them to a letter or digit before them.
SYMBOLS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_ALNUM = np.array([chr(c).isalnum() for c in range(128)])
SCHEMA = "doc_id long, part int, at long, n_tokens long, ids array<int>"


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers start[i], ..., start[i] + n[i] - 1 of every i."""
    return np.repeat(start - (n.cumsum() - n), n) + np.arange(n.sum())


def _gather(flat: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``flat`` (``size[i]`` values each) laid out in the order ``which``, and their sizes."""
    n = size[which]
    return flat[_ranges((size.cumsum() - size)[which], n)], n


class Stretches:
    """Whole-text encoding: each distinct stretch between white space of a batch is encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        if not all(x in str(self.tokenizer.normalizer) for x in ("\\s+", "Lowercase")):
            raise ValueError("only tokenizers that lower-case and drop white space are supported")
        self.model = self.tokenizer.model
        added = "".join(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.symbols = "".join(x for x in SYMBOLS if x not in added)
        # Lower-case Latin letters that every step before the model leaves alone but for their bytes' names.
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        plain = [c for c in map(chr, [*range(97, 123), *range(0xDF, 0x180)])
                 if c.isalpha() and c == c.lower() and unicodedata.is_normalized("NFC", c)]
        self.letters = {ord(c): shown.pre_tokenize_str(c)[0][0] for c in plain}
        self.known = Known(KEPT_ENTRIES, self._word)

    def _word(self, word: str) -> bytes:
        """Ids of a new word: letters alone are one piece for the model, anything else takes the whole way."""
        low = word.lower() if word.isalpha() and max(word) < "\u0180" else word  # as the tokenizer does
        if all(map(self.letters.__contains__, map(ord, low))):
            return array("I", [t.id for t in self.model.tokenize(low.translate(self.letters))]).tobytes()
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _pieces(self, stretches: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Word and symbols after it, of each stretch; words of ASCII letters come lower-cased."""
        data = np.append(np.frombuffer(stretches.buffers()[2] or b"", np.uint8), np.uint8(32))
        edges = np.frombuffer(stretches.buffers()[1], np.int32)[stretches.offset:stretches.offset + len(stretches) + 1]
        words = pc.ascii_rtrim(stretches, self.symbols)
        size = pc.binary_length(words).to_numpy(zero_copy_only=False)
        last = edges[:-1] + size - 1  # place of a word's last byte; it begins at edges[:-1]
        one, two = (data[np.maximum(last - back, edges[:-1])] for back in (0, 1))
        latin = (two == 0xC3) & (one >= 0x80) & (one != 0x97) & (one != 0xB7)
        cut = (size > 0) & (latin | (one < 128) & _ALNUM[one & 127]) & (last + 1 < edges[1:])
        words = pc.if_else(pa.array(cut), words, stretches)
        words = pc.if_else(pc.ascii_is_alpha(words), pc.ascii_lower(words), words)
        n = np.where(cut, edges[1:] - last - 1, 0)
        symbols = data[_ranges(edges[1:] - n, n)].tobytes()
        stops = np.concatenate([[0], n.cumsum()]).astype(np.int32)
        return words, pa.Array.from_buffers(pa.string(), len(n), [None, pa.py_buffer(stops), pa.py_buffer(symbols)])

    def encode(self, column: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts laid end to end, ``end`` after each, and where each text's ids begin and end."""
        lists = pc.ascii_split_whitespace(column)
        n_words = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        words, symbols = (x.dictionary_encode() for x in self._pieces(coded.dictionary))
        ids = [self.known[x.decode("utf-8", "replace")]
               for d in (words, symbols) for x in d.dictionary.cast(pa.binary()).to_pylist()]
        # Pieces make stretches, and stretches make texts: the same gathering twice.
        pieces = np.stack([words.indices.to_numpy(), symbols.indices.to_numpy() + len(words.dictionary)], axis=1)
        flat, size = _gather(np.frombuffer(b"".join(ids), np.int32), np.array([len(x) // 4 for x in ids], np.int64),
                             pieces.ravel())
        size = np.append(size.reshape(-1, 2).sum(axis=1), len(end) // 4)
        flat = np.append(flat, np.frombuffer(end, np.int32))
        stops = n_words.cumsum()
        flat, n = _gather(flat, size, np.insert(coded.indices.to_numpy(), stops, len(size) - 1))
        return flat, np.concatenate([[0], n.cumsum()[stops + np.arange(len(stops))]])


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, row_group: int = 32 << 20,
                 page: int = 256 << 10, encoding: str = "dictionary", parts: int | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` into files below ``path``; ``tokenizer`` is a file on every executor.

    ``encoding`` is ``dictionary`` or ``delta``; ``row_group`` and ``page`` are bytes.
    """
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretches = per_process(("tokens", tokenizer), lambda: Stretches(tokenizer))
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, edges = stretches.encode(batch.column("text"), end)
            n, stops = np.diff(edges), edges[1:]
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(n), part), pa.int32()),
                 pa.array(at + stops - n), pa.array(n), lists], ["doc_id", "part", "at", "n_tokens", "ids"])
            at += int(stops[-1])

    small_batches(docs.sparkSession)
    rows = texts(docs, id_col, text_col)
    ranges = ["doc_id", F.substring("text", 1, 32)]  # in the files' order; rows of one doc_id take several parts
    dealt = rows.repartitionByRange(parts, *ranges) if parts else rows.repartitionByRange(*ranges)
    (dealt.sortWithinPartitions("doc_id", "text").mapInArrow(run, SCHEMA).write
     .option("compression", "zstd")
     .option("parquet.block.size", row_group).option("parquet.page.size", page)
     .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
     .option("parquet.writer.version", "PARQUET_2_0").parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files as a table; filters on ``doc_id`` and column choice reach the scan."""
    return spark.read.schema(SCHEMA).parquet(path)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """``part, before``: tokens of all parts before each part (one row a part)."""
    totals = read_tokens(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id, part, at, n_tokens, ids_crc32`` of the rows of a token table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values = memoryview(ids.values.to_numpy()).cast("B") if len(ids.values) else b""
            edges = (ids.offsets.to_numpy().astype(np.int64) * 4).tolist()
            sums = [zlib.crc32(values[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "part", "at", "n_tokens")] + [pa.array(sums, pa.int64())],
                ["doc_id", "part", "at", "n_tokens", "ids_crc32"])

    small_batches(tokens.sparkSession)
    return tokens.mapInArrow(run, "doc_id long, part int, at long, n_tokens long, ids_crc32 long")
