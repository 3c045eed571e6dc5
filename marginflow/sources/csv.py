"""CSV extracts: typed load by column name, and untyped (all-text) load.

Files follow RFC 4180: quotes are doubled inside quoted fields, which may hold line breaks.  Each
file has a header row; a folder's files may order their columns differently, since every file is
read with its own header and the columns are taken *by name* (extra columns are ignored, a missing
one raises).  Typed loads cast each column to its declared type with ANSI casts: a bad value aborts
the load.  Empty fields, quoted or not, are empty strings and then fail the cast of a numeric or date
column, as an unparsable value should.  Blanks around values are data and are kept, on load and on write.

A file is split although a quoted field may hold line breaks.  Where a split begins, it can't tell
whether it is inside a quoted field; but that follows from the number of quotes before it, even or odd.

1. A first pass counts the quotes of every split (Spark's ranges of a file) and keeps the header of a
   file's first split.  One row a split is written to the scratch folder.
2. Summing the counts along each file tells each split's case.  A second pass cuts the splits into whole
   records, which ``from_csv`` parses in the JVM under their file's header.
3. Where a record crosses splits, their first and last lines are put together along the file.

Each pass reads all files of a path in one job, however many there are, and large files by as many
tasks as ``spark.sql.files.maxPartitionBytes`` makes of them.  Splits' cases reach the tasks by a
broadcast join, whose small side has a row a split; beyond ``MOST_BROADCAST`` splits lines are dealt by
split and sorted by place instead.  A header must end within its file's first split.  Lines end in a
line feed, with or without a carriage return.
"""

from __future__ import annotations

import csv as reader
import io
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..session import scratch_dir
from .tables import input_state

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

# A value that never appears in the data: with it as nullValue, empty fields stay "".
_NO_NULL_TOKEN = "\u0000<no-null>\u0000"
_DIALECT = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8",
            "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_PARSE = {**{k: str(v).lower() if isinstance(v, bool) else v for k, v in _DIALECT.items() if k not in ("header", "encoding")},
          "nullValue": _NO_NULL_TOKEN, "emptyValue": "", "mode": "FAILFAST", "multiLine": "true", "maxCharsPerColumn": "-1"}
MOST_BROADCAST = 1_000_000  # splits, about 100 MB; 128 TB at the usual 128 MB a split
MOST_HEADERS = 1000  # different headers below one path
ROWS_PER_FILE = 250_000  # of an extract; about 35 MB of text
SPLITS = "file string, start long, quotes long, header string"
HEAD, TAIL, THROUGH = 0, 1, 2  # lines that end a record begun earlier, that begin one, that do neither


class MissingColumnError(ValueError):
    pass


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, start`` (of the split) and ``line``, in the order of the file within a split."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                       F.col("value").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """Lines of a batch, split by split."""
    files, starts = batch.column("file").to_pylist(), batch.column("start").to_pylist()
    at = 0
    while at < len(files):
        stop = at
        while stop < len(files) and files[stop] == files[at] and starts[stop] == starts[at]:
            stop += 1
        yield files[at], starts[at], batch.column("line").slice(at, stop - at)
        at = stop


def _quotes(lines: pa.Array) -> np.ndarray:
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a split: its quotes and, from a file's first split, the header (null if it doesn't end there)."""
    def row(file: str, start: int, quotes: int, header: list[str], shut: bool) -> pa.RecordBatch:
        values = [file], [start], [quotes], ["\n".join(header) if shut else None]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(values, (
            pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["file", "start", "quotes", "header"])

    place, quotes, header, shut = None, 0, [], False
    for batch in batches:
        for file, start, lines in _runs(batch):
            if (file, start) != place:
                if place:
                    yield row(*place, quotes, header, shut)
                place, quotes, header, shut = (file, start), 0, [], False
            counts = _quotes(lines)
            if start == 0 and not shut:
                ends = np.flatnonzero((quotes + counts.cumsum()) % 2 == 0)
                header += lines.slice(0, int(ends[0]) + 1 if len(ends) else len(lines)).to_pylist()
                shut = bool(len(ends))
            quotes += int(counts.sum())
    if place:
        yield row(*place, quotes, header, shut)


class _Cutter:
    """Cuts the lines of one split, batch by batch, into records."""

    def __init__(self, inside: int):
        self.parity, self.open = inside, []  # lines of the record that is open
        self.begun_here = not inside

    def __call__(self, lines: pa.Array) -> Iterator[tuple[bool, list[str]]]:
        """(begun in this split, texts): the records that end in these lines."""
        counts = _quotes(lines)
        after = (self.parity + counts.cumsum()) % 2
        self.parity = int(after[-1])
        if self.begun_here and not self.open and not counts.any():
            yield True, lines.to_pylist()
            return
        texts, begin = lines.to_pylist(), 0
        for stop in np.flatnonzero(after == 0).tolist():
            yield self.begun_here, ["\n".join([*self.open, *texts[begin:stop + 1]])]
            self.open, self.begun_here, begin = [], True, stop + 1
        self.open += texts[begin:]


def _whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``header_no, record`` of records that begin and end in one split."""
    place, cutter, header = None, None, False
    for batch in batches:
        at = 0
        for file, start, lines in _runs(batch):
            inside, number = (batch.column(c)[at].as_py() for c in ("inside", "header_no"))
            at += len(lines)
            if (file, start) != place:
                place, cutter, header = (file, start), _Cutter(inside), start == 0
            records = [x for here, texts in cutter(lines) if here for x in texts]
            if header and records:
                records, header = records[1:], False
            records = [x.removesuffix("\r") for x in records if x not in ("", "\r")]
            if records:
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(records), pa.int32()), pa.array(records, pa.string())],
                                                 ["header_no", "record"])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``header_no, file, start, kind, piece``: what a split has of records that cross its ends."""
    def piece(kind: int, text: list[str]) -> pa.RecordBatch:
        values = [number], [place[0]], [place[1]], [kind], ["\n".join(text)]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(values, (
            pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.string()), strict=True)],
            ["header_no", "file", "start", "kind", "piece"])

    def last() -> Iterator[pa.RecordBatch]:
        if cutter and cutter.parity:
            yield piece(TAIL if cutter.begun_here else THROUGH, cutter.open)

    place, cutter, number = None, None, 0
    for batch in batches:
        at = 0
        for file, start, lines in _runs(batch):
            if (file, start) != place:
                yield from last()
                place, cutter, number = (file, start), _Cutter(batch.column("inside")[at].as_py()), batch.column("header_no")[at].as_py()
            at += len(lines)
            for here, texts in cutter(lines):
                if not here:
                    yield piece(HEAD, texts)
    yield from last()


def _crossing(ends: DataFrame) -> DataFrame:
    """``header_no, record`` of the records that cross splits: a tail and all pieces up to the next head."""
    # A window holds a file's pieces, two a split at most, and of crossing records alone.
    along = W.partitionBy("file").orderBy("start", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    of = F.last(F.when(F.col("kind") == TAIL, F.col("start")), ignorenulls=True).over(along)
    whole = ends.withColumn("_of", of).groupBy("file", "_of").agg(
        F.min("header_no").alias("header_no"), F.sort_array(F.collect_list(F.struct("start", "piece"))).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["piece"]), "\n")
    return whole.select("header_no", F.regexp_replace(text, "\r$", "").alias("record"))


def _columns(header: str) -> list[str]:
    return next(reader.reader(io.StringIO(header.removesuffix("\r").removeprefix("\ufeff"), newline="")))


def _with_cases(lines: DataFrame, cases: DataFrame, few: bool) -> DataFrame:
    """Lines, in their order, with what is known of their split."""
    same = (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start"))
    if few:
        joined = lines.join(F.broadcast(cases), same, "left")  # keeps lines where and as they are
    else:
        joined = (lines.withColumn("place", F.monotonically_increasing_id()).join(cases, same, "left")
                  .repartition("file", "start").sortWithinPartitions("file", "start", "place"))
    # Splits depend on settings: lines of a split that was not surveyed are never dropped in silence.
    known = F.when(F.col("_file").isNull(), F.raise_error(F.lit("files are split otherwise than when they were surveyed"))
                   .cast("int")).otherwise(F.col("inside"))
    return joined.select("file", "start", "line", known.alias("inside"), "header_no", "_open")


_SURVEYS: dict[tuple, str] = {}
_SPLITTING = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum",
              "spark.sql.leafNodeDefaultParallelism")


def _surveyed(spark: SparkSession, path: str) -> DataFrame:
    """A row a split; the survey is made once for a session, its way to split files, and their state."""
    settings = tuple(spark.conf.get(k, None) for k in _SPLITTING)
    key = spark.sparkContext.applicationId, scratch_dir(spark), path, settings, hash(input_state(spark, path))
    if key not in _SURVEYS:
        scratch = f"{scratch_dir(spark)}/csv/{uuid.uuid4().hex}"
        _lines(spark, path).mapInArrow(_survey, SPLITS).write.parquet(scratch)
        _SURVEYS[key] = scratch
    return spark.read.schema(SPLITS).parquet(_SURVEYS[key])


def _read_text(spark: SparkSession, path: str, wanted: list[str] | None = None) -> DataFrame:
    """All records of a path as text columns: ``wanted``, or those of the first header."""
    splits = _surveyed(spark, path)
    before = F.coalesce(F.sum("quotes").over(W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    told = splits.withColumn("inside", (before % 2).cast("int"))
    found = [r.header for r in told.where("start = 0").groupBy("header").agg(F.min("file").alias("f")).orderBy("f")
             .limit(MOST_HEADERS + 1).collect()]  # one row a different header
    if len(found) > MOST_HEADERS:
        raise ValueError(f"{path}: more than {MOST_HEADERS} different headers")
    if not found or any(h is None for h in found):
        raise ValueError(f"{path}: no file with a header that ends in its first split")
    names = [_columns(h) for h in found]
    wanted = wanted or names[0]
    missing = [sorted(set(wanted) - set(n)) for n in names]
    if any(missing):
        raise MissingColumnError(f"{path}: missing columns {next(m for m in missing if m)}")
    number = F.coalesce(*[F.when(F.col("header") == F.lit(h), F.lit(i)) for i, h in enumerate(found)])
    headers = told.where("start = 0").select(F.col("file").alias("_of"), number.alias("header_no"))
    cases = told.join(headers, told["file"] == headers["_of"]).select(
        F.col("file").alias("_file"), F.col("start").alias("_start"), "inside", "header_no",
        ((F.col("inside") + F.col("quotes")) % 2).alias("_open"))
    few = splits.count() <= MOST_BROADCAST  # from the files' footers
    records = _with_cases(_lines(spark, path), cases, few).mapInArrow(_whole_records, "header_no int, record string")
    crossed = "inside = 1 or _open = 1"
    if not cases.where(crossed).isEmpty():
        ends = _with_cases(_lines(spark, path), cases, few).where(crossed).mapInArrow(
            _ends, "header_no int, file string, start long, kind int, piece string")
        records = records.union(_crossing(ends))

    # A record is parsed once, whole, under its header: fields taken off ``from_csv`` itself would each
    # have a parse of their own, of that one column.
    parsed = []
    for i, columns in enumerate(names):
        schema = T.StructType([T.StructField(f"c{j}", T.StringType()) for j in range(len(columns))])
        fields = F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), _PARSE)
        parsed.append(F.when(F.col("header_no") == i, fields).alias(f"_p{i}"))
    rows = records.select(*parsed)
    return rows.select(*[F.coalesce(*[F.col(f"_p{i}.c{columns.index(c)}") for i, columns in enumerate(names)], F.lit("")).alias(c)
                         for c in wanted])


def load_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Untyped load: every column a string, names from the header (of the first file by name)."""
    return _read_text(spark, path)


def load_typed_csv(spark: SparkSession, path: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """Typed load of ``path`` against the declared schema of ``table`` (columns by name)."""
    schema = schema or schemas.TABLES[table]
    raw = _read_text(spark, path, schema.names)
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def write_csv_extract(df: DataFrame, path: str) -> None:
    """Write an extract with a header row (directory of compressed part files, overwrite).

    A compressed file is read by one task, so files are of bounded length."""
    (df.write.mode("overwrite").options(**_DIALECT).option("emptyValue", '""').option("compression", "gzip")
     .option("maxRecordsPerFile", ROWS_PER_FILE).csv(path))
