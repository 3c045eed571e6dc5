"""Quality rules as a learned decision list.

Statistics of every whole text come first.  A decision list is then learned from labelled rows by
sequential covering: a rule, a conjunction of thresholds on statistics, grows by the condition of
most information gain until it covers no kept row of the growing part, loses its last conditions
while that helps it on the pruning part, and takes the rows it covers out of the learning set.
Learning ends when a new rule is no longer right about most of what it covers.  The list becomes
one ordered Spark conditional expression over the statistics.

The list is fitted on at most ``max_rows`` labelled rows, drawn by hashed ``doc_id``; the
statistics and the expression cover all rows.

Defined results: a null text has no words; ratios without a denominator are 0; labels that are
null, or name no document, are left out; without labels of both kinds the list is empty and keeps
every row; repeated rows each have their row; very long texts are counted whole; no rows give no rows;
columns beside those named are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Rolling, Scratch, mix, rows_of, small_batches, texts

WINDOW = 8
WINDOW_BASE = 0x9E3779B97F4A7C15  # fixed value: odd base of the rolling hash
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("symbol_share", "mean_word", "dup_line_share", "repeat_share", "distinct_share", "upper_share",
          "digit_share", "mark_share", "line_words", "same_next_share")
LEARNED = ("n_words", *RATIOS)  # what conditions may be on: a longer text of one kind stays of its kind


def _repeated(lists: list[list[bytes]], symbols: np.ndarray, sizes: np.ndarray, rolling: Rolling) -> np.ndarray:
    """Words of each list within windows that the list has twice or more."""
    which = np.repeat(np.arange(len(lists)), sizes)
    place = np.arange(len(symbols)) - np.repeat(sizes.cumsum() - sizes, sizes)
    start = np.flatnonzero(place + WINDOW <= np.repeat(sizes, sizes))
    if not len(start):
        return np.zeros(len(lists), np.int64)
    grams = rolling.runs(rolling.prefix(symbols), start, start + WINDOW)
    _, inverse, count = np.unique(mix(grams ^ mix(which[start].astype(np.uint64))), return_inverse=True,
                                  return_counts=True)
    twice = start[count[inverse] > 1]
    edge = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW, -1)
    return np.bincount(which, weights=edge.cumsum()[:-1] > 0, minlength=len(lists)).astype(np.int64)


def _of_text(text: str, words: list[bytes], symbols: np.ndarray) -> tuple:
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    marks = sum(map(text.count, SYMBOLS))
    seen, again, lines = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            again += line in seen
            seen.add(line)
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    lower = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    upper = int((points != lower).sum()) if len(points) == len(lower) else sum(map(str.isupper, text))
    digits = int(((points >= 48) & (points <= 57)).sum())
    ends = sum(map(text.count, "!?"))
    same = int((symbols[1:] == symbols[:-1]).sum())
    per_char, per_word = 1 / max(1, chars), 1 / max(1, n)
    return (chars, marks, again, marks * per_char, chars * per_word, again / max(1, lines),
            len(np.unique(symbols)) * per_word, upper * per_char, digits * per_char, ends * per_word,
            n / max(1, lines), same * per_word)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the counts and the ratios of each row's text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(WINDOW_BASE)
        for batch, raws in rows_of(batches):
            lists = [x.split() for x in raws]
            sizes = np.array([len(x) for x in lists], np.int64)
            flat = [w for x in lists for w in x]
            symbols = np.fromiter(map(xxhash.xxh64_intdigest, flat), np.uint64, len(flat))
            cuts = np.split(symbols, sizes.cumsum()[:-1])
            repeat = _repeated(lists, symbols, sizes, rolling)
            rows = [_of_text(x.decode("utf-8", "replace"), w, s) for x, w, s in zip(raws, lists, cuts, strict=True)]
            chars, marks, again, sym, mean, dup, distinct, *rest = map(np.array, zip(*rows, strict=True))
            columns = [sizes, chars, marks, again, repeat, sym, mean, dup, repeat / np.maximum(1, sizes), distinct, *rest]
            kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(RATIOS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", *COUNTS, *RATIOS])

    small_batches(docs.sparkSession)
    kinds = [f"{c} long" for c in COUNTS] + [f"{c} double" for c in RATIOS]
    return texts(docs, id_col, text_col).mapInArrow(run, ", ".join(["doc_id long", *kinds]))


@dataclass(frozen=True)
class Condition:
    name: str
    at_least: bool
    bound: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        return table[self.name] >= self.bound if self.at_least else table[self.name] <= self.bound

    def column(self) -> Column:
        return F.col(self.name) >= self.bound if self.at_least else F.col(self.name) <= self.bound


@dataclass
class DecisionList:
    """Rules in order; a row that no rule covers is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def keeps(self) -> Column:
        out = None
        for rule in self.rules:
            met = rule[0].column()
            for condition in rule[1:]:
                met = met & condition.column()
            out = F.when(met, F.lit(False)) if out is None else out.when(met, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def __str__(self) -> str:
        told = [" and ".join(f"{c.name} {'>=' if c.at_least else '<='} {c.bound:.6g}" for c in r) for r in self.rules]
        return "".join(f"if {x}: drop\n" for x in told) + "else: keep"


def _covered(rule: list[Condition], table: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for condition in rule:
        out &= condition.holds(table)
    return out


def _best(table: dict[str, np.ndarray], drop: np.ndarray, inside: np.ndarray) -> tuple[float, Condition | None]:
    """Condition of most FOIL gain among the rows inside the rule so far."""
    p, n = int(drop[inside].sum()), int((~drop[inside]).sum())
    before, best, chosen = np.log2(p / (p + n)), 0.0, None
    for name, values in table.items():
        order = np.argsort(values[inside], kind="stable")
        value, hit = values[inside][order], drop[inside][order]
        last = np.append(value[1:] != value[:-1], True)  # a threshold ends at the last equal value
        up = hit.cumsum()[last].astype(float)
        size = (np.flatnonzero(last) + 1).astype(float)
        bound = value[last]
        low_before = np.concatenate([[0.0], up[:-1]]), np.concatenate([[0.0], size[:-1]])
        for at_least, got, of in ((False, up, size), (True, p - low_before[0], p + n - low_before[1])):
            gain = got * (np.log2(np.maximum(got, 1e-9) / of) - before)
            i = int(gain.argmax())
            if gain[i] > best + 1e-9:
                best, chosen = float(gain[i]), Condition(name, at_least, float(bound[i]))
    return best, chosen


def cover(table: dict[str, np.ndarray], drop: np.ndarray, max_rules: int = 12, max_conditions: int = 5,
          min_right: float = 0.75) -> DecisionList:
    """Sequential covering; two thirds of the rows grow a rule and the rest prune it."""
    found, left = DecisionList(), np.ones(len(drop), bool)
    grow_part = np.arange(len(drop)) % 3 != 0
    while len(found.rules) < max_rules:
        inside, rule = left & grow_part, []
        if not drop[inside].any() or drop[inside].all():
            break
        while len(rule) < max_conditions and not drop[inside].all():
            gain, condition = _best(table, drop, inside)
            if condition is None or gain <= 0:
                break
            rule.append(condition)
            inside = inside & condition.holds(table)

        def worth(r: list[Condition]) -> float:
            hit = _covered(r, table, len(drop)) & left & ~grow_part
            p, n = int(drop[hit].sum()), int((~drop[hit]).sum())
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = _covered(rule, table, len(drop)) & left if rule else np.zeros(len(drop), bool)
        if not hit.any() or drop[hit].mean() < min_right or worth(rule) < 2 * min_right - 1:
            break
        found.rules.append(rule)
        left &= ~hit
    return found


def learn(stats: DataFrame, labels: DataFrame, max_rows: int = 20_000, label_col: str = "quality",
          id_col: str = "doc_id") -> DecisionList:
    """Decision list that drops rows labelled 0; ``stats`` as given by ``statistics``."""
    wanted = labels.where(F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), (F.col(label_col) == 0).alias("drop"))
    names = list(LEARNED)
    labelled = stats.join(wanted, "doc_id")
    # Rows are drawn by hashed doc_id: first those below a bound that twice max_rows should pass, so
    # that no task or the driver sees many more than max_rows, then the least of these.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    bound = int(min(1.0, 2 * max_rows / max(1, labelled.count())) * (1 << 40))
    rows = (labelled.where(place < bound).orderBy(place, *names, "drop").limit(max_rows)
            .select(*names, "drop").toPandas())
    if not len(rows):
        return DecisionList()
    return cover({n: rows[n].to_numpy(float) for n in names}, rows["drop"].to_numpy(bool))


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Statistics of each row, ``base_failed`` and ``kept``."""
    stats = Scratch(docs.sparkSession, "rules").table("statistics", statistics(docs))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    verdict = learn(stats, labels, **options).keeps()
    return stats.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict)
