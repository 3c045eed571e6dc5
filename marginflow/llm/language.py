"""Language identification by multilingual mixture inference.

Learning.  Each language has a distribution over character n-grams (lengths 1 to 3 within
words and their borders, lower-cased, hashed into a fixed number of cells), counted over all its
training documents: one count vector for each task and language is added up by Spark.

Inference.  A document's n-grams come from a mixture of languages.  Expectation-maximisation
estimates the mixture's proportions from the n-gram likelihoods; languages are taken into the
document's set one by one, that of the greatest gain first, while the log-likelihood gained exceeds a
penalty that grows with the document's size, as in the Bayesian information criterion.  The prediction is the language of
the largest proportion in that set, and the score its proportion.

Defined results: a null text or one without a letter is ``und`` with score 0 and an empty set;
equal proportions go to the language first in the alphabet; with no training text every document
with a letter is ``und`` too; very long texts are counted whole; repeated rows each have their row;
no rows give no rows; columns beside those named are not read, whatever their names.  Predictions
read the text alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

CELL_BITS = 14
CELLS = 1 << CELL_BITS
UNDETERMINED = "und"
# ASCII letters and other characters stay, the rest of ASCII becomes a border.
_FOLD = np.array([c if chr(c).isalpha() else 32 for c in range(128)], np.uint32)


def cells_of(text: str) -> np.ndarray:
    """Cells of the n-grams of a text, repeats included."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    points = np.where(points < 128, _FOLD[points & 127], points)
    border = points == 32
    one = points[~(border & np.concatenate([[False], border[:-1]]))]
    two = one[:-1] * np.uint32(0x85EBCA6B) + one[1:]
    three = two[:-1] * np.uint32(0x85EBCA6B) + one[2:]
    grams = np.concatenate([one[one != 32], two + np.uint32(1 << 30), three + np.uint32(3 << 30)])
    grams ^= grams >> np.uint32(15)
    return (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - CELL_BITS)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def learn(training: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Count vector of each language; the driver receives one vector a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if lang not in total:
                    total[lang] = np.zeros(CELLS, np.int64)
                if has_letter(text):
                    total[lang] += np.bincount(cells_of(text), minlength=CELLS)
        for lang, counts in total.items():
            cell = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(cell), pa.string()), pa.array(cell, pa.int32()), pa.array(counts[cell])],
                ["lang", "cell", "n"])

    small_batches(training.sparkSession)
    rows = (training.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")))
    sums = rows.mapInArrow(run, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    vectors: dict[str, np.ndarray] = {}
    for lang, cell, n in sums.groupBy("lang").agg(
            F.collect_list("cell").alias("cell"), F.collect_list("n").alias("n")).collect():
        vectors[lang] = np.zeros(CELLS, np.int64)
        vectors[lang][cell] = n
    return dict(sorted(vectors.items()))


def probabilities(counts: dict[str, np.ndarray]) -> tuple[list[str], np.ndarray]:
    """Languages, and their smoothed n-gram probabilities as columns."""
    if not counts:
        return [], np.zeros((CELLS, 0))
    columns = [(c + 0.5) / (c.sum() + 0.5 * CELLS) for c in counts.values()]
    return list(counts), np.ascontiguousarray(np.stack(columns, axis=1))


def proportions(weights: np.ndarray, likelihood: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, float]:
    """EM for the mixture of the columns of ``likelihood``; ``weights`` counts its rows."""
    k = likelihood.shape[1]
    share, total = np.full(k, 1 / k), weights.sum()
    for _ in range(rounds if k > 1 else 0):
        joint = likelihood * share
        new = (weights / joint.sum(axis=1)) @ joint / total
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(weights @ np.log(likelihood @ share))


def mixture(cells: np.ndarray, table: np.ndarray, penalty: float = 2.0) -> tuple[list[int], np.ndarray]:
    """Languages of a document, by falling proportion, and their proportions.

    At each step the language of the greatest gain is taken, while its gain exceeds the penalty.  The
    likelihood is concave in the proportions, so a language gains at most what its derivative, or that
    of one taken, exceeds its mean by: one whose bound can't pay, or can't beat the best so far, is not
    tried.
    """
    weights = np.bincount(cells, minlength=CELLS)
    cell = np.flatnonzero(weights)
    weights, likelihood = weights[cell].astype(float), table[cell]
    total = weights.sum()
    single = weights @ np.log(likelihood)
    chosen, best = [int(single.argmax())], float(single.max())
    share = np.ones(1)
    cost = penalty * 0.5 * math.log(total + 1)
    while len(chosen) < likelihood.shape[1]:
        slope = (weights / (likelihood[:, chosen] @ share)) @ likelihood - total
        bound = np.maximum(slope, slope[chosen].max())
        bound[chosen] = -np.inf
        gained, taken = cost, None
        for extra in np.argsort(-bound, kind="stable").tolist():
            if bound[extra] <= gained:
                break
            wider, level = proportions(weights, likelihood[:, [*chosen, extra]])
            if level - best > gained:
                gained, taken = level - best, (extra, wider, level)
        if taken is None:
            break
        chosen, share, best = [*chosen, taken[0]], taken[1], taken[2]
    order = sorted(range(len(chosen)), key=lambda i: (-share[i], chosen[i]))
    return [chosen[i] for i in order], share[order]


def predict(docs: DataFrame, counts: dict[str, np.ndarray], id_col: str = "doc_id",
            text_col: str = "text", keep: dict[str, Column] | None = None, keep_text: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score, languages`` for each row; ``languages`` is its set.

    ``keep`` names further columns computed from ``docs`` that are carried through, as the text
    is with ``keep_text``.
    """
    names, table = probabilities(counts)

    def judge(text: str | None) -> tuple[str, float, list[str]]:
        if not names or not has_letter(text):
            return UNDETERMINED, 0.0, []
        found, share = mixture(cells_of(text), table)
        return names[found[0]], min(1.0, float(share[0])), [names[i] for i in found]

    carried = ["text"] * keep_text + list(keep or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [judge(t) for t in batch.column("text").to_pylist()]
            lang, score, sets = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(sets, pa.list_(pa.string())), *map(batch.column, carried)],
                ["doc_id", "lang_pred", "score", "languages", *carried])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       *[c.alias(n) for n, c in (keep or {}).items()])
    extra = "".join(f", `{n}` {rows.schema[n].dataType.simpleString()}" for n in carried)
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, languages array<string>" + extra)
