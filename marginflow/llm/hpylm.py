"""Language-model scores from a hierarchical Pitman-Yor model sampled by Gibbs.

Model.  A token follows a context, the real word before it (or the start of the text).  Each context
is a restaurant with the distribution of the next word; contexts whose words end alike share a parent
restaurant, all parents share the root, and the root's base is uniform over the training
vocabulary and one unknown word.  A table in a restaurant is a customer in its parent.

Where the work is.  What ties words together is, for each restaurant, only its numbers of
customers and tables.  Given these, the seating of one word in all its restaurants depends on that
word alone.  So training counts of (word, context) are combined by Spark and dealt to buckets of
words; every bucket runs Gibbs sweeps over its own seating, and after each sweep Spark adds up the
restaurants' totals for the next one.  Those of the root and the parents are 65 rows.  Those of the
contexts are as many as the corpus has words: buckets send their shares to the parts of a Spark
table of contexts, and each part sends every bucket the sums of the contexts that it asked for.  A
pair that occurs once has one table in every state, so a sweep asks only for contexts with a pair of
its bucket that occurs more often, and pairs of one customer travel without their context.  A sweep
reseats all customers.  In rows of at most ``FEW`` customers each leaves its table in turn and is
seated anew, each step in all rows at once.  A row of more customers is held as its numbers of
customers and tables, and its tables are drawn as a whole, given the customers (``draw_tables``):
its memory and time don't grow with them.
A bucket's state is a function of its counts, the totals so far and a fixed seed: it is replayed after
each sweep, and only the numbers of tables that scores need are written, so a lost executor loses nothing.

Scoring.  Tokens of all documents meet the model by bucket, in blocks that hold each distinct
(word, context) once; probabilities are averaged over the states after the burn-in, and partial
sums go back to the block's documents.  A frequent word's blocks are dealt over several copies of
its bucket.

Defined results: a null text is empty and holds the end token alone; a null ``doc_id`` trains;
without training rows every token is unknown; repeated rows each have their row; very long texts are
scored whole, in blocks; no rows give no rows; columns beside those named are not read, whatever their
names.  Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, give_back, mix, per_process, raw, small_batches

# A context has 64 bits; the upper 6, from the last two bytes of the word, name its parent, the others
# are of the word's hash.  Within a bucket contexts are numbered, and a number has 32 bits: the parent's
# 6 above the place among the bucket's contexts.
PARENT_BITS, CONTEXT_BITS, PARENT_SHIFT = 6, 32, 26
_U = np.uint64
_LOW = _U((1 << CONTEXT_BITS) - 1)
_PLACE = _U((1 << PARENT_SHIFT) - 1)
_ASKED = _U(1 << PARENT_SHIFT - 1)  # from here on places of contexts whose totals a sweep needs
END, START = xxhash.xxh64_intdigest(b" "), xxhash.xxh64_intdigest(b"\n")  # no word has these bytes
BLOCK_TOKENS, BLOCK_DOCS = 5_000_000, 20_000


# ---- tokens and blocks ---------------------------------------------------------------------

_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\x0b\x0c\r")] = True
_LETTER = mix(np.arange(1, 257, dtype=np.uint64))  # a 64-bit number for each byte
_STEP = _U(0x9E3779B97F4A7C15)
_LONG = 64  # longer words are hashed one by one


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of each word data[start:stop]: a polynomial over its bytes, then mixed.

    All words advance by one byte at once; sorted by falling length, those still running are the
    first ones.
    """
    size = stop - start
    order = np.argsort(-np.minimum(size, _LONG + 1).astype(np.int16), kind="stable")
    at, running = start[order], np.bincount(np.minimum(size, _LONG), minlength=_LONG + 1)
    running = running[::-1].cumsum()[::-1]  # words of at least so many bytes
    h = np.zeros(len(size), np.uint64)
    for k in range(_LONG):
        m = int(running[k + 1])
        if not m:
            break
        h[:m] = h[:m] * _STEP + _LETTER[data[at[:m] + k]]
    out = np.empty_like(h)
    out[order] = mix(h ^ (size[order].astype(np.uint64) << _U(56)))
    for i in np.flatnonzero(size > _LONG).tolist():
        out[i] = xxhash.xxh64_intdigest(data[start[i]:stop[i]].tobytes())
    return out


def tokens_of(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Over all texts: hash of each token, its context, and the number of tokens of each text."""
    data = np.frombuffer(b"  " + b" ".join(raws).lower() + b" ", np.uint8)
    blank = _BLANK[data]
    start = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    stop = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    length = np.fromiter(map(len, raws), np.int64, len(raws)) + 1
    begin = 2 + length.cumsum() - length
    sizes = np.diff(np.searchsorted(start, np.append(begin, len(data))))
    hashes = word_hashes(data, start, stop)
    last = data[stop - 1].astype(np.uint64) << _U(8) | data[stop - 2]
    tail = mix(last) >> _U(64 - PARENT_BITS)
    before = tail << _U(64 - PARENT_BITS) | hashes >> _U(PARENT_BITS)
    counts, first = sizes + 1, sizes.cumsum() - sizes + np.arange(len(raws))
    token = np.empty(int(counts.sum()), np.uint64)
    context = np.empty(len(token), np.uint64)
    is_end = np.zeros(len(token), bool)
    is_end[first + sizes] = True
    token[is_end], token[~is_end] = _U(END), hashes
    context[first] = _U(START)
    after = np.ones(len(token), bool)
    after[first] = False
    context[after] = before
    return token, context, counts


def bucket_of(token: np.ndarray, buckets: int) -> np.ndarray:
    out = (token ^ token >> _U(32)) % _U(buckets)
    return out.astype(np.uint16 if buckets < 1 << 16 else np.int64)  # short numbers sort faster


def key_of(token: np.ndarray, context: np.ndarray) -> np.ndarray:
    """The word's upper bits above its context's: numbers of both, in a bucket."""
    return token & ~_LOW | context >> _U(64 - CONTEXT_BITS)


def numbers(contexts: np.ndarray) -> np.ndarray:
    """Numbers of a bucket's contexts, which are distinct and ascend."""
    parent = contexts >> _U(64 - PARENT_BITS) << _U(PARENT_SHIFT)
    return parent | np.arange(len(contexts), dtype=np.uint64)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers, byte planes together, compressed."""
    out = [len(arrays).to_bytes(4, "little")]
    for x in arrays:
        x = np.ascontiguousarray(x)
        body = zstandard.ZstdCompressor(level=1).compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes())
        out += [x.dtype.str.encode().ljust(4), len(x).to_bytes(8, "little"), len(body).to_bytes(8, "little"), body]
    return b"".join(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    out, at = [], 4
    for _ in range(int.from_bytes(blob[:4], "little")):
        dtype = np.dtype(blob[at:at + 4].decode().strip())
        n, size = (int.from_bytes(blob[at + i:at + i + 8], "little") for i in (4, 12))
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[at + 20:at + 20 + size]), np.uint8)
        out.append(np.ascontiguousarray(planes.reshape(dtype.itemsize, n).T).view(dtype).reshape(n))
        at += 20 + size
    return out


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=_U(0))


def _sums(steps: np.ndarray) -> np.ndarray:
    return steps.cumsum(dtype=np.uint64)


def _collected(batches: Iterator[pa.RecordBatch], extra: tuple[str, ...] = ()) -> Iterator[list]:
    """Blocks of documents: tokens, contexts, sizes, and the extra columns' values.

    A block is the only holder of its arrays: what a caller takes out of it is freed with its last use.
    """
    held: list[list] = [[], [], []] + [[] for _ in extra]
    n = docs = 0

    def block() -> list:
        out = []
        for i, parts in enumerate(held):
            out.append(np.concatenate(parts) if i < 3 else [v for x in parts for v in x])
            parts.clear()  # the parts are not kept beside the block
        return out

    for batch in batches:
        if not batch.num_rows:
            continue
        for part, new in zip(held, [*tokens_of(raw(batch)), *(batch.column(c).to_pylist() for c in extra)], strict=True):
            part.append(new)
        n, docs = n + len(held[0][-1]), docs + batch.num_rows
        if n >= BLOCK_TOKENS or docs >= BLOCK_DOCS:
            n = docs = 0
            del new
            yield block()
            give_back()
    if docs:
        new = None
        yield block()
        give_back()


def _split(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    found, start = np.unique(bucket[order], return_index=True)
    if len(order):
        yield from zip(found.tolist(), np.split(order, start[1:]), strict=True)


def _numbered(values: np.ndarray, buckets: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values by bucket and size, and each value's place among them."""
    found = pa.array(values).dictionary_encode()
    del values
    distinct = found.dictionary.to_numpy()
    order = np.lexsort((distinct, bucket_of(distinct, buckets)))
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    return distinct[order], place[found.indices.to_numpy()]


def _used(places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``n`` places occur, and the rank of each."""
    if len(places) < n // 8:
        return np.unique(places, return_inverse=True)
    occurs = np.zeros(n, bool)
    occurs[places] = True
    return np.flatnonzero(occurs), (occurs.cumsum() - 1)[places]


def _dealt(block: list, buckets: int) -> Iterator[tuple]:
    """For each bucket of a block: its keys by own numbers, how often each occurs, the tokens in the
    keys' order (one key's in the block's order), and the words and contexts that are numbered.

    Takes tokens and contexts, the block's first two, out of it."""
    words, word = _numbered(block.pop(0), buckets)
    contexts, before = _numbered(block.pop(0))
    keys = word.astype(np.uint64)
    keys <<= _U(CONTEXT_BITS)
    keys |= before
    del word, before
    order = np.argsort(keys, kind="stable").astype(np.uint32 if len(keys) < 1 << 32 else np.int64)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    keys, first = keys[first], np.append(first, len(keys))
    found, start = np.unique(bucket_of(words, buckets), return_index=True)
    start = np.append(start, len(words))
    cut = np.append(np.searchsorted(keys, start[:-1].astype(np.uint64) << _U(CONTEXT_BITS)), len(keys))
    for i, bucket in enumerate(found.tolist()):
        some, span = keys[cut[i]:cut[i + 1]], first[cut[i]:cut[i + 1] + 1]
        used, at = _used((some & _LOW).astype(np.int64), len(contexts))
        own = contexts[used]
        number = (some >> _U(CONTEXT_BITS)) - _U(start[i])
        yield (bucket, number << _U(CONTEXT_BITS) | numbers(own)[at], np.diff(span), order[span[0]:span[-1]],
               words[start[i]:start[i + 1]], own)


def _renumbered(keys: np.ndarray, own: tuple, words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Keys by the numbers of words and contexts among more of them."""
    word = np.searchsorted(words, own[0]).astype(np.uint64)[(keys >> _U(CONTEXT_BITS)).astype(np.int64)]
    context = numbers(contexts)[np.searchsorted(contexts, own[1])][(keys & _PLACE).astype(np.int64)]
    return word << _U(CONTEXT_BITS) | context


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(counts, new) if len(keys) else counts


def _merged(pieces: list[tuple]) -> tuple:
    """Keys, counts, words and contexts of several pieces with numbers of their own."""
    words, contexts = (np.unique(np.concatenate([p[i] for p in pieces])) for i in (2, 3))
    keys = np.concatenate([_renumbered(p[0], p[2:], words, contexts) for p in pieces])
    return (*_summed(keys, np.concatenate([p[1] for p in pieces])), words, contexts)


def _asked(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of the contexts in which a pair of the bucket occurs more than once."""
    return np.unique(keys[counts > 1] & _PLACE).astype(np.int64)


def _for_sweeps(keys: np.ndarray, counts: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys with the asked contexts numbered anew; a pair that occurs once has any number below
    them that no other pair of its word and parent has, as its table depends on no total."""
    out, single = keys & ~_PLACE, counts == 1
    group = out[single]
    if len(group):
        new = np.concatenate([[True], group[1:] != group[:-1]])
        start = np.flatnonzero(new)
        out[single] |= (np.arange(len(group)) - start[new.cumsum() - 1]).astype(np.uint64)
    more = np.searchsorted(asked, (keys[~single] & _PLACE).astype(np.int64)).astype(np.uint64)
    out[~single] |= _ASKED + more
    order = np.argsort(out, kind="stable")
    return out[order], counts[order]


def _few(keys: np.ndarray, counts: np.ndarray, contexts: np.ndarray, asked: np.ndarray) -> bytes:
    keys, counts = _for_sweeps(keys, counts, asked)
    return pack(_steps(keys), counts, _steps(contexts[asked]))


def training_counts(rows: DataFrame, buckets: int, scratch: Scratch) -> DataFrame:
    """``bucket, tokens, words, counts, few``: the counted (word, context) keys of each bucket.

    ``counts`` holds them with the words and contexts that are numbered, which are those of all rows;
    ``few`` is what sweeps need, with the contexts that they ask for.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _collected(batches, ("held_out",)):
            train = np.repeat(~np.array(block[3], bool), block[2])
            for bucket, keys, n, at, words, contexts in _dealt(block, buckets):
                n = np.add.reduceat(train[at], n.cumsum() - n, dtype=np.uint32)
                blob = pack(_steps(keys), n, _steps(words), _steps(contexts))
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([blob], pa.binary())],
                                                 ["bucket", "counts"])
            del block, train, keys, n, at, words, contexts, blob  # before the next block is read

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pieces, waiting = None, [], 0

        def done() -> pa.RecordBatch:
            keys, n, words, contexts = _merged(pieces)
            pieces.clear()
            keys, n = keys[n > 0], n[n > 0]
            asked = _asked(keys, n)
            few = _few(keys, n, contexts, asked)
            known = len(np.unique(keys >> _U(CONTEXT_BITS)))
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int64()), pa.array([int(n.sum())], pa.int64()), pa.array([known], pa.int64()),
                 pa.array([pack(_steps(keys), n, _steps(words), _steps(contexts))], pa.binary()),
                 pa.array([few], pa.binary())], ["bucket", "tokens", "words", "counts", "few"])

        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                if bucket != now:
                    if pieces:
                        yield done()
                        give_back()
                    now, pieces, waiting = bucket, [], 0
                keys, n, words, contexts = unpack(blob)
                pieces.append((_sums(keys), n.astype(np.int64), _sums(words), _sums(contexts)))
                waiting += len(n)
                if waiting > 4_000_000:  # what came in pieces is added up before more is read
                    pieces, waiting = [_merged(pieces)], 0
        if pieces:
            del keys, n, words, contexts
            yield done()
            give_back()

    small_batches(rows.sparkSession)
    parts = rows.select("text", "held_out").mapInArrow(count, "bucket long, counts binary")
    dealt = parts.repartition("bucket").sortWithinPartitions("bucket")
    return scratch.table("counts", dealt.mapInArrow(
        combine, "bucket long, tokens long, words long, counts binary, few binary"))


# ---- numbers of tables ---------------------------------------------------------------------

TABLED = 256  # rows of up to so many customers draw from exact weights
_NODES = 32


def _log_seatings(discount: float) -> np.ndarray:
    """Log of the summed weights of all seatings of n customers at t tables, at [n, t]; a table of
    s customers weighs (1 - d)(2 - d)...(s - 1 - d)."""
    out = np.full((TABLED + 1, TABLED + 1), -np.inf)
    out[0, 0] = 0
    tables = np.arange(1, TABLED + 1)
    for n in range(TABLED):
        joins = np.log(np.maximum(n - discount * tables, 1e-300))
        out[n + 1, 1:] = np.logaddexp(out[n, :-1], np.where(tables <= n, out[n, 1:] + joins, -np.inf))
    return out


def table_moments(customers: np.ndarray, new_weight: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and variance of the number of tables of many customers.

    Tables are the jumps of a compound Poisson law: t tables weigh [x^c] of
    (l f)^t / t! with l = new_weight / d and f = 1 - (1 - x)^d.  So the factorial moments are
    ratios of the c-th coefficients of (l f)^k exp(l f), taken by the trapezoid rule on a parabola
    x = exp(-m (1 + iu)^2) through the saddle point or, for small l, at the scale of 1 / c.
    """
    c, rate = customers.astype(float), new_weight / discount
    low, high = np.full(len(c), -45.0), np.full(len(c), 5.0)
    for _ in range(24):  # the saddle point: c = l d x (1 - x)^(d - 1) at x = exp(-s)
        middle = (low + high) / 2
        s = np.exp(middle)
        above = np.log(rate * discount) + (discount - 1) * np.log(-np.expm1(-s)) - s > np.log(c)
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    m = np.maximum(np.exp(low), 8 / c)
    reach = np.minimum(6.5 / np.sqrt(min(0.6, 2 - 2 * discount) * m * c), np.pi / (2 * m))
    sums = np.zeros((3, len(c)))
    # exp(-l y) falls out of all ratios at the saddle, which keeps numbers in range.
    level = rate * (-np.expm1(-m)) ** discount
    for k in range(_NODES + 1):
        u = reach * k / _NODES
        s = m * (1 + 1j * u) ** 2
        y = (1 - np.exp(-s)) ** discount
        scale = np.exp((s - m) * c) * (1 + 1j * u) * (0.5 if k == 0 else 1)
        bent, flat = np.exp(level - rate * y), np.exp(np.minimum(level, 1))
        # The constant terms have no c-th coefficient and are left out where they would drown the rest.
        near = level < 1
        bent_less = np.where(near, np.expm1(np.where(near, -rate * y, 0)) * np.where(near, flat, 1), bent)
        for power, factor in enumerate((0 * y, -y, y * y - 2 * y)):
            sums[power] += (scale * (bent_less + factor * bent)).real
    first, second = rate * sums[1] / sums[0], rate ** 2 * sums[2] / sums[0]
    return first, second + first - first ** 2


def draw_tables(customers: np.ndarray, new_weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Numbers of tables of whole rows, given their customers and the weights of a new table.

    Up to ``TABLED`` customers the draw is from the exact weights.  Beyond, one table is sure and the
    others are drawn from the binomial (Poisson, where it is no narrower) of their exact mean and
    variance, which is the limit for few tables as for many.
    """
    out = np.minimum(customers, 1)
    log = per_process(("hpylm seatings", discount), lambda: _log_seatings(discount))
    rows = np.flatnonzero((customers > 1) & (customers <= TABLED))
    for at in range(0, len(rows), 4096):
        some = rows[at:at + 4096]
        weight = log[customers[some]] + np.arange(TABLED + 1) * np.log(new_weight[some])[:, None]
        weight = np.exp(weight - weight.max(axis=1, keepdims=True)).cumsum(axis=1)
        out[some] = (weight < rng.random(len(some))[:, None] * weight[:, -1:]).sum(axis=1)
    rows = np.flatnonzero(customers > TABLED)
    if len(rows):
        mean, variance = table_moments(customers[rows], new_weight[rows], discount)
        mean = np.clip(mean - 1, 0, customers[rows] - 1)
        share = 1 - variance / np.maximum(mean, 1e-12)
        narrow = share > 1e-6
        trials = np.maximum(np.round(mean / np.where(narrow, share, 1)), np.ceil(mean)).astype(np.int64)
        drawn = np.where(narrow, rng.binomial(trials, np.clip(mean / np.maximum(trials, 1), 0, 1)), rng.poisson(mean))
        out[rows] = np.minimum(1 + drawn, customers[rows])
    return out


# ---- seating -------------------------------------------------------------------------------

FEW = 64  # rows with room for more customers are held as numbers


@dataclass
class Totals:
    """Customers and tables of every restaurant, by level (0 is the root), after one sweep."""

    customers: list[np.ndarray]
    tables: list[np.ndarray]


@dataclass
class Settings:
    discount: list[float]
    strength: list[float]
    base: float
    sweeps: int
    burn_in: int
    history: list[Totals] = field(default_factory=list)

    @property
    def kept(self) -> range:
        """States over which scores are averaged."""
        return range(min(self.burn_in + 1, self.sweeps), self.sweeps + 1)


class Seating:
    """Tables of many (word, restaurant) rows; a step acts on at most one customer of a row.

    ``at[i]`` is the table of customer i and ``size[k]`` the customers of table k; a row's
    customers and its table names lie in its own stretch of both arrays.  Rows with room for more
    than ``FEW`` customers have no stretch: their numbers of customers and tables are all they are.
    """

    def __init__(self, room: np.ndarray):
        own = np.where(room > FEW, 0, room)
        self.offset = own.cumsum() - own
        self.room = room
        self.many = room > FEW
        self.customers = np.zeros(len(room), np.int64)
        self.tables = np.zeros(len(room), np.int64)
        self.at = np.zeros(int(own.sum()), np.int32)
        self.size = np.zeros(int(own.sum()), np.int32)

    def start(self, customers: np.ndarray, discount: float) -> None:
        """Seat all customers at about customers**discount / 2 tables, evenly."""
        self.customers = customers.astype(np.int64)
        self.tables = np.minimum(self.customers, 1)
        self.size[self.offset[(self.customers > 0) & ~self.many]] = 1
        rows = np.flatnonzero(self.customers > 1)
        n = self.customers[rows]
        self.tables[rows] = np.clip(np.round(n ** discount / 2), 1, n).astype(np.int64)
        rows = rows[~self.many[rows]]
        n, tables = self.customers[rows], self.tables[rows]
        nth = np.arange(n.sum()) - np.repeat(n.cumsum() - n, n)
        first, table = np.repeat(self.offset[rows], n), nth % np.repeat(tables, n)
        self.at[first + nth] = table
        own = np.arange(tables.sum()) - np.repeat(tables.cumsum() - tables, tables)
        even, rest = np.repeat(n // tables, tables), np.repeat(n % tables, tables)
        self.size[np.repeat(self.offset[rows], tables) + own] = even + (own < rest)

    def leave(self, rows: np.ndarray, rng: np.random.Generator, nth: int | None = None) -> None:
        """One customer leaves each row: the one in this place (-1 is the last), else one at random."""
        first, n = self.offset[rows], self.customers[rows]
        if nth is None:
            seat = first + (rng.random(len(rows)) * n).astype(np.int64)
        else:
            seat = first + (nth if nth >= 0 else n + nth)
        table = first + self.at[seat]
        self.at[seat] = self.at[first + n - 1]
        self.customers[rows] = n - 1
        self.size[table] -= 1
        self.tables[rows] -= self.size[table] == 0

    def enter(self, rows: np.ndarray, new_weight: np.ndarray, discount: float, rng: np.random.Generator) -> None:
        """One customer enters each row: a new table by ``new_weight``, an old one by its size less the discount."""
        first, n = self.offset[rows], self.customers[rows]
        old = n - discount * self.tables[rows]
        opens = rng.random(len(rows)) * (old + new_weight) >= old
        table = np.empty(len(rows), np.int64)
        todo = np.flatnonzero(~opens)
        while len(todo):  # a random customer's table, taken with probability (size - discount) / size
            tried = first[todo] + self.at[first[todo] + (rng.random(len(todo)) * n[todo]).astype(np.int64)]
            size = self.size[tried]
            taken = rng.random(len(todo)) * size < size - discount
            table[todo[taken]] = tried[taken]
            todo = todo[~taken]
        todo = np.flatnonzero(opens)
        while len(todo):  # a free table name
            tried = first[todo] + (rng.random(len(todo)) * self.room[rows[todo]]).astype(np.int64)
            free = self.size[tried] == 0
            table[todo[free]] = tried[free]
            todo = todo[~free]
        self.at[first + n] = table - first
        self.size[table] += 1
        self.customers[rows] = n + 1
        self.tables[rows] += opens

    def follow(self, wanted: np.ndarray, new_weight: np.ndarray, discount: float, rng: np.random.Generator) -> None:
        """Let customers in and out until each row has as many as its children have tables."""
        self.customers[self.many] = wanted[self.many]
        self.tables[self.many] = np.minimum(self.tables[self.many], wanted[self.many])
        change = wanted - self.customers
        for sign, rows in ((1, np.flatnonzero(change > 0)), (-1, np.flatnonzero(change < 0))):
            left = np.abs(change[rows])
            while len(rows):
                if sign > 0:
                    self.enter(rows, new_weight[rows], discount, rng)
                else:
                    self.leave(rows, rng)
                left = left - 1
                rows, left = rows[left > 0], left[left > 0]

    def sweep(self, new_weight: np.ndarray, discount: float, rng: np.random.Generator) -> None:
        """Reseat every customer."""
        rows = np.flatnonzero((self.customers > 1) & ~self.many)
        nth = -1  # the last one first: the place of who leaves goes to the last, who is then a reseated one
        while len(rows):
            self.leave(rows, rng, nth)
            self.enter(rows, new_weight[rows], discount, rng)
            nth += 1
            rows = rows[self.customers[rows] > nth + 1]
        rows = np.flatnonzero(self.many)
        self.tables[rows] = draw_tables(self.customers[rows], new_weight[rows], discount, rng)


def _distinct(ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, and each value's place among them."""
    new = np.ones(len(ascending), bool)
    new[1:] = ascending[1:] != ascending[:-1]
    return ascending[new], new.cumsum() - 1


class Bucket:
    """The words of one bucket in all restaurants."""

    def __init__(self, number: int, blob: bytes, settings: Settings, seated: bool = True):
        step, counts, *dictionary = unpack(blob)
        self.number, self.settings = number, settings
        leaf = _sums(step)
        del step
        middle, above = _distinct(leaf & ~_PLACE)
        root, top = _distinct(middle & ~_LOW)
        self.keys = [root, middle, leaf]
        if len(dictionary) == 2:  # words and contexts of all rows, those of no training row too
            self.words, self.own_contexts = map(_sums, dictionary)
            self.contexts, context = numbers(self.own_contexts), (leaf & _PLACE).astype(np.int64)
        elif dictionary:  # contexts that sweeps ask for; all others, which have numbers below, are one last place
            self.own_contexts = _sums(dictionary[0])
            self.contexts = np.append(numbers(self.own_contexts) + _ASKED, _LOW)
            context = np.minimum((leaf & _PLACE) - _ASKED, _U(len(self.own_contexts))).astype(np.int64)
        else:
            self.contexts, context = np.unique(leaf & _LOW, return_inverse=True)
        self.place = [np.zeros(len(root), np.int64), (middle & _LOW).astype(np.int64) >> PARENT_SHIFT, context]
        self.parent = [None, top, above]
        self.counts = counts = counts.astype(np.int64)
        self.word_count = np.bincount(top[above], weights=counts, minlength=len(root)).astype(np.int64)
        if not seated:
            return
        self.levels: list[Seating] = [None, None, None]
        room = counts
        for level in (2, 1, 0):
            self.levels[level] = Seating(room.astype(np.int64))
            if level:
                room = np.bincount(self.parent[level], weights=room, minlength=len(self.keys[level - 1])).astype(np.int64)
        customers = counts
        for level in (2, 1, 0):
            self.levels[level].start(customers, settings.discount[level])
            if level:
                customers = self._tables_below(level - 1)

    def _tables_below(self, level: int) -> np.ndarray:
        below = self.levels[level + 1].tables
        return np.bincount(self.parent[level + 1], weights=below, minlength=len(self.keys[level])).astype(np.int64)

    def _above(self, level: int, totals: Totals) -> np.ndarray:
        """Probability of each row's word in the parent restaurant."""
        if level == 0:
            return np.full(len(self.keys[0]), self.settings.base)
        return self.probability(level - 1, totals)[self.parent[level]]

    def probability(self, level: int, totals: Totals) -> np.ndarray:
        s, seats, at = self.settings, self.levels[level], self.place[level]
        d, theta = s.discount[level], s.strength[level]
        spare = (theta + d * totals.tables[level][at]) * self._above(level, totals)
        return (seats.customers - d * seats.tables + spare) / (theta + totals.customers[level][at])

    def sweep(self, totals: Totals, nth: int) -> None:
        rng = np.random.default_rng([self.number, nth])
        s = self.settings
        for level in (2, 1, 0):
            # A leaf of one customer has one table, whatever the weight.
            some = np.flatnonzero(self.counts > 1) if level == 2 else slice(None)
            above = self.probability(1, totals)[self.parent[2][some]] if level == 2 else self._above(level, totals)
            weight = np.zeros(len(self.keys[level]))
            weight[some] = (s.strength[level] + s.discount[level] * totals.tables[level][self.place[level][some]]) * above
            if level < 2:
                self.levels[level].follow(self._tables_below(level), weight, s.discount[level], rng)
            self.levels[level].sweep(weight, s.discount[level], rng)

    def states(self, upto: int) -> Iterator[int]:
        """Replay: state 0 is the start; state i follows sweep i under the totals of state i - 1."""
        yield 0
        for i in range(1, upto + 1):
            self.sweep(self.settings.history[i - 1], i)
            yield i


def _bits(level: int) -> int:
    """Bits of a restaurant's number where it is the same in all buckets; each bucket numbers its contexts."""
    return (0, PARENT_BITS, 0)[level]


# ---- totals --------------------------------------------------------------------------------

_SHARE = "level int, place int, customers long, tables long, part long, bucket long, asks int, blob binary"
# A share of contexts' totals asks for no sums, for sweeps', or for scores'; beside them, tables of the kept states.
_NONE, _SWEEPS, _SCORES, _STATES = -1, 0, 1, 2
_SENT = "bucket long, asks int, state int, part long, blob binary"


def _share(part: int | None, bucket: int, asks: int, blob: bytes) -> pa.RecordBatch:
    schema = [("level", pa.int32()), ("place", pa.int32()), ("customers", pa.int64()), ("tables", pa.int64()),
              ("part", pa.int64()), ("bucket", pa.int64()), ("asks", pa.int32()), ("blob", pa.binary())]
    return pa.RecordBatch.from_pylist([{"part": part, "bucket": bucket, "asks": asks, "blob": blob}], pa.schema(schema))


def _shares(bucket: int, asks: int, contexts: np.ndarray, columns: list[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    """A bucket's shares of its contexts' totals, for each part of the contexts."""
    for part, at in _split(bucket_of(contexts, parts)):
        yield _share(part, bucket, asks, pack(_steps(contexts[at]), *[c[at].astype(np.int64) for c in columns]))


def _upper_shares(bucket: Bucket) -> Iterator[pa.RecordBatch]:
    for level in (0, 1):
        seats, n = bucket.levels[level], 1 << _bits(level)
        customers, tables = (np.bincount(bucket.place[level], weights=x, minlength=n).astype(np.int64)
                             for x in (seats.customers, seats.tables))
        at = np.flatnonzero(customers)
        none = [pa.nulls(len(at), t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), level), pa.int32()), pa.array(at, pa.int32()), pa.array(customers[at]),
             pa.array(tables[at]), *none],
            ["level", "place", "customers", "tables", "part", "bucket", "asks", "blob"])


def _tables_of(bucket: Bucket, some: np.ndarray) -> np.ndarray:
    """Tables in each context of the bucket, in these rows."""
    return np.bincount(bucket.place[2][some], weights=bucket.levels[2].tables[some], minlength=len(bucket.contexts))


def _grouped(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[int, list[dict]]]:
    now, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row[name] != now:
                if held:
                    yield now, held
                now, held = row[name], []
            held.append(row)
    if held:
        yield now, held


def _sent(rows: list[dict], asks: int, contexts: np.ndarray, parts: int) -> dict[int, list[np.ndarray]]:
    """Sums by state, in the order of the contexts that were asked for."""
    at, out = dict(_split(bucket_of(contexts, parts))), {}
    for row in rows:
        if row["asks"] == asks:
            columns = unpack(row["blob"])
            found = out.setdefault(row["state"], [np.zeros(len(contexts)) for _ in columns])
            for total, column in zip(found, columns, strict=True):
                total[at[row["part"]]] = column
    return out


def _tables_asked(rows: list[dict], contexts: np.ndarray, parts: int) -> list[np.ndarray]:
    """Tables of the contexts that sweeps ask for, by state.

    State 0 comes as customers, tables of pairs that occur once, and other tables; later ones as other tables.
    """
    sent = _sent(rows, _SWEEPS, contexts, parts)
    if not len(contexts):
        return []
    return [sent[0][1] + sent[state][-1] for state in sorted(sent)]


def _started(counts: DataFrame, settings: Settings, parts: int) -> DataFrame:
    """Shares of state 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column("bucket").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                bucket = Bucket(number, blob, settings)
                yield from _upper_shares(bucket)
                n = len(bucket.contexts)
                columns = [np.bincount(bucket.place[2], weights=bucket.counts, minlength=n),
                           np.bincount(bucket.place[2], weights=bucket.counts == 1, minlength=n),
                           _tables_of(bucket, bucket.counts > 1)]
                yield from _shares(number, _SCORES, bucket.own_contexts, columns, parts)
                asked = bucket.own_contexts[_asked(bucket.keys[2], bucket.counts)]
                del bucket, columns  # before the next bucket is seated
                yield from _shares(number, _SWEEPS, asked, [np.zeros(len(asked))] * 3, parts)
                give_back()

    return counts.select("bucket", "counts").mapInArrow(run, _SHARE)


def _swept(counts: DataFrame, sent: list[DataFrame], settings: Settings, parts: int) -> DataFrame:
    """Shares of the state after as many sweeps as there are totals; after the last, of all states that scores need."""
    upto = len(sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _grouped(batches, "bucket"):
            bucket, history = Bucket(number, rows.pop(0)["blob"], settings), []
            contexts = bucket.own_contexts
            for upper, found in zip(settings.history, _tables_asked(rows, contexts, parts) or [np.zeros(0)] * upto, strict=True):
                history.append(Totals(upper.customers, [*upper.tables, np.append(found, 0)]))
            rows.clear()
            bucket.settings = replace(settings, history=history)
            columns, tables, more = [], [], bucket.counts > 1
            for state in bucket.states(upto):
                if state == upto or upto == settings.sweeps and state in settings.kept:
                    columns.append(_tables_of(bucket, more)[:-1])
                    tables += [bucket.levels[0].tables.copy(), bucket.levels[1].tables.copy(), bucket.levels[2].tables[more]]
            yield from _upper_shares(bucket)
            del bucket, history, found, more  # before the next bucket's rows are read
            yield from _shares(number, _SWEEPS if upto < settings.sweeps else _NONE, contexts, columns, parts)
            if upto == settings.sweeps:
                yield _share(None, number, _STATES, pack(*tables))
            del contexts, columns, tables
            give_back()

    none = [F.lit(-1).alias("asks"), F.lit(-1).alias("state"), F.lit(-1).cast("long").alias("part")]
    rows = counts.select("bucket", *none, F.col("few").alias("blob"))
    for df in sent:
        rows = rows.union(df.where(F.col("asks") == _SWEEPS))
    return rows.repartition("bucket").sortWithinPartitions("bucket", "state").mapInArrow(run, _SHARE)


def _asking(counts: DataFrame, columns: int, parts: int) -> DataFrame:
    """Shares of nothing that ask for the sums that scores need."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column("bucket").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                contexts = _sums(unpack(blob)[3])
                yield from _shares(number, _SCORES, contexts, [np.zeros(len(contexts))] * columns, parts)

    return counts.select("bucket", "counts").mapInArrow(run, _SHARE)


def _context_sums(shares: DataFrame, state: int) -> DataFrame:
    """Shares of each part of the contexts are added up; every bucket that asks gets the sums of its contexts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _grouped(batches, "part"):
            blobs = [unpack(row["blob"]) for row in rows]
            _, at = np.unique(np.concatenate([_sums(b[0]) for b in blobs]), return_inverse=True)
            sums = [np.bincount(at, weights=np.concatenate(c)).astype(np.int64)
                    for c in zip(*(b[1:] for b in blobs), strict=True)]
            stop = np.cumsum([len(b[0]) for b in blobs])
            for row, own in zip(rows, np.split(at, stop[:-1]), strict=True):
                if row["asks"] != _NONE:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["bucket"]], pa.int64()), pa.array([row["asks"]], pa.int32()),
                         pa.array([state], pa.int32()), pa.array([part], pa.int64()),
                         pa.array([pack(*[x[own] for x in sums])], pa.binary())],
                        ["bucket", "asks", "state", "part", "blob"])
            del rows, blobs, at, sums, own
            give_back()

    return (shares.where(F.col("part").isNotNull()).select("part", "bucket", "asks", "blob")
            .repartition("part").sortWithinPartitions("part").mapInArrow(run, _SENT))


def _upper_totals(shares: DataFrame) -> Totals:
    """Totals of the root and the parents: one row for each reaches the driver; those of contexts stay in Spark."""
    out = Totals([np.zeros(1 << _bits(x)) for x in (0, 1)], [np.zeros(1 << _bits(x)) for x in (0, 1)])
    sums = shares.where(F.col("level").isNotNull()).groupBy("level", "place").agg(F.sum("customers"), F.sum("tables"))
    for level, place, customers, tables in sums.collect():
        out.customers[level][place], out.tables[level][place] = customers, tables
    return out


def learn(counts: DataFrame, settings: Settings, parts: int, scratch: Scratch) -> list[DataFrame]:
    """Sweeps: the upper totals of every state go to ``settings.history``; returned is what scores need,
    the sums that parts of the contexts sent to buckets and the buckets' tables in the kept states."""
    sent, states = [], []
    for state in range(settings.sweeps + 1):
        shares = scratch.table(f"shares{state}", _swept(counts, sent, settings, parts) if state else
                               _started(counts, settings, parts))
        settings.history.append(_upper_totals(shares))
        last = state and state == settings.sweeps
        if last:
            states = [shares.where(F.col("asks") == _STATES).select("bucket", "asks", F.lit(state).alias("state"), "part", "blob")]
            shares = shares.union(_asking(counts, len(settings.kept), parts))
        sent.append(scratch.table(f"sent{state}", _context_sums(shares, state)))
        if not last:
            scratch.drop(f"shares{state}")
    return [*(df.where(F.col("asks") == _SCORES) for df in sent), *states]


class Scorer:
    """Averaged log10 probabilities of (word, context) keys of one bucket."""

    def __init__(self, bucket: Bucket, settings: Settings, kept: list[tuple] | None = None):
        """``kept``: totals, customers and tables of the kept states; without it they are replayed."""
        self.settings, self.bucket, self.kept = settings, bucket, kept
        if kept is None:
            self.kept = [(settings.history[state], [s.customers.copy() for s in bucket.levels],
                          [s.tables.copy() for s in bucket.levels])
                         for state in bucket.states(settings.sweeps) if state in settings.kept]
            bucket.levels = []

    @staticmethod
    def _found(own: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(own, wanted)
        hit = np.flatnonzero(at < len(own))
        hit = hit[own[at[hit]] == wanted[hit]]
        return hit, at[hit]

    def log10(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log probability, and training count of the word, for each key."""
        s = self.settings
        by_level = [keys & ~_LOW, keys & ~_PLACE, keys]
        found = [self._found(own, k) for own, k in zip(self.bucket.keys, by_level, strict=True)]
        parent = ((keys & _LOW) >> _U(PARENT_SHIFT)).astype(np.int64)
        every = np.arange(len(keys))
        place = [(every, np.zeros(len(keys), np.int64)), (every, parent), self._found(self.bucket.contexts, keys & _LOW)]
        mean = np.zeros(len(keys))
        for totals, customers, tables in self.kept:
            p = np.full(len(keys), s.base)
            for level in range(3):
                d, theta = s.discount[level], s.strength[level]
                own, spare, all_customers = np.zeros(len(keys)), np.full(len(keys), theta), np.full(len(keys), theta)
                hit, at = found[level]
                own[hit] = customers[level][at] - d * tables[level][at]
                hit, at = place[level]
                spare[hit] += d * totals.tables[level][at]
                all_customers[hit] += totals.customers[level][at]
                p = (own + spare * p) / all_customers
            mean += p / len(self.kept)
        count = np.zeros(len(keys), np.int64)
        count[found[0][0]] = self.bucket.word_count[found[0][1]]
        return np.log10(mean), count


def _scorer(number: int, rows: list[dict], settings: Settings, parts: int) -> Scorer:
    """A bucket's model from its counts and all that parts of the contexts sent to it."""
    bucket = Bucket(number, rows[0]["blob"], settings, seated=not settings.sweeps)
    scores = _sent(rows[1:], _SCORES, bucket.own_contexts, parts)
    customers, once, first = scores[0]

    def totals(state: int, found: np.ndarray) -> Totals:
        upper = settings.history[state]
        return Totals([*upper.customers, customers], [*upper.tables, once + found])

    if not settings.sweeps:
        bucket.settings = replace(settings, history=[totals(0, first)])
        return Scorer(bucket, bucket.settings)
    found = iter(unpack(next(row["blob"] for row in rows if row["asks"] == _STATES)))
    kept = []
    for state, column in zip(settings.kept, scores[settings.sweeps], strict=True):
        tables = [next(found), next(found), np.ones(len(bucket.counts), np.int64)]
        tables[2][bucket.counts > 1] = next(found)
        below = [np.bincount(bucket.parent[x + 1], weights=tables[x + 1], minlength=len(tables[x])) for x in (0, 1)]
        kept.append((totals(state, column), [*below, bucket.counts], tables))
    return Scorer(bucket, settings, kept)


# ---- scoring -------------------------------------------------------------------------------

_PART = ("block long, kind int, bucket long, copy int, asks int, state int, part long, blob binary, "
         "doc_ids array<long>, held array<boolean>")
_NAMES = ["block", "kind", "bucket", "copy", "asks", "state", "part", "blob", "doc_ids", "held"]
_COUNTS, _TOTALS, _TOKENS, _DOCS = 0, 1, 2, 3


def _part(block: int, kind: int, bucket: int, copy: int, blob: bytes, ids=None, held=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([kind], pa.int32()), pa.array([bucket], pa.int64()),
         pa.array([copy], pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()),
         pa.array([blob], pa.binary()), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_()))],
        _NAMES)


def _token_blocks(docs: DataFrame, buckets: int, copies: dict[int, int]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = TaskContext.get().partitionId() << 32
        for block in _collected(batches, ("doc_id", "held_out")):
            sizes, ids, held = block[2:]
            doc = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
            for bucket, keys, n, at, words, contexts in _dealt(block, buckets):
                # Documents stay in order within a key.
                blob = pack(_steps(keys), n.astype(np.uint32), doc[at], _steps(words), _steps(contexts))
                yield _part(nth, _TOKENS, bucket, nth % 7919 % copies.get(bucket, 1), blob)
            # Sizes and ids travel under a number of their own: negative, so it is no bucket.
            yield _part(nth, _DOCS, -1 - nth, 0, pack(sizes), ids, held)
            nth += 1
            del block, doc, keys, n, at, words, contexts, blob  # before the next block is read

    return docs.mapInArrow(run, _PART)


def _partial_scores(settings: Settings, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, model, scorer = None, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == _DOCS:
                    yield _part(row["block"], _DOCS, 0, 0, row["blob"], row["doc_ids"], row["held"])
                    continue
                if (row["bucket"], row["copy"]) != now:
                    now, model, scorer = (row["bucket"], row["copy"]), [], None
                    give_back()
                if row["kind"] != _TOKENS:
                    model.append(row)
                else:
                    if scorer is None:
                        scorer, model = _scorer(row["bucket"], model, settings, parts), []
                    step, n, doc, *own = unpack(row["blob"])
                    keys = _renumbered(_sums(step), tuple(map(_sums, own)), scorer.bucket.words, scorer.bucket.own_contexts)
                    log, count = scorer.log10(keys)
                    docs, inverse = np.unique(doc, return_inverse=True)
                    sums = [np.bincount(inverse, weights=np.repeat(x, n), minlength=len(docs))
                            for x in (log, np.log10(count + 1.0), count > 0)]
                    blob = pack(docs, sums[0], sums[1], sums[2].astype(np.uint32))
                    yield _part(row["block"], _TOKENS, 0, 0, blob)
        model, scorer = [], None
        step = n = doc = own = keys = log = count = docs = inverse = sums = None
        give_back()

    return run


def _per_document(settings: Settings, train_tokens: int):
    offset = math.log10(train_tokens + 1 / settings.base)  # the base's share is 1 / (words + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums, ids, held, sizes = None, None, None, None, None

        def done() -> pa.RecordBatch:
            log, base, known = sums
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(sizes, pa.int64()),
                 pa.array(known.astype(np.int64)), pa.array(np.full(len(sizes), train_tokens), pa.int64()),
                 pa.array(base - sizes * offset), pa.array(log)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != now:
                    if now is not None:
                        yield done()
                    now, ids, held, (sizes,) = row["block"], row["doc_ids"], row["held"], unpack(row["blob"])
                    sums = [np.zeros(len(sizes)) for _ in range(3)]
                    continue
                docs, *parts = unpack(row["blob"])
                for total, part in zip(sums, parts, strict=True):
                    total[docs] += part
        if now is not None:
            yield done()

    return run


def score(docs: DataFrame, held_out: Column, sweeps: int = 3, burn_in: int = 1,
          bucket_tokens: int = 5_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row.

    The model learns from rows whose ``held_out`` (a boolean column of ``docs``) is not true.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "hpylm")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(chars / (5 * bucket_tokens)))
    counts = training_counts(rows, buckets, scratch)
    n, words = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    settings = Settings([0.5, 0.6, 0.7], [1.0, 1.0, 1.0], 1 / (words + 1), sweeps, burn_in)
    sent = learn(counts, settings, buckets, scratch)
    # Only buckets far above their share, which a few very frequent words make, have copies.
    copies = {r["bucket"]: math.ceil(r["tokens"] / (2 * bucket_tokens)) for r in
              counts.where(F.col("tokens") > 4 * bucket_tokens).select("bucket", "tokens").collect()}
    number = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in copies.items() for x in kv]), F.col("bucket"))
                        if copies else F.lit(None).cast("int"), F.lit(1))
    none = {"doc_ids": "array<long>", "held": "array<boolean>"}
    model = counts.select("bucket", F.lit(None).cast("int").alias("asks"), F.lit(None).cast("int").alias("state"),
                          F.lit(None).cast("long").alias("part"), F.col("counts").alias("blob"), F.lit(_COUNTS).alias("kind"))
    for df in sent:
        model = model.union(df.select("*", F.lit(_TOTALS)))
    model = model.select(
        F.lit(0).cast("long").alias("block"), "kind", "bucket",
        F.explode(F.sequence(F.lit(0), (number - 1).cast("int"))).alias("copy"), "asks", "state", "part", "blob",
        *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    met = (model.union(_token_blocks(rows, buckets, copies)).repartition("bucket", "copy")
           .sortWithinPartitions("bucket", "copy", "kind"))
    partial = met.mapInArrow(_partial_scores(settings, buckets), _PART)
    return (partial.repartition("block").sortWithinPartitions("block", F.desc("kind"))
            .mapInArrow(_per_document(settings, int(n)), "doc_id long, held_out boolean, n_tokens long, n_known long, "
                        "train_tokens long, base_score double, score double"))
