"""Byte-level BPE by dynamic programming over prefixes.

The BPE encoding of a byte string has, for each of its prefixes, one last token, and it does not
change when the string grows.  So a left-to-right pass finds, for each prefix, the vocabulary
entries that end there (an automaton with suffix links reports them all) and takes the one that
is compatible with the last token of the prefix before it.  Following the stored tokens back from
the end gives the ids; no merge is ever replayed on the text.

Two tokens are compatible if BPE, run on their joined bytes, gives just these two: no merge
across their border may come before the merges that build the tokens beside it.  That is read off
the two tokens' own merge histories along the border.

Texts are cut into pre-tokens by the tokenizer's pattern first, and the ids of pre-tokens seen
before are kept in a dictionary of bounded size.

Defined results: a null text is empty and has no ids; added special tokens that stand in a text
get their own ids, as the tokenizers library does by default; repeated rows each have their row; very
long texts are encoded whole; no rows give no rows; columns beside the two named are not read, whatever
their names.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Known, per_process, rows_of, small_batches, texts

# The pre-token pattern of byte-level BPE and Unicode's White_Space characters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
SPACE = r"\t-\r \x85\xa0  -     　"
LETTER = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
# Every pre-token lies within one of these: a whole run of common letters, which is one itself,
# or a run between white space, each with the blank before it, or white space.
CHUNK = (rf" ?[{LETTER}]+(?=[{SPACE}!-@\[-`{{-~]|$)| ?[^{SPACE}]+"
         rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")

KEPT_ENTRIES, KEPT_PAIRS = 200_000, 400_000
NEVER = 1 << 62


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file, and its byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merge order and matching automaton of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec["pre_tokenizer"]
        if spec["normalizer"] or steps["type"] != "ByteLevel" or steps["add_prefix_space"] or not steps["use_regex"]:
            raise ValueError("only plain byte-level BPE files are supported")
        letter = byte_letters()
        of = {k: bytes(letter[c] for c in k) for k in spec["model"]["vocab"]}
        self.id = {of[k]: i for k, i in spec["model"]["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = 1 + max([*self.id.values(), *self.special.values()])
        self.bytes: list[bytes] = [b""] * size
        for data, i in self.id.items():
            self.bytes[i] = data
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for order, merge in enumerate(spec["model"]["merges"]):
            left, right = (merge.split(" ") if isinstance(merge, str) else merge)
            a, b = self.id[of[left]], self.id[of[right]]
            self.rank.setdefault((a, b), order)
            self.made.setdefault(self.id[of[left] + of[right]], (order, a, b))
        self.automaton = ahocorasick.Automaton()
        for data, i in self.id.items():
            if len(data) == 1 or i in self.made:
                self.automaton.add_word(data.decode("latin-1"), (i, len(data)))
        self.automaton.make_automaton()
        self._edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self._fits: dict[int, bool] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Pieces at a token's left (0) or right (1) end as it is built, each with the order of
        the merge that takes it up next."""
        found = self._edges.get((token, side))
        if found is None:
            found, until, piece = [], NEVER, token
            while True:
                found.append((piece, until))
                if piece not in self.made:
                    break
                until = self.made[piece][0]
                piece = self.made[piece][1 + side]
            found.reverse()
            self._edges[token, side] = found
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether BPE keeps the border between two adjoining tokens."""
        lefts, rights = iter(self.edge(left, 1)), iter(self.edge(right, 0))
        (x, x_until), (y, y_until) = next(lefts), next(rights)
        while True:
            order = self.rank.get((x, y), NEVER)
            # Of merges of one order the leftmost comes first.
            if order < x_until and order <= y_until:
                return False
            if x_until == y_until == NEVER:
                return True
            if x_until <= y_until:
                x, x_until = next(lefts)
            else:
                y, y_until = next(rights)

    def piece(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        last = [-1] * (len(data) + 1)
        width = last[:]
        known, get = self._fits, self._fits.get
        for end, (token, n) in self.automaton.iter(data.decode("latin-1")):
            end += 1
            if last[end] < 0:
                if end > n:
                    before = last[end - n]
                    if before < 0:
                        continue
                    pair = before << 20 | token
                    fit = get(pair)
                    if fit is None:
                        if len(known) >= KEPT_PAIRS:
                            known.clear()
                        fit = known[pair] = self.fits(before, token)
                    if not fit:
                        continue
                last[end], width[end] = token, n
        out, at = [], len(data)
        while at:
            out.append(last[at])
            at -= width[at]
        out.reverse()
        return out


class Encoder:
    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.find = regex.compile(PATTERN).findall
        self.chunks = re.compile(CHUNK).findall
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.known = Known(KEPT_ENTRIES, self._ids_of_chunk)

    def ids_of(self, text: str) -> bytes:
        """Ids of a stretch without special tokens, as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.known.__getitem__, self.chunks(text)))

    def _ids_of_chunk(self, chunk: str) -> bytes:
        pieces = self.find(chunk)
        if len(pieces) == 1:
            return array("I", self.vocabulary.piece(chunk.encode())).tobytes()
        return b"".join(map(self.ids_of, pieces))

    def encode(self, text: str) -> bytes:
        if self.marks is None or not self.marks.search(text):
            return self.ids_of(text)
        special = self.vocabulary.special
        return b"".join(array("I", [special[x]]).tobytes() if x in special else self.ids_of(x)
                        for x in self.marks.split(text))

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.vocabulary.bytes.__getitem__, array("I", ids))).decode("utf-8", "replace")


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: ids as little-endian unsigned 32-bit integers, and the
    text that they decode to.  ``vocabulary`` is the file's path on every executor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(("bpe", vocabulary), lambda: Encoder(vocabulary))
        for batch, raws in rows_of(batches):
            ids = [encoder.encode(x.decode("utf-8", "replace")) for x in raws]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array(ids, pa.binary()), pa.array([encoder.decode(x) for x in ids], pa.string())],
                ["doc_id", "n_tokens", "ids", "decoded"])

    small_batches(docs.sparkSession)
    return texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, decoded string")
