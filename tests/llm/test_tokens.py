import random
import zlib
from array import array
from glob import glob

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from llm_rows import ODD, by_row
from tokenizers import Tokenizer

from marginflow.llm import tokens
from marginflow.llm.common import Scratch, read

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


def test_stretches_equal_whole_texts(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_ENTRIES", 40)
    rng, theirs = random.Random(2), library()
    letters = "aabcdee   \n\t '''stremSTR.,!?0189éèüßñ中😀\x85\xa0 \x1c\x00İḴ́ªº²½٣Σς̱́HIK"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["a <|endoftext|> b", "x<|startoftext|>y", "<|STARTOFTEXT|>"]
    mine = tokens.Stretches(PATH)
    texts += ["\u212bngstr\u00d6m### \u00c9\u00e9$$$ \u0130x%% a\u0301*** \u1e9e!! \u00d7## x'### \u01c4!", "ABC&&&abc 9%%%\u00e9'S!!"]
    end = array("I", [1]).tobytes()
    for at in range(0, len(texts), 500):
        some = texts[at:at + 500]
        ids, edges = mine.encode(pa.array([None, *some, ""]), end)
        assert ids[:1].tolist() == [1] and ids[edges[-2]:].tolist() == [1]
        for text, a, b in zip(some, edges[1:].tolist(), edges[2:].tolist(), strict=False):
            assert ids[a:b].tolist() == [*theirs.encode(text, add_special_tokens=False).ids, 1], repr(text)


def written(spark, docs, **options):
    path = Scratch(spark, "test").path("files")
    tokens.write_tokens(docs, path, PATH, 1, **options)
    return path


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_files(spark, encoding):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    path = written(spark, docs, encoding=encoding, row_group=1 << 20, page=16 << 10, parts=3)
    local = path.removeprefix("file:")
    files = sorted(glob(f"{local}/part-*"))
    assert len(files) == 3
    last = -1
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            ids = meta.row_group(g).column(4)
            assert ids.path_in_schema.startswith("ids.")
            assert ids.has_offset_index and ids.has_column_index
            wanted = "RLE_DICTIONARY" if encoding == "dictionary" else "DELTA_BINARY_PACKED"
            assert wanted in ids.encodings
        table = pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist()
        assert table == sorted(table) and table[0] > last
        last = table[-1]
    plan = tokens.read_tokens(spark, path).where("doc_id = 7").select("n_tokens")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,7)" in plan and "ids" not in plan.split("ReadSchema")[1]


def test_query_against_the_library(spark):
    from marginflow.llm.queries import op1_tokens

    theirs, start, want = library(), 0, []
    for r in sorted(read(spark, "/root/testdata/sf0.001", "documents").collect(), key=lambda r: r.doc_id):
        ids = [*theirs.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    got = by_row(op1_tokens(spark, "/root/testdata/sf0.001"), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == sorted(want, key=repr)


def test_odd_rows(spark, odd, nothing):
    theirs, path = library(), written(spark, odd, parts=4)
    rows = tokens.checksums(tokens.read_tokens(spark, path)).join(tokens.starts(spark, path), "part").collect()
    rows = sorted(rows, key=lambda r: r.before + r["at"])
    order = sorted(ODD, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    start = 0
    for r, (i, text) in zip(rows, order, strict=True):
        ids = [*theirs.encode(text or "", add_special_tokens=False).ids, 1]
        assert (r.doc_id, r.before + r["at"], r.n_tokens, r.ids_crc32) == (
            i, start, len(ids), zlib.crc32(array("I", ids).tobytes()))
        start += len(ids)
    empty = written(spark, nothing)
    assert tokens.checksums(tokens.read_tokens(spark, empty)).count() == 0
