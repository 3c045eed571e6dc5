import hashlib
import random
from array import array

import public_tokenizers
from llm_rows import ODD, by_row
from tokenizers import Tokenizer

from marginflow.llm import bpe

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
LETTERS = "aabbcdee   \n\t  '''stremvldSTR..,!?0123456789éèüßñ中文字😀\x85\xa0 \x1c\x1f\x00İḴ́ªº²½٣"


def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


def test_equals_the_library_on_random_strings():
    mine, theirs, rng = bpe.Encoder(PATH), library(), random.Random(3)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 50))) for _ in range(4000)]
    texts += [t[:9] + "<|endoftext|>" + t[9:] for t in texts[:200]]
    texts += ["a" * n for n in range(1, 200)] + ["ab" * n for n in range(99)] + [" " * n for n in range(50)] + ["don't 's x's"]
    for text in texts:
        ids = theirs.encode(text, add_special_tokens=False).ids
        got = mine.encode(text)
        assert list(array("I", got)) == ids, repr(text)
        assert mine.decode(got) == theirs.decode(ids, skip_special_tokens=False)


def test_every_prefix_has_one_last_token():
    """What the method rests on: just one match at each prefix is compatible with what is before."""
    words, v = [b" international", b"strengths", b"aaaaaaa", "çelletionß".encode()], bpe.Vocabulary(PATH)
    for word in words:
        last = {0: None}
        for end in range(1, len(word) + 1):
            fit = []
            for start in range(end):
                token = v.id.get(word[start:end])
                if token is not None and (last[start] is None or v.fits(last[start], token)):
                    fit.append(token)
            assert len(fit) == 1
            last[end] = fit[0]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_ENTRIES", 5)
    mine, theirs = bpe.Encoder(PATH), library()
    text = "one two three four five six seven eight one two three, four. five six seven eight nine ten one"
    for _ in range(3):
        assert list(array("I", mine.encode(text))) == theirs.encode(text, add_special_tokens=False).ids


def test_odd_rows(odd, nothing):
    theirs = library()
    got = by_row(bpe.encode(odd, PATH), "doc_id", "n_tokens", "ids", "decoded")
    want = []
    for i, t in ODD:
        ids = theirs.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), bytearray(array("I", ids).tobytes()), theirs.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=repr)
    assert bpe.encode(nothing, PATH).count() == 0


def test_query(spark):
    from marginflow.llm.common import read
    from marginflow.llm.queries import op9_bpe

    theirs, dir_ = library(), "/root/testdata/sf0.001"
    want = []
    for r in read(spark, dir_, "documents").collect():
        ids = theirs.encode(r.text or "", add_special_tokens=False).ids
        text = theirs.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert by_row(op9_bpe(spark, dir_), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
