import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfwise.llm import bpe as op

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "b", "the", " ", "  ", "\n", " ", "　", "é", "'s", "'ll", "!", "12", "<|endoftext|>", "<|endo", "漢字", "\t", "\x1c", "\x85", "😀", "ing", "\x00"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 900))) for _ in range(n)]


@pytest.mark.parametrize("bits, least", [(10, 128), (4, 2), (1, 1)])
def test_same_tokens_however_the_text_is_cut(library, monkeypatch, bits, least):
    monkeypatch.setattr(op, "CUT_BITS", bits)
    monkeypatch.setattr(op, "LEAST_CHUNK", least)
    bpe = op.ByteBpe(PATH)
    for text in [*texts(150), "no_blank_at_all" * 400, " " * 3000, "", "x"]:
        want = library.encode(text, add_special_tokens=False).ids
        ids = bpe.encode(text.encode())
        assert ids.tolist() == want
        assert bpe.decode(ids).decode() == library.decode(want, skip_special_tokens=False)


def test_shared_chunks_are_encoded_once(monkeypatch):
    bpe = op.ByteBpe(PATH)
    shared = " ".join(f"word{i}" for i in range(4000)).encode()
    bpe.encode(shared)
    stored = len(bpe.store)
    bpe.encode(b"another beginning, " + shared)
    assert stored > 10 and len(bpe.store) <= stored + 4
    monkeypatch.setattr(op, "STORE_BYTES", 20_000)
    bpe.encode(b"x" + shared[::-1])
    assert bpe.store_size <= 20_000


def test_documents(docs, library):
    rows = [*enumerate(texts(20, 3)), (50, None), (51, ""), (51, ""), (None, "a b")]
    got = sorted(map(str, op.encode_documents(docs(rows), PATH, with_ids=True).collect()))
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    frame = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        frame.append((i, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False)), ids))
    spark = docs([]).sparkSession
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>"
    assert got == sorted(map(str, spark.createDataFrame(frame, schema).collect()))
    assert op.encode_documents(docs([]), PATH).count() == 0
