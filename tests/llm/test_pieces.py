"""Encoding and decoding against the library itself."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from aeromart.llm import pieces
from aeromart.llm.queries import tokenizer_path

ODD = [
    "", " ", "  ", "a ", " a", " \n ", "▁", "▁▁a", "a▁ b", "<s> </s> <unk> <0x0A>", "\x00", " \x00 ", "ﬁ Ａ", "a" * 5000,
    "\t\ta\r\n", "日本 語", "é x", "🙂 ok", None,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


def test_any_text_as_the_library_does(library):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab ▁\n<>é日s/unk") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    coder = pieces.Encoder(tokenizer_path())
    assert coder.by_chunk
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)]
    assert got == library.encode([t or "" for t in texts], add_bos=True, add_eos=True)


def test_a_small_table_changes_nothing(library):
    coder = pieces.Encoder(tokenizer_path(), table_size=5)
    texts = [f"word{i} and word{i + 1}" for i in range(50)]
    for text in texts:
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)
    assert len(coder.table) <= 10


def test_digests_and_round_trip(frame, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (1, "again")]
    found = pieces.token_digests(frame(rows), tokenizer_path()).collect()
    assert len(found) == len(rows)
    wanted = {}
    for i, t in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        key = (hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        wanted.setdefault(i, []).append((len(ids), *key))
    for r in found:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) in wanted[r["doc_id"]]
    kept = pieces.tokenised(frame([(1, "one two"), (2, None)]), tokenizer_path())
    assert [(r["n_tokens"], r["round_trip"], r["runs"]) for r in kept.orderBy("doc_id").collect()] == [(4, True, 7), (2, True, 7)]
    texts = pieces.decode_ids(pieces.encode_texts(frame([(1, "one two"), (2, None)]), tokenizer_path()), tokenizer_path(), out="back")
    assert [r["back"] for r in texts.orderBy("doc_id").collect()] == ["one two", ""]
    assert pieces.token_digests(frame([]), tokenizer_path()).count() == 0


def test_a_worker_keeps_no_table_after_its_task(frame, spark):
    pieces.tokenised(frame([(i, f"word{i} and more") for i in range(64)]), tokenizer_path()).count()
    rows = pieces.tokenised(frame([(i, f"word{i} and more") for i in range(64)]), tokenizer_path()).collect()
    assert len(rows) == 64

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(pieces.encoder(tokenizer_path(), pieces.TABLE_SIZE).table)] * batch.num_rows)], names=["held"])

    found = spark.range(0, 64, 1, 8).mapInArrow(held, "held long").collect()
    assert {r["held"] for r in found} == {0}
