import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cartwake.llm import token_codes as C
from cartwake.llm.queries import QUERIES

from text_helpers import SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(PATH)


@given(st.lists(st.integers(0, 2**32 - 1), max_size=2000))
@settings(max_examples=40, deadline=None)
def test_codes_round_trip(ids):
    data = C._shard(3, 1, [7, None], [struct.pack(f"<{len(ids)}I", *ids), b""])
    s = C.Shard(data)
    assert s.tokens(0, len(ids)).tolist() == ids
    assert (s.partition, s.number, s.known.tolist(), s.document(1).tolist()) == (3, 1, [1, 0], [])
    for i in random.Random(0).sample(range(len(ids)), min(5, len(ids))):
        assert s.token(i) == ids[i]
        assert s.tokens(i, len(ids)).tolist() == ids[i:]


def test_random_access_over_many_blocks():
    ids = np.random.default_rng(0).integers(0, 2**17, 50_000).astype("<u4")
    ids[:1000] = 5
    s = C.Shard(C._shard(0, 0, [0], [ids.tobytes()]))
    for i in (0, 511, 512, 1023, 1024, 49_999, 33_333):
        assert s.token(i) == ids[i]
    for a, b in ((0, 1), (999, 1001), (1024, 9000), (17, 17), (49_990, 50_000)):
        assert (s.tokens(a, b) == ids[a:b]).all()
    with pytest.raises(IndexError):
        s.token(50_000)


def test_cut_shard_is_refused():
    data = C._shard(0, 0, [0], [struct.pack("<3I", 1, 2, 3)])
    with pytest.raises(ValueError):
        C.Shard(data[:-1])
    with pytest.raises(ValueError):
        C.Shard(b"XXXX" + data[4:])


@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" .,'\n\tİΣ̱́AaB1<|endoftext|>")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_words_give_the_ids_of_the_whole_text(text):
    encoder = C._encoder(PATH)
    want = encoder.model.encode(text, add_special_tokens=False).ids
    assert list(struct.unpack(f"<{len(want)}I", encoder.texts([text])[0][: 4 * len(want)])) == want
    assert len(encoder.texts([text])[0]) == 4 * len(want)


def expected(rows, model):
    start, out = 0, []
    for d, text in rows:
        ids = model.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((d, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_query(spark, texts, model):
    got = sorted(map(tuple, QUERIES["op1_token_codes"](spark, SMALL).collect()))
    assert got == expected(sorted(texts.items()), model)


def test_odd_rows_and_small_shards(spark, odd, model, tmp_path):
    C.write_codes(odd, str(tmp_path / "codes"), PATH, shard_tokens=50)
    got = C.read_codes(spark, str(tmp_path / "codes")).collect()
    assert len(got) == odd.count()
    assert len({(r.partition, r.shard) for r in got}) > 1
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    want = expected([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()], model)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(d), n, c) for d, _, n, c in want)


def test_empty_table(none):
    assert C.encode_documents(none, PATH).count() == 0
