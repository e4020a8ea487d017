import hashlib
import random
import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from text_helpers import SMALL
from tokenizers import Tokenizer

from cartwake.llm import bpe_tree as B
from cartwake.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "e", "in", "th", "'s", "İ", "Σ", " ", "\n", "\u0301", "<|endoftext|>", "<|startoftext|>", "<|", "!"]


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(PATH)


def ids_of(model, text):
    return model.encode(text, add_special_tokens=False).ids


@given(
    st.lists(st.one_of(st.characters(codec="utf-8"), st.sampled_from(PARTS)), max_size=60).map("".join),
    st.integers(1, 9), st.integers(1, 4),
)
@settings(max_examples=300, deadline=None)
def test_any_cut_gives_the_ids_of_the_whole(text, leaf, window):
    tree = B._tree_encoder(PATH)
    parts = B.halves(tree.row(text), leaf)
    assert tree.tree([tree.encode(p) for p in parts], window) == ids_of(tree.words.model, text)


@pytest.mark.parametrize("letters", ["a", "ab", "!", "hehe", "etaoinshrdlu", "ＡＢ中"])
def test_one_unsplit_piece(letters, model):
    tree, dice = B._tree_encoder(PATH), random.Random(3)
    text = "".join(dice.choice(letters) for _ in range(20_000)) if len(letters) > 4 else letters * (20_001 // len(letters))
    parts = B.halves(tree.row(text), 1000)
    assert len(parts) > 16
    assert tree.tree([tree.encode(p) for p in parts]) == ids_of(model, text)


def test_windows_change_what_halves_alone_would_give(model):
    tree = B._tree_encoder(PATH)
    parts = B.halves(tree.row("interesting" * 40), 7)
    alone = [i for p in parts for i in tree.encode(p)]
    assert alone != ids_of(model, "interesting" * 40)


def expected(rows, model):
    out = []
    for d, text in rows:
        ids = ids_of(model, text or "")
        back = model.decode(ids, skip_special_tokens=False)
        out.append((d, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return out


def digests(done):
    return [
        (r.doc_id, len(r.ids) // 4, hashlib.sha256(bytes(r.ids)).hexdigest(), hashlib.sha256(r.decoded.encode()).hexdigest())
        for r in done.collect()
    ]


def test_query(spark, texts, model):
    assert sorted(map(tuple, QUERIES["op13_bpe"](spark, SMALL).collect())) == sorted(expected(texts.items(), model))


def test_every_text_cut(spark, documents, texts, model):
    got = digests(B.decode(B.encode(documents, PATH, leaf=100), PATH))
    assert sorted(got) == sorted(expected(texts.items(), model))


@pytest.mark.parametrize("leaf", [8, B.LEAF])
def test_odd_rows(spark, odd, model, leaf):
    unsplit = spark.createDataFrame([(11, "ab" * 40_000), (11, "ab" * 40_000), (None, "x!" * 40_000)], "doc_id long, text string")
    rows = odd.select("doc_id", "text").unionByName(unsplit)
    docs = odd.unionByName(unsplit, allowMissingColumns=True).withColumnsRenamed({"fp": "ids", "row": "a.b", "size": "Key"})
    got = digests(B.decode(B.encode(docs, PATH, leaf=leaf), PATH))
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(got, key=key) == sorted(expected([(r.doc_id, r.text) for r in rows.collect()], model), key=key)


def test_empty_table_and_unknown_ids(spark, none, model):
    assert B.decode(B.encode(none, PATH), PATH).count() == 0
    rows = spark.createDataFrame([(1, bytearray(struct.pack("<3I", 320, 2**31, 321))), (2, None), (3, bytearray())], "doc_id long, ids binary")
    got = {r.doc_id: r.decoded for r in B.decode(rows, PATH).collect()}
    assert got == {1: model.decode([320, 321], skip_special_tokens=False), 2: "", 3: ""}
