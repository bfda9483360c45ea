from __future__ import annotations

import hashlib
import random
import sys
from types import ModuleType

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caremeld.llm import chunked_bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TINY = B.Codec(PATH, B.Chunking(mean=8, window=8))
USUAL = B.Codec(PATH)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


pieces = st.sampled_from(
    [" ", "  ", "\n", "\t ", "a", "the", "'s", "'re", "'", "!!", "12", "é", "日本", "\u00a0", "\u2028", "\x85", "<|endoftext|>", "<|endo", "ftext|>", "\U0001f600", "x" * 30, " word"]
)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.lists(pieces, max_size=60).map("".join)))
def test_equals_the_library(text):
    for codec in (TINY, USUAL):
        ids = codec.encode(text)
        assert ids.tolist() == library(text)
        assert codec.decode(ids) == LIBRARY.decode(ids.tolist(), skip_special_tokens=False) == text


def test_long_texts_without_boundaries():
    for text in ("x" * 200_000, " " * 1_000_000 + "y", "日本語" * 40_000):
        assert USUAL.encode(text).tolist() == library(text)


def test_cuts_follow_content():
    """The same passage is cut alike wherever it stands, and slabs change nothing."""
    rng = random.Random(1)
    passage = rng.randbytes(4_000).hex().encode()
    one, other = b"abc" * 77 + passage, b"z" * 1_234 + passage
    chunking = B.Chunking(mean=64)
    inner = lambda data, at: {c - at for c in B.cut_points(data, chunking) if c - at > 64}
    assert inner(one, 231) == inner(other, 1_234) and len(inner(one, 231)) > 50
    assert B.cut_points(one, B.Chunking(mean=64, slab=1_000)) == B.cut_points(one, chunking)
    assert B.cut_points(b"", chunking) == []
    mean = len(passage) / len(B.cut_points(passage, chunking))
    assert 32 < mean < 128


def test_shared_chunks_are_encoded_once_and_bounded():
    rng = random.Random(2)
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(2_000))
    codec = B.Codec(PATH)
    codec.encode("first " + passage)
    before = codec.encoded_chunks
    codec.encode("second, other start " + passage)
    assert codec.encoded_chunks - before <= 3 and codec.reused_chunks > 20 and codec.repairs > 20
    small = B.Codec(PATH, B.Chunking(cached_bytes=20_000))
    assert small.encode(passage).tolist() == codec.encode(passage).tolist()
    assert small.held <= 20_000


def test_on_tables(spark, documents, texts, nothing, clashing):
    rows = documents.select("doc_id", "text", B.digests(F.col("text"), PATH).alias("d")).collect()
    for r in rows:
        ids = library(r.text or "")
        assert r.d.n_tokens == len(ids)
        assert r.d.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.d.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    together = B.brought_together(clashing, "text")
    assert together.columns == clashing.columns and together.count() == len(texts)
    arrays = nothing.select(B.token_ids(F.col("text"), PATH).alias("ids"))
    assert arrays.count() == 0
    (one,) = spark.createDataFrame([("the end",)], "text string").select(B.token_ids(F.col("text"), PATH).alias("ids")).collect()
    assert one.ids == library("the end")


@pytest.mark.parametrize("path", [PATH])
def test_special_tokens_are_recognised(path):
    assert USUAL.encode("a<|endoftext|>b").tolist() == library("a<|endoftext|>b")
    assert 50256 in USUAL.encode("x <|endoftext|>").tolist()


def test_characters_of_every_plane():
    """Both libraries see the same letters, digits, spaces and marks."""
    for code in [*range(0x500), *range(0x500, 0x30000, 7), *range(0xE0000, 0xE0200)]:
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)}b1{chr(code)}2 {chr(code)}{chr(code)} .{chr(code)}. {chr(code)}'s"
            assert USUAL.fast.encode_ordinary(text) == library(text), hex(code)


@pytest.mark.parametrize("alphabet", ["日本語の文章を書くときは、句読点。が必要です「これ」カタカナ漢字！", "абв где жзи клм ноп рст уфх", "αβγ δεζ ηθι κλμ νξο", "abc def ghi"])
def test_copies_reuse_chunks_in_any_script(alphabet):
    """Of three texts that differ in their beginning, little more than one is encoded."""
    rng = random.Random(8)
    body = "".join(rng.choice(alphabet) for _ in range(12_000))
    codec, encoded = B.Codec(PATH), 0
    plain = codec.plain

    def counted(data):
        nonlocal encoded
        encoded += len(data)
        return plain(data)

    codec.plain = counted
    texts = [f"{'start ' * i}{body}" for i in range(3)]
    for text in texts:
        assert codec.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert encoded < 0.45 * sum(len(t.encode()) for t in texts)


def test_odd_boundaries_against_the_library():
    rng, codec = random.Random(9), B.Codec(PATH)
    parts = list("ab'sT1 .,!\n\t　。、日本がа \x85\x1c​") + ["<|endoftext|>", "<|", "endoftext", "|>", " " * 300, "\n" * 257]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=rng.randint(1, 500)))
        assert codec.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 1_000_000 + "a", "\n" * 1_000_000, " \n" * 500_000 + "<|endoftext|>x"])
def test_very_long_white_space(text):
    codec = B.Codec(PATH)
    ids = codec.encode(text)
    assert codec.decode(ids) == text
    assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_a_worker_holds_one_codec_for_all_its_queries(spark, monkeypatch):
    """Each query makes its function anew; what the codecs of earlier ones hold would add up."""
    monkeypatch.setitem(sys.modules, "kept_in_this_process", ModuleType("kept_in_this_process"))
    codecs = []
    for _ in range(3):
        apply = B.encoded(PATH, lambda codec, value: codecs.append(codec) or len(codec.encode(value)), "long")
        assert [n.tolist() for n in apply.func(iter([pd.Series(["one two", None])]))] == [[2, 0]]
    assert len(codecs) == 6 and len({id(c) for c in codecs}) == 1
