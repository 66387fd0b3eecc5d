import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fieldlens.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBpe(PATH)


def same(own, library, texts):
    for text, ids in zip(texts, own.encode_batch(texts)):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == want, text[:80]
        assert own.decode(ids.tolist()) == library.decode(want, skip_special_tokens=False)


def test_random_texts(own, library):
    rng = random.Random(5)
    letters = [chr(rng.randrange(1, 0x3000)) for _ in range(300)] + list("aabbeett  \n\t'") * 20 + ["<|endoftext|>"] * 6
    same(own, library, ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(3000)])


def test_long_words_and_specials(own, library):
    same(own, library, ["a" * 3000, "ab" * 2000, " " * 500 + "x", "=-" * 700, "<|endoftext|><|endoftext|> a<|endoftext|",
                        "I'll we've 's's", "", None])


def test_every_character(own, library):
    every = [chr(c) for c in range(1, 0x110000, 1) if not 0xD800 <= c < 0xE000]
    same(own, library, ["".join(f"{c}'s 1{c}x " for c in every[i:i + 400]) for i in range(0, len(every), 8000)])


def test_stepped_and_heap_merging_agree(own):
    rng = random.Random(1)
    words = [bytes(rng.choices(b"thean iorst", k=rng.randrange(1, 40))) for _ in range(500)]
    flat, size = own._exact_many(words)
    at = 0
    for w, n in zip(words, size.tolist()):
        assert flat[at:at + n].tolist() == own.exact(w)
        at += n


def test_cache_is_bounded(own, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    for k in range(20):
        own.encode_batch([" ".join(f"w{k}x{i}" for i in range(30))])
        assert len(own.cache) <= 50 + 61


def test_frames(spark, edge, empty, library):
    out = bpe.decode(bpe.encode(edge, PATH), PATH)
    both = bpe.round_trip(edge, PATH)
    assert both.columns == out.columns and both.exceptAll(out).count() == 0
    assert [c for c in out.columns if c.lower() == "ids"] == ["ids"]
    rows = out.collect()
    assert len(rows) == edge.count()
    for r in rows:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == (r.text or "")
    assert bpe.encode(empty, PATH).count() == 0
