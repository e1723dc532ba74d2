"""Tokenizer files that differ from the usual one: words must be lowered and cut only where the file does so."""

import json
import random
import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gridloom.llm.tokens import WordTokenizer, shared_forms, splits_at_white_space
from gridloom.llm.words import text_bytes

TEXTS = ["Hello WORLD Foo", "hello, world!", "It's 3.14, isn't IT?", "", "a-b_c (Über) Straße: ok", "x<|endoftext|>Y, z", "ÀÉ É, 12,5"]


def edited(path, change):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    change(spec)
    path.write_text(json.dumps(spec), encoding="utf-8")
    return str(path)


def without_lowercase(spec):
    spec["normalizer"]["normalizers"] = [x for x in spec["normalizer"]["normalizers"] if x["type"] != "Lowercase"]


def at_white_space_only(spec):
    spec["pre_tokenizer"]["pretokenizers"][0]["pattern"] = {"Regex": r"[^\s]+"}


def both(spec):
    without_lowercase(spec)
    at_white_space_only(spec)


@pytest.mark.parametrize("change", [lambda spec: None, without_lowercase, at_white_space_only, both])
def test_as_the_library(tmp_path, change):
    path = edited(tmp_path / "words.json", change)
    assert splits_at_white_space(path)
    made = random.Random(3)
    texts = TEXTS + ["".join(made.choice("aBcÉß .,'-!7\n<") for _ in range(made.randrange(40))) for _ in range(500)]
    library = Tokenizer.from_file(path)
    expected = [library.encode(x, add_special_tokens=False).ids for x in texts]
    words = WordTokenizer(path)
    assert [x.tolist() for x in words.encode_batch(pa.array(texts))] == expected
    assert words.count_batch(pa.array(texts)) == [len(x) for x in expected]


def test_room_for_shared_forms():
    """Lowering and parting a batch of texts takes a few bytes for each of theirs; rows are looked at one by one."""
    texts = ["Abc, DEF! " * 20_000, "", None, "É Abc, DEF! " * 20_000, "<x> Abc, DEF! " * 20_000, ""]
    data, bounds = text_bytes(pa.array(texts))
    tracemalloc.start()
    made, edges = shared_forms(data, bounds, True, True)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    rows = [made[a:b].tobytes().decode() for a, b in zip(edges[:-1], edges[1:])]
    assert rows == ["abc , def ! " * 20_000, "", "", "É Abc , DEF ! " * 20_000, "<x> Abc, DEF! " * 20_000, ""]
    assert most < 10 * len(data)
