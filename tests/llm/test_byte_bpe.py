import json
import random

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from layerloom.llm.byte_bpe import Codes, Encoder, Memo, slices
from layerloom.llm.registry import BYTE_BPE
from tokenizers import Tokenizer

LIBRARY = Tokenizer.from_file(BYTE_BPE)
IDS, SPANS = Encoder(BYTE_BPE), Encoder(BYTE_BPE, spans=True)
PARTS = [
    "a", "B", " ", "  ", "\n", " \n", "\t", "é", "'s", "'", "\x1c", "0", "12", "€", "<|endoftext|>", ".", ",", "漢", "\x00", "​",
    "é", "\x85", "\r\n", "foo", "﻿", "　",
]


def agree(texts):
    want = LIBRARY.encode_batch(list(texts), add_special_tokens=False)
    array = pa.array(texts, pa.string())
    assert [x.tolist() for x in IDS.run(array)] == [e.ids for e in want]
    assert [[tuple(p) for p in x.tolist()] for x in SPANS.run(array)] == [list(e.offsets) for e in want]


def test_random_texts():
    draw = random.Random(5)
    agree(["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 40))) for _ in range(4000)])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(texts):
    agree(texts)


def test_slices():
    texts = pa.array(["x" * (17 << 20), None, "", "y"])
    assert sum(len(p) for p in slices(texts)) == 4 and list(slices(texts[:0])) == []
    assert [len(x) for x in IDS.run(pa.array([None, ""], pa.string()))] == [0, 0]


def test_memo_keeps_what_is_asked_for():
    memo = Memo(4)
    for k in range(20):
        found = memo.look_up(["hot", f"k{k}"])
        assert found == ([None, None] if k == 0 else [b"h", None])
        memo["hot"], memo[f"k{k}"] = b"h", b"x"
    assert len(memo) + len(memo.old) < 8


class Watched:
    """The library, with the characters that it was given."""

    def __init__(self, inner):
        self.inner, self.given = inner, 0

    def _run(self, name, texts, **options):
        self.given += sum(map(len, texts))
        return getattr(self.inner, name)(texts, **options)

    def encode_batch(self, texts, **options):
        return self._run("encode_batch", texts, **options)

    def encode_batch_fast(self, texts, **options):
        return self._run("encode_batch_fast", texts, **options)


def test_known_words_are_not_encoded_again_for_the_signs_or_lines_around_them():
    for spans in (False, True):
        code = Encoder(BYTE_BPE, spans=spans)
        code.tokenizer = Watched(code.tokenizer)
        [*code.run(pa.array(["Oner reensh ereathth\nOner, x***"]))]
        code.tokenizer.given = 0
        text = "Oner reensh*** ereathth\nOner reensh, ereathth. reensh.\nOner"
        (found,) = code.run(pa.array([text]))
        want = LIBRARY.encode(text, add_special_tokens=False)
        assert found.tolist() == ([list(p) for p in want.offsets] if spans else want.ids)
        assert code.tokenizer.given <= 2  # "." alone


def test_signs_lines_and_spaces_in_any_order():
    draw = random.Random(7)
    parts = ["the", " of", "É", "ß", "1", " ", "\n", "\n\n", "\r\n", "\u00a0", *".,;:!?#$%&*'<|", "'s", "'ll", "\u0301", "漢"]
    agree(["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(8000)])


def test_added_tokens_across_a_cut_and_vocabularies_without_heads(tmp_path):
    made = json.loads(LIBRARY.to_str())
    text = "a the.of b<sp> c <sp>d\nthe.of\nx the end. y"

    def same(made, name):
        path = str(tmp_path / name)
        with open(path, "w") as f:
            json.dump(made, f)
        library = Tokenizer.from_file(path)
        for _ in range(2):
            assert [x.tolist() for x in Encoder(path).run(pa.array([text]))] == [library.encode(text, add_special_tokens=False).ids]
        return library

    token = {"id": 50256, "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
    same(made | {"added_tokens": [token | {"content": "the.of"}]}, "sign.json")
    same(made | {"added_tokens": [token | {"content": "b<sp> c"}]}, "space.json")
    same(made | {"added_tokens": [token | {"content": "<sp>", "lstrip": True, "rstrip": True}]}, "strip.json")
    vocab = {c: k for k, c in enumerate("abcdefghijklmnopqrstuvwxyz")}
    same(made | {"added_tokens": [], "model": made["model"] | {"vocab": vocab, "merges": []}}, "few.json")


def test_codes_keep_what_is_asked_for():
    def strings(values, kind):
        return pa.array(values, kind)

    codes = Codes(4)
    for k in range(20):
        keys = strings(["hot", f"k{k}"], pa.large_string())
        found = codes.look_up(keys)
        assert found.to_pylist() == ([None, None] if k == 0 else [b"h", None])
        new = found.is_null()
        codes.add(keys.filter(new), strings([b"h", b"x"], pa.large_binary()).filter(new))
    assert len(codes.keys) < 8


def test_long_pieces_are_not_kept():
    code = Encoder(BYTE_BPE)
    assert len([*code.run(pa.array(["word " + "x" * 5000]))]) == 1
    assert code.known.keys.to_pylist() == ["word"]
