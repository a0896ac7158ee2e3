import hashlib
import random
import time

import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from layerloom.llm import piece_bpe
from layerloom.llm.registry import PIECE_BPE, op7_piece_bpe
from tests.llm.conftest import SF, texts_of

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
CODEC = piece_bpe.PieceCodec(PIECE_BPE)
PARTS = [
    "a", "b", "ab", "B", " ", "  ", "\n", "é", "s", "aa", "aaaa", "=" * 7, "-" * 5, "0", "€", "漢", "\x00", "▁", "▁▁", "the", "ing", "th",
    "1" * 9, "<s>", "<0x0A>", "abab", "     ", "🙂",
]


def agree(texts):
    got = []
    for ids, edges in CODEC.encode(pa.array(texts, pa.string())):
        for k, text in enumerate(CODEC.decode(ids, edges)):
            got.append((ids[edges[k] : edges[k + 1]].tolist(), text))
    assert got == [(LIBRARY.encode(t), LIBRARY.decode(LIBRARY.encode(t))) for t in texts]


def test_random_texts():
    draw = random.Random(5)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 40))) for _ in range(4000)]
    agree([*texts, "a" * 5000, "ab" * 3000, " " * 700, "", " "])


def test_long_words():
    """Words without spaces, of letters, of vocabulary pieces and of several scripts, also when cut at any length."""
    draw = random.Random(11)
    pieces = [p for p in (LIBRARY.id_to_piece(i) for i in range(300, LIBRARY.get_piece_size(), 7)) if "▁" not in p]
    words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyzéß漢字语", k=draw.randint(65, 900))) for _ in range(60)]
    words += ["".join(draw.choices(pieces, k=draw.randint(20, 300))) for _ in range(60)]
    words += ["".join(draw.choices("ab", k=700)), "x" * 999, "=" * 500 + "a" * 500, "🙂" * 200]
    agree([*words, " ".join(words[:5]), "   ".join(words[60:65])])


def test_a_very_long_word_takes_seconds():
    draw = random.Random(12)
    word = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=100_000))
    began = time.process_time()
    agree([word])
    assert time.process_time() - began < 8


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=5))
def test_any_text(texts):
    agree(texts)


def test_whole_table(spark, documents):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for doc, text in texts_of(documents):
        ids = LIBRARY.encode(text)
        want[doc] = (len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids)))
    assert {r["doc_id"]: tuple(r)[1:] for r in op7_piece_bpe(spark, SF).collect()} == want


def test_odd_and_empty(odd, none):
    got = sorted((str(r["doc_id"]), list(r["ids"])) for r in piece_bpe.encode(odd, PIECE_BPE).collect())
    assert got == sorted((str(d), LIBRARY.encode(t)) for d, t in texts_of(odd))
    assert piece_bpe.digests(odd, PIECE_BPE).count() == odd.count()
    assert piece_bpe.digests(none, PIECE_BPE).count() == 0
