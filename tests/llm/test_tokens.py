"""Token counts, the codec and chat formatting against the encoders' own library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagemill.llm.bpe_codec import Encoder, bpe_decode, bpe_encode, bpe_round_trip
from pagemill.llm.chat_format import Coder, Escape, assemble, format_turns, read_back
from pagemill.llm.merges import byte_letters, merge_symbols
from pagemill.llm.token_counts import token_counts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [
    "", " ", "\n\n  a  b \t", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b", "<|startoftext|>x<|endoftext|>",
    "It's we'll THEY'RE", "aaaaaaaaaaaaaaaa" * 50, "ΣΑΣ ΟΔΟΣ", "İstanbul é ẛ̣ ﬁ", "日本語 テスト 123", "x\x1c\x85y\xa0z",
    "²³¹ ½ 12345", "\U0001f600\U0001f468‍\U0001f469", "՘֋ a՘b", "!!!???###", "a\0b", "word" * 4000, "'s's't",
]


@pytest.fixture(scope="module")
def mixed_texts():
    pick = random.Random(11)
    letters = "abcdefghij ABC123'.,!?\n\téßñΩ漢"
    return TEXTS + ["".join(pick.choices(letters, k=pick.randrange(1, 300))) for _ in range(400)]


def test_counts_equal_the_library(spark, make, mixed_texts):
    library = Tokenizer.from_file(BYTES)
    rows = list(enumerate(mixed_texts)) + [(-1, None), (None, "a b"), (0, "x")]
    found = sorted(map(tuple, token_counts(make(rows), BYTES).collect()), key=repr)
    expected = [
        (i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows
    ]
    assert found == sorted(expected, key=repr)


def test_codec_equals_the_library(spark, make, mixed_texts):
    library = Tokenizer.from_file(WORDS)
    rows = list(enumerate(mixed_texts)) + [(-1, None)]
    expected = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    encoded = bpe_encode(make(rows), WORDS).cache()
    assert {r.doc_id: r.ids for r in encoded.collect()} == expected
    decoded = {i: library.decode(ids, skip_special_tokens=False) for i, ids in expected.items()}
    assert {r.doc_id: r.text for r in bpe_decode(encoded, WORDS).collect()} == decoded
    for r in bpe_round_trip(make(rows), WORDS).collect():
        ids = np.array(expected[r.doc_id], "<u4").tobytes()
        assert r.n_tokens == len(expected[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded[r.doc_id].encode()).hexdigest()


def test_only_failing_words_are_merged():
    with open(WORDS, "rb") as file:
        encoder = Encoder.of(file.read())
    pick = random.Random(2)
    words = ["".join(pick.choices("aeinorstlh", k=pick.randrange(1, 14))) for _ in range(3000)]
    before = encoder.exact_words
    assert encoder.encode_words(words) == [encoder.exact(w) for w in words]
    assert 0 < encoder.exact_words - before < len(words)


def test_merging_counts_merges():
    merges = {(0, 1): (0, 2), (2, 2): (1, 3)}
    assert merge_symbols([0, 1, 0, 1, 0], merges) == ([3, -1, -1, -1, 0], 3)
    assert len(set(byte_letters())) == 256


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_empty_table(make, path):
    nothing = make([(1, "a")]).filter("doc_id > 1")
    assert token_counts(nothing, BYTES).count() == 0 and bpe_encode(nothing, WORDS).count() == 0


def test_escape_is_reversible():
    escape, pick = Escape(), random.Random(4)
    parts = ["</s>", "[INST]", "[/INST]", "<|turn|>", "<|done|>", "\\", "<", "[", "</s", "x", " ", "<\\/s>", "<<SYS>>"]
    for _ in range(3000):
        text = "".join(pick.choices(parts, k=pick.randrange(8)))
        hidden = escape.escape(text)
        assert escape.unescape(hidden) == text
        assert not any(c in hidden for c in ("</s>", "[INST]", "<|turn|>", "<|done|>", "<<SYS>>"))
    with pytest.raises(ValueError):
        Escape(("<a>", "<a>b"))


def test_very_long_blank_runs_are_encoded():
    with open(RANKS, "rb") as file:
        coder = Coder.of(file.read())
    for text in (" " * 300_000, "\n" * 100_000 + "x", "a" * 200_000):
        assert coder.decode(coder.encode(text)) == text


def test_conversations_are_read_back(spark):
    rows = [
        (1, 1, "assistant", "second </s>"), (1, 0, "user", "first"), (1, 2, "assistant", "third"),
        (2, 0, None, None), (2, None, "assistant", ""), (None, 0, "assistant", "no id"),
        (3, 0, "assistant<|body|>", "<|done|>\\"), (4, 0, "user", "tie"), (4, 0, "user", "tie"),
    ] + [(5, n, "assistant" if n % 2 else "user", f"turn {n} [INST]") for n in range(500)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumn("ids", F.lit("clash")).withColumn("mask", F.lit(1)).repartition(4)
    segments = assemble(format_turns(frame, RANKS))
    for r in read_back(segments, RANKS).collect():
        own = sorted(
            (x for x in rows if x[0] == r.conv_id), key=lambda x: (x[1] is not None, x[1] or 0)
        )
        turns = "".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in own)
        learned = "".join(text or "" for _, _, role, text in own if role == "assistant")
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert read_back(segments, RANKS).count() == 6
    assert read_back(assemble(format_turns(frame.filter("turn > 9999"), RANKS)), RANKS).count() == 0


def test_round_trip_is_encoding_and_decoding(monkeypatch):
    with open(WORDS, "rb") as file:
        encoder = Encoder.of(file.read())
    special = next(iter(encoder.vocabulary.specials))
    texts = [
        "", " \n", "Plain words, and 'tis 12 more.", f"a{special}b {special}{special}", special, special.upper(),
        "x" * 400 + " y", "x" * 400, "ünïcode İstanbul 東京 \U0001f600", "\x00� ​",
    ]
    want = [(ids.astype("<u4").tobytes(), encoder.decode(ids.tolist())) for ids in encoder.encode_batch(texts)]
    for kept in (600_000, 0):  # with and without what earlier texts left
        monkeypatch.setattr("pagemill.llm.bpe_codec.KEPT_WORDS", kept)
        for _ in range(2):
            assert list(encoder.round_trip(texts)) == want
    assert not any(len(w) > 48 for w in encoder.packed)
    assert encoder.packed.keys() == encoder.decoded.keys()
