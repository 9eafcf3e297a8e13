import hashlib
import random
import time
import tracemalloc

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skein.llm import bpe

from .messy import messy, messy_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.Tables.read(PATH))


def test_random_texts_equal_the_library(codec, library):
    draw = random.Random(7)
    signs = "abcdexyzthe ing   ABC éßΣİ'’.!12²٣́‍中\t\n\x1f\xa0<|>"
    batch = ["".join(draw.choices(signs, k=draw.randint(0, 60))) for _ in range(1500)]
    batch += ["it's IT'S we'll <|endoftext|>x <|startoftext|><|endoftext|>", "aaaa" * 2000, "zq" * 50 + " the", "ﬁ Å ǅ"]
    wanted = library.encode_batch(batch, add_special_tokens=False)
    found = list(codec.encode_batch(batch))
    assert found == [w.ids for w in wanted]
    assert [codec.decode(ids) for ids in found] == [library.decode(w.ids, skip_special_tokens=False) for w in wanted]


def test_only_failing_words_are_merged(codec):
    codec.words.clear()
    codec.tried = codec.failed = 0
    codec.learn({"the", "house", "zxqvjw", "photosynthesis"})
    assert codec.tried == 4 and codec.failed < 4


def test_merging_long_words_equals_merging_in_arrays(codec):
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefghio", k=draw.randint(1, 40))).encode() for _ in range(200)]
    assert codec.merge_all(words) == [codec.merge_long(w) for w in words]


def test_messy_table(spark, library):
    rows = bpe.round_trip_digests(messy(spark), PATH).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    wanted = []
    for key, text, *_ in messy_rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        wanted.append((key, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, rows), key=repr) == sorted(wanted, key=repr)
    assert bpe.round_trip_digests(messy(spark, 0), PATH).collect() == []


def test_encode_then_decode(spark, library):
    encoded = bpe.encode(messy(spark), PATH)
    texts = {(r.doc_id, r.text) for r in bpe.decode(encoded, PATH).collect()}
    assert texts == {(k, library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False))
                     for k, t, *_ in messy_rows()}


def test_a_very_long_word_is_merged_alone(codec, library):
    start = time.time()
    for text in ("x" * 200_000, "語" * 60_000, "ab" * 40 + " " + "y" * 65):
        assert next(codec.encode_batch([text])) == library.encode(text, add_special_tokens=False).ids
    assert time.time() - start < 20


def test_a_remembered_word_takes_few_bytes(codec):
    draw = random.Random(5)
    words = {"".join(draw.choices("abcdefghio", k=10)) for _ in range(20_000)}
    codec.words.clear()
    codec.learn({"the"})
    tracemalloc.start()
    try:
        codec.learn(words)
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert len(codec.words) == len(words) + 1 and held < 160 * len(words)  # the words themselves were made before
