import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, nothing
from hypothesis import example, given, settings
from hypothesis import strategies as st

from tidemark.llm.piece_agenda import MODEL, Codec, Vocabulary, by_heap, coded


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(public_tokenizers.path(MODEL))


ALPHABET = st.sampled_from(list("abehinorst ABC\t\n▁éßñ日本語🎉<>/0x12'\x00"))


@settings(max_examples=300, deadline=None)
@example("")
@example("  ")
@example("▁")
@example("a" * 200)
@example(" ▁ a▁b  <s> </s> <0x41> <unk> ")
@given(st.text(ALPHABET, max_size=120) | st.text(max_size=40))
def test_equals_the_library(text):
    global _codec
    if "_codec" not in globals():
        _codec = Codec(Vocabulary(public_tokenizers.path(MODEL)))
    library = _codec.vocabulary.library
    want = library.encode(text, add_bos=True, add_eos=True)
    (got,) = _codec.encode([text])
    assert np.frombuffer(got, "<u4").tolist() == want
    assert _codec.decode(got) == library.decode(want)


def test_heap_and_lock_step_agree(vocabulary):
    codec = Codec(vocabulary)
    long = Codec(vocabulary)
    long.long_word = 0
    texts = ["the internationalisation of unbelievably antidisestablishmentarian sentences", "ééé日本" * 9]
    assert codec.encode(texts) == long.encode(texts)
    assert by_heap(vocabulary, []) == []


def test_kept_words_may_be_dropped_any_time(vocabulary):
    codec, small = Codec(vocabulary), Codec(vocabulary)
    small.most_kept = 1
    texts = ["one two three", "three two one", "one  two"]
    assert [small.encode([t])[0] for t in texts] == codec.encode(texts)


def test_awkward_rows(spark, vocabulary):
    docs = awkward(spark, clash=("ids", "code", "row"))
    rows = coded(docs).collect()
    assert len(rows) == docs.count() and all(r.agrees for r in rows)
    for r in rows:
        want = vocabulary.library.encode(r.text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        assert r.decoded == vocabulary.library.decode(want)
    assert coded(nothing(spark)).count() == 0


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_every_document_of_the_samples_agrees_with_the_library(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    assert coded(docs).where("NOT agrees").count() == 0
