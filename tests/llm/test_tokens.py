"""Chunk by chunk encoding gives what the library gives for whole texts."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("public_tokenizers")
from cellindex.llm.tokens import ID, LEADING, WORDS, Encoder, public_path  # noqa: E402

ENCODERS = {
    "word": Encoder(public_path("word_bpe_49k.json"), WORDS, memo=50),
    "byte": Encoder(public_path("byte_bpe_50k.json"), LEADING, memo=50),
}
PIECES = st.sampled_from(
    [" ", "\n", "  ", "\t", "\r\n", "\x1c", "\x85", "\xa0", " ", "　", "\x00", "a", "Word", "THE", "don't", "'S", "'", "é", "é",
     "́", "ΑΣ", "Σ", "İ", "ß", "ǅ", ".", ",", "...", "!!", "?", "|", "<|endoftext|>", "<", "≠", "3", "14", "½", "²", "_", "中", "😀", "µ", "K"]
)


@pytest.mark.parametrize("name", sorted(ENCODERS))
@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(PIECES | st.characters(exclude_categories=["Cs"]), max_size=14).map("".join), min_size=1, max_size=4))
def test_same_ids_as_whole_texts(name, texts):
    encode = ENCODERS[name]
    whole = encode.library.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, ID).tolist() for x in encode.ids(texts)] == [x.ids for x in whole]
    if name == "byte":
        spans = [list(zip(a.tolist(), b.tolist())) for a, b in encode.spans(texts)]
        assert spans == [x.offsets for x in whole]


def test_null_and_empty_have_no_ids():
    assert ENCODERS["word"].ids([None, "", " \n"]) == [b"", b"", b""]


def test_spans_need_all_places():
    with pytest.raises(ValueError):
        ENCODERS["word"].spans(["a"])
