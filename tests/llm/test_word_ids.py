"""Ids of new words, many of which are encoded as one text."""

import numpy as np
from weftline.llm import packing
from weftline.llm.encoding import word_vocabulary


def test_words_encoded_together_have_their_own_ids():
    """Words that have the token put between words, or letters and marks of all kinds, are told apart."""
    own = packing.WordIds(word_vocabulary())
    plain = [f"word{k}" for k in range(600)] + ["É", "é", "́", "'s", "don't", "<|endoftext|>", "你好", "x"]
    odd = ["|", "a|", "|b", "||", "a|b", "｜", "<|", "|>"]
    for words in (plain, plain + odd, odd, ["|"], [plain[0]], []):
        ids, sizes = own.ids_of(words)
        want = [own.library.encode(w, add_special_tokens=False).ids for w in words]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    own.between = None  # a vocabulary without such a word
    ids, sizes = own.ids_of(["a", "bc|"])
    assert len(ids) == sizes.sum() and ids.dtype == np.uint32


def test_new_words_are_encoded_as_few_texts():
    own, asked = packing.WordIds(word_vocabulary()), []

    class Library:
        def encode_batch_fast(self, texts, **more):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **more)

    library, own.library = own.library, Library()
    words = [f"w{k}" for k in range(2000)]
    ids, ends, _ = own.encode([" ".join(words), None, ""])
    assert len(asked) <= 4 and ends.tolist()[1:] == [len(ids) - 1, len(ids)]
    assert ids.tolist() == library.encode(" ".join(words), add_special_tokens=False).ids + [packing.END_ID] * 3
