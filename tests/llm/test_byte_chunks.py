"""Ids of new chunks of a byte vocabulary, many of which are encoded as one text."""

import pytest
from weftline.llm import repacking
from weftline.llm.repacking import ByteIds, byte_vocabulary

from . import cases
from .test_repacking import ODD_TEXTS, library


class Counting:
    """The library, and the texts it was asked for."""

    def __init__(self, own: ByteIds):
        self.real, self.asked, own.library = own.library, [], self

    def encode_batch_fast(self, texts, **more):
        self.asked += texts
        return self.real.encode_batch_fast(texts, **more)


def want(texts):
    lib = library()
    return [[*lib.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def got(own, texts):
    ids, ends = own.encode(texts)
    return [ids[a:b].tolist() for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]


def test_new_chunks_are_encoded_as_few_texts():
    own = ByteIds(byte_vocabulary())
    lib = Counting(own)
    texts = [" ".join(f"Wörd{k}" for k in range(2000)), "\n".join(f"line{k}, end{k}" for k in range(1000)), None, ""]
    assert got(own, texts) == want(texts)
    assert len(lib.asked) <= 24
    lib.asked.clear()
    assert got(own, texts) == want(texts) and not lib.asked


def test_a_word_before_a_mark_is_not_asked_again():
    own = ByteIds(byte_vocabulary())
    got(own, ["x unheard of"])
    lib = Counting(own)
    texts = ["x unheard, of. unheard."]
    assert got(own, texts) == want(texts) and not lib.asked


@pytest.mark.parametrize("together", [1, 2, 7, 256])
def test_chunks_of_all_kinds_side_by_side(together, monkeypatch):
    monkeypatch.setattr(repacking, "TOGETHER", together)
    own = ByteIds(byte_vocabulary())
    spaced = [f"x{s}y{s}{s}z {s} w\n{s}v{s}" for s in "\t\r\x0b\x0c\x1c\x1f\x85   　\x00\x01​́"]
    marks = ["a., b,. c.. 7. 7, é. ɐ. ß, 日. 日, ́. -, ., , .", "'s. don't, 'll.", "Ġ Ċ Ġa ĊĠ.", "<|endoftext|>. a<|endoftext|>,", "x <|endof text|>, <|endoftext |>"]
    texts = [*ODD_TEXTS, *spaced, *marks, *(t for t in cases.odd_documents().values() if t)]
    assert got(own, texts) == want(texts)
    assert got(own, texts[::-1]) == want(texts[::-1])


def test_the_memo_starts_anew_and_no_place_stays_empty(monkeypatch):
    monkeypatch.setattr(repacking, "MEMO_CHUNKS", 3)
    own = ByteIds(byte_vocabulary())
    for texts in (["a b c d e."], ["e a"], ["e. b"]):
        assert got(own, texts) == want(texts) and len(own.ids) <= 5
    lib = Counting(own)
    lib.encode_batch_fast = lambda *a, **b: 1 / 0
    with pytest.raises(ZeroDivisionError):
        own.encode(["new chunks"])
    own.library = lib.real
    assert got(own, ["new chunks b"]) == want(["new chunks b"])
