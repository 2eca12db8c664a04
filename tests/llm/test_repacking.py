"""Certified repacking: ids against the library, bounds against all packings, sequences against their contract."""

import collections
import itertools
import random
import zlib

import numpy as np
import pytest
from weftline.llm import repacking

from . import cases

ODD_TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  ", "  a", "a b", "a  b", "a   b", "\n", "\n\n", "a\n", "\na", "a\nb", "a\n\nb", "a\n\n\nb", "a \nb", "a\n b", "a \n b", "a\n\n b.", "a\t b", "a \tb", "a b", "a  b", "a  b", "a　　b",
    "don't 'tis I'll", "end.\nStart, x.y 3.14 ,,", "\x1c a\x1cb  c", "a\0b \0", "x <|endoftext|> y", "x  <|endoftext|>  y", "<|endoftext|>", "Über straße. naïve, Ελλάδα. 日本語、テスト。 ퟿", "a" * 3000, " " * 500, "\n" * 77 + "x", "😀 😀.\n😀",
]


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(repacking.byte_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def test_ids_are_the_library_s():
    r = random.Random(8)
    parts = ["a", "Wort", "don't", ".", ",", " ", "  ", "\n", "\t", "\r\n", " ", " ", "7", "é", "ß.", "日本", "!?", "\x1f", "\x85"]
    texts = ODD_TEXTS + ["".join(r.choice(parts) for _ in range(r.randrange(1, 30))) for _ in range(3000)] + [t for t in cases.odd_documents().values() if t]
    own, lib = repacking.ByteIds(repacking.byte_vocabulary()), library()
    ids, ends = own.encode([*texts, None])
    begin = 0
    for t, e in zip(texts, ends.tolist(), strict=False):
        assert ids[begin:e].tolist() == [*lib.encode(t, add_special_tokens=False).ids, 0], repr(t)
        begin = e
    assert ends[-1] == ends[-2] + 1


def fewest(lengths, window):
    """The least number of sequences, by trying all placements."""
    best = len(lengths)

    def place(k, free):
        nonlocal best
        if len(free) >= best:
            return
        if k == len(lengths):
            best = len(free)
            return
        for i in {f: i for i, f in enumerate(free) if f >= lengths[k]}.values():
            place(k + 1, [*free[:i], free[i] - lengths[k], *free[i + 1 :]])
        place(k + 1, [*free, window - lengths[k]])

    place(0, [])
    return best


def test_bound_and_best_fit():
    r, certified = random.Random(6), 0
    for _ in range(400):
        window = r.choice([10, 16, 30])
        lengths = np.array([r.randrange(1, window + 1) for _ in range(r.randrange(1, 10))])
        least = repacking.bound(np.bincount(lengths, minlength=window + 1), window)
        sequence, offset, free = repacking.best_fit(lengths, window)
        best = fewest(sorted(lengths.tolist(), reverse=True), window)
        assert -(-lengths.sum() // window) <= least <= best <= len(free)
        certified += least == len(free)
        for s in range(len(free)):
            own = sorted((o, n) for q, o, n in zip(sequence, offset, lengths, strict=True) if q == s)
            assert [o for o, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1] and window - sum(n for _, n in own) == free[s]
    assert certified > 300
    # Three of these share no sequence and two leave room that nothing fills: total length alone says 5.
    assert repacking.bound(np.bincount([6] * 8, minlength=11), 10) == 8
    assert repacking.bound(np.bincount([4] * 9, minlength=11), 10) == 5


def check(rows, docs, window, digest=False, keys=None):
    """All pieces of all documents once, in sequences without gaps; gives the number of sequences."""
    lib, by_doc, by_sequence = library(), collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(docs)
    for k, t in docs.items():
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        own = sorted(by_doc[k], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and [r.start for r in own] == [0, *itertools.accumulate(r.length for r in own)][:-1] and sum(r.length for r in own) == len(ids)
        assert all(r.length == window for r in own[1:]) and 0 < own[0].length <= window
        for r in own:
            x = ids[r.start : r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(np.array(x, "<u4").tobytes()) if digest else r.ids == x
    for own in by_sequence.values():
        own.sort()
        assert [o for o, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1] and sum(n for _, n in own) <= window
    return len(by_sequence)


@pytest.mark.parametrize("window,digest", [(2048, True), (64, False), (7, True)])
def test_repack(spark, window, digest, monkeypatch):
    monkeypatch.setattr(repacking, "GROUP_SEQUENCES", 16)
    docs = cases.odd_documents()
    df = cases.frame(spark, docs)
    got = repacking.repack(df, window=window, digest=digest).collect()
    n = check(got, docs, window, digest)
    lengths = np.array([r.length for r in got])
    assert got[0].least == repacking.bound(np.bincount(lengths, minlength=window + 1), window)
    # At most two sequences more than best-fit decreasing over the whole table at once.
    assert got[0].least <= n <= len(repacking.best_fit(lengths, window)[2]) + 2


def test_exchange_between_partitions(spark):
    """Long documents in one partition and short ones in another: neither can fill its sequences alone."""
    long_, short = [" ".join(["a"] * 29)] * 60, [" ".join(["a"] * 9)] * 60  # 30 and 10 tokens
    docs = dict(enumerate(long_ + short))
    df = cases.frame(spark, docs).drop("key").repartitionByRange(2, "doc_id")
    rows = repacking.repack(df, window=40).collect()
    assert {r.length for r in rows} == {30, 10} and rows[0].least == 60
    assert check(rows, docs, 40) == 60


def test_repeated_rows_and_none(spark):
    df = cases.frame(spark, {1: "x y z", 2: None, 3: ""}, extra=[(1, "x y z"), (None, "no id"), (None, None)])
    rows = repacking.repack(df, window=4).collect()
    assert collections.Counter((r.doc_id, r.length) for r in rows) == {(1, 4): 2, (2, 1): 1, (3, 1): 1, (None, 3): 1, (None, 1): 1}
    assert len({r.sequence_id for r in rows}) == rows[0].least == 4
    out = repacking.repack(df.limit(0))
    assert out.count() == 0 and out.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset", "least"]
