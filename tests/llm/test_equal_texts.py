"""Texts that are equal but for white space and case: one stands for all, none is lost."""

import pytest
from weftline.llm import ngram_join, shared

from . import cases

WORDS = [f"w{k}" for k in range(60)]


@pytest.mark.parametrize("limit", [shared.BROADCAST_BYTES, 0])
def test_equal_texts(spark, monkeypatch, limit):
    monkeypatch.setattr(ngram_join, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(ngram_join.join_small, "__defaults__", (*ngram_join.join_small.__defaults__[:-1], limit))
    a, b, near = " ".join(WORDS), " ".join(WORDS[::-1]), " ".join(WORDS[:-1] + ["other"])
    docs = {k: a if k % 2 else a.upper().replace(" ", "\n\t ") for k in range(40, 90)}  # one large group
    docs |= {5: b, 6: b, 20: near, 30: "", 31: None, 32: " ", 33: "one two", 34: "ONE  two", 35: "two one"}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_groups(cases.frame(spark, docs)).collect()}
    assert got == cases.linked({k: t for k, t in docs.items()})
    assert got[89] == (56, 20) and got[6] == (56, 5) and got[34] == (1, 33) and got[35] == (1, 35) and got[31] == (0, 31)


def test_an_id_of_two_texts_links_both(spark):
    """Id 7 has the texts of 3 and of 9, so all three are one component; rows without id stand for nothing."""
    a, b = " ".join(WORDS), " ".join(WORDS[::-1])
    rows = [(3, a), (7, a), (7, b), (9, b), (None, a), (None, b), (11, a), (12, b)]
    got = ngram_join.similar_groups(cases.frame(spark, {}, extra=rows)).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (-1, -1), (3, 3), (7, 3), (7, 3), (9, 3), (11, 3), (12, 3)]
