"""The operators on odd documents against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import collections
import functools
import math
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from weftline.llm import encoding, lines, lm, ngram_join, packing, quality, sharding, spotsigs, substrings, urls

from . import cases

DOCS = cases.odd_documents()
REPEATS = [(0, DOCS[0]), (None, "a row without id " * 4), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return cases.frame(spark).cache()


@pytest.fixture(scope="module")
def messy(spark):
    return cases.frame(spark, extra=REPEATS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return cases.frame(spark, {}).limit(0)


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(encoding.word_vocabulary())


def test_quality(docs, messy, empty):
    want = cases.quality(DOCS)
    got = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    assert {k: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for k, r in got.items()} == want
    assert all(not r.kept for r in got.values() if r.base_failed)
    assert quality.quality_rules(messy).count() == len(DOCS) + 3
    assert quality.quality_rules(empty).count() == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.kept}


def test_quality_rejects_bad_hosts(spark):
    good, bad = " ".join(f"g{k}" for k in range(30)), "too short"
    rows = [(k, good if k % 10 == 0 else bad, "bad") for k in range(200)] + [(1000 + k, good if k % 10 else bad, f"ok{k % 5}") for k in range(200)]
    got = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert all(not r.kept for r in got if r.host == "bad")
    assert all(r.kept == (not r.base_failed) for r in got if r.host != "bad")


def test_lattice(docs, messy, empty):
    want, n = collections.Counter(), 0
    split = {k: [w.lower() for w in cases.words_of(t)] for k, t in DOCS.items()}
    for k, w in split.items():
        if zlib.crc32(str(k).encode()) % 10:
            want.update([*w, b"\n"])
            n += len(w) + 1
    v = len(want)
    a, b = ({r.doc_id: r for r in lm.score(docs, frequent_words=x).collect()} for x in (50, 0))
    words = lm.count_words(docs.select("text", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0).alias("train")), "text")
    n_docs = want[b"\n"]
    pieces, single, end, _ = lm.piece_scores(words, n_docs, lm.piece_vocabulary())
    for k, w in split.items():
        base = sum(math.log10((want[x] + 0.1) / (n + 0.1 * (v + 1))) for x in [*w, b"\n"])
        model = sum(math.log10((want[x] + v * (math.exp(end) if x == b"\n" else segmentations(x.decode(), pieces, single))) / (n + v)) for x in [*w, b"\n"])
        for r in (a[k], b[k]):
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(k).encode()) % 10 == 0, len(w) + 1, sum(want[x] > 0 for x in [*w, b"\n"]), n)
            assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(model, rel=1e-9)
    more = collections.Counter((r.doc_id, r.n_tokens) for r in lm.score(messy).collect())
    assert more == collections.Counter([(k, len(w) + 1) for k, w in split.items()] + [(k, len(cases.words_of(t)) + 1) for k, t in REPEATS])
    assert lm.score(empty).count() == 0


@functools.cache
def _paths(word, table):
    """The sum over all ways to spell a word with pieces or with the bytes of single characters, longest pieces last."""
    if not word:
        return 1.0
    pieces, single = TABLES[table]
    total = math.exp(sum(single[x] for x in word[0].encode())) * _paths(word[1:], table)
    return total + sum(math.exp(pieces[word[:j]]) * _paths(word[j:], table) for j in range(1, len(word) + 1) if word[:j] in pieces)


TABLES = {}


def segmentations(word, pieces, single):
    TABLES[id(pieces)] = pieces, single
    return _paths("\u2581" + word, id(pieces))


def test_lattice_sums_all_segmentations():
    pieces, single = {"▁": math.log(0.1), "▁a": math.log(0.2), "a": math.log(0.3), "ab": math.log(0.05), "b": math.log(0.1)}, [-50.0] * 256
    want = 0.1 * 0.3 * 0.1 + 0.2 * 0.1 + 0.1 * 0.05
    assert math.exp(lm.lattice("ab", pieces, single, 2)) == pytest.approx(want, rel=1e-9)


def test_partenum(docs, messy, empty):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_groups(docs).collect()}
    assert got == cases.linked(DOCS)
    more = [tuple(r) for r in ngram_join.similar_groups(messy).collect()]
    assert len(more) == len(DOCS) + 3 and {(k, n, c) for k, n, c in more if k is not None} == {(k, *v) for k, v in got.items()}
    assert ngram_join.similar_groups(empty).count() == 0


def test_components(spark, monkeypatch):
    """Chains, cycles and random pairs, with least partners broadcast and joined."""
    from weftline.llm import components as module

    pairs = [(i, i + 1) for i in range(100, 120)] + [(200, 201), (201, 202), (202, 200), (7, 7), (300, 301), (301, 300)] + [(400 + i * i % 37, 400 + i * 5 % 41) for i in range(30)]
    root = {x: x for p in pairs if p[0] != p[1] for x in p}
    for _ in root:
        for a, b in pairs:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    for limit in (32 << 20, 0):
        monkeypatch.setattr(module, "BROADCAST_BYTES", limit)
        assert dict(map(tuple, module.components(spark.createDataFrame(pairs, "a long, b long")).collect())) == root
    assert module.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_partenum_large_buckets(spark):
    """One passage in many documents, and a chain of near copies: stars alone would miss links."""
    import random

    r = random.Random(5)
    w = [f"x{k}" for k in range(5000)]
    passage = [r.choice(w) for _ in range(60)]
    docs = {k: " ".join([*[r.choice(w) for _ in range(r.randrange(4, 30))], *passage, *[r.choice(w) for _ in range(r.randrange(4, 30))]]) for k in range(120)}
    x = [r.choice(w) for _ in range(100)]
    for k in range(60):
        x[(k * 7) % 100] = r.choice(w)
        docs[1000 + k] = " ".join(x)
    got = {a.doc_id: (a.n_shingles, a.component_id) for a in ngram_join.similar_groups(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(6)).collect()}
    assert got == cases.linked(docs)


def test_partenum_row_without_id_first(spark):
    """A row without id comes before equal and near texts in the same task, and more equal texts are in other tasks."""
    w = [f"y{k}" for k in range(60)]
    text, near = " ".join(w), " ".join([*w, "tail"])
    docs = {1: text, 2: text, 3: near, 4: text, 5: text, 6: near, 7: "another text of its own here"}
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    first = frame([(None, text), (None, near), *[(k, docs[k]) for k in (1, 2, 3, 7)]])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_groups(first.union(frame([(k, docs[k]) for k in (4, 5, 6)]))).collect()}
    assert got.pop(None)[1] is None
    assert got == cases.linked(docs)


def test_partenum_many_signatures_in_a_group(spark):
    """Two equal sets in two tasks with more than 65,535 signatures of each in one group."""
    text = " ".join(f"z{k}" for k in range(90_000))
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string").repartition(2, "doc_id")
    packed = ngram_join._signature_rows(docs.union(docs), 1, 5, 75, 100)
    assert max(len(r.sigs) for r in packed.filter("sigs IS NOT NULL").select("sigs").collect()) > 65_535 * ngram_join.SIGNATURE_BYTES
    rows = packed.groupBy("p").applyInArrow(ngram_join._pairs_of_group, ngram_join._OUT).filter(f"kind = {ngram_join.PAIR}")
    assert rows.count() > 0


def test_bpe(docs, messy, empty):
    t = tokenizer()
    got = {r.doc_id: r for r in encoding.encode(docs).collect()}
    for k, text in DOCS.items():
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert (got[k].n_tokens, got[k].ids) == (len(ids), " ".join(map(str, ids)))
        assert got[k].decoded == t.decode(ids, skip_special_tokens=False)
    assert encoding.encode(messy, digest=True).count() == len(DOCS) + 3
    assert encoding.encode(empty).count() == 0


def test_bpe_odd_characters():
    t, e = tokenizer(), encoding.Encoder(encoding.word_vocabulary())
    for text in ("\x1cab\x1fcd\x85e​f　g", "İstanbul K ǅ ﬁ Ⅷ x²", "日本語 👍🏽👍", "a ̸=b = ̸x é", "<|ENDOFTEXT|> <|endoftext|><|startoftext|>x", "\x00\x01 ab\x7f don''t '' 'sss"):
        ids = t.encode(text, add_special_tokens=False).ids
        assert e.batch([text])[0] == (len(ids), " ".join(map(str, ids)), t.decode(ids, skip_special_tokens=False))


def jump(key: int, n: int) -> int:
    b, j = -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_sharding(spark, messy, empty):
    keys = [0, 1, 2, -1, 2**63 - 1, -(2**63), 123456789012345]
    for n in (1, 2, 24, 25):
        got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect()
        assert {r.k: r.s for r in got} == {k: jump(k % 2**64, n) for k in keys}
    rows = sharding.assign_shards(messy).collect()
    assert len(rows) == len(DOCS) + 3
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24 and r.law == "key"
        if r.doc_id is not None:
            raw = (DOCS[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
            h = xxhash.xxh64_intdigest(str(r.doc_id).encode(), seed=42)
            assert (r.shard, r.grown_shard) == (jump(h, 24), jump(h, 25))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign_shards(empty).count() == 0


def test_sharding_cells(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 3)
    rows = sharding.assign_shards(spark.range(500).selectExpr("id AS doc_id", "CAST(id AS string) AS text")).collect()
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 24


def test_spotsigs(docs, messy, empty, monkeypatch):
    monkeypatch.setattr(spotsigs, "CELL_ROWS", 20)
    got = {r.doc_id: r for r in spotsigs.fingerprints(docs).collect()}
    ids = sorted(DOCS)
    for k, nxt in zip(ids, ids[1:] + ids[:1], strict=True):
        t, o, r = DOCS[k] or "", DOCS[nxt] or "", got[k]
        assert r.edited == t[: len(t) - len(t) // 4] + o[: len(t) // 4] and r.n_chars == len(t)
        a, b, c = set(r.signatures), set(r.edited_signatures), set(got[nxt].signatures)
        near = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert r.near_edited == pytest.approx(near(a, b)) and r.near_next == pytest.approx(near(a, c))
        assert bool(a) == bool(t.split())
        assert len(a) == len(chains(t)) and len(a & c) == len(chains(t) & chains(o)) and len(a & b) == len(chains(t) & chains(r.edited))
    assert got[0].signatures == got[5000].signatures
    assert spotsigs.fingerprints(messy).count() == len(DOCS) + 3
    assert spotsigs.fingerprints(empty).count() == 0


def chains(text) -> set:
    """What a text's fingerprint stands for, word by word."""
    found, plain, words, anchor, last = set(), set(), set(), "start", None
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for x in (w.decode() for w in cases.words_of(text.translate(lower))):
        words.add(x)
        if x.strip(spotsigs.MARKS) in {"", *spotsigs.ANCHORS}:
            anchor = x
            continue
        if last is not None:
            plain.add((last[1], x))
            if last[0] is not None:
                found.add((*last, x))
        last, anchor = (anchor, x), None
    if len(found) < spotsigs.FEW:
        found |= plain
    return found or words


def test_spotsigs_outlying_id(spark, monkeypatch):
    """One id far from all others leaves the cells of the others as they are."""
    monkeypatch.setattr(spotsigs, "CELL_ROWS", 50)
    ids = [*range(1000), 2**62]
    d, _ = spotsigs.in_cells(spark.createDataFrame([(k, f"text {k}") for k in ids], "doc_id long, text string").repartition(4), "doc_id", "text")
    assert max(r["count"] for r in d.filter("_end = 0").groupBy("_cell").count().collect()) <= 200
    got = {r.doc_id: r for r in spotsigs.fingerprints(spark.createDataFrame([(k, "abcdefgh" + str(k)) for k in ids], "doc_id long, text string")).collect()}
    for k, nxt in zip(ids, [*ids[1:], 0], strict=True):
        t, o = f"abcdefgh{k}", f"abcdefgh{nxt}"
        assert got[k].edited == t[: len(t) - len(t) // 4] + o[: len(t) // 4]


def test_urls(spark):
    made = [(1, "http://a.example.com/en/712?x"), (2, "http://example.net/de/81"), (3, "https://B.Example.NET/de/7#t"), (4, "nothing"), (5, None), (6, "x://h.org/es/"), (7, "http://notcom/en/1"), (8, "http://q.com?en/")]
    pages = spark.createDataFrame(made + [(100 + k, f"http://bad.site.io/{k}") for k in range(60)] + [(200 + k, f"http://good.io/{k}") for k in range(60)], "page_id long, url string")
    labels = spark.createDataFrame([(100 + k, 0, 0) for k in range(60)] + [(200 + k, 1, 0) for k in range(60)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in urls.judge_urls(pages, labels).collect()}
    assert [got[k][1:5] for k in range(1, 9)] == [
        ("a.example.com", "/en/712", "example.com/en/7", "allow"), ("example.net", "/de/81", "example.net/de/8", "block"), ("b.example.net", "/de/7", "net/de/", "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("h.org", "/es/", "org/es/", "block"), ("notcom", "/en/1", None, "allow"), ("q.com", "", None, "allow"),
    ]
    assert all(got[100 + k].verdict == "block" and got[200 + k].verdict == "allow" for k in range(60))
    assert urls.judge_urls(pages.limit(0), labels).count() == 0 and urls.judge_urls(pages, labels.limit(0)).count() == 128


def test_bucket_pointers(docs, messy, empty):
    want = cases.substrings(DOCS)
    for hot in (2000, 2):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, cases.sha(bytes(r.kept))) for r in substrings.dedup_substrings(docs, hot=hot).collect()}
        assert got == want
    rows = substrings.dedup_substrings(messy).collect()
    assert len(rows) == len(DOCS) + 3 and {(r.doc_id, r.n_removed) for r in rows if r.doc_id is not None} == {(k, v[1]) for k, v in want.items()}
    assert substrings.dedup_substrings(empty).count() == 0


def test_bucket_pointers_sort():
    text = np.frombuffer(b"abracadabra" * 20 + b"x" * 90 + b"abracadabra" * 10, np.uint8)
    at = np.arange(len(text) - 50)
    p = substrings.bucket_pointers(text, at)
    by = collections.defaultdict(set)
    for i in at:
        by[text[i : i + 50].tobytes()].add(int(p[i]))
    assert all(len(v) == 1 for v in by.values()) and len({next(iter(v)) for v in by.values()}) == len(by)


def test_packing(docs, messy, empty):
    t = tokenizer()
    want = {k: np.array([*t.encode(x or "", add_special_tokens=False).ids, 2]) for k, x in DOCS.items()}
    rows, placed, seqs = packing.pack(docs).collect(), collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        assert r.ids == want[r.doc_id][r.start : r.start + r.length].tolist() and r.doc_tokens == len(want[r.doc_id])
        placed[r.doc_id].append((r.start, r.length))
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts, total in [(p, len(want[k])) for k, p in placed.items()] + [(s, None) for s in seqs.values()]:
        at = 0
        for a, n in sorted(parts):
            assert a == at
            at += n
        assert at == total if total else at <= 4096
    assert len(placed) == len(DOCS)
    assert packing.pack(messy, digest=True).filter("start = 0").count() == len(DOCS) + 3
    assert packing.pack(empty).count() == 0


def test_cuts_are_cheapest():
    r = np.random.default_rng(3)
    for _ in range(20):
        ends = np.unique(r.integers(1, 400, 12))
        total = int(ends[-1])
        stops = np.unique(r.integers(1, total, 25))
        found = packing.cuts(total, ends, stops, 64)
        places = sorted({0, total, *ends.tolist(), *stops.tolist()})
        long = [(a, b) for a, b in zip(places, places[1:], strict=False) if b - a > 64]
        places = sorted({*places, *[p for a, b in long for p in range(a + 64, b, 64)]})
        pen = {p: 0 if p in ends else 8 if p in stops else 64 for p in places}
        cost = {0: 0}
        for j in places[1:]:
            cost[j] = min(cost[i] + (0 if j - i in (32, 16) else 64 - (j - i)) for i in places if i < j <= i + 64) + pen[j]
        mine, at = 0, 0
        for j in found:
            mine += (0 if j - at in (32, 16) else 64 - (j - at)) + pen[j]
            at = j
        assert mine == cost[total]


def test_line_dedup(docs, messy, empty):
    want = cases.lines(DOCS)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text if r.kept_text is not None else DOCS[r.doc_id] or "") for r in lines.dedup_lines(docs).collect()}
    assert got == want
    assert sum(v[1] for v in want.values()) > 0
    assert lines.dedup_lines(messy).count() == len(DOCS) + 3
    assert lines.dedup_lines(empty).count() == 0


def test_line_dedup_hot_line(spark, capsys):
    """One line that most rows have, some several times, in documents without an id too; the plan sorts within ranges and shuffles once."""
    hot = "The Line That Almost All Documents Have"
    docs = {k: "\n".join([f"own line number {k} of its own", *[hot] * (1 + k % 3), f"tail {k}"]) for k in range(300)}
    x = spark.createDataFrame([*docs.items(), (None, hot), (7, docs[7])], "doc_id long, text string").repartition(6)
    got = collections.Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text if r.kept_text is not None else docs[r.doc_id]) for r in lines.dedup_lines(x).collect())
    want = collections.Counter((k, *v) for k, v in cases.lines(docs).items())
    want.update([(7, *cases.lines(docs)[7]), (None, 1, 1, "")])
    assert got == want
    lines.first_lines(lines.line_hashes(x, "doc_id", "text", 20), 4).explain()
    plan = capsys.readouterr().out
    assert "Sort [h" in plan and "Window [row_number()" in plan and plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan


def test_bucket_pointers_repeated_and_null_ids(spark):
    """Rows with one id lose nothing to each other; rows without id lose to all others and nothing to each other."""
    a, b = "".join(chr(97 + k % 26) for k in range(0, 7 * 90, 7)), "0123456789" * 3
    rows = [(1, b + a[:60]), (1, a[:60] + b), (None, a[:70]), (None, a[:70] + "!"), (2, a[5:60])]
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == collections.Counter([(1, 90, 0, 0, rows[0][1].encode()), (1, 90, 0, 0, rows[1][1].encode()), (None, 70, 60, 1, a[60:70].encode()), (None, 71, 60, 1, (a[60:70] + "!").encode()), (2, 55, 55, 1, b"")])


def test_bucket_pointers_same_stretch_twice(spark):
    """A stretch that one document has twice, of which only a part is in a smaller one: both lose that part."""
    a, b = "".join(chr(97 + k % 26) for k in range(0, 7 * 70, 7)), "ZYXWVUTSRQPONMLKJIHGFEDCBA9876543210"
    docs = {1: a[:60] + "!?", 2: a[4:70] + b + "#" * 3 + a[4:70] + b, 3: a[:60] + "%" + a[10:70]}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, cases.sha(bytes(r.kept))) for r in substrings.dedup_substrings(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert got == cases.substrings(docs)
