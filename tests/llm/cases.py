"""Small documents with all that may go wrong, and brute-force versions of the operators."""

from __future__ import annotations

import collections
import hashlib
import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, host string, tag string, id long, p int, _t string, kept string, n_lines int"


def odd_documents() -> dict:
    """doc_id to text: near copies, common passages and lines, runs, empty and null texts, one very long text."""
    r = random.Random(11)
    words = ["of", "the", "and", "to", "in", "Über", "é", "|", "don't"] + [f"w{k}" for k in range(900)]
    passages = [" ".join(r.choice(words) for _ in range(30)) for _ in range(6)]
    docs, k = {}, 0
    for size in (1, 3, 5, 8, 12, 30, 90, 200):
        base = [r.choice(words) for _ in range(size)]
        for _ in range(4):
            x = list(base)
            for _ in range(r.randrange(0, size // 20 + 2)):
                x[r.randrange(len(x))] = r.choice(words)
            docs[k] = " ".join(x)
            k += 3
    for _ in range(60):
        x = [r.choice(passages)[r.randrange(0, 30) :] if r.random() < 0.4 else "ab" * r.randrange(1, 60) if r.random() < 0.2 else " ".join(r.choice(words) for _ in range(r.randrange(1, 25))) for _ in range(r.randrange(1, 6))]
        docs[k] = r.choice(["\n", " ", "\n\n  "]).join(x)
        k += 2
    docs |= {5000: docs[0], 5001: docs[9], 5002: None, 5003: "", 5004: " \n\t", 5005: "é" * 60, 5006: "xé" + "é" * 60, 5007: "A  b", 5008: "a B", 5009: "-" * 200, 5010: "\n\n", 5011: "x <|endoftext|> it's ΣΑΣ"}
    docs[6000] = " ".join(r.choice(words) for _ in range(20_000))
    docs[6001] = docs[6000] + " more"
    for n in range(4):
        docs[7000 + n] = f"own {n} line here\n  The Common Line of All Texts \nown {n} tail\nthe common line of all texts"
    return docs


def frame(spark, docs: dict | None = None, extra: list | None = None):
    """The documents with columns whose names the operators use inside; ``extra`` rows repeat ids or lack them."""
    docs = odd_documents() if docs is None else docs
    rows = [(k, t) for k, t in docs.items()] + list(extra or [])
    return spark.createDataFrame([(k, t, "en", f"s{n % 3}" if n % 7 else None, len(t or ""), "h", "g", 1, 2, "t", "k", 3) for n, (k, t) in enumerate(rows)], SCHEMA).repartition(5)


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def words_of(t) -> list[bytes]:
    return (t or "").encode().split()


def linked(docs: dict) -> dict:
    """doc_id to (number of shingles, component) with all pairs compared that have a shingle in common."""
    sets = {}
    for k, t in docs.items():
        w = [x.lower() for x in words_of(t)]
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    inverted, common = collections.defaultdict(list), collections.Counter()
    for k, s in sets.items():
        for x in s:
            inverted[x].append(k)
    for v in inverted.values():
        common.update((v[i], v[j]) for i in range(len(v)) for j in range(i + 1, len(v)))
    root = {k: k for k in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), c in common.items():
        if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), find(k)) for k in docs}


def whole_characters(docs: dict) -> dict:
    """doc_id to the text without all characters that lose a byte."""
    out = {}
    for k, (t, gone) in covered(docs).items():
        at, kept = 0, []
        for c in t.decode():
            n = len(c.encode())
            if not any(gone[at : at + n]):
                kept.append(c)
            at += n
        out[k] = "".join(kept)
    return out


def covered(docs: dict) -> dict:
    """doc_id to its bytes and a mask of those that go."""
    first, out = {}, {}
    for k in sorted(docs):
        t = (docs[k] or "").encode()
        gone = bytearray(len(t))
        for i in range(len(t) - 49):
            if first.setdefault(t[i : i + 50], k) < k:
                gone[i : i + 50] = b"\1" * 50
        out[k] = (t, gone)
    return out


def substrings(docs: dict) -> dict:
    """doc_id to (bytes, removed, spans, hash of the rest)."""
    out = {}
    for k, (t, gone) in covered(docs).items():
        out[k] = (len(t), sum(gone), sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1])), sha(bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return out


def lines(docs: dict) -> dict:
    """doc_id to (lines, dropped, kept text)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = {k: (t or "").split("\n") for k, t in docs.items()}
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(lower)
    holders = collections.defaultdict(set)
    for k, ls in split.items():
        for x in ls:
            holders[key(x)].add(k)
    out = {}
    for k, ls in split.items():
        kept = [x for x in ls if not (len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and max(holders[key(x)]) != k)]
        out[k] = (len(ls), len(ls) - len(kept), "\n".join(kept))
    return out


def quality(docs: dict) -> dict:
    """doc_id to (words, their characters, symbols, repeated lines, repeated words, failed)."""
    out = {}
    for k, t in docs.items():
        t = t or ""
        w = [x.decode() for x in words_of(t)]
        at = collections.defaultdict(list)
        for i in range(len(w) - 7):
            at[tuple(w[i : i + 8])].append(i)
        covered = {i + j for v in at.values() if len(v) > 1 for i in v for j in range(8)}
        ls = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        out[k] = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(ls) - len(set(ls)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w))
    return out
