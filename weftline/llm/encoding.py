"""BPE encoding and decoding by a pair occurrence index.

The texts of a partition are taken batch by batch.  A batch's new words become lists of
symbols; an index maps each adjacent pair to all its positions in the batch.  A heap of the
ranks of pairs that occur is worked off in ascending order: a rank is applied at every
position of its pair, left to right, and the lists of the pairs that this breaks and makes
are updated.  What a word became is kept for later batches, up to ``MEMO_WORDS``
words.

Words are found as the public vocabulary file lays down: NFC, white space apart, lower
case, then contractions, runs of letters, single digits, runs of other characters.

Defined results: a null or empty text has no ids; ids of special tokens come only from their
own strings in the text; repeated rows are encoded each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache
from unicodedata import normalize

from pyspark.sql import DataFrame, functions as F

from weftline.llm.shared import documents

#: Words remembered by a Python worker; the memo starts anew beyond.
MEMO_WORDS = 500_000
#: Texts of a partition are taken in pieces of about so many characters.
PIECE_CHARS = 2_000_000


def word_vocabulary() -> str:
    """Place of the public vocabulary; imported here since only workers that encode need it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable symbol of each byte, as byte-level vocabularies write it."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    out = [""] * 256
    for b in plain:
        out[b] = chr(b)
    for k, b in enumerate(rest):
        out[b] = chr(256 + k)
    return out


class Vocabulary:
    """Ids, merges and special tokens of a byte-level BPE file with word ends."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.merges = {}
        for rank, m in enumerate(model["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            pair = (self.ids[left], self.ids[right])
            self.merges.setdefault(pair, (rank, self.ids[left + right]))
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        pattern = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        # The public library's \\s is Unicode White_Space, which U+001C to U+001F are not.
        self.find = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"), regex.V0).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else lambda s: [s]
        self.bytes = byte_symbols()
        self.raw: dict[int, str] = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}

    def symbols(self, word: str) -> list[int]:
        """Ids of a word's bytes; the last has the word's end."""
        b = word.encode()
        s, ids = self.bytes, self.ids
        out = [ids[s[x]] for x in b[:-1]]
        out.append(ids[s[b[-1]] + self.end])
        return out

    def index_merge(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, all words at once: the pair occurrence index."""
        sym: list[int] = []
        ends: list[int] = []
        for w in words:
            sym += self.symbols(w)
            ends.append(len(sym))
        n = len(sym)
        prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
        begin = 0
        for e in ends:  # links stay within a word
            prev[begin], nxt[e - 1] = -1, -1
            begin = e
        merges = self.merges
        where: dict[tuple[int, int], list[int]] = {}
        heap: list[tuple[int, tuple[int, int]]] = []

        def note(pair: tuple[int, int], at: int) -> None:
            if pair in merges:
                if pair in where:
                    where[pair].append(at)
                else:
                    where[pair] = [at]
                    heapq.heappush(heap, (merges[pair][0], pair))

        for i in range(n):
            if nxt[i] >= 0:
                note((sym[i], sym[nxt[i]]), i)
        while heap:
            _, pair = heapq.heappop(heap)
            left, right = pair
            new = merges[pair][1]
            spots = where.pop(pair)
            spots.sort()
            for i in spots:
                j = nxt[i]
                if j < 0 or sym[i] != left or sym[j] != right:  # an earlier merge took it
                    continue
                sym[i], sym[j] = new, -1
                k = nxt[i] = nxt[j]
                nxt[j] = -1
                if k >= 0:
                    prev[k] = i
                    note((new, sym[k]), i)
                if prev[i] >= 0:
                    note((sym[prev[i]], new), prev[i])
        out, begin = [], 0
        for e in ends:
            out.append([x for x in sym[begin:e] if x >= 0])
            begin = e
        return out

    def words(self, text: str) -> list[str]:
        """Words of a text in order; a special token's string stands for itself."""
        if "<|" not in text:
            return self.find(normal(text))
        out: list[str] = []
        for part in self.cut(text):
            out += [part] if part in self.special else self.find(normal(part))
        return out

    def spelled(self, ids: list[int]) -> str:
        """The decoder for ids of a file without a decoder: token strings joined by spaces."""
        return " ".join(self.raw[i] for i in ids if i in self.raw)


def normal(s: str) -> str:
    """NFC, then the lower case of each character by itself: no final sigma."""
    if s.isascii():
        return s.lower()
    s = normalize("NFC", s)
    return s.lower() if "\u03a3" not in s else "".join(map(str.lower, s))


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes batches of texts; remembers what words became."""

    def __init__(self, path: str):
        self.v = vocabulary(path)
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, str] = {}

    def learn(self, new: set[str]) -> None:
        special = self.v.special
        words = sorted(w for w in new if w not in special)
        for w, own in zip(words, self.v.index_merge(words), strict=True):
            self.ids[w] = " ".join(map(str, own))
            self.decoded[w] = self.v.spelled(own)
        for w in new & special.keys():
            self.ids[w], self.decoded[w] = str(special[w]), w

    def batch(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """Of each text: the number of ids, the ids joined by spaces, the decoded text."""
        if len(self.ids) > MEMO_WORDS:
            self.ids.clear()
            self.decoded.clear()
        split = [self.v.words(t) if t else [] for t in texts]
        new: set[str] = set()
        for s in split:
            new.update(s)
        self.learn(new - self.ids.keys())
        ids, decoded, out = self.ids.__getitem__, self.decoded.__getitem__, []
        for s in split:
            joined = " ".join(map(ids, s))
            out.append((joined.count(" ") + 1 if s else 0, joined, " ".join(map(decoded, s))))
        return out


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One to a Python worker, so that later partitions find what earlier ones learned."""
    return Encoder(path)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary_path: str | None = None, digest: bool = False) -> DataFrame:
    """key, n_tokens, ids (decimal, joined by spaces), decoded; with ``digest`` their SHA-256 instead of themselves."""
    kind = dict(docs.dtypes)[key]
    names = ("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded")

    def run(batches):
        import pyarrow as pa

        enc = encoder(vocabulary_path or word_vocabulary())
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in batches:
            keys, texts = b.column(0), b.column(1).to_pylist()
            begin = size = 0
            for k, t in enumerate(texts):
                size += len(t or "")
                if size >= PIECE_CHARS or k == len(texts) - 1:
                    got = enc.batch(texts[begin : k + 1])
                    a, d = ([x[i] for x in got] for i in (1, 2))
                    if digest:
                        a, d = list(map(sha, a)), list(map(sha, d))
                    yield pa.RecordBatch.from_arrays([keys.slice(begin, k + 1 - begin), pa.array([x[0] for x in got], pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], [key, "n_tokens", *names])
                    begin, size = k + 1, 0

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, n_tokens long, {names[0]} string, {names[1]} string")


def op4_pair_index(spark, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir), digest=True)
