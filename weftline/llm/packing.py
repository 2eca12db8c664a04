"""Packing by order-preserving dynamic programming.

The documents of a scan task are one stream of tokens in table order.  Windows of at most
``window`` tokens are cut at document ends, at sentence ends or, in sentences longer than
``LONG_SENTENCE``, at places in between.  A cut into a document costs a truncation penalty, a
window costs its padding (none at a power of two).  The cheapest cuts are found by

    best[j] = penalty[j] + window - at[j] + min(best[i] + at[i] for at[j] - window <= at[i] < at[j])

whose minimum slides with j, so that a monotone queue gives each transition in constant time;
windows of a half and a quarter of the length are tried besides, which need no padding either.  A stream is solved in segments of
``SEGMENT_TOKENS``; all but a segment's last two windows are settled, the rest moves on, so
memory does not grow with the partition.  A window left so short that cutting it into powers
of two costs less than padding it is cut that way.

Nothing is shuffled, and a task that is run again gives the same rows: sequence ids are made of
the partition's number and a count.

Defined results: a null or empty text is its end token alone; repeated rows are packed each;
an empty table gives no rows; null ids stay null; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections import deque
from functools import lru_cache
from itertools import chain, islice
from unicodedata import is_normalized

import numpy as np
from pyspark.sql import DataFrame, functions as F

from weftline.llm.bytewise import giving_back
from weftline.llm.encoding import PIECE_CHARS, word_vocabulary
from weftline.llm.shared import documents

END_ID = 2
SENTENCE_PENALTY, INSIDE_PENALTY = 8, 64
LONG_SENTENCE = 256
SEGMENT_TOKENS = 262_144
#: Blank-free chunks that a Python worker remembers (some 200 bytes each); it starts anew beyond.
MEMO_CHUNKS = 800_000
SENTENCE_END = frozenset(".!?…。！？")
#: A word that is one token, put between words so that many are encoded as one text, and how many those are.
BETWEEN, TOGETHER = "|", 512


def chunks(text: str) -> list[str]:
    """Parts of a text between Unicode white space, which U+001C to U+001F are not; tokens never cross it."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        import regex

        return [x for x in regex.split(r"\p{White_Space}+", text) if x]
    return text.split()


def simple(chunk: str) -> tuple[str, ...]:
    """A chunk as its lower-case word of letters and the stop or comma after it, or as it is."""
    word, mark = (chunk[:-1], chunk[-1:]) if chunk[-1] in ".," else (chunk, "")
    low = word.lower()
    if word.isascii() and word.isalpha():
        return (low, mark) if mark else (low,)
    # Letters that come apart when normalised or lowered would join the mark.
    if not word.isalpha() or not low.isalpha() or "\u03a3" in word or not is_normalized("NFC", word):
        return (chunk,)
    return (low, mark) if mark else (low,)


class Numbers(dict):
    """Numbers chunks as they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class WordIds:
    """Ids of blank-free chunks as flat arrays; the library encodes each new chunk once."""

    def __init__(self, path: str, memo: int = MEMO_CHUNKS):
        self.memo = memo
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        between = self.library.encode(BETWEEN, add_special_tokens=False).ids
        self.between = between[0] if len(between) == 1 else None
        self.clear()

    def clear(self) -> None:
        self.at = Numbers({"": 0})
        self.flat, self.begin, self.size, self.stop = np.array([END_ID], np.uint32), np.zeros(1, np.int64), np.ones(1, np.int64), np.zeros(1, bool)

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and how many each has; many words are one text, parted by a word that is one token."""
        groups = [words[k : k + TOGETHER] for k in range(0, len(words), TOGETHER)] if self.between is not None else []
        texts = self.library.encode_batch_fast([f" {BETWEEN} ".join(g) for g in groups], add_special_tokens=False)
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for g, text in zip(groups, texts, strict=True):
            every = np.array(text.ids, np.uint32)
            cut = np.flatnonzero(every == self.between)
            if len(cut) == len(g) - 1:
                ids.append(np.delete(every, cut))
                sizes.append(np.diff(np.concatenate([[-1], cut, [len(every)]])) - 1)
            else:  # a word has that token too
                self.apart(g, ids, sizes)
        if not groups:
            self.apart(words, ids, sizes)
        return np.concatenate(ids), np.concatenate(sizes)

    def apart(self, words: list[str], ids: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        own = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
        ids.append(np.fromiter(chain.from_iterable(own), np.uint32))
        sizes.append(np.fromiter(map(len, own), np.int64, len(own)))

    def learn(self, new: list[str]) -> None:
        """Ids of chunks that were numbered since the last call."""
        # A word of letters and one mark after it are tokens apart: such chunks have the word's ids.
        plain = [simple(c) for c in new]
        number = Numbers()
        parts = np.fromiter(map(number.__getitem__, chain.from_iterable(plain)), np.int64)
        ids, sizes = self.ids_of(list(number))
        own = sizes[parts]
        after = np.cumsum(own)
        start = (np.cumsum(sizes) - sizes)[parts]
        got = ids[np.arange(after[-1]) + np.repeat(start - after + own, own)]
        count = np.fromiter(map(len, plain), np.int64, len(plain))
        size = np.add.reduceat(own, np.cumsum(count) - count)
        begin = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, got])
        self.begin, self.size = np.concatenate([self.begin, begin]), np.concatenate([self.size, size])
        self.stop = np.concatenate([self.stop, np.fromiter((w[-1] in SENTENCE_END for w in new), bool, len(new))])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids of all texts, each followed by its end; where each text ends; where sentences end."""
        if len(self.at) > self.memo:
            self.clear()
        split = [chunks(t) if t else [] for t in texts]
        count = np.fromiter(map(len, split), np.int64, len(split)) + 1
        last = np.cumsum(count) - 1
        index = np.zeros(int(count.sum()), np.int64)
        mask = np.ones(len(index), bool)
        mask[last] = False
        index[mask] = np.fromiter(map(self.at.__getitem__, chain.from_iterable(split)), np.int64, len(index) - len(split))
        if len(self.at) > len(self.size):
            self.learn(list(islice(self.at, len(self.size), None)))
        size = self.size[index]
        after = np.cumsum(size)
        ids = self.flat[np.arange(after[-1]) + np.repeat(self.begin[index] - after + size, size)]
        return ids, after[last], after[self.stop[index]]


@lru_cache(1)
def word_ids(path: str, memo: int = MEMO_CHUNKS) -> WordIds:
    return WordIds(path, memo)


def cuts(total: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, window: int) -> list[int]:
    """Ends of the windows that cover ``total`` tokens at least cost; the last is ``total``."""
    at = np.union1d(np.union1d(doc_ends, sentence_ends), np.array([0, total]))
    at = at[at <= total]
    step = min(LONG_SENTENCE, window)
    gaps = np.diff(at)
    if (long := np.flatnonzero(gaps > step)).size:
        at = np.union1d(at, np.concatenate([np.arange(at[k] + step, at[k + 1], step) for k in long]))
    penalty = np.where(np.isin(at, doc_ends), 0, np.where(np.isin(at, sentence_ends), SENTENCE_PENALTY, INSIDE_PENALTY)).tolist()
    places = at.tolist()
    n = len(places)
    # Windows of half and a quarter of the full length end without padding too.
    halves = []
    for w in (window // 2, window // 4):
        k = np.searchsorted(at, at - w)
        halves.append(np.where(at[np.minimum(k, n - 1)] == at - w, k, -1).tolist() if w & (w - 1) == 0 else [-1] * n)
    best, back = [0.0] * n, [0] * n
    queue: deque[int] = deque([0])
    key = [0.0] * n  # best[i] + at[i], rising along the queue
    for j, p, extra, h, q in zip(range(1, n), places[1:], penalty[1:], halves[0][1:], halves[1][1:], strict=True):
        low = p - window
        while places[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        cost = key[i] - low
        if h >= 0 and best[h] < cost:
            cost, i = best[h], h
        if q >= 0 and best[q] < cost:
            cost, i = best[q], q
        cost += extra
        best[j], back[j] = cost, i
        key[j] = v = cost + p
        while queue and key[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
    out, j = [], n - 1
    while j:
        out.append(places[j])
        j = back[j]
    return out[::-1]


def in_powers(length: int, window: int) -> list[int]:
    """Lengths into which a window of ``length`` is cut: itself, or powers of two if they cost less than its padding."""
    bits = [1 << k for k in range(length.bit_length()) if length >> k & 1][::-1]
    return bits if window - length > (len(bits) - 1) * INSIDE_PENALTY else [length]


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 4096, vocabulary_path: str | None = None, digest: bool = False, memo: int = MEMO_CHUNKS, keep_memo: bool = True) -> DataFrame:
    """One row per piece of a document: key, start, length, doc_tokens, sequence_id, offset, and ids (with ``digest`` ids_crc32).

    Without ``keep_memo`` a task forgets what it remembers when it ends, so that its worker's next work has the memory.
    """
    kind = dict(docs.dtypes)[key]
    last = "ids_crc32 long" if digest else "ids array<int>"

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        words = word_ids(vocabulary_path or word_vocabulary(), memo)
        sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        # The open segment: its ids, and per document its key, where it begins (may be before the segment) and ends.
        ids, keys, begin, ends, stops = np.zeros(0, np.uint32), [], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

        def settle(final: bool):
            nonlocal sequence, ids, keys, begin, ends, stops
            found = cuts(len(ids), ends, stops, window)
            found = found if final else found[:-2]
            if not found:
                return None
            whole = np.diff(np.array([0, *found]))
            edges = np.cumsum(np.array([x for n in whole.tolist() for x in in_powers(n, window)]))
            done = int(edges[-1])
            points = np.union1d(np.concatenate([edges, ends[ends <= done]]), [0])
            lo, hi = points[:-1], points[1:]
            doc, seq = np.searchsorted(ends, lo, "right"), np.searchsorted(edges, lo, "right")
            offset = lo - np.concatenate([[0], edges])[seq]
            slices = [ids[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
            value = pa.array([zlib.crc32(x.tobytes()) for x in slices], pa.int64()) if digest else pa.array([x.astype(np.int32) for x in slices], pa.list_(pa.int32()))
            out = pa.RecordBatch.from_arrays(
                [pa.array([keys[d] for d in doc.tolist()], key_type), pa.array(lo - begin[doc]), pa.array(hi - lo), pa.array((ends - begin)[doc]), pa.array(sequence + seq), pa.array(offset), value],
                [key, "start", "length", "doc_tokens", "sequence_id", "offset", last.split()[0]],
            )
            sequence += len(edges)
            left = int(np.searchsorted(ends, done, "right"))
            ids, keys, begin, ends, stops = ids[done:], keys[left:], begin[left:] - done, ends[left:] - done, stops[stops > done] - done
            return out

        key_type = None
        for b in batches:
            key_type = b.schema.field(0).type
            own, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            first = size = 0
            for k, t in enumerate(texts):
                size += len(t or "")
                if size < PIECE_CHARS and k < len(texts) - 1:
                    continue
                got, e, s = words.encode(texts[first : k + 1])
                base = len(ids)
                ids, keys = np.concatenate([ids, got]), keys + own[first : k + 1]
                begin = np.concatenate([begin, base + np.concatenate([[0], e[:-1]])])
                ends, stops = np.concatenate([ends, base + e]), np.concatenate([stops, base + s])
                first, size = k + 1, 0
                if len(ids) >= SEGMENT_TOKENS and (out := settle(False)) is not None:
                    yield out
        if len(ids) and (out := settle(True)) is not None:
            yield out
        if not keep_memo:
            words.clear()  # the library itself stays: a worker that loads it anew in each task grows by some megabytes a task

    return docs.select(F.col(key), F.col(text)).mapInArrow(run if keep_memo else giving_back(run), f"`{key}` {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, {last}")


def op9_dp_packing(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), digest=True)
