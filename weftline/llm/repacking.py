"""Best-fit packing with certified sequence counts.

A scan task packs its documents by best-fit decreasing, in segments that bound its memory.  Dual
feasible functions map lengths so that no full sequence exceeds its capacity; the mapped sum over the
capacity is therefore a lower bound of the number of sequences, for a segment and, from the
histogram of all lengths (at most ``window`` rows), for the whole table.  What reaches its bound is
certified.  Sequences whose documents could still be placed better are loose: all that have room
where a segment's free tokens make up a sequence, else only its emptiest one.  While the table
is above its bound, loose sequences of many segments are dealt to groups, whole, exchange their documents
and are packed again; a group that comes out no better keeps what it had.  When that saves nothing and
the table is still more than one in ``WIDE`` above its bound, one exchange takes all sequences but whole
pieces, since full ones may hold what others lack.  Rounds end at the bound or when nothing is saved.

Documents are encoded once, in the scan.  What moves afterwards are the rows of loose sequences.

Defined results: a null or empty text is its end token alone; a document longer than ``window`` is cut,
its first piece may be shorter; repeated rows are packed each; an empty table gives no rows; null
ids stay null; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache
from itertools import chain, islice, pairwise

import numpy as np
from pyspark.sql import DataFrame, functions as F

from weftline.llm.encoding import PIECE_CHARS, byte_symbols
from weftline.llm.shared import documents, forget, stored

END_ID = 0
#: Chunks of text that a Python worker remembers, and their characters; it starts anew beyond.
MEMO_CHUNKS, MEMO_CHARS = 800_000, 16_000_000
#: New chunks that are encoded as one text.
TOGETHER = 256
#: A segment of a scan task ends at so many pieces or tokens.
SEGMENT_PIECES, SEGMENT_TOKENS = 262_144, 16_777_216
#: Loose sequences that a group of an exchange has on average.
GROUP_SEQUENCES = 2048
#: A table that is more than one in so many sequences above its bound may exchange full sequences too.
WIDE = 1000
#: Scaled functions u_k that bound a count, k = 1 to STEPS.
STEPS = 64
#: Letters that every version of Unicode in use knows come before this one.
SETTLED = "ɐ"
RUNS = re.compile(r"(\s\s+)")
#: White space of Latin-1 as a plain space.
BLANK = bytes(32 if chr(b).isspace() else b for b in range(256))


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _single(text: str) -> list[str]:
    """A text whose white space stands alone, cut before each space and line end: tokens never cross such a place."""
    return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")


def chunks(text: str) -> list[str]:
    """Parts of a text that are encoded independently of each other.

    A run of white space before other text is one token but for its last character, which a space gives
    to what follows; at the end of a text the run is whole.
    """
    try:
        if b"  " not in text.encode("latin-1").translate(BLANK):
            return _single(text)
    except UnicodeEncodeError:
        pass
    pieces = RUNS.split(text)
    out, lead = [], ""
    for k in range(0, len(pieces), 2):
        out += _single(lead + pieces[k])
        if k + 1 < len(pieces):
            run, lead = pieces[k + 1], ""
            if not pieces[k + 2]:
                out.append(run)
            elif run[-1] == " ":
                out.append(run[:-1])
                lead = " "
            else:
                out += [run[:-1], run[-1]]
    return out


class Places(dict):
    """Ids of chunks; one that is asked for first gets an empty place, to be filled later."""

    def __missing__(self, chunk: str) -> bytearray:
        self[chunk] = place = bytearray()
        return place


class ByteIds:
    """Ids of chunks, four bytes each; the library encodes each new chunk once, many as one text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [x.content for x in self.library.get_added_tokens_decoder().values()]
        vocabulary, symbols = self.library.get_vocab(), byte_symbols()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token[:1] in (symbols[ord(" ")], symbols[ord("\n")])]] = True
        self.marks = {m: self.bytes_of([m])[m] for m in ".," if not any(m in s for s in self.special)}
        self.clear()

    def clear(self) -> None:
        self.ids, self.chars = Places(), 0

    def bytes_of(self, new: list[str]) -> dict[str, bytes]:
        """Ids of chunks by the library.

        A chunk whose only white space is the space or line end that it begins with can follow another one:
        no token crosses that place, and of its tokens the first alone begins with it.
        """
        out: dict[str, bytes] = {}
        together, apart = [], []
        for c in new:
            rest = c[1:]
            (together if c[:1] in (" ", "\n") and rest and rest.isprintable() and " " not in rest else apart).append(c)
        groups = [together[k : k + TOGETHER] for k in range(0, len(together), TOGETHER)]
        texts = list(map("".join, groups))
        for group, text, e in zip(groups, texts, self.library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.uint32)
            begin = np.flatnonzero(self.opens[ids])
            if len(begin) != len(group) or self.odd(text):
                apart += group
                continue
            raw, at = ids.tobytes(), [*(4 * begin).tolist(), 4 * len(ids)]
            out.update(zip(group, (raw[a:b] for a, b in pairwise(at)), strict=True))
        for c, e in zip(apart, self.library.encode_batch_fast(apart, add_special_tokens=False), strict=True):
            out[c] = np.array(e.ids, np.uint32).tobytes()
        return out

    def learn(self, new: list[str]) -> None:
        """Fills the places of new chunks; a stop or comma after a letter is a token apart, so that the word's ids serve."""
        word = {c: c[:-1] for c in new if c[-1:] in self.marks and c[-2:-1] < SETTLED and c[-2:-1].isalpha()}
        got = self.bytes_of(list(dict.fromkeys(chain((c for c in new if c not in word), (w for w in word.values() if not self.ids.get(w))))))
        for c in new:
            raw = got[c] if (w := word.get(c)) is None else (got.get(w) or self.ids[w]) + self.marks[c[-1]]
            place = self.ids[c]
            place += raw
            self.ids[c] = raw
        self.chars += sum(map(len, new))

    def odd(self, text: str) -> bool:
        """Texts whose tokens may cross the places of ``chunks``: special tokens, U+0000, what only Python takes for white space."""
        return any(c in text for c in "\0\x1c\x1d\x1e\x1f") or any(s in text for s in self.special)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts, each followed by its end, and where each text ends."""
        if len(self.ids) > MEMO_CHUNKS or self.chars > MEMO_CHARS:
            self.clear()
        known, place, end = len(self.ids), self.ids.__getitem__, np.array([END_ID], np.uint32).tobytes()
        try:
            own = [[*map(place, [] if not t else [t] if self.odd(t) else chunks(t)), end] for t in texts]
            if len(self.ids) > known:
                self.learn(list(islice(self.ids, known, None)))
        except BaseException:
            self.clear()  # no place may stay empty
            raise
        whole = [b"".join(x) for x in own]
        return np.frombuffer(b"".join(whole), np.uint32), np.cumsum([len(x) // 4 for x in whole])


@lru_cache(1)
def byte_ids(path: str) -> ByteIds:
    """One to a Python worker, so that later partitions find what earlier ones learned."""
    return ByteIds(path)


def bound(count: np.ndarray, window: int) -> int:
    """No packing of ``count[w]`` pieces of each length w into sequences of ``window`` has fewer sequences than this.

    Two families of dual feasible functions: lengths above window - x count as whole sequences and
    those below x as nothing; and u_k, which rounds (k + 1) w / window down to whole k-ths unless it is whole.
    """
    w = np.arange(window + 1)
    number, tokens = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(count * w)])
    x = np.arange(window // 2 + 1)
    parted = (number[-1] - number[window - x + 1]) * window + tokens[window - x + 1] - tokens[x]
    best = int(-(-parted.max() // window))
    for k in range(1, STEPS + 1):
        top = (k + 1) * w
        mapped = np.where(top % window == 0, k * w, top // window * window)
        best = max(best, -(-int((count * mapped).sum()) // (k * window)))
    return best


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: sequence and offset of each piece, and the free tokens of each sequence."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[int] = []
    by_free: list[list[int]] = [[] for _ in range(window + 1)]
    some = 0  # bit r: a sequence has r tokens free
    order = np.argsort(-lengths, kind="stable")
    for i, w in zip(order.tolist(), lengths[order].tolist(), strict=True):
        if fitting := some >> w:
            r = w + (fitting & -fitting).bit_length() - 1
            s = by_free[r].pop()
            if not by_free[r]:
                some ^= 1 << r
        else:
            s, r = len(free), window
            free.append(window)
        sequence[i], offset[i] = s, window - r
        free[s] = left = r - w
        if left:
            by_free[left].append(s)
            some |= 1 << left
    return sequence, offset, np.array(free, np.int64)


def loose(free: np.ndarray, certified: bool, window: int) -> np.ndarray:
    """Which sequences may gain from an exchange."""
    if not len(free) or not free.any():
        return np.zeros(len(free), bool)
    if not certified or free.sum() >= window:
        return free > 0
    return np.arange(len(free)) == free.argmax()


def _scan(docs: DataFrame, key: str, text: str, window: int, path: str | None, digest: bool) -> DataFrame:
    """Pieces of all documents, packed segment by segment."""
    kind = dict(docs.dtypes)[key]
    last = "ids_crc32 long" if digest else "ids array<int>"

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        words = byte_ids(path or byte_vocabulary())
        next_id = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        keys, piece, start, length, value, tokens = [], [], [], [], [], 0
        key_type = None

        def settle():
            nonlocal next_id, keys, piece, start, length, value, tokens
            n = np.array(length, np.int64)
            sequence, offset, free = best_fit(n, window)
            certified = len(free) == bound(np.bincount(n, minlength=window + 1), window)
            out = pa.RecordBatch.from_arrays(
                [pa.array(keys, key_type), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(n), pa.array(value, pa.int64() if digest else pa.list_(pa.int32())),
                 pa.array(next_id + sequence), pa.array(offset), pa.array(loose(free, certified, window)[sequence])],
                [key, "piece", "start", "length", last.split()[0], "sequence_id", "offset", "loose"],
            )
            next_id += len(free)
            keys, piece, start, length, value, tokens = [], [], [], [], [], 0
            return out

        for b in batches:
            key_type = b.schema.field(0).type
            own, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            first = size = 0
            for k, t in enumerate(texts):
                size += len(t or "")
                if size < PIECE_CHARS and k < len(texts) - 1:
                    continue
                ids, ends = words.encode(texts[first : k + 1])
                begin = 0
                for d, end in zip(own[first : k + 1], ends.tolist(), strict=True):
                    cut = begin
                    upto = begin + ((end - begin) % window or window)
                    number = 0
                    while cut < end:
                        x = ids[cut:upto]
                        keys.append(d)
                        piece.append(number)
                        start.append(cut - begin)
                        length.append(upto - cut)
                        value.append(zlib.crc32(x.tobytes()) if digest else x.astype(np.int32))
                        cut, upto, number = upto, upto + window, number + 1
                    tokens += end - begin
                    begin = end
                    if len(keys) >= SEGMENT_PIECES or tokens >= SEGMENT_TOKENS:
                        yield settle()
                first, size = k + 1, 0
        if keys:
            yield settle()

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, piece int, start long, length long, {last}, sequence_id long, offset long, loose boolean")


def _exchange(rows: DataFrame, groups: int, number: int, window: int) -> DataFrame:
    """Loose sequences dealt to groups and packed again; a group that needs as many as before stays as it was."""

    def again(own, table):
        import pyarrow as pa

        n = table.column("length").to_numpy()
        was = len(np.unique(table.column("sequence_id").to_numpy()))
        sequence, offset, free = best_fit(n, window)
        if len(free) < was:
            base = (number << 56) + (own[0].as_py() << 32)
            certified = len(free) == bound(np.bincount(n, minlength=window + 1), window)
            for name, new in (("sequence_id", base + sequence), ("offset", offset), ("loose", loose(free, certified, window)[sequence])):
                table = table.set_column(table.schema.get_field_index(name), name, pa.array(new))
        return table.drop_columns(["group"])

    dealt = rows.withColumn("group", F.pmod(F.xxhash64(F.lit(number), "sequence_id"), F.lit(groups)).cast("int"))
    return dealt.groupBy("group").applyInArrow(again, rows.schema)


def _sequences(df: DataFrame) -> int:
    return df.agg(F.count_if(F.col("offset") == 0).alias("n")).first().n


def _try(moving: DataFrame, number: int, window: int) -> tuple[DataFrame | None, int]:
    """The exchanged rows if that saves sequences, and how many."""
    if not (sequences := _sequences(moving)):
        return None, 0
    groups = -(-sequences // GROUP_SEQUENCES)
    new, _ = stored(_exchange(moving, groups, number, window), "exchanged")
    saved = sequences - _sequences(new)
    if not saved:
        forget(new)
        return None, 0
    return new, saved


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for x in tables[1:]:
        out = out.unionByName(x)
    return out


def repack(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 2048, vocabulary_path: str | None = None, digest: bool = False, rounds: int = 8) -> DataFrame:
    """One row per piece of a document: key, piece, start, length, ids (with ``digest`` ids_crc32), sequence_id, offset, and ``least``, which no packing of the table can beat."""
    packed, _ = stored(_scan(docs, key, text, window, vocabulary_path, digest), "packed")
    count = np.zeros(window + 1, np.int64)
    for r in packed.groupBy("length").count().collect():  # at most ``window`` rows
        count[r.length] = r["count"]
    least, now = bound(count, window), _sequences(packed)
    settled, open_, wide = [], packed, False
    for number in range(1, rounds + 1):
        if now == least:
            break
        moving, rest = open_.filter("loose"), [*settled, open_.filter("NOT loose")]
        new, saved = _try(moving, number, window)
        if not saved:
            if wide or (now - least) * WIDE <= now:
                break
            wide, every = True, _union([*settled, open_])
            moving, rest = every.filter(F.col("length") < window), [every.filter(F.col("length") == window)]
            new, saved = _try(moving, number, window)
            if not saved:
                break
        settled, open_, now = rest, new, now - saved
    return _union([*settled, open_]).drop("loose").withColumn("least", F.lit(least).cast("long"))


def op13_certified_repacking(spark, sf_dir: str) -> DataFrame:
    return repack(documents(spark, sf_dir), digest=True).drop("least")
