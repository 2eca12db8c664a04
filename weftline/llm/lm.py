"""LM scoring by a subword lattice.

The pieces of a public subword vocabulary get unigram scores from the training documents
(those whose CRC-32 of the id is not 0 modulo 10): the library's segmentation of each
distinct word, weighted by the word's count.  A word's probability is then the sum over all
its segmentations into pieces, found by a forward recursion in log space over the word's
lattice; every character has a path of byte pieces too, so no word is impossible.  Besides, the
word as a whole is an edge of its lattice, weighted by its count in the training documents against the number
of their distinct words; so what the model knows grows with the corpus.  A text's
probability is the product over its words and the end.

The distinct words are counted by shuffle and stay a distributed table; each gets its lattice
probability once.  Texts find the values of a fixed number of the most frequent words in a table that all
tasks have, those of all others by a join; that leaves no word so frequent that its key is hot.

Defined results: a null or empty text is its end alone; a null id counts as the empty text
when held out is decided; repeated rows each count; without training documents all pieces are
equally likely; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, functions as F

from weftline.llm.bytewise import in_pieces, in_slices, word_hashes
from weftline.llm.shared import documents, materialize

#: So many of the most frequent words are sent to all tasks (32 bytes each: 4 MB), whatever the size of the corpus.
FREQUENT_WORDS = 131_072
#: Words that a task counts before it passes them on.
COUNT_WORDS = 400_000
SMOOTH = 0.1
LOG10 = math.log(10)


def piece_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(1)
def _library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _held_out(key: str, fold: int, folds: int):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds == fold


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """word, c: how often training texts (column train) have it; words of other texts have c = 0."""

    def run(batches):
        import pyarrow as pa

        counts: dict[bytes, int] = {}

        def out():
            got = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "c"])
            counts.clear()
            return got

        for b in batches:
            for t, train in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for w in t.encode().lower().split() if t else ():
                    counts[w] = counts.get(w, 0) + train
                if len(counts) > COUNT_WORDS:
                    yield out()
        if counts:
            yield out()

    found = docs.select(F.col(text), F.col("train").cast("int")).mapInArrow(run, "word string, c long")
    return found.groupBy("word").agg(F.sum("c").alias("c"))


def piece_scores(words: DataFrame, n_docs: int, path: str) -> tuple[dict[str, float], list[float], float, int]:
    """Log probabilities: of pieces, of bytes, of the end; and the longest piece.  At most the vocabulary's size reaches the driver."""

    def run(batches):
        import pyarrow as pa

        library = _library(path)
        total = np.zeros(library.get_piece_size(), np.int64)
        for b in batches:
            w, c = b.column(0).to_pylist(), b.column(1).to_numpy()
            for part in in_pieces(w, 500_000):
                ids = library.encode(w[part], num_threads=1)
                size = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter((i for x in ids for i in x), np.int64, int(size.sum()))
                np.add.at(total, flat, np.repeat(c[part], size))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["piece", "n"])

    rows = words.filter("c > 0").select("word", "c").mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    counts = {r["piece"]: r["n"] for r in rows}
    library = _library(path)
    usable = [i for i in range(library.get_piece_size()) if not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i))]
    total = math.log(sum(counts.get(i, 0) + SMOOTH for i in usable) + n_docs + SMOOTH)
    logs = {i: math.log(counts.get(i, 0) + SMOOTH) - total for i in usable}
    single = [0.0] * 256
    for i in usable:
        if library.is_byte(i):
            single[int(library.id_to_piece(i)[3:5], 16)] = logs[i]
    pieces = {library.id_to_piece(i): logs[i] for i in usable if not library.is_byte(i)}
    return pieces, single, math.log(n_docs + SMOOTH) - total, max(map(len, pieces), default=1)


def lattice(word: str, pieces: dict[str, float], single: list[float], longest: int) -> float:
    """Log probability of a word: all segmentations of the word-start mark and the word."""
    s = "▁" + word
    n = len(s)
    forward = [-math.inf] * (n + 1)
    forward[0] = 0.0
    get, exp, log = pieces.get, math.exp, math.log
    for i in range(n):
        here = forward[i]
        if here == -math.inf:
            continue
        spelled = here + sum(single[b] for b in s[i].encode())
        for j in range(i + 1, min(n, i + longest) + 1):
            p = get(s[i:j])
            if j == i + 1:
                step = spelled if p is None else _add(here + p, spelled, exp, log)
            elif p is None:
                continue
            else:
                step = here + p
            old = forward[j]
            forward[j] = step if old == -math.inf else _add(old, step, exp, log)
    return forward[n]


def _add(a: float, b: float, exp, log) -> float:
    if a < b:
        a, b = b, a
    return a + log(1.0 + exp(b - a))


def word_values(words: DataFrame, model, train: int, types: int, total: float) -> DataFrame:
    """h (hash of the word), known, base and lm: log10 of its smoothed count and of its probability by the lattice.

    The word as a whole is one more edge of its lattice: (count + types * lattice) / (train + types).
    """
    sent = words.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        pieces, single, _, longest = sent.value
        for b in batches:
            w, c = b.column(0).to_pylist(), b.column(1).to_numpy()
            if not len(w):
                continue
            h, _ = word_hashes([x.encode() for x in w])
            by_pieces = np.fromiter((lattice(x, pieces, single, longest) for x in w), float, len(w)) + math.log(max(types, 1))
            with np.errstate(divide="ignore"):
                lm = (np.logaddexp(by_pieces, np.log(c)) - math.log(train + max(types, 1))) / LOG10
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c > 0), pa.array(np.log10((c + 0.1) / total)), pa.array(lm)], ["h", "known", "base", "lm"])

    return words.select("word", "c").mapInArrow(run, _VALUE)


_VALUE = "h long, known boolean, base double, lm double"


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10, held_out_fold: int = 0, vocabulary_path: str | None = None, frequent_words: int = FREQUENT_WORDS) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probability of the text by the lattice)."""
    path = vocabulary_path or piece_vocabulary()
    docs = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_t"), _held_out(key, held_out_fold, folds).alias("held_out"))
    n_docs = docs.filter(~F.col("held_out")).count()
    words = materialize(count_words(docs.withColumn("train", ~F.col("held_out")), "_t"), "words")
    s = words.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    train, types = (s["n"] or 0) + n_docs, s["v"] + (n_docs > 0)
    total = train + 0.1 * (types + 1)
    model = piece_scores(words, n_docs, path)
    lm_end = math.log10((n_docs + max(types, 1) * math.exp(model[2])) / (train + max(types, 1)))
    end = (1 if n_docs else 0, math.log10((n_docs + 0.1) / total), lm_end)
    values = materialize(word_values(words, model, train, types, total), "values")
    # The words that are met most often: a fixed number.
    frequent = word_values(words.orderBy(F.desc("c"), "word").limit(frequent_words), model, train, types, total).toPandas() if frequent_words else None
    out = _summed(docs, key, values, frequent, end)
    return out.select(key, "held_out", "n_tokens", "n_known", F.lit(train).cast("long").alias("train_tokens"), "base_score", "score")


def _summed(docs: DataFrame, key: str, values: DataFrame, frequent, end: tuple) -> DataFrame:
    """The sums of the texts' words: frequent ones where the text is read, all others by a join on their hashes, one row for each distinct one of a text."""
    kind = dict(docs.dtypes)[key]
    table = None
    if frequent is not None and len(frequent):
        h = frequent["h"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        table = (h[order], *(frequent[x].to_numpy(float)[order] for x in ("known", "base", "lm")))
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        import pyarrow as pa

        for b in (x for whole in batches for x in in_slices(whole, "_t")):
            texts = [t.encode() for t in b.column("_t").to_pylist()]
            for part in in_pieces(texts):
                h, n = word_hashes(texts[part])
                m, of = len(n), np.repeat(np.arange(len(n)), n)
                sums, rest = [np.zeros(m) for _ in range(3)], np.ones(len(h), bool)
                if sent.value is not None and len(h):
                    f, *columns = sent.value
                    at = np.minimum(np.searchsorted(f, h), len(f) - 1)
                    rest = f[at] != h
                    sums = [np.bincount(of[~rest], weights=x[at[~rest]], minlength=m) for x in columns]
                yield rows(pa, b, part, None, [], [], [n, sums[0].astype(np.int64), *sums[1:]])
                order = np.lexsort((h[rest], of[rest]))
                o, g = of[rest][order], h[rest][order]
                new = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (g[1:] != g[:-1])])) if len(o) else np.zeros(0, np.int64)
                if len(new):
                    yield rows(pa, b, part, o[new], g[new].view(np.int64), np.diff(np.concatenate([new, [len(o)]])), None)

    def rows(pa, b, part, of, h, times, sums):
        """A row for each document with its sums, or for each word with its document and how often it is there."""
        x = b.slice(part.start, part.stop - part.start)
        if sums is not None:
            n = x.num_rows
            cols = [x.column("_row"), x.column(key), x.column("held_out"), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), *map(pa.array, sums)]
        else:
            n = len(of)
            cols = [x.column("_row").take(pa.array(of)), pa.nulls(n, x.column(key).type), pa.nulls(n, pa.bool_()), pa.array(h), pa.array(times), *(pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
        return pa.RecordBatch.from_arrays(cols, ["_row", key, "held_out", "h", "times", "n", "k", "b", "s"])

    found = docs.withColumn("_row", F.monotonically_increasing_id()).mapInArrow(run, f"_row long, `{key}` {kind}, held_out boolean, h long, times long, n long, k long, b double, s double")
    found = materialize(found, "found")
    other = found.filter("h IS NOT NULL").select("_row", "h", "times").join(values, "h")
    other = other.groupBy("_row").agg(F.sum(F.when(F.col("known"), F.col("times")).otherwise(0)).alias("k2"), F.sum(F.col("times") * F.col("base")).alias("b2"), F.sum(F.col("times") * F.col("lm")).alias("s2"))
    out = found.filter("h IS NULL").drop("h", "times").join(other, "_row", "left")
    add = lambda a, b, e: F.col(a) + F.coalesce(F.col(b), F.lit(0)) + F.lit(e)
    return out.select(key, "held_out", (F.col("n") + 1).alias("n_tokens"), add("k", "k2", end[0]).cast("long").alias("n_known"), add("b", "b2", end[1]).alias("base_score"), add("s", "s2", end[2]).alias("score"))


def op2_lattice(spark, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
