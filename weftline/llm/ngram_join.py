"""N-gram Jaccard join by PartEnum signatures.

A document's set are the hashes of its distinct word shingles.  Sets whose sizes differ by no
more than the similarity allows fall into the same or neighbouring bands of sizes.  In a band
two similar sets differ in at most k shingles.  The domain of shingles is parted at two levels by
a hash: ``n1`` parts of ``CELLS`` cells each.  A signature is what a set has in ``CELLS - DIFFER``
cells of one part, for every such subset of every part.  n1 is so large that similar sets agree in
several signatures: one differing shingle spoils two of a part's three subsets, a second one the rest.
So each set may leave out as many as similar sets agree in beside one.  It leaves out its
last by an order that only content decides (shingles that are not common first, then all, then a
hash): of the signatures that two sets agree in, both keep the first.  Passages that very many
documents hold therefore make no buckets of their own where the documents have enough beside them.

The signatures go packed to the group that their hash names.  A group sorts them; sets
that have one in common are candidates.  Up to ``SMALL`` sets give all their pairs, larger
buckets a star and their members, which count as one bucket for all that have the same centre.  Candidates pass exact bounds (sizes, then the distance of
the sets' parity sketches, which is never more than that of the sets), then the texts are
compared.  Links give components; larger buckets whose members are then in different
components try pairs that would join them, and what is still apart after ``FOREST_ROUNDS`` is compared
across components: all members outside of the bucket's largest component against all of the bucket.
So no link is lost and no group of copies is expanded into all pairs.  A member counts once for its bucket, however many
groups of signatures it meets it in.

Texts with the same words in the same order, whatever white space and case, are found first, by 128-bit hashes of all texts: the least id of each
group stands for it in all that follows and gives it its component.  Equal sets of other texts count as linked by
their 128-bit hashes.  Signatures and hashes only propose.

Defined results: a null or empty text has no shingles and is linked with nothing; rows with
one id are one document for links; a row without id has no component; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from weftline.llm.bytewise import give_back, giving_back, in_pieces, in_slices, mix, word_hashes
from weftline.llm.components import components
from weftline.llm.shared import BROADCAST_BYTES, documents, forget, join_small, materialize, stored

#: Cells of a part, and how many of them a subset leaves out.
CELLS, DIFFER = 3, 1
#: Shingles whose signatures, about 6 bytes each packed and 30 sorted, make one group.
GROUP_SHINGLES = 3_000_000
#: Sets in a bucket that give all their pairs; larger buckets give stars first.
SMALL = 8
#: Bytes of a signature beside the group that it goes to.  Equal bytes of different signatures only cost a comparison.
SIGNATURE_BYTES = 5
#: Documents, and their shingles, whose texts are compared in one task.
BLOCK, BLOCK_SHINGLES = 128, 400_000
#: Members of a bucket, and bytes of their sketches, in one tile of ``_across``.
TILE, TILE_BYTES = 2048, 4 << 20
#: Rounds in which larger buckets try only spanning pairs, before the last tries all that are left.
FOREST_ROUNDS = 1
#: Shingles are counted by this many bits of their hash; a task tells of those that it has this often; so many make one common.
COUNT_BITS, COUNT_LOCAL, COMMON = 22, 4, 32
#: Bytes of text that are worked on at once: numpy takes some 50 times as many.
PIECE = 1_000_000
_C = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, also across texts; where each text's words begin; hashes of the words."""
    h, n = word_hashes(texts)
    full = max(len(h) - width + 1, 0)
    s = np.zeros(full, np.uint64)
    for k in range(width):
        s += h[k : k + full] * (_C[k] | np.uint64(1))
    return mix(s), np.concatenate([[0], np.cumsum(n)]), h


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    s, edge, h = _shingles(texts, width)
    out = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        if b - a >= width:
            x = np.sort(s[a : b - width + 1])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        elif b > a:
            out.append(mix((h[a:b] * (_C[32 : 32 + b - a] | np.uint64(1))).sum(keepdims=True, dtype=np.uint64) + _C[b - a]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class Bands:
    """Bands of set sizes for a similarity of num / den: band i holds sizes low[i] to high[i], and high[i] * num / den < low[i] + 1."""

    def __init__(self, num: int, den: int, largest: int):
        self.num, self.den = num, den
        low, high = [1], [den // num]
        while high[-1] < largest:
            low.append(high[-1] + 1)
            high.append(max(low[-1], low[-1] * den // num))
        for _ in range(2):
            low.append(high[-1] + 1)
            high.append(max(low[-1], low[-1] * den // num))
        self.low, self.high = np.array(low), np.array(high)
        # Sets of sizes s and t that are similar differ in at most (s + t) * (den - num) / (den + num) shingles.
        most = 2 * self.high * (den - num) // (den + num)
        # (DIFFER + 1) * n1 is more than the most; the rest is what signatures may be left out for.
        self.parts = -(-(most + 1 + -(-3 * most // 10)) // (DIFFER + 1))

    def band(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.high, size)

    def change(self, size: np.ndarray, band: np.ndarray) -> np.ndarray:
        """The most shingles in which a set of ``size`` differs from a similar one of at most band's sizes."""
        other = np.minimum(self.high[band], size * self.den // self.num)
        return (size + other) * (self.den - self.num) // (self.den + self.num)

    def spoiled(self, size: np.ndarray, band: np.ndarray) -> np.ndarray:
        """The most signatures that so many differing shingles spoil: two for the first in a part, one for a second."""
        k, n1 = self.change(size, band), self.parts[band]
        return np.minimum(2 * np.minimum(k, n1) + np.maximum(k - n1, 0), CELLS * n1)


def signatures(sets: list[np.ndarray], bands: Bands, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(index of the set, signature) of the signatures that the sets keep, by band and set."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    have = np.flatnonzero(size)
    if not len(have):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    items, size = np.concatenate(sets), size[have]
    value = mix(items ^ np.uint64(0xA5A5A5A5DEADBEEF))
    rare = items if common is None else _rare(items, common)
    who, sig = [], []
    own = bands.band(size)
    for band in (own, own + 1):
        n1 = bands.parts[band]
        base = CELLS * (np.cumsum(n1) - n1)
        place = mix(items ^ np.repeat(mix(band.astype(np.uint64) + np.uint64(77)), size)) >> np.uint64(32)
        cell = ((place * np.repeat((CELLS * n1).astype(np.uint64), size)) >> np.uint64(32)).astype(np.int64) + np.repeat(base, size)
        total = int(CELLS * n1.sum())
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, cell, value)
        held = np.bincount(cell, minlength=total).reshape(-1, CELLS)
        few = held if common is None else np.bincount(cell[rare], minlength=total).reshape(-1, CELLS)
        # What is in a part without one of its cells.
        held, few = (np.minimum(x.sum(1, keepdims=True) - x, 63).ravel().astype(np.uint64) for x in (held, few))
        sums = sums.reshape(-1, CELLS)
        sums = (sums.sum(1, keepdims=True) - sums).ravel()
        of = np.repeat(np.arange(len(have)), CELLS * n1)
        name = (band[of].astype(np.uint64) << np.uint64(32)) + (np.arange(total) - base[of]).astype(np.uint64)
        s = mix(sums + mix(name))
        rank = (few << np.uint64(58)) | (held << np.uint64(52)) | (s >> np.uint64(12))
        kept = np.zeros(total, bool)
        most = CELLS * n1 - bands.spoiled(size, band) - 1  # how many may be left out
        # Sets with as many signatures are ranked together.
        for n in np.unique(n1):
            at = np.flatnonzero(n1 == n)
            rows = base[at][:, None] + np.arange(CELLS * n)
            r = rank[rows]
            least = np.sort(r, axis=1)[np.arange(len(at)), most[at]]
            kept[rows] = r >= least[:, None]
        kept = np.flatnonzero(kept)
        who.append(have[of[kept]])
        sig.append(s[kept])
    return np.concatenate(who), np.concatenate(sig)


def _rare(items: np.ndarray, common: np.ndarray) -> np.ndarray:
    b = items >> np.uint64(64 - COUNT_BITS)
    return (common[(b >> np.uint64(3)).astype(np.int64)] >> (b & np.uint64(7)).astype(np.uint8)) & 1 == 0


def _sequence_hashes(h: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's words in their order; texts without words have 0."""
    n = np.diff(edge)
    place = np.arange(len(h), dtype=np.uint64) - np.repeat(edge[:-1], n).astype(np.uint64)
    some, out = np.flatnonzero(n), np.zeros((2, len(n)), np.uint64)
    if len(some):
        x = mix(h + place * (_C[44] | np.uint64(1)))
        for k in (0, 1):
            out[k, some] = np.add.reduceat(x, edge[:-1][some])
            x = mix(x + _C[45])
    return out[0].view(np.int64), out[1].view(np.int64)


def common_shingles(docs: DataFrame, width: int) -> tuple[np.ndarray, int, DataFrame]:
    """A bit for each of 2 ** COUNT_BITS hash values of shingles: whether many documents have one with it; the number of shingles; (id, q, r): hashes of the texts with words.

    It has a fixed size, covers all documents and only orders signatures: no result depends on it.
    """

    def run(batches):
        import pyarrow as pa

        def counts(b, c):
            m = len(b)
            return pa.RecordBatch.from_arrays([pa.array(b.astype(np.int32)), pa.array(c.astype(np.int64)), *(pa.nulls(m, pa.int64()) for _ in range(3))], names)

        count, seen = np.zeros(1 << COUNT_BITS, np.uint32), 0
        for b in (x for whole in batches for x in in_slices(whole, "_t")):
            ids, texts = b.column(0).cast(pa.int64()), [t.encode() if t else b"" for t in b.column(1).to_pylist()]
            for part in in_pieces(texts, PIECE):
                s, edge, h = _shingles(texts[part], width)
                s >>= np.uint64(64 - COUNT_BITS)
                np.add.at(count, s.astype(np.int64), np.uint32(1))
                seen += len(s)
                q, r = _sequence_hashes(h, edge)
                m, own = len(q), ids[part]
                yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.int32()), pa.array(np.diff(edge)), own, pa.array(q), pa.array(r)], names)
        yield counts(np.array([-1]), np.array([seen]))
        at = np.flatnonzero(count >= max(COUNT_LOCAL, 4 * seen // len(count) + COUNT_LOCAL))
        for k in range(0, len(at), 100_000):
            x = at[k : k + 100_000]
            yield counts(x, count[x])

    names = ["b", "c", "id", "q", "r"]
    # Counts of shingles have a value b, texts have none and their number of words as c.
    read = materialize(docs.toDF("_id", "_t").mapInArrow(giving_back(run), "b int, c long, id long, q long, r long"), "read")
    total = materialize(read.filter("b IS NOT NULL").groupBy("b").agg(F.sum("c").alias("c")), "counts")
    told = total.agg(F.sum(F.when(F.col("b") >= 0, F.col("c"))).alias("often"), F.sum(F.when(F.col("b") < 0, F.col("c"))).alias("all")).first()
    mean = (told["often"] or 0) / (1 << COUNT_BITS)
    place = (F.col("b") + 1).cast("long")
    rows = total.filter((F.col("b") >= 0) & (F.col("c") >= max(COMMON, 4 * mean))).groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(1 << (COUNT_BITS - 3), np.uint8)
    for r in rows.collect():  # at most 2 ** COUNT_BITS bits in all
        out[4096 * (r.k - 1) : 4096 * r.k] = np.frombuffer(r.bits, np.uint8)
    forget(total)
    hashed = read.filter("b IS NULL AND c > 0 AND id IS NOT NULL").select("id", "q", "r")
    hashed._stored_at = read._stored_at
    return out, told["all"] or 0, hashed


def parities(s: np.ndarray) -> bytes:
    """Whether an odd number of the set's hashes falls into each of 2 to 4 bins a shingle: one that two sets do not have in common changes one bit at most."""
    bits = 64
    while bits < 2 * len(s):
        bits *= 2
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def _folded(column, width: int) -> np.ndarray:
    """Sketches as rows of 64-bit words, folded to ``width`` bytes (all of them are powers of two)."""
    raw = column if isinstance(column, list) else column.to_pylist()
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    out = np.zeros((len(raw), width // 8), np.uint64)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        x = np.frombuffer(b"".join([raw[k] for k in at.tolist()]), np.uint64).reshape(len(at), -1, width // 8)
        out[at] = np.bitwise_xor.reduce(x, axis=1)
    return out


def _distances(a, b) -> np.ndarray:
    """In how many bits two columns of sketches differ; the larger one is folded to the smaller."""
    a, b = a.to_pylist(), b.to_pylist()
    width = np.minimum(np.fromiter(map(len, a), np.int64, len(a)), np.fromiter(map(len, b), np.int64, len(b)))
    out = np.zeros(len(a), np.int64)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        for rows in np.array_split(at, -(-len(at) * int(w) // (8 << 20))):
            x, y = (_folded([c[k] for k in rows.tolist()], int(w)) for c in (a, b))
            out[rows] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
    return out


def _two_hashes(s: np.ndarray) -> tuple[int, int]:
    return tuple(int(mix(mix(s + c)).sum(dtype=np.uint64).view(np.int64)) for c in (_C[40], _C[41]))


KINDS = DOCUMENT, SIGNATURES, COPY, PAIR, MEMBER = range(5)
_MAP = "kind int, p int, node long, id long, n long, h1 long, h2 long, bins binary, sigs binary, locals binary"
_POSSIBLE = "a long, b long, na long, nb long, proven boolean"
_OUT = "kind int, a long, b long, n long, h1 long, h2 long, bins binary"


def _signature_rows(docs: DataFrame, groups: int, width: int, num: int, den: int, common=None) -> DataFrame:
    """Rows for the groups: documents (id, size, hashes, sketch), links to a task's earlier copy, packed signatures."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        schema = pa.schema([("kind", pa.int32()), ("p", pa.int32()), *((x, pa.int64()) for x in ("node", "id", "n", "h1", "h2")), *((x, pa.binary()) for x in ("bins", "sigs", "locals"))])
        prefix, seen = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32, {}
        bands = Bands(num, den, 1000)

        def rows(m: int, **cols):
            return pa.RecordBatch.from_arrays([cols[f.name] if f.name in cols else pa.nulls(m, f.type) for f in schema], schema=schema)

        for b in (x for whole in batches for x in in_slices(whole, "_t")):
            ids, texts = b.column(0), [t.encode() if t else b"" for t in b.column(1).to_pylist()]
            for part in in_pieces(texts, PIECE):
                # A document's number in its piece takes 16 bits.
                for q in [slice(k, min(k + 65_535, part.stop)) for k in range(part.start, part.stop, 65_535)]:
                    sets = shingle_sets(texts[q], width)
                    m = len(sets)
                    largest = max(map(len, sets), default=0)
                    if largest > bands.high[-3]:
                        bands = Bands(num, den, 2 * largest)
                    node = prefix + np.arange(m)
                    two = [_two_hashes(s) for s in sets]
                    p = ((node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % groups
                    yield rows(m, kind=pa.array(np.full(m, DOCUMENT, np.int32)), p=pa.array(p.astype(np.int32)), node=pa.array(node), id=ids[q].cast(pa.int64()), n=pa.array([len(s) for s in sets], pa.int64()), h1=pa.array([x[0] for x in two], pa.int64()), h2=pa.array([x[1] for x in two], pa.int64()), bins=pa.array([parities(s) for s in sets], pa.binary()))
                    copies, named = [], ids[q].is_valid().to_pylist()
                    for k, x in enumerate(two):
                        if len(sets[k]):
                            # A row without an id links nothing, so it stands for no other row and needs no signature.
                            first = seen.setdefault(x, int(node[k])) if named[k] else None
                            if first is None:
                                sets[k] = sets[k][:0]
                            elif first != node[k]:
                                copies.append((first, int(node[k]), int(p[k])))
                                sets[k] = sets[k][:0]
                    if copies:
                        yield rows(len(copies), kind=pa.array(np.full(len(copies), COPY, np.int32)), p=pa.array([c[2] for c in copies], pa.int32()), node=pa.array([c[0] for c in copies], pa.int64()), id=pa.array([c[1] for c in copies], pa.int64()))
                    who, sig = signatures(sets, bands, common.value if common is not None else None)
                    if len(sig):
                        to = (sig % np.uint64(groups)).astype(np.int64)
                        order = np.argsort((to << 16) | who)
                        to, local, sig = to[order], who[order].astype(np.uint16), (sig // np.uint64(groups))[order]
                        raw = np.ascontiguousarray(sig.view(np.uint8).reshape(-1, 8)[:, :SIGNATURE_BYTES])
                        cut = np.flatnonzero(np.concatenate([[True], np.diff(to) != 0]))
                        ends = np.concatenate([cut[1:], [len(to)]])
                        yield rows(len(cut), kind=pa.array(np.full(len(cut), SIGNATURES, np.int32)), p=pa.array(to[cut].astype(np.int32)), node=pa.array(np.full(len(cut), prefix)), **{c: pa.array([x[i:j].tobytes() for i, j in zip(cut, ends, strict=True)], pa.binary()) for c, x in (("sigs", raw), ("locals", local))})
                    prefix += 1 << 16

    return docs.toDF("_id", "_t").mapInArrow(giving_back(run), _MAP)


def _pairs_of_group(table):
    """A group's documents and copy links as they are; pairs of small buckets, stars and members of large ones."""
    import pyarrow as pa
    import pyarrow.compute as pc

    kind = table.column("kind")
    schema = pa.schema([("kind", pa.int32()), *((x, pa.int64()) for x in ("a", "b", "n", "h1", "h2")), ("bins", pa.binary())])

    def made(k: int, a, b):
        m = len(a)
        return pa.table([pa.array(np.full(m, k, np.int32)), pa.array(a), pa.array(b), *(pa.nulls(m, pa.int64()) for _ in range(3)), pa.nulls(m, pa.binary())], schema=schema)

    keep = table.filter(pc.not_equal(kind, SIGNATURES))
    out = [pa.table([keep.column(x).combine_chunks() if len(keep) else pa.nulls(0, schema.field(i).type) for i, x in enumerate(("kind", "node", "id", "n", "h1", "h2", "bins"))], schema=schema)]
    packed = table.filter(pc.equal(kind, SIGNATURES))
    if len(packed):
        sig, node = [], []
        for prefix, s, local in zip(*(packed.column(x).to_pylist() for x in ("node", "sigs", "locals")), strict=True):
            wide = np.zeros((len(s) // SIGNATURE_BYTES, 8), np.uint8)
            wide[:, :SIGNATURE_BYTES] = np.frombuffer(s, np.uint8).reshape(-1, SIGNATURE_BYTES)
            sig.append(wide.view(np.uint64).ravel())
            node.append(np.frombuffer(local, np.uint16).astype(np.int64) + prefix)
        sig, node = np.concatenate(sig), np.concatenate(node)
        order = np.argsort(sig)
        sig, node = sig[order], node[order]
        new = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        size = np.diff(np.concatenate([new, [len(sig)]]))
        a, b = [], []
        for m in range(2, SMALL + 1):
            at = new[size == m]
            for i in range(m):
                for j in range(i + 1, m):
                    a.append(node[at + i])
                    b.append(node[at + j])
        sets_seen: set[bytes] = set()
        ma, mb = [], []
        for at, m in zip(new[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
            members = np.unique(node[at : at + m])
            if (raw := members.tobytes()) in sets_seen:
                continue
            sets_seen.add(raw)
            # Near copies stand in many buckets whose members are almost the same: those with one centre go together.
            centre = members[np.argmin(mix(members.astype(np.uint64)))]
            a.append(np.full(len(members), centre))
            b.append(members)
            ma.append(a[-1])
            mb.append(members)
        if a:
            pair = np.stack([np.concatenate(a), np.concatenate(b)], 1)
            pair = np.unique(np.sort(pair, axis=1)[pair[:, 0] != pair[:, 1]], axis=0)
            out.append(made(PAIR, pair[:, 0], pair[:, 1]))
        if ma:
            member = np.unique(np.stack([np.concatenate(ma), np.concatenate(mb)], 1), axis=0)
            out.append(made(MEMBER, member[:, 0], member[:, 1]))
    return pa.concat_tables(out)


def _possible(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose sizes and sketches do not rule them out; ``proven`` where the sets' hashes are equal."""

    def run(batches):
        import pyarrow as pa

        for x in batches:
            if not x.num_rows:
                continue
            na, nb = x.column("na").to_numpy(), x.column("nb").to_numpy()
            near = _distances(x.column("ba"), x.column("bb")) * (den + num) <= (na + nb) * (den - num)
            keep = pa.array(near | x.column("same").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([x.column(c).filter(keep) for c in ("ia", "ib", "na", "nb", "same")], ["a", "b", "na", "nb", "proven"])

    fits = F.least("na", "nb") * den >= F.greatest("na", "nb") * num
    return pairs.filter(fits & (F.col("ia") != F.col("ib"))).select("ia", "ib", "na", "nb", "ba", "bb", "same").mapInArrow(run, _POSSIBLE)


def _with_documents(pairs: DataFrame, d: DataFrame) -> DataFrame:
    for x in "ab":
        pairs = pairs.join(d.select(F.col("node").alias(x), F.col("id").alias(f"i{x}"), F.col("n").alias(f"n{x}"), F.col("h1").alias(f"h{x}"), F.col("h2").alias(f"g{x}"), F.col("bins").alias(f"b{x}")), x)
    return pairs.withColumn("same", (F.col("ha") == F.col("hb")) & (F.col("ga") == F.col("gb")) & (F.col("na") == F.col("nb")))


def _once(pairs: DataFrame) -> DataFrame:
    """Each pair once, the lesser id first."""
    turned = F.col("a") > F.col("b")
    x = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(turned, F.col("nb")).otherwise(F.col("na")).alias("na"), F.when(turned, F.col("na")).otherwise(F.col("nb")).alias("nb"), "proven")
    return x.groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.bool_or("proven").alias("proven"))


def _links(docs: DataFrame, possible: DataFrame, width: int, num: int, den: int, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The pairs (a < b) whose texts are similar, and all pairs that were looked at; ``known`` are left out."""
    possible = _once(possible)
    if known is not None:
        possible = possible.join(known.select("a", "b"), ["a", "b"], "left_anti")
    possible = materialize(possible, "possible")
    if not possible.limit(1).count():
        return materialize(possible.select("a", "b"), "links"), possible
    open_ = possible.filter("NOT proven")
    # Documents that are compared have a leader in common; a block holds the documents of one or two tiles, so that
    # a text is sent once to each block that needs it and not once for each of its pairs.
    ends = open_.select("a", "b", "na").union(open_.select(F.col("b").alias("a"), F.col("a").alias("b"), "nb")).groupBy("a").agg(F.min("b").alias("m"), F.max("na").alias("n"))
    ends = ends.select(F.col("a").alias("_i"), F.least("a", "m").alias("leader"), "n")
    size = ends.groupBy("leader").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("k"))
    tiles = materialize(ends.join(size, "leader").select("_i", F.xxhash64("leader", F.pmod(F.xxhash64("_i"), F.col("k"))).alias("tile")), "tiles")
    x = open_.select("a", "b").join(tiles.withColumnRenamed("_i", "a").withColumnRenamed("tile", "p"), "a").join(tiles.withColumnRenamed("_i", "b").withColumnRenamed("tile", "q"), "b")
    x = materialize(x.select("a", "b", F.xxhash64(F.least("p", "q"), F.greatest("p", "q")).alias("block")), "blocks")
    forget(tiles)
    needed, size = stored(x.select("block", F.explode(F.array("a", "b")).alias("_i")).distinct(), "compared")
    texts = join_small(docs.toDF("_i", "_t").filter("_i IS NOT NULL"), needed, size, ["_i"], "inner")

    def run(pairs, texts):
        import pyarrow as pa

        ids, own = texts.column("_i").to_pylist(), [t.encode() if t else b"" for t in texts.column("_t").to_pylist()]
        sets: dict[int, list[np.ndarray]] = {}
        for part in in_pieces(own, PIECE):
            for i, q in zip(ids[part], shingle_sets(own[part], width), strict=True):
                sets.setdefault(i, []).append(q)
        out = []
        for i, j in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
            out.append(any(_similar(p, q, num, den) for p in sets[i] for q in sets[j]))
        keep = pa.array(out, pa.bool_())
        del sets, own, texts
        give_back()
        return pa.table({c: pairs.column(c).filter(keep) for c in "ab"})

    found = x.groupBy("block").cogroup(texts.select("block", "_i", "_t").groupBy("block")).applyInArrow(run, "a long, b long")
    links = materialize(found.union(possible.filter("proven").select("a", "b")), "links")
    forget(x, needed)
    return links, possible


def _similar(p: np.ndarray, q: np.ndarray, num: int, den: int) -> bool:
    both = np.concatenate([p, q])
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return same > 0 and den * same >= num * (len(p) + len(q) - same)


def _across(members: DataFrame, num: int, den: int, forest: bool) -> DataFrame:
    """Possible pairs between members of a bucket with different labels, tile against tile.

    Two such members are not both of the bucket's largest label, so only tiles of the others meet all tiles.
    With ``forest`` only as many pairs as would join the labels of two tiles if all of them were links.
    """
    per = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("m"))
    size = members.groupBy("bucket").agg(F.greatest(F.count(F.lit(1)) / TILE, F.sum(F.length("bins")) / TILE_BYTES).alias("k"), F.count(F.lit(1)).alias("all"))
    size = size.join(per.groupBy("bucket").agg(F.max_by("label", F.struct("m", "label")).alias("largest"), F.max("m").alias("most")), "bucket")
    # Tiles of the largest label have numbers from 0 on, those of the others follow.
    tiles = lambda rows: F.greatest(F.ceil(F.col("k") * rows / F.col("all")), F.lit(1)).cast("int")
    size = size.select("bucket", "largest", tiles(F.col("most")).alias("_l"), tiles(F.col("all") - F.col("most")).alias("_o"))
    outside, last = F.col("label") != F.col("largest"), F.col("_l") + F.col("_o") - 1
    x = members.join(size, "bucket").withColumn("_mine", F.when(outside, F.col("_l") + F.pmod(F.xxhash64("node"), F.col("_o"))).otherwise(F.pmod(F.xxhash64("node"), F.col("_l"))).cast("int"))
    x = x.withColumn("_other", F.explode(F.when(outside, F.sequence(F.lit(0), last)).otherwise(F.sequence(F.col("_l"), last))))
    x = x.withColumn("_p", F.least("_mine", "_other")).withColumn("_q", F.greatest("_mine", "_other"))

    # Small buckets go together, so that a task's table has about TILE_BYTES.
    x = materialize(x.select("bucket", "_p", "_q", "_mine", "id", "label", "n", "bins"), "tiled")
    held = x.agg(F.sum(F.length("bins") + 48)).first()[0] or 0
    x = x.withColumn("_g", F.pmod(F.xxhash64("bucket", "_p", "_q"), F.lit(1 + held // TILE_BYTES)))

    def compared(mine, p, q, ids, label, n, raw):
        bits = _folded(raw, min(map(len, raw)))
        left, right = np.flatnonzero(mine == p), np.flatnonzero(mine == q)
        root = {x: x for x in label.tolist()} if forest else {}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        # Some rows against all others at a time, within some megabytes of sketches.
        rows = max(1, (1 << 20) // max(1, len(right) * bits.shape[1]))
        for at in range(0, len(left), rows):
            i = left[at : at + rows]
            near = (label[i][:, None] != label[right][None, :]) & (ids[i][:, None] != ids[right][None, :])
            near &= np.minimum(n[i][:, None], n[right][None, :]) * den >= np.maximum(n[i][:, None], n[right][None, :]) * num
            if p == q:
                near &= right[None, :] > i[:, None]
            if not near.any():
                continue
            total = n[i][:, None] + n[right][None, :]
            near &= np.bitwise_count(bits[i][:, None, :] ^ bits[right][None, :, :]).sum(2, dtype=np.int64) * (den + num) <= total * (den - num)
            for x, y in zip(*np.nonzero(near), strict=True):
                j, k = int(i[x]), int(right[y])
                if forest:
                    u, v = find(int(label[j])), find(int(label[k]))
                    if u == v:
                        continue
                    root[u] = v
                yield int(ids[j]), int(ids[k]), int(n[j]), int(n[k])

    def run(table):
        import pyarrow as pa

        table = table.sort_by([("bucket", "ascending"), ("_p", "ascending"), ("_q", "ascending")])
        bucket, p, q, *rest = (table.column(c).to_numpy() for c in ("bucket", "_p", "_q", "_mine", "id", "label", "n"))
        raw, out = table.column("bins").to_pylist(), []
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(bucket) != 0) | (np.diff(p) != 0) | (np.diff(q) != 0), [True]]))
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            mine, ids, label, n = (c[i:j] for c in rest)
            out += compared(mine, p[i], q[i], ids, label, n, raw[i:j])
        return pa.table({c: pa.array([o[k] for o in out], pa.int64()) for k, c in enumerate(("a", "b", "na", "nb"))} | {"proven": pa.array([False] * len(out), pa.bool_())})

    return x.groupBy("_g").applyInArrow(lambda t: run(t.drop_columns(["_g"])), _POSSIBLE)


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    for x in "ab":
        pairs = pairs.join(labels.select(F.col("node").alias(x), F.col("component").alias(f"_{x}")), x, "left")
    return pairs.filter(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b", "na", "nb", "proven")


def _joined_by(labels: DataFrame, more: DataFrame) -> DataFrame:
    """The labels after further links; both tables are deleted if there are any."""
    if not more.limit(1).count():
        forget(more)
        return labels
    out = materialize(components(more.union(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))), "labels")
    forget(labels, more)
    return out


def _same_texts(hashed: DataFrame) -> tuple[DataFrame, int]:
    """(id, lead) of texts that equal that of a lesser id, and their table's bytes; ids that several rows have stay out."""
    once = materialize(hashed.groupBy("id").agg(F.count(F.lit(1)).alias("_n"), F.first("q").alias("q"), F.first("r").alias("r")).filter("_n = 1").drop("_n"), "texts")
    groups, size = stored(once.groupBy("q", "r").agg(F.min("id").alias("lead"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"), "equal")
    out = stored(join_small(once, groups, size, ["q", "r"], "inner").filter("id <> lead").select("id", "lead"), "same-texts")
    forget(once, groups)
    return out


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets with more than one label, with their labels."""
    named = members.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("component", "id"))
    named = materialize(named.select("bucket", "node", "id", "label"), "named-members")
    mixed, size = stored(named.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("bucket"), "mixed")
    out = materialize(join_small(named, mixed, size, ["bucket"], "left_semi"), "mixed-members")
    forget(named, mixed)
    return out


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, num: int = 75, den: int = 100, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """key, n_shingles, component_id (least key reachable by links of similarity num / den)."""
    every = docs.select(F.col(key), F.col(text))
    spark = docs.sparkSession
    bits, shingles, hashed = common_shingles(every, width)
    same, size = _same_texts(hashed)
    forget(hashed)
    docs = join_small(every.toDF("_i", "_t"), same.select(F.col("id").alias("_i")), size, ["_i"], "left_anti").toDF(key, text)
    if size * 4 > BROADCAST_BYTES:  # node numbers follow the order of rows, which a task that is run again must find
        docs = docs.sortWithinPartitions(key, text)
    common = spark.sparkContext.broadcast(bits)
    # A group is one task's table, so their number follows the shingles that were counted.  More would only find the same pairs again.
    groups = 1 + shingles // group_shingles
    rows = materialize(_signature_rows(docs, groups, width, num, den, common).groupBy("p").applyInArrow(lambda t: give_back(_pairs_of_group(t)), _OUT), "pairs")
    d = rows.filter(F.col("kind") == DOCUMENT).select(F.col("a").alias("node"), F.col("b").alias("id"), "n", "h1", "h2", "bins")
    copies = rows.filter(F.col("kind") == COPY).select("a", "b").join(d.select(F.col("node").alias("a"), F.col("id").alias("ia")), "a").join(d.select(F.col("node").alias("b"), F.col("id").alias("ib")), "b").select(F.col("ia").alias("a"), F.col("ib").alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    pairs = rows.filter(F.col("kind") == PAIR).select("a", "b").distinct()
    found = materialize(_once(_possible(_with_documents(pairs, d), num, den)), "candidates")
    # First each document with the least of its partners; then only pairs that these links leave apart.
    least = found.filter("NOT proven").groupBy("b").agg(F.min_by(F.struct("a", "na", "nb"), "a").alias("x")).select("x.a", "b", "x.na", "x.nb", F.lit(False).alias("proven"))
    links, known = _links(docs, least.union(found.filter("proven").select(*least.columns)), width, num, den)
    links = materialize(links.union(copies), "links")
    labels = materialize(components(links), "labels")
    forget(links)
    more, tried = _links(docs, _apart(found, labels), width, num, den, known)
    forget(found)
    known = known.union(tried)
    labels = _joined_by(labels, more)
    # Near copies meet in many groups with one centre: a member counts once for its bucket.
    members = materialize(rows.filter(F.col("kind") == MEMBER).select(F.col("a").alias("bucket"), F.col("b").alias("node")).distinct(), "members")
    if members.limit(1).count():
        members, last = materialize(members.join(d.filter("id IS NOT NULL").select("node", "id"), "node"), "known-members"), members
        forget(last)
        # Each round but the last tries what would join the labels; the last leaves no pair untried.
        for forest in (*[True] * FOREST_ROUNDS, False):
            if not (m := _mixed(members, labels)).limit(1).count():
                forget(m)
                break
            members, last = m.select("bucket", "node", "id"), members
            full = materialize(m.join(d.select("node", "n", "bins"), "node"), "mixed-members")
            more, tried = _links(docs, _across(full, num, den, forest), width, num, den, known)
            forget(full, last)
            members._stored_at = m._stored_at
            known = known.union(tried)
            labels = _joined_by(labels, more)
    out = d.join(labels.withColumnRenamed("node", "id"), "id", "left").select("id", "n", F.coalesce("component", "id").alias("component"))
    if same.limit(1).count():
        # One row for each group of equal texts, then for each of its texts.
        out = materialize(out, "classes")
        leads, size = stored(same.select(F.col("lead").alias("id")).distinct(), "leads")
        leads, size = stored(join_small(out, leads, size, ["id"], "left_semi").withColumnRenamed("id", "lead"), "lead-classes")
        out = out.unionByName(join_small(same, leads, size, ["lead"], "inner").select("id", "n", "component"))
    return out.select(F.col("id").cast(dict(docs.dtypes)[key]).alias(key), F.col("n").alias("n_shingles"), F.col("component").cast(dict(docs.dtypes)[key]).alias("component_id"))


def op3_partenum(spark, sf_dir: str) -> DataFrame:
    return similar_groups(documents(spark, sf_dir))
