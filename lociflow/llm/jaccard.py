"""N-gram Jaccard join by rare-first prefix filtering (operator 8).

1. Every text becomes the set of its distinct word shingles (64-bit hashes).  Equal sets
   form a class; only one row of a class goes on, so copies cost one row.
2. Shingles are ordered from rare to frequent by a table of counts over all documents
   (``BUCKETS`` hash buckets, a fixed size; a shared bucket only changes the order, never a
   result).  Two sets that are similar enough share one of their first n - ceil(t n) + 1
   shingles: the prefix.  Shingles that one document alone has in its prefix are dropped
   before, by a bitmap of fixed size.
3. Rows that share a prefix shingle are candidates when they pass the length and positional
   filters.  First every row meets one other only, the smallest head of its shingles' groups,
   which joins large groups of near copies at linear cost.  Then rows of one shingle that are
   still in different components meet each other: groups of up to ``SMALL`` rows as pairs; of larger
   ones, cut into bands of similar length, first the bitmaps meet in blocks (below), and only rows
   that these leave a partner move their sets.
4. Verification streams the sets of one row's candidates past its own set: the suffix filter
   probes the middle of one set, splits both there and bounds the halves, to ``DEPTH`` levels;
   what passes is intersected exactly.
5. Links are counted inside components, in blocks: two blocks of at most about ``BLOCK_ROWS`` sets
   meet in one task as bit rows, and only sums per row (or a spanning forest, in step 3) leave
   it, so no list of all pairs is ever made.  A set of a component of m different sets moves
   m / ``BLOCK_ROWS`` + 1 times; pairs that steps 3 and 4 have linked are intersected here once more.

Joins are never broadcast, so that the plan and what it moves are the same at every size.

Rows are told apart by a 64-bit hash of id and text; two different rows share one with a
chance of about n^2 / 2^65, the same bound that holds for shingles.

Edge cases: null, empty and wordless texts have no shingles and link with nothing; texts with
fewer words than a shingle count as one shingle; rows without an id, and different texts under
one id, are documents of their own; a component's id is its smallest non-null doc_id (null if it
has none); repeated rows and equal texts share a class and count as links of one another; clashing
extra columns are not read; an empty table gives no rows; very long texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import bitmap_of, discard, freed, in_bitmap, key_bit, materialize, settings, small_batches, without_rows
from lociflow.llm.graph import components

BUCKETS, RANGES = 1 << 22, 64
#: Bits of a set's parity bitmap (four times as many from each size on: a full bitmap tells nothing), and of the table of
#: shared prefix shingles (16 MB at any input).
SKETCH_BITS, SKETCH_SIZES, SHARED_BITS = 512, (400, 1600, 6400), 27
#: Rows of a shingle that meet as pairs; rows and shingles of a block; levels of the suffix filter; candidates of one stream.
SMALL, BLOCK_ROWS, BLOCK_SHINGLES, DEPTH, STREAM = 48, 4096, 2_400_000, 3, 2000
#: Bits of a block's rows that are held at once (as bytes).
HELD_BITS = 1 << 24
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """Hash of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """Sorted distinct shingle hashes of texts; word hashes are kept for the task (bounded)."""

    def __init__(self, words: int):
        self.words, self.cache = words, _WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        found = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
        if not found:
            return np.zeros(0, np.uint64)
        if len(self.cache) > 100_000:
            self.cache.clear()
        hashes = np.fromiter(map(self.cache.__getitem__, found), np.uint64, len(found))
        n = min(self.words, len(hashes))
        rolled = np.full(len(hashes) - n + 1, n, np.uint64)
        for k in range(n):
            rolled = _mix(rolled * _M2 + hashes[k : k + len(rolled)])
        rolled.sort()
        return rolled[np.append(True, rolled[1:] != rolled[:-1])]


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(42)).astype(np.int64)


def shingle_counts(docs: DataFrame, words: int) -> np.ndarray:
    """Order of the hash buckets by documents over all of ``docs`` (text): 0 rare to 65,535 frequent, on a logarithmic scale."""
    width = BUCKETS // RANGES

    @freed
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, total = Shingler(words), np.zeros(BUCKETS, np.uint32)
        salt = TaskContext.get().partitionId() // 16
        for batch in batches:
            hits = [_bucket(shingles(t)) for t in batch.column(0).to_pylist()]
            if hits:
                at, n = np.unique(np.concatenate(hits), return_counts=True)
                total[at] += n.astype(np.uint32)
        counts = total.astype("<u4").reshape(RANGES, width)
        some = [r for r in range(RANGES) if counts[r].any()]
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array([salt] * len(some), pa.int32()), pa.array([_planes(counts[r]) for r in some], pa.binary())], ["range", "salt", "counts"])

    def added(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for blob in table.column("counts").to_pylist():
            total += _from_planes(blob, np.uint32)
        return pa.table({"range": pa.array([key[0].as_py()], pa.int32()), "salt": pa.array([table.column("salt")[0].as_py() // 64], pa.int32()), "counts": pa.array([_planes(np.minimum(total, 2**32 - 1).astype("<u4"))], pa.binary())})

    def ordered(key: tuple, table: pa.Table) -> pa.Table:
        counts = _from_planes(added(key, table).column("counts")[0].as_py(), np.uint32)
        return pa.table({"range": pa.array([key[0].as_py()], pa.int32()), "places": pa.array([(np.log2(counts + 1.0) * 2047).astype("<u2").tobytes()], pa.binary())})

    schema = "range int, salt int, counts binary"
    # a tree: of 16 tasks, of 64 such sums, and of what is left (a thousand blobs of 256 KB for a million tasks)
    partial = docs.select("text").mapInArrow(count, schema)
    for _ in range(2):
        partial = partial.groupBy("range", "salt").applyInArrow(added, schema)
    out = np.zeros((RANGES, width), np.uint16)
    for r in partial.groupBy("range").applyInArrow(ordered, "range int, places binary").collect():  # RANGES rows, 8 MB
        out[r.range] = np.frombuffer(r.places, "<u2")
    return out.reshape(-1)


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, so that leading zeros compress."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _from_planes(blob: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def sketch_of(s: np.ndarray) -> np.ndarray:
    """Parity bitmap of a set, as words: bit k counts, modulo 2, the shingles whose last bits are k."""
    bits = SKETCH_BITS << 2 * sum(len(s) > size for size in SKETCH_SIZES)
    parity = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def folded(words: np.ndarray, size: int) -> np.ndarray:
    """A longer bitmap as the one of ``size`` words of the same set: parities of bits that fall together add up."""
    return np.bitwise_xor.reduce(words.reshape(-1, size), axis=0)


def _needed(n, percent: int):
    return -((-percent * n) // 100)


def signatures(docs: DataFrame, order_of: np.ndarray, words: int, percent: int) -> DataFrame:
    """(row, doc_id, n, key, prefix, sketch, wide): set size, identity of the set, rare-first prefix shingles, parity bitmap, and the
    longer one of a large set (empty for others)."""
    shared = docs.sparkSession.sparkContext.broadcast(order_of)

    @freed
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, table = Shingler(words), shared.value
        for batch in batches:
            n, keys, prefixes, sketches, wide = [], [], [], [], []
            for t in batch.column(2).to_pylist():
                s = shingles(t)
                n.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                # s ascends, so a stable order by count is the order by (count, shingle)
                order = np.argsort(table[_bucket(s)], kind="stable")[: len(s) - _needed(len(s), percent) + 1] if len(s) else []
                prefixes.append(s[order].view(np.int64) if len(s) else np.zeros(0, np.int64))
                wide.append(sketch_of(s))
                sketches.append(folded(wide[-1], SKETCH_BITS // 64))
                if len(wide[-1]) == len(sketches[-1]):
                    wide[-1] = wide[-1][:0]
            ends = np.cumsum([0, *(len(p) for p in prefixes)], dtype=np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            maps = []
            for part in (sketches, wide):
                at = pa.array(np.cumsum([0, *(len(x) for x in part)], dtype=np.int32))
                maps.append(pa.ListArray.from_arrays(at, pa.array(np.concatenate(part) if part else np.zeros(0, np.int64))))
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), *maps]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), *lists], ["row", "doc_id", "n", "key", "prefix", "sketch", "wide"])

    return docs.select("row", "doc_id", "text").mapInArrow(sign, "row long, doc_id long, n long, key binary, prefix array<long>, sketch array<long>, wide array<long>")


def shared_tokens(members: DataFrame) -> np.ndarray:
    """Bitmap over the leading ``SHARED_BITS`` bits of prefix shingles that two or more rows have.

    Tasks send each of their distinct shingles once, packed by range; a hot shingle costs one
    record per task.  The bitmap has a fixed size; a shared bit only lets a row through.
    """
    total = members.agg(F.sum(F.size("prefix"))).first()[0] or 0
    n_buckets = 1 << max(6, min(20, (total * 8 >> 20).bit_length()))
    shift = np.uint64(64 - n_buckets.bit_length() + 1)

    @freed
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            token, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            bucket = (token >> shift).astype(np.int64)
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
            spans = list(zip(cut, np.append(cut[1:], len(bucket)), strict=True))
            many = n > 1
            columns = [pa.array([int(bucket[a]) for a, _ in spans], pa.int32())] + [pa.array([c[a:b].tobytes() for a, b in spans], pa.binary()) for c in (token, many)]
            yield pa.record_batch(columns, ["bucket", "tokens", "many"])

        size = 0
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            held.append(flat)
            size += len(flat)
            if size > 2_000_000:
                yield from flush()
                size = 0
        yield from flush()

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        token = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()])
        many = np.concatenate([np.frombuffer(x, bool) for x in table.column("many").to_pylist()])
        order = np.argsort(token, kind="stable")
        token, many = token[order], many[order]
        many[1:] |= token[1:] == token[:-1]
        width = (1 << SHARED_BITS) // n_buckets
        bits = np.zeros(width, bool)
        bits[((token[many] >> np.uint64(64 - SHARED_BITS)) % np.uint64(width)).astype(np.int64)] = True
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    packed = members.select("prefix").mapInArrow(local, "bucket int, tokens binary, many binary")
    out = np.zeros((n_buckets, (1 << SHARED_BITS) // n_buckets // 8), np.uint8)
    for r in packed.groupBy("bucket").applyInArrow(merged, "bucket int, bits binary").collect():  # 16 MB at most
        out[r.bucket] = np.frombuffer(r.bits, np.uint8)
    return out.reshape(-1)


def prefix_rows(members: DataFrame, shared: np.ndarray) -> DataFrame:
    """(id, n, pos, token) of the prefix shingles whose bit is set in ``shared``."""
    table = members.sparkSession.sparkContext.broadcast(shared)

    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = table.value
        for batch in batches:
            lists = batch.column(2)
            lengths = np.diff(lists.offsets.to_numpy())
            token = lists.flatten().to_numpy(zero_copy_only=False)
            bit = (token.view(np.uint64) >> np.uint64(64 - SHARED_BITS)).astype(np.int64)
            keep = np.flatnonzero(bitmap[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1)
            row = np.repeat(np.arange(len(lengths)), lengths)[keep]
            pos = keep - (np.cumsum(lengths) - lengths)[row]
            at = pa.array(row)
            yield pa.record_batch([batch.column(0).take(at), batch.column(1).take(at), pa.array(pos, pa.int32()), pa.array(token[keep], pa.int64())], ["id", "n", "pos", "token"])

    return members.select("row", "n", "prefix").mapInArrow(run, "id long, n long, pos int, token long")


def shingle_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(id, shingles) for at least the rows in ``ids`` (one column): whole sorted sets, packed; a task gives a repeated row once."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap_of(ids.select(key_bit(F.col(ids.columns[0])).alias("b"))))

    @freed
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen, bitmap = Shingler(words), set(), bits.value
        for batch in batches:
            if len(seen) > 300_000:
                seen.clear()
            keep = np.flatnonzero(in_bitmap(bitmap, batch.column(2).to_numpy()))
            rows, texts = batch.column(0).to_numpy(), batch.column(1)
            out, packed = [], []
            for k in keep:
                if (row := int(rows[k])) not in seen:
                    seen.add(row)
                    out.append(row)
                    packed.append(shingles(texts[k].as_py()).tobytes())
            yield pa.record_batch([pa.array(out, pa.int64()), pa.array(packed, pa.binary())], ["id", "shingles"])

    return docs.select("row", "text", key_bit(F.col("row")).alias("b")).mapInArrow(sets, "id long, shingles binary")


def suffix_bound(x: np.ndarray, y: np.ndarray, most: int, depth: int = DEPTH) -> int:
    """A lower bound of the size of the symmetric difference of two sorted sets, exact enough to exceed ``most`` or not.

    The middle of the shorter set is probed and both sets are split there; what lies on one
    side of the probe cannot match what lies on the other.
    """
    apart = abs(len(x) - len(y))
    if apart > most or not depth or not len(x) or not len(y):
        return apart
    if len(x) < len(y):
        x, y = y, x
    probe = len(y) // 2
    at = int(np.searchsorted(x, y[probe]))
    miss = int(at == len(x) or x[at] != y[probe])
    rest = x[at + 1 - miss :]
    left_gap, right_gap = abs(at - probe), abs(len(rest) - (len(y) - probe - 1))
    bound = left_gap + right_gap + miss
    if bound > most:
        return bound
    left = suffix_bound(x[:at], y[:probe], most - right_gap - miss, depth - 1)
    if left + right_gap + miss > most:
        return left + right_gap + miss
    return left + miss + suffix_bound(rest, y[probe + 1 :], most - left - miss, depth - 1)


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Suffix filter, then the exact test 100 * intersection >= percent * union."""
    size = len(x) + len(y)
    need = -((-percent * size) // (100 + percent))  # 100 i >= p (size - i)
    if suffix_bound(x, y, size - 2 * need) > size - 2 * need:
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum()) >= need


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold.

    Every candidate's set travels to the task of its partner ``a``, whose own set comes first in
    the stream; a partner with many candidates is dealt to several streams.
    """
    streams = pairs.groupBy("a").agg(F.ceil(F.count("*") / STREAM).cast("int").alias("streams"))
    salted = pairs.join(streams, "a").select("a", F.pmod(F.xxhash64("b"), F.col("streams")).cast("int").alias("salt"), "b")
    heads = streams.select("a", F.explode(F.sequence(F.lit(0), F.col("streams") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"))
    # partners and candidates meet their sets in one join, so that a set moves twice at most
    asked = heads.unionByName(salted).withColumn("id", F.coalesce("b", "a"))
    dealt = asked.join(sets, "id").select("a", "salt", "b", "shingles").repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    @freed
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            out: list[tuple[int, int]] = []
            for a, b, blob in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                if b is None:
                    head, own = a, np.frombuffer(blob, np.uint64)
                elif a == head and similar(own, np.frombuffer(blob, np.uint64), percent):
                    out.append((a, b))
            yield pa.record_batch([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return dealt.mapInArrow(check, "a long, b long")


def _common(a: list[np.ndarray], b: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of every set of ``a`` with every set of ``b`` (or of ``a``)."""
    sets = a + (b or [])
    tokens = np.concatenate(sets)
    tokens.sort()
    tokens = tokens[1:][tokens[1:] == tokens[:-1]]  # others are in no intersection
    shared = tokens[np.append(True, tokens[1:] != tokens[:-1])] if len(tokens) else tokens
    out = np.zeros((len(a), len(sets) - len(a) if b else len(a)), np.int32)
    width = max(64, HELD_BITS // len(sets) // 64 * 64)
    for lo in range(0, len(shared), width):  # a part of the columns as bits; sets ascend, so each has its part in one piece
        part = shared[lo : lo + width]
        bits = np.zeros((len(sets), -(-len(part) // 64) * 64), bool)
        for k, s in enumerate(sets):
            inside = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], "right")]
            column = np.searchsorted(part, inside)
            bits[k, column[part[column] == inside]] = True
        words = np.packbits(bits, axis=1).view(np.uint64)
        other = words[len(a) :] if b else words
        for k in range(len(a)):
            out[k] += np.bitwise_count(words[k] & other).sum(axis=1, dtype=np.int32)
    return out


def block_pairs(rows: DataFrame, group: list[str]) -> DataFrame:
    """``rows`` (group columns, id, n, more) dealt to pairs (i, j) of blocks of their group.

    A row goes to every pair that its own block is in, so a task holds two blocks of bounded size.
    """
    size = rows.groupBy(*group).agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = rows.join(size, group).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    each = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return each.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other", "blocks")


def possible_rows(rows: DataFrame, group: list[str], percent: int) -> DataFrame:
    """Of ``rows`` (group, id, n, comp, sketch) in pairs of blocks those with a partner of another component that lengths and bitmaps allow."""

    def run(table: pa.Table) -> pa.Table:
        block, i, j, n, comp = (table.column(c).to_numpy() for c in ("block", "i", "j", "n", "comp"))
        bits = table.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(block), -1)
        first = np.flatnonzero(block == i)
        second = first if len(i) and i[0] == j[0] else np.flatnonzero(block == j)
        keep = np.zeros(len(block), bool)
        for k in first:
            apart = np.bitwise_count(bits[second] ^ bits[k]).sum(axis=1, dtype=np.int64)
            both = n[second] + n[k]
            able = (comp[second] != comp[k]) & (np.minimum(n[second], n[k]) * 100 >= np.maximum(n[second], n[k]) * percent) & ((both - apart) * (100 + percent) >= both * (2 * percent))
            if able.any():
                keep[k] = True
                keep[second[able]] = True
        return table.select([*group, "i", "j", "block", "id", "comp"]).filter(pa.array(keep))

    dealt = block_pairs(rows.select(*group, "id", "n", "comp", "sketch"), group)
    types = {f.name: f.dataType.simpleString() for f in dealt.schema.fields}
    return dealt.groupBy(*group, "i", "j").applyInArrow(run, ", ".join(f"{c} {types[c]}" for c in [*group, "i", "j", "block", "id", "comp"]))


def _blocks_of(table: pa.Table, percent: int):
    """Distinct rows of the first and the second block, and which of them link."""
    ids = table.column("id").to_numpy()
    _, once = np.unique(ids, return_index=True)
    block, i, j = (table.column(c).to_numpy()[once] for c in ("block", "i", "j"))
    first, second = once[block == i], once[block == j]
    blobs = table.column("shingles")
    a = [np.frombuffer(blobs[int(k)].as_buffer(), np.uint64) for k in first]
    one = bool(len(i)) and i[0] == j[0]
    b = None if one else [np.frombuffer(blobs[int(k)].as_buffer(), np.uint64) for k in second]
    if not a or (b is not None and not b):
        return first, second, None
    sizes, others = np.array([len(s) for s in a]), np.array([len(s) for s in (a if one else b)])
    common = _common(a, b)
    linked = np.zeros(common.shape, bool)
    for k in range(len(a)):
        linked[k] = common[k].astype(np.int64) * (100 + percent) >= (sizes[k] + others) * percent
    if one:
        np.fill_diagonal(linked, False)
    return first, second, linked


def block_forest(rows: DataFrame, group: list[str], sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join the components of a group's rows (id, n, comp, sketch): a spanning forest per pair of blocks."""

    def run(table: pa.Table) -> pa.Table:
        first, second, linked = _blocks_of(table, percent)
        out: list[tuple[int, int]] = []
        if linked is not None:
            ids, comp = table.column("id").to_numpy(), table.column("comp").to_numpy()
            one = linked.shape[0] == linked.shape[1] and np.array_equal(first, second)
            nodes = first if one else np.concatenate([first, second])
            if not one:  # one square of links over both blocks
                n, m = linked.shape
                square = np.zeros((n + m, n + m), bool)
                square[:n, n:], square[n:, :n] = linked, linked.T
                linked = square
            fresh = np.ones(len(nodes), bool)
            for start in range(len(nodes)):
                if not fresh[start]:
                    continue
                fresh[start] = False
                queue = [start]
                while queue:
                    k = queue.pop()
                    found = np.flatnonzero(linked[k] & fresh)
                    fresh[found] = False
                    queue += found.tolist()
                    out += [(int(ids[nodes[k]]), int(ids[nodes[f]])) for f in found if comp[nodes[k]] != comp[nodes[f]]]
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    dealt = possible_rows(rows, group, percent).join(sets, "id")
    return dealt.select(*group, "i", "j", "block", "id", "comp", "shingles").groupBy(*group, "i", "j").applyInArrow(run, "a long, b long")


def block_counts(rows: DataFrame, group: list[str], sets: DataFrame, percent: int) -> DataFrame:
    """(id, links): the weights of the rows that each row (id, n, weight) links with inside its group."""

    def run(table: pa.Table) -> pa.Table:
        first, second, linked = _blocks_of(table, percent)
        if linked is None:
            return pa.table({"id": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        ids, weight = table.column("id").to_numpy(), table.column("weight").to_numpy()
        one = np.array_equal(first, second)
        out = [(ids[first], linked @ weight[first if one else second])]
        if not one:
            out.append((ids[second], weight[first] @ linked))
        return pa.table({"id": pa.array(np.concatenate([x[0] for x in out])), "links": pa.array(np.concatenate([x[1] for x in out]).astype(np.int64))})

    dealt = block_pairs(rows, group).join(sets, "id")
    counted = dealt.select(*group, "i", "j", "block", "id", "weight", "shingles").groupBy(*group, "i", "j").applyInArrow(run, "id long, links long")
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


def _close(a: str, b: str, percent: int):
    """Length and positional filter for two rows of a shingle's group."""
    n1, n2, p1, p2 = (F.col(f"{x}{y}") for y in ("n", "pos") for x in (a, b))
    most = F.least(n1 - p1, n2 - p2) + F.least(p1, p2)
    return (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent) & (most * (100 + percent) >= (n1 + n2) * percent)


def _alike(a: str, b: str, percent: int):
    """Sets differ in at least as many shingles as their parity bitmaps differ in bits; bitmaps of two lengths leave a pair open."""
    x, y = F.col(f"{a}sketch"), F.col(f"{b}sketch")
    apart = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, k: n + k)
    both = F.col(f"{a}n") + F.col(f"{b}n")
    return (F.size(x) != F.size(y)) | ((both - apart) * (100 + percent) >= both * (2 * percent))


def _component_of(rows: DataFrame, comp: DataFrame) -> DataFrame:
    return rows.join(comp, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")


def class_links(docs: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """Components (id, component) over the rows that have links; ``members`` is used up."""
    n = members.count()
    rows = prefix_rows(members, shared_tokens(members))
    groups = rows.groupBy("token").agg(F.count("*").alias("c"), F.min(F.struct("id", "n", "pos")).alias("p")).where("c > 1")
    rows = materialize(rows.join(groups, "token").select("token", "id", "n", "pos", F.col("p.id").alias("p_id"), F.col("p.n").alias("p_n"), F.col("p.pos").alias("p_pos")), "prefixes")
    # first: one partner for each row
    star = rows.select("id", F.col("n").alias("x_n"), F.col("pos").alias("x_pos"), "p_id", F.col("p_n").alias("y_n"), F.col("p_pos").alias("y_pos")).where("id <> p_id")
    tried = star.where(_close("x_", "y_", percent)).groupBy(F.col("id").alias("b")).agg(F.min("p_id").alias("a")).select("a", "b")
    longest = F.when(F.size("wide") > 0, F.col("wide")).otherwise(F.col("sketch"))
    profile = lambda side, name: members.select(F.col("row").alias(side), F.col("n").alias(f"{name}_n"), longest.alias(f"{name}_sketch"))
    likely = lambda pairs: pairs.join(profile("a", "x"), "a").join(profile("b", "y"), "b").where(_alike("x_", "y_", percent)).select("a", "b")
    tried = materialize(likely(tried), "pairs", n)
    links = materialize(verify(tried, sets_of(docs, tried, words), percent), "links", n)
    comp = components(links, n)
    # then: rows of one shingle that are in different components still
    tagged = _component_of(rows.select("token", "id", "n", "pos"), comp)
    per = tagged.groupBy("token", "comp").agg(F.count("*").alias("c"))
    mixed = per.groupBy("token").agg(F.sum("c").alias("group_size"), F.count("*").alias("k")).where("k > 1").drop("k")
    sketches = members.select(F.col("row").alias("id"), "sketch")
    tagged = materialize(tagged.join(mixed, "token").join(sketches, "id"), "mixed")
    discard(rows)
    few = tagged.where(F.col("group_size") <= SMALL)
    x, y = (few.select("token", *[F.col(c).alias(f"{s}_{c}") for c in ("id", "n", "pos", "comp", "sketch")]) for s in "xy")
    crossing = x.join(y, "token").where((F.col("x_id") < F.col("y_id")) & (F.col("x_comp") != F.col("y_comp")) & _close("x_", "y_", percent) & _alike("x_", "y_", percent))
    pairs = crossing.select(F.col("x_id").alias("a"), F.col("y_id").alias("b")).distinct()
    known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # the short bitmaps travel with every shingle of a row, the long ones of large sets only with pairs that these leave
    second = materialize(likely(pairs.join(known, ["a", "b"], "left_anti")), "pairs")
    discard(members)
    # sets of similar enough size are in the same or the next band; a row stands in both
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(100.0 / percent))).cast("int") if percent < 100 else F.col("n").cast("int")
    many = tagged.where(F.col("group_size") > SMALL).select("token", "id", "n", "comp", "sketch", F.explode(F.array(band, band + 1)).alias("band"))
    apart = many.groupBy("token", "band").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2").select("token", "band")
    many = materialize(many.join(apart, ["token", "band"]), "crowded")
    wanted = second.select(F.explode(F.array("a", "b")).alias("id")).unionByName(many.select("id")).distinct()
    sets = materialize(shingle_sets(docs, wanted, words), "sets")
    found = verify(second, sets, percent).unionByName(block_forest(many, ["token", "band"], sets, percent))
    more = materialize(found, "links")
    if more.limit(1).count():
        discard(comp)
        comp = components(links.unionByName(more), n)
    discard(tried, second, many, tagged, sets, links, more)
    return comp


def sets_of(docs: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """Whole sets of at least the rows in ``pairs``."""
    return shingle_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), words)


def count_links(docs: DataFrame, classes: DataFrame, comp: DataFrame, words: int, percent: int) -> DataFrame:
    """(rep, links): documents that a class links with beside its own."""
    rows = materialize(classes.select(F.col("rep").alias("id"), "n", F.col("class_size").alias("weight")).join(comp, "id"), "linked", comp.count())
    counted = materialize(block_counts(rows, ["component"], shingle_sets(docs, rows.select("id"), words), percent), "counts", rows.count())
    discard(rows)
    return counted.withColumnRenamed("id", "rep")


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id", links: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, class_size, n_links, row, component.

    ``words`` per shingle; two documents link when 100 * intersection >= ``percent`` * union.
    class_size: rows with an equal set; n_links: rows that the document links with, equal sets
    included (null without ``links``); row: the hash of id and text; component: the same for all rows
    of a component, whatever their ids.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
    with settings(docs.sparkSession, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        signed = materialize(signatures(docs, shingle_counts(docs, words), words, percent), "signatures")
        alike = signed.where("n > 0").groupBy("key").agg(F.min("row").alias("rep"), F.min("doc_id").alias("least"), F.max("n").alias("n"), F.count("*").alias("class_size"))
        n = signed.count()
        classes = materialize(alike, "classes", n)
        # rows of classes of their own stay where they are; only the others meet their class
        several = materialize(signed.select("row", "key").distinct().join(classes.where("class_size > 1").select("key", "rep"), "key").select("row", (F.col("row") == F.col("rep")).alias("stays")), "several", n)
        members = materialize(without_rows(signed.where("n > 0").select("row", "n", "prefix", "sketch", "wide"), several, "row"), "members")
        discard(several)
        # prefixes are kept once, and no longer than they are read
        sizes = materialize(signed.select("row", "doc_id", "n", "key"), "sizes", n)
        discard(signed)
        comp = class_links(docs, members, words, percent).withColumnRenamed("id", "rep")
        counted = count_links(docs, classes, comp.withColumnRenamed("rep", "id"), words, percent) if links else classes.select("rep", F.lit(None).cast("long").alias("links")).where("false")
    joined = classes.hint("merge").join(comp, "rep")
    named = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    labelled = classes.hint("merge").join(joined.select("rep", "component").hint("merge").join(named, "component"), "rep", "left")
    labelled = labelled.hint("merge").join(counted, "rep", "left").select(
        "key",
        F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
        "class_size",
        (F.coalesce("links", F.lit(0)) + F.col("class_size") - 1 if links else F.lit(None).cast("long")).alias("n_links"),
        F.coalesce("component", "rep").alias("component"),
    )
    found = sizes.where("n > 0").hint("merge").join(labelled, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "class_size", "n_links", "row", "component")
    none = F.lit(0).cast("long") if links else F.lit(None).cast("long")
    alone = sizes.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("class_size"), none.alias("n_links"), "row", F.col("row").alias("component"))
    return found.unionByName(alone)
