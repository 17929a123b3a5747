"""Suffix-array deduplication by distributed prefix doubling on sampled positions (operator 7).

A byte goes when some string of ``threshold`` bytes that covers it also starts in a document
with a smaller id.  ``doubling`` ranks every position by prefix doubling as it is usually written; it
moves each position once per round, which no disk budget near the size of the text allows (the
README has the figures), so it serves as the check of this module.  Here ranks are
taken at winnowed positions only (anchors: the least half-length rank in every threshold-long
string, so two equal strings keep the same anchor), and they grow in two steps:

* Step 1, half the threshold.  Anchors are sorted by rank, and within a rank by the hash of
  their surroundings (every threshold-long string that holds the anchor).  Where a smaller
  document has the same surroundings, all of them go at once.  An anchor whose rank has one kind of
  surroundings only is unique, or settled, and leaves.
* Step 2, the threshold.  For the anchors left the bytes of the surroundings are fetched.  For
  each place of the anchor in a string, records are sorted by (rank, rank of the string), the bytes
  of equal ranks are compared, and the smallest document keeps the string.

Ranks are 64-bit hashes of the bytes (equal strings have equal ranks without a global renumbering).
Step 1 decides by 64 bits of hash and those that the bucket implies; step 2 compares bytes.
Every task first settles what repeats inside it and sends one record per (rank, surroundings),
packed by bucket.  Hot ranks, those of ``HOT_DOCS`` documents of a sample or of more than
``CROWD`` different surroundings, are dealt by whole strings instead, so that they
spread over the buckets; which ranks the sample finds changes the dealing, never the result.

Edge cases: a null text is empty (0 bytes, sha256 of nothing); texts shorter than the
threshold lose nothing; repeated rows (same id and text) get the same result and do not
remove one another, nor do different texts under one id; spans belong to a row (id and hash of the
text, where ids repeat); a null id sorts before all others and is one document; long runs of one byte make
every position an anchor and stay linear; clashing extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import discard, materialize, small_batches

THRESHOLD = 50
#: Bytes of text per bucket, bytes ranked at once, anchors that a task holds before it sends.
BUCKET_BYTES, PIECE, HELD = 1 << 20, 1 << 20, 800_000
#: Sampled documents, how many of them make a rank hot, and different surroundings that do.
SAMPLE_DOCS, HOT_DOCS, CROWD = 4000, 64, 4096
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTES = np.random.default_rng(50).integers(1, 2**63, 256, np.int64).astype(np.uint64) | np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}
_NULL_ID = -(1 << 63)
#: kind 1: by rank (a: rank, b: surroundings, bytes: room to the text's end); 2: by string (a, b: two hashes); 3: by rank (a: rank, b: first and
#: last start of a string, bytes: the surroundings), or open anchors by document (b: 1 where crowded); 0: settled spans, by document (a: start, b: end).
_FLOW = "kind int, bucket int, ids binary, rows binary, places binary, a binary, b binary, bytes binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, PIECE + (1 << 16))
        for name, base in (("up", _BASE), ("down", _BACK)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Ranked:
    """The bytes of several texts, with ranks of any substring from prefix sums."""

    def __init__(self, texts: list[bytes]):
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        up, self.down = _powers(len(self.data) + 1)
        self.sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTES[self.data] * up[:-1], out=self.sums[1:])

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Rank of bytes lo..hi of the joined texts."""
        return _mix((self.sums[hi] - self.sums[lo]) * self.down[lo])

    def all_of_length(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return _mix((self.sums[k:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)

    def anchors(self, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions whose half-length rank is least in a threshold-long string, and those ranks."""
        half = threshold // 2
        window = threshold - half + 1
        rank = self.all_of_length(half)
        n = len(rank) - window + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        least, s = rank, 1
        while s * 2 <= window:
            least, s = np.minimum(least[:-s], least[s:]), s * 2
        least = np.minimum(least[:n], least[window - s : window - s + n])
        # strings that reach into the next text do not count
        valid = np.zeros(n, bool)
        for at, size in zip(self.starts, self.lengths, strict=True):
            if size >= threshold:
                valid[at : at + size - threshold + 1] = True
        least = np.where(valid, least, 0)
        pad = np.zeros(window - 1, np.uint64)
        most, s = np.concatenate([pad, least, pad]), 1
        while s * 2 <= window:
            most, s = np.maximum(most[:-s], most[s:]), s * 2
        most = np.maximum(most[: len(rank)], most[window - s : window - s + len(rank)])
        at = np.flatnonzero(most == rank)
        return at, rank[at]


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes], list]]:
    """(ids, row hashes, texts, rest of the columns) of bounded bytes."""
    ids = np.array([_NULL_ID if v is None else v for v in batch.column(0).to_pylist()], np.int64)
    rows = batch.column(1).to_numpy()
    texts = [t or b"" for t in batch.column(2).to_pylist()]
    lo = 0
    while lo < len(texts):
        hi, held = lo, 0
        while hi < len(texts) and (hi == lo or held + len(texts[hi]) <= PIECE):
            held += len(texts[hi])
            hi += 1
        yield ids[lo:hi], rows[lo:hi], texts[lo:hi], [c.slice(lo, hi - lo).to_pylist() for c in batch.columns[3:]]
        lo = hi


def _buckets_of(docs: DataFrame) -> int:
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(64, min(1 << 20, size // BUCKET_BYTES))


def _bucket(rank: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((rank >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


def _planes(values: np.ndarray, width: int) -> bytes:
    """The ``width`` low bytes of each value, bytes of equal weight side by side, so that what is alike compresses."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T[:width]).tobytes()


def _from_planes(blobs: list[bytes | None], width: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    out = [np.zeros(0, kind)]
    for blob in blobs:
        if blob:
            whole = np.zeros((len(blob) // width, size), np.uint8)
            whole[:, :width] = np.frombuffer(blob, np.uint8).reshape(width, -1).T
            out.append(whole.view(kind).reshape(-1))
    return np.concatenate(out)


def _runs(order_key: np.ndarray) -> np.ndarray:
    """Starts of equal runs in a sorted key."""
    return np.flatnonzero(np.append(True, order_key[1:] != order_key[:-1])) if len(order_key) else np.zeros(0, np.int64)


def _ends(starts: np.ndarray, n: int) -> np.ndarray:
    return np.append(starts[1:], n) if len(starts) else starts


def _split(bucket: np.ndarray, kind: int, columns: list[tuple[np.ndarray, int]], extra: np.ndarray | None = None) -> pa.RecordBatch:
    """Records packed by bucket: (ids, rows, places, a, b) with their widths."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cut = _runs(bucket)
    spans = [order[a:b] for a, b in zip(cut, _ends(cut, len(bucket)), strict=True)]
    blobs = [pa.array([_planes(values[s], width) for s in spans], pa.binary()) for values, width in columns]
    more = pa.array([None if extra is None else extra[s].tobytes() for s in spans], pa.binary())
    return pa.record_batch([pa.array([kind] * len(spans), pa.int32()), pa.array(bucket[cut], pa.int32()), *blobs, more], ["kind", "bucket", "ids", "rows", "places", "a", "b", "bytes"])


#: Bytes of a and b that each kind sends.
_WIDTHS = {0: (4, 4), 1: (5, 5), 2: (8, 5), 3: (8, 4)}


def _send(kind: int, bucket: np.ndarray, ids, rows, places, a, b, extra=None) -> pa.RecordBatch:
    wa, wb = _WIDTHS[kind]
    return _split(bucket, kind, [(ids, 8), (rows, 8), (places.astype(np.int32), 4), (a, wa), (b, wb)], extra)


def _received(table: pa.Table, kind: int) -> list[np.ndarray]:
    """ids, rows, places, a, b of one kind."""
    part = table.filter(pa.array(table.column("kind").to_numpy() == kind))
    wa, wb = _WIDTHS[kind]
    as_a = np.int32 if kind == 0 else np.uint64
    kinds = [("ids", 8, np.int64), ("rows", 8, np.int64), ("places", 4, np.int32), ("a", wa, as_a), ("b", wb, as_a)]
    out = [_from_planes(part.column(c).to_pylist(), w, k) for c, w, k in kinds]
    return [x.astype(np.int64) if x.dtype == np.int32 else x for x in out]


def _owned(key: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by key, and per sorted record whether it belongs to the smallest id of its key."""
    order = np.argsort(key)
    starts = _runs(key[order])
    if not len(starts):
        return order, np.zeros(0, bool)
    least = np.minimum.reduceat(ids[order], starts)
    return order, ids[order] == np.repeat(least, np.diff(np.append(starts, len(order))))


def _merged(ids, rows, starts, ends):
    """Spans sorted by document, neighbours and overlaps made one."""
    order = np.lexsort((ends, starts, rows, ids))
    ids, rows, starts, ends = ids[order], rows[order], starts[order], ends[order]
    if not len(ids):
        return ids, rows, starts, ends
    # the furthest end so far within the document, by a running maximum over (document number, end)
    number = np.cumsum(np.append(True, (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1]))).astype(np.int64)
    reach = np.maximum.accumulate((number << 32) + ends)
    fresh = np.append(True, (number[1:] << 32) + starts[1:] > reach[:-1])
    at = np.flatnonzero(fresh)
    return ids[at], rows[at], starts[at], np.maximum.reduceat(ends, at)


def _document_bucket(ids: np.ndarray, rows: np.ndarray, n_buckets: int) -> np.ndarray:
    return _bucket(_mix(_mix(ids.view(np.uint64)) + rows.view(np.uint64)), n_buckets)


def _send_spans(spans, n_buckets: int) -> pa.RecordBatch:
    """Spans by document; places are not used."""
    ids, rows, starts, ends = _merged(*spans)
    return _send(0, _document_bucket(ids, rows, n_buckets), ids, rows, np.zeros(len(ids), np.int32), starts.astype(np.int32), ends.astype(np.int32))


def hot_ranks(docs: DataFrame, threshold: int) -> np.ndarray:
    """Half-length ranks of anchors that ``HOT_DOCS`` documents of a hash sample have; at most a few ten thousand."""
    total = docs.count()
    if not total:
        return np.zeros(0, np.uint64)
    part = F.pmod(F.xxhash64("doc_id", F.lit("hot"), F.length("text")), F.lit(1 << 30)) < int(min(1.0, SAMPLE_DOCS / total) * (1 << 30))

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts, _ in _pieces(batch):
                found = [np.unique(Ranked([t[: 1 << 20]]).anchors(threshold)[1]) for t in texts]
                yield pa.record_batch([pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64))], ["rank"])

    sampled = docs.where(part).mapInArrow(ranks, "rank long")
    counted = sampled.groupBy("rank").agg(F.count("*").alias("n")).where(F.col("n") >= HOT_DOCS).select("rank")
    return np.sort(counted.toArrow().column("rank").to_numpy().astype(np.int64).view(np.uint64))


def _strings(r: Ranked, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the strings that hold an anchor (by row of ``at``), each start once, and the row each came from."""
    half = threshold // 2
    first = np.maximum(lo, at - (threshold - half))
    last = np.minimum(hi - threshold, at)
    n = np.maximum(last - first + 1, 0)
    starts = np.repeat(first - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
    _, once = np.unique(starts, return_index=True)
    return starts[once], np.repeat(np.arange(len(at)), n)[once]


def _string_hashes(r: Ranked, starts: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    half = threshold // 2
    first, second = r.of(starts, starts + half), r.of(starts + half, starts + threshold)
    return _mix(first * _M2 + second), _mix(second * _M1 + (first ^ (first >> np.uint64(17))))


class _Strings:
    """Records by whole strings of one task, settled before they are sent."""

    def __init__(self, threshold: int, n_buckets: int):
        self.threshold, self.n_buckets, self.held, self.count = threshold, n_buckets, [], 0

    def add(self, r: Ranked, at: np.ndarray, row: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        lo = r.starts[row]
        starts, of = _strings(r, at, lo, lo + r.lengths[row], self.threshold)
        if len(starts):
            a, b = _string_hashes(r, starts, self.threshold)
            doc = row[of]
            self.held.append((ids[doc], rows[doc], starts - r.starts[doc], a, b))
            self.count += len(starts)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        ids, rows, places, a, b = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.count = [], 0
        order, own = _owned(a ^ _mix(b), ids)
        gone, kept = order[~own], order[own]
        if len(gone):
            yield _send_spans((ids[gone], rows[gone], places[gone], places[gone] + self.threshold), self.n_buckets)
        yield _send(2, _bucket(a[kept], self.n_buckets), ids[kept], rows[kept], places[kept], a[kept], b[kept])


def anchor_records(docs: DataFrame, hot: np.ndarray, threshold: int, n_buckets: int) -> DataFrame:
    """Step 1 in each task: anchors with the hash of their surroundings, settled inside the task."""
    half = threshold // 2
    before, after = threshold - half, threshold
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_list = shared.value
        held: list[tuple] = []
        strings = _Strings(threshold, n_buckets)

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            rank, detail, ids, rows, places, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order, own = _owned(rank ^ _mix(detail), ids)
            gone, kept = order[~own], order[own]
            if len(gone):
                yield _send_spans((ids[gone], rows[gone], np.maximum(places[gone] - before, 0), np.minimum(places[gone] + after, sizes[gone])), n_buckets)
            room = np.minimum(sizes[kept] - places[kept], 65535).astype("<u2")
            yield _send(1, _bucket(rank[kept], n_buckets), ids[kept], rows[kept], places[kept], rank[kept], detail[kept], room)

        count = 0
        for batch in batches:
            for ids, rows, texts, _ in _pieces(batch):
                r = Ranked(texts)
                at, rank = r.anchors(threshold)
                if not len(at):
                    continue
                row = np.searchsorted(r.starts, at, side="right") - 1
                if len(hot_list):
                    where = np.minimum(np.searchsorted(hot_list, rank), len(hot_list) - 1)
                    is_hot = hot_list[where] == rank
                    if is_hot.any():
                        strings.add(r, at[is_hot], row[is_hot], ids, rows)
                        at, rank, row = at[~is_hot], rank[~is_hot], row[~is_hot]
                        if strings.count > HELD:
                            yield from strings.flush()
                lo, hi = r.starts[row], r.starts[row] + r.lengths[row]
                left, right = np.maximum(lo, at - before), np.minimum(hi, at + after)
                detail = _mix(r.of(left, right) + _mix((at - left).astype(np.uint64) * np.uint64(1000) + (right - at).astype(np.uint64)))
                held.append((rank, detail, ids[row], rows[row], at - lo, r.lengths[row]))
                count += len(at)
                if count > HELD:
                    yield from flush()
                    count = 0
        yield from flush()
        yield from strings.flush()

    return docs.mapInArrow(run, _FLOW)


def _settled_strings(table: pa.Table, threshold: int):
    ids, rows, places, a, b = _received(table, 2)
    order, own = _owned(a ^ _mix(b), ids)
    gone = order[~own]
    return ids[gone], rows[gone], places[gone], places[gone] + threshold


def settle_anchors(records: DataFrame, threshold: int, n_buckets: int) -> DataFrame:
    """Step 1 over all tasks: covered spans (kind 0, by document), and anchors to look at (kind 3; b: 1 where crowded)."""
    before, after = threshold - threshold // 2, threshold

    def run(key: tuple, table: pa.Table) -> pa.Table:
        out = []
        known = _received(table, 0)
        spans = [[known[k] for k in (0, 1, 3, 4)], _settled_strings(table, threshold)]
        ids, rows, places, rank, detail = _received(table, 1)
        if len(ids):
            blobs = table.filter(pa.array(table.column("kind").to_numpy() == 1)).column("bytes").to_pylist()
            room = np.concatenate([np.frombuffer(x, "<u2") for x in blobs]).astype(np.int64)
            order, own = _owned(rank ^ _mix(detail << np.uint64(20)), ids)
            gone = order[~own]
            spans.append((ids[gone], rows[gone], np.maximum(places[gone] - before, 0), places[gone] + np.minimum(after, room[gone])))
            # owners whose rank has other surroundings too
            kept = order[own]
            kept = kept[np.lexsort((detail[kept], rank[kept]))]
            r, d = rank[kept], detail[kept]
            starts = _runs(r)
            if len(starts):
                fresh = np.append(True, (r[1:] != r[:-1]) | (d[1:] != d[:-1]))
                kinds = np.add.reduceat(fresh.astype(np.int64), starts)
                many = np.repeat(kinds, np.diff(np.append(starts, len(kept))))
                left = kept[many > 1]
                crowded = (many[many > 1] > CROWD).astype(np.uint64)
                if len(left):
                    out.append(_send(3, _document_bucket(ids[left], rows[left], n_buckets), ids[left], rows[left], places[left], rank[left], crowded))
        joined = tuple(np.concatenate(x) for x in zip(*spans, strict=True))
        if len(joined[0]):
            out.append(_send_spans(joined, n_buckets))
        return pa.Table.from_batches(out or [_send_spans(joined, n_buckets)])

    return records.groupBy("bucket").applyInArrow(run, _FLOW)


def open_rows(settled: DataFrame) -> DataFrame:
    """Anchors of kind 3 by row: (o_id, o_row, anchors packed: place, crowded)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids, rows, places, _, crowded = _received(table, 3)
        order = np.lexsort((places, rows, ids))
        ids, rows, places, crowded = ids[order], rows[order], places[order], crowded[order]
        cut = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1]))) if len(ids) else np.zeros(0, np.int64)
        packed = (places * 2 + crowded.astype(np.int64)).astype("<i8")
        blobs = [np.unique(packed[a:b]).tobytes() for a, b in zip(cut, _ends(cut, len(ids)), strict=True)]
        return pa.table({"o_id": pa.array(ids[cut], mask=ids[cut] == _NULL_ID), "o_row": pa.array(rows[cut], pa.int64()), "anchors": pa.array(blobs, pa.binary())})

    return settled.where("kind = 3").groupBy("bucket").applyInArrow(run, "o_id long, o_row long, anchors binary")


def surroundings(docs: DataFrame, open_anchors: DataFrame, threshold: int, n_buckets: int) -> DataFrame:
    """Step 2 in each task: bytes around the open anchors (kind 3), and strings around crowded ones (kind 2)."""
    half = threshold // 2
    before, width = threshold - half, 2 * threshold - half

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        strings = _Strings(threshold, n_buckets)

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                rank, ids, rows, places, cuts, data = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                yield _send(3, _bucket(rank, n_buckets), ids, rows, places, rank, cuts, data)

        count = 0
        for batch in batches:
            for ids, rows, texts, (lists,) in _pieces(batch):
                r = Ranked(texts)
                found = [np.frombuffer(x, "<i8") for x in lists]
                row = np.repeat(np.arange(len(found)), [len(x) for x in found])
                packed = np.concatenate(found)
                at, crowded = (packed >> 1) + r.starts[row], (packed & 1).astype(bool)
                if crowded.any():
                    strings.add(r, at[crowded], row[crowded], ids, rows)
                    at, row = at[~crowded], row[~crowded]
                    if strings.count > HELD:
                        yield from strings.flush()
                if not len(at):
                    continue
                lo, hi = r.starts[row], r.starts[row] + r.lengths[row]
                index = (at - before)[:, None] + np.arange(width)[None, :]
                data = r.data[np.clip(index, 0, len(r.data) - 1)]
                first = np.maximum(lo - (at - before), 0)
                last = np.clip(hi - at + before - threshold, -1, before)
                held.append((r.of(at, at + half), ids[row], rows[row], at - lo, (first | ((last + 1) << 16)).astype(np.uint64), data))
                count += len(at)
                if count > HELD // 8:
                    yield from flush()
                    count = 0
        yield from flush()
        yield from strings.flush()

    rows = docs.join(open_anchors, docs["doc_id"].eqNullSafe(open_anchors["o_id"]) & (docs["row"] == open_anchors["o_row"])).select("doc_id", "row", "text", "anchors")
    return rows.mapInArrow(run, _FLOW)


def settle_bytes(records: DataFrame, threshold: int, n_buckets: int) -> DataFrame:
    """Step 2 over all tasks: per place of the anchor in a string, the smallest document keeps it."""
    half = threshold // 2
    before, width = threshold - half, 2 * threshold - half

    def run(key: tuple, table: pa.Table) -> pa.Table:
        known = _received(table, 0)
        spans = [[known[k] for k in (0, 1, 3, 4)], _settled_strings(table, threshold)]
        ids, rows, places, rank, cuts = _received(table, 3)
        if len(ids):
            blobs = table.filter(pa.array(table.column("kind").to_numpy() == 3)).column("bytes").to_pylist()
            data = np.concatenate([np.frombuffer(x, np.uint8) for x in blobs]).reshape(-1, width)
            first, last = (cuts & np.uint64(0xFFFF)).astype(np.int64), (cuts >> np.uint64(16)).astype(np.int64) - 1
            up, down = _powers(width + 1)
            sums = np.zeros((len(data), width + 1), np.uint64)
            np.cumsum(_BYTES[data] * up[None, :width], axis=1, out=sums[:, 1:])
            mixed = _mix(rank)
            for start in range(before + 1):  # the string starts before - start bytes ahead of the anchor
                able = np.flatnonzero((start >= first) & (start <= last))
                if len(able) < 2:
                    continue
                string = _mix((sums[able, start + threshold] - sums[able, start]) * down[start]) ^ mixed[able]
                order = able[np.lexsort((ids[able], string))]
                value = np.sort(string)
                starts = _runs(value)
                owner = np.repeat(order[starts], np.diff(np.append(starts, len(order))))
                gone = ids[order] != ids[owner]
                at, by = order[gone], owner[gone]
                if len(at):
                    # the bytes decide; a collision keeps the string, which a true repeat never is
                    same = (data[at, start : start + threshold] == data[by, start : start + threshold]).all(axis=1)
                    at = at[same]
                    lo = places[at] - before + start
                    spans.append((ids[at], rows[at], lo, lo + threshold))
        joined = tuple(np.concatenate(x) for x in zip(*spans, strict=True))
        return pa.Table.from_batches([_send_spans(joined, n_buckets)])

    return records.groupBy("bucket").applyInArrow(run, _FLOW)


def document_spans(done: DataFrame, n_buckets: int) -> DataFrame:
    """(o_id, o_row, spans): all covered spans of a document, merged, as pairs of 32-bit numbers."""

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        known = _received(table, 0)
        ids, rows, starts, ends = _merged(*(known[k] for k in (0, 1, 3, 4)))
        at = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1]))) if len(ids) else np.zeros(0, np.int64)
        pairs = np.stack([starts, ends], axis=1).astype(np.int32)
        blobs = [pairs[a:b].tobytes() for a, b in zip(at, _ends(at, len(ids)), strict=True)]
        return pa.table({"o_id": pa.array(ids[at], mask=ids[at] == _NULL_ID), "o_row": pa.array(rows[at], pa.int64()), "spans": pa.array(blobs, pa.binary())})

    return done.where("kind = 0").groupBy("bucket").applyInArrow(merged, "o_id long, o_row long, spans binary")


def _with_rows(docs: DataFrame) -> DataFrame:
    """``row``: tells different texts under one id apart; 0 everywhere when every id has one text."""
    hashed = docs.withColumn("row", F.xxhash64("text"))
    several = hashed.groupBy("doc_id").agg(F.min("row").alias("a"), F.max("row").alias("b")).where("a <> b").limit(1).count()
    return hashed if several else docs.withColumn("row", F.lit(0).cast("long"))


def removed_spans(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(o_id, o_row, spans): per document (doc_id, row, text as bytes) the covered spans, sorted, packed as (start, end) in 32 bits."""
    n_buckets = _buckets_of(docs)
    settled = materialize(settle_anchors(anchor_records(docs, hot_ranks(docs, threshold), threshold, n_buckets), threshold, n_buckets), "settled")
    open_anchors = materialize(open_rows(settled), "open")
    last = materialize(settle_bytes(surroundings(docs, open_anchors, threshold, n_buckets), threshold, n_buckets), "settled")
    spans = materialize(document_spans(settled.unionByName(last), n_buckets), "spans")
    discard(open_anchors, settled, last)
    return spans


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text (UTF-8 bytes), spans (removed, merged) and kept (remaining bytes) of every document."""
    small_batches(docs.sparkSession, 256)
    docs = _with_rows(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))).select("doc_id", "row", "text")
    spans = removed_spans(docs, threshold)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, merged = [], []
            for t, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                runs = np.frombuffer(found or b"", np.int32).reshape(-1, 2).tolist()
                at, out = 0, []
                for a, b in runs:
                    out.append(t[at:a])
                    at = b
                kept.append(b"".join([*out, t[at:]]))
                merged.append([{"start": a, "end": b} for a, b in runs])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(merged, kind), pa.array(kept, pa.binary())], ["doc_id", "text", "spans", "kept"])

    rows = docs.join(spans, docs["doc_id"].eqNullSafe(spans["o_id"]) & (docs["row"] == spans["o_row"]), "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(cut, "doc_id long, text binary, spans array<struct<start:long,end:long>>, kept binary")


def suffix_digest(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    out = remove_repeats(docs, threshold)
    size, kept = F.length("text").cast("long"), F.length("kept").cast("long")
    return out.select("doc_id", size.alias("n_bytes"), (size - kept).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
