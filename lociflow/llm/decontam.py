"""Benchmark decontamination over a positional inverted index (operator 10).

The index is built once over the whole corpus and stored as a table in the shared folder.  It is
cut into segments, as many as tasks fill with ``SEGMENT_POSTINGS`` postings.  A segment is one
row: its documents, a sorted term dictionary, and per term a posting list (documents and
ascending word positions), so a query reads it where it lies, without a shuffle.  Terms that the
benchmark does not have are left out by a bitmap of fixed size, so one pass over the documents
serves a benchmark of any length.

A query is a window of an item: ``window`` consecutive words, or the whole item when it is
shorter.  Document frequencies are summed from the stored dictionaries; every window takes its
terms from the rarest to the most frequent.  In a segment that has all of them, the postings of
the rarest term, less its offset, are the candidate starts; each further list,
offset-adjusted, is intersected with them until none is left or all terms agree.  What
remains are exact phrase matches.  Starts without one are tried again with a tolerance of
``slop`` words per term around the expected place: proximity matches.

Terms are 64-bit hashes of words (a false match needs ten chosen words to collide).  Windows are
sent to the tasks in blocks of ``WINDOW_BLOCK`` (some 15 MB), and every block reads the index once,
not the documents.

Edge cases: null texts have no words; an item without words has no window and is never hit;
empty tables give documents without hits; every row of the corpus gives one row, whatever ids
repeat or are null; repeated items count once, and items without an id as one of the empty
name; texts of any length are indexed whole; clashing extra columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import WANTED_BITS, bitmap_of, in_bitmap, materialize, small_batches

WINDOW, SLOP = 10, 2
#: Postings of a segment (8 MB), documents of a segment, windows of a block.
SEGMENT_POSTINGS, SEGMENT_DOCS, WINDOW_BLOCK = 1_000_000, 50_000, 100_000
#: Bytes that are not part of a word become spaces, A-Z become a-z.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: One row per segment: packed ids, null flags and word counts of its documents; terms, their document counts, ends of their lists; the lists.
INDEX_SCHEMA = "segment long, ids binary, nulls binary, sizes binary, terms binary, n_docs binary, ends binary, docs binary, places binary"
_HITS = "doc_id long, n_words long, spans array<long>, exact_items array<string>, near_items array<string>"


_COLUMNS = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]


class _Terms(dict):
    """Signed 64-bit hash of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        value = self[word] = value - (1 << 64) if value >> 63 else value
        return value


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def _terms_of(words: list[bytes], known: _Terms) -> np.ndarray:
    if len(known) > 200_000:
        known.clear()
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def _term_bits(terms: np.ndarray) -> np.ndarray:
    return (terms.view(np.uint64) >> np.uint64(64 - WANTED_BITS)).astype(np.int64)


def build_index(docs: DataFrame, terms: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The index rows of all of ``docs``, with the lists of at least the ``terms`` (one long column)."""
    spark = docs.sparkSession
    small_batches(spark)
    wanted = spark.sparkContext.broadcast(bitmap_of(terms.select(F.shiftrightunsigned(terms.columns[0], 64 - WANTED_BITS).cast("int").alias("b"))))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bitmap = _Terms(), wanted.value
        ids: list = []
        sizes: list[int] = []
        lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0

        def segment() -> Iterator[pa.RecordBatch]:
            number = int.from_bytes(os.urandom(8), "little", signed=True)
            term, doc, pos = (np.concatenate(x) for x in zip(*lists, strict=True)) if lists else (np.zeros(0, np.int64),) * 3
            order = np.argsort(term, kind="stable")  # documents and positions ascend already
            term, doc, pos = term[order], doc[order].astype("<i4"), pos[order].astype("<i4")
            cut = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
            ends = np.append(cut[1:], len(term)) if len(cut) else cut
            new_doc = np.append(1, (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
            n_docs = np.add.reduceat(new_doc, cut) if len(cut) else np.zeros(0, np.int64)
            packed = [np.array([i or 0 for i in ids], "<i8"), np.array([i is None for i in ids], np.uint8), np.array(sizes, "<i4"), term[cut], n_docs.astype("<i4"), ends.astype("<i8"), doc, pos]
            for k in (ids, sizes, lists):
                k.clear()
            yield pa.record_batch([pa.array([number], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in packed)], _COLUMNS)

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                terms_ = _terms_of(words_of(t), known)
                at = np.flatnonzero(in_bitmap(bitmap, _term_bits(terms_)))
                if len(at):
                    lists.append((terms_[at], np.full(len(at), len(ids)), at))
                    held += len(at)
                ids.append(i)
                sizes.append(len(terms_))
                if held >= SEGMENT_POSTINGS or len(ids) >= SEGMENT_DOCS:
                    yield from segment()
                    held = 0
        if ids:
            yield from segment()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(index, INDEX_SCHEMA)


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, item, terms): the distinct windows of every item; repeated items give them once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Terms()
        for batch in batches:
            ids, items, terms = [], [], []
            for item, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = _terms_of(words_of(t), known).tolist()
                pieces = {tuple(found[k : k + window]) for k in range(max(1, len(found) - window + 1))} if found else set()
                for piece in pieces:
                    ids.append(hashlib.blake2b(repr((item, piece)).encode("utf-8", "surrogatepass"), digest_size=16).digest())
                    items.append(item)
                    terms.append(list(piece))
            yield pa.record_batch([pa.array(ids, pa.binary()), pa.array(items, pa.string()), pa.array(terms, pa.list_(pa.int64()))], ["id", "item", "terms"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return rows.mapInArrow(cut, "id binary, item string, terms array<long>").dropDuplicates(["id"])


def term_frequencies(index: DataFrame) -> DataFrame:
    """(term, n): documents per term, summed from the dictionaries of all segments."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.record_batch([pa.array(np.frombuffer(terms, "<i8")), pa.array(np.frombuffer(n, "<i4").astype(np.int64))], ["term", "n"])

    return index.select("terms", "n_docs").mapInArrow(read, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def rare_first(windows: DataFrame, index: DataFrame) -> DataFrame:
    """(id, item, terms, offsets): the terms of each window from the rarest on; windows with a term that no document has go."""
    each = windows.select("id", "item", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term")).join(term_frequencies(index), "term")
    order = each.groupBy("id", "item", "size").agg(F.array_sort(F.collect_list(F.struct("n", "term", "offset"))).alias("order")).where("size(order) = size")
    return order.select("id", "item", F.transform("order", lambda x: x["term"]).alias("terms"), F.transform("order", lambda x: x["offset"]).alias("offsets"))


def _has(sorted_values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_values, wanted)
    at[at == len(sorted_values)] = 0
    return sorted_values[at] == wanted


def _near(sorted_values: np.ndarray, wanted: np.ndarray, slop: int) -> np.ndarray:
    at = np.searchsorted(sorted_values, wanted - slop)
    inside = at < len(sorted_values)
    return inside & (sorted_values[np.minimum(at, len(sorted_values) - 1)] <= wanted + slop)


class _Segment:
    """Posting lists of a stored segment, as sorted (document, position) keys made when they are asked for."""

    def __init__(self, terms: bytes, ends: bytes, docs: bytes, places: bytes):
        self.terms, self.ends = np.frombuffer(terms, "<i8"), np.frombuffer(ends, "<i8")
        self.docs, self.places, self.made = np.frombuffer(docs, "<i4"), np.frombuffer(places, "<i4"), {}

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Numbers of terms in the dictionary; -1 where it lacks one."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == terms, at, -1) if len(self.terms) else np.full(terms.shape, -1)

    def keys(self, k: int) -> np.ndarray:
        if k not in self.made:
            part = slice(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))
            self.made[k] = (self.docs[part].astype(np.int64) << 32) | self.places[part]
        return self.made[k]


def _block_hits(index: DataFrame, block: list, slop: int) -> tuple[DataFrame, Broadcast]:
    """Hits of one block of windows in every document of every segment, with segment and place; and what was broadcast for it."""
    size = max((len(r.terms) for r in block), default=1)
    terms, offsets = np.zeros((len(block), size), np.int64), np.zeros((len(block), size), np.int32)
    sizes = np.array([len(r.terms) for r in block], np.int32)
    for k, r in enumerate(block):
        terms[k, : len(r.terms)], offsets[k, : len(r.terms)] = r.terms, r.offsets
    shared = index.sparkSession.sparkContext.broadcast((terms, offsets, sizes, [r.item for r in block]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, offsets, sizes, items = shared.value
        inside = np.arange(terms.shape[1])[None, :] < sizes[:, None]
        for batch in batches:
            for number, ids, nulls, words, *lists in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, nulls, words = np.frombuffer(ids, "<i8"), np.frombuffer(nulls, np.uint8), np.frombuffer(words, "<i4")
                segment = _Segment(*lists)
                numbers = segment.find(terms)
                spans: dict[int, set] = {}
                exact: dict[int, set] = {}
                near: dict[int, set] = {}
                for k in np.flatnonzero(((numbers >= 0) | ~inside).all(axis=1)).tolist():
                    n = int(sizes[k])
                    rarest, first = segment.keys(numbers[k, 0]), int(offsets[k, 0])
                    rest = list(zip(numbers[k, 1:n].tolist(), offsets[k, 1:n].tolist(), strict=True))
                    starts = (rarest[(rarest & 0xFFFFFFFF) >= first] if first else rarest) - first
                    starts = starts[(starts & 0xFFFFFFFF) + n <= words[starts >> 32]]
                    for t, offset in rest:
                        if not len(starts):
                            break
                        starts = starts[_has(segment.keys(t), starts + offset)]
                    for s in starts.tolist():
                        spans.setdefault(s >> 32, set()).add((s & 0xFFFFFFFF, n))
                        exact.setdefault(s >> 32, set()).add(items[k])
                    if slop:
                        around = rarest - first
                        for t, offset in rest:
                            if not len(around):
                                break
                            around = around[_near(segment.keys(t), around + offset, slop)]
                        for d in np.unique((around + first) >> 32).tolist():
                            near.setdefault(d, set()).add(items[k])
                n = len(ids)
                columns = [
                    pa.array(ids, pa.int64(), mask=nulls.astype(bool)),
                    pa.array(words.astype(np.int64)),
                    pa.array([[x for s in sorted(spans.get(k, ())) for x in s] for k in range(n)], pa.list_(pa.int64())),
                    pa.array([sorted(exact.get(k, ())) for k in range(n)], pa.list_(pa.string())),
                    pa.array([sorted(near.get(k, set()) - exact.get(k, set())) for k in range(n)], pa.list_(pa.string())),
                    pa.array([number] * n, pa.int64()),
                    pa.array(np.arange(n), pa.int64()),
                ]
                yield pa.record_batch(columns, ["doc_id", "n_words", "spans", "exact_items", "near_items", "segment", "place"])

    return index.select("segment", "ids", "nulls", "sizes", "terms", "ends", "docs", "places").mapInArrow(search, _HITS + ", segment long, place long"), shared


def search(index: DataFrame, ordered: DataFrame, slop: int = SLOP) -> DataFrame:
    """One row per indexed document: doc_id, n_words, spans (start, length pairs), exact_items, near_items."""
    blocks = max(1, -(-ordered.count() // WINDOW_BLOCK))
    block_of = F.pmod(F.xxhash64("id"), F.lit(blocks))
    rows_of = lambda k: ordered.where(block_of == k).select("item", "terms", "offsets").collect()
    if blocks == 1:
        return _block_hits(index, rows_of(0), slop)[0].drop("segment", "place")
    # block by block: what is held, here and in the tasks, is one block, whatever the benchmark
    found = []
    for k in range(blocks):
        hits, shared = _block_hits(index, rows_of(k), slop)
        some = F.size("exact_items") + F.size("near_items") > 0
        found.append(materialize(hits if k == 0 else hits.where(some), "hits"))
        shared.destroy()
    # the place in the segment tells repeated rows apart
    merged = reduce(lambda a, b: a.unionByName(b), found).groupBy("segment", "place").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("exact_items")))).alias("exact_items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_items")))).alias("near_items"),
    )
    return merged.withColumn("near_items", F.array_except("near_items", "exact_items")).drop("segment", "place")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_words, spans (start, length pairs), exact_items, near_items."""
    windows = materialize(windows_of(benchmark, window), "windows")
    index = materialize(build_index(docs, windows.select(F.explode("terms").alias("term")), text, doc_id), "index")
    return search(index, materialize(rare_first(windows, index), "ordered"), slop)


def contamination_digest(hits: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near."""
    small_batches(hits.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, n_words, spans, exact, near = (c.to_pylist() for c in batch.columns)
            covered = []
            for s in spans:
                end = total = 0
                for start, length in sorted(zip(s[::2], s[1::2], strict=True)):
                    total += max(0, start + length - max(end, start))
                    end = max(end, start + length)
                covered.append(total)
            shas = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in exact]
            columns = [(doc, pa.int64()), (n_words, pa.int64()), (covered, pa.int64()), ([len(x) for x in exact], pa.int64()), (shas, pa.string()), ([c > 0 for c in covered], pa.bool_()), ([len(x) for x in near], pa.int64())]
            yield pa.record_batch([pa.array(v, k) for v, k in columns], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near"])

    return hits.select("doc_id", "n_words", "spans", "exact_items", "near_items").mapInArrow(digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, n_near long")
