"""Point-in-time feature join by augmented interval trees (operator 12).

1. A version is usable from the later of event and arrival until its expiry.  Of versions of one key
   with equal start and expiry only the best (event, arrival, rank) can ever win, so one goes on.
2. Time is cut in cells: ``CELL`` units wide, twice as wide on every further level.  A version lies on the first
   level whose cells are as wide as it is long, in one cell or two; an ask looks in one cell of
   every level in use.  So a version is copied once at most, whatever its length.
3. Cells with many versions or asks are split by hash into pieces of about ``PIECE_VERSIONS``; an ask
   goes to every piece of its cell.
4. A piece is a balanced tree over its versions by start: every node knows the largest expiry below it.
   Asks go down from the root past nodes that start too late or have all expired; the leaves they
   reach are all versions that are usable at their time, and the lexicographic maximum stays.
5. The best of all pieces is the answer of a distinct (key, time), and asks with it get it by an equi join.

Counts of cells, versions and asks are only moved by hash; nothing is collected (but one number, the set of levels
in use) and nothing broadcast.

Edge cases: versions without key, event, arrival, expiry or rank, and those that expire before they start, are
never usable; an ask without key or time has no winner; repeated asks get the same answer each;
repeated versions tie, and the largest payload wins (nulls last); empty tables give asks without winners; extra
columns of both inputs are kept out by their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociflow.llm.common import materialize

CELL = 1024
#: Versions and asks of a piece; versions and asks looked at together by one step of a search.
PIECE_VERSIONS, PIECE_ASKS, STEP = 65_536, 65_536, 1 << 22
#: Levels at most: times are 64-bit numbers.
LEVELS = 52


class IntervalTree:
    """Intervals by start in a balanced tree, kept level by level: ``tops[k]`` has the largest end below each node."""

    def __init__(self, start: np.ndarray, end: np.ndarray):
        self.order = np.argsort(start, kind="stable")
        self.start = start[self.order]
        size = 1 << max(0, int(len(start) - 1).bit_length())
        ends = np.full(size, np.iinfo(np.int64).min)
        ends[: len(start)] = end[self.order]
        self.tops = [ends]
        while len(self.tops[-1]) > 1:
            self.tops.append(self.tops[-1].reshape(-1, 2).max(axis=1))

    def stabbed(self, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (ask, interval) with start <= time < end, by ask."""
        started = np.searchsorted(self.start, times, side="right")  # intervals before this place have started
        ask, node = np.arange(len(times)), np.zeros(len(times), np.int64)
        for level in range(len(self.tops) - 1, -1, -1):
            if level < len(self.tops) - 1:
                ask, node = np.repeat(ask, 2), (np.repeat(node * 2, 2).reshape(-1, 2) + [0, 1]).reshape(-1)
            keep = ((node << level) < started[ask]) & (self.tops[level][node] > times[ask])
            ask, node = ask[keep], node[keep]
        return ask, self.order[node]


def best_of_piece(start: np.ndarray, end: np.ndarray, place: np.ndarray, times: np.ndarray) -> np.ndarray:
    """For each time the interval with the largest ``place`` among those usable then, or -1."""
    best = np.full(len(times), -1, np.int64)
    if not len(start):
        return best
    tree = IntervalTree(start, end)
    by_place = np.empty(len(place), np.int64)
    by_place[place] = np.arange(len(place))
    step = max(1, STEP // len(start))
    for at in range(0, len(times), step):
        ask, found = tree.stabbed(times[at : at + step])
        if len(ask):
            head = np.flatnonzero(np.append(True, ask[1:] != ask[:-1]))
            best[at + ask[head]] = by_place[np.maximum.reduceat(place[found], head)]
    return best


def _cell(time: Column, level: Column) -> Column:
    """Number of the cell of ``time``; floor division, also below zero."""
    width = F.shiftleft(F.lit(CELL).cast("long"), level) if isinstance(level, int) else F.expr(f"shiftleft({CELL}L, level)")
    return F.floor((time - F.pmod(time, width)) / width).cast("long")


def point_in_time(versions: DataFrame, asks: DataFrame, payload: list[str]) -> DataFrame:
    """(key, t, event, arrival, rank, payload...): the winner of every distinct (key, t) of ``asks``.

    ``versions``: key, event, arrival, expiry, rank and the ``payload`` columns, times as whole numbers; the latest event
    wins, then the latest arrival, then the largest rank.
    """
    start = F.greatest("event", "arrival")
    order = ["event", "arrival", "rank", *payload]
    usable = versions.select("key", start.alias("start"), "expiry", F.struct(*order).alias("v")).where("key is not null and v.event is not null and v.arrival is not null and v.rank is not null and start < expiry")
    best = usable.groupBy("key", "start", "expiry").agg(F.max("v").alias("v"))
    # the first level with cells at least as wide as the version is long
    level = F.greatest(F.lit(0), F.ceil(F.log2((F.col("expiry") - F.col("start")) / F.lit(CELL)))).cast("int")
    spread = best.withColumn("level", F.least(level, F.lit(LEVELS)))
    cells = F.sequence(_cell(F.col("start"), F.col("level")), _cell(F.col("expiry") - 1, F.col("level")))
    placed = materialize(spread.withColumn("cell", F.explode(cells)), "versions")
    used = placed.agg(F.bit_or(F.expr("shiftleft(1L, level)")).alias("b")).first()["b"] or 0
    levels = [k for k in range(LEVELS + 1) if used >> k & 1]
    times = materialize(asks.where("key is not null and t is not null").select("key", F.col("t").cast("long").alias("t")).distinct(), "asks")
    asked = times.withColumn("level", F.explode(F.lit(levels).cast("array<int>"))).withColumn("cell", _cell(F.col("t"), F.col("level")))
    keys = ["key", "level", "cell"]
    counted = placed.groupBy(keys).agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("m")).unionByName(asked.groupBy(keys).agg(F.lit(0).cast("long").alias("n"), F.count("*").alias("m")))
    # only cells where versions and asks meet go on
    sizes = counted.groupBy(keys).agg(F.sum("n").alias("n"), F.sum("m").alias("m")).where("n > 0 and m > 0")
    pieces = materialize(sizes.select(*keys, F.ceil(F.col("n") / PIECE_VERSIONS).cast("int").alias("n_pieces"), F.ceil(F.col("m") / PIECE_ASKS).cast("int").alias("m_pieces")), "pieces")

    def dealt(rows: DataFrame, own: str, other: str, by: list[str]) -> DataFrame:
        met = rows.hint("merge").join(pieces, keys)
        own_piece = F.pmod(F.xxhash64(*by), F.col(own)).cast("int").alias(own[0])
        # a row of one side meets every piece of the other
        return met.select(*rows.columns, own_piece, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[0])).repartition(*keys, "n", "m")

    left = dealt(placed, "n_pieces", "m_pieces", ["start", "expiry"])
    right = dealt(asked, "m_pieces", "n_pieces", ["t"])
    value = placed.schema["v"].dataType.simpleString()

    def search(group: tuple, mine: pa.Table, times: pa.Table) -> pa.Table:
        v, t = mine.column("v").combine_chunks(), times.column("t").combine_chunks()
        columns = [v.field(k).to_numpy(zero_copy_only=False) for k in range(3)]
        place = np.empty(len(v), np.int64)
        # start and expiry tell versions apart; the larger stands later only where all of the order is equal
        place[np.lexsort((*columns[::-1],))] = np.arange(len(v))
        found = best_of_piece(mine.column("start").to_numpy(), mine.column("expiry").to_numpy(), place, t.to_numpy())
        hit = np.flatnonzero(found >= 0)
        return pa.table({"key": times.column("key").combine_chunks().take(pa.array(hit)), "t": t.take(pa.array(hit)), "v": v.take(pa.array(found[hit]))})

    kind = placed.schema["key"].dataType.simpleString()
    found = left.groupBy(*keys, "n", "m").cogroup(right.groupBy(*keys, "n", "m")).applyInArrow(search, f"key {kind}, t long, v {value}")
    won = found.groupBy("key", "t").agg(F.max("v").alias("v")).select("key", "t", "v.*")
    return won


def hex_number(value: Column, group: int) -> Column:
    """The ``group``-th eight-digit group (from 0) of a hex string as an unsigned number."""
    return F.conv(F.substring(value, 1 + 8 * group, 8), 16, 10).cast("long")


#: Rules of the query: seconds of a day's half, spread of arrivals and of expiries, age from which a value is stale.
SPAN, LATE, BEFORE, VALID, STALE = 50_000, 600, 60, 900, 120


def document_versions(docs: DataFrame) -> DataFrame:
    """(key, event, arrival, expiry, rank, n_chars, lang): every document as a version of its source."""
    digest = docs.select(F.col("source").alias("key"), F.col("doc_id").cast("long").alias("rank"), F.col("n_chars").cast("long").alias("n_chars"), "lang", F.sha2(F.col("doc_id").cast("string").cast("binary"), 256).alias("h"))
    event, b, c = hex_number(F.col("h"), 0) % SPAN, hex_number(F.col("h"), 1), hex_number(F.col("h"), 2)
    return digest.select("key", event.alias("event"), (event - BEFORE + b % LATE).alias("arrival"), (event + c % VALID).alias("expiry"), "rank", "n_chars", "lang")


def label_asks(labels: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, key, t): the source (the least, where one id has several) and the time that a label asks about."""
    t = hex_number(F.sha2(F.col("doc_id").cast("string").cast("binary"), 256), 3) % SPAN
    sources = docs.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("source").alias("key"))
    return labels.select(F.col("doc_id").cast("long").alias("doc_id")).hint("merge").join(sources, "doc_id", "left").select("doc_id", "key", t.alias("t"))


def feature_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per label: doc_id, t, version_id, age, status, n_chars, lang."""
    asks = materialize(label_asks(labels, docs), "label_asks")
    won = point_in_time(document_versions(docs), asks, ["n_chars", "lang"])
    age = F.col("t") - F.col("event")
    status = F.when(F.col("event").isNull(), "none").when(age > STALE, "stale").otherwise("fresh")
    out = asks.hint("merge").join(won, ["key", "t"], "left").select("doc_id", "t", F.col("rank").alias("version_id"), age.alias("age"), status.alias("status"), "n_chars", "lang")
    fresh = F.col("status") == "fresh"
    return out.withColumn("n_chars", F.when(fresh, F.col("n_chars"))).withColumn("lang", F.when(fresh, F.col("lang")))


def feature_sql() -> str:
    """The same for DuckDB over ``documents`` and ``labels``."""
    number = lambda k: f"CAST('0x' || substr(sha256(doc_id::VARCHAR), {1 + 8 * k}, 8) AS BIGINT)"
    return f"""
WITH v AS (
  SELECT source, doc_id, n_chars, lang, {number(0)} % {SPAN} AS event,
         {number(0)} % {SPAN} - {BEFORE} + {number(1)} % {LATE} AS arrival, {number(0)} % {SPAN} + {number(2)} % {VALID} AS expiry FROM documents),
q AS (SELECT row_number() OVER () AS r, l.doc_id, {number(3).replace("doc_id", "l.doc_id")} % {SPAN} AS t, d.source
      FROM labels l LEFT JOIN (SELECT doc_id, min(source) AS source FROM documents GROUP BY doc_id) d USING (doc_id)),
w AS (
  SELECT q.*, v.doc_id AS version_id, v.event, v.n_chars, v.lang,
         row_number() OVER (PARTITION BY r ORDER BY v.event DESC NULLS LAST, v.arrival DESC NULLS LAST, v.doc_id DESC NULLS LAST, v.n_chars DESC NULLS LAST, v.lang DESC NULLS LAST) AS place
  FROM q LEFT JOIN v ON v.source = q.source AND v.event <= q.t AND v.arrival <= q.t AND q.t < v.expiry)
SELECT doc_id, t, version_id, t - event AS age, CASE WHEN event IS NULL THEN 'none' WHEN t - event > {STALE} THEN 'stale' ELSE 'fresh' END AS status,
       CASE WHEN t - event <= {STALE} THEN n_chars END AS n_chars, CASE WHEN t - event <= {STALE} THEN lang END AS lang
FROM w WHERE place = 1"""
