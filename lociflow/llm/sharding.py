"""Histogram sort into shards of near-equal bytes (operator 2, native).

Rows are ordered by (60 leading bits of md5(text), doc_id).  A driver loop counts the
exact bytes and rows that lie below candidate key boundaries over all partitions, keeps
only the key range around each wanted splitter, and probes that range again until every
splitter is within tolerance.  Only the ranges still open are read in later rounds, only
sums per probe reach the driver (at most ``MAX_PROBES`` rows a round), and the rows
themselves move once.

The law is ``bytes``: sizes come first.  Equal texts are neighbours in the order, so a group of
them stays in one shard unless a splitter falls inside it; there doc_id decides, so a hot
group is spread instead of overfilling one shard.

Inside a shard rows are numbered by parts: a part is a cell of the hash (as many cells as make
about ``PART_BYTES`` each), and a cell that one text fills beyond that is dealt to several
parts by a hash of the id.  Parts are counted, their first slots are running sums over a table
with one row per part, and a part is what one task sorts; its size does not grow with the input.

Edge cases: a null text counts no bytes (size 8) and has a null crc; a null doc_id sorts
first; rows that agree in doc_id and text cannot be separated and share a shard and a part; an
empty table gives no rows; input columns whose names clash with the result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociflow.llm.common import materialize

#: Probe rows that one counting round may return to the driver.
MAX_PROBES = 8192
#: Bytes that one part (one task's sort) should hold.
PART_BYTES = 16 << 20
#: Bytes that each row counts beside its text.
ROW_BYTES = 8
_H, _D, _W = "__h", "__d", "__w"
Key = tuple[int, int]


def text_hash(text: Column) -> Column:
    """60 leading bits of md5(text) as a long; a null text counts as the empty one."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def with_key(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    return (
        df.withColumn(_H, text_hash(F.col(text)))
        .withColumn(_D, F.coalesce(F.col(doc_id).cast("long"), F.lit(-1)))
        .withColumn(_W, F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + ROW_BYTES)
    )


@dataclass
class _Range:
    """Keys ``lo`` to ``hi`` (both occur); what lies below; the first key after it."""

    lo: Key
    hi: Key
    below_bytes: int
    below_rows: int
    after: tuple[Key | None, int, int]
    targets: list[int] = field(default_factory=list)


def _at_least(lo: Key) -> Column:
    return (F.col(_H) > lo[0]) | ((F.col(_H) == lo[0]) & (F.col(_D) >= lo[1]))


def _inside(r: _Range) -> Column:
    hi = (F.col(_H) < r.hi[0]) | ((F.col(_H) == r.hi[0]) & (F.col(_D) <= r.hi[1]))
    return _at_least(r.lo) & hi


def _probe(r: _Range, probes: int) -> Column:
    """Equal steps over the key part that still differs inside the range."""
    at = 0 if r.lo[0] != r.hi[0] else 1
    step = (r.hi[at] - r.lo[at]) // probes + 1
    return F.expr(f"({(_H, _D)[at]} - {r.lo[at]}L) div {step}L")


def histogram_splitters(keyed: DataFrame, parts: int, tolerance: float = 0.0):
    """Splitters of ``parts`` near-equal parts: [(key, bytes below, rows below)], parts - 1 of them.

    Splitter t is the first key with at least t/parts of all bytes below it, or, within
    ``tolerance`` (a fraction of a part), a later one that a probe has met.  A key of None
    lies beyond the last row.
    """
    total = keyed.agg(F.sum(_W).alias("w"), F.count("*").alias("n"), F.min(F.struct(_H, _D)).alias("lo"), F.max(F.struct(_H, _D)).alias("hi")).first()
    if not total.n:
        return [(None, 0, 0)] * (parts - 1)
    found: dict[int, tuple[Key | None, int, int]] = {}
    # ceil(t * total / parts): the least number of bytes that must lie below splitter t
    goal = {t: -(-t * total.w // parts) for t in range(1, parts)}
    slack = tolerance * total.w / parts
    open_ranges = [_Range(tuple(total.lo), tuple(total.hi), 0, 0, (None, total.w, total.n), list(goal))]
    while open_ranges:
        probes = max(2, MAX_PROBES // len(open_ranges))
        where, which, step = None, None, None
        for i, r in enumerate(open_ranges):
            inside = _inside(r)
            where = inside if where is None else where | inside
            which = F.when(inside, i) if which is None else which.when(inside, i)
            step = F.when(inside, _probe(r, probes)) if step is None else step.when(inside, _probe(r, probes))
        counted = (
            keyed.where(where)
            .groupBy(which.alias("r"), step.alias("p"))
            .agg(F.sum(_W).alias("w"), F.count("*").alias("n"), F.min(F.struct(_H, _D)).alias("lo"), F.max(F.struct(_H, _D)).alias("hi"))
            .collect()
        )
        by_range: dict[int, list] = {}
        for row in sorted(counted, key=lambda x: (x.r, x.p)):
            by_range.setdefault(row.r, []).append(row)
        later: list[_Range] = []
        for i, r in enumerate(open_ranges):
            cells, below_w, below_n = [], r.below_bytes, r.below_rows
            for row in by_range[i]:
                cells.append(_Range(tuple(row.lo), tuple(row.hi), below_w, below_n, (None, 0, 0)))
                below_w, below_n = below_w + row.w, below_n + row.n
            for j, cell in enumerate(cells):
                nxt = cells[j + 1] if j + 1 < len(cells) else None
                cell.after = (nxt.lo, nxt.below_bytes, nxt.below_rows) if nxt else r.after
            k = 0
            for t in sorted(r.targets):
                if cells[0].below_bytes >= goal[t]:
                    found[t] = (cells[0].lo, cells[0].below_bytes, cells[0].below_rows)
                    continue
                while cells[k].after[1] < goal[t]:
                    k += 1
                cell = cells[k]
                if cell.lo == cell.hi or cell.after[1] - goal[t] <= slack:
                    found[t] = cell.after
                else:
                    cell.targets.append(t)
            later += [c for c in cells if c.targets]
        open_ranges = later
    return [found[t] for t in range(1, parts)]


def histogram_shards(docs: DataFrame, n_shards: int = 24, text: str = "text", doc_id: str = "doc_id", tolerance: float = 0.0, part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` with size, text_crc32, law ('bytes'), shard, slot and grown_shard (null)."""
    clash = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in clash])
    keyed = with_key(docs, text, doc_id)
    part = ["__shard", "__cell", "__part"]
    narrow = keyed.select(_H, _D, _W).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cuts = histogram_splitters(narrow, n_shards, tolerance)
        total = narrow.agg(F.sum(_W)).first()[0] or 0
        bits = max(0, min(40, (total // part_bytes).bit_length()))
        shard = sum((_at_least(c[0]).cast("int") for c in cuts if c[0] is not None), F.lit(0))
        cell = F.shiftright(_H, 60 - bits) if bits else F.lit(0).cast("long")
        placed = lambda df: df.withColumn("__shard", shard).withColumn("__cell", cell)
        # cells that one text overfills: their rows are dealt to several parts
        sizes = placed(narrow).groupBy("__shard", "__cell").agg(F.ceil(F.sum(_W) / part_bytes).cast("int").alias("__parts"))
        hot = materialize(sizes.where("__parts > 4"), "hot")

        def parted(df: DataFrame) -> DataFrame:
            deal = F.coalesce(F.pmod(F.xxhash64(_D), F.col("__parts")), F.lit(0)).cast("int")
            return placed(df).join(hot, ["__shard", "__cell"], "left").withColumn("__part", deal).drop("__parts")

        counted = parted(narrow).groupBy(*part).agg(F.count("*").alias("__n"))
        before = Window.partitionBy("__shard").orderBy("__cell", "__part").rowsBetween(Window.unboundedPreceding, -1)
        first = materialize(counted.withColumn("__first", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"), "parts")
    finally:
        narrow.unpersist()
    inside = Window.partitionBy(*part).orderBy(_H, _D)
    numbered = parted(keyed).withColumn("__slot", F.row_number().over(inside) - 1)
    return numbered.join(first, part).select(
        *docs.columns,
        F.col(_W).alias("size"),
        F.crc32(F.col(text).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("__shard").alias("shard"),
        (F.col("__first") + F.col("__slot")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
