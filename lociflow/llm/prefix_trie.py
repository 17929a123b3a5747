"""Conversation prefix trie (operator 11).

1. Every turn becomes 16 bytes of the SHA-256 of its role and text, and its length; texts are not
   moved.  Turns of a conversation become one array, in their order.
2. The arrays are range-sorted over the whole table, ties by conversation.  Rows of a trie node are
   then neighbours: a node of depth d is a run of rows whose adjacent longest common prefixes
   (LCPs) are at least d.
3. Each partition sweeps its rows with a stack of open nodes.  When an LCP falls below a node's depth
   the node closes and adds its sums to the one below it.  Nodes on the path of the partition's first
   or last row may go on in a neighbour; they leave the task as one stack for each of the two paths.
4. The stacks of all partitions (two rows for each partition, whatever it holds) pass in order through the same
   sweep, which closes what was open.  Children whose parent closed there learn the parent's
   smallest member by a join on partition, side and depth.

A hot first turn, a hot conversation text or a third of all rows in one node are runs over many
partitions and cost nothing more, but for ``ends_sha256``: a hash is sequential, so the ids of a run of
equal conversations pass in order, as one string per partition, through the one task of step 4.

Bound: a conversation is one array of 20 bytes a turn in one task.  Two different turns share a digest with a
chance of about n^2 / 2^129.

Edge cases: null roles and texts are empty; turns without an order come first; turns of one order
stand by the digest of role and text; repeated rows are turns of their own; rows without conv_id are not read;
an empty table has no nodes; extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociflow.llm.common import materialize

#: Conversations of this many ids share a head, of at most ``HEADS`` - 1 turns.
FAMILY, HEADS = 100, 6
KEY_BYTES = 16
_SWEPT = (
    "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, last_turn binary, "
    "part int, side int, lo int, keys array<binary>, sizes array<int>, sums array<long>, shas array<string>, ids string"
)
NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "last_turn"]


def turn_key(role: Column, text: Column) -> Column:
    """Digest of a turn; the length of the role keeps ("a", "bc") and ("ab", "c") apart."""
    return F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)), 1, KEY_BYTES)


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, keys, sizes): digests and lengths of the turns of every rebuilt conversation.

    The first h turns of c come from conversation c - c % 100 and the others from c itself, where h is the
    crc32 of c modulo 6.  One shuffle: families are dealt whole, at most 100 conversations each.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    conv = F.col("conv_id").cast("long")
    turns = conversations.where(conv.isNotNull()).select(
        (conv - conv % FAMILY).alias("family"), conv.alias("conv_id"), F.struct(F.col("turn"), turn_key(role, text).alias("key"), F.length(text).cast("int").alias("size")).alias("t")
    )
    own = turns.repartition("family").groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    head = F.first(F.when(F.col("family") == F.col("conv_id"), F.slice("own", 1, HEADS - 1)), ignorenulls=True).over(Window.partitionBy("family"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    rest = F.slice("own", taken + 1, F.greatest(F.size("own") - taken, F.lit(0)))
    path = F.concat(F.coalesce(F.slice(head, F.lit(1), taken), F.slice("own", 1, 0)), rest)
    return own.withColumn("path", path).select("conv_id", F.col("path.key").alias("keys"), F.col("path.size").alias("sizes"))


class _Node:
    """An open node: sums over what has closed below it so far."""

    __slots__ = ("key", "size", "n", "least", "children", "leaves", "saved", "ends", "sha", "first", "waiting", "refs")

    def __init__(self, key: bytes | None, size: int, first: bool):
        self.key, self.size, self.first = key, size, first
        self.n = self.children = self.leaves = self.saved = 0
        self.least: int | None = None
        self.ends: list[int] = []
        self.sha = None  # of ids that other partitions sent
        self.waiting: list[tuple] = []
        self.refs: list[tuple[int, int]] = []

    def add(self, n: int, least: int | None, children: int, leaves: int, saved: int) -> None:
        if n:
            self.n += n
            self.least = least if self.least is None else min(self.least, least)
        self.children += children
        self.leaves += leaves
        self.saved += saved

    def close(self) -> None:
        self.leaves = self.leaves or 1
        self.saved += (self.n - 1) * self.size

    def ends_text(self) -> str:
        return ",".join(map(str, self.ends))

    def ends_hash(self) -> str:
        return self.sha.hexdigest() if self.sha else hashlib.sha256(self.ends_text().encode()).hexdigest()

    def record(self, depth: int) -> tuple:
        return self.least, depth, self.n, self.children, self.leaves, self.saved, self.ends_hash(), self.key


def _lcp(a: list, b: list) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(k for k in range(n) if a[k] != b[k])


class _Out:
    """Rows for the next record batch."""

    def __init__(self) -> None:
        self.rows: list[dict] = []

    def node(self, record: tuple, parent: int | None, part: int | None = None, side: int | None = None) -> None:
        least, depth, n, children, leaves, saved, ends, key = record
        self.rows.append({"conv_id": least, "depth": depth, "parent_conv_id": parent, "n_convs": n, "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": ends, "last_turn": key, "part": part, "side": side})

    def flush(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.rows), 4096):
            yield pa.RecordBatch.from_pylist(self.rows[at : at + 4096], schema)
        self.rows = []


def _arrow_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary()), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in _SWEPT.split(", "))])


def _sweep_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Closed nodes of one partition, then its two open stacks."""
    part, schema, out = TaskContext.get().partitionId(), _arrow_schema(), _Out()
    stack: list[_Node] = []
    left: list[_Node] = []  # the first row's path, as far as it has closed on the right
    first_path: tuple[list, list] | None = None
    path: list[bytes] = []
    sizes: list[int] = []

    def close() -> None:
        node, depth = stack.pop(), len(stack)
        if node.first:
            left.append(node)
            return
        node.close()
        for child in node.waiting:
            out.node(child, node.least)
        above = stack[-1]
        above.add(node.n, node.least, 1, node.leaves, node.saved)
        if above.first:  # open to the left in any case
            out.node(node.record(depth), None, part, 0)
        else:
            above.waiting.append(node.record(depth))

    for batch in batches:
        for conv, keys, lengths in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            opening = first_path is None
            if opening:
                first_path, stack = (keys, lengths), [_Node(None, 0, True)]
            shared = _lcp(path, keys)
            while len(stack) > shared + 1:
                close()
            for k in range(shared, len(keys)):
                stack.append(_Node(keys[k], lengths[k], opening))
            stack[-1].add(1, conv, 0, 0, 0)
            stack[-1].ends.append(conv)
            path, sizes = keys, lengths
        yield from out.flush(schema)
    if first_path is None:
        return
    common = [node for node in stack if node.first]
    right = stack[len(common) :]
    for side, lo, (keys, lengths), nodes in ((0, 0, first_path, common + left[::-1]), (1, len(common), (path, sizes), right)):
        if not nodes:
            continue
        for k, node in enumerate(nodes):
            for child in node.waiting:
                out.node(child, None, part, side)
        # only the ids of the path's own row can go on in a neighbour
        whole = [hashlib.sha256(node.ends_text().encode()).hexdigest() if node.ends else None for node in nodes[:-1]]
        sums = [x for node in nodes for x in (node.n, node.least or 0, node.children, node.leaves, node.saved)]
        out.rows.append({"part": part, "side": side, "lo": lo, "keys": keys, "sizes": lengths, "sums": sums, "shas": [*whole, None], "ids": nodes[-1].ends_text()})
    yield from out.flush(schema)


class _Known:
    """A finished hash of ids, in the place of one that runs on."""

    def __init__(self, text: str):
        self.hexdigest = lambda: text


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stacks of all partitions in order; closes every node, and says what each partition's open nodes were called."""
    schema, out = _arrow_schema(), _Out()
    stack: list[_Node] = []
    path: list[bytes] = []

    def close() -> None:
        node, depth = stack.pop(), len(stack)
        node.close()
        for child in node.waiting:
            out.node(child, node.least)
        for part, side in node.refs:
            out.rows.append({"conv_id": node.least, "depth": depth, "part": part, "side": side})
        if stack:
            stack[-1].add(node.n, node.least, 1, node.leaves, node.saved)
            stack[-1].waiting.append(node.record(depth))
        else:
            out.node(node.record(depth), None)

    for batch in batches:
        for row in batch.to_pylist():
            keys, lengths, sums = row["keys"], row["sizes"], row["sums"]
            if not stack:
                stack = [_Node(None, 0, False)]
            shared = _lcp(path, keys)
            while len(stack) > shared + 1:
                close()
            for k in range(shared, len(keys)):
                stack.append(_Node(keys[k], lengths[k], False))
            for k, sha in enumerate(row["shas"]):
                node = stack[row["lo"] + k]
                node.add(*sums[5 * k : 5 * k + 5])
                node.refs.append((row["part"], row["side"]))
                if sha:
                    node.sha = _Known(sha)
            if row["ids"]:
                last = stack[-1]
                if last.sha is None:
                    last.sha = hashlib.sha256(row["ids"].encode())
                else:
                    last.sha.update(b"," + row["ids"].encode())
            path = keys
        yield from out.flush(schema)
    while stack:
        close()
    yield from out.flush(schema)


def trie_nodes(paths: DataFrame) -> DataFrame:
    """One row for each distinct prefix of ``paths`` (conv_id, keys, sizes): ``NODE_COLUMNS``.

    conv_id: the smallest member; parent_conv_id: the parent's; n_convs: members; n_children; n_leaves: nodes
    without children in the subtree; saved_tokens: (members - 1) times the length of the last turn,
    summed over the subtree; ends_sha256: of the ids that end here; last_turn: digest of the last turn.
    """
    ordered = paths.select("conv_id", "keys", "sizes").repartitionByRange("keys", "conv_id").sortWithinPartitions("keys", "conv_id")
    swept = materialize(ordered.mapInArrow(_sweep_rows, _SWEPT), "swept")
    stacks = swept.where("keys is not null").repartition(1).sortWithinPartitions("part", "side")
    closed = materialize(stacks.mapInArrow(_stitch, _SWEPT), "stitched")
    names = closed.where("part is not null").select("part", "side", (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent"))
    inside = swept.where("keys is null")
    late = inside.where("part is not null").join(names, ["part", "side", "depth"]).withColumn("parent_conv_id", F.col("parent"))
    return inside.where("part is null").select(NODE_COLUMNS).unionByName(late.select(NODE_COLUMNS)).unionByName(closed.where("part is null").select(NODE_COLUMNS))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return trie_nodes(rebuilt_paths(conversations))


def with_last_turn(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` with the role and text of their last turn (null for the root)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = conversations.where("conv_id is not null").select(turn_key(role, text).alias("last_turn"), role.alias("last_role"), text.alias("last_text"))
    return nodes.join(said.groupBy("last_turn").agg(F.min(F.struct("last_role", "last_text")).alias("s")).select("last_turn", "s.*"), "last_turn", "left")


def trie_digest(nodes: DataFrame) -> DataFrame:
    """The columns of the query."""
    return nodes.select([F.col(c).cast("string" if c == "ends_sha256" else "long").alias(c) for c in NODE_COLUMNS[:-1]])


def crc32_sql(value: str) -> str:
    """crc32 of an ASCII text, for DuckDB, which has none: bit by bit, over codes of characters and eight marks of a shift each."""
    steps = f"list_concat([4294967295], flatten([[ord(c), -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split({value}, '')]))"
    return f"xor(list_reduce({steps}, lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"


def trie_sql() -> str:
    """The same for DuckDB over ``conversations``."""
    return f"""
WITH turns AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(k ORDER BY turn NULLS FIRST, k) AS ks, list(length(text) ORDER BY turn NULLS FIRST, k) AS ls FROM turns GROUP BY c),
h AS (SELECT *, CAST({crc32_sql("c::VARCHAR")} % {HEADS} AS INTEGER) AS h FROM own),
r AS (
  SELECT h.c, list_concat(coalesce(b.ks[1:h.h], []), h.ks[h.h + 1:]) AS ks, list_concat(coalesce(b.ls[1:h.h], []), h.ls[h.h + 1:]) AS ls
  FROM h LEFT JOIN own b ON b.c = h.c - h.c % {FAMILY}),
p AS (SELECT c, d, list_aggregate(ks[1:d], 'string_agg', '') AS path, CASE WHEN d > 0 THEN list_aggregate(ks[1:d - 1], 'string_agg', '') END AS up,
             CASE WHEN d > 0 THEN ls[d] ELSE 0 END AS size, d = len(ks) AS last
      FROM (SELECT *, unnest(range(len(ks) + 1)) AS d FROM r)),
m AS (SELECT coalesce(path, '') AS path, CASE WHEN d > 0 THEN coalesce(any_value(up), '') END AS up, d, min(c) AS conv_id, count(*) AS n, any_value(size) AS size,
             sha256(coalesce(string_agg(CASE WHEN last THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends
      FROM p GROUP BY path, d),
q AS (SELECT m.*, (SELECT count(*) FROM m k WHERE k.up = m.path AND k.d = m.d + 1) AS kids FROM m),
s AS (SELECT a.path, a.d, CAST(sum(CASE WHEN x.kids = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum((x.n - 1) * x.size) AS BIGINT) AS saved
      FROM q a JOIN q x ON x.d >= a.d AND x.path[1:64 * a.d] = a.path GROUP BY a.path, a.d)
SELECT q.conv_id, CAST(q.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(q.n AS BIGINT) AS n_convs, CAST(q.kids AS BIGINT) AS n_children,
       s.n_leaves, s.saved AS saved_tokens, q.ends AS ends_sha256
FROM q JOIN s ON s.path = q.path AND s.d = q.d LEFT JOIN m u ON u.path = q.up AND u.d = q.d - 1"""
