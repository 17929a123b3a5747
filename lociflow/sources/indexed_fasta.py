"""Random access to sequences: FASTA files read by byte ranges of their index, as a Spark data source (SRC-08).

The index has a row per contig, as ``.fai`` files have: name, bases, offset of the first base, bases and bytes per line; here with
the file too.  ``spark.read.format("indexed_fasta")`` has the rows (chrom, chunk_no, seq); a partition is a run of chunks
of one contig and reads only the bytes of these.  Filters on chrom and chunk_no, and a list of wanted chunks, leave
partitions out at planning.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from lociflow.functions.hgvs import norm_chrom
from lociflow.operators.tables import file_system
from lociflow.sources.readers import CHUNK, fetch_bases

NAME, SCHEMA = "indexed_fasta", "chrom string, chunk_no long, seq string"
_INDEX = "file string, chrom string, length long, offset long, line_bases long, line_bytes long"
#: Chunks of one partition at most, and bytes that a file is indexed by at once.
RUN, BLOCK = 64, 1 << 24


def _open(path: str) -> pa.NativeFile:
    files, at = pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)
    return files.open_input_file(at)


def index_file(path: str, block: int = BLOCK) -> list[tuple]:
    """Index rows of one file, which is read in blocks; lines of a contig but the last must be of one length."""
    out: list[list] = []
    with _open(path) as f:
        at, rest = 0, b""
        while True:
            data = f.read(block)
            lines = (rest + data).split(b"\n")
            rest = lines.pop() if data else b""
            for line in lines:
                size, bare = len(line) + 1, line.rstrip(b"\r")
                if bare.startswith(b">"):
                    out.append([path, (bare[1:].split() or [b""])[0].decode(), 0, at + size, 0, 0, False])
                elif bare and out:
                    own = out[-1]
                    if own[6] or (own[4] and len(bare) > own[4]):
                        raise ValueError(f"{path}: lines of {own[1]} differ in length")
                    own[4], own[5] = own[4] or len(bare), own[5] or size
                    own[2] += len(bare)
                    own[6] = len(bare) < own[4]  # only the last line may be shorter
                at += size
            if not data:
                return [tuple(x[:6]) for x in out]


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """Index of the FASTA files under ``path``, one task per file."""
    files, at = file_system(spark, path)
    found = [at] if files.getFileStatus(at).isFile() else [s.getPath() for s in files.listStatus(at) if not s.getPath().getName().startswith(("_", "."))]
    names = spark.createDataFrame([(p.toString(),) for p in found], "file string").repartition(max(1, len(found)), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for name in batch.column(0).to_pylist() for r in index_file(name)]
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 4]
            yield pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["file", "chrom", "length", "offset", "line_bases", "line_bytes"])

    return names.mapInArrow(run, _INDEX)


@dataclass
class _Run(InputPartition):
    file: str
    chrom: str
    length: int
    offset: int
    line_bases: int
    line_bytes: int
    first: int
    last: int

    def byte_range(self, chunk: int) -> tuple[int, int]:
        """Where the bases of chunks ``first`` to ``last`` lie in the file."""
        lo, hi = self.first * chunk, min((self.last + 1) * chunk, self.length)
        at = lambda k: self.offset + k // self.line_bases * self.line_bytes + k % self.line_bases
        return at(lo), at(hi - 1) + 1


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.index = [tuple(r) for r in json.loads(options["index"])]
        self.chunk = int(options.get("chunk", CHUNK))
        self.wanted = {c: set(k) for c, k in json.loads(options["wanted"]).items()} if "wanted" in options else None
        self.chroms: set[str] | None = None
        self.least, self.most, self.only = 0, None, None

    def pushFilters(self, filters: list) -> Iterator:
        """Takes comparisons of chrom and chunk_no with values; they hold for whole chunks, so nothing is left to check."""
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            values = set(f.value) if isinstance(f, In) else {f.value} if isinstance(f, EqualTo) else None
            if column == "chrom" and values is not None:
                self.chroms = values if self.chroms is None else self.chroms & values
            elif column == "chunk_no" and values is not None:
                self.only = values if self.only is None else self.only & values
            elif column == "chunk_no" and isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.least = max(self.least, f.value + isinstance(f, GreaterThan))
            elif column == "chunk_no" and isinstance(f, LessThan | LessThanOrEqual):
                most = f.value - isinstance(f, LessThan)
                self.most = most if self.most is None else min(self.most, most)
            else:
                yield f

    def partitions(self) -> list[_Run]:
        out = []
        for file, chrom, length, offset, line_bases, line_bytes in self.index:
            if not length or (self.chroms is not None and chrom not in self.chroms) or (self.wanted is not None and chrom not in self.wanted):
                continue
            last = (length - 1) // self.chunk
            able = range(self.least, min(last, last if self.most is None else self.most) + 1)
            for chosen in (self.only, None if self.wanted is None else self.wanted[chrom]):
                if chosen is not None:
                    able = sorted(k for k in chosen if self.least <= k <= last and (self.most is None or k <= self.most) and k in able)
            runs: list[list[int]] = []
            for k in able:
                if runs and runs[-1][1] + 1 == k and k - runs[-1][0] < RUN:
                    runs[-1][1] = k
                else:
                    runs.append([k, k])
            out += [_Run(file, chrom, length, offset, line_bases, line_bytes, a, b) for a, b in runs]
        return out

    def read(self, part: _Run | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # no partition is left
            return
        lo, hi = part.byte_range(self.chunk)
        with _open(part.file) as f:
            f.seek(lo)
            bases = f.read(hi - lo).translate(None, b"\r\n ").decode().upper()
        numbers = list(range(part.first, part.last + 1))
        pieces = [bases[k * self.chunk : (k + 1) * self.chunk] for k in range(len(numbers))]
        yield pa.record_batch([pa.array([part.chrom] * len(numbers)), pa.array(numbers, pa.int64()), pa.array(pieces)], ["chrom", "chunk_no", "seq"])


class IndexedFasta(DataSource):
    """Options: ``index`` (rows as JSON), ``chunk`` (bases of a row), ``wanted`` (chrom to chunk numbers, as JSON)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def sequence_source(spark: SparkSession, index: DataFrame, chunk: int = CHUNK, wanted: dict[str, list[int]] | None = None) -> DataFrame:
    """The sequence table (chrom, chunk_no, seq) behind an index; contigs by their common names."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(IndexedFasta)
    # one row per contig of the reference: its size does not follow the rows that ask
    rows = [tuple(r) for r in index.select("file", norm_chrom(F.col("chrom")), "length", "offset", "line_bases", "line_bytes").where("chrom is not null").collect()]
    reader = spark.read.format(NAME).option("index", json.dumps(rows)).option("chunk", str(chunk))
    return (reader if wanted is None else reader.option("wanted", json.dumps(wanted))).load()


def fetch_indexed(df: DataFrame, index: DataFrame, chrom: str, start: str, end: str, out: str, chunk: int = CHUNK) -> DataFrame:
    """Bases start..end (1-based, closed) of each row; only chunks that a row asks for are read.

    The distinct chunks come to the driver: at most as many as the reference has.
    """
    asked = df.where(F.col(chrom).isNotNull() & (F.col(start) >= 1) & (F.col(end) >= F.col(start)))
    chunks = asked.select(F.col(chrom).alias("c"), F.explode(F.sequence(F.floor((F.col(start) - 1) / chunk), F.floor((F.col(end) - 1) / chunk))).alias("k"))
    lengths = index.groupBy(norm_chrom(F.col("chrom")).alias("c")).agg(F.max("length").alias("n"))
    some = chunks.join(lengths, "c").where(F.col("k") * chunk < F.col("n")).groupBy("c").agg(F.sort_array(F.collect_set("k")).alias("k")).collect()
    sequence = sequence_source(df.sparkSession, index, chunk, {r.c: r.k for r in some})
    return fetch_bases(df, sequence, chrom, start, end, out, chunk)
