"""Byte ranges of sequences, table functions of SQL, transcript walks, and tables of buckets under a stream."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lociflow.functions import sql
from lociflow.operators import resolver
from lociflow.sources import indexed_fasta, sinks
from lociflow.streaming import ingest


# -- sequences ---------------------------------------------------------------------------
def genome(tmp_path, ending="\n"):
    rng = random.Random(1)
    contigs = {name: "".join(rng.choice("ACGTn") for _ in range(n)) for name, n in (("chr1", 1003), ("2", 60), ("chrX", 61), ("3", 5000), ("empty", 0))}
    text = ""
    for name, s in contigs.items():
        text += f">{name} described{ending}" + "".join(s[k : k + 60] + ending for k in range(0, len(s), 60))
    (tmp_path / "g.fa").write_bytes(text.encode())
    return {k.removeprefix("chr"): v.upper() for k, v in contigs.items()}, str(tmp_path / "g.fa")


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_index_and_ranges(spark, tmp_path, ending):
    contigs, path = genome(tmp_path, ending)
    for block in (7, 1 << 20):
        rows = indexed_fasta.index_file(path, block)
        assert [(r[1], r[2]) for r in rows] == [("chr1", 1003), ("2", 60), ("chrX", 61), ("3", 5000), ("empty", 0)]
    index = indexed_fasta.build_index(spark, path)
    table = indexed_fasta.sequence_source(spark, index, 100)
    got = {}
    for r in table.collect():
        got.setdefault(r.chrom, {})[r.chunk_no] = r.seq
    assert {c: "".join(s for _, s in sorted(v.items())) for c, v in got.items()} == {c: s for c, s in contigs.items() if s}
    some = table.where("chrom = '3' and chunk_no >= 10 and chunk_no < 13").collect()
    assert sorted((r.chunk_no, r.seq) for r in some) == [(k, contigs["3"][100 * k : 100 * k + 100]) for k in (10, 11, 12)]
    asked = spark.createDataFrame([(1, "1", 95, 210), (2, "2", 60, 60), (3, "3", 4999, 5001), (4, "nowhere", 1, 5), (5, "X", 0, 3), (6, None, 1, 2), (7, "3", 250, 250)], "i long, c string, s long, e long")
    found = {r.i: r.b for r in indexed_fasta.fetch_indexed(asked, index, "c", "s", "e", "b", 100).collect()}
    assert found == {1: contigs["1"][94:210], 2: contigs["2"][59], 3: None, 4: None, 5: None, 6: None, 7: contigs["3"][249]}


def test_only_asked_ranges_are_planned_and_read(tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual

    contigs, path = genome(tmp_path)
    index = [list(r) for r in indexed_fasta.index_file(path)]
    size = (tmp_path / "g.fa").stat().st_size
    planned = lambda reader: sum(b - a for a, b in (p.byte_range(100) for p in reader.partitions()))
    reader = lambda **more: indexed_fasta._Reader({"index": json.dumps(index), "chunk": "100", **more})
    assert size * 0.98 < planned(reader()) < size
    few = reader(wanted=json.dumps({"3": [4, 5, 40], "2": [0]}))
    assert [(p.chrom, p.first, p.last) for p in few.partitions()] == [("2", 0, 0), ("3", 4, 5), ("3", 40, 40)] and planned(few) < 400
    pushed = reader()
    rest = list(pushed.pushFilters([EqualTo(("chrom",), "3"), GreaterThan(("chunk_no",), 46), LessThanOrEqual(("chunk_no",), 48), EqualTo(("seq",), "x")]))
    assert len(rest) == 1 and [(p.first, p.last) for p in pushed.partitions()] == [(47, 48)]
    only = reader()
    assert not list(only.pushFilters([In(("chunk_no",), (3, 0, 99))])) and {(p.chrom, p.first) for p in only.partitions() if p.chrom == "3"} == {("3", 0), ("3", 3)}
    # bytes outside the ranges are never looked at
    data = bytearray((tmp_path / "g.fa").read_bytes())
    for p in few.partitions():
        a, b = p.byte_range(100)
        kept = data[a:b]
        (tmp_path / "g.fa").write_bytes(b"?" * a + kept + b"?" * (len(data) - b))
        assert "".join(next(few.read(p)).column(2).to_pylist()) == contigs[p.chrom][p.first * 100 : (p.last + 1) * 100]


def test_written_sequences_index_again(spark, tmp_path):
    df = spark.createDataFrame([("a", "ACGT" * 40), ("b", "A"), ("c", "C" * 60), ("d", "")], "chrom string, seq string")
    sinks.write_fasta(df.repartition(2), str(tmp_path / "out"))
    got = {r.chrom: (r.length, r.line_bases) for r in indexed_fasta.build_index(spark, str(tmp_path / "out")).collect()}
    assert got == {"a": (160, 60), "b": (1, 1), "c": (60, 60)}
    (tmp_path / "bad.fa").write_text(">x\nACG\nACGTA\n")
    with pytest.raises(ValueError, match="differ in length"):
        indexed_fasta.index_file(str(tmp_path / "bad.fa"))


# -- SQL -----------------------------------------------------------------------------------
def test_table_functions(spark):
    names = sql.register(spark)
    assert {"text_spans", "negative_evidence", "gene_of_variant"} <= set(names)
    spark.createDataFrame([(1, "We saw c.5A>G in Marfan syndrome."), (2, None), (3, "nothing")], "id long, t string").createOrReplaceTempView("some_texts")
    rows = spark.sql("SELECT x.id, s.* FROM some_texts x, LATERAL text_spans(x.t) s ORDER BY s.start").collect()
    assert [(r.id, r.kind, r.norm) for r in rows] == [(1, "variant", "c.5A>G"), (1, "clinical", "Marfan syndrome")]
    linked = spark.sql("SELECT x.id, l.variant FROM some_texts x, LATERAL sentence_links(x.t) l ORDER BY x.id").collect()
    assert [(r.id, r.variant) for r in linked] == [(1, "c.5A>G")]
    assert spark.sql("SELECT * FROM genomic_names('hg38 chr7:5,000 A>G')").first().pos == 5000
    assert spark.sql("SELECT name, partner FROM paired_names('c.5A>G (p.Arg2Leu)')").count() == 2
    assert spark.sql("SELECT variants_scanned('rs12345 and c.5A>G') AS v").first().v == ["rs12345", "c.5A>G"]
    for wrong in ("text_spans(1)", "negative_evidence('x')"):
        with pytest.raises(Exception, match="must be a string|expected 2 arguments"):
            spark.sql(f"SELECT * FROM {wrong}").collect()


# -- transcripts -----------------------------------------------------------------------------
def test_walk_by_prefix_sums_is_the_walk_over_all_positions():
    rng = random.Random(8)
    for _ in range(200):
        exons, at = [], 10
        for _ in range(rng.randrange(1, 6)):
            a = at + rng.randrange(1, 30)
            at = a + rng.randrange(0, 20)
            exons.append((a, at))
        rng.shuffle(exons)
        every = [p for a, b in sorted(exons) for p in range(a, b + 1)]
        lo, hi = sorted(rng.choice(every) for _ in range(2))
        for strand in "+-":
            positions = every if strand == "+" else every[::-1]
            walk = resolver._walk(exons, [(lo, hi)], strand)
            assert [walk.at(k) for k in range(-1, len(positions) + 1)] == [None, *positions, None]
            assert {p: walk.place(p) for p in range(0, at + 5)} == {p: positions.index(p) if p in positions else None for p in range(0, at + 5)}
            first = positions.index(lo if strand == "+" else hi)
            assert (walk.first, walk.last) == (first, positions.index(hi if strand == "+" else lo))
    assert resolver._walk([(1, 5)], [(9, 12)], "+") is None and resolver._walk([], [(1, 2)], "+") is None


# -- tables under a stream -------------------------------------------------------------------
def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({"pmid": str(k), "title": v}) for k, v in rows) + "\n")


def table(spark, target):
    return {r.pmid: r.title for r in ingest.read_table(spark, target).collect()}


def test_batches_rewrite_touched_buckets_only(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = lambda pairs: spark.createDataFrame(pairs, "pmid string, title string")
    first = ingest.merge_batch(rows([(str(k), "old") for k in range(640)]), 0, target, buckets=64)
    assert first["written_rows"] == first["total_rows"] == first["new_rows"] == 640
    second = ingest.merge_batch(rows([("5", "new"), ("5", "newer"), ("9999", "added")]), 1, target, buckets=8)  # the table keeps its 64
    assert second["n_buckets"] == 64 and second["new_rows"] == 2 and second["total_rows"] == 641
    assert second["written_rows"] / second["total_rows"] < 0.08  # two buckets of 64
    got = table(spark, target)
    assert got["5"] == "newer" and got["9999"] == "added" and len(got) == 641 and got["6"] == "old"
    assert ingest.merge_batch(rows([("1", "again")]), 1, target) is None and table(spark, target) == got  # a replay does nothing
    assert ingest.merge_batch(rows([]), 2, target)["total_rows"] == 641


def test_versions_go_when_nobody_holds_them(spark, tmp_path):
    target = str(tmp_path / "t")
    batch = lambda v: spark.createDataFrame([(str(k), f"v{v}") for k in range(20)], "pmid string, title string")
    ingest.merge_batch(batch(0), 0, target, buckets=4, keep=1)
    with ingest.held(spark, target) as old:
        for v in (1, 2, 3):
            ingest.merge_batch(batch(v), v, target, buckets=4, keep=1)
        assert ingest.versions(spark, target) == [0, 3]
        assert {r.title for r in old.collect()} == {"v0"} and set(table(spark, target).values()) == {"v3"}
    (tmp_path / "t" / "data" / "0000000004-dead").mkdir()  # what a batch left that died before its commit
    assert ingest.vacuum(spark, target, 1) == 2 and ingest.versions(spark, target) == [3]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1


def test_stream_restarts_in_the_middle(spark, tmp_path, monkeypatch):
    source, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    go = lambda: ingest.upsert(ingest.article_stream(spark, str(source), 1), target, checkpoint, buckets=8).awaitTermination()
    put(source, "a.json", [(1, "old"), (2, "x")])
    go()
    put(source, "b.json", [(1, "new"), (3, "y")])
    commit, calls = ingest.write_text, []

    def dies(spark_, path, text, replace=True):
        calls.append(path)
        if len(calls) == 1:
            raise RuntimeError("lost before the commit")
        return commit(spark_, path, text, replace)

    monkeypatch.setattr(ingest, "write_text", dies)
    with pytest.raises(Exception, match="lost before the commit"):
        go()
    assert table(spark, target) == {"1": "old", "2": "x"}  # nothing of the lost batch is read
    go()
    assert table(spark, target) == {"1": "new", "2": "x", "3": "y"} and ingest.versions(spark, target) == [0, 1]
    put(source, "c.json", [(4, "z")])
    put(source, "d.json", [(4, "zz")])
    go()
    assert table(spark, target) == {"1": "new", "2": "x", "3": "y", "4": "zz"} or table(spark, target)["4"] == "z"
    assert ingest.versions(spark, target) == [2, 3]


def test_late_rows_are_left_out_of_windows(spark, tmp_path):
    folder = tmp_path / "clicks"
    folder.mkdir()
    write = lambda name, rows: (folder / name).write_text("\n".join(json.dumps({"ts": ts, "kind": k}) for ts, k in rows) + "\n")

    def go():
        stream = spark.readStream.schema("ts timestamp, kind string").option("maxFilesPerTrigger", 1).json(str(folder))
        counted = ingest.windowed_counts(stream, "ts", "kind").select(F.col("window.start").cast("string").alias("start"), "kind", "count")
        counted.writeStream.format("parquet").option("path", str(tmp_path / "counts")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()

    write("a.json", [("2024-01-01 10:01:00", "a"), ("2024-01-01 10:05:00", "a"), ("2024-01-01 10:31:00", "b")])
    go()
    write("b.json", [("2024-01-01 11:40:00", "b"), ("2024-01-01 10:35:00", "b")])  # the second is in time: the mark was 10:01
    go()
    write("c.json", [("2024-01-01 10:06:00", "a"), ("2024-01-01 11:35:00", "b")])  # the first is late: the mark is 11:10
    go()
    write("d.json", [("2024-01-01 13:00:00", "b")])
    go()
    got = sorted((r.start, r.kind, r["count"]) for r in spark.read.parquet(str(tmp_path / "counts")).collect())
    assert got == [("2024-01-01 10:00:00", "a", 2), ("2024-01-01 10:30:00", "b", 2), ("2024-01-01 11:30:00", "b", 1), ("2024-01-01 11:40:00", "b", 1)]
