"""Counts of gates, fingerprints of stages, the cache of payloads and the index on disk."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lociflow.operators import index_table, resolver
from lociflow.plans import gates, stages
from lociflow.plans.gates import Gate
from lociflow.sources import catalogue_cache


def some_gates():
    return [Gate("even", F.col("id") % 2 == 0), Gate("small", F.col("id") < 50, "audit_only"), Gate("never", F.col("id") < 0, "disabled")]


@pytest.mark.parametrize(
    ("profile", "declared", "kept", "rows"),
    [
        ("strict", None, 50, [("even", "required", 50, 50), ("small", "audit_only", 50, 50), ("all", "strict", 50, 50)]),
        ("audit", None, 100, [("even", "audit_only", 50, 50), ("small", "audit_only", 50, 50), ("all", "audit", 100, 0)]),
        ("custom", {"small": "enabled", "even": "disabled"}, 50, [("small", "enabled", 50, 50), ("all", "custom", 50, 50)]),
        ("custom", {"small": "enabled", "never": "required"}, 0, [("even", "required", 50, 50), ("small", "enabled", 50, 50), ("never", "required", 0, 100), ("all", "custom", 0, 100)]),
    ],
)
def test_profiles_and_counts_in_one_pass(spark, profile, declared, kept, rows):
    counts = Observation()
    out = gates.apply_gates(spark.range(100), some_gates(), profile, declared, counts)
    assert len(out.collect()) == kept and gates.gate_counts(counts, some_gates(), profile, declared) == rows
    nothing = Observation()
    gates.apply_gates(spark.range(0), some_gates(), profile, declared, nothing).collect()
    assert all(r[2:] == (0, 0) for r in gates.gate_counts(nothing, some_gates(), profile, declared))


def test_unknown_profiles_and_gates_are_refused():
    for wrong in (("other", None), ("custom", {"nobody": "enabled"})):
        with pytest.raises(ValueError):
            gates.with_profile([], *wrong)


def runner(spark, folder, calls, limit=50, **more):
    def made(name, make):
        def run(tables):
            calls.append(name)
            return make(tables)

        return run

    steps = {
        "one": stages.Stage(made("one", lambda t: t["in"]), gates=(Gate("small", F.col("id") < limit), Gate("odd", F.col("id") % 2 == 1, "audit_only"))),
        "two": stages.Stage(made("two", lambda t: t["one"].withColumn("x", F.col("id") + 1)), reads=("one",)),
        "aside": stages.Stage(made("aside", lambda t: t["in"].where("id > 90")), reads=("in",)),
        "three": made("three", lambda t: t["two"].join(t["aside"], "id", "left_anti")),
    }
    return stages.Runner(steps, {"in": spark.range(100)}, str(folder), **more)


def test_a_changed_gate_runs_what_lies_behind_it(spark, tmp_path):
    calls = []
    first = runner(spark, tmp_path, calls)
    assert first.run()["three"].count() == 50 and calls == ["one", "two", "aside", "three"]
    assert first.reports == {"one": [("small", "required", 50, 50), ("odd", "audit_only", 50, 50), ("all", "strict", 50, 50)]}
    again = runner(spark, tmp_path, calls)
    assert again.run()["three"].count() == 50 and len(calls) == 4 and again.reports == first.reports
    del calls[:]
    assert runner(spark, tmp_path, calls, limit=10).run()["three"].count() == 10 and calls == ["one", "two", "three"]  # not aside
    del calls[:]
    assert runner(spark, tmp_path, calls, 10, profile="custom", declared={"one": {"odd": "enabled"}}).run()["three"].count() == 5 and "one" in calls
    del calls[:]
    runner(spark, tmp_path, calls, 10, profile="custom", declared={"one": {"odd": "enabled"}}, inputs={"in": "v2"}).run()
    assert calls == ["one", "two", "aside", "three"]  # other inputs
    del calls[:]
    runner(spark, tmp_path, calls, 10, profile="custom", declared={"one": {"odd": "enabled"}}, inputs={"in": "v2"}, force=True).run("two", "two")
    assert calls == ["two"]


def test_resume_needs_what_it_builds_on(spark, tmp_path):
    calls = []
    with pytest.raises(stages.ChangedUpstream, match="one is not finished"):
        runner(spark, tmp_path, calls, profile="resume").run("two")
    runner(spark, tmp_path, calls, profile="custom").run(last="two")
    del calls[:]
    assert runner(spark, tmp_path, calls, profile="resume").run("aside")["three"].count() == 50 and calls == ["aside", "three"]
    with pytest.raises(stages.ChangedUpstream, match="one is of other settings"):
        runner(spark, tmp_path, calls, limit=20, profile="resume").run("aside")


def test_refresh_asks_for_what_is_missing_or_old(spark, tmp_path):
    path, asked = str(tmp_path / "cache"), []
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "rs string")
    answers = {"rs1": ("rs1", "one", None), "rs2": ("rs2", None, "timeout"), "rs4": ("rs4", "four", None)}

    def fetch(df):
        got = sorted(r.rs for r in df.collect())
        asked.append(got)
        return spark.createDataFrame([answers[n] for n in got if n in answers], "rs string, payload string, error string")

    go = lambda now, *x: catalogue_cache.refresh(names(*x), path, fetch, now, buckets=4)
    assert go(0, "rs1", "RS1 ", "rs2", "rs3", None, " ") == catalogue_cache.Refresh(3, 0, 3, 1, 1, 1) and asked == [["rs1", "rs2", "rs3"]]
    assert go(10, "rs1", "rs2", "rs3") == catalogue_cache.Refresh(3, 3, 0, 0, 0, 0) and len(asked) == 1
    assert go(10, "rs1", "rs4").asked == 1 and asked[-1] == ["rs4"]
    day = catalogue_cache.DAY
    assert go(2 * day, "rs1", "rs2", "rs3").asked == 1 and asked[-1] == ["rs2"]  # a failure is tried again first
    answers["rs1"], answers["rs2"] = ("rs1", None, "down"), ("rs2", "two", None)
    assert go(200 * day, "rs1", "rs2", "rs3").asked == 3
    cache = {r.rs: (r.state, r.payload, r.checked_at) for r in catalogue_cache.read_cache(spark, path).collect()}
    assert cache == {"rs1": ("found", "one", 0), "rs2": ("found", "two", 200 * day), "rs3": ("absent", None, 200 * day), "rs4": ("found", "four", 10)}


def test_index_is_joined_where_it_lies(spark, tmp_path):
    table = spark.createDataFrame([("GRCh38", "1", k, "A", "G", f"G{k % 7}", f"NM_{k}", "1", f"c.{k}A>G", None, f"rs{10_000 + k}") for k in range(300)], "assembly string, chrom string, pos long, ref string, alt string, gene string, nm string, nm_version string, c string, p string, rs string")
    path = str(tmp_path / "index")
    known = index_table.write_index(resolver.reference_index(table), path, buckets=6)
    assert known["buckets"] == 6 and known["rows"] == resolver.reference_index(table).count()
    spark.sql(f"DROP TABLE {index_table._table_name(path)}")  # another session knows nothing of it
    index = index_table.read_index(spark, path)
    asked = spark.createDataFrame([(k, 1, f"rs{10_000 + k}") for k in range(0, 600, 5)], "id long, step int, key string")
    joined = asked.hint("merge").join(index, ["step", "key"])
    assert joined.count() == 60
    plan = joined._jdf.queryExecution().executedPlan().toString()
    inside = plan[plan.index("Scan parquet") - 400 :] if "Scan parquet" in plan else plan
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in inside
    with pytest.raises(FileNotFoundError):
        index_table.read_index(spark, str(tmp_path / "none"))
