"""The pipeline against a brute-force version of its stages on a small corpus."""

import random
import re

import corpus_pipeline as cp
from lociflow.llm import langid
from lociflow.llm.common import id_bucket_py


def test_pipeline(spark, tmp_path):
    rng = random.Random(4)
    vocabulary = {"en": "the of and house king people with them water stone river bread night".split(), "fr": "la le du maison roi gens avec eux eau pierre fleuve pain nuit".split()}
    rows = []
    for i in range(120):
        lang = "en" if i % 3 else "fr"
        text = " ".join(rng.choice(vocabulary[lang]) + rng.choice(["", "s", "t"]) for _ in range(50))
        rows.append((i, text, lang, f"src{i % 3}", len(text)))
    rows += [(200, rows[3][1] + " more", "en", "src0", 1), (201, rows[3][1], "en", "src1", 1), (202, None, "en", "src1", None), (203, "", None, None, 0)]
    item = "quick brown foxes jump over eleven lazy dogs by noon today"
    rows.append((204, " ".join(reversed(rows[7][1].split())) + " " + item, "en", "src2", 1))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("b", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept, at = {}, docs
    for name, stage in cp.STAGES:
        at = stage(spark, at, str(tmp_path))
        kept[name] = {r.doc_id: r for r in at.collect()}
        at = spark.createDataFrame(list(kept[name].values()), at.schema)
        if name != "shard":
            assert at.columns == docs.columns
    classify = langid._Classifier(langid.fit_dictionaries(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1")))
    assert set(kept["language_id"]) == {r[0] for r in rows if not classify(r[1])[2]}
    assert {202, 203}.isdisjoint(kept["language_id"]) and id_bucket_py(0, 3) in (0, 1, 2)
    assert {200, 201}.isdisjoint(kept["near_duplicates"]) and 3 in kept["near_duplicates"]
    assert 204 in kept["near_duplicates"] and set(kept["near_duplicates"]) - set(kept["decontaminate"]) == {204}
    words = sum(len(re.findall(r"\S+", r.text)) for r in kept["decontaminate"].values())
    assert 0.4 * words < sum(len(r.text.split()) for r in kept["mix"].values()) <= 0.6 * words
    assert set(kept["shard"]) == set(kept["mix"])
    assert {r.shard for r in kept["shard"].values()} <= set(range(24))
    assert {r.doc_id for r in cp.run(spark, str(tmp_path)).collect()} == set(kept["shard"])


def _unlike(rng):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60))


def test_null_and_repeated_ids(spark, tmp_path):
    rng = random.Random(5)
    item = "quick brown foxes jump over eleven lazy dogs by noon today"
    nameless = "seven small ships sail past the grey rocks before the storm"
    clean = [_unlike(rng) for _ in range(12)]
    rows = [(None, x, "en", "s", 1) for x in clean[:6]]
    rows += [(None, clean[0] + " more", "en", "s", 1), (7, clean[1] + " more", "en", "s", 1), (None, clean[2], "en", "s", 1)]
    rows += [(8, x, "en", "s", 1) for x in clean[6:9]] + [(8, clean[6], "en", "s", 1)]
    rows += [(None, " ", "en", "s", 1), (None, None, "en", "s", 1), (9, "", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted((r.doc_id or 0, r.text or "") for r in cp.near_duplicates(spark, docs, str(tmp_path)).collect())
    first = [x for x in kept if x in [(0, clean[0]), (0, clean[0] + " more")]]
    assert len(first) == 1
    assert [x for x in kept if x not in first] == sorted([(0, x) for x in clean[2:6]] + [(7, clean[1] + " more")] + [(8, x) for x in clean[6:9]] + [(0, " "), (0, ""), (9, "")])

    spark.createDataFrame([("b", item), (None, nameless)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, clean[0], "en", "s", 1), (None, clean[1] + " " + item, "en", "s", 1), (None, clean[2], "en", "s", 1), (8, clean[3] + " " + nameless, "en", "s", 1), (8, clean[4], "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {(r.doc_id, r.text) for r in cp.decontaminate(spark, docs, str(tmp_path)).collect()} == {(None, clean[0]), (None, clean[2]), (8, clean[4])}


def test_odd_tables_pass_every_stage(spark, tmp_path):
    """Clashing columns come through, a very long text is read whole, and an empty table stays empty."""
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    item = "quick brown foxes jump over eleven lazy dogs by noon today"
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, rejected int, __row string, epoch string, domain int, Place long, __possible string, stays string, __l int"
    extra = ("s", 3, "r", "e", 4, 5, "p", "t", 6)
    rows = [(k, " ".join(rng.choice(words) for _ in range(40)), rng.choice(["en", "fr"]), "src1", 1, *extra) for k in range(30)]
    long_ = " ".join(rng.choice(words) for _ in range(120_000))
    rows += [(90, long_, "en", "src1", 1, *extra), (91, long_ + " " + item, None, None, None, *extra), (92, None, "en", "src1", 0, *extra)]
    spark.createDataFrame([("b", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, schema)
    for name, stage in cp.STAGES[1:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.schema.names == docs.schema.names, name
        kept = {r.doc_id: r for r in out.collect()}
        assert all(tuple(kept[r[0]]) == r for r in rows if r[0] in kept), name
        if name == "near_duplicates":
            assert set(kept) == {r[0] for r in rows} - {91}
        if name == "decontaminate":
            assert set(kept) == {r[0] for r in rows} - {91}
    kept = cp.language_id(spark, docs, str(tmp_path))
    assert kept.schema.names == docs.schema.names and kept.where("doc_id = 92").count() == 0
    none = docs.where("doc_id < 0")
    for name, stage in cp.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0, name
