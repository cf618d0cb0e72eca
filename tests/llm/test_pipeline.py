"""The pipeline on a small corpus, stage by stage, and the entry's guard."""

import importlib
import sys

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("k1", F.lit("mine"))
    out = {"start": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(root / name))
        out[name] = docs = spark.read.parquet(str(root / name))
    return out


def test_stages_keep_the_columns_and_drop_only_what_they_must(spark, stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    before = stages["start"]
    for name in names[:-1]:
        assert stages[name].columns == stages["start"].columns
        assert 0.8 * before.count() <= stages[name].count() <= before.count()
        assert stages[name].join(before, "doc_id", "left_anti").count() == 0
        before = stages[name]
    assert stages["personal_data"].count() == stages["decontamination"].count()
    assert not any("@" in r.text and ".example.com" in r.text for r in stages["personal_data"].collect())
    assert stages["personal_data"].filter("n_chars <> char_length(text)").count() == 0
    ids = stages["packing"].select("doc_id").distinct()
    assert ids.count() == before.select("doc_id").distinct().count()


def test_run_gives_what_the_stages_give(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    found = corpus_pipeline.run(spark, SF_DIR).select(columns).collect()
    assert sorted(found) == sorted(stages["packing"].select(columns).collect())


def test_stages_on_odd_rows_and_on_an_empty_table(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing names: no row is lost but by a decision."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kind = docs.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    own = "key string, `row` int, score double, _terms int, `a.b` string"
    mine = ("k", 1, 2.0, 3, "dot")
    long = " ".join(f"w{i}" for i in range(120_000))
    texts = {1: None, 2: "", 3: " \t\n", 4: " " * 1_500_000, 5: "x" * 1_000_000, 6: long, 7: "one word", 8: "one word", None: "no id"}
    rows = [(d, t, None, None, None, *mine) for d, t in texts.items()]
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    odd = spark.createDataFrame([*rows, rows[-1], rows[6]], f"{kind}, {own}")
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, odd.limit(0), SF_DIR)
        found = stage(spark, odd, SF_DIR)
        assert empty.count() == 0
        if name == "packing":
            assert sum(r.length for r in found.filter("doc_id = 4").collect()) == 1_500_001
            assert found.filter("piece = 0").count() == odd.count()
            continue
        assert found.columns == empty.columns == odd.columns
        kept = found.collect()
        assert all(tuple(r)[5:] == mine for r in kept)
        ids = sorted(r.doc_id for r in kept if r.doc_id is not None)
        if name == "near_duplicates":  # one of the copies stays, and one of equal rows
            assert ids == [1, 2, 3, 4, 5, 6, 7] and len(kept) == 8
        else:
            assert ids == [1, 2, 3, 4, 5, 6, 7, 7, 8] and len(kept) == odd.count()
            assert {r.doc_id: r.text for r in kept if r.doc_id is not None} == {d: t for d, t in texts.items() if d is not None}


def test_the_entry_registers_each_operator(monkeypatch):
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        assert not any(name.startswith("op") or name == "pipeline" for name in importlib.reload(entry).queries())
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
