from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__ as entry
from churnwatch.llm import simhash
from tests.conftest import SF01
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_simhash import brute_components, brute_fingerprint


def test_stages(spark):
    names = spark.read.parquet(f"{SF01}/documents.parquet").columns
    docs, outs = spark.read.parquet(f"{SF01}/documents.parquet"), {}
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF01).cache()
        assert out.columns == names
        outs[name] = {r.doc_id: r for r in out.collect()}
        docs = out
    assert len(outs["language"]) >= 0.98 * len(before)
    assert outs["lines"].keys() == outs["language"].keys()
    assert all(r.n_chars == len(r.text) for k, r in outs["lines"].items() if r.text != before[k].text)
    rows = sorted((k, r.text) for k, r in outs["lines"].items())
    low = brute_components([(k, brute_fingerprint(t)) for k, t in rows])
    assert set(outs["near_duplicates"]) == {k for (k, _), c in zip(rows, low) if k == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    kept = [(k, r.text) for k, r in outs["near_duplicates"].items()]
    dirty = {d for d, _ in leaks(kept, items)}
    assert dirty and set(outs["decontamination"]) == {k for k, _ in kept} - dirty
    mixed = corpus_pipeline.mix(spark, docs, SF01).collect()
    taken, target = defaultdict(int), {}
    for r in mixed:
        assert r.text == outs["decontamination"][r.doc_id].text and 1 <= r.copies <= 2
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.25 * target[s] for s in target)


def test_registered(spark):
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, copies int"
    rows = [(1, None, None, None, None, 1), (None, "the cat sat on the mat and then the dog came", "en", None, 5, 1), (2, "", "en", "a", 0, 1)]
    rows += [(3, "the cat sat on the mat and then the dog came in and sat too", "en", "a", 9, 1)] * 3 + [(4, "x " * 60_000, "en", "b", 9, 1)]
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_path}/{len(table)}-{k}"
            stage(spark, docs, SF01).write.parquet(path)
            docs = spark.read.parquet(path)
            if name != "mix":
                assert set(docs.columns) == set(schema.replace(" long", "").replace(" string", "").replace(" int", "").split(", "))
        assert (docs.count() > 0) == bool(table)


def test_keep_one_keeps_whole_rows(spark):
    docs = spark.createDataFrame([(2, "a b c d e", "y"), (2, "a b c d e", "x"), (3, "A b c d e", "z"), (None, "a b c d e", "w"), (9, None, "q")], "doc_id long, text string, fp string")
    assert sorted(map(str, simhash.keep_one(docs).collect())) == sorted(map(str, spark.createDataFrame([(2, "a b c d e", "x"), (9, None, "q")], docs.schema).collect()))


def test_clashing_names(spark, tmp_path):
    """Columns called like the stages' own inner ones pass through unchanged."""
    extra = ["_a", "_b", "_lines", "_kept", "_lang", "_score", "_rejected", "_entropy", "_text", "dotted.name"]
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where("doc_id % 50 = 0")
    plain = spark.createDataFrame(docs.collect(), docs.schema)
    for k, c in enumerate(extra):
        plain = plain.withColumn(c, F.concat_ws("-", F.lit(k), "doc_id"))
    kept = plain
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, kept, SF01).write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        assert kept.columns == plain.columns
    rows = kept.collect()
    assert rows and all(r[c] == f"{k}-{r.doc_id}" for r in rows for k, c in enumerate(extra))
    mixed = corpus_pipeline.mix(spark, kept, SF01).collect()
    assert mixed and all(r[c] == f"{k}-{r.doc_id}" for r in mixed for k, c in enumerate(extra))
