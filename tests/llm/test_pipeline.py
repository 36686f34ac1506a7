"""The pipeline's stages against plain versions, and run() as a whole."""

from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tidemark.llm import language, packing

from .samples import awkward, empty, prose, values
from .test_chunks import brute
from .test_links import shingle_set, smallest_reachable

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, testdata):
    return spark.read.parquet(f"{testdata}/documents.parquet")


def awkward_documents(spark):
    docs = awkward(spark, ["lang_pred", "spans", "copy", "lane"])
    return docs.select(
        "*", F.lit("en").alias("lang"), F.when(F.col("doc_id") > 5, "a").alias("source"),
        F.length("text").cast("long").alias("n_chars"),
    )


def test_stages_bear_awkward_tables(spark, testdata):
    for name, stage in pipeline.STAGES:
        got = stage(spark, awkward_documents(spark), testdata)
        assert name == "packing" or got.columns == pipeline.DOCUMENT
        rows = got.collect()
        assert rows or name == "mixing"
        assert stage(spark, empty(spark, DOCUMENTS), testdata).collect() == []


def test_language_stage(spark, testdata):
    docs = documents(spark, testdata)
    kept = pipeline.in_known_language(spark, docs, testdata)
    profiles = language.Profiles(language.learn_profiles(docs).collect(), language.PROFILE_SIZE)
    want = []
    for row in docs.collect():
        lang, score = profiles.nearest(row.text)
        if lang != "und" and score >= pipeline.LEAST_SCORE:
            want.append(tuple(row[c] for c in pipeline.DOCUMENT))
    assert values(kept, *pipeline.DOCUMENT) == sorted(want, key=repr)
    strange = docs.limit(3).withColumn("text", F.lit("漢字 かな 한글 " * 20)).withColumn("lang", F.lit(None).cast("string"))
    assert pipeline.in_known_language(spark, docs.unionByName(strange), testdata).count() == len(want)


def test_near_copies_stage(spark, testdata):
    docs = documents(spark, testdata).limit(150)
    kept = values(pipeline.without_near_copies(spark, docs, testdata), *pipeline.DOCUMENT)
    rows = docs.collect()
    sets = {r.doc_id: shingle_set(r.text) for r in rows}
    ids = sorted(sets)
    pairs = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    reach = smallest_reachable(ids, pairs)
    want = [tuple(r[c] for c in pipeline.DOCUMENT) for r in rows if reach[r.doc_id] == r.doc_id]
    assert kept == sorted(want, key=repr)


def exchanged_bytes(plan):
    """What the exchanges of a finished plan wrote, before compression."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return exchanged_bytes(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return exchanged_bytes(plan.plan())
    own = plan.metrics().apply("dataSize").value() if name == "ShuffleExchangeExec" else 0
    return own + sum(exchanged_bytes(plan.children().apply(k)) for k in range(plan.children().size()))


def test_near_copies_stage_leaves_most_texts_in_place(spark):
    texts = [prose(k, 2000) for k in range(60)]
    rows = [(k, t, "en", "a", len(t)) for k, t in enumerate([*texts, texts[7]])]
    rows.append(rows[20])
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(4).localCheckpoint()
    kept = pipeline.without_near_copies(spark, docs, "")
    assert values(kept, *pipeline.DOCUMENT) == sorted(rows[:60], key=repr)
    moved = exchanged_bytes(kept._jdf.queryExecution().executedPlan())
    assert 0 < moved < sum(map(len, texts)) / 5


def test_near_copies_stage_bears_shared_bits_and_repeated_ids(spark, monkeypatch):
    docs = awkward_documents(spark).select(*pipeline.DOCUMENT)
    extra = [(k, prose(k % 9 + 20, 40), "en", "a", 1) for k in [*range(20, 40), 25, 25, 31]]
    extra += [(21, prose(50, 40), "en", "a", 1), (None, prose(20, 40), "en", "a", 1)]
    docs = docs.unionByName(spark.createDataFrame(extra, DOCUMENTS)).localCheckpoint()
    found, _ = pipeline.jaccard.similar(docs.select("doc_id", "text"))
    stay = {r.doc_id for r in found.collect() if r.doc_id == r.component_id}
    want = sorted({(r.doc_id, r.text) for r in docs.collect() if r.doc_id in stay}, key=repr)
    for bits in (pipeline.MARK_BITS, 8, 1):
        monkeypatch.setattr(pipeline, "MARK_BITS", bits)
        assert values(pipeline.without_near_copies(spark, docs, ""), "doc_id", "text") == want


def test_marks_find_every_id(spark, monkeypatch):
    docs = spark.range(-3000, 3000).select(F.col("id").alias("doc_id"))
    docs = docs.unionByName(spark.createDataFrame([(None,)], "doc_id long"))
    for bits, most in ((pipeline.MARK_BITS, 1005), (1 << 17, 1200)):
        monkeypatch.setattr(pipeline, "MARK_BITS", bits)
        ids = docs.where("doc_id % 6 = 0 OR doc_id IS NULL")
        marked = {r.doc_id for r in pipeline.with_marks(docs, ids).where("_marked").collect()}
        assert {r.doc_id for r in ids.collect()} <= marked and len(marked) <= most
    assert pipeline.with_marks(docs, docs.limit(0)).where("_marked").count() == 0


def test_passages_stage(spark, testdata):
    docs = documents(spark, testdata).limit(120)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, pipeline.chunks.LEAST_BYTES)
    got = pipeline.without_repeated_passages(spark, docs, testdata).collect()
    expected = {d: t for (d, _), t in want.items() if t} | {d: t for d, t in rows if not t}
    assert {r.doc_id: r.text for r in got} == expected
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None)


def test_mixing_and_packing_stages(spark, testdata):
    docs = documents(spark, testdata)
    mixed = pipeline.mixed(spark, docs, testdata)
    before = {tuple(r) for r in docs.select(*pipeline.DOCUMENT).collect()}
    after = [tuple(r) for r in mixed.collect()]
    assert set(after) <= before and abs(len(after) - len(before)) < 6 * len(before) ** 0.5
    packed = pipeline.packed(spark, mixed, testdata).collect()
    held = defaultdict(int)
    for row in packed:
        held[row.sequence_id] += row.length
    assert max(held.values()) <= pipeline.CAPACITY
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r[0] for r in after)
    assert len(held) <= 1.05 * -(-sum(held.values()) // pipeline.CAPACITY) + 1


def test_each_text_is_judged_and_cut_once(spark, testdata):
    docs = documents(spark, testdata)
    for stage in (pipeline.in_known_language, pipeline.without_repeated_passages):
        plan = stage(spark, docs, testdata)._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("ArrowEvalPython") == 1, stage.__name__


def test_plan_of_sequences_needs_no_python_workers(spark):
    rows, _ = packing.plan({3: 5, 7: 2}, 8)
    for some in (rows, []):
        table = packing.plan_table(spark, some)
        assert "PythonRDD" not in table._jdf.rdd().toDebugString()
        assert [tuple(r) for r in table.collect()] == [tuple(r) for r in some]
        assert table.dtypes == spark.createDataFrame([], packing.PLAN).dtypes


def test_run(spark, testdata):
    rows = pipeline.run(spark, testdata).collect()
    assert rows and {r.doc_id for r in rows} <= {
        r.doc_id for r in documents(spark, testdata).select("doc_id").collect()
    }
    assert len(pipeline.STAGES) == 5
