"""The conditional random field against enumeration, and its document scores."""

import itertools
import math

import numpy as np

from tidemark.llm import queries, toxicity

from .samples import awkward, empty, prose, values


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    start, move = rng.normal(size=2), rng.normal(size=(2, 2))
    emissions = rng.normal(size=(4, 5))
    real = np.arange(5) < np.array([5, 3, 1, 4])[:, None]
    toxic, all_zero, expected = toxicity.marginals(emissions, real, start, move, True)
    pairs = np.zeros((2, 2))
    for row, length in enumerate(real.sum(1)):
        weights = {}
        for path in itertools.product((0, 1), repeat=int(length)):
            score = start[path[0]] + sum(emissions[row, t] * y for t, y in enumerate(path))
            score += sum(move[a, b] for a, b in itertools.pairwise(path))
            weights[path] = math.exp(score)
        total = sum(weights.values())
        assert math.isclose(all_zero[row], math.log(weights[(0,) * length] / total), abs_tol=1e-9)
        for t in range(length):
            share = sum(w for p, w in weights.items() if p[t]) / total
            assert math.isclose(toxic[row, t], share, abs_tol=1e-9)
        for path, weight in weights.items():
            for a, b in itertools.pairwise(path):
                pairs[a, b] += weight / total
    assert np.allclose(pairs, expected)


def taught():
    texts, labels = [], []
    for k in range(120):
        words = prose(k, 60).split()
        if k % 3 == 0:
            words[k % 50] = ("grubbish", "snarkly")[k % 2]
        texts.append(" ".join(words))
        labels.append(int(k % 3 == 0))
    return toxicity.fit(texts, labels)


def test_spans_and_scores(spark):
    model = taught()
    text = "Über all, " + prose(900, 90) + " GRUBBISH snarkly! " + prose(901, 100)
    docs = awkward(spark, ["score", "spans", "label"], [(20, text), (21, prose(77, 80))])
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    (span,) = by_id[20].spans
    assert text[span.begin : span.end] == "GRUBBISH snarkly"
    assert by_id[20].predicted == 1 and by_id[20].score > 0.9
    assert by_id[21].predicted == 0 and by_id[21].spans == []
    lowest = min(r.score for r in rows)
    for doc in (3, 4, 5):
        assert by_id[doc].spans == [] and by_id[doc].score == lowest < 0.5
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_long_lower_case_keeps_offsets():
    (result,) = taught().documents(["İİİ x grubbish"])
    ((begin, end, _),) = result[1]
    assert "İİİ x grubbish"[begin:end] == "grubbish"


def test_without_both_classes(spark):
    for labels, share in (([], 0.0), ([0, 0], 0.0), ([1, 1], 1.0)):
        model = toxicity.fit(["one text", "other text here"][: len(labels)], labels)
        assert {r.score for r in toxicity.score(awkward(spark, []), model).collect()} == {share}
    assert toxicity.score(empty(spark), taught()).collect() == []


def test_sample_bears_awkward_labels(spark):
    docs = awkward(spark, ["toxic"])
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 0), (3, 1), (4, 1), (None, 1), (9, 0), (10, None), (99, 1)],
        "doc_id long, toxic int",
    )
    texts, toxic = toxicity.sample(docs, labels)
    assert sorted(zip(map(len, texts), toxic)) == sorted(
        [(len(prose(1, 40)), 1), (len(texts[toxic.index(0)]), 0)]
    )
    assert len(toxicity.sample(docs, labels, documents=1)[0]) <= 2


def test_copies_count_once():
    text = prose(5, 80).split()
    assert toxicity._without_copies([text, text, prose(6, 80).split(), [], ["a"]]) == [0, 2, 3, 4]


def test_query_shape(spark, testdata):
    rows = queries.op1_toxicity(spark, testdata)
    assert values(rows, "doc_id") == values(
        spark.read.parquet(f"{testdata}/documents.parquet"), "doc_id"
    )


def test_scores_keep_the_true_share(spark):
    # A word in 60 % of the toxic tenth and in 20 % of the others: not toxic more often than not.
    rows = []
    for k in range(2000):
        toxic = int(k % 10 == 0)
        words = prose(k, 30).split()
        if k // 10 % 10 < (6 if toxic else 2):
            words[k % 20] = "snarkly"
        rows.append((k, " ".join(words), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    counts = toxicity.counted(docs)
    assert counts == {0: 1800, 1: 200}
    flagged = {}
    for cap in (180, 5000):  # below and above both classes
        model = toxicity.fit(*toxicity.sample(docs, docs, documents=cap), of_class=counts)
        scored = [model.score(odds, n) for odds, _, n in model.documents([r[1] for r in rows])]
        assert abs(sum(scored) / len(scored) - 0.1) < 0.04
        flagged[cap] = sum(s >= 0.5 for s in scored)
    assert max(flagged.values()) <= 100, flagged


def test_long_clean_documents_are_not_flagged(spark):
    rows = []
    for k in range(400):
        toxic, size = int(k % 4 == 0), 4000 if k % 10 == 9 else 60
        words = prose(k, size).split()
        if toxic:
            words[k % 50] = ("grubbish", "snarkly")[k % 2]
        elif k % 8 == 1:
            words[k % 50] = "grubby"
        rows.append((k, " ".join(words), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.where("doc_id < 300")
    first = toxicity.fit(*toxicity.sample(docs, labels), of_class=toxicity.counted(labels))
    model = toxicity.calibrated(first, docs, labels)
    held = docs.where("doc_id >= 300")
    judged = toxicity.score(held, model).join(held, "doc_id").collect()
    long = [r for r in judged if len(r.text) > toxicity.SAMPLE_CHARACTERS and not r.toxic]
    assert len(long) == 10 and sum(r.predicted for r in long) == 0
    assert sum(r.predicted == r.toxic for r in judged) >= 90
