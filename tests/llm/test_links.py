"""Components, the Jaccard join and embedding near-duplicates against brute force."""

import itertools
import random
import re

import numpy as np
import pytest

from tidemark.llm import jaccard, projections, queries
from tidemark.llm.graph import components

from .samples import awkward, empty, prose, values


def smallest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    chain = [(k, k + 1) for k in range(1000, 1060)]
    star = [(2000, 2001 + k) for k in range(300)]
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + chain + star
    frame = spark.createDataFrame([*links, (5, None), (7, 7)], "a long, b long").repartition(5)
    got = {r.id: r.component for r in components(frame, "a", "b").collect()}
    linked = [(a, b) for a, b in links if a != b]
    assert got == smallest_reachable({n for x in linked for n in x}, linked)
    assert components(frame.limit(0), "a", "b").collect() == []


def shingle_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def check_similar(spark, rows, docs):
    found, links = jaccard.similar(docs)
    sets = [shingle_set(text) for _, text in rows]
    pairs = [
        (i, j) for i, j in itertools.combinations(range(len(rows)), 2)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    reach = smallest_reachable(range(len(rows)), pairs)
    want = []
    for k, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in reach if reach[j] == reach[k] and rows[j][0] is not None]
        want.append((doc, len(sets[k]), min(ids) if ids else None))
    assert values(found, "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)
    classes = {r["class"] for r in found.collect()}
    assert all(r.one in classes and r.other in classes for r in links.collect())


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = prose(rng.randrange(10**9), 1)
    return " ".join(words)


def test_similar_matches_brute_force(spark):
    rng = random.Random(2)
    rows = []
    shared = prose(777, 70)
    for family in range(12):
        first = prose(family, rng.randint(6, 220))
        for copy in range(rng.randint(1, 14)):
            text = edited(first, rng, rng.randint(0, max(1, len(first.split()) // 60)))
            rows.append((len(rows) + 1, text))
        rows.append((len(rows) + 1, shared + " " + prose(5000 + family, rng.randint(5, 60))))
    chain = prose(99, 200)
    for _ in range(10):  # each one is near the one before only
        chain = edited(chain, rng, 3)
        rows.append((len(rows) + 1, chain))
    rows += [(500, "A b C"), (501, "a B c"), (502, "a b"), (503, "É b"), (504, "é b"), (505, "a\x0bb"), (506, "a\xa0b")]
    rng.shuffle(rows)
    check_similar(spark, rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(6))


def test_similar_awkward(spark):
    docs = awkward(spark, ["n", "class", "component_id", "token"])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check_similar(spark, rows, docs)
    found, links = jaccard.similar(empty(spark))
    assert found.collect() == [] and links.collect() == []
    with pytest.raises(ValueError):
        jaccard.similar(docs, percent=70)


def test_frequent_tokens_change_no_result(spark, monkeypatch):
    """With a tiny sketch nearly any token may count as frequent."""
    rows = [(k, prose(k // 3, 40) + f" w{k}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = values(jaccard.similar(docs)[0], "doc_id", "component_id")
    assert values(jaccard.similar(docs, sketch_bits=10)[0], "doc_id", "component_id") == plain


def test_documents_of_the_table(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check_similar(spark, rows, docs)


def test_recall_is_planned():
    least = projections.least_collisions()
    assert 1 <= least < projections.COUNTED
    for rows in (1, 100, 10**4, 10**9):
        depth, trees = projections.shape(rows, 0.93)
        deviation = (2 * 0.07) ** 0.5
        near = projections._same_cell(deviation, projections.CELL_WIDTH * deviation)
        assert 1 - (1 - near**depth) ** trees >= projections.TREE_RECALL - 1e-12


def brute_links(rows, threshold=0.93):
    units = {}
    for k, (_, label, vector) in enumerate(rows):
        if label is None or not vector or any(x is None or not np.isfinite(x) for x in vector):
            continue
        vector = np.array(vector) / (np.abs(vector).max() or 1)
        if norm := np.linalg.norm(vector):
            units[k] = vector / norm
    return [
        (i, j) for i, j in itertools.combinations(units, 2)
        if rows[i][1] == rows[j][1] and len(units[i]) == len(units[j])
        and units[i] @ units[j] >= threshold
    ]


@pytest.mark.parametrize("block", [8, 768])
def test_near_duplicates_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(projections, "BLOCK", block)
    rng = np.random.default_rng(4)
    rows = []
    for group in range(90):
        first = rng.normal(size=24)
        for _ in range(int(rng.integers(1, 5)) if group else 60):
            vector = first + rng.normal(size=24) * rng.choice([0.0, 0.1, 0.2])
            rows.append((len(rows), int(group % 3), vector.tolist()))
    nan = float("nan")
    rows += [
        (900, None, rows[0][2]), (901, 1, None), (902, 1, []), (903, 1, [0.0] * 24),
        (904, 1, [nan] + [1.0] * 23), (905, 1, [None] + [1.0] * 23), (906, 1, [float("inf")] * 24),
        (907, 5, [1e-300] * 24), (908, 5, [1e300] * 24), (909, 5, [1.0, 1.0]),
        (None, 5, [2.0] * 24), (910, 6, [1.0] * 24), (910, 6, [1.0] * 24), (None, 7, [3.0] * 24),
    ]
    frame = spark.createDataFrame(
        [(*r, "clash") for r in rows], "vec_id long, label int, embedding array<double>, n_links string"
    ).repartition(4)
    got = projections.near_duplicates(frame).collect()
    links = brute_links(rows)
    counts = [sum(k in pair for pair in links) for k in range(len(rows))]
    reach = smallest_reachable(range(len(rows)), links)
    assert sum(r.n_links for r in got) >= 0.97 * sum(counts)
    by_id = {r.vec_id: r for r in got if r.vec_id not in (None, 910)}
    for k, (number, *_) in enumerate(rows):
        if number in by_id:
            assert by_id[number].n_links <= counts[k]
            known = [rows[j][0] for j in reach if reach[j] == reach[k] and rows[j][0] is not None]
            assert by_id[number].component_id >= min(known)
            assert by_id[number].kept == (by_id[number].component_id == number)
    for number in (900, 901, 902, 903, 904, 905, 906, 909):
        assert (by_id[number].n_links, by_id[number].component_id) == (0, number)
    assert (by_id[907].n_links, by_id[908].n_links, by_id[908].component_id) == (2, 2, 907)
    assert [(r.n_links, r.component_id) for r in got if r.vec_id == 910] == [(1, 910)] * 2


def test_recall_on_the_table(spark, testdata):
    frame = spark.read.parquet(f"{testdata}/embeddings.parquet")
    rows = [(r.vec_id, r.label, r.embedding) for r in frame.collect()]
    links = brute_links(rows)
    got = queries.op4_embeddings(spark, testdata).collect()
    assert sum(r.n_links for r in got) >= 0.9 * 2 * len(links)


def test_recall_at_the_threshold(spark):
    """Pairs planted at cosines from 0.93 to 0.95 among vectors that are near to nothing."""
    rng = np.random.default_rng(8)
    rows = []
    for pair in range(1500):
        first, other = rng.normal(size=(2, 64))
        first /= np.linalg.norm(first)
        other -= (other @ first) * first
        other /= np.linalg.norm(other)
        cosine = rng.uniform(0.9301, 0.95)
        second = cosine * first + (1 - cosine**2) ** 0.5 * other
        rows += [(2 * pair, pair % 2, first.tolist()), (2 * pair + 1, pair % 2, second.tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = projections.near_duplicates(frame.repartition(5)).collect()
    linked = sum(r.n_links for r in got) / 2
    assert 0.95 * 1500 <= linked <= 1500
    assert all(r.component_id == r.vec_id - r.vec_id % 2 for r in got if r.n_links)


@pytest.mark.parametrize("block", [7, 16_384])
def test_no_link_is_left_out(spark, monkeypatch, block):
    """Chains whose ends are not near, ids in any order, and pairs just above and below 0.93."""
    monkeypatch.setattr(projections, "BLOCK", block)
    rng = np.random.default_rng(15)
    rows = [(2, 0, [1.0, 0.0]), (1, 0, [0.95, 0.3122498999]), (3, 0, [0.95, -0.3122498999])]
    for size, chains in ((1, 0), (3, 25), (64, 25), (90, 5)):
        for _ in range(chains):
            link = rng.normal(size=size)
            for _ in range(int(rng.integers(2, 6))):
                link /= np.linalg.norm(link)
                rows.append((0, int(rng.integers(2)), link.tolist()))
                step = rng.normal(size=size)
                step -= (step @ link) * link
                cosine = rng.choice([0.9300001, 0.9299999, 0.94])
                link = cosine * link + (1 - cosine**2) ** 0.5 * step / np.linalg.norm(step)
    numbers = rng.permutation(len(rows)) + 10
    rows = rows[:3] + [(int(i), *r[1:]) for i, r in zip(numbers, rows[3:])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = projections.near_duplicates(frame.repartition(5)).collect()
    links = brute_links(rows)
    reach = smallest_reachable(range(len(rows)), links)
    want = []
    for k, (number, *_) in enumerate(rows):
        first = min(rows[j][0] for j in reach if reach[j] == reach[k])
        want.append((number, sum(k in pair for pair in links), first, first == number))
    assert sorted(map(tuple, got)) == sorted(want)


def test_cells_link_fewer_pairs_at_most(spark):
    rng = np.random.default_rng(16)
    first = rng.normal(size=(300, 16)).repeat(2, axis=0)
    rows = [(k, 0, v.tolist()) for k, v in enumerate(first + rng.normal(size=(600, 16)) * 0.05)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    links = brute_links(rows)
    for most, exhaustive in ((1.0, True), (0.95, False)):
        got = projections.near_duplicates(frame, exhaustive=exhaustive).collect()
        assert most * 2 * len(links) <= sum(r.n_links for r in got) <= 2 * len(links)


def test_empty_embeddings(spark):
    frame = empty(spark, "vec_id long, label int, embedding array<float>")
    assert projections.near_duplicates(frame).collect() == []
