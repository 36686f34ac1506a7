"""The trie against one built of dictionaries, and against SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries, trie

from .samples import empty, values

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    """Turns (role, text) of each conversation; ties by the digest that stands for a turn."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[: trie.TURN]
            turns[conv].append(((turn is not None, turn or 0, key), (role, text)))
    return {conv: [t for _, t in sorted(own)] for conv, own in turns.items()}


def spliced(turns, block=100, most=6):
    out = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % most
        out[conv] = turns.get(conv - conv % block, [])[:h] + own[h:]
    return out


def plain(turns):
    """Nodes of {conversation: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, own in turns.items():
        for depth in range(len(own) + 1):
            members[tuple(own[:depth])].append(conv)
        ends[tuple(own)].append(conv)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    rows = []

    def below(path):
        yield path
        for child in children[path]:
            yield from below(child)

    for path, own in members.items():
        parts = list(below(path))
        rows.append(
            (
                min(own), len(path), min(members[path[:-1]]) if path else None, len(own),
                len(children[path]), sum(not children[p] for p in parts),
                sum((len(members[p]) - 1) * len(p[-1][1]) for p in parts if p),
                hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest(),
            )
        )
    return sorted(rows, key=repr)


def random_rows(seed, convs, depth=9, words="abc"):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        own = [rng.choice(words) * rng.randint(1, 2) for _ in range(rng.randint(1, depth))]
        if conv % 3 == 0:
            own = ["hot", "conversation", "of", "many"]  # a third of all are alike
        if conv % 7 == 0:
            own = ["hot", f"child {conv}"]  # a node with many children
        rows += [(conv, n, "user" if n % 2 else "assistant", text) for n, text in enumerate(own)]
    rng.shuffle(rows)
    return rows


def got(frame):
    return values(frame, *trie.COLUMNS)


@pytest.mark.parametrize("shards,held", [(1, 100_000), (1, 3), (2, 1), (7, 5), (60, 100_000)])
def test_matches_plain(spark, shards, held):
    rows = random_rows(shards, 400)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = trie.prefix_trie(trie.paths(table), shards=shards, held=held)
    assert got(found) == plain(ordered(rows))


def test_spliced_matches_plain(spark):
    rows = random_rows(5, 350)
    rows += [(10_007, 0, "user", "x"), (10_007, 1, "user", "y"), (20_000, 0, "user", "only")]
    rows += [(c, 0, "user", "short") for c in range(30_001, 30_040)]  # no base: some without turns
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    turns = spliced(ordered(rows))
    assert any(not own for own in turns.values())
    assert got(trie.prefix_trie(trie.spliced_paths(table), shards=9)) == plain(turns)


def test_awkward(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, "user", "second"), (1, 0, "user", "also second"),
        (1, 0, "user", "also second"), (2, 0, None, None), (2, 1, "", ""), (3, 0, "", None),
        (None, 0, "user", "lost"), (None, None, None, None), (-5, 3, "a", "bc"), (-6, 3, "ab", "c"),
        (4, 0, "user", "long " * 50_000), (5, 0, "user", "long " * 50_000), (6, 0, "1", ":x"),
        (7, 0, "", "x" * 9), (8, 0, "user", "\U0001f600é"), (9, 0, "user", "\U0001f600é"),
    ]
    rows += [(10, n, "user", str(n)) for n in range(3000)] + [(11, n, "user", str(n)) for n in range(2999)]
    table = spark.createDataFrame(
        [(*r, 1, "x") for r in rows], SCHEMA + ", depth int, path string"
    ).repartition(3)
    found = trie.prefix_trie(trie.paths(table), shards=4)
    turns = ordered(rows)
    short = {c: t for c, t in turns.items() if c not in (10, 11)}
    depths = {r["depth"]: r for r in found.where("conv_id IN (10, 11) AND depth > 0").collect()}
    assert sorted(depths) == list(range(1, 3001))
    assert depths[2999]["n_convs"] == 2 and depths[3000]["n_convs"] == 1
    assert depths[1]["saved_tokens"] == sum(len(str(n)) for n in range(2999))
    rest = [r for r in got(found) if r[0] not in (10, 11)]
    assert [r for r in rest if r[1] > 0] == [r for r in plain(short) if r[1] > 0]


def test_empty_tables(spark):
    for turns in (empty(spark, SCHEMA), spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)):
        for listed in (trie.paths(turns), trie.spliced_paths(turns)):
            found = trie.prefix_trie(listed)
            assert found.collect() == [] and found.columns == list(trie.COLUMNS)


@given(st.lists(st.lists(st.sampled_from("ab"), max_size=4), min_size=1, max_size=30), st.integers(0, 6))
@settings(max_examples=200, deadline=None)
def test_shards_and_skeleton_add_up(turns, cuts):
    """The walk alone, with any splitters: no Spark."""
    keys = {t: hashlib.sha256(t.encode()).digest()[: trie.TURN] for t in "ab"}
    listed = sorted((b"".join(keys[t] for t in own), conv) for conv, own in enumerate(turns))
    splitters = sorted(set(listed[:: max(1, len(listed) // (cuts + 1))][1:]))
    skeleton = trie._Skeleton(splitters)
    nodes = 0
    sums = defaultdict(int)
    for shard in range(len(splitters) + 1):
        low = splitters[shard - 1] if shard else (b"", -1)
        high = splitters[shard] if shard < len(splitters) else (b"\xff" * 200, 0)
        state = trie._Shard(skeleton, shard, 2)
        own = [(p, c) for p, c in listed if low <= (p, c) < high]
        for path, conv in own:
            state.add(conv, path, [1] * (len(path) // trie.TURN))
        state.finish()
        for row in state.taken().to_pylist():
            if row["kind"] in ("node", "open"):
                nodes += 1
            if row["kind"] == "skeleton":
                sums[row["node"]] += row["n_convs"]
    distinct = {tuple(own[:d]) for own in turns for d in range(len(own) + 1)}
    assert nodes + len(sums) == len(distinct)
    assert sums["0"] == len(turns)


def test_query_matches_sql(spark, testdata):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS FROM '{testdata}/conversations.parquet'")
    query, text = queries.QUERIES["op12_trie"]
    result = duck.execute(text)
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(trie.COLUMNS)
    rows = [tuple(dict(zip(names, r))[c] for c in trie.COLUMNS) for r in result.fetchall()]
    found = got(query(spark, testdata))
    assert found == sorted(rows, key=repr)
    turns = [tuple(r) for r in spark.read.parquet(f"{testdata}/conversations.parquet").collect()]
    assert found == plain(spliced(ordered(turns)))
