"""The prefix trie of conversations: range shards of sorted paths under a skeleton of splitters."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.graph import Scratch, kept

#: Bytes that stand for a turn in a path: the first of the SHA-256 of role and text.
TURN = 16
#: Paths, per shard, from which the splitters are taken.
SAMPLE = 16
#: Shards at most: the skeleton is broadcast, and its nodes are finished on the driver.
MOST_SHARDS = 4096
#: Turns of a splitter at most; conversations alike for longer are split no finer.
SPLITTER_TURNS = 64
#: Finished nodes that a task holds back at most, until their parents' smallest member is known.
HELD = 100_000
#: Characters of a list of ids that travel together.
PIECE = 1 << 16

COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
)


# --- paths ----------------------------------------------------------------------------


def _turns(conversations: DataFrame, id_column: str) -> DataFrame:
    """(conv, place, key, size): turns numbered from 1, each by its digest and length."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    key = F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, TURN)
    rows = conversations.select(
        F.col(id_column).cast("long").alias("conv"), "turn", key.alias("key"),
        F.char_length(text).alias("size"),
    ).where("conv IS NOT NULL")
    # Only digests are gathered: some 30 bytes for each turn of a conversation.
    listed = rows.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("turn", "key", "size"))).alias("turns")
    )
    return listed.withColumn("turns", F.transform("turns", lambda t: F.struct(t["key"], t["size"])))


def paths(conversations: DataFrame, *, id_column: str = "conv_id") -> DataFrame:
    """(conv, path, sizes): each conversation's turns in order, as digests, and their lengths.

    Turns are ordered by ``turn``, null first, equal ones by digest. Null roles and texts are
    empty. Rows with a null id belong to no conversation and are left out; rows that repeat
    another are turns of their own.
    """
    return _path_of(_turns(conversations, id_column), F.col("turns"))


def _path_of(listed: DataFrame, turns: Column) -> DataFrame:
    whole = listed.select("conv", turns.alias("turns"))
    # Joined as text: adding one binary to the next would copy the path for each turn.
    joined = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), ""))
    return whole.select(
        "conv", joined.alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes")
    )


def spliced_paths(
    conversations: DataFrame, *, block: int = 100, most: int = 6, id_column: str = "conv_id"
) -> DataFrame:
    """As ``paths``, with each conversation's beginning taken from the first of its block.

    Conversation c gets the first h turns of conversation c - c % block (all if it has fewer, none
    if there is none), then its own after its first h; h is the checksum (CRC-32) of the id in
    decimal, modulo ``most``. A conversation may end up without a turn.
    """
    listed = _turns(conversations, id_column)
    bases = listed.where(F.col("conv") % block == 0).select(
        F.col("conv").alias("base"), F.slice("turns", 1, most - 1).alias("first")
    )
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")
    spliced = listed.select(
        "conv", "turns", h.alias("h"), (F.col("conv") - F.col("conv") % block).alias("base")
    ).join(bases, "base", "left")
    own = F.when(
        F.size("turns") > F.col("h"),
        F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))),
    ).otherwise(F.slice("turns", 1, 0))
    begun = F.when(
        F.col("first").isNotNull() & (F.col("h") > 0), F.slice("first", 1, F.greatest("h", F.lit(1)))
    ).otherwise(F.slice("turns", 1, 0))
    return _path_of(spliced, F.concat(begun, own))


# --- splitters and skeleton ------------------------------------------------------------


def _common(one: bytes, other: bytes) -> int:
    """Turns that two paths begin with alike."""
    most = min(len(one), len(other)) // TURN
    if one[: most * TURN] == other[: most * TURN]:
        return most
    low, high = 0, most  # alike for low turns, not for high
    while high - low > 1:
        middle = (low + high) // 2
        if one[: middle * TURN] == other[: middle * TURN]:
            low = middle
        else:
            high = middle
    return low


def _splitters(listed: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """First (path, conversation) of each shard but the first, from the rows with least hashes.

    Between different paths the shortest beginning of the later one is enough. Equal paths are
    split by conversation, so one that a third of all conversations have lies in many shards.
    """
    if shards < 2:
        return []
    mark = F.xxhash64("conv", "path")
    sample = listed.select(
        F.substring("path", 1, SPLITTER_TURNS * TURN).alias("path"), "conv", mark.alias("mark")
    )
    sample = sample.orderBy("mark", "conv").limit(shards * SAMPLE).collect()
    keys = sorted((bytes(row["path"]), row["conv"]) for row in sample)
    found = set()
    for k in range(1, shards):
        place = k * len(keys) // shards
        if place == 0 or keys[place] == keys[place - 1]:
            continue
        (before, _), (path, conv) = keys[place - 1], keys[place]
        if path == before:
            found.add((path, conv))
        else:
            found.add((path[: (_common(before, path) + 1) * TURN], -(1 << 63)))
    return sorted(found)


class _Skeleton:
    """The trie of the splitters' paths: the only nodes with members in more than one shard."""

    def __init__(self, splitters: list[tuple[bytes, int]]) -> None:
        self.paths = sorted(
            {b""}
            | {p[: d * TURN] for p, _ in splitters for d in range(1, len(p) // TURN + 1)}
        )
        self.number = {path: n for n, path in enumerate(self.paths)}


# --- shards ---------------------------------------------------------------------------


class _Node:
    """An open node: the conversations so far that begin with its path."""

    __slots__ = (
        "number", "serial", "least", "members", "children", "leaves", "saved", "size", "ends",
        "ended", "held",
    )

    def __init__(self, number: int | None, size: int) -> None:
        self.number = number  # in the skeleton
        self.serial: str | None = None  # once children have left without its smallest member
        self.least: int | None = None
        self.members = self.children = self.leaves = self.saved = self.ended = 0
        self.size = size
        self.ends = None if number is not None else hashlib.sha256()
        self.held: list[list] = []


_ROW = T.StructType(
    [
        # node: done; open: done but for its parent; least: a parent's smallest member;
        # skeleton: what a shard adds to a node of the skeleton; ends: a piece of its list of ids
        T.StructField("kind", T.StringType()),
        T.StructField("conv_id", T.LongType()),
        T.StructField("depth", T.LongType()),
        T.StructField("parent_conv_id", T.LongType()),
        T.StructField("n_convs", T.LongType()),
        T.StructField("n_children", T.LongType()),
        T.StructField("n_leaves", T.LongType()),
        T.StructField("saved_tokens", T.LongType()),
        T.StructField("ends_sha256", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("piece", T.LongType()),
        T.StructField("size", T.LongType()),
    ]
)
_KINDS = [
    pa.string(), *[pa.int64()] * 7, pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()
]


class _Shard:
    """Walks the sorted paths of one shard with a stack of open nodes."""

    def __init__(self, skeleton: _Skeleton, shard: int, held: int) -> None:
        self.skeleton, self.shard, self.most_held = skeleton, shard, held
        self.path = b""
        self.stack = [_Node(0, 0)]
        self.rows: list[tuple] = []
        self.held = self.named = 0
        self.ids: list[str] = []
        self.ids_of: int | None = None
        self.ids_size = self.pieces = 0

    def _put(self, kind: str, *values, node=None, piece=None, size=None) -> None:
        filled = [*values, *[None] * (8 - len(values))]
        self.rows.append((kind, *filled, node, self.shard, piece, size))

    def add(self, conv: int, path: bytes, sizes: list[int]) -> None:
        common = _common(self.path, path)
        while len(self.stack) > common + 1:
            self._close()
        for depth in range(common + 1, len(path) // TURN + 1):
            number = None
            if self.stack[-1].number is not None:
                number = self.skeleton.number.get(path[: depth * TURN])
            self.stack.append(_Node(number, sizes[depth - 1]))
        self.path = path
        node = self.stack[-1]
        node.members += 1
        node.least = conv if node.least is None else min(node.least, conv)
        # Equal paths come in the order of their conversations.
        if node.number is None:
            node.ends.update(f",{conv}".encode() if node.ended else str(conv).encode())
        else:
            self._list(node.number, conv)
        node.ended += 1

    def _list(self, number: int, conv: int) -> None:
        if self.ids_of != number or self.ids_size > PIECE:
            self._flush_ids()
            self.ids_of = number
        text = str(conv)
        self.ids.append(text)
        self.ids_size += len(text) + 1

    def _flush_ids(self) -> None:
        if self.ids:
            self._put(
                "ends", None, None, None, None, None, None, None, ",".join(self.ids),
                node=str(self.ids_of), piece=self.pieces,
            )
            self.pieces += 1
        self.ids, self.ids_size, self.ids_of = [], 0, None

    def _close(self) -> None:
        """Finishes the deepest open node and adds it to its parent."""
        node, depth = self.stack.pop(), len(self.stack)
        parent = self.stack[-1] if self.stack else None
        if node.number is not None:
            # Its own part of leaves and savings is known when all shards are added up.
            if node.members:
                self._put(
                    "skeleton", node.least, depth, None, node.members, node.children, node.leaves,
                    node.saved, node=str(node.number), size=node.size,
                )
        else:
            if not node.children:
                node.leaves = 1
            node.saved += (node.members - 1) * node.size
            self._let_go(node)
            if node.serial is not None:
                self._put("least", node.least, node=node.serial)
            row = [
                node.least, depth, None, node.members, node.children, node.leaves, node.saved,
                node.ends.hexdigest(),
            ]
            if parent.number is not None:
                self._put("open", *row, node=str(parent.number))
            else:
                parent.held.append(row)
                self.held += 1
                if self.held > self.most_held:
                    self._relieve()
            parent.children += 1
            parent.leaves += node.leaves
            parent.saved += node.saved
        if parent is not None:
            parent.members += node.members
            least = [n for n in (parent.least, node.least) if n is not None]
            parent.least = min(least) if least else None

    def _let_go(self, node: _Node) -> None:
        """Children that were held back leave with their parent's smallest member."""
        for row in node.held:
            row[2] = node.least
            self._put("node", *row)
        self.held -= len(node.held)
        node.held = []

    def _relieve(self) -> None:
        """Too many wait: they leave at once, and their parents' smallest members follow."""
        for node in self.stack:
            if node.held:
                if node.serial is None:
                    node.serial = f"{self.shard}.{self.named}"
                    self.named += 1
                for row in node.held:
                    self._put("open", *row, node=node.serial)
                node.held = []
        self.held = 0

    def finish(self) -> None:
        while self.stack:
            self._close()
        self._flush_ids()

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(_KINDS)
        self.rows = []
        arrays = [pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, _ROW.fieldNames())


def _walk(listed: DataFrame, splitters: list, skeleton: _Skeleton, held: int) -> DataFrame:
    shared = listed.sparkSession.sparkContext.broadcast((splitters, skeleton))

    @F.arrow_udf("int")
    def shard_of(path: pa.Array, conv: pa.Array) -> pa.Array:
        cuts = shared.value[0]
        pairs = zip(path.to_pylist(), conv.to_pylist(), strict=True)
        return pa.array([bisect_right(cuts, pair) for pair in pairs], pa.int32())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for shard, conv, path, sizes in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if state is None or state.shard != shard:
                    if state is not None:
                        state.finish()
                        yield state.taken()
                    state = _Shard(shared.value[1], shard, held)
                state.add(conv, path, sizes)
                if len(state.rows) >= 10_000:
                    yield state.taken()
        if state is not None:
            state.finish()
            yield state.taken()

    sharded = listed.withColumn("shard", shard_of("path", "conv") if splitters else F.lit(0))
    return (
        sharded.select("shard", "conv", "path", "sizes")
        .repartitionById(len(splitters) + 1, F.col("shard"))
        .sortWithinPartitions("shard", "path", "conv")
        .mapInArrow(walk, _ROW)
    )


# --- skeleton nodes -------------------------------------------------------------------


def _end_digests(walked: DataFrame) -> DataFrame:
    """(node, digest) of the lists of ids that belong to nodes of the skeleton.

    A SHA-256 takes its bytes in order: the pieces of a list, of some 8,000 ids each, meet in one
    task, which holds one of them at a time.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, done, names, digests = None, None, [], []
        for batch in batches:
            for name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name != node:
                    if node is not None:
                        names.append(node)
                        digests.append(done.hexdigest())
                    node, done = name, hashlib.sha256()
                    done.update(text.encode())
                else:
                    done.update(b"," + text.encode())
        if node is not None:
            names.append(node)
            digests.append(done.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(digests, pa.string())], ["node", "digest"]
        )

    pieces = walked.where("kind = 'ends'").select(
        "node", F.col("ends_sha256").alias("ids"), "shard", "piece"
    )
    in_order = pieces.repartition("node").sortWithinPartitions("node", "shard", "piece")
    return in_order.select("node", "ids").mapInArrow(digest, "node string, digest string")


def _finished(walked: DataFrame, skeleton: _Skeleton) -> list[tuple]:
    """The skeleton's nodes, (number, row): at most as many as the splitters have turns."""
    summed = (
        walked.where("kind = 'skeleton'")
        .groupBy("node")
        .agg(
            F.min("conv_id").alias("least"),
            *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
            F.max("size").alias("size"),
        )
        .collect()
    )
    ends = {int(r["node"]): r["digest"] for r in _end_digests(walked).collect()}
    nodes = {int(r["node"]): r.asDict() for r in summed}
    # Deeper nodes come after their parents in the order of paths, so backwards all children
    # of a node are known before it.
    for number in sorted(nodes, reverse=True):
        node, path = nodes[number], skeleton.paths[number]
        node["depth"] = len(path) // TURN
        if not node["n_children"]:
            node["n_leaves"] = 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node["size"]
        node["parent"] = skeleton.number[path[:-TURN]] if path else None
        if path:
            above = nodes[node["parent"]]
            above["n_children"] += 1
            above["n_leaves"] += node["n_leaves"]
            above["saved_tokens"] += node["saved_tokens"]
    nobody = hashlib.sha256().hexdigest()
    return [
        (
            number,
            (
                node["least"], node["depth"],
                nodes[node["parent"]]["least"] if node["parent"] is not None else None,
                node["n_convs"], node["n_children"], node["n_leaves"], node["saved_tokens"],
                ends.get(number, nobody),
            ),
        )
        for number, node in sorted(nodes.items())
    ]


def prefix_trie(
    listed: DataFrame, *, shards: int | None = None, held: int = HELD
) -> DataFrame:
    """One row per node of the trie of all conversations' beginnings, root included.

    ``listed`` has (conv, path, sizes) as ``paths`` gives them. A node stands for a distinct
    sequence of first turns; its members are the conversations that begin with it. Columns, all
    numbers long: conv_id, the smallest member, which together with depth names the node;
    parent_conv_id, that of its parent (root: null); n_convs, its members; n_children; n_leaves,
    the nodes without children among it and those below; saved_tokens, summed over the same nodes,
    (members - 1) times the length of the last turn's text; ends_sha256, of the ids of the members
    that end there, ascending, joined by commas.

    Without conversations there is no node, not even a root. Ids are expected once each; one that
    is repeated counts as often.

    Conversations are dealt into ranges of (path, id), by splitters from the rows with the least
    hashes, and sorted there. A node that lies in one range is finished in its task, which holds
    the open nodes of one path. Nodes that more than one range can share are beginnings of
    splitters: for these the tasks return partial sums, which are added up by node. There are few
    of them, however many conversations there are (``MOST_SHARDS`` splitters of at most
    ``SPLITTER_TURNS`` turns), so they go through the driver and back by broadcast.
    """
    spark = listed.sparkSession
    scratch = Scratch(spark)
    listed = scratch.keep(listed.select("conv", "path", "sizes"), "trie-paths")
    wanted = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    splitters = _splitters(listed, min(wanted, MOST_SHARDS))
    skeleton = _Skeleton(splitters)
    walked = scratch.keep(_walk(listed, splitters, skeleton, held), "trie-nodes")
    finished = _finished(walked, skeleton)
    fields = [_ROW[c] for c in COLUMNS]
    top = spark.createDataFrame([row for _, row in finished], T.StructType(fields))
    known = spark.createDataFrame(
        [(str(number), row[0]) for number, row in finished], "node string, least long"
    )
    # Few nodes wait for a parent that had too many children to hold them; most for the skeleton's.
    below = walked.where("kind = 'open'").drop("parent_conv_id")
    of_skeleton = below.where(~F.contains("node", F.lit("."))).join(F.broadcast(known), "node")
    named = walked.where("kind = 'least'").select("node", F.col("conv_id").alias("least"))
    of_shards = below.where(F.contains("node", F.lit("."))).join(named, "node")
    parent = F.col("least").alias("parent_conv_id")
    rest = [parent if c == "parent_conv_id" else F.col(c) for c in COLUMNS]
    found = (
        walked.where("kind = 'node'").select(*COLUMNS)
        .unionByName(of_skeleton.select(*rest))
        .unionByName(of_shards.select(*rest))
        .unionByName(top)
    )
    done = kept(found, "trie")
    scratch.release()
    return done


def trie_sql(conversations: str, block: int = 100, most: int = 6) -> str:
    """The trie of spliced conversations as SQL of DuckDB."""
    return f"""
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '')
                    || coalesce(text, '')), 1, {2 * TURN})) AS place
        FROM {conversations} WHERE conv_id IS NOT NULL
    ),
    checksums AS (
        SELECT list(v ORDER BY n) AS step FROM (
            SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
                CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v
            FROM range(256) AS r(n)
        )
    ),
    crc AS (
        SELECT conv_id, list_reduce([4294967295] || list_transform(
                string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
            lambda c, d: xor(c >> 8, step[(xor(c, d) & 255) + 1])) AS c
        FROM (SELECT DISTINCT conv_id FROM turns), checksums
    ),
    convs AS (
        SELECT conv_id, xor(c, 4294967295) % {most} AS h, conv_id - conv_id % {block} AS base FROM crc
    ),
    rebuilt AS (
        SELECT c.conv_id, 0 AS part, t.place, t.role, t.text
        FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
        UNION ALL
        SELECT c.conv_id, 1, t.place, t.role, t.text
        FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h
    ),
    numbered AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth,
            length(text) AS size, sha256(length(role) || ':' || role || text) AS turn_key
        FROM rebuilt
    ),
    members AS (
        SELECT conv_id, depth, size, sha256(string_agg(turn_key, ',') OVER (
            PARTITION BY conv_id ORDER BY depth)) AS node
        FROM numbered
        UNION ALL SELECT conv_id, 0, 0, '' FROM convs
    ),
    lengths AS (SELECT conv_id, max(depth) AS last FROM members GROUP BY conv_id),
    nodes AS (
        SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
            count(*) FILTER (depth = last) AS n_ends,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                FILTER (depth = last), '')) AS ends_sha256
        FROM members JOIN lengths USING (conv_id) GROUP BY ALL
    ),
    above AS (
        SELECT n.node, n.depth, p.node AS parent
        FROM nodes n JOIN members p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
    ),
    children AS (SELECT parent AS node, count(*) AS n_children FROM above GROUP BY parent),
    own AS (
        SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * size AS saved
        FROM nodes n LEFT JOIN children USING (node)
    ),
    sums AS (
        SELECT m.node, sum((o.n_children = 0)::BIGINT) AS n_leaves, sum(o.saved) AS saved_tokens
        FROM own o JOIN members m ON m.conv_id = o.conv_id AND m.depth <= o.depth
        GROUP BY m.node
    )
    SELECT o.conv_id, o.depth::BIGINT AS depth, p.conv_id AS parent_conv_id,
        o.n_convs::BIGINT AS n_convs, o.n_children::BIGINT AS n_children,
        s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, o.ends_sha256
    FROM own o JOIN sums s USING (node)
        LEFT JOIN above a ON a.node = o.node LEFT JOIN own p ON p.node = a.parent
    """
