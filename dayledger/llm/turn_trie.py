"""Conversation prefix trie: ternary search trees over dictionary-encoded turns, one per range shard.

A node is a distinct sequence of first turns; its members are the conversations that begin with it. A turn is
its role and text, encoded once by a dictionary of all distinct turns.

1. Conversations become arrays of turn ids, ``CHUNK`` turns at a time. Equal ones are one weighted sequence.
2. Sequences are dealt by ranges of their order, so a shard holds whole subtrees but for the prefixes of its first and its last
   sequence. Each shard inserts its sequences into a ternary search tree, the median first, then the medians of both halves,
   so the tree is balanced; nodes are made after their ancestors, so one pass backwards over them adds up
   members, leaves and savings without recursion.
3. Boundary nodes, which neighbouring shards may have too, leave a shard as parts: what its other nodes below add. Parts of
   one node are added up, then every boundary node adds its own share to its ancestors.
4. Conversations that go on after a chunk with others beginning alike take part in a further trie below that node; its totals
   flow back into the nodes above. One that goes on alone is a chain, whose nodes come straight from its turns,
   so a conversation that holds a third of all turns is not gathered anywhere.
5. The ids of the conversations that end at a node are hashed one by one as they come, sorted.

Turns are numbered without a window over a conversation: rows are sorted by ranges, and each range adds the counts of those before.

Defined results: turns go by number, null first, then by a hash of role and text; repeated rows are turns of their own. A null
role or text is empty. Rows without a conv_id belong to no conversation. A conversation without turns is a member of the
root and ends there. Without any conversation there is no node. Texts of any length are read once and hashed, 128 bits.
Further columns of the input are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_intdigest

from dayledger.llm.common import stored

#: Turns of a conversation that are gathered at once.
CHUNK = 256
_SHARD = 100_000
_ROOT = (0, 0)


def encoded(turns: DataFrame) -> DataFrame:
    """(conv_id, place, turn_id, chars) of columns conv_id, turn, role, text: turns numbered from 0 in each conversation."""
    spark = turns.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    hashed = [F.xxhash64(F.lit(seed), role, text).alias(name) for seed, name in ((1, "one"), (2, "two"))]
    rows = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *hashed, F.length(text).cast("long").alias("chars"))
    order = ["conv_id", "turn", "one", "two"]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    rows = stored(rows.drop("turn"), "turns")
    words = rows.groupBy("one", "two").agg(F.first("chars").alias("chars"))
    words = stored(words.select("one", "two", F.monotonically_increasing_id().alias("turn_id")), "dictionary")
    # Each range of a conversation starts after the rows of its earlier ranges.
    ranges = rows.groupBy("conv_id", F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n"), F.min("at").alias("start"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over ranges, not turns
    before = ranges.select("conv_id", "part", (F.col("start") - F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("zero"))
    numbered = rows.withColumn("part", F.shiftright("at", 33)).join(before, ["conv_id", "part"]).withColumn("place", F.col("at") - F.col("zero"))
    return numbered.join(words, ["one", "two"]).select("conv_id", "place", "turn_id", "chars")


class Tree:
    """A ternary search tree over sequences of turn ids: each node holds a turn, smaller and greater siblings, and its first child."""

    def __init__(self) -> None:
        self.turn, self.less, self.more, self.child, self.up, self.depth = [-1], [0], [0], [0], [0], [0]

    def _new(self, turn: int, up: int) -> int:
        for values, value in ((self.turn, turn), (self.less, 0), (self.more, 0), (self.child, 0), (self.up, up), (self.depth, self.depth[up] + 1)):
            values.append(value)
        return len(self.turn) - 1

    def insert(self, sequence: list[int]) -> int:
        """The node of the whole sequence; 0 is the root."""
        up = 0
        for turn in sequence:
            links, at = self.child, up
            while node := links[at]:
                if turn == self.turn[node]:
                    break
                links, at = self.less if turn < self.turn[node] else self.more, node
            else:
                node = links[at] = self._new(turn, up)
            up = node
        return up


def medians(n: int) -> Iterator[int]:
    """0 to n - 1: the middle, then the middles of both halves, and so on."""
    ranges = [(0, n)]
    for a, b in ranges:
        if a < b:
            yield (a + b) // 2
            ranges += [(a, (a + b) // 2), ((a + b) // 2 + 1, b)]


def prefix_keys(group: tuple[int, int], sequence: list[int]) -> list[tuple[int, int]]:
    """A key for each prefix of the sequence, the empty one's being the group's."""
    data, head, keys = np.array(sequence, dtype="<i8").tobytes(), np.array(group, dtype="<i8").tobytes(), [group]
    chain = head
    for i in range(len(sequence)):
        value = xxh3_128_intdigest(chain + data[8 * i : 8 * i + 8])
        chain = value.to_bytes(16, "little")
        keys.append(tuple(np.frombuffer(chain, dtype="<i8").tolist()))
    return keys


_SEQUENCE = "g1 long, g2 long, turns array<long>, chars array<long>, n long, first long, going long"
# Nodes of one shard (part = false) and parts of nodes that others may have too, with the keys of their ancestors. Of a part
# n_children, n_leaves and saved count what its children that are no parts add.
_NODE = (
    "part boolean, k1 long, k2 long, up1 long, up2 long, depth long, first long, parent long, n long, children long, leaves long, saved long, "
    "chars long, going long, ended long, above array<struct<k1:long,k2:long>>"
)


def _grown(base: int):
    """The nodes of a shard's groups; ``base`` is the depth of the groups' roots."""

    def shard(group: tuple[int, int], rows: list[dict]) -> Iterator[dict]:
        tree, ends = Tree(), [0] * len(rows)
        for i in medians(len(rows)):
            ends[i] = tree.insert(rows[i]["turns"])
        size = len(tree.turn)
        n, children, leaves, saved, chars, going = ([0] * size for _ in range(6))
        first: list[int | None] = [None] * size
        ended: list[int | None] = [None] * size  # the sequence's first member, if it ends there
        part, keys = [False] * size, {}
        for i, (row, end) in enumerate(zip(rows, ends, strict=True)):
            n[end], first[end], going[end] = row["n"], row["first"], row["going"]
            ended[end] = row["first"] if row["going"] < row["n"] else None
            shared = row["going"] and row["n"] > 1
            path, node = [], end
            for length in reversed(row["chars"]):
                chars[node] = length
                path.append(node)
                node = tree.up[node]
            if shared or i in (0, len(rows) - 1):
                for node, key in zip([0, *reversed(path)], prefix_keys(group, row["turns"]), strict=True):
                    part[node], keys[node] = True, key
        part[0], keys[0] = True, group
        for node in range(size - 1, -1, -1):
            up = tree.up[node]
            if going[node] == 1 and n[node] == 1:  # a chain follows
                children[node], leaves[node] = 1, 1
            if not part[node]:
                leaves[node] += children[node] == 0
                saved[node] += (n[node] - 1) * chars[node]
            if node:
                n[up] += n[node]
                first[up] = first[node] if first[up] is None else first[up] if first[node] is None else min(first[up], first[node])
                children[up] += not part[node]
                if not part[node]:
                    leaves[up] += leaves[node]
                    saved[up] += saved[node]
        for node in range(size):
            up, above = tree.up[node], []
            row = {"part": part[node], "depth": base + tree.depth[node], "first": first[node], "n": n[node], "children": children[node], "leaves": leaves[node], "saved": saved[node], "chars": chars[node], "going": going[node], "ended": ended[node]}
            if part[node]:
                row["k1"], row["k2"] = keys[node]
                at = node
                while at:
                    at = tree.up[at]
                    above.append({"k1": keys[at][0], "k2": keys[at][1]})
                row["above"] = above
            if node and part[up]:
                row["up1"], row["up2"] = keys[up]
            elif node:
                row["parent"] = first[up]
            yield row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        group: tuple[int, int] | None = None

        def close() -> Iterator[pa.RecordBatch]:
            nodes = list(shard(group, held)) if held else []
            for at in range(0, len(nodes), 20_000):
                yield _records(nodes[at : at + 20_000])

        for batch in batches:
            for row in batch.to_pylist():
                if (row["g1"], row["g2"]) != group:
                    yield from close()
                    held, group = [], (row["g1"], row["g2"])
                held.append(row)
        yield from close()

    return run


def _records(rows: list[dict]) -> pa.RecordBatch:
    key = pa.list_(pa.struct([("k1", pa.int64()), ("k2", pa.int64())]))
    kinds = {"part": pa.bool_(), "above": key}
    names = [field.split()[0] for field in _NODE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([row.get(name) for row in rows], kinds.get(name, pa.int64())) for name in names], names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each node, sorted by it and conv_id, the hash of the conversations that end there."""
    now, digest = None, None
    done: list[tuple[int, int, str]] = []
    for batch in batches:
        for depth, first, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "first", "conv_id")), strict=True):
            if (depth, first) != now:
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = (depth, first), hashlib.sha256(str(conv).encode())
            else:
                digest.update(b",%d" % conv)
        yield _digest_batch(done)
        done = []
    if now is not None:
        yield _digest_batch([(*now, digest.hexdigest())])


def _digest_batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)], ["depth", "first", "ends_sha256"])


def _level(turns: DataFrame, members: DataFrame, base: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """(nodes and parts, members with their sequences' first member) of the tries that begin at depth ``base``."""
    spark = turns.sparkSession
    here = turns.filter((F.col("place") >= base) & (F.col("place") < base + chunk))
    gathered = here.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "turn_id", "chars"))).alias("all"))
    none = F.array().cast("array<long>")
    rows = members.join(gathered, "conv_id", "left").select(
        "conv_id", "total", "g1", "g2", F.coalesce(F.col("all.turn_id"), none).alias("turns"), F.coalesce(F.col("all.chars"), none).alias("chars"), (F.col("total") > base + chunk).alias("goes")
    )
    rows = stored(rows, "sequences")
    classes = rows.groupBy("g1", "g2", "turns").agg(F.first("chars").alias("chars"), F.count("*").alias("n"), F.min("conv_id").alias("first"), F.count_if("goes").alias("going"))
    classes = stored(classes.select(*[field.split()[0] for field in _SEQUENCE.split(", ")]), "classes")
    shards = max(1, -(-classes.count() // _SHARD))
    parts = max(shards, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shards * _SHARD // 1000)))
    dealt = classes.repartitionByRange(parts, "g1", "g2", "turns").sortWithinPartitions("g1", "g2", "turns")
    nodes = stored(dealt.mapInArrow(_grown(base), _NODE), "nodes")
    least = classes.select("g1", "g2", "turns", "first", F.col("n").alias("alike"))
    return nodes, rows.select("conv_id", "total", "g1", "g2", "turns", "goes").join(least, ["g1", "g2", "turns"]).select("conv_id", "total", "goes", "first", "alike")


def _union(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def _merged(parts: DataFrame, below: DataFrame | None) -> DataFrame:
    """Boundary nodes with their totals; ``below`` has what tries below them add."""
    once = parts.groupBy("k1", "k2").agg(
        *[F.first(c, True).alias(c) for c in ("up1", "up2", "depth", "chars", "above")],
        F.min("first").alias("first"),
        F.max("ended").alias("ended"),
        *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")],
    )
    if below is not None:
        once = once.join(below, ["k1", "k2"], "left")
        once = once.select(*[c for c in parts.columns if c in once.columns and c not in ("children", "leaves", "saved")], *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("children", "leaves", "saved")])
    once = stored(once, "boundary")
    counted = once.filter("up1 is not null").groupBy(F.col("up1").alias("k1"), F.col("up2").alias("k2")).agg(F.count("*").alias("sub"))
    once = once.join(counted, ["k1", "k2"], "left").withColumn("children", F.col("children") + F.coalesce("sub", F.lit(0)))
    own = once.withColumn("leaf", F.col("leaves") + (F.col("children") == 0).cast("long")).withColumn("own", F.col("saved") + F.when(F.size("above") > 0, (F.col("n") - 1) * F.col("chars")).otherwise(0))
    shares = own.select("leaf", "own", F.explode(F.concat("above", F.array(F.struct("k1", "k2")))).alias("k"))
    totals = shares.groupBy("k.k1", "k.k2").agg(F.sum("leaf").alias("leaves"), F.sum("own").alias("saved"))
    return stored(once.drop("leaves", "saved").join(totals, ["k1", "k2"]), "merged")


def nodes(turns: DataFrame, conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    ``turns`` has conv_id, place (from 0, without gaps), turn_id and chars; ``conversations`` every conv_id, each once.
    """
    turns = stored(turns, "rebuilt")
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("total"))
    every = conversations.select("conv_id").join(counts, "conv_id", "left").select("conv_id", F.coalesce("total", F.lit(0)).alias("total"))
    members = every.select("*", *[F.lit(x).cast("long").alias(g) for x, g in zip(_ROOT, ("g1", "g2"), strict=True)])
    levels, chains, ends, base = [], [], [], 0
    while True:
        found, sequences = _level(turns, members, base, chunk)
        levels.append(found)
        ends.append(sequences.filter(~F.col("goes")).select(F.col("total").alias("depth"), "first", "conv_id"))
        on = sequences.filter("goes")
        chains.append(on.filter("alike = 1").select("conv_id", "total", F.lit(base + chunk).cast("long").alias("since")))
        shared = found.filter(F.col("part") & (F.col("going") > 0) & (F.col("n") > 1)).select("first", F.col("k1").alias("g1"), F.col("k2").alias("g2"))
        members = stored(on.filter("alike > 1").join(shared, "first").select("conv_id", "total", "g1", "g2"), "members")
        base += chunk
        if members.isEmpty():
            break

    below, done, heads = None, [], []
    columns = ["first", "depth", "parent", "up1", "up2", "n", "children", "leaves", "saved", "ended"]
    for number, found in reversed(list(enumerate(levels))):
        merged = _merged(found.filter("part"), below)
        # The roots of further tries are nodes of the level above.
        roots = merged.filter(F.size("above") == 0)
        below = roots.select("k1", "k2", *[F.col(c).alias(f"more_{c}") for c in ("children", "leaves", "saved")])
        mine = merged.filter(F.size("above") > 0) if number else merged
        heads.append(mine.select(F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("first").alias("head")))
        done.append(found.filter(~F.col("part")).select(*columns).unionByName(mine.withColumn("parent", F.lit(None).cast("long")).select(*columns)))
    rows = _union(done).join(_union(heads), ["up1", "up2"], "left")
    done = [rows.select(F.col("first").alias("conv_id"), "depth", F.coalesce("parent", "head").alias("parent_conv_id"), "n", "children", "leaves", "saved", "ended")]
    for chain in chains:
        rows = turns.join(chain, "conv_id").filter(F.col("place") >= F.col("since"))
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        last = F.col("place") + 1 == F.col("total")
        done.append(rows.select("conv_id", (F.col("place") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"), one.alias("n"), F.when(last, none).otherwise(one).alias("children"), one.alias("leaves"), none.alias("saved"), F.col("conv_id").alias("ended")))
        ends.append(chain.select(F.col("total").alias("depth"), F.col("conv_id").alias("first"), "conv_id"))
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = _union(ends).repartition(parts, "depth", "first").sortWithinPartitions("depth", "first", "conv_id")
    digests = last.mapInArrow(_digests, "depth long, first long, ends_sha256 string").withColumnRenamed("first", "ended")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return _union(done).join(digests, ["ended", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256")
    )
