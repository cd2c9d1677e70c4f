"""The trie of conversation prefixes from sorted turn arrays (operator 12).

A conversation is the array of its turns' digests, written end to end, so that bytes sort as the arrays do and a prefix comes first.
The arrays are sorted globally by (array, id), in ranges: copies of one conversation, however many, spread over neighbouring ranges. The
longest common prefix (LCP) of neighbours tells the nodes: each partition is swept with a stack of the nodes on the current array's
path; a node closes where an LCP falls below its depth.

Nodes that are open at a partition's edge are stitched. How deep the last array of a partition shares its prefix with the first of the
next is known before the sweep, one number a partition. From these numbers alone each partition knows in which one a node that it
inherits began; (that partition, depth) names the node, and its parts are added up by name. What lies below such nodes is added
up by a second sweep over them: there are at most as many as partitions times the turns that neighbours share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probalink.llm.common import SPACE, stored, text_of

#: Bytes of a turn's digest, and the characters of ids that a node keeps before they are hashed elsewhere.
TURN, KEPT = 32, 1 << 16
#: Rows that a task writes at once.
ROWS = 10_000


def turn_arrays(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns as (key, words), in the order of `turn`, null first, ties by their content.

    Null role and text become empty; rows without a conv_id belong to no conversation. key is the SHA-256 of role and text, words
    their text's words. A conversation is held as one row of 40 bytes or so a turn, never with its texts.
    """
    role, text = text_of("role"), text_of("text")
    key = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.regexp_count(text, F.lit(f"[^{SPACE}]+")).cast("long")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn", key.alias("key"), words.alias("words"))
    rows = conversations.where("conv_id IS NOT NULL").select("conv_id", turn.alias("t"))
    own = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    return own.select("conv_id", F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["words"].alias("words"))).alias("turns"))


def branched(arrays: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Every conversation c with its first h turns, h = CRC-32 of c in decimal modulo `most`, replaced by those of conversation
    c - c % every: all of these if there are fewer, none if there is no such conversation."""
    base = F.col("conv_id") - F.col("conv_id") % every
    firsts = arrays.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("__base"), F.slice("turns", 1, most - 1).alias("__first"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = arrays.withColumns({"__base": base, "__h": h}).join(firsts, "__base", "left")
    head = F.coalesce(F.slice("__first", F.lit(1), F.col("__h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("__h") + 1, F.greatest(F.size("turns") - F.col("__h"), F.lit(0)))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def shared(a: bytes, b: bytes) -> int:
    """Turns that two arrays have in common from their begin on."""
    low, high = 0, min(len(a), len(b)) // TURN
    if a[: high * TURN] == b[: high * TURN]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[: middle * TURN] == b[: middle * TURN]:
            low = middle
        else:
            high = middle
    return low


class Node:
    __slots__ = ("number", "depth", "words", "inherited", "n", "least", "children", "leaves", "saved", "ends", "size", "sent")

    def __init__(self, number: int, depth: int, words: int, inherited: bool):
        self.number, self.depth, self.words, self.inherited = number, depth, words, inherited
        self.n = self.children = self.leaves = self.saved = self.size = self.sent = 0
        self.least: int | None = None
        self.ends: list[str] = []


COLUMNS = ("kind", "part", "number", "parent", "began", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words", "ends", "digest")
SCHEMA = ", ".join(f"{c} {'string' if c in ('ends', 'digest') else 'long'}" for c in COLUMNS)
#: Kinds of rows: a node that lies within a partition, the part of one that an edge cuts, a run of a node's ends.
WITHIN, CUT, ENDS = 0, 1, 2


def sweep(sorted_arrays: DataFrame, depths: dict[int, tuple[int, int]]) -> DataFrame:
    """Rows (COLUMNS) of all partitions' nodes; depths are those of `edges`."""
    order = sorted(depths)
    place = {p: k for k, p in enumerate(order)}
    edge, through = [depths[p][0] for p in order] + [-1], [depths[p][1] for p in order]

    def began(k: int, depth: int) -> int:
        """The partition where the node of this depth began that partition k inherits."""
        k -= 1
        while min(edge[k], through[k]) >= depth:
            k -= 1
        return k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        stack: list[Node] = []
        at, number, previous = -1, 0, b""

        def send(node: Node, first: int) -> None:
            """A run of the node's ends; they are hashed where all of them meet."""
            out.append((ENDS, at, node.number if first < 0 else -1 - node.depth, node.sent, first, node.depth, *[None] * 6, ",".join(node.ends), None))
            node.sent += 1
            node.ends, node.size = [], 0

        def pop(last: bool) -> None:
            node = stack.pop()
            parent = stack[-1] if stack else None
            cut = node.inherited or (last and node.depth <= edge[at + 1])
            if parent is not None:
                parent.n += node.n
                parent.least = node.least if parent.least is None else min(parent.least, node.least)
            up = parent.number if parent is not None else None
            if cut:
                first = began(at, node.depth) if node.inherited else at
                if node.ends:
                    send(node, first)
                out.append((CUT, at, node.number, up, first, node.depth, node.least, node.n, node.children, node.leaves, node.saved, node.words, None, None))
                return
            if node.sent and node.ends:
                send(node, -1)
            leaves = node.leaves + (node.children == 0)
            saved = node.saved + (node.n - 1) * node.words
            digest = None if node.sent else hashlib.sha256(",".join(node.ends).encode()).hexdigest()
            out.append((WITHIN, at, node.number, up, None, node.depth, node.least, node.n, node.children, leaves, saved, node.words, None, digest))
            if parent is not None:
                parent.leaves += leaves
                parent.saved += saved

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n in ("ends", "digest") else pa.int64()) for n, c in zip(COLUMNS, zip(*out))], list(COLUMNS))
            out.clear()
            return made

        for given in batches:
            for part, path, conv, words in zip(*(given.column(c).to_pylist() for c in ("__part", "path", "conv_id", "words"))):
                if at < 0 or order[at] != part:
                    while stack:
                        pop(True)
                    at, number = place[part], 0
                    lcp = edge[at]
                    for depth in range(lcp + 1):
                        stack.append(Node(number, depth, words[depth - 1] if depth else 0, True))
                        number += 1
                else:
                    lcp = shared(previous, path)
                previous = path
                while len(stack) - 1 > lcp and stack:
                    pop(False)
                for depth in range(len(stack), len(path) // TURN + 1):
                    if stack:
                        stack[-1].children += 1
                    stack.append(Node(number, depth, words[depth - 1] if depth else 0, False))
                    number += 1
                top = stack[-1]
                top.n += 1
                top.least = conv if top.least is None else min(top.least, conv)
                top.ends.append(str(conv))
                top.size += len(top.ends[-1]) + 1
                if top.size > KEPT:
                    # a node that began here may still be cut by the partition's end: both names of it are settled later
                    send(top, began(at, top.depth) if top.inherited else -1)
                if len(out) >= ROWS:
                    yield batch()
        while stack:
            pop(True)
        if out:
            yield batch()

    parts = max(depths, default=0) + 1
    return sorted_arrays.repartitionById(parts, F.col("__part").cast("int")).sortWithinPartitions("__part", "path", "conv_id").mapInArrow(run, SCHEMA)


def edges(sorted_arrays: DataFrame) -> dict[int, tuple[int, int]]:
    """For each partition the turns that its first array shares with the last of the one before it (-1 for the first partition), and
    with its own last: two numbers a partition come to the driver."""
    whole = F.struct("path", "conv_id")
    ends = sorted_arrays.groupBy("__part").agg(F.min(whole)["path"].alias("first"), F.max(whole)["path"].alias("last"))
    ends = ends.withColumn("before", F.lag("last").over(Window.orderBy("__part")))  # one row a partition

    def lcp(other: str) -> Column:
        most = (F.least(F.octet_length("first"), F.octet_length(other)) / TURN).cast("int")
        turn = lambda c, k: F.substring(F.col(c), (k - 1) * TURN + 1, F.lit(TURN))
        found = F.array_position(F.transform(F.sequence(F.lit(1), most), lambda k: turn("first", k) == turn(other, k)), F.lit(False))
        return F.when(F.col(other).isNull(), -1).when(most < 1, 0).when(found == 0, most).otherwise(found - 1).cast("long")

    return {r["__part"]: (r["a"], r["b"]) for r in ends.select("__part", lcp("before").alias("a"), lcp("last").alias("b")).collect()}


def stitched(cut: DataFrame) -> DataFrame:
    """(began, depth, conv_id, parent_conv_id, n_convs, …) of the nodes that edges cut, each once, from the sums of their parts."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    nodes = cut.groupBy("began", "depth").agg(F.min("conv_id").alias("conv_id"), *sums, F.max("words").alias("words"))
    names = ["began", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []
        out: list[list] = []

        def pop() -> None:
            row = stack.pop()
            if stack:
                stack[-1][6] += row[6]
                stack[-1][7] += row[7]
            out.append(row)

        for batch in batches:
            for r in batch.to_pylist():  # a node comes before those below it
                while stack and stack[-1][1] >= r["depth"]:
                    pop()
                leaves = r["n_leaves"] + (r["n_children"] == 0)
                saved = r["saved_tokens"] + (r["n_convs"] - 1) * r["words"]
                stack.append([r["began"], r["depth"], r["conv_id"], stack[-1][2] if stack else None, r["n_convs"], r["n_children"], leaves, saved])
            if len(out) >= ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)
                out.clear()
        while stack:
            pop()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

    return nodes.repartition(1).sortWithinPartitions("began", "depth").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def digests(runs: DataFrame) -> DataFrame:
    """(part, number, digest): the runs of each node's ends, hashed one after another."""
    names = ["part", "number", "digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, hashed = None, hashlib.sha256()
        for batch in batches:
            done = []
            for part, number, ends in zip(*(batch.column(c).to_pylist() for c in ("part", "number", "ends"))):
                if (part, number) != node:
                    done += [(*node, hashed.hexdigest())] if node else []
                    node, hashed = (part, number), hashlib.sha256(ends.encode())
                else:
                    hashed.update(b"," + ends.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names)
        if node:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip((*node, hashed.hexdigest()))], names)

    return runs.repartition("part", "number").sortWithinPartitions("part", "number", "at", "run").mapInArrow(run, "part long, number long, digest string")


def trie(arrays: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a row for each distinct prefix of
    the conversations in `arrays` (as `turn_arrays` makes them, an id once), the empty one included.

    conv_id is the smallest id of those that begin with the prefix; saved_tokens are the words that storing each prefix of the
    subtree once saves; ends_sha256 is over the sorted ids of those that are the prefix. A conversation without turns ends at the root.
    An empty table has no nodes. Copies of one conversation may be any part of the table: they are sorted by id, their counts add up
    across partitions, and their ids are hashed as a stream.
    """
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["key"]), ""))
    placed = arrays.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words"))
    ordered = stored(placed.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").withColumn("__part", F.spark_partition_id()), "sorted")
    nodes = stored(sweep(ordered, edges(ordered)), "nodes")
    within, cut, runs = (nodes.where(F.col("kind") == k) for k in (WITHIN, CUT, ENDS))
    # a run that was sent before its node was known to be cut goes to the node's other name
    named = cut.where("began = part").select("part", "number", F.col("depth").alias("__depth"))
    own = runs.where("began < 0").join(named, ["part", "number"], "left")
    own = own.select("part", F.coalesce(-1 - F.col("__depth"), F.col("number")).alias("number"), F.col("part").alias("at"), F.col("parent").alias("run"), "ends")
    other = runs.where("began >= 0").select(F.col("began").alias("part"), "number", F.col("part").alias("at"), F.col("parent").alias("run"), "ends")
    hashes = stored(digests(own.unionByName(other)), "digests")
    whole = stored(stitched(cut), "stitched")
    # the conv_id of each node by its number in a partition, for the nodes below it
    parents = within.where("n_children > 0").select("part", "number", "conv_id")
    parents = parents.unionByName(cut.select("part", "number", "began", "depth").join(whole.select("began", "depth", "conv_id"), ["began", "depth"]).select("part", "number", "conv_id"))
    parents = parents.select("part", F.col("number").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    inner = within.join(parents, ["part", "parent"], "left").join(hashes.withColumnRenamed("digest", "__digest"), ["part", "number"], "left")
    inner = inner.select(*columns, F.coalesce("digest", "__digest").alias("ends_sha256"))
    outer = whole.withColumns({"part": F.col("began"), "number": -1 - F.col("depth")}).join(hashes, ["part", "number"], "left")
    outer = outer.select(*columns, F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
    return inner.unionByName(outer)
