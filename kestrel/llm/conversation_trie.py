"""The prefix trie of conversations by blocks of turns (operator 11).

A node is a sequence of first turns; it is named by its smallest member and its
depth. Turns are reduced to 128-bit digests, and ``BLOCK_TURNS`` successive turns
make a block.

1. *Blocks.* The digests of a conversation's blocks, each hashed with its place,
   are combined by exclusive-or into a running 128-bit value, so equal values
   mean equal first blocks. Conversations are grouped by these values, one row a
   block and not one a turn.
2. *Turns.* A block through which all that entered it go on together needs
   nothing more: its turns have the members of its end. Only where siblings part
   (or some end inside) are the turns grouped one by one, below the value with
   which the block was entered. Blocks that a conversation enters alone are never
   grouped.

What the tree adds up follows from three numbers of each conversation, so no
level is walked and no subtree is gathered: ``r``, the depth from which it is the
smallest member of its nodes; ``saved``, the bytes of its turns above ``r``, which
others store; ``leaf``, whether it names the leaf it ends in. A node has as many
leaves as its members have leaf marks. Its subtree's saved bytes are its members'
``saved``, each less what lies above the node (the node's own member counts as
0). Its children are its own next turn and the conversations whose ``r`` is one
deeper below it.

Skew. A conversation may hold a third of all turns: turns are numbered over range
partitions of (conv_id, turn, role, start of the text), blocks are gathered in
runs of ``RUN_BLOCKS``, and running values are carried from run to run by a table
with a row for each. A prefix may belong to a third of all conversations: groups
are counted with partial sums, written, and joined back as plain equi joins,
which Spark splits. The ids of the conversations that end in one node are hashed
as a stream in one task, as SHA-256 over a list has no parallel form; that task
holds one batch at a time.

Defined cases: rows without a conv_id belong to no conversation and are left out;
null turns come first, rows of the same turn follow by role and text; null role or
text is ''; repeated rows are repeated turns; a conversation may be rebuilt to no
turns, and is then a member of the root alone; an empty table has no nodes; other
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import work_path

#: Turns of a block, and blocks whose running values one window works out.
BLOCK_TURNS, RUN_BLOCKS = 4, 1024
#: Rebuilding: conversation c takes the first ``crc32(c) % HEADS`` turns of conversation ``c - c % FAMILY``.
HEADS, FAMILY = 9, 5
#: Characters of a text that range bounds look at.
BOUND_CHARS = 32

NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``part`` and ``i``, the place of a row among those of its conversation in the partition (from 1); rows come sorted."""
    part, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("c").to_numpy()
        first = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        size = np.diff(np.r_[first, len(conv)])
        start = np.zeros(len(first), np.int64)
        if conv[0] == last:
            start[0] = count
        i = np.arange(1, len(conv) + 1) - np.repeat(first - start, size)
        last, count = conv[-1], int(i[-1])
        yield pa.record_batch([batch.column("c"), pa.array([part] * len(conv), pa.int32()), pa.array(i, pa.int64()), batch.column("digest"), batch.column("bytes")], names=["c", "part", "i", "digest", "bytes"])


def number_turns(conversations: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """((c, d, digest, bytes) of every turn, d from 1; (c, turns) of every conversation)."""
    spark = conversations.sparkSession
    rows = conversations.select(F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("t"), *[F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("role", "text")]).where("c is not null")
    order = [F.col("c"), F.col("t").asc_nulls_first(), F.col("role")]
    rows = rows.repartitionByRange(*order, F.substring("text", 1, BOUND_CHARS)).sortWithinPartitions(*order, "text")
    digest = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")))
    rows.select("c", digest.alias("digest"), F.octet_length("text").cast("long").alias("bytes")).mapInArrow(_number, "c long, part int, i long, digest binary, bytes long").write.parquet(path)
    turns = spark.read.schema("c long, part int, i long, digest binary, bytes long").parquet(path)
    # one row for each conversation and range
    sizes = turns.groupBy("c", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("c").orderBy("part")) - F.col("n")
    numbered = turns.join(sizes.select("c", "part", before.alias("before")), ["c", "part"]).select("c", (F.col("i") + F.col("before")).alias("d"), "digest", "bytes")
    return numbered, sizes.groupBy("c").agg(F.sum("n").alias("turns"))


def rebuild(turns: DataFrame, convs: DataFrame, heads: int = HEADS, family: int = FAMILY) -> DataFrame:
    """(c, d, digest, bytes) of the rebuilt conversations that have turns."""
    h = F.crc32(F.col("c").cast("string").cast("binary")) % heads
    own = convs.select("c", "turns", h.alias("h"), (F.col("c") - F.col("c") % family).alias("base"))
    base = convs.select(F.col("c").alias("base"), F.col("turns").alias("base_turns"))
    own = own.join(base, "base", "left").select("c", "base", "h", F.least("h", F.coalesce("base_turns", F.lit(0))).alias("taken"))
    tails = turns.join(own.select("c", "h", "taken"), "c").where("d > h").select("c", (F.col("d") - F.col("h") + F.col("taken")).alias("d"), "digest", "bytes")
    first = turns.where((F.col("c") % family == 0) & (F.col("d") < heads)).select(F.col("c").alias("base"), "d", "digest", "bytes")
    # at most heads - 1 turns of a base, for at most twice as many conversations as a family has
    taken = first.join(own.select("c", "base", "h"), "base").where("d <= h").select("c", "d", "digest", "bytes")
    return tails.unionByName(taken)


def blocks_of(turns: DataFrame, block_turns: int = BLOCK_TURNS, run_blocks: int = RUN_BLOCKS) -> DataFrame:
    """One row for each block: c, j, n, digests, sizes, bytes before it, and the running values on entry (x, y) and after it (x2, y2)."""
    j = F.floor((F.col("d") - 1) / block_turns).cast("long")
    rows = turns.withColumn("j", j).withColumn("run", F.floor(F.col("j") / run_blocks).cast("long")).repartition("c", "run")
    listed = F.array_sort(F.collect_list(F.struct("d", "digest", "bytes")))  # block_turns at most
    rows = rows.groupBy("c", "run", "j").agg(listed.alias("t")).select(
        "c", "run", "j", F.size("t").alias("n"), F.col("t.digest").alias("digests"), F.col("t.bytes").alias("sizes"),
        F.aggregate("t", F.lit(0).cast("long"), lambda a, t: a + t["bytes"]).alias("b"))
    all_ = F.concat_ws(",", F.transform("digests", F.hex))
    rows = rows.withColumn("hx", F.xxhash64("j", all_, F.lit(1))).withColumn("hy", F.xxhash64(F.lit(2), "j", all_))
    runs = rows.groupBy("c", "run").agg(F.bit_xor("hx").alias("rx"), F.bit_xor("hy").alias("ry"), F.sum("b").alias("rb"))
    earlier = Window.partitionBy("c").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    runs = runs.select("c", "run", *[F.coalesce(f(x).over(earlier), zero).alias(x) for f, x in ((F.bit_xor, "rx"), (F.bit_xor, "ry"), (F.sum, "rb"))])
    upto = Window.partitionBy("c", "run").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"wx": F.bit_xor("hx").over(upto), "wy": F.bit_xor("hy").over(upto), "wb": F.sum("b").over(upto)}).join(runs, ["c", "run"])
    x2, y2 = F.col("wx").bitwiseXOR(F.col("rx")), F.col("wy").bitwiseXOR(F.col("ry"))
    return rows.select("c", "j", "n", "digests", "sizes", (F.col("wb") + F.col("rb") - F.col("b")).alias("before"),
                       x2.bitwiseXOR(F.col("hx")).alias("x"), y2.bitwiseXOR(F.col("hy")).alias("y"), x2.alias("x2"), y2.alias("y2"))


def segments(blocks: DataFrame, convs: DataFrame, n_convs: int, smallest: int, path: str, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(c, a, z, n, rep, before, sizes): depths a to z of c, whose nodes have n members, the smallest of them rep."""
    spark, k = blocks.sparkSession, block_turns

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    shared = written(blocks.where(F.col("n") == k).groupBy("j", "x2", "y2").agg(F.count(F.lit(1)).alias("members"), F.min("c").alias("rep")).where("members > 1"), "shared-blocks")
    left = written(blocks.where(F.col("n") == k).select("c", "j", "x2", "y2").join(shared, ["j", "x2", "y2"]).select("c", "j", "members", "rep"), "left")
    entered = left.select("c", (F.col("j") + 1).alias("j"), F.col("members").alias("came"))
    state = blocks.join(left, ["c", "j"], "left").join(entered, ["c", "j"], "left")
    came = F.when(F.col("j") == 0, F.lit(n_convs)).otherwise(F.coalesce("came", F.lit(1)))
    state = written(state.withColumn("came", came).withColumn("parts", (F.col("came") > 1) & ~F.coalesce(F.col("members") == F.col("came"), F.lit(False))), "blocks-entered")

    first = (F.col("j") * k + 1).alias("a")
    whole = state.where("not parts").select("c", first, (F.col("j") * k + F.col("n")).alias("z"), F.when(F.col("came") > 1, F.col("members")).otherwise(F.lit(1)).alias("n"),
                                            F.when(F.col("came") > 1, F.col("rep")).otherwise(F.col("c")).alias("rep"), "before", "sizes")
    # where siblings part: turn by turn, below the value with which the block was entered
    turn = state.where("parts").select("c", "j", "x", "y", "before", "sizes", "digests", F.explode(F.sequence(F.lit(1), "n")).alias("t"))
    key = F.unhex(F.md5(F.concat_ws(",", "x", "y", "j", F.transform(F.slice("digests", F.lit(1), F.col("t")), F.hex))))
    above = F.aggregate(F.slice("sizes", F.lit(1), F.col("t") - 1), F.col("before"), lambda a, b: a + b)
    turn = turn.select("c", (F.col("j") * k + F.col("t")).alias("a"), key.alias("key"), above.alias("before"), F.slice("sizes", F.col("t"), F.lit(1)).alias("sizes"))
    common = written(turn.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("c").alias("rep")).where("members > 1"), "shared-turns")
    single = turn.join(common, "key", "left").select("c", "a", F.col("a").alias("z"), F.coalesce("members", F.lit(1)).alias("n"), F.coalesce("rep", "c").alias("rep"), "before", "sizes")
    none = F.lit(0).cast("long")
    root = convs.select("c", none.alias("a"), none.alias("z"), F.lit(n_convs).cast("long").alias("n"), F.lit(smallest).cast("long").alias("rep"), none.alias("before"), F.array(none).alias("sizes"))
    return written(whole.unionByName(single).unionByName(root), "segments")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, z, ends, sha) of rows sorted by (rep, z, c): SHA-256 of the ids, comma-joined, over batch borders."""
    node, digest, count = None, None, 0

    def told() -> pa.RecordBatch:
        return pa.record_batch([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([count], pa.int64()), pa.array([digest.hexdigest()])], names=["rep", "z", "ends", "sha"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rep, z, c = (batch.column(x).to_numpy() for x in ("rep", "z", "c"))
        edge = np.flatnonzero((rep[1:] != rep[:-1]) | (z[1:] != z[:-1])) + 1
        for a, b in zip(np.r_[0, edge].tolist(), np.r_[edge, len(c)].tolist(), strict=True):
            if node != (at := (int(rep[a]), int(z[a]))):
                if node is not None:
                    yield told()
                node, digest, count = at, hashlib.sha256(), 0
            digest.update((("," if count else "") + ",".join(map(str, c[a:b].tolist()))).encode())
            count += b - a
    if node is not None:
        yield told()


def trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS, run_blocks: int = RUN_BLOCKS) -> DataFrame:
    """One row for each node of the rebuilt conversations (columns ``NODES``)."""
    spark = conversations.sparkSession
    path = work_path(spark, "trie")
    turns, convs = number_turns(conversations, f"{path}/turns")
    convs.write.parquet(f"{path}/convs")
    convs = spark.read.parquet(f"{path}/convs")
    root = convs.agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).first()
    if not root["n"]:
        return spark.createDataFrame([], NODES)
    blocks_of(rebuild(turns, convs), block_turns, run_blocks).write.parquet(f"{path}/blocks")
    seg = segments(spark.read.parquet(f"{path}/blocks"), convs, root["n"], root["c"], path, block_turns)

    mine, end = F.col("rep") == F.col("c"), F.col("before") + F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)
    own = seg.groupBy("c").agg(
        F.max("z").alias("len"), F.min(F.when(mine, F.col("a"))).alias("r"), F.max_by(F.when(~mine, F.col("rep")), F.when(~mine, F.col("z"))).alias("q"),
        F.coalesce(F.max_by(F.when(~mine, end), F.when(~mine, F.col("z"))), F.lit(0)).alias("saved"), F.max_by("rep", "z").alias("end"), F.max_by("n", "z").alias("end_n"))
    own.write.parquet(f"{path}/own")
    own = spark.read.parquet(f"{path}/own")
    ended = own.where("end_n > 1").select(F.col("end").alias("rep"), F.col("len").alias("z"), "c").repartition("rep", "z").sortWithinPartitions("rep", "z", "c")
    ended.mapInArrow(_ends, "rep long, z long, ends long, sha string").write.parquet(f"{path}/ends")
    ends = spark.read.schema("rep long, z long, ends long, sha string").parquet(f"{path}/ends")

    # a conversation names a leaf if all members of the node it ends in end there, and it is the smallest
    marks = own.join(ends.select(F.col("rep").alias("c"), F.col("z").alias("len"), "ends"), ["c", "len"], "left")
    leaf = ((F.col("end_n") == 1) | ((F.col("end") == F.col("c")) & F.coalesce(F.col("ends") == F.col("end_n"), F.lit(False)))).cast("long")
    marks = marks.select("c", "saved", leaf.alias("leaf"))
    branches = own.where("r > 0").groupBy(F.col("q").alias("rep"), (F.col("r") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("branches"))

    names = own.select(F.col("c").alias("rep"), "len", "r", "q", F.col("saved").alias("rep_saved"))
    parent = F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") > F.col("r"), F.col("rep")).otherwise(F.col("q"))
    goes_on = (F.col("len") > F.col("depth")).cast("long")
    # nodes of several members: their marks added up, one row for each run of depths
    nodes = seg.where("n > 1").join(marks, "c").groupBy("rep", "a", "z", "n").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"), F.max("before").alias("before"), F.max("sizes").alias("sizes"))
    nodes = nodes.join(names, "rep").withColumn("t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("z") - F.col("a")))).withColumn("depth", F.col("a") + F.col("t"))
    above = F.aggregate(F.slice("sizes", F.lit(1), F.col("t").cast("int")), F.col("before"), lambda a, b: a + b)
    nodes = nodes.withColumn("above", above).join(branches, ["rep", "depth"], "left").join(ends.select("rep", F.col("z").alias("depth"), "sha"), ["rep", "depth"], "left")
    shared = nodes.select(
        F.col("rep").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.col("n").alias("n_convs"), (goes_on + F.coalesce("branches", F.lit(0))).alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("saved") - F.col("rep_saved") - (F.col("n") - 1) * F.col("above")).alias("saved_tokens"), F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"))
    # nodes of one conversation
    alone = seg.where("n = 1").select("rep", "a", "z").join(names, "rep").withColumn("depth", F.explode(F.sequence("a", "z")))
    one = F.lit(1).cast("long")
    alone = alone.select(F.col("rep").alias("conv_id"), "depth", parent.alias("parent_conv_id"), one.alias("n_convs"), goes_on.alias("n_children"), one.alias("n_leaves"),
                         F.lit(0).cast("long").alias("saved_tokens"), F.when(goes_on == 1, F.lit(EMPTY_SHA)).otherwise(F.sha2(F.col("rep").cast("string").cast("binary"), 256)).alias("ends_sha256"))
    return shared.unionByName(alone)
