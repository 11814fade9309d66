"""Conversation prefix trie by mergeable partial tries.

A node is a distinct sequence of first turns (role, text); it is known by its depth and two 64-bit hashes, each the XOR of the
hashes of (position, turn) so far, so a parent's hashes come from a child's by one XOR. Every partition emits a locally combined
table of its nodes; tables are merged in groups of FAN, round after round, by a hash of the node, and a merge sums members and
keeps the smallest one. The end lists (conversations that end at a node) are merged as sorted runs: pieces of at most
PIECE bytes are joined where the rows lie, and a node's SHA-256 reads its pieces in order, one at a time.

The rollup goes bottom-up along conversations: a node is owned by its smallest member, so a conversation owns the nodes of its
path from some depth on. Running sums from the last turn give each owned node's subtree within its owner; the total of an owner
is then added to each ancestor above its first owned node. So no round is needed for each level, and exact copies, which own
nothing, add nothing. Running values are taken within blocks of BLOCK turns and then over blocks, so that a conversation with a
large part of all turns is many tasks.

Defined cases. Turns are ordered by turn (null first), role, text; repeated rows are turns each. Null role or text: empty, and
equal to an empty one. Rows without a conv_id belong to no conversation. Remainders are never negative, also of negative ids.
Very long texts are hashed and counted whole, and shuffled once. Empty table: no node, not even the root. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraline.llm import common

FAN, PIECE, BLOCK = 16, 1 << 16, 1 << 16
HEADS, FAMILY = 4, 20  # the contract's h is below HEADS, and families have FAMILY ids
WORDS = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "x", "y"]


def running(rows: DataFrame, key: str, order: str, block: str, values: dict[str, str], backwards: bool = False) -> DataFrame:
    """Each column of values becomes its running aggregate (bit_xor or sum) within the key, along the order. block: a column that cuts a key's rows into stretches along the order."""
    merge = {"bit_xor": lambda a, b: a.bitwiseXOR(b), "sum": lambda a, b: a + b}
    along, over = (F.col(c).desc() if backwards else F.col(c).asc() for c in (order, block))
    local = Window.partitionBy(key, block).orderBy(along).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumns({c: F.expr(f"{f}({c})").over(local) for c, f in values.items()})
    totals = rows.groupBy(key, block).agg(*[F.expr(f"{f}({c})").alias(f"__{c}") for c, f in values.items()])
    before = Window.partitionBy(key).orderBy(over).rowsBetween(Window.unboundedPreceding, -1)
    earlier = totals.withColumns({f"__{c}": F.expr(f"{f}(__{c})").over(before) for c, f in values.items()}).where(F.coalesce(*[F.col(f"__{c}") for c in values]).isNotNull())
    joined = inside.join(earlier, [key, block], "left")
    return joined.withColumns({c: merge[f](F.col(c), F.coalesce(F.col(f"__{c}"), F.lit(0).cast("long"))) for c, f in values.items()}).drop(*[f"__{c}" for c in values])


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """conv_id, pos (from 0), the turn's hashes a, b and its words; conv_id and n_turns of each conversation."""
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    dealt = rows.repartitionByRange("conv_id", "turn", F.substring("role", 1, 64)).sortWithinPartitions("conv_id", "turn", "role", "text")
    hashed = dealt.select(
        "conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq"),
        F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(11), "text", F.lit(7), "role").alias("b"), F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"),
    )
    turns, _ = common.materialize(hashed, "trie-turns")
    spans = turns.groupBy("conv_id", "part").agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("conv_id")
    spans = spans.select("conv_id", "part", (F.col("first") - F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("zero"), F.sum("n").over(whole).alias("n_turns"))
    placed = turns.join(spans.select("conv_id", "part", "zero"), ["conv_id", "part"]).select("conv_id", (F.col("seq") - F.col("zero")).alias("pos"), "a", "b", "words")
    return placed, spans.select("conv_id", "n_turns").distinct()


def rebuilt(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c with the first crc32(c) % HEADS turns of conversation c - c % FAMILY in place of its own."""
    first = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))
    plan = lengths.select("conv_id", "n_turns", first.alias("base"), F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)).alias("h"))
    heads = lengths.where(F.pmod("conv_id", F.lit(FAMILY)) == 0).select(F.col("conv_id").alias("base"), F.col("n_turns").alias("has"))
    plan = plan.join(heads, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("k"), "n_turns")
    own = turns.join(plan, "conv_id").where(F.col("pos") >= F.col("h")).select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "a", "b", "words")
    lent = turns.where((F.col("pos") < HEADS - 1) & (F.pmod("conv_id", F.lit(FAMILY)) == 0)).withColumnRenamed("conv_id", "base").join(plan, "base").where(F.col("pos") < F.col("k"))
    return own.unionByName(lent.select("conv_id", "pos", "a", "b", "words")), plan.select("conv_id", (F.col("k") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("n_turns"))


def members(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row for each conversation and node on its path: conv_id, the node and its parent's hashes, the words of its last text, whether the conversation ends there."""
    at = turns.withColumns({"depth": F.col("pos") + 1, "block": F.floor(F.col("pos") / BLOCK)})
    at = at.select("conv_id", "depth", "block", "words", F.xxhash64("depth", "a", "b").alias("x"), F.xxhash64(F.lit(5), "b", "depth", "a").alias("y")).withColumns({"u": F.col("x"), "v": F.col("y")})
    path = running(at, "conv_id", "depth", "block", {"x": "bit_xor", "y": "bit_xor"})
    path = path.join(lengths, "conv_id").select("conv_id", "depth", "x", "y", F.col("x").bitwiseXOR(F.col("u")).alias("px"), F.col("y").bitwiseXOR(F.col("v")).alias("py"), "words", (F.col("depth") == F.col("n_turns")).alias("ends"))
    zero = F.lit(0).cast("long")
    root = lengths.select("conv_id", zero.alias("depth"), zero.alias("x"), zero.alias("y"), zero.alias("px"), zero.alias("py"), zero.alias("words"), (F.col("n_turns") == 0).alias("ends"))
    return path.unionByName(root)


def merged_tables(rows: DataFrame, key: list[str], aggregates: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Each partition's locally combined table, then tables merged FAN by FAN. aggregates: name -> (over rows, over merged rows)."""
    left = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    table, first = rows.withColumn("__group", F.spark_partition_id()), True
    while left > 1:
        left = -(-left // FAN)
        group = [F.floor(F.col("__group") / FAN).alias("__group")] if left > 1 else []
        table = table.groupBy(*group, *key).agg(*[pair[not first].alias(c) for c, pair in aggregates.items()])
        first = False
    return table


def joined_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, x, y, conv_id) to pieces of a node's comma-joined ids, each with its first id."""
    node, first, ids, size, out = None, None, [], 0, []

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64()] * 4 + [pa.string()], strict=True)], names=[*NODE, "first", "piece"])

    for batch in batches:
        for *at, conv in zip(*(batch.column(c).to_pylist() for c in [*NODE, "conv_id"]), strict=True):
            if at != node or size > PIECE:
                if ids:
                    out.append((*node, first, ",".join(ids)))
                node, first, ids, size = at, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
            if len(out) >= 4096 or out and len(out[-1][4]) > PIECE // 2:
                yield rows()
                out = []
    if ids:
        out.append((*node, first, ",".join(ids)))
    if out:
        yield rows()


def hashed_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one SHA-256 a node; only the state of the present node is held."""
    node, state = None, None
    for batch in batches:
        out = []
        for *at, piece in zip(*(batch.column(c).to_pylist() for c in [*NODE, "piece"]), strict=True):
            if at == node:
                state.update(b",")
            else:
                if node:
                    out.append((*node, state.hexdigest()))
                node, state = at, hashlib.sha256()
            state.update(piece.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=[*NODE, "ends_sha256"])
    if node:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, state.hexdigest())], names=[*NODE, "ends_sha256"])


def end_hashes(rows: DataFrame) -> DataFrame:
    """The SHA-256 of the ids, ascending and comma-joined, of the conversations that end at each node."""
    ends = rows.where("ends").select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    pieces = ends.mapInArrow(joined_pieces, "depth long, x long, y long, first long, piece string")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(hashed_pieces, "depth long, x long, y long, ends_sha256 string")


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row for each node of the trie over conversations given as ordered_turns() returns them."""
    spark = turns.sparkSession
    common.ship(spark)
    rows, rows_path = common.materialize(members(turns, lengths), "trie-members")
    same = {c: (F.max(c), F.max(c)) for c in ("px", "py", "words")}
    nodes, nodes_path = common.materialize(merged_tables(rows, NODE, {"n_convs": (F.count("*"), F.sum("n_convs")), "owner": (F.min("conv_id"), F.min("owner"))} | same), "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    own = nodes.withColumns({"block": F.floor(F.col("depth") / BLOCK), "n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")})
    own, own_path = common.materialize(running(own, "owner", "depth", "block", {"n_leaves": "sum", "saved_tokens": "sum"}, backwards=True).drop("block"), "trie-own")
    branch = own.groupBy("owner").agg(F.min("depth").alias("top"), F.max("n_leaves").alias("n_leaves"), F.max("saved_tokens").alias("saved_tokens"))  # the sums at the top hold the others
    above = rows.join(branch.withColumnRenamed("owner", "conv_id"), "conv_id").where(F.col("depth") < F.col("top"))
    sums = merged_tables(above, NODE, {"leaves_below": (F.sum("n_leaves"), F.sum("leaves_below")), "saved_below": (F.sum("saved_tokens"), F.sum("saved_below"))})
    at = {c: F.col(c) for c in ("depth", "px", "py")}
    heads = own.join(branch.select("owner", F.col("top").alias("depth")), ["owner", "depth"]).where("depth > 1").select("owner", (at["depth"] - 1).alias("depth"), at["px"].alias("x"), at["py"].alias("y"))
    parents = heads.join(own.select(*NODE, F.col("owner").alias("parent")), NODE).select("owner", (F.col("depth") + 1).alias("depth"), "parent")
    least = lengths.agg(F.min("conv_id").alias("least"))  # one row: the root's owner
    found = own.join(parents, ["owner", "depth"], "left").join(sums, NODE, "left").join(end_hashes(rows), NODE, "left").crossJoin(F.broadcast(least))
    parent = F.when(F.col("depth") == 1, F.col("least")).when(F.col("depth") > 1, F.coalesce("parent", "owner"))
    zero = F.lit(0).cast("long")
    return found.select(
        F.col("owner").alias("conv_id"), "depth", parent.alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("n_leaves") + F.coalesce("leaves_below", zero)).alias("n_leaves"), (F.col("saved_tokens") + F.coalesce("saved_below", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    turns, lengths = rebuilt(*ordered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return trie(turns, lengths)


#: crc32 by its definition: the 256 remainders of the reversed polynomial 0xEDB88320, then a step for each digit.
ORACLE_SQL = r"""
WITH crc AS MATERIALIZED (SELECT list(t ORDER BY i) AS tab FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384 ELSE 0 END)) AS t FROM (SELECT unnest(range(0, 256)) AS i))),
r AS MATERIALIZED (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
lens AS (SELECT c, count(*) AS n, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda s: ord(s)::BIGINT)), lambda v, b: xor(v >> 8, any_value(tab)[(xor(v, b) & 255) + 1])), 4294967295) % 4 AS h FROM r, crc GROUP BY c),
plan AS (SELECT l.c, l.n, l.h, l.c - l.c % 20 AS base, least(l.h, coalesce(b.n, 0)) AS k FROM lens l LEFT JOIN lens b ON b.c = l.c - l.c % 20),
built AS (SELECT r.c, p - h + k AS p, role, text FROM r JOIN plan USING (c) WHERE p >= h UNION ALL SELECT plan.c, p, role, text FROM plan JOIN r ON r.c = plan.base WHERE p < k),
paths AS MATERIALIZED (SELECT c, 0 AS d, [] :: STRUCT(r VARCHAR, t VARCHAR)[] AS path, NULL AS text FROM plan
  UNION ALL SELECT c, p + 1, list(struct_pack(r := role, t := text)) OVER (PARTITION BY c ORDER BY p), text FROM built),
node AS MATERIALIZED (SELECT d, path, min(c) AS conv_id, count(*) AS n_convs, len(regexp_extract_all(coalesce(any_value(text), ''), '[^\x20\x09-\x0D]+')) AS words FROM paths GROUP BY d, path),
leaf AS MATERIALIZED (SELECT node.*, coalesce(k.n, 0) AS n_children FROM node LEFT JOIN (SELECT d - 1 AS d, path[1:d - 1] AS path, count(*) AS n FROM node WHERE d > 0 GROUP BY 1, 2) k ON k.d = node.d AND k.path = node.path),
sub AS (SELECT a AS d, path[1:a] AS path, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens FROM (SELECT leaf.*, unnest(range(0, d + 1)) AS a FROM leaf) GROUP BY 1, 2),
ends AS (SELECT d, path, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM (SELECT c, max(d) AS d, arg_max(path, d) AS path FROM paths GROUP BY c) GROUP BY d, path)
SELECT leaf.conv_id, leaf.d::BIGINT AS depth, up.conv_id AS parent_conv_id, leaf.n_convs, leaf.n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM leaf JOIN sub ON sub.d = leaf.d AND sub.path = leaf.path LEFT JOIN leaf up ON up.d = leaf.d - 1 AND up.path = leaf.path[1:leaf.d - 1] LEFT JOIN ends ON ends.d = leaf.d AND ends.path = leaf.path
"""
