"""Chat formatting with cumulative-snapshot collapse. DataFrame functions only.

Logged conversations are often snapshots: the same conversation again with more turns. A turn's hash covers its position, role
and text; the sum of a conversation's turn hashes up to a turn identifies that prefix (two 64-bit hashes, summed exactly as
decimals). Equal conversations keep the smallest id, after a partial aggregate; a conversation whose whole is a proper prefix
of another one is dropped by an anti-join against the distinct proper prefixes. What is left is rendered, turn after turn, as

    <|im_start|>role
    text<|im_end|>

and a marker inside a text gets a blank after its `<|`, so that it can't end a turn.

Defined cases. Turns are ordered by turn, role, text (nulls first). Exactly repeated turn rows count once; different rows of
one turn number are turns one after another. Null role or text: empty, and equal to an empty one. Very long texts and conversations are rendered whole. Null conv_id: one
conversation without an id, which loses against equal ones that have one. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def _escaped(c: Column) -> Column:
    for mark in (START, END):
        c = F.replace(c, F.lit(mark), F.lit(mark.replace("<|", "<| ")))
    return c


def collapse_and_render(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns and rendered for every maximal conversation."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates()
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = rows.select("conv_id", "role", "text", F.row_number().over(ordered).alias("pos"))
    so_far = Window.partitionBy("conv_id").orderBy("pos")
    hashed = placed.select("conv_id", "pos", F.xxhash64("pos", "role", "text").cast("decimal(20,0)").alias("x"), F.xxhash64(F.lit(11), "text", "role", "pos").cast("decimal(20,0)").alias("y"))
    prefixes = hashed.select("conv_id", "pos", F.sum("x").over(so_far).alias("x"), F.sum("y").over(so_far).alias("y"), F.lead("pos").over(so_far).isNull().alias("whole"))
    distinct = prefixes.where("whole").groupBy("pos", "x", "y").agg(F.min("conv_id").alias("conv_id"))
    proper = prefixes.where("not whole").select("pos", "x", "y").distinct()
    kept = distinct.join(proper, ["pos", "x", "y"], "left_anti").select(F.col("conv_id").alias("kept_id"), F.col("pos").alias("n_turns"))
    said = placed.select("conv_id", "pos", F.concat(F.lit(START), _escaped(F.col("role")), F.lit("\n"), _escaped(F.col("text")), F.lit(END)).alias("said"))
    whole = said.join(kept, said["conv_id"].eqNullSafe(kept["kept_id"])).groupBy("conv_id", "n_turns").agg(F.array_sort(F.collect_list(F.struct("pos", "said"))).alias("turns"))
    return whole.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", lambda t: t["said"]), "\n").alias("rendered"))


def op2_chat(spark, sf_dir: str) -> DataFrame:
    return collapse_and_render(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE_SQL = """
WITH rows AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
placed AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM rows),
whole AS (SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY pos) AS turns, count(*) AS n FROM placed GROUP BY conv_id),
one AS (SELECT min(conv_id) AS conv_id, turns, n FROM whole GROUP BY turns, n),
proper AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, n)) AS k FROM one)),
kept AS (SELECT conv_id, n FROM one WHERE NOT EXISTS (SELECT 1 FROM proper WHERE proper.turns = one.turns))
SELECT kept.conv_id AS conv_id, kept.n AS n_turns, string_agg('<|im_start|>' || replace(replace(role, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') || chr(10)
  || replace(replace(text, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') || '<|im_end|>', chr(10) ORDER BY pos) AS rendered
FROM kept JOIN placed ON placed.conv_id = kept.conv_id GROUP BY kept.conv_id, kept.n
"""
