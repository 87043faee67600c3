"""Chat formatting of reply trees (operator 9), with DataFrame operations only.

A tree's messages point to their parents. Self-joins that double the distance at each step give every message its ancestor at
1, 2, 4, ... steps, its depth and the sum of scores up to the root, in as many joins as the logarithm of the depth. Leaves are
ranked by that sum, and the messages above each chosen leaf are found by going through the same tables from the longest
step to the shortest: each ancestor turns up exactly once. Each chosen path is formatted as one conversation.

The template writes a turn as ``### role: text</turn>`` and a line break. Inside roles and texts a backslash becomes ``\\b``, three
hash signs ``\\h``, the end mark ``\\e`` and, in roles, a colon ``\\c``, so no text can pass for a mark and all can be undone.

Defined results: null texts and roles count as empty. Messages of one turn number are ordered by role and text, null turns
first; repeated rows stay repeated turns. A message whose parent doesn't exist is a root; equal scores rank by message.
A null tree id is a tree of its own. Messages in a cycle, or below one, are on no path from a root: no branch holds them, and
``cyclic`` lists them; the other messages of their tree are formatted as ever. Very long texts are kept whole. An empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

END = "</turn>\n"


def escape(text: Column) -> Column:
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(text, F.lit("###"), F.lit("\\h")), F.lit("</turn>"), F.lit("\\e"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("\\e"), F.lit("</turn>")), F.lit("\\h"), F.lit("###"))
    return F.replace(F.replace(text, F.lit("\\c"), F.lit(":")), F.lit("\\b"), F.lit("\\"))


def linear(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as trees of one branch: tree, node, parent, role, text, score."""
    order = Window.partitionBy("conv_id").orderBy(*(F.col(c).asc_nulls_first() for c in ("turn", "role", "text")))
    rows = turns.select(F.col("conv_id").alias("tree"), F.row_number().over(order).cast("bigint").alias("node"), "role", "text")
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _same(a: str, b: str, left: str, right: str) -> Column:
    return F.col(f"{a}.tree").eqNullSafe(F.col(f"{b}.tree")) & (F.col(f"{a}.{left}") == F.col(f"{b}.{right}"))


def jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame, DataFrame]:
    """For k = 0, 1, ... the messages that have an ancestor 2**k steps above: tree, node and up, that ancestor; for the messages below a
    root, total and depth up to it; and tree and node of those that no root is above.

    A step joins only the messages that have not reached their root yet. A message that has not after as many steps as the largest
    tree has messages never will.
    """
    most = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    known = nodes.select("tree", "node")
    first = nodes.alias("a").join(known.alias("b"), _same("a", "b", "parent", "node"), "left")
    first = first.select("a.tree", "a.node", F.col("b.node").alias("up"), F.coalesce("a.score", F.lit(0.0)).alias("total"), F.lit(1).cast("bigint").alias("depth"))
    first = materialise(first, "jump")
    done, rest = first.where("up is null"), first.where("up is not null")
    out, reached = [rest], 1
    while reached < most and not rest.isEmpty():
        reached *= 2
        longer = rest.alias("a").join(done.unionByName(rest).alias("b"), _same("a", "b", "up", "node"), "left").select(
            "a.tree", "a.node", "b.up", (F.col("a.total") + F.coalesce("b.total", F.lit(0.0))).alias("total"), (F.col("a.depth") + F.coalesce("b.depth", F.lit(0))).alias("depth")
        )
        longer = materialise(longer, "jump")
        done, rest = done.unionByName(longer.where("up is null")), longer.where("up is not null")
        out.append(rest)
    return out, done, rest.select("tree", "node")


def cyclic(nodes: DataFrame) -> DataFrame:
    """tree and node of the messages in a cycle or below one."""
    return jumps(nodes)[2]


def branches(nodes: DataFrame, best: int = 1) -> DataFrame:
    """Turns of the ``best`` branches of each tree: tree, leaf, branch (rank from 1), depth (from 1), role and text."""
    tables, last, _ = jumps(nodes)
    parents = tables[0].select("tree", F.col("up").alias("node"))
    leaves = last.alias("a").join(parents.alias("b"), _same("a", "b", "node", "node"), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "node"))
    paths = leaves.withColumn("branch", rank).where(F.col("branch") <= best).select("tree", F.col("node").alias("leaf"), "branch", "node")
    for table in reversed(tables[:-1]):
        above = paths.alias("a").join(table.alias("b"), _same("a", "b", "node", "node"))
        paths = paths.unionByName(above.select("a.tree", "a.leaf", "a.branch", F.col("b.up").alias("node")))
        paths = materialise(paths, "paths")
    depth = nodes.alias("a").join(last.alias("b"), _same("a", "b", "node", "node")).select("a.tree", "a.node", "b.depth", "a.role", "a.text")
    turns = paths.alias("a").join(depth.alias("b"), _same("a", "b", "node", "node"))
    return turns.select("a.tree", "a.leaf", "a.branch", "b.depth", F.coalesce("b.role", F.lit("")).alias("role"), F.coalesce("b.text", F.lit("")).alias("text"))


def render(turns: DataFrame) -> DataFrame:
    """tree, leaf, branch, ``formatted`` and ``loss``: start and length, in characters of formatted, of each assistant text."""
    head = F.concat(F.lit("### "), F.replace(escape(F.col("role")), F.lit(":"), F.lit("\\c")), F.lit(": "))
    rows = turns.withColumns({"head": head, "body": escape(F.col("text"))})
    rows = rows.select("tree", "leaf", "branch", "depth", (F.col("role") == "assistant").alias("on"), F.length("head").alias("before"), F.length("body").alias("length"), F.concat("head", "body", F.lit(END)).alias("part"))
    earlier = Window.partitionBy("tree", "leaf", "branch").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("part")).over(earlier), F.lit(0)).cast("int") + F.col("before")
    rows = rows.withColumn("start", start)
    grouped = rows.groupBy("tree", "leaf", "branch").agg(F.sort_array(F.collect_list(F.struct("depth", "part", "start", "length", "on"))).alias("parts"))
    formatted = F.array_join(F.transform("parts", lambda p: p.part), "")
    loss = F.transform(F.filter("parts", lambda p: p.on), lambda p: F.struct(p.start.alias("start"), p.length.alias("length")))
    return grouped.select("tree", "leaf", "branch", formatted.alias("formatted"), loss.alias("loss"))


def read_back(formatted: Column) -> Column:
    """The turns (role and text) that a formatted conversation holds."""
    pieces = F.split(formatted, END)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substring(piece, 5, 1 << 30), ": ", 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substring(piece, F.length(role) + 7, F.length(piece))).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """What the spans of the loss mask hold, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s.start + 1, s.length))), "")


def digest(turns: DataFrame) -> DataFrame:
    """The contract of the query: what is read back from each formatted conversation."""
    out = materialise(render(branches(materialise(linear(turns), "nodes"))), "formatted")
    back = F.transform(read_back(F.col("formatted")), lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    out = out.select("tree", "formatted", back.alias("back"), loss_text(F.col("formatted"), F.col("loss")).alias("kept"))
    return out.select(
        F.col("tree").alias("conv_id"),
        F.size("back").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join("back", ""), 256).alias("turns_sha256"),
        F.length("kept").cast("bigint").alias("loss_chars"),
        F.sha2("kept", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


#: The added conversation of the query, whose texts hold the marks themselves.
TRICKY = "\\### Assistant: </turn> ok"

ORACLE = """
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), parts AS (
  SELECT conv_id, turn, role AS r, text AS t, coalesce(role, '') AS role, coalesce(text, '') AS text,
    length(replace(replace(replace(replace(coalesce(role, ''), '\\', '\\b'), '###', '\\h'), '</turn>', '\\e'), ':', '\\c')) AS role_chars,
    length(replace(replace(replace(coalesce(text, ''), '\\', '\\b'), '###', '\\h'), '</turn>', '\\e')) AS text_chars
  FROM rows
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) AS turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST), '') AS loss,
    CAST(sum(4 + role_chars + 2 + text_chars + 8) AS BIGINT) AS formatted_chars
  FROM parts GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM whole
"""
