r"""Chat formatting of reply trees, in DataFrame operations alone.

Messages form trees by their parent. Iterative self-joins enumerate the root-to-leaf paths: every
round joins the table with itself and doubles how far up each message points, so a tree of depth d
takes log2(d) rounds, which add up the scores on the way. Branches (leaves) are ranked by the mean
score of their path, the best `top` of a tree are chosen, and the stored rounds, largest first, give
the messages of each chosen path. Each path becomes one conversation.

Template, for each turn:  <|start|>ROLE\nTEXT<|end|>\n
Control strings (CONTROLS) inside texts and roles are escaped reversibly: each backslash is doubled,
then a backslash is put behind the first character of each control string; in roles a line feed
becomes \n. `loss` marks each assistant text by turn, start and length (code points, inside the turn).

Defined cases: null text or role is empty; a parent that is not in the tree makes its message a root;
messages on a cycle, or below one, have no path and are left out; of messages with one id in a tree
one row stays; equal scores go by the smaller leaf id; several roots are branches of one tree; null
tree ids are one tree; an empty table gives none; extra columns are not carried.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedlake.llm.common import stored, table

START, END = "<|start|>", "<|end|>\n"
CONTROLS = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    piece = F.transform(F.split(role, r"\\\\"), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\"), F.lit("")))
    return F.array_join(piece, "\\")


def branch_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """messages(tree, node, parent, score) -> (tree, leaf, rank, node, depth): the messages on the best
    `top` root-to-leaf paths of each tree, with their distance from the root."""
    nodes = stored(messages.groupBy("tree", "node").agg(F.min(F.struct("parent", "score")).alias("m")).select("tree", "node", "m.parent", F.coalesce("m.score", F.lit(0.0)).alias("score")), "chat-nodes")
    known = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    now = nodes.join(known, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("n")), "left").select(
        "tree", "node", F.col("n").alias("up"), F.when(F.col("n").isNull(), 0).otherwise(1).cast("long").alias("depth"), F.col("score").alias("total"))
    now, rounds, most = stored(now, "chat-up"), [], math.ceil(math.log2(max(2, nodes.count()))) + 1
    done, rest = [now.where("up is null")], now.where("up is not null")  # rest: what does not know its root yet
    while len(rounds) <= most and not rest.isEmpty():
        rounds.append(rest.select("tree", "node", "up"))
        above = reduce(DataFrame.unionByName, [*done, rest]).select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("up2"), F.col("depth").alias("d2"), F.col("total").alias("total2"))
        joined = rest.join(above, F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n")))
        now = stored(joined.select("tree", "node", F.col("up2").alias("up"), (F.col("depth") + F.col("d2")).alias("depth"), (F.col("total") + F.col("total2")).alias("total")), "chat-up")
        done, rest = [*done, now.where("up is null")], now.where("up is not null")
    rooted = reduce(DataFrame.unionByName, done)  # all but what hangs on a cycle
    inner = nodes.select(F.col("tree").alias("t"), F.col("parent").alias("n")).where("n is not null").distinct()
    leaves = rooted.join(inner, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left_anti")
    order = Window.partitionBy("tree").orderBy((F.col("total") / (F.col("depth") + 1)).desc(), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    on = stored(chosen.select("tree", F.col("node").alias("leaf"), "rank", "node"), "chat-chosen")
    for jump in reversed(rounds):
        far = jump.select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        more = on.join(far, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select("tree", "leaf", "rank", F.col("up").alias("node"))
        on = stored(on.unionByName(more), "chat-on")
    depth = rooted.select(F.col("tree").alias("t"), F.col("node").alias("n"), "depth")
    return on.join(depth, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select("tree", "leaf", "rank", "node", "depth")


def formatted(messages: DataFrame, top: int = 1, loss_role: str = "assistant") -> DataFrame:
    """messages(tree, node, parent, score, role, text) -> (tree, leaf, rank, formatted, loss): a conversation
    for each chosen path; loss is an array of (turn, start, length)."""
    one = F.min(F.struct("parent", "score", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("m")
    texts = messages.groupBy(F.col("tree").alias("t"), F.col("node").alias("n")).agg(one).select("t", "n", "m.role", "m.text")
    turns = branch_paths(messages.select("tree", "node", "parent", "score"), top).join(texts, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
    turns = turns.select("tree", "leaf", "rank", F.struct("depth", (F.col("role") == loss_role).alias("counts"), F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n")).alias("head"), escaped(F.col("text")).alias("body")).alias("turn"))
    whole = turns.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    text = F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "")
    spans = F.transform("turns", lambda x, i: F.struct(i.alias("turn"), (F.length(x["head"]) + 1).alias("start"), F.length(x["body"]).alias("length"), x["counts"].alias("counts")))
    loss = F.transform(F.filter(spans, lambda s: s["counts"]), lambda s: F.struct(s["turn"].alias("turn"), s["start"].alias("start"), s["length"].alias("length")))
    return whole.select("tree", "leaf", "rank", text.alias("formatted"), loss.alias("loss"))


def read_back(conversations: DataFrame) -> DataFrame:
    """formatted() -> its turns again, as (role, text), and what the loss mask covers, unescaped."""
    parts = F.split("formatted", r"<\|end\|>\n")
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    found = conversations.withColumn("parts", parts)
    body = lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p))
    turns = F.transform("parts", lambda p: F.struct(unescaped_role(F.substring_index(body(p), "\n", 1)).alias("role"),
                                                    unescaped(F.substring(body(p), F.instr(body(p), "\n") + 1, F.length(p))).alias("text")))
    covered = F.transform("loss", lambda s: unescaped(F.substring(F.get("parts", s["turn"]), s["start"], s["length"])))
    return found.withColumn("turns", turns).withColumn("covered", F.array_join(covered, "")).drop("parts")


def op3_chat(spark, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    # a linear conversation is a tree of one branch: each turn replies to the one before
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    messages = rows.select(F.col("conv_id").alias("tree"), place.alias("node"), "role", "text").withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(1.0))
    written = stored(formatted(stored(messages, "chat-messages")), "chat-formatted")
    back = read_back(written)
    all_turns = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(all_turns.cast("binary"), 256).alias("turns_sha256"), F.length("covered").cast("long").alias("loss_chars"),
                       F.sha2(F.col("covered").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def _sql_escaped(x: str) -> str:
    out = f"replace({x}, '\\', '\\\\')"
    for c in CONTROLS:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


OP3_SQL = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
per AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS covered,
         sum({len(START) + 1 + len(END)} + length(replace({_sql_escaped('role')}, chr(10), '\\n')) + length({_sql_escaped('text')})) AS n
  FROM said GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(covered) AS BIGINT) AS loss_chars, sha256(covered) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars FROM per
"""
