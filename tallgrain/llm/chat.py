"""Chat formatting: reply trees cut into root-to-leaf paths, each one conversation.

Messages name the message they answer.  Iterative self-joins double the reach of every message:
after round n it knows its ancestor 2^n steps up and the sum of scores on the way, so a thread of
a thousand turns takes ten joins of ids and numbers, without any text.  The leaves' sums rank the
branches of a tree; the chosen leaves then mark their ancestors by the same doubled steps, and the
marked messages, with their texts, make one formatted conversation a path.

A formatted conversation is a list of segments, each with its loss flag; joined they are the text.
Control strings inside a role or text are escaped, reversibly:

    [BOS] ( [TURN] role [SAYS] text [END] ) *        loss: the text of assistant turns
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BEGIN, TURN, SAYS, END = "<s>", "[INST]", "[/INST]", "</s>"
#: What stands for each string inside a text.  The backslash comes first when escaping and last
#: when reading back, so that every backslash in an escaped text begins one of these.
ESCAPES = (("\\", "\\b"), (BEGIN, "\\s"), (TURN, "\\i"), (SAYS, "\\j"), (END, "\\e"))


def escape(text: Column) -> Column:
    """``text`` without control strings."""
    for raw, short in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(short))
    return text


def unescape(text: Column) -> Column:
    """What ``escape`` was given."""
    for raw, short in reversed(ESCAPES):
        text = F.replace(text, F.lit(short), F.lit(raw))
    return text


def thread(messages: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(tree, node, parent, score): messages in turn order, each answering the one before.

    Turns that tie are put in order by role and text.  The score counts turns, so the whole thread
    is the best path.  Rows without a conversation form one of their own.  Repeated rows are turns
    of their own; an empty table gives no rows.  Columns other than conversation, turn, role and
    text are left out, so their names can't clash.
    """
    messages = messages.select(*dict.fromkeys([conv, turn, "role", "text"]))
    order = Window.partitionBy(conv).orderBy(turn, "role", "text")
    node = F.row_number().over(order).cast("long")
    return (
        messages.withColumn("node", node)
        .withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
        .withColumn("score", F.lit(1.0))
        .withColumnRenamed(conv, "tree")
    )


def paths(messages: DataFrame, best: int = 1, label: str = "chat") -> DataFrame:
    """(tree, path, node, depth): the messages of the ``best`` branches of each tree.

    ``messages`` has tree, node, parent, score.  A branch runs from a root (no parent, or one that
    is not there) to a message without answers; its score is the sum of its messages' scores (null
    counts 0), ties go to the smaller leaf.  Nodes are unique in a tree; a message on a cycle is on
    no branch, because it has no root.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    there = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    up = nodes.join(there, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("n")), "left")
    # jump: the ancestor 2^round steps up; total, depth: what lies below it, this message included.
    step = written(
        up.select("tree", "node", F.col("n").alias("jump"), F.col("score").alias("total"), F.lit(1).cast("long").alias("depth")),
        f"{label}-jumps",
    )
    rounds, ended, most = [], [step.where("jump is null")], nodes.count()
    # After n rounds a message with a jump left is 2^n steps deep, or on its way into a cycle.
    while (1 << len(rounds)) <= most and not step.where("jump is not null").isEmpty():
        going = step.where("jump is not null")  # who has met the root is not joined again
        rounds.append(going)
        known = reduce(DataFrame.unionByName, ended, going)
        far = known.select(
            F.col("tree").alias("t"),
            F.col("node").alias("n"),
            F.col("jump").alias("jump2"),
            F.col("total").alias("total2"),
            F.col("depth").alias("depth2"),
        )
        met = going.join(far, F.col("tree").eqNullSafe(F.col("t")) & (F.col("jump") == F.col("n")))
        step = written(
            met.select(
                "tree",
                "node",
                F.col("jump2").alias("jump"),
                (F.col("total") + F.col("total2")).alias("total"),
                (F.col("depth") + F.col("depth2")).alias("depth"),
            ),
            f"{label}-jumps",
        )
        ended.append(step.where("jump is null"))
    step = reduce(DataFrame.unionByName, ended)
    answered = nodes.where("parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("n")).distinct()
    leaves = step.join(
        answered, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left_anti"
    )
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "node"))
    marked = leaves.withColumn("path", rank).where(F.col("path") <= best).select("tree", "path", "node")
    for jumps in reversed(rounds):
        over = jumps.select(F.col("tree").alias("t"), F.col("node").alias("n"), "jump")
        reached = marked.join(over, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
        # Every distance is one sum of powers of two, so no message is marked twice.
        marked = marked.unionByName(reached.select("tree", "path", F.col("jump").alias("node")))
        marked = written(marked, f"{label}-marked")
    depth = step.select(F.col("tree").alias("t"), F.col("node").alias("n"), "depth")
    return marked.join(depth, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select(
        "tree", "path", "node", "depth"
    )


def formatted(messages: DataFrame, chosen: DataFrame) -> DataFrame:
    """(tree, path, segments, formatted): one row per chosen path.

    ``messages`` has tree, node, role, text (null: empty); ``segments`` lists (text, in_loss) in
    order, and ``formatted`` is their texts joined.  A path is one row, so it must fit one task.
    """
    parts = messages.select(
        F.col("tree").alias("t"),
        F.col("node").alias("n"),
        escape(F.coalesce("role", F.lit(""))).alias("role"),
        escape(F.coalesce("text", F.lit(""))).alias("text"),
    )
    turns = chosen.join(parts, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).groupBy("tree", "path")
    listed = turns.agg(F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))

    def segment(text: Column, in_loss: Column) -> Column:
        return F.struct(text.alias("text"), in_loss.alias("in_loss"))

    def of_turn(turn: Column) -> Column:
        return F.array(
            segment(F.concat(F.lit(TURN), turn["role"], F.lit(SAYS)), F.lit(False)),
            segment(turn["text"], turn["role"] == "assistant"),
            segment(F.lit(END), F.lit(False)),
        )

    begin = F.array(segment(F.lit(BEGIN), F.lit(False)))
    segments = F.concat(begin, F.flatten(F.transform("turns", of_turn)))
    return listed.select("tree", "path", segments.alias("segments")).withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")
    )


def read_turns(text: Column) -> Column:
    """The (role, text) of each turn of a formatted conversation, in order."""
    body = F.substring(text, len(BEGIN) + 1, 2**31 - 1)
    parts = F.split(body, END)  # no character of it means anything in a pattern
    turns = F.slice(parts, 1, F.size(parts) - 1)

    def of_part(part: Column) -> Column:
        head = F.substring_index(part, SAYS, 1)
        role = F.substr(head, F.lit(len(TURN) + 1))
        said = F.substr(part, F.length(head) + F.lit(len(SAYS) + 1))
        return F.struct(unescape(role).alias("role"), unescape(said).alias("text"))

    return F.transform(turns, of_part)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    under = F.filter(segments, lambda s: s["in_loss"])
    return F.array_join(F.transform(under, lambda s: unescape(s["text"])), "")


def conversations(messages: DataFrame, best: int = 1) -> DataFrame:
    """Formatted paths of reply trees; ``messages`` has tree, node, parent, score, role, text."""
    return formatted(messages, paths(messages, best))
