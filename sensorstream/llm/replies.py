"""Reply trees as chat conversations: every chosen path from a root to a leaf becomes one conversation.

Messages name their parents. Self-joins that double in reach tell every message its root, its depth and the
score of its path; leaves are ranked by score in their tree, and for the chosen ones the same jumps, taken again, list
the messages on their paths. A path of m messages needs some log2(m) joins, and every row is light: ids only. Texts join
once, are escaped and marked where they lie, and are put together in parts of PART_TURNS turns, so no
task gathers a conversation of any length. Everything is DataFrame and SQL functions.

A turn is written as `<|im_start|>role`, a line feed, the text, `<|im_end|>`, a line feed. Inside roles and texts a backslash is put
between `<` and `|` (one more where there are some already), so no text holds a mark, and taking one out again gives
the text. In roles, line feeds and backslashes are escaped as well, so the first line feed of a turn ends its role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorstream.llm.common import table

#: The marks of the template, as fixed values.
START, END = "<|im_start|>", "<|im_end|>\n"
#: Turns of one part of a formatted conversation.
PART_TURNS = 256
#: A parent followed by more than one in so many rows joins by broadcast; there are at most as many of these.
HOT = 512


# ---- template --------------------------------------------------------------------------------


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    lined = F.replace(F.replace(F.coalesce(role, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escape(lined)


def unescape_role(role: Column) -> Column:
    halves = F.split(unescape(role), r"\\\\")
    return F.array_join(F.transform(halves, lambda h: F.replace(h, F.lit("\\n"), F.lit("\n"))), "\\")


# ---- trees -----------------------------------------------------------------------------------


def turns_as_replies(messages: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(tree, node, parent, role, text, score): each turn answers the one before it in its conversation. Turns go by
    `turn` (null first), equal ones by role and a hash of the text; nothing is merged, so repeated rows are turns of their own.

    A conversation may hold any share of the rows: its turns are dealt to ranges, linked inside of them, and
    the first turn of a range looks up the last one before."""
    spark = messages.sparkSession
    rows = table(
        messages.select(F.col(tree).cast("long").alias("tree"), F.monotonically_increasing_id().alias("node"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")),
        "chat-rows",
    )
    place = ["turn", "role", "hash", "node"]
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    light = rows.select("tree", "turn", "role", F.xxhash64("text").alias("hash"), "node")
    dealt = table(light.repartitionByRange(ranges, "tree", *place).withColumn("range", F.spark_partition_id()), "chat-ranges")
    inside = Window.partitionBy("tree", "range").orderBy(*place)
    linked = dealt.select("tree", "range", "node", F.lag("node").over(inside).alias("before"), F.row_number().over(inside).alias("at"))
    # A tree that crosses ranges has its own last rows in all but one; there are at most two such trees a range.
    ends = dealt.groupBy("tree", "range").agg(F.max_by("node", F.struct(*place)).alias("last"))
    crossing = ends.groupBy("tree").agg(F.count(F.lit(1)).alias("ranges")).where("ranges > 1").select("tree")
    ends = ends.join(F.broadcast(crossing.withColumnRenamed("tree", "_tree")), F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
    along = Window.partitionBy("tree").orderBy("range")
    ends = ends.select(F.col("tree").alias("_tree"), F.col("range").alias("_range"), F.lag("last").over(along).alias("over"))
    first = (F.col("at") == 1) & F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("range") == F.col("_range"))
    parents = linked.join(F.broadcast(ends), first, "left").select("node", F.coalesce("before", "over").alias("parent"))
    return rows.join(parents, "node").select("tree", "node", "parent", "role", "text", F.lit(0.0).alias("score"))


def _follow(left: DataFrame, right: DataFrame, key: str, rows: int) -> DataFrame:
    """Join on `key`, of which `right` has at most one row each. Keys with more than one in HOT of all rows on the left, fewer than
    HOT by count, are broadcast: a message with very many answers is not one task's work."""
    count = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = [r[0] for r in count.where(F.col("_n") * HOT > max(rows, 64 * HOT)).select(key).collect()]
    if not hot:
        return left.join(right, key)
    few = F.broadcast(right.where(F.col(key).isin(hot)))
    return left.where(F.col(key).isin(hot)).join(few, key).unionByName(left.where(~F.col(key).isin(hot)).join(right, key))


def branches(replies: DataFrame, best: int | None = 1) -> tuple[DataFrame, DataFrame]:
    """Two tables: the chosen leaves (tree, leaf, rank, score, depth) and their paths (leaf, node, above), `above` counting
    the steps up from the leaf.

    A branch ends at a message that nobody answers; its score is the sum over its messages (null counts as 0), and the
    `best` ones of a tree are chosen (None: all), equal ones by ascending node. A parent that is missing makes a root, and
    messages on or below a cycle of parents have no root and are on no branch."""
    light = table(replies.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")), "chat-light")
    rows = light.count()
    answers = _follow(light.where("parent is not null"), light.select(F.col("node").alias("parent")), "parent", rows)
    roots = light.join(answers.select("node"), "node", "left_anti").select("tree", "node", F.lit(None).cast("long").alias("up"), F.lit(1).cast("long").alias("steps"), "score")
    jump = table(roots.unionByName(answers.select("tree", "node", F.col("parent").alias("up"), F.lit(1).cast("long").alias("steps"), "score")), "chat-jump")
    # A message is finished once its jump passes the root; later rounds carry the others only.
    rounds, finished = [jump], jump.where("up is null")
    while (1 << (len(rounds) - 1)) <= rows and rounds[-1].where("up is not null").head(1):
        going = rounds[-1].where("up is not null")
        further = finished.unionByName(going).select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("steps2"), F.col("score").alias("score2"))
        both = _follow(going, further, "up", rows)
        jump = table(both.select("tree", "node", F.col("up2").alias("up"), (F.col("steps") + F.col("steps2")).alias("steps"), (F.col("score") + F.col("score2")).alias("score")), "chat-jump")
        rounds.append(jump)
        finished = finished.unionByName(jump.where("up is null"))
    answered = rounds[0].where("up is not null").select(F.col("up").alias("node")).distinct()
    leaves = finished.join(answered, "node", "left_anti")
    ranked = leaves.select("tree", F.col("node").alias("leaf"), "score", F.col("steps").alias("depth"))
    if best is None:
        chosen = ranked.withColumn("rank", F.lit(None).cast("int"))
    else:
        order = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
        chosen = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    chosen = table(chosen.select("tree", "leaf", "rank", "score", "depth"), "chat-leaves")
    path = chosen.select("leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("above"))
    for reach, known in enumerate(rounds[:-1]):
        higher = _follow(path, known.where("up is not null").select("node", "up"), "node", rows)
        path = path.unionByName(table(higher.select("leaf", F.col("up").alias("node"), (F.col("above") + (1 << reach)).alias("above")), "chat-paths"))
    return chosen, path


def format_branches(replies: DataFrame, best: int | None = 1, loss_roles=("assistant",)) -> DataFrame:
    """(tree, leaf, rank, parts, part, formatted, loss): the `best` branches of each tree as conversations, null texts and roles as
    empty ones. `loss` lists the (start, length), in code points of `formatted`, that training counts: the texts of `loss_roles`,
    without role, marks or line feeds of the template.

    A conversation is one row; one of more than PART_TURNS turns goes on in the next `part`, and its parts, put together, are the
    conversation. Null trees are one tree, an empty table gives an empty table, other columns are not read."""
    chosen, path = branches(replies, best)
    placed = path.join(chosen.select("leaf", "depth"), "leaf").select("leaf", "node", (F.col("depth") - 1 - F.col("above")).alias("at"))
    role, body = escape_role(F.col("role")), escape(F.col("text"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    turns = replies.select("node", F.concat(head, body, F.lit(END)).alias("turn"), F.length(head).alias("before"), F.length(body).alias("length"), F.coalesce(F.col("role").isin(*loss_roles), F.lit(False)).alias("counts"))
    full = placed.join(turns, "node").withColumn("part", F.floor(F.col("at") / PART_TURNS))
    so_far = Window.partitionBy("leaf", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("turn")
    turn = F.struct("at", "turn", (F.coalesce(F.sum(size).over(so_far), F.lit(0)) + F.col("before")).cast("long").alias("start"), "length", "counts")
    parts = full.select("leaf", "part", turn.alias("t")).groupBy("leaf", "part").agg(F.sort_array(F.collect_list("t")).alias("t"))
    loss = F.transform(F.filter("t", lambda t: t["counts"]), lambda t: F.struct(t["start"].alias("start"), t["length"].cast("long").alias("length")))
    parts = parts.select("leaf", "part", F.array_join("t.turn", "").alias("formatted"), loss.alias("loss"))
    count = F.ceil(F.col("depth") / PART_TURNS).alias("parts")
    return parts.join(chosen, "leaf").select("tree", "leaf", "rank", count, "part", "formatted", "loss")


def read_back(formatted: DataFrame) -> DataFrame:
    """(tree, leaf, rank, n_turns, turns, loss_text, formatted_chars) of what `format_branches` wrote: turns as role, line feed, text, line
    feed; all text under the loss mask in order, without escapes."""
    each = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda t: t != "")
    name = lambda t: F.substring(F.substring_index(t, "\n", 1), len(START) + 1, 1 << 30)
    said = lambda t: F.substring(t, F.length(F.substring_index(t, "\n", 1)) + 2, F.length(t))
    plain = F.transform(each, lambda t: F.concat(unescape_role(name(t)), F.lit("\n"), unescape(said(t)), F.lit("\n")))
    under = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    read = formatted.select(
        "tree", "leaf", "rank", "parts", "part", F.size(each).cast("long").alias("n_turns"), F.array_join(plain, "").alias("turns"), F.array_join(under, "").alias("loss_text"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    columns = ["tree", "leaf", "rank", "n_turns", "turns", "loss_text", "formatted_chars"]
    # Only conversations of several parts have anything to put together.
    piece = F.struct("part", "turns", "loss_text")
    several = read.where("parts > 1").groupBy("leaf").agg(
        F.first("tree").alias("tree"), F.first("rank").alias("rank"), F.sum("n_turns").alias("n_turns"), F.sum("formatted_chars").alias("formatted_chars"), F.sort_array(F.collect_list(piece)).alias("p")
    )
    several = several.withColumn("turns", F.array_join("p.turns", "")).withColumn("loss_text", F.array_join("p.loss_text", ""))
    return read.where("parts = 1").select(*columns).unionByName(several.select(*columns))
