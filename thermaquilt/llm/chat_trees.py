"""Reply trees: paths by iterative self-joins, branches ranked by score, each chosen path formatted as one conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermaquilt.llm.common import stage_table

#: The template's own marks; fixed values.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: Control strings of this and other public templates: a first character and what follows it.
_CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>|/?SYS>>)"
_ESCAPED = r"([<\[])(\\*)\\(\||/?s>|/?INST\]|</?SYS>>|/?SYS>>)"


def escape(text: Column) -> Column:
    """text with a backslash put into each control string; one more where some stand already, so it can be undone."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    """Undoes escape."""
    return F.regexp_replace(text, _ESCAPED, r"$1$2$3")


def _jumps(links: DataFrame) -> list[DataFrame]:
    """Tables (tree, id, up, score, turns): by message, the ancestor 1, 2, 4, ... steps up (null above the root), and the sum and number of the messages before it.

    The last one has null wherever a root is reached; a ring of parents never
    reaches one. Rows carry ids and sums only, no paths and no texts.
    """
    tables, size = [stage_table(links.withColumn("turns", F.lit(1).cast("long")), "tree-jump")], links.count()
    while 1 << (len(tables) - 1) <= size and tables[-1].where("up is not null").head(1):
        step = tables[-1].select(F.col("tree").alias("t"), F.col("id").alias("i"), F.col("up").alias("next"), F.col("score").alias("more"), F.col("turns").alias("steps"))
        far = tables[-1].join(step, (F.col("tree") == F.col("t")) & (F.col("up") == F.col("i")), "left")
        tables.append(stage_table(far.select("tree", "id", F.col("next").alias("up"), (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"), (F.col("turns") + F.coalesce("steps", F.lit(0))).alias("turns")), "tree-jump"))
    return tables


def tree_paths(messages: DataFrame, branches: int) -> DataFrame:
    """(tree, leaf, branch, score, id, place): the messages of the `branches` best root-to-leaf paths of each tree, a row each; place is 1 at the root.

    messages: tree, id, parent (null at a root), score. Pointers are doubled by
    self-joins on (tree, id), so a path of n messages takes about log2(n) rounds;
    then each chosen leaf's path is spread out by the same tables, from the
    longest jump down, so what is written grows with the paths, not with their
    squares. A path's score is the sum of its messages'. A parent that isn't
    there ends a path as a root does; a ring of parents gives no path.
    """
    links = messages.select("tree", "id", "parent", F.coalesce(F.col("score"), F.lit(0.0)).cast("double").alias("score")).dropDuplicates(["tree", "id"])
    known = links.select(F.col("tree").alias("t"), F.col("id").alias("i"))
    links = links.join(known, (F.col("tree") == F.col("t")) & (F.col("parent") == F.col("i")), "left").select("tree", "id", F.when(F.col("i").isNotNull(), F.col("parent")).alias("up"), "score")
    tables = _jumps(links)
    whole = tables[-1].where("up is null").select("tree", "id", "score", F.col("turns").alias("place"))
    parents = tables[0].where("up is not null").select("tree", F.col("up").alias("id")).distinct()
    leaves = whole.join(parents, ["tree", "id"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "id"))
    paths = leaves.withColumn("branch", rank).where(F.col("branch") <= branches).select("tree", F.col("id").alias("leaf"), "branch", "score", "id")
    for jump in reversed(tables):
        step = jump.select(F.col("tree").alias("t"), F.col("id").alias("i"), "up")
        both = paths.join(step, (F.col("tree") == F.col("t")) & (F.col("id") == F.col("i")))
        paths = both.select("tree", "leaf", "branch", "score", F.explode(F.array_compact(F.array("id", "up"))).alias("id"))
    return paths.join(whole.select("tree", "id", "place"), ["tree", "id"])


def format_paths(messages: DataFrame, *, branches: int = 1, learn_roles: tuple[str, ...] = ("assistant",), null_tree: bool = False) -> DataFrame:
    """(tree, leaf, branch, score, formatted, loss): the best `branches` paths of each tree as one conversation each.

    messages: tree, id, parent, score, role, text. A conversation is, per turn,
    TURN role BODY text END, with control strings inside roles and texts escaped
    reversibly. `loss` is an array of (start, length) in code points of
    `formatted`: the escaped texts of learn_roles, nothing between. Equal scores
    are ranked by leaf id. Null texts and roles are empty, null scores 0; with
    null_tree, messages without a tree are a tree of their own, else they are in
    none; messages without an id are in no path. Of several
    messages with one id in a tree, any one, with its texts in order of role and
    text the first, stands for all. Texts are whole however long. No messages
    give no rows; extra columns are ignored.
    """
    kind = messages.schema["tree"].dataType
    key = F.when(F.col("tree").isNull(), "n").otherwise(F.concat(F.lit("v"), F.col("tree").cast("string")))
    messages = messages.where("id is not null" if null_tree else "id is not null and tree is not null").select(key.alias("tree"), "id", "parent", "score", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    once = messages.groupBy("tree", "id").agg(F.min(F.struct("role", "text", "parent", "score")).alias("m")).select("tree", "id", "m.*")
    best = tree_paths(once, branches)
    turns = best.join(once.select("tree", "id", "role", "text"), ["tree", "id"])
    turn = F.struct("place", F.coalesce("role", F.lit("")).alias("role"), escape(F.col("text")).alias("text"))
    rows = turns.groupBy("tree", "leaf", "branch", "score").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    piece = lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(BODY), t["text"], F.lit(END + "\n"))
    before = lambda t: F.char_length(escape(t["role"])) + len(TURN) + len(BODY)
    walked = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("loss")),
        lambda a, t: F.struct(
            (a["at"] + F.char_length(piece(t))).alias("at"),
            F.when(t["role"].isin(*learn_roles), F.concat(a["loss"], F.array(F.struct((a["at"] + before(t)).alias("start"), F.char_length(t["text"]).alias("length"))))).otherwise(a["loss"]).alias("loss"),
        ),
    )
    tree = F.when(F.col("tree") != "n", F.substring(F.col("tree"), F.lit(2), F.length("tree"))).cast(kind).alias("tree")
    return rows.select(tree, "leaf", "branch", "score", F.array_join(F.transform("turns", piece), "").alias("formatted"), walked["loss"].alias("loss"))


def read_back(formatted: Column) -> Column:
    """Array of (role, text) read from a formatted conversation, unescaped."""
    parts = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p: p != "")
    cut = lambda p: F.split(F.substring(p, F.lit(1), F.char_length(p) - len(END) - 1), r"<\|body\|>", 2)
    return F.transform(parts, lambda p: F.struct(unescape(cut(p)[0]).alias("role"), unescape(cut(p)[1]).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, joined without gaps."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def linear_trees(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations by turn as reply trees of one branch: each turn answers the one before it, in order of turn, role, text."""
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    t = turns.select(F.col(conv).alias("tree"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    t = t.withColumn("id", F.row_number().over(order).cast("long"))
    return t.select("tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), F.lit(1.0).alias("score"), "role", "text")
