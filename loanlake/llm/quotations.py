"""Conversations in reply order, linked by their quotations.

A line that begins with ``>`` marks is quoted, as many levels deep as it has marks.  Quoted
lines are normalised (marks off, A-Z lower-cased, white space made one space) and found by hash
among the unquoted lines of other messages: the earliest message of the same conversation
before the quoting one, or else the earliest of another conversation.  A message replies to the
latest message of its conversation that it quotes at the first level, and otherwise to the
message before it.  Bodies are left without quotes, and messages stand in reply order: by their
distance from the first message of their thread, then by turn.

Only column expressions, joins and aggregates are used.  Originals are reduced to the
earliest holder of a line before they are joined, so a line that a third of all messages hold is one
row.  Orders within a conversation are made block by block with offsets.  Threads are followed by
doubling: every round, stored, halves the steps to a thread's start.

Null texts have no lines.  Rows that share conversation and turn are one message for linking, and
each keeps its row; between them the order goes by hash.  Rows without a conversation or a turn stand
alone: no parent, depth 0, position 1.  An empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACES, Scratch, lower_ascii

MARKS = r"^([ \t]*(?:>[ \t]*)+)"
BLOCK = 4096


def _normalised(line: Column) -> Column:
    return lower_ascii(F.regexp_replace(F.btrim(line, F.lit(SPACES)), "[ \\t\\x0B\\f\\r]+", " "))


def _lines(text: Column) -> Column:
    """Lines as ``(level, marks, line)``; the line still has its marks."""
    found = lambda line: F.regexp_extract(line, MARKS, 1)
    level = lambda marks: F.length(marks) - F.length(F.translate(marks, ">", ""))
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n"),
        lambda line: F.struct(level(found(line)).alias("level"), F.length(found(line)).alias("marks"), line.alias("line")),
    )


def _links(messages: DataFrame) -> DataFrame:
    """``conv, turn, quoted lines`` linked: one row per quoted line with where it was said first."""
    lines = messages.select("conv", "turn", F.explode("lines").alias("l"))
    content = _normalised(F.expr("substring(l.line, l.marks + 1)"))
    lines = lines.select("conv", "turn", F.col("l.level").alias("level"), content.alias("content")).filter("content <> ''")
    # Two hashes: one alone could meet a foreign line among very many.
    lines = lines.withColumns({"h1": F.xxhash64("content"), "h2": F.xxhash64(F.lit(7), "content")}).drop("content")
    quoted = lines.filter("level > 0")
    said = lines.filter("level = 0").join(quoted.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi")
    own = said.groupBy("conv", "h1", "h2").agg(F.min("turn").alias("own_turn"))
    entry = F.struct("conv", F.col("own_turn").alias("turn"))
    first = own.groupBy("h1", "h2").agg(F.min(entry).alias("first"))
    # The earliest holder of a further conversation counts where the first is the quoting one.
    further = own.join(first, ["h1", "h2"]).filter(F.col("conv") > F.col("first.conv"))
    second = further.groupBy("h1", "h2").agg(F.min(entry).alias("second"))
    holders = first.join(second, ["h1", "h2"], "left")
    linked = quoted.join(own, ["conv", "h1", "h2"], "left").join(holders, ["h1", "h2"], "left")
    inside = F.when(F.col("own_turn") < F.col("turn"), F.col("own_turn"))
    other = F.when(F.col("first.conv") != F.col("conv"), F.col("first")).otherwise(F.col("second"))
    outside = F.when(inside.isNull(), other)
    return linked.select("conv", "turn", "level", inside.alias("inside"), outside.alias("outside"))


def _before(keys: DataFrame, value: str) -> DataFrame:
    """Add ``before``, the value of the row before in the conversation, block by block."""
    block = F.floor(F.col(value) / BLOCK)
    rows = keys.withColumn("block", block)
    ends = rows.groupBy("conv", "block").agg(F.max(value).alias("last"))
    ends = ends.withColumn("last", F.lag("last").over(Window.partitionBy("conv").orderBy("block")))
    inside = F.lag(value).over(Window.partitionBy("conv", "block").orderBy(value))
    rows = rows.withColumn("before", inside).join(ends, ["conv", "block"])
    return rows.withColumn("before", F.coalesce("before", "last")).drop("block", "last")


def _threads(scratch: Scratch, parents: DataFrame) -> DataFrame:
    """``conv, turn, root, depth`` from ``conv, turn, parent`` (null where a thread begins).

    Every round a message takes over the reach of the one it points to.  Those that point to
    the start of their thread are done and take no part in further rounds.
    """
    start = F.col("parent").isNull()
    steps = scratch.store(
        parents.select("conv", "turn", F.coalesce("parent", "turn").alias("root"), F.when(start, 0).otherwise(1).cast("bigint").alias("depth"))
    )
    done, active = steps.filter("depth = 0"), steps.filter("depth > 0")
    while not active.isEmpty():
        above = done.unionByName(active)
        above = above.select("conv", F.col("turn").alias("root"), F.col("root").alias("top"), F.col("depth").alias("more"))
        further = scratch.store(active.join(above, ["conv", "root"]))
        done = done.unionByName(further.filter("more = 0").select("conv", "turn", "root", "depth"))
        doubled = further.filter("more > 0")
        active = doubled.select("conv", "turn", F.col("top").alias("root"), (F.col("depth") + F.col("more")).alias("depth"))
    return done


def _positions(placed: DataFrame) -> DataFrame:
    """``conv, turn, position``: the number of rows of the conversation that stand before this message's."""
    counted = placed.withColumn("block", F.floor(F.col("turn") / BLOCK))
    blocks = counted.groupBy("conv", "depth", "block").agg(F.sum("n").alias("size"))
    so_far = Window.partitionBy("conv").orderBy("depth", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("offset", F.coalesce(F.sum("size").over(so_far), F.lit(0))).drop("size")
    inside = Window.partitionBy("conv", "depth", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    rows = counted.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    rows = rows.join(blocks, ["conv", "depth", "block"])
    return rows.select("conv", "turn", "root", "depth", "parent", (F.col("offset") + F.col("inside")).alias("offset"))


def reply_order(
    spark: SparkSession,
    table: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``table``.

    ``conv_id, turn, role, body, n_quoted`` (quoted lines), ``max_level, n_linked`` (quoted lines
    whose message was found), ``parent_turn, root_turn, depth, position, quoted_conv`` (smallest
    other conversation that is quoted).
    """
    scratch = Scratch(spark, "quotes")
    rows = table.select(
        F.col(f"`{conv_id}`").alias("conv"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.col(f"`{role}`").alias("role"),
        _lines(F.col(f"`{text}`")).alias("lines"),
    )
    quoted = F.filter("lines", lambda line: line["level"] > 0)
    plain = F.transform(F.filter("lines", lambda line: line["level"] == 0), lambda line: line["line"])
    bodies = rows.select(
        "conv", "turn", "role",
        F.btrim(F.array_join(plain, "\n"), F.lit(SPACES)).alias("body"),
        F.size(quoted).cast("bigint").alias("n_quoted"),
        F.coalesce(F.array_max(F.transform("lines", lambda line: line["level"])), F.lit(0)).cast("bigint").alias("max_level"),
    )
    usable = "conv IS NOT NULL AND turn IS NOT NULL"
    links = _links(rows.filter(usable)).groupBy("conv", "turn").agg(
        F.max(F.when(F.col("level") == 1, F.col("inside"))).alias("replied"),
        F.count(F.coalesce(F.col("inside").cast("string"), F.col("outside.turn").cast("string"))).alias("n_linked"),
        F.min("outside.conv").alias("quoted_conv"),
    )
    links = scratch.store(links)
    keys = rows.filter(usable).groupBy("conv", "turn").agg(F.count("*").alias("n"))
    keys = _before(keys, "turn").join(links.select("conv", "turn", "replied"), ["conv", "turn"], "left")
    keys = scratch.store(keys.select("conv", "turn", "n", F.coalesce("replied", "before").alias("parent")))
    threads = _threads(scratch, keys.select("conv", "turn", "parent"))
    placed = scratch.store(_positions(keys.join(threads, ["conv", "turn"])))
    scratch.drop(keys)
    joined = bodies.join(placed, ["conv", "turn"], "left").join(links.drop("replied"), ["conv", "turn"], "left")
    among = Window.partitionBy("conv", "turn").orderBy(F.xxhash64("role", "body"), "role", "body")
    position = F.when(F.col("offset").isNull(), F.lit(1)).otherwise(F.col("offset") + F.row_number().over(among))
    return joined.select(
        F.col("conv").alias("conv_id"), "turn", "role", "body", "n_quoted", "max_level",
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        F.col("parent").alias("parent_turn"),
        F.coalesce("root", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        position.cast("bigint").alias("position"),
        "quoted_conv",
    )
