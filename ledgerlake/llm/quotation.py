r"""Quoted conversations in reply order: quoted passages are linked to the messages they come from, then taken out. DataFrame operations only.

1. A line's level is the number of ``>`` it begins with (blanks may stand between them). Successive lines of one level are a passage. A line
   of the ``On ... wrote:`` kind right before a quotation introduces it and is no text of the message.
2. Passages and lines are normalised (A-Z folded, runs of blanks made one space, ends stripped) and hashed. A message's own text gives the
   hash of its whole, of each paragraph and of each line; a quoted passage the hash of its whole and of each line.
3. They are joined by conversation and hash. A hash belongs to the earliest turn that has it as its own text, an aggregate taken before the
   join, so a line that a third of all messages hold costs one row per conversation, and each quoted hash meets one message at most.
4. A message replies to the message that its outermost quotation comes from, among several to the one with most characters in common,
   then the latest. Deeper levels decide only where no outer one is found. A message is no reply to itself or a later one. A message
   whose quotations lead nowhere, or that has none, replies to the turn before it; the first turn of a conversation replies to none.
5. A thread is opened by the first turn and by every reply to another message than the turn before; the turns after it go on in it. So each message
   is in one thread, at a position from 0 up, and a thread's first message names the message that it branches off from. Turns are sorted
   into ranges of a stored table; windows hold a range of a conversation at most, and ranges meet by a row each.
6. Depth counts the replies up to the conversation's first message: along the thread, then from thread to thread by doubling.
7. ``conversations`` gives the turns of a thread as one marked-up text, in parts of ``messages`` positions.

A message without quotations keeps its text as it is; otherwise the text is its own lines, with blank lines at both ends removed. Null texts
count as empty. Messages whose conversation or turn is null are neither quoted nor linked and are their own thread. Rows that repeat a turn keep a row
each and share its links and position; in a thread's text equal ones stand once, others side by side. Other columns are not looked at. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlake.llm.common import discard, stored, text_of

QUOTED = r"^[\x20\t]*>[>\x20\t]*"
INTRODUCES = r"^On .+ wrote:[\x20\t]*$"
KEY = ["conv_id", "turn"]
MESSAGES = 1000  # positions of a thread in one text
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    folded = F.translate(text, UPPER + "\t\n\x0b\x0c\r", UPPER.lower() + " " * 5)
    return F.trim(F.regexp_replace(folded, " {2,}", " "))


def _lines(text: Column) -> Column:
    return F.split(F.regexp_replace(text, "\r\n", "\n"), "\n", -1)


def _level(line: Column) -> Column:
    mark = F.regexp_extract(line, QUOTED, 0)
    return F.length(mark) - F.length(F.translate(mark, ">", ""))


def parsed(messages: DataFrame) -> DataFrame:
    """Lines of the messages that quote anything: KEY, n (of the line), level, content, introduces."""
    body = F.col("body")
    some = messages.where(body.rlike("(?m)" + QUOTED)).select(*KEY, "body").distinct()
    lines = some.select(*KEY, F.xxhash64("body").alias("version"), F.posexplode(_lines(body)).alias("n", "line"))
    lines = lines.withColumn("level", _level(F.col("line"))).withColumn("content", F.regexp_replace("line", QUOTED, ""))
    # The lines of one message: a window that holds a message at most.
    near = Window.partitionBy(*KEY, "version").orderBy("n")
    before = F.lag("level").over(near)
    return (
        lines.withColumn("next_level", F.lead("level").over(near))
        .withColumn("opens", F.when(before.isNull() | (before != F.col("level")), 1).otherwise(0))
        .withColumn("passage", F.sum("opens").over(near))
        .withColumn("introduces", (F.col("level") == 0) & (F.col("next_level") > 0) & F.col("line").rlike(INTRODUCES))
    )


def _text(lines: Column) -> Column:
    """The contents of (n, content) in order."""
    return F.array_join(F.transform(F.array_sort(lines), lambda x: x["content"]), "\n")


def link(lines: DataFrame, own: DataFrame) -> DataFrame:
    """KEY and reply_to of the messages that quote an earlier one. own: KEY and body of each message, quotations taken out."""
    whole = F.col("body")
    units = F.array_distinct(
        F.filter(
            F.transform(F.concat(F.array(whole), F.split(whole, r"\n[\x20\t]*\n"), _lines(whole)), normalised), lambda t: t != ""
        )
    )
    sources = (
        own.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
        .select(*KEY, F.explode(units).alias("unit"))
        .groupBy("conv_id", F.xxhash64("unit").alias("hash"), F.length("unit").alias("size"))
        .agg(F.min("turn").alias("source"))
    )
    quoted = lines.where("level > 0 AND conv_id IS NOT NULL AND turn IS NOT NULL")
    passages = quoted.groupBy(*KEY, "version", "passage", "level").agg(
        _text(F.collect_list(F.struct("n", "content"))).alias("content")  # the lines of one message at most
    )
    wanted = (
        passages.select(*KEY, "level", "content")
        .union(quoted.select(*KEY, "level", "content"))
        .select(*KEY, "level", normalised(F.col("content")).alias("unit"))
        .where("unit != ''")
        .select(*KEY, "level", F.xxhash64("unit").alias("hash"), F.length("unit").alias("size"))
        .distinct()
    )
    found = wanted.join(sources, ["conv_id", "hash", "size"]).where("source < turn")
    strength = found.groupBy(*KEY, "level", "source").agg(F.sum("size").alias("common"))
    best = F.max(F.struct((-F.col("level")).alias("outer"), "common", "source")).alias("best")
    return strength.groupBy(*KEY).agg(best).select(*KEY, F.col("best.source").alias("reply_to"))


def ordered(own: DataFrame, links: DataFrame) -> DataFrame:
    """KEY, reply_to, quoted, thread, position (from 0) of every turn of a conversation."""
    turns = own.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select(*KEY).distinct()
    linked = turns.join(links.withColumnRenamed("reply_to", "source"), KEY, "left")
    ranges = stored(linked.repartitionByRange(*KEY).select("*", F.spark_partition_id().alias("range")), "turn-ranges")
    inside = Window.partitionBy("conv_id", "range").orderBy("turn")
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    rows = ranges.groupBy("conv_id", "range").agg(F.max("turn").alias("last"), F.count("*").alias("n"))
    rows = rows.select("conv_id", "range", F.max("last").over(earlier).alias("last"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n"))
    placed = ranges.join(rows, ["conv_id", "range"]).select(
        *KEY, "range", "source",
        F.coalesce(F.lag("turn").over(inside), "last").alias("previous"),
        (F.col("n") + F.row_number().over(inside)).alias("rank"),
    )
    opens = F.col("previous").isNull() | (F.col("source") != F.col("previous"))
    head = F.when(opens, F.struct("rank", F.col("turn").alias("first")))
    placed = placed.withColumn("head", head)
    heads = placed.groupBy("conv_id", "range").agg(F.max("head").alias("before"))
    heads = heads.select("conv_id", "range", F.max("before").over(earlier).alias("before"))
    return (
        placed.withColumn("head", F.max("head").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .join(heads, ["conv_id", "range"])
        .withColumn("head", F.coalesce("head", "before"))
        .select(
            *KEY,
            F.coalesce("source", "previous").alias("reply_to"),
            F.col("source").isNotNull().alias("quoted"),
            F.col("head.first").alias("thread"),
            (F.col("rank") - F.col("head.rank")).alias("position"),
        )
    )


def depths(turns: DataFrame) -> DataFrame:
    """conv_id, thread and the depth of its first message, by doubling the steps from thread to thread until all have reached the first."""
    heads = turns.where("position = 0 AND reply_to IS NOT NULL").select("conv_id", "thread", F.col("reply_to").alias("turn"))
    above = turns.select(*KEY, F.col("thread").alias("up"), (F.col("position") + 1).alias("depth"))
    now = stored(heads.join(above, KEY).select("conv_id", "thread", "up", "depth"), "thread-steps")
    while True:
        above = now.select("conv_id", F.col("thread").alias("up"), F.col("up").alias("further"), F.col("depth").alias("more"))
        further = stored(
            now.join(above, ["conv_id", "up"], "left").select(
                "conv_id", "thread", F.coalesce("further", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("further").isNotNull().alias("goes_on"),
            ),
            "thread-steps",
        )
        discard(now)
        if further.where("goes_on").isEmpty():
            return further.select("conv_id", "thread", F.col("depth").alias("above"))
        now = further


def reply_ordered(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per message: conv_id, turn, role, text without quotations, reply_to, quoted (whether a quotation says so), thread (turn of its first
    message), position in it, depth (replies up to the conversation's first message), chat (the turn as marked-up text)."""
    base = messages.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), text_of(text_col).alias("body")
    )
    lines = stored(parsed(base), "quoted-lines")
    kept = lines.where("level = 0 AND NOT introduces").groupBy(*KEY, "version").agg(_text(F.collect_list(F.struct("n", F.col("line").alias("content")))).alias("kept"))
    quoting = lines.select(*KEY, "version").distinct()
    bare = quoting.join(kept, _same(quoting, kept, [*KEY, "version"]), "left").select(
        *[quoting[c].alias(f"b_{c}") for c in (*KEY, "version")],
        F.regexp_replace(F.coalesce("kept", F.lit("")), r"^(?:[\x20\t]*\n)+|(?:\n[\x20\t]*)+$", "").alias("bare"),
    )
    version = F.xxhash64("body")
    here = base["conv_id"].eqNullSafe(bare["b_conv_id"]) & base["turn"].eqNullSafe(bare["b_turn"]) & (version == bare["b_version"])
    own = stored(base.join(bare, here, "left").select(*KEY, "role", F.coalesce("bare", "body").alias("body")), "own-texts")
    links = stored(link(lines, own), "reply-links")
    turns = stored(ordered(own, links), "turn-order")
    tree = turns.join(depths(turns), ["conv_id", "thread"], "left").select(
        F.col("conv_id").alias("l_conv_id"), F.col("turn").alias("l_turn"), "reply_to", "quoted", "thread", "position",
        (F.coalesce("above", F.lit(0)) + F.col("position")).alias("depth"),
    )
    out = own.join(tree, (own["conv_id"] == tree["l_conv_id"]) & (own["turn"] == tree["l_turn"]), "left")
    return out.select(
        *KEY,
        "role",
        F.col("body").alias("text"),
        "reply_to",
        F.coalesce("quoted", F.lit(False)).alias("quoted"),
        F.coalesce("thread", "turn").alias("thread"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("position", "depth")],
        F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("")), F.lit("\n"), F.col("body"), F.lit("<|im_end|>")).alias("chat"),
    )


def conversations(ordered_rows: DataFrame, messages: int = MESSAGES) -> DataFrame:
    """One marked-up text per thread of ``reply_ordered`` rows: conv_id, thread, part (from 0), follows (what the thread replies to; null
    past its first part), messages, text. A message without conversation or turn is a text of its own."""
    part = F.floor(F.col("position") / messages).alias("part")
    whole = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    turns = ordered_rows.where(whole).select("conv_id", "thread", part, "position", "chat", "reply_to").distinct()
    # At most ``messages`` positions of one thread.
    several = turns.groupBy("conv_id", "thread", "part").agg(
        F.max(F.when(F.col("position") == 0, F.col("reply_to"))).alias("follows"),
        F.count("*").alias("messages"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "chat"))), lambda x: x["chat"]), "\n").alias("text"),
    )
    alone = ordered_rows.where(~whole).select("conv_id", "thread", part, "reply_to", F.lit(1).cast("long"), "chat")
    return several.union(alone)


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & a[c].eqNullSafe(b[c])
    return out
