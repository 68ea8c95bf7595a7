"""Conversations in reply order, without quotations, by linking quoted passages to their originals.

A line that begins with one or more ``>`` quotes, each mark one level deeper. Consecutive lines of
one level are a passage. Passages are normalised and hashed, and so are the whole text, the
paragraphs and the lines that each message has of its own; equal hashes within a conversation link
a quotation to the first message that has the passage, if it is an earlier turn. A passage that no
earlier message has as one of these is a trimmed quotation: its paragraphs and lines are looked up
instead. Its original has all that was found of it, so it is linked to the latest of the messages
that have these first. A message replies to the latest message that it quotes at the first level.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.tables import stored
from starloom.operators.join import lookup

#: White space at the ends of and between words makes no difference.
SPACE = "[ \\t\\r\\n]+"
QUOTING = "(^|\\n)[ \\t]*>"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), SPACE, " "))


def _messages(conversations: DataFrame) -> DataFrame:
    """Each message once, with how often it occurs."""
    columns = {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}
    rows = conversations.select(*(conversations[c].cast(t).alias(c) for c, t in columns.items()))
    messages = rows.groupBy(*columns).agg(F.count("*").alias("n_copies"))
    return messages.withColumn("message", F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})))


def _lines(messages: DataFrame) -> DataFrame:
    """``message, passage, at, level, line`` of messages that quote."""
    lines = messages.select("message", F.posexplode(F.split("text", "\n")).alias("at", "raw"))
    marks = F.regexp_extract("raw", "^[ \\t>]*", 0)
    level = F.length(F.regexp_replace(marks, "[^>]", ""))
    lines = lines.withColumns({"level": level, "marks": marks})
    line = F.when(F.col("level") > 0, F.substr("raw", F.length("marks") + 1)).otherwise(F.col("raw"))
    order = Window.partitionBy("message").orderBy("at")
    begins = (F.col("level") != F.lag("level", 1, -1).over(order)).cast("int")
    lines = lines.select("message", "at", "level", line.alias("line"), begins.alias("begins"))
    passage = F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return lines.select("message", passage.alias("passage"), "at", "level", "line")


def _in_order(condition: Column | None = None) -> Column:
    """Lines of a group as one text."""
    item = F.struct("at", "line")
    items = F.collect_list(item if condition is None else F.when(condition, item))
    return F.array_join(F.transform(F.array_sort(items), lambda x: x["line"]), "\n")


def _pieces(text: Column) -> Column:
    """Paragraphs and lines."""
    return F.concat(F.split(text, "\\n[ \\t\\r]*\\n"), F.split(text, "\\n"))


def _units(own: DataFrame) -> DataFrame:
    """``conv_id, hash, turn, message``: what a quotation of a message may consist of."""
    units = F.concat(F.array("text"), _pieces(F.col("text")))
    units = F.array_distinct(F.transform(units, normalised))
    units = F.filter(units, lambda u: u != "")
    return own.select("conv_id", "turn", "message", F.explode(F.transform(units, F.md5)).alias("hash"))


def _sought(passages: DataFrame) -> DataFrame:
    """``whole, hash`` added: a row for each passage that is not blank, and for each other piece of it with a word."""
    passages = passages.withColumn("words", normalised(F.col("passage_text"))).where("words != ''")
    pieces = F.array_except(F.transform(_pieces(F.col("passage_text")), normalised), F.array("words"))
    pieces = F.filter(pieces, lambda p: p.rlike("[\\p{L}\\p{N}]"))
    sought = F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.md5("words").alias("hash"))), F.transform(
        pieces, lambda p: F.struct(F.lit(False).alias("whole"), F.md5(p).alias("hash"))
    ))
    return passages.withColumn("sought", F.explode(sought)).select(*passages.drop("words", "passage_text").columns, "sought.*")


def _roots(replies: DataFrame) -> DataFrame:
    """``message, root, depth`` of replies, by doubling the distance until all have arrived."""
    state = stored(replies.select("message", F.col("parent").alias("root"), F.lit(1).alias("depth")), "replies")
    while True:
        step = state.select(F.col("message").alias("root"), F.col("root").alias("further"), F.col("depth").alias("more"))
        joined = lookup(state, step, "root")
        joined = joined.select(
            "message",
            F.coalesce("further", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("further").isNotNull().alias("moved"),
        )
        joined = stored(joined, "replies")
        state = joined.drop("moved")
        if joined.where("moved").isEmpty():
            return state


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """One row per message: ``conv_id, thread, depth, turn, role, reply_to, n_quotes, n_linked,
    n_copies, text``.

    ``reply_to`` is the turn of the message replied to, ``thread`` the turn of the message where
    that chain begins (the own turn if there is none) and ``depth`` the steps to it. Sorted by
    ``conv_id, thread, depth, turn`` a conversation is in reply order. ``n_quotes`` counts quoted
    passages, ``n_linked`` those whose original was found, whole or by some paragraph or line (a part
    of a line is not looked up); ``text`` is what the message says itself, without blank lines at
    its ends if it quotes.

    Repeated messages (all four columns equal) are one, counted in ``n_copies``. Messages without
    conversation or turn link to nothing; a null text stays null; blank quotations link to nothing.
    Other columns of the input are left out.

    Only quoting messages are taken apart, only their conversations searched, and of originals only
    hashes are shuffled, one per conversation and passage after counting, and of quotations one per
    passage, paragraph and line. A frequent passage, a
    long conversation or a much quoted message is joined to one row each, so such joins can be
    split. No conversation has to fit into one task.
    """
    messages = _messages(conversations)
    quotes = F.coalesce(F.col("text").rlike(QUOTING), F.lit(False))
    plain, quoting = messages.where(~quotes), messages.where(quotes)
    lines = _lines(quoting)
    passages = lines.where("level > 0").groupBy("message", "passage", "level").agg(_in_order().alias("passage_text"))
    own = lines.groupBy("message").agg(_in_order(F.col("level") == 0).alias("own"))
    quoting = quoting.join(own, "message").withColumn("text", F.trim("own", F.lit("\n"))).drop("own")

    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    asked = quoting.where(known).select("conv_id").distinct()
    texts = plain.select("conv_id", "turn", "message", "text").unionByName(quoting.select("conv_id", "turn", "message", "text"))
    texts = lookup(texts.where(known), asked, "conv_id", "inner", right_grouped=True)
    first = _units(texts).groupBy("conv_id", "hash").agg(F.min(F.struct("turn", "message")).alias("first"))
    first = first.select(F.struct("conv_id", "hash").alias("spot"), "first")

    asking = quoting.where(known).select("message", "conv_id", "turn")
    asking = _sought(passages.join(asking, "message")).withColumn("spot", F.struct("conv_id", "hash"))
    found = lookup(asking, first, "spot", "inner", right_grouped=True).where("first.turn < turn")
    found = found.groupBy("message", "passage", "level").agg(F.max(F.struct("whole", "first")).alias("best"))
    linked = found.groupBy("message").agg(
        F.count("*").alias("n_linked"), F.max(F.when(F.col("level") == 1, F.col("best.first"))).alias("parent")
    )
    linked = stored(linked, "links")
    counts = passages.groupBy("message").agg(F.count("*").alias("n_quotes"))
    replies = linked.where("parent is not null").select("message", F.col("parent.message").alias("parent"))
    roots = _roots(replies)
    turns = messages.select("message", F.col("turn").alias("thread"))
    roots = lookup(roots, turns.withColumnRenamed("message", "root"), "root").select("message", "thread", "depth")

    rows = quoting.join(counts, "message", "left").join(linked, "message", "left").join(roots, "message", "left")
    shown = rows.select(
        "conv_id",
        F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        "turn",
        "role",
        F.col("parent.turn").alias("reply_to"),
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "n_copies",
        "text",
    )
    zero = F.lit(0).cast("bigint")
    return plain.select(
        "conv_id", F.col("turn").alias("thread"), F.lit(0).alias("depth"), "turn", "role",
        F.lit(None).cast("bigint").alias("reply_to"), zero.alias("n_quotes"), zero.alias("n_linked"), "n_copies", "text",
    ).unionByName(shown)


def formatted(messages: DataFrame) -> DataFrame:
    """With ``formatted``: the message under its role's mark, as chat templates have it."""
    role, text = F.coalesce("role", F.lit("unknown")), F.coalesce("text", F.lit(""))
    return messages.withColumn("formatted", F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n")))
