"""Chat formatting by quotation linking, with DataFrame operations only.

A message's lines carry a quote level, the number of ``>`` they begin with.
Runs of lines of one level are passages; a passage is normalised (letters and
digits in lower case, single spaces) and hashed, as a whole and line by line.
What a message says itself (level 0) is hashed as a whole, by paragraph and by
line. A quoted passage belongs to the earliest message of the conversation
that says it unquoted, so each (conversation, hash) has one original and the
join never pairs copies with copies. A message replies to the latest of its
originals at the lowest quote level that has any.

Replies form trees. Their roots are found by pointer doubling, and a
conversation is put in reply order: threads by their first message, and in a
thread by turn, so every message follows the one that it answers. Ranks come
from a range-partitioned sort, so no task holds a conversation whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerflow.llm.storage import materialise

_QUOTE = r"^[ \t>]*>"  # no repeated group, which Java's matcher would recurse into
_WROTE = r"^On .* wrote:[ \t]*$"


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _hashes(texts: Column) -> Column:
    """Distinct hashes of the texts that hold a letter or digit."""
    distinct = F.array_distinct(texts)  # a text of one line is its own paragraph and line
    return F.array_distinct(F.transform(F.filter(F.transform(distinct, _normal), lambda x: x != ""), lambda x: F.md5(x)))


def parse(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, body, quote_levels, says, quotes) of each message.

    ``body`` is the text without quoted lines and without the ``On ... wrote:`` line before them; a null text has an
    empty body. ``says`` are hashes of what the body says, ``quotes`` (level, hash) of the quoted passages.
    """
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    cut = messages.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                          F.col(role_col).alias("role"), lines.alias("lines"))
    marks = F.transform("lines", lambda x: F.regexp_extract(x, _QUOTE, 0))
    leveled = cut.withColumn("levels", F.transform(marks, lambda m: F.length(F.regexp_replace(m, r"[^>]", ""))))
    content = F.transform("lines", lambda x: F.regexp_replace(x, _QUOTE + r"[ \t]?", ""))
    runs = leveled.withColumn("content", content).withColumn(
        "starts", F.filter(F.sequence(F.lit(1), F.size("levels")),
                           lambda i: (i == 1) | (F.get("levels", i - 1) != F.get("levels", i - 2))))
    own = F.filter("lines", lambda x, i: (F.get("levels", i) == 0)
                   & ~(x.rlike(_WROTE) & (F.coalesce(F.get("levels", i + 1), F.lit(0)) > 0)))
    passages = F.transform("starts", lambda s, j: F.struct(
        F.get("levels", s - 1).alias("level"),
        F.slice("content", s, F.coalesce(F.get("starts", j + 1), F.size("lines") + 1) - s).alias("lines")))
    cutted = runs.select("conv_id", "turn", "role", F.array_join(own, "\n").alias("body"),
                         F.array_max("levels").alias("quote_levels"),
                         F.filter(passages, lambda p: p["level"] > 0).alias("passages"))
    says = _hashes(F.concat(F.array("body"), F.split("body", r"\n[ \t]*\n"), F.split("body", "\n")))
    quotes = F.flatten(F.transform("passages", lambda p: F.transform(
        _hashes(F.concat(F.array(F.array_join(p["lines"], " ")), F.split(F.array_join(p["lines"], "\n"), r"\n[ \t]*\n"),
                         p["lines"])),
        lambda h: F.struct(p["level"].alias("level"), h.alias("hash")))))
    return cutted.select("conv_id", "turn", "role", "body", "quote_levels", says.alias("says"), quotes.alias("quotes"))


def reply_links(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to) of the messages that quote an earlier one. Messages without conversation or turn have none."""
    placed = parsed.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    originals = (placed.select("conv_id", "turn", F.explode("says").alias("hash"))
                 .groupBy("conv_id", "hash").agg(F.min("turn").alias("original")))
    quoted = placed.select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.level", "q.hash").distinct()
    best = F.max(F.struct((-F.col("level")).alias("level"), "original"))
    return (quoted.join(originals, ["conv_id", "hash"]).where("original < turn")
            .groupBy("conv_id", "turn").agg(best.alias("best"))
            .select("conv_id", "turn", F.col("best.original").alias("reply_to")))


def roots(links: DataFrame) -> DataFrame:
    """(conv_id, turn, thread, depth): the first message of each linked message's tree and the steps to it.

    Pointer doubling: a round joins each pointer that isn't at a root yet with its target's pointer, so a chain of
    n takes log n rounds, and messages that have arrived take no further part.
    """
    target = links.select("conv_id", F.col("turn").alias("thread"), F.lit(True).alias("linked"))
    pointers = materialise(
        links.select("conv_id", "turn", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth"))
        .join(target, ["conv_id", "thread"], "left")
        .select("conv_id", "turn", "thread", "depth", F.col("linked").isNull().alias("arrived")), "chat-pointers")
    while pointers.where("not arrived").limit(1).count():
        jump = pointers.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("next"),
                               F.col("depth").alias("more"), F.col("arrived").alias("ends"))
        stepped = (pointers.where("not arrived").join(jump, ["conv_id", "thread"])
                   .select("conv_id", "turn", F.col("next").alias("thread"), (F.col("depth") + F.col("more")).alias("depth"),
                           F.col("ends").alias("arrived")))
        pointers = materialise(pointers.where("arrived").union(stepped), "chat-pointers")
    return pointers.drop("arrived")


def reply_positions(nodes: DataFrame) -> DataFrame:
    """Add ``position``: 1 + the messages before (thread, turn) in the conversation; ``nodes`` has one row per
    (conv_id, thread, turn) with its number of messages ``n``."""
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "thread", "turn"]
    dealt = materialise(nodes.repartitionByRange(tasks, *order).withColumn("part", F.spark_partition_id()), "chat-order")
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = dealt.groupBy("part").agg(F.sum("n").alias("sum"))
    earlier = (parts.alias("a").join(parts.alias("b"), F.col("b.part") < F.col("a.part"), "left")  # one row per task
               .groupBy("a.part").agg(F.coalesce(F.sum("b.sum"), F.lit(0)).alias("before")))
    ranked = dealt.withColumn("upto", F.sum("n").over(within)).join(F.broadcast(earlier), "part")
    ranked = ranked.withColumn("at", F.col("before") + F.col("upto") - F.col("n"))
    first = ranked.groupBy(F.col("conv_id").alias("of")).agg(F.min("at").alias("first"))
    return ranked.join(first, F.col("conv_id").eqNullSafe(F.col("of"))).select("conv_id", "thread", "turn", (F.col("at") - F.col("first") + 1).alias("position"))


def format_chats(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, body, quote_levels, reply_to, thread, depth, position), one row per message.

    ``thread`` is the turn of the tree's first message (its own for messages that reply to none) and ``position`` the
    place in the conversation's reply order; rows of one conversation and turn share links and position. Null turns
    come first, a null conversation is one of its own. Extra columns are not read.
    """
    # written once: the line expressions are the costly part, and links, bodies and ranks all need some of it
    parsed = materialise(parse(messages, conv_col, turn_col, role_col, text_col), "chat-parsed")
    links = materialise(reply_links(parsed), "chat-links")
    trees = links.join(roots(links), ["conv_id", "turn"])
    # ids stand beside their null flags, as an equality join drops nulls
    keys = [F.coalesce(F.col("conv_id"), F.lit(0)).alias("k1"), F.col("conv_id").isNull().alias("k2"),
            F.coalesce(F.col("turn"), F.lit(0)).alias("k3"), F.col("turn").isNull().alias("k4")]
    turns = (parsed.select("conv_id", "turn")
             .groupBy("conv_id", "turn").agg(F.count("*").alias("n")))
    placed = turns.join(trees, ["conv_id", "turn"], "left").withColumn("thread", F.coalesce("thread", "turn"))
    ranked = materialise(reply_positions(placed.select("conv_id", "thread", "turn", "n")), "chat-ranks")
    known = (ranked.join(links, ["conv_id", "turn"], "left")
             .join(trees.select("conv_id", "turn", "depth"), ["conv_id", "turn"], "left")
             .select(*keys, "reply_to", "thread", F.coalesce("depth", F.lit(0)).alias("depth"), "position"))
    body = parsed.select("conv_id", "turn", "role", "body", "quote_levels", *keys)
    return body.join(known, ["k1", "k2", "k3", "k4"]).select(
        "conv_id", "turn", "role", "body", "quote_levels", "reply_to", "thread", "depth", "position")


def as_mail(conversations: DataFrame) -> DataFrame:
    """The conversations as mail: each message after the first quotes the turn before it and, one level deeper, the one before that.

    The tables hold no quotes of their own; the check query links these back.
    """
    first = conversations.groupBy("conv_id", "turn").agg(F.min(F.coalesce("text", F.lit(""))).alias("said"))

    def before(n: int) -> DataFrame:
        return first.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("said").alias(f"said{n}"))

    def quoted(said: str, mark: str) -> Column:
        return F.array_join(F.transform(F.split(said, "\n", -1), lambda x: F.concat(F.lit(mark), x)), "\n")

    joined = conversations.join(before(1), ["conv_id", "turn"], "left").join(before(2), ["conv_id", "turn"], "left")
    return joined.select("conv_id", "turn", "role", F.concat_ws(
        "\n", F.when(F.col("said1").isNotNull(), F.lit("On the turn before someone wrote:")),
        quoted("said2", "> > "), quoted("said1", "> "), "text").alias("text"))


def format_chats_sql(table: str = "conversations") -> str:
    """DuckDB SQL for :func:`format_chats` over :func:`as_mail`: the mail is rebuilt, cut into lines and linked by joins on text."""
    normal = "trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))".format
    return f"""
WITH RECURSIVE
heads AS (SELECT conv_id, turn, min(coalesce(text, '')) AS said FROM {table} GROUP BY ALL),
marked AS (
  SELECT h.conv_id, h.turn, 0 AS level, unnest(string_split(h.said, chr(10))) AS line, generate_subscripts(string_split(h.said, chr(10)), 1) AS i
  FROM heads h),
own AS (SELECT conv_id, turn, {normal('line')} AS unit FROM marked
        UNION SELECT conv_id, turn, {normal('said')} FROM heads
        UNION SELECT conv_id, turn, {normal('p')} FROM (SELECT conv_id, turn, unnest(regexp_split_to_array(said, '\\n[ \\t]*\\n')) AS p FROM heads)),
originals AS (SELECT conv_id, unit, min(turn) AS original FROM own WHERE unit <> '' GROUP BY ALL),
passages AS (
  SELECT n.conv_id, n.turn, q.level, q.unit
  FROM heads n JOIN (
    SELECT conv_id, turn + 1 AS turn, 1 AS level, {normal('line')} AS unit FROM marked
    UNION SELECT conv_id, turn + 1, 1, {normal("replace(said, chr(10), ' ')")} FROM heads
    UNION SELECT m.conv_id, m.turn + 2, 2, {normal('m.line')} FROM marked m
    UNION SELECT m.conv_id, m.turn + 2, 2, {normal("replace(m.said, chr(10), ' ')")} FROM heads m) q
  ON n.conv_id = q.conv_id AND n.turn = q.turn),
linked AS (
  SELECT p.conv_id, p.turn, max(struct_pack(level := -p.level, original := o.original)) AS best
  FROM passages p JOIN originals o ON p.conv_id = o.conv_id AND p.unit = o.unit WHERE o.original < p.turn GROUP BY ALL),
up AS (SELECT h.conv_id, h.turn, best.original AS reply_to FROM heads h LEFT JOIN linked USING (conv_id, turn)),
walk AS (
  SELECT conv_id, turn, turn AS thread, 0 AS depth FROM up WHERE reply_to IS NULL
  UNION ALL
  SELECT u.conv_id, u.turn, w.thread, w.depth + 1 FROM up u JOIN walk w ON u.conv_id = w.conv_id AND u.reply_to = w.turn),
quoted AS (SELECT h.conv_id, h.turn, CASE WHEN b.turn IS NOT NULL THEN 2 WHEN a.turn IS NOT NULL THEN 1 ELSE 0 END AS quote_levels
           FROM heads h LEFT JOIN heads a ON a.conv_id = h.conv_id AND a.turn = h.turn - 1
           LEFT JOIN heads b ON b.conv_id = h.conv_id AND b.turn = h.turn - 2)
SELECT c.conv_id, c.turn, c.role, coalesce(c.text, '') AS body, q.quote_levels, u.reply_to, w.thread,
       CAST(w.depth AS BIGINT) AS depth,
       CAST(rank() OVER (PARTITION BY c.conv_id ORDER BY w.thread, c.turn) AS BIGINT) AS position
FROM {table} c JOIN up u USING (conv_id, turn) JOIN walk w USING (conv_id, turn) JOIN quoted q USING (conv_id, turn)"""
