"""Operator 9: chat formatting by quotation linking.  DataFrame functions only.

A line's quote level is the number of ``>`` marks that it begins with (blanks
between them don't count).  Lines that follow each other at one level are a
passage; its text, without marks, is normalised (lower case, runs of other than
letters and digits as one space) and cut into sliding windows of ``WINDOW``
words, so wrapping it anew or quoting a part of it changes nothing; a shorter
passage is one unit.  The windows of every message's own text, and its short
lines and sentences, meet them by a hash of 64 bits within the conversation; the
origin of a unit is the first message that has it as its own, found in one sort,
so no pairs multiply, and only conversations with quotes take part.

A message answers the origin of most units of its outermost level; inner levels,
which quote what the quoted message quoted, decide only where an outer one links
to nothing (of equals the later message).  Its own text is what is left without
quoted lines and the attribution lines above them.  ``thread_root`` and ``depth``
(found by doubling, a few rows a message whatever the length of a thread) order a
conversation by replies.

Defined results: a null or empty text has no lines and an empty own text.  A
message without a linked quote starts a thread (its own turn, depth 0).  Rows
that repeat a conversation and turn are linked alike.  Null ``conv_id`` or
``turn``: the message is formatted but never linked.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodfact.llm.common import checkpointed, text_of

WINDOW = 5
#: Messages whose units a task sorts, and the most of a conversation that goes to one task.
TASK, LONG = 4096, 16384
#: The marks before a quoted line; no group is repeated, so a line of any number of marks is matched in a loop.
MARKS = r"^[ \t]*+>[> \t]*+"
#: Lines that announce a quotation; longer ones are text.
ATTRIBUTION = r"(?i)^[ \t]*(on .+ wrote|.+ (wrote|writes|said)|(am|le) .+ (schrieb|a écrit).*|el .+ escribió)[ \t]*:[ \t]*$"
ATTRIBUTION_CHARS = 300
NOT_WORD = r"[^\p{L}\p{N}]+"
SHORT = r"^(?:[^\p{L}\p{N}]*+[\p{L}\p{N}]++){0,%d}+[^\p{L}\p{N}]*+\z" % (WINDOW - 1)  # fewer words than a window; read up to the word too many
_NEXT, _AFTER = "\x01", "\x02"  # before a passage, after its level


def normalised(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(text, NOT_WORD, " ")))


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, own_text, passages (level, words as one text), n_quoted (lines), quote_level (deepest), quotes (false: no quoted line)."""
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", text_of().alias("t"))
    quotes, clean = F.col("t").rlike(r"(?m)^[ \t]*+>"), F.replace(F.replace("t", F.lit(_NEXT), F.lit(" ")), F.lit(_AFTER), F.lit(" "))
    # quotes stands for itself: a filter goes below this and makes what it names anew, so none may need the lines
    rows = rows.select("conv_id", "turn", "role", "t", quotes.alias("quotes"), F.when(quotes, _by_level(F.split(clean, "\n", -1), _answer)).alias("answer"),
                       F.when(quotes, _by_level(F.split(clean, "\n", -1), _passages)).alias("passages"))
    return rows.select(
        "conv_id", "turn", "role", F.btrim(F.when(F.col("quotes"), F.col("answer.own")).otherwise(F.col("t")), F.lit(" \t\n\r")).alias("own_text"),
        "passages", F.coalesce("answer.n_quoted", F.lit(0)).cast("long").alias("n_quoted"),
        F.coalesce("answer.deepest", F.lit(0)).cast("long").alias("quote_level"), "quotes")


def _once(value: Column, use) -> Column:
    """``use`` of the value as a lambda's argument, which is made once; a column inside a lambda is made for each of its elements."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _by_level(lines: Column, use) -> Column:
    """``use`` of a message's lines and their quote levels."""
    return _once(lines, lambda line: _once(
        F.transform(line, lambda x: F.length(F.translate(F.regexp_extract(x, MARKS, 0), " \t", ""))), lambda level: use(line, level)))


def _answer(lines: Column, level: Column) -> Column:
    own = F.filter(lines, lambda x, i: (F.get(level, i) == 0) & ~(
        (i + 1 < F.size(lines)) & (F.coalesce(F.get(level, i + 1), F.lit(0)) > 0)
        & (F.length(x) <= ATTRIBUTION_CHARS) & F.rlike(x, F.lit(ATTRIBUTION))))
    return F.struct(F.array_join(own, "\n").alias("own"), F.size(F.filter(level, lambda x: x > 0)).alias("n_quoted"), F.array_max(level).alias("deepest"))


def _passages(lines: Column, level: Column) -> Column:
    joined = F.array_join(F.transform(lines, lambda x, i: F.concat(
        F.when((i > 0) & (F.get(level, i - 1) == F.get(level, i)), F.lit(" ")).otherwise(
            F.concat(F.lit(_NEXT), F.get(level, i).cast("string"), F.lit(_AFTER))),
        F.regexp_replace(x, MARKS, ""))), "")
    return F.transform(F.filter(F.split(joined, _NEXT), lambda p: ~p.startswith("0" + _AFTER) & (p != "")), lambda p: F.struct(
        F.split_part(p, F.lit(_AFTER), F.lit(1)).cast("int").alias("level"), normalised(F.split_part(p, F.lit(_AFTER), F.lit(2))).alias("words")))


def _windows(words: Column) -> Column:
    """Hashes of the windows of a normalised text; of a shorter one, of the whole."""
    return _once(F.split(words, " "), lambda w: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - WINDOW + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, WINDOW))))


def _met(texts: DataFrame) -> DataFrame:
    """conv_id, turn, level, parent_turn, n: how many units a message quotes from each origin.  ``last``: the last turn that quotes."""
    parts = F.concat(F.split("own_text", "\n"), F.split("own_text", r"[.!?\n]+"), F.array("own_text"))
    short = F.transform(F.filter(parts, lambda x: F.rlike(x, F.lit(SHORT))), normalised)
    said = F.transform(F.concat(F.array(normalised(F.col("own_text"))), short), lambda x: F.struct(F.lit(0).alias("level"), x.alias("words")))
    none = F.array().cast("array<struct<level:int,words:string>>")
    pieces = F.filter(F.concat(F.when(F.col("turn") < F.col("last"), said).otherwise(none), F.coalesce("passages", none)), lambda x: x["words"] != "")
    # outer, as of the others Spark makes a filter that makes the array once more
    units = (texts.select("conv_id", "turn", F.inline_outer(pieces))
             .select("conv_id", "turn", "level", F.explode_outer(_windows(F.col("words"))).alias("h")).where("h IS NOT NULL"))
    # one sort: the first to say a unit is the least turn before; of equal units of a message the first one counts
    unit = Window.partitionBy("h", "conv_id").orderBy("turn", "level")
    origin = F.min(F.when(F.col("level") == 0, F.col("turn"))).over(unit.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (units.select("*", origin.alias("parent_turn"), (F.row_number().over(unit) == F.rank().over(unit)).alias("first"))
            .where("level > 0 AND first AND parent_turn < turn").groupBy("conv_id", "turn", "level", "parent_turn").agg(F.count("*").alias("n")))


def links(rows: DataFrame) -> DataFrame:
    """conv_id, turn, parent_turn of each message with a linked quotation (one row for each)."""
    keyed = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    asked = checkpointed(keyed.groupBy("conv_id").agg(F.count("*").alias("messages"), F.max(F.when(F.col("quotes"), F.col("turn"))).alias("last"))
                         .where("last IS NOT NULL"))
    messages, longest = asked.agg(F.sum("messages"), F.max("messages")).first()
    if messages is None:
        return keyed.select("conv_id", "turn", F.col("turn").alias("parent_turn")).limit(0)
    # texts are dealt out by conversation, so that units, many times as large, stay where they are made
    texts = keyed.select("conv_id", "turn", "own_text", "passages")
    tasks = min(-(-messages // TASK), 8 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    short, long = asked.where(F.col("messages") <= LONG), F.broadcast(asked.where(F.col("messages") > LONG))
    dealt = texts if longest <= LONG else texts.join(long, "conv_id", "left_anti")
    met = _met(dealt.repartition(tasks, "conv_id").join(short, "conv_id"))
    if longest > LONG:  # no task could hold such a conversation: its units are dealt out by themselves
        met = met.union(_met(texts.join(long, "conv_id")))
    best = met.groupBy("conv_id", "turn").agg(F.max(F.struct(-F.col("level"), "n", "parent_turn")).alias("best"))
    # few rows a task are left: the rounds of threads() read them in larger parts
    return best.select("conv_id", "turn", F.col("best.parent_turn").alias("parent_turn")).repartition(-(-tasks // 16), "conv_id", "turn")


def threads(parents: DataFrame) -> DataFrame:
    """conv_id, turn, thread_root, depth of each message with a parent: the way up doubles each round."""
    now = checkpointed(parents.select("conv_id", "turn", F.col("parent_turn").alias("up"), F.lit(1).cast("long").alias("depth")))
    while not now.isEmpty():
        above = now.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("further"), F.col("depth").alias("more"))
        now = checkpointed(now.join(above, ["conv_id", "up"], "left").select(
            "conv_id", "turn", F.coalesce("further", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("further").isNotNull().alias("moved")))
        done = now.where("moved").isEmpty()
        now = now.drop("moved")
        if done:
            break
    return now.select("conv_id", "turn", F.col("up").alias("thread_root"), "depth")


def _placed(rows: DataFrame, *kept: Column) -> DataFrame:
    """A row for each message with its place in the threads; ``kept`` is what goes along of its text."""
    parents = checkpointed(links(rows))
    placed = parents.join(threads(parents), ["conv_id", "turn"])
    out = rows.select("conv_id", "turn", "role", "quote_level", "n_quoted", F.struct(*kept).alias("kept")).join(placed, ["conv_id", "turn"], "left")
    return out.select("conv_id", "turn", "role", "parent_turn", F.coalesce("thread_root", "turn").alias("thread_root"),
                      F.coalesce("depth", F.lit(0)).alias("depth"), "quote_level", "n_quoted", "kept.*")


def chats(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, parent_turn, thread_root, depth, quote_level, n_quoted, content: a row for each message, quotes removed."""
    return _placed(parsed(messages), F.col("own_text").alias("content"))


def formatted(rows: DataFrame) -> DataFrame:
    """The messages of ``chats`` with their chat markup, to be written ordered by conv_id, thread_root, depth, parent_turn and turn."""
    return rows.withColumn("markup", F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), "content", F.lit("\n")))


def digests(messages: DataFrame) -> DataFrame:
    own = F.col("own_text")
    return _placed(parsed(messages), F.length(own).cast("long").alias("n_chars"), F.md5(own.cast("binary")).alias("content_md5"))


def with_quotations(messages: DataFrame) -> DataFrame:
    """The conversations as if every message quoted what it answers: odd turns the one before, wrapped anew below an
    attribution; even turns the two before, one level deeper the older one."""
    base = (messages.where("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "turn")
            .agg(F.min("role").alias("role"), F.min(text_of()).alias("text")))
    before = [base.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("text").alias(f"text{k}")) for k in (1, 2)]
    rows = base.join(before[0], ["conv_id", "turn"], "left").join(before[1], ["conv_id", "turn"], "left")

    def quote(text: Column, marks: str) -> Column:
        return F.concat(F.lit(marks), F.replace(text, F.lit("\n"), F.lit("\n" + marks)), F.lit("\n"))

    wrapped = F.regexp_replace("text1", r"((?:\S+ ){6})", "$1\n")
    odd = F.concat(F.lit("On Monday, A wrote:\n"), quote(wrapped, "> "), F.col("text"))
    even = F.concat(quote(F.col("text2"), "> > "), quote(F.col("text1"), "> "), F.col("text"))
    text = F.when((F.col("turn") % 2 == 1) & F.col("text1").isNotNull(), odd).when(
        (F.col("turn") % 2 == 0) & F.col("text1").isNotNull() & F.col("text2").isNotNull(), even).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", "role", text.alias("text"))
