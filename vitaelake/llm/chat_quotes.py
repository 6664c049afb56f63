"""Quotation linking: replies joined to the messages they quote, and told without the quotes.

Built-in column functions only. A line's quote level is the number of ``>`` it starts with.
Neighbouring lines of one level are a passage, whatever lines it is wrapped to: the marks off, ASCII
lower-cased, white space as single spaces, its runs of ``WINDOW`` words are hashed (all its words
and each of its lines, where it has fewer). Hashes of quoted passages are joined to those of what the
messages of the conversation wrote themselves, where any short line counts whole as well. A message replies to the
earlier one that agrees with most of its level-1 windows, the latest of equals, or else with most of
its deeper ones. Following replies up gives each message its thread and depth; conversations are read
by (conv_id, thread_turn, turn).

All pairs of a window that more than ``COMMON`` messages of a conversation wrote (a greeting, a
signature) would be many, so those are settled in three steps, which lose no pair that could win.
The messages that share a rarer window with the quote, and the latest earlier writer of each common
one, are scored exactly, on the windows of both kinds; messages that wrote the same common windows
count those once. That settles most quotes: no other message agrees with more than the common ones.
For the rest, a better message has one of the quote's rarest common windows, as many as it can miss:
the distinct sets of common windows that hold one are scored, and the latest earlier writer of each.

Defined results: a null text has no lines; lines without a word count for nothing, also between two
of one passage; quotes of what nobody wrote earlier in the conversation stay unlinked, and so do those
of fewer words than a window that are no whole line or passage; a null conv_id is a conversation of
its own; a message without turn can neither reply nor be replied to; repeated rows (equal conv_id
and turn) are one message for linking and stay one row each; an empty table gives an empty table;
further columns are ignored.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitaelake.llm.native import let, lower_ascii, staged

# Words that are hashed together, and messages that may have written them for all pairs to be made.
WINDOW = 5
COMMON = 64
# Turns of a conversation whose order is settled in one group.
TURNS = 1024
MARKS = "^[\\x09\\x20]*(?:>[\\x09\\x20]*)+"


def split_lines(text: Column) -> Column:
    """A struct of level and normalised text for every line with a word."""

    def parse(line: Column) -> Column:
        marks = F.regexp_extract(line, MARKS, 0)
        rest = F.regexp_replace(line, MARKS, "")
        plain = F.trim(F.regexp_replace(lower_ascii(rest), "[\\x09-\\x0D\\x20]+", " "))
        return F.struct(
            F.regexp_count(marks, F.lit(">")).cast("int").alias("level"), plain.alias("plain")
        )

    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(F.transform(lines, parse), lambda line: line["plain"] != "")


def without_quotes(text: Column) -> Column:
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    own = F.filter(lines, lambda line: ~line.rlike("^[\\x09\\x20]*>"))
    return F.trim(F.array_join(own, "\n"))


def passages(lines: Column) -> Column:
    """level and lines (the words of each) of every run of lines of one level."""
    told = F.transform(lines, lambda line: F.struct(line["level"], F.split(line["plain"], " ").alias("words")))

    def runs(told: Column) -> Column:
        numbers = F.when(F.size(told) > 0, F.sequence(F.lit(0), F.size(told) - 1))
        starts = F.filter(
            F.coalesce(numbers, F.array().cast("array<int>")),
            lambda at: (at == 0) | (F.get(told, at)["level"] != F.get(told, at - 1)["level"]),
        )
        return let(
            starts,
            lambda firsts: F.transform(
                firsts,
                lambda first, number: F.struct(
                    F.get(told, first)["level"].alias("level"),
                    F.slice(
                        told["words"],
                        first + 1,
                        F.coalesce(F.get(firsts, number + 1), F.size(told)) - first,
                    ).alias("lines"),
                ),
            ),
        )

    return let(told, runs)


def window_hashes(lines: Column, each: bool) -> Column:
    """Hashes of all runs of WINDOW words of a passage, or of all its words where there are fewer;
    and those of its short lines, in any passage if ``each``, or else in a short one only."""

    def hashes(words: Column) -> Column:
        last = F.greatest(F.size(words) - WINDOW, F.lit(0))
        runs = F.transform(F.sequence(F.lit(0), last), lambda at: F.xxhash64(F.slice(words, at + 1, WINDOW)))
        short = F.filter(lines, lambda line: F.size(line) < WINDOW)
        if not each:
            short = F.when(F.size(words) < WINDOW, short)
        own = F.coalesce(F.transform(short, lambda line: F.xxhash64(line)), F.array().cast("array<long>"))
        return F.array_union(runs, own)

    return let(F.flatten(lines), hashes)


def quoted_windows(messages: DataFrame) -> DataFrame:
    """conv, turn, key, level: the windows that a message quotes, each at its outermost level."""
    kept = messages.where(F.col("text").rlike("(?:^|\n)[\x09\x20]*>"))
    found = F.filter(passages(split_lines(F.col("text"))), lambda passage: passage["level"] > 0)
    told = kept.select("conv", "turn", F.explode(found).alias("passage"))
    keys = told.select(
        "conv", "turn", F.col("passage.level").alias("level"),
        F.explode(window_hashes(F.col("passage.lines"), each=False)).alias("key"),
    )
    return keys.groupBy("conv", "turn", "key").agg(F.min("level").alias("level"))


def written_windows(messages: DataFrame) -> DataFrame:
    """conv, turn, key: the windows of what a message wrote itself, and its short lines."""

    def own_keys(lines: Column) -> Column:
        runs = F.filter(passages(lines), lambda passage: passage["level"] == 0)
        return F.flatten(F.transform(runs, lambda run: window_hashes(run["lines"], each=True)))

    keys = let(split_lines(F.col("text")), own_keys)
    return messages.select("conv", "turn", F.explode(keys).alias("key")).distinct()


def latest_writers(quoted: DataFrame, written: DataFrame, kept: list[str]) -> DataFrame:
    """quoted (conv, turn, key and the columns ``kept``) with ``origin``, the latest earlier turn that
    wrote the key; null without one.

    The turns of a window are ordered in groups of bounded size, each of which takes over the
    latest writer of the groups before it.
    """
    group = F.floor(F.col("turn") / TURNS)
    writers = written.select("conv", "key", "turn", group.alias("group"))
    events = quoted.select("conv", "key", "turn", *kept, group.alias("group"), F.lit(None).cast("long").alias("wrote"))
    events = events.unionByName(
        writers.withColumn("wrote", F.col("turn")), allowMissingColumns=True
    )
    within = Window.partitionBy("conv", "key", "group").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    placed = events.withColumn("near", F.max("wrote").over(within)).where("wrote IS NULL")
    # One row for a group that wrote or quoted: the latest writer of all groups before.
    last = events.groupBy("conv", "key", "group").agg(F.max("wrote").alias("last"))
    earlier = Window.partitionBy("conv", "key").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    before = last.select("conv", "key", "group", F.max("last").over(earlier).alias("far"))
    return placed.join(before, ["conv", "key", "group"]).select(
        "conv", "turn", "key", *kept, F.coalesce("near", "far").alias("origin")
    )


def window_sets(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """Rows of ``by`` with ``name``: a digest of the windows that they hold together."""
    listed = F.concat_ws(",", F.sort_array(F.collect_set(F.hex("key"))))
    return rows.groupBy(*by).agg(F.unhex(F.md5(listed)).alias(name))


def set_overlaps(pairs: DataFrame, asked: DataFrame, told: DataFrame) -> DataFrame:
    """conv, asked_set, told_set, both: how many windows the sets of each pair share, if any."""
    pairs = pairs.select("conv", "asked_set", "told_set").distinct()
    met = pairs.join(asked, ["conv", "asked_set"]).join(told, ["conv", "told_set", "key"])
    return met.groupBy("conv", "asked_set", "told_set").agg(F.count(F.lit(1)).alias("both"))


def common_scores(
    rare: DataFrame, quoted: DataFrame, written: DataFrame, writers: DataFrame
) -> DataFrame:
    """conv, turn, outer, origin, agreed: ``rare`` (the same, by rare windows) with what origins share
    of the common windows ``quoted`` and ``written``, and with every other origin that may be the
    latest of those that agree with most."""
    spark = rare.sparkSession
    quote, side = ["conv", "turn"], ["conv", "turn", "outer"]
    asked_sets = staged(spark, window_sets(quoted, side, "asked_set"), "asked-sets")
    told_sets = staged(spark, window_sets(written, quote, "told_set"), "told-sets")
    asked = quoted.join(asked_sets, side).select("conv", "asked_set", "key").distinct()
    told = written.join(told_sets, quote).select("conv", "told_set", "key").distinct()
    asked, told = staged(spark, asked, "asked"), staged(spark, told, "told")
    late = latest_writers(quoted, written, ["outer"]).where("origin IS NOT NULL")
    late = staged(spark, late, "late")

    # What is known: all that agree in a rare window, and the latest writer of each common one.
    near = rare.unionByName(
        late.select(*side, "origin").distinct().withColumn("agreed", F.lit(0).cast("long"))
    )
    near = near.groupBy(*side, "origin").agg(F.max("agreed").alias("agreed"))
    of_origin = told_sets.withColumnRenamed("turn", "origin")
    placed = near.join(asked_sets, side, "left").join(of_origin, ["conv", "origin"], "left")
    placed = staged(spark, placed, "near")
    sets = ["conv", "asked_set", "told_set"]
    pairs = placed.where("asked_set IS NOT NULL AND told_set IS NOT NULL")
    placed = placed.join(set_overlaps(pairs, asked, told), sets, "left").select(
        *side, "origin", (F.col("agreed") + F.coalesce("both", F.lit(0))).alias("agreed")
    )
    scores = staged(spark, placed, "scores")

    # Quotes that another message may win: it shares all it agrees with among the common windows.
    most = scores.groupBy(*quote).agg(F.max(F.struct("outer", "agreed", "origin")).alias("most"))
    most = most.select(*quote, "most.*").withColumnRenamed("origin", "chosen")
    limits = late.groupBy(*side).agg(
        F.count(F.lit(1)).alias("windows"), F.min("origin").alias("earliest")
    )
    # Who wrote all of them wrote them no later than the earliest of the latest writers.
    unsettled = most.join(limits, side).where(
        "agreed < windows OR (agreed = windows AND chosen < earliest)"
    )
    unsettled = staged(spark, unsettled, "unsettled")
    rank = F.row_number().over(Window.partitionBy(*side).orderBy("writers", "key"))
    ranked = late.join(unsettled, side).join(writers, ["conv", "key"])
    first = ranked.withColumn("rank", rank).where("rank <= windows - agreed + 1")
    further = first.select(*side, "agreed", "key").join(told, ["conv", "key"])
    further = further.select(*side, "agreed", "told_set").distinct().join(asked_sets, side)
    further = staged(spark, further, "further")
    able = further.join(set_overlaps(further, asked, told), sets).where("both >= agreed")
    asking = able.select(*side, F.col("told_set").alias("key"), "both")
    telling = told_sets.select("conv", "turn", F.col("told_set").alias("key"))
    telling = telling.join(asking.select("conv", "key").distinct(), ["conv", "key"], "left_semi")
    found = latest_writers(asking, telling, ["outer", "both"]).where("origin IS NOT NULL")
    return scores.unionByName(found.select(*side, "origin", F.col("both").alias("agreed")))


def reply_edges(messages: DataFrame) -> DataFrame:
    """conv, turn, parent, n_windows, n_agreed: the message that each linked message replies to, the
    quoted windows of the level that tells, and how many of them it agrees with."""
    spark = messages.sparkSession
    quoted = staged(spark, quoted_windows(messages), "quoted")
    # Only what is quoted has to be found, and only where something is.
    asked = quoted.select("conv", "key").distinct()
    writing = messages.join(quoted.select("conv").distinct(), "conv", "left_semi")
    written = written_windows(writing).join(asked, ["conv", "key"], "left_semi")
    written = staged(spark, written, "written")
    writers = written.groupBy("conv", "key").agg(F.count(F.lit(1)).alias("writers"))
    common = writers.where(F.col("writers") > COMMON).select("conv", "key")
    by_key = ["conv", "key"]
    outer = (F.col("level") == 1).alias("outer")
    rare = quoted.join(common, by_key, "left_anti").join(
        written.withColumnRenamed("turn", "origin"), by_key
    )
    rare = rare.where(F.col("origin") < F.col("turn")).groupBy("conv", "turn", outer, "origin")
    rare = rare.agg(F.count(F.lit(1)).alias("agreed"))
    common = staged(spark, common, "common")
    scores = rare
    if not common.isEmpty():
        scores = common_scores(
            rare,
            quoted.join(common, by_key, "left_semi").select("conv", "turn", outer, "key"),
            written.join(common, by_key, "left_semi"),
            writers,
        )
    sizes = quoted.groupBy("conv", "turn", outer).agg(F.count(F.lit(1)).alias("n_windows"))
    best = F.max(F.struct("outer", "agreed", "origin")).alias("best")
    chosen = scores.groupBy("conv", "turn").agg(best).select(
        "conv", "turn", F.col("best.outer").alias("outer"), F.col("best.origin").alias("parent"),
        F.col("best.agreed").alias("n_agreed"),
    )
    return chosen.join(sizes, ["conv", "turn", "outer"]).select(
        "conv", "turn", "parent", "n_windows", "n_agreed"
    )


def thread_roots(edges: DataFrame) -> DataFrame:
    """conv, turn, root, depth for every message that replies.

    Each round doubles the distance looked up, so there are logarithmically many in the longest
    chain of replies; each is written to the shared folder.
    """
    spark = edges.sparkSession
    paths = edges.select(
        "conv", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")
    )
    while True:
        up = paths.select(
            "conv", F.col("turn").alias("root"), F.col("root").alias("further"), F.col("depth").alias("steps")
        )
        paths = staged(
            spark,
            paths.join(up, ["conv", "root"], "left").select(
                "conv",
                "turn",
                F.coalesce("further", "root").alias("root"),
                (F.col("depth") + F.coalesce("steps", F.lit(0))).alias("depth"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "threads",
        )
        moved = not paths.where("moved").isEmpty()
        paths = paths.drop("moved")
        if not moved:
            return paths


def link_quotes(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """A row per message: conv_id, turn, role, parent_turn, thread_turn, depth, n_quoted_lines,
    n_windows and n_agreed (quoted windows that told the parent, and how many it agrees with; 0
    without one), text without quotes."""
    spark = conversations.sparkSession
    # A conversation's key is never null, so that joins need no null-safe comparison.
    rows = conversations.select(
        F.struct(F.col(conv_id).isNull().alias("none"), F.coalesce(F.col(conv_id).cast("long"), F.lit(0)).alias("id")).alias("conv"),
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.col(role).alias("role"),
        F.col(text).alias("text"),
    )
    edges = staged(spark, reply_edges(rows.where(F.col("turn").isNotNull())), "replies")
    roots = thread_roots(edges)
    found = edges.join(roots, ["conv", "turn"])
    quoted = F.size(F.filter(split_lines(F.col("text")), lambda line: line["level"] > 0))
    return rows.join(found, ["conv", "turn"], "left").select(
        "conv_id",
        "turn",
        "role",
        F.col("parent").alias("parent_turn"),
        F.coalesce("root", "turn").alias("thread_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        quoted.cast("long").alias("n_quoted_lines"),
        F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_windows"),
        F.coalesce("n_agreed", F.lit(0)).cast("long").alias("n_agreed"),
        without_quotes(F.col("text")).alias("text"),
    )
