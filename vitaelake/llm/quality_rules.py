"""Quality rules: statistics of each document and the frequency of its lines across documents.

Built-in column functions only. The method: normalise every line (ASCII lower case, white space
as one space, digits as 0), hash it, and count in how many distinct documents of a host it
occurs; exact copies of a text count as one document, so copying a clean document does not make
its lines boilerplate. Lines above the limit are removed, and a document that keeps too small a
share of its distinct line characters is rejected as depleted.

Defined results: a null text is an empty one and fails the base rules; a null host is a host of
its own; a null doc_id is a value like any other; repeated rows get the same verdict each; an
empty table gives an empty table; other columns are carried by ``filter_documents`` unchanged.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaelake.llm.native import let, lower_ascii, row_digest, words

WINDOW = 5


@dataclass(frozen=True)
class Rules:
    """min_words and repeat_percent: base rules. max_documents: distinct documents of one host a
    line may occur in. min_left: share of line characters that must be left."""

    min_words: int = 10
    repeat_percent: int = 20
    max_documents: int = 100
    min_left: float = 0.3


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike("[^\\x09-\\x0D\\x20]"))


def normal_line(line: Column) -> Column:
    spaced = F.trim(F.regexp_replace(line, "[\\x09-\\x0D\\x20]+", " "))
    return F.regexp_replace(lower_ascii(spaced), "[0-9]", "0")


def repeated_words(text_words: Column) -> Column:
    """Words in 5-word windows that the text has twice or more.

    Windows are compared by a 64-bit hash. Only a text with an equal pair is sorted; its
    repeated windows, in order, then cover five words each, less what the next one covers too.
    """

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW),
            lambda at: F.xxhash64(*[F.get(hashes, at + step) for step in range(WINDOW)]),
        )

    def repeated_starts(ordered: Column) -> Column:
        def equal(at: Column, other: Column) -> Column:
            here, there = F.get(ordered, at)["key"], F.get(ordered, other)["key"]
            return F.coalesce(here == there, F.lit(False))

        repeated = F.filter(ordered, lambda _, at: equal(at, at - 1) | equal(at, at + 1))
        return F.sort_array(F.transform(repeated, lambda window: window["at"]))

    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.size(starts) - 1),
            F.lit(0).cast("long"),
            lambda total, at: total
            + F.least(F.coalesce(F.get(starts, at + 1) - F.get(starts, at), F.lit(WINDOW)), F.lit(WINDOW)),
        )

    def count(keys: Column) -> Column:
        ordered = F.sort_array(
            F.transform(keys, lambda key, at: F.struct(key.alias("key"), at.alias("at")))
        )
        return F.when(
            F.size(F.array_distinct(keys)) < F.size(keys),
            let(ordered, lambda rows: let(repeated_starts(rows), covered)),
        ).otherwise(F.lit(0).cast("long"))

    hashes = F.transform(text_words, lambda word: F.xxhash64(word))
    return F.when(
        F.size(text_words) > WINDOW, let(hashes, lambda row: let(windows(row), count))
    ).otherwise(F.lit(0).cast("long"))


def base_statistics(text: Column, rules: Rules) -> Column:
    """A struct of the statistics and the verdict of the base rules."""
    whole = F.coalesce(text, F.lit(""))

    def of_lines(lines: Column) -> Column:
        return F.size(lines) - F.size(F.array_distinct(lines))

    def of_words(row: Column) -> Column:
        return F.struct(
            F.size(row).cast("long").alias("n_words"),
            F.length(F.array_join(row, "")).cast("long").alias("word_chars"),
            F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines_with_words(text), of_lines).cast("long").alias("n_dup_lines"),
            repeated_words(row).alias("n_repeat_words"),
        )

    def judged(base: Column) -> Column:
        too_short = base["n_words"] < rules.min_words
        repeats = 100 * base["n_repeat_words"] > rules.repeat_percent * base["n_words"]
        return F.struct(
            *[
                base[name].alias(name)
                for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            ],
            (too_short | repeats).alias("base_failed"),
        )

    return let(let(words(text), of_words), judged)


def document_lines(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """The distinct normalised lines of each row: its key, host, text digest, line and length."""
    normal = F.transform(lines_with_words(F.col(text)), normal_line)
    hashed = F.array_distinct(
        F.transform(
            normal,
            lambda line: F.struct(F.xxhash64(line).alias("line"), F.length(line).alias("chars")),
        )
    )
    return docs.select(
        F.col(doc_id).alias("id"),
        row_digest(F.col(text), F.col(host)).alias("digest"),
        F.col(host).alias("host"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("content"),
        F.explode(hashed).alias("one"),
    ).select("id", "digest", "host", "content", "one.line", "one.chars")


def frequent_lines(lines: DataFrame, rules: Rules) -> DataFrame:
    """Lines in more than ``max_documents`` distinct documents of a host.

    Counted in two steps, (host, line, content) first, so that a line which a third of all
    documents share is spread over the tasks and reaches the second step as partial counts.
    """
    distinct = lines.select("host", "line", "content").distinct()
    counts = distinct.groupBy("host", "line").agg(F.count(F.lit(1)).alias("documents"))
    return counts.where(F.col("documents") > rules.max_documents).select("host", "line")


def removed_lines(lines: DataFrame, rules: Rules, with_lines: bool) -> DataFrame:
    """For each row key that loses lines: characters lost, and the lines if asked for.

    The frequent side has one row per key, so the join can split a hot line's documents; its
    size is measured at run time, and only a small one is broadcast.
    """
    frequent = frequent_lines(lines, rules).select(
        F.col("host").alias("frequent_host"), F.col("line").alias("frequent_line")
    )
    hit = lines.select("id", "digest", "host", "line", "chars").join(
        frequent,
        F.col("host").eqNullSafe(F.col("frequent_host"))
        & (F.col("line") == F.col("frequent_line")),
    )
    one_per_row = hit.select("id", "digest", "line", "chars").distinct() if with_lines else hit
    aggregates = [F.sum("chars").alias("lost_chars"), F.count(F.lit(1)).alias("lost_lines")]
    if with_lines:
        aggregates.append(F.collect_set("line").alias("lost"))
        return one_per_row.groupBy("id", "digest").agg(*aggregates)
    # A repeated row has each of its lines once per copy; the copies count is divided out.
    return one_per_row.groupBy("id", "digest", "line").agg(F.max("chars").alias("chars")).groupBy(
        "id", "digest"
    ).agg(*aggregates)


def verdicts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    rules: Rules = Rules(),
) -> DataFrame:
    """A row per document: doc_id, the statistics, base_failed, lost_lines, lost_chars, kept.

    Only narrow columns are shuffled; texts are read where they lie.
    """
    lines = document_lines(docs, doc_id, text, host)
    base = docs.select(
        F.col(doc_id).alias("doc_id"),
        row_digest(F.col(text), F.col(host)).alias("digest"),
        base_statistics(F.col(text), rules).alias("base"),
        line_chars(F.col(text)).alias("line_chars"),
    )
    lost = removed_lines(lines, rules, with_lines=False).select(
        F.col("id").alias("lost_id"), F.col("digest").alias("lost_digest"), "lost_chars", "lost_lines"
    )
    joined = base.join(
        lost,
        F.col("doc_id").eqNullSafe(F.col("lost_id")) & (F.col("digest") == F.col("lost_digest")),
        "left",
    )
    lost_chars = F.coalesce("lost_chars", F.lit(0)).cast("long")
    return joined.select(
        "doc_id",
        "base.*",
        F.coalesce("lost_lines", F.lit(0)).cast("long").alias("lost_lines"),
        lost_chars.alias("lost_chars"),
        (~F.col("base.base_failed") & enough_left(F.col("line_chars"), lost_chars, rules)).alias(
            "kept"
        ),
    )


def line_chars(text: Column) -> Column:
    """Characters of the distinct normalised lines."""
    distinct = F.array_distinct(F.transform(lines_with_words(text), normal_line))
    return F.length(F.array_join(distinct, "")).cast("long")


def enough_left(total: Column, lost: Column, rules: Rules) -> Column:
    return (total - lost) >= rules.min_left * total


def filter_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    rules: Rules = Rules(),
) -> DataFrame:
    """The documents that pass, without their frequent lines; all columns of the input."""
    lost = removed_lines(document_lines(docs, doc_id, text, host), rules, with_lines=True)
    lost = lost.select(
        F.struct(
            F.col("id").alias("id"),
            F.col("digest").alias("digest"),
            "lost",
            "lost_chars",
        ).alias("__lost")
    )
    passing = docs.where(~base_statistics(F.col(text), rules)["base_failed"])
    joined = passing.join(
        lost,
        F.col(doc_id).eqNullSafe(F.col("__lost.id"))
        & (row_digest(F.col(text), F.col(host)) == F.col("__lost.digest")),
        "left",
    )
    kept = joined.where(
        F.col("__lost").isNull()
        | enough_left(line_chars(F.col(text)), F.col("__lost.lost_chars"), rules)
    )
    left = F.filter(
        F.split(F.col(text), "\n"),
        lambda line: ~F.array_contains(F.col("__lost.lost"), F.xxhash64(normal_line(line))),
    )
    cleaned = F.when(F.col("__lost").isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    return kept.select(
        *[cleaned.alias(name) if name == text else F.col(f"`{name}`") for name in docs.columns]
    )
