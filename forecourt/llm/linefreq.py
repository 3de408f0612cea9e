"""Quality rules with cross-document line frequency (operator 5).

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import cut_lineage, helper_prefix

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_DOCUMENTS = 10
SMALL_HOST, SMALL_PERCENT, SMALL_LEAST = 200, 5, 2
LEAST_LEFT = 0.2
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def normal_line(line: Column) -> Column:
    """ASCII lower case, digits as 0, white space as single blanks without ends."""
    plain = F.trim(F.regexp_replace(line, SPACE, " "))
    return F.translate(plain, _UPPER + "123456789", _UPPER.lower() + "0" * 9)


def _keys(docs: DataFrame) -> list[Column]:
    """Two columns that rows share only if id, text and source are equal."""
    return [
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("__id"),
        F.xxhash64("text", F.col("source").cast("string"), F.col("doc_id").isNull()).alias("__same"),
    ]


def base_measures(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The measures of single documents, with the row keys in front.

    Repeated windows are found by 64-bit hashes of their words inside the row:
    hashes are sorted with their places, equal neighbours are repeats, and the
    words of repeated windows are counted from the sorted places. Nothing is
    exploded, so a text costs no shuffle however long it is.
    """
    rows = docs.select(
        *_keys(docs),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        _words(_text()).alias("words"),
        _lines(_text()).alias("lines"),
        F.regexp_count(_text(), F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
    )
    starts = F.when(
        F.size("words") >= window, F.sequence(F.lit(0), F.size("words") - window)
    ).otherwise(F.array().cast("array<int>"))
    rows = rows.select(
        "__id",
        "__same",
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform(
            starts, lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(window)))
        ).alias("hashes"),
    )
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    placed = F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    rows = rows.withColumn("placed", F.when(repeats, F.sort_array(placed))).drop("hashes")

    def repeated(item: Column, k: Column) -> Column:
        before, after = F.get("placed", k - 1)["h"], F.get("placed", k + 1)["h"]
        return item["h"].eqNullSafe(before) | item["h"].eqNullSafe(after)

    places = F.sort_array(F.transform(F.filter("placed", repeated), lambda item: item["i"]))
    rows = rows.withColumn("places", places).drop("placed")

    def new_words(place: Column, k: Column) -> Column:
        gap = place - F.get("places", k - 1)
        return F.least(F.lit(window), F.when(k == 0, window).otherwise(gap)).cast("bigint")

    covered = F.aggregate(
        F.transform("places", new_words), F.lit(0).cast("bigint"), lambda total, n: total + n
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0))).drop("places")


def document_lines(docs: DataFrame) -> DataFrame:
    """``__id, __same, source, document, line, line_words``: each distinct line of a row once.

    Rows with one ``doc_id`` are one ``document``, and those without one if their texts are equal.

    ``line`` is a hash of the normalised line, ``line_words`` the words of all
    its occurrences in the text. Lines without a word are left out.
    """
    lines = F.transform(
        _lines(_text()),
        lambda line: F.struct(
            F.xxhash64(normal_line(line)).alias("h"), F.size(_words(line)).alias("n")
        ),
    )
    return (
        docs.select(
            *_keys(docs),
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.xxhash64("text")))
            .alias("document"),
            F.posexplode(lines).alias("place", "item"),
        )
        .groupBy("__id", "__same", "source", "document", F.col("item.h").alias("line"), "place")
        .agg(F.first("item.n").cast("bigint").alias("n"))
        .groupBy("__id", "__same", "source", "document", "line")
        .agg(F.sum("n").alias("line_words"))
    )


def frequent_lines(
    lines: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    small_host: int = SMALL_HOST,
    small_percent: int = SMALL_PERCENT,
    small_least: int = SMALL_LEAST,
) -> DataFrame:
    """``host, line``: lines in more documents of their host than the limit.

    The limit is ``min_documents``, however large the host is. In hosts of fewer
    than ``small_host`` documents lines in more than ``small_percent`` of them, and
    in more than ``small_least`` documents, are frequent too. Documents are counted
    by their ids, so copies count.
    """
    counts = lines.groupBy("source", "line").agg(F.count_distinct("document").alias("n"))
    hosts = lines.groupBy("source").agg(F.count_distinct("document").alias("all"))
    hosts = hosts.select(F.col("source").alias("host"), "all")
    share = (F.col("all") < small_host) & (F.col("n") * 100 > F.col("all") * small_percent)
    return (
        counts.filter(F.col("n") > min(min_documents, small_least))
        .join(hosts, F.col("source").eqNullSafe(F.col("host")))
        .filter((F.col("n") > min_documents) | (share & (F.col("n") > small_least)))
        .select("host", "line")
    )


def _lost_lines(docs: DataFrame, **limits) -> DataFrame:
    """``__id, __same, lost, lost_words``: the frequent lines of the rows that have some."""
    lines = cut_lineage(document_lines(docs))
    frequent = cut_lineage(frequent_lines(lines, **limits).withColumnRenamed("line", "hot"))
    same = F.col("source").eqNullSafe(F.col("host")) & (F.col("line") == F.col("hot"))
    found = lines.join(frequent, same).select("__id", "__same", "line", "line_words")
    lost = found.groupBy("__id", "__same").agg(
        F.collect_list("line").alias("lost"), F.sum("line_words").alias("lost_words")
    )
    return cut_lineage(lost)


def judge(docs: DataFrame, least_left: float = LEAST_LEFT, **limits) -> DataFrame:
    """The measures and verdict of every row of ``docs``.

    ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    removed_words, base_failed, kept``. ``removed_words`` are the words of lines
    above the limits of ``frequent_lines``. A document is depleted, and not kept,
    if fewer than ``MIN_WORDS`` words are left or less than ``least_left`` of them.

    A null text has no words and fails. A null source is a host of its own.
    Repeated rows each get a row with equal values; no rows give none.
    """
    measures = base_measures(docs)
    lost = _lost_lines(docs, **limits).select("__id", "__same", "lost_words")
    removed = F.coalesce("lost_words", F.lit(0))
    left = F.col("n_words") - removed
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    depleted = (left < MIN_WORDS) | (left < F.col("n_words") * least_left)
    return measures.join(lost, ["__id", "__same"], "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        removed.alias("removed_words"),
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
    )


def clean(docs: DataFrame, least_left: float = LEAST_LEFT, **limits) -> DataFrame:
    """The kept rows of ``docs`` without their frequent lines.

    Other columns pass through, whatever their names.
    """
    p = helper_prefix(docs.columns)
    names = {"__id": f"{p}id", "__same": f"{p}same", "lost": f"{p}lost", "lost_words": f"{p}lost_words"}
    lost = _lost_lines(docs, **limits).withColumnsRenamed(names)
    id_, same = _keys(docs)
    rows = docs.select("*", id_.alias(f"{p}id"), same.alias(f"{p}same"))
    rows = rows.join(lost, [f"{p}id", f"{p}same"], "left")
    lines = F.filter(
        F.split("text", "\n"),
        lambda line: ~F.array_contains(f"{p}lost", F.xxhash64(normal_line(line))),
    )
    shorter = F.when(F.col(f"{p}lost").isNull(), F.col("text")).otherwise(F.array_join(lines, "\n"))
    n_words = F.size(_words(_text()))
    left = n_words - F.coalesce(f"{p}lost_words", F.lit(0))
    return rows.filter((left >= MIN_WORDS) & (left >= n_words * least_left)).select(
        *(shorter.alias("text") if name == "text" else F.col(name) for name in docs.columns)
    )
