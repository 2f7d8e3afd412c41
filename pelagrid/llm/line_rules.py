"""Quality rules with cross-document line frequency, in SQL functions only.

Base rules count words, symbols, repeated lines and repeated five-word windows of one
text. The line rule works across documents: the lines of all texts are normalised and hashed,
the different documents of a host (column ``source``) that have a line are counted, lines
above the limit are taken as boilerplate of that host, and a text that keeps too little
without them is rejected. Documents with equal texts count once, so copies of a text do not turn
its lines into boilerplate.

Hot lines and hosts are counted in the map tasks first (distinct, then count), and the
join that brings the counts back is left bare for adaptive skew handling.

Defined results: null text is an empty one, with all counts 0 and ``base_failed``; null hosts
are one host; repeated rows give repeated rows. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagrid.llm.graph import written

WORD = r"[^\x20\x09-\x0D]+"
SOLID = r"[^\x20\x09-\x0D]"
SYMBOL = "[#*$%&|<>]"
SPAN = 5  # words of a window


@dataclass(frozen=True)
class Limits:
    """A line is boilerplate in more than ``line_documents`` of a host's different documents, however large the host.

    A line of fewer than ``chance_words`` words returns by chance in a fixed share of all texts; it must also
    be in more than ``share`` of them.
    """

    min_words: int = 10
    repeat_percent: int = 20
    line_documents: int = 20
    chance_words: int = 4
    share: float = 0.05
    kept_words: int = 10  # words that a text must keep
    kept_share: float = 0.3  # and share of its words


def _lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(SOLID))


def _normal(line: Column) -> Column:
    """Lower case, digits as 0, runs of white space as one space, trimmed."""
    plain = F.regexp_replace(F.lower(line), "[1-9]", "0")
    return F.trim(F.regexp_replace(plain, r"[\x20\x09-\x0D]+", " "))


def base_counts(documents: DataFrame) -> DataFrame:
    """doc_id, source and text with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Each step is a projection of its own, so no list is computed once per element.
    listed = documents.select("doc_id", F.col("source").cast("string").alias("source"), text.alias("text"))
    listed = listed.withColumns(
        {"words": F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), "lines": _lines_with_words(F.col("text"))}
    )
    listed = listed.withColumn("n_words", F.size("words").cast("long"))
    hashed = listed.withColumn(
        "windows",
        F.when(
            F.col("n_words") >= SPAN,
            F.transform(
                F.sequence(F.lit(0), (F.col("n_words") - SPAN).cast("int")),
                lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(SPAN)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    # Only texts with a window found twice need places: sorted by hash, equal windows are
    # neighbours; each is marked by looking one back and one on.
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = hashed.withColumn(
        "placed",
        F.when(twice, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    again = placed.withColumn(
        "again",
        F.sort_array(
            F.transform(
                F.filter(
                    "placed",
                    lambda x, k: (F.get("placed", k - 1)["h"].eqNullSafe(x["h"]))
                    | (F.get("placed", k + 1)["h"].eqNullSafe(x["h"])),
                ),
                lambda x: x["i"],
            )
        ),
    )
    # A window covers its words up to the next window's first.
    covered = F.aggregate(
        F.transform("again", lambda i, k: F.least(F.lit(SPAN), F.coalesce(F.get("again", k + 1) - i, F.lit(SPAN)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    return again.select(
        "doc_id",
        "source",
        "text",
        "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def frequent_lines(
    documents: DataFrame, limits: Limits = Limits(), lines: DataFrame | None = None
) -> DataFrame:
    """host, line (hash) and documents for the lines above the limit of their host."""
    lines = _line_rows(documents) if lines is None else lines
    counted = (
        # A line has the same number of words wherever it stands.
        lines.select("host", "line", "words", "text_a", "text_b")
        .distinct()
        .groupBy("host", "line", "words")
        .agg(F.count("*").alias("documents"))
        .where(F.col("documents") > limits.line_documents)
    )
    host_size = (
        documents.select(_host().alias("host"), *_identity())
        .distinct()
        .groupBy("host")
        .agg(F.count("*").alias("size"))
    )
    return (
        counted.join(host_size, "host")
        .where((F.col("words") >= limits.chance_words) | (F.col("documents") > limits.share * F.col("size")))
        .drop("size", "words")
    )


def _host() -> Column:
    # A null host is told from any named one by the prefix.
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))


def _identity() -> list[Column]:
    """128 bits that stand for a text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.xxhash64(text).alias("text_a"), F.xxhash64(F.lit(7), text).alias("text_b")]


def _line_rows(documents: DataFrame) -> DataFrame:
    """One row for each text's line that has a word: host, text identity, line hash, words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (
        documents.select(_host().alias("host"), *_identity(), F.explode(_lines_with_words(text)).alias("raw"))
        .select(
            "host", "text_a", "text_b",
            F.xxhash64(_normal(F.col("raw"))).alias("line"),
            F.regexp_count("raw", F.lit(WORD)).cast("long").alias("words"),
        )
    )


def judge(documents: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Base counts, base_failed, boilerplate_words and kept for every row."""
    counts = base_counts(documents)
    counts = counts.select(
        F.struct(_host().alias("host"), *_identity()).alias("_text"), *[c for c in counts.columns if c != "text"]
    ).drop("source")
    lines = written(_line_rows(documents), "lines")
    common = frequent_lines(documents, limits, lines)
    # Lines were listed once for every row, so a text's sum holds each of its copies.
    copies = counts.groupBy("_text").agg(F.count("*").alias("_copies"))
    removed = (
        lines.groupBy("host", "line", "text_a", "text_b")
        .agg(F.sum("words").alias("words"))
        .join(common.drop("documents"), ["host", "line"])
        .groupBy(F.struct("host", "text_a", "text_b").alias("_text"))
        .agg(F.sum("words").alias("words"))
        .join(copies, "_text")
        .select("_text", (F.col("words") / F.col("_copies")).cast("long").alias("_removed"))
    )
    joined = counts.join(removed, "_text", "left").withColumn(
        "boilerplate_words", F.coalesce("_removed", F.lit(0)).cast("long")
    )
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words")
    )
    left = F.col("n_words") - F.col("boilerplate_words")
    depleted = (F.col("boilerplate_words") > 0) & (
        (left < limits.kept_words) | (left < limits.kept_share * F.col("n_words"))
    )
    return joined.withColumns({"base_failed": failed}).withColumn(
        "kept", ~F.col("base_failed") & ~depleted
    ).drop("_text", "_removed")


def without_frequent_lines(documents: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """All documents, with the boilerplate lines of their host taken out of the text; null texts stay null.

    Lines become rows and meet the boilerplate by (host, hash), so no host's list of lines is held in a
    row; what is left of each different text is put together once and joined back to its copies.
    """
    common = frequent_lines(documents, limits).select("host", "line")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    pieces = (
        documents.select(_host().alias("host"), *_identity(), text.alias("text")).dropDuplicates(["host", "text_a", "text_b"])
        .select("host", "text_a", "text_b", F.posexplode(F.split("text", "\n")).alias("at", "raw"))
        .withColumn("line", F.xxhash64(_normal(F.col("raw"))))
    )
    own = ["host", "text_a", "text_b"]
    touched = written(pieces.join(common, ["host", "line"], "left_semi").select(*own, "at"), "boilerplate")
    # Only texts that lose a line are put together again.
    left = (
        pieces.join(touched.select(*own).distinct(), own, "left_semi")
        .join(touched, [*own, "at"], "left_anti")
        .groupBy(*own)
        .agg(F.array_sort(F.collect_list(F.struct("at", "raw"))).alias("left"))
    )
    cleaned = touched.select(*own).distinct().join(left, own, "left").select(
        F.struct(*own).alias("_line_rules_key"),
        F.array_join(F.transform("left", lambda x: x["raw"]), "\n").alias("_line_rules_left"),
        F.lit(True).alias("_line_rules_cut"),
    )
    new = F.when(F.col("_line_rules_cut"), F.coalesce("_line_rules_left", F.lit(""))).otherwise(F.col("text"))
    return (
        documents.withColumn("_line_rules_key", F.struct(_host().alias("host"), *_identity()))
        .join(cleaned, "_line_rules_key", "left")
        .withColumn("text", new)
        .select(*documents.columns)
    )
