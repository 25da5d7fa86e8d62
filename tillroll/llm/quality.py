"""Quality rules with cross-document line frequency. DataFrame functions only.

Every document gets counts of its own text, and its lines are compared with the
other documents of its host (``source``). A line is boilerplate of a host when
more than ``max_docs`` distinct documents there hold it, and more than
``max_share`` of the host's distinct documents. Its lines above the limits are
removed from the text (``cleaned``, ``keep_good``); a document whose rebuilt text keeps
less than ``min_left`` of its words is depleted and rejected.

Lines are compared by a 60-bit md5 of their normal form (A-Z lowered, digits
to 0, white space to one space, trimmed). Equal texts of a host are one document,
told by the md5 of the whole text, so exact copies don't make their own text look like
boilerplate. A document without a line (empty, or white space only) counts nowhere.

Cases: a null text counts as empty (no words, ``base_failed``); a null source is
the host with the empty name; null or repeated ids and repeated rows each keep
their row, equal texts of a host get the same verdict; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import LOWER, UPPER, WHITE, hash60, let, stored

MIN_WORDS, MAX_REPEAT_PCT = 50, 50
MAX_DOCS, MAX_SHARE, MIN_LEFT = 20, 0.02, 0.3
#: Fixed values of the rules.
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{WHITE}+"), "")


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more. Windows are told apart
    by a 64-bit hash. Longs that hold 33 bits of it and the place are sorted first;
    only the few windows that agree there are compared by the whole hash."""
    def neighbours(s: Column, key) -> Column:
        same = lambda x, i: F.coalesce(key(x) == key(F.get(s, i)), F.lit(False))
        return F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))

    def covered(hashes: Column) -> Column:
        packed = F.sort_array(F.transform(
            hashes, lambda h, i: F.shiftleft(h, 31).bitwiseOR(i.cast("long"))))
        maybe = let(packed, lambda s: neighbours(s, lambda x: F.shiftright(x, 31)))
        full = F.sort_array(F.transform(maybe, lambda x: let(
            x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"),
            lambda i: F.struct(F.get(hashes, i).alias("h"), i.alias("i")))))
        twice = let(full, lambda s: neighbours(s, lambda x: x["h"]))
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return F.aggregate(
            places, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"),
                                    p.alias("last")),
            lambda acc: acc["n"].cast("long"))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(
            F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    # let: the optimiser may put the words' expression wherever their column stands
    return let(words, lambda w: F.when(F.size(w) < 3, F.lit(0).cast("long")).otherwise(
        let(windows(w), lambda h: F.when(
            F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))))


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{WHITE[1:-1]}]"))


def normal_line(line: Column) -> Column:
    plain = F.translate(line, f"{UPPER}123456789\t\x0b\x0c\r", f"{LOWER}{'0' * 9}{' ' * 4}")
    return F.trim(F.regexp_replace(plain, " {2,}", " "))


def base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of the base rules."""
    t = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn("_words", words_of(t)).select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines_of(t), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias(
            "n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
    )


def host_of(source: Column) -> Column:
    return F.coalesce(source.cast("string"), F.lit(""))


def host_lines(docs: DataFrame) -> DataFrame:
    """The distinct lines of each distinct (host, text): host, content, line hash."""
    t = F.coalesce(F.col("text"), F.lit(""))
    hashed = F.array_distinct(F.transform(lines_of(t), lambda x: hash60(normal_line(x))))
    return docs.select(
        host_of(F.col("source")).alias("host"), F.unhex(F.md5(t.cast("binary"))).alias("content"),
        F.explode(hashed).alias("line")).distinct()


def boilerplate_lines(lines: DataFrame, max_docs: int = MAX_DOCS,
                      max_share: float = MAX_SHARE) -> DataFrame:
    """(host, line, n_docs) of the lines above both limits."""
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("n_docs"))
    hosts = lines.select("host", "content").distinct().groupBy("host").agg(
        F.count("*").alias("host_docs"))
    return counts.where(F.col("n_docs") > max_docs).join(hosts, "host").where(
        F.col("n_docs") > max_share * F.col("host_docs")).select("host", "line", "n_docs")


def host_boilerplate(docs: DataFrame, max_docs: int = MAX_DOCS,
                     max_share: float = MAX_SHARE) -> DataFrame:
    """(host, gone): the hashes of the host's lines above both limits. Each stands in more than
    ``max_share`` of the documents, so they are less than ``1 / max_share`` times the lines of
    the host's mean document."""
    lines = stored(host_lines(docs), "lines")
    common = boilerplate_lines(lines, max_docs, max_share)
    return stored(common.groupBy("host").agg(F.collect_list("line").alias("gone")), "common-lines")


def without_lines(text: Column, gone: Column) -> Column:
    """The text rebuilt from its lines that are not in ``gone``; blank lines stay."""
    stays = lambda x: ~F.array_contains(gone, hash60(normal_line(x)))
    return F.when(gone.isNull() | text.isNull(), text).otherwise(
        F.array_join(F.filter(F.split(text, "\n"), stays), "\n"))


def with_boilerplate(docs: DataFrame, max_docs: int = MAX_DOCS,
                     max_share: float = MAX_SHARE) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct) and ``gone`` of its host (or null)."""
    common = host_boilerplate(docs, max_docs, max_share)
    return docs.select(F.struct("*").alias("row"), host_of(F.col("source")).alias("host")).join(
        common, "host", "left")


def cleaned(docs: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """One row per row of ``docs``, all columns, and ``clean_text``: its text without the lines
    above the limits."""
    rows = with_boilerplate(docs.drop("clean_text"), max_docs, max_share)
    clean = without_lines(F.col("row.text"), F.col("gone")).alias("clean_text")
    return rows.select("row", clean).select("row.*", "clean_text")  # the table may have a column gone


def is_depleted(clean_text: Column, n_words: Column, min_left: float) -> Column:
    return F.size(words_of(F.coalesce(clean_text, F.lit("")))) < min_left * n_words


def quality_rules(docs: DataFrame, min_words: int = MIN_WORDS,
                  max_repeat_pct: int = MAX_REPEAT_PCT, max_docs: int = MAX_DOCS,
                  max_share: float = MAX_SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, the base counts,
    ``base_failed`` and ``kept``."""
    rows = base_counts(cleaned(docs.select("doc_id", "text", "source"), max_docs, max_share))
    return rows.withColumn(
        "base_failed", (F.col("n_words") < min_words)
        | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~is_depleted(F.col("clean_text"), F.col("n_words"), min_left)).alias(
            "kept"))


def keep_good(docs: DataFrame, min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT,
              min_left: float = MIN_LEFT, **limits) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep, with the lines above the limits
    removed from ``text``; where that changes a text, ``n_chars`` (if there is one) follows."""
    row = F.col("row")

    def judged(n: Column) -> Column:  # n: words of a text that passes the base rules
        return let(F.when(n.isNotNull(), without_lines(row["text"], F.col("gone"))), lambda t: F.struct(
            t.alias("text"), (n.isNotNull() & ~is_depleted(t, n, min_left)).alias("good")))

    n = let(words_of(F.coalesce(row["text"], F.lit(""))), lambda w: F.when(
        (F.size(w) >= min_words) & (100 * repeated_words(w) <= max_repeat_pct * F.size(w)), F.size(w)))
    # explode of one: the filter can't be pushed below it, so texts are judged once
    kept = with_boilerplate(docs, **limits).select("row", F.explode(F.array(let(n, judged))).alias(
        "new")).where("new.good").select("row", F.col("new.text").alias("clean"))
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("clean") != row["text"], F.length("clean")).otherwise(
            row["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return kept.select(*(new.get(c, row[c]).alias(c) for c in docs.columns))
