"""Quality rules from counts of words, symbols and repeats, and from how often lines recur across a host's documents.

Only DataFrame functions: every count of a text is an expression over its words, and only lines' hashes move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, table

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEATED = 30
MAX_DOCS = 20
MIN_LEFT = 0.3

_BREAKS = "\t\n\x0b\x0c\r"


def _any(text: Column, characters: str) -> Column:
    found = text.contains(characters[0])
    for c in characters[1:]:
        found |= text.contains(c)
    return found


def _spaced(text: Column) -> Column:
    """The text with spaces for other white space; the slow general form is only for texts that need it."""
    plain = F.replace(text, F.lit("\n"), F.lit(" "))
    return F.when(_any(text, _BREAKS.replace("\n", "")), F.translate(text, _BREAKS, " " * len(_BREAKS))).otherwise(plain)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(_spaced(text), " ", -1), "")


def _kept_chars(text: Column) -> Column:
    return F.length(F.replace(_spaced(text), F.lit(" "), F.lit("")))


def _symbols(text: Column) -> Column:
    return F.when(_any(text, SYMBOLS), F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).otherwise(0)


def _normal(line: Column) -> Column:
    """A line in lower case, without white space at its ends or in runs, its digits all zero."""
    spaced = _spaced(line)
    single = F.when(spaced.contains("  "), F.regexp_replace(spaced, " +", " ")).otherwise(spaced)
    digits = F.when(_any(line, "123456789"), F.translate(single, "123456789", "0" * 9)).otherwise(single)
    return F.lower(F.trim(digits))


def measured(docs: DataFrame) -> DataFrame:
    """A row per document: its counts, the hash and size of each of its lines, and one hash of them all (whole).

    Repeated windows are found by sorting the hashes of a text's windows with their positions, and only if
    there are fewer distinct hashes than windows. The steps are separate selects, so that Spark computes an
    array once and not once per element that reads it.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike("[^ \\t\\x0B\\f\\r]"))
    steps = (
        docs.select("doc_id", F.coalesce("source", F.lit("")).alias("host"), text.alias("text"))
        .select("*", _words(F.col("text")).alias("words"), lines.alias("lines"))
        .select(
            "doc_id",
            "host",
            F.xxhash64(F.col("doc_id").isNull(), "doc_id", "host", "text").alias("row_key"),
            F.size("words").cast("long").alias("n_words"),
            F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
            _symbols(F.col("text")).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
            F.transform("lines", lambda x: F.struct(_normal(x).alias("line"), _kept_chars(x).alias("chars"))).alias("lines"),
        )
        .withColumn(
            "windows",
            F.when(
                F.size("hashes") >= WINDOW,
                F.transform(
                    F.sequence(F.lit(0), F.size("hashes") - WINDOW),
                    lambda i: F.xxhash64(*[F.col("hashes")[i + k] for k in range(WINDOW)]),
                ),
            ),
        )
        .drop("hashes")
        .withColumn(
            "ranked",
            F.when(
                F.size(F.array_distinct("windows")) < F.size("windows"),
                F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))),
            ),
        )
        .drop("windows")
        .withColumn("last", F.size("ranked") - 1)
        .withColumn(
            "found",
            F.sort_array(
                F.filter(
                    F.transform(
                        "ranked",
                        lambda x, i: F.when(
                            ((i > 0) & (F.col("ranked")[F.greatest(i - 1, F.lit(0))]["h"] == x["h"]))
                            | ((i < F.col("last")) & (F.col("ranked")[F.least(i + 1, F.col("last"))]["h"] == x["h"])),
                            x["at"],
                        ),
                    ),
                    lambda at: at.isNotNull(),
                )
            ),
        )
        .drop("ranked")
        .withColumn("last", F.size("found") - 1)
        .withColumn(
            "covers",
            F.transform(
                "found",
                lambda at, i: F.when(i < F.col("last"), F.least(F.lit(WINDOW), F.col("found")[F.least(i + 1, F.col("last"))] - at)).otherwise(WINDOW),
            ),
        )
        .drop("found", "last")
        .withColumn("n_repeat_words", F.coalesce(F.aggregate("covers", F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"))
    )
    return steps.select(
        *[c for c in steps.columns if c not in ("lines", "covers")],
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))).alias("base_failed"),
        F.md5(F.array_join(F.transform("lines", lambda x: x["line"]), "\n")).alias("whole"),
        F.transform("lines", lambda x: F.struct(F.xxhash64(x["line"]).alias("line"), x["chars"].alias("chars"))).alias("lines"),
    )


def quality(docs: DataFrame, max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """One row per document row with its counts, base_failed, removed_chars and kept.

    A line is removed everywhere in a host (``source``) if it stands in more than ``max_docs`` distinct documents of it.
    Documents are distinct if their normalised lines differ anywhere, so copies of one document count once. A document
    is rejected if it fails the base rules or keeps less than ``min_left`` of its characters.

    Null texts count as empty, null hosts as the host ''. Null ids are kept as they are. Rows with equal doc_id, source
    and text are one document and get equal results. An empty table gives no rows; other columns are ignored.
    """
    scanned = checkpointed(measured(docs))
    lines = (
        scanned.select("row_key", "host", "whole", F.explode("lines").alias("line"))
        .groupBy("row_key", "host", "whole", F.col("line.line").alias("line"))
        .agg(F.sum("line.chars").alias("chars"), F.count("*").alias("times"))
    )
    # A hot line is summed by document on the map side, then by line: neither step holds a host's rows in one task.
    distinct = lines.groupBy("host", "line", "whole").agg(F.count("*").alias("rows"))
    frequent = distinct.groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > max_docs).select("host", "line")
    copies = scanned.groupBy("row_key").agg(F.count("*").alias("rows"))
    removed = (
        lines.join(frequent, ["host", "line"], "left_semi")
        .groupBy("row_key")
        .agg(F.sum("chars").alias("chars"))
        .join(copies, "row_key")
        .select("row_key", F.expr("chars div rows").alias("removed_chars"))
    )
    left = F.col("word_chars") - F.col("removed_chars")
    return (
        scanned.drop("lines", "whole", "host")
        .join(removed, "row_key", "left")
        .withColumn("removed_chars", F.coalesce("removed_chars", F.lit(0).cast("long")))
        .withColumn("kept", ~F.col("base_failed") & (left >= min_left * F.col("word_chars")))
    )


def op7_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).drop("row_key")


OP7_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, list_filter(string_split_regex(text, '[ \\t\\n\\x0b\\f\\r]'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0b\\f\\r]')) AS lines
  FROM d
), windows AS (
  SELECT row_no, pos, array_to_string(words[pos:pos + {WINDOW - 1}], ' ') AS shingle
  FROM (SELECT row_no, words, unnest(range(1, len(words) - {WINDOW - 2})) AS pos FROM w WHERE len(words) >= {WINDOW})
), twice AS (
  SELECT row_no, pos FROM windows QUALIFY count(*) OVER (PARTITION BY row_no, shingle) > 1
), covered AS (
  SELECT row_no, count(DISTINCT pos + k) AS n FROM twice, (SELECT unnest(range({WINDOW})) AS k) GROUP BY row_no
), line AS (
  SELECT row_no, line_no, host,
         lower(trim(regexp_replace(translate(line, '123456789' || chr(9) || chr(11) || chr(12) || chr(13), '000000000    '), ' +', ' ', 'g'), ' ')) AS line,
         length(regexp_replace(line, '[ \\t\\n\\x0b\\f\\r]', '', 'g')) AS chars
  FROM (SELECT row_no, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS line_no FROM w)
), whole AS (
  SELECT row_no, string_agg(line, chr(10) ORDER BY line_no) AS whole FROM line GROUP BY row_no
), frequent AS (
  SELECT host, line FROM line JOIN whole USING (row_no) GROUP BY host, line HAVING count(DISTINCT whole) > {MAX_DOCS}
), removed AS (
  SELECT row_no, sum(chars) AS chars FROM line SEMI JOIN frequent USING (host, line) GROUP BY row_no
), counted AS (
  SELECT row_no, doc_id, len(words) AS n_words, length(regexp_replace(text, '[ \\t\\n\\x0b\\f\\r]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (row_no)
), failed AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       coalesce(chars, 0)::BIGINT AS removed_chars,
       NOT base_failed AND word_chars - coalesce(chars, 0) >= {MIN_LEFT} * word_chars AS kept
FROM failed LEFT JOIN removed USING (row_no)
"""
