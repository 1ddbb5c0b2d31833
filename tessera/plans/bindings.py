"""Bind the driver's parquet tables to the shapes the operators expect.

* survey: a projection of ``lineitem`` (one respondent per line item)
* posts: ``orders`` as questions, ``lineitem`` as answers
* docs: ``documents``; pages: ``pages``

Every binding is a lazy projection of a parquet scan, so column pruning and
filter pushdown reach the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.text import format_posts

# Fixed values used by the catalogue queries.
DOC_TERMS = ("the", "The", "the,", "in", "und", "que", "a", "zzzabsent")
ORDER_TAGS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SPREAD = 50000
PER_TAG = 3
PER_TAG_PUBLISHED = 9  # 45 centers over the five order priorities
SEED = 42
SCORE_SHIFT = 25
INDEX_PAGE = 100
INDEX_BLOCK = 16
TWO_TERMS = ("the", "in")
BUCKETS = 8
# Event-time windows of the streams; no row of the tables is later than the lateness.
STREAM_WINDOW, STREAM_LATENESS, STREAM_PARTITIONS = "28 days", "4000 days", 8
ANSWER_PAGE = 3
MANY_CENTERS = 300
PER_SUPPLIER = 2

# A time-use file's width: (column, source column, factor) of 440 activities.
# The factors keep every product and sum exact in doubles, whatever the order.
WIDE_ACTIVITIES = tuple(
    (f"t{group}{i:04d}", source, factor)
    for g, group in enumerate(("01", "02", "03", "04", "05", "06", "07", "08", "09", "10", "11",
                               "12", "13", "14", "15", "16", "17", "18", "1801", "1803", "1805", "50"))
    for i in range(20)
    for source, factor in ((("l_quantity", "l_linenumber")[(g + i) % 2], 1 + (g * 20 + i) % 7),))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def survey_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey_from_lineitem(table(spark, sf_dir, "lineitem"))


def timed_answers(li: DataFrame, *, score_shift: int = 0) -> DataFrame:
    """Answers (ptype, id, parent, score) of line items, with the time ``at``."""
    return li.select(F.lit(2).alias("ptype"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("parent"),
                     (F.col("l_quantity").cast("int") - score_shift).alias("score"), F.col("l_shipdate").cast("timestamp").alias("at"))


def survey_from_lineitem(li: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """Wide survey: an id string, three respondent codes, eight activity columns (minutes).

    Column order matters: sums run left to right in this order. ``li`` may be
    a batch or a streaming frame.
    """
    return li.select(
        *[F.col(c).cast("timestamp").alias(c) for c in keep],
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("tucaseid"),
        F.col("l_linenumber").cast("double").alias("telfs"),
        (F.col("l_suppkey") % 2 + 1).cast("double").alias("tesex"),
        (F.col("l_partkey") % 90).cast("double").alias("teage"),
        F.col("l_quantity").alias("t010101"),
        (F.col("l_tax") * 100).alias("t030101"),
        (F.col("l_discount") * 100).alias("t050101"),
        (F.col("l_extendedprice") / 1000).alias("t180501"),
        (F.col("l_quantity") * 2).alias("t020101"),
        (F.col("l_tax") * 50).alias("t180101"),
        (F.col("l_discount") * 10).alias("t180901"),
        (F.col("l_quantity") * 7).alias("t170101"),
    )


def wide_survey_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survey with hundreds of activity columns, derived from ``lineitem``."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string)) as tucaseid",
        "cast(l_linenumber as double) as telfs", "cast(l_suppkey % 2 + 1 as double) as tesex", "cast(l_partkey % 90 as double) as teage",
        *[f"cast({c} * {f} as double) as {n}" for n, c, f in WIDE_ACTIVITIES])


def posts_frame(spark: SparkSession, sf_dir: str, *, score_shift: int = 0) -> DataFrame:
    """Posts (ptype, id, accepted, parent, score, tag): orders are questions, line items answers.

    Answer ids are ``l_orderkey * 10 + l_linenumber`` (line numbers stay below 10).
    ``score_shift`` lowers answer scores to produce negative values.
    """
    questions = table(spark, sf_dir, "orders").select(
        F.lit(1).alias("ptype"),
        F.col("o_orderkey").alias("id"),
        F.lit(None).cast("bigint").alias("accepted"),
        F.lit(None).cast("bigint").alias("parent"),
        F.lit(0).alias("score"),
        F.col("o_orderpriority").alias("tag"),
    )
    answers = table(spark, sf_dir, "lineitem").select(
        F.lit(2).alias("ptype"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.lit(None).cast("bigint").alias("accepted"),
        F.col("l_orderkey").alias("parent"),
        (F.col("l_quantity").cast("int") - F.lit(score_shift)).alias("score"),
        F.lit(None).cast("string").alias("tag"),
    )
    return questions.unionByName(answers)


def docs_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs_from_documents(table(spark, sf_dir, "documents"))


def docs_from_documents(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text")


def article_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, value): each document as a one-line article record."""
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(
        F.lit("<page> <title>"), F.concat(F.lit("Article "), F.col("doc_id").cast("string")),
        F.lit("</title><text>"), "text", F.lit("</text>  </page>")).alias("value"))


def pages_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "html")


def benchmark_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(term): every token of the benchmark's texts, repeats included."""
    return table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")).alias("term"))


def faulty_post_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): the posts as lines, some cut short, some with a word where a number belongs."""
    fault = F.col("id") % 50
    whole = format_posts(posts_frame(spark, sf_dir), keep=("id",))
    field = F.split("value", ",")
    return whole.select(
        F.when(fault == 1, F.concat_ws(",", field[0], field[1]))
        .when(fault == 2, F.regexp_replace("value", "[0-9]+,([^,]*)$", "x,$1"))
        .when(fault == 3, F.regexp_replace("value", "^([0-9]+,[0-9]+),", "$1,z")).otherwise(F.col("value")).alias("value"))


# The survey's whole numbers as CSV columns: (name, SQL over lineitem).
FAULTY_COLUMNS = (
    ("tucaseid", "cast(l_orderkey as string)"), ("telfs", "cast(l_linenumber as string)"),
    ("tesex", "cast(l_suppkey % 2 + 1 as string)"), ("teage", "cast(l_partkey % 90 as string)"),
    ("t010101", "cast(cast(l_quantity as int) as string)"), ("t050101", "cast(l_suppkey % 60 as string)"),
    ("t020101", "cast(l_partkey % 300 as string)"))


def write_faulty_survey(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The survey's whole numbers as CSV files with header; some lines short, long, with a bad or no number, or the header again."""
    names = [n for n, _ in FAULTY_COLUMNS]
    header = ",".join(names)
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey"), *[F.expr(e).alias(n) for n, e in FAULTY_COLUMNS])
    fault, line = F.col("l_orderkey") % 40, F.concat_ws(",", *names)
    value = (F.when(fault == 1, F.concat_ws(",", *names[:-1])).when(fault == 2, F.concat(line, F.lit(",7")))
             .when(fault == 3, F.concat_ws(",", *names[:3], F.lit(""), *names[4:]))
             .when(fault == 4, F.concat_ws(",", *names[:5], F.lit("abc"), *names[6:])).when(fault == 5, F.lit(header)).otherwise(line))
    li.select(value.alias(header)).write.option("header", True).option("quote", "\u0000").option("sep", "\u0001").csv(path)


def faulty_article_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, value): one-line articles, some without the marker and some cut off behind it."""
    fault = F.col("doc_id") % 20
    return article_lines(spark, sf_dir).select("doc_id", F.when(fault == 1, F.replace("value", F.lit("</title>"), F.lit("")))
                                               .when(fault == 2, F.concat(F.substring_index("value", "<text>", 1), F.lit("<text>cut")))
                                               .otherwise(F.col("value")).alias("value"))


def line_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, x, y): a point per line item, spread in both directions."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), (F.col("l_quantity").cast("int") * 100 + F.col("l_suppkey") % 100).cast("int").alias("x"),
        F.col("l_extendedprice").cast("int").alias("y"))
