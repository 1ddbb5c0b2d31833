"""Parent/child posts: pair questions with their answers, keep the best answer score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.numbering import rank_in_groups
from tessera.session import materialize

# Post type codes.
QUESTION, ANSWER = 1, 2


def _no_parent(parent: Column, otherwise: Column) -> Column:
    return F.when(parent.isNull(), F.raise_error(F.lit("answer without parent id"))).otherwise(otherwise)


def pair_parent_child(posts: DataFrame, *, type_col: str = "ptype", id_col: str = "id",
                      parent_col: str = "parent", score_col: str = "score", tag_col: str = "tag",
                      question_code: int = QUESTION, answer_code: int = ANSWER,
                      strict: bool = True) -> DataFrame:
    """(qid, tag, aid, score): one row per question and answer pair (inner join).

    Questions without answers and answers whose question is absent vanish;
    an answer with no parent id fails the job (``strict=False`` drops it). The
    answers stream through the join while the question side (one row per key)
    is buffered, and AQE splits a question with a huge answer list over tasks.

    The strict form joins the answers to the left of the questions and decides
    on the joined row: a match is kept, a null parent raises. So each side is
    scanned once, and the raise is in no join key, which Catalyst would copy
    into a filter on the other side.
    """
    answers = posts.where(F.col(type_col) == answer_code)
    questions = posts.where(F.col(type_col) == question_code)
    a = answers.select(F.col(parent_col).alias("qid"), F.col(id_col).alias("aid"), F.col(score_col).alias("score"))
    q = questions.select(F.col(id_col).alias("_question"), F.col(tag_col).alias("tag"))
    on = F.col("qid") == F.col("_question")
    if strict:
        joined = a.join(q, on, "left").where(_no_parent(F.col("qid"), F.col("_question").isNotNull()).cast("boolean"))
    else:
        joined = a.join(q, on)
    return joined.select("qid", "tag", "aid", "score")


def best_child_score(posts: DataFrame, *, floor: int | None = None, type_col: str = "ptype",
                     id_col: str = "id", parent_col: str = "parent", score_col: str = "score",
                     tag_col: str = "tag", question_code: int = QUESTION, answer_code: int = ANSWER,
                     strict: bool = True) -> DataFrame:
    """(qid, tag, score): highest answer score per answered question, one row per question id.

    One aggregate over all posts, keyed by the question they belong to: one
    scan, one shuffle, partial maxima map-side, so a question holding a third
    of all answers costs no more than any other. ``floor=0`` clamps the best
    score at zero; the default keeps negative scores. Of questions repeated
    under one id the smallest tag counts. An answer with no parent id fails
    the job unless ``strict=False``, which leaves it out.
    """
    is_question, is_answer = F.col(type_col) == question_code, F.col(type_col) == answer_code
    parent = F.col(parent_col)
    key = F.when(is_question, F.col(id_col)).otherwise(
        _no_parent(parent, parent).cast(posts.schema[id_col].dataType) if strict else parent)
    best = posts.where(is_question | is_answer).groupBy(key.alias("qid")).agg(
        F.min(F.when(is_question, F.col(tag_col))).alias("tag"), F.max(F.when(is_answer, F.col(score_col))).alias("score"),
        F.count_if(is_question).alias("_questions"), F.count_if(is_answer).alias("_answers"))
    best = best.where((F.col("_questions") > 0) & (F.col("_answers") > 0) & F.col("qid").isNotNull())
    score = F.col("score") if floor is None else F.greatest(F.lit(floor), F.col("score"))
    return best.select("qid", "tag", score.alias("score"))


# Answers per page of the nested pairs: no answer array grows beyond this.
ANSWER_PAGE_SIZE = 10_000


def pair_pages(posts: DataFrame, *, page_size: int = ANSWER_PAGE_SIZE, type_col: str = "ptype", id_col: str = "id",
               parent_col: str = "parent", score_col: str = "score", tag_col: str = "tag",
               question_code: int = QUESTION, answer_code: int = ANSWER, strict: bool = True) -> DataFrame:
    """(qid, tag, page, answers): each answered question with its answers as sorted arrays of (aid, score).

    The nested form of ``pair_parent_child``. The answers of a question, in
    (aid, score) order, are cut into pages of ``page_size``, numbered from 0, so
    no array grows with a question. A question of one page, which nearly every
    one is, is grouped by its id alone, in one shuffle. The answers of the
    others are ranked by range (``rank_in_groups``) and grouped by question and
    page, so a question with a third of all answers spreads over its pages. The
    arrays then meet the questions: the join has one row a page.

    An answer with no parent id fails the job unless ``strict=False``, which
    leaves it out; null ids come first within a question.
    """
    if page_size <= 0:
        raise ValueError("page_size must be positive")
    answers = posts.where(F.col(type_col) == answer_code)
    parent = F.col(parent_col)
    answers = answers.where(_no_parent(parent, F.lit(True)).cast("boolean") if strict else parent.isNotNull())
    # Written once: three jobs read it, and the strict check stays out of their join keys.
    answers = materialize(answers.select(parent.alias("qid"), F.col(id_col).alias("aid"), F.col(score_col).alias("score")), "answers")
    hot = answers.groupBy("qid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > page_size).select("qid")
    hot = materialize(hot, "paged-questions")  # at most one row per page_size answers
    item = F.struct("aid", "score")
    in_one = answers.join(hot, "qid", "left_anti").groupBy("qid").agg(
        F.lit(0).cast("bigint").alias("page"), F.array_sort(F.collect_list(item)).alias("answers"))
    ranked = rank_in_groups(answers.join(hot, "qid", "left_semi"), ["qid"], ["aid", "score"], out="rank")
    in_more = ranked.groupBy("qid", F.expr(f"rank div {page_size}").alias("page")).agg(
        F.array_sort(F.collect_list(item)).alias("answers"))
    questions = posts.where(F.col(type_col) == question_code).select(F.col(id_col).alias("_question"), F.col(tag_col).alias("tag"))
    pages = in_one.unionByName(in_more)
    return pages.join(questions, F.col("qid") == F.col("_question")).select("qid", "tag", "page", "answers")


def best_score_of_pages(pages: DataFrame, *, floor: int | None = None) -> DataFrame:
    """(qid, tag, score) from ``pair_pages``: the highest answer score of each question, over all its pages."""
    best = pages.groupBy("qid", "tag").agg(F.max(F.array_max(F.transform("answers", lambda a: a["score"]))).alias("score"))
    return best if floor is None else best.withColumn("score", F.greatest(F.lit(floor), "score"))
