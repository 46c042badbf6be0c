"""Queries of problem 10."""

from fluelake.llm import truncation
from fluelake.runtime import table


def p10_signs(spark, sf_dir):
    return truncation.judged(table(spark, sf_dir, "documents"), "doc_id", "text", "source").withColumnRenamed("id", "doc_id")


def p10_found(spark, sf_dir):
    return p10_signs(spark, sf_dir).where("cut").select("doc_id")


def p10_shares(spark, sf_dir):
    return truncation.shares(p10_signs(spark, sf_dir))


QUERIES = {"p10_found": p10_found, "p10_signs": p10_signs, "p10_shares": p10_shares}
SQL: dict[str, str] = {}
