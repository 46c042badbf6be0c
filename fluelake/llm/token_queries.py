"""Queries of problem 8."""

from fluelake.llm import tokens
from fluelake.runtime import table


def p8_ids(spark, sf_dir):
    return tokens.encoded(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ids")


QUERIES = {"p8_ids": p8_ids}
SQL: dict[str, str] = {}
