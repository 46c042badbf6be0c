"""Queries of problem 7."""

from fluelake.llm import scans
from fluelake.runtime import table


def p7_found(spark, sf_dir):
    return scans.found(table(spark, sf_dir, "extracted_text")).withColumnRenamed("id", "text_id")


def p7_repaired(spark, sf_dir):
    return scans.repaired(table(spark, sf_dir, "extracted_text")).withColumnRenamed("id", "text_id")


QUERIES = {"p7_found": p7_found, "p7_repaired": p7_repaired}
SQL: dict[str, str] = {}
