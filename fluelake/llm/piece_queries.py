"""Queries of problem 6."""

from pyspark.sql import functions as F

from fluelake.llm import pieces
from fluelake.runtime import table


def p6_pieces(spark, sf_dir):
    return pieces.split(table(spark, sf_dir, "extracted_text"), "text_id", "source").withColumnRenamed("id", "text_id")


def p6_found(spark, sf_dir):
    found = pieces.boundaries(table(spark, sf_dir, "extracted_text"), "text_id", "source")
    return found.select(F.col("id").alias("text_id"), "boundary")


QUERIES = {"p6_found": p6_found, "p6_pieces": p6_pieces}
SQL: dict[str, str] = {}
