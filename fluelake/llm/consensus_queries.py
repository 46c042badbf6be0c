"""Queries of problem 3."""

from pyspark.sql import functions as F

from fluelake.llm import consensus
from fluelake.runtime import table


def p3_consensus(spark, sf_dir):
    found, _ = consensus.run(table(spark, sf_dir, "validation_run"))
    return found.withColumnsRenamed({"item": "filename", "field": "field_name"})


def p3_found(spark, sf_dir):
    return p3_consensus(spark, sf_dir).select("filename", "field_name", "label")


def p3_reviewers(spark, sf_dir):
    _, reviewers = consensus.run(table(spark, sf_dir, "validation_run"))
    return reviewers.select(F.col("annotator").alias("reviewer"), F.col("field").alias("field_name"), "votes", "sigma", "change", "reliability")


def p3_agreement(spark, sf_dir):
    found, _ = consensus.run(table(spark, sf_dir, "validation_run"))
    return consensus.field_agreement(found).withColumnRenamed("field", "field_name")


QUERIES = {"p3_found": p3_found, "p3_consensus": p3_consensus, "p3_reviewers": p3_reviewers, "p3_agreement": p3_agreement}
SQL: dict[str, str] = {}
