"""Queries of problem 4."""

from fluelake.llm import survivors
from fluelake.runtime import table


def p4_found(spark, sf_dir):
    return survivors.survivors(table(spark, sf_dir, "permit_data_extracted")).select("row_id")


def p4_records(spark, sf_dir):
    return survivors.records(table(spark, sf_dir, "permit_data_extracted"))


QUERIES = {"p4_found": p4_found, "p4_records": p4_records}
SQL: dict[str, str] = {}
