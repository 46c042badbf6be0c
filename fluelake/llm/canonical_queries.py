"""Queries of problem 5."""

from fluelake.llm import canonical
from fluelake.runtime import table

FIELDS = ["fuel_type", "unit_type", "unit_make"]


def p5_mapped(spark, sf_dir):
    rows, reference = table(spark, sf_dir, "permit_data_extracted"), table(spark, sf_dir, "reference_values")
    return canonical.mapped(rows, reference, "row_id", FIELDS).withColumnRenamed("id", "row_id")


def p5_found(spark, sf_dir):
    return p5_mapped(spark, sf_dir).select("row_id", "field_name", "ref_id")


QUERIES = {"p5_found": p5_found, "p5_mapped": p5_mapped}
SQL: dict[str, str] = {}
