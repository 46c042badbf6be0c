"""Queries of problem 2."""

from fluelake.llm import addresses
from fluelake.runtime import cut, table


def p2_found(spark, sf_dir):
    pairs = addresses.same_place(table(spark, sf_dir, "permit_data_extracted"))
    return pairs.withColumnsRenamed({"file_a": "filename_a", "file_b": "filename_b"})


def p2_rewrites(spark, sf_dir):
    _, found = addresses.mined(cut(addresses.files(table(spark, sf_dir, "permit_data_extracted"))))
    return spark.createDataFrame(sorted(found.items()), "written string, meant string")


QUERIES = {"p2_found": p2_found, "p2_rewrites": p2_rewrites}
SQL: dict[str, str] = {}
