"""Queries of problem 9."""

from fluelake.llm import mixing
from fluelake.runtime import table


def p9_mix(spark, sf_dir):
    chosen, _ = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))
    return chosen.withColumnRenamed("id", "doc_id")


def p9_shares(spark, sf_dir):
    _, report = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))
    return report


QUERIES = {"p9_mix": p9_mix, "p9_shares": p9_shares}
SQL: dict[str, str] = {}
