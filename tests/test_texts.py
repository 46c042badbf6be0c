from fluelake.plans import flows
from fluelake.runtime import table


def test_every_text_makes_the_round_trip(spark, small):
    d = table(spark, small, "extracted_text").where("source is not null and source <> ''")
    want = sorted((r.text_id, r.n) for r in d.select("text_id", F.length("source").alias("n")).collect())
    got = flows.texts_back(spark, small).collect()
    assert sorted((r.text_id, r.chars_read) for r in got) == want and all(r.chars == r.chars_read for r in got)
