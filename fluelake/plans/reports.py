"""Queries of quality, coverage and descriptive statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from fluelake.functions import text as T
from fluelake.operators import quality, stats
from fluelake.operators.sampling import quantile_bins
from fluelake.plans import sqltools as S
from fluelake.plans.scalars import EQUIPMENT, PLACEHOLDERS, SENTINELS
from fluelake.runtime import table

P, DOC, VAL = "permit_data_extracted", "documents", "validation_run"
STATES = "AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY PR VI GU AS MP".split()
FIELDS = ["facility_name", "facility_city", "facility_zip_code", "unit_id", "unit_make", "capacity_value", "capacity_unit", "fuel_type", "pollutants", "emission_limits", "opacity_limit"]
#: The tables' texts are shorter than usual ones, so edges and thresholds are scaled down.
SIZE_BINS = [0, 1_000, 2_000, 4_000, 8_000, 12_000, 20_000, 30_000, 10**9]
CATEGORIES = [
    ("location", ["address", "city", "zip", "county", "state"]), ("dates", ["date", "year"]), ("permit", ["permit", "regulatory", "authority"]), ("facility", ["facility", "owner", "industry"]),
]


def _p(spark, sf_dir):
    return table(spark, sf_dir, P)


def state_rollup(spark, sf_dir):
    """Files, units and rows by state, and over all."""
    d = _p(spark, sf_dir).select(F.upper(T.strip(F.col("facility_state_abbreviation"))).alias("state"), "filename", "unit_id")
    agg = [F.countDistinct("filename").alias("files"), F.sum(quality.present(F.col("unit_id")).cast("bigint")).alias("units"), F.count("*").alias("rows")]
    return d.groupBy("state").agg(*agg).unionByName(d.agg(*agg).withColumn("state", F.lit("TOTAL")))


def status_counts(spark, sf_dir):
    return _p(spark, sf_dir).groupBy("status", "source_run", "model_used").agg(F.count("*").alias("rows"))


def kpis(spark, sf_dir):
    site = T.joined_key(F.col("facility_name"), F.col("facility_city"), F.col("facility_state_abbreviation"))
    d = _p(spark, sf_dir).select(site.alias("site"), "facility_state_abbreviation", "permit_number", "filename")
    a = d.agg(F.countDistinct("site").alias("sites"), F.count("*").alias("units"), F.countDistinct("facility_state_abbreviation").alias("states"), F.countDistinct("permit_number").alias("permits"), F.countDistinct("filename").alias("files"))
    return a.join(F.broadcast(d.groupBy("site").agg(F.count("*").alias("n")).agg(F.median("n").alias("median_units"))), F.lit(True))


def site_table(spark, sf_dir):
    """Sites with the first stated facility, city and state, and their size."""
    site = T.joined_key(F.col("facility_name"), F.col("facility_city"), F.col("facility_state_abbreviation"))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("row_id"))).alias(c)
    return _p(spark, sf_dir).groupBy(site.alias("site")).agg(*[first(c) for c in ("facility_name", "facility_city", "facility_county")], F.count("*").alias("units"))


def box_stats(spark, sf_dir):
    """Capacities of the eight commonest units."""
    n = F.regexp_replace(T.strip(F.col("capacity_value")), ",", "")
    d = _p(spark, sf_dir).select(T.capacity_unit(F.col("capacity_unit")).alias("unit"), F.when(n.rlike(r"^[0-9]+(\.[0-9]+)?$"), n.try_cast("double")).alias("v")).where("unit <> ''")
    return stats.box_stats(d, "unit", "v", 8)


def top_values(spark, sf_dir):
    """The 15 commonest fuels and unit types, after folding."""
    out = None
    for c in ("fuel_type", "unit_type", "control_devices", "industry_description"):
        d = _p(spark, sf_dir).select(T.fold_label(F.col(c)).alias("value")).where("value is not null").groupBy("value").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "value").limit(15).select(F.lit(c).alias("field"), "value", "rows")
        out = d if out is None else out.unionByName(d)
    return out


def top_pairs(spark, sf_dir):
    """The 15 commonest pairs of make and model, placeholders left out after counting."""
    d = _p(spark, sf_dir).where("unit_make is not null and unit_model is not null").groupBy("unit_make", "unit_model").agg(F.count("*").alias("rows"))
    make, model = T.strip(F.col("unit_make")), T.strip(F.col("unit_model"))
    d = d.where(~F.lower(make).isin("", *PLACEHOLDERS) & ~F.lower(model).isin("", *PLACEHOLDERS))
    return d.select(F.concat_ws(" ", make, model).alias("value"), "rows").orderBy(F.desc("rows"), "value").limit(15)


def top_with_other(spark, sf_dir):
    d = _p(spark, sf_dir).select(F.coalesce(T.fold_label(F.col("unit_type")), F.lit("unclassified")).alias("label")).groupBy("label").agg(F.count("*").alias("units"))
    return stats.top_with_other(d, "label", "units", 13, "Other")


def vintage_median(spark, sf_dir):
    """Units by year of manufacture from 1940 on, running, and the year of the median unit."""
    d = _p(spark, sf_dir).select(T.year_in(F.col("year_of_manufacture")).alias("year")).where("year >= 1940").groupBy("year").agg(F.count("*").alias("units"))
    return stats.median_of_counts(d, "year", "units")


def missingness(spark, sf_dir):
    return quality.missing_shares(_p(spark, sf_dir).where(F.col("status").startswith("Success")), FIELDS)


def state_completeness(spark, sf_dir):
    """Share of stated values by state and field."""
    d = _p(spark, sf_dir).groupBy("facility_state_abbreviation").agg(*[F.round(F.avg(quality.present(F.col(f)).cast("double")), 6).alias(f) for f in FIELDS])
    return d.unpivot(["facility_state_abbreviation"], FIELDS, "field", "share").withColumnRenamed("facility_state_abbreviation", "state")


def qc_report(spark, sf_dir):
    """Quality figures of successful rows, in one pass."""
    c = F.col
    ok = lambda f, cond: F.sum(F.when(quality.present(c(f)) & F.coalesce(cond, F.lit(False)), 1).otherwise(0))
    has = lambda f: F.sum(quality.present(c(f)).cast("bigint"))
    iso = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
    metrics = {
        "rows": F.count("*"), "issuance_stated": has("issuance_date"), "issuance_iso": ok("issuance_date", c("issuance_date").rlike(iso)), "expiration_iso": ok("expiration_date", c("expiration_date").rlike(iso)),
        "state_stated": has("facility_state_abbreviation"), "state_valid": ok("facility_state_abbreviation", T.strip(c("facility_state_abbreviation")).isin(STATES)),
        "zip_stated": has("facility_zip_code"), "zip_valid": ok("facility_zip_code", T.strip(c("facility_zip_code")).rlike(r"^[0-9]{5}(-[0-9]{4})?$")),
        "capacity_stated": has("capacity_value"), "capacity_with_unit": ok("capacity_value", quality.present(c("capacity_unit"))), "unit_ids": has("unit_id"), "one_letter_ids": ok("unit_id", F.length(T.strip(c("unit_id"))) <= 1),
        "error_cells": reduce(lambda a, b: a + b, [F.sum(F.when(F.upper(T.strip(c(f))) == "ERROR", 1).otherwise(0)) for f in FIELDS]),
    }
    d = _p(spark, sf_dir).where(c("status").startswith("Success")).agg(*[v.cast("bigint").alias(k) for k, v in metrics.items()])
    return d.unpivot([], list(metrics), "metric", "value")


def duplicate_groups(spark, sf_dir):
    d = _p(spark, sf_dir).where(F.col("status").startswith("Success") & quality.present(F.col("unit_id"))).select("row_id", "filename", "unit_id")
    return quality.duplicated(d, ["filename", "unit_id"])


def _sized(spark, sf_dir):
    units = _p(spark, sf_dir).where("status = 'Success'").groupBy("filename").agg(F.count("*").alias("units"))
    texts = table(spark, sf_dir, "extracted_text").where("source is not null").groupBy("filename").agg(F.max(F.length("source")).cast("bigint").alias("chars"), F.max(F.regexp_count("source", F.lit(quality.EQUIPMENT))).cast("bigint").alias("mentions"))
    return units.join(texts, "filename")


def recall_by_size(spark, sf_dir):
    """Units found by size of the text in eight right-closed bins."""
    return quality.recall_by_size(_sized(spark, sf_dir), SIZE_BINS)


def recall_suspects(spark, sf_dir):
    """Long texts that name much equipment and gave few units."""
    return quality.recall_suspects(_sized(spark, sf_dir), least_chars=4_000, least_mentions=10, most_units=8).select("filename", "chars", "units", "mentions", "per_unit")


def rule_validate(spark, sf_dir):
    return _p(spark, sf_dir).select("row_id", F.array_join(quality.rule_errors(), ",").alias("broken"))


def extraction_accuracy(spark, sf_dir):
    """Run b's units against run a's as truth: kinds of match by field, and the score."""
    fields = ["unit_make", "unit_type", "fuel_type", "capacity_unit", "unit_description"]
    d = _p(spark, sf_dir).where("status = 'Success' and unit_id is not null")
    one = lambda r: d.where(F.col("source_run") == r).groupBy("filename", "unit_id").agg(*[F.min_by(f, "row_id").alias(f"{f}_{r[-1]}") for f in fields])
    j = one("run_a").join(one("run_b"), ["filename", "unit_id"])
    kinds = [quality.match_type(F.col(f"{f}_b"), F.col(f"{f}_a")) for f in fields]
    return j.select("filename", "unit_id", F.concat_ws(",", *kinds).alias("kinds"), F.round(quality.accuracy(kinds), 6).alias("score"))


def invention_risk(spark, sf_dir):
    """Risk that a file's stated fields were made up, against its text."""
    fields = ["facility_name", "permit_number", "issuance_date", "year_of_manufacture", "capacity_value"]
    rows = _p(spark, sf_dir).where("status = 'Success'").select("row_id", "filename", *fields)
    texts = table(spark, sf_dir, "extracted_text").where("source is not null").select("filename", "source")
    cells = rows.select("row_id", "filename", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lower(f).alias("v")) for f in fields])).alias("c")).select("row_id", "filename", "c.*")
    found = quality.stated_in(cells, texts, "filename", "v", "source")
    hits = cells.join(found, ["filename", "v"]).groupBy("row_id").agg(F.collect_set("field").alias("stated"))  # at most one entry a field
    j = rows.join(texts.select("filename").distinct(), "filename", "left_semi").join(hits, "row_id", "left")
    return j.select("row_id", *[quality.invention_risk(f, F.col(f), F.coalesce(F.array_contains("stated", f), F.lit(False))).alias(f) for f in fields])


def validation_decision(spark, sf_dir):
    """Status and reason of each answer sheet; a model of the panel that gave no field has failed."""
    d = table(spark, sf_dir, VAL).select("record_id", "field_summary", "unit_agreement_ratio")
    models = F.array_distinct(F.flatten(F.transform(F.map_values("field_summary"), lambda s: F.coalesce(s["complete_models"], F.array().cast("array<string>")))))
    d = d.withColumn("models", F.coalesce(models, F.array().cast("array<string>")))
    panel = d.select(F.explode("models").alias("m")).agg(F.countDistinct("m").alias("panel"))  # one row
    d = d.join(F.broadcast(panel), F.lit(True))
    status, reason = quality.validation_decision(F.col("field_summary"), F.col("unit_agreement_ratio"), F.size("models"), F.col("panel") - F.size("models"))
    return d.select("record_id", status.alias("decision"), reason.alias("why"))


def equipment_documents(spark, sf_dir):
    """Each row with the number of documents of its facility that state any equipment."""
    c = ["facility_name", "facility_address", "facility_city", "facility_state_abbreviation", "facility_zip_code"]
    whole = T.joined_key(*[F.col(x) for x in c], sep="|", upper=False)
    has = reduce(lambda a, b: a | b, [~F.coalesce(F.lower(T.strip(F.col(x))).isin(SENTINELS), F.lit(True)) for x in EQUIPMENT])
    d = _p(spark, sf_dir).select("row_id", "filename", F.when(whole == "||||", F.concat(F.lit("unknown::"), "filename")).otherwise(whole).alias("facility"), has.alias("has"))
    return quality.documents_with(d, "facility", "filename", F.col("has")).select("row_id", "documents")


def model_comparison(spark, sf_dir):
    """Models by completeness of their rows and agreement with the reviewers."""
    p = _p(spark, sf_dir).where("status = 'Success'")
    filled = reduce(lambda a, b: a + b, [quality.present(F.col(f)).cast("int") for f in FIELDS])
    a = p.groupBy("model_used").agg(F.count("*").alias("rows"), F.round(F.avg(filled / len(FIELDS)), 6).alias("completeness"))
    v = table(spark, sf_dir, VAL).select(F.explode("field_summary").alias("field", "s")).select(F.explode("s.complete_models").alias("model_used"), F.col("s.agreeing_models").alias("g"))
    b = v.groupBy("model_used").agg(F.count("*").alias("answers"), F.round(F.avg(F.array_contains("g", F.col("model_used")).cast("double")), 6).alias("agreement"))
    return a.join(b, "model_used", "left")


def composite_score(spark, sf_dir):
    """The mean of whichever of three scores a file has."""
    v = table(spark, sf_dir, VAL).groupBy("filename").agg(F.max("unit_agreement_ratio").alias("a"))
    p = _p(spark, sf_dir).groupBy("filename").agg(F.avg(quality.present(F.col("capacity_value")).cast("double")).alias("b"), F.avg(F.when(F.col("naics_source") == "permit", 1.0).when(F.col("naics_source").isNotNull(), 0.5)).alias("c"))
    parts = F.filter(F.array("a", "b", "c"), lambda x: x.isNotNull())
    return p.join(v, "filename", "left").select("filename", F.round(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x) / F.size(parts), 6).alias("score"))


def pooled_validation(spark, sf_dir):
    """Completeness and agreement of the panel by field, over the last sheet of each reviewer and file."""
    d = table(spark, sf_dir, VAL)
    last = d.groupBy("filename", "reviewer").agg(F.max_by("field_summary", F.struct("recorded_at", "record_id")).alias("fs"))
    s = last.select(F.explode("fs").alias("field", "s"))
    some = F.size("s.complete_models") > 0
    return s.groupBy("field").agg(F.count("*").alias("answers"), F.sum(some.cast("bigint")).alias("present"), F.sum((some & ~F.col("s.needs_review")).cast("bigint")).alias("agreeing"))


def flip_stats(spark, sf_dir):
    """Fields whose exact comparison disagrees though a reviewer's models agree in number, by field."""
    s = table(spark, sf_dir, VAL).select(F.explode("field_summary").alias("field", "s"))
    complete, agreeing = F.size("s.complete_models"), F.size("s.agreeing_models")
    flip = (complete >= 2) & F.col("s.needs_review") & (agreeing >= 2)
    return s.groupBy("field").agg(F.sum(flip.cast("bigint")).alias("flips"), F.sum(((complete >= 2) & (agreeing == 0)).cast("bigint")).alias("conflicts"))


def ratio_summary(spark, sf_dir):
    d = table(spark, sf_dir, VAL).where("unit_agreement_ratio is not null")
    r = "unit_agreement_ratio"
    return d.agg(F.count("*").alias("n"), F.round(F.avg(r), 6).alias("mean"), F.median(r).alias("median"), F.min(r).alias("least"), F.round(F.avg(F.when(F.col(r) >= 0.7, 1.0).otherwise(0.0)), 6).alias("from_070"))


def _matched(spark, sf_dir):
    """Facilities by state, matched if a second run saw them."""
    d = _p(spark, sf_dir).where("facility_name is not null").select(F.col("facility_state_abbreviation").alias("state"), T.company_name(F.col("facility_name")).alias("name"), "source_run", F.substring("naics_resolved", 1, 2).alias("sector"))
    return d.groupBy("state", "name").agg((F.countDistinct("source_run") >= 3).alias("matched"), F.count("*").alias("weight"), F.min("sector").alias("sector"))


def coverage_table(spark, sf_dir):
    d = stats.coverage(_matched(spark, sf_dir), "state", "matched")
    return d.withColumn("tier", stats.tier(F.col("coverage")))


def tier_summary(spark, sf_dir):
    return coverage_table(spark, sf_dir).groupBy("tier").agg(F.count("*").alias("states"), F.sum("total").alias("facilities"))


def representation_ratio(spark, sf_dir):
    """Sectors' share of the matched facilities over their share of all."""
    d = stats.coverage(_matched(spark, sf_dir), "sector", "matched")
    every = Window.partitionBy(F.lit(1))  # one row a sector
    return d.select("sector", "total", "matched", F.round((F.col("matched") / F.sum("matched").over(every)) / (F.col("total") / F.sum("total").over(every)), 4).alias("ratio"))


def weighted_coverage(spark, sf_dir):
    m = _matched(spark, sf_dir)
    c = stats.coverage(m, "state", "matched").join(m.groupBy("state").agg(F.sum("weight").alias("weight")), "state")
    return c.agg(F.round(F.avg("coverage"), 4).alias("plain"), F.round(stats.weighted_mean(c, "coverage", "weight"), 4).alias("weighted"))


def coverage_quartiles(spark, sf_dir):
    """Facilities by quartile of their weight, ranked first so that ties part."""
    m = _matched(spark, sf_dir).where("state is not null")
    from fluelake.operators.sampling import ranked

    m = ranked(m, [F.col("weight"), F.col("state"), F.col("name")], "place").withColumn("rank", F.col("place") + 1)
    return quantile_bins(m, "rank", 4).groupBy("bin").agg(F.count("*").alias("facilities"), F.sum(F.col("matched").cast("bigint")).alias("matched"))


def spearman(spark, sf_dir):
    d = _sized(spark, sf_dir)
    s = stats.spearman(d, "chars", "units")
    return s.select("n", F.round("rho", 6).alias("rho"))


def crosstab_norm(spark, sf_dir):
    d = _p(spark, sf_dir).select(T.fold_label(F.col("fuel_type")).alias("fuel"), T.fold_label(F.col("unit_type")).alias("unit"))
    return stats.crosstab(d, "fuel", "unit", 10)


def describe_lengths(spark, sf_dir):
    return stats.describe(table(spark, sf_dir, DOC).where("n_chars is not null"), "n_chars")


def multi_value_split(spark, sf_dir):
    """Pollutants, split at commas and semicolons, counted."""
    d = _p(spark, sf_dir).select(F.explode(F.split("pollutants", "[,;]")).alias("p")).select(T.strip(F.col("p")).alias("pollutant")).where("pollutant <> ''")
    return d.groupBy("pollutant").agg(F.count("*").alias("rows"))


def growth_stats(spark, sf_dir):
    """Rows, files and facilities of two snapshots by state, and their change."""
    p = _p(spark, sf_dir).withColumns({"state": F.substring("filename", 1, 2), "fac": F.concat_ws("|", F.substring("filename", 1, 2), F.lower("facility_name"))})

    def snap(d, n):
        return d.groupBy("state").agg(F.count("*").alias(f"rows_{n}"), F.countDistinct("filename").alias(f"files_{n}"), F.countDistinct("fac").alias(f"facilities_{n}"))

    j = snap(p.where("source_run = 'run_a'"), "old").join(snap(p, "new"), "state", "full_outer").na.fill(0)
    return j.withColumns({f"{c}_gain": F.col(f"{c}_new") - F.col(f"{c}_old") for c in ("rows", "files", "facilities")})


def quantity_sum(spark, sf_dir):
    """Units by type, a missing quantity as one."""
    q = F.when(T.strip(F.col("unit_quantity")).rlike("^[0-9]+$"), T.strip(F.col("unit_quantity")).try_cast("bigint"))
    return _p(spark, sf_dir).where("unit_type is not null").groupBy(T.fold_label(F.col("unit_type")).alias("unit")).agg(F.sum(F.coalesce(q, F.lit(1))).alias("quantity"))


def weighted_categories(spark, sf_dir):
    """Answers by category of their field's name, with their percentage."""
    d = table(spark, sf_dir, VAL).select(F.explode(F.map_keys("field_summary")).alias("field")).groupBy("field").agg(F.count("*").alias("n"))
    d = d.groupBy(T.keyword_case(F.lower("field"), CATEGORIES, "other").alias("category")).agg(F.count("*").alias("fields"), F.sum("n").alias("answers"))
    return d.withColumn("percent", F.round(100 * F.col("answers") / F.sum("answers").over(Window.partitionBy(F.lit(1))), 4))


QUERIES = {f.__name__: f for f in (state_rollup, status_counts, kpis, site_table, box_stats, top_values, top_pairs, top_with_other, vintage_median, missingness, state_completeness, qc_report, duplicate_groups, recall_by_size, recall_suspects, rule_validate, extraction_accuracy, invention_risk, validation_decision, equipment_documents, model_comparison, composite_score, pooled_validation, flip_stats, ratio_summary, coverage_table, tier_summary, representation_ratio, weighted_coverage, coverage_quartiles, spearman, crosstab_norm, describe_lengths, multi_value_split, growth_stats, quantity_sum, weighted_categories)}


def _sql():
    from fluelake.plans.classes import _FOLD
    from fluelake.plans.scalars import _CELL, _KEY, _SITE, _YEAR

    has = lambda c: f"coalesce({S.strip(c)} <> '', false)"
    words = "'', 'unknown', 'n/a', 'na', 'none', 'not specified', 'not available', 'not listed', 'unspecified', 'various', '-', '--', 'unk', 'tbd'"
    one_row = f"upper({S.strip('facility_state_abbreviation')})"
    n = f"replace({S.strip('capacity_value')}, ',', '')"
    from fluelake.functions.text import CAPACITY_UNITS

    spaces = r"[\s\x{00A0}]+"
    token = f"lower(regexp_replace({S.strip('capacity_unit')}, '{spaces}', ' ', 'g'))"
    unit = f"coalesce({S.lookup(token, CAPACITY_UNITS)}, {S.strip('capacity_unit')})"
    iso = "'^[0-9]{4}-[0-9]{2}-[0-9]{2}$'"
    state = S.strip("facility_state_abbreviation")
    qc = {
        "rows": "count(*)", "issuance_stated": f"count(*) FILTER (WHERE {has('issuance_date')})", "issuance_iso": f"count(*) FILTER (WHERE regexp_matches(issuance_date, {iso}))", "expiration_iso": f"count(*) FILTER (WHERE regexp_matches(expiration_date, {iso}))",
        "state_stated": f"count(*) FILTER (WHERE {has('facility_state_abbreviation')})", "state_valid": f"count(*) FILTER (WHERE {state} IN ({', '.join(map(S.quote, STATES))}))",
        "zip_stated": f"count(*) FILTER (WHERE {has('facility_zip_code')})", "zip_valid": f"count(*) FILTER (WHERE regexp_matches({S.strip('facility_zip_code')}, '^[0-9]{{5}}(-[0-9]{{4}})?$'))",
        "capacity_stated": f"count(*) FILTER (WHERE {has('capacity_value')})", "capacity_with_unit": f"count(*) FILTER (WHERE {has('capacity_value')} AND {has('capacity_unit')})", "unit_ids": f"count(*) FILTER (WHERE {has('unit_id')})",
        "one_letter_ids": f"count(*) FILTER (WHERE {has('unit_id')} AND length({S.strip('unit_id')}) <= 1)", "error_cells": " + ".join(f"count(*) FILTER (WHERE upper({S.strip(f)}) = 'ERROR')" for f in FIELDS),
    }
    sized = f"""u AS (SELECT filename, count(*) AS units FROM {P} WHERE status = 'Success' GROUP BY 1),
        t AS (SELECT filename, CAST(max(length(source)) AS BIGINT) AS chars, CAST(max(len(regexp_extract_all(source, {S.quote(r"(?i)\b(boiler|furnace|heater|oven|dryer|kiln|incinerator|turbine|engine|generator|melter|calciner|cracker|reformer)s?\b")}))) AS BIGINT) AS mentions FROM extracted_text WHERE source IS NOT NULL GROUP BY 1),
        s AS (SELECT u.filename, units, chars, mentions FROM u JOIN t ON u.filename = t.filename)"""
    rules = []
    for f, r in quality.RULES.items():
        bad = " OR ".join([*([f"length({f}) < {r['least']}"] if "least" in r else []), *([f"length({f}) > {r['most']}"] if "most" in r else []), *([f"NOT regexp_matches({f}, {S.quote(r['pattern'])})"] if "pattern" in r else []), *([f"NOT regexp_matches({f}, {S.quote(quality.NUMBER)})"] if r.get("number") else [])])
        rules.append(f"CASE WHEN CASE WHEN {f} IS NULL OR {f} = '' THEN {str(bool(r.get('required'))).lower()} ELSE {bad} END THEN '{f}' END")
    acc = ["unit_make", "unit_type", "fuel_type", "capacity_unit", "unit_description"]

    def kind(f):
        a, b = f"lower({S.strip(f'b.{f}')})", f"lower({S.strip(f'a.{f}')})"
        w = lambda c: rf"list_distinct(list_filter(string_split_regex({c}, '\s+'), lambda w: w <> ''))"
        jac = f"(CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE coalesce(len(list_intersect({w(a)}, {w(b)})) / nullif(len(list_distinct(list_concat({w(a)}, {w(b)}))), 0), 0) END)"
        return f"(CASE WHEN b.{f} IS NULL AND a.{f} IS NULL THEN 'exact' WHEN b.{f} IS NULL THEN 'missing' WHEN a.{f} IS NULL THEN 'extra' WHEN {a} = {b} THEN 'exact' WHEN {jac} > 0.8 THEN 'partial' ELSE 'different' END)"

    side = lambda r: f"(SELECT filename, unit_id, {', '.join(f'arg_min_null({f}, row_id) AS {f}' for f in acc)} FROM {P} WHERE status = 'Success' AND unit_id IS NOT NULL AND source_run = '{r}' GROUP BY ALL)"

    def risk(f):
        low, un = f"lower({f})", "false"
        if "date" in f:
            un = f"NOT regexp_matches({f}, {iso})"
        elif "year" in f:
            un = f"NOT coalesce(CASE WHEN regexp_matches({f}, '^[0-9]+$') THEN try_cast({f} AS BIGINT) END BETWEEN 1900 AND 2030, false)"
        elif "capacity" in f:
            x = f"CASE WHEN regexp_matches({f}, {S.quote(quality.NUMBER)}) THEN try_cast(trim({f}) AS DOUBLE) END"
            un = f"coalesce(({x}) <= 0 OR ({x}) > 10000, false)"
        parts = [f"CASE WHEN EXISTS (SELECT 1 FROM hit WHERE hit.filename = p.filename AND hit.v = {low}) THEN 0 ELSE 3 END", *[f"CASE WHEN regexp_matches({low}, {S.quote(p)}) THEN 4 ELSE 0 END" for p in quality.SUSPICIOUS], f"CASE WHEN {low} IN ({', '.join(map(S.quote, quality.GENERIC))}) THEN 2 ELSE 0 END", f"CASE WHEN {un} THEN 3 ELSE 0 END"]
        return f"CASE WHEN {S.strip(f)} <> '' THEN least({' + '.join(parts)}, 10) / 10 END AS {f}"

    risky = ["facility_name", "permit_number", "issuance_date", "year_of_manufacture", "capacity_value"]
    entries = f"(SELECT unnest(map_keys(field_summary)) AS field, unnest(map_values(field_summary)) AS s FROM {VAL})"
    matched = f"m AS (SELECT facility_state_abbreviation AS state, {S.company_name('facility_name')} AS name, count(DISTINCT source_run) >= 3 AS matched, count(*) AS weight, min(substr(naics_resolved, 1, 2)) AS sector FROM {P} WHERE facility_name IS NOT NULL GROUP BY ALL)"
    cov = lambda g: f"(SELECT {g}, count(*) AS total, CAST(sum(matched::INT) AS BIGINT) AS matched, round(sum(matched::INT) / count(*), 3) AS coverage FROM m GROUP BY ALL)"
    tiers = "CASE WHEN coverage >= 0.7 THEN 'well-covered' WHEN coverage >= 0.3 THEN 'partial' WHEN coverage IS NOT NULL THEN 'sparse' ELSE '' END"
    fold = lambda c: _FOLD(c)
    top = lambda c: f"(SELECT '{c}' AS field, {fold(c)} AS value, count(*) AS rows FROM {P} GROUP BY 2 HAVING {fold(c)} IS NOT NULL ORDER BY rows DESC, value LIMIT 15)"
    years = f"try_cast({_YEAR} AS INTEGER)"
    rank = lambda c: f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2)"
    snap = lambda w, n: f"(SELECT substr(filename, 1, 2) AS state, count(*) AS rows_{n}, count(DISTINCT filename) AS files_{n}, count(DISTINCT concat_ws('|', substr(filename, 1, 2), lower(facility_name))) AS facilities_{n} FROM {P} {w} GROUP BY 1)"
    q = S.strip("unit_quantity")
    old = "WHERE source_run = 'run_a'"
    return {
        "state_rollup": f"SELECT {one_row} AS state, count(DISTINCT filename) AS files, CAST(sum({has('unit_id')}::INT) AS BIGINT) AS units, count(*) AS rows FROM {P} GROUP BY 1 UNION ALL SELECT 'TOTAL', count(DISTINCT filename), CAST(sum({has('unit_id')}::INT) AS BIGINT), count(*) FROM {P}",
        "status_counts": f"SELECT status, source_run, model_used, count(*) AS rows FROM {P} GROUP BY ALL",
        "kpis": f"WITH d AS (SELECT *, {_SITE} AS site FROM {P}), s AS (SELECT site, count(*) AS n FROM d GROUP BY 1) SELECT count(DISTINCT site) AS sites, count(*) AS units, count(DISTINCT facility_state_abbreviation) AS states, count(DISTINCT permit_number) AS permits, count(DISTINCT filename) AS files, (SELECT median(n) FROM s) AS median_units FROM d",
        "site_table": f"SELECT {_SITE} AS site, {', '.join(f'arg_min({c}, row_id) FILTER (WHERE {c} IS NOT NULL) AS {c}' for c in ('facility_name', 'facility_city', 'facility_county'))}, count(*) AS units FROM {P} GROUP BY 1",
        "box_stats": f"""
            WITH d AS (SELECT {unit} AS unit, CASE WHEN regexp_matches({n}, '^[0-9]+([.][0-9]+)?$') THEN try_cast({n} AS DOUBLE) END AS v FROM {P}), k AS (SELECT unit, v FROM d WHERE unit <> '' AND v > 0),
            t AS (SELECT unit FROM k GROUP BY 1 ORDER BY count(*) DESC, unit LIMIT 8), g AS (SELECT unit, count(*) AS rows, quantile_cont(v, [0.025, 0.25, 0.5, 0.75, 0.975]) AS q FROM k WHERE unit IN (SELECT unit FROM t) GROUP BY 1)
            SELECT unit, rows, q[1] AS low, q[2] AS q1, q[3] AS middle, q[4] AS q3, q[5] AS high FROM g""",
        "top_values": " UNION ALL ".join(f"SELECT * FROM {top(c)}" for c in ("fuel_type", "unit_type", "control_devices", "industry_description")),
        "top_pairs": f"""
            WITH g AS (SELECT unit_make, unit_model, count(*) AS rows FROM {P} WHERE unit_make IS NOT NULL AND unit_model IS NOT NULL GROUP BY ALL)
            SELECT {S.strip('unit_make')} || ' ' || {S.strip('unit_model')} AS value, rows FROM g WHERE lower({S.strip('unit_make')}) NOT IN ({words}) AND lower({S.strip('unit_model')}) NOT IN ({words}) ORDER BY rows DESC, value LIMIT 15""",
        "top_with_other": f"""
            WITH g AS (SELECT coalesce({fold('unit_type')}, 'unclassified') AS label, count(*) AS units FROM {P} GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY units DESC, label) AS k FROM g)
            SELECT CASE WHEN k <= 13 THEN label ELSE 'Other' END AS label, CAST(sum(units) AS BIGINT) AS units FROM r GROUP BY 1""",
        "vintage_median": f"""
            WITH y AS (SELECT CASE WHEN {years} <= 2026 THEN {years} END AS year FROM {P}), g AS (SELECT year, count(*) AS units FROM y WHERE year >= 1940 GROUP BY 1),
            w AS (SELECT *, CAST(sum(units) OVER (ORDER BY year) AS BIGINT) AS running, sum(units) OVER () AS t FROM g)
            SELECT year, units, running, running * 2 >= t AND (running - units) * 2 < t AS is_median FROM w""",
        "missingness": " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER (WHERE NOT {has(f)}) AS missing, round(count(*) FILTER (WHERE NOT {has(f)}) / count(*), 4) AS share FROM {P} WHERE starts_with(status, 'Success')" for f in FIELDS),
        "state_completeness": " UNION ALL ".join(f"SELECT facility_state_abbreviation AS state, '{f}' AS field, round(avg({has(f)}::INT), 6) AS share FROM {P} GROUP BY 1" for f in FIELDS),
        "qc_report": " UNION ALL ".join(f"SELECT '{k}' AS metric, CAST({v} AS BIGINT) AS value FROM {P} WHERE starts_with(status, 'Success')" for k, v in qc.items()),
        "duplicate_groups": f"SELECT row_id, filename, unit_id FROM {P} WHERE starts_with(status, 'Success') AND {has('unit_id')} QUALIFY count(*) OVER (PARTITION BY filename, unit_id) > 1",
        "recall_by_size": f"""
            WITH {sized}, b AS (SELECT *, (SELECT count(*) FROM (VALUES {', '.join(f'({x})' for x in SIZE_BINS[1:-1])}) v(x) WHERE chars > x) + 1 AS bin, units / (chars / 1000) AS rate FROM s WHERE chars > 0)
            SELECT CAST(bin AS INTEGER) AS bin, count(*) AS files, quantile_cont(units, 0.5) AS median_units, round(avg(units), 4) AS mean_units, quantile_cont(units, 0.9) AS p90_units, round(avg((units <= 3)::INT), 4) AS few, round(quantile_cont(rate, 0.5), 6) AS median_rate FROM b GROUP BY 1""",
        "recall_suspects": f"WITH {sized} SELECT filename, chars, units, mentions, round(mentions / greatest(units, 1), 4) AS per_unit FROM s WHERE chars >= 4000 AND mentions >= 10 AND units <= 8",
        "rule_validate": f"SELECT row_id, concat_ws(',', {', '.join(rules)}) AS broken FROM {P}",
        "extraction_accuracy": f"""
            WITH k AS (SELECT a.filename, a.unit_id, {', '.join(f'{kind(f)} AS k{i}' for i, f in enumerate(acc))} FROM {side('run_a')} a JOIN {side('run_b')} b ON a.filename = b.filename AND a.unit_id = b.unit_id)
            SELECT filename, unit_id, concat_ws(',', k0, k1, k2, k3, k4) AS kinds, round(({' + '.join(f"CASE k{i} WHEN 'exact' THEN 1.0 WHEN 'partial' THEN 0.5 ELSE 0.0 END::DOUBLE" for i in range(5))}) / 5, 6) AS score FROM k""",
        "invention_risk": f"""
            WITH t AS (SELECT DISTINCT filename, lower(source) AS text FROM extracted_text WHERE source IS NOT NULL), v AS ({' UNION '.join(f"SELECT filename, lower({f}) AS v FROM {P} WHERE status = 'Success'" for f in risky)}),
            hit AS (SELECT DISTINCT v.filename, v.v FROM v JOIN t ON v.filename = t.filename AND contains(t.text, v.v))
            SELECT row_id, {', '.join(risk(f) for f in risky)} FROM {P} p WHERE status = 'Success' AND filename IN (SELECT filename FROM t)""",
        "validation_decision": f"""
            WITH m AS (SELECT record_id, len(list_distinct(flatten(list_transform(map_values(field_summary), lambda s: coalesce(s.complete_models, []))))) AS k FROM {VAL}),
            panel AS (SELECT count(DISTINCT x) AS n FROM (SELECT unnest(flatten(list_transform(map_values(field_summary), lambda s: s.complete_models))) AS x FROM {VAL})),
            d AS (SELECT record_id, CASE WHEN coalesce(k, 0) < 2 THEN 'Fewer than two models succeeded' WHEN n - coalesce(k, 0) >= 2 THEN 'Two or more models failed'
                {' '.join(f"WHEN coalesce(field_summary['{f}'].needs_review, false) THEN 'General field ''{f}'' needs review'" for f in ('Facility Name', 'Facility Address', 'Facility City', 'Facility State Abbreviation', 'Facility Zip Code', 'Permit Number', 'Permit Type', 'Issuance Date', 'Expiration Date', 'Regulatory Authority', 'Primary Applicable Regulations (e.g., Title V, PSD, NESHAP Subpart)'))}
                WHEN unit_agreement_ratio < 0.7 THEN 'Unit field agreement ratio ' || CAST(round(CAST(unit_agreement_ratio AS DECIMAL(12, 6)), 2) AS VARCHAR) || ' < 0.7' END AS why
                FROM {VAL} JOIN m USING (record_id), panel)
            SELECT record_id, CASE WHEN why IS NULL THEN 'SUCCESS' ELSE 'REVIEW_REQUIRED' END AS decision, why FROM d""",
        "equipment_documents": f"""
            WITH d AS (SELECT row_id, filename, CASE WHEN {_KEY} = '||||' THEN 'unknown::' || filename ELSE {_KEY} END AS facility, {' + '.join(_CELL)} > 0 AS has FROM {P}),
            n AS (SELECT facility, count(DISTINCT filename) AS documents FROM d WHERE has GROUP BY 1)
            SELECT row_id, coalesce(documents, 0) AS documents FROM d LEFT JOIN n ON d.facility = n.facility""",
        "model_comparison": f"""
            WITH a AS (SELECT model_used, count(*) AS rows, round(avg(({' + '.join(f'{has(f)}::INT' for f in FIELDS)}) / {len(FIELDS)}), 6) AS completeness FROM {P} WHERE status = 'Success' GROUP BY 1),
            v AS (SELECT unnest(s.complete_models) AS m, s.agreeing_models AS g FROM {entries}), b AS (SELECT m, count(*) AS answers, round(avg(list_contains(g, m)::INT), 6) AS agreement FROM v GROUP BY 1)
            SELECT model_used, rows, completeness, answers, agreement FROM a LEFT JOIN b ON model_used = m""",
        "composite_score": f"""
            WITH v AS (SELECT filename, max(unit_agreement_ratio) AS a FROM {VAL} GROUP BY 1), p AS (SELECT filename, avg({has('capacity_value')}::INT) AS b, avg(CASE WHEN naics_source = 'permit' THEN 1.0::DOUBLE WHEN naics_source IS NOT NULL THEN 0.5::DOUBLE END) AS c FROM {P} GROUP BY 1)
            SELECT p.filename, round((coalesce(a, 0) + b + coalesce(c, 0)) / (1 + (a IS NOT NULL)::INT + (c IS NOT NULL)::INT), 6) AS score FROM p LEFT JOIN v ON p.filename = v.filename""",
        "pooled_validation": f"""
            WITH l AS (SELECT field_summary FROM {VAL} QUALIFY row_number() OVER (PARTITION BY filename, reviewer ORDER BY recorded_at DESC, record_id DESC) = 1), s AS (SELECT unnest(map_keys(field_summary)) AS field, unnest(map_values(field_summary)) AS s FROM l)
            SELECT field, count(*) AS answers, CAST(sum((len(s.complete_models) > 0)::INT) AS BIGINT) AS present, CAST(sum((len(s.complete_models) > 0 AND NOT s.needs_review)::INT) AS BIGINT) AS agreeing FROM s GROUP BY 1""",
        "flip_stats": f"SELECT field, CAST(sum((len(s.complete_models) >= 2 AND s.needs_review AND len(s.agreeing_models) >= 2)::INT) AS BIGINT) AS flips, CAST(sum((len(s.complete_models) >= 2 AND len(s.agreeing_models) = 0)::INT) AS BIGINT) AS conflicts FROM {entries} GROUP BY 1",
        "ratio_summary": f"SELECT count(*) AS n, round(avg(unit_agreement_ratio), 6) AS mean, median(unit_agreement_ratio) AS median, min(unit_agreement_ratio) AS least, round(avg((unit_agreement_ratio >= 0.7)::INT), 6) AS from_070 FROM {VAL} WHERE unit_agreement_ratio IS NOT NULL",
        "coverage_table": f"WITH {matched} SELECT *, {tiers} AS tier FROM {cov('state')}",
        "tier_summary": f"WITH {matched} SELECT {tiers} AS tier, count(*) AS states, CAST(sum(total) AS BIGINT) AS facilities FROM {cov('state')} GROUP BY 1",
        "representation_ratio": f"WITH {matched} SELECT sector, total, matched, round((matched / sum(matched) OVER ()) / (total / sum(total) OVER ()), 4) AS ratio FROM {cov('sector')}",
        "weighted_coverage": f"WITH {matched} SELECT round(avg(coverage), 4) AS plain, round(sum(coverage * w) / sum(w), 4) AS weighted FROM {cov('state')} c JOIN (SELECT state AS s, sum(weight) AS w FROM m GROUP BY 1) k ON c.state = k.s",
        "coverage_quartiles": f"""
            WITH {matched}, r AS (SELECT *, row_number() OVER (ORDER BY weight, state, name) AS k FROM m WHERE state IS NOT NULL), e AS (SELECT quantile_cont(k, [0.25, 0.5, 0.75]) AS q FROM r)
            SELECT CASE WHEN k <= q[1] THEN 1 WHEN k <= q[2] THEN 2 WHEN k <= q[3] THEN 3 ELSE 4 END AS bin, count(*) AS facilities, CAST(sum(matched::INT) AS BIGINT) AS matched FROM r, e GROUP BY 1""",
        "spearman": f"WITH {sized}, r AS (SELECT {rank('chars')} AS x, {rank('units')} AS y FROM s) SELECT count(*) AS n, round(corr(x, y), 6) AS rho FROM r",
        "crosstab_norm": f"""
            WITH d AS (SELECT {fold('fuel_type')} AS fuel, {fold('unit_type')} AS unit FROM {P}), a AS (SELECT fuel FROM d WHERE fuel IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, fuel LIMIT 10), b AS (SELECT unit FROM d WHERE unit IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, unit LIMIT 10),
            g AS (SELECT a.fuel, b.unit, (SELECT count(*) FROM d WHERE d.fuel = a.fuel AND d.unit = b.unit) AS count FROM a, b)
            SELECT fuel, unit, count, round(CASE WHEN sum(count) OVER (PARTITION BY fuel) > 0 THEN 100 * count / sum(count) OVER (PARTITION BY fuel) ELSE 0 END, 4) AS percent FROM g""",
        "describe_lengths": f"WITH d AS (SELECT n_chars AS v FROM {DOC} WHERE n_chars IS NOT NULL) SELECT count(v) AS n, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS spread, min(v) AS least, max(v) AS most, quantile_cont(v, 0.1) AS p10, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.9) AS p90 FROM d",
        "multi_value_split": f"WITH d AS (SELECT unnest(string_split_regex(pollutants, '[,;]')) AS p FROM {P}) SELECT {S.strip('p')} AS pollutant, count(*) AS rows FROM d WHERE {S.strip('p')} <> '' GROUP BY 1",
        "growth_stats": "SELECT state, " + ", ".join(f"coalesce({c}_{n}, 0) AS {c}_{n}" for c in ("rows", "files", "facilities") for n in ("old", "new")) + ", " + ", ".join(f"coalesce({c}_new, 0) - coalesce({c}_old, 0) AS {c}_gain" for c in ("rows", "files", "facilities")) + f" FROM {snap(old, 'old')} FULL JOIN {snap('', 'new')} USING (state)",
        "quantity_sum": f"SELECT {fold('unit_type')} AS unit, CAST(sum(coalesce(CASE WHEN regexp_matches({q}, '^[0-9]+$') THEN try_cast({q} AS BIGINT) END, 1)) AS BIGINT) AS quantity FROM {P} WHERE unit_type IS NOT NULL GROUP BY 1",
        "weighted_categories": f"""
            WITH f AS (SELECT field, count(*) AS n FROM (SELECT unnest(map_keys(field_summary)) AS field FROM {VAL}) GROUP BY 1), g AS (SELECT {S.keyword_case('lower(field)', CATEGORIES, 'other')} AS category, count(*) AS fields, CAST(sum(n) AS BIGINT) AS answers FROM f GROUP BY 1)
            SELECT *, round(100 * answers / sum(answers) OVER (), 4) AS percent FROM g""",
    }


SQL = _sql()
