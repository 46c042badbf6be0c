"""Queries of classification and of nested documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from fluelake.functions import text as T
from fluelake.operators import classify as C
from fluelake.operators import nested
from fluelake.plans import sqltools as S
from fluelake.plans.scalars import SUBSECTOR_WORDS
from fluelake.runtime import table

P = "permit_data_extracted"
GENERAL = ["facility_name", "facility_city", "naics_code", "permit_number"]
UNIT = ["unit_id", "unit_type", "fuel_type", "capacity_value"]
FIELDS = ["facility_zip_code", "issuance_date", "expiration_date", "permit_type", "permit_number", "regulatory_authority"]


def rule_classify(spark, sf_dir):
    return C.classified(table(spark, sf_dir, P).select("row_id", "industry_description"), "industry_description", "code").select("row_id", "code")


def manufacturing_split(spark, sf_dir):
    """Rows by sheet: the description's code first, the stated codes where no rule knew it; and the plainer rule."""
    d = C.classified(table(spark, sf_dir, P).select("row_id", "industry_description", "naics_code", "sic_code", "naics_resolved"), "industry_description", "code")
    by_text, by_code = C.in_manufacturing_tab(F.col("code")), C.in_manufacturing_tab(F.col("naics_code")) | C.in_manufacturing_tab(F.col("sic_code"))
    sheet = F.when(by_text | (F.col("code").isNull() & by_code), "manufacturing").otherwise("other")
    return d.select("row_id", sheet.alias("sheet"), C.sheet_by_codes(F.col("naics_code"), F.col("naics_resolved"), F.col("sic_code")).alias("sheet_by_codes"), C.is_manufacturing(F.col("sic_code")).alias("sic_made"))


def naics_cascade(spark, sf_dir):
    """Each file's code by the permit, a registry of facility names, the description, the older code; with its origin."""
    d = table(spark, sf_dir, P).where("status = 'Success'")
    f = d.groupBy("filename").agg(*[F.min_by(c, "row_id").alias(c) for c in ("facility_name", "facility_state_abbreviation", "naics_code", "sic_code", "industry_description")])
    name = T.company_name(F.col("facility_name"))
    registry = d.where("naics_source = 'permit'").groupBy(F.col("facility_state_abbreviation").alias("state"), name.alias("name")).agg(F.min("naics_resolved").alias("registry"))
    f = C.classified(f.withColumns({"name": name, "state": F.col("facility_state_abbreviation")}), "industry_description", "derived").join(registry, ["state", "name"], "left")
    code, origin = C.resolved(F.col("naics_code"), F.col("registry"), F.col("derived"), F.col("sic_code"))
    return f.select("filename", code.alias("code"), origin.alias("origin"))


def code_precedence(spark, sf_dir):
    """The two orders in which codes win: resolved, stated, classified; and classified, stated."""
    d = C.classified(table(spark, sf_dir, P).select("row_id", "industry_description", "naics_resolved", "naics_code"), "industry_description", "code")
    return d.select("row_id", F.coalesce("naics_resolved", "naics_code", "code").alias("ready"), F.coalesce("code", "naics_code").alias("legacy"))


def worklist(spark, sf_dir):
    """Distinct descriptions no rule knows, in batches of 20."""
    d = C.classified(table(spark, sf_dir, P).select("row_id", "unit_type"), "unit_type", "code").where("code is null and unit_type is not null")
    one = d.select(T.fold_label(F.col("unit_type")).alias("text")).where("text is not null").distinct()
    from fluelake.operators.sampling import ranked

    return ranked(one, [F.col("text")], "place").select("text", F.floor(F.col("place") / 20).cast("bigint").alias("batch"))


def canonical_casing(spark, sf_dir):
    return C.canonical_spellings(table(spark, sf_dir, P), "fuel_type", {"nat gas": "Natural Gas", "ulsd": "Diesel (ULSD)"})


def primary_bucket(spark, sf_dir):
    """Rows by subsector, water, waste water and data centers above the code."""
    d = table(spark, sf_dir, P)
    text = F.concat_ws(" ", F.coalesce("industry_description", F.lit("")), F.coalesce("facility_name", F.lit("")))
    flags = {n: text.rlike(f"(?i){SUBSECTOR_WORDS[k]}") for n, k in (("Wastewater / sewage", "is_wastewater"), ("Water treatment / supply", "is_water"), ("Data centers", "is_datacenter"))}
    return d.select(C.primary_bucket(F.col("naics_resolved"), flags).alias("bucket"), "filename").groupBy("bucket").agg(F.count("*").alias("units"), F.countDistinct("filename").alias("files"))


def subsector_options(spark, sf_dir):
    """Subsectors of 100 rows or more, and everything."""
    d = table(spark, sf_dir, P).where("naics_resolved is not null").groupBy(F.substring("naics_resolved", 1, 3).alias("option")).agg(F.count("*").alias("rows"))
    every = table(spark, sf_dir, P).agg(F.lit("ALL").alias("option"), F.count("*").alias("rows"))
    return d.where("rows >= 100").unionByName(every)


def error_classes(spark, sf_dir):
    d = table(spark, sf_dir, "processing_log").where("status = 'failed'")
    return d.groupBy(C.error_class(F.col("error_text")).alias("kind")).agg(F.count("*").alias("entries"))


def merge_codes(spark, sf_dir):
    """Run b's stated codes, as outside results, merged into run a's resolved ones."""
    d = table(spark, sf_dir, P)
    a = d.where("source_run = 'run_a'").select("filename", F.col("naics_resolved").alias("code"), "row_id")
    b = d.where("source_run = 'run_b'").select("filename", F.col("naics_code").alias("code"), "row_id")
    return C.merge_codes(a, b, "filename", "code", "row_id")


def _documents(spark, sf_dir):
    d = table(spark, sf_dir, P).where("status in ('Success', 'Success (No Units Found)')")
    return nested.rebuilt(d, "filename", GENERAL, UNIT, "row_id")


def rebuild_units(spark, sf_dir):
    d = _documents(spark, sf_dir)
    return d.select("filename", "facility_name", F.size("emission_units").cast("bigint").alias("units"), F.array_join(F.transform("emission_units", lambda u: F.coalesce(u["unit_id"], F.lit("?"))), "|").alias("ids"))


def flatten_units(spark, sf_dir):
    d = _documents(spark, sf_dir).select("filename", F.struct(*GENERAL, "emission_units").alias("doc"))
    return nested.flattened(d, "doc", GENERAL).select("filename", *GENERAL, *UNIT)


def parse_fenced_json(spark, sf_dir):
    """Documents written as fenced JSON, parsed and flattened again."""
    form = nested.schema(GENERAL, UNIT)
    d = _documents(spark, sf_dir).select("filename", F.concat(F.lit("Here it is:\n```json\n"), F.to_json(F.struct(*GENERAL, "emission_units")), F.lit("\n```")).alias("reply"))
    return nested.flattened(d.select("filename", nested.parsed(F.col("reply"), form).alias("doc")), "doc", GENERAL).select("filename", "facility_name", "unit_id", "fuel_type")


def prompt_sizes(spark, sf_dir):
    """Prompts put together from a template and whole texts, by their length."""
    template = "Read the permit.\n--- START ---\n{permit_text}\n--- END ---"
    d = table(spark, sf_dir, "extracted_text").where("source is not null")
    return d.select("text_id", F.length(F.replace(F.lit(template), F.lit("{permit_text}"), F.col("source"))).cast("bigint").alias("chars"))


def chunk_text(spark, sf_dir):
    """Texts in overlapping chunks of 10,000 characters."""
    return nested.chunked(table(spark, sf_dir, "extracted_text"), "text_id", "source", 10_000, 1_000).select(F.col("id").alias("text_id"), "chunk", "start", "end")


def consensus_field(spark, sf_dir):
    """Per file and field: the commonest value over the models, the models that gave one and this one."""
    d = table(spark, sf_dir, P).where("status = 'Success'").groupBy("filename", "model_used").agg(*[F.min_by(f, "row_id").alias(f) for f in FIELDS])
    long = d.unpivot(["filename", "model_used"], FIELDS, "field", "value").withColumn("value", T.comparable(F.col("value")))
    v = long.where("value <> ''").groupBy("filename", "field", "value").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("model_used")).alias("models"))
    best = F.min_by(F.struct("value", "models"), F.struct(-F.col("n"), "value"))
    g = v.groupBy("filename", "field").agg(best.alias("b"), F.sum("n").alias("complete"), F.count("*").alias("values"))
    agreeing = F.size("b.models").cast("bigint")
    return g.select("filename", "field", F.col("b.value").alias("chosen"), "complete", agreeing.alias("agreeing"), ((F.col("values") > 1) | ((F.col("complete") >= 2) & (agreeing < 2))).alias("needs_review"))


QUERIES = {f.__name__: f for f in (rule_classify, manufacturing_split, naics_cascade, code_precedence, worklist, canonical_casing, primary_bucket, subsector_options, error_classes, merge_codes, rebuild_units, flatten_units, parse_fenced_json, prompt_sizes, chunk_text, consensus_field)}

_MADE = [r for r in C.RULES if r[1][:2] in ("31", "32", "33")]
_RULES = lambda c: "(CASE " + " ".join(f"WHEN regexp_matches({c}, {S.quote(p)}) THEN '{k}'" for p, k in [*_MADE, *[r for r in C.RULES if r not in _MADE]]) + " END)"
_FOLD = lambda c: rf"nullif(lower(regexp_replace(regexp_replace({S.strip(c)}, '[\s\x{{00A0}}]+', ' ', 'g'), '[.;,]+$', '')), '')"
_CODE = _RULES(_FOLD("industry_description"))
_DIG = lambda c: rf"regexp_replace(regexp_replace(trim({c}), '^([0-9]+)\.[0-9]*$', '\1'), '[^0-9]', '', 'g')"
_IS = lambda c: f"coalesce(CASE WHEN length({_DIG(c)}) = 4 THEN {_DIG(c)}[1:1] IN ('2', '3') ELSE {_DIG(c)}[1:2] IN ('31', '32', '33') END, false)"
_TAB = lambda c: f"({_IS(c)} OR coalesce({_DIG(c)} IN ({', '.join(map(S.quote, C.EXTRA_NAICS + C.EXTRA_SIC))}), false))"
_TWO = lambda c: f"coalesce(regexp_extract(trim({c}), '^([0-9]{{2}})', 1) IN ('31', '32', '33'), false)"
_PARTS = lambda c: rf"list_transform(string_split_regex(trim({c}), '[;,/|\s]+'), lambda p: regexp_replace(p, '[^0-9]', '', 'g'))"
_FIRST = lambda c: f"list_filter({_PARTS(c)}, lambda d: length(d) = 6 AND d[1:2] IN ({', '.join(map(S.quote, C.SECTORS))}))[1]"
_SIC = S.lookup(f"list_filter({_PARTS('sic_code')}, lambda d: length(d) = 4)[1][1:2]", C.SIC_SECTOR)
_LABEL = lambda c: f"coalesce({S.lookup(c, C.SUBSECTORS)}, 'NAICS ' || {c})"
_T = "(coalesce(industry_description, '') || ' ' || coalesce(facility_name, ''))"
_DOC = f"{P} WHERE status IN ('Success', 'Success (No Units Found)')"
_SOME = f"coalesce({', '.join(UNIT)}) IS NOT NULL"
_RAW = rf"regexp_replace(regexp_replace({S.strip('raw')}, '[\s\x{{00A0}}]+', ' ', 'g'), '[.;,]+$', '')"
_FLAT = f"""
    WITH g AS (SELECT filename, {', '.join(f'arg_min_null({c}, row_id) AS {c}' for c in GENERAL)} FROM {_DOC} GROUP BY 1), u AS (SELECT filename, {', '.join(UNIT)} FROM {_DOC} AND {_SOME})
    SELECT g.filename, {', '.join(f'g.{c}' for c in GENERAL)}, {', '.join(f'u.{c}' for c in UNIT)} FROM g LEFT JOIN u ON g.filename = u.filename"""
_CMP = rf"regexp_replace(lower({S.strip('coalesce(v, chr(32))')}), '[\s\x{{00A0}}]+', ' ', 'g')"
SQL = {
    "rule_classify": f"SELECT row_id, {_CODE} AS code FROM {P}",
    "manufacturing_split": f"""
        WITH d AS (SELECT *, {_CODE} AS code FROM {P})
        SELECT row_id, CASE WHEN {_TAB('code')} OR (code IS NULL AND ({_TAB('naics_code')} OR {_TAB('sic_code')})) THEN 'manufacturing' ELSE 'other' END AS sheet,
            CASE WHEN {_TWO('naics_code')} OR {_TWO('naics_resolved')} OR coalesce(regexp_matches(trim(sic_code), '^[23][0-9]{{3}}'), false) THEN 'manufacturing' ELSE 'other' END AS sheet_by_codes, {_IS('sic_code')} AS sic_made FROM d""",
    "naics_cascade": f"""
        WITH f AS (SELECT filename, {', '.join(f'arg_min_null({c}, row_id) AS {c}' for c in ('facility_name', 'facility_state_abbreviation', 'naics_code', 'sic_code', 'industry_description'))} FROM {P} WHERE status = 'Success' GROUP BY 1),
        r AS (SELECT facility_state_abbreviation AS state, {S.company_name('facility_name')} AS name, min(naics_resolved) AS registry FROM {P} WHERE status = 'Success' AND naics_source = 'permit' GROUP BY ALL),
        j AS (SELECT filename, {_FIRST('naics_code')} AS a, registry AS b, nullif({_CODE}, '339999') AS c, {_SIC} AS d FROM f LEFT JOIN r ON state = facility_state_abbreviation AND name = {S.company_name('facility_name')})
        SELECT filename, coalesce(a, b, c, d) AS code, CASE WHEN a IS NOT NULL THEN 'permit' WHEN b IS NOT NULL THEN 'registry' WHEN c IS NOT NULL THEN 'derived' WHEN d IS NOT NULL THEN 'sic' END AS origin FROM j""",
    "code_precedence": f"SELECT row_id, coalesce(naics_resolved, naics_code, {_CODE}) AS ready, coalesce({_CODE}, naics_code) AS legacy FROM {P}",
    "worklist": f"WITH d AS (SELECT DISTINCT {_FOLD('unit_type')} AS text FROM {P} WHERE {_RULES(_FOLD('unit_type'))} IS NULL) SELECT text, (row_number() OVER (ORDER BY text COLLATE \"C\") - 1) // 20 AS batch FROM d WHERE text IS NOT NULL",
    "canonical_casing": f"""
        WITH c AS (SELECT fuel_type AS raw, count(*) AS n FROM {P} WHERE fuel_type IS NOT NULL GROUP BY 1), f AS (SELECT raw, n, {_FOLD('raw')} AS folded FROM c),
        b AS (SELECT folded, {_RAW} AS shown FROM f WHERE folded IS NOT NULL QUALIFY row_number() OVER (PARTITION BY folded ORDER BY n DESC, raw) = 1)
        SELECT folded, CASE folded WHEN 'nat gas' THEN 'Natural Gas' WHEN 'ulsd' THEN 'Diesel (ULSD)' ELSE CASE WHEN shown = lower(shown) AND shown <> upper(shown) THEN {S.title_case('shown')} ELSE shown END END AS canonical FROM b""",
    "primary_bucket": f"""
        SELECT CASE WHEN regexp_matches({_T}, {S.quote(SUBSECTOR_WORDS['is_datacenter'])}, 'i') THEN 'Data centers' WHEN regexp_matches({_T}, {S.quote(SUBSECTOR_WORDS['is_water'])}, 'i') THEN 'Water treatment / supply'
            WHEN regexp_matches({_T}, {S.quote(SUBSECTOR_WORDS['is_wastewater'])}, 'i') THEN 'Wastewater / sewage' ELSE coalesce(CASE WHEN length(naics_resolved) >= 3 THEN {_LABEL('naics_resolved[1:3]')} END, 'Unclassified') END AS bucket,
            count(*) AS units, count(DISTINCT filename) AS files FROM {P} GROUP BY 1""",
    "subsector_options": f"SELECT naics_resolved[1:3] AS option, count(*) AS rows FROM {P} WHERE naics_resolved IS NOT NULL GROUP BY 1 HAVING count(*) >= 100 UNION ALL SELECT 'ALL', count(*) FROM {P}",
    "merge_codes": f"""
        WITH a AS (SELECT filename, regexp_replace(naics_resolved, '[^0-9]', '', 'g') AS c, row_id FROM {P} WHERE source_run = 'run_a'), b AS (SELECT filename, regexp_replace(naics_code, '[^0-9]', '', 'g') AS c, row_id FROM {P} WHERE source_run = 'run_b'),
        u AS (SELECT filename, c, row_id, 'prior' AS origin FROM a WHERE length(c) = 6 UNION ALL SELECT filename, CASE WHEN length(c) = 6 THEN c ELSE '' END, row_id, 'new' FROM b)
        SELECT filename, c AS code, origin FROM u QUALIFY row_number() OVER (PARTITION BY filename ORDER BY c <> '' DESC, origin = 'new' DESC, row_id DESC) = 1""",
    "error_classes": """
        SELECT CASE WHEN regexp_matches(lower(error_text), 'context length|context window|token limit|too many tokens|max_tokens must be at least 1|finish_reason=length|context.*token|token.*context|max_tokens.*got -|got -.*max_tokens', 's') THEN 'token_limit' WHEN regexp_matches(lower(error_text), 'rate limit|429|502|503|server error|overloaded|timed out') THEN 'retryable'
            WHEN regexp_matches(lower(error_text), 'json|decode|parse|empty response') THEN 'parse' WHEN error_text IS NOT NULL THEN 'other' END AS kind, count(*) AS entries FROM processing_log WHERE status = 'failed' GROUP BY 1""",
    "rebuild_units": f"SELECT filename, arg_min_null(facility_name, row_id) AS facility_name, count(*) FILTER (WHERE {_SOME}) AS units, coalesce(string_agg(coalesce(unit_id, '?'), '|' ORDER BY row_id) FILTER (WHERE {_SOME}), '') AS ids FROM {_DOC} GROUP BY 1",
    "flatten_units": _FLAT,
    "parse_fenced_json": f"SELECT filename, facility_name, unit_id, fuel_type FROM ({_FLAT})",
    "prompt_sizes": "SELECT text_id, length(source) + length('Read the permit.') + length('--- START ---') + length('--- END ---') + 3 AS chars FROM extracted_text WHERE source IS NOT NULL",
    "consensus_field": f"""
        WITH d AS (SELECT filename, model_used, {', '.join(f'arg_min_null({c}, row_id) AS {c}' for c in FIELDS)} FROM {P} WHERE status = 'Success' GROUP BY ALL),
        l AS ({' UNION ALL '.join(f"SELECT filename, model_used, '{c}' AS field, {c} AS v FROM d" for c in FIELDS)}),
        n AS (SELECT filename, field, model_used, CASE WHEN regexp_matches(replace({_CMP}, ',', ''), '^[0-9]+([.][0-9]+)?$') THEN {S.plain_number(f"replace({_CMP}, ',', '')")} ELSE {_CMP} END AS value FROM l),
        v AS (SELECT filename, field, value, count(*) AS n, count(DISTINCT model_used) AS models FROM n WHERE value <> '' GROUP BY ALL),
        g AS (SELECT filename, field, sum(n) AS complete, count(*) AS vals FROM v GROUP BY ALL), b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY filename, field ORDER BY n DESC, value) = 1)
        SELECT g.filename, g.field, b.value AS chosen, CAST(complete AS BIGINT) AS complete, models AS agreeing, vals > 1 OR (complete >= 2 AND models < 2) AS needs_review FROM g JOIN b ON g.filename = b.filename AND g.field = b.field""",
}
