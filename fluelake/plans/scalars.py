"""Queries of the scalar cleaning operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from fluelake.functions import text as T
from fluelake.plans import sqltools as S
from fluelake.runtime import table

P = "permit_data_extracted"
# Words of the virtual subsectors, of fuels, of unit types, of data centers and of document decisions.
SUBSECTOR_WORDS = {
    "is_datacenter": r"\bdata\s*cent(?:er|re)s?\b|\bcolocation\b|\bhyperscale\b",
    "is_water": r"\bwater\s+(?:treatment|plant|supply|distribution|district|utility|authority)\b|\bdrinking\s+water\b|\bpotable\s+water\b",
    "is_wastewater": r"\bwastewater\b|\bsewage\b|\bsanitary\s+sewer\b|\bpublicly\s+owned\s+treatment\b|\bWWTP\b|\bPOTW\b",
}
FUEL_RULES = [
    ("Natural Gas", ["natural gas", "nat gas", "pipeline gas", "lng", "cng"]), ("Propane / LPG", ["propane", "lpg", "butane"]),
    ("Fuel Oil / Diesel", ["diesel", "distillate", "fuel oil", "no. 2", "no 2", "#2", "# 2", "no. 4", "no 4", "#4", "# 4", "kerosene", "jet fuel"]),
    ("Gasoline", ["gasoline", "petrol"]), ("Coal / Coke", ["coal", "anthracite", "bituminous", "lignite", "petcoke", "pet coke", "coke"]),
    ("Biomass / Wood", ["biomass", "wood", "sawdust", "hog fuel", "pellet", "bagasse", "fiber", "shavings"]),
    ("Biogas / Landfill Gas", ["landfill gas", "lfg", "digester gas", "biogas"]), ("Hydrogen", ["hydrogen"]),
    ("Electricity", ["electric", "grid power", "kwh"]), ("Utility / Other Non-Fuel", ["steam", "compressed air"]),
]
UNIT_RULES = [
    ("Combustion - Boilers & Heaters", ["boiler", "heater", "furnace", "kiln", "oven", "burner", "hrsg", "steam generator"]),
    ("Combustion - Engines & Turbines", ["turbine", "generator", "engine", "rice", "genset", "cogen", "compressor engine"]), ("Combustion - Flares", ["flare"]),
    ("Combustion - Thermal Processes", ["oxidizer", "incinerator", "dryer", "roaster", "afterburner", "thermal oxidizer"]),
    ("Process / Production Equipment", ["process", "line", "coating", "spray", "paint", "printing", "mix", "blend", "extrusion", "reactor"]),
    ("Storage & Material Handling", ["tank", "storage", "silo", "bin", "hopper", "pile", "conveyor", "loadout", "loading", "unloading"]),
    ("Pollution Control Equipment", ["baghouse", "scrubber", "filter", "control device", "precipitator", "separator", "cyclone", "esp", "control system"]),
]
DATA_CENTER_WORDS = ["data center", "datacenter", "data centre", "server farm", "hosting", "colocation", "colo", "cloud computing"]
TITLE_V = [r"\btitle\s*v\b", r"\btitle\s*5\b", r"\bpart\s*70\b", r"\b70\.[0-9]+\b"]
PERMIT = [r"\bpermit\b", r"\boperating permit\b", r"\btitle v operating permit\b", r"\bpermit number\b"]
NEGATIVE = [r"\bpublic notice\b", r"\bnotice of\b", r"\bhearing\b", r"\bfact sheet\b", r"\bapplication\b", r"\brequest for\b", r"\bdraft\b", r"\bcomment period\b"]
# Words that stand for no make or model, cells that say nothing, and words of names that are no search terms.
PLACEHOLDERS = ["unknown", "n/a", "na", "none", "not specified", "not available", "not listed", "unspecified", "various", "-", "--", "unk", "tbd"]
EQUIPMENT = [
    "unit_id", "unit_description", "unit_quantity", "unit_make", "unit_model", "year_of_manufacture", "unit_type", "pollutants", "emission_limits",
    "opacity_limit", "throughput_production_limit", "control_devices", "capacity_value", "capacity_unit", "fuel_type", "rated_efficiency",
    "annual_run_hours", "generation_capacity", "applicable_neshap_nsps_subpart",
]
SENTINELS = ["", "error", "invalid unit entry", "information not provided"]
STOPWORDS = ["plant", "facility", "station", "works", "mill", "terminal", "complex", "site"]


def _rows(spark, sf_dir):
    return table(spark, sf_dir, P)


def clean_dates_and_zip(spark, sf_dir):
    c = F.col
    return _rows(spark, sf_dir).select("row_id", T.normalize_date(c("issuance_date")).alias("issuance"), T.normalize_date(c("expiration_date")).alias("expiration"), T.normalize_zip(c("facility_zip_code")).alias("zip"))


def _sql_date(c):
    s = S.strip(c)
    shapes = [(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "%Y-%m-%d"), (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "%m/%d/%Y"), (r"^[A-Z][a-z]{3,} [0-9]{1,2}, [0-9]{4}$", "%B %d, %Y"), (r"^[A-Z][a-z]{2} [0-9]{1,2}, [0-9]{4}$", "%b %d, %Y")]
    return "strftime(coalesce(" + ", ".join(f"CASE WHEN regexp_matches({s}, '{p}') THEN try_strptime({s}, '{f}') END" for p, f in shapes) + "), '%Y-%m-%d')"


def _sql_zip(c):
    s, d = S.strip(c), f"regexp_replace({c}, '[^0-9]', '', 'g')"
    return f"(CASE WHEN lower({s}) NOT IN ('', 'nan') THEN CASE WHEN length({d}) >= 9 THEN substr({d}, 1, 5) || '-' || substr({d}, 6, 4) WHEN length({d}) >= 5 THEN substr({d}, 1, 5) ELSE {s} END END)"


def _sql_hours_value(c):
    s = S.strip(c)
    without_commas = f"replace({s}, ',', '')"
    return f"(CASE WHEN lower({s}) NOT IN ('', 'nan', 'none') THEN {S.plain_number(S.first_match('([0-9]+(?:[.][0-9]+)?)', without_commas))} END)"


def _sql_basis(c):
    b = f"replace(lower({S.first_match(T.HOUR_BASIS.replace('(?i)', ''), S.strip(c), 1, 'i')}), ' ', '')"
    return f"(CASE WHEN lower({S.strip(c)}) NOT IN ('', 'nan', 'none') THEN CASE WHEN contains({b}, 'peryear') OR (starts_with({b}, 'hr') AND contains({b}, 'yr')) THEN 'hours/year' ELSE {b} END END)"


def split_hours(spark, sf_dir):
    """Both hour fields split into value and basis, operating hours with their defaults."""
    c, oh = F.col, F.col("operating_hours")
    s = T.strip(oh)
    error = F.upper(s).isin("ERROR", "INVALID UNIT ENTRY")
    missing = oh.isNull() | (s == "")
    value, basis = T.hours_value(oh), T.hours_basis(oh)
    d = _rows(spark, sf_dir).select("row_id", "status", oh, c("annual_run_hours").alias("a"))
    said = F.coalesce(error, F.lit(False)) | missing
    return d.select(
        "row_id",
        F.when(missing & F.col("status").startswith("Success"), T.MISSING_HOURS).otherwise(oh).alias("operating"),
        F.when(~said, value).alias("operating_value"),
        F.when(~said, F.coalesce(basis, F.when(value.isNotNull() & F.lower(oh).contains("hour"), "hours/year"))).alias("operating_basis"),
        T.hours_value(c("a")).alias("annual_value"),
        T.hours_basis(c("a")).alias("annual_basis"),
    )


def clean_labels(spark, sf_dir):
    c = F.col
    return _rows(spark, sf_dir).select(
        "row_id", T.fold_label(c("industry_description")).alias("industry"), T.fold_label(c("unit_make")).alias("make"), T.digits_only(c("naics_code")).alias("naics"),
        T.canonical_fuel(c("fuel_type")).alias("fuel"), T.fuel_display(c("fuel_type")).alias("fuel_shown"), T.city_case(c("facility_city")).alias("city"),
        T.capacity_unit(c("capacity_unit")).alias("unit"), T.strip_references(c("unit_description")).alias("description"),
    )


def capacity_from_text(spark, sf_dir):
    """Missing capacity and unit taken from the description."""
    number, unit = T.capacity_in(F.col("unit_description"))
    no_value = F.coalesce(T.strip(F.col("capacity_value")) == "", F.lit(True))
    no_unit = F.coalesce(T.strip(F.col("capacity_unit")) == "", F.lit(True))
    return _rows(spark, sf_dir).select("row_id", F.when(no_value, F.coalesce(number, F.col("capacity_value"))).otherwise(F.col("capacity_value")).alias("capacity_value"), F.when(no_value & no_unit, F.coalesce(unit, F.col("capacity_unit"))).otherwise(F.col("capacity_unit")).alias("capacity_unit"))


def row_keys(spark, sf_dir):
    """Site, facility and unit keys, normalised company and file names."""
    c = F.col
    parts = [c(x) for x in ("facility_name", "facility_address", "facility_city", "facility_state_abbreviation", "facility_zip_code")]
    whole = T.joined_key(*parts, sep="|", upper=False)
    return _rows(spark, sf_dir).select(
        "row_id", T.joined_key(c("facility_name"), c("facility_city"), c("facility_state_abbreviation")).alias("site"),
        F.when(whole == "||||", F.concat(F.lit("unknown::"), c("filename"))).otherwise(whole).alias("facility"),
        F.regexp_replace(F.regexp_replace(whole, r"\|+", "|"), r"^\||\|$", "").alias("short_key"),
        T.unit_key(c("unit_id"), c("unit_description")).alias("unit"), F.regexp_replace(F.lower(T.unit_key(c("unit_id"), c("unit_description"))), "[^a-z0-9]", "").alias("loose_unit"),
        T.company_name(c("facility_name")).alias("company"), T.file_key(F.concat(c("filename"), F.lit(".PDF "))).alias("file"),
    )


def row_flags(spark, sf_dir):
    """Virtual subsectors, year and age, placeholder and completeness tests of every row."""
    c = F.col
    text = F.concat_ws(" ", F.coalesce(c("industry_description"), F.lit("")), F.coalesce(c("facility_name"), F.lit("")))
    year = T.year_in(c("year_of_manufacture"))
    cells = [F.when(F.coalesce(F.lower(T.strip(c(x))).isin(SENTINELS), F.lit(True)), 0).otherwise(1) for x in EQUIPMENT]
    return _rows(spark, sf_dir).select(
        "row_id", *[text.rlike(f"(?i){p}").alias(n) for n, p in SUBSECTOR_WORDS.items()], year.alias("year"), (F.lit(2026) - year).alias("age"),
        F.coalesce(F.lower(T.strip(c("unit_make"))).isin(PLACEHOLDERS), F.lit(False)).alias("make_is_placeholder"), (reduce(lambda a, b: a + b, cells) > 0).alias("has_equipment"), reduce(lambda a, b: a + b, cells).cast("bigint").alias("filled"),
        reduce(lambda a, b: a + b, [F.when(c(x).isNotNull(), 1).otherwise(0) for x in EQUIPMENT]).cast("bigint").alias("non_null"),
    )


def row_categories(spark, sf_dir):
    """Fuel and unit-type categories of rows without an ERROR cell, data centers of Virginia left out."""
    c = F.col
    error = reduce(lambda a, b: a | b, [F.coalesce(F.trim(c(x)) == "ERROR", F.lit(False)) for x in EQUIPMENT])
    fuel = F.replace(F.lower(T.strip(c("fuel_type"))), F.lit("-"), F.lit(" "))
    unit = F.lower(T.strip(c("unit_type")))
    text = F.lower(F.concat_ws(" ", c("facility_name"), c("industry_description")))
    center = F.coalesce(T.strip(c("naics_code")).startswith("518210"), F.lit(False)) | reduce(lambda a, b: a | b, [text.contains(k) for k in DATA_CENTER_WORDS])
    d = _rows(spark, sf_dir).where(~error & ~(center & F.coalesce(F.upper(T.strip(c("facility_state_abbreviation"))) == "VA", F.lit(False))))
    return d.select("row_id", F.when(~fuel.isin("", "na", "n/a", "none", "unknown"), T.keyword_case(fuel, FUEL_RULES, "Other / Misc")).alias("fuel_category"), F.when(unit != "", T.keyword_case(unit, UNIT_RULES, "Other / Uncategorized")).alias("unit_category"))


def classify_title_v(spark, sf_dir):
    """Document decisions by counts of words; the whole texts are read."""
    t = F.trim(F.regexp_replace(F.lower("text"), r"[\s\u00a0]+", " "))
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(t, F.lit("")).alias("t"))
    hits = lambda ps: reduce(lambda a, b: a + b, [F.regexp_count("t", F.lit(p)) for p in ps]).cast("bigint")
    d = d.select("doc_id", (F.col("t") == "").alias("nothing"), hits(TITLE_V).alias("title_v_hits"), hits(PERMIT).alias("permit_hits"), hits(NEGATIVE).alias("negative_hits"))
    v, p = F.col("title_v_hits"), F.col("permit_hits")
    decision = F.when(F.col("nothing"), "uncertain").when(((v >= 1) & (p >= 2)) | ((v >= 2) & (p >= 1)), "keep").when((v == 0) | (p == 0), "drop").otherwise("uncertain")
    return d.select("doc_id", decision.alias("decision"), "title_v_hits", "permit_hits", "negative_hits")


def document_sizes(spark, sf_dir):
    """Token estimate of each document and its characters without illegal control characters."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.floor(F.octet_length("text") / 4).cast("bigint").alias("tokens"), F.length(F.regexp_replace("text", T.CONTROL, "")).cast("bigint").alias("clean_chars"))


def needs_ocr(spark, sf_dir):
    """Files whose extracted text is too thin for their pages."""
    d = table(spark, sf_dir, "text_manifest").select("filename", "method", "chars", "pages")
    thin = F.when(F.col("method") == "native", F.col("chars") < 30 * F.col("pages")).otherwise(F.col("chars") < F.greatest(F.lit(300), 25 * F.col("pages")))
    return d.groupBy("filename", F.coalesce("method", F.lit("unknown")).alias("method")).agg(F.count("*").alias("entries"), F.sum(F.when(thin, 1).otherwise(0)).alias("thin"))


def answers_compared(spark, sf_dir):
    """Reviewers' answers in the form in which they are compared."""
    d = table(spark, sf_dir, "validation_run").select("record_id", F.explode("field_summary").alias("field", "s"))
    return d.select("record_id", "field", T.comparable(F.col("s.chosen_value")).alias("value"))


def search_terms(spark, sf_dir):
    """Words of facility names, each once in the order of first use, short and common words left out."""
    d = table(spark, sf_dir, P).where("facility_name is not null").select("row_id", F.posexplode(F.split(F.lower("facility_name"), "[^a-z0-9]+")).alias("pos", "term"))
    d = d.where((F.length("term") >= 4) & ~F.col("term").isin(STOPWORDS))
    first = d.groupBy("term").agg(F.min(F.struct("row_id", "pos")).alias("first"), F.count("*").alias("uses"))
    return first.select("term", F.col("first.row_id").alias("first_row"), F.col("first.pos").cast("bigint").alias("first_word"), "uses")


QUERIES = {f.__name__: f for f in (clean_dates_and_zip, split_hours, clean_labels, capacity_from_text, row_keys, row_flags, row_categories, classify_title_v, document_sizes, needs_ocr, answers_compared, search_terms)}


def _sql_hits(patterns):
    return " + ".join(f"len(regexp_extract_all(t, {S.quote(p)}))" for p in patterns)


_CAP = [(S.first_match(p, "unit_description", 1, "i"), S.first_match(p, "unit_description", 2, "i")) for p in T.CAPACITY_PATTERNS]
_KEY = " || '|' || ".join(f"lower({S.strip(f'coalesce({c}, {chr(39)}{chr(39)})')})" for c in ("facility_name", "facility_address", "facility_city", "facility_state_abbreviation", "facility_zip_code"))
_SITE = " || ' | ' || ".join(f"upper({S.strip(f'coalesce({c}, {chr(39)}{chr(39)})')})" for c in ("facility_name", "facility_city", "facility_state_abbreviation"))
_CELL = [f"(CASE WHEN coalesce(lower({S.strip(c)}) IN ({', '.join(map(S.quote, SENTINELS))}), true) THEN 0 ELSE 1 END)" for c in EQUIPMENT]
_UNIT = S.unit_key("unit_id", "unit_description")
_YEAR = S.first_match("(19[0-9][0-9]|20[0-2][0-9])", "year_of_manufacture")
_FUEL, _FKEY = S.strip("fuel_type"), f"lower({S.strip('fuel_type')})"
_HELD = " ".join(f"WHEN contains({_FKEY}, {S.quote(k)}) OR contains({S.quote(k)}, {_FKEY}) THEN {S.quote(v)}" for k, v in T.FUEL_SYNONYMS.items())
_CITY = S.strip("facility_city")
_COMP = rf"regexp_replace(lower({S.strip('coalesce(v, chr(32))')}), '[\s\x{{00A0}}]+', ' ', 'g')"
_FUEL2 = f"replace(lower({S.strip('fuel_type')}), '-', ' ')"
_DC = " OR ".join(f"contains(lower(concat_ws(' ', facility_name, industry_description)), {S.quote(k)})" for k in DATA_CENTER_WORDS)

SQL = {
    "clean_dates_and_zip": f"SELECT row_id, {_sql_date('issuance_date')} AS issuance, {_sql_date('expiration_date')} AS expiration, {_sql_zip('facility_zip_code')} AS zip FROM {P}",
    "split_hours": f"""
        WITH d AS (SELECT row_id, status, operating_hours AS oh, annual_run_hours AS a,
            coalesce(upper({S.strip('operating_hours')}) IN ('ERROR', 'INVALID UNIT ENTRY'), false) AS error, operating_hours IS NULL OR {S.strip('operating_hours')} = '' AS missing,
            {_sql_hours_value('operating_hours')} AS v, {_sql_basis('operating_hours')} AS b FROM {P})
        SELECT row_id, CASE WHEN missing AND starts_with(status, 'Success') THEN '{T.MISSING_HOURS}' ELSE oh END AS operating,
            CASE WHEN NOT (error OR missing) THEN v END AS operating_value,
            CASE WHEN NOT (error OR missing) THEN coalesce(b, CASE WHEN v IS NOT NULL AND contains(lower(oh), 'hour') THEN 'hours/year' END) END AS operating_basis,
            {_sql_hours_value('a')} AS annual_value, {_sql_basis('a')} AS annual_basis FROM d""",
    "clean_labels": rf"""
        SELECT row_id, nullif(lower(regexp_replace(regexp_replace({S.strip('industry_description')}, '[\s\x{{00A0}}]+', ' ', 'g'), '[.;,]+$', '')), '') AS industry,
            nullif(lower(regexp_replace(regexp_replace({S.strip('unit_make')}, '[\s\x{{00A0}}]+', ' ', 'g'), '[.;,]+$', '')), '') AS make,
            nullif(regexp_replace(naics_code, '[^0-9]', '', 'g'), '') AS naics,
            CASE WHEN {_FUEL} <> '' THEN coalesce({S.lookup(_FKEY, T.FUEL_SYNONYMS)}, CASE {_HELD} END, {_FUEL}) END AS fuel,
            CASE WHEN {_FUEL} <> '' THEN CASE WHEN regexp_matches({_FUEL}, '^[A-Za-z]+$') THEN upper(({_FUEL})[1:1]) || lower(({_FUEL})[2:]) ELSE {S.title_case(_FUEL)} END END AS fuel_shown,
            CASE WHEN {_CITY} <> '' THEN CASE WHEN {_CITY} = upper({_CITY}) AND {_CITY} <> lower({_CITY}) AND length({_CITY}) > 3 THEN {S.title_case(_CITY)} ELSE {_CITY} END END AS city,
            coalesce({S.lookup(f"lower(regexp_replace({S.strip('capacity_unit')}, '[{chr(92)}s{chr(92)}x{{00A0}}]+', ' ', 'g'))", T.CAPACITY_UNITS)}, {S.strip('capacity_unit')}) AS unit,
            trim(regexp_replace(regexp_replace(regexp_replace(unit_description, '\b[a-zA-Z][0-9]{{3,5}}\s*[-–]\s*[a-zA-Z]?[0-9]{{3,5}}\b', ' ', 'g'), '\b[a-zA-Z][0-9]{{3,5}}\b', ' ', 'g'), '\s+', ' ', 'g')) AS description
        FROM {P}""",
    "capacity_from_text": f"""
        WITH d AS (SELECT row_id, capacity_value AS v, capacity_unit AS u, replace(coalesce({', '.join(a for a, _ in _CAP)}), ',', '') AS n, coalesce({', '.join(b for _, b in _CAP)}) AS w,
            coalesce({S.strip('capacity_value')} = '', true) AS nv, coalesce({S.strip('capacity_unit')} = '', true) AS nu FROM {P})
        SELECT row_id, CASE WHEN nv THEN coalesce(n, v) ELSE v END AS capacity_value, CASE WHEN nv AND nu THEN coalesce(w, u) ELSE u END AS capacity_unit FROM d""",
    "row_keys": rf"""
        WITH d AS (SELECT *, {_KEY} AS whole, {_UNIT} AS uk FROM {P})
        SELECT row_id, {_SITE} AS site, CASE WHEN whole = '||||' THEN 'unknown::' || filename ELSE whole END AS facility,
            regexp_replace(regexp_replace(whole, '\|+', '|', 'g'), '^\||\|$', '', 'g') AS short_key, uk AS unit, regexp_replace(lower(uk), '[^a-z0-9]', '', 'g') AS loose_unit,
            {S.company_name('facility_name')} AS company, lower(trim(filename)) AS file FROM d""",
    "row_flags": f"""
        WITH d AS (SELECT *, coalesce(industry_description, '') || ' ' || coalesce(facility_name, '') AS t, try_cast({_YEAR} AS INTEGER) AS y0 FROM {P})
        SELECT row_id, {', '.join(f"regexp_matches(t, {S.quote(p)}, 'i') AS {n}" for n, p in SUBSECTOR_WORDS.items())}, CASE WHEN y0 <= 2026 THEN y0 END AS year, 2026 - CASE WHEN y0 <= 2026 THEN y0 END AS age,
            coalesce(lower({S.strip('unit_make')}) IN ('unknown', 'n/a', 'na', 'none', 'not specified', 'not available', 'not listed', 'unspecified', 'various', '-', '--', 'unk', 'tbd'), false) AS make_is_placeholder, {' + '.join(_CELL)} > 0 AS has_equipment, CAST({' + '.join(_CELL)} AS BIGINT) AS filled,
            CAST({' + '.join(f'(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END)' for c in EQUIPMENT)} AS BIGINT) AS non_null FROM d""",
    "row_categories": f"""
        SELECT row_id, CASE WHEN {_FUEL2} NOT IN ('', 'na', 'n/a', 'none', 'unknown') THEN {S.keyword_case(_FUEL2, FUEL_RULES, 'Other / Misc')} END AS fuel_category,
            CASE WHEN {S.strip('unit_type')} <> '' THEN {S.keyword_case(f"lower({S.strip('unit_type')})", UNIT_RULES, 'Other / Uncategorized')} END AS unit_category
        FROM {P} WHERE NOT ({' OR '.join(f"coalesce(trim({c}) = 'ERROR', false)" for c in EQUIPMENT)})
            AND NOT ((coalesce(starts_with({S.strip('naics_code')}, '518210'), false) OR {_DC}) AND coalesce(upper({S.strip('facility_state_abbreviation')}) = 'VA', false))""",
    "classify_title_v": rf"""
        WITH d AS (SELECT doc_id, coalesce(trim(regexp_replace(lower(text), '[\s\x{{00A0}}]+', ' ', 'g')), '') AS t FROM documents),
        h AS (SELECT doc_id, t = '' AS nothing, CAST({_sql_hits(TITLE_V)} AS BIGINT) AS title_v_hits, CAST({_sql_hits(PERMIT)} AS BIGINT) AS permit_hits, CAST({_sql_hits(NEGATIVE)} AS BIGINT) AS negative_hits FROM d)
        SELECT doc_id, CASE WHEN nothing THEN 'uncertain' WHEN (title_v_hits >= 1 AND permit_hits >= 2) OR (title_v_hits >= 2 AND permit_hits >= 1) THEN 'keep' WHEN title_v_hits = 0 OR permit_hits = 0 THEN 'drop' ELSE 'uncertain' END AS decision,
            title_v_hits, permit_hits, negative_hits FROM h""",
    "document_sizes": r"SELECT doc_id, CAST(floor(octet_length(encode(text)) / 4) AS BIGINT) AS tokens, CAST(length(regexp_replace(text, '[\x00-\x08\x0b-\x0c\x0e-\x1f]', '', 'g')) AS BIGINT) AS clean_chars FROM documents",
    "needs_ocr": """
        SELECT filename, coalesce(method, 'unknown') AS method, count(*) AS entries, CAST(sum(CASE WHEN CASE WHEN method = 'native' THEN chars < 30 * pages ELSE chars < greatest(300, 25 * pages) END THEN 1 ELSE 0 END) AS BIGINT) AS thin
        FROM text_manifest GROUP BY ALL""",
    "answers_compared": rf"""
        WITH d AS (SELECT record_id, unnest(map_keys(field_summary)) AS field, unnest(map_values(field_summary)).chosen_value AS v FROM validation_run)
        SELECT record_id, field, CASE WHEN regexp_matches(replace({_COMP}, ',', ''), '^[0-9]+(\.[0-9]+)?$') THEN {S.plain_number(f"replace({_COMP}, ',', '')")} ELSE {_COMP} END AS value FROM d""",
    "search_terms": f"""
        WITH w AS (SELECT row_id, string_split_regex(lower(facility_name), '[^a-z0-9]+') AS ws FROM {P} WHERE facility_name IS NOT NULL),
        d AS (SELECT row_id, unnest(generate_series(0, len(ws) - 1)) AS pos, unnest(ws) AS term FROM w)
        SELECT term, arg_min(row_id, row_id * 1000 + pos) AS first_row, CAST(arg_min(pos, row_id * 1000 + pos) AS BIGINT) AS first_word, count(*) AS uses
        FROM d WHERE length(term) >= 4 AND term NOT IN ({', '.join(map(S.quote, STOPWORDS))}) GROUP BY term""",
}
