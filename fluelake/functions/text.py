"""Cleaning of free-text fields as column expressions; all stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Illegal control characters of worksheets.
CONTROL = r"[\x00-\x08\x0b-\x0c\x0e-\x1f]"
# Fuel synonyms in their order of precedence.
FUEL_SYNONYMS = {
    "#2 oil": "#2 fuel oil", "#2 fuel oil": "#2 fuel oil", "#2 distillate": "#2 fuel oil", "no. 2 oil": "#2 fuel oil",
    "no. 2 fuel oil": "#2 fuel oil", "number 2 oil": "#2 fuel oil", "number 2 fuel oil": "#2 fuel oil", "diesel fuel": "diesel",
    "diesel oil": "diesel", "natural gas": "natural gas", "nat gas": "natural gas", "ng": "natural gas", "propane gas": "propane",
    "lp gas": "propane", "lpg": "propane",
}
# Spellings of capacity units.
CAPACITY_UNITS = {
    "mmbtu/hr": "MMBtu/hr", "mmbtu per hour": "MMBtu/hr", "mmbtuhr": "MMBtu/hr", "mmbtu/h": "MMBtu/hr", "mmbtu hr": "MMBtu/hr",
    "lb/hr": "lb/hr", "lbs/hr": "lb/hr", "pounds per hour": "lb/hr", "pounds/hour": "lb/hr", "lbs/hour": "lb/hr", "tons/hr": "tons/hr",
    "tons/hour": "tons/hr", "tons per hour": "tons/hr", "ton/hr": "tons/hr", "tph": "tons/hr", "hp": "HP", "horsepower": "HP", "bhp": "BHP",
    "kw": "kW", "mw": "MW", "gallons": "gallons", "gal": "gallons", "mcf/hr": "MCF/hr", "scfm": "SCFM", "acfm": "ACFM",
}
# Number and unit patterns of descriptions, the first that matches counts.
CAPACITY_PATTERNS = [
    r"([0-9,]+(?:\.[0-9]+)?)\s*(MMBtu/hr|MMBtu/h|MMBtu|mmBtu/hr)\b", r"([0-9,]+(?:\.[0-9]+)?)\s*(MW|kw|kW)\b",
    r"([0-9,]+(?:\.[0-9]+)?)\s*(hp|HP|bhp)\b", r"([0-9,]+(?:\.[0-9]+)?)\s*(cfm|CFM|scfm|SCFM)\b",
    r"([0-9,]+(?:\.[0-9]+)?)\s*(tons/day|tons/yr|tons/year|lb/hr|lb/hour)\b",
]
# Legal suffixes of company names.
COMPANY_SUFFIXES = ["LLC", "INC", "INCORPORATED", "CORP", "CORPORATION", "CO", "COMPANY", "LP", "LLP", "LTD", "PLC", "LLLP", "PC", "PA"]
# Time bases of running hours.
HOUR_BASIS = r"(?i)(hours?/year|hours?/yr|hrs?/yr|h/yr|hr/yr|hours?\s+per\s+year|hrs?/year)"
MISSING_HOURS = "information not provided"


def strip(c: Column) -> Column:
    """Without white space, no-break spaces included, at either end."""
    return F.regexp_replace(c, r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_match(pattern: str, c: Column, group: int = 1) -> Column:
    """The group of the first match, null for none."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def normalize_zip(c: Column) -> Column:
    """ddddd-dddd from nine digits on, else five; under five digits the text as it is; null for blank and nan."""
    s, d = strip(c), F.regexp_replace(c, "[^0-9]", "")
    n = F.length(d)
    zip_code = F.when(n >= 9, F.concat(F.substring(d, 1, 5), F.lit("-"), F.substring(d, 6, 4))).when(n >= 5, F.substring(d, 1, 5)).otherwise(s)
    return F.when(~F.lower(s).isin("", "nan"), zip_code)


def normalize_date(c: Column) -> Column:
    """yyyy-MM-dd of a date written by numbers or with the month's name; null if it is none."""
    s = strip(c)
    formats = ["yyyy-MM-dd", "M/d/yyyy", "MMMM d, yyyy", "MMM d, yyyy"]
    shapes = [r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", r"^[A-Z][a-z]{3,} [0-9]{1,2}, [0-9]{4}$", r"^[A-Z][a-z]{2} [0-9]{1,2}, [0-9]{4}$"]
    return F.date_format(F.coalesce(*[F.when(s.rlike(p), F.try_to_date(s, f)) for p, f in zip(shapes, formats)]), "yyyy-MM-dd")


def plain_number(c: Column) -> Column:
    """A decimal number without leading zeros and without a fraction of zeros."""
    t = F.regexp_replace(c, "^0+([0-9])", "$1")
    return F.regexp_replace(F.regexp_replace(t, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def hours_value(c: Column) -> Column:
    s = F.regexp_replace(strip(c), ",", "")
    return F.when(~F.lower(strip(c)).isin("", "nan", "none"), plain_number(first_match(r"([0-9]+(?:\.[0-9]+)?)", s)))


def hours_basis(c: Column) -> Column:
    """The written basis in lower case; the hr/yr forms and "per year" as hours/year, the others as they are."""
    b = F.replace(F.lower(first_match(HOUR_BASIS, strip(c))), F.lit(" "), F.lit(""))
    b = F.when(b.contains("peryear") | (b.startswith("hr") & b.contains("yr")), "hours/year").otherwise(b)
    return F.when(~F.lower(strip(c)).isin("", "nan", "none"), b)


def fold_label(c: Column) -> Column:
    """Trimmed, single spaces, no final . ; or comma, lower case; null if nothing is left."""
    return empty_to_null(F.lower(F.regexp_replace(F.regexp_replace(strip(c), r"[\s\u00a0]+", " "), r"[.;,]+$", "")))


def digits_only(c: Column) -> Column:
    return empty_to_null(F.regexp_replace(c, "[^0-9]", ""))


def capacity_in(description: Column) -> tuple[Column, Column]:
    """Number without commas and unit of the first pattern that the description has."""
    p = [f"(?i){x}" for x in CAPACITY_PATTERNS]
    return F.replace(F.coalesce(*[first_match(x, description, 1) for x in p]), F.lit(","), F.lit("")), F.coalesce(*[first_match(x, description, 2) for x in p])


def capacity_unit(c: Column) -> Column:
    """The usual spelling of a unit, or the trimmed text."""
    units = F.create_map(*[F.lit(x) for kv in CAPACITY_UNITS.items() for x in kv])
    return F.coalesce(F.try_element_at(units, F.lower(F.regexp_replace(strip(c), r"[\s\u00a0]+", " "))), strip(c))


def canonical_fuel(c: Column) -> Column:
    """Exact synonym, else the first synonym that holds the text or is held by it, else the trimmed text."""
    s = strip(c)
    key = F.lower(s)
    exact = F.try_element_at(F.create_map(*[F.lit(x) for kv in FUEL_SYNONYMS.items() for x in kv]), key)
    held = reduce(lambda w, kv: w.when(key.contains(kv[0]) | F.lit(kv[0]).contains(key), kv[1]), FUEL_SYNONYMS.items(), F.when(F.lit(False), F.lit("")))
    return F.when(s != "", F.coalesce(exact, held, s))


def title_case(c: Column) -> Column:
    """Every run of letters with a capital first; letters after other characters begin anew."""
    runs = F.regexp_extract_all(c, F.lit(r"([A-Za-z]+|[^A-Za-z]+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1_000_000)))), "")


def city_case(c: Column) -> Column:
    """Title case for an all-capital name longer than three letters, else the trimmed name."""
    s = strip(c)
    shouted = (s == F.upper(s)) & (s != F.lower(s)) & (F.length(s) > 3)
    return F.when(s != "", F.when(shouted, title_case(s)).otherwise(s))


def fuel_display(c: Column) -> Column:
    """One word capitalised, several words in title case."""
    s = strip(c)
    return F.when(s != "", F.when(s.rlike("^[A-Za-z]+$"), F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1_000_000)))).otherwise(title_case(s)))


def strip_references(c: Column) -> Column:
    """Without letter-and-digit references such as b1743-b1744, spaces collapsed."""
    t = F.regexp_replace(c, r"\b[a-zA-Z][0-9]{3,5}\s*[-–]\s*[a-zA-Z]?[0-9]{3,5}\b", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"\b[a-zA-Z][0-9]{3,5}\b", " "), r"\s+", " "))


def joined_key(*parts: Column, sep: str = " | ", upper: bool = True) -> Column:
    """Trimmed parts in one case, null as empty."""
    case = F.upper if upper else F.lower
    return F.concat_ws(sep, *[case(strip(F.coalesce(p, F.lit("")))) for p in parts])


def year_in(c: Column, last: int = 2026) -> Column:
    """The first year 1900 to 2029 of a text, none after ``last``."""
    y = first_match(r"(19[0-9][0-9]|20[0-2][0-9])", c).cast("int")
    return F.when(y <= last, y)


def comparable(c: Column) -> Column:
    """Trimmed, lower case, single spaces; a number without commas and without a zero fraction; empty for null."""
    s = F.regexp_replace(F.lower(strip(F.coalesce(c, F.lit("")))), r"[\s\u00a0]+", " ")
    n = F.replace(s, F.lit(","), F.lit(""))
    return F.when(n.rlike(r"^[0-9]+(\.[0-9]+)?$"), plain_number(n)).otherwise(s)


def company_name(c: Column) -> Column:
    """Capital letters and digits, & as AND, without legal suffixes."""
    t = F.regexp_replace(F.replace(F.upper(F.coalesce(c, F.lit(""))), F.lit("&"), F.lit(" AND ")), "[^A-Z0-9 ]", " ")
    return F.array_join(F.filter(F.split(t, " +"), lambda w: (w != "") & ~w.isin(COMPANY_SUFFIXES)), " ")


def unit_key(unit_id: Column, description: Column) -> Column:
    """The trimmed id, or desc_ and twelve hex digits of the description's md5."""
    return F.coalesce(empty_to_null(strip(unit_id)), F.concat(F.lit("desc_"), F.substring(F.md5(F.coalesce(description, F.lit(""))), 1, 12)))


def file_key(c: Column) -> Column:
    """A file name in lower case without its extension."""
    return F.regexp_replace(F.lower(strip(c)), r"\.(pdf|txt|json|html?)$", "")


def keyword_case(c: Column, rules: list[tuple[str, list[str]]], other: str | None) -> Column:
    """The name of the first rule one of whose keywords the text holds."""
    return reduce(lambda w, r: w.when(reduce(lambda a, b: a | b, [c.contains(k) for k in r[1]]), r[0]), rules[1:], F.when(reduce(lambda a, b: a | b, [c.contains(k) for k in rules[0][1]]), rules[0][0])).otherwise(other)
