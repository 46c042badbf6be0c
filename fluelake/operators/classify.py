"""Industry codes from descriptions and mixed evidence, with the origin of each code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluelake.functions.text import fold_label

#: Ordered (pattern, code) rules; a parameter, of which these are the usual ones for emission-unit descriptions.
RULES = [
    (r"\bdata (processing )?cent(er|re)s?\b", "518210"), (r"\b(electric|electrical) (power )?generat(ion|ing)\b", "221112"), (r"\bpower plant\b", "221112"),
    (r"\bsteam generation\b", "221330"), (r"\bnatural gas\b.*\b(transmission|compressor|pipeline|storage)\b", "486210"), (r"\blandfill\b", "562212"),
    (r"\b(waste ?water|sewage)\b", "221320"), (r"\bwater (treatment|supply)\b", "221310"), (r"\bhospital\b", "622110"),
    (r"\bcrushed stone\b|\bquarr(y|ying)\b", "212312"), (r"\bsand and gravel\b", "212321"), (r"\bcoal min(e|ing)\b", "212114"), (r"\boil and gas\b", "211120"),
    (r"\bpetroleum refin(ery|eries|ing)\b", "324110"), (r"\basphalt\b", "324121"), (r"\bbasic chemical\b|\bchemical (production|manufactur)", "325199"),
    (r"\bplastics?\b", "326160"), (r"\bglass\b", "327213"), (r"\bbrick\b|\bclay product", "327120"), (r"\bcement\b", "327310"), (r"\bconcrete\b", "327320"),
    (r"\bpaper\b", "322120"), (r"\bpulp\b", "322110"), (r"\bwood panel\b|\bplywood\b|\bparticleboard\b", "321219"), (r"\bsawmill\b|\blumber\b", "321113"),
    (r"\bsteel foundry\b|\bfoundr(y|ies)\b", "331513"), (r"\bsteel\b", "331110"), (r"\baluminum\b", "331313"), (r"\bcorn mill", "311221"), (r"\bbrewery\b", "312120"),
    (r"\bwiner(y|ies)\b", "312130"), (r"\bfood\b", "311999"), (r"\btextile\b", "313210"), (r"\bprinting\b", "323111"), (r"\bfurniture\b", "337122"),
    (r"\bmachinery\b", "333999"), (r"\bmotor vehicle\b|\bautomobile\b", "336110"), (r"\bsemiconductor\b", "334413"), (r"\bgeneral manufacturing\b", "339999"),
]
# Industry sectors in use; catch-all codes; sectors of the older classification's divisions.
SECTORS = "11 21 22 23 31 32 33 42 44 45 48 49 51 52 53 54 55 56 61 62 71 72 81 92".split()
CATCH_ALL = ["339999"]
SIC_SECTOR = (
    {f"{i:02d}": "11" for i in range(1, 10)} | {f"{i:02d}": "21" for i in range(10, 15)} | {f"{i:02d}": "23" for i in range(15, 18)}
    | {f"{i:02d}": "31" for i in range(20, 24)} | {f"{i:02d}": "32" for i in range(24, 33)} | {f"{i:02d}": "33" for i in range(33, 40)}
    | {f"{i:02d}": "48" for i in range(40, 48)} | {"49": "22"} | {f"{i:02d}": "42" for i in range(50, 52)} | {f"{i:02d}": "44" for i in range(52, 60)}
)
EXTRA_NAICS, EXTRA_SIC = ["518210", "221310", "221320"], ["7374", "4941", "4952"]
# Names of the three-digit subsectors shown.
SUBSECTORS = {
    "311": "Food Manufacturing", "312": "Beverage and Tobacco Product", "313": "Textile Mills", "314": "Textile Product Mills", "315": "Apparel",
    "316": "Leather and Allied Product", "321": "Wood Product", "322": "Paper", "323": "Printing and Related Support", "324": "Petroleum and Coal Products",
    "325": "Chemical", "326": "Plastics and Rubber Products", "327": "Nonmetallic Mineral Product", "331": "Primary Metal", "332": "Fabricated Metal Product",
    "333": "Machinery", "334": "Computer and Electronic Product", "335": "Electrical Equipment, Appliance, and Component", "336": "Transportation Equipment",
    "337": "Furniture and Related Product", "339": "Miscellaneous", "111": "Crop Production", "211": "Oil and Gas Extraction", "212": "Mining (except Oil and Gas)",
    "221": "Utilities", "486": "Pipeline Transportation", "518": "Data Processing, Hosting, and Related Services", "562": "Waste Management and Remediation Services", "622": "Hospitals",
}


def is_manufacturing_code(code: Column) -> Column:
    return F.substring(code, 1, 2).isin("31", "32", "33")


def rule_code(text: Column, rules=RULES) -> Column:
    """The first manufacturing rule that matches, else the first other one, else null."""
    t = F.lower(text)
    made = [r for r in rules if r[1][:2] in ("31", "32", "33")]
    other = [r for r in rules if r not in made]
    first = lambda rs: F.coalesce(*[F.when(t.rlike(p), c) for p, c in rs])
    return F.coalesce(first(made), first(other))


def classified(df: DataFrame, column: str, out: str, rules=RULES, cache: DataFrame | None = None) -> DataFrame:
    """``df`` with the code of a description: the rules run once per distinct folded text; texts no rule knows are
    looked up in ``cache`` (text, code), if there is one."""
    folded = fold_label(F.col(column))
    distinct = df.select(folded.alias("__text")).where("__text is not null").distinct().withColumn("__code", rule_code(F.col("__text"), rules))
    if cache is not None:
        distinct = distinct.join(cache.select(F.col("text").alias("__text"), F.col("code").alias("__known")), "__text", "left").select("__text", F.coalesce("__code", "__known").alias("__code"))
    return df.withColumn("__text", folded).join(distinct, "__text", "left").withColumnRenamed("__code", out).drop("__text")


def code_digits(code: Column) -> Column:
    """The digits of a code, without a decimal part."""
    return F.regexp_replace(F.regexp_replace(F.trim(code), r"^([0-9]+)\.[0-9]*$", "$1"), "[^0-9]", "")


def is_manufacturing(code: Column) -> Column:
    """Four digits: divisions 2 and 3 of the older classification; else sectors 31 to 33. False for null."""
    d = code_digits(code)
    return F.coalesce(F.when(F.length(d) == 4, F.substring(d, 1, 1).isin("2", "3")).otherwise(is_manufacturing_code(d)), F.lit(False))


def in_manufacturing_tab(code: Column) -> Column:
    d = code_digits(code)
    return is_manufacturing(code) | F.coalesce(d.isin(*EXTRA_NAICS, *EXTRA_SIC), F.lit(False))


def sheet_by_codes(naics: Column, classified_code: Column, sic: Column) -> Column:
    """The other rule for the sheet: a code's first two digits, else an older code of 2xxx or 3xxx."""
    made = lambda c: F.coalesce(F.regexp_extract(F.trim(c), "^([0-9]{2})", 1).isin("31", "32", "33"), F.lit(False))
    return F.when(made(naics) | made(classified_code) | F.coalesce(F.trim(sic).rlike("^[23][0-9]{3}"), F.lit(False)), "manufacturing").otherwise("other")


def first_valid_code(text: Column) -> Column:
    """The first six-digit part with a sector in use."""
    parts = F.transform(F.split(F.trim(text), r"[;,/|\s]+"), lambda p: F.regexp_replace(p, "[^0-9]", ""))
    return F.get(F.filter(parts, lambda d: (F.length(d) == 6) & F.substring(d, 1, 2).isin(SECTORS)), F.lit(0))


def older_code_sector(text: Column) -> Column:
    """The sector of the first four-digit part."""
    parts = F.transform(F.split(F.trim(text), r"[;,/|\s]+"), lambda p: F.regexp_replace(p, "[^0-9]", ""))
    code = F.get(F.filter(parts, lambda d: F.length(d) == 4), F.lit(0))
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in SIC_SECTOR.items() for x in kv]), F.substring(code, 1, 2))


def resolved(permit: Column, registry: Column, derived: Column, older: Column) -> tuple[Column, Column]:
    """Code and its origin: the permit's, the registry's, the derived one (no catch-all), the older code's sector."""
    a, b, c, d = first_valid_code(permit), registry, first_valid_code(derived), older_code_sector(older)
    c = F.when(~c.isin(CATCH_ALL), c)
    origin = F.when(a.isNotNull(), "permit").when(b.isNotNull(), "registry").when(c.isNotNull(), "derived").when(d.isNotNull(), "sic")
    return F.coalesce(a, b, c, d), origin


def subsector_label(code: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in SUBSECTORS.items() for x in kv]), code), F.concat(F.lit("NAICS "), code))


def primary_bucket(code: Column, flags: dict[str, Column]) -> Column:
    """The subsector's label, overwritten by the last flag that holds."""
    label = F.when(F.length(code) >= 3, subsector_label(F.substring(code, 1, 3)))
    return reduce(lambda w, f: w.when(f[1], f[0]), reversed(list(flags.items())), F.when(F.lit(False), "")).otherwise(F.coalesce(label, F.lit("Unclassified")))


def canonical_spellings(df: DataFrame, column: str, synonyms: dict[str, str] | None = None) -> DataFrame:
    """(folded, canonical): per folded label its commonest spelling, ties in order; all-lowercase ones in title case;
    synonyms win."""
    from fluelake.functions.text import strip, title_case

    raw = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("raw")).agg(F.count("*").alias("n"))
    raw = raw.withColumn("folded", fold_label(F.col("raw"))).where("folded is not null")
    best = raw.groupBy("folded").agg(F.min_by("raw", F.struct(-F.col("n"), "raw")).alias("raw"))
    shown = F.regexp_replace(F.regexp_replace(strip(F.col("raw")), r"[\s\u00a0]+", " "), r"[.;,]+$", "")
    plain = (shown == F.lower(shown)) & (shown != F.upper(shown))
    known = F.try_element_at(F.create_map(*[F.lit(x) for kv in (synonyms or {"": ""}).items() for x in kv]), F.col("folded"))
    return best.select("folded", F.coalesce(known, F.when(plain, title_case(shown)).otherwise(shown)).alias("canonical"))


# What messages of exceeded token limits, and of errors worth another try, contain.
TOKEN_LIMIT = ["maximum context length", "context length", "context window", "token limit", "too many tokens", "max_tokens must be at least 1", "finish_reason=length"]
RETRYABLE = ["rate limit", "429", "502", "503", "server error", "overloaded", "timed out"]


def error_class(text: Column) -> Column:
    """token_limit, retryable, parse or other, of an error message; null for none."""
    t = F.lower(text)
    has = lambda *words: reduce(lambda a, b: a | b, [F.contains(t, F.lit(w)) for w in words])
    return (
        F.when(has(*TOKEN_LIMIT) | has("context") & has("token") | has("max_tokens") & has("got -"), "token_limit").when(has(*RETRYABLE), "retryable")
        .when(t.rlike("json|decode|parse|empty response"), "parse").when(text.isNotNull(), "other")
    )



def merge_codes(prior: DataFrame, new: DataFrame, file: str, code: str, order: str) -> DataFrame:
    """(file, code, origin): outside results merged into earlier ones. A code is six digits, whatever stands between,
    else empty. An earlier result counts only if it has a code; a new one without a code never replaces anything; of
    several of a file the last with a code counts, else the first."""
    digits = F.regexp_replace(F.coalesce(F.col(code).cast("string"), F.lit("")), "[^0-9]", "")
    read = lambda d, name: d.where(F.col(file).isNotNull()).select(file, F.when(F.length(digits) == 6, digits).otherwise("").alias(code), F.col(order).alias("__o"), F.lit(name).alias("origin"))
    both = read(prior, "prior").where(F.col(code) != "").unionByName(read(new, "new"))
    rank = F.when(F.col(code) != "", F.struct((F.col("origin") == "new").alias("new"), "__o"))
    best = both.groupBy(file).agg(F.max_by(F.struct(code, "origin"), rank).alias("b"))
    return best.select(file, F.coalesce("b." + code, F.lit("")).alias(code), F.coalesce("b.origin", F.lit("new")).alias("origin"))
