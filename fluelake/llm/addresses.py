"""Postal addresses that denote the same place, by mined rewrites.

Addresses agreeing in house number and postal code (the town where there is none), and in all words but one run of at
most two, show how one thing is written in two ways. Such pairs are counted over all addresses; those whose
co-occurrence is significant become rewrites, the addresses are normalised again and matched again, until no new rewrite
appears. The abbreviations of street types and directions are mined first, by the same test; only those that too few
addresses show are filled in from a given list. Then mining goes on with all words, and two files lie at one place if number and street name agree (up to one typing error), stated types and directions do not differ, and the
postal code or the town agrees.

No pairs are formed to mine or to match: masked words, and names with one letter left out, are the join keys. Only the
answer itself lists pairs of files.

Defined results. Null, blank and filler addresses, post office boxes and texts without a house number state no street
location and are in no pair. A building, gate, plant or suite is left out. Several rows of a file count once; the
greatest stated value of each field stands for the file. A file is in no pair with itself.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluelake.functions.blank import FILLER_WORDS, is_blank
from fluelake.llm.canonical import distance
from fluelake.runtime import cut

# Street types and directions with their common abbreviations; rewrites never turn one into another.
TYPES = {
    "street": "st str strt", "avenue": "av ave aven avn", "road": "rd", "drive": "dr drv driv", "lane": "ln", "court": "ct crt",
    "boulevard": "blvd boul boulv", "parkway": "pkwy pky pkway parkwy", "place": "pl", "circle": "cir circ", "terrace": "ter terr",
    "trail": "trl", "way": "wy", "highway": "hwy hiway", "square": "sq", "plaza": "plz", "alley": "aly", "loop": "lp", "pike": "pk",
}
DIRECTIONS = {
    "north": "n no", "south": "s so", "east": "e", "west": "w",
    "northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw",
}
ROADS = {"county road": "cr|co rd|cnty rd|county rd|co road|cnty road", "state highway": "state hwy|st hwy|st highway|sh", "state route": "sr|st rt|state rt"}
ORDINALS = "first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth".split()
TOWNS = {"saint": "st", "fort": "ft", "mount": "mt", "north": "n", "south": "s", "east": "e", "west": "w"}
PART = re.compile(r"(?:,\s*)?\b(?:buildings?|bldg|gate|plant|plt|suite|ste|unit|floor|room|rm|dock|apt)\b\.?\s*(?:#|no\.?)?\s*\d+[a-z]?\b\s*,?|(?:,\s*)?\b(?:suite|ste|unit|bldg|building)\b\.?\s*#?\s*[a-z]\b\s*,?")
BOX = re.compile(r"\bp\.?\s*o\.?\s*box\b|\bpost office box\b")
TAIL = re.compile(r",\s*([^,\d]+),\s*([a-z]{2})\b\.?(?:\s+(\d{5})(?:-?\d{4})?)?\W*$")
WORDS_OF_TYPE = {x for t, a in TYPES.items() for x in [t]}
SEED = {a: t for t, s in TYPES.items() for a in s.split()} | {a: d for d, s in DIRECTIONS.items() for a in s.split()} | {a: r for r, s in ROADS.items() for a in s.split("|")}
SEED |= {f"{i}{({1: 'st', 2: 'nd', 3: 'rd'}).get(i, 'th')}": w for i, w in enumerate(ORDINALS, 1)}
FIXED = sorted(WORDS_OF_TYPE | set(DIRECTIONS))
#: A rewrite needs this log-likelihood ratio (p < 0.001), support, and share of the word's places.
SIGNIFICANT, SUPPORT, SHARE = 10.83, 2, 0.15
#: The same share for a type or direction: most of its places have no other spelling beside them.
TYPE_SHARE = 0.02
#: A spelling within one edit of a word this many times as frequent is a typing error.
TYPO_RATIO, TYPO_LENGTH = 8, 5
#: A correction must have a lower chance than this to be near a frequent word by accident; letters a word may be of.
CHANCE, LETTERS = 0.05, 26
#: Without a common frame a rare word must be within one edit of a word this many times as frequent.
LONE_RATIO = 25
MOST_REWRITES = 200_000
#: A frame of more runs is paired in parts of so many.
FRAME = 500
RECORD = "number string, words array<string>, zip string, town string, state string"


def rewritten(words: list[str], rules: dict[str, str]) -> list[str]:
    """The words after the rules for runs of two and of one, applied once from the left."""
    out, i = [], 0
    while i < len(words):
        two = " ".join(words[i : i + 2])
        if i + 1 < len(words) and two in rules:
            out += rules[two].split()
            i += 2
        else:
            out += rules.get(words[i], words[i]).split()
            i += 1
    return out


def town_key(town: str | None) -> str | None:
    if town is None or (t := re.sub(r"[\s\u00a0]+", " ", re.sub(r"[^a-z\s\u00a0]", " ", town.lower())).strip()) in FILLER_WORDS:
        return None
    return "".join(TOWNS.get(w, w) if i == 0 else w for i, w in enumerate(t.split()))


def parsed(address: str | None, town: str | None, code: str | None, state: str | None):
    """(house number, words of the street, postal code, town, state), or None for no street location."""
    a = re.sub(r"[\s\u00a0]+", " ", (address or "").lower()).strip()
    if a in FILLER_WORDS or BOX.search(a):
        return None
    z = re.sub(r"\D", "", code or "")[:5]
    s = (state or "").strip().lower()
    tail = TAIL.search(a)
    if tail:
        town, s = (town if town_key(town) else tail[1]), (s if len(s) == 2 else tail[2])
        z = z if len(z) == 5 else tail[3] or ""
        a = a[: tail.start()]
    a = PART.sub(" ", a)
    m = re.search(r"(?:\bno\.?|#)\s*(\d+)\b", a) or re.search(r"^\W*(\d+)\b(?!\s*(?:st|nd|rd|th)\b)", a) or re.search(r"\b(\d+)\W*$", a)
    if not m:
        return None
    rest = f"{a[: m.start()]} {a[m.end() :]}"
    words = re.sub(r"[^a-z0-9 ]", " ", re.sub(r"(?<=[a-z])\.(?=[a-z]\b)|['’]", "", rest)).split()
    if not words or not any(c.isalpha() for w in words for c in w):
        return None
    return m[1].lstrip("0"), words, z if len(z) == 5 else None, town_key(town), s if len(s) == 2 else None


def street(words: list[str]) -> tuple[str, str | None, str | None]:
    """(name without spaces, type, direction) of normalised words."""
    w, kind, way = list(words), None, None
    if len(w) > 1 and w[-1] in DIRECTIONS:
        way = w.pop()
    elif len(w) > 1 and w[0] in DIRECTIONS:
        way = w.pop(0)
    if len(w) > 1 and w[-1] in WORDS_OF_TYPE:
        kind = w.pop()
    if way is None and len(w) > 1 and w[-1] in DIRECTIONS:
        way = w.pop()
    if w and w[0] == "highway" and len(w) > 1 and w[1].isdigit():
        w.insert(0, "state")
    return "".join(w), kind, way


def files(rows: DataFrame, file="filename", address="facility_address", town="facility_city", code="facility_zip_code", state="facility_state_abbreviation") -> DataFrame:
    """(file, number, words, zip, town, state): the street location each file states, files without one left out."""
    said = [F.max(F.when(~is_blank(F.col(c)), F.col(c))).alias(n) for c, n in ((address, "address"), (town, "town"), (code, "code"), (state, "state"))]
    one = rows.where(F.col(file).isNotNull()).groupBy(F.col(file).alias("file")).agg(*said).where("address is not null")

    @F.pandas_udf(RECORD)
    def parse(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            got = [parsed(*r) or (None, None, None, None, None) for r in zip(*columns)]
            yield pd.DataFrame(got, columns=["number", "words", "zip", "town", "state"])

    d = one.select("file", parse("address", "town", "code", "state").alias("r")).select("file", "r.*")
    return d.where("number is not null")


def _normalised(places: DataFrame, rules: dict[str, str]) -> DataFrame:
    sent = places.sparkSession.sparkContext.broadcast(rules)

    @F.pandas_udf("array<string>")
    def rewrite(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for words in batches:
            yield pd.Series([rewritten(list(w), sent.value) for w in words], dtype=object)

    return places.withColumn("words", rewrite("words"))


def _candidates(places: DataFrame) -> DataFrame:
    """(a, b, support, places of a, of b, all places): runs found in one frame, every two of them, the rarer one as a."""
    d = places.select("number", F.coalesce("zip", F.concat(F.lit("t"), "town")).alias("zip"), "words").where("zip is not null").distinct()

    def masked(n):
        def at(i):
            frame = F.concat_ws(" ", F.slice("words", 1, i - 1), F.lit("*"), F.slice("words", i + n, F.size("words")))
            return F.struct(F.concat_ws("|", "number", "zip", frame).alias("frame"), F.concat_ws(" ", F.slice("words", i, n)).alias("run"))

        return F.when(F.size("words") >= n, F.transform(F.sequence(F.lit(1), F.size("words") - n + 1), at)).otherwise(F.expr("cast(array() as array<struct<frame:string,run:string>>)"))

    runs = d.select(F.explode(F.concat(masked(1), masked(2))).alias("x")).select("x.*").where("not run rlike '^[0-9 ]+$'").distinct()
    frequency = runs.groupBy("run").agg(F.count("*").alias("f"))
    both = runs.join(frequency, "run")
    # frames of one run have no pair; the others are split by salts, each part meeting all runs of its frame
    several = runs.groupBy("frame").agg(F.count("*").alias("n")).where("n > 1").select("frame", F.ceil(F.col("n") / FRAME).alias("parts"))
    each = both.join(several, "frame")
    left = each.select("frame", F.pmod(F.xxhash64("run"), F.col("parts")).alias("part"), F.col("run").alias("a"), F.col("f").alias("f_a"))
    right = each.select("frame", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("run").alias("b"), F.col("f").alias("f_b"))
    rarer = (F.col("f_a") < F.col("f_b")) | (F.col("f_a") == F.col("f_b")) & (F.col("a") < F.col("b"))
    pairs = left.join(right, ["frame", "part"]).where(rarer).groupBy("a", "f_a", "b", "f_b").agg(F.count("*").alias("support"))
    return pairs.join(F.broadcast(runs.agg(F.count("*").alias("all"))), F.lit(True))  # one row, one number


def _misspelt(places: DataFrame) -> DataFrame:
    """(a, f_a, b, f_b): rare words and the frequent ones that share a form with one letter left out."""
    words = places.select("number", "zip", F.explode("words").alias("a")).where("not a rlike '[0-9]' and length(a) >= 4").distinct()
    f = cut(words.groupBy("a").agg(F.count("*").alias("f_a")))
    shorter = F.transform(F.sequence(F.lit(1), F.length("a")), lambda i: F.concat(F.substring(F.col("a"), F.lit(1), i - 1), F.substring(F.col("a"), i + 1, F.length("a"))))
    forms = f.withColumn("form", F.explode(F.array_distinct(F.concat(F.array("a"), shorter))))
    right = forms.select(F.col("a").alias("b"), F.col("f_a").alias("f_b"), "form").where(F.col("f_b") >= LONE_RATIO)
    return forms.join(right, "form").where(F.col("f_b") >= LONE_RATIO * F.col("f_a")).select("a", "f_a", "b", "f_b").distinct()


def _ratio(k: int, a: int, b: int, n: int) -> float:
    """Log-likelihood ratio of k joint places where a and b would meet by chance in a * b / n."""
    expected = max(a * b / n, 1e-9)
    return 2 * (k * math.log(k / expected) - (k - expected)) if k > expected else 0.0


def _abbreviations(rows, rules: dict[str, str]) -> dict[str, str]:
    """The runs that significantly stand for a type or direction, in letters of it in their order, whichever is the
    rarer; nothing else is decided before these are alike."""
    fixed = WORDS_OF_TYPE | set(DIRECTIONS)
    best: dict[str, tuple[float, str]] = {}
    for r in rows:
        for x, y, f in ((r.a, r.b, r.f_a), (r.b, r.a, r.f_b)):
            if y not in fixed or x in fixed or x in rules or x[0] != y[0] or not _in_order(x, y):
                continue
            ratio = _ratio(r.support, r.f_a, r.f_b, r.all)
            if ratio >= SIGNIFICANT and r.support >= SUPPORT and r.support >= TYPE_SHARE * f:
                best[x] = max(best.get(x, (0.0, "")), (ratio, y))
    return {x: y for x, (_, y) in best.items()}


def _in_order(short: str, long: str) -> bool:
    at = iter(long)
    return all(c in at for c in short)


def _accepted(rows, rules: dict[str, str]) -> dict[str, str]:
    fixed = WORDS_OF_TYPE | set(DIRECTIONS)
    best: dict[str, tuple[float, str]] = {}
    for r in rows:
        a, b = r.a, r.b
        if a in fixed or a in rules or any(w.isdigit() for w in (a + " " + b).split()):
            continue
        if set(a.split()) & fixed != set(b.split()) & fixed and set(a.split()) & fixed:
            continue  # never swap or drop a stated type or direction
        x, y = a.replace(" ", ""), b.replace(" ", "")
        ratio = _ratio(r.support, r.f_a, r.f_b, r.all)
        typo = x == y or (min(len(x), len(y)) >= TYPO_LENGTH and r.f_b >= TYPO_RATIO * r.f_a and distance(x, y, 1) <= 1 and not any(c.isdigit() for c in x + y))
        common = r.support >= SUPPORT and r.support >= SHARE * r.f_a and x[0] == y[0] or (r.support >= SUPPORT and r.support >= SHARE * r.f_a and a[0].isdigit() != b[0].isdigit())
        if ratio >= SIGNIFICANT and (typo or common):
            best[a] = max(best.get(a, (0.0, "")), (ratio, b))
    return {a: b for a, (_, b) in best.items()}


def _by_chance(word: str, frequent: int) -> float:
    """How many of so many frequent words an unrelated word would have within one edit, were letters drawn at random."""
    n = len(word)
    return frequent * (52 * n + 25) / LETTERS**n


def _corrections(rows, rules: dict[str, str]) -> dict[str, str]:
    fixed = WORDS_OF_TYPE | set(DIRECTIONS)
    best: dict[str, tuple[int, int, str]] = {}
    frequent = len({r.b for r in rows})
    for r in rows:
        if r.a not in fixed and r.a not in rules and _by_chance(r.a, frequent) < CHANCE and (d := distance(r.a, r.b, 1)) <= 1:
            best[r.a] = min(best.get(r.a, (9, 0, "")), (d, -r.f_b, r.b))
    return {a: b for a, (_, _, b) in best.items()}


def _few(pairs: DataFrame) -> list:
    """The pairs to judge, on the driver, their number checked."""
    rows = pairs.limit(MOST_REWRITES + 1).collect()
    if len(rows) > MOST_REWRITES:
        raise ValueError(f"more than {MOST_REWRITES} rewrites to judge; mine the addresses state by state")
    return rows


def mined(places: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The places with normalised words, and the rewrites found; stops when a round finds none."""
    found: dict[str, str] = {}
    while True:
        pairs = _candidates(places).where((F.col("support") >= SUPPORT) & (F.col("a").isin(*FIXED) | F.col("b").isin(*FIXED)))
        new = _abbreviations(_few(pairs), found)
        if not new:
            break
        found |= new
        places = cut(_normalised(places, new))
    places = cut(_normalised(places, {a: b for a, b in SEED.items() if a not in found}))
    while True:  # each round adds a run of the finite vocabulary as a key
        # only pairs that can pass leave the cluster
        worth = _candidates(places).where((F.col("support") >= SUPPORT) & (F.col("support") >= SHARE * F.col("f_a")) | (F.col("f_b") >= TYPO_RATIO * F.col("f_a")) & (F.levenshtein(F.replace("a", F.lit(" "), F.lit("")), F.replace("b", F.lit(" "), F.lit(""))) <= 2))
        new = _accepted(_few(worth), found)
        new = _corrections(_few(_misspelt(places)), found | new) | new
        if not new:
            break
        found |= new
        places = cut(_normalised(places, new))
    return places, found


def _records(places: DataFrame) -> DataFrame:
    @F.pandas_udf("name string, type string, way string")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for words in batches:
            yield pd.DataFrame([street(list(w)) for w in words], columns=["name", "type", "way"])

    return places.withColumn("s", split("words")).select("file", "number", "s.*", "zip", "town", "state")


def same_place(rows: DataFrame, **columns) -> DataFrame:
    """(file_a, file_b), file_a < file_b: the pairs of files at one place."""
    places, _ = mined(cut(files(rows, **columns)))
    d = _records(places)
    key = F.unhex(F.sha2(F.concat_ws("|", *[F.coalesce(c, F.lit("?")) for c in ("number", "name", "type", "way", "zip", "town", "state")]), 256))
    d = cut(d.withColumn("r", key))
    records = d.drop("file").distinct()
    # names within one edit share the name with one letter left out, or one is the other's
    shorter = F.transform(F.sequence(F.lit(1), F.length("name")), lambda i: F.concat(F.substring(F.col("name"), F.lit(1), i - 1), F.substring(F.col("name"), i + 1, F.length("name"))))
    variants = F.when(F.col("name").rlike("[0-9]") | (F.length("name") < TYPO_LENGTH), F.array("name")).otherwise(F.array_distinct(F.concat(F.array("name"), shorter)))
    where = F.array_compact(F.array(F.concat(F.lit("z"), "zip"), F.concat(F.lit("t"), "town"), F.concat(F.lit("s"), "state")))
    keys = records.withColumn("variant", F.explode(variants)).withColumn("where", F.explode(where))
    # the state alone is a key only where the other side may know no more
    left = keys.select(*[F.col(c).alias(f"{c}_a") for c in records.columns], "number", "variant", "where")
    right = keys.select(*[F.col(c).alias(f"{c}_b") for c in records.columns], "number", "variant", "where")
    p = left.join(right, ["number", "variant", "where"]).where("r_a < r_b").drop("variant", "where").distinct()
    agree = lambda c: F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b"))
    open_or_same = lambda c: F.coalesce(F.col(f"{c}_a") == F.col(f"{c}_b"), F.lit(True))
    near = F.length(F.greatest("name_a", "name_b"))
    street_ok = open_or_same("type") & open_or_same("way") & open_or_same("state") & (near > 0)
    street_same = agree("type") & agree("way")
    zips, towns = F.col("zip_a") == F.col("zip_b"), F.col("town_a") == F.col("town_b")
    unplaced = F.coalesce("zip_a", "town_a").isNull() | F.coalesce("zip_b", "town_b").isNull()
    one_zip = F.col("zip_a").isNull() | F.col("zip_b").isNull()
    place_ok = F.coalesce(zips, F.lit(False)) | F.coalesce(towns, F.lit(False)) & (one_zip | street_same) | unplaced & street_same & (F.col("name_a") == F.col("name_b"))
    linked = p.where(street_ok & place_ok).select("r_a", "r_b")
    who = d.select("r", "file")
    across = linked.join(who.select(F.col("r").alias("r_a"), F.col("file").alias("x")), "r_a").join(who.select(F.col("r").alias("r_b"), F.col("file").alias("y")), "r_b")
    across = across.select(F.least("x", "y").alias("file_a"), F.greatest("x", "y").alias("file_b"))
    placed = d.where(F.coalesce("zip", "town", "state").isNotNull()).select("r", "file")
    within = placed.withColumnRenamed("file", "file_a").join(placed.withColumnRenamed("file", "file_b"), "r").where("file_a < file_b").select("file_a", "file_b")
    return within.unionByName(across)
