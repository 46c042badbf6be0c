"""Best representative of each group of rows that describe one unit.

Rows belong to one unit by their id, whatever its spelling; a row without an id belongs to the unit its description
names. Of a unit's rows the Pareto-undominated ones over completeness, recency and trust form the skyline; a
lexicographic policy (completeness, then date, then smallest id) picks the survivor, and the built record fills each
field from the first dominance layer that has it. The policy does not look at trust, so rows that differ in trust
alone are equal to it: the smallest id among them survives, though the skyline holds only the most trusted.

A description without an id meets the names of its file through pieces of the name: of a name within k edits at least
one of k + 1 pieces is untouched and has moved by at most k places, so pieces and places are the join keys.

Defined results. A row that reports a failure or no unit, and one with neither id nor description, is no case and
appears nowhere. Null dates are oldest, null trust is lowest. Repeated rows tie and the smallest id survives. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluelake.functions.blank import is_blank
from fluelake.llm.truncation import _sent
from fluelake.runtime import cut, squashed, stored

UNIT_FIELDS = [
    "unit_id", "unit_description", "unit_quantity", "unit_make", "unit_model", "year_of_manufacture", "unit_type", "pollutants",
    "emission_limits", "opacity_limit", "throughput_production_limit", "control_devices", "capacity_value", "capacity_unit",
    "fuel_type", "rated_efficiency", "annual_run_hours", "generation_capacity", "applicable_neshap_nsps_subpart",
]
#: Names under this length have no pieces; floor(n / (edits + 1)) is at most LONGEST_PIECE for every longer one.
SHORT_NAME, LONGEST_PIECE = 2, 4
#: Groups, and keys of eight bytes, sent to every worker; more of them are joined by shuffle.
MOST_SENT, MOST_KEYS = 200_000, 1_000_000
MARK = r"(?:\bno\. ?|\bnumber |#)([0-9]+)"


def unit_key(unit_id: Column) -> Column:
    """An id without its spelling: upper-case letters and digits, the letter O read as zero within a number, leading
    zeros and words before the id dropped. Null for an id that says nothing."""
    t = F.upper(F.regexp_replace(unit_id, r"[^A-Za-z0-9]+", " "))
    t = F.trim(F.regexp_replace(t, r"^ *(?:(?:ID|EMISSION|EMISSIONS|SOURCE|UNIT|POINT|NO|NUMBER) )+(?=[A-Z0-9])", ""))
    t = F.regexp_replace(t, " ", "")
    t = F.regexp_replace(F.regexp_replace(t, r"(?<=[0-9])O(?=[O0-9]|[A-Z]?$)", "0"), r"(?<=[A-Z0-9])O(?=O*[0-9])", "0")
    t = F.regexp_replace(t, r"(?<![0-9])0+(?=[0-9])", "")
    return F.when(~is_blank(unit_id) & (t != ""), t)


def _names(description: Column) -> dict[str, Column]:
    """What a description names: equipment, its number and side, and its place."""
    t = F.regexp_replace(squashed(description), r"^.{1,40}?-fired ", "")
    tail = F.regexp_extract(t, MARK + r"(.*)$", 2)
    numbered = t.rlike(MARK)
    place = F.regexp_extract(F.when(numbered, tail).otherwise(F.regexp_extract(t, r"((?: in the | located in |, | - | \().*)$", 1)), r"^[ ,(-]*(?:in the |located in )?([a-z][a-z0-9 ]*)", 1)
    name = F.trim(F.when(numbered, F.regexp_extract(t, r"^(.*?) ?" + MARK, 1)).otherwise(F.regexp_extract(t, r"^([^,(;]*?)(?: in the | located in | - |,|\(|;|$)", 1)))
    side = F.regexp_extract(t, r"\b(?:left|right)\)? ([ab])\b|" + MARK + r" ([ab])\b", 1)
    side = F.when(side == "", F.regexp_extract(t, MARK + r" ([ab])\b", 2)).otherwise(side)
    return {"name": name, "number": F.regexp_extract(t, MARK, 1), "side": side, "place": F.trim(place)}


def _edits(name: Column) -> Column:
    """Edits forgiven in a name."""
    return F.greatest(F.lit(1), F.floor(F.length(name) / 5).cast("int"))


def _pieces(name: Column) -> Column:
    """(gram, at): one more disjoint pieces of a name than edits are forgiven, at each place they may have moved to."""
    k = _edits(name)
    size = F.floor(F.length(name) / (k + 1)).cast("int")
    piece = lambda i, move: F.struct(F.substring(name, i * size + 1, size).alias("gram"), (i * size + move).alias("at"))
    each = F.transform(F.sequence(F.lit(0), k), lambda i: F.transform(F.sequence(-k, k), lambda move: piece(i, move)))
    return F.when(F.length(name) >= SHORT_NAME, F.array_distinct(F.flatten(each)))


def _grams(name: Column) -> Column:
    """(gram, at): the parts of a name that have a length a piece can have."""
    at = F.sequence(F.lit(0), F.length(name) - 1)
    sizes = F.sequence(F.when(F.length(name) > 6, 3).otherwise(1), F.lit(LONGEST_PIECE))  # short pieces are of short names
    each = F.transform(sizes, lambda q: F.transform(at, lambda i: F.struct(F.substring(name, i + 1, q).alias("gram"), i.alias("at"))))
    return F.when(F.length(name) > 0, F.filter(F.flatten(each), lambda x: F.length(x["gram"]) + x["at"] <= F.length(name)))


def completeness(fields: list[str] = UNIT_FIELDS) -> Column:
    """How many of the fields hold real information."""
    return sum((F.when(is_blank(F.col(f)), 0).otherwise(1) for f in fields[1:]), F.when(is_blank(F.col(fields[0])), 0).otherwise(1))


def scored(df: DataFrame, fields: list[str]) -> DataFrame:
    """The rows that describe a unit, with the column ``unit`` (the id, or what the description names), completeness
    ``__c``, recency ``__d`` (days, null oldest), trust ``__t`` and the given fields.

    The table is read once: what its patterns give is stored, and the joins below read that."""
    good = (squashed(F.col("status")) == "success") & F.col("filename").isNotNull()
    described = ~is_blank(F.col("unit_description"))
    day = F.coalesce(F.unix_date(F.try_to_date(F.trim("processing_date"), "yyyy-MM-dd")), F.lit(-1000000))
    trust = F.when(F.lower("model_used").contains("large"), 2).otherwise(0) + F.when(F.trim("pieces_failed") == "0", 1).otherwise(0)
    marks = {"__c": completeness(), "__d": day, "__t": F.coalesce(trust, F.lit(0)), "__named": described, "__id": unit_key(F.col("unit_id")), **{f"__{k}": v for k, v in _names(F.col("unit_description")).items()}}
    read = df.where(good & (described | ~is_blank(F.col("unit_id")))).select("row_id", "filename", *fields, *[v.alias(k) for k, v in marks.items()])
    return with_units(stored(read, "units"))


def with_units(d: DataFrame) -> DataFrame:
    """``d`` with the column ``unit`` instead of what it is made of."""
    named = F.col("__named")
    with_id = d.where("__id is not null").withColumn("unit", F.concat(F.lit("id:"), "__id"))
    without = d.where("__id is null").select("filename", "__name", "__number", "__side", "__place").distinct()
    # a unit's number is that of its description, or else that of its id
    said = F.col("__number") != ""
    number = F.when(said, F.col("__number")).otherwise(F.regexp_extract("__id", r"([0-9]+)[A-Z]?$", 1))
    side = F.when(F.col("__side") != "", F.col("__side")).otherwise(F.lower(F.regexp_extract("__id", r"[0-9]([A-Z])$", 1)))
    known = with_id.where(named).select("filename", number.alias("__number"), side.alias("__side"), "unit", F.col("__name").alias("name"), F.col("__place").alias("place")).distinct()
    # names in question share an untouched piece, so that a file of many rows never meets itself whole; only pieces asked
    # for leave the rows that offer them
    keys = ["filename", "__number", "__side"]
    key = F.xxhash64(*keys, "k.at", "k.gram").alias("key")
    known = cut(known.join(_sent(without.select(*keys).distinct(), MOST_SENT), keys, "left_semi"))
    wanted = cut(without.select("*", F.explode(_pieces(F.col("__name"))).alias("k")).select(*without.columns, key))
    names = known.select(*keys, "name").distinct()
    offered = names.select(*keys, "name", F.explode(_grams(F.col("name"))).alias("k")).select("name", key)
    offered = offered.join(_sent(wanted.select("key").distinct(), MOST_KEYS), "key", "left_semi").distinct()
    off = F.levenshtein(F.col("name"), F.col("__name"))
    met = wanted.join(offered, "key").where(off <= _edits(F.col("__name"))).select(*without.columns, "name").distinct()
    # a name too short to have pieces is compared with those as short
    short = without.where(F.length("__name") < SHORT_NAME).join(names.where(F.length("name") <= SHORT_NAME), keys).select(*without.columns, "name")
    pairs = met.unionByName(short).distinct().join(known, [*keys, "name"])
    same_place = (F.col("place") == F.col("__place")) | (F.levenshtein("place", "__place") <= 2)
    near = (off <= _edits(F.col("__name"))) & ((F.col("__number") != "") | same_place)
    best = pairs.where(near).groupBy("filename", "__name", "__number", "__side", "__place").agg(F.min(F.struct(off.alias("off"), F.when(same_place, 0).otherwise(1).alias("far"), F.col("unit"))).alias("best"))
    own = F.concat(F.lit("named:"), F.concat_ws("|", "__name", "__number", "__side", "__place"))
    joined = d.where("__id is null").join(best, ["filename", "__name", "__number", "__side", "__place"], "left").withColumn("unit", F.coalesce("best.unit", own)).drop("best")
    return with_id.unionByName(joined).drop("__id", "__named", "__name", "__number", "__side", "__place")


def survivors(df: DataFrame) -> DataFrame:
    """(filename, unit, row_id, rows): of every unit with two or more rows the one that survives.

    A unit's rows shrink before the shuffle to the best row of each completeness and trust (few values), so that no
    group, however large, meets in one task; the skyline is taken of what is left."""
    d = scored(df, [])
    point = F.struct("__d", (-F.col("row_id")).alias("first"))
    corner = d.groupBy("filename", "unit", "__c", "__t").agg(F.max(point).alias("p"), F.count("*").alias("n"))
    candidate = F.struct("__c", F.col("p.__d").alias("__d"), F.col("p.first").alias("first"), "__t")
    g = corner.groupBy("filename", "unit").agg(F.sum("n").alias("rows"), F.collect_list(candidate).alias("all"))

    def undominated(x):
        def dominates(y):
            at_least = (y["__c"] >= x["__c"]) & (y["__d"] >= x["__d"]) & (y["__t"] >= x["__t"])
            return at_least & ((y["__c"] > x["__c"]) | (y["__d"] > x["__d"]) | (y["__t"] > x["__t"]))

        return ~F.exists("all", dominates)

    # the policy's best of the skyline, and then of all rows the policy calls equal to it, whatever their trust
    g = g.where("rows >= 2").withColumn("best", F.array_max(F.filter("all", undominated)))
    equal = F.filter("all", lambda x: (x["__c"] == F.col("best.__c")) & (x["__d"] == F.col("best.__d")))
    return g.select("filename", "unit", (-F.array_max(equal)["first"]).alias("row_id"), "rows")


def records(df: DataFrame, fields: list[str] = UNIT_FIELDS) -> DataFrame:
    """One record per unit, of all units: each field from the first dominance layer in which it holds information,
    there by completeness, date and smallest row id. A field no row has is null."""
    d = scored(df, fields)
    points = d.groupBy("filename", "unit").agg(F.sort_array(F.collect_set(F.struct("__c", "__d", "__t")), asc=False).alias("points"))

    def step(done, p):
        over = F.filter(done, lambda q: (q["__d"] >= p["__d"]) & (q["__t"] >= p["__t"]))
        layer = F.coalesce(F.array_max(F.transform(over, lambda q: q["layer"])), F.lit(0)) + 1
        return F.concat(done, F.array(F.struct(p["__c"].alias("__c"), p["__d"].alias("__d"), p["__t"].alias("__t"), layer.alias("layer"))))

    empty = F.expr("cast(array() as array<struct<__c:int,__d:int,__t:int,layer:int>>)")
    layers = points.select("filename", "unit", F.explode(F.aggregate("points", empty, step)).alias("l")).select("filename", "unit", "l.*")
    d = d.join(layers, ["filename", "unit", "__c", "__d", "__t"])
    rank = F.struct("layer", (-F.col("__c")).alias("c"), (-F.col("__d")).alias("d"), "row_id")
    built = [F.min_by(F.col(f), F.when(~is_blank(F.col(f)), rank)).alias(f) for f in fields]
    return d.groupBy("filename", "unit").agg(F.count("*").alias("rows"), *built)
