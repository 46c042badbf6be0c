"""Noise in text from scanned pages: furniture, broken words, misread characters; and the repair.

Furniture is what stands alone at the edge of a page and is a page number, the file's name, or made of the document's
title words and set phrases, or returns on other pages. Pages end at break markers and, as markers may be missing, at
lines of page numbers in sequence and of the file's name. A word broken by a line end is one whose halves make a word of
the corpus and whose hyphenated form is rarer. Misread words come from a symmetric-delete index over the corpus's
frequency lexicon: words are indexed by a form in which characters that scans confuse are alike, with and without one
letter left out; a rare word and a far more frequent one of the same form are a candidate pair, their weighted edit
distance and the frequency of the word pairs around decide.

Counts are over all texts. No list of words leaves the cluster; words, pairs and candidates meet in joins.

Defined results. Null, empty and blank texts have no noise and are repaired to themselves (null stays null). Lines are
counted from 1 at each newline. The page break marker is no noise. Repeated texts are judged alike.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fluelake.llm.canonical import distance
from fluelake.runtime import cut

#: Rows sent to every worker; more of them are joined by shuffle.
MOST_SENT = 200_000

BREAK = re.compile(r"^[ \t]*--- Page Break ---[ \t]*$|^[ \t]*\f[ \t\f]*$")
HYPHENS = "-­¬‐"
HYPHENED = set(HYPHENS)
BROKEN = re.compile(rf"([^\W\d_][\w'|]*)([{HYPHENS}])[ \t]*$")
LEADING = re.compile(r"^[ \t]*([^\W\d_][\w'|]*)")
COMPOUND = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)+")
WORD = re.compile(r"[^\W_]+(?:['.|!][^\W_]+|[|])*[|]?|[|](?=[^\W\d_])[^\W_]+")
# Phrases that running heads are made of besides a document's own title.
PHRASES = "statement of basis draft final operating permit title v technical support document page pg no number of and the inc llc co corp company ltd incorporated".split()
MONTHS = "january february march april may june july august september october november december".split()
#: A page's end is not looked for so near to the beginning or end of what the markers leave.
EDGE = 3
#: A page without break markers has at least so many lines of text.
LEAST_LINES = 6
TEXTS_AT_ONCE = 32
# The strokes that scanned characters fall into; characters and pairs with the same strokes are confused
# ("rn" and "m", "cl" and "d", "li" and "h", "1" and "l").
STROKES = str.maketrans({
    "m": "rri", "n": "ri", "u": "ii", "h": "ii", "d": "ci", "w": "vv", "l": "i", "1": "i", "|": "i", "!": "i", "0": "o", "5": "s",
    "6": "b", "8": "b", "e": "c", "f": "t", "9": "g", "q": "g", "2": "z",
})
#: A word is suspect if a word of its form is RATIO times as frequent; LONE for forms that differ by one letter.
RATIO, LONE, LEAST = 8, 60, 4
MOST_COST = 1.3


def form(word: str) -> str:
    """A word as strokes, alike for words that scans confuse."""
    return word.lower().translate(STROKES)


def _formed(word: Column) -> Column:
    """``form`` of lower-case words as an expression: first what becomes one stroke, then what becomes several."""
    one = {chr(a): b for a, b in STROKES.items() if len(b) == 1}
    t = F.translate(word, "".join(one), "".join(one.values()))
    for a, b in STROKES.items():
        if len(b) > 1:
            t = F.replace(t, F.lit(chr(a)), F.lit(b))
    return t


def _title_words(text_lines: list[str], filename: str | None) -> set[str]:
    words = {w.lower() for line in text_lines for w in re.findall(r"[^\W_]+", line)}
    return words | {w.lower() for w in re.findall(r"[^\W_]+", filename or "")} | set(PHRASES) | set(MONTHS)


_PAGE_WORDS = {form(w) for w in ("page", "pg", "of", "p", "pagc")}


def is_page_number(line: str) -> bool:
    """Nothing but a number, and perhaps the word for page and a total."""
    if len(line) > 24:
        return False
    words = re.findall(r"[^\W_]+", line)
    framed = re.fullmatch(r"\W*[\[(\-–].*[\])\-–]\W*|(?i:pa\w{2}|pg)\b.*|.*\|.*", line.strip()) is not None
    digits = [w for w in words if any(c.isdigit() for c in w) or (framed and len(w) < 4 and set(w) <= set("lIOoSB"))]
    others = [w for w in words if w not in digits]
    return bool(digits) and len(digits) <= 2 and all(len(w) <= 5 for w in digits) and all(form(w) in _PAGE_WORDS or (len(w) == 1 and form(w) == "i") for w in others) and "." not in line.replace("pg.", "").replace("Pg.", "").replace("p.", "")


FILE, FIRST = re.compile(r"[\w.\-]+\.(?:pdf|txt|tiff?)"), re.compile(r"[a-z0-9]")
NUMBERED = re.compile(r"(?i)\bpa\w\w \w{1,3} of \w{1,3}$|^\d{1,4} {3,}\D+$|^\D.* {3,}\d{1,4}$")
_DIGITS = str.maketrans("lIiOoSB", "1110058")


def page_numbers(texts: list[str]) -> set[int]:
    """Places of the page numbers among lines of text: those with the word for page, a bar or dashes around, and
    the others if most of them are in sequence."""
    framed, plain = set(), []
    for k, s in enumerate(texts):
        if not is_page_number(s):
            continue
        words = re.findall(r"[^\W_]+", s)
        value = next((v for w in words if (v := w.translate(_DIGITS)).isdecimal()), None)
        if value is None:
            continue
        if "|" in s or re.fullmatch(r"[-–].*[-–]", s) or any(len(w) > 1 and form(w) in _PAGE_WORDS for w in words):
            framed.add(k)
        else:
            plain.append((int(value), k))
    # the longest sequence of rising numbers with room for the pages between: the rest after LEAST_LINES a page may not
    # fall; the last page may be shorter
    ends, at, before = [], [], {}
    for v, k in sorted(plain, key=lambda x: (x[0], -x[1])):
        room = k - LEAST_LINES * v + (LEAST_LINES if k >= len(texts) - EDGE else 0)
        i = bisect_right(ends, room)
        before[k] = at[i - 1] if i else None
        ends[i : i + 1], at[i : i + 1] = [room], [k]
    chain, k = set(), at[-1] if at else None
    while k is not None:
        chain.add(k)
        k = before[k]
    return framed | chain if len(chain) > 1 and 2 * len(chain) > len(plain) else framed


def _known(word: str, title: set[str], forms: set[str]) -> bool:
    return word in title or form(word) in forms or len(word) == 1 or any(c.isdigit() for c in word) and (word.isdigit() or len(word) <= 7)


def furniture(lines: list[str], filename: str | None) -> set[int]:
    """Indices of running heads, feet and page numbers."""
    pages: list[list[int]] = [[]]
    for i, line in enumerate(lines):
        if BREAK.match(line):
            pages.append([])
        elif line.strip():
            pages[-1].append(i)
    head = [lines[i] for p in pages if p for i in p[:2]][:2]
    title = _title_words(head, filename)
    forms = {form(w) for w in title if len(w) > 2}
    stem = re.sub(r"[^a-z0-9]", "", (filename or "").lower())

    def names_file(s: str) -> bool:
        if "." in s and " " not in s and FILE.fullmatch(s):
            return True
        low = s.lower()
        first = FIRST.search(low) if len(stem) > 5 else None
        return first is not None and first[0] == stem[0] and re.sub(r"[^a-z0-9]", "", low) in (stem, stem + "pdf", stem + "txt")

    def foot(s: str) -> bool:
        return is_page_number(s) or names_file(s)

    # where markers are missing a page ends after the lines of its foot
    filled = [i for p in pages for i in p]
    stripped = [lines[i].strip() for i in filled]
    ends = {filled[k] for k in page_numbers(stripped)} | {i for i, s in zip(filled, stripped) if names_file(s)}
    whole, pages, unmarked = pages, [], set()
    for p in whole:
        start = 0
        for k, i in enumerate(p[:-1]):
            if i in ends and p[k + 1] not in ends and EDGE <= k < len(p) - EDGE:
                pages.append(p[start : k + 1])
                unmarked.add(len(pages) - 1)
                start = k + 1
        pages.append(p[start:])
    mask = lambda s: "|".join(sorted(re.sub(r"\d+", "0", part.strip().lower()) for part in re.split(r"\s{3,}", s.strip())))
    tops: dict[str, int] = {}
    for p in pages[1:]:
        if p:
            tops[mask(lines[p[0]])] = tops.get(mask(lines[p[0]]), 0) + 1
    inside: set[str] = set()  # made when a line first asks for it

    def running_head(i: int) -> bool:
        s = lines[i].strip()
        words = [w.lower() for w in re.findall(r"[^\W_]+", s)]
        if not words or len(s) > 110 or re.search(r"(?<!\bco)(?<!\binc)(?<!\bltd)(?<!\bcorp)[.;,:]$", s.lower()):
            return False
        if all(_known(w, title, forms) for w in words) and any(len(w) > 2 for w in words):
            letters = [w for w in words if not any(c.isdigit() for c in w)]
            shown = [w for w in re.findall(r"[^\W_]+", s) if w.lower() not in ("of", "and", "the")]
            return bool(letters) and all(not w[0].islower() or any(c.isdigit() for c in w) or form(w) in _PAGE_WORDS for w in shown)
        below = lines[i + 1] if i + 1 < len(lines) else ""
        columns = [len(re.split(r"\t| {3,}", x.strip())) for x in (s, below)]
        if re.match(r"\d+\.\d", s) or columns[0] > 2 and columns[0] == columns[1]:
            return False  # a numbered heading; the heads of a table's columns
        if tops.get(mask(s), 0) < 2:
            return False
        if not inside:
            inside.update(mask(lines[i]) for p in pages for i in p[1:-1])
        return mask(s) not in inside and not re.search(r"[a-z]{2,} [a-z]{2,} [a-z]{2,} [a-z]{2,} [a-z]{2,}", s)

    feet = [next((i for i in p[::-1] if not foot(lines[i].strip())), None) for p in (pages[k] for k in sorted(unmarked))]
    above = Counter(mask(lines[i]) for i in feet if i is not None)
    out: set[int] = set()
    for k, p in enumerate(pages):
        low = 0
        for i in p[::-1]:  # upwards from the foot
            if not foot(lines[i].strip()):
                break
            out.add(i)
            low += 1
        # the number may stand under the next page's head
        if k in unmarked and low and (rest := p[: len(p) - low]) and above[mask(lines[rest[-1]])] > 1 and running_head(rest[-1]):
            out.add(rest[-1])
            low += 1
        for i in p[: len(p) - low]:  # downwards from the head
            if not (foot(lines[i].strip()) or (k and running_head(i))):
                break
            out.add(i)
    # heads that hold the page number themselves, where neither marker nor foot shows the page's end
    numbered = [i for i in filled if ("   " in lines[i] or " of " in lines[i].lower()) and NUMBERED.search(lines[i].strip()) and running_head(i)]
    returning = Counter(mask(lines[i]) for i in numbered)
    return out | {i for i in numbered if returning[mask(lines[i])] > 1}


def words_of(line: str) -> list[str]:
    return WORD.findall(line.lower())


def line_rows(text: str, filename: str | None) -> list[tuple]:
    """(line_no, line, running, words, compounds, first, second, mark, next_no) of each line with letters or digits."""
    lines = text.split("\n")
    bad = furniture(lines, filename)
    body = [i for i, s in enumerate(lines) if i not in bad and s.strip() and not BREAK.match(s)]
    rows, carried = [], None
    following = dict(zip(body, body[1:]))
    for i, s in enumerate(lines):
        if i in bad:
            rows.append((i + 1, s, True, [], [], None, None, None, None))
            continue
        if i not in following and i not in body[-1:]:
            continue
        t, first, second, mark = s, None, None, None
        if carried:
            t = LEADING.sub("", t, count=1)
            carried = None
        j = following.get(i)
        m = BROKEN.search(t) if t.rstrip(" \t")[-1:] in HYPHENED else None
        if m and j is not None and (n := LEADING.match(lines[j])):
            first, mark, second = m[1].lower(), m[2], n[1].lower()
            carried, t = True, t[: m.start()]
        compounds = COMPOUND.findall(t.lower()) if "-" in t else []
        rows.append((i + 1, s, False, words_of(t), compounds, first, second, mark, j + 1 if first else None))
    return rows


LINE = "line_no int, line string, running boolean, words array<string>, compounds array<string>, first string, second string, mark string, next_no int"


def lines(df: DataFrame, id_col: str, text: str, filename: str) -> DataFrame:
    """One row per line that is furniture or has text, with its words; see ``line_rows``."""
    d = df.select(F.col(id_col).alias("id"), F.col(filename).alias("filename"), F.col(text).alias("text")).where(F.col("text").isNotNull())

    kind = df.schema[id_col].dataType.simpleString()
    out = f"id {kind}, {LINE}"
    form = to_arrow_schema(T._parse_datatype_string(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = form.names
        for batch in batches:  # only a few texts at a time are Python objects
            for a in range(0, batch.num_rows, TEXTS_AT_ONCE):
                i, f, t = (c.to_pylist() for c in batch.slice(a, TEXTS_AT_ONCE).columns)
                rows = [(x, *r) for x, y, z in zip(i, f, t) for r in line_rows(z, y)]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), form.field(k).type) for k, c in enumerate(zip(*rows))] if rows else [pa.array([], x.type) for x in form], names=names)

    return d.mapInArrow(run, out)


def breaks(rows: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(id, line_no, next_no, first, second, joined): the line ends that broke a word, not a compound's own hyphen."""
    h = rows.where("first is not null").select("id", "line_no", "next_no", "first", "second", "mark", F.element_at(F.concat(F.array(F.lit("")), "words"), -1).alias("prev"))
    h = h.withColumns({"joined": F.concat("first", "second"), "compound": F.concat_ws("-", "first", "second")})
    count = lambda c: lexicon.select(F.col("word").alias(c), F.col("n").alias(f"n_{c}"))
    compounds = rows.select(F.explode("compounds").alias("compound")).groupBy("compound").agg(F.count("*").alias("n_compound"))
    # how often a compound begins or ends with each half
    heads = compounds.groupBy(F.substring_index("compound", "-", 1).alias("first")).agg(F.sum("n_compound").alias("n_head"))
    for c in ("joined", "first", "second"):
        h = h.join(count(c), c, "left")
    h = h.join(compounds, "compound", "left").join(heads, "first", "left").na.fill(0, ["n_joined", "n_first", "n_second", "n_compound", "n_head"])
    soft = F.col("mark").isin("­", "¬")
    whole = (F.col("n_first") > 2) & (F.col("n_second") > 2)
    broke = F.when(F.col("n_compound") > F.col("n_joined"), False).when(F.col("n_joined") > 0, True).when(F.col("n_compound") > 0, False).otherwise(soft | ~whole & (F.col("n_head") == 0) | ~whole & (F.col("n_second") < 3))
    return h.where(broke).select("id", "line_no", "next_no", "first", "second", "joined", "prev")


def lexicon(rows: DataFrame) -> DataFrame:
    """(word, n) over the body lines of all texts, broken words left out."""
    return rows.where(~F.col("running")).select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def cost(word: str, meant: str) -> float:
    """Weighted edit distance: what a confusion explains is cheap, other edits cost 1."""
    w, m = word.lower(), meant.lower()
    if w == m:
        return 0.0
    a, b = form(w), form(m)
    swaps = abs(len(w) - len(m)) * 0.1 + sum(x != y for x, y in zip(w, m)) * 0.02
    return 0.2 + min(swaps, 0.3) if a == b else distance(a, b, 1) + 0.2


def candidates(words: DataFrame) -> DataFrame:
    """(word, meant, cost): rare words and far more frequent ones of the same form or one letter off."""
    letters = words.where("word rlike '[a-z]' and length(word) > 1")

    f = cut(letters.withColumn("form", _formed(F.col("word"))))
    left = lambda i: F.concat(F.substring(F.col("form"), F.lit(1), i - 1), F.substring(F.col("form"), i + 1, F.length("form")))
    shorter = F.when(F.length("form") >= 5, F.transform(F.sequence(F.lit(1), F.length("form")), left)).otherwise(F.expr("cast(array() as array<string>)"))
    keys = f.withColumn("key", F.explode(F.array_distinct(F.concat(F.array("form"), shorter))))
    # a word that is rare beside every word of its keys can not be what another means
    rare = keys.select("word", "n", "form", "key")
    common = keys.where(F.col("n") >= LEAST * 2).select(F.col("word").alias("meant"), F.col("n").alias("n_meant"), F.col("form").alias("form_meant"), "key")
    same = F.col("form") == F.col("form_meant")
    enough = F.when(same, F.col("n_meant") >= RATIO * F.col("n")).otherwise((F.col("n_meant") >= LONE * F.col("n")) & (F.length("form") >= 5))
    pairs = rare.join(common, "key").where((F.col("word") != F.col("meant")) & enough).select("word", "n", "meant", "n_meant").distinct()

    @F.pandas_udf("double")
    def costs(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for w, m in batches:
            yield pd.Series([cost(x, y) for x, y in zip(w, m)], dtype=float)

    return pairs.withColumn("cost", costs("word", "meant")).where(F.col("cost") <= MOST_COST)


def _sent(df: DataFrame, most: int = MOST_SENT) -> DataFrame:
    """``df``, marked for broadcast if it has no more than ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def misreadings(rows: DataFrame, broken: DataFrame, words: DataFrame) -> DataFrame:
    """(id, line_no, word, meant): every place of a misread word, a broken word at the line that has the misread part."""
    # words that occur broken only are no part of the lexicon, but may be misread like the others
    unknown = broken.select(F.col("joined").alias("word")).distinct().join(words, "word", "left_anti").withColumn("n", F.lit(1).cast("long"))
    found = cut(candidates(words.unionByName(unknown)))
    sent = _sent(found)
    body = rows.where(~F.col("running") & (F.size("words") > 0)).select("id", "line_no", "words")
    # only the places of words in question leave the lines
    places = body.select("id", "line_no", "words", F.posexplode("words").alias("pos", "word")).join(_sent(cut(found.select("word").distinct())), "word", "left_semi")
    places = places.select("id", "line_no", "word", F.get("words", F.col("pos") - 1).alias("prev"), F.get("words", F.col("pos") + 1).alias("next"))
    joined = broken.select("id", "line_no", F.col("joined").alias("word"), "prev", F.lit(None).cast("string").alias("next"), "first", "next_no")
    all_places = places.withColumns({"first": F.lit(None).cast("string"), "next_no": F.lit(None).cast("int")}).unionByName(joined)
    o = cut(all_places.join(sent, "word"))
    # of the pairs of neighbours only those asked for are counted, all over the corpus
    asked = {"before": ("prev", "meant"), "after": ("meant", "next"), "own_before": ("prev", "word"), "own_after": ("word", "next")}
    wanted = [o.select(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in asked.values()]
    wanted = cut(wanted[0].unionByName(wanted[1]).unionByName(wanted[2]).unionByName(wanted[3]).where("a is not null and b is not null").distinct())
    pair = F.xxhash64("a", "b")
    two = F.transform(F.sequence(F.lit(0), F.size("words") - 2), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1)))
    lines_of_two = body.where(F.size("words") > 1).select(F.explode(two).alias("pair"))
    pairs = lines_of_two.join(_sent(wanted.select(pair.alias("pair")).distinct()), "pair", "left_semi").groupBy("pair").agg(F.count("*").alias("n"))
    pairs = cut(wanted.join(pairs.withColumnRenamed("pair", "h"), pair == F.col("h")).select("a", "b", "n"))
    for name, (x, y) in asked.items():
        o = o.join(pairs.select(F.col("a").alias(x), F.col("b").alias(y), F.col("n").alias(name)), [x, y], "left")
    # how often the word as written stands so; the place itself is one
    o = o.na.fill(0, ["before", "after"]).na.fill(1, ["own_before", "own_after"])
    more = (F.col("before") > F.col("own_before")).cast("int") + (F.col("after") > F.col("own_after")).cast("int")
    context = (F.col("before") > 0).cast("int") + (F.col("after") > 0).cast("int")
    sides = F.when(F.coalesce("prev", F.lit("")) != "", 1).otherwise(0) + F.when(F.col("next").isNotNull(), 1).otherwise(0)
    code = F.col("word").rlike("^[a-z][0-9]+[a-z]?$") | (F.length("word") < 4) & ~F.col("word").rlike("[0-9|]")
    plain = F.col("cost") < 1.0
    ok = F.when(code, (context == 2) & plain).when(plain, (context > 0) | (sides == 0) & (F.length("word") > 5) | (F.col("n_meant") >= LONE * F.col("n")) & (F.length("word") > 6)).otherwise(more == F.greatest(F.lit(1), sides))
    rank = F.struct(F.col("cost"), (-F.col("before") - F.col("after")).alias("seen"), F.col("meant"))
    best = o.where(ok).groupBy("id", "line_no", "word", "first", "next_no").agg(F.min(rank).alias("r"))
    second = F.col("first").isNotNull() & F.startswith(F.col("r.meant"), F.col("first"))
    return best.select("id", F.when(second, F.col("next_no")).otherwise(F.col("line_no")).alias("line_no"), "word", F.col("r.meant").alias("meant"), F.col("first").isNotNull().alias("was_broken"), F.col("line_no").alias("from_line")).distinct()


def noise(df: DataFrame, id_col="text_id", text="source", filename="filename") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lines, broken words, misread words) of all texts."""
    rows = cut(lines(df, id_col, text, filename))
    words = cut(lexicon(rows))
    broken = cut(breaks(rows, words))
    return rows, broken, misreadings(rows, broken, words)


def found(df: DataFrame, **columns) -> DataFrame:
    """(id, line_no, noise): one row per line and kind of noise."""
    rows, broken, misread = noise(df, **columns)
    parts = [rows.where("running").select("id", "line_no", F.lit("running").alias("noise")), broken.select("id", "line_no", F.lit("hyphen").alias("noise")), misread.select("id", "line_no", F.lit("ocr").alias("noise")).distinct()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _same_case(meant: str, written: str) -> str:
    return meant.upper() if written.isupper() and len(written) > 1 else meant[:1].upper() + meant[1:] if written[:1].isupper() else meant


def rebuilt(text: str, running: set[int], broken: dict[int, tuple[str, str]], fixes: dict[int, dict[str, str]]) -> str:
    """The text without furniture and page breaks, words made whole and read aright, paragraphs on one line each.
    Table rows and lines of a text without line wrapping stay as they are."""
    src, out, para, drop = text.split("\n"), [], "", None
    width = max((len(s) for k, s in enumerate(src, 1) if k not in running), default=0)

    def flush():
        nonlocal para
        if para:
            out.append(para)
        para = ""

    at_page, pending = False, None
    for k, s in enumerate(src, 1):
        if k in running:
            continue
        if BREAK.match(s):
            at_page = True
            continue
        t = s.rstrip()
        if not t.strip():
            if not at_page and pending is None:
                flush()
                if out and out[-1] != "":
                    out.append("")
            continue
        if drop:
            t = LEADING.sub("", t, count=1)
            drop = None
        for wrong, right in fixes.get(k, {}).items():
            t = re.sub(rf"(?<![\w|]){re.escape(wrong)}(?![\w|])", lambda m, right=right: _same_case(right, m[0]), t, flags=re.I)
        if pending is not None:
            t, pending = pending + t.lstrip() if t[:1] in ",.;:)" else pending + t, None
        if k in broken:
            m = BROKEN.search(t)
            if m:
                pending = t[: m.start()] + _same_case(broken[k][0], m[1])
                drop = True
                continue
        table = "\t" in t or re.search(r"\S {3,}\S", t)
        if at_page and para and not re.search(r"[.:!?]$", para):
            para += " " + t.lstrip()
        elif table or width > 200:
            flush()
            out.append(t)
        else:
            if at_page:
                flush()
                out.append("")
            para = t if not para else para + t.lstrip() if para.endswith("-") else para + " " + t.lstrip()
        at_page = False
    if pending:
        para += (" " if para else "") + pending
    flush()
    return "\n".join(out)


def repaired(df: DataFrame, id_col="text_id", text="source", filename="filename") -> DataFrame:
    """(id, repaired) of every text; the noise of a text is gathered beside it, never more than its own lines."""
    rows, broken, misread = noise(df, id_col, text, filename)
    r = rows.where("running").groupBy("id").agg(F.collect_set("line_no").alias("running"))
    b = broken.groupBy("id").agg(F.collect_set(F.struct("line_no", "joined")).alias("broken"))
    m = misread.groupBy("id").agg(F.collect_set(F.struct(F.when(F.col("was_broken"), F.col("from_line")).otherwise(F.col("line_no")).alias("line_no"), "word", "meant", "was_broken")).alias("misread"))
    d = df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(r, "id", "left").join(b, "id", "left").join(m, "id", "left")

    @F.pandas_udf("string")
    def build(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            out = []
            for t, run, brk, mis in zip(*columns):
                if t is None:
                    out.append(None)
                    continue
                mis = [] if mis is None else list(mis)
                whole = {(x["line_no"], x["word"]): x["meant"] for x in mis if x["was_broken"]}
                joined = {x["line_no"]: (whole.get((x["line_no"], x["joined"]), x["joined"]), "") for x in (brk if brk is not None else [])}
                fixes: dict[int, dict[str, str]] = {}
                for x in mis:
                    if not x["was_broken"]:
                        fixes.setdefault(x["line_no"], {})[x["word"]] = x["meant"]
                out.append(rebuilt(t, set() if run is None else set(run), joined, fixes))
            yield pd.Series(out, dtype=object)

    return d.select("id", build("text", "running", "broken", "misread").alias("repaired"))
