"""Free-entered values mapped to the entries of a reference list.

Canonical names and aliases go into one multi-pattern automaton, which finds them as whole words inside a value; of
overlapping mentions the longest wins, and the entry with the longest text mentioned is the value's. A value without a
mention goes to token-set similarity: its words are matched softly to an entry's words (typing errors, misread
characters, abbreviations, initials, joined and split words), weighed by how few entries use a word. A value that no
entry reaches, or that two reach alike, is reported unmatched with reference 0.

Defined results. Null, blank and filler values are no cases. A value spelled exactly like a canonical name needs no
mapping and gives no row. Repeated values give the same answer, each its row. An empty reference list maps every value
to 0. Entries with null names or fields are ignored. A very long value is matched whole.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluelake.functions.blank import is_blank

#: The reference list goes to every worker; a longer list must be split by field or otherwise partitioned first.
MOST_ENTRIES = 1_000_000
# Words that say nothing about which entry is meant.
NOISE = {
    "primary", "secondary", "backup", "only", "existing", "new", "see", "note", "notes", "typical", "no", "number", "num", "the", "of", "and", "a",
    "inc", "llc", "co", "corp", "corporation", "company", "mfg", "ltd", "manufacturing",
}
# Characters that scans and typists confuse, read as letters.
MISREAD = str.maketrans({"0": "o", "1": "l", "5": "s", "8": "b"})
# Trade words that are no spelling of the list's.
SYNONYMS = {"genset": "generator", "gensets": "generator"}
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"
#: The most that ``most_edits`` gives; the longest ending that ``stem`` takes off, and one edit.
MOST_EDITS, LONGEST_ENDING = 4, 6
NOTHING = np.array([], dtype=int)
ACCEPT, MARGIN, NAMED, PARTLY = 0.6, 0.08, 0.72, (0.6, 0.45)


def words(text: str) -> list[str]:
    """Lower-case words; a letter-and-digit mix stays one word."""
    return re.findall(r"[^\W_]+(?:&[^\W_]+)*", text.lower())


def distance(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap of neighbours) between two strings, or ``most`` + 1 if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if before and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


def allowed(n: int) -> int:
    """Edits forgiven in a word of n letters."""
    return 0 if n < 4 else 1 if n < 6 else 2 if n < 10 else 3


def _within(short: str, long: str) -> bool:
    at = iter(long)
    return all(c in at for c in short)


def stem(w: str) -> str:
    """A word without the common ending that makes it another form ("curing", "cure")."""
    return re.sub(r"(?<=[a-z]{3})(?:ating|atory|ation|ing|ory|ers?|ors?|ion|ed|es|e|s)$", "", w)


def likeness(v: str, c: str) -> float:
    """How surely the typed word v stands for the word c."""
    if v == c:
        return 1.0
    if v.isdigit() or c.isdigit():
        return 0.0
    r = v.translate(MISREAD)
    if r == c or r + "s" == c or r == c + "s":
        return 0.97
    n = max(len(r), len(c))
    most = allowed(n) + 1
    d = distance(r, c, most)
    best = 0.0
    if d < most and (d < 2 or min(len(r), len(c)) > 5):
        best = 1.0 - 0.1 * d if n < 10 else 1.0 - 0.08 * d
    elif d == most and (n >= 7 or (n == 3 and len(r) > 1)):
        best = 0.55
    if len(r) >= 3 and c.startswith(r):
        best = max(best, 0.85)
    if 3 <= len(r) < len(c) and r[0] == c[0] and r[-1] == c[-1] and _within(r, c) and sum(x in "aeiou" for x in r) * 2 < len(r):
        best = max(best, 0.8)
    if len(r) > 3 and len(c) > 3:
        x, y = stem(r), stem(c)
        if x == y:
            best = max(best, 0.85)
        elif best < 0.75 and max(len(x), len(y)) > 3 and min(len(x), len(y)) > 2 and x[0] == y[0] and distance(x, y, 1) <= 1:
            best = max(best, 0.65)
    return best


def most_edits(n: int) -> int:
    """Edits at which a word of n letters is still looked at."""
    return allowed(n) + 1


class Words:
    """The words of a list, indexed by all that can make ``likeness`` positive, so that it is tried on few of them:
    the letters they count (no edit changes more than one), their beginnings, first and last letters with one between,
    and their stems with one letter left out."""

    def __init__(self, listed: set[str]):
        self.sorted = sorted(w for w in listed if not w.isdigit())
        by_length = sorted(self.sorted, key=len)
        self.words = np.array(by_length, dtype=object)
        self.lengths = np.array([len(w) for w in by_length], dtype=np.int64)
        self.bags = np.array([self._bag(w) for w in by_length], dtype=np.int32).reshape(-1, len(LETTERS) + 1)
        self.edits = np.array([most_edits(n) for n in range(int(self.lengths[-1]) + 5 if len(by_length) else 5)])
        self.between: dict[tuple[str, str, str], list[str]] = {}
        self.stems: dict[str, list[str]] = {}
        for w in self.sorted:
            for x in set(w[1:-1]):
                self.between.setdefault((w[0], w[-1], x), []).append(w)
            if len(w) > 3:
                for form in shortened(stem(w)):
                    self.stems.setdefault(form, []).append(w)
        self.longest = int(self.lengths[-1]) if len(by_length) else 0

    @staticmethod
    def _bag(w: str) -> list[int]:
        known = [w.count(x) for x in LETTERS]
        return [*known, len(w) - sum(known)]

    def near(self, v: str) -> dict[str, float]:
        """Each word that v may stand for, with its likeness."""
        r = v.translate(MISREAD)
        n = len(r)
        tried: set[str] = set()
        # edits: lengths within reach, then letters that edits can explain
        lo, hi = np.searchsorted(self.lengths, [n - MOST_EDITS, n + MOST_EDITS + 1])
        if lo < hi:
            m = self.lengths[lo:hi]
            k = self.edits[np.maximum(m, n)] if n < len(self.edits) else np.full(len(m), most_edits(n))
            off = self.bags[lo:hi] - np.array(self._bag(r), dtype=np.int32)
            more = np.maximum(off, 0).sum(axis=1)
            ok = (more <= k) & (more - (m - n) <= k)
            tried.update(self.words[lo:hi][ok])
        if n >= 3:
            at = bisect_left(self.sorted, r)
            while at < len(self.sorted) and self.sorted[at].startswith(r):
                tried.add(self.sorted[at])
                at += 1
            tried.update(min((self.between.get((r[0], r[-1], x), []) for x in r[1:-1]), key=len))
        if n > 3:
            for form in shortened(stem(r)):
                tried.update(self.stems.get(form, []))
        return {c: s for c in tried if (s := likeness(v, c)) > 0}


def shortened(w: str) -> set[str]:
    """A word, and the same with one letter left out."""
    return {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}


class Matcher:
    """The entries (reference, names) of one field."""

    def __init__(self, entries: list[tuple[int, list[str]]]):
        self.names: list[tuple[int, tuple[str, ...]]] = []
        self.exact: dict[str, int] = {}
        self.canonical = {names[0] for _, names in entries}
        self.automaton = ahocorasick.Automaton()
        users: dict[str, set[int]] = {}
        patterns: dict[str, tuple[int, int]] = {}
        in_names: dict[str, list[int]] = {}
        initials: dict[str, list[int]] = {}
        for ref, names in entries:
            for name in names:
                w = tuple(words(name))
                if not w:
                    continue
                for x in set(w):
                    users.setdefault(x, set()).add(ref)
                    in_names.setdefault(x, []).append(len(self.names))
                first = "".join(x[0] for x in w)
                for two in {first[i : i + 2] for i in range(len(first) - 1)}:
                    initials.setdefault(two, []).append(len(self.names))
                self.names.append((ref, w))
                self.exact.setdefault("".join(w), ref)
                patterns.setdefault(f" {' '.join(w)} ", (ref, len("".join(w))))
        for p, x in patterns.items():
            self.automaton.add_word(p, (len(p), *x))
        if patterns:
            self.automaton.make_automaton()
        n = max(1, len({r for r, _ in self.names}))
        self.weight = {x: math.log(1 + n / len(u)) for x, u in users.items()}
        self.unknown = math.log(1 + n)
        self.numbers = {x for x in users if x.isdigit()}
        self.numbered = np.array([bool(self.numbers & set(c)) for _, c in self.names], dtype=bool)
        self.total = np.array([sum(self.weight[x] for x in dict.fromkeys(c)) for _, c in self.names])
        self.in_names = {x: np.array(i) for x, i in in_names.items()}
        self.initials = {x: np.array(i) for x, i in initials.items()}
        self.words = Words(set(users))
        self.near = lru_cache(1 << 16)(self._near)
        self._lost = lru_cache(1 << 16)(self._lost)

    def _near(self, v: str) -> dict[str, float]:
        """The list's words that v may stand for; a word of the list stands for itself alone."""
        if v in self.weight:
            return {v: 1.0}
        return {} if v.isdigit() else self.words.near(v)

    def mentioned(self, w: list[str]) -> int:
        """The entry with the longest mention, 0 for none; it wins over all that overlap it."""
        text = " ".join(["", *w, ""])
        if not len(self.automaton) or len(text) < 3:
            return 0
        spans = ((-size, end + 1 - n, ref) for end, (n, ref, size) in self.automaton.iter(text))
        return min(spans, default=(0, 0, 0))[2]

    def joins(self, v: tuple[str, ...]) -> list[tuple[float, tuple[int, ...], tuple[str, ...]]]:
        """Words of a value that stand for more or fewer words: two typed apart for one, one typed together for two."""
        out = []
        # a half alike at 0.85 is no longer than a word of the list and an ending or edit
        longest = 2 * (self.words.longest + LONGEST_ENDING)
        for i, t in enumerate(v):
            if i + 1 < len(v):
                out += [(s, (i, i + 1), (x,)) for x, s in self.near(t + v[i + 1]).items() if s >= 0.8 and len(x) > 5]
            if t not in self.weight and 5 < len(t) <= longest:
                for k in range(3, len(t) - 2):
                    for x, p in self.near(t[:k]).items():
                        if p >= 0.85:
                            out += [(0.95 * min(p, q), (i,), (x, y)) for y, q in self.near(t[k:]).items() if q >= 0.85 and y != x]
        return out

    def reached(self, v: tuple[str, ...], joins: list) -> list[tuple[float, int]]:
        """(bound, name) of the names that share anything with a value, the greatest bound first. No score is above
        its bound: each word gains at most its best likeness in the name, and is lost where the name has none."""
        shares: list[tuple[np.ndarray, np.ndarray, float]] = []  # names, gains there, loss elsewhere
        for i, t in enumerate(v):
            parts = [(self.in_names[x], np.full(len(self.in_names[x]), s * self.weight[x])) for x, s in self.near(t).items()]
            for s, at, names in joins:
                if i in at:
                    parts += [(self.in_names[x], np.full(len(self.in_names[x]), s * sum(self.weight[y] for y in set(names)))) for x in names]
            if len(t) > 1 and t not in self.weight:
                at = min((self.initials.get(t[k : k + 2], NOTHING) for k in range(len(t) - 1)), key=len)
                at = np.array([k for k in at if t in "".join(x[0] for x in self.names[k][1])], dtype=int)
                parts.append((at, 0.9 * self.total[at]))
            if parts:
                at, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                gain = np.zeros(len(at))
                np.maximum.at(gain, where, np.concatenate([p[1] for p in parts]))
                shares.append((at, gain, self._lost(t)))
        if not shares:
            return []
        at, where = np.unique(np.concatenate([x[0] for x in shares]), return_inverse=True)
        gained = np.bincount(where, np.concatenate([x[1] for x in shares]))
        kept = np.bincount(where, np.concatenate([np.full(len(x[0]), x[2]) for x in shares]))
        lost = np.maximum(sum(self._lost(t) for t in v) - kept, 0.0)
        bound = np.minimum(gained, self.total[at]) / (self.total[at] + lost) + 1e-9
        order = np.lexsort((at, -bound))
        return list(zip(bound[order].tolist(), at[order].tolist()))

    def _lost(self, t: str) -> float:
        """What a word of the value that a name has no use for counts against the name."""
        return 0.8 * max((self.weight[x] for x, s in self.near(t).items() if s > 0.75), default=self.unknown)

    def score(self, v: tuple[str, ...], c: tuple[str, ...], joins: list) -> tuple[float, float, bool]:
        """Soft token-set similarity of value and name, the share of the name that is covered, and whether every word
        of the value is used."""
        open_c = dict.fromkeys(c)
        found = [(s, (i,), (x,)) for i, t in enumerate(v) for x, s in self.near(t).items() if x in open_c]
        found += [j for j in joins if all(x in open_c for x in j[2])]
        for i, t in enumerate(v):  # initials
            if 1 < len(t) <= len(c) and t not in self.weight:
                found += [(0.9, (i,), c[a : a + len(t)]) for a in range(len(c) - len(t) + 1) if t == "".join(x[0] for x in c[a : a + len(t)])]
        gained, used = 0.0, set()
        for s, at, names in sorted(found, key=lambda f: (-f[0] * len(f[1]) ** 0.1, f[1], f[2])):
            if not used & set(at) and all(x in open_c for x in names):
                used |= set(at)
                once = dict.fromkeys(names)  # a name may repeat a word
                gained += s * sum(self.weight[x] for x in once)
                for x in once:
                    del open_c[x]
        total = sum(self.weight[x] for x in dict.fromkeys(c))
        spent = sum(self._lost(t) for i, t in enumerate(v) if i not in used)
        return gained / (total + spent), gained / total, len(used) == len(v)

    def find(self, value: str) -> tuple[int, str, float]:
        """(reference or 0, how, score) of a value."""
        raw = words(value)
        if (ref := self.exact.get("".join(raw))) is not None:
            return ref, "name", 1.0
        v = [w for w in raw if w not in NOISE and not (w.isdigit() and w not in self.numbers)] or raw
        if (ref := self.exact.get("".join(v))) is not None:
            return ref, "name", 1.0
        if ref := self.mentioned(v):
            return ref, "mention", 1.0
        v = [y for w in v for y in SYNONYMS.get(w, w).split()]
        v = tuple(v)
        joins = self.joins(v)
        stated = {w for w in v if w in self.numbers}
        best: dict[int, tuple[float, float, bool]] = {}
        first, top, second = 0, 0.0, 0.0  # the best entry and its score, the best score of another
        left: list[int] = []  # names that can not be among the two best
        for bound, i in self.reached(v, joins):
            ref, c = self.names[i]
            if stated and self.numbered[i] and not stated <= set(c):
                continue
            if bound < second:
                left.append(i)
                continue
            best[ref] = max(best.get(ref, (0.0, 0.0, False)), self.score(v, c, joins))
            likely = best[ref][0]
            if ref == first or likely > top:
                first, top, second = ref, likely, second if ref == first else top
            else:
                second = max(second, likely)
        order = sorted(best.items(), key=lambda x: (-x[1][0], x[0]))
        if not order:
            return 0, "none", 0.0
        ref, (likely, covered, used) = order[0]
        second = order[1][1][0] if len(order) > 1 else 0.0
        clear = likely - second >= MARGIN
        if clear and (likely >= ACCEPT or covered >= NAMED or (covered >= PARTLY[0] and likely >= PARTLY[1])):
            return ref, "similar", likely
        # every word is one of the list's, and no other entry has them all
        if clear and used and likely >= 0.25 and all(max(self.near(w).values(), default=0) > 0.7 for w in v):
            for i in left:
                r, c = self.names[i]
                best[r] = max(best.get(r, (0.0, 0.0, False)), self.score(v, c, joins))
            if sum(x[2] for x in best.values()) == 1:
                return ref, "similar", likely
        return 0, "none", likely


def _entries(reference: DataFrame, most: int) -> dict[str, list[tuple[int, list[str]]]]:
    """The list by field, on the driver, its size checked."""
    rows = reference.where("field_name is not null and canonical_value is not null").select("ref_id", "field_name", "canonical_value", "known_aliases").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the reference list has more than {most} entries; map it field by field")
    fields: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: r.ref_id):
        fields.setdefault(r.field_name, []).append((r.ref_id, [r.canonical_value, *[a for a in r.known_aliases or [] if a]]))
    return fields


def mapped(df: DataFrame, reference: DataFrame, id_col: str, fields: list[str], most_entries: int = MOST_ENTRIES) -> DataFrame:
    """(id, field_name, value, ref_id, how, score): one row for each informative value not spelled exactly like a
    canonical name of its field. The list, its size checked, is sent to the workers; rows are never shuffled."""
    shared = df.sparkSession.sparkContext.broadcast(_entries(reference, most_entries))
    cells = F.array(*[F.struct(F.lit(f).alias("field_name"), F.when(~is_blank(F.col(f)), F.col(f)).alias("value")) for f in fields])
    d = df.select(F.col(id_col).alias("id"), F.explode(cells).alias("c")).select("id", "c.*").where("value is not null")

    @F.pandas_udf("ref_id bigint, how string, score double")
    def find(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        ready = {f: Matcher(e) for f, e in shared.value.items()}

        @lru_cache(1 << 16)
        def answer(field: str, value: str):
            if field not in ready:
                return 0, "none", 0.0
            return (0, "canonical", 1.0) if value in ready[field].canonical else ready[field].find(value)

        for field, value in batches:
            yield pd.DataFrame([answer(f, v) for f, v in zip(field, value)], columns=["ref_id", "how", "score"])

    return d.withColumn("m", find("field_name", "value")).select("id", "field_name", "value", "m.*").where("how <> 'canonical'")
