"""Pieces of DuckDB SQL that the queries' checks share."""

from __future__ import annotations

from fluelake.functions.blank import FILLER_WORDS


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^[\s\x{{00A0}}]+|[\s\x{{00A0}}]+$', '', 'g')"


def blank(c: str, words: list[str] = FILLER_WORDS) -> str:
    return f"coalesce(lower({strip(c)}) IN ({', '.join(map(quote, words))}), true)"


def first_match(pattern: str, c: str, group: int = 1, options: str = "") -> str:
    o = f", '{options}'" if options else ""
    return f"(CASE WHEN regexp_matches({c}, {quote(pattern)}{o}) THEN regexp_extract({c}, {quote(pattern)}, {group}{o}) END)"


def lookup(c: str, table: dict[str, str]) -> str:
    return f"(CASE {c} " + " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in table.items()) + " END)"


def plain_number(c: str) -> str:
    return rf"regexp_replace(regexp_replace(regexp_replace({c}, '^0+([0-9])', '\1'), '(\.[0-9]*?)0+$', '\1'), '\.$', '')"


def title_case(c: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all({c}, '[A-Za-z]+|[^A-Za-z]+'), lambda r: upper(r[1:1]) || lower(r[2:])), '')"


def company_name(c: str) -> str:
    from fluelake.functions.text import COMPANY_SUFFIXES

    t = f"regexp_replace(replace(upper(coalesce({c}, '')), '&', ' AND '), '[^A-Z0-9 ]', ' ', 'g')"
    return f"array_to_string(list_filter(string_split({t}, ' '), lambda w: w <> '' AND w NOT IN ({', '.join(map(quote, COMPANY_SUFFIXES))})), ' ')"


def unit_key(unit_id: str, description: str) -> str:
    return f"coalesce(nullif({strip(unit_id)}, ''), 'desc_' || substr(md5(coalesce({description}, '')), 1, 12))"


def keyword_case(c: str, rules: list[tuple[str, list[str]]], other: str | None) -> str:
    whens = " ".join(f"WHEN {' OR '.join(f'contains({c}, {quote(k)})' for k in words)} THEN {quote(name)}" for name, words in rules)
    return f"(CASE {whens} ELSE {quote(other) if other is not None else 'NULL'} END)"
