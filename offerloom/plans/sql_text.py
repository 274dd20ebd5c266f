"""DuckDB SQL of the text functions, for the oracles; inputs keep to ASCII white space."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from offerloom.functions import dictionaries as d
from offerloom.functions import text


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def erase(c: str, rule: str, by: str = "") -> str:
    return f"regexp_replace({c}, {lit(rule)}, {lit(by)}, 'g')"


def squeezed(c: str) -> str:
    return f"trim({erase(c, chr(92) + 's+', ' ')})"


def lookup(c: str, table: Mapping[str, str], otherwise: str | None = None) -> str:
    entries = ", ".join(f"{lit(k)}: {lit(v)}" for k, v in table.items())
    return f"coalesce(MAP {{{entries}}}[{c}], {otherwise or c})"


def first_contained(c: str, choices: Iterable[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({c}, {lit(p)}) THEN {lit(v)}" for p, v in choices) + f" ELSE {otherwise} END"


def without_brand(c: str, brand: str) -> str:
    return f"CASE WHEN {brand} <> '' THEN replace({c}, lower({brand}), '') ELSE {c} END"


def brand_key(brand: str) -> str:
    upper = f"translate(upper({brand}), 'ÉÈÊËÀÂÄÙÛÜÎÏÔÖ''’´`‘', 'EEEEAAAUUUIIOO')"
    return lookup(squeezed(erase(upper, r"[^A-Z0-9\s&.]")), d.BRAND_ALIASES)


def core_name(name: str, brand: str) -> str:
    c = without_brand(f"lower({name})", brand)
    for rule, word in d.COMPOUNDS:
        c = erase(c, rule, word)
    for rule in text.CORE_ERASURES:
        c = erase(c, rule)
    c = squeezed(erase(c, r"[^a-z0-9\sğüşıöçâîû]"))
    words = f"list_filter(list_transform(string_split({c}, ' '), lambda w: {lookup('w', d.SYNONYMS)}), lambda w: length(w) > 1)"
    return f"array_to_string(list_slice({words}, 1, 8), ' ')"


def product_line(name: str, brand: str) -> str:
    c = without_brand(f"lower({name})", brand)
    for rule in text.LINE_ERASURES:
        c = erase(c, rule)
    return first_contained(squeezed(erase(c, r"[^a-z0-9\sğüşıöçâîû]", " ")), ((x, x) for x in d.PRODUCT_LINES), "''")


def codes(c: str) -> str:
    return f"list_transform(list_filter(regexp_extract_all({c}, {lit(text.CODE)}, 1), lambda x: length(x) <= 5), lambda x: upper(x))"


def shade_codes(name: str, brand: str) -> str:
    return codes(erase(erase(without_brand(f"lower({name})", brand), r"\bspf\s*\d+"), r"\b\d+\s*(?:ml|gr|g|oz)s?\b"))


def sizes(name: str) -> str:
    found = rf"regexp_extract_all(lower({name}), '\b\d+(?:[.,]\d+)?\s*(?:ml|gr|g|oz|lt|cl)s?\b')"
    return rf"list_sort(list_distinct(list_transform({found}, lambda x: upper(regexp_replace(x, '\s+', '', 'g')))))"


def variant_shade(name: str) -> str:
    colours = ", ".join(map(lit, d.COLOUR_CODES))
    named = rf"list_transform(list_filter(regexp_split_to_array(lower({name}), '[\s,.-]+'), lambda w: w IN ({colours})), lambda w: upper(w))"
    return f"array_to_string(list_sort(list_distinct(list_concat({codes(f'lower({name})')}, {named}))), '-')"


def word_set(name: str) -> str:
    return rf"list_distinct(list_filter(regexp_split_to_array(regexp_replace(lower({name}), '[^a-zçğıöşü0-9\s]', '', 'g'), '\s+'), lambda w: length(w) > 2))"


def compatible(a: str, b: str) -> str:
    pairs = ", ".join(lit("|".join(sorted(p))) for p in d.COMPATIBLE_CATEGORIES)
    return f"({a} = {b} OR least({a}, {b}) || '|' || greatest({a}, {b}) IN ({pairs}))"


def tokens(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda w: length(w) > 1)"


def synonyms(words: str) -> str:
    return f"list_transform({words}, lambda w: {lookup('w', d.SYNONYMS)})"


GENERIC = ", ".join(map(lit, d.GENERIC_WORDS))


def compared(core: str) -> str:
    kept = f"list_filter({tokens(core)}, lambda w: {lookup('w', d.SYNONYMS)} NOT IN ({GENERIC}))"
    return f"CASE WHEN len({kept}) > 0 THEN {kept} ELSE {tokens(core)} END"


def bigrams(words: str) -> str:
    pairs = f"list_zip(list_slice({words}, 1, len({words}) - 1), list_slice({words}, 2, len({words})))"
    return f"list_transform(list_filter({pairs}, lambda p: NOT (p[1] IN ({GENERIC}) AND p[2] IN ({GENERIC}))), lambda p: p[1] || ' ' || p[2])"


def folded(c: str) -> str:
    return f"lower(translate({c}, 'ŞĞÜÖÇÂÎÛÉ', 'şğüöçâîûé'))"


def matches(c: str, rule: str) -> str:
    return f"regexp_matches({folded(c)}, {lit(rule)})"
