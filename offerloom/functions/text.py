"""Names, brands, categories and codes of products as Spark expressions.

Names mix Turkish and English, and the rules are written for a regex dialect with
ASCII word boundaries, case folding that never mixes dotted and dotless i, and
white space that includes Unicode's. ``pattern`` and ``folded`` carry that over;
no other module writes such patterns itself. All functions are Column -> Column
and stay in the JVM. Null is the empty string throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerloom.functions import dictionaries as d

#: White space of the rules, and an ASCII word boundary.
SPACE = r"\s\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"
BOUNDARY = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"
#: The same, one by one.
SPACE_CHARS = " \t\n\x0b\f\r\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
NAME_CHARS = "a-z0-9" + SPACE + "ğüşıöçâîû"
SIZE = r"\b\d+\s*(?:ml|gr|g|oz|adet|piece)s?\b"
CODE = r"\b([a-z]{0,2}\d{1,3}[a-z]{0,2})\b"


def pattern(rule: str) -> str:
    r"""A rule's pattern for Java: \b is an ASCII boundary and \s all white space."""
    out, in_class, i = [], False, 0
    while i < len(rule):
        two = rule[i : i + 2]
        if two == r"\b" and not in_class:
            out.append(BOUNDARY)
        elif two == r"\s":
            out.append(SPACE if in_class else f"[{SPACE}]")
        elif rule[i] == "\\":
            out.append(two)
        else:
            in_class = rule[i] == "[" or in_class and rule[i] != "]"
            out.append(rule[i])
            i += 1
            continue
        i += 2
    return "".join(out)


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def folded(c: Column) -> Column:
    """Lower case for rules that ignore case: letters keep their dots and accents."""
    return F.lower(F.translate(text(c), "ŞĞÜÖÇÂÎÛÉ", "şğüöçâîûé"))


def matches(c: Column, rule: str) -> Column:
    """Whether a rule that ignores case is found."""
    return folded(c).rlike(pattern(rule))


def erase(c: Column, rule: str, by: str = "") -> Column:
    return F.regexp_replace(c, pattern(rule), by)


def strip(c: Column) -> Column:
    return F.btrim(text(c), F.lit(SPACE_CHARS))


def squeezed(c: Column) -> Column:
    return strip(F.regexp_replace(text(c), f"[{SPACE}]+", " "))


def let(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.element_at(F.transform(F.array(c), f), 1)


def lookup(c: Column, table: Mapping[str, str], otherwise: Column | None = None) -> Column:
    """The entry of a small fixed table, else ``otherwise`` (the key itself)."""
    entries = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    if otherwise is None:
        return let(c, lambda x: F.coalesce(F.element_at(entries, x), x))
    return F.coalesce(F.element_at(entries, c), otherwise)


def first_contained(c: Column, choices: Iterable[tuple[str, str]], otherwise: Column) -> Column:
    """The value of the first (part, value) whose part is in the text."""
    listed = list(choices)

    def chain(x: Column) -> Column:
        out = F.when(x.contains(listed[0][0]), listed[0][1])
        for part, value in listed[1:]:
            out = out.when(x.contains(part), value)
        return out

    return F.coalesce(let(c, chain), otherwise)


def alternatives(words: Iterable[str]) -> str:
    return "(?:" + "|".join(words) + ")"


def without_brand(lowered: Column, brand: Column) -> Column:
    return let(lowered, lambda x: F.when(F.length(text(brand)) > 0, F.replace(x, F.lower(text(brand)), F.lit(""))).otherwise(x))


# brands ---------------------------------------------------------------------


def brand_key(brand: Column) -> Column:
    """Upper case in ASCII letters, digits, ``&`` and ``.``; aliases resolved. Letters without an ASCII base go."""
    upper = F.translate(F.upper(text(brand)), "ÉÈÊËÀÂÄÙÛÜÎÏÔÖ'’´`‘", "EEEEAAAUUUIIOO")
    return lookup(squeezed(F.regexp_replace(upper, f"[^A-Z0-9{SPACE}&.]", "")), d.BRAND_ALIASES)


def brand_shown(brand: Column) -> Column:
    """The name that a brand is shown by; blank is empty, unknown brands stay."""
    return F.when(F.length(strip(brand)) == 0, "").otherwise(lookup(brand_key(brand), d.BRAND_DISPLAY, text(brand)))


def plain_quotes(c: Column) -> Column:
    return F.translate(text(c), "‘’ʼʻ“”", "''''\"\"")


def brand_in_name(name: Column, brands: Iterable[str] = d.KNOWN_BRANDS) -> Column:
    """The longest known brand that the name contains anywhere, as listed; else empty."""
    ordered = sorted(brands, key=len, reverse=True)
    lowered = F.lower(plain_quotes(name))
    plain = str.maketrans("‘’ʼʻ“”", "''''\"\"")
    return first_contained(lowered, ((b.translate(plain).lower(), b) for b in ordered), F.lit(""))


def name_without(name: Column, brand: Column) -> Column:
    """The name without the brand's first occurrence and the separators that it leaves in front."""
    plain, needle = plain_quotes(name), plain_quotes(brand)
    at = F.position(F.lower(needle), F.lower(plain))
    cut = F.concat(F.substring(plain, F.lit(1), at - 1), F.substring(plain, at + F.length(needle), F.length(plain)))
    rest = strip(F.regexp_replace(strip(cut), f"^[-–,{SPACE}]+", ""))
    return F.when((F.length(needle) > 0) & (at > 0), rest).otherwise(text(name))


def brand_of_line(name: Column) -> Column:
    return first_contained(F.lower(text(name)), d.LINE_TO_BRAND.items(), F.lit(""))


def brand_prefix(name: Column, brands: Iterable[str] = d.KNOWN_BRANDS) -> Column:
    """The longest known brand that the name starts with, else empty."""
    lowered, chain = F.lower(text(name)), None
    for b in sorted(brands, key=len, reverse=True):
        hit = lowered.startswith(b.lower())
        chain = F.when(hit, b) if chain is None else chain.when(hit, b)
    return chain.otherwise("")


def without_prefix(name: Column, brand: Column) -> Column:
    starts = F.lower(text(name)).startswith(F.lower(text(brand))) & (F.length(text(brand)) > 0)
    return F.when(starts, strip(F.substring(text(name), F.length(brand) + 1, F.length(name)))).otherwise(text(name))


# categories -----------------------------------------------------------------


def category_label(label: Column) -> Column:
    return lookup(label, d.CATEGORY_LABELS)


def category_name(category: Column) -> Column:
    return lookup(category, d.CATEGORY_NAMES)


def category_by_name(name: Column, category: Column) -> Column:
    """The category of the first rule with a part in the name, else ``category``."""
    return first_contained(F.lower(text(name)), ((k, c) for c, keys in d.CATEGORY_RULES for k in keys), category)


def compatible(a: Column, b: Column) -> Column:
    """Equal, or one of the pairs that stand for each other; not transitive."""
    pairs = [F.concat_ws("|", F.array(*map(F.lit, sorted(p)))) for p in d.COMPATIBLE_CATEGORIES]
    return a.eqNullSafe(b) | F.concat_ws("|", F.least(a, b), F.greatest(a, b)).isin(*pairs)


# names ----------------------------------------------------------------------


def words(c: Column, longer_than: int = 1) -> Column:
    return F.filter(F.split(c, " "), lambda w: F.length(w) > longer_than)


def synonyms(tokens: Column) -> Column:
    return F.transform(tokens, lambda w: lookup(w, d.SYNONYMS))


def with_compounds(c: Column) -> Column:
    for rule, word in d.COMPOUNDS:
        c = erase(c, rule, word)
    return c


def match_name(name: Column, brand: Column) -> Column:
    """A name for comparison: no brand, units or long numbers, synonyms in one language."""
    c = with_compounds(without_brand(strip(F.regexp_replace(F.lower(text(name)), r"^\*+", "")), brand))
    c = F.regexp_replace(c, f"[^{NAME_CHARS}]", "")
    c = squeezed(erase(erase(c, r"\b(?:adet|ml|gr|spf|no|numara)\b"), r"\b\d{4,}"))
    return F.array_join(synonyms(F.split(c, " ")), " ")


#: What isn't part of a name's core, in the order in which it goes.
CORE_ERASURES = (
    r"[-–]\s*\d{1,3}\s+[a-z].*$",
    r"\b\d{2,3}\s+" + alternatives(d.NUMBERED_COLOURS) + r"\b.*",
    r"\bno[:\s]*\d+",
    SIZE,
    r"\badet\b",
    r"\b\d{6,}",
    r"\b" + alternatives(d.CORE_COLOURS) + r"\b",
    r"\b" + alternatives(d.CORE_TONES) + r"\b",
    r"\b[0-9]{1,3}\s*$",
    r"\b\d{1,3}\b",
)


def core_name(name: Column, brand: Column) -> Column:
    """What is common to all shades and sizes of a product: eight words at most."""
    c = with_compounds(without_brand(F.lower(text(name)), brand))
    for rule in CORE_ERASURES:
        c = erase(c, rule)
    c = squeezed(F.regexp_replace(c, f"[^{NAME_CHARS}]", ""))
    return F.array_join(F.slice(words(F.array_join(synonyms(F.split(c, " ")), " ")), 1, 8), " ")


#: What is no part of a product line, in the order in which it goes.
LINE_ERASURES = (
    r"\b\d{6,}",
    r"\bno[:\s]*\d+",
    r"\b\d+\s*(?:ml|gr|g|oz|adet)\b",
    r"[-–]\s*\d{1,3}\s+\w+.*$",
    r"\b" + alternatives(d.LINE_COLOURS) + r"\b",
    r"\b[0-9]{1,3}\s*$",
)


def product_line(name: Column, brand: Column) -> Column:
    """The first known product line in the name, else empty."""
    c = without_brand(F.lower(text(name)), brand)
    for rule in LINE_ERASURES:
        c = erase(c, rule)
    c = squeezed(F.regexp_replace(c, f"[^{NAME_CHARS}]", " "))
    return first_contained(c, ((x, x) for x in d.PRODUCT_LINES), F.lit(""))


def _codes(lowered: Column) -> Column:
    found = F.regexp_extract_all(lowered, F.lit(pattern(CODE)), F.lit(1))
    return F.transform(F.filter(found, lambda x: F.length(x) <= 5), F.upper)


def shade_codes(name: Column, brand: Column) -> Column:
    """Codes such as 01, N10 and 125C, in order of appearance; sun protection and sizes are none."""
    c = without_brand(F.lower(text(name)), brand)
    return _codes(erase(erase(c, r"\bspf\s*\d+"), r"\b\d+\s*(?:ml|gr|g|oz)s?\b"))


def sizes(name: Column) -> Column:
    """Distinct sizes such as 15ML, sorted."""
    found = F.regexp_extract_all(F.lower(text(name)), F.lit(pattern(r"\b\d+(?:[.,]\d+)?\s*(?:ml|gr|g|oz|lt|cl)s?\b")), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda s: F.upper(F.regexp_replace(s, f"[{SPACE}]+", "")))))


def variant_size(name: Column) -> Column:
    return F.array_join(sizes(name), "-")


def variant_shade(name: Column) -> Column:
    """Distinct codes and colours of the name, sorted and joined; digits of sizes count as codes."""
    lowered = F.lower(text(name))
    colours = F.filter(F.split(lowered, f"[{SPACE},.-]+"), lambda w: w.isin(*d.COLOUR_CODES))
    return F.array_join(F.array_sort(F.array_distinct(F.concat(_codes(lowered), F.transform(colours, F.upper)))), "-")


def shown_name(name: Column, brand: Column, longest: int = 80) -> Column:
    """A name for display: without the brand, cut to ``longest`` characters. The brand is taken literally."""
    c = F.regexp_replace(text(name), f"[{SPACE}]+", " ")
    quoted = F.concat(F.lit("(?iu)\\Q"), F.replace(text(brand), F.lit("\\E"), F.lit("")), F.lit("\\E"))
    c = F.when(F.length(text(brand)) > 0, F.regexp_replace(c, quoted, F.lit(""))).otherwise(c)
    return strip(F.substring(strip(c), 1, longest))


def common_prefix_cut(raw: Column, brand: Column, product: Column) -> Column:
    """A shade's own name: without the brand in front and the words that it shares with the start of the product's name."""
    lead = f"^[{SPACE}\\-–:,/|]+"
    own = strip(F.regexp_replace(without_prefix(strip(raw), brand), lead, ""))
    a, b = F.split(own, f"[{SPACE}]+"), F.split(strip(F.regexp_replace(without_prefix(strip(product), brand), lead, "")), f"[{SPACE}]+")
    same = F.zip_with(F.slice(a, 1, F.least(F.size(a), F.size(b))), F.slice(b, 1, F.least(F.size(a), F.size(b))), lambda x, y: F.lower(x) == F.lower(y))
    first_other = F.array_position(same, F.lit(False))
    shared = F.when(first_other > 0, first_other - 1).otherwise(F.size(same)).cast("int")
    rest = strip(F.regexp_replace(F.array_join(F.slice(a, shared + 1, F.size(a)), " "), lead, ""))
    return F.when(F.length(rest) > 0, rest).otherwise(text(raw))


# similarity -----------------------------------------------------------------


def significant(core: Column) -> Column:
    """Words of a core that tell products apart, by their synonyms."""
    return F.filter(synonyms(words(core)), lambda w: ~w.isin(*d.GENERIC_WORDS))


def _compared(core: Column) -> Column:
    kept = F.filter(words(core), lambda w: ~lookup(w, d.SYNONYMS).isin(*d.GENERIC_WORDS))
    return F.when(F.size(kept) > 0, kept).otherwise(words(core))


def bigrams(tokens: Column) -> Column:
    """Neighbouring words, unless both are generic; repeats stay."""
    n = F.size(tokens)
    pairs = F.zip_with(F.slice(tokens, 1, F.greatest(n - 1, F.lit(0))), F.slice(tokens, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    kept = F.filter(pairs, lambda p: ~(p["a"].isin(*d.GENERIC_WORDS) & p["b"].isin(*d.GENERIC_WORDS)))
    return F.transform(kept, lambda p: F.concat(p["a"], F.lit(" "), p["b"]))


def similarity_parts(core: Column) -> tuple[Column, Column]:
    """(distinct words, bigrams) of a core, once a row, for ``similarity_of``."""
    kept = _compared(core)
    return F.array_distinct(synonyms(kept)), bigrams(words(F.array_join(kept, " ")))


def similarity_of(words_a: Column, bigrams_a: Column, words_b: Column, bigrams_b: Column) -> Column:
    """In [0, 1]: the smaller coverage of distinct words, or of bigrams if that is higher; 0 without words.

    The Jaccard similarity of the words never exceeds their smaller coverage, so it needs no term.
    """
    cover = F.size(F.array_intersect(words_a, words_b)) / F.greatest(F.size(words_a), F.size(words_b), F.lit(1))
    common = F.size(F.filter(bigrams_a, lambda x: F.array_contains(bigrams_b, x)))
    pairs = F.when((F.size(bigrams_a) > 0) & (F.size(bigrams_b) > 0), common / F.greatest(F.size(bigrams_a), F.size(bigrams_b))).otherwise(0.0)
    return F.when((F.size(words_a) == 0) | (F.size(words_b) == 0), 0.0).otherwise(F.greatest(cover, pairs))


def similarity(a: Column, b: Column) -> Column:
    """``similarity_of`` two cores."""
    return similarity_of(*similarity_parts(a), *similarity_parts(b))


def word_set(name: Column) -> Column:
    """Distinct words of a raw name with three characters or more."""
    kept = F.regexp_replace(F.lower(text(name)), f"[^a-zçğıöşü0-9{SPACE}]", "")
    return F.array_distinct(F.filter(F.split(kept, f"[{SPACE}]+"), lambda w: F.length(w) > 2))


def is_travel_size(name: Column) -> Column:
    return matches(name, r"\b(?:seyahat|travel|mini|minyat[uü]r|sample|deneme)\b")


def is_waterproof(name: Column) -> Column:
    return matches(name, r"\b(?:waterproof|su\s*ge[cç]irmez)\b")


def reliable_barcode(code: Column) -> Column:
    """Digits only, of a public format's length, and not in the ranges that sellers number themselves in."""
    own = (F.length(code) == 8) & code.startswith("30") | (F.length(code) == 13) & code.startswith("205")
    return F.coalesce(code.rlike("^[0-9]+$") & F.length(code).isin(8, 12, 13) & ~own, F.lit(False))


def skin_types(category: Column) -> Column:
    entries = F.create_map(*(x for k, v in d.SKIN_TYPES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    return F.coalesce(F.element_at(entries, category), F.array(F.lit("normal")))


