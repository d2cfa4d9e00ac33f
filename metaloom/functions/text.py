"""Text as columns: trimming, folding, short names, language maps."""

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from metaloom.constants import LANGUAGES
from metaloom.functions.literals import literal_map
from metaloom.functions.uris import as_column

BEYOND_ASCII, ASCII_RUNS = "[^\\x00-\\x7f]", "[\\x00-\\x7f]+"
_EDGE = "[\\s\\x1c-\\x1f]+"
# No character from here on has a special caseless form, or has a compatibility form or combines,
# but for ideographs, which hold nothing ASCII.
CASED_BELOW, MARKED_BELOW = 0x1F000, 0x1FBFF


def strip(text) -> Column:
    """Text without white space at either end, Unicode spaces included."""
    return F.regexp_replace(text, f"(?U)^{_EDGE}|{_EDGE}$", "")


def let(value, body) -> Column:
    """`body` of a value that is computed once, however often `body` names it."""
    return F.transform(F.array(value), body)[0]


@cache
def _foldings():
    """(one-to-one, one-to-many) characters whose caseless form is not their lower case, made
    from the Unicode database."""
    single, several = {}, {}
    for char in map(chr, range(0x80, CASED_BELOW)):
        folded = char.casefold()
        if folded != char.lower():
            (single if len(folded) == 1 else several)[char] = folded
    return single, several


def _unfolded(text, several) -> Column:
    """Characters that stand for several, spelled out. Only what is beyond ASCII is searched for them, one
    lookup a character; a class of hundreds of characters would be tried in turn on every character."""
    def spelled(others):
        held = F.array_intersect(F.split(others, ""), F.lit(list(several)))
        spelling = literal_map(several)
        return F.when(F.translate(others, "".join(several), "") == others, text).otherwise(
            F.aggregate(held, text, lambda done, c: F.replace(done, c, F.try_element_at(spelling, c))))

    return let(F.regexp_replace(text, ASCII_RUNS, ""), spelled)


def casefold(text) -> Column:
    """Caseless form: lower case, with sharp s, ligatures and the final sigma folded too."""
    text = as_column(text)
    single, several = _foldings()
    folded = F.translate(F.lower(text), "".join(single), "".join(single.values()))
    return (F.when(~text.rlike(BEYOND_ASCII), F.lower(text))
            .otherwise(let(folded, lambda f: _unfolded(f, several))))


def fold_keyword(text) -> Column:
    """What two spellings of one keyword have in common."""
    return casefold(strip(text))


@cache
def _decompositions():
    """(one-to-one, one-to-many, combining) characters under compatibility decomposition.

    Made from the Unicode database. Only decompositions with an ASCII part matter for a short
    name: everything else is a separator with or without its accents.
    """
    single, several, combining = {}, {}, []
    for char in map(chr, range(0x80, MARKED_BELOW)):
        if not unicodedata.decomposition(char) and not unicodedata.combining(char):
            continue  # stands for itself
        if unicodedata.combining(char):
            combining.append(char)
            continue
        parts = "".join(c for c in unicodedata.normalize("NFKD", char)
                        if not unicodedata.combining(c))
        if not parts:  # marks alone
            combining.append(char)
        elif parts != char and any(c.isascii() for c in parts):
            (single if len(parts) == 1 else several)[char] = parts
    return single, several, combining


def strip_accents(text) -> Column:
    """Text with accents and other combining marks removed, compatibility forms unfolded.

    ASCII text is left alone, and most other text is ASCII after one pass of single-character
    replacements: the branches of a `when` are evaluated only where it holds. Characters that
    unfold to several are looked for only in what is left.
    """
    text = F.coalesce(as_column(text), F.lit(""))
    single, several, combining = _decompositions()

    def rest(bare):
        return F.when(~bare.rlike(BEYOND_ASCII), bare).otherwise(_unfolded(bare, several))

    bare = F.translate(text, "".join([*single, *combining]), "".join(single.values()))
    return F.when(~text.rlike(BEYOND_ASCII), text).otherwise(let(bare, rest))


def slugify(text) -> Column:
    """A short lower-case name: no accents, no parentheticals, words joined by `_`."""
    plain = F.regexp_replace(F.lower(strip_accents(text)), "\\([^)]*\\)", " ")
    return F.btrim(F.array_join(F.split(plain, "[^a-z0-9]+"), "_"), F.lit("_"))


def nullif_empty(text) -> Column:
    return F.when(text != "", text)


def fold_language(tag) -> Column:
    """The one of two keys a language tag belongs under: English, or everything else."""
    return (F.when(F.lower(F.split(tag, "-")[0]) == "en", F.lit("en"))
            .otherwise(F.lit("sv")))


def localized_text(texts, language="sv") -> Column:
    """One string out of a language map: the asked language, the other one, then any."""
    other = LANGUAGES[1] if language == LANGUAGES[0] else LANGUAGES[0]
    return F.coalesce(
        nullif_empty(F.try_element_at(texts, F.lit(language))),
        nullif_empty(F.try_element_at(texts, F.lit(other))),
        F.try_element_at(F.filter(F.map_values(texts), lambda v: v != ""), F.lit(1)))


def keywords_in(words, language="sv") -> Column:
    """Keywords of the asked language, or the other's where it has none."""
    other = LANGUAGES[1] if language == LANGUAGES[0] else LANGUAGES[0]

    def held(tag):
        found = F.try_element_at(words, F.lit(tag))
        return F.when(F.size(found) > 0, found)

    return F.coalesce(held(language), held(other), F.array().cast("array<string>"))


def keyword_values(words) -> Column:
    """Every keyword as written, both languages, repeats and blanks included."""
    return F.flatten(F.map_values(F.coalesce(words, F.create_map().cast("map<string,array<string>>"))))


def all_keywords(words) -> Column:
    """Every keyword in either language, each once, in order."""
    return F.array_distinct(keyword_values(words))
