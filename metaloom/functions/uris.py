"""URIs as columns: parts, spellings, CURIEs, language codes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from metaloom.constants import ISO_639_1, LANGUAGE_PREFIXES, NAMESPACES
from metaloom.functions.literals import literal_map

HOST_PATTERN = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"
PATH_PATTERN = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def host_of(url) -> Column:
    """Host name in lower case; empty where the address has none."""
    return F.lower(F.regexp_extract(url, HOST_PATTERN, 1))


def path_of(url) -> Column:
    """Path without query, fragment and the parameters of its last segment."""
    return F.regexp_replace(F.regexp_extract(url, PATH_PATTERN, 1), ";[^/]*$", "")


def scheme_of(url) -> Column:
    return F.lower(F.regexp_extract(url, "^([a-zA-Z][a-zA-Z0-9+.-]*):", 1))


def first_url(value, is_array=False) -> Column:
    """The first non-empty address of a field that holds one or several."""
    value = as_column(value)
    if not is_array:
        return F.when(value != "", value)
    return F.try_element_at(F.filter(value, lambda v: v.isNotNull() & (v != "")), F.lit(1))


def _base_form(uri) -> Column:
    """The URI without its fragment and, for a Creative Commons address, without the page name
    of a deed or legal code."""
    base = F.regexp_replace(uri, "#.*$", "")
    return F.when(
        F.contains(base, F.lit("creativecommons.org")),
        F.regexp_replace(base, "/(?:deed|legalcode)(?:\\.[A-Za-z-]+)?/?$", "/")).otherwise(base)


def _twin(uri) -> Column:
    """The same address under the other of http and https; null for anything else."""
    return (F.when(F.startswith(uri, F.lit("https://")),
                   F.concat(F.lit("http://"), F.substring(uri, 9, 1 << 30)))
            .when(F.startswith(uri, F.lit("http://")),
                  F.concat(F.lit("https://"), F.substring(uri, 8, 1 << 30))))


def uri_spellings(uri) -> Column:
    """The spellings one vocabulary URI turns up as, most exact first, each once."""
    uri = as_column(uri)
    base = _base_form(uri)
    bare = F.regexp_replace(base, "/+$", "")
    slashed = F.concat(bare, F.lit("/"))
    forms = F.array(uri, base, _twin(base), bare, _twin(bare), slashed, _twin(slashed))
    return F.array_distinct(F.filter(forms, lambda f: f.isNotNull() & (f != "")))


def is_plain_spelling(uri) -> Column:
    """Whether the URI has no fragment and no page suffix: a form other spellings can lead to."""
    return _base_form(as_column(uri)) == as_column(uri)


def spelling_key(uri) -> Column:
    """What all spellings of a URI share: an equality that makes looking them up an equi-join."""
    base = F.regexp_replace(_base_form(as_column(uri)), "/+$", "")
    return F.regexp_replace(base, "^https?://", "")


def last_segment(uri) -> Column:
    tail = F.regexp_extract(F.regexp_replace(uri, "/+$", ""), "([^/]*)$", 1)
    return F.regexp_extract(tail, "([^#]*)$", 1)


def language_code(uri) -> Column:
    """ISO code of a language URI, two letters where there are two; null for other URIs."""
    uri = as_column(uri)
    known = F.lit(False)
    for prefix in LANGUAGE_PREFIXES:
        known = known | F.startswith(uri, F.lit(prefix))
    tail = F.lower(F.regexp_extract(F.regexp_replace(uri, "/+$", ""), "([^/]*)$", 1))
    shorter = literal_map(ISO_639_1)
    return F.when(known & tail.rlike("(?U)^\\p{L}+$"),
                  F.when(F.length(tail) == 2, tail)
                  .otherwise(F.coalesce(F.try_element_at(shorter, tail), tail)))


def expand_curie(term) -> Column:
    """`prefix:local` as a full URI; anything else as it is."""
    term = as_column(term)
    namespaces = literal_map(NAMESPACES)
    prefix = F.substring_index(term, ":", 1)
    namespace = F.try_element_at(namespaces, prefix)
    local = F.substring(term, F.length(prefix) + 2, F.lit(1 << 30))
    return (F.when(F.contains(term, F.lit("://")) | ~F.contains(term, F.lit(":")), term)
            .otherwise(F.coalesce(F.concat(namespace, local), term)))


def shorten_uri(uri) -> Column:
    """`prefix:local` under the longest known namespace, the first registered among equals."""
    uri = as_column(uri)
    first_prefix = {}
    for prefix, namespace in NAMESPACES.items():
        first_prefix.setdefault(namespace, prefix)
    short = None
    for namespace, prefix in sorted(first_prefix.items(), key=lambda item: -len(item[0])):
        hit = F.startswith(uri, F.lit(namespace))
        value = F.concat(F.lit(prefix + ":"), F.substring(uri, len(namespace) + 1, 1 << 30))
        short = F.when(hit, value) if short is None else short.when(hit, value)
    return short.otherwise(uri)
