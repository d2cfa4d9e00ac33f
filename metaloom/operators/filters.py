"""Filters and predicates: columns that are true for the records that match.

Within one filter a list means any of its values; filters are joined with AND. A negation means
"does not match", also where the field is unset.
"""

import datetime
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaloom.constants import DATASET_FILTERS, KINDS
from metaloom.functions.text import (fold_keyword, keyword_values, slugify,
                                     strip)
from metaloom.functions.typed import second_stamp
from metaloom.functions.uris import as_column
from metaloom.operators.facets import values_of
from metaloom.operators.graph import NODES
from metaloom.operators.vocabulary import slug_aliases, term_slugs


class QueryError(ValueError):
    """A filter that cannot be answered: an empty value, an unknown name, an impossible date."""


def require_values(value, name):
    """What a filter asks for, as text. Nothing to ask for is an error: it would match everything."""
    if isinstance(value, (set, frozenset)):
        value = sorted(value, key=str)
    asked = ["" if v is None else str(v) for v in (value if isinstance(value, (list, tuple)) else (value,))]
    if not "".join(asked).strip():
        raise QueryError(f"filter {name!r} has nothing to look for")
    return asked


# --- composition -------------------------------------------------------------

EVERYTHING = None  # the neutral part


def holds(condition) -> Column:
    return F.coalesce(condition, F.lit(False))


def all_of(*conditions) -> Column:
    """AND of the parts; empty parts are neutral."""
    parts = [c for c in conditions if c is not None]
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def any_of(*conditions) -> Column:
    """OR of the parts; empty parts are neutral."""
    parts = [c for c in conditions if c is not None]
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(True)


def none_of(condition) -> Column:
    """Does not match, also where the field is unset."""
    return ~holds(condition)


def score(*weighted) -> Column:
    """Sum of the weights of the conditions that hold, to order by."""
    return reduce(lambda a, b: a + b, [
        F.when(holds(c), F.lit(float(w))).otherwise(F.lit(0.0)) for c, w in weighted])


# --- fields ------------------------------------------------------------------

def term(field, value) -> Column:
    return as_column(field) == F.lit(value)


def one_of(field, values):
    """Any of the values; no values is the neutral part."""
    values = list(values)
    return as_column(field).isin(values) if values else EVERYTHING


def within(field, start=None, end=None, kind="string") -> Column:
    """Inclusive range; a null bound is open, a bare date is widened. Bounds are compared as the
    column's `kind`, so the filter reaches the scan."""
    column = as_column(field)

    def bound(value):
        return F.lit(widen(value)).cast(kind)

    bounds = [column >= bound(start) if start is not None else None,
              column <= bound(end) if end is not None else None]
    return all_of(column.isNotNull(), *bounds)


def unset(field) -> Column:
    column = as_column(field)
    return column.isNull() | (column == "")


def overlaps(field, values) -> Column:
    """Any of a record's values is among those asked for."""
    return holds(F.arrays_overlap(as_column(field), F.array(*[F.lit(v) for v in values])))


def facet_filter(facet, values) -> Column:
    """A record matches where the values a facet reads out of it include one of these."""
    wanted = [F.lit(v) for v in values]
    if facet in ("publisher", "publisher_type", "access_rights", "accrual_periodicity",
                 "service_type"):
        field = {"publisher": "publisher.id", "publisher_type": "publisher.type"}.get(facet, facet)
        return holds(F.col(field).isin(list(values)))
    if facet in ("format", "kind"):
        return holds(F.exists("distributions", lambda d: d[facet].isin(list(values))))
    return holds(F.arrays_overlap(values_of(facet), F.array(*wanted)))


def access_rights_filter(values) -> Column:
    """`none` asks for records that set no access rights."""
    named = [v for v in values if v != "none"]
    parts = [one_of("access_rights", named)]
    if len(named) < len(values):
        parts.append(unset("access_rights"))
    return holds(any_of(*parts))


def keyword_filter(keys) -> Column:
    """Exact on the folded keyword. `keys` are folded already."""
    return holds(F.exists(keyword_values(F.col("keywords")),
                          lambda k: fold_keyword(k).isin(list(keys))))


def phrase_in(phrase, title="title", description="description", keywords="keywords") -> Column:
    """Case-insensitive substring of the title, the description or any keyword, in either
    language. The texts of a map are joined by a space, so a phrase may straddle languages."""
    needle = F.lower(F.lit(phrase))

    def in_map(field):
        return F.contains(F.lower(F.array_join(F.map_values(field), " ")), needle)

    in_words = F.exists(keyword_values(F.col(keywords)),
                        lambda k: (strip(k) != "") & F.contains(F.lower(k), needle))
    return holds(in_map(title)) | holds(in_map(description)) | holds(in_words)


def phrase_of_words(phrase, *texts) -> Column:
    """The phrase as whole words anywhere in the texts, whatever its case."""
    words = [re.escape(w) for w in phrase.split()]
    pattern = r"(?iU)(?<![\w])" + r"\W+".join(words) + r"(?![\w])"
    return holds(F.concat_ws("\n", *texts).rlike(pattern))


def format_either_way(values, uri="format_uri", literal="format_literal") -> Column:
    """A format stated as a URI or as a media type: each value is looked for where it belongs."""
    as_uri = [v for v in values if "://" in v]
    as_text = [v for v in values if "://" not in v]
    return holds(any_of(one_of(uri, as_uri), one_of(literal, as_text)))


def with_pair(entries: DataFrame, predicate, value, graph="metadata") -> DataFrame:
    """Entries that hold the exact predicate and object anywhere in their graph."""
    def held(node):
        return F.exists(F.coalesce(F.try_element_at(node, F.lit(predicate)), F.array().cast(NODES)), lambda o: o["value"] == value)

    return entries.filter(F.exists(F.map_values(graph), held))


# --- dates -------------------------------------------------------------------

# What may stand for a moment, and how it is read; a shorter form means its first second.
WIDTHS = {"%Y": 4, "%Y-%m": 7, "%Y-%m-%d": 10}


def widen(value) -> str:
    """A date bound as a full stamp. Text of another form is left as it is."""
    if hasattr(value, "isoformat"):
        moment = value if isinstance(value, datetime.datetime) else datetime.datetime(value.year, value.month, value.day)
        return (moment if moment.tzinfo is None else moment.astimezone(datetime.timezone.utc)).isoformat()[:19]
    written = str(value).strip()
    for form in WIDTHS:
        # strptime also takes single digits, which are no written form
        if len(written) == WIDTHS[form]:
            try:
                return datetime.datetime.strptime(written, form).isoformat()
            except ValueError:
                pass
    return written


def date_bound(value, name="modified_after") -> str:
    """The second a date filter starts at."""
    stamp = widen("" if value is None else value)[:19]
    try:
        datetime.datetime.strptime(stamp, "%Y-%m-%dT%H:%M:%S")
    except ValueError:
        raise QueryError(f"filter {name!r} cannot read {value!r} as a date") from None
    return stamp


def modified_after(value, modified="modified", issued="issued") -> Column:
    """Changed since, inclusive. `issued` stands in for a missing `modified`. Text is compared,
    to the second and without offsets."""
    def given(field):
        return F.when(F.col(field) != "", F.col(field))

    stamp = second_stamp(F.coalesce(given(modified), given(issued)))
    return holds(stamp >= F.lit(date_bound(value)))


# --- values in the data ------------------------------------------------------

def observed_values(records: DataFrame, facets=DATASET_FILTERS, expressions=None) -> DataFrame:
    """`(facet, value)`: every value the records hold for each filter, keywords folded."""
    def structs(facet):
        read = F.array_distinct(values_of(facet, expressions))
        fold = fold_keyword if facet == "keyword" else (lambda v: v)
        return F.transform(read, lambda v: F.struct(F.lit(facet).alias("facet"),
                                                    fold(v).alias("value")))

    return (records.select(F.explode(F.concat(*[structs(f) for f in facets])).alias("f"))
            .select("f.*").distinct())


def resolve_values(requested: DataFrame, observed: DataFrame, labels: DataFrame) -> DataFrame:
    """`(value, slug, found)`: the short names each requested value stands for.

    Exact first: a name the data holds is the whole answer, since a synonym would match what the
    facet counts under another name. Failing that, the vocabulary's synonyms. A value that is
    neither has a null `slug`.
    """
    asked = requested.select("value").distinct().withColumn("_name", slugify("value"))
    held = observed.select(F.col("value").alias("_name"), F.lit(True).alias("_held")).distinct()
    exact = asked.join(held, "_name", "left")
    synonyms = (slug_aliases(labels).select(F.col("slug").alias("_name"), "uri")
                .join(term_slugs(labels), "uri").select("_name", "slug").distinct())
    known = synonyms.unionByName(synonyms.select("_name", F.col("_name").alias("slug"))).distinct()
    joined = exact.join(known, "_name", "left")
    slug = F.when(F.col("_held"), F.col("_name")).otherwise(F.col("slug"))
    found = (F.when(F.col("_held"), "data").when(F.col("slug").isNotNull(), "vocabulary")
             .otherwise("unknown"))
    return joined.select("value", slug.alias("slug"), found.alias("found")).distinct()


def keyword_spellings(records: DataFrame, requested: DataFrame) -> DataFrame:
    """`(key, spelling, records)`: the spellings in use of the requested keywords."""
    keys = requested.select(fold_keyword("value").alias("key")).distinct()
    used = (records.select(F.explode(F.array_distinct(values_of("keyword"))).alias("spelling"))
            .groupBy("spelling").agg(F.count("*").alias("records"))
            .withColumn("key", fold_keyword("spelling")))
    return used.join(keys, "key", "left_semi").select("key", "spelling", "records")


def kinds(values):
    """Kinds as asked for; only the known ones exist."""
    wanted = [re.sub(r"[^a-z0-9]+", "_", v.lower()).strip("_") for v in values]
    for value in wanted:
        if value not in KINDS:
            raise QueryError(f"unknown kind {value!r}; one of {', '.join(KINDS)}")
    return wanted
