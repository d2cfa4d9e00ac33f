"""A catalogue to ask: search, facets, publishers, one record, and what it holds."""

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.constants import (DATA_SERVICE_FILTERS, DATASET_FILTERS, PUBLISHER_FACETS,
                                PUBLISHER_FILTERS)
from metaloom.operators import facets as fc
from metaloom.operators import filters as fl
from metaloom.operators import links, publishers, reports, vocabulary
from metaloom.operators.assemble import record_by_uri
from metaloom.operators.filters import QueryError
from metaloom.operators.windows import check_window, page
from metaloom.session import cut_lineage

FILTERS = {"dataset": [*DATASET_FILTERS, "modified_after", "query"],
           "data_service": [*DATA_SERVICE_FILTERS, "query"],
           "publisher": PUBLISHER_FILTERS}


class Result:
    """What one search found: a page, and the total and facets over every match."""

    def __init__(self, matches: DataFrame, counted: DataFrame, label, limit, offset, facet_limit):
        self.matches, self.limit, self.offset = matches, limit, offset
        self._counted, self._label, self._facet_limit = counted, label, facet_limit

    @property
    def rows(self) -> DataFrame:
        return page(self.matches, self.limit, self.offset)

    @property
    def total(self) -> DataFrame:
        return self.matches.agg(F.count("*").alias("total"))

    @property
    def facets(self) -> DataFrame:
        """`(facet, value, count, label)`, with `rank` where a limit was asked for. What a limit
        cuts is not labelled first."""
        shown = (self._counted if self._facet_limit is None
                 else fc.limited(self._counted, self._facet_limit))
        return self._label(shown)

    @property
    def omitted(self) -> DataFrame:
        limit = self._facet_limit
        return (fc.omitted(self._counted, limit) if limit is not None
                else self._counted.select("facet", F.lit(0).alias("omitted")).limit(0))


class Catalogue:
    """Records as read (`build.view`), with the vocabulary and the publisher table.

    `exclude_broken` leaves out dead distributions and the datasets that had nothing else. Who a
    publisher is comes from all records; how much it holds, from those in scope.
    """

    def __init__(self, records: DataFrame, labels: DataFrame, publisher_table: DataFrame,
                 exclude_broken=True, sources=None):
        self.every, self.labels, self.table, self.sources = records, labels, publisher_table, sources
        held = links.scope(records) if exclude_broken else records
        self.datasets = held.filter(F.col("type") != "data_service")
        self.services = held.filter(F.col("type") == "data_service")

    # -- values to names ---------------------------------------------------------

    # Written on first use: each of these is a pass over the catalogue, and searches ask again.

    @cached_property
    def agents(self) -> DataFrame:
        return cut_lineage(publishers.agents_of(self.every))

    @cached_property
    def representatives(self) -> DataFrame:
        return cut_lineage(publishers.representatives(self.agents, self.table))

    @cached_property
    def keys(self) -> DataFrame:
        return cut_lineage(publishers.name_keys(self.agents, self.table))

    @cached_property
    def observed(self) -> dict:
        """Per kind of record `(facet, value)`, every value in use of every filter."""
        return {"dataset": cut_lineage(fl.observed_values(self.datasets, DATASET_FILTERS)),
                "data_service": cut_lineage(fl.observed_values(self.services, DATA_SERVICE_FILTERS))}

    def _observed(self, kind, name) -> DataFrame:
        return self.observed[kind].filter(F.col("facet") == name).select("value")

    def _asked(self, values):
        return self.every.sparkSession.createDataFrame([(v,) for v in values], "value string")

    def _unknown(self, name, value, known):
        """The error for a value nobody knows, with the nearest known ones."""
        near = vocabulary.nearest_known(self._asked([value]), known).orderBy("rank").collect()
        hint = ", ".join(r["known"] for r in near)
        return QueryError(f"no {name} is called {value!r}" + (f"; close to it: {hint}" if hint else ""))

    def resolve_publishers(self, values):
        """Ids of what was asked for: as many rows as values, whatever the catalogue's size."""
        found = publishers.resolve(self._asked(values), self.keys, self.table).collect()
        for row in found:
            if row["id"] is None:
                raise self._unknown("publisher", row["value"], self.agents.select(F.col("id").alias("known")))
        return [r["id"] for r in found]

    def _slugs(self, name, values, kind):
        observed = self._observed(kind, name)
        found = fl.resolve_values(self._asked(values), observed, self.labels).collect()
        for row in found:
            if row["slug"] is None:
                raise self._unknown(name, row["value"], observed.select(F.col("value").alias("known")))
        return sorted({r["slug"] for r in found})

    def _keyword_keys(self, values):
        observed = (self._observed("dataset", "keyword").unionByName(self._observed("data_service", "keyword"))
                    .select(F.col("value").alias("known")).distinct())
        asked = self._asked(values).select(fl.fold_keyword("value").alias("known")).distinct()
        known = [r["known"] for r in asked.join(observed, "known", "left_semi").collect()]
        for row in asked.collect():
            if row["known"] not in known:
                raise self._unknown("keyword", row["known"], observed)
        return known

    def condition(self, record_type="dataset", **filters):
        """One column that is true for the records all filters match."""
        parts = []
        for name, value in filters.items():
            if name not in FILTERS[record_type]:
                raise QueryError(f"{record_type} records have no {name!r}; "
                                 f"available: {', '.join(FILTERS[record_type])}")
            if name == "modified_after":
                parts.append(fl.modified_after(value))
                continue
            values = fl.require_values(value, name)
            if name == "query":
                parts.append(fl.phrase_in(str(value)))
            elif name == "publisher":
                parts.append(fl.facet_filter(name, self.resolve_publishers(values)))
            elif name == "keyword":
                parts.append(fl.keyword_filter(self._keyword_keys(values)))
            elif name == "kind":
                parts.append(fl.facet_filter(name, fl.kinds(values)))
            elif name == "access_rights":
                unset = [v for v in values if v.strip().lower() == "none"]
                named = [v for v in values if v not in unset]
                slugs = self._slugs(name, named, record_type) if named else []
                parts.append(fl.access_rights_filter(slugs + ["none"] * bool(unset)))
            else:
                parts.append(fl.facet_filter(name, self._slugs(name, values, record_type)))
        return fl.all_of(*parts)

    # -- asking -------------------------------------------------------------------

    def search(self, query=None, record_type="dataset", limit=None, offset=0, facet_limit=None, **filters):
        check_window(limit, offset)
        if query is not None:
            filters["query"] = query
        records = self.services if record_type == "data_service" else self.datasets
        names = DATA_SERVICE_FILTERS if record_type == "data_service" else DATASET_FILTERS
        matches = records.filter(self.condition(record_type, **filters))
        counted = fc.facet_counts(matches, names)
        names_of = self.representatives.select("id", F.col("agent.name").alias("name"))
        return Result(matches, counted, lambda rows: fc.labelled(rows, self.labels, names_of),
                      limit, offset, facet_limit)

    def facets(self, limit=None) -> DataFrame:
        return self.search(limit=0, facet_limit=limit).facets

    def get(self, uri) -> DataFrame:
        """One record by its URI; of several with one URI the first."""
        return record_by_uri(self.datasets.unionByName(self.services), uri)

    def publishers(self, **filters) -> DataFrame:
        """Every publisher with something that matches, biggest first."""
        def matching(records, record_type):
            for name in filters:
                if name not in PUBLISHER_FILTERS:
                    raise QueryError(f"publishers have no {name!r}")
            return records.filter(self.condition(record_type, **filters)) if filters else records

        counted = publishers.counts(matching(self.datasets, "dataset"),
                                    matching(self.services, "data_service"))
        return publishers.publisher_rows(counted, self.representatives)

    def publisher(self, value):
        """(row, facets) of one publisher; the row is empty for one that holds nothing here."""
        pid = self.resolve_publishers(fl.require_values(value, "publisher"))[0]
        mine = self.datasets.filter(F.col("publisher.id") == pid)
        rows = publishers.publisher_rows(publishers.counts(
            mine, self.services.filter(F.col("publisher.id") == pid)), self.representatives)
        return rows, fc.labelled(fc.facet_counts(mine, PUBLISHER_FACETS), self.labels)

    def info(self) -> DataFrame:
        return reports.catalogue_info(self.every)

    def source_rows(self) -> DataFrame:
        return reports.source_rows(self.sources, self.datasets, self.services)
