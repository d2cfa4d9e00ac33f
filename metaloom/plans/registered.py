"""Every registered query."""

import importlib

from pyspark.sql import functions as F

from metaloom.operators.facets import facet_counts, ordered
from metaloom.operators.filters import facet_filter
from metaloom.operators.links import scope
from metaloom.plans.registry import ORACLES, QUERIES, query  # noqa: F401

for _area in ("facets", "quality", "publishers", "assembly", "vocabulary", "graph", "entities", "store", "readers"):
    importlib.import_module(f"metaloom.plans.queries_{_area}")


@query("flagship", """
WITH d AS (SELECT doc_id, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
           WHERE lang = 'en' AND (quality IS NULL OR quality <> 0)),
f AS (SELECT 'publisher' AS facet, source AS value FROM d
      UNION ALL SELECT 'theme', 'en' FROM d
      UNION ALL SELECT 'kind', CASE WHEN toxic = 1 THEN 'unverified' ELSE 'unmarked' END FROM d WHERE quality IS NOT NULL)
SELECT facet, value, count(*) AS count FROM f GROUP BY ALL ORDER BY facet, count DESC, value""")
def flagship_plan(t):
    """English datasets that are not dead, by source, language and verdict."""
    alive = scope(t.document_records).filter(facet_filter("theme", ["en"]))
    verdict = F.transform("distributions", lambda d: F.when(d["unverified"].isNotNull(), "unverified")
                          .otherwise("unmarked"))
    return ordered(facet_counts(alive, ["publisher", "theme", "kind"], {"kind": verdict}))


def flagship(spark, folder):
    return QUERIES["flagship"](spark, folder)
