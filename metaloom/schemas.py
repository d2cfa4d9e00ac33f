"""Declared schemas: envelopes, graphs, records and the small tables beside them."""

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()


def _struct(**fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


STRINGS = T.ArrayType(S)
TEXT = T.MapType(S, S)
WORDS = T.MapType(S, STRINGS)

# One RDF object as written: the language may sit in either of two fields.
RAW_NODE = T.StructType([T.StructField(n, S)
                         for n in ("type", "value", "lang", "xml:lang", "datatype")])
RAW_GRAPH = T.MapType(S, T.MapType(S, T.ArrayType(RAW_NODE)))
NODE = _struct(type=S, value=S, lang=S, datatype=S)
GRAPH = T.MapType(S, T.MapType(S, T.ArrayType(NODE)))

# A page of registry entries. Graphs stay text until `parse_graph`, so that one malformed graph
# cannot spoil its page.
ENTRY_PAGE = _struct(
    offset=L, limit=L, results=L,
    resource=_struct(children=T.ArrayType(_struct(
        contextId=S, entryId=S, rights=STRINGS, metadata=S, info=S, relations=S))))

LINK_CHECK = _struct(entryType=S, context=S, uri=S, property=S, status=S, statusMessage=S,
                     checkedAt=S, attempts=L)

LICENCE = _struct(id=S, label=TEXT, uri=S)
MARK = _struct(reason=S, checked=S, by=S)
PERIOD = _struct(start=S, end=S)
CONTACT = _struct(uri=S, name=S, email=S)
AGENT = _struct(uri=S, name=TEXT, type=S, homepage=S, email=S, identifiers=STRINGS)
PUBLISHER = _struct(id=S, uri=S, name=TEXT, alias=S, type=S, homepage=S, email=S,
                    identifiers=STRINGS)
DISTRIBUTION = _struct(
    uri=S, title=TEXT, description=TEXT, access_url=S, download_url=S, format=S,
    license=LICENCE, status=S, availability=S, languages=STRINGS, issued=S, modified=S,
    access_service_uris=STRINGS, byte_size=L)
DATASET = _struct(
    uri=S, context_id=S, entry_id=S, type=S, title=TEXT, description=TEXT, keywords=WORDS,
    identifier=S, landing_page=S, publisher=AGENT, themes=STRINGS, license=LICENCE,
    access_rights=S, accrual_periodicity=S, languages=STRINGS, spatial=STRINGS,
    temporal=PERIOD, issued=S, modified=S, contact_points=T.ArrayType(CONTACT),
    distributions=T.ArrayType(DISTRIBUTION))
DATA_SERVICE = _struct(
    uri=S, context_id=S, entry_id=S, type=S, title=TEXT, description=TEXT, keywords=WORDS,
    service_type=S, endpoint_url=S, endpoint_description=S, serves_datasets=STRINGS,
    conforms_to=STRINGS, publisher=AGENT, themes=STRINGS, license=LICENCE, access_rights=S,
    landing_page=S, contact_points=T.ArrayType(CONTACT))

VERDICT = _struct(url=S, status=S, reason=S, checked=S, invalid_cert=T.BooleanType())
SOURCE = _struct(context_id=S, status=S, harvested=S, title=S)
