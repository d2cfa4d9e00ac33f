"""Truth tables of the rules read off one value."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from metaloom.constants import ISO_639_1
from metaloom.functions import quality, text, typed, uris


def table(spark, rows, schema, column):
    """[(input..., expected)] -> [(expected, got)] in one job."""
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}, expected string")
    out = df.select("i", "expected", column.cast("string").alias("got")).orderBy("i").collect()
    return [(r["expected"], r["got"]) for r in out]


def check(pairs):
    assert [g for _, g in pairs] == [e for e, _ in pairs]


def test_kinds(spark):
    rows = [
        ("csv", None, "https://h.example.org/files/a", False, "file"),
        (None, None, "https://h.example.org/files/a.XLSX", False, "file"),
        ("csv", "https://h.example.org/a", None, False, "file"),
        ("pdf", None, "https://h.example.org/report", False, "file"),
        ("csv", None, "https://h.example.net/rowstore/dataset/abc", False, "rowstore"),
        ("csv", "https://h.example.net/rowstore/dataset/abc/csv", None, False, "rowstore"),
        (None, None, "https://h.example.org/dataset/roads/resource/1", False, "ckan"),
        ("csv", "https://h.example.org/dataset/roads/resource/1", None, False, "file"),
        ("json", None, "https://h.example.org/api/explore/v2/x", False, "huwise"),
        ("json", None, "https://API.scb.se/OV/v1/x", False, "pxweb"),
        ("json", None, "https://h.example.org/PXWeb/api", False, "pxweb"),
        ("json", None, "https://v2.kolada.se/kpi", False, "kolada"),
        (None, None, "https://doi.org/10.1/x", False, "doi"),
        ("wms_service", None, "https://h.example.org/maps", False, "geodata"),
        (None, "https://h.example.org/a.gpkg", None, False, "geodata"),
        (None, None, "https://h.example.org/ows?service=WFS", False, "geodata"),
        ("html", None, "https://h.example.org/about", False, "web_page"),
        ("html", "https://h.example.org/page", None, False, "web_page"),
        ("html", "https://h.example.org/x.csv", None, False, "file"),
        (None, None, "https://h.example.org/api", True, "api"),
        (None, None, "https://h.example.org/somewhere", False, "unknown"),
        (None, None, None, False, "unknown"),
    ]
    check(table(spark, rows, "f string, d string, a string, s boolean",
                quality.kind_of("f", "d", "a", F.col("s"))))


def test_an_address_is_matched_once(spark):
    """Each of the two addresses meets the patterns in one place of the plan, not wherever its kind is named."""
    rows = spark.createDataFrame([("csv", "https://h.example.org/a", None)], "f string, d string, a string")
    plan = rows.select(quality.kind_of("f", "d", "a", F.lit(False)).alias("kind"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("wmsserver") == 2


def test_dead_reasons(spark):
    rows = [(r, "true") for r in ("Not Found", " forbidden ", "404", "File not found", "Access Denied",
                                  "Content Too Large", "Request Entity Too Large", "I'm a Teapot", "500",
                                  "request to x failed, reason: getaddrinfo ENOTFOUND x")]
    rows += [(r, "false") for r in (None, "", "timeout", "Too Many Requests", "429", "OK", "200",
                                    "request to x failed, reason: read ECONNRESET",
                                    "request to x failed, reason: getaddrinfo EAI_AGAIN x")]
    check(table(spark, rows, "r string", quality.is_dead("r")))


def test_slugs_equal_the_definition(spark):
    """Against the definition itself, over every character that decomposes."""
    import re

    def expected(value):
        plain = "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))
        plain = re.sub(r"\([^)]*\)", " ", plain.lower())
        return re.sub(r"[^a-z0-9]+", "_", plain).strip("_")

    words = ["Local authority", "CC BY 4.0 (Attribution)", "Straße", "ﬁle ½ ⑴ №", "Å Ä Ö é ñ", "", "áb",
             "İstanbul", "漢字 x", "Ⅷ ª K"]
    words += [f"x{chr(p)}y" for p in range(0x80, 0x3000)]
    check(table(spark, [(w, expected(w)) for w in words], "w string", text.slugify("w")))


def test_spelled_out_characters_are_looked_up(spark):
    """One lookup a character: a class of all of them would be tried in turn on every character of a text."""
    for several, column in ((text._decompositions()[1], text.slugify("w")), (text._foldings()[1], text.casefold("w"))):
        rows = spark.createDataFrame([("x",)], "w string").select(column)
        assert "[" + "".join(several)[:40] not in rows._jdf.queryExecution().analyzed().toString()
    words = ["ß" * 3000 + " ﬁ ½ ﬁ 𝟘🄀ﬃ 漢 …½…", "(ﬁ) Straße … (ﬂ", "__a--ﬁ__"]
    expected = ["fi_1_2_fi_00_ffi_1_2", "stra_e_fl", "a_fi"]
    check(table(spark, list(zip(words, expected)), "w string", text.slugify("w")))
    check(table(spark, [(w, w.casefold()) for w in words], "w string", text.casefold("w")))


def test_casefold_equals_python(spark):
    words = [" Straße ", "ΟΔΟΣ", "ﬁ", "ıI", "Kommun\n    ", " x "]
    check(table(spark, [(w, w.strip().casefold()) for w in words], "w string", text.fold_keyword("w")))


def test_uri_spellings(one):
    assert one(uris.uri_spellings, "http://a.example.org/x/#f") == [
        "http://a.example.org/x/#f", "http://a.example.org/x/", "https://a.example.org/x/",
        "http://a.example.org/x", "https://a.example.org/x"]
    spelled = one(uris.uri_spellings, "https://creativecommons.org/licenses/by/4.0/deed.sv")
    assert "http://creativecommons.org/licenses/by/4.0/" in spelled
    assert one(uris.uri_spellings, "text/csv") == ["text/csv", "text/csv/"]


def test_curies_and_languages(spark):
    check(table(spark, [("dcat:Dataset", "http://www.w3.org/ns/dcat#Dataset"), ("http://x/y", "http://x/y"),
                        ("plain", "plain"), ("nope:x", "nope:x")], "t string", uris.expand_curie("t")))
    check(table(spark, [("http://purl.org/dc/terms/title", "dcterms:title"),
                        ("http://entrystore.org/terms/statistics#x", "stats:x"),
                        ("http://entrystore.org/terms/x", "es:x"), ("urn:x", "urn:x")],
                "t string", uris.shorten_uri("t")))
    eu = "http://publications.europa.eu/resource/authority/language/"
    rows = [(eu + "SWE", "sv"), (eu + "FIT", "fit"), ("http://id.loc.gov/vocabulary/iso639-1/sv", "sv"),
            (eu + "X1", None), ("http://other/SWE", None), (None, None)]
    rows += [(eu + three.upper(), two) for three, two in ISO_639_1.items()]
    check(table(spark, rows, "t string", uris.language_code("t")))


def test_byte_sizes(spark):
    rows = [("5 420 000", "5420000"), ("39000.0", "39000"), ("5 420", "5420"), ("7.", "7"), ("12", "12"),
            ("1 000", "1000"), ("2022-02-09", None), ("-5", None), ("5.5", None), ("", None), ("5 MB", None)]
    check(table(spark, rows, "t string", typed.byte_size("t")))


def test_dates(spark):
    xsd = "http://www.w3.org/2001/XMLSchema#"
    rows = [("2020-03-04", None, "2020-03-04"), ("2020-03-04T09:00:00Z", None, "2020-03-04T09:00:00+00:00"),
            ("2020-03-04T09:00:00.5+01:00", None, "2020-03-04T09:00:00.500000+01:00"),
            ("2020-03-04T09:00:00.000", None, "2020-03-04T09:00:00"), ("2020-02-30", None, None),
            ("2020-03-04 09:00:00", None, "2020-03-04"), ("2020-03-04T10:00:00", xsd + "date", "2020-03-04"),
            ("2020-03-04", xsd + "dateTime", "2020-03-04T00:00:00"), ("2019", None, None),
            ("2019", xsd + "gYear", None), ("2020-03-04T25:00:00", None, None), ("soon", xsd + "date", None)]
    check(table(spark, rows, "v string, d string", typed.date_text("v", F.col("d"))))


def test_typed_literals(spark):
    xsd = "http://www.w3.org/2001/XMLSchema#"
    rows = [("42", xsd + "integer", "integer"), ("x", xsd + "int", "string"), ("1.5", xsd + "decimal", "float"),
            ("TRUE", xsd + "boolean", "boolean"), ("maybe", xsd + "boolean", "string"), ("2019-XX", xsd + "gYear", "integer"),
            ("2020-01-01", xsd + "date", "date"), ("2020-01-01T00:00:00", xsd + "dateTime", "datetime"), ("text", None, "string")]
    check(table(spark, rows, "v string, d string", typed.typed_literal("v", F.col("d"))["family"]))


@pytest.mark.parametrize("value, stamp", [("2024", "2024-01-01T00:00:00"), ("2024-02", "2024-02-01T00:00:00"),
                                          ("2024-02-03", "2024-02-03T00:00:00"),
                                          ("2024-05-06T08:00:00+02:00", "2024-05-06T08:00:00")])
def test_date_bounds(value, stamp):
    from metaloom.operators.filters import date_bound
    assert date_bound(value) == stamp


@pytest.mark.parametrize("value", [None, "", "2024-13-45", "soon"])
def test_impossible_dates_are_refused(value):
    from metaloom.operators.filters import QueryError, date_bound
    with pytest.raises(QueryError):
        date_bound(value)
