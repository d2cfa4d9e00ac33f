"""The store, the readers, refresh and streaming, on files the tests write."""

import json

import pytest
from pyspark.sql import functions as F

from metaloom.constants import iri
from metaloom.operators import links
from metaloom.plans import build
from metaloom.plans.refresh import refresh
from metaloom.plans.search import Catalogue
from metaloom.operators.filters import QueryError
from metaloom.sources import exports, registry, vocabularies
from metaloom.sources.store import Store, StoreError, changed_since
from metaloom.streaming import upserts


def rows(spark, *values):
    return spark.createDataFrame(values, "context_id string, entry_id string, uri string, type string, harvested string, n int")


def held(store):
    return {(r["context_id"], r["entry_id"]): r["n"] for r in store.records().collect()}


def test_upsert_writes_only_its_rows(spark, tmp_path):
    store = Store(spark, tmp_path / "s")
    with pytest.raises(StoreError):
        store.records()
    # One URI on two entries: two rows, as identity is the entry.
    assert store.rebuild(rows(spark, *[("c", str(i), "u", "dataset", "2024-01-01", i) for i in range(40)]), "t1") == 40
    assert store.upsert(rows(spark, ("c", "3", "u", "dataset", "2024-01-02", 300), ("d", "1", "v", "data_service", "2024-01-02", 1)), "t2") == 2
    state = held(store)
    assert len(state) == 41 and state[("c", "3")] == 300 and state[("c", "4")] == 4
    assert store.records("data_service").count() == 1
    assert set(store.pointer()["tables"]["records"]["parts"].values()) == {1}
    assert spark.read.parquet(str(tmp_path / "s" / "records" / "d=2")).count() == 2
    # An older row never replaces a newer one where only newer ones count.
    store.upsert(rows(spark, ("c", "3", "u", "dataset", "2023-01-01", -1)), "t3", only_newer=True)
    assert held(store)[("c", "3")] == 300
    # A plain upsert does, and what follows is judged against it.
    store.upsert(rows(spark, ("c", "3", "u", "dataset", "2023-01-01", -2)), "t3")
    store.upsert(rows(spark, ("c", "3", "u", "dataset", "2023-01-02", -3), ("c", "4", "u", "dataset", "2023-01-02", -3)), "t3", only_newer=True)
    assert held(store)[("c", "3")] == -3 and held(store)[("c", "4")] == 4
    before = held(store)
    assert store.compact() and held(store) == before and store.compact() == []
    store.upsert_table("verdicts", spark.createDataFrame([("u", "dead", "1")], "url string, status string, checked string"), "url")
    store.rebuild(rows(spark, ("c", "1", "u", "dataset", "2024-01-03", 9)), "t4")
    assert held(store) == {("c", "1"): 9} and store.verdicts() is None
    meta = {r["key"]: r["value"] for r in store.meta().collect()}
    assert meta["first_retrieved"] == "t1" and meta["last_refreshed"] == "t4"
    assert store.vacuum() and held(store) == {("c", "1"): 9}


def size_of(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def many(spark, start, end, step=1, harvested="2024-01-01"):
    return spark.range(start, end, step).selectExpr(
        "'c' AS context_id", "cast(id AS string) AS entry_id", "concat('u', id) AS uri", "'dataset' AS type",
        f"'{harvested}' AS harvested", "cast(id AS int) AS n")


def test_scattered_keys_write_no_more_than_their_rows(spark, tmp_path):
    """A thousand keys all over the table are one small delta; buckets follow the measured rows."""
    store = Store(spark, tmp_path / "s", bucket_rows=5_000)
    store.rebuild(many(spark, 0, 60_000), "t1")
    table = store.pointer()["tables"]["records"]
    assert table["buckets"] == 16 and table["rows"] == 60_000
    assert store.upsert(many(spark, 0, 60_000, 60, "2024-01-02"), "t2") == 1_000
    delta = tmp_path / "s" / "records" / "d=2"
    assert spark.read.parquet(str(delta)).count() == 1_000
    assert size_of(delta) < size_of(tmp_path / "s" / "records" / "v=1") / 10
    assert store.records().count() == 60_000 and store.records().filter("harvested = '2024-01-02'").count() == 1_000
    # One key: compaction writes its bucket and no other.
    small = Store(spark, tmp_path / "one", bucket_rows=5_000)
    small.rebuild(many(spark, 0, 60_000), "t1")
    small.upsert(many(spark, 7, 8, harvested="2024-01-03"), "t2")
    assert len(small.compact()) == 1 and small.records().count() == 60_000
    # A table that outgrows its buckets gets more of them.
    grown = Store(spark, tmp_path / "two", bucket_rows=1_000)
    grown.rebuild(many(spark, 0, 1_000), "t1")
    assert grown.pointer()["tables"]["records"]["buckets"] == 1
    grown.upsert(many(spark, 500, 6_000), "t2")
    assert grown.pointer()["tables"]["records"]["buckets"] == 8 and grown.records().count() == 6_000
    assert grown.pointer()["tables"]["records"]["deltas"] == []


def test_small_buckets_share_files(spark, tmp_path):
    """Files grow with the rows, however small a bucket is; each bucket still has its own version."""
    store = Store(spark, tmp_path / "s", bucket_rows=50)
    store.rebuild(many(spark, 0, 20_000), "t1")
    table = store.pointer()["tables"]["records"]
    assert table["buckets"] == 512 and len(list((tmp_path / "s" / "records" / "v=1").rglob("*.parquet"))) < 20
    expected = {("c", str(i)): i for i in range(20_000)}
    for version, keys in ((2, range(0, 30, 3)), (4, range(1, 5)), (6, range(19_990, 20_010))):
        new = spark.createDataFrame([("c", str(i), f"u{i}", "dataset", "2024-01-02", -version) for i in keys],
                                    "context_id string, entry_id string, uri string, type string, harvested string, n int")
        store.upsert(new, "t2")
        expected.update({("c", str(i)): -version for i in keys})
        touched = store.compact()
        assert 0 < len(touched) <= len(keys) and held(store) == expected
        assert spark.read.parquet(str(tmp_path / "s" / "records" / f"v={version + 1}")).select("bucket").distinct().count() == len(touched)
    assert len(set(store.pointer()["tables"]["records"]["parts"].values())) == 4
    # Where a bucket has a folder of its own, those of versions it has left are not opened.
    apart = Store(spark, tmp_path / "apart", bucket_rows=125_001)
    apart.rebuild(many(spark, 0, 500_000), "t1")
    apart.upsert(many(spark, 7, 8), "t2")
    assert len(apart.compact()) == 1 and apart.records().count() == 500_000
    read = apart.records()
    read.count()
    assert len(read.inputFiles()) >= 4 and "array_contains" in read._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_deltas_are_compacted_before_they_are_many(spark, tmp_path):
    store = Store(spark, tmp_path / "s", max_deltas=3)
    store.upsert_table("verdicts", spark.createDataFrame([], "url string, status string, checked string"), "url", latest="checked")
    assert store.verdicts().count() == 0
    for i in range(5):
        store.upsert_table("verdicts", spark.createDataFrame([("u", str(i), f"2024-01-0{5 - i}"), (f"v{i}", "x", None)], "url string, status string, checked string"), "url", latest="checked")
        assert len(store.pointer()["tables"]["verdicts"]["deltas"]) < 3
    got = {r["url"]: r["status"] for r in store.verdicts().collect()}
    assert got == {"u": "0", **{f"v{i}": "x" for i in range(5)}}


def test_a_failure_before_the_pointer_leaves_the_old_state(spark, tmp_path, monkeypatch):
    store = Store(spark, tmp_path / "s")
    store.rebuild(many(spark, 0, 10), "t1", meta={"high_water": "a"})

    def lost(*_):
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as broken:
        broken.setattr(store, "_publish", lost)
        for step in (lambda: store.upsert(many(spark, 5, 20), "t2", meta={"high_water": "b"}), lambda: store.rebuild(many(spark, 0, 1), "t2"),
                     lambda: store.upsert_table("verdicts", spark.createDataFrame([("u",)], "url string"), "url")):
            with pytest.raises(RuntimeError):
                step()
    assert store.records().count() == 10 and store.pointer()["meta"]["high_water"] == "a" and store.verdicts() is None
    store.upsert(many(spark, 5, 20), "t2", meta={"high_water": "b"})
    assert store.records().count() == 20 and store.pointer()["meta"]["high_water"] == "b"


def test_sources_are_a_snapshot(spark, tmp_path):
    store = Store(spark, tmp_path / "s")
    for name in ("a", "b"):
        store.replace_table("sources", spark.createDataFrame([(name, "failed")], "context_id string, status string"))
    assert [r["context_id"] for r in store.sources().collect()] == ["b"]


def node(kind, value, **more):
    return {"type": kind, "value": value, **more}


def entry(context, entry_id, uri, graph, modified="2024-01-01T00:00:00Z"):
    info = {f"https://r.example.org/{entry_id}": {
        iri("es:resource"): [node("uri", uri)],
        iri("dcterms:modified"): [node("literal", modified, datatype=iri("xsd:dateTime"))]}}
    return {"contextId": context, "entryId": entry_id, "rights": ["readmetadata"], "metadata": graph, "info": info}


def dataset(n, title, files=(), publisher="urn:agent", keyword="Väg", access=None):
    uri = f"urn:d{n}"
    graph = {uri: {iri("rdf:type"): [node("uri", iri("dcat:Dataset"))],
                   iri("dcterms:title"): [node("literal", title, **{"xml:lang": "sv"})],
                   iri("dcat:keyword"): [node("literal", keyword, lang="sv")],
                   iri("dcat:theme"): [node("uri", "http://v.example.org/tran/")],
                   iri("dcterms:publisher"): [node("uri", publisher)],
                   iri("dcat:distribution"): [node("uri", f) for f in files]}}
    if access:
        graph[uri][iri("dcterms:accessRights")] = [node("uri", access)]
    return entry("1", str(n), uri, graph, modified=f"2024-01-0{n}T00:00:00Z")


def distribution(uri, url, fmt="text/csv"):
    return entry("1", uri, uri, {uri: {
        iri("rdf:type"): [node("uri", iri("dcat:Distribution"))],
        iri("dcat:accessURL"): [node("uri", url)], iri("dcterms:format"): [node("literal", fmt)]}})


def agent():
    return entry("9", "a", "urn:agent", {"urn:agent": {
        iri("rdf:type"): [node("uri", iri("foaf:Agent"))], iri("foaf:name"): [node("literal", "Trafik & Väg")]}})


@pytest.fixture(scope="module")
def catalogue(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("registry")
    children = [dataset(1, "Vägar", ["urn:f1", "urn:f2"], keyword="väg "), dataset(2, "Budget (öppen)", ["urn:f3"], keyword="VÄG"),
                dataset(3, "Utan filer", access="http://v.example.org/closed"),
                distribution("urn:f1", "https://h.example.org/a"), distribution("urn:f2", "https://h.example.org/b", "text/html"),
                distribution("urn:f3", "https://h.example.org/c"), agent()]
    (folder / "page1.json").write_text(json.dumps({"results": 7, "resource": {"children": children}}))
    (folder / "page2.json").write_text(json.dumps({"results": 7, "resource": {"children": []}}))
    reports = folder / "reports" / "1"
    reports.mkdir(parents=True)
    checks = [{"uri": "https://h.example.org/b", "status": "broken", "statusMessage": "Not Found", "checkedAt": "2024-01-01T00:00:00.000Z"},
              {"uri": "https://h.example.org/c", "status": "broken", "statusMessage": "Gone", "checkedAt": "2024-01-01T00:00:00.000Z"},
              {"uri": "https://h.example.org/a", "status": "broken", "statusMessage": "timeout", "checkedAt": "2024-01-01"}, {"status": "broken"}]
    (reports / "r1.json").write_text(json.dumps(checks))
    (reports / "r2.json").write_text('{"error": "no list"}')
    (folder / "labels.json").write_text(json.dumps({"labels": {"http://v.example.org/tran": {"en": "Transport", "sv": "Transport sv"}}}))
    labels = vocabularies.read_labels(spark, str(folder / "labels.json"))
    read, unreadable = registry.read_link_checks(spark, str(folder / "reports" / "*" / "*.json"))
    assert unreadable.count() == 1 and read.count() == 3
    entries = registry.read_entries(spark, str(folder / "page*.json"))
    stored = build.records(build.stage_entries(entries, str(folder / "stage")), labels)
    store = Store(spark, folder / "store")
    store.rebuild(stored, "now")
    publishers = vocabularies.read_publishers(spark, str(folder / "none.json"))
    shown = build.view(store.records(), checks=read, publishers=publishers,
                       sources=spark.createDataFrame([("1", "failed", "2024-01-02", "x")], "context_id string, status string, harvested string, title string")).cache()
    return {"store": store, "shown": shown, "labels": labels, "publishers": publishers,
            "asked": Catalogue(shown, labels, publishers), "entries": entries}


def test_records_of_a_registry(catalogue):
    found = {r["uri"]: r for r in catalogue["shown"].collect()}
    assert set(found) == {"urn:d1", "urn:d2", "urn:d3"}
    one = found["urn:d1"]
    assert one["themes"] == ["transport"] and one["title"] == {"sv": "Vägar"} and one["stale"]["reason"] == "harvest failed"
    assert one["publisher"]["id"] == "trafik_vag" and one["publisher"]["name"] == {"sv": "Trafik & Väg"}
    files = {d["uri"]: d for d in one["distributions"]}
    assert files["urn:f2"]["broken"]["reason"] == "Not Found" and files["urn:f1"]["unverified"]["reason"] == "timeout"
    assert files["urn:f1"]["kind"] == "file" and files["urn:f2"]["kind"] == "web_page"


def test_every_facet_value_filters_to_its_count(catalogue):
    """The promise of a facet: filtering by a value finds exactly as many as it says."""
    asked = catalogue["asked"]
    assert {r["uri"] for r in asked.datasets.collect()} == {"urn:d1", "urn:d3"}
    values = asked.facets().collect()
    assert len(values) >= 5
    for value in values:
        found = asked.search(limit=0, **{value["facet"]: value["value"]})
        assert found.total.head()["total"] == value["count"], value


def test_searches(catalogue):
    asked = catalogue["asked"]
    assert [r["uri"] for r in asked.search("VÄGA").rows.collect()] == ["urn:d1"]
    assert asked.search(access_rights="none").total.head()["total"] == 1
    assert [r["uri"] for r in asked.search(limit=1, offset=1).rows.collect()] == ["urn:d3"]
    assert asked.get("urn:d3").count() == 1 and asked.get("urn:d2").count() == 0
    rows_, _ = asked.publisher("Trafik & väg")
    assert rows_.head()["dataset_count"] == 2
    for wrong in ({"theme": "transprot"}, {"keyword": []}, {"format": " "}, {"nothing": "x"}, {"kind": "paper"}, {"publisher": "who"}):
        with pytest.raises(QueryError):
            asked.search(**wrong)
    with pytest.raises(QueryError):
        asked.search(limit=-1)


def test_export(catalogue):
    flat = exports.flat_distributions(catalogue["asked"].datasets).collect()
    assert [(r["dataset"], r["format"], r["url"]) for r in flat] == [("urn:d1", "csv", "https://h.example.org/a")]
    found = catalogue["asked"].search(facet_limit=1)
    document = json.loads(exports.to_json(exports.result_document(found.rows, found.facets, found.omitted, total=2)).head()["json"])
    assert document["total"] == 2 and len(document["datasets"]) == 2 and document["facets"]["theme"][0]["value"] == "transport"


def test_incremental_refresh_keeps_what_it_did_not_ask_about(catalogue, spark):
    store = catalogue["store"]
    staged = build.stage_entries(catalogue["entries"])
    late = changed_since(staged, "2024-01-03")
    fresh = build.records(late, catalogue["labels"], references=staged)
    assert [r["uri"] for r in fresh.collect()] == ["urn:d3"]
    store.upsert(fresh, "later")
    assert store.records().count() == 3


def test_a_refresh_is_one_step_with_a_stored_mark(catalogue, spark, tmp_path, monkeypatch):
    store, labels = Store(spark, tmp_path / "s"), catalogue["labels"]
    staged = build.stage_entries(catalogue["entries"])
    early = staged.filter(F.col("harvested") < "2024-01-03")
    first = refresh(store, early, labels, "t1")
    assert (first.written, first.before) == (2, None) and first.mark.startswith("2024-01-02")
    assert refresh(store, early, labels, "t2").written == 0
    version = store.pointer()["version"]
    with monkeypatch.context() as broken:
        broken.setattr(store, "_publish", lambda state: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh(store, staged, labels, "t3")
    assert store.records().count() == 2 and store.pointer()["version"] == version
    second = refresh(store, staged, labels, "t4")
    assert (second.written, second.before) == (1, first.mark) and second.mark.startswith("2024-01-03")
    assert {r["uri"]: r["n"] for r in store.records().select("uri", F.size("distributions").alias("n")).collect()} == {"urn:d1": 2, "urn:d2": 1, "urn:d3": 0}
    version = store.pointer()["version"]
    assert refresh(store, staged, labels, "t5").written == 0 and store.pointer()["version"] == version
    assert {r["key"]: r["value"] for r in store.meta().collect()}["last_refreshed"] == "t4"


def test_streams_end_where_a_batch_does(spark, tmp_path):
    """Arrivals out of order, in several files: the newest stands."""
    schema = "context_id string, entry_id string, uri string, type string, harvested string, n int"
    for i, batch in enumerate([[("c", "1", "u", "dataset", "2024-01-03", 3)], [("c", "1", "u", "dataset", "2024-01-02", 2), ("c", "2", "u", "dataset", "2024-01-01", 1)]]):
        spark.createDataFrame(batch, schema).coalesce(1).write.json(str(tmp_path / "in" / f"b{i}"))
    store = Store(spark, tmp_path / "s")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in" / "*"))
    upserts.upsert_records(stream, store, str(tmp_path / "cp"), "now").awaitTermination(100)
    assert held(store) == {("c", "1"): 3, ("c", "2"): 1}
    # A batch that is run again after it was published is left out; the next one is not.
    ((name, last),) = store.pointer()["streams"].items()
    version = store.pointer()["version"]
    again = rows(spark, ("c", "1", "u", "dataset", "2024-01-09", 9))
    assert last == 1 and store.upsert(again, "now", only_newer=True, batch=(name, last)) == 0
    assert held(store) == {("c", "1"): 3, ("c", "2"): 1} and store.pointer()["version"] == version
    assert store.upsert(again, "now", only_newer=True, batch=(name, last + 1)) == 1 and held(store)[("c", "1")] == 9
    checks = "uri string, context string, pos int, status string, statusMessage string, checkedAt string"
    for i, batch in enumerate([[("u", "a", 1, "broken", "x", "2024-01-02")], [("u", "a", 2, "success", None, "2024-01-01"), ("v", "a", 1, "success", None, "2024-01-01")]]):
        spark.createDataFrame(batch, checks).coalesce(1).write.json(str(tmp_path / "links" / f"b{i}"))
    stream = spark.readStream.schema(checks).option("maxFilesPerTrigger", 1).json(str(tmp_path / "links" / "*"))
    upserts.upsert_checks(stream, store, str(tmp_path / "cp2")).awaitTermination(100)
    assert {r["url"]: r["status"] for r in store.link_checks().collect()} == {"u": "broken", "v": "success"}


def test_vocabulary_files(spark, tmp_path):
    (tmp_path / "se.txt").write_text("# note\n\n1\tFirst\tx\n1\tSecond\tx\nx\tNo\n2\tTwo\n")
    (tmp_path / "co.txt").write_text("a\tb\tc\td\tLand\t2\n" + "\t".join(["c"] * 4 + ["Country"] + ["c"] * 11 + ["3"]) + "\n")
    names = vocabularies.read_gazetteer(spark, [(str(tmp_path / "se.txt"), 0, 1), (str(tmp_path / "co.txt"), 16, 4)])
    assert {r["id"]: r["name"] for r in names.collect()} == {"1": "First", "2": "Two", "3": "Country"}
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.json").write_text(json.dumps({"choices": [{"value": "u", "label": {"sv": "ett", "en": "one", "de": "x"}}, {"value": "w", "label": "none"}]}))
    (tmp_path / "t" / "b.json").write_text(json.dumps({"choices": [{"value": "u", "label": {"en": "uno"}}]}))
    (tmp_path / "t" / "c.json").write_text("not json")
    assert [(r["uri"], r["label"]) for r in vocabularies.read_templates(spark, str(tmp_path / "t")).collect()] == [("u", {"sv": "ett", "en": "uno"})]
    xml = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:s="http://www.w3.org/2004/02/skos/core#"
      xmlns:r="http://www.w3.org/2000/01/rdf-schema#"><x><s:Concept rdf:about="https://v.example.org/a/"><r:label xml:lang="en">Label</r:label>
      <s:prefLabel xml:lang="swe"> Begrepp </s:prefLabel><s:prefLabel xml:lang="en-GB">Term</s:prefLabel></s:Concept>
      <s:Concept rdf:about="http://other"><s:prefLabel xml:lang="sv">No</s:prefLabel></s:Concept></x></rdf:RDF>"""
    documents = spark.createDataFrame([("http://v.example.org/a", xml, None), ("urn:bad", "<a", None)], "uri string, xml string, final_url string")
    assert [(r["uri"], r["label"]) for r in vocabularies.labels_of_documents(documents).collect()] == [("http://v.example.org/a", {"en": "Term", "sv": "Begrepp"})]
    (tmp_path / "p.json").write_text(json.dumps({"publishers": {"scb": {"uri": "http://d.example.org/organisation/SE2021/", "alias": "S C"}, "x": {"alias": "Y"}}}))
    got = {r["id"]: (r["uri"], r["org_no"]) for r in vocabularies.read_publishers(spark, str(tmp_path / "p.json")).collect()}
    assert got == {"scb": ("http://d.example.org/organisation/SE2021/", "se2021"), "x": (None, None)}


def test_harvest_results(spark):
    text = {"context_id": "7", "info": json.dumps({"u": {iri("es:status"): [node("uri", "http://e/Failed")], iri("dcterms:modified"): [node("literal", "2024-01-01T10:00:00.123Z")]}}),
            "metadata": json.dumps({"m": {iri("dcterms:title"): [node("literal", "Källa")]}})}
    from metaloom.operators.graph import parse_graph
    df = spark.createDataFrame([text], "context_id string, info string, metadata string").select(
        "context_id", parse_graph(F.col("info")).alias("info"), parse_graph(F.col("metadata")).alias("metadata"), F.lit(1).alias("ord"))
    run = links.latest_harvest(registry.harvest_runs(df)).head()
    assert (run["status"], run["harvested"], run["title"]) == ("failed", "2024-01-01T10:00:00", "Källa")


def test_one_row_per_key_and_newest_by_moment(spark, tmp_path):
    """10:00+02:00 is before 09:30+00:00, whatever the text says; a batch may hold a key twice."""
    store = Store(spark, tmp_path / "s")
    old, new = "2024-01-01T10:00:00+02:00", "2024-01-01T09:30:00+00:00"
    store.rebuild(rows(spark, ("c", "1", "u", "dataset", old, 1), ("c", "1", "u", "dataset", new, 2), ("c", "2", "v", "dataset", new, 3)), "t1")
    assert held(store) == {("c", "1"): 2, ("c", "2"): 3}
    store.upsert(rows(spark, ("c", "2", "v", "dataset", old, 4), ("c", "3", "w", "dataset", new, 6), ("c", "3", "w", "dataset", old, 5)), "t2", only_newer=True)
    assert held(store) == {("c", "1"): 2, ("c", "2"): 3, ("c", "3"): 6}
    table = spark.createDataFrame([("u", "a", new)], "url string, status string, checked string")
    store.upsert_table("link_checks", table, "url", latest="checked")
    store.upsert_table("link_checks", table.selectExpr("url", "'b' AS status", f"'{old}' AS checked"), "url", latest="checked")
    assert [r["status"] for r in store.link_checks().collect()] == ["a"]
    since = changed_since(rows(spark, ("c", "1", "u", "dataset", old, 1), ("c", "2", "u", "dataset", new, 2)), "2024-01-01T08:30:00Z")
    assert [r["n"] for r in since.collect()] == [2]


def test_newest_report_of_read_entries(spark, catalogue):
    """Report entries order by page and place, which is no number."""
    made = spark.createDataFrame([("1", "r1", "2024-01-01", ("p", 1)), ("1", "r2", "2024-01-02", ("p", 3)), ("1", "r3", "2024-01-02", ("p", 2))],
                                 "context_id string, report_id string, created string, ord struct<file:string,pos:int>")
    assert [r["report_id"] for r in links.latest_per_context(made).collect()] == ["r3"]
    checks = spark.createDataFrame([("1", "r3", "u"), ("1", "r2", "u")], "context_id string, report_id string, uri string")
    assert build.newest_checks(checks, made).count() == 1
    assert registry.report_entries(catalogue["entries"]).count() == catalogue["entries"].count()


def test_refresh_reads_only_what_it_refers_to(catalogue):
    staged = build.stage_entries(catalogue["entries"])
    one = staged.filter(F.col("uri_of" if "uri_of" in staged.columns else "entry_id") == "1")
    partial = {r["uri"]: r for r in build.records(one, catalogue["labels"], references=staged).collect()}
    whole = {r["uri"]: r for r in build.records(staged, catalogue["labels"]).collect()}
    assert set(partial) == {"urn:d1"} and partial["urn:d1"] == whole["urn:d1"]
    mine, others = build.split_by_entity(one), build.split_by_entity(staged)
    assert build.referred_to(mine, others)["distribution"].count() == 2 and others["distribution"].count() == 3


def test_an_entry_on_two_pages_is_one_record(catalogue):
    twice = catalogue["entries"].unionByName(catalogue["entries"].withColumn("ord", F.struct(F.lit("a").alias("file"), F.col("ord.pos").alias("pos"))))
    made = build.records(build.stage_entries(twice), catalogue["labels"]).collect()
    assert len(made) == 3 and sorted(len(r["distributions"]) for r in made) == [0, 1, 2]


def test_pages_by_place(spark):
    from metaloom.operators.windows import page, page_after

    table = spark.createDataFrame([(i // 3, f"{i:02d}") for i in range(20)], "a int, b string")
    order, last, seen = ["a", "b"], None, []
    while True:
        got = page_after(table, last, 6, order).collect()
        if not got:
            break
        seen += [r["b"] for r in got]
        last = (got[-1]["a"], got[-1]["b"])
    assert seen == [r["b"] for r in page(table, order=order).collect()]


def test_a_deep_page_opens_the_files_it_lies_in(spark):
    from metaloom.operators.windows import Pages

    pages = Pages(spark.range(1_000).selectExpr("cast(id % 7 AS int) AS a", "format_string('%04d', id) AS b"), ["a", "b"], file_rows=60)
    expected = sorted((i % 7, f"{i:04d}") for i in range(1_000))
    assert pages.total == 1_000 and len(pages.files) > 1
    for limit, offset in ((10, 0), (25, 730), (1_000, 0), (5, 998), (5, 1_000), (0, 3), (None, 990), (400, 300)):
        got = [tuple(r) for r in pages.page(limit, offset).collect()]
        assert got == expected[offset:None if limit is None else offset + limit], (limit, offset)
    one = pages.page(3, 61)
    assert len(one.inputFiles()) == 1


def test_a_facet_of_many_values_is_cut_before_its_task(spark):
    from metaloom.operators import facets

    counted = spark.range(9_000).selectExpr("'f' AS facet", "cast(id AS string) AS value", "id % 50 AS count")
    expected = sorted(((-(i % 50), str(i)) for i in range(9_000)))[:3_000]
    got = facets.limited(counted, 3_000)
    assert [r["value"] for r in got.orderBy("rank").collect()] == [v for _, v in expected]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") == 2 and "_share" in plan


def test_a_result_document_keeps_its_order(spark):
    from metaloom.sources.exports import result_document

    window = spark.range(50).repartition(5).selectExpr("concat('u', 99 - id) AS uri", "'c' AS context_id", "cast(id AS string) AS entry_id", "map('en', 'x') AS title")
    facets_ = spark.createDataFrame([("f", "v", 1, 1, {"en": "V"})], "facet string, value string, count bigint, rank int, label map<string,string>")
    omitted = spark.createDataFrame([("f", 2)], "facet string, omitted bigint")
    row = result_document(window, facets_, omitted, total=50).head()
    assert [d["uri"] for d in row["datasets"]] == sorted(f"u{99 - i}" for i in range(50)) and row["datasets"][0]["title"] == {"en": "x"}
