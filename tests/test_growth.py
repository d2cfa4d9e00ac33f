"""How much plans do, by the rows their nodes hand on or the bytes they leave: work must grow with the input."""

from pyspark.sql import functions as F

from metaloom.operators import publishers, vocabulary
from metaloom.operators.entities import with_entities
from metaloom.operators.graph import (described, objects, parse_graph, text_map, uris, values, with_envelope, with_subject,
                                      word_map)
from metaloom.plans import build
from metaloom.plans.queries_entities import contact_entries
from metaloom.plans.standins import Tables
from metaloom.sources import registry


def handed_on(df, *names):
    """Rows that nodes of these names gave, in all, after `df` has run."""
    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        children = node.children()
        mine = node.metrics().apply("numOutputRows").value() if name in names else 0
        return mine + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def one_publisher(spark, agents):
    """Agents of one id, and a table that gives this id as many aliases; half of its URIs are in use."""
    numbers = spark.range(agents)
    uri = F.concat(F.lit("urn:a:"), "id")
    texts = F.array().cast("array<string>")
    rows = numbers.select(F.lit("org").alias("id"), uri.alias("uri"), F.lit(1).alias("records"), F.struct(
        F.create_map(F.lit("en"), F.concat(F.lit("Name "), "id")).alias("name"), texts.alias("identifiers")).alias("agent"))
    table = numbers.select(F.lit("org").alias("id"), F.when(F.col("id") % 2 == 0, uri).otherwise(F.concat(F.lit("urn:x:"), "id")).alias("uri"),
                           F.concat(F.lit("Alias "), "id").alias("alias"), F.lit(None).cast("string").alias("org_no"))
    return rows, table


def test_aliases_are_stated_once_for_an_id(spark):
    agents, table = one_publisher(spark, 1000)
    keys = publishers.name_keys(agents, table)
    assert {tuple(r) for r in keys.filter("key IN ('org', 'urn:a:7', 'alias_7', 'name_7')").collect()} == {
        ("org", "org", 0), ("alias_7", "org", 1), ("urn:a:7", "org", 2), ("name_7", "org", 4)}
    assert len(keys.collect()) == 3001
    assert handed_on(keys, "Generate") < 20_000


def test_aliases_of_a_table_meet_an_id_folded(spark):
    agents, table = one_publisher(spark, 1000)
    asked = spark.createDataFrame([("ALIAS 8",), ("alias_9",), ("org",), ("nobody",)], "value string")
    no_names = agents.select("uri", "id").withColumnRenamed("uri", "key")
    found = publishers.resolve(asked, no_names, table)
    assert {tuple(r) for r in found.collect()} == {
        ("ALIAS 8", "org", True), ("alias_9", "org", True), ("org", "org", True), ("nobody", None, False)}
    assert handed_on(found, "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin") < 20_000


def test_staged_entries_leave_their_graphs_behind(spark):
    rows = contact_entries(Tables(spark, "/root/testdata/sf0.001")).limit(6)
    places = F.explode(F.array(*[F.struct(F.lit(file).alias("file"), F.lit(0).alias("pos")) for file in ("b", "a")]))
    entries = rows.select("context_id", "entry_id", "rights", "metadata", "info", places.alias("ord"))
    plan = build.one_per_entry(with_entities(with_envelope(entries), keep=["ord", "harvested"]))
    staged = build.stage_entries(entries)
    for held in (plan, staged):
        assert not any("map<string,map" in kind for _, kind in held.dtypes)
    assert {(r["uri"], r["email"]) for r in build.contacts(staged).collect()} == {
        (f"urn:contact:{i}", f"e{i}@example.org") for i in (int(r[0]) for r in rows.select("entry_id").collect())}
    assert staged.count() == 6 and {r[0] for r in staged.select("ord.file").collect()} == {"b"}


def test_reports_are_packed_into_few_files(spark, tmp_path):
    """However many contexts have a report; each one reads as it does from a file of its own."""
    bodies = {"a": '[{"uri": "u", "status": "broken"}, {"uri": ""}]', "b": '[{"uri": "v"', "c": ' []', "d": '{"uri": "w"}'}
    for name, body in bodies.items():
        (tmp_path / "files" / name).mkdir(parents=True)
        (tmp_path / "files" / name / "r.json").write_text(body)
    packed, more = str(tmp_path / "packed"), 2000
    few = spark.createDataFrame([(f"{name}/r.json", body) for name, body in bodies.items()], "file string, text string")
    many = spark.range(more).select(F.concat(F.lit("m"), "id", F.lit("/r.json")).alias("file"), F.lit('[{"uri": "m"}]').alias("text"))
    registry.pack_reports(few.unionByName(many), packed)
    assert len(list((tmp_path / "packed").glob("*.parquet"))) < 20
    ours, theirs = registry.read_packed_checks(spark, packed), registry.read_link_checks(spark, str(tmp_path / "files" / "*" / "*.json"))
    assert ours[0].filter("uri = 'm'").count() == more
    assert ours[0].filter("uri <> 'm'").collect() == theirs[0].collect() and theirs[0].count() == 1
    assert {r[0] for r in ours[1].collect()} == {"b/r.json", "d/r.json"}
    assert {r[0][-8:] for r in theirs[1].collect()} == {"b/r.json", "d/r.json"}


def test_an_entry_is_read_in_few_steps(spark):
    """Texts, graphs, envelope and subject, one step each; an envelope's date that nobody asks for is not read."""
    rows = with_subject(contact_entries(Tables(spark, "/root/testdata/sf0.001")), "contact").select("entry_id", "uri")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 4 and "terms/modified" not in plan
    assert {r["uri"] for r in rows.collect()} == {f"urn:contact:{r['entry_id']}" for r in rows.collect()}


def test_a_uri_is_looked_up_once_however_many_rows_name_it(spark):
    """Of the joins, one hands on all rows; the lookups of spellings see each different URI once."""
    labels = spark.createDataFrame([("http://v.example.org/a", {"en": "Big thing"}, "1")], "uri string, label map<string,string>, ord string")
    uris = ["http://v.example.org/a", "https://v.example.org/a/", "http://v.example.org/c/Other-Thing", "", None]
    rows = spark.range(5000).select("id", F.get(F.array(*map(F.lit, uris)), (F.col("id") % 5).cast("int")).alias("uri"), F.lit("old").alias("slug"))
    for found, last in ((vocabulary.with_slug(rows, "uri", labels), "other_thing"), (vocabulary.with_labels(rows, "uri", labels).select(
            "id", "uri", F.try_element_at("label", F.lit("en")).alias("slug")), None)):
        named = found.collect()
        expected = ["big_thing", "big_thing"] if last else ["Big thing", "Big thing"]
        assert sorted((r["id"], r["slug"]) for r in named if r["id"] < 5) == list(enumerate([*expected, last, None, None])) and len(named) == 5000
        assert handed_on(found, "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin") < 6000


def test_what_is_not_wanted_is_classified_and_left(spark):
    """Staging for services reads no datasets, but an entry that became a dataset on a later page is no service any more."""
    def graph(subject, kind):
        return f'{{"{subject}": {{"http://www.w3.org/1999/02/22-rdf-syntax-ns#type": [{{"type": "uri", "value": "{kind}"}}]}}}}'

    service, dataset = "http://www.w3.org/ns/dcat#DataService", "http://www.w3.org/ns/dcat#Dataset"
    rows = [("1", "a", service), ("1", "b", dataset), ("2", "a", dataset), ("2", "b", service), ("3", "a", dataset)]
    info = '{{"urn:e:{0}": {{"http://entrystore.org/terms/resource": [{{"type": "uri", "value": "urn:r:{0}"}}]}}}}'
    texts = spark.createDataFrame([(n, f, graph(f"urn:r:{n}", kind), info.format(n)) for n, f, kind in rows], "entry_id string, file string, m string, i string")
    entries = texts.select(F.lit("c").alias("context_id"), "entry_id", F.array(F.lit("readmetadata")).alias("rights"), parse_graph(F.col("m")).alias("metadata"),
                           parse_graph(F.col("i")).alias("info"), F.struct("file", F.lit(0).alias("pos")).alias("ord"))
    staged = build.stage_entries(entries, wanted=build.SERVICES)
    assert [r[0] for r in build.projected(staged, "data_service").select("uri").collect()] == ["urn:r:2"] and staged.count() == 1
    assert "dataset" not in staged.columns and "distribution" not in staged.columns
    narrow = build.stage_entries(entries, wanted=build.REFERENCES)
    assert len(narrow.select("dataset.*").columns) == 4 and narrow.count() == 3


def test_short_lists_need_no_function_per_element(spark):
    """Lists of one or two objects give what longer ones would."""
    texts = {"none": "[]", "one": '[{"type":"literal","value":"a","lang":"en"}]',
             "same": '[{"type":"literal","value":"","lang":"sv"},{"type":"literal","value":"b","lang":"sv"}]',
             "two": '[{"type":"literal","value":"","lang":"sv"},{"type":"literal","value":"b","lang":"en-GB"}]',
             "odd": '[{"type":"literal","value":"a","lang":""},{"type":"literal","value":"b","xml:lang":"fi"}]',
             "uris": '[{"type":"uri","value":"u"},{"type":"uri","value":"v"}]', "mixed": '[{"type":"literal","value":"a"},{"type":"uri","value":"v"}, null]'}
    rows = spark.createDataFrame([(n, f'{{"s":{{"p://p":{t}}}}}') for n, t in texts.items()], "name string, text string")
    nodes = objects(described(parse_graph(F.col("text")), F.lit("s")), "p://p")
    found = {r["name"]: (r["t"], r["w"], r["u"], r["v"]) for r in rows.select("name", text_map(nodes).alias("t"), word_map(nodes).alias("w"), uris(nodes).alias("u"), values(nodes).alias("v")).collect()}
    assert found == {"none": ({}, {}, [], []), "one": ({"en": "a"}, {"en": ["a"]}, [], ["a"]), "same": ({}, {"sv": ["", "b"]}, [], ["", "b"]),
                     "two": ({"en": "b"}, {"sv": [""], "en": ["b"]}, [], ["", "b"]), "odd": ({"sv": "a"}, {"sv": ["a", "b"]}, [], ["a", "b"]),
                     "uris": ({}, {}, ["u", "v"], []), "mixed": ({"sv": "a"}, {"sv": ["a"]}, ["v"], ["a"])}
