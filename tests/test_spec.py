import pytest

from shardloom.spec import FieldMapping, IndexSpec, SpecError, TypeSpec, separator_from_token


def test_separator_tokens():
    assert separator_from_token("u0001") == "\x01"
    assert separator_from_token(",abc") == ","


def test_routing_field_must_exist():
    with pytest.raises(SpecError):
        TypeSpec("t", ("a", "b"), routing_field="c")


def test_partition_field_in_every_type():
    t1 = TypeSpec("t1", ("year", "a"))
    t2 = TypeSpec("t2", ("b",))
    with pytest.raises(SpecError):
        IndexSpec("ix", 3, (t1, t2), partition_fields=("year",))


def test_bad_specs():
    with pytest.raises(SpecError):
        IndexSpec("ix", 0, ())
    with pytest.raises(SpecError):
        TypeSpec("t", ("a",), field_sep=",,")
    with pytest.raises(SpecError):
        TypeSpec("t", ("_a",))
    with pytest.raises(SpecError):
        FieldMapping("a", "integer", "analyzed")
    with pytest.raises(SpecError):
        TypeSpec("t", ("a",), mapping={"b": "long"})


def test_round_trip():
    t = TypeSpec("reading", ("station", "region", "celsius", "taken"), field_sep=";",
                 routing_field="station", mapping={"celsius": "double", "taken": "timestamp"}, input_path="/readings")
    ix = IndexSpec("weather", 6, (t,), partition_fields=("region",))
    assert IndexSpec.from_dict(ix.to_dict()) == ix


def test_cli_builds_from_a_json_spec(spark, tmp_path):
    import json

    from shardloom.__main__ import main
    from shardloom.sinks.documents import read_documents
    from shardloom.sources import fixtures as fx
    from shardloom.sources.lines import write_lines
    from tests.conftest import SF_SMALL

    src = str(tmp_path / "in")
    write_lines(fx.events_lines(spark, SF_SMALL), src)
    t = TypeSpec("event", fx.EVENT_TYPE.field_names, input_path=src, field_sep=",", routing_field="uid")
    spec = IndexSpec("events", 3, (t,), partition_fields=("year", "month", "day"))
    path = tmp_path / "job.json"
    path.write_text(json.dumps(spec.to_dict()))
    assert main(["build", str(path), str(tmp_path / "out"), "--quarantine", "--publish", str(tmp_path / "live")]) == 0
    assert read_documents(spark, str(tmp_path / "live")).count() > 0


def test_mapping_as_a_search_index_states_it():
    import json

    exact = [{"all": {"match": "*", "match_mapping_type": "string", "mapping": {"type": "string", "index": "not_analyzed"}}}]
    shape = {"reading": {"dynamic_templates": exact, "properties": {"celsius": {"type": "double"}, "note": {"type": "string", "index": "analyzed"}}}}
    for mapping in (shape, json.dumps(shape), shape["reading"], {"celsius": {"type": "double"}, "note": {"type": "string", "index": "analyzed"}}):
        t = TypeSpec("reading", ("celsius", "note"), mapping=mapping)
        assert t.mapping == (FieldMapping("celsius", "double"), FieldMapping("note", "string", "analyzed"))
    for bad in ({"reading": {"properties": {"note": {"type": "string", "analyzer": "x"}}}}, {"reading": {"properties": {}, "_ttl": {}}},
                {"reading": {"dynamic_templates": [{"all": {"mapping": {"type": "long", "store": True}}}], "properties": {}}},
                {"reading": {"dynamic_templates": [{"all": {"match": "*", "path": "x", "mapping": {}}}], "properties": {}}},
                {"reading": {"dynamic_templates": [{"all": {"match": "(", "match_pattern": "regex", "mapping": {}}}], "properties": {}}},
                {"reading": {"dynamic_templates": [{"all": {"mapping": {"type": "long", "index": "analyzed"}}}], "properties": {}}}):
        with pytest.raises(SpecError):
            TypeSpec("reading", ("celsius", "note"), mapping=bad)


def test_cli_reads_feed_options(spark, tmp_path):
    import json

    from shardloom.__main__ import main
    from shardloom.sinks import documents as sk
    from shardloom.sources import lines as ln

    feed = spark.createDataFrame([("1,a b",), ("2," + "x" * 50,), ("3,c",)], "value string")
    ln.write_lines(feed, str(tmp_path / "in"), line_sep=";", compression="gzip")
    spec = IndexSpec("notes", 3, (TypeSpec("note", ("k", "text"), field_sep=",", key_fields=("k",), input_path=str(tmp_path / "in"), record_sep=";",
                                           max_line_bytes=20, mapping={"note": {"properties": {"text": {"index": "analyzed"}}}}),), unrouted="random")
    assert IndexSpec.from_dict(json.loads(json.dumps(spec.to_dict()))) == spec
    (tmp_path / "job.json").write_text(json.dumps(spec.to_dict()))
    out = str(tmp_path / "out")
    assert main(["build", str(tmp_path / "job.json"), out, "--postings", "--id-mode", "key"]) == 0
    docs = sk.active_documents(spark, out)
    assert sorted(json.loads(r.doc)["k"] for r in docs.collect()) == ["1", "3"] and {r.shard for r in docs.collect()} <= {0, 1, 2}
    assert sorted(r.term for r in sk.active_table(spark, out, "postings").where("field = 'text'").collect()) == ["b", "c"]


def test_the_first_template_that_fits_decides(spark, tmp_path):
    from shardloom import FieldTemplate, build_index
    from shardloom.operators import postings as po

    rules = [{"ids": {"match": "*_id", "unmatch": "x*", "mapping": {"type": "long"}}},
             {"floats": {"path_match": "m.*", "match_pattern": "regex", "mapping": {"type": "double", "index": "no"}}},
             {"numbers": {"match_mapping_type": "long", "mapping": {"type": "integer"}}},
             {"rest": {"match": "*", "match_mapping_type": "string", "mapping": {"type": "{dynamic_type}", "index": "analyzed"}}}]
    t = TypeSpec("t", ("k", "a_id", "x_id", "mass", "a.b*c", "note"), field_sep=",", routing_field="k", key_fields=("k",),
                 mapping={"properties": {"note": {"type": "string", "index": "no"}, "k": {"type": "string"}}, "dynamic_templates": rules})
    assert {n: (m.data_type, m.index_mode) for n, m in t.field_mapping().items()} == {
        "k": ("string", "not_analyzed"), "note": ("string", "no"), "a_id": ("long", "not_analyzed"), "x_id": ("string", "analyzed"),
        "mass": ("double", "no"), "a.b*c": ("string", "analyzed")}
    assert TypeSpec.from_dict(t.to_dict()) == t
    assert po.text_fields(t) == ["x_id", "a.b*c"] and po.keyword_fields(t) == ["k", "a_id"]
    # a star stands for any text and nothing else is special
    assert FieldTemplate("f", match="a.*c").fits("a.bc") and not FieldTemplate("f", match="a.*c").fits("abc")
    assert FieldTemplate("f", match="*").fits("") and not FieldTemplate("f", match="a*").fits("ba")
    u = TypeSpec("t", ("k", "n_id", "mass"), field_sep=",", routing_field="k", key_fields=("k",), mapping={"dynamic_templates": rules})
    lines = {"t": spark.createDataFrame([("1,5,2.5",), ("2,x,1",), ("3,,",)], "value string")}
    res = build_index(spark, IndexSpec("ix", 2, (u,)), str(tmp_path / "out"), inputs=lines, mode="quarantine")
    assert [r.reason for r in res.rejected.collect()] == ["coercion:n_id"]
    assert {r.field: (r.data_type, r.origin) for r in res.mapping.collect()} == {
        "k": ("string", "template"), "n_id": ("long", "template"), "mass": ("double", "template")}
