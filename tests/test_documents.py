import hashlib
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from makers import call, document, element, landing, people, sky
from snapfold.functions import xml_json
from snapfold.operators import documents, facts, gates
from snapfold.sources import landing as source

BAD = {
    "not xml": ("hello", ["xml_parse_failed", "not_success"]),
    "truncated": (document()[:-40], ["xml_parse_failed", "not_success"]),
    "trailing": (document() + "rest", ["xml_parse_failed", "not_success"]),
    "no payload": (None, ["payload_missing", "not_success"]),
    "error root": ("<RESULT><CODE>ERROR-500</CODE><MESSAGE>x</MESSAGE></RESULT>", ["not_success", "envelope_missing"]),
    "bad code": (document(code="INFO-200"), ["not_success", "bad_result_code"]),
    "empty city": (document(city=""), ["not_success", "citydata_missing"]),
    "no area": (document(area=None), ["citydata_key_missing"]),
    "blank name": (document(name="  "), ["citydata_key_missing"]),
    "no block": (document(city="<AREA_CD>A</AREA_CD><AREA_NM>N</AREA_NM>"), ["citydata_key_missing"]),
    "text block": (document(inner="closed"), ["population_container"]),
    "two records": (document(inner=people() + people()), ["population_object"]),
    "empty record": (document(inner="<LIVE_PPLTN_STTS/>"), ["population_object"]),
    "no level": (document(inner=people(AREA_CONGEST_LVL="")), ["population_key_missing"]),
    "no min": (document(inner=people(AREA_PPLTN_MIN=None)), ["population_key_missing"]),
    "no max": (document(inner=people(AREA_PPLTN_MAX="")), ["population_key_missing"]),
    "no time": (document(inner=people(PPLTN_TIME="")), ["population_key_missing"]),
    "min 12.0": (document(inner=people(AREA_PPLTN_MIN="12.0")), ["population_not_int"]),
    "min abc": (document(inner=people(AREA_PPLTN_MIN="abc")), ["population_not_int"]),
    "min above max": (document(inner=people(AREA_PPLTN_MIN="201")), ["population_range"]),
    "bad time": (document(inner=people(PPLTN_TIME="yesterday")), ["population_time"]),
    "bad ratio": (document(inner=people(MALE_PPLTN_RATE="abc")), ["ratio_not_number"]),
}
GOOD = {
    "plain": document(),
    "prolog": '<?xml version="1.0"?>\n<!-- c -->' + document() + "\n",
    "spaces": document(inner=people(AREA_PPLTN_MIN=" 12 ")),
    "equal": document(inner=people(AREA_PPLTN_MIN="200")),
    "unpadded time": document(inner=people(PPLTN_TIME="2024-3-1 0:30")),
    "wide spaces": document(name="　Station "),
    "extra elements": document().replace("</CITYDATA>", "<SUB><LINE>2</LINE></SUB></CITYDATA>"),
}


def gated(spark, docs, **options):
    calls = [call(i, xml, **options) for i, xml in enumerate(docs)]
    raw = documents.classify(landing(spark, calls), with_payload=False, keep_parts=True)
    return gates.document_gate(raw)


def test_each_broken_document_has_its_reasons(spark):
    rows = gated(spark, [xml for xml, _ in BAD.values()]).orderBy("raw_id").collect()
    found = {name: row.reasons for name, row in zip(BAD, rows)}
    assert found == {name: reasons for name, (_, reasons) in BAD.items()}


def test_good_documents_pass(spark):
    valid = gates.accepted(gated(spark, GOOD.values()))
    rows = documents.populations(valid, F.current_timestamp(), with_call=True).orderBy("ingestion_id").collect()
    assert len(rows) == len(GOOD)
    assert [r.population_min for r in rows] == [100, 100, 12, 200, 100, 100, 100]
    assert {str(r.observed_at) for r in rows} == {"2024-02-29 15:30:00"}
    assert {r.date_key for r in rows} == {20240301}
    assert {r.area_name for r in rows} == {"Station"}
    assert rows[0].male_ratio == Decimal("48.50") and rows[0].resident_ratio is None and rows[0].non_resident_ratio is None


def test_status_and_source_decide(spark):
    assert gated(spark, [document()], status=500).first().reasons == ["not_success"]
    assert gated(spark, [document()], source="other").first().reasons == ["wrong_source"]


def test_batch_with_a_broken_document_can_be_refused(spark):
    mixed = gated(spark, [document(), document(area=None)])
    assert gates.accepted(mixed).count() == 1
    try:
        gates.require_clean(mixed)
        raise AssertionError("a broken batch passed")
    except gates.GateError as error:
        assert "citydata_key_missing" in str(error)


def test_weather_is_optional_but_checked(spark):
    docs = [
        document(), document(weather=""), document(weather="<WEATHER_STTS/>"), document(weather=sky() + sky()),
        document(weather=sky(WEATHER_TIME="")), document(weather=sky(WEATHER_TIME="noon")),
        document(weather=sky(TEMP="abc")), document(weather=sky(TEMP="-", PM10="없음", PCP_MSG=None)),
        document(weather=sky(TEMP="12345")),
    ]
    valid = gates.accepted(gated(spark, docs))
    assert gates.weather_skipped(valid).first()["weather_skipped"] == 3
    checked = gates.weather_gate(valid)
    reasons = {r.raw_id: r.reason for r in gates.rejected(checked).collect()}
    assert reasons == {4: "weather_time", 5: "weather_time", 6: "weather_number", 8: "weather_number"}
    rows = {r.ingestion_id: r for r in documents.weathers(gates.accepted(checked), F.current_timestamp()).collect()}
    assert set(rows) == {0, 7}
    assert rows[0].temperature_c == Decimal("-3.50") and rows[0].precipitation_mm is None
    assert rows[0].weather_description == "air\nrain\nuv"
    assert rows[7].temperature_c is None and rows[7].pm10 is None and rows[7].weather_description == "air\nuv"
    assert str(rows[0].observed_at) == "2024-02-29 15:20:00"


def test_every_call_is_kept_with_its_outcome(spark):
    calls = [call(1, document(name="")), call(2, BAD["error root"][0]), call(3, "hello")]
    raw = documents.classify(landing(spark, calls)).orderBy("raw_id").collect()
    assert [r.area_name for r in raw] == ["Asked", "Asked", "Asked"]
    assert [r.result_code for r in raw] == ["INFO-000", "ERROR-500", None]
    assert [r.error_message for r in raw] == [None, None, "xml_parse_failed"]
    assert [r.payload is None for r in raw] == [False, False, True]
    assert raw[0].payload_hash == hashlib.sha256(raw[0].payload.encode()).hexdigest()


def test_xml_becomes_nested_json():
    xml = '<a x="1"><b>1</b><b> 012 </b><c/><d><e>가</e>text</d><f>  </f></a>'
    expected = {"a": {"@x": "1", "b": ["1", "012"], "c": None, "d": {"e": "가", "#text": "text"}, "f": None}}
    canonical = xml_json._canonical(xml)
    assert json.loads(canonical) == expected
    assert canonical.startswith('{"a":{"@x":"1","b":["1","012"],') and "가" in canonical
    assert xml_json._canonical("<a><b></a>") is None
    assert xml_json._canonical('<!DOCTYPE a [<!ENTITY x "y">]><a>&x;</a>') is None


def test_repeated_outer_blocks_are_no_object(spark):
    city = "<AREA_CD>A</AREA_CD><AREA_NM>N</AREA_NM>" + element("LIVE_PPLTN_STTS", people()) * 2
    assert gated(spark, [document(city=city)]).first().reasons == ["population_container"]


def test_json_feed(spark):
    record = {
        "PPLTN_TIME": "2024-05-06 07:08:00", "AREA_CONGEST_LVL": "calm",
        "AREA_PPLTN_MIN": "17", "AREA_PPLTN_MAX": "23",
    }
    city = {"AREA_NM": "Harbour", "AREA_CD": "H1", "LIVE_PPLTN_STTS": [record, {}]}
    bodies = [{"CITYDATA": city}, {"CITYDATA": {**city, "LIVE_PPLTN_STTS": []}}, {"CITYDATA": None}]
    rows = [(i, json.dumps(b), "asked", "Asked", True) for i, b in enumerate(bodies)] + [(3, "{x", "G", "G", True)]
    df = spark.createDataFrame(rows, "raw_id long, payload string, area_code string, area_name string, is_success boolean")
    checked = gates.json_gate(documents.read_json_documents(df.withColumn("received_at", F.current_timestamp())))
    reasons = {r.raw_id: r.reason for r in gates.rejected(checked).collect()}
    assert reasons == {1: "population_container", 2: "citydata_missing", 3: "json_parse_failed"}
    row = documents.json_populations(gates.accepted(checked)).first()
    assert (row.area_code, row.population_max, str(row.observed_at)) == ("H1", 23, "2024-05-05 22:08:00")


def test_acceptance_equals_the_strict_parser(spark):
    """Whether a text is one document: the reader plus what is read off the text, beside expat."""
    good = document()
    root = "SeoulRtd.citydata"
    texts = [
        good, good + "\n" * 500, good + "<x/>", good + "garbage -->", good + good, f"{good}<{root}/>", good + "<!-- a --> b -->",
        good + "<!-- a -- b -->", good + "<!-- a --><!-- b -->\n<?p q?>", "<!-- <foo> -->" + good, "<?style <b>?>" + good, "\n " + good,
        good.replace(f"</{root}>", f"</{root} >"), "x" + good, f"<!DOCTYPE {root}>" + good, "<a/>", "<a b='c'/> ", "<a/><b/>", "<a><a></a></a>",
        "<a><a/></a>", "<a></a><a></a>", "", " ", "<a>", "</a>", "<a></b>", "<?xml version='1.0'?>" + good, good + "<!-- open", "<ab></ab><a></a>",
        "<a><ab></ab></a>", good.replace(f"</{root}>", f"<!-- <{root}> --></{root}>"), good.replace(f"</{root}>", f"<!-- </{root}> --></{root}>"),
        good.replace(f"</{root}>", f"<X><![CDATA[<{root}>]]></X></{root}>"), good + f"<!-- <{root}></{root}> -->", "<a><a /></a>", "<a><a b='c'/></a>",
        f"<!DOCTYPE {root} SYSTEM 'x>y'>" + good, f'<!DOCTYPE {root} [<!-- don\'t ] --><!ELEMENT a ANY>]>' + good, f"<!DOCTYPE {root} SYSTEM 'x>" + good,
        good.replace(f"</{root}>", f"<?p </{root}> ?></{root}>"), "<a><![CDATA[</a>]]>", "<!-- " + "c" * 100_000 + " -->" + good + "<!-- " + "-c" * 100_000 + " -->",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "raw_id long, payload_xml string")
    found = documents.read_documents(df).select("raw_id", "well_formed", xml_json.xml_to_json("payload_xml").isNotNull().alias("strict"))
    assert [(r.raw_id, r.well_formed) for r in found.orderBy("raw_id").collect()] == [
        (r.raw_id, r.strict) for r in found.orderBy("raw_id").collect()]


def test_repeated_fields_are_refused(spark):
    twice = people() + "<X/>"
    cases = {
        "field_repeated": document(inner=people().replace("</LIVE_PPLTN_STTS>", "<AREA_PPLTN_MIN>1</AREA_PPLTN_MIN></LIVE_PPLTN_STTS>")),
        "citydata_key_missing": document(city="<AREA_CD>a</AREA_CD><AREA_CD>b</AREA_CD><AREA_NM>n</AREA_NM><LIVE_PPLTN_STTS>" + people() + "</LIVE_PPLTN_STTS>"),
        None: document(inner=twice),
    }
    rows = [call(i, xml) for i, xml in enumerate(cases.values())]
    gated = gates.document_gate(documents.classify(landing(spark, rows), with_payload=False, keep_parts=True))
    found = {r.raw_id: r.reasons for r in gated.collect()}
    assert [(found[i] or [None])[0] for i in range(3)] == list(cases)
    assert "field_repeated" in found[1]


def test_area_counts_and_record_files(spark, tmp_path):
    active = spark.range(3)
    assert gates.require_area_count(active, 3) is active
    for areas, expected in ((active, 8), (active.limit(0), 3)):
        with pytest.raises(gates.GateError):
            gates.require_area_count(areas, expected)
    (tmp_path / "many.xml").write_text("<all><row><A>1</A></row><row><A>2</A></row></all>")
    assert sorted(r.A for r in source.read_records(spark, str(tmp_path), "row", "A string").collect()) == ["1", "2"]


def test_weather_view_takes_successful_calls_only(spark):
    at = F.lit("2024-03-01").cast("timestamp")
    header = spark.createDataFrame([(1, True), (2, False)], "ingestion_id long, is_success boolean").withColumn("collected_at", at)
    weather = spark.createDataFrame([(1, 3), (2, 4), (5, 6)], "ingestion_id long, pm10 int")
    assert [(r.ingestion_id, r.pm10) for r in facts.weather_view(weather, header).collect()] == [(1, 3)]
