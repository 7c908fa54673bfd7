"""Hand-made documents and rows."""

from datetime import datetime

RESULT = "<RESULT><RESULT.CODE>{code}</RESULT.CODE><RESULT.MESSAGE>ok</RESULT.MESSAGE></RESULT>"
PEOPLE = {
    "AREA_CONGEST_LVL": "보통", "AREA_CONGEST_MSG": "fine", "AREA_PPLTN_MIN": "100", "AREA_PPLTN_MAX": "200",
    "MALE_PPLTN_RATE": "48.5", "FEMALE_PPLTN_RATE": "51.5", "RESNT_PPLTN_RATE": "*",
    "NON_RESNT_PPLTN_RATE": "\\N", "PPLTN_TIME": "2024-03-01 00:30",
}
SKY = {
    "WEATHER_TIME": "2024-03-01 00:20", "TEMP": "-3.5", "HUMIDITY": "40", "PRECIPITATION": "-",
    "PRECPT_TYPE": "없음", "WIND_SPD": "1.2", "PM10": "30", "PM25": "12", "AIR_IDX": "좋음",
    "AIR_MSG": "air", "PCP_MSG": "rain", "UV_MSG": "uv",
}


def element(name, inner):
    return f"<{name}>{inner}</{name}>"


def fields(values):
    return "".join(element(k, v) for k, v in values.items() if v is not None)


def people(**changes):
    return element("LIVE_PPLTN_STTS", fields({**PEOPLE, **changes}))


def sky(**changes):
    return element("WEATHER_STTS", fields({**SKY, **changes}))


def document(area="POI001", name="Station", inner=None, weather=None, code="INFO-000", city=None):
    if city is None:
        block = element("LIVE_PPLTN_STTS", people() if inner is None else inner)
        air = element("WEATHER_STTS", sky() if weather is None else weather)
        city = fields({"AREA_CD": area, "AREA_NM": name}) + block + air
    body = RESULT.format(code=code) + element("CITYDATA", city)
    return element("SeoulRtd.citydata", body)


def call(raw_id, xml, at="2024-02-29 15:40:00", status=200, source="seoul_realtime_city", asked="Asked"):
    moment = datetime.fromisoformat(at)
    return (raw_id, source, asked, moment, moment, status, xml)


CALL_SCHEMA = (
    "raw_id long, source_name string, request_area_name string, requested_at timestamp, "
    "received_at timestamp, http_status int, payload_xml string"
)


def landing(spark, calls):
    return spark.createDataFrame(calls, CALL_SCHEMA)
