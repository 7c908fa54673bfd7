"""The feed's formats, codes, labels and sentinels.

Nothing here is logic. Each value is a fact about the document feed or about the
warehouse contract, and results are only right if it is exactly this.
"""

# Document envelope
SUCCESS_ROOT = "SeoulRtd.citydata"
ERROR_ROOT = "RESULT"
SUCCESS_CODE = "INFO-000"
SOURCE_NAME = "seoul_realtime_city"

# Clocks: the feed's texts are local time of this zone, instants are stored.
BUSINESS_ZONE = "Asia/Seoul"
MINUTE_PATTERN = "yyyy-M-d H:m"

# Congestion labels and the mart column each one is counted in
CONGESTION_COUNTS = {
    "여유": "relaxed_count",
    "보통": "normal_count",
    "약간 붐빔": "slightly_crowded_count",
    "붐빔": "crowded_count",
    "매우 붐빔": "very_crowded_count",
}

# Precipitation type that means "no rain"
NO_PRECIPITATION = "없음"

# Texts that mean "no value" in weather numbers and in population ratios
WEATHER_NULL_TEXTS = ("", "-", "없음", "null", "None")
RATIO_NULL_TEXTS = ("", "*", "\\N")

# Number of active areas the collection run expects
EXPECTED_AREAS = 8

# White space cut from both ends of a document text
WHITE_SPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
