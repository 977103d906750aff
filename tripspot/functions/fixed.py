"""Fixed values. Results depend on them, so they are stated here as plain text."""

# Hourly weather variables of the public forecast format.
WEATHER_FIELDS = (
    "temperature_2m",
    "precipitation",
    "snowfall",
    "wind_speed_10m",
    "relative_humidity_2m",
    "weather_code",
)
NUMERIC_WEATHER_FIELDS = tuple(name for name in WEATHER_FIELDS if name != "weather_code")
WEATHER_LIVE_SOURCE = "Open-Meteo forecast"
WEATHER_FALLBACK_SOURCE = "historical_fallback"
WEATHER_ARCHIVE_SOURCE = "Open-Meteo Historical Forecast API"

# Score thresholds: lower bound (inclusive) of each level, hottest first.
LEVEL_BOUNDS = (("very_hot", 75.0), ("hot", 50.0), ("medium", 25.0), ("low", None))
LEVEL_LABELS = {
    "vi": {"very_hot": "Rất nóng", "hot": "Nóng", "medium": "Trung bình", "low": "Thấp"},
    "en": {"very_hot": "very hot", "hot": "hot", "medium": "medium", "low": "low"},
}
ALERT, NORMAL = "CRITICAL_ANOMALY", "NORMAL"
DISPATCH_REASON = {
    "vi": "Được xếp hạng theo score trung bình của replay",
    "en": "ranked by mean replay score",
}

# WMO weather interpretation codes.
WEATHER_CODE_LABELS = {
    "vi": {
        0: "Trời quang",
        1: "Ít mây",
        2: "Có mây rải rác",
        3: "Nhiều mây",
        45: "Sương mù",
        48: "Sương mù đóng băng",
        51: "Mưa phùn nhẹ",
        53: "Mưa phùn vừa",
        55: "Mưa phùn dày",
        56: "Mưa phùn đóng băng nhẹ",
        57: "Mưa phùn đóng băng dày",
        61: "Mưa nhẹ",
        63: "Mưa vừa",
        65: "Mưa lớn",
        66: "Mưa đóng băng nhẹ",
        67: "Mưa đóng băng lớn",
        71: "Tuyết nhẹ",
        73: "Tuyết vừa",
        75: "Tuyết lớn",
        77: "Hạt tuyết",
        80: "Mưa rào nhẹ",
        81: "Mưa rào vừa",
        82: "Mưa rào mạnh",
        85: "Mưa tuyết nhẹ",
        86: "Mưa tuyết mạnh",
        95: "Dông",
        96: "Dông, mưa đá nhẹ",
        99: "Dông, mưa đá mạnh",
    },
    "en": {
        0: "clear sky",
        1: "mainly clear",
        2: "partly cloudy",
        3: "overcast",
        45: "fog",
        48: "depositing rime fog",
        51: "light drizzle",
        53: "moderate drizzle",
        55: "dense drizzle",
        56: "light freezing drizzle",
        57: "dense freezing drizzle",
        61: "slight rain",
        63: "moderate rain",
        65: "heavy rain",
        66: "light freezing rain",
        67: "heavy freezing rain",
        71: "slight snowfall",
        73: "moderate snowfall",
        75: "heavy snowfall",
        77: "snow grains",
        80: "slight rain showers",
        81: "moderate rain showers",
        82: "violent rain showers",
        85: "slight snow showers",
        86: "heavy snow showers",
        95: "thunderstorm",
        96: "thunderstorm with slight hail",
        99: "thunderstorm with heavy hail",
    },
}
WEATHER_OTHER = {"vi": "Điều kiện thời tiết khác", "en": "other conditions"}
WEATHER_NO_DATA = {"vi": "Không có dữ liệu", "en": "no data"}

EARTH_RADIUS_M = 6_371_000.0

# Places that summed scores are kept to.
SCORE_PLACES = 12
