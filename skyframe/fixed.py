"""Fixed values the results depend on.

FIXED VALUES — these must equal the source system's constants for the
results to agree.  They are listed plainly, in their natural order.
"""

from __future__ import annotations

# FIXED VALUES: area id -> district of the collected history (16 entries).
AREA_DISTRICT = {
    "60198": "昌平",
    "71141": "朝阳",
    "60205": "大兴",
    "71445": "东城",
    "60206": "房山",
    "71142": "丰台",
    "71144": "海淀",
    "60207": "怀柔",
    "60246": "门头沟",
    "60247": "密云",
    "60204": "平谷",
    "71143": "石景山",
    "60202": "顺义",
    "71071": "通州",
    "71446": "西城",
    "60199": "延庆",
}

# FIXED VALUES: the places offered to the user (display names, suffix 区).
PLACES = ["朝阳区", "昌平区", "丰台区", "石景山区", "东城区",
          "西城区", "海淀区", "门头沟区", "房山区", "通州区",
          "顺义区", "大兴区", "怀柔区", "平谷区", "密云区", "延庆区"]

# FIXED VALUES: suffix of a place's display name.
PLACE_SUFFIX = "区"

# FIXED VALUES: collection period (years inclusive) and months.
FIRST_YEAR, LAST_YEAR = 2016, 2024
MONTHS = (1, 12)

# FIXED VALUES: query-string key that carries the area id in a target URL,
# and the width of an area id.
AREA_KEY = "areaInfo%5BareaId%5D"
AREA_ID_WIDTH = 5

# FIXED VALUES: target URL shape (host is a parameter of the caller).
URL_TEMPLATE = ("{base}?areaInfo%5BareaId%5D={area}&areaInfo%5BareaType%5D=2"
                "&date%5Byear%5D={year}&date%5Bmonth%5D={month}")

# FIXED VALUES: header of a history page table (column titles).
PAGE_HEADER = ["日期", "星期", "最高温", "最低温", "天气", "风力风向", "空气质量指数", "空气质量"]

# FIXED VALUES: temperature unit stripped before the integer cast.
DEGREE = "°"

# FIXED VALUES: text standing for a missing air-quality index.
MISSING_AQI = "-"

# FIXED VALUES: air-quality bands, inclusive upper bounds, in order; above
# the last bound the last label applies.
AQI_BOUNDS = [50, 100, 150, 200, 300]
AQI_CLASSES = ["优", "良", "轻度污染", "中度污染", "重度污染", "严重污染"]

# FIXED VALUES: wind axis domain as listed (西南风 and 西北风 appear twice).
WIND_AXIS = ["西南风", "西北风", "东风", "西风", "南风", "北风", "东北风", "东南风", "西南风", "西北风", "无"]

# FIXED VALUES: map value pieces (min, max, label), both ends inclusive.
MAP_PIECES = [
    (31, 40, "30~40℃"),
    (21, 30, "20~30℃"),
    (11, 20, "10~20℃"),
    (1, 10, "0~10℃"),
    (-10, 0, "-10~0℃"),
]

# FIXED VALUES: display label -> stored column.
LABEL_COLUMNS = {
    "最高温": "max_t",
    "最低温": "min_t",
    "天气": "weather",
    "风向": "wind",
    "空气质量指数": "aqi",
    "空气质量": "aqi_type",
}

# FIXED VALUES: weekday names, Sunday first.
WEEKDAYS = ["周日", "周一", "周二", "周三", "周四", "周五", "周六"]


def dedup(seq):
    """Keep first occurrences, in order."""
    seen, out = set(), []
    for x in seq:
        if x not in seen:
            seen.add(x)
            out.append(x)
    return out


WIND_DOMAIN = dedup(WIND_AXIS)
