"""Text labels of weather codes."""

from pyspark.sql import Column, functions as F

from tripspot.functions.fixed import WEATHER_CODE_LABELS, WEATHER_NO_DATA, WEATHER_OTHER


def weather_label(code, lang="vi") -> Column:
    """A constant map is enough for 28 codes: no join, no shuffle."""
    value = F.col(code) if isinstance(code, str) else code
    pairs = [F.lit(item) for entry in WEATHER_CODE_LABELS[lang].items() for item in entry]
    known = F.try_element_at(F.create_map(*pairs), value.try_cast("int"))
    return F.when(value.isNull(), WEATHER_NO_DATA[lang]).otherwise(F.coalesce(known, F.lit(WEATHER_OTHER[lang])))
