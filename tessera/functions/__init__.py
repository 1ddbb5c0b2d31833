"""Column-expression building blocks shared by the operators."""

from tessera.functions.geometry import nearest_center, nearest_center_array, squared_distance
from tessera.functions.recode import (
    age_band,
    minutes_to_hours,
    row_sum,
    sex_band,
    working_band,
)
from tessera.functions.tags import tag_index
from tessera.functions.text import has_token, matching_terms, tokens

__all__ = [
    "age_band", "has_token", "matching_terms", "minutes_to_hours", "nearest_center", "nearest_center_array",
    "row_sum", "sex_band", "squared_distance", "tag_index", "tokens", "working_band",
]
