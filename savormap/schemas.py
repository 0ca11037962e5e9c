"""Declared schemas of the input tables and of the messages."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_TEXT, _NUMBER, _WHOLE = T.StringType(), T.DoubleType(), T.IntegerType()

REVIEWS = _struct(
    ("user_id", _TEXT),
    ("business_id", _TEXT),
    ("stars", _NUMBER),
    ("text", _TEXT),
    ("date", T.TimestampType()),
)
PLACES = _struct(
    ("business_id", _TEXT),
    ("name", _TEXT),
    ("address", _TEXT),
    ("city", _TEXT),
    ("latitude", _NUMBER),
    ("longitude", _NUMBER),
    ("stars", _NUMBER),
    ("hours", _TEXT),
)
PHOTOS = _struct(("business_id", _TEXT), ("photo_id", _TEXT), ("caption", _TEXT))
LABELLED_TEXT = _struct(("text", _TEXT), ("aspect_category", _TEXT), ("polarity", _TEXT))
USER_FEATURES = _struct(("user_id", _TEXT), ("user_feature", T.ArrayType(_NUMBER)))
PLACE_FEATURES = _struct(("business_id", _TEXT), ("res_feature", T.ArrayType(_NUMBER)))

# Messages on the wire.
RATING_MESSAGE = _struct(
    ("user", _WHOLE), ("restaurant", _WHOLE), ("rating", _NUMBER), ("timestamp", T.LongType())
)
PLACE_IN_RANGE = _struct(
    ("business_id", _TEXT),
    ("name", _TEXT),
    ("address", _TEXT),
    ("dist_km", _TEXT),
    ("latitude", _TEXT),
    ("longitude", _TEXT),
    ("stars", _TEXT),
    ("hours", _TEXT),
)
PHOTO = _struct(("photo_id", _TEXT), ("caption", _TEXT))
RANGE_MESSAGE = _struct(
    ("user_id", _TEXT),
    (
        "business_id_listInRange",
        T.ArrayType(T.StructType(PLACE_IN_RANGE.fields + _struct(("photos", T.ArrayType(PHOTO))).fields)),
    ),
)
RECOMMENDATION_MESSAGE = _struct(("user_id", _TEXT), ("recommender_list", T.ArrayType(_TEXT)))
