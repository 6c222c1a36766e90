"""Explicit schemas of the known datasets and of the nested run metadata."""

from __future__ import annotations

from pyspark.sql import types as T


def _doubles(names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


# Dataset column names.
WEATHER = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("Formatted Date", "Summary", "Precip Type")]
    + _doubles(
        [
            "Temperature (C)",
            "Apparent Temperature (C)",
            "Humidity",
            "Wind Speed (km/h)",
            "Wind Bearing (degrees)",
            "Visibility (km)",
            "Loud Cover",
            "Pressure (millibars)",
        ]
    )
    + [T.StructField("Daily Summary", T.StringType())]
)

HEART = T.StructType(
    [
        T.StructField("age", T.IntegerType()),
        T.StructField("sex", T.IntegerType()),
        T.StructField("chest pain type", T.IntegerType()),
        T.StructField("resting bp s", T.IntegerType()),
        T.StructField("cholesterol", T.IntegerType()),
        T.StructField("fasting blood sugar", T.IntegerType()),
        T.StructField("resting ecg", T.IntegerType()),
        T.StructField("max heart rate", T.IntegerType()),
        T.StructField("exercise angina", T.IntegerType()),
        T.StructField("oldpeak", T.DoubleType()),
        T.StructField("ST slope", T.IntegerType()),
        T.StructField("target", T.IntegerType()),
    ]
)

BLOOD_FEATURES = (
    "Sex Age CA CK CREA ALP GGT GLU AST ALT LDH PCR KAL NAT UREA WBC RBC HGB HCT MCV MCH MCHC PLT1 "
    "NE LY MO EO BA NET LYT MOT EOT BAT"
).split()
BLOOD_TEST = T.StructType(_doubles(BLOOD_FEATURES) + [T.StructField("SARSCov", T.IntegerType())])

RUN_METADATA = T.StructType(
    [
        T.StructField("experiment", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("scaler", T.StringType()),
        T.StructField("n_train", T.LongType()),
        T.StructField("n_test", T.LongType()),
        T.StructField("feature_names", T.ArrayType(T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    ]
)
