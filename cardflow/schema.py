"""Column names, schemas and fixed values of the transaction model."""

from __future__ import annotations

from pyspark.sql import types as T

# Look-back windows in seconds and the constants of the feature definitions.
TEN_MINUTES = 600
ONE_HOUR = 3600
ONE_DAY = 86400
WINDOWS = {"cnt_10m": TEN_MINUTES, "cnt_1h": ONE_HOUR, "cnt_24h": ONE_DAY}
RETENTION = ONE_DAY
EARTH_RADIUS_KM = 6371.0
REVIEW_COST = 10.0
VALIDATION_START = "2019-11-01"
DAYS_PER_YEAR = 365.25

# Header of the raw card CSV (after an unnamed index) and the name used here.
RAW_COLUMNS = {
    "trans_date_trans_time": "ts",
    "cc_num": "card_id",
    "merchant": "merchant",
    "category": "category",
    "amt": "amount",
    "first": "first_name",
    "last": "last_name",
    "gender": "gender",
    "street": "street",
    "city": "city",
    "state": "state",
    "zip": "zip",
    "lat": "home_lat",
    "long": "home_lon",
    "city_pop": "city_pop",
    "job": "job",
    "dob": "birth_date",
    "trans_num": "tx_id",
    "unix_time": "unix_time",
    "merch_lat": "merch_lat",
    "merch_long": "merch_lon",
    "is_fraud": "is_fraud",
}
RAW_INDEX = "_index"
RAW_TYPES = {
    "card_id": "long",
    "amount": "double",
    "home_lat": "double",
    "home_lon": "double",
    "city_pop": "long",
    "unix_time": "long",
    "merch_lat": "double",
    "merch_lon": "double",
    "is_fraud": "int",
}
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"

# Fields of a transaction message and their names on the wire.
MESSAGE_FIELDS = {
    "tx_id": "id_transaccion",
    "card_id": "numero_tarjeta",
    "ts": "fecha_hora_transaccion",
    "amount": "monto",
    "category": "categoria",
    "merchant": "comercio",
    "gender": "genero",
    "birth_date": "fecha_nacimiento",
    "home_lat": "latitud_cliente",
    "home_lon": "longitud_cliente",
    "merch_lat": "latitud_comercio",
    "merch_lon": "longitud_comercio",
    "city_pop": "poblacion_ciudad",
}
MESSAGE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"

# The seven fields the state needs; every one of them must be present in a message.
EVENT_TYPES = {
    "card_id": T.LongType(),
    "tx_id": T.StringType(),
    "ts": T.StringType(),
    "amount": T.DoubleType(),
    "category": T.StringType(),
    "merch_lat": T.DoubleType(),
    "merch_lon": T.DoubleType(),
}
# What scoring needs besides; a state does without.
REQUEST_TYPES = {
    "gender": T.StringType(),
    "birth_date": T.StringType(),
    "home_lat": T.DoubleType(),
    "home_lon": T.DoubleType(),
    "city_pop": T.LongType(),
}
EVENT_COLUMNS = ["card_id", "tx_id", "epoch_s", "amount", "category", "merch_lat", "merch_lon"]

HISTORY_FEATURES = [
    *WINDOWS,
    "prior_amount",
    "amount_ratio",
    "is_new_category",
    "prev_distance_km",
    "implied_speed_kmh",
]
FEATURE_TABLE_COLUMNS = ["card_id", "tx_id", "ts", *HISTORY_FEATURES]

RECENT_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("epoch_s", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("amount", T.DoubleType()),
        ]
    )
)
STATE_SCHEMA = T.StructType(
    [
        T.StructField("card_id", T.LongType()),
        T.StructField("n_total", T.LongType()),
        T.StructField("amount_total", T.DoubleType()),
        T.StructField("categories_seen", T.ArrayType(T.StringType())),
        T.StructField("recent", RECENT_TYPE),
        T.StructField("last_epoch", T.LongType()),
        T.StructField("last_tx_id", T.StringType()),
        T.StructField("last_lat", T.DoubleType()),
        T.StructField("last_lon", T.DoubleType()),
    ]
)
STATE_COLUMNS = STATE_SCHEMA.fieldNames()

# Model inputs. The card is a lookup key and never a model input.
NUMERIC_FEATURES = ["amount", "hour", "weekday", "age", "home_merchant_km", "city_pop"]
CATEGORICAL_FEATURES = ["category", "gender"]
