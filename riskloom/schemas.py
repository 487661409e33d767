"""Table schemas, shared by batch and streaming readers."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


PAYMENT = _struct(
    ("tx_id", T.StringType()),
    ("user_id", T.StringType()),
    ("amount", T.DoubleType()),
    ("currency", T.StringType()),
    ("card_country", T.StringType()),
    ("method", T.StringType()),
    ("flag_ataque", T.BooleanType()),
)

VISIT = _struct(
    ("timestamp", T.StringType()),
    ("user_id", T.StringType()),
    ("ip", T.StringType()),
    ("session_duration", T.IntegerType()),
    ("pages_visited", T.IntegerType()),
    ("is_bot", T.BooleanType()),
    ("flag_ataque", T.BooleanType()),
)

BLACKLIST = _struct(("ip", T.StringType()), ("riesgo_historico", T.StringType()))

ALERT = _struct(
    ("tx_id", T.StringType()),
    ("user_id", T.StringType()),
    ("amount", T.DoubleType()),
    ("card_country", T.StringType()),
    ("score_fraude", T.IntegerType()),
    ("status", T.StringType()),
)

BOT_TRAFFIC = _struct(
    ("user_id", T.StringType()),
    ("ip", T.StringType()),
    ("pages_visited", T.IntegerType()),
    ("timestamp", T.StringType()),
    ("riesgo_historico", T.StringType()),
)

WINDOW_METRIC = _struct(
    ("window_start", T.TimestampType()),
    ("window_end", T.TimestampType()),
    ("total_visitas", T.IntegerType()),
    ("media_paginas", T.DoubleType()),
)

COUNTRY_SUMMARY = _struct(("card_country", T.StringType()), ("total_transacciones", T.LongType()))

TOP_SCRAPERS = _struct(
    ("ip", T.StringType()),
    ("total_paginas_dia", T.LongType()),
    ("total_sesiones_dia", T.LongType()),
    ("tiempo_total_segundos", T.LongType()),
)

HOT_NODES = _struct(("id", T.StringType()), ("degree", T.LongType()), ("tipo", T.StringType()))

FRAUD_RINGS = _struct(
    ("component", T.StringType()),
    ("num_entidades", T.LongType()),
    ("segment_no", T.IntegerType()),
    ("miembros", T.StringType()),
)

PROJECT = _struct(("id", T.StringType()), ("name", T.StringType()), ("created_at", T.StringType()))

MESSAGE = _struct(
    ("type", T.StringType()),
    ("data", _struct(("content", T.StringType()))),
)
