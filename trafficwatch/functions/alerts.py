"""Column expressions over alerts: keys, wire encoding, severity and message text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficwatch.schema import ALERT_COLUMNS

# Severity ranks used by the notification gate (unknown -> 0, an
# unknown minimum -> 2), and the lines of the notification texts below.
SEVERITY_RANK = {"warning": 1, "critical": 2}
UNKNOWN_MIN_RANK = 2
UNKNOWN = "unknown"
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"  # how timestamps look in alert JSON (UTC)

# Alert as read back from the wire: timestamps stay text so that fallback keys
# and messages show exactly what was sent.
WIRE_ALERT_SCHEMA = T.StructType(
    [
        T.StructField("src_ip", T.StringType()),
        T.StructField("window_start", T.StringType()),
        T.StructField("window_end", T.StringType()),
        T.StructField("window_size", T.StringType()),
        T.StructField("attack_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("severity_rank", T.IntegerType()),
        T.StructField("request_count", T.LongType()),
        T.StructField("rps", T.DoubleType()),
        T.StructField("unique_path_count", T.LongType()),
        T.StructField("error_ratio", T.DoubleType()),
        T.StructField("signal_reason", T.StringType()),
        T.StructField("detected_at", T.StringType()),
    ]
)


def alert_key() -> Column:
    """``src_ip|attack_type|window_end|window_size``; null parts are skipped."""
    return F.concat_ws(
        "|",
        F.col("src_ip"),
        F.col("attack_type"),
        F.col("window_end").cast("string"),
        F.col("window_size"),
    )


def alert_json(columns: tuple[str, ...] = ALERT_COLUMNS) -> Column:
    """One JSON object per alert; null fields are omitted, times as ISO-8601 UTC millis."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]), {"timestampFormat": ISO_MILLIS})


def encode_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts -> wire records (key, value)."""
    return alerts.select(alert_key().alias("key"), alert_json().alias("value"))


_CORRUPT = "_corrupt_record"
_TEXT_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in WIRE_ALERT_SCHEMA.fields] + [T.StructField(_CORRUPT, T.StringType())])


def parse_alert(text: Column) -> Column:
    """JSON text -> struct of the alert fields as text; null unless it is one JSON object.

    A name that repeats counts with its last value, as in most JSON readers.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "allowSingleQuotes": "false"}
    parsed = F.from_json(text, _TEXT_SCHEMA, options)
    whole = parsed[_CORRUPT].isNull() & F.trim(text).endswith("}")
    return F.when(whole, parsed)


def alert_field(parsed: Column, name: str) -> Column:
    """One field of ``parse_alert`` in its declared type; quoted numbers count, other text gives null."""
    kind = WIRE_ALERT_SCHEMA[name].dataType
    if isinstance(kind, T.StringType):
        return parsed[name]
    number = parsed[name].try_cast("double")
    return number if isinstance(kind, T.DoubleType) else F.coalesce(parsed[name].try_cast(kind), number.try_cast(kind))


def severity_rank_of(sev: Column) -> Column:
    s = F.lower(sev)
    expr = None
    for name, rank in SEVERITY_RANK.items():
        expr = F.when(s == name, rank) if expr is None else expr.when(s == name, rank)
    return expr.otherwise(0)


def min_rank(min_severity: str) -> int:
    return SEVERITY_RANK.get((min_severity or "").lower(), UNKNOWN_MIN_RANK)


def fallback_key() -> Column:
    """Key rebuilt from a decoded alert when the message carries none."""
    return F.concat_ws(
        "|",
        *[F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)) for c in ("src_ip", "attack_type", "window_end", "window_size")],
    )


def message_key(key: Column) -> Column:
    return F.coalesce(F.when(key != "", key), fallback_key())


def _or_unknown(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(UNKNOWN))


def format_alert() -> Column:
    """Seven-line notification of one decoded (wire) alert; missing -> unknown."""
    c = F.col
    return F.concat_ws(
        "\n",
        F.lit("DDoS Alert"),
        F.concat(F.lit("IP: "), _or_unknown(c("src_ip"))),
        F.concat(F.lit("Attack: "), _or_unknown(c("attack_type"))),
        F.concat(F.lit("Severity: "), _or_unknown(c("severity"))),
        F.concat(F.lit("Window: "), _or_unknown(c("window_size")), F.lit(" ending "), _or_unknown(c("window_end"))),
        F.concat(F.lit("Requests: "), _or_unknown(c("request_count")), F.lit(" | RPS: "), _or_unknown(c("rps"))),
        F.concat(F.lit("Reason: "), _or_unknown(c("signal_reason"))),
    )


def format_digest() -> Column:
    """Notification of one digest (see operators.digest.digest)."""
    c = F.col
    listed = F.size(c("ips"))
    ip_text = F.array_join(c("ips"), ", ")
    ip_text = F.when(
        c("ip_count") > listed,
        F.concat(ip_text, F.lit(", ...(+"), (c("ip_count") - listed).cast("string"), F.lit(" more)")),
    ).otherwise(ip_text)
    ip_text = F.when(ip_text == "", F.lit(UNKNOWN)).otherwise(ip_text)
    end = F.coalesce(
        F.date_format(c("window_end_max"), ISO_MILLIS), F.date_format(c("window_end_min"), ISO_MILLIS), F.lit(UNKNOWN)
    )
    return F.concat_ws(
        "\n",
        F.lit("DDoS Alert"),
        F.concat(F.lit("IP: "), ip_text),
        F.concat(F.lit("Attack: "), c("attack_type")),
        F.concat(F.lit("Severity: "), c("severity")),
        F.concat(F.lit("Window: "), c("window_size"), F.lit(" ending "), end),
        F.concat(
            F.lit("Requests: "),
            F.format_string("%.0f", c("request_count_sum")),
            F.lit(" | RPS: "),
            F.format_string("%.2f", c("rps_sum")),
        ),
        F.concat(F.lit("Reason: "), c("signal_reason")),
    )
