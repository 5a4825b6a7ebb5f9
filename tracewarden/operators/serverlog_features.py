"""Feature table over access-log entries, one row per entry.

Only the column names are given; the formulas are ours, as stated at each group. All of it is
one projection, without a shuffle. Flags are 0 or 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewarden.config import DEFAULTS, DetectionConfig
from tracewarden.functions import patterns as P
from tracewarden.functions.text import path_tokens

# Fixed value: code of a method is its place here, -1 for others.
METHODS = ("DELETE", "GET", "HEAD", "OPTIONS", "PATCH", "POST", "PUT")


def _flag(test: Column) -> Column:
    return F.when(test, 1).otherwise(0)


def _names(column: str, *words: str) -> Column:
    return P.names_any(F.col(column), words)


def time_columns(cfg: DetectionConfig = DEFAULTS) -> dict[str, Column]:
    """Monday is day 0; business hours are the configured work hours. NULL for an unknown time."""
    hour, day = F.hour("dt"), F.weekday("dt")
    known = F.col("dt").isNotNull()
    return {
        "hour": hour,
        "day_of_week": day,
        "month": F.month("dt"),
        "is_weekend": F.when(known, _flag(day >= 5)),
        "is_business_hours": F.when(
            known, _flag((hour >= cfg.work_hours_start) & (hour < cfg.work_hours_end))),
    }


def request_columns() -> dict[str, Column]:
    """Depth counts path segments; special characters are all but letters, digits and slashes."""
    endpoint = F.col("endpoint")
    asked = F.contains(endpoint, F.lit("?"))
    params = F.substr(endpoint, F.instr(endpoint, "?") + 1)
    code = F.array_position(F.array(*[F.lit(m) for m in METHODS]), F.upper("method")) - 1
    family = F.floor(F.col("status") / 100)
    return {
        "method_encoded": code.cast("int"),
        "endpoint_length": F.length(endpoint),
        "endpoint_depth": F.size(path_tokens(endpoint)),
        "has_query_params": _flag(asked),
        "query_param_count": F.when(asked & (params != ""), F.regexp_count(params, F.lit("&")) + 1).otherwise(0),
        "special_char_count": F.regexp_count(endpoint, F.lit("[^A-Za-z0-9/]")),
        "is_admin_endpoint": _flag(F.contains(F.lower(endpoint), F.lit("admin"))),
        "status": F.col("status"),
        "bytes": F.col("bytes_sent"),
        "response_time": F.col("response_time"),
        **{f"status_{i}xx": _flag(family == i) for i in range(1, 6)},
        "is_error": _flag(F.col("status") >= 400),
    }


def agent_columns(cfg: DetectionConfig = DEFAULTS) -> dict[str, Column]:
    """Browsers that name others in their agent text are tested first: Edge and Opera, then Chrome,
    then Safari. A referrer is external when its host is not the configured site."""
    ua = "user_agent"
    edge, opera = _names(ua, "edge/", "edg/"), _names(ua, "opr/", "opera")
    chrome_token = _names(ua, "chrome/")
    ios, android = _names(ua, "iphone", "ipad", "ipod"), _names(ua, "android")
    referred = ~F.col("referrer").isin("", "-")
    host = F.lower(F.regexp_extract("referrer", "^[A-Za-z]+://([^/:?#]+)", 1))
    return {
        "ua_length": F.length(ua),
        "is_chrome": _flag(chrome_token & ~edge & ~opera),
        "is_firefox": _flag(_names(ua, "firefox/")),
        "is_safari": _flag(_names(ua, "safari/") & ~chrome_token & ~edge & ~opera),
        "is_edge": _flag(edge),
        "is_opera": _flag(opera),
        "is_windows": _flag(_names(ua, "windows")),
        "is_mac": _flag(_names(ua, "macintosh", "mac os x") & ~ios),
        "is_linux": _flag(_names(ua, "linux") & ~android),
        "is_android": _flag(android),
        "is_ios": _flag(ios),
        "is_mobile": _flag(android | ios | _names(ua, "mobile")),
        "is_bot": _flag(_names(ua, "bot", "crawler", "spider", "wget/", *P.ATTACK_TOOLS)),
        "has_referrer": _flag(referred),
        "referrer_length": F.when(referred, F.length("referrer")).otherwise(0),
        "is_external_referrer": _flag(referred & (host != cfg.site_host)),
    }


def address_columns() -> dict[str, Column]:
    """Private ranges are those of RFC 1918; an octet that is no number is NULL."""
    octet = [F.expr(f"try_cast(get(split(ip, '[.]'), {i}) AS INT)") for i in range(4)]
    private = (
        (octet[0] == 10)
        | ((octet[0] == 172) & octet[1].between(16, 31))
        | ((octet[0] == 192) & (octet[1] == 168))
    )
    return {
        **{f"ip_octet_{i + 1}": o for i, o in enumerate(octet)},
        "is_private_ip": _flag(private),
    }


def attack_columns() -> dict[str, Column]:
    """Pattern rules without the dataset-wide gate; command injection uses patterns of our own."""
    endpoint = F.col("endpoint")
    return {
        "is_sql_injection": _flag(P.matches_any(endpoint, P.SQL_INJECTION)),
        "is_xss": _flag(P.matches_any(endpoint, P.XSS)),
        "is_path_traversal": _flag(P.matches_any(endpoint, P.PATH_TRAVERSAL)),
        "is_command_injection": _flag(P.matches_any(endpoint, P.COMMAND_INJECTION)),
    }


def serverlog_features(entries: DataFrame, order: str = "seq", cfg: DetectionConfig = DEFAULTS) -> DataFrame:
    columns = {
        **time_columns(cfg), **request_columns(), **agent_columns(cfg),
        **address_columns(), **attack_columns(),
    }
    return entries.select(order, *[c.alias(n) for n, c in columns.items()])
