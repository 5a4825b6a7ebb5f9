"""Record shapes."""

from pyspark.sql import types as T

#: One parsed access-log line. ``seq`` (the file-order key) is added by the scan.
LOG_ENTRY = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("status", T.LongType()),
    T.StructField("bytes_sent", T.LongType()),
    T.StructField("referrer", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("response_time", T.LongType()),
    T.StructField("dt", T.TimestampNTZType()),
])

#: One packet record as files carry it; ``timestamp`` is epoch seconds.
PACKET = T.StructType([
    T.StructField("src_ip", T.StringType()),
    T.StructField("dst_ip", T.StringType()),
    T.StructField("dst_port", T.IntegerType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("timestamp", T.DoubleType()),
])

THREAT_COLUMNS = (
    "rule_ord", "type", "severity", "source_ip", "description", "evidence", "timestamp",
)

ALERT_COLUMNS = ("type", "severity", "detail", "ip", "seq")

#: The five inputs of the classifier, in order.
MODEL_COLUMNS = ("packet_size", "packet_count_ip", "flow_bytes", "unique_ports", "time_delta")
