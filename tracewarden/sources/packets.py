"""Packet records from CSV, JSON and streams. Readers add the order key ``seq`` and name the
time column ``ts``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewarden.plans.ordering import scan_key
from tracewarden.schema import PACKET
from tracewarden.sources.json_arrays import array_objects


def _typed(df: DataFrame, *extra) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast(f.dataType).alias("ts" if f.name == "timestamp" else f.name)
            for f in PACKET
        ],
        *extra,
    )


def packets_from_csv(spark: SparkSession, path) -> DataFrame:
    """Header CSV; columns are found by name, in any order. A bad number raises (ANSI cast), and so does a file
    whose header differs from that of the first file of the folder."""
    raw = spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    return _typed(raw, scan_key().alias("seq"))


def _begins_with_array(spark: SparkSession, path) -> bool:
    """Does the first file with any text begin with a bracket? Only its beginning is read."""
    pieces = spark.read.option("lineSep", "}")
    for file in sorted(spark.read.text(path).inputFiles()):
        first = pieces.text(file).filter(F.trim("value") != "").limit(1).collect()
        if first:
            return first[0][0].lstrip().startswith("[")
    return False


def packets_from_json(spark: SparkSession, path, lines: bool | None = None) -> DataFrame:
    """One object per line (``lines=True``), or one JSON array of packet objects per file, of any size: see
    :mod:`tracewarden.sources.json_arrays`.

    Unless told, the form is that of the first file. No packet of a file of the other form is lost: an array in a single line is read with
    the lines, and anything else raises when it is read.
    """
    if lines is None:
        lines = not _begins_with_array(spark, path)
    if lines:
        raw = spark.read.schema(PACKET).option("mode", "FAILFAST").json(path)
        return _typed(raw, scan_key().alias("seq"))
    objects = array_objects(spark, path)
    return _typed(objects.select(F.from_json("text", PACKET, {"mode": "FAILFAST"}).alias("packet"), "seq").select("packet.*", "seq"), "seq")


def packet_scan(spark: SparkSession, path: str, lines: bool | None = None) -> DataFrame:
    """Choose the reader by suffix, which is case-sensitive. ``lines`` as in :func:`packets_from_json`."""
    if path.endswith(".csv"):
        return packets_from_csv(spark, path)
    if path.endswith(".json"):
        return packets_from_json(spark, path, lines)
    raise ValueError(f"Unsupported file type: {path}")


def tcp_only(packets: DataFrame) -> DataFrame:
    return packets.filter(F.col("protocol") == "TCP")


def all_ip(packets: DataFrame) -> DataFrame:
    """Keep every packet; those that are not TCP get port 0 and protocol ``Other``."""
    is_tcp = F.col("protocol") == "TCP"
    return packets.withColumns({
        "dst_port": F.when(is_tcp, F.col("dst_port")).otherwise(0),
        "protocol": F.when(is_tcp, F.col("protocol")).otherwise("Other"),
    })


#: Columns that a streamed CSV file may have.
CSV_COLUMNS = 32


def _csv_stream(files: DataFrame) -> DataFrame:
    """``path, pos, packet`` of CSV texts. The first line names the columns, in any order; a line is a record."""
    names = [f"c{i}" for i in range(CSV_COLUMNS)]
    fields = ", ".join(f"{n} string" for n in names)
    # As the one element of an array, so that a line is parsed once for all its cells.
    cells = lambda line: F.expr(
        f"transform(array(from_csv({line}, '{fields}')), row -> array({', '.join(f'row.{n}' for n in names)}))")
    # What is found below a generator is found once, not once for each use: the places of the columns in a file, the cells in a line.
    heads = files.withColumn("first", F.regexp_replace(F.substring_index("value", "\n", 1), "\r$", "")).select(
        "path", "value", F.explode(cells("first")).alias("head")).withColumn("head", F.transform("head", F.trim))
    places = [f"at_{f.name}" for f in PACKET]
    lines = heads.select(
        "path", *[F.nullif(F.array_position("head", f.name), F.lit(0)).cast("int").alias(at) for f, at in zip(PACKET, places)],
        F.posexplode(F.split("value", "\r?\n")).alias("pos", "line"))
    rows = lines.filter((F.col("pos") > 0) & (F.trim("line") != "")).select("path", "pos", *places, F.explode(cells("line")).alias("row"))

    def value(name: str) -> Column:
        missing = F.raise_error(F.concat(F.lit(f"no column {name} in "), F.col("path"))).cast("string")
        return F.when(F.col(f"at_{name}").isNull(), missing).otherwise(F.get("row", F.col(f"at_{name}") - 1))

    return rows.select("path", "pos", F.struct(*[value(f.name).cast(f.dataType).alias(f.name) for f in PACKET]).alias("packet"))


def _json_stream(files: DataFrame) -> DataFrame:
    """``path, pos, packet`` of JSON texts, each an array of packets or a packet in each line."""
    strict = {"mode": "FAILFAST"}
    whole = F.from_json("value", T.ArrayType(PACKET), strict)
    lines = F.filter(F.split("value", "\r?\n"), lambda line: F.trim(line) != "")
    piece = lambda packet, line: F.struct(packet.alias("whole"), line.alias("line"))
    pieces = F.when(F.ltrim("value").startswith("["), F.transform(whole, lambda p: piece(p, F.lit(None).cast("string")))).otherwise(
        F.transform(lines, lambda line: piece(F.lit(None).cast(PACKET), line)))
    rows = files.select("path", F.posexplode(pieces).alias("pos", "piece"))
    # Lines are parsed one at a time, above the generator; as the one element of an array, so that each is parsed once for all its columns.
    packet = F.coalesce("piece.whole", F.from_json("piece.line", PACKET, strict))
    return rows.select("path", "pos", F.explode(F.array(packet)).alias("packet"))


def packet_stream(spark: SparkSession, path: str, fmt: str = "json", files_per_trigger: int = 100) -> DataFrame:
    """Packet files as they arrive in a folder: JSON (an array, or lines) or CSV with a header.

    ``seq`` orders packets as the scans' key does, by file and place in it; it is text, so that stateful functions can sort by it.
    A file is read whole by one task, which is what gives its packets their places: let files arrive in pieces of at most some
    hundred MB. Empty files have no packets. A record that can't be read raises.
    """
    files = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_trigger).load(
        path).select("value", F.col("_metadata.file_path").alias("path"))
    records = {"csv": _csv_stream, "json": _json_stream}[fmt](files)
    place = F.lpad(F.col("pos").cast("string"), 10, "0")
    return _typed(records.select("packet.*", "path", "pos"), F.concat("path", F.lit("#"), place).alias("seq"))
