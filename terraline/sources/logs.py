"""The two raw text logs, read with Spark's text source. Line numbers come from the file's own lines, so that file order is explicit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraline.functions.naming import clean_double, pair_key
from terraline.functions.stability import risk_class, si_dynamic, si_static_roll, si_total
from terraline.operators.ordered import clock_rows

# The columns of the inertial log, and the words ESTABILIDAD and "sin datos GPS" of the formats below.
IMU_COLUMNS = ["ax", "ay", "az", "gx", "gy", "gz", "roll", "pitch", "yaw", "timeantwifi", "usciclo1", "usciclo2", "usciclo3", "usciclo4", "usciclo5", "si", "accmag", "microsds", "k3"]


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, file, line_no (from 0), value. One file is one log of a trip, so a file is read as one row and split."""
    whole = spark.read.format("binaryFile").load(paths)
    text = F.decode("content", "ISO-8859-1")
    split = whole.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "value"))
    return split.where(F.col("value").isNotNull())


def strict_int(c: Column) -> Column:
    """An integer without a decimal point, null otherwise."""
    t = F.trim(c)
    return F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("int"))


def parse_gps(raw: DataFrame) -> DataFrame:
    """path, file, line_no, timestamp and the ten fields. Rows with under ten fields, a bad cast, or `sin datos GPS` are left out."""
    f = F.split("value", ",")
    body = raw.where((F.col("line_no") >= 2) & (F.trim("value") != "") & ~F.col("value").contains("sin datos GPS")).select("path", "file", "line_no", f.alias("f")).where(F.size("f") >= 10)
    at = lambda i: F.trim(F.get("f", F.lit(i)))
    for i in (3, 4, 5, 6, 9):  # NaN is a number to the parser and becomes null
        body = body.where(at(i).try_cast("double").isNotNull())
    clock = F.regexp_extract(at(2), r"(\d{1,2}:\d{2}:\d{2})", 1)
    out = body.select(
        "path", "file", "line_no", F.try_to_timestamp(F.concat_ws(" ", at(1), clock), F.lit("d/M/yyyy H:mm:ss")).cast("timestamp_ntz").alias("timestamp"),
        at(0).alias("hora_raspberry"), at(1).alias("fecha"), at(2).alias("hora_gps"), clean_double(at(3)).alias("lat"), clean_double(at(4)).alias("lon"),
        clean_double(at(5)).alias("alt"), clean_double(at(6)).alias("hdop"), strict_int(at(7)).alias("fix"), strict_int(at(8)).alias("numsats"), clean_double(at(9)).alias("speed_kmh"),
    )
    return out.where(F.col("timestamp").isNotNull() & F.col("fix").isNotNull() & F.col("numsats").isNotNull())


def gps_row_classes(raw: DataFrame) -> DataFrame:
    """raw, valid, no_fix and malformed rows by file."""
    f = F.split("value", ",")
    kind = F.when(F.col("value").contains("sin datos GPS"), "no_fix").when(F.size(f) < 10, "malformed").otherwise("valid")
    rows = raw.where((F.col("line_no") >= 2) & (F.trim("value") != "")).select("file", kind.alias("kind"))
    return rows.groupBy("file").agg(F.count("*").alias("raw_rows"), *[F.count(F.when(F.col("kind") == k, 1)).alias(f"{k}_rows") for k in ("valid", "no_fix", "malformed")])


_MARK = r"^(?:[01]?\d|2[0-3]):[0-5]\d:[0-5]\d$"


def imu_rows(raw: DataFrame) -> DataFrame:
    """path, file, session, line_no, fields (array of doubles), marker (seconds of the day) and anchor (epoch seconds) for data and marker rows.

    A line that begins with ESTABILIDAD and has a readable date as its second non-empty part starts a session; without one it is
    skipped. Rows before the first session belong to its anchor, and markers there are skipped, as are times that don't exist.
    Data rows need four fields and four numbers; trailing empty fields don't count.
    """
    w = Window.partitionBy("path").orderBy("line_no")
    value = F.regexp_replace(F.trim("value"), "\x00", "")
    parts = F.filter(F.split(value, ";"), lambda x: F.trim(x) != "")
    head = F.upper(value).startswith("ESTABILIDAD")
    start = F.when(head, F.unix_timestamp(F.try_to_timestamp(F.get(parts, F.lit(1)), F.lit("d/M/yyyy H:mm:ss"))))
    t = F.split(value, ":")
    marker = F.when(value.rlike(_MARK), t[0].cast("int") * 3600 + t[1].cast("int") * 60 + t[2].cast("int"))
    fields = F.transform(F.split(F.regexp_replace(value, "[;\\s]+$", ""), ";"), lambda x: clean_double(F.trim(x)))
    rows = raw.select("path", "file", "line_no", head.alias("head"), start.alias("start"), marker.alias("marker"), F.when(~head, fields).alias("fields"))
    rows = rows.withColumn("session", F.sum(F.col("start").isNotNull().cast("int")).over(w))
    first = F.min(F.when(F.col("session") == 1, F.col("start"))).over(Window.partitionBy("path"))
    rows = rows.withColumn("anchor", F.coalesce(F.max("start").over(Window.partitionBy("path", "session")), first))
    rows = rows.where("not head and not (session = 0 and marker is not null)")
    good = (F.size("fields") >= 4) & (F.size(F.filter("fields", lambda x: x.isNotNull())) >= 4)
    return rows.select("path", "file", "session", "anchor", "line_no", "marker", F.when(F.col("marker").isNull(), F.col("fields")).alias("fields")).where(F.col("marker").isNotNull() | good)


def parse_imu(raw: DataFrame, columns: list[str] = IMU_COLUMNS) -> DataFrame:
    """One row a sample with timestamp: row i of the N up to the next marker, session or end stands i/N seconds behind the last
    marker or the session's start. Columns beyond the given ones become extra: a map of col_i. Rows of a file without any
    readable date are left out."""
    stamped = clock_rows(imu_rows(raw), ["path", "session"], ["line_no"], "anchor", "marker").withColumn("timestamp", F.timestamp_micros("t_us").cast("timestamp_ntz"))
    named = [F.get("fields", F.lit(k)).alias(c) for k, c in enumerate(columns)]
    rest = F.slice("fields", len(columns) + 1, F.greatest(F.lit(0), F.size("fields") - len(columns)))
    extra = F.map_from_entries(F.transform(rest, lambda x, k: F.struct(F.concat(F.lit("col_"), (k + len(columns)).cast("string")), x)))
    return stamped.select("path", "file", "session", "line_no", "timestamp", *named, F.when(F.size(rest) > 0, extra).alias("extra"))


def pair_files(gps: DataFrame, imu: DataFrame) -> DataFrame:
    """key, gps_path, imu_path of files that belong together. Frames with path."""
    name = F.element_at(F.split("path", "/"), -1)
    g = gps.select(pair_key(name, "GPS").alias("key"), F.col("path").alias("gps_path")).where("key is not null")
    i = imu.select(pair_key(name, "ESTABILIDAD").alias("key"), F.col("path").alias("imu_path")).where("key is not null")
    return g.join(i, "key")


def parse_gps_formatted(raw: DataFrame) -> DataFrame:
    """The formatter's projection of the GPS log: t_us (epoch microseconds of the recorder's clock), position, speed in m/s, heading 0."""
    f = F.split("value", ",")
    body = raw.where((F.col("line_no") >= 2) & (F.trim("value") != "") & ~F.col("value").contains("sin datos GPS")).select("path", "file", "line_no", f.alias("f")).where(F.size("f") >= 10)
    at = lambda i: F.trim(F.get("f", F.lit(i)))
    clock = F.regexp_extract(at(0), r"(\d{1,2}:\d{2}:\d{2})", 1)
    t = F.unix_micros(F.try_to_timestamp(F.concat_ws(" ", at(1), clock), F.lit("d/M/yyyy H:mm:ss")))
    out = body.select("path", "file", "line_no", t.alias("t_us"), clean_double(at(3)).alias("lat"), clean_double(at(4)).alias("lon"), clean_double(at(5)).alias("alt"), (clean_double(at(9)) / 3.6).alias("speed_ms"), F.lit(0.0).alias("heading_deg"))
    return out.where("t_us is not null and lat is not null and lon is not null and alt is not null and speed_ms is not null")


def parse_imu_formatted(raw: DataFrame) -> DataFrame:
    """Samples of rows with ten numbers or more, with t_us and the roll-based stability columns."""
    s = parse_imu(raw).where("pitch is not null and timeantwifi is not null and yaw is not null")
    t = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', timestamp)")
    total = si_total(F.col("roll"), F.col("ay"))
    return s.withColumns({"t_us": t, "si_static": si_static_roll(F.col("roll")), "si_dynamic": si_dynamic(F.col("ay")), "si_total": total, "risk": risk_class(total)})


def imu_values(raw: DataFrame, columns: list[str] = IMU_COLUMNS, least: int = 10) -> DataFrame:
    """All rows with enough `;` as doubles, without clocks: NULs stripped, short rows padded, long ones cut."""
    f = F.split(F.regexp_replace("value", "\x00", ""), ";")
    rows = raw.select("path", "file", "line_no", f.alias("f")).where((F.size("f") > least) & clean_double(F.get("f", F.lit(0))).isNotNull())
    return rows.select("path", "file", "line_no", *[clean_double(F.trim(F.get("f", F.lit(k)))).alias(c) for k, c in enumerate(columns)])


def imu_row_classes(raw: DataFrame) -> DataFrame:
    """raw, data, marker, header and malformed rows by file."""
    n = F.size(F.filter(F.split("value", ";"), lambda x: clean_double(F.trim(x)).isNotNull()))
    value = F.trim("value")
    kind = F.when(F.upper("value").startswith("ESTABILIDAD"), "header").when(value.rlike(_MARK), "marker").when(n >= 4, "data").otherwise("malformed")
    rows = raw.where(F.trim("value") != "").select("file", kind.alias("kind"))
    return rows.groupBy("file").agg(F.count("*").alias("raw_rows"), *[F.count(F.when(F.col("kind") == k, 1)).alias(f"{k}_rows") for k in ("data", "marker", "header", "malformed")])


def loose_row_count(raw: DataFrame) -> DataFrame:
    """Non-blank lines less the two of the head, by file."""
    return raw.where(F.trim("value") != "").groupBy("file").agg(F.greatest(F.lit(0), F.count("*") - 2).alias("n_rows"))
