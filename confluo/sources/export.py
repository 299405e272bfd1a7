"""Plain and compact exports, and their readers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.codec import base64_digits, base64_value
from ..operators.ordered import REPEAT, delta_decode, delta_encode, mark_repeats, unmark_repeats
from ..plans.storage import store


def write_tabs(df: DataFrame, path: str) -> None:
    """Tab-separated without header or quotes, null as nothing."""
    df.write.mode("overwrite").csv(path, sep="\t", quote="", nullValue="", emptyValue="")


def pretty_metadata(df: DataFrame) -> DataFrame:
    """One line per record: hash, authors, publishers, album, year; lists joined by `~`, year 0 left out."""
    year = F.when(F.col("year") > 0, F.col("year").cast("string")).otherwise(F.lit(""))
    line = F.concat_ws("\t", "hash", F.array_join("authors", "~"), F.array_join("publishers", "~"), F.coalesce("album", F.lit("")), year)
    return df.select(F.regexp_replace(line, "\t+$", "").alias("value"))


def parse_metadata(lines: DataFrame) -> DataFrame:
    """The inverse of :func:`pretty_metadata`."""
    f = F.split("value", "\t")
    many = lambda i: F.filter(F.split(F.coalesce(F.get(f, F.lit(i)), F.lit("")), "~"), lambda x: x != "")
    return lines.select(
        F.get(f, F.lit(0)).alias("hash"), many(1).alias("authors"), many(2).alias("publishers"),
        F.coalesce(F.get(f, F.lit(3)), F.lit("")).alias("album"), F.coalesce(F.get(f, F.lit(4)).try_cast("int"), F.lit(0)).alias("year"),
    )


def pretty_lengths(df: DataFrame) -> DataFrame:
    """(hash, minsubsong, line) of (hash, subsong, length, end) rows, in order of subsong."""
    entry = F.when(F.col("end") == "player", F.col("length").cast("string")).otherwise(F.concat_ws(",", F.col("length").cast("string"), "end"))
    kept = df.groupBy("hash").agg(F.min("subsong").alias("minsubsong"), F.array_sort(F.collect_list(F.struct("subsong", entry.alias("e")))).alias("es"))
    return kept.select("hash", "minsubsong", F.array_join("es.e", " ").alias("line"))


def parse_lengths_lines(df: DataFrame) -> DataFrame:
    """(hash, subsong, length, end) rows: the inverse of :func:`pretty_lengths`, numbered from minsubsong on."""
    entries = df.select("hash", "minsubsong", F.posexplode(F.split("line", " ")).alias("i", "e"))
    end = F.regexp_extract("e", "^[^,]*,(.*)$", 1)
    return entries.select("hash", (F.col("minsubsong") + F.col("i")).alias("subsong"), F.substring_index("e", ",", 1).cast("long").alias("length"), F.when(end == "", "player").otherwise(end).alias("end"))


def pretty_modinfos(df: DataFrame) -> DataFrame:
    """One line per hash: hash, format, channels; 0 channels left out, blanks at the end cut."""
    channels = F.when(F.col("channels") > 0, F.col("channels").cast("string")).otherwise("")
    return df.select(F.regexp_replace(F.concat_ws("\t", "hash", F.coalesce("format", F.lit("")), channels), "\t+$", "").alias("value"))


def parse_modinfos(lines: DataFrame) -> DataFrame:
    """The inverse of :func:`pretty_modinfos`."""
    f = F.split("value", "\t")
    return lines.select(F.get(f, F.lit(0)).alias("hash"), F.coalesce(F.get(f, F.lit(1)), F.lit("")).alias("format"), F.coalesce(F.get(f, F.lit(2)).try_cast("int"), F.lit(0)).alias("channels"))


def encode_records(df: DataFrame, idx: str, values: list[str]) -> DataFrame:
    """(shard, place, line) of records (idx long, string values): sorted by the values, then the index, and packed.

    A line is the index in base 64 and the values, those equal to the line before as U+007F; a line that equals the one
    before in all values is the difference of the indices alone.  Blanks at the end are cut.  Order is by ranges; each
    range is a shard that begins anew, so shards are written and read apart.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = store(df.select(idx, *values).repartitionByRange(parts, *values, idx).withColumn("shard", F.spark_partition_id()), "records")
    w = Window.partitionBy("shard").orderBy(*values, idx)
    rows = ranged.withColumn("place", F.row_number().over(w))
    same = [F.coalesce(F.lag(v).over(w) == F.col(v), F.lit(False)) for v in values]
    rows = rows.select("shard", "place", idx, *values, F.lag(idx).over(w).alias("__before"), *[s.alias(f"__s{i}") for i, s in enumerate(same)])
    every = reduce(lambda a, b: a & b, [F.col(f"__s{i}") for i in range(len(values))])
    shown = [F.when(F.col(f"__s{i}"), F.lit(REPEAT)).otherwise(F.coalesce(v, F.lit(""))) for i, v in enumerate(values)]
    full = F.regexp_replace(F.concat_ws("\t", base64_digits(F.col(idx).cast("long"), 4, True), *shown), "\t+$", "")
    # an index whose values are all empty keeps one tab, as a line without any is a difference
    full = F.when(F.instr(full, "\t") == 0, F.concat(full, F.lit("\t"))).otherwise(full)
    delta = base64_digits((F.col(idx) - F.col("__before")).cast("long"), 4, True)
    return rows.select("shard", "place", F.when(every, delta).otherwise(full).alias("line"))


def decode_records(lines: DataFrame, idx: str, values: list[str]) -> DataFrame:
    """The inverse of :func:`encode_records`: a running sum of differences from the last full line, and repeated values carried on."""
    f = F.split("line", "\t")
    alone = F.size(f) == 1
    w = Window.partitionBy("shard").orderBy("place")
    rows = lines.select("shard", "place", base64_value(F.get(f, F.lit(0))).alias("__n"), alone.alias("__alone"), *[F.coalesce(F.get(f, F.lit(i)), F.lit("")).alias(v) for i, v in enumerate(values, 1)])
    rows = rows.withColumn("__run", F.sum((~F.col("__alone")).cast("int")).over(w))
    run = Window.partitionBy("shard", "__run").orderBy("place")
    rows = rows.withColumn(idx, F.sum("__n").over(run))
    kept = [F.last(F.when(F.col("__alone") | (F.col(v) == REPEAT), F.lit(None)).otherwise(F.col(v)), ignorenulls=True).over(w).alias(v) for v in values]
    return rows.select(idx, *kept)


def encode_keys(keys: DataFrame, key: str, shard_bits: int = 8) -> DataFrame:
    """(shard, place, code): sorted 48-bit keys as base-64 differences, restarted in each shard of the top bits."""
    sharded = keys.select(F.shiftright(key, 48 - shard_bits).cast("int").alias("shard"), F.col(key).alias("key")).distinct()
    return delta_encode(sharded, ["shard"], "key").select("shard", "key", base64_digits(F.col("delta"), 8, True).alias("code"))


def decode_keys(codes: DataFrame) -> DataFrame:
    return delta_decode(codes.withColumn("delta", base64_value(F.col("code"))), ["shard"], [F.col("key")], "delta", "decoded")


def encode_repeats(df: DataFrame, key: list[str], order: list[str], values: list[str]) -> DataFrame:
    return mark_repeats(df, key, [F.col(c) for c in order], values)


def decode_repeats(df: DataFrame, key: list[str], order: list[str], values: list[str]) -> DataFrame:
    return unmark_repeats(df, key, [F.col(c) for c in order], values)


def console_table(rows: DataFrame, widest: int = 40, most: int = 1000) -> str:
    """A few result rows as text: columns as wide as needed, cut with an ellipsis; asks for at most ``most`` rows."""
    cells = [[("" if v is None else str(v)) for v in r] for r in rows.limit(most).collect()]
    cut = lambda s: s if len(s) <= widest else s[: widest - 1] + "…"
    table = [[cut(c) for c in r] for r in [rows.columns, *cells]]
    widths = [max(map(len, column)) for column in zip(*table, strict=True)]
    return "\n".join("  ".join(c.ljust(w) for c, w in zip(r, widths, strict=True)).rstrip() for r in table)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return parse_metadata(spark.read.text(path))
