"""Case files of any layout, read uniformly: each file by its own header.

Case files name and order their columns differently from one release to the
next. Here every file's header is read, its names are resolved against aliases
(``Province/State`` = ``Province_State``), and the files are read by groups of equal
headers, each with its own column order, before they are put together with one set of names
and types. The headers are read by the driver through Spark's file systems, a few at a
time in parallel: one line a file, no data.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epipanel.functions.dates import mdy_name, parse_mdy_name, parse_observation_date
from epipanel.functions.numeric import to_count

# The names that the files use for one column, without case and punctuation.
ALIASES: dict[str, tuple[str, ...]] = {
    "obs_date": ("observationdate", "obsdate", "date"),
    "state": ("provincestate", "state", "province"),
    "country": ("countryregion", "country", "region"),
    "county": ("admin2", "county"),
    "place": ("combinedkey", "location"),
    "lat": ("lat", "latitude"),
    "lon": ("long", "lon", "longitude"),
    "population": ("population",),
    "updated": ("lastupdate", "lastupdated", "updated"),
    "confirmed": ("confirmed", "cases", "totalconfirmed"),
    "deaths": ("deaths", "totaldeaths"),
    "recovered": ("recovered", "totalrecovered"),
    "active": ("active",),
    "uid": ("uid",),
    "iso2": ("iso2",),
    "iso3": ("iso3",),
    "code3": ("code3",),
    "fips": ("fips",),
}
COUNTS = ("population", "confirmed", "deaths", "recovered", "active")
HEADERS_AT_ONCE = 16


def plain_name(name: str) -> str:
    return re.sub(r"[\W_]+", "", name.strip().lstrip("﻿").lower())


def resolve_header(header: Sequence[str], aliases: Mapping[str, Sequence[str]] = ALIASES) -> list[str | None]:
    """The column that each name of a header stands for: one of ``aliases``, a
    date as ``M/d/yy``, or None for others. Two names of one column raise ValueError."""
    known = {plain_name(a): column for column, names in aliases.items() for a in (column, *names)}
    out: list[str | None] = []
    for name in header:
        day = parse_mdy_name(name.strip().lstrip("﻿"))
        out.append(mdy_name(day) if day else known.get(plain_name(name)))
    twice = sorted({c for c in out if c and out.count(c) > 1})
    if twice:
        raise ValueError(f"several columns of {list(header)} stand for {twice}")
    return out


def read_headers(spark: SparkSession, path: str) -> dict[str, tuple[str, ...]]:
    """The header of every data file under ``path`` (a file, folder or glob; compressed
    files too). Hidden files and empty ones are left out."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    found = fs.globStatus(root)
    if not found:
        raise FileNotFoundError(path)
    files: list[str] = []
    for status in found:
        if status.isFile():
            files.append(status.getPath().toString())
            continue
        listed = fs.listFiles(status.getPath(), True)
        while listed.hasNext():
            file = listed.next()
            inside = file.getPath().toString()[len(status.getPath().toString()):]
            if not any(part[:1] in "._" for part in inside.split("/") if part) and file.getLen() > 0:
                files.append(file.getPath().toString())
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def header(file: str) -> tuple[str, ...]:
        at = jvm.org.apache.hadoop.fs.Path(file)
        stream = fs.open(at)
        codec = codecs.getCodec(at)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            return tuple(next(csv.reader([reader.readLine() or ""]), ()))
        finally:
            reader.close()

    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        return {f: h for f, h in zip(sorted(files), pool.map(header, sorted(files))) if h}


def _typed(column: str, raw: Column) -> Column:
    if column == "obs_date":
        return parse_observation_date(raw)
    if column in COUNTS or parse_mdy_name(column):
        return to_count(raw)
    if column in ("lat", "lon"):
        return raw.try_cast("double")
    return raw


def load_uniform(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, aliases: Mapping[str, Sequence[str]] = ALIASES
) -> DataFrame:
    """All files under ``path`` as one typed table with uniform names.

    * every file's own header decides where its columns are; files with the same header are read together;
    * the result has ``columns`` (default: every known column of any file, in the order of ``aliases``,
      then the dates in order); a column that a file lacks is null there; unknown columns are left out;
    * dates become ``date``, counts ``bigint`` (``5.0`` is 5), coordinates ``double``, others stay text; what cannot be read is null;
    * a file in which two columns stand for one, or no file at all, raises; a header alone gives no rows.
    """
    headers = read_headers(spark, path)
    layouts: dict[tuple[str, ...], list[str]] = {}
    for file, header in headers.items():
        layouts.setdefault(header, []).append(file)
    if not layouts:
        raise ValueError(f"no file with a header under {path}")
    resolved = {header: resolve_header(header, aliases) for header in layouts}
    if columns is None:
        seen = {c for r in resolved.values() for c in r if c}
        columns = [c for c in aliases if c in seen] + sorted((c for c in seen if c not in aliases), key=parse_mdy_name)
    parts = []
    for header, files in layouts.items():
        # by position: names in a file may be repeated or empty
        schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(header))])
        raw = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(files)
        place = {c: i for i, c in enumerate(resolved[header]) if c}
        cells = [(c, F.col(f"_{place[c]}") if c in place else F.lit(None).cast("string")) for c in columns]
        parts.append(raw.select(*[_typed(c, cell).alias(c) for c, cell in cells]))
    return reduce(DataFrame.unionAll, parts)


def load_observations(spark: SparkSession, path: str) -> DataFrame:
    """Daily observation files of any layouts, as :func:`epipanel.sources.files.read_observations` gives them."""
    return load_uniform(spark, path, ["obs_date", "state", "country", "confirmed", "deaths", "recovered"])
