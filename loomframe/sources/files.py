"""Readers, each a declared schema and a lazy scan, and a writer of many small files."""

from __future__ import annotations

import math
import os
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomframe.session import stored


#: So many names with more than one line are looked up; the lines of other names are not shuffled.
FEW_NAMES = 10_000


def write_each(df: DataFrame, name: str, line: str, folder: str) -> list[str]:
    """Write one text file per name (without ``/``) that holds its lines; gives the folders of files.

    Every task has one folder for all its files, which costs far less than a folder and a
    committed file per name. The folders of tasks that failed are not in the list. ``df`` is
    read more than once and must give the same rows each time.
    """
    def write(batches):
        import contextlib
        import os
        import uuid
        from urllib.parse import unquote, urlparse

        import pyarrow as pa

        parsed = urlparse(folder)
        store, own = None, f"{folder}/{uuid.uuid4().hex}"
        inner = unquote(urlparse(own).path)
        if parsed.scheme not in ("", "file"):
            from pyarrow import fs
            store, inner = fs.FileSystem.from_uri(own)
        last, files = None, contextlib.ExitStack()
        with files:
            for batch in batches:
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if key != last:
                        if last is None:
                            store.create_dir(inner, recursive=True) if store else os.makedirs(inner)
                        files.close()
                        out = files.enter_context(store.open_output_stream(f"{inner}/{key}") if store
                                                  else open(f"{inner}/{key}", "wb"))
                        last = key
                    out.write(text.as_buffer() if text.is_valid else b"")
                    out.write(b"\n")
        if last is not None:
            yield pa.RecordBatch.from_pydict({"folder": [own]})

    rows = df.select(F.col(name).cast("string").alias("name"), F.col(line).cast("string").alias("line"))
    again = stored(rows.groupBy("name").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 1))
    names, lines = again.agg(F.count(F.lit(1)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    # A file's lines come one after the other, so a task has one open file.
    if names <= FEW_NAMES and 2 * lines <= rows.count():  # lines of the other names stay where they are
        few = F.broadcast(again.select(F.col("name").alias("_again")))
        same = rows["name"].eqNullSafe(F.col("_again"))
        shuffled = rows.join(few, same, "left_semi").repartition("name").sortWithinPartitions("name")
        rows = rows.join(few, same, "left_anti").unionByName(shuffled).coalesce(
            int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    else:
        rows = rows.repartition("name").sortWithinPartitions("name")
    found = [r["folder"] for r in stored(rows.mapInArrow(write, "folder string")).collect()]  # one per task
    if not found:  # an empty folder
        df.sparkSession.createDataFrame([], "value string, part string").write.partitionBy("part").text(folder)
    return found or [folder]


def read_csv(spark: SparkSession, path: str | list[str], schema, quote: str = '"') -> DataFrame:
    """Comma-separated text with a header line; NaN and empty fields become null."""
    df = spark.read.schema(schema).csv(path, header=True, quote=quote, escape="\\")
    return nan_to_null(df)


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats}) if floats else df


# The sensor file's column layout (three identical body units).
_UNIT = ["temp_1", *[f"{kind}_{axis}" for kind in ("acc16", "acc6", "gyro", "mag")
                          for axis in (1, 2, 3)], *[f"orient_{i}" for i in (1, 2, 3, 4)]]
SENSOR_COLUMNS = ["timestamp", "activity_id", "heart_rate",
                  *[f"{place}_{name}" for place in ("hand", "chest", "ankle") for name in _UNIT]]

# Activity codes of the recordings and the codes used instead.
ACTIVITY_CODES = {0: 12, 1: 0, 2: 1, 3: 2, 4: 3, 5: 4, 6: 5, 7: 6, 12: 7, 13: 8, 16: 9, 17: 10,
                  24: 11}


def sensor_schema(names: Sequence[str] = tuple(SENSOR_COLUMNS)) -> T.StructType:
    kinds = {"timestamp": T.DoubleType(), "activity_id": T.IntegerType()}
    return T.StructType([T.StructField(n, kinds.get(n, T.FloatType())) for n in names])


def read_sensor_files(spark: SparkSession, paths: str | list[str], pattern: str,
                      names: Sequence[str] = tuple(SENSOR_COLUMNS),
                      subject: str = r"(\d+)\.[^./]*$") -> DataFrame:
    """Blank-separated sensor files: time, activity and the columns whose name
    matches; the subject is the number that a pattern finds in the file's path,
    by default the digits at the end of its name."""
    df = spark.read.schema(sensor_schema(names)).csv(paths, sep=" ", header=False,
                                                      nullValue="NaN", nanValue="NaN")
    wanted = [n for n in names if n not in ("timestamp", "activity_id") and re.search(pattern, n)]
    found = F.regexp_extract(F.col("_metadata.file_path"), subject, 1).try_cast("long")
    return nan_to_null(df.select(found.alias("subject_id"), "timestamp", "activity_id", *wanted))


# Header fields of the message documents; others can be added by the caller.
HEADERS = ("From", "To", "Cc", "X-bcc", "Subject", "Date")


def message_schema(headers: Sequence[str] = HEADERS) -> T.StructType:
    fields = [T.StructField(h, T.StringType()) for h in headers]
    return T.StructType([T.StructField("_id", T.StringType()), T.StructField("body", T.StringType()),
                         T.StructField("headers", T.StructType(fields))])


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents, one per line, with the nested headers they may have."""
    return spark.read.schema(message_schema()).json(path)


def flat_messages(df: DataFrame) -> DataFrame:
    """The columns the mail operators use."""
    names = {"sender": "From", "rcpt": "To", "cc": "Cc", "bcc": "X-bcc", "subject": "Subject",
             "date": "Date"}
    return df.select(F.col("_id").alias("id"),
                     *[F.col(f"headers.`{h}`").alias(n) for n, h in names.items()])


# Endings of files that Spark's reader unpacks.
PACKED = (".deflate", ".gz", ".bz2", ".lz4", ".snappy", ".zst")

#: Bytes that a task of ``read_corpus`` reads about; a file counts as the second number at least.
READ_BYTES, OPEN_BYTES = 64 << 20, 8 << 10


def _local_paths(spark: SparkSession, path: str | list[str]) -> list[str] | None:
    """The paths as those of local files or folders; None if one is a pattern, missing or in another store."""
    context = spark.sparkContext
    default = context._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(context._jsc.hadoopConfiguration())
    found = []
    for given in [path] if isinstance(path, str) else path:
        plain = re.sub(r"^file:(//(?=/))?", "", given)
        known = plain.startswith("/") if plain != given else default.getScheme() == "file"
        if not known or re.match(r"[^/]*:|//|$", plain) or re.search(r"[{}\[\]*?\\]", plain):
            return None
        found.append(os.path.abspath(plain))
        if not os.path.exists(found[-1]):
            return None
    return found or None


def _listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, name, size)`` of the files in local folders and the folders in them, without hidden ones.

    Tasks list all folders of a level side by side, so no list of files is held in one place.
    A file that lies below two of the paths is listed twice.
    """
    def entries(batches):
        import os

        import pyarrow as pa

        schema = pa.schema([("path", pa.string()), ("name", pa.string()), ("size", pa.int64())])

        def hidden(name, folder):  # as in Spark's listing
            if folder and name.startswith(("_metadata", "_common_metadata")):
                return False
            return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")

        def inside(path):
            if not os.path.isdir(path):
                if not hidden(os.path.basename(path), False):
                    yield path, os.path.basename(path), os.path.getsize(path)
                return
            with os.scandir(path) as found:
                for entry in found:
                    folder = entry.is_dir()
                    if hidden(entry.name, folder) or not os.path.exists(entry.path):  # (a link to nothing)
                        continue
                    yield entry.path, entry.name, None if folder else entry.stat().st_size

        rows = []
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in inside(path):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*rows), schema.types)], schema=schema)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*rows), schema.types)], schema=schema)

    level, found = spark.createDataFrame([(p,) for p in dict.fromkeys(paths)], "path string"), []
    while not found or not level.isEmpty():
        level = level.repartition(spark.sparkContext.defaultParallelism)
        seen = stored(level.mapInArrow(entries, "path string, name string, size long"))
        found.append(seen.filter(F.col("size").isNotNull()))
        level = seen.filter(F.col("size").isNull()).select("path")
    return reduce(DataFrame.unionByName, found)


def read_corpus(spark: SparkSession, path: str | list[str], glob: str = "*.txt", number: str = r"/(\d+)[^/]*$") -> DataFrame:
    """One row per text file with the number a pattern finds in its path (by default
    the digits its name starts with), in that order.

    Local files are listed, put in order by name and read by tasks, so the driver holds none of
    their names and no text is shuffled. Other stores, patterns of paths and packed files go
    through Spark's reader, which holds an entry per file in the driver.
    """
    paths = _local_paths(spark, path)
    if paths is not None:
        # The pattern as Hadoop reads it, for the whole name.
        wanted = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
        # Spark's reader gives no row for an empty file.
        listed = _listed(spark, paths).filter(F.col("name").rlike(rf"(?s)\A(?:{wanted})\z") & (F.col("size") > 0))
        packed = reduce(lambda a, b: a | b, [F.col("name").endswith(e) for e in PACKED])
        cost, unpack = listed.agg(F.sum(F.greatest("size", F.lit(OPEN_BYTES))), F.count_if(packed)).first()
        if not unpack:
            return _read_listed(listed, number, max(1, math.ceil((cost or 0) / READ_BYTES)))
    df = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(
        path, wholetext=True)
    # File names in the metadata are encoded as in a URL.
    def plain(name: str) -> Column:
        return F.url_decode(F.replace(F.col(f"_metadata.{name}"), F.lit("+"), F.lit("%2B")))
    name = plain("file_name")
    found = F.regexp_extract(plain("file_path"), number, 1).try_cast("long")
    return df.select(found.alias("number"), name.alias("name"), F.col("value").alias("text")
                     ).orderBy("number", "name")


def _read_listed(listed: DataFrame, number: str, tasks: int) -> DataFrame:
    """``(number, name, text)`` of listed local files in order, each file once."""
    def texts(batches):
        import pyarrow as pa

        schema = pa.schema([("number", pa.int64()), ("name", pa.string()), ("text", pa.binary())])
        last, rows, held = None, [], 0
        for batch in batches:
            for key, name, path in zip(*[c.to_pylist() for c in batch.columns]):
                if path == last:
                    continue
                with open(path, "rb") as file:
                    rows.append((key, name, file.read()))
                last, held = path, held + len(rows[-1][2])
                if held >= 8 << 20 or len(rows) == 10_000:
                    yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*rows), schema.types)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*rows), schema.types)], schema=schema)

    key = ["number", "name", "path"]
    found = F.regexp_extract(F.concat(F.lit("file:"), "path"), number, 1).try_cast("long")
    rows = listed.select(found.alias("number"), "name", "path").repartitionByRange(tasks, *key).sortWithinPartitions(*key)
    return rows.mapInArrow(texts, "number long, name string, text binary").withColumn(
        "text", F.col("text").cast("string"))


def read_pairs(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Lines of numbers separated by white space, without a header."""
    parts = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).filter(F.trim("value") != "").select(
        *[F.get(parts, F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)])


def read_results(spark: SparkSession, path: str, schema, cols: Sequence[str]) -> DataFrame:
    """Some columns of a tab-separated log with a header line."""
    return spark.read.schema(schema).csv(path, sep="\t", header=True).select(*cols)


def result_by_id(spark: SparkSession, path: str, schema, id_column: str, value) -> DataFrame:
    """All columns of the log's rows for one experiment."""
    return spark.read.schema(schema).csv(path, sep="\t", header=True).filter(F.col(id_column) == F.lit(value))


# -- pages --------------------------------------------------------------------

# The character entities decoded in page text, ampersand last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def block_text(html: Column, css_class: str) -> Column:
    """Text of the ``div`` blocks of a class, with that of the blocks inside them."""
    name = re.escape(css_class)
    value = "|".join([f'"(?:[^"]*\\s)?{name}(?:\\s[^"]*)?"', f"'(?:[^']*\\s)?{name}(?:\\s[^']*)?'", f"{name}(?=[\\s>])"])
    wanted = rf"(?s)^<(?i:div)\b[^>]*\b(?i:class)\s*=\s*(?:{value})"
    parts = F.regexp_extract_all(html, F.lit(r"(?s)<[^>]*>|[^<]+|<"), F.lit(0))

    def step(state: Column, part: Column) -> Column:
        opens, closes = F.rlike(part, F.lit(r"^<(?i:div)\b")), F.rlike(part, F.lit(r"^</(?i:div)\b"))
        depth = F.when(opens & ((state["depth"] > 0) | F.rlike(part, F.lit(wanted))), state["depth"] + 1) \
            .when(closes & (state["depth"] > 0), state["depth"] - 1).otherwise(state["depth"])
        inside = (state["depth"] > 0) & ~F.rlike(part, F.lit(r"(?s)^<[^>]*>$"))
        return F.struct(depth.alias("depth"), F.when(inside, F.concat(state["text"], part)).otherwise(state["text"])
                        .alias("text"))

    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"))
    text = F.aggregate(parts, start, step, lambda state: state["text"])
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def assemble_pages(df: DataFrame, doc: str, page: str, html: str, css_class: str) -> DataFrame:
    """``(doc, text)``: block texts of a document's pages, in page order."""
    texts = df.select(doc, page, block_text(F.col(html), css_class).alias("t"))
    # Only pages with text travel; a document's text is one value of the result.
    pages = F.array_sort(F.collect_list(F.when(F.col("t") != "", F.struct(page, "t"))))
    return texts.groupBy(doc).agg(
        F.array_join(F.transform(pages, lambda p: p["t"]), "").alias("text"))
