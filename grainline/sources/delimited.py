"""Delimited exports: all columns are text, and headers may differ from file to file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainline.session import scratch
from grainline.spec import TableSpec

CSV_OPTIONS = {
    "header": "true",
    "inferSchema": "false",
    "multiLine": "false",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}


def normalized(names: list[str]) -> list[str]:
    """Trimmed, lower-case names with underscores; two names may not become the same."""
    out = [n.strip().lower().replace(" ", "_") for n in names]
    twice = sorted({n for n in out if out.count(n) > 1})
    if twice:
        raise ValueError(f"column names collide after normalisation: {twice}")
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*normalized(df.columns))


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def scan_csv(spark: SparkSession, path: str, columns: list[str], labels: list[str] = ()) -> DataFrame:
    """Read files that share one header. Partition labels stay text, so ``month=01`` is "01"."""
    return spark.read.options(**CSV_OPTIONS).schema(text_schema([*columns, *labels])).csv(path)


def _listing(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    )


def _plain(path: Column) -> Column:
    """One spelling of a local file URI: ``file:///a`` and ``file:/a`` are the same."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, length, modificationTime) of the non-empty files below ``root``; no content is read."""
    return _listing(spark, root, pattern).select(_plain(F.col("path")).alias("path"), "length", "modificationTime")


def all_paths(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """The paths of all files below ``root``, empty ones included. Only names pass the driver, as in any scan."""
    names = [(p,) for p in _listing(spark, root, pattern).inputFiles()]
    decoded = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    return spark.createDataFrame(names, "path string").select(_plain(decoded).alias("path"))


def file_opener():
    """A function that opens a byte stream for a file URI inside a task.

    It is made here, not at module level, so that it travels to the executors by value:
    they need pyarrow, not this package.
    """

    def open_file(path, compression="detect"):
        from pyarrow import fs

        # the listed path is plain text, so only the root of a store goes through a URI parser
        scheme, _, rest = path.partition(":")
        if scheme == "file":
            system, inner = fs.LocalFileSystem(), "/" + rest.lstrip("/")
        else:
            host, _, below = rest.lstrip("/").partition("/")
            system, base = fs.FileSystem.from_uri(f"{scheme}://{host}/")
            inner = f"{base.rstrip('/')}/{below}"
        return system.open_input_stream(inner, compression=compression)

    return open_file


def _header_reader():
    open_file = file_opener()
    longest = 1 << 20

    def first_line(path):
        with open_file(path) as stream:
            line = b""
            while b"\n" not in line:
                more = stream.read(16_384)
                if not more:
                    break
                line += more
                if len(line) > longest:
                    raise ValueError(f"{path}: no line end within the first {longest} bytes")
        return line.split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r")

    def read(batches):
        import csv

        for batch in batches:
            header = [first_line(p) for p in batch["path"]]
            yield batch.assign(header=header, names=[next(csv.reader([h]), []) for h in header])

    return read


def file_headers(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """(path, file, header, names) per non-empty file, names parsed as CSV. A task reads the first line of its files.

    ``file`` is the path as Spark names it in ``_metadata``.
    """
    files = _listing(spark, root, pattern).where(F.col("length") > 0)
    files = files.select(_plain(F.col("path")).alias("path"), F.col("_metadata.file_path").alias("file"))
    return files.mapInPandas(_header_reader(), "path string, file string, header string, names array<string>")


def schema_differences(headers: DataFrame, expected: list[str]) -> DataFrame:
    """(path, column_name, finding) with finding missing, extra or moved. Row-local."""
    bare = F.transform("names", lambda n: F.replace(F.lower(F.trim(n)), F.lit(" "), F.lit("_")))
    wanted = F.array(*[F.lit(c) for c in expected])
    rows = headers.select("path", bare.alias("actual"), wanted.alias("wanted"))
    missing = F.array_except("wanted", "actual")
    extra = F.array_except("actual", "wanted")
    moved = F.filter(
        F.array_intersect("wanted", "actual"),
        lambda n: F.array_position(F.col("actual"), n) != F.array_position(F.col("wanted"), n),
    )

    def named(columns, finding):
        return F.transform(columns, lambda n: F.struct(n.alias("column_name"), F.lit(finding).alias("finding")))

    findings = F.concat(named(missing, "missing"), named(extra, "extra"), named(moved, "moved"))
    return rows.select("path", F.explode(findings).alias("f")).select("path", "f.*")


def missing_labels(headers: DataFrame, labels: list[str]) -> DataFrame:
    """(path, label) for files whose path lacks a partition label."""
    absent = F.filter(
        F.array(*[F.lit(x) for x in labels]), lambda n: ~F.contains(F.col("path"), F.concat(F.lit("/"), n, F.lit("=")))
    )
    return headers.select("path", F.explode(absent).alias("label"))


def file_findings(spark: SparkSession, root: str, spec: TableSpec, pattern: str = "*.csv") -> DataFrame:
    """(path, finding, column_name): empty files, files outside the pattern, missing labels, missing and extra columns."""
    labels = list(spec.partitions)
    headers = file_headers(spark, root, pattern)
    none = F.lit(None).cast("string").alias("column_name")
    filled = list_files(spark, root).select("path")
    matching = all_paths(spark, root, pattern)
    empty = matching.join(filled, "path", "left_anti").select("path", F.lit("empty_file").alias("finding"), none)
    stray = all_paths(spark, root).join(matching, "path", "left_anti").select("path", F.lit("outside_pattern").alias("finding"), none)
    unlabelled = missing_labels(headers, labels).select("path", F.lit("missing_label").alias("finding"), F.col("label").alias("column_name"))
    columns = schema_differences(headers, [n for n in spec.names if n not in labels]).where("finding <> 'moved'")
    columns = columns.select("path", F.concat("finding", F.lit("_column")).alias("finding"), "column_name")
    return empty.unionByName(stray).unionByName(unlabelled).unionByName(columns)


def data_lines(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """(file, source_rows): the lines of each file that are not blank, less its header. Counted apart from the CSV parser."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(root)
    filled = lines.where(F.trim("value") != "").groupBy(F.col("_metadata.file_path").alias("file"))
    return filled.agg((F.count(F.lit(1)) - 1).alias("source_rows"))


def _label(file: Column, name: str) -> Column:
    """The value of ``name=`` in a path; undone are the encoding of the URI and that of the folder name."""
    found = F.regexp_extract(file, f"/{name}=([^/]*)/", 1)
    for _ in range(2):
        found = F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B")))
    return F.when(found.isin("", "__HIVE_DEFAULT_PARTITION__"), None).otherwise(found)


def union_drifting(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column absent from one export is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_raw(
    spark: SparkSession, root: str | list[str], spec: TableSpec, pattern: str = "*.csv", file_column: str | None = None
) -> DataFrame:
    """All files of a table as text, matched by column name rather than by position, in one scan.

    Every non-empty file below ``root`` that the pattern matches is read, whatever its depth; a
    file outside its partition folders has NULL labels, which the gate reports. A missing nullable column of a fact becomes NULL; a missing required column fails. New
    columns are kept out of the result for facts and fail for dimensions. ``root`` may be a list of files; ``file_column``
    adds the file of each row, as Spark names it.
    """
    labels = list(spec.partitions)
    expected = [n for n in spec.names if n not in labels]
    required = {c.name for c in spec.columns if not c.nullable} - set(labels)
    # one small row per file, written so that Spark knows its size when it joins
    at = scratch(spark, "headers")
    file_headers(spark, root, pattern).select("file", "header", "names").write.parquet(at)
    headers = spark.read.parquet(at)
    layouts = {r["header"]: normalized(r["names"]) for r in headers.groupBy("header").agg(F.first("names").alias("names")).collect()}
    if not layouts:
        raise ValueError(f"{spec.name}: no rows below {root}")
    for header, names in sorted(layouts.items()):
        absent = [n for n in expected if n not in names]
        extra = [n for n in names if n not in expected]
        if required & set(absent) or (spec.role == "dimension" and absent):
            raise ValueError(f"{spec.name}: missing required columns {absent} below {root} (header {header[:200]})")
        if extra and spec.role == "dimension":
            raise ValueError(f"{spec.name}: unexpected columns {extra} below {root} (header {header[:200]})")
    # by position first, the same for every file; the header of the file then says which position a column has
    width = max(map(len, layouts.values()))
    read = spark.read.options(**CSV_OPTIONS).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    rows = read.schema(text_schema([f"_c{k}" for k in range(width)])).csv(root).select("*", F.col("_metadata.file_path").alias("file"))

    def place(name):
        found = [F.when(F.col("header") == h, F.col(f"_c{names.index(name)}")) for h, names in layouts.items() if name in names]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    if len(layouts) == 1:
        rows = rows.withColumn("header", F.lit(next(iter(layouts))))
    else:
        rows = rows.join(headers.select("file", "header"), "file")
    named = [F.col("file").alias(file_column)] if file_column else []
    return rows.select(*[(_label(F.col("file"), n) if n in labels else place(n)).alias(n) for n in spec.names], *named)
