"""Landing files: readers for batch and stream, schema registry, control totals."""

from __future__ import annotations

import fnmatch
import json
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.config import Entity, Environment, Source

FILES_PER_TRIGGER = 200
RESCUED = "_rescued_data"
#: Column of the file that a row came from.
FILE = "_file_name"
#: Folder columns of the landing zone; a redelivery under another date is the same record.
FOLDER_COLUMNS = ("dt",)
_WILD = re.compile(r"[*?\[{]")


class SchemaDriftError(Exception):
    """A column went away or changed its type."""


def source_dir(path_glob: str) -> str:
    """The path before its first segment with a wildcard."""
    kept = []
    for part in path_glob.split("/"):
        if _WILD.search(part):
            break
        kept.append(part)
    else:
        kept = kept[:-1] if "." in kept[-1] else kept
    return "/".join(kept)


def _format(source: Source) -> str:
    if source.format == "avro":
        raise ValueError("avro needs a package that isn't part of this installation; land parquet or json")
    return source.format


def hinted(schema: T.StructType, hints: str | None) -> T.StructType:
    """A schema with the types that a DDL string gives; columns it alone has are added."""
    if not hints:
        return schema
    wanted = {f.name: f for f in T.StructType.fromDDL(hints).fields}
    out = [wanted.pop(f.name, f) for f in schema.fields]
    return T.StructType(out + list(wanted.values()))


def infer_schema(spark: SparkSession, path: str | list[str], source: Source, hints: str | None = None, root: str | None = None) -> T.StructType:
    """One-shot schema of the given files or folder; strings for csv and json values stay as inferred.

    Fields of json files that are NULL everywhere have no type yet and are left out. Files of one column under
    several types (parquet) are folded one by one.
    """
    reader = spark.read.format(_format(source)).options(**source.options)
    if root:
        reader = reader.option("basePath", root)
    if source.format == "csv":
        reader = reader.option("inferSchema", "true")
    if source.format == "json":
        reader = reader.option("dropFieldIfAllNull", "true")
    if source.format != "parquet":
        return hinted(reader.load(path).schema, hints)
    try:
        return hinted(reader.option("mergeSchema", "true").load(path).schema, hints)
    except Exception:  # incompatible types, told by no class of their own
        if isinstance(path, str):
            raise
    found = reader.load(path[0]).schema
    for p in path[1:]:
        found = check_drift(found, reader.load(p).schema, may_lack=True)
    return hinted(found, hints)


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def widened(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds all values of both, exactly; None if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.FloatType) and isinstance(y, T.DoubleType):
            return y
        if isinstance(x, _INTEGERS[:3]) and isinstance(y, T.DoubleType):
            return y
        if isinstance(x, _INTEGERS) and isinstance(y, T.DecimalType):
            whole = max(_DIGITS[type(x)], y.precision - y.scale)
            return T.DecimalType(whole + y.scale, y.scale) if whole + y.scale <= 38 else None
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale, whole = max(a.scale, b.scale), max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        item = widened(a.elementType, b.elementType)
        return item and T.ArrayType(item)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            if (kind := widened(fields.get(f.name, T.NullType()), f.dataType)) is None:
                return None
            fields[f.name] = kind
        return T.StructType([T.StructField(n, k) for n, k in fields.items()])
    return None


def check_drift(registered: T.StructType, found: T.StructType, may_lack: bool = False) -> T.StructType:
    """The schema to go on with: new columns are added, types widened where no value is lost; columns that
    are lost (unless they may be) or retyped otherwise are errors."""
    now, out = {f.name: f.dataType for f in found.fields}, []
    for f in registered.fields:
        if f.name not in now and not may_lack:
            raise SchemaDriftError(f"column {f.name} is gone")
        kind = widened(f.dataType, now.get(f.name, T.NullType()))
        if kind is None:
            raise SchemaDriftError(f"column {f.name} was {f.dataType.simpleString()}, is {now[f.name].simpleString()}")
        out.append(T.StructField(f.name, kind))
    known = set(registered.names)
    return T.StructType(out + [f for f in found.fields if f.name not in known])


def landed_files(spark: SparkSession, root: str, pattern: str) -> list[tuple[int, str]]:
    """Modification time and path of the files under a folder whose names fit a pattern; hidden ones aside."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    found, files = [], fs.listFiles(where, True)
    while files.hasNext():
        f = files.next()
        path = f.getPath()
        if fnmatch.fnmatch(path.getName(), pattern) and path.getName()[0] not in "._":
            found.append((f.getModificationTime(), path.toString()))
    return sorted(found)


class Registry:
    """Schemas of an entity on any Hadoop path: a file for each version, created once and never replaced."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.removesuffix(".json")
        self._of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._of(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def latest(self) -> dict | None:
        """version, schema, and how far it has read: seen (modification time) and the files of that time."""
        if not self._fs.exists(self._of(self.path)):
            return None
        for name in sorted((f.getPath().getName() for f in self._fs.listStatus(self._of(self.path))), reverse=True):
            if name.endswith(".json") and not name.startswith("."):
                stream = self._fs.open(self._of(f"{self.path}/{name}"))
                try:
                    text = bytes(stream.readAllBytes()).decode()
                finally:
                    stream.close()
                if text.endswith("}\n"):
                    return json.loads(text)
        return None

    def add(self, schema: T.StructType, seen: int, names: list[str]) -> None:
        last = self.latest()
        version = last["version"] + 1 if last else 0
        # a version that another run has created meanwhile is an error, not replaced
        out = self._fs.create(self._of(f"{self.path}/{version:08d}.json"), False)
        out.write(bytearray((json.dumps({"version": version, "schema": schema.json(), "seen": seen, "names": names}) + "\n").encode()))
        out.close()


def registered_schema(spark: SparkSession, env: Environment, entity: Entity) -> T.StructType:
    """The entity's schema from the registry, widened by the files that have landed since its last version.

    Only those files are read. Where one column of theirs is of another type, it is retyped (an error) only if
    none of its values fits the registered type; else the others are rescued when they are read.
    """
    registry, source = Registry(spark, env.schema_path(entity.name)), entity.source
    root, pattern = env.landing_path(source_dir(source.path_glob)), source.path_glob.rsplit("/", 1)[-1]
    last, files = registry.latest(), landed_files(spark, root, pattern)
    if last:
        files = [(t, p) for t, p in files if t > last["seen"] or (t == last["seen"] and p not in last["names"])]
        known = T.StructType.fromJson(json.loads(last["schema"]))
        if not files:
            return known
    if not files:
        return infer_schema(spark, root, source, entity.schema_hints)
    paths = [p for _, p in files]
    found = infer_schema(spark, paths, source, entity.schema_hints, root)
    if last:
        found = _settled(spark, paths, root, source, known, found)
        found = check_drift(known, hinted(found, entity.schema_hints), may_lack=source.format == "json")
    newest = max(t for t, _ in files)
    registry.add(found, newest, [p for t, p in files if t == newest] + ([p for p in last["names"] if newest == last["seen"]] if last else []))
    return found


def _settled(spark: SparkSession, paths: list[str], root: str, source: Source, known: T.StructType, found: T.StructType) -> T.StructType:
    """The found schema, with the known type for text columns of which some value fits it (or that have none)."""
    now = {f.name: f.dataType for f in found.fields}
    odd = [f for f in known.fields if f.name in now and widened(f.dataType, now[f.name]) is None]
    if source.format == "parquet" or not odd:
        return found
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in found.fields])
    rows = spark.read.format(source.format).options(**source.options).option("basePath", root).schema(text).load(paths)
    values = [c for f in odd for c in (F.count(f.name).alias(f"n_{f.name}"), F.count(F.col(f.name).try_cast(f.dataType)).alias(f"ok_{f.name}"))]
    counts = rows.agg(*values).first()
    kept = {f.name: f.dataType for f in odd if counts[f"ok_{f.name}"] or not counts[f"n_{f.name}"] or isinstance(f.dataType, T.StringType)}
    return T.StructType([T.StructField(f.name, kept.get(f.name, f.dataType)) for f in found.fields])


def rescued(raw: DataFrame, schema: T.StructType, broken: str | None = None) -> DataFrame:
    """Columns of schema, cast, and RESCUED: a JSON object of what doesn't fit.

    raw holds a file's columns as they are (strings of text formats, a parquet file's own types). A value that
    its column's type can't hold, or of a column that the schema lacks, stays under its name; `broken` is the
    column of raw with lines that didn't parse. Nothing is lost, and rows of which all fits have NULL.
    """
    kinds, kept, left = dict(raw.dtypes), [], {}
    for f in schema.fields:
        if f.name == RESCUED:
            continue
        if f.name not in kinds:
            kept.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = F.col(f"`{f.name}`")
        if kinds[f.name] == f.dataType.simpleString():
            kept.append(value)
            continue
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        if nested and kinds[f.name] != "string":
            kept.append(F.from_json(F.to_json(value), f.dataType).alias(f.name))
            continue
        cast = F.from_json(value, f.dataType) if nested else value.try_cast(f.dataType)
        if kinds[f.name] not in ("string", "binary"):  # numbers that would be cut don't fit
            cast = F.when(cast.try_cast(kinds[f.name]).eqNullSafe(value), cast)
        kept.append(cast.alias(f.name))
        left[f.name] = F.when(cast.isNull() & value.isNotNull(), value.cast("string"))
    for c in raw.columns:
        if c not in schema.names and c not in (broken, RESCUED):
            value = F.col(f"`{c}`")
            left[c] = value.cast("string") if not kinds[c].startswith(("struct", "array", "map")) else F.to_json(value)
    if broken:
        left["_broken"] = F.col(broken)
    if not left:
        return raw.select(*kept, F.lit(None).cast("string").alias(RESCUED))
    pairs = F.map_filter(F.map_from_arrays(F.array(*[F.lit(n) for n in left]), F.array(*left.values())), lambda k, v: v.isNotNull())
    return raw.select("*", pairs.alias("_left")).select(*kept, F.when(F.size("_left") > 0, F.to_json("_left")).alias(RESCUED))


def rescued_json(lines: DataFrame, schema: T.StructType, *others: str) -> DataFrame:
    """As rescued, of json lines (a string column `value`); other columns go along.

    Each object is read as a map of its raw values, so a field is NULL, fits its type, or is rescued as it came.
    """
    known = [f for f in schema.fields if f.name != RESCUED and f.name not in others]
    m = lines.withColumn("_m", F.from_json("value", "map<string,string>"))
    left = F.map_filter("_m", lambda k, v: ~k.isin(*[f.name for f in known]) & v.isNotNull())
    kept = []
    for f in known:
        value = F.try_element_at(F.col("_m"), F.lit(f.name))
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        cast = F.from_json(value, f.dataType) if nested else value.try_cast(f.dataType)
        kept.append(cast.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            bad = cast.isNull() & value.isNotNull()
            left = F.map_concat(left, F.when(bad, F.create_map(F.lit(f.name), value)).otherwise(F.create_map().cast("map<string,string>")))
    broken = F.col("_m").isNull() & (F.length(F.trim("value")) > 0)
    left = F.when(broken, F.create_map(F.lit("_broken"), F.col("value"))).otherwise(left)
    blank = F.length(F.trim("value")) == 0
    return m.where(~blank).select(*others, *kept, F.when(F.size(left) > 0, F.to_json(left)).alias(RESCUED))


_BROKEN = "_broken_line"


def read_stream(spark: SparkSession, env: Environment, entity: Entity, schema: T.StructType | None = None, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """A stream of the entity's files that no checkpoint has seen, with FILE (where each row came from) and what didn't fit."""
    source, schema = entity.source, schema or registered_schema(spark, env, entity)
    root, pattern = env.landing_path(source_dir(source.path_glob)), source.path_glob.rsplit("/", 1)[-1]
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", pattern)
    return _fitted(reader, source, schema, root)


def _fitted(reader, source: Source, schema: T.StructType, root: str) -> DataFrame:
    """A batch or stream of files in the given schema; partition folders are columns like others."""
    folders = [f for f in schema.fields if f.name in FOLDER_COLUMNS]
    if source.format == "json" and source.options.get("multiLine", "false").lower() != "true":
        lines = reader.format("text").schema(T.StructType([T.StructField("value", T.StringType()), *folders])).load(root)
        lines = lines.select("*", F.col("_metadata.file_path").alias(FILE))
        return rescued_json(lines, schema, FILE, *[f.name for f in folders])
    reader = reader.format(_format(source)).options(**source.options)
    if source.format == "parquet":
        got = reader.schema(schema).load(root)
        return got.select("*", F.col("_metadata.file_path").alias(FILE), F.lit(None).cast("string").alias(RESCUED))
    text = T.StructType([*[f if f in folders else T.StructField(f.name, T.StringType()) for f in schema.fields], T.StructField(_BROKEN, T.StringType())])
    got = reader.schema(text).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BROKEN).load(root)
    got = got.select("*", F.col("_metadata.file_path").alias(FILE))
    return rescued(got, T.StructType([*schema.fields, T.StructField(FILE, T.StringType())]), _BROKEN)


def read_batch(spark: SparkSession, env: Environment, entity: Entity, schema: T.StructType | None = None) -> DataFrame:
    """All of the entity's files at once, in the given schema (or the registry's); dt= folders become a column.

    Csv files are read under their own headers, parquet files under their own types: files of one header, or
    schema, together. So columns that the schema lacks, and values that don't fit, are rescued by name.
    """
    source = entity.source
    root, pattern = env.landing_path(source_dir(source.path_glob)), source.path_glob.rsplit("/", 1)[-1]
    schema = schema or registered_schema(spark, env, entity)
    if source.format == "json":
        return _fitted(spark.read.option("pathGlobFilter", pattern), source, schema, root)
    whole = T.StructType([*schema.fields, T.StructField(FILE, T.StringType())])
    groups: dict[str, list[str]] = {}
    for _, path in landed_files(spark, root, pattern):
        one = spark.read.format(_format(source)).options(**source.options).option("basePath", root)
        groups.setdefault(one.load(path).schema.json(), []).append(path)
    parts = []
    for kind, paths in groups.items():
        own = T.StructType.fromJson(json.loads(kind))
        reader = spark.read.format(source.format).options(**source.options).option("basePath", root)
        if source.format == "csv":
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BROKEN)
            own = T.StructType([*own.fields, T.StructField(_BROKEN, T.StringType())])
        got = reader.schema(own).load(paths).select("*", F.col("_metadata.file_path").alias(FILE))
        parts.append(rescued(got, whole, _BROKEN if source.format == "csv" else None))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], T.StructType([*whole.fields, T.StructField(RESCUED, T.StringType())]))


def control_totals(spark: SparkSession, path: str) -> dict | None:
    """The source's own totals for a batch: revenue, planted defects; None if it sent none. Any Hadoop path will do."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return None
    return json.loads(spark.read.option("wholetext", "true").text(path).first()[0])
