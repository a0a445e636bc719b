"""Declared-schema, read-only Parquet tables.

A table is a *projection* over ``spark.read.parquet``: file column *i* feeds
declared column *i* whatever its name (positional binding), surplus declared
columns are NULL, surplus file columns are never read, and every column is
converted to its declared type (``types.conform``). Because the result is a
projection, Catalyst still prunes columns and pushes filters into the scan, and
a temp view over it refuses INSERT.

Many files: files are grouped by footer signature (names and types in file
order) in a distributed job, each group is read once and bound by position,
and the groups are unioned. Schema inference is tried first; the footer is
consulted only when Spark refuses a column type (half float, nanosecond
timestamp, decimal wider than 38 digits, time of day).
"""

from __future__ import annotations

import functools
import json

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from medley.errors import CorruptTableError, NoSuchTableError, ReadOnlyTableError
from medley.session import local_path, scratch_path
from medley.sources import types as ty

POSITION_COLUMNS = ("file_path", "row_index")
REFUSED = "_refused"
_CONF_PREFIX = "medley.table."


# --------------------------------------------------------------------------- footers

def _open_fs(uri: str):
    import pyarrow.fs as pafs
    for hadoop_name in ("s3a://", "s3n://"):             # the footer reader knows the store as s3
        if uri.startswith(hadoop_name):
            uri = "s3://" + uri[len(hadoop_name):]
    if "://" in uri and not uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), local_path(uri)


def footer_schema(uri: str) -> pa.Schema:
    """Arrow schema from one file's footer (reads metadata only). Legacy INT96
    timestamps, which Spark reads as instants, are reported as UTC timestamps."""
    fs, path = _open_fs(uri)
    with fs.open_input_file(path) as fh:
        pf = pq.ParquetFile(fh)
        schema = pf.schema_arrow
        int96 = {pf.schema.column(i).path.split(".")[0] for i in range(len(pf.schema))
                 if pf.schema.column(i).physical_type == "INT96"}
    for i, f in enumerate(schema):
        if f.name in int96 and pa.types.is_timestamp(f.type):
            schema = schema.set(i, pa.field(f.name, pa.timestamp("us", tz="UTC")))
    return schema


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Distributed listing of the data files under ``path``, whatever their
    suffix (``glob`` narrows it; names that begin with _ or . are no data). The
    content is not read: ``binaryFile`` skips the bytes when only ``path`` is
    selected."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path")


def footers(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, sig, schema, error) of every file under ``path``, read by executors
    (``mapInPandas``) in one pass and written once: every later step reads that
    table. A file that is no Parquet raises ``CorruptTableError``."""
    def read_footers(batches):
        for pdf in batches:
            rows = []
            for p in pdf["path"]:
                try:
                    schema = footer_schema(p)
                    rows.append((p, ty.signature(schema), schema.serialize().to_pybytes(), None))
                except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as exc:
                    rows.append((p, None, None, str(exc).splitlines()[0]))
            yield pd.DataFrame(rows, columns=["path", "sig", "schema", "error"])

    target = scratch_path(spark, "footers")
    schema = "path string, sig string, schema binary, error string"
    list_files(spark, path, glob).mapInPandas(read_footers, schema).write.parquet(target)
    found = spark.read.schema(schema).parquet(target)
    bad = found.where("error is not null").limit(1).collect()
    if bad:
        raise CorruptTableError(f"cannot read {bad[0]['path']} as Parquet: {bad[0]['error']}")
    return found


def _schema_of(raw) -> pa.Schema:
    return pa.ipc.read_schema(pa.py_buffer(bytes(raw)))


def footer_signatures(found: DataFrame) -> list[tuple[str, pa.Schema, int]]:
    """(signature, schema, number of files) per distinct footer signature, most
    files first: one row per signature reaches the driver, no file list."""
    rows = (found.groupBy("sig").agg(F.first("schema").alias("schema"), F.count(F.lit(1)).alias("files"))
            .orderBy(F.col("files").desc(), "sig").collect())
    return [(r["sig"], _schema_of(r["schema"]), r["files"]) for r in rows]


def footer_groups(found: DataFrame) -> list[tuple[str, pa.Schema, list[str]]]:
    """The files of each footer signature, for a folder whose footers differ:
    then each group is read on its own. The lists are the same metadata Spark's
    own file index keeps on the driver."""
    rows = (found.groupBy("sig").agg(F.first("schema").alias("schema"),
                                     F.sort_array(F.collect_list("path")).alias("files"))
            .orderBy("sig").collect())
    return [(r["sig"], _schema_of(r["schema"]), list(r["files"])) for r in rows]


def _is_single_file(spark: SparkSession, path: str) -> bool:
    """A plain file (not a folder, even one named ``x.parquet``), asked of the
    Hadoop file system the scan itself will use."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.getFileStatus(p).isFile())
    except Exception:  # noqa: BLE001 - missing path or no JVM access (Connect)
        return path.endswith(".parquet") and "*" not in path


# --------------------------------------------------------------------------- binding

def _read_group(spark: SparkSession, files: list[str] | None, arrow_schema: pa.Schema | None,
                folder: str | None = None, glob: str | None = None):
    """Read files that share one footer; returns (df, raw fields, raw kinds).
    ``files=None`` reads every data file under ``folder`` (as listed by
    ``list_files``), for a folder whose footers all agree."""
    if files is None:
        schema, kinds = ty.read_schema(arrow_schema)
        reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        return reader.parquet(folder), list(schema.fields), kinds
    if arrow_schema is None:
        try:
            df = spark.read.parquet(*files)
            df.schema  # force inference now so refusals surface here
            return df, list(df.schema.fields), [ty.RawKind()] * len(df.schema.fields)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
                raise
        except Exception as exc:  # noqa: BLE001 - refusal types vary by version
            if "PATH_NOT_FOUND" in str(exc):
                raise
        arrow_schema = footer_schema(files[0])
    schema, kinds = ty.read_schema(arrow_schema)
    df = spark.read.schema(schema).parquet(*files)
    return df, list(schema.fields), kinds


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _refused(raw: T.StructField, kind: ty.RawKind, name: str, value) -> Column:
    """(column, raw) of a cell that has a value in the file but none in the table."""
    cell = F.col(_quoted(raw.name))
    return F.when(cell.isNotNull() & value.isNull(),
                  F.struct(F.lit(name).alias("column"), ty.raw_text(cell, raw.dataType, kind).alias("raw")))


def _bind(df: DataFrame, raw_fields, kinds, declared: T.StructType, mode: str,
          row_position: bool, refused: bool = False) -> DataFrame:
    cols = []
    for i, field in enumerate(declared.fields):
        if i < len(raw_fields):
            raw = raw_fields[i]
            expr = ty.conform(F.col(_quoted(raw.name)), raw.dataType, field.dataType,
                              kinds[i], mode)
        else:
            expr = F.lit(None).cast(field.dataType)
        cols.append(expr.alias(field.name))
    if refused:
        cells = [_refused(raw_fields[i], kinds[i], f.name, cols[i]) for i, f in enumerate(declared.fields)
                 if i < len(raw_fields) and ty.may_refuse(raw_fields[i].dataType, f.dataType, kinds[i])]
        none = F.array().cast("array<struct<column:string,raw:string>>")
        cols.append(F.filter(F.concat(none, F.array(*cells)), lambda x: x.isNotNull()).alias(REFUSED)
                    if cells else none.alias(REFUSED))
    if row_position:
        cols += [F.col("_metadata.file_path").alias("file_path"),
                 F.col("_metadata.row_index").alias("row_index")]
    return df.select(*cols)


def bind_parquet(spark: SparkSession, path: str, schema, mode: str = "permissive",
                 row_position: bool = False, glob: str | None = None) -> DataFrame:
    """A Parquet file or directory bound by position to ``schema``.

    ``schema`` is a StructType or DDL string. ``mode`` is ``permissive``
    (unconvertible cells become NULL) or ``strict`` (they fail the query).
    ``row_position`` appends ``file_path`` and ``row_index`` (S10). All data
    files of a folder are bound, whatever their suffix, unless ``glob`` names a
    part of them.
    """
    declared = ty.to_struct(schema)
    try:
        return _bound(_read(spark, path, glob), declared, mode, row_position)
    except AnalysisException as exc:
        raise _map_error(exc, path) from exc


def bind_with_rejects(spark: SparkSession, path: str, schema,
                      glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a permissive binding. ``rows`` are those of
    ``bind_parquet``; ``rejects`` has file_path, row_index, column and raw for every
    cell that holds a value in the file and could not be converted (``raw`` is that
    value as text, binary as hexadecimal digits).

    Both are projections over one reading, with the same conversions: the rows don't
    compute the rejects, and the rejects read only the columns that a conversion can
    refuse. A number that merely loses digits is converted, not refused."""
    declared = ty.to_struct(schema)
    try:
        read = _read(spark, path, glob)
        rows = _bound(read, declared, "permissive", False)
        cells = _bound(read, declared, "permissive", True, refused=True)
    except AnalysisException as exc:
        raise _map_error(exc, path) from exc
    rejects = (cells.select(*POSITION_COLUMNS, F.explode(REFUSED).alias("cell"))
               .select(*POSITION_COLUMNS, "cell.column", "cell.raw"))
    return rows, rejects


def _read(spark: SparkSession, path: str, glob: str | None = None) -> list[tuple]:
    """(DataFrame, raw fields, raw kinds) of each footer signature."""
    return [_read_group(spark, files, arrow_schema, path, glob)
            for arrow_schema, files in _groups(spark, path, glob)]


def _bound(read: list[tuple], declared: T.StructType, mode: str, row_position: bool,
           refused: bool = False) -> DataFrame:
    return functools.reduce(DataFrame.unionAll, [
        _bind(df, raw_fields, kinds, declared, mode, row_position, refused)
        for df, raw_fields, kinds in read])


def _groups(spark: SparkSession, path: str, glob: str | None = None) -> list[tuple]:
    """(Arrow schema, files) per footer signature; files None: the whole folder,
    schema None: Spark infers, and the footer is read only on refusal."""
    if _is_single_file(spark, path):
        return [(None, [path])]
    # footers known: no inference. One signature (the common case): the folder is
    # read as a whole and no file list is built.
    found = footers(spark, path, glob)
    sigs = footer_signatures(found)
    if not sigs:
        raise NoSuchTableError(f"no Parquet files under {path}")
    return [(sigs[0][1], None)] if len(sigs) == 1 else [(g[1], g[2]) for g in footer_groups(found)]


def natural_schema(spark: SparkSession, path: str) -> T.StructType:
    """The table's own columns with the types they decode to (used when a table
    is opened without a declared schema); of a folder whose footers differ, the
    columns that most files have."""
    try:
        if _is_single_file(spark, path):
            _df, fields, kinds = _read_group(spark, [path], None)
        else:
            sigs = footer_signatures(footers(spark, path))
            if not sigs:
                raise NoSuchTableError(f"no Parquet files under {path}")
            schema, kinds = ty.read_schema(sigs[0][1])
            fields = schema.fields
    except AnalysisException as exc:
        raise _map_error(exc, path) from exc
    return T.StructType([T.StructField(f.name, ty.natural_type(f.dataType, k), True)
                         for f, k in zip(fields, kinds)])


def _map_error(exc: Exception, path: str) -> Exception:
    msg = str(exc)
    if "PATH_NOT_FOUND" in msg:
        return NoSuchTableError(f"no such table file: {path}")
    return CorruptTableError(f"cannot read {path} as Parquet: {msg.splitlines()[0]}")


# --------------------------------------------------------------------------- catalog

def _conf_key(name: str, what: str) -> str:
    return f"{_CONF_PREFIX}{name.lower()}.{what}"


def _definition_path(spark: SparkSession, name: str, warehouse: str | None):
    """Where a table's definition is kept: beside the warehouse's data, on
    storage that outlives the session."""
    root = warehouse or spark.conf.get("spark.sql.warehouse.dir")
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_medley_tables/{name.lower()}.json")
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _save_definition(spark, name, warehouse, definition: dict) -> None:
    at, fs = _definition_path(spark, name, warehouse)
    out = fs.create(at, True)
    out.write(bytearray(json.dumps(definition).encode()))
    out.close()


def _load_definition(spark, name, warehouse) -> dict | None:
    """From the session, else from the warehouse (another session made it)."""
    text = spark.conf.get(_conf_key(name, "definition"), None)
    if text is None:
        at, fs = _definition_path(spark, name, warehouse)
        if not fs.exists(at):
            return None
        text = spark.read.text(at.toString(), wholetext=True).first()[0]
    return json.loads(text)


def create_table(spark: SparkSession, name: str, schema, path: str | None = None,
                 warehouse: str | None = None, mode: str = "permissive",
                 replace: bool = False) -> DataFrame:
    """Register ``name`` -> (declared schema, path) as a read-only view.

    Path defaults to ``<warehouse>/<name>.parquet``. The view is a projection,
    so INSERT into it is refused by Spark (S9). The definition is also kept in
    the warehouse folder (``spark.sql.warehouse.dir`` unless one is given), so
    ``open_table`` finds it from a later session.
    """
    if path is None:
        if warehouse is None:
            raise ValueError("give a path or a warehouse folder")
        path = f"{warehouse.rstrip('/')}/{name}.parquet"
    if not replace and spark.catalog.tableExists(name):
        raise ValueError(f"table {name} already exists")
    declared = ty.to_struct(schema)
    df = bind_parquet(spark, path, declared, mode)
    df.createOrReplaceTempView(name)
    definition = {"path": path, "schema": declared.jsonValue(), "mode": mode}
    spark.conf.set(_conf_key(name, "definition"), json.dumps(definition))
    _save_definition(spark, name, None, definition)
    return df


def _group_sql(spark: SparkSession, path: str, declared: T.StructType, arrow_schema, files,
               mode: str, glob: str | None) -> str:
    """SELECT text that binds the files of one footer signature by position."""
    df, raw_fields, kinds = _read_group(spark, files, arrow_schema, path, glob)
    cols = []
    for i, field in enumerate(declared.fields):
        if i < len(raw_fields):
            raw = raw_fields[i]
            text = ty.conform_sql(_quoted(raw.name), raw.dataType, field.dataType, kinds[i], mode)
        else:
            text = f"CAST(NULL AS {field.dataType.simpleString()})"
        cols.append(f"{text} AS {_quoted(field.name)}")
    if files and len(files) > 1:
        root = files[0].rsplit("/", 1)[0]
        while not all(f.startswith(root + "/") for f in files):
            root = root.rsplit("/", 1)[0]
        at = f"{root}/{{{','.join(f[len(root) + 1:] for f in files)}}}"
    else:
        at = files[0] if files else path
    return f"SELECT {', '.join(cols)} FROM parquet.{_quoted(at)}"


def create_view(spark: SparkSession, name: str, schema, path: str, mode: str = "permissive",
                replace: bool = False, glob: str | None = None) -> str:
    """S6 as a permanent view: ``name`` is found in SQL by every session of the
    catalog, and the catalog refuses every INSERT into it (S9). Returns the view's
    text, one SELECT per footer signature that binds the columns by position.

    The text can only say what the file reader of SQL can read: a file type it
    refuses (half float, nanosecond timestamp, decimal wider than 38 digits, time
    of day) raises ``ValueError``; ``create_table`` binds those. A folder of one
    signature is read whole, so files added later belong to the view if they have
    that signature. With a catalog that outlives the application (a metastore), so
    does the view."""
    declared = ty.to_struct(schema)
    try:
        parts = [_group_sql(spark, path, declared, arrow_schema, files, mode, glob)
                 for arrow_schema, files in _groups(spark, path, glob)]
    except AnalysisException as exc:
        raise _map_error(exc, path) from exc
    text = "\nUNION ALL\n".join(parts)
    verb = "CREATE OR REPLACE VIEW" if replace else "CREATE VIEW"
    comment = f"read-only, bound by position to {path}".replace("'", "")
    spark.sql(f"{verb} {name} COMMENT '{comment}' AS\n{text}")
    return text


def drop_view(spark: SparkSession, name: str, if_exists: bool = False) -> None:
    """S8 of a permanent view; the data stays."""
    spark.sql(f"DROP VIEW {'IF EXISTS ' if if_exists else ''}{name}")


def open_table(spark: SparkSession, name: str, warehouse: str | None = None) -> DataFrame:
    """Resolve a table: one made in this session, else one whose definition
    lies in the warehouse, else ``<warehouse>/<name>.parquet`` with its own
    schema. A missing file raises ``NoSuchTableError``, an unreadable one
    ``CorruptTableError``."""
    definition = _load_definition(spark, name, None)
    if definition is not None:
        df = bind_parquet(spark, definition["path"], T.StructType.fromJson(definition["schema"]),
                          definition["mode"])
        df.createOrReplaceTempView(name)
        return df
    if warehouse is None:
        raise NoSuchTableError(f"no such table: {name}")
    path = f"{warehouse.rstrip('/')}/{name}.parquet"
    try:
        return bind_parquet(spark, path, natural_schema(spark, path))
    except (NoSuchTableError, CorruptTableError):
        raise
    except Exception as exc:  # noqa: BLE001
        raise _map_error(exc, path) from exc


def drop_table(spark: SparkSession, name: str, if_exists: bool = False) -> bool:
    """Forget the name; the data file is left untouched."""
    known = _load_definition(spark, name, None) is not None
    if not known and not if_exists:
        raise NoSuchTableError(f"no such table: {name}")
    spark.catalog.dropTempView(name)
    spark.conf.unset(_conf_key(name, "definition"))
    at, fs = _definition_path(spark, name, None)
    fs.delete(at, False)
    return known


def insert_into(spark: SparkSession, name: str, rows) -> None:
    """Every write to a bound table is refused."""
    raise ReadOnlyTableError(f"table {name} is read-only")


def with_row_position(spark: SparkSession, path: str, schema, mode: str = "permissive"):
    """The bound table plus stable ``file_path`` / ``row_index`` per row."""
    return bind_parquet(spark, path, schema, mode, row_position=True)


MOST_FILES = 10_000


def fetch_by_position(table: DataFrame, positions: DataFrame) -> DataFrame:
    """Rows at saved (file_path, row_index) positions; unknown positions
    give no row. Where the positions lie in at most ``MOST_FILES`` files, only
    those are scanned. A semi join on the position: AQE broadcasts a small key
    list and shuffles a large one."""
    keys = positions.select(*POSITION_COLUMNS)
    files = [r[0] for r in keys.select("file_path").distinct().limit(MOST_FILES + 1).collect()]
    if len(files) <= MOST_FILES:
        table = table.where(F.col("file_path").isin(files))
    return table.join(keys, list(POSITION_COLUMNS), "left_semi")


def table_stats(df: DataFrame) -> int:
    """Row count (Parquet footers give it; no column data is read)."""
    return df.count()


__all__ = ["bind_parquet", "bind_with_rejects", "create_table", "create_view", "drop_view", "open_table", "drop_table", "insert_into",
           "with_row_position", "fetch_by_position", "table_stats", "footers", "footer_groups", "footer_signatures",
           "footer_schema", "list_files", "POSITION_COLUMNS"]
