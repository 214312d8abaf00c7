"""Weekly files: which exist, what their headers are, and their rows."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formline.functions.columns import id_from_name, no_nan, rename_present, text_of, whole_number_text
from formline.session import cut_lineage, fresh_path

# Fixed patterns of the raw layout: {season}/gws/gw{week}.csv
STEP_PATTERN = r"gw(\d+)\.csv[^/]*$"
SEASON_PATTERN = r"/([^/]+)/gws/[^/]*$"
MAX_HEADERS = 200
#: Lines of one quoted cell beyond which its quote counts as never closed.
MAX_RECORD_LINES = 10_000
#: New files that are read by their paths; of more, their folder is read.
MAX_LISTED = 10_000


def file_catalog(
    spark: SparkSession,
    root: str,
    step_pattern: str = STEP_PATTERN,
    season_pattern: str = SEASON_PATTERN,
) -> DataFrame:
    """(path, season, step, length) of the weekly files below ``root``; contents are not read.

    Files of no bytes are left out, as Spark's file sources do.
    """
    path = F.col("path")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(root)
        .select(
            "path",
            text_of(path, season_pattern).alias("season"),
            text_of(path, step_pattern).cast("int").alias("step"),
            "length",
        )
        .where(F.col("season").isNotNull() & F.col("step").isNotNull())
    )


def _lines(spark: SparkSession, paths: str | Sequence[str], encoding: str) -> DataFrame:
    """(path, block, at, line) of all lines of CSV files; ``at`` grows inside a block, blocks by their number.

    Files are split at will. Only in encodings whose line breaks are no single bytes they are read as a whole.
    """
    whole = encoding.upper().startswith(("UTF-16", "UTF-32"))
    files = (
        spark.read.format("binaryFile" if whole else "text")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(paths if isinstance(paths, str) else list(paths))
    )
    path = F.col("_metadata.file_path").alias("path")
    if whole:
        text = F.split(F.decode("content", encoding), "\r\n|\n|\r")
        return files.select(path, F.lit(0).cast("bigint").alias("block"), F.posexplode(text).alias("at", "line"))
    return files.select(
        path,
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.decode(F.col("value").cast("binary"), encoding).alias("line"),
    )


# Fixed patterns. Inside a quoted field quotes come in pairs; a field is quoted if it begins with a quote.
_INSIDE = '(?:[^"]++|"")*+'
_FIELDS = f'(?:"{_INSIDE}"[^,]*+,|[^",][^,]*+,|,)*+'
#: Lines that end inside a quoted field, if they begin outside of one, and if they begin inside.
_OPENS = f'^{_FIELDS}"{_INSIDE}$'
_STAYS = f'^{_INSIDE}$|^{_INSIDE}"[^,]*+,{_FIELDS}"{_INSIDE}$'


def _records(lines: DataFrame, max_lines: int = MAX_RECORD_LINES) -> DataFrame:
    """``lines`` (path, block, at, line) with those that a line break inside quotes cuts put together again.

    Whether a line begins inside quotes follows from all lines before it: a line either settles that by itself,
    keeps it or turns it over. The turns are added up per block, then over a file's blocks in order, so
    no task sees more than one block. Only the lines of cut records are grouped. A record of over
    ``max_lines`` lines is an error: some quote is never closed.
    """
    opens, stays = F.col("line").rlike(_OPENS), F.col("line").rlike(_STAYS)
    if lines.where(opens).isEmpty():
        return lines
    judged = lines.withColumns({"opens": opens, "stays": stays})
    settles = F.col("opens") == F.col("stays")
    turns = (F.col("opens") & ~F.col("stays")).cast("int")
    upto = Window.partitionBy("path", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turned = F.sum(turns).over(upto) % 2
    # the state after a line is what the last settling line left, turned over as often as since then
    known = F.last(F.when(settles, (F.col("opens").cast("int") + F.col("turned")) % 2), True).over(upto)
    ended = judged.withColumn("turned", turned).withColumn("known", known)
    last = F.struct("turned", "known")
    blocks = ended.groupBy("path", "block").agg(F.max_by(last, "at").alias("last"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    all_turned = F.coalesce(F.sum("last.turned").over(earlier), F.lit(0)) % 2
    before = F.sum("last.turned").over(earlier.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    settled = F.when(F.col("last.known").isNotNull(), (F.col("last.known") + F.col("last.turned") + before) % 2)
    entered = blocks.withColumn("settled", settled).select(
        "path", "block", ((F.coalesce(F.last("settled", True).over(earlier), F.lit(0)) + all_turned) % 2).alias("entry")
    )
    at_end = (F.coalesce("known", "entry") + F.col("turned")) % 2
    inside = ended.join(entered, ["path", "block"]).withColumn("ends_inside", at_end == 1)
    previous = Window.partitionBy("path", "block").orderBy("at")
    begins = F.coalesce(F.lag("ends_inside").over(previous), F.col("entry") == 1)
    marked = inside.withColumn("begins_inside", begins)
    start = F.when(~F.col("begins_inside"), F.struct("block", "at"))
    marked = marked.withColumn("start", F.last(start, True).over(upto))
    firsts = marked.groupBy("path", "block").agg(F.max("start").alias("latest"))
    carried = firsts.select("path", "block", F.last("latest", True).over(earlier).alias("carried"))
    whole = marked.where("not begins_inside and not ends_inside").select(*lines.columns)
    cut = (
        marked.where("begins_inside or ends_inside")
        .join(carried, ["path", "block"])
        .select("path", F.coalesce("start", "carried").alias("record"), F.struct("block", "at", "line").alias("part"))
    )
    sizes = cut.groupBy("path", "record").agg(F.count("*").alias("n")).where(F.col("n") > max_lines)
    endless = sizes.first()
    if endless is not None:
        raise ValueError(f"a quoted cell of over {max_lines} lines in {endless['path']}: is a quote not closed?")
    parts = F.array_sort(F.collect_list("part"))
    put = cut.groupBy("path", "record").agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("line"))
    return whole.unionByName(put.select("path", "record.block", "record.at", "line"))


def _raw_rows(
    spark: SparkSession, paths: str | Sequence[str], step_pattern: str, season_pattern: str, encoding: str
) -> DataFrame:
    """(path, season, step, header, fields) of every record below the weekly files' headers.

    Lines are read once and stored in the shared folder; a file's header is its first record and is joined back
    to the file's other records. Line breaks inside quotes belong to their cell (as a line feed).
    """
    path = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    stored = fresh_path(spark, "weekly")
    weekly = _lines(spark, paths, encoding).select(
        "path", text_of(path, season_pattern).alias("season"),
        text_of(path, step_pattern).cast("int").alias("step"), "block", "at", "line",
    )
    weekly.where(F.col("step").isNotNull()).write.parquet(stored)
    lines = spark.read.parquet(stored)
    files = lines.select("path", "season", "step").distinct()
    records = _records(lines.select("path", "block", "at", "line"))
    place = F.struct("block", "at")
    mark = F.regexp_replace(F.min_by("line", place), "^(\ufeff|\u00ef\u00bb\u00bf)", "")
    # the header is in the first block; a file of one block has all its lines there
    heads = records.where("block = 0").groupBy("path").agg(F.min(place).alias("top"), mark.alias("head"))
    below = records.join(heads, "path").where((F.col("line") != "") & (place > F.col("top"))).join(files, "path")
    return below.select(
        "path", "season", "step", _fields(F.col("head")).alias("header"), _fields(F.col("line")).alias("fields")
    )


def weekly_store(
    spark: SparkSession,
    root: str,
    store: str,
    step_pattern: str = STEP_PATTERN,
    season_pattern: str = SEASON_PATTERN,
    encoding: str = "ISO-8859-1",
) -> DataFrame:
    """The records of all weekly files below ``root``, of which only new and changed files are read.

    ``store`` holds the records of earlier runs and a manifest of (path, length, modified, batch). Files that the
    manifest lacks, or has with another length or time, are read and appended as one batch; the manifest is
    written after them, so what a failed run left behind is never seen. Of a path's entries the latest counts,
    and paths that are gone do not.
    """
    records, manifest = f"{store}/records", f"{store}/manifest"
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(root)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
    path = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    present = listed.where(text_of(path, step_pattern).cast("int").isNotNull() & text_of(path, season_pattern).isNotNull())
    kinds = "path string, length bigint, modified timestamp, batch string, number bigint"
    try:
        known = spark.read.schema(kinds).parquet(manifest)
        known.isEmpty()
    except AnalysisException:  # nothing was stored yet
        known = spark.createDataFrame([], kinds)
    latest = known.groupBy("path").agg(F.max_by(F.struct("length", "modified", "batch"), "number").alias("e")).select("path", "e.*")
    fresh = cut_lineage(present.join(latest.drop("batch"), ["path", "length", "modified"], "left_anti"))
    n_fresh = fresh.count()
    if n_fresh:
        number = (known.agg(F.max("number")).first()[0] or 0) + 1
        batch = uuid.uuid4().hex
        if n_fresh <= MAX_LISTED:
            read = _raw_rows(spark, [r["path"] for r in fresh.select("path").collect()], step_pattern, season_pattern, encoding)
        else:
            read = _raw_rows(spark, root, step_pattern, season_pattern, encoding)
            read = read.join(fresh.select(_plain_path(F.col("path")).alias("_p")), _plain_path(F.col("path")) == F.col("_p"), "left_semi")
        read.write.parquet(f"{records}/batch={batch}")
        entries = fresh.select("path", "length", "modified", F.lit(batch).alias("batch"), F.lit(number).cast("bigint").alias("number"))
        entries.coalesce(1).write.mode("append").parquet(manifest)
        known = spark.read.schema(kinds).parquet(manifest)
        latest = known.groupBy("path").agg(F.max_by("batch", "number").alias("batch"))
    current = latest.select("path", "batch").join(present.select("path"), "path", "left_semi")
    current = current.select(_plain_path(F.col("path")).alias("_p"), F.col("batch").alias("_b"))
    if current.isEmpty():
        return spark.createDataFrame([], "path string, season string, step int, header array<string>, fields array<string>")
    stored = spark.read.option("basePath", records).parquet(records)
    return stored.join(
        current, (_plain_path(F.col("path")) == F.col("_p")) & (F.col("batch") == F.col("_b")), "left_semi"
    ).drop("batch")


def _plain_path(path: Column) -> Column:
    """A path however its scheme's slashes are written and its characters escaped."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^([a-z]+:)/+", "$1/")


def _fields(line: Column) -> Column:
    """The fields of a CSV line: unquoted empty ones are NULL, quotes are taken off."""
    parts = F.regexp_extract_all(line, F.lit('(?:^|,)("(?:[^"]++|"")*+"|[^,]*)'), F.lit(1))
    inner = lambda x: F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
    quoted_field = lambda x: (F.length(x) >= 2) & F.startswith(x, F.lit('"')) & F.endswith(x, F.lit('"'))
    return F.transform(parts, lambda x: F.when(quoted_field(x), inner(x)).otherwise(F.nullif(x, F.lit(""))))


def _typed(text: Column, ddl: str) -> tuple[Column, Column]:
    """A cell under its type, and whether it is one that does not fit it.

    Whole numbers may be written with decimals of 0, as programs do when a column has gaps.
    """
    kind = T.DataType.fromDDL(ddl)
    if isinstance(kind, T.StringType):
        return text, F.lit(False)
    value = text.try_cast(kind)
    if isinstance(kind, T.IntegralType):
        number = text.try_cast("double")
        value = F.coalesce(value, F.when(number == F.floor(number), number.try_cast(kind)))
    missing = F.lower(F.trim(text)).isin("", "nan")
    return value, text.isNotNull() & ~missing & value.isNull()


def read_weekly(
    spark: SparkSession,
    root: str,
    types: Mapping[str, str],
    step_pattern: str = STEP_PATTERN,
    season_pattern: str = SEASON_PATTERN,
    renames: Mapping[str, str] | None = None,
    name: str = "player_name",
    ident: str = "player_id",
    encoding: str = "ISO-8859-1",
    corrupt: str | None = None,
    store: str | None = None,
) -> DataFrame:
    """Rows of all weekly files with ``season`` and ``step`` from their path.

    Every row follows the header of its own file; the result has the columns of all headers. ``types``
    gives column types after renaming; other columns stay text. A cell that does not fit its type
    is NULL; ``corrupt`` names a column for the number of such cells in a row. Without an id column the
    id is the last ``_`` token of the name. Empty files contribute nothing. Only the distinct headers
    reach the driver. With ``store`` only files that are new or changed since the last such read are read,
    see :func:`weekly_store`.
    """
    renames = {"name": name, "element": ident} if renames is None else renames
    if store is None:
        # the headers are looked at before the rows: records are put together once and read from there
        records = _raw_rows(spark, root, step_pattern, season_pattern, encoding)
        path = fresh_path(spark, "weekly-records")
        records.write.parquet(path)
        raw = spark.read.schema(records.schema).parquet(path)
    else:
        raw = weekly_store(spark, root, store, step_pattern, season_pattern, encoding)
    headers = [r["header"] for r in raw.select("header").distinct().limit(MAX_HEADERS + 1).collect()]
    if len(headers) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers below {root}")
    sources: dict[str, list[str]] = {}
    for header in sorted(headers, key=str):
        for column in header:
            if column is not None and column not in sources.setdefault(renames.get(column, column), []):
                sources[renames.get(column, column)].append(column)
    cells, wrong = {}, [F.lit(0)]
    for column, written in sources.items():
        texts = [F.get("fields", F.array_position("header", F.lit(w)).cast("int") - 1) for w in written]
        value, misfit = _typed(F.coalesce(*texts), types.get(column, "string"))
        cells[column] = value
        wrong.append(misfit.cast("int"))
    if name in cells:
        listed = F.arrays_overlap("header", F.lit(sources.get(ident, [""])))
        given = cells.get(ident, F.lit(None)).cast("string")
        cells[ident] = F.when(listed, given).otherwise(id_from_name(cells[name]))
    if ident in cells:
        cells[ident] = whole_number_text(cells[ident].cast("string"))
    if corrupt is not None:
        cells[corrupt] = sum(wrong[1:], wrong[0])
    own = [c for c in ("season", "step") if c not in cells]
    return no_nan(raw.select(*[v.alias(c) for c, v in cells.items()], *own))


def read_team_list(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The team list, its ``id`` column (if any) renamed ``team_id``."""
    return rename_present(_read_csv(spark, path, schema), {"id": "team_id"})


def read_season_lists(
    spark: SparkSession,
    root: str,
    file_name: str,
    schema: str | None = None,
    renames: Mapping[str, str] | None = None,
) -> DataFrame:
    """``{root}/{season}/{file_name}`` of all seasons in one scan, season from the path."""
    rows = _read_csv(spark, f"{root}/*/{file_name}", schema)
    season = text_of(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$")
    return rename_present(rows.select("*", season.alias("season")), renames or {})


def _read_csv(spark: SparkSession, path: str, schema: str | None) -> DataFrame:
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)
