"""Reading sentence pairs and giving them dense ids."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.operators.boundary import stage_boundary
from pairloom.operators.first_rows import first_in_order
from pairloom.operators.sequence import dense_sequence
from pairloom.schemas import LANGS
from pairloom.sources.places import Source, parse_split

# Whole texts that are stored once more, in order.
COMPRESSION = "zstd"

# A line of a report that is a list, a tuple, a text, a number or a constant.
OTHER_LITERAL = r"""^(?:\[.*\]|\(.*\)|'[^']*'|"[^"]*"|[+-]?[0-9.]+|None|True|False)$"""

# A text in single or double quotes, or what stands between texts.
PIECES = r"""'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+"|[^'"]++|['"]"""
# A printed code point of eight digits.
FAR = r"\\U([0-9a-fA-F]{8})"
# A record that isn't JSON: a key in single quotes, or a constant of Python after a comma or colon.
PRINTED = r"""^\{\s*'|[:,\[]\s*(?:None|True|False|')"""


def attach_ids(
    df: DataFrame,
    order_by: Sequence,
    *,
    include_ids: bool = True,
    id_field: str = "id",
    start_id: int = 0,
    overwrite_ids: bool = False,
) -> DataFrame:
    """Append the dense ids ``start_id, start_id + 1, ...`` in the order of ``order_by``.

    A table has no order of its own, so one has to be named; repeated values are an error. An existing id column is an error unless it is to be overwritten.
    """
    if not include_ids:
        return df
    columns = _columns_without_id(df.columns, id_field, overwrite_ids)
    return dense_sequence(df, order_by, id_field, start=start_id, keep=columns, unique=True, compression=COMPRESSION)


def _columns_without_id(columns: Sequence[str], id_field: str, overwrite_ids: bool) -> list[str]:
    if id_field in columns and not overwrite_ids:
        raise ValueError(f"the source has a column {id_field!r}; overwrite_ids=True would replace it")
    return [c for c in columns if c != id_field]


def _paths(
    path_name: str, name: str | None, split: str, data_files: str | Sequence[str] | Mapping | None
) -> tuple[str, list[str]]:
    """Format and paths. With ``data_files``, ``path_name`` is the format."""
    if data_files is None:
        return "parquet", ["/".join(part.rstrip("/") for part in (path_name, name, split) if part)]
    if isinstance(data_files, Mapping):
        if split not in data_files:
            raise ValueError(f"data_files has no split {split!r}")
        data_files = data_files[split]
    return path_name, [data_files] if isinstance(data_files, str) else list(data_files)


def _with_pair(rows: DataFrame) -> DataFrame:
    """Flat columns, one per language, become the pair; all other columns stay."""
    if "translation" in rows.columns:
        if not isinstance(rows.schema["translation"].dataType, T.StructType):
            raise ValueError("the column 'translation' must hold an object with a text per language")
        return rows
    if not set(LANGS) <= set(rows.columns):
        raise ValueError(f"no column 'translation' and no columns {', '.join(LANGS)}, only {', '.join(rows.columns)}")
    return rows.withColumn("translation", F.struct(*LANGS)).drop(*LANGS)


def load_pairs(
    spark: SparkSession,
    path_name: str,
    *,
    split: str,
    name: str | None = None,
    data_files: str | Sequence[str] | Mapping | None = None,
    max_examples: int | None = None,
    include_ids: bool = True,
    id_field: str = "id",
    start_id: int = 0,
    overwrite_ids: bool = False,
    order_by: Sequence | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read pairs, keep the first ``max_examples`` and append dense ids.

    Without ``data_files`` the parquet folder ``path_name[/name]/split`` is read; with
    it, ``path_name`` is a format (``parquet``, ``json``) and ``data_files`` a path, a
    list of paths or a mapping from split to these. JSON records have the pair as
    ``translation`` or as one field per language; their other fields stay columns, and
    without ``schema`` all are inferred. The order is that of the files (by
    list entry, then path, numbers in it as numbers) and of the rows in them, or that of
    ``order_by``, whose values must be unique together.

    ``split`` may name rows: ``train[:1000]``, ``train[10%:20%]``, ``train[-5:]``, and several parts joined by ``+``,
    which follow each other. Only files that hold wanted rows are read. Slices need file order.
    """
    slices = parse_split(split)
    sources = {part.name: _paths(path_name, name, part.name, data_files) for part in slices}
    file_format = next(iter(sources.values()))[0]
    entries = [(of, path) for of, (_, paths) in sources.items() for path in paths]
    if schema is None and file_format == "json":
        # One schema for all files, so that a column which some lack is null there.
        schema = spark.read.json([path for _, path in entries], mode="FAILFAST").schema
    source = Source(spark, file_format, entries, schema)
    rows = source.rows()
    pairs = _with_pair(rows) if file_format == "json" else rows
    whole = all(part.begin is None and part.end is None for part in slices) and len(slices) == len(sources)
    if whole and not include_ids and max_examples is None:
        return pairs
    columns = _columns_without_id(pairs.columns, id_field, overwrite_ids) if include_ids else pairs.columns
    number = id_field if include_ids else "_number"
    if order_by is None:
        placed = source.numbered(slices, number, start=start_id, limit=max_examples)
        placed = _with_pair(placed) if file_format == "json" else placed
        return placed.select(*columns, *([number] if include_ids else []))
    if not whole:
        raise ValueError("a slice of a split is one of rows in file order, not in that of order_by")
    if max_examples is not None:
        pairs = first_in_order(pairs, order_by, max_examples)
    if not include_ids:
        return pairs
    return dense_sequence(pairs, order_by, number, start=start_id, keep=columns, unique=True, compression=COMPRESSION)


def read_records(spark: SparkSession, path: str, schema: T.StructType | None = None, *, locate: bool = False) -> DataFrame:
    """Read a snapshot or dataset: JSON lines for ``.jsonl``, parquet otherwise.

    A bad JSON record is an error; blank lines are skipped. With ``locate``, the error names file and line, for which
    the lines are counted first.
    """
    if not path.lower().rstrip("/").endswith(".jsonl"):
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    if not locate:
        return (spark.read if schema is None else spark.read.schema(schema)).json(path, mode="FAILFAST")
    bad, record = "__bad", F.col("record")
    if schema is None:
        # Bad records get the column of their own here, too, and are met below.
        inferred = spark.read.json(path, columnNameOfCorruptRecord=bad).schema
        schema = T.StructType([field for field in inferred if field.name != bad])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    lines = Source(spark, "text", [("", path)], None).lines().where(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    parsed = lines.withColumn("record", F.from_json("value", T.StructType([*schema, T.StructField(bad, T.StringType())]), options))
    place = F.concat(F.col("file"), F.lit(", line "), F.col("line").cast("string"), F.lit(": no record: "), F.substring("value", 1, 200))
    checked = F.when(record[bad].isNotNull(), F.raise_error(place)).otherwise(record)
    # The boundary keeps filters on the fields from a line that hasn't been tested.
    return stage_boundary(parsed.select(checked.alias("record"))).select(*[record[field.name].alias(field.name) for field in schema])


def _as_json(line: Column) -> Column:
    """A record as it was printed, in JSON: constants outside texts, escapes inside them.

    Pieces are a text in either kind of quotes or what stands between texts.
    """
    pieces = F.regexp_extract_all(line, F.lit(PIECES), 0)

    def translate(piece: Column) -> Column:
        inside = F.substr(piece, F.lit(2), F.length(piece) - 2)
        # \\xNN becomes a four-digit escape, an escaped quote the quote. A pair of backslashes is kept apart.
        text = F.replace(inside, F.lit("\\\\"), F.lit("\0"))
        text = F.regexp_replace(text, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
        text = F.replace(text, F.lit("\\'"), F.lit("'"))
        text = F.regexp_replace(text, r'(?<!\\)"', r'\\"')
        # A character beyond the first plane has no escape of its own in JSON; it stands for itself.
        far = F.regexp_extract_all(text, F.lit(FAR), 1)
        chars = F.transform(far, lambda code: F.decode(F.unhex(code), "UTF-32"))
        around = F.split(text, FAR)
        joined = F.zip_with(around, chars, lambda part, char: F.concat(part, F.coalesce(char, F.lit(""))))
        text = F.when(F.contains(text, F.lit("\\U")), F.array_join(joined, "")).otherwise(text)
        text = F.replace(text, F.lit("\0"), F.lit("\\\\"))
        constant = F.regexp_replace(piece, r"\bNone\b", "null")
        constant = F.regexp_replace(F.regexp_replace(constant, r"\bTrue\b", "true"), r"\bFalse\b", "false")
        quoted = F.substr(piece, F.lit(1), F.lit(1)).isin("'", '"')
        return F.when(quoted, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(constant)

    return F.array_join(F.transform(pieces, translate), "")


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a report of one record per line, as JSON or as printed by Python.

    Printed records may be in either kind of quotes, hold ``None``, ``True`` and ``False``, and escapes such
    as ``\\x01``. Blank lines and lines that hold some other literal than a record are skipped, a line that
    is none of these is an error.
    """
    line = F.trim("value")
    rows = spark.read.text(path).where((line != "") & ~line.rlike(OTHER_LITERAL))
    # JSON needs no translation, and its escapes are read as they are.
    text = F.when(line.rlike(PRINTED), _as_json(line)).otherwise(line)
    record = F.from_json(text, schema, {"mode": "FAILFAST"})
    # The boundary keeps later filters from parsing a line before it has been tested.
    return stage_boundary(rows).select(record.alias("record")).select("record.*")
