"""Wide CSV files (thousands of numeric columns) as one array column, and back."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.constants import NULL_TOKENS
from assayloom.sources.readers import _parsed
from assayloom.sources.writers import _refuse_self_overwrite

#: Text of records that a task parses at once, and of rows that Python gets at once when written.
_PARSE_BYTES, _WRITE_BYTES = 16 << 20, 32 << 20
_LINES = "path string, start long, value string"


# ---- reading ----

@dataclass(frozen=True)
class _Range:
    """One byte range of a file: how its lines lie among the records of the whole file."""

    open: bool      # a quoted field is open where the range begins
    first: int      # number of the first record that ends in it
    origin: tuple   # range in which the record began that is open at its start


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the byte range they lie in; the ranges are those of Spark's own text scan."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select(
        meta["file_path"].alias("path"), meta["file_block_start"].alias("start"), "value")


def _runs(batches) -> Iterator[tuple[tuple, list]]:
    """((path, start), Arrow arrays of lines) of each byte range; its lines come one after the other."""
    key, held = None, []
    for batch in batches:
        paths, starts, values = batch.column(0), batch.column(1), batch.column(2)
        at = 0
        while at < len(values):
            own = paths[at].as_py(), starts[at].as_py()
            # The last row tells whether the batch holds one range only, as nearly all do.
            stop = len(values)
            if (paths[stop - 1].as_py(), starts[stop - 1].as_py()) != own:
                stop = next(i for i in range(at, len(values)) if (paths[i].as_py(), starts[i].as_py()) != own)
            if own != key and key is not None:
                yield key, held
                held = []
            key = own
            held.append(values.slice(at, stop - at))
            at = stop
    if key is not None:
        yield key, held


def _states(lines, open_: bool):
    """(open before, open after, blank) of every line: a quoted field is open after an odd number of quotes."""
    import numpy as np
    import pyarrow.compute as pc

    quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
    after = (np.cumsum(quotes) + open_) % 2 == 1
    before = np.concatenate(([open_], after[:-1])) if len(after) else after
    bare = pc.is_in(lines, value_set=_as_strings(["", "\r"])).to_numpy(zero_copy_only=False)
    return before, after, bare & ~before


def _as_strings(values):
    import pyarrow as pa

    return pa.array(values, pa.string())


def _measure(batches):
    """Of each byte range: whether it holds an odd number of quotes, and how many records end in it either way."""
    import pyarrow as pa

    for (path, start), parts in _runs(batches):
        odd, ends, header = False, [0, 0], None
        for lines in parts:
            for k in (0, 1):
                _, after, blank = _states(lines, odd ^ bool(k))
                ends[k] += int((~after & ~blank).sum())
            if start == 0 and header is None:
                header = next(_records([lines], False))[0]
            odd ^= bool(_states(lines, False)[1][-1])
        mark = hashlib.sha256(header.encode()).hexdigest() if header is not None else None
        yield pa.RecordBatch.from_pydict(
            {"path": [path], "start": [start], "odd": [odd], "even_ends": [ends[0]], "odd_ends": [ends[1]],
             "mark": pa.array([mark], pa.string()), "header": pa.array([header], pa.string())})


def _records(parts: list, open_: bool) -> Iterator[tuple[str, bool, bool]]:
    """(text, whole, last) of the records of a byte range: the first is not whole if it began before, the last if it goes on."""
    held, begun = [], not open_
    for lines in parts:
        _, after, blank = _states(lines, open_)
        for text, going, empty in zip(lines.to_pylist(), after.tolist(), blank.tolist()):
            if empty:
                continue
            held.append(text)
            if not going:
                yield "\n".join(held).removesuffix("\r"), begun, False
                held, begun = [], True
        open_ = bool(after[-1]) if len(after) else open_
    if held:
        yield "\n".join(held), False, True


def _fields(header: str) -> list[str]:
    import csv
    import io

    return next(csv.reader(io.StringIO(header.removeprefix("﻿"), newline="")))


def _table(records: list[str], numbers: list[int], names: list[str], keep: list[str], out: str, row_id: str | None, tokens: list[str]):
    """Records as a batch: row ids, kept columns as text, all others as one list of floats (missing or no number: NaN)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.csv as pv

    rest = [n for n in names if n not in set(keep)]
    data = "\n".join(records).encode() + b"\n"

    def parsed(wide: pa.DataType):
        return pv.read_csv(
            pa.BufferReader(data), pv.ReadOptions(use_threads=False, block_size=len(data) + 1, column_names=names),
            pv.ParseOptions(newlines_in_values=True),
            pv.ConvertOptions(column_types={n: pa.string() for n in keep} | {n: wide for n in rest}, null_values=tokens,
                              strings_can_be_null=True, quoted_strings_can_be_null=True, check_utf8=False))

    def numbers_of(column):
        text = pc.utf8_trim_whitespace(column.combine_chunks())
        fine = pc.match_substring_regex(text, r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity)$")
        return pa.chunked_array([pc.cast(pc.if_else(fine, pc.utf8_ltrim(text, "+"), None), pa.float64())])

    places = [k for k, n in enumerate(names) if n not in set(keep)]
    try:
        table = parsed(pa.float64())
        columns = [table.column(k) for k in places]
    except pa.ArrowInvalid:
        table = parsed(pa.string())  # a record of another length fails again, with its text
        columns = [numbers_of(table.column(k)) for k in places]
    block = np.empty((table.num_rows, len(rest)), np.float32)
    for j, column in enumerate(columns):
        block[:, j] = column.to_numpy()
    ends = pa.array(np.arange(table.num_rows + 1, dtype=np.int32) * len(rest))
    arrays = {row_id: pa.array(numbers, pa.int64())} if row_id else {}
    arrays |= {n: table[n].combine_chunks() for n in keep}
    arrays[out] = pa.ListArray.from_arrays(ends, pa.array(block.ravel()))
    return pa.RecordBatch.from_pydict(arrays)


def _cut(records: Iterable[tuple[int, str]]) -> Iterator[tuple[list[int], list[str]]]:
    """Numbered records in runs of bounded text."""
    numbers, texts, size = [], [], 0
    for n, text in records:
        numbers.append(n)
        texts.append(text)
        size += len(text)
        if size >= _PARSE_BYTES:
            yield numbers, texts
            numbers, texts, size = [], [], 0
    if texts:
        yield numbers, texts


def read_wide_csv(
    spark: SparkSession,
    path: str,
    keep: T.StructType,
    out: str = "targets",
    row_id: str | None = "row_id",
    null_tokens: Iterable[str] = NULL_TOKENS,
) -> DataFrame:
    """Read wide CSV files straight into ``keep`` columns plus one ``array<float>``.

    The plan never holds the wide schema, and any file system that Spark reads will
    do. A file is read in the byte ranges of Spark's text scan, so a large one
    spreads over many tasks; line breaks inside quoted fields may lie anywhere. Quotes
    must stand around fields or be doubled inside them. A first pass counts quotes
    and records of every range, which tells where each range lies in its file; a
    record that crosses a border is put together from its parts, wherever these lie.

    Every file starts with the same header, else ValueError, as when a kept column is
    not in it. Kept columns are cast as in ``read_csv``; every other column, in the
    header's order, is a place of the array, NaN where the value is missing or no
    number. ``row_id`` numbers the records of all files in path order, the same on
    every run. Blank lines are no records; a record with more or fewer fields is an error.

    One line per byte range reaches the driver and goes to every task, as in Spark's own file listing.
    A task holds one range of text and 16 MB of parsed records.
    """
    lines = _lines(spark, path)
    ranges = sorted(lines.mapInArrow(
        _measure, "path string, start long, odd boolean, even_ends long, odd_ends long, mark string, header string",
    ).drop("header").collect(), key=lambda r: (r["path"], r["start"]))
    heads = {r["path"]: r["mark"] for r in ranges if r["start"] == 0}
    if len(set(heads.values())) != 1:
        raise ValueError(f"the files of {path} have different headers" if heads else f"{path} has no header")
    first = next(r["path"] for r in ranges)
    names = _fields(lines.where((F.col("path") == first) & (F.col("start") == 0)).mapInArrow(
        _measure, "path string, start long, odd boolean, even_ends long, odd_ends long, mark string, header string").first()["header"])
    kept = keep.fieldNames()
    lacking = [n for n in kept if n not in names]
    if lacking or len(set(names)) != len(names):
        raise ValueError(f"{path} has no column {lacking}" if lacking else f"{path} has columns of one name")

    places, at, crossing = {}, 0, False
    open_, origin = False, None
    for r in ranges:
        key = r["path"], r["start"]
        if r["start"] == 0:
            open_, origin = False, key
            if not r["even_ends"]:
                raise ValueError(f"the header of {r['path']} goes beyond its first byte range")
        places[key] = _Range(open_, at, origin)
        crossing |= open_
        ends = r["odd_ends"] if open_ else r["even_ends"]
        at += ends - (r["start"] == 0)
        if ends or not open_:
            origin = key
        open_ ^= r["odd"]
    tokens = list(null_tokens)

    def numbered(batches):
        """(range, number, text, whole, last) of all records but headers."""
        for key, parts in _runs(batches):
            if key not in places:
                raise ValueError(f"{path} changed while it was read")
            own = places[key]
            n = own.first - (key[1] == 0)
            for j, (text, whole, last) in enumerate(_records(parts, own.open)):
                if key[1] or j:
                    yield key, n, text, whole, last
                n += not last

    def load(batches):
        for numbers, texts in _cut((n, text) for _, n, text, whole, _ in numbered(batches) if whole):
            yield _table(texts, numbers, names, kept, out, row_id, tokens)

    def parts(batches):
        import pyarrow as pa

        for key, n, text, whole, last in numbered(batches):
            if not whole:
                begins = key if last and (not places[key].open or n > places[key].first) else places[key].origin
                yield pa.RecordBatch.from_pydict(
                    {"path": [begins[0]], "begins": [begins[1]], "start": [key[1]], "last": [last], "number": [n], "text": [text]})

    def join(batches):
        for batch in batches:
            for numbers, texts in _cut(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                yield _table(texts, numbers, names, kept, out, row_id, tokens)

    raw = T.StructType([*([T.StructField(row_id, T.LongType())] if row_id else []), *[T.StructField(n, T.StringType()) for n in kept],
                        T.StructField(out, T.ArrayType(T.FloatType()))])
    table = lines.mapInArrow(load, raw)
    if crossing:
        # The part that ends a record tells its number; the others go on.
        pieces = F.array_sort(F.collect_list(F.struct("start", "text")))
        whole = (lines.mapInArrow(parts, "path string, begins long, start long, last boolean, number long, text string")
                 .groupBy("path", "begins").agg(F.min(F.when(~F.col("last"), F.col("number"))).alias("number"), pieces.alias("pieces"))
                 .select("number", F.array_join(F.col("pieces.text"), "\n").alias("text")))
        table = table.unionByName(whole.mapInArrow(join, raw))
    return table.select(*([row_id] if row_id else []), *[_parsed(f).alias(f.name) for f in keep.fields], out)


# ---- writing ----

def _cell(field: T.StructField) -> Column:
    """A value as CSV text, quoted where it must be; null is empty."""
    c = F.col(f"`{field.name}`")
    nested = (T.ArrayType, T.StructType, T.MapType)
    text = F.to_json(c) if isinstance(field.dataType, nested) else c.cast("string")
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(text.rlike('[",\r\n]'), quoted).otherwise(text), F.lit(""))


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"' if any(c in name for c in '",\r\n') else name


def write_wide_csv(df: DataFrame, path: str, names: DataFrame | Sequence[str], column: str = "targets", mode: str = "overwrite") -> None:
    """CSV sink that writes an array column as one named column per place.

    ``names`` are the columns' names in order, or a table (pos, name). All other
    columns come first, nested ones as JSON text. An array of another length is an
    error; null arrays and missing values are empty. Every part file has the header,
    also when there are no rows. Each row is put into text by itself, no wide row
    is ever built. Overwriting a path the table itself reads is refused.
    """
    if mode == "overwrite":
        _refuse_self_overwrite(df, path)
    spark = df.sparkSession
    if isinstance(names, DataFrame):
        names = [r["name"] for r in names.orderBy("pos").collect()]
    names = list(names)
    others = [f for f in df.schema.fields if f.name != column]
    taken = [*[f.name for f in others], *names]
    if len(set(taken)) != len(taken) or not taken:
        raise ValueError("columns of one name")
    header = ",".join(map(_quoted, taken))
    values = F.col(f"`{column}`")
    joined = F.array_join(values.cast("array<string>"), ",", "")
    if isinstance(df.schema[column].dataType.elementType, (T.FloatType, T.DoubleType)):
        joined = F.replace(joined, F.lit("NaN"), F.lit(""))  # in the text of numbers it stands for nothing else
    wrong = F.raise_error(F.concat(F.lit(f"{column} has a length other than {len(names)}: "), F.size(values).cast("string")))
    joined = F.when(values.isNull(), F.lit("," * (len(names) - 1))).when(F.size(values) == len(names), joined).otherwise(wrong.cast("string"))
    cells = [*[_cell(f) for f in others], *([joined] if names else [])]
    line = F.concat_ws(",", *cells).alias("value")

    def with_header(batches):
        import pyarrow as pa

        told = False
        for batch in batches:
            if batch.num_rows and not told:
                yield pa.RecordBatch.from_arrays([pa.array([header])], ["value"])
                told = True
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["value"])
        if not told and TaskContext.get().partitionId() == 0:
            yield pa.RecordBatch.from_arrays([pa.array([header])], ["value"])

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(1, _WRITE_BYTES // (len(header) + 64))))
    try:
        (df.select(line).mapInArrow(with_header, "value string")
            .write.mode(mode).option("maxRecordsPerFile", 0).option("lineSep", "\n").text(path))
    finally:
        spark.conf.set(key, before)
