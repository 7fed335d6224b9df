"""Reader for COPY-text dumps: (schema, table, ordinal, columns, fields) rows.

``COPY schema.table (a, b) FROM stdin;`` opens a block, ``\\.`` closes it; fields are
separated by tabs, ``\\N`` is null, and backslash escapes are undone.  A row with another
number of fields than the header, or a file that ends inside a block, is an error.
Files are read as lines, never as one value.  A file named .gz can't be split and is one
task.  Others are split: a first pass sums up each split for either state it may begin in
(inside a block or not), the sums are chained along each file, and every split is then
read from the state it truly begins in."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain, groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = "path string, schema string, table string, ordinal long, columns array<string>, fields array<string>"
_OPEN = re.compile(r'^COPY "?(\w+)"?\."?(\w+)"? \(([^)]*)\) FROM stdin;$')
_ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}
_ESCAPED = re.compile(r"\\(.)", re.S)


class DumpError(ValueError):
    """A dump that isn't what it says."""


def unescape(field: str) -> str | None:
    if field == "\\N":
        return None
    return _ESCAPED.sub(lambda m: _ESCAPES.get(m[1], m[1]), field) if "\\" in field else field


def escape(value: str | None) -> str:
    if value is None:
        return "\\N"
    out = value.replace("\\", "\\\\")
    for letter, c in _ESCAPES.items():
        out = out.replace(c, "\\" + letter)
    return out


def _step(state: list | None, line: str) -> list | None:
    """State after a line: None outside, [schema, table, columns, rows so far] inside."""
    if state is None:
        m = _OPEN.match(line)
        return [m[1], m[2], [c.strip().strip('"') for c in m[3].split(",")], 0] if m else None
    return None if line == "\\." else [*state[:3], state[3] + 1]


def scan_lines(lines: Iterator[str], state: list | None = None, to_the_end: bool = True) -> Iterator[tuple[str, str, int, list[str], list[str | None]]]:
    """Rows of the lines, which begin in ``state`` and, if ``to_the_end``, must end outside."""
    for line in lines:
        line = line.rstrip("\n")
        if state is not None and line != "\\.":
            schema, table, columns, n = state
            fields = [unescape(f) for f in line.split("\t")]
            if len(fields) != len(columns):
                raise DumpError(f"{schema}.{table} row {n}: {len(fields)} fields for {len(columns)} columns")
            yield schema, table, n, columns, fields
        state = _step(state, line)
    if state is not None and to_the_end:
        raise DumpError(f"the dump ends inside {state[0]}.{state[1]}")


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[str]]]:
    """(path, start, state) of each split with its lines, in order.  Lines are bytes until
    here, so wrong UTF-8 is an error and not replaced."""
    rows = chain.from_iterable(zip(*(c.to_pylist() for c in b.columns), strict=True) for b in batches)
    for key, lines in groupby(rows, itemgetter(0, 1, 2)):
        yield key, (line[3].decode() for line in lines)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split: the state at its end if it begins outside; the lines up to the first
    that closes a block, whether there is one, and the state at the end after that."""
    for (path, start, _), lines in _splits(batches):
        outside, after, closed, head = None, None, False, 0
        for line in lines:
            outside = _step(outside, line)
            if closed:
                after = _step(after, line)
            elif line == "\\.":
                closed = True
            else:
                head += 1
        row = {"path": path, "start": start, "outside": json.dumps(outside), "closed": closed, "head": head, "after": json.dumps(after)}
        yield pa.RecordBatch.from_pylist([row])


def _chained(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state each split of one file begins in."""
    state, begins = None, []
    pdf = pdf.sort_values("start")
    for outside, closed, head, after in pdf[["outside", "closed", "head", "after"]].itertuples(index=False):
        begins.append(json.dumps(state))
        if state is None:
            state = json.loads(outside)
        else:
            state = json.loads(after) if closed else [*state[:3], state[3] + int(head)]
    if state is not None:
        raise DumpError(f"the dump ends inside {state[0]}.{state[1]}")
    return pd.DataFrame({"path": pdf["path"], "start": pdf["start"], "state": begins})


def read_dump(spark: SparkSession, glob: str) -> DataFrame:
    """All rows of all dumps; ``ordinal`` counts a block's rows from 0."""
    text = spark.read.text(glob, lineSep="\n")
    lines = text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.lit(None).cast("string").alias("state"), F.col("value").cast("binary").alias("line"))
    whole = all(f.endswith(".gz") for f in text.inputFiles())
    if not whole:
        sums = lines.mapInArrow(_sums, "path string, start long, outside string, closed boolean, head long, after string")
        states = sums.groupBy("path").applyInPandas(_chained, "path string, start long, state string")
        # One row for each split of a file (spark.sql.files.maxPartitionBytes), so it is small.
        # A broadcast join keeps the lines in their order.
        lines = lines.drop("state").join(F.broadcast(states), ["path", "start"]).select("path", "start", "state", "line")
    schema = pa.schema([("path", pa.string()), ("schema", pa.string()), ("table", pa.string()), ("ordinal", pa.int64()), ("columns", pa.list_(pa.string())), ("fields", pa.list_(pa.string()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (path, _, state), split in _splits(batches):
            held = []
            for row in scan_lines(split, json.loads(state or "null"), whole):
                held.append(dict(zip(schema.names, (path, *row), strict=True)))
                if len(held) == 5000:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held = []
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)

    return lines.mapInArrow(rows, ROWS)


def table_of(dump: DataFrame, schema: str, table: str, columns: list[str]) -> DataFrame:
    """One table of a dump with its columns by name (all strings)."""
    rows = dump.filter((F.col("schema") == schema) & (F.col("table") == table))
    return rows.select("ordinal", *(F.element_at("fields", F.array_position("columns", F.lit(c)).cast("int")).alias(c) for c in columns))


def is_blank(value) -> F.Column:
    """Null or empty."""
    return value.isNull() | (value == "")


def copy_lines(df: DataFrame, schema: str, table: str) -> DataFrame:
    """(ordinal, line) of a COPY block, header and end included, in ``df``'s order."""
    def quoted(c):
        s = F.col(c).cast("string")
        out = F.replace(s, F.lit("\\"), F.lit("\\\\"))
        for letter, ch in _ESCAPES.items():
            out = F.replace(out, F.lit(ch), F.lit("\\" + letter))
        return F.coalesce(out, F.lit("\\N"))

    spark = df.sparkSession
    head = spark.createDataFrame([(-1, f"COPY {schema}.{table} ({', '.join(df.columns)}) FROM stdin;")], "ordinal long, line string")
    foot = spark.createDataFrame([((1 << 62), "\\.")], "ordinal long, line string")
    body = df.select(F.monotonically_increasing_id().alias("ordinal"), F.concat_ws("\t", *map(quoted, df.columns)).alias("line"))
    return head.union(body).union(foot)


def full_dump(frames: dict[str, DataFrame], schema: str, references: list[tuple[str, str]], serial: dict[str, str], classified: set[str]) -> DataFrame:
    """(position, ordinal, line) of a dump of whole tables, in an order that can be restored:
    schema, tables, a block a table, and the sequences set after the rows.  ``serial``: table
    -> its numbered column.  A table outside ``classified`` is refused before a line is made."""
    from folioscope.operators.package_checks import restore_order

    strange = sorted(set(frames) - classified)
    if strange:
        raise DumpError(f"tables without a class: {strange}")
    spark = next(iter(frames.values())).sparkSession
    order = restore_order(list(frames), references)
    kinds = {"bigint": "bigint", "int": "integer", "double": "double precision", "timestamp": "timestamp", "boolean": "boolean"}
    head = [f"CREATE SCHEMA {schema};"]
    for t in order:
        columns = ", ".join(f"{c} {kinds.get(kind, 'text')}" for c, kind in frames[t].dtypes)
        head.append(f"CREATE TABLE {schema}.{t} ({columns});")
    out = spark.createDataFrame([(0, i, line) for i, line in enumerate(head)], "position int, ordinal long, line string")
    for n, t in enumerate(order, 1):
        out = out.unionByName(copy_lines(frames[t], schema, t).withColumn("position", F.lit(n)))
    for n, (t, c) in enumerate(sorted(serial.items())):
        top = frames[t].agg(F.coalesce(F.max(c), F.lit(0)).alias("m"))
        line = F.format_string(f"SELECT setval(pg_get_serial_sequence('{schema}.{t}', '{c}'), %s);", F.col("m").cast("string"))
        out = out.unionByName(top.select(F.lit(len(order) + 1).alias("position"), F.lit(n).cast("long").alias("ordinal"), line.alias("line")))
    return out
