"""Rows that fail to parse: split delivered lines into typed rows and labelled rejects.

A delivered line is one comma-separated record.  The loader runs per Arrow batch:

1. quoting is checked on the whole batch with one vector regex; a line that fails it
   could swallow its neighbours and never reaches the CSV reader;
2. the rest is parsed by ``pyarrow.csv`` with every field read as a string.  Its
   invalid-row callback hands over the lines with a wrong number of fields;
3. the columns with a rule are tested as vectors, and the first failing rule names the
   reason; whole-number columns are cast as vectors, and a sound line whose cell does not
   fit keeps that cell's text under the name of its column in ``failed``.

Membership rules (a value must be one of a reference list) are joined afterwards, so
the list is never shipped inside a closure of unknown size.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.session import broadcast_if_small

#: A whole record whose fields are all either free of quotes or properly quoted.
_FIELD = r'(?:"(?:[^"]|"")*"|[^",]*)'
QUOTING = rf"(?s)\A{_FIELD}(?:,{_FIELD})*\z"
EIN = r"\A(?:[0-9]{9}|[0-9]{2}-[0-9]{7})?\z"
_WHOLE = r"(?:[0-9]+|[0-9]{1,3}(?:,[0-9]{3})+)(?:\.00)?"
AMOUNT = rf"\A(?: *(?:-? *(?:\$ ?)?|\$ ?- *){_WHOLE} *)?\z"
#: Cells that are no whole number: column -> text.
FAILED = pa.map_(pa.string(), pa.string())
#: More reference values than this are joined by shuffle instead of broadcast.
MAX_BROADCAST_VALUES = 10_000


@dataclass(frozen=True)
class RecordFormat:
    """The fields of a record in order, and the vector rules on them in order of precedence."""

    dataset: str
    fields: tuple[str, ...]
    rules: tuple[tuple[str, str, str], ...] = ()  # (field, reason, pattern the value must match)
    longs: tuple[str, ...] = ()


AWARDS_FORMAT = RecordFormat(
    "awards",
    ("category", "initiative", "award_type", "member", "organization", "program", "ein", "amount", "agency", "purpose"),
    (("ein", "bad_ein", EIN), ("amount", "bad_amount", AMOUNT)),
    ("amount",),
)
CAPITAL_FORMAT = RecordFormat(
    "capital",
    ("part", "agency", "budget_line", "sub_id", "boro", "fy1", "fy2", "fy3", "fy4", "sponsor", "title", "building_code", "school_code"),
    (),
    ("fy1", "fy2", "fy3", "fy4"),
)


def _parse(ids: pa.Array, lines: pa.Array, fmt: RecordFormat) -> pa.Table:
    """Columns ``_id``, the fields as strings, ``reason``; one row per line."""
    lines = pc.fill_null(lines, "")
    good = pc.match_substring_regex(lines, QUOTING)
    bad_ids = ids.filter(pc.invert(good))
    kept, kept_ids = lines.filter(good), ids.filter(good)
    names = ["_id", *fmt.fields]
    rejected: list[int] = []

    def on_invalid(row) -> str:
        rejected.append(int(row.text.split(",", 1)[0]))
        return "skip"

    parsed = pa.table({n: pa.array([], pa.int64() if n == "_id" else pa.string()) for n in names})
    if len(kept):
        # a bare line break outside quotes would start another record: such a line is read alone
        text = pc.binary_join_element_wise(kept_ids.cast(pa.string()), kept, ",")
        bare = pc.match_substring_regex(pc.replace_substring_regex(kept, r'"(?:[^"]|"")*"', ""), r"[\r\n]")
        for alone in text.filter(bare).to_pylist():
            on_invalid(type("Row", (), {"text": alone}))
        text = text.filter(pc.invert(bare))
        if len(text):
            buf = io.BytesIO(("\n".join(text.to_pylist()) + "\n").encode())
            longest = pc.max(pc.binary_length(text)).as_py()
            parsed = pacsv.read_csv(
                buf,
                read_options=pacsv.ReadOptions(use_threads=False, column_names=names, block_size=max(1 << 20, 4 * longest)),
                parse_options=pacsv.ParseOptions(newlines_in_values=True, ignore_empty_lines=False, invalid_row_handler=on_invalid),
                convert_options=pacsv.ConvertOptions(column_types={n: pa.int64() if n == "_id" else pa.string() for n in names}, strings_can_be_null=False),
            )
    reason = pa.nulls(parsed.num_rows, pa.string())
    for field, why, pattern in reversed(fmt.rules):
        fails = pc.invert(pc.match_substring_regex(parsed[field].combine_chunks(), pattern))
        reason = pc.if_else(fails, why, reason)
    parsed = parsed.append_column("reason", pa.chunked_array([reason]) if isinstance(reason, pa.Array) else reason)
    failing: dict[int, list[tuple[str, str]]] = {}
    for field in fmt.longs:
        text = parsed[field].combine_chunks()
        number, fails = _cast(text)
        parsed = parsed.append_column(f"_n_{field}", number)
        for i in pc.indices_nonzero(fails).to_pylist():
            failing.setdefault(i, []).append((field, text[i].as_py()))
    parsed = parsed.append_column("failed", pa.array([failing.get(i) for i in range(parsed.num_rows)], FAILED))
    names = [*names, *(f"_n_{f}" for f in fmt.longs)]
    blank = lambda n: pa.nulls(n, pa.string())
    parts = [parsed]
    for which, why in ((bad_ids, "quoting"), (pa.array(rejected, pa.int64()), "column_count")):
        n = len(which)
        parts.append(pa.table({
            "_id": which.cast(pa.int64()), **{f: blank(n) for f in fmt.fields}, **{f"_n_{f}": pa.nulls(n, pa.int64()) for f in fmt.longs},
            "reason": pa.array([why] * n, pa.string()), "failed": pa.nulls(n, FAILED),
        }))
    return pa.concat_tables([p.select([*names, "reason", "failed"]) for p in parts]).combine_chunks()


def _cast(text: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(whole numbers, which cells fail): of a column of texts; empty cells are null and sound.

    A number of up to 18 digits always fits and is cast with its column; longer ones are tried one by one.
    """
    digits = pc.replace_substring_regex(pc.replace_substring_regex(text, r"\.00 *\z", ""), r"[$, ]", "")
    empty = pc.equal(digits, "")
    plain = pc.match_substring_regex(digits, r"\A-?[0-9]{1,18}\z")
    number = pc.if_else(plain, digits, None).cast(pa.int64())
    odd = pc.and_(pc.invert(empty), pc.invert(plain))
    if pc.any(odd).as_py():
        values, still = number.to_pylist(), odd.to_pylist()
        for i in pc.indices_nonzero(odd).to_pylist():
            s = digits[i].as_py()
            if re.fullmatch(r"-?[0-9]+", s) and -(1 << 63) <= int(s) < 1 << 63:
                values[i], still[i] = int(s), False
        number, odd = pa.array(values, pa.int64()), pa.array(still, pa.bool_())
    return number, odd


def parse_lines(lines: DataFrame, fmt: RecordFormat, id_col: str = "line_id", line_col: str = "line") -> DataFrame:
    """One row per line: the id, every field as string (null in a rejected line), ``reason`` (null if sound), the cast whole numbers and ``failed``.

    ``failed`` maps a column of whole numbers to its text where that is none, or none that
    fits 64 bits; null if all cells fit.

    Null and empty lines have one empty field and are rejected as ``column_count``.
    Extra columns of ``lines`` are ignored.  An empty input gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield from _parse(b.column(0).cast(pa.int64()), b.column(1).cast(pa.string()), fmt).to_batches()

    schema = T.StructType([T.StructField("_id", T.LongType()), *(T.StructField(f, T.StringType()) for f in fmt.fields), *(T.StructField(f"_n_{f}", T.LongType()) for f in fmt.longs), T.StructField("reason", T.StringType()), T.StructField("failed", T.MapType(T.StringType(), T.StringType()))])
    out = lines.select(F.col(id_col).cast("long").alias("_id"), F.col(line_col).cast("string").alias("_line")).mapInArrow(run, schema)
    return out.withColumnRenamed("_id", id_col)


def require_member(parsed: DataFrame, field: str, allowed: DataFrame, allowed_col: str, reason: str) -> DataFrame:
    """Label rows whose ``field`` is not exactly one of ``allowed``; earlier reasons stay.

    Null and empty entries of the list allow nothing.  Repeated entries count once.
    """
    names = allowed.select(F.col(allowed_col).alias("_name")).where(F.col("_name") != "").distinct()
    j = parsed.join(broadcast_if_small(names, MAX_BROADCAST_VALUES), parsed[field] == F.col("_name"), "left")
    return j.withColumn("reason", F.coalesce("reason", F.when(F.col("_name").isNull(), reason))).drop("_name")


def typed(parsed: DataFrame, fmt: RecordFormat) -> DataFrame:
    """The sound rows with whole-number fields as BIGINT (empty to null); ``failed`` holds as JSON the text of every cell that is no such number."""
    ok = parsed.where(F.col("reason").isNull()).drop("reason")
    return ok.withColumns({c: F.col(f"_n_{c}") for c in fmt.longs}).withColumn("failed", F.to_json("failed")).drop(*(f"_n_{c}" for c in fmt.longs))


@dataclass(frozen=True)
class LoadResult:
    awards: DataFrame
    capital: DataFrame
    rejects: DataFrame  # line_id, reason


def load_lines(raw_lines: DataFrame, capital: DataFrame) -> LoadResult:
    """Load ``raw_lines`` (line_id, dataset, line): typed awards, typed capital rows, and every other line with its reason."""
    pick = lambda d: raw_lines.where(F.col("dataset") == d).select("line_id", "line")
    a = parse_lines(pick("awards"), AWARDS_FORMAT)
    c = require_member(parse_lines(pick("capital"), CAPITAL_FORMAT), "agency", capital, "agency", "bad_agency")
    bad = lambda d: d.where(F.col("reason").isNotNull()).select("line_id", "reason")
    return LoadResult(typed(a, AWARDS_FORMAT), typed(c, CAPITAL_FORMAT), bad(a).unionByName(bad(c)))
