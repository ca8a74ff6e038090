"""CSV records whose quoted fields hold line ends, read by many tasks a file.

Whether a line of a file starts a record or goes on inside a quoted field depends on
everything before it. Read line by line, a file can still be split anywhere: a
line maps the state at its start (outside or inside a quoted field) to the state at its
end, and so does a run of lines. The steps:

1. every input split composes its lines into one such map (one row per split);
2. the driver goes through these maps in file order, which gives the state in which each split
   starts;
3. every split puts its lines together into records; a record that crosses into
   other splits comes in fragments, at most two a split, which are joined.

No whole file is read by one task and no row but the fragments is shuffled. Quotes
inside a quoted field are doubled; a quote inside an unquoted field is a plain
character; what follows a closing quote belongs to the field up to the next comma. Lines end
with ``\\n`` or ``\\r\\n``. A quote that is never closed makes the rest of its file one record.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronage.operators.rank import checkpointed

_FIELD = rb'(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|)'
_CLOSED_FROM_OUTSIDE = re.compile(_FIELD + rb"(?:," + _FIELD + rb")*+")
_CLOSED_FROM_INSIDE = re.compile(rb'(?:[^"]++|"")*+"[^,]*+(?:,' + _FIELD + rb")*+")

WHOLE, OPENS, GOES_ON, CLOSES = range(4)  # what a piece is of its record

_EFFECT = "_file string, _block bigint, outside boolean, inside boolean"
_PIECE = "_file string, _block bigint, place bigint, part int, record string"


def line_effect(line: bytes) -> tuple[bool, bool]:
    """Is the end of a line inside a quoted field, if its start is outside; if its start is inside?"""
    if b'"' not in line:
        return False, True
    return _CLOSED_FROM_OUTSIDE.fullmatch(line) is None, _CLOSED_FROM_INSIDE.fullmatch(line) is None


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes]]:
    for batch in batches:
        yield from zip(zip(batch["_file"].to_pylist(), batch["_block"].to_pylist()), batch["line"].to_pylist())


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: the composed map of its lines."""
    found: dict[tuple[str, int], tuple[bool, bool]] = {}
    for split, line in _rows(batches):
        at = found.get(split, (False, True))
        if b'"' in line:
            effect = line_effect(line)
            at = effect[at[0]], effect[at[1]]
        found[split] = at
    if found:
        yield pa.RecordBatch.from_pydict({
            "_file": [f for f, _ in found], "_block": pa.array([b for _, b in found], pa.int64()),
            "outside": [o for o, _ in found.values()], "inside": [i for _, i in found.values()]})


class _Pieces:
    """Output rows, handed on in batches of ``size``."""

    def __init__(self, size: int = 4096):
        self.size, self.rows = size, []

    def full(self) -> bool:
        return len(self.rows) >= self.size

    def take(self) -> pa.RecordBatch:
        f, b, place, part, record = zip(*self.rows)
        self.rows = []
        return pa.RecordBatch.from_pydict({"_file": list(f), "_block": pa.array(b, pa.int64()), "place": pa.array(place, pa.int64()),
                                           "part": pa.array(part, pa.int32()), "record": pa.array(record, pa.string())})


def _assemble(starts: dict[str, dict[int, bool]], encoding: str, header: bool, whole_only: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, split, lines, inside, part, place = _Pieces(), None, [], False, WHOLE, 0

        def emit(kind: int) -> int:
            """Add the lines at hand; returns the place of the next record."""
            if whole_only and kind != WHOLE:
                raise RuntimeError("the input splits changed since they were counted: read the files again")
            text = b"\n".join(lines)
            if kind in (WHOLE, CLOSES):
                text = text.removesuffix(b"\r")
            if kind == WHOLE and not text:
                return place  # a blank line
            own = place if kind in (WHOLE, OPENS) else -1
            if header and split[1] == 0 and own == 0 and not headed[0]:
                headed[0] = True
                if kind == WHOLE:
                    return place
                own = -2  # the header goes on in the next split
            out.rows.append((*split, own, kind, text.decode(encoding, "replace")))
            return place + (own >= 0)

        headed = [False]
        for here, line in _rows(batches):
            if here != split:
                if lines:
                    emit(OPENS if part == WHOLE else GOES_ON)
                if here[1] not in starts.get(here[0], {}):
                    raise RuntimeError("the input splits changed since they were counted: read the files again")
                split, lines, place, headed[0] = here, [], 0, False
                inside = starts[here[0]][here[1]]
                part = CLOSES if inside else WHOLE
            lines.append(line)
            if b'"' in line:
                inside = line_effect(line)[inside]
            if not inside:
                place = emit(part)
                lines, part = [], WHOLE
                if out.full():
                    yield out.take()
        if lines:
            emit(OPENS if part == WHOLE else GOES_ON)
        if out.rows:
            yield out.take()
    return run


def _starts(effects: pa.Table) -> tuple[dict[str, dict[int, bool]], bool]:
    """State at the start of each split, and whether any record crosses splits."""
    starts: dict[str, dict[int, bool]] = {}
    state, crossing, last = False, False, None
    for row in effects.sort_by([("_file", "ascending"), ("_block", "ascending")]).to_pylist():
        if row["_file"] != last:
            state, last = False, row["_file"]
        starts.setdefault(last, {})[row["_block"]] = state
        state = row["inside"] if state else row["outside"]
        crossing = crossing or state
    return starts, crossing


def read_records(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", header: bool = True) -> DataFrame:
    """The records of CSV files as text: ``record`` and ``_seq`` (file, offset of the
    split in which it starts, its place there from 0), whose order is the file order.
    Blank lines are left out, and with ``header`` the first record of each file.

    A first job runs at once: it reads every line and returns one row per input split. If no record
    crosses splits the rest is lazy; otherwise the records are stored once. An
    ``encoding`` in which line ends, commas or quotes aren't their ASCII bytes is an error."""
    if '\n",'.encode(encoding) != b'\n",':
        raise ValueError(f"records can't be split in {encoding}")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.col("value").cast("binary").alias("line"))
    starts, crossing = _starts(lines.mapInArrow(_effects, _EFFECT).toArrow())
    pieces = lines.mapInArrow(_assemble(starts, encoding, header, not crossing), _PIECE)
    if crossing:
        pieces = checkpointed(pieces)
    seq = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("place"))
    whole = pieces.where(F.col("part") == WHOLE).select("record", seq.alias("_seq"))
    return whole.unionAll(_joined(pieces.where(F.col("part") != WHOLE))) if crossing else whole


def _joined(pieces: DataFrame) -> DataFrame:
    """Records from fragments: each belongs to the last one that opens at or before it."""
    opens = F.when(F.col("part") == OPENS, F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("place")))
    # at most two fragments a split meet in a file's window
    ordered = Window.partitionBy("_file").orderBy("_block", F.col("part") == OPENS)
    owned = pieces.withColumn("_seq", F.last(opens, ignorenulls=True).over(ordered))
    parts = F.sort_array(F.collect_list(F.struct("_block", (F.col("part") == OPENS).alias("_opens"), "record")))
    text = F.array_join(F.transform(parts, lambda p: p["record"]), "\n")
    return owned.groupBy("_seq").agg(text.alias("record")).where("_seq.place >= 0").select("record", "_seq")
