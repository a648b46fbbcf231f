"""Several values packed in one field: one row for each value, with its position.

Values are separated by one of ``;,|`` with blanks (space, tab) around it, or by blanks alone; double quotes
may enclose a value, ``""`` within them is one quote. The text column is read as one Arrow buffer: quote parity
and separator masks are computed over all its bytes at once, child offsets follow from the masks, the values
become a list array, and that is flattened with the ordinals of its parents.

Defined cases: null fields give no row; an empty item (also ``""``) keeps its position and gives no row; blanks
at either end of a field separate nothing; a quote that does not enclose a whole value is an ordinary character
(rows with such quotes are read one by one).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BYTES_AT_ONCE = 1 << 22  # masks and counts take about 60 bytes for each byte of text
QUOTE, HARD, BLANK = 34, b";,|", b" \t"
_IS_HARD, _IS_BLANK = (np.isin(np.arange(256), list(x)) for x in (HARD, BLANK))


def split_one(text: str) -> list[tuple[int, str]]:
    """The same for one field whose quotes may stand anywhere; the definition that the fast path follows."""
    out: list[tuple[int, str]] = []
    n, i, pos, hard_before = len(text), 0, 1, True
    seps, blanks = ";,|", " \t"
    while i < n and text[i] in blanks:
        i += 1
    while i < n:
        if text[i] in seps:  # an item ends here; without a value before it, it was empty
            pos, i, hard_before = pos + 1, i + 1, True
            while i < n and text[i] in blanks:
                i += 1
            continue
        if not hard_before:
            pos += 1
        end, value = None, ""
        if text[i] == '"':
            j = i + 1
            while (j := text.find('"', j)) >= 0:
                if text[j + 1 : j + 2] == '"':
                    j += 2
                elif j + 1 == n or text[j + 1] in seps + blanks:
                    end, value = j + 1, text[i + 1 : j].replace('""', '"')
                    break
                else:
                    break
        if end is None:
            end = i
            while end < n and text[end] not in seps + blanks:
                end += 1
            value = text[i:end]
        if value:
            out.append((pos, value))
        i, hard_before = end, False
        while i < n and text[i] in blanks:
            i += 1
    return out


def split_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Parent ordinal, position and value of every value in an Arrow string array."""
    texts = texts.cast(pa.large_string())
    keep = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
    texts = texts.drop_null()
    rows = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + rows + 1] if rows else np.zeros(1, np.int64)
    if not rows or offsets[-1] == offsets[0]:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), pa.array([], pa.large_string())
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    starts, stops = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    row = np.repeat(np.arange(rows), stops - starts)

    quote = data == QUOTE
    before = np.cumsum(quote) - quote
    at_start = np.concatenate([before, [before[-1] + quote[-1]]])[starts]
    inside = ((before - at_start[row]) & 1).astype(bool)
    sep = (_IS_HARD | _IS_BLANK)[data] & ~inside
    first = np.zeros(data.size, bool)
    first[starts[starts < stops]] = True
    last = np.zeros(data.size, bool)
    last[stops[starts < stops] - 1] = True

    # Quotes that don't enclose a whole value: their rows are read one by one.
    prev_sep, next_sep = np.concatenate([[True], sep[:-1]]) | first, np.concatenate([sep[1:], [True]]) | last
    prev_quote, next_quote = np.concatenate([[False], quote[:-1]]) & ~first, np.concatenate([quote[1:], [False]]) & ~last
    stray = quote & np.where(inside, ~(next_sep | next_quote), ~(prev_sep | (prev_quote & np.concatenate([[False], inside[:-1]]))))
    odd = np.zeros(rows, bool)
    odd[row[stray]] = True
    ends = np.concatenate([before, [before[-1] + quote[-1]]])[stops]
    odd |= ((ends - at_start) & 1).astype(bool)

    part = ~sep & ~odd[row]
    head, tail = np.flatnonzero(part & prev_sep), np.flatnonzero(part & next_sep)
    owner = row[head]
    hard = np.cumsum(_IS_HARD[data] & sep)
    opens = np.concatenate([[True], owner[1:] != owner[:-1]]) if head.size else np.zeros(0, bool)
    lead = hard[head] - (hard[starts[owner]] - (_IS_HARD[data] & sep)[starts[owner]])
    step = np.where(opens, lead, np.maximum(np.diff(hard[head], prepend=0), 1))
    total = np.cumsum(step)
    pos = 1 + total - np.repeat((total - step)[opens], np.diff(np.append(np.flatnonzero(opens), head.size)))

    # Enclosing quotes and the second of two inner quotes go; what is left is the values' own buffer.
    enclosed = quote[head]
    at = np.flatnonzero(part)
    item = np.cumsum((part & prev_sep)[at]) - 1
    drop = quote[at] & ~inside[at] & enclosed[item]
    drop[np.searchsorted(at, tail[enclosed])] = True
    kept, size = at[~drop], np.bincount(item[~drop], minlength=head.size)
    child = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    values = pa.LargeStringArray.from_buffers(head.size, pa.py_buffer(child.tobytes()), pa.py_buffer(data[kept].tobytes()))
    lists = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))]).astype(np.int64), values)
    parent, flat = pc.list_parent_indices(lists).to_numpy(), lists.flatten()
    full = size > 0
    parent, pos, flat = parent[full], pos[full].astype(np.int32), flat.filter(pa.array(full))

    if odd.any():
        slow = [(i, p, v) for i in np.flatnonzero(odd) for p, v in split_one(texts[i].as_py())]
        parent = np.concatenate([parent, np.array([x[0] for x in slow], np.int64)])
        pos = np.concatenate([pos, np.array([x[1] for x in slow], np.int32)])
        flat = pa.concat_arrays([flat, pa.array([x[2] for x in slow], pa.large_string())])
    return keep[parent], pos, flat


def unpack(df: DataFrame) -> DataFrame:
    """field, rec_id, pos, val from rows (field string, rec_id bigint, packed string)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy()
            cuts = np.flatnonzero(np.diff(np.cumsum(size, dtype=np.int64) // BYTES_AT_ONCE)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(batch)]):
                part = batch.slice(lo, hi - lo)
                parent, pos, values = split_buffer(part.column(2))
                at = pa.array(parent)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(pos, pa.int32()), values.cast(pa.string())], ["field", "rec_id", "pos", "val"]
                )

    return df.select("field", F.col("rec_id").cast("bigint"), "packed").mapInArrow(run, "field string, rec_id bigint, pos int, val string")


def stack_fields(df: DataFrame, key: str, fields: list[str], version: str) -> DataFrame:
    """(field, rec_id, packed) for each field of each record, the version loaded last where it came twice."""
    held = df.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(F.col(version), *fields)).alias("v"))
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"v.{f}").alias("packed")) for f in fields))
    return held.select(F.col(key).alias("rec_id"), F.explode(pairs).alias("p")).select("p.field", "rec_id", "p.packed").where("packed is not null")
