"""Fill-in-middle transformation by displacement scatter.

Two cuts, counted in code points, part a text into prefix, middle and suffix.
The cuts and the form are drawn from the SHA-256 of ``seed:id``, so a task
that runs again after a lost executor writes the same output:

* ``psm``:  ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* ``spm``:  ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
* ``plain``: the text itself (empty texts, texts that hold a mark, and the
  share of texts that the draw leaves alone)

All texts of a block lie end to end in one byte array.  Code points are
counted by their leading bytes, which turns cuts into byte places.  A
difference array holds, where a part begins, by how much the shift of its
bytes differs from the part before; its cumulative sum is the output place of
every byte of the block, and one scatter writes all outputs.  ``restore``
finds the marks in the outputs, builds the same kind of array over the
restored texts and gathers their bytes back.  No loop runs over texts.

A text outside ``plain`` holds no mark, and a mark begins with the only ``<``
it has, so none can arise where two parts meet: the three marks of an output
are the only ones in it.

Defined cases: null text counts as empty and is plain with n = 0.  A null id
draws like the empty string.  Repeated rows and ids each get their row; ids
that are equal draw the same numbers.  Empty tables give empty results.  Other
columns are ignored, whatever their names.  Memory is a few arrays over one
block of ``BLOCK`` bytes, or over one text where it is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = "1"
PLAIN_FROM = 90  # of 100: texts from this draw on stay plain
SPM_BELOW = 20  # of 100: texts below this draw put the suffix first
BLOCK = 1 << 22  # bytes of text moved at once
PREFIX, SUFFIX, MIDDLE = (np.frombuffer(m, np.uint8) for m in (b"<P>", b"<S>", b"<M>"))
MARK = 3  # bytes of a mark
FORMS = ["plain", "psm", "spm"]
PLAIN, PSM, SPM = range(3)


def draws(id_col: str = "doc_id", seed: str = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers of each id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def blocks(column: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, start of each text and the end) of runs of texts of
    up to so many bytes; a longer text is alone.  Nulls are empty."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    ends = np.zeros(1, kind) if places is None else np.frombuffer(places, kind)[column.offset:]
    ends = ends[:len(column) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
        yield at, raw[ends[at]:ends[stop]], ends[at:stop + 1] - ends[at]
        at = stop


def marks_in(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, rows) of all marks that lie inside one text."""
    at = np.flatnonzero(raw[:-2] == PREFIX[0]) if len(raw) >= MARK else np.zeros(0, np.int64)
    kind = raw[at + 1]
    at = at[(raw[at + 2] == PREFIX[2]) & ((kind == PREFIX[1]) | (kind == SUFFIX[1]) | (kind == MIDDLE[1]))]
    row = np.searchsorted(off, at, "right") - 1
    whole = at + MARK <= off[row + 1]
    return at[whole], row[whole]


def places(begin: np.ndarray, shift: np.ndarray, size: int) -> np.ndarray:
    """Place of each of ``size`` bytes when those from ``begin[k]`` on (in
    ascending order, up to the next) move by ``shift[k]``."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, begin, np.diff(shift, prepend=0))
    return np.cumsum(change[:size]) + np.arange(size)


def scatter(raw: np.ndarray, off: np.ndarray, h: np.ndarray, plain_from: int = PLAIN_FROM,
            spm_below: int = SPM_BELOW) -> dict[str, np.ndarray]:
    """Forms, cuts and outputs of one block; h has a column per draw."""
    points = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    before = np.searchsorted(points[:-1], off)
    n = np.diff(before)
    a, b = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    low, high = np.minimum(a, b), np.maximum(a, b)
    cut, cut2 = points[before[:-1] + low], points[before[:-1] + high]
    form = np.where(h[:, 3] % 100 < spm_below, SPM, PSM)
    form[(n == 0) | (h[:, 2] % 100 >= plain_from)] = PLAIN
    form[marks_in(raw, off)[1]] = PLAIN
    moved = form != PLAIN
    start, end = off[:-1], off[1:]
    out_off = np.concatenate(([0], np.cumsum(end - start + 3 * MARK * moved)))
    prefix, middle, suffix = cut - start, cut2 - cut, end - cut2
    spm = form == SPM
    first = out_off[:-1] + MARK * moved
    second = first + np.where(spm, suffix, prefix) + MARK
    to_prefix = np.where(spm, second, first)
    to_suffix = np.where(spm, first, second)
    to_middle = out_off[1:] - middle
    plain = ~moved  # one part, so that nothing in it moves
    to_middle[plain], to_suffix[plain] = (first + prefix)[plain], (first + prefix + middle)[plain]
    out = np.empty(out_off[-1], np.uint8)
    begin = np.column_stack([start, cut, cut2]).ravel()
    out[places(begin, np.column_stack([to_prefix, to_middle, to_suffix]).ravel() - begin, len(raw))] = raw
    for to, mark in ((to_prefix, PREFIX), (to_suffix, SUFFIX), (to_middle, MIDDLE)):
        out[(to[moved] - MARK)[:, None] + np.arange(MARK)] = mark
    return {"n": n, "form": form, "prefix": low, "middle": high - low, "raw": out, "off": out_off}


def gather_back(raw: np.ndarray, off: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, starts) of the texts of a block of outputs."""
    at, row = marks_in(raw, off)
    moved = np.flatnonzero(form != PLAIN)
    keep = form[row] != PLAIN
    if not np.array_equal(row[keep], np.repeat(moved, 3)):
        raise ValueError("an output without its three marks")
    at = at[keep].reshape(-1, 3)
    spm = form[moved] == SPM
    kinds = raw[at + 1]
    want = np.where(spm[:, None], [SUFFIX[1], PREFIX[1], MIDDLE[1]], [PREFIX[1], SUFFIX[1], MIDDLE[1]])
    if (kinds != want).any():
        raise ValueError("marks of an output are not in the order of its form")
    start, end = off[:-1], off[1:]
    back_off = np.concatenate(([0], np.cumsum(end - start - 3 * MARK * (form != PLAIN))))
    # where in the output each part begins, and its size; a plain text is all prefix
    of_prefix, of_suffix, of_middle = start.copy(), end.copy(), end.copy()
    of_prefix[moved] = np.where(spm, at[:, 1], at[:, 0]) + MARK
    of_suffix[moved] = np.where(spm, at[:, 0], at[:, 1]) + MARK
    of_middle[moved] = at[:, 2] + MARK
    prefix, middle = end - start, np.zeros(len(form), np.int64)
    prefix[moved] = np.where(spm, at[:, 2] - at[:, 1], at[:, 1] - at[:, 0]) - MARK
    middle[moved] = end[moved] - of_middle[moved]
    first = back_off[:-1]
    begin = np.column_stack([first, first + prefix, first + prefix + middle]).ravel()
    source = np.column_stack([of_prefix, of_middle, of_suffix]).ravel()
    return raw[places(begin, source - begin, back_off[-1])], back_off


def _strings(raw: np.ndarray, off: np.ndarray) -> pa.Array:
    if off[-1] < 1 << 31:
        return pa.StringArray.from_buffers(len(off) - 1, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(raw))
    return pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(off), pa.py_buffer(raw))


def transform_column(text: Column, h: list[Column], plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> Column:
    """Struct (n, form, prefix_chars, middle_chars, output) of a text column."""
    kind = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"

    @F.arrow_udf(kind)
    def transform(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        h = np.column_stack([x.to_numpy(zero_copy_only=False) for x in (h1, h2, h3, h4)])
        parts = [scatter(raw, off, h[at:at + len(off) - 1], plain_from, spm_below) for at, raw, off in blocks(texts)]
        if not parts:
            return pa.array([], pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                                           ("middle_chars", pa.int64()), ("output", pa.string())]))
        n, form, prefix, middle = (np.concatenate([p[k] for p in parts]) for k in ("n", "form", "prefix", "middle"))
        plain = form == PLAIN
        return pa.StructArray.from_arrays(
            [pa.array(n), pa.array(FORMS).take(pa.array(form)), pa.array(prefix, mask=plain),
             pa.array(middle, mask=plain), pa.concat_arrays([_strings(p["raw"], p["off"]) for p in parts])],
            ["n", "form", "prefix_chars", "middle_chars", "output"])
    return transform(text, *h)


def restore_column(output: Column, form: Column) -> Column:
    """The texts of outputs, from outputs and forms alone."""
    @F.arrow_udf("string")
    def restore(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        code = pc.index_in(forms, pa.array(FORMS)).to_numpy(zero_copy_only=False)
        parts = [_strings(*gather_back(raw, off, code[at:at + len(off) - 1])) for at, raw, off in blocks(outputs)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())
    return restore(output, form)


def fill_in_middle(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED,
                   plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row."""
    moved = documents.select(F.col(id_col).alias("doc_id"),
                             transform_column(F.col(text_col), draws(id_col, seed), plain_from, spm_below).alias("f"))
    return moved.select("doc_id", "f.*")


def restored(transformed: DataFrame) -> DataFrame:
    """Adds ``restored``, rebuilt from ``output`` and ``form``."""
    return transformed.withColumn("restored", restore_column(F.col("output"), F.col("form")))
