"""Fill-in-middle over texts stored as seekable compressed frames.

1. `pack` cuts each text into frames of a fixed number of code points. A frame is an independent zstandard
   frame with the number of code points before it, so any range is read from the frames that cover it. The store is
   written to the shared folder; what follows reads it and never the texts.
2. `planned` draws form and cuts from a hash of the id, by plain column functions.
3. `arranged` reorders frames. Whole frames move as they are, compressed; only the at most two that hold a cut are
   decompressed and their pieces compressed again. Marks are frames of their own.
4. `restored` finds the marks by streaming the output and puts the ranges between them back in order.
5. `digested` streams frames in order through a digest.

A row holds one text's frames, so nothing is shuffled, and a task decompresses one frame at a time: beyond the
compressed row its memory does not depend on the length of a text.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored, text_of

#: code points of a frame
FRAME = 1 << 15
LEVEL = 3
#: fixed values: the marks, and shares of 100
MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
CHANGED, SPM = 90, 20
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}

FRAMES = "array<struct<start:bigint,units:int,data:binary>>"
_FRAMES = pa.list_(pa.struct([("start", pa.int64()), ("units", pa.int32()), ("data", pa.binary())]))
#: (code points, compressed bytes) of one frame; where it starts follows from those before it
Frame = tuple[int, bytes]


def _compressed(text: str) -> Frame:
    return len(text), zstandard.compress(text.encode(), LEVEL)


def _text(data: bytes) -> str:
    return zstandard.decompress(data).decode()


def frames_of(text: str, size: int = FRAME) -> list[Frame]:
    return [_compressed(text[i : i + size]) for i in range(0, len(text), size)]


def placed(frames: list[Frame]) -> list[dict]:
    """Frames with their cumulative counts, as stored."""
    out, start = [], 0
    for units, data in frames:
        out.append({"start": start, "units": units, "data": data})
        start += units
    return out


def span(frames: list[dict], start: int, stop: int) -> list[Frame]:
    """Frames of the code points from start to before stop: whole frames as they are, cut ones compressed anew."""
    out = []
    at = max(0, bisect_right(frames, start, key=lambda f: f["start"]) - 1)
    while start < stop and at < len(frames):
        f = frames[at]
        end = min(stop, f["start"] + f["units"])
        if start == f["start"] and end - start == f["units"]:
            out.append((f["units"], f["data"]))
        elif start < end:
            out.append(_compressed(_text(f["data"])[start - f["start"] : end - f["start"]]))
        start, at = max(start, end), at + 1
    return out


def _length(frames: list[dict]) -> int:
    return frames[-1]["start"] + frames[-1]["units"] if frames else 0


def arrange(frames: list[dict], form: str, prefix: int | None, middle: int | None) -> list[Frame]:
    """Frames of the output of one text."""
    if form == "plain":
        return [(f["units"], f["data"]) for f in frames]
    ranges = {"prefix": (0, prefix), "middle": (prefix, prefix + middle), "suffix": (prefix + middle, _length(frames))}
    out = []
    for part in ORDERS[form]:
        out += [_compressed(MARKS[part]), *span(frames, *ranges[part])]
    return out


def restore(frames: list[dict], form: str) -> list[Frame]:
    """Frames of the text that an output of this form was made from; the marks are looked for, not remembered."""
    if form == "plain":
        return [(f["units"], f["data"]) for f in frames]
    at, before = {}, ""
    for f in frames:
        # a mark may lie across frames
        seen = before + _text(f["data"])
        for part, mark in MARKS.items():
            if (found := seen.find(mark)) >= 0:
                at.setdefault(part, f["start"] - len(before) + found)
        before = seen[-2:]
    stops = dict(zip(ORDERS[form], [*[at[p] for p in ORDERS[form][1:]], _length(frames)]))
    return [f for part in ("prefix", "middle", "suffix") for f in span(frames, at[part] + len(MARKS[part]), stops[part])]


def digest(frames: list[dict]) -> str:
    told = hashlib.sha256()
    for f in frames:
        told.update(zstandard.decompress(f["data"]))
    return told.hexdigest()


def _mapped(df: DataFrame, of: Callable, reads: list[str], name: str, kind: str, arrow: pa.DataType) -> DataFrame:
    """The frame with column `name` (new, or in place) as of(*values of `reads`), row by row inside Arrow batches."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([of(*[v.as_py() for v in row]) for row in zip(*[batch.column(c) for c in reads])], arrow)
            columns = {c: batch.column(c) for c in batch.schema.names} | {name: found}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    fields = {f.name: f.dataType.simpleString() for f in df.schema} | {name: kind}
    return df.mapInArrow(over, ", ".join(f"`{c}` {t}" for c, t in fields.items()))


def pack(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = FRAME) -> DataFrame:
    """(id, n, marked, frames) of every row, n in code points; marked: the text has one of the marks. A NULL text is empty."""
    base = docs.select(F.col(id).alias("id"), text_of(text).alias("text"))
    known = base.select("id", F.length("text").cast("bigint").alias("n"), F.expr(" OR ".join(f"contains(text, '{m}')" for m in MARKS.values())).alias("marked"), "text")
    packed = _mapped(known, lambda t: placed(frames_of(t, size)), ["text"], "frames", FRAMES, _FRAMES)
    return packed.drop("text")


def read_range(store: DataFrame, start: str, stop: str) -> DataFrame:
    """The store with column `piece`, the code points from column `start` to before column `stop`; NULL bounds give NULL."""

    def of(frames: list[dict], a: int | None, b: int | None) -> str | None:
        return None if a is None or b is None else "".join(_text(data) for _, data in span(frames, max(0, a), b))

    return _mapped(store, of, ["frames", start, stop], "piece", "string", pa.string())


def planned(store: DataFrame) -> DataFrame:
    """The store with form, prefix_chars and middle_chars; both are NULL where the text stays plain."""
    told = F.sha2(F.concat(F.lit("1:"), text_of("id")), 256)
    h = [F.conv(F.substring(told, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]
    plain = (F.col("n") == 0) | F.col("marked") | (h[2] % 100 >= CHANGED)
    cuts = [h[i] % (F.col("n") + 1) for i in (0, 1)]
    first = F.least(*cuts)
    return store.withColumns({
        "form": F.when(plain, "plain").when(h[3] % 100 < SPM, "spm").otherwise("psm"),
        "prefix_chars": F.when(~plain, first),
        "middle_chars": F.when(~plain, F.greatest(*cuts) - first),
    })


def arranged(plan: DataFrame) -> DataFrame:
    """The plan with the frames of the output."""
    return _mapped(plan, lambda *row: placed(arrange(*row)), ["frames", "form", "prefix_chars", "middle_chars"], "frames", FRAMES, _FRAMES)


def restored(output: DataFrame) -> DataFrame:
    """The output with the frames of the text rebuilt from frames and form alone."""
    return _mapped(output, lambda *row: placed(restore(*row)), ["frames", "form"], "frames", FRAMES, _FRAMES)


def digested(store: DataFrame, name: str) -> DataFrame:
    """The store with the sha256 of the whole UTF-8 text that its frames hold, in lowercase hex."""
    return _mapped(store, digest, ["frames"], name, "string", pa.string())


def transform(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = FRAME) -> DataFrame:
    """(id, n, marked, frames, form, prefix_chars, middle_chars) for every row, with the frames of the output.

    Form and cuts depend on the id only, so repeated rows come out alike; rows of NULL id hash as an empty id. NULL texts
    are empty and stay plain, as do texts that have a mark. Other columns are not read. An empty table gives no rows.
    """
    store = stored(pack(docs, id, text, size), "frames")
    return arranged(planned(store)).withColumnRenamed("id", id)
