"""Byte-level BPE: every distinct pre-token outside a small hot set is encoded where its occurrences meet.

1. A sample of documents tells which pre-tokens are hot. As many as fit a few megabytes, most used first, go to
   every task with their ids. This set changes the cost, never the ids.
2. Texts are cut by the pattern, once. A slab of texts is kept as a compressed stream of numbers, one a place: that of a hot
   pre-token, or a number of its own for each other pre-token of the slab. Those are exploded with their numbers, the
   ones of a slab that go the same way in one row.
3. One shuffle brings equal pre-tokens together, and a task merges each once, by rank.
4. The ids are joined back to their slab, and every place takes the ids of its number.
5. Decoding looks each id up in the table of token bytes, which every task holds: its size is the vocabulary's.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

#: bytes of hot pre-tokens and their ids
HOT = 4 << 20
#: documents that are counted for them
SAMPLE = 20_000
#: distinct pre-tokens that a counting task holds before it hands them on
COUNTED = 100_000
#: pre-tokens of a slab; a longer text is a slab of its own
SLAB = 1 << 19
#: ways into which exploded pre-tokens part: so many documents have one of their own, within these bounds
DOCS_A_WAY, WAYS = 20_000, (32, 4096)
#: pre-tokens whose ids a task keeps while it merges; beyond that it may merge one again
MERGED = 1_000_000


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, one base64 token and its rank to a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, table: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of least rank merges first, the leftmost on ties."""
    if (whole := table.get(piece)) is not None:
        return [whole]
    end = list(range(1, len(piece) + 1))  # end of the part that starts here
    left = list(range(-1, len(piece) - 1))  # start of the part before
    size, alive = len(piece), [True] * len(piece)
    heap = []

    def offer(start: int) -> None:
        if start >= 0 and (middle := end[start]) < size:
            rank = table.get(piece[start : end[middle]])
            if rank is not None:
                heapq.heappush(heap, (rank, start, end[middle]))

    for start in range(size - 1):
        offer(start)
    while heap:
        _, start, stop = heapq.heappop(heap)
        if not alive[start] or end[start] >= size or end[end[start]] != stop:
            continue
        alive[end[start]] = False
        end[start] = stop
        if stop < size:
            left[stop] = start
        offer(start)
        offer(left[start])
    return [table[piece[i : end[i]]] for i in range(size) if alive[i]]


def _counted(texts: DataFrame, pattern: str) -> DataFrame:
    """(piece, uses) of the whole corpus."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen = regex.compile(pattern), Counter()

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["piece", "uses"])
            seen.clear()
            return got

        for batch in batches:
            for text in batch.column(0):
                seen.update(cut.findall(text.as_py() or ""))
                if len(seen) >= COUNTED:
                    yield out()
        yield out()

    return texts.mapInArrow(of, "piece string, uses bigint").groupBy("piece").agg(F.sum("uses").alias("uses"))


@lru_cache(maxsize=4)
def _kind(path: str) -> str:
    return "<u2" if max(ranks(path).values()) < 1 << 16 else "<u4"


class _Ids(dict):
    """Packed ids by the bytes of a pre-token, each merged when it is first asked for."""

    def __init__(self, path: str):
        super().__init__()
        self.table, self.kind = ranks(path), _kind(path)

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= MERGED:
            self.clear()
        found = self[piece] = np.array(merge(piece, self.table), self.kind).tobytes()
        return found


def hot_pieces(texts: DataFrame, path: str, pattern: str, hot: int = HOT, sample: int = SAMPLE) -> tuple[list[str], list[bytes]]:
    """The most used pre-tokens of a sample and their ids, most used first, at most `hot` bytes; those used once are left out."""
    total = texts.count()
    if not total or not hot:
        return [], []
    some = texts.filter(F.pmod(F.xxhash64("text", F.lit("hot")), F.lit(1 << 30)) < int(min(1.0, sample / total) * (1 << 30)))
    counted = stored(_counted(some, pattern).filter("uses > 1"), "hot_pieces")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([ids[p] for p in batch.column(0).cast(pa.binary()).to_pylist()], pa.binary())], ["piece", "uses", "ids"])

    encoded = counted.mapInArrow(of, "piece string, uses bigint, ids binary")
    size = F.octet_length("piece") + F.octet_length("ids")
    pieces = stored(encoded.withColumns({"size": size, "step": F.floor(F.log2("uses") * 8)}), "hot_encoded")
    least, room = None, hot
    # one row for each eighth of a power of two
    for step, n in pieces.groupBy("step").agg(F.sum("size").alias("n")).orderBy(F.desc("step")).collect():
        if (room := room - n) < 0:
            break
        least = step
    if least is None:
        return [], []
    found = pieces.filter(F.col("step") >= least).select("piece", "ids", "uses").toArrow().sort_by([("uses", "descending"), ("piece", "ascending")])
    return found["piece"].to_pylist(), found["ids"].to_pylist()


class _Numbers(dict):
    """Number of a pre-token: its place among the hot ones, or after those one that is given when it is first seen."""

    def __init__(self, hot: list[str]):
        super().__init__(zip(hot, range(len(hot))))
        self.hot, self.fresh = len(hot), []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = self.hot + len(self.fresh)
        self.fresh.append(piece)
        return number

    def forget(self) -> list[str]:
        """Pre-tokens that were given numbers since the last call; the numbers are free again."""
        fresh, self.fresh = self.fresh, []
        for piece in fresh:
            del self[piece]
        return fresh


def packed_stream(numbers: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: the high ones are nearly empty."""
    return zstandard.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked_stream(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def packed_parts(numbers: list[int], parts: list[bytes]) -> bytes:
    """Rising numbers, and the bytes that belong to each, as one compressed binary."""
    heads = np.concatenate([np.diff(numbers, prepend=0), [len(p) for p in parts]]).astype("<u4")
    planes = heads.view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.compress(b"".join([len(numbers).to_bytes(4, "little"), planes, *parts]), 3)


def unpacked_parts(packed: bytes) -> tuple[list[int], list[bytes]]:
    raw = zstandard.decompress(packed)
    n = int.from_bytes(raw[:4], "little")
    heads = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, 4).reshape(4, -1).T).view("<u4").ravel()
    stops = np.cumsum(np.append(4 + 8 * n, heads[n:].astype(np.int64))).tolist()
    return np.cumsum(heads[:n]).tolist(), [raw[a:b] for a, b in zip(stops, stops[1:])]


def _slabs(slim: DataFrame, pattern: str, hot: Broadcast, ways: int) -> DataFrame:
    """(slab, ids, places, stream, rest): texts of (id, text) as numbers, and the pre-tokens that are not hot by their way."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, numbers = regex.compile(pattern), _Numbers(hot.value[0])

        def slab(ids: pa.Array, texts: list[np.ndarray]) -> pa.RecordBatch:
            rest: dict[int, tuple[list, list]] = {}
            for k, piece in enumerate(numbers.forget()):
                raw = piece.encode()
                own = rest.setdefault(zlib.crc32(raw) % ways, ([], []))
                own[0].append(k)
                own[1].append(raw)
            return pa.RecordBatch.from_arrays([
                pa.array([uuid.uuid4().bytes], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int32())),
                pa.array([packed_stream(np.concatenate(texts))], pa.binary()),
                pa.array([[{"way": w, "pieces": packed_parts(*own)} for w, own in sorted(rest.items())]],
                         pa.list_(pa.struct([("way", pa.int32()), ("pieces", pa.binary())]))),
            ], ["slab", "ids", "places", "stream", "rest"])

        for batch in batches:
            first, texts, size = 0, [], 0
            for i, t in enumerate(batch.column(1)):
                pieces = cut.findall(t.as_py() or "")
                texts.append(np.fromiter(map(numbers.__getitem__, pieces), np.uint32, len(pieces)))
                size += len(pieces)
                if size >= SLAB or i == batch.num_rows - 1:
                    yield slab(batch.column(0).slice(first, len(texts)), texts)
                    first, texts, size = i + 1, [], 0

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(of, f"slab binary, ids array<{kind}>, places array<int>, stream binary, rest array<struct<way:int,pieces:binary>>")


def encode(
    docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text", hot: int = HOT, sample: int = SAMPLE,
) -> DataFrame:
    """(id, ids) for every row: the token ids of the whole text, as little-endian numbers in one binary.

    `ids_of` makes an array of them. A NULL text is empty and has no ids. Special tokens are ordinary text.
    Repeated rows and rows of NULL id get a row each. An empty table gives no rows.
    Other columns are not read. The numbers have two bytes if the vocabulary allows, else four.
    """
    slim = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(hot_pieces(slim.select("text"), path, pattern, hot, sample))
    ways = min(max(WAYS[0], slim.count() // DOCS_A_WAY), WAYS[1])
    slabs = stored(_slabs(slim, pattern, known, ways), "slabs")
    kind = slim.schema["id"].dataType.simpleString()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids(path)
        for batch in batches:
            found = []
            for packed in batch.column(1).to_pylist():
                numbers, pieces = unpacked_parts(packed)
                found.append(packed_parts(numbers, [ids[p] for p in pieces]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["slab", "ids"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, hot_ids = _kind(path), known.value[1]
        hot_flat, hot_sizes = np.frombuffer(b"".join(hot_ids), kind), np.array([len(x) for x in hot_ids], np.int64)
        for batch in batches:
            of_docs, docs_ids = [], []
            for i in range(batch.num_rows):
                numbers = unpacked_stream(batch.column(2)[i].as_py())
                own: dict[int, bytes] = {}
                for part in batch.column(3)[i].as_py() or ():
                    own.update(zip(*unpacked_parts(part)))
                # after the hot ones numbers were given one after the other
                late = [own[k] for k in range(len(own))]
                flat = np.concatenate([hot_flat, np.frombuffer(b"".join(late), kind)])
                sizes = np.concatenate([hot_sizes, np.array([len(x) for x in late], np.int64)]) // np.dtype(kind).itemsize
                starts = np.cumsum(sizes) - sizes
                each = sizes[numbers]
                ends = np.cumsum(each)
                ids = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[numbers] - (ends - each), each)]
                stops = np.append(0, ends)[np.cumsum(batch.column(1)[i].as_py())]
                of_docs += [ids[a:b].tobytes() for a, b in zip(np.append(0, stops[:-1]), stops)]
                docs_ids.append(batch.column(0)[i].values)
            if docs_ids:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(docs_ids), pa.array(of_docs, pa.binary())], ["id", "ids"])

    exploded = slabs.select("slab", F.inline("rest")).repartition("way").select("slab", "pieces")
    late = exploded.mapInArrow(merged, "slab binary, ids binary").groupBy("slab").agg(F.collect_list("ids").alias("late"))
    both = slabs.select("slab", "ids", "places", "stream").join(late, "slab", "left")
    return both.select("ids", "places", "stream", "late").mapInArrow(whole, f"id {kind}, ids binary").withColumnRenamed("id", id)


def ids_of(packed: bytes | None, path: str) -> np.ndarray:
    return np.frombuffer(packed or b"", _kind(path))


@lru_cache(maxsize=4)
def _tokens(path: str) -> np.ndarray:
    """Token bytes by id."""
    table = ranks(path)
    tokens = np.full(max(table.values()) + 1, b"", dtype=object)
    for token, rank in table.items():
        tokens[rank] = token
    return tokens


def decode(encoded: DataFrame, path: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, ids, bytes): the bytes that the ids of every row stand for. NULL ids are none; an unknown id is an error."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        for batch in batches:
            found = [b"".join(tokens[ids_of(x.as_py(), path)].tolist()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [id, ids, "bytes"])

    kind = encoded.schema[id].dataType.simpleString()
    return encoded.select(id, ids).mapInArrow(of, f"`{id}` {kind}, `{ids}` binary, bytes binary")


def digests(encoded: DataFrame, path: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of what `encode` returns, decoded row by row: no text leaves its task."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        # numerals with a blank, all of one width: bytes that are looked up without a loop
        numerals = np.array([f"{i} " for i in range(len(tokens))], dtype="S")
        for batch in batches:
            n, told, back = [], [], []
            for x in batch.column(1):
                ids = ids_of(x.as_py(), path)
                n.append(len(ids))
                told.append(hashlib.sha256(numerals[ids].tobytes().replace(b"\0", b"")[:-1]).hexdigest())
                back.append(hashlib.sha256(b"".join(tokens[ids].tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(told, pa.string()), pa.array(back, pa.string())],
                [id, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = encoded.schema[id].dataType.simpleString()
    return encoded.select(id, ids).mapInArrow(of, f"`{id}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
