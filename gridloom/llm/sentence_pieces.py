"""SentencePiece encoding and decoding, with a max-plus scan for giant documents.

A document of at most ``giant`` code points is encoded by the library in its
task. A longer one is cut into chunks at fixed places, wherever these fall.
A piece that ends at or reaches over a cut is a boundary state. A chunk's
transfer matrix holds, for each state at its left and each at its right end,
the best score of a path of pieces between them; matrices combine by max-plus
products, which are associative, so a document's chunks are worked on in any
place and order. The states on the best path are then handed back, and every
chunk traces its own part of the path by itself.

The model here is of the BPE kind. An encoding is the BPE encoding if and only
if each two neighbouring pieces are what BPE makes of their joint text, so a
step between pieces scores 0 where that holds and minus infinity elsewhere, and
the best path is the library's own encoding. Pieces never reach over the start
of a word, so inside a chunk whole words go through the library and the scan
works on what lies beside the cuts; a chunk without a word's start is scanned
piece by piece.

Null and empty texts have no pieces. Very long texts are what the scan is for.
Rows that are repeated are encoded alike; rows without a doc_id are told apart by
their texts. Where several paths score alike, there is but one: an encoding is
unique. An empty table gives no rows. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialize, row_identity, ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
GIANT, CHUNK = 32_768, 16_384
SPACE = "▁"
NEVER = -np.inf
#: Texts or chunks that are Python objects at a time.
AT_ONCE = 128


class Pieces:
    """The model, told to add no prefix of its own, so that parts of a text can be encoded."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        self.prefix = SPACE if spec.normalizer_spec.add_dummy_prefix else ""
        if spec.normalizer_spec.name != "identity" or spec.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("chunks need a model that leaves text as it is")
        spec.normalizer_spec.add_dummy_prefix = False
        self.part = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.longest = max(len(p.piece) for p in spec.pieces)
        self.words = frozenset(p.piece for p in spec.pieces if p.type == p.NORMAL)
        if any(SPACE in p.lstrip(SPACE) for p in self.words):
            raise ValueError("a piece reaches over the start of a word")
        self.encode = lru_cache(1 << 14)(lambda text: tuple(self.part.encode(text)))
        self.follows = lru_cache(1 << 15)(lambda a, b: self.encode(a + b) == self.encode(a) + self.encode(b))

    @lru_cache(1 << 15)  # noqa: B019  one instance a task
    def is_piece(self, text: str) -> bool:
        return len(text) == 1 or (text in self.words and len(self.encode(text)) == 1)

    def normal(self, text: str) -> str:
        return self.prefix + text.replace(" ", SPACE) if text else ""

    def states(self, text: str, cut: int) -> list[tuple[int, int]]:
        """(start, end) of the pieces with start < cut <= end."""
        return [(a, b) for a in range(max(0, cut - self.longest), cut) for b in range(cut, min(len(text), a + self.longest) + 1) if self.is_piece(text[a:b])]


def word_start(text: str, at: int, to: int) -> int:
    """First place from ``at`` on, up to ``to``, where a run of spaces begins after another character; -1 if none."""
    while 0 <= (at := text.find(SPACE, max(at, 1), to)):
        if text[at - 1] != SPACE:
            return at
        at += 1
    return -1


def last_word_start(text: str, at: int, to: int) -> int:
    while at < to:
        to = text.rfind(SPACE, at, to)
        if to <= 0 or to < at:
            return -1
        if text[to - 1] != SPACE:
            return to
    return -1


def paths(pieces: Pieces, text: str, begin: dict, to: int) -> tuple[dict, dict]:
    """Max-plus sweep from states (start, end) to all pieces that end at or reach over ``to``.

    begin: state -> vector of scores. Returns the vectors of the states at ``to``, and each
    piece's best predecessor by the first component.
    """
    ends: dict[int, dict] = {}
    back: dict = {}
    for state, score in begin.items():
        ends.setdefault(state[1], {})[state] = score
    done: dict = {}
    for at in range(min(ends, default=to), to):
        if not (here := ends.pop(at, None)):
            continue
        for b in range(at + 1, min(len(text), at + pieces.longest) + 1):
            if not pieces.is_piece(text[at:b]):
                continue
            best, by = None, None
            for state, score in here.items():
                if state[0] == state[1] or pieces.follows(text[state[0] : state[1]], text[at:b]):
                    best = score if best is None else np.maximum(best, score)
                    by = state if by is None or score[0] > NEVER else by
            if best is not None and (best > NEVER).any():
                ends.setdefault(b, {})[at, b] = best
                back[at, b] = by
    for here in ends.values():
        done.update(here)
    return done, back


def _enter(begin: list[tuple[int, int]], pieces: Pieces, text: str, left: int, right: int) -> tuple[int, int]:
    """First and last word start that the chunk can be split at; -1, -1 if there is none.

    A split needs every boundary state to lie on its own side.
    """
    to = max(0, right - pieces.longest)
    first = word_start(text, max((b for _, b in begin), default=left), to)
    return (first, last_word_start(text, first, to)) if first >= 0 else (-1, -1)


def transfer(pieces: Pieces, text: str, left: int, right: int, begin: list, end: list) -> np.ndarray:
    """Scores from each state at ``left`` to each at ``right``: 0 or minus infinity for this kind of model."""
    first, last = _enter(begin, pieces, text, left, right)
    rows = {s: np.where(np.arange(len(begin)) == i, 0.0, NEVER) for i, s in enumerate(begin)}
    if first < 0:
        done, _ = paths(pieces, text, rows, right)
        return np.stack([done.get(s, np.full(len(begin), NEVER)) for s in end], axis=1)
    into = [np.full(len(begin), NEVER)]
    into += [v for s, v in paths(pieces, text, rows, first)[0].items() if s[1] == first]
    enter = np.max(into, axis=0)  # all paths meet at the word's start
    done, _ = paths(pieces, text, {(last, last): np.zeros(1)}, right)
    leave = np.array([done[s][0] if s in done else NEVER for s in end])
    return enter[:, None] + leave[None, :]


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return np.max(a[:, :, None] + b[None, :, :], axis=1)


def best_states(matrices: list[np.ndarray]) -> list[int]:
    """Which state the best path passes at each inner boundary."""
    ahead = [matrices[0]]
    for m in matrices[1:-1]:
        ahead.append(compose(ahead[-1], m))
    picked, column = [], 0
    for before, m in zip(reversed(ahead), reversed(matrices[1:]), strict=True):
        column = int(np.argmax(before[0] + m[:, column]))
        picked.append(column)
    return picked[::-1]


def trace(pieces: Pieces, text: str, left: int, right: int, begin: tuple[int, int], end: tuple[int, int]) -> list[int]:
    """Ids of the pieces after state ``begin`` up to and with state ``end``."""
    def walk(start: tuple[int, int], to: int, state: tuple[int, int]) -> list[int]:
        _, back = paths(pieces, text, {start: np.zeros(1)}, to)
        out: list[int] = []
        while state != start:
            out[:0] = pieces.encode(text[state[0] : state[1]])
            state = back[state]
        return out

    first, last = _enter([begin], pieces, text, left, right)
    if first < 0:
        return walk(begin, right, end)
    head: list[int] = []
    if begin[1] < first:
        done, _ = paths(pieces, text, {begin: np.zeros(1)}, first)
        head = walk(begin, first, next(s for s in done if s[1] == first))
    return head + pieces.part.encode(text[first:last]) + walk((last, last), right, end)


def _chunks(shared):
    """Chunks of giant texts with the context that their boundary states need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        margin = 2 * pieces.longest
        for batch in batches:
            for r1, r2, text in zip(batch.column("_r1").to_pylist(), batch.column("_r2").to_pylist(), batch.column("text"), strict=True):
                text = pieces.normal(text.as_py())
                count = -(-len(text) // CHUNK)
                for at in range(0, count, 64):
                    some = range(at, min(at + 64, count))
                    low = [max(0, i * CHUNK - margin) for i in some]
                    high = [min(len(text), (i + 1) * CHUNK + margin) for i in some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([r1] * len(low), pa.int64()), pa.array([r2] * len(low), pa.int64()), pa.array(list(some), pa.int32()), pa.array([count] * len(low), pa.int32()),
                            pa.array([i * CHUNK - a for i, a in zip(some, low, strict=True)], pa.int32()),
                            pa.array([min(len(text), (i + 1) * CHUNK) - a for i, a in zip(some, low, strict=True)], pa.int32()),
                            pa.array([text[a:b] for a, b in zip(low, high, strict=True)], pa.string()),
                        ],
                        names=["_r1", "_r2", "chunk", "chunks", "left", "right", "part"],
                    )

    return run


def _ends(pieces: Pieces, chunk: int, chunks: int, left: int, right: int, text: str) -> tuple[list, list]:
    """The boundary states of a chunk: the document's own ends have one each."""
    begin = [(0, 0)] if chunk == 0 else pieces.states(text, left)
    end = [s for s in pieces.states(text, right) if s[1] == right] if chunk == chunks - 1 else pieces.states(text, right)
    return begin, end


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small parts of batches: as Python objects, texts and ids take several times their room."""
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(at, AT_ONCE)


def _matrices(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        for batch in slices(batches):
            out = []
            for _, _, chunk, chunks, left, right, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                begin, end = _ends(pieces, chunk, chunks, left, right, text)
                m = transfer(pieces, text, left, right, begin, end)
                if chunk == chunks - 1:  # any piece may be the last
                    m = m.max(axis=1, keepdims=True)
                out.append((m.shape[0], m.astype(np.float32).tobytes()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.binary())], names=[*batch.schema.names[:4], "rows", "matrix"])

    return run


def _combine(key: tuple, table: pa.Table) -> pa.Table:
    """One document's matrices, a few hundred bytes a chunk -> the state at each chunk's two ends."""
    rows = sorted(set(zip(*(table.column(c).to_pylist() for c in ("chunk", "rows", "matrix")), strict=True)))
    matrices = [np.frombuffer(m, dtype=np.float32).reshape(n, -1) for _, n, m in rows]
    inner = best_states(matrices) if len(matrices) > 1 else []
    n = len(matrices)
    return pa.table({"_r1": pa.array([key[0].as_py()] * n, pa.int64()), "_r2": pa.array([key[1].as_py()] * n, pa.int64()), "chunk": pa.array(range(n), pa.int32()), "enters": pa.array([0, *inner], pa.int32()), "leaves": pa.array([*inner, -1], pa.int32())})


def _trace(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        for batch in slices(batches):
            out = []
            for _, _, chunk, chunks, left, right, text, enters, leaves in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                begin, end = _ends(pieces, chunk, chunks, left, right, text)
                start = begin[enters]
                if leaves < 0:
                    m = transfer(pieces, text, left, right, [start], end)
                    leaves = int(np.argmax(m[0]))
                out.append(trace(pieces, text, left, right, start, end[leaves]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.list_(pa.int32()))], names=["_r1", "_r2", "chunk", "ids"])

    return run


def _encode(shared, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        for part in slices(batches):
            texts = [t or "" for t in part.column("row").field("text").cast(pa.string()).to_pylist()]
            found = part.column("found")
            edges, flat = found.offsets.to_numpy(), found.values.to_numpy(zero_copy_only=False)
            given = found.is_valid().to_numpy(zero_copy_only=False).tolist()
            ids, same = [], []
            for i, text in enumerate(texts):  # one text's ids are Python objects at a time
                own = flat[edges[i] : edges[i + 1]].tolist() if given[i] else pieces.whole.encode(text)
                ids.append(np.array(own, dtype=np.int32))
                same.append(not check or (pieces.whole.decode(own) if own else "") == text)
            columns = [part.column("row"), pa.array(ids, pa.list_(pa.int32())), part.column("parts"), *([pa.array(same)] if check else [])]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "ids", "n_chunks", *(["round_trip"] if check else [])])

    return run


def encode(docs: DataFrame, model: str = MODEL, giant: int = GIANT, check: bool = False) -> DataFrame:
    """The input's rows with ids (array<int>) and n_chunks, how many parts the text was encoded in.

    With ``check`` also round_trip: do the ids decode to the text again (to an empty one, for null)?
    It saves a second pass through Python, which ``decode`` would be.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(model, "rb") as f:  # the driver's copy goes to all tasks: half a megabyte, whatever the input
        shared = spark.sparkContext.broadcast(f.read())
    new = ["ids", "n_chunks", *(["round_trip"] if check else [])]
    keep = [c for c in docs.columns if c not in new]
    text = F.col("text").cast("string")
    rows = docs.select(F.struct(*keep).alias("row"), text.alias("text"), *(c.alias(k) for k, c in zip(("_r1", "_r2"), row_identity(F.col("doc_id").cast("long"), text), strict=True)))
    is_giant = F.coalesce(F.char_length("text") > giant, F.lit(False))
    chunks = rows.where(is_giant).select("_r1", "_r2", "text").mapInArrow(_chunks(shared), "_r1 long, _r2 long, chunk int, chunks int, left int, right int, part string")
    chunks = materialize(chunks.dropDuplicates(["_r1", "_r2", "chunk"]))
    matrices = chunks.mapInArrow(_matrices(shared), "_r1 long, _r2 long, chunk int, chunks int, rows int, matrix binary")
    states = matrices.groupBy("_r1", "_r2").applyInArrow(_combine, "_r1 long, _r2 long, chunk int, enters int, leaves int")
    traced = chunks.join(states, ["_r1", "_r2", "chunk"]).select("_r1", "_r2", "chunk", "chunks", "left", "right", "part", "enters", "leaves")
    traced = traced.mapInArrow(_trace(shared), "_r1 long, _r2 long, chunk int, ids array<int>")
    whole = traced.groupBy("_r1", "_r2").agg(F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("p"))
    whole = materialize(whole.select("_r1", "_r2", F.flatten(F.col("p.ids")).alias("found"), F.size("p").alias("parts")))
    big = rows.where(is_giant).join(whole, ["_r1", "_r2"]).select("row", "found", "parts")
    small = rows.where(~is_giant).select("row", F.lit(None).cast("array<int>").alias("found"), F.lit(1).alias("parts"))
    schema = rows.select("row").withColumns({"ids": F.array().cast("array<int>"), "n_chunks": F.lit(1)} | ({"round_trip": F.lit(True)} if check else {})).schema
    return small.union(big).mapInArrow(_encode(shared, check), schema).select("row.*", *new)


def _decode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        for part in slices(batches):
            texts = [pieces.whole.decode(x.as_py()) if x.is_valid and len(x) else "" for x in part.column("ids")]
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(texts, pa.string())], names=["row", "decoded"])

    return run


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """The input's rows with decoded, the text of their ids."""
    spark = encoded.sparkSession
    ship(spark)
    with open(model, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    rows = encoded.select(F.struct(*[c for c in encoded.columns if c != "decoded"]).alias("row"), "ids")
    return rows.mapInArrow(_decode(shared), rows.select("row").withColumn("decoded", F.lit("")).schema).select("row.*", "decoded")
