"""SentencePiece encoding and decoding with a unigram model.

Pieces with log scores stand in a double-array trie over their bytes. A text is cut where a run of
whitespace markers begins, since no piece goes on past a marker; equal cuts are encoded once per
task. Viterbi takes the cuts of a whole batch together: the trie is walked from all positions at
once, which gives the lattice edges, and best scores run forward over them position by position.
Characters without a piece are encoded as their bytes.

The vocabulary file is read on the driver by its public library; encoding does not use it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from parcelmart.llm.common import mapped

MARKER = "▁"
UNKNOWN_TEXT = " ⁇ "
CACHED = 150_000  # cuts a worker keeps; beyond it starts anew
CACHED_CHARACTERS = 1 << 24  # and characters of them, as texts without blanks are cuts as long as they are
CHARACTERS = 1 << 18  # about so many characters are encoded at a time

_CUTS = re.compile(" +[^ ]+| +$")


@dataclass
class Pieces:
    """A vocabulary as arrays: the trie over piece bytes (a transition by byte b goes from state s to
    base[s] + b + 1, which is right if its check is s), the piece and score that end at a state, and
    the bytes that each id decodes to."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    scores: np.ndarray
    unknown_score: float
    unknown_id: int
    byte_ids: np.ndarray | None
    out: np.ndarray
    out_start: np.ndarray
    dummy_prefix: bool


def build_trie(keys: list[bytes], ids: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Double-array trie of distinct non-empty keys."""
    children: list[dict[int, int]] = [{}]
    ending = [-1]
    for key, number in zip(keys, ids, strict=True):
        node = 0
        for b in key:
            if b not in children[node]:
                children[node][b] = len(children)
                children.append({})
                ending.append(-1)
            node = children[node][b]
        ending[node] = number
    size = 2 * len(children) + 1024
    base, check, piece = [0] * size, [-1] * size, [-1] * size
    check[0] = 0
    low = 512  # where the search for free states begins
    todo = [(0, 0)]
    while todo:
        node, state = todo.pop()
        piece[state] = ending[node]
        codes = sorted(b + 1 for b in children[node])
        if not codes:
            continue
        at, taken = low, 0
        while check[at] >= 0 or any(check[at - codes[0] + c] >= 0 for c in codes[1:]):
            taken += check[at] >= 0
            at += 1
            if at + 512 > len(check):
                base += [0] * len(base)
                piece += [-1] * len(piece)
                check += [-1] * len(check)
        if taken >= 0.9 * (at - low + 1):
            low = at  # what lies before is nearly full
        base[state] = at - codes[0]
        for c in codes:
            check[base[state] + c] = state
            todo.append((children[node][c - 1], base[state] + c))
    return np.array(base, np.int32), np.array(check, np.int32), np.array(piece, np.int32)


def load_pieces(path: str) -> Pieces:
    """The vocabulary of a model file. A unigram model's scores are taken as they are. Other kinds
    score a piece by its rank only; there the log score is that of Zipf's law, -log(rank * H)."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(path, "rb") as file:
        model = proto.ModelProto.FromString(file.read())
    spec, kinds = model.normalizer_spec, proto.ModelProto.SentencePiece.Type
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError("only models that leave texts as they are can be used")
    if any(MARKER in p.piece.lstrip(MARKER) for p in model.pieces):
        raise ValueError("a piece goes on past a whitespace marker")
    normal = [k for k, p in enumerate(model.pieces) if p.type == kinds.NORMAL]
    scores = np.zeros(len(model.pieces))
    if model.trainer_spec.model_type == proto.TrainerSpec.UNIGRAM:
        scores[:] = [p.score for p in model.pieces]
    else:
        ranked = sorted(normal, key=lambda k: (-model.pieces[k].score, k))
        ranks = np.arange(1, len(ranked) + 1)
        scores[ranked] = -np.log(ranks * (1 / ranks).sum())
    user = [k for k, p in enumerate(model.pieces) if p.type == kinds.USER_DEFINED]
    for k in user:  # they win over any split
        scores[k] = len(model.pieces[k].piece) * max(scores[normal], default=0.0) - 0.1
    keys = [model.pieces[k].piece.encode() for k in normal + user]
    base, check, piece = build_trie(keys, normal + user)
    unknown = next(k for k, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
    byte_ids = None
    decoded = []
    for k, p in enumerate(model.pieces):
        if p.type == kinds.BYTE:
            byte_ids = np.full(256, unknown, np.int32) if byte_ids is None else byte_ids
            byte_ids[int(p.piece[3:5], 16)] = k
            decoded.append(bytes([int(p.piece[3:5], 16)]))
        elif p.type == kinds.CONTROL:
            decoded.append(b"")
        elif p.type == kinds.UNKNOWN:
            decoded.append(UNKNOWN_TEXT.encode())
        else:
            decoded.append(p.piece.replace(MARKER, " ").encode())
    return Pieces(
        base,
        check,
        piece,
        scores,
        float(min(scores[normal], default=0.0)) - 10,
        unknown,
        byte_ids,
        np.frombuffer(b"".join(decoded), np.uint8),
        np.concatenate([[0], np.cumsum([len(x) for x in decoded])]),
        spec.add_dummy_prefix,
    )


def _edges(p: Pieces, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, piece) of every piece found in the bytes, not past the end of its cut."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    state, here = np.zeros(len(starts), np.int32), starts
    limit = ends[starts]
    found = [], [], []
    while len(starts):
        step = p.base[state] + data[here] + np.int32(1)
        good = p.check[step] == state
        starts, here, limit, state = starts[good], here[good] + 1, limit[good], step[good]
        piece = p.piece[state]
        hit = piece >= 0
        for out, x in zip(found, (starts, here, piece), strict=True):
            out.append(x[hit])
        inside = here < limit
        starts, here, limit, state = starts[inside], here[inside], limit[inside], state[inside]
    return tuple(np.concatenate(x) for x in found)


def viterbi(p: Pieces, cuts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds): the best segmentation of each cut. Of equal scores the longer piece wins."""
    lengths = np.array([len(c) for c in cuts], np.int64)
    first = np.concatenate([[0], np.cumsum(lengths)])
    data = np.frombuffer(b"".join(cuts), np.uint8)
    cut_of = np.repeat(np.arange(len(cuts)), lengths)
    start, end, piece = _edges(p, data, first[1:][cut_of])
    gain = p.scores[piece]
    # a character that is no piece by itself gets an edge of its own
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    tails = np.append(heads[1:], len(data))
    alone = np.zeros(len(data) + 1, bool)
    single = np.zeros(len(data) + 1, np.int64)
    single[heads] = tails
    alone[start[single[start] == end]] = True
    lone = ~alone[heads]
    start, end = np.concatenate([start, heads[lone]]), np.concatenate([end, tails[lone]])
    piece = np.concatenate([piece, np.full(lone.sum(), -1, np.int32)])
    gain = np.concatenate([gain, np.full(lone.sum(), p.unknown_score)])
    # nodes: the positions of a cut and its end
    node = start + cut_of[start]
    target = end + cut_of[start]
    local = start - first[:-1][cut_of[start]]
    order = np.argsort(local.astype(np.uint16) if len(local) and local.max() < 1 << 16 else local, kind="stable")
    node, target, piece, gain, local = node[order], target[order], piece[order], gain[order], local[order]
    best = np.full(len(data) + len(cuts), -np.inf)
    best[first[:-1] + np.arange(len(cuts))] = 0
    back, used = np.zeros(len(best), np.int64), np.full(len(best), -1, np.int32)
    bounds = np.flatnonzero(np.concatenate([[True], local[1:] != local[:-1], [True]])) if len(local) else []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):  # from one position a cut's edges end apart
        score = best[node[a:b]] + gain[a:b]
        better = score > best[target[a:b]]
        to = target[a:b][better]
        best[to], back[to], used[to] = score[better], node[a:b][better], piece[a:b][better]
    # back from the ends
    at = first[1:] + np.arange(len(cuts))
    head = first[:-1] + np.arange(len(cuts))
    alive = np.flatnonzero(at > head)
    owners, pieces, spans = [], [], []
    while len(alive):
        now = at[alive]
        owners.append(alive)
        pieces.append(used[now])
        spans.append(np.stack([back[now] - alive, now - alive]))
        at[alive] = back[now]
        alive = alive[at[alive] > head[alive]]
    if not owners:
        return np.empty(0, np.int32), np.zeros(len(cuts) + 1, np.int64)
    owner, ids, span = np.concatenate(owners)[::-1], np.concatenate(pieces)[::-1], np.concatenate(spans, 1)[:, ::-1]
    order = np.argsort(owner, kind="stable")
    owner, ids, span = owner[order], ids[order], span[:, order]
    if p.byte_ids is None:
        ids = np.where(ids < 0, np.int32(p.unknown_id), ids)
    else:
        width = np.where(ids < 0, span[1] - span[0], 1)
        offset = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        spread = np.repeat(ids, width)
        ids = np.where(spread < 0, p.byte_ids[data[np.repeat(span[0], width) + offset]], spread)
        owner = np.repeat(owner, width)
    return ids.astype(np.int32), np.searchsorted(owner, np.arange(len(cuts) + 1))


def _ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of runs of the given lengths, one run after the other."""
    total = int(length.sum())
    return np.arange(total) + np.repeat(start - (np.cumsum(length) - length), length)


class Encoder:
    """Encodes texts; keeps the ids of the cuts it has met."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.ids, self.bounds = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _cuts(self, text: str) -> list[str]:
        if not text:
            return []
        text = text.replace(MARKER, " ")
        if not self.pieces.dummy_prefix and text[0] != " ":
            # the first cut has no marker; a lone surrogate, which no text holds, tells it from others
            head, _, rest = text.partition(" ")
            return ["\ud800" + head, *([] if len(head) == len(text) else self._cuts(" " + rest))]
        if self.pieces.dummy_prefix:
            text = " " + text
        if "  " in text or text[-1] == " ":
            return [c[1:] for c in _CUTS.findall(text)]
        return text[1:].split(" ")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of the texts."""
        cuts = [self._cuts(t) for t in texts]
        if len(self.known) > CACHED or self.held > CACHED_CHARACTERS:
            self._clear()
        fresh = list(dict.fromkeys(c for c in chain.from_iterable(cuts) if c not in self.known))
        if fresh:
            made, bounds = viterbi(self.pieces, [c[1:].encode() if c[:1] == "\ud800" else (MARKER + c.replace(" ", MARKER)).encode() for c in fresh])
            n = len(self.known)
            self.held += sum(map(len, fresh))
            self.known.update(zip(fresh, range(n, n + len(fresh)), strict=True))
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + bounds[1:]])
            self.ids = np.concatenate([self.ids, made])
        number = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cuts)), np.int64, sum(map(len, cuts)))
        length = self.bounds[number + 1] - self.bounds[number]
        ends = np.concatenate([[0], np.cumsum(length)])
        texts_end = np.concatenate([[0], np.cumsum([len(own) for own in cuts])]).astype(np.int64)
        return self.ids[_ragged(self.bounds[number], length)], ends[texts_end]


def decode(p: Pieces, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Texts of id runs. Bytes that are no UTF-8 become U+FFFD; unknown ids become the mark for them."""
    ids = np.where((ids < 0) | (ids >= len(p.out_start) - 1), p.unknown_id, ids)
    length = p.out_start[ids + 1] - p.out_start[ids]
    data = p.out[_ragged(p.out_start[ids], length)].tobytes()
    ends = np.concatenate([[0], np.cumsum(length)])[bounds].tolist()
    out = []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        if p.dummy_prefix and data[a : a + 1] == b" ":
            a += 1
        out.append(data[a:b].decode("utf-8", "replace"))
    return out


def _slices(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    texts, first, size = [], 0, 0
    for k in range(len(column)):
        texts.append(column[k].as_py() or "")
        size += len(texts[-1])
        if size >= CHARACTERS:
            yield first, texts
            texts, first, size = [], k + 1, 0
    if texts:
        yield first, texts


_ENCODERS: dict[str, Encoder] = {}  # by call: a worker keeps its cuts from task to task


def _encode(model, key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _ENCODERS:
            _ENCODERS.clear()
            pa.default_memory_pool().release_unused()  # a worker may come from an earlier step
            _ENCODERS[key] = Encoder(model.value)
        encoder = _ENCODERS[key]
        for batch in batches:
            for first, texts in _slices(batch.column(batch.num_columns - 1)):
                ids, bounds = encoder.encode(texts)
                same = [a == b for a, b in zip(texts, decode(model.value, ids, bounds), strict=True)]
                kept = batch.slice(first, len(texts))
                yield pa.record_batch(
                    [*kept.columns[:-1], pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)), pa.array(same)],
                    names=[*batch.schema.names[:-1], "ids", "round_trip"],
                )

    return encode_batches


def encode_texts(docs: DataFrame, keep: list[str], model: str = "/opt/tokenizers/piece_bpe_32k.model", text: str = "text") -> DataFrame:
    """The ``keep`` columns of every row, ids (array of int) and round_trip: whether decoding gives
    the text back, which it does unless the text holds a whitespace marker itself.

    Null and empty texts have no ids. Repeated rows are encoded alike; every row gives one row.
    Columns beyond ``keep`` may have any name; an empty table gives no rows. The model file is
    read on the driver and sent to the tasks; its size does not depend on the data.
    """
    sent = docs.sparkSession.sparkContext.broadcast(load_pieces(model))
    rows = docs.select(*keep, F.col(text).cast("string").alias("encoded_text"))
    schema = StructType([*rows.schema[:-1], StructField("ids", ArrayType(IntegerType())), StructField("round_trip", BooleanType())])
    return mapped(rows, _encode(sent, uuid.uuid4().hex), schema)


def _decode(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.num_columns - 1)
            for first in range(0, batch.num_rows, 256):
                part = ids.slice(first, 256)
                length = np.array([len(x) if x.is_valid else 0 for x in part], np.int64)
                bounds = np.concatenate([[0], np.cumsum(length)])
                flat = part.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                texts = pa.array(decode(model.value, flat, bounds), pa.string())
                yield pa.record_batch([*batch.slice(first, 256).columns[:-1], texts], names=[*batch.schema.names[:-1], "text"])

    return decode_batches


def decode_ids(rows: DataFrame, keep: list[str], model: str = "/opt/tokenizers/piece_bpe_32k.model", ids: str = "ids") -> DataFrame:
    """The ``keep`` columns of every row and the text of its ids; null and empty arrays give an empty
    text, null ids and ids beyond the vocabulary the mark for unknown pieces."""
    sent = rows.sparkSession.sparkContext.broadcast(load_pieces(model))
    taken = rows.select(*keep, F.col(ids).cast("array<int>").alias("decoded_ids"))
    schema = StructType([*taken.schema[:-1], StructField("text", StringType())])
    return mapped(taken, _decode(sent), schema)
