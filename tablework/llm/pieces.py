"""SentencePiece encoding and decoding: batched Viterbi over the pieces of a given model."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tablework.llm.text import mix64, packed, powers, slices

#: A model file of the public tokenizers; any SentencePiece model with byte pieces will do.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"

# The visible space of SentencePiece, and a code that stands for it where a text itself has it.
_BLANK, _OWN_BLANK = 0x2581, 0x110001
# Penalty of an unknown character below the worst piece, as in SentencePiece.
_UNKNOWN = 10.0
_SALT = np.uint64(0x6C62272E07BB0142)
_SLICE = 512 << 10
#: Look-ups of pieces that are held at once, for words of one length.
_LOOKUPS = 1 << 18


@dataclass
class PieceModel:
    """Pieces by hash. ``keys`` is sorted; ``ids`` and ``scores`` belong to it. ``lengths``: the
    lengths of pieces that occur. ``by_byte``: the id of each byte piece. ``data`` and
    ``offsets``: the bytes that each id decodes to. ``splits``: no piece has a blank behind
    another character, so words can be cut apart."""

    keys: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    lengths: list[int]
    by_byte: np.ndarray
    unknown_score: float
    data: np.ndarray
    offsets: np.ndarray
    splits: bool


def _sums(codes: np.ndarray) -> np.ndarray:
    up, _ = powers(codes.shape[1] + 1)
    sums = np.zeros((codes.shape[0], codes.shape[1] + 1), dtype=np.uint64)
    np.cumsum(mix64(codes.astype(np.uint64) + _SALT) * up[: codes.shape[1]], axis=1, out=sums[:, 1:])
    return sums


def read_model(path: str = MODEL_FILE) -> PieceModel:
    """The pieces and scores of a SentencePiece model file, read by the driver.

    The file's own scores are summed, whatever kind of model it is: for a BPE file they are
    negative merge ranks, and the result is the segmentation of the best sum of ranks, not
    that of the merges.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    keys, ids, scores, lengths, out = [], [], [], set(), []
    by_byte, splits = np.full(256, -1, dtype=np.int64), True
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            by_byte[int(piece[3:5], 16)] = i
            out.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unused(i):
            out.append(b"")
        elif model.is_unknown(i):
            out.append(" ⁇ ".encode())
        else:
            codes = np.frombuffer(piece.encode("utf-32-le"), np.uint32)[None, :]
            keys.append(mix64(_sums(codes)[:, -1] + np.uint64(len(piece)))[0])
            ids.append(i)
            scores.append(model.get_score(i))
            lengths.add(len(piece))
            splits &= chr(_BLANK) not in piece.lstrip(chr(_BLANK))
            out.append(piece.replace(chr(_BLANK), " ").encode())
    if (by_byte < 0).any():
        raise ValueError(f"{path} has no byte pieces, so not every text could be restored")
    keys, ids, scores = np.array(keys, dtype=np.uint64), np.array(ids), np.array(scores)
    order = np.argsort(keys)
    return PieceModel(
        keys[order], ids[order], scores[order], sorted(lengths), by_byte, scores.min() - _UNKNOWN,
        np.frombuffer(b"".join(out), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in out])]), splits,
    )


def _viterbi(model: PieceModel, codes: np.ndarray) -> np.ndarray:
    """(words, length) tokens of words of one length, right-aligned: the place in the piece
    table, or -1 - code for a character that no piece covers; elsewhere the smallest number.

    All words advance together. Of equal sums the one with the longest last piece wins.
    """
    n, size = codes.shape
    sums, (_, down) = _sums(codes), powers(size + 1)
    best = np.full((size + 1, n), -np.inf)
    best[0] = 0
    back, token = np.zeros((size + 1, n), dtype=np.int32), np.zeros((size + 1, n), dtype=np.int64)
    lengths = np.array(model.lengths[::-1])
    # the pieces that end at a run of places are looked up together, then sums advance place by place
    step, rows = max(1, _LOOKUPS // (n * len(lengths))), np.arange(n)
    for first in range(1, size + 1, step):
        ends = np.arange(first, min(first + step, size + 1))
        score = np.full((len(lengths), len(ends), n), -np.inf)
        at = np.zeros(score.shape, dtype=np.int32)
        for k, length in enumerate(lengths):
            can = ends >= length
            if can.any():
                last = ends[can]
                key = mix64((sums[:, last] - sums[:, last - length]) * down[last - length] + np.uint64(length)).T
                found = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
                at[k, can] = found
                score[k, can] = np.where(model.keys[found] == key, model.scores[found], -np.inf)
        for i, end in enumerate(ends):
            # the longest piece comes first and wins among equals; places before the word have no score
            sums_here = best[np.maximum(end - lengths, 0)] + score[:, i]
            k = sums_here.argmax(axis=0)
            top = sums_here[k, rows]
            lone = best[end - 1] + model.unknown_score
            known = top >= lone
            best[end] = np.where(known, top, lone)
            back[end] = np.where(known, end - lengths[k], end - 1)
            token[end] = np.where(known, at[k, i, rows], -1 - codes[:, end - 1].astype(np.int64))
    out = np.full((n, size), np.iinfo(np.int64).min)
    place, step = np.full(n, size), size - 1
    while len(rows):
        out[rows, step] = token[place, rows]
        place = back[place, rows]
        rows, place = rows[place > 0], place[place > 0]
        step -= 1
    return out


def encode_texts(model: PieceModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of the pieces of each text. A null text has none, nor has an empty one."""
    data, offsets = packed(texts)
    if not len(data):
        return np.zeros(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).copy()
    codes[codes == _BLANK] = _OWN_BLANK
    codes[codes == 32] = _BLANK
    # a blank before each text that has any characters
    full = np.flatnonzero(np.diff(before))
    codes = np.insert(codes, before[full], _BLANK)
    heads = before[full] + np.arange(len(full))
    if model.splits:
        blank = codes == _BLANK
        cut = blank.copy()
        cut[1:] &= ~blank[:-1]
        cut[heads] = True
        starts = np.flatnonzero(cut)
    else:
        starts = heads
    ends = np.append(starts[1:], len(codes))
    text_first = np.searchsorted(starts, heads)
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(mix64(codes.astype(np.uint64) + _SALT) * up[: len(codes)], out=sums[1:])
    words = mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    del sums
    _, first, word = np.unique(words, return_index=True, return_inverse=True)
    starts, lengths = starts[first], (ends - starts)[first]
    counts = np.zeros(len(first), dtype=np.int64)
    parts = []
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        most = max(1, (1 << 18) // int(length))
        for i in range(0, len(rows), most):
            some = rows[i : i + most]
            found = _viterbi(model, codes[starts[some][:, None] + np.arange(length)])
            real = found > np.iinfo(np.int64).min
            counts[some] = real.sum(axis=1)
            parts.append((some, found[real]))
    begin = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.empty(begin[-1], dtype=np.int64)
    for some, found in parts:
        n = counts[some]
        tokens[np.repeat(begin[some] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())] = found
    # the words of all texts, in order
    n = counts[word]
    ends = np.cumsum(n)
    tokens = tokens[np.repeat(begin[word] - (ends - n), n) + np.arange(ends[-1])]
    text_start = (ends - n)[text_first]
    # characters without a piece become the pieces of their bytes
    lone = np.flatnonzero(tokens < 0)
    ids = model.ids[np.maximum(tokens, 0)]
    size = np.zeros(len(texts), dtype=np.int64)
    size[full] = np.diff(np.append(text_start, len(tokens)))
    if len(lone):
        kinds, kind = np.unique(tokens[lone], return_inverse=True)
        spelt = [chr(_BLANK if -1 - k == _OWN_BLANK else -1 - k).encode() for k in kinds.tolist()]
        width = np.ones(len(tokens), dtype=np.int64)
        width[lone] = np.array([len(x) for x in spelt])[kind]
        places = np.concatenate([[0], np.cumsum(width)])
        longer = np.repeat(ids, width)
        flat = model.by_byte[np.frombuffer(b"".join(spelt), np.uint8)]
        at = np.concatenate([[0], np.cumsum([len(x) for x in spelt])])[:-1][kind]
        w = width[lone]
        inner = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        longer[np.repeat(places[lone], w) + inner] = flat[np.repeat(at, w) + inner]
        bounds = places[np.append(text_start, len(tokens))]
        size[full] = np.diff(bounds)
        ids = longer
    return ids.astype(np.int32), np.concatenate([[0], np.cumsum(size)])


def decode_pieces(model: PieceModel, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The texts of lists of ids: what the pieces stand for, without the first blank."""
    width = np.diff(model.offsets)[ids]
    ends = np.cumsum(width)
    total = int(ends[-1]) if len(ends) else 0
    data = model.data[np.repeat(model.offsets[ids] - (ends - width), width) + np.arange(total)]
    at = np.concatenate([[0], ends])[offsets]
    heads = at[:-1][np.diff(at) > 0]
    heads = heads[data[heads] == 32]
    keep = np.ones(len(data), dtype=bool)
    keep[heads] = False
    at = at - np.searchsorted(heads, at)
    return pa.Array.from_buffers(
        pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data[keep])]
    ).cast(pa.string())


def tokenize(docs: DataFrame, model: PieceModel, text: str = "text") -> DataFrame:
    """``docs`` with pieces (ids), n_pieces and decoded, the text that the ids give back.

    A blank goes before every text, blanks are visible spaces, no other normalisation.
    Words begin at blanks; each distinct word of a batch is segmented once, into the pieces
    with the highest sum of scores. A character without a piece, and a visible space that
    the text itself has, become byte pieces, so every text is restored exactly. Null: null,
    0, null; empty: no pieces. Columns of these names are replaced. One pass, no shuffle.
    """
    added = StructType(
        [
            StructField("pieces", ArrayType(IntegerType())),
            StructField("n_pieces", LongType()),
            StructField("decoded", StringType()),
        ]
    )
    docs = docs.drop(*added.names)
    own = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text, _SLICE):
                texts = batch.column(text)
                ids, offsets = encode_texts(shared.value, texts)
                null = texts.is_null()
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()), mask=null if texts.null_count else None
                )
                decoded = decode_pieces(shared.value, ids, offsets)
                if texts.null_count:
                    decoded = pc.if_else(null, pa.scalar(None, pa.string()), decoded)
                columns = [batch.column(c) for c in own]
                columns += [lists, pa.array(np.diff(offsets)), decoded]
                yield pa.RecordBatch.from_arrays(columns, names=[*own, *added.names])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *added.fields]))
