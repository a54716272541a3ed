"""Sampled SentencePiece segmentations, reproducible by row key, and lossless decoding.

The lattice of a text has an arc for every vocabulary piece found in it. Forward filtering sums the weights of all paths to each
node; backward sampling draws the arcs from the end with chances in proportion to filtered weight times arc weight, so each segmentation
comes with the probability that the unigram model gives it, raised to ``alpha`` and normalised. Random numbers are a hash of seed, row key,
chunk and step: they do not depend on partitions, batches or retries.

No piece has a blank sign after another character (checked on loading), so a lattice falls apart before each run of blanks. Each distinct chunk
of a batch is filtered once; all its occurrences are drawn together, step by step. Lattices are built for groups of chunks of about ``NODES``
characters, so that memory does not grow with a text. A chunk longer than that is filtered window by window, keeping only the sums at the windows' starts;
drawing goes back through the windows, building each once more. Longer texts are cut into pieces between chunks.

The model file stores merge ranks, not probabilities. A piece of rank r gets the weight 1 / (r + RANK_SHIFT), the usual law of
word frequencies. A character without a piece of its own is spelled in byte pieces, at a weight below all others.

Encoding puts one blank sign before a text and writes each space as one; a blank sign that the text itself holds is spelled in bytes.
Decoding undoes it, so that every text comes back byte for byte. Null and empty texts have no pieces and decode to the empty text. Repeated
rows with the same key get the same pieces. Texts are encoded whole. Other columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import PIECE_BYTES, U, mix, pieces, powers, text_of, utf8

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
SEED = 7
RANK_SHIFT = 10.0
SPELLED = 1e-3  # weight of a spelled character, as a part of the smallest piece's

BLANK_SIGN = 0x2581
OWN_SIGN = 0x110000  # stands for a blank sign of the text itself; above all code points
CELL_BITS, BEGIN_BITS = 20, 22
NODES = 1 << 16  # of lattices held at once
WINDOW = 1 << 13  # nodes of a longer chunk
LENGTH_SALT = 0xA24BAED4963EE407
STRIDE, MASK = 0xD1B54A32D192ED03, (1 << 64) - 1


def _cells(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash's cell in each of the two tables."""
    return keys >> U(64 - CELL_BITS), (keys >> U(64 - 2 * CELL_BITS)) & U((1 << CELL_BITS) - 1)


@dataclass
class Vocabulary:
    """table: piece id by hash cell (two tables, -1 where empty; the second for those whose cell in the first is taken); begins: cells of
    all beginnings of pieces; keys: hashes of pieces; weights: by id; spelled: weight of a spelled character; length: of the longest
    piece; byte_ids: by byte; data, at: what each piece decodes to."""

    table: np.ndarray
    begins: np.ndarray
    keys: np.ndarray
    weights: np.ndarray
    spelled: float
    length: int
    byte_ids: np.ndarray
    data: np.ndarray
    at: np.ndarray


def _hash(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of successive strings of code points."""
    at = np.concatenate([[0], np.cumsum(lengths)])
    position = np.arange(at[-1]) - np.repeat(at[:-1], lengths)
    summed = np.concatenate([[U(0)], np.cumsum(mix(codes) * powers(int(lengths.max(initial=1)))[position])])
    return mix(summed[at[1:]] - summed[at[:-1]] + lengths.astype(U))


def load(path: str = MODEL_FILE, alpha: float = ALPHA) -> Vocabulary:
    """Read a model on the driver; its vocabulary (some 32,000 pieces) is what the tasks get."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    usable = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    names = {i: sp.id_to_piece(i) for i in usable}
    if any(chr(BLANK_SIGN) in name.lstrip(chr(BLANK_SIGN)) for name in names.values()):
        raise ValueError("a piece has a blank sign after another character")
    byte_ids = np.zeros(256, np.int32)
    for i in range(n):
        if sp.is_byte(i):
            byte_ids[int(sp.id_to_piece(i)[1:-1], 16)] = i
    keys, begins = np.zeros(n, U), np.zeros(1 << BEGIN_BITS, bool)
    lengths = np.array([len(names[i]) for i in usable])
    letters = mix(np.array([ord(c) for i in usable for c in names[i]], U))
    growing, at = np.zeros(len(usable), U), np.concatenate([[0], np.cumsum(lengths)])[:-1]
    power = powers(int(lengths.max()))
    for k in range(int(lengths.max())):
        on = np.flatnonzero(lengths > k)
        growing[on] += letters[at[on] + k] * power[k]
        begins[growing[on] >> U(64 - BEGIN_BITS)] = True
    keys[usable] = growing + lengths.astype(U) * U(LENGTH_SALT)
    table = np.full((2, 1 << CELL_BITS), -1, np.int32)
    for i in usable:
        cells = [int(c) for c in _cells(keys[i])]
        free = next((t for t in (0, 1) if table[t, cells[t]] < 0), None)
        if free is None:
            raise ValueError("two pieces share both their cells")
        table[free, cells[free]] = i
    weight = np.zeros(n)
    ranks = np.array([-sp.get_score(i) for i in usable])
    weight[usable] = -np.log(ranks - ranks.min() + RANK_SHIFT)
    weight -= np.log(np.exp(weight[usable]).sum())
    spelled = float(np.exp(alpha * (weight[usable].min() + np.log(SPELLED))))
    weight[usable] = np.exp(alpha * weight[usable])
    out = [b""] * n
    for i in usable:
        out[i] = names[i].replace(chr(BLANK_SIGN), " ").encode()
    for b in range(256):
        out[byte_ids[b]] = bytes([b])
    at = np.concatenate([[0], np.cumsum([len(x) for x in out])])
    return Vocabulary(table, begins, keys, weight, spelled, int(lengths.max()), byte_ids, np.frombuffer(b"".join(out), np.uint8), at)


def _arcs(v: Vocabulary, codes: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lattice of several chunks, longest first: all first characters, then all second ones, and so on.

    Returns, by node (behind a character) and arc length less 1, the arc and its weight; and the first node of each step. Arcs are piece ids,
    or the piece count plus the code point of a spelled character.
    """
    steps, n_pieces = int(lengths[0]), len(v.keys)
    wide = np.searchsorted(-lengths, -np.arange(steps), side="left")  # chunks longer than each step
    base = np.concatenate([[0], np.cumsum(wide)])
    total = int(base[-1])
    place = np.repeat(np.arange(steps), wide)
    rank = np.arange(total) - base[place]
    codes = codes[(np.cumsum(lengths) - lengths)[rank] + place].astype(U)

    letters, power = mix(codes), powers(width)
    arcs = np.full((total, width), -1, np.int32)
    begin, at, who, key = np.arange(total), place, rank, np.zeros(total, U)
    for k in range(1, width + 1):
        if k > 1:
            on = np.flatnonzero(lengths[who] - at >= k)
            begin, at, who, key = begin[on], at[on], who[on], key[on]
        end = base[at + k - 1] + who
        key = key + letters[end] * power[k - 1]
        on = np.flatnonzero(v.begins[key >> U(64 - BEGIN_BITS)])
        begin, at, who, key, end = begin[on], at[on], who[on], key[on], end[on]
        whole = key + U(k * LENGTH_SALT % (1 << 64))
        cells = _cells(whole)
        found = v.table[0, cells[0]]
        other = np.flatnonzero((found >= 0) & (v.keys[found] != whole))
        found[other] = v.table[1, cells[1][other]]
        good = np.flatnonzero((found >= 0) & (v.keys[found] == whole))
        arcs[end[good], k - 1] = found[good]
    weights = np.where(arcs >= 0, v.weights[arcs], 0.0)
    alone = np.flatnonzero(arcs[:, 0] < 0)
    arcs[alone, 0] = n_pieces + codes[alone].astype(np.int32)
    weights[alone, 0] = v.spelled
    return arcs, weights, base


def _filter(weights: np.ndarray, base: np.ndarray, paths: np.ndarray) -> np.ndarray:
    """Forward filtering: by node and arc length less 1, the cumulated chance to arrive by it.

    ``paths`` holds, by chunk and number of steps back less 1, the summed weights of all paths, at a common scale per chunk.
    """
    chance = np.empty(weights.shape, np.float32)
    for step in range(len(base) - 1):
        rows = slice(base[step], base[step + 1])
        paths = paths[: base[step + 1] - base[step]]
        arrive = np.cumsum(weights[rows] * paths, axis=1)
        sums = arrive[:, -1:]
        np.divide(arrive, sums, out=chance[rows], casting="same_kind")
        # Every few steps the sums are scaled, else the product of many small weights would underflow.
        paths = np.concatenate([sums, paths[:, :-1]], axis=1)
        if step % 8 == 7:
            paths /= sums
    return chance


def _draw(arcs, chance, base, which, step, state):
    """Backward sampling of several occurrences from their last steps: (occurrences, arcs) step by step."""
    active, drawn = np.arange(len(which)), []
    while len(active):
        state = mix(state + U(STRIDE))
        u = (state >> U(41)).astype(np.float32) * np.float32(2.0**-23)
        node = base[step] + which
        k = np.minimum((chance[node] <= u[:, None]).sum(1), np.minimum(step, chance.shape[1] - 1))
        drawn.append((active, arcs[node, k]))
        step = step - k - 1
        on = step >= 0
        step, which, state, active = step[on], which[on], state[on], active[on]
    return drawn


def _filter_one(weights: np.ndarray, paths: list[float], first: int) -> tuple[np.ndarray, list[float]]:
    """``_filter`` for a window of one chunk that begins at step ``first``; also the sums at its end."""
    past, out = deque(paths, len(paths)), []
    for step, row in enumerate(weights.tolist(), first):
        arrive = list(accumulate(map(mul, row, past)))
        out.append(arrive)
        past.appendleft(arrive[-1])
        if step % 8 == 7:
            past = deque([x / arrive[-1] for x in past], len(paths))
    found = np.array(out)
    return (found / found[:, -1:]).astype(np.float32), list(past)


def _long_chunk(v: Vocabulary, codes: np.ndarray, state: int) -> np.ndarray:
    """The arcs of one long chunk, drawn as ``_draw`` draws them, the last first."""
    width, starts = v.length, list(range(0, len(codes), WINDOW))

    def window(a: int) -> tuple[np.ndarray, np.ndarray]:
        lead = min(a, width - 1)  # arcs into the window begin up to here
        part = codes[a - lead : a + WINDOW]
        arcs, weights, _ = _arcs(v, part, np.array([len(part)]), width)
        return arcs[lead:], weights[lead:]

    paths = [[1.0] + [0.0] * (width - 1)]
    for a in starts[:-1]:
        paths.append(_filter_one(window(a)[1], paths[-1], a)[1])
    step, drawn = len(codes) - 1, []
    for a in reversed(starts):
        arcs, weights = window(a)
        chance = _filter_one(weights, paths.pop(), a)[0].tolist()
        while step >= a:
            state = _mixed((state + STRIDE) & MASK)
            k = min(bisect_right(chance[step - a], (state >> 41) * 2.0**-23), step, width - 1)
            drawn.append(arcs[step - a, k])
            step -= k + 1
    return np.array(drawn, np.int32)


def _mixed(x: int) -> int:
    """``mix`` of one number."""
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def encode_texts(
    v: Vocabulary, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, seed: int, first_chunk: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Sampled piece ids of several texts, and where each text's begin (with the total last).

    Chunks are numbered from ``first_chunk``; the number is part of what a random sequence depends on.
    """
    n = len(offsets) - 1
    whole = bytes(data)
    texts = [whole[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    counts = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(counts)])
    if not starts[-1]:
        return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
    code = np.frombuffer("".join(" " + t for t in texts if t).encode("utf-32-le"), np.uint32)
    code = np.where(code == BLANK_SIGN, np.uint32(OWN_SIGN), np.where(code == 32, np.uint32(BLANK_SIGN), code))
    blank = code == BLANK_SIGN
    opens = blank.copy()
    opens[1:] &= ~blank[:-1]
    opens[starts[:-1][counts > 0]] = True
    first = np.flatnonzero(opens)
    lengths = np.diff(np.concatenate([first, [len(code)]]))

    owner = np.searchsorted(starts, first, side="right") - 1
    row = np.arange(len(first)) - np.searchsorted(first, starts[:-1])[owner] + first_chunk
    state = mix(mix(keys.view(U) + U(seed))[owner] + row.astype(U) * U(0x9E3779B97F4A7C15))
    steps = np.zeros(len(first), np.int64)
    drawn: list[tuple[np.ndarray, np.ndarray, int]] = []
    long = {int(c): _long_chunk(v, code[first[c] : first[c] + lengths[c]], int(state[c])) for c in np.flatnonzero(lengths > NODES)}
    for c, arcs in long.items():
        steps[c] = len(arcs)
    short = np.flatnonzero(lengths <= NODES)
    if len(short):
        # One copy of each distinct chunk, longest first; groups of them with about NODES characters.
        inner = np.arange(int(lengths[short].sum())) - np.repeat(np.cumsum(lengths[short]) - lengths[short], lengths[short])
        _, kind, which = np.unique(
            _hash(code[np.repeat(first[short], lengths[short]) + inner].astype(U), lengths[short]), return_index=True, return_inverse=True
        )
        longest = np.argsort(-lengths[short][kind], kind="stable")
        place = np.empty(len(kind), np.int64)
        place[longest] = np.arange(len(kind))
        kind, which = short[kind[longest]], place[which]
        size = lengths[kind]
        by_kind = np.argsort(which, kind="stable")
        ordered = which[by_kind]
        for a, b in pieces(np.concatenate([[0], np.cumsum(size)]), NODES):
            own = by_kind[np.searchsorted(ordered, a) : np.searchsorted(ordered, b)]
            width = min(v.length, int(size[a]))
            inner = np.arange(int(size[a:b].sum())) - np.repeat(np.cumsum(size[a:b]) - size[a:b], size[a:b])
            arcs, weights, base = _arcs(v, code[np.repeat(first[kind[a:b]], size[a:b]) + inner], size[a:b], width)
            paths = np.zeros((b - a, width))
            paths[:, 0] = 1
            chance = _filter(weights, base, paths)
            for at, (who, arc) in enumerate(_draw(arcs, chance, base, which[own] - a, size[which[own]] - 1, state[short[own]])):
                drawn.append((short[own[who]], arc, at))
                steps[short[own[who]]] = at + 1
    after = np.cumsum(steps)
    out = np.zeros(int(after[-1]), np.int32)
    for who, arc, at in drawn:
        out[after[who] - 1 - at] = arc
    for c, arcs in long.items():
        out[after[c] - len(arcs) : after[c]] = arcs[::-1]
    bounds = np.concatenate([[0], after])[np.concatenate([np.searchsorted(first, starts[:-1]), [len(first)]])]
    return _spell(v, out, bounds)


def encode_long(v: Vocabulary, data: np.ndarray, key: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The same as ``encode_texts`` for one text, in pieces of about ``PIECE_BYTES`` that begin with the blanks of a chunk."""
    blank = data == 32
    opens = np.flatnonzero(blank[1:-1] & ~blank[:-2]) + 1  # the text's last byte opens no piece, which would be empty
    cuts = [0]
    while True:
        k = np.searchsorted(opens, cuts[-1] + PIECE_BYTES)
        if k == len(opens):
            break
        cuts.append(int(opens[k]))
    found, chunk = [], 0
    for a, b in zip(cuts, [*cuts[1:], len(data)], strict=True):
        part = data[a + 1 if a else 0 : b]  # a later piece begins with the blank that encoding puts first
        ids, _ = encode_texts(v, part, np.array([0, len(part)]), key, seed, chunk)
        found.append(ids)
        part = blank[a:b]
        chunk += int((part[1:] & ~part[:-1]).sum()) + 1 - int(not a and part[0])
    ids = np.concatenate(found)
    return ids, np.array([0, len(ids)])


def _spell(v: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace spelled characters by the pieces of their UTF-8 bytes."""
    n_pieces = len(v.keys)
    where = np.flatnonzero(ids >= n_pieces)
    if not len(where):
        return ids, bounds
    code = ids[where].astype(np.int64) - n_pieces
    code[code == OWN_SIGN] = BLANK_SIGN
    extra = (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
    repeats = np.ones(len(ids), np.int64)
    repeats[where] += extra
    at = np.concatenate([[0], np.cumsum(repeats)])
    out = np.repeat(ids, repeats)
    place = at[where]
    for tail in range(4):
        some = extra >= tail
        shift = 6 * (extra[some] - tail)
        bits = code[some] >> shift
        lead = np.array([0x00, 0xC0, 0xE0, 0xF0])[extra[some]] | bits
        byte = lead if tail == 0 else (0x80 | (bits & 0x3F))
        out[place[some] + tail] = v.byte_ids[byte]
    return out, at[bounds]


def decode_ids(v: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes that several id lists stand for, and their offsets."""
    size = np.diff(v.at)[ids]
    at = np.concatenate([[0], np.cumsum(size)])
    data = v.data[np.repeat(v.at[ids] - at[:-1], size) + np.arange(at[-1])]
    offsets = at[bounds]
    some = offsets[1:] > offsets[:-1]
    keep = np.ones(len(data), bool)
    keep[offsets[:-1][some]] = False  # the blank sign that encoding put first
    return data[keep], np.concatenate([[0], np.cumsum(np.diff(offsets) - some)])


def _encode(sent, seed: int, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = sent.value
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            keys = batch.column(1).to_numpy()
            for a, b in pieces(offsets):
                own, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                whole = encode_long(v, own, keys[a:b], seed) if len(own) > PIECE_BYTES and b - a == 1 else None
                ids, bounds = whole or encode_texts(v, own, at, keys[a:b], seed)
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)),
                ]
                if check:
                    back, ends = decode_ids(v, ids, bounds)
                    same = np.diff(ends) == np.diff(at)
                    if not same.all() or not np.array_equal(back, own):
                        same &= [bytes(back[p:q]) == bytes(own[r:s]) for p, q, r, s in zip(ends, ends[1:], at, at[1:])]
                    columns.append(pa.array(same))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "lossless"][: len(columns)])

    return run


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model_file: str = MODEL_FILE,
    alpha: float = ALPHA,
    seed: int = SEED,
    check: bool = False,
) -> DataFrame:
    """doc_id and ids, a sampled segmentation; with check, also lossless: whether decoding these ids gave the text's bytes again."""
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(load(model_file, alpha))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(id_col).alias("key"), text_of(text_col).alias("body"))
    return rows.mapInArrow(_encode(sent, seed, check), f"doc_id {kind}, ids array<int>" + ", lossless boolean" * check)


def _decode(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = sent.value
        for batch in batches:
            lists = batch.column(1)
            if lists.null_count:
                lists = pa.array([x or [] for x in lists.to_pylist()], pa.list_(pa.int32()))
            ends = lists.offsets.to_numpy().astype(np.int64)
            ids = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
            data, offsets = decode_ids(v, ids, ends - ends[0])
            whole = bytes(data)
            texts = [whole[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model_file: str = MODEL_FILE) -> DataFrame:
    """doc_id and text; null lists decode to the empty text."""
    kind = encoded.schema[id_col].dataType.simpleString()
    sent = encoded.sparkSession.sparkContext.broadcast(load(model_file))
    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(_decode(sent), f"doc_id {kind}, text string")
