"""Alignment of two tokenizers' tokens over the same bytes, and how often their ids are linked in the whole corpus.

Every text is read as a blank and the text: by a byte-level BPE (A) as it stands, by a piece model (B) that adds the blank itself. Byte offsets where
tokens of both end are cuts. They part the tokens into groups; the last A and the last B token of a group are linked.

Fragments form a monoid. The fragment of a byte range holds the tokens that end in it, in parts: with k cuts in the range there are k + 1 parts, the
first open to the left, the last open to the right, those between closed. Two neighbours compose by joining the last part of one with the first of the
other; one empty part is the identity, and composing is associative (``compose``, ``Fragment``). A text up to ``RANGE`` bytes is one fragment. A longer one is cut
into segments, which tasks read separately, each giving fragments that end at multiples of ``RANGE``, often within a group; these are composed by a tree
with ``FAN`` children, level by level, in as many Spark tasks as there are nodes. Equal long texts are read once.

Segments, and the chunks whose tokens a worker remembers, begin at a single blank between two characters that are not white space. There neither tokenizer
can tell them from the whole: A's pattern ends a word before such a blank and never looks back, and no piece of B has a blank after another character (checked
on loading). A worker remembers at most ``CHUNKS`` distinct chunks; this changes no result.

Counts of id pairs come from all links. A worker looks up the frequent pairs, at most ``HOT`` of them by a threshold on counts, in an array it is sent; the
others, each of which is rare, meet their counts in a join.

Null and empty texts, and those whose tokens of A or B do not spell the blank and the text byte for byte (a text with a blank sign of its own), have no tokens:
all numbers are 0 and the hash is the empty string. Such texts add to no count. Special tokens' strings inside texts are plain text. Repeated rows count each, with
equal results. An empty table gives no rows. Other columns are not looked at. A text without blanks is one chunk, read whole by one task.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import pieces, stored

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RANGE = 1 << 16
FAN = 16
CHUNKS = 1 << 18
CHUNK_BYTES = 1 << 25  # of remembered chunks
GROUP = 1 << 14  # characters of new chunks encoded at once
PIECE = 1 << 18  # characters of texts handled at once
HOT = 1 << 20

BLANK_SIGN = "▁"
CUT = re.compile(r"(?<=\S) (?=\S)")
# Where this finds nothing, every blank is a cut.
UNEVEN = re.compile(r"\s\s|\A\s|\s\Z")
LISTS = "a array<int>, b array<int>, na array<int>, nb array<int>"
NUMBERS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


# The monoid


@dataclass
class Fragment:
    """Tokens of both tokenizers that end in a byte range, and how many of each the range's parts have."""

    a: np.ndarray
    b: np.ndarray
    na: np.ndarray
    nb: np.ndarray


def identity() -> Fragment:
    return Fragment(*(np.zeros(0, np.int32) for _ in "ab"), *(np.zeros(1, np.int32) for _ in "ab"))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.concatenate([left[:-1], [left[-1] + right[0]], right[1:]]).astype(np.int32)


def compose(left: Fragment, right: Fragment) -> Fragment:
    return Fragment(
        np.concatenate([left.a, right.a]), np.concatenate([left.b, right.b]), _joined(left.na, right.na), _joined(left.nb, right.nb)
    )


def compose_all(fragments: list[Fragment]) -> Fragment:
    """The same as composing one after the other, with every list put together once."""
    if not fragments:
        return identity()
    counts = []
    for name in ("na", "nb"):
        lists = [getattr(f, name) for f in fragments]
        first = np.cumsum([0] + [len(x) - 1 for x in lists[:-1]])
        whole = np.zeros(int(first[-1]) + len(lists[-1]), np.int32)
        for at, x in zip(first.tolist(), lists, strict=True):
            whole[at : at + len(x)] += x
        counts.append(whole)
    return Fragment(np.concatenate([f.a for f in fragments]), np.concatenate([f.b for f in fragments]), *counts)


# Tokens


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _digits(n: int) -> np.ndarray:
    """Decimal digits of 0 to n - 1, left-aligned, with room for a separator."""
    width = len(str(max(n - 1, 0))) + 1
    return np.array([str(i).ljust(width, "\0").encode() for i in range(n)]).view(np.uint8).reshape(n, width) if n else np.zeros((0, 1), np.uint8)


class _Numbers(dict):
    """Numbers of chunks in the order in which they were first asked for; ``new`` collects those just numbered."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


class Tokenizers:
    """Both tokenizers and the tokens of the chunks met so far. One per Python worker."""

    def __init__(self, byte_model: str, piece_model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.byte_level = Tokenizer.from_file(byte_model)
        self.byte_level.encode_special_tokens = True
        self.piece = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        alphabet = byte_alphabet()
        self.a_bytes = [b""] * self.byte_level.get_vocab_size(with_added_tokens=True)
        for token, i in self.byte_level.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = bytes(map(alphabet.__getitem__, token)) if set(token) <= alphabet.keys() else token.encode()
        self.b_bytes = []
        for i in range(self.piece.get_piece_size()):
            name = self.piece.id_to_piece(i)
            if BLANK_SIGN in name.lstrip(BLANK_SIGN):
                raise ValueError("a piece has a blank sign after another character")
            self.b_bytes.append(bytes([int(name[1:-1], 16)]) if self.piece.is_byte(i) else name.replace(BLANK_SIGN, " ").encode())
        self.a_size, self.b_size = (np.array([len(x) for x in names], np.int32) for names in (self.a_bytes, self.b_bytes))
        self.a_digits, self.b_digits = _digits(len(self.a_size)), _digits(len(self.b_size))
        self.forget()

    def forget(self) -> None:
        self.known = _Numbers()
        self.bytes = 0
        # Tokens of all known chunks, where each chunk's begin (with the total last), and which chunks are spelled wrongly.
        self.a, self.b = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.a_at, self.b_at = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.wrong = np.zeros(0, bool)

    def _encode(self, chunks: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids of A and of B, each with the number of every chunk's tokens; None where bytes or chunks do not come out.

        The chunks are encoded as one text with a blank before each.
        """
        text = " ".join(chunks)
        whole = f" {text}".encode()
        ends = np.cumsum([len(c.encode()) + 1 for c in chunks])
        out = []
        for ids, names, size in (
            (self.byte_level.encode(f" {text}", add_special_tokens=False).ids, self.a_bytes, self.a_size),
            (self.piece.encode(text), self.b_bytes, self.b_size),
        ):
            if b"".join(map(names.__getitem__, ids)) != whole:
                return None
            flat = np.array(ids, np.int32)
            token_ends = np.cumsum(size[flat], dtype=np.int64)
            last = np.searchsorted(token_ends, ends)
            if (token_ends[last] != ends).any():
                return None
            out.append((flat, np.diff(last + 1, prepend=0)))
        return out

    def _learn(self, chunks: list[str]) -> None:
        # Between chunks with white space or a blank sign at their ends, joining would make no cuts.
        groups, size = [], GROUP
        for chunk in chunks:
            plain = chunk and BLANK_SIGN not in chunk and not chunk[0].isspace() and not chunk[-1].isspace()
            if not plain or size >= GROUP:
                groups.append([])
            groups[-1].append(chunk)
            size = GROUP if not plain else (0 if len(groups[-1]) == 1 else size) + len(chunk)
        none = np.zeros(0, np.int32), np.zeros(1, np.int64)
        found, wrong = [], []
        while groups:
            group = groups.pop()
            if (one := self._encode(group)) is None and len(group) > 1:
                groups += [[c] for c in group]
                continue
            found.append(one or [none, none])
            wrong += [one is None] * len(group)
        # Taken from the end, so put in order again.
        found.reverse()
        self.wrong = np.concatenate([self.wrong, np.array(wrong[::-1], bool)])
        self.bytes += sum(map(len, chunks))
        for k, name in enumerate("ab"):
            setattr(self, name, np.concatenate([getattr(self, name), *(f[k][0] for f in found)]))
            at = getattr(self, f"{name}_at")
            setattr(self, f"{name}_at", np.concatenate([at, at[-1] + np.cumsum(np.concatenate([f[k][1] for f in found]))]))

    def read(self, bodies: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of both tokenizers for several texts, where each text's begin (with the total last), and which texts are spelled rightly.

        A text stands behind a blank. Empty ones and those spelled wrongly have no tokens.
        """
        if len(self.known) > CHUNKS or self.bytes > CHUNK_BYTES:
            self.forget()
        which, size = [], []
        for body in bodies:
            chunks = (CUT.split(body) if UNEVEN.search(body) else body.split(" ")) if body else []
            which += map(self.known.__getitem__, chunks)
            size.append(len(chunks))
        if self.known.new:
            self._learn(self.known.new)
            self.known.new = []
        chunk = np.array(which, np.int64)
        owner = np.repeat(np.arange(len(bodies)), size)
        right = np.array(size) > 0
        right[owner[self.wrong[chunk]]] = False
        used = right[owner]
        chunk, owner = chunk[used], owner[used]
        out = []
        for ids, begins in ((self.a, self.a_at), (self.b, self.b_at)):
            length = begins[chunk + 1] - begins[chunk]
            ends = np.cumsum(length)
            out.append(ids[np.repeat(begins[chunk] - (ends - length), length) + np.arange(int(ends[-1]) if len(ends) else 0)])
            out.append(np.concatenate([[0], np.cumsum(np.bincount(owner, length, len(bodies)).astype(np.int64))]))
        return *out, right


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(models: tuple[str, str]) -> Tokenizers:
    if models not in _LOADED:
        _LOADED.clear()
        _LOADED[models] = Tokenizers(*models)
    return _LOADED[models]


# Fragments of texts, and what a whole text gives


@dataclass
class Fragments:
    """Several fragments: their lists one after the other, and where each fragment's begin (with the total last)."""

    a: np.ndarray
    b: np.ndarray
    na: np.ndarray
    nb: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray
    parts_at: np.ndarray


def fragments(t: Tokenizers, bodies: list[str], starts: np.ndarray, size: int) -> tuple[Fragments, np.ndarray, np.ndarray, np.ndarray]:
    """The fragments of segments that begin at these bytes, split at multiples of ``size``; a segment's row and first byte for each; right rows.

    Every segment gives a fragment, if only an empty one.
    """
    a, a_at, b, b_at, right = t.read(bodies)
    a_end, b_end = np.cumsum(t.a_size[a], dtype=np.int64), np.cumsum(t.b_size[b], dtype=np.int64)
    total = int(a_end[-1]) if len(a_end) else 0
    ends = np.zeros(total + 1, bool)
    ends[b_end] = True
    a_cut = ends[a_end]
    ends[:] = False
    ends[a_end] = True
    b_cut = ends[b_end]
    # The byte before each segment in this batch, and hence every token's place in its own text.
    before = np.concatenate([[0], a_end])[a_at[:-1]]
    bounds = []
    for end, at in ((a_end, a_at), (b_end, b_at)):
        row = np.repeat(np.arange(len(bodies)), np.diff(at))
        place = end - before[row] + starts[row]
        bounds.append((row, (place - 1) // size))
    first = starts // size
    last = np.maximum.reduceat(np.concatenate([bounds[0][1], [0]]), np.minimum(a_at[:-1], len(a))) if len(bodies) else first
    last = np.where(np.diff(a_at) > 0, last, first)
    many = last - first + 1
    row = np.repeat(np.arange(len(bodies)), many)
    offset = np.concatenate([[0], np.cumsum(many)])
    number = first[row] + np.arange(int(offset[-1])) - offset[row]
    found = []
    for owner, ranges in bounds:
        of = offset[owner] + ranges - first[owner]
        found.append(np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(row)))]).astype(np.int64))
    counts = []
    for cut, at in ((a_cut, found[0]), (b_cut, found[1])):
        cuts = np.flatnonzero(cut) + 1
        inside = np.searchsorted(cuts, at[1:], "right")  # cuts up to each fragment's end
        ends_at = inside + np.arange(len(row))
        all_ends = np.empty(len(cuts) + len(row), np.int64)
        is_end = np.zeros(len(all_ends), bool)
        is_end[ends_at] = True
        all_ends[ends_at] = at[1:]
        all_ends[~is_end] = cuts
        counts.append(np.diff(all_ends, prepend=0).astype(np.int32))
        parts = np.concatenate([[0], ends_at + 1])
    return Fragments(a, b, *counts, *found, parts), row, np.maximum(starts[row], number * size), right


def whole_texts(t: Tokenizers, f: Fragments) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
    """Numbers and hash per whole text, its linked pairs of ids, and where each text's pairs begin (with the total last)."""
    n = len(f.parts_at) - 1
    tail = np.zeros(len(f.na), bool)
    tail[f.parts_at[1:] - 1] = True
    if (f.na[tail] + f.nb[tail]).any():
        raise ValueError("the end of a text is not a cut")
    na, nb = f.na[~tail].astype(np.int64), f.nb[~tail].astype(np.int64)
    a_last, b_last = np.cumsum(na), np.cumsum(nb)
    groups_at = f.parts_at - np.arange(n + 1)
    width = max(t.a_digits.shape[1], t.b_digits.shape[1])
    text = np.zeros((len(f.a) + len(f.b), width), np.uint8)
    for ids, digits, count, shift, sign in ((f.a, t.a_digits, na, b_last - nb, b"|"), (f.b, t.b_digits, nb, a_last, b";")):
        place = np.arange(len(ids)) + np.repeat(shift, count)
        text[place, : digits.shape[1]] = digits[ids]
        filled = (digits != 0).sum(1)[ids]
        mark = np.full(len(ids), ord(","), np.uint8)
        mark[np.cumsum(count) - 1] = sign[0]
        if sign == b";":
            some = groups_at[1:] > groups_at[:-1]
            mark[b_last[groups_at[1:][some] - 1] - 1] = 0  # nothing after a text's last group
        text[place, filled] = mark
    used = text != 0
    at = np.concatenate([[0], np.cumsum(used.sum(1))])[f.a_at + f.b_at]
    flat = memoryview(text[used])
    hashes = [hashlib.sha256(flat[x:y]).hexdigest() if y > x else "" for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    links = np.diff(groups_at)
    pairs = f.a[a_last - 1].astype(np.int64) * len(t.b_size) + f.b[b_last - 1]
    numbers = [pa.array(x.astype(np.int64)) for x in (np.diff(f.a_at), np.diff(f.b_at), links, links)]
    return [*numbers, pa.array(hashes, pa.string())], pairs, groups_at


def _lists(at: np.ndarray, values: np.ndarray, kind: type = np.int32) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(kind)))


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[str]]]:
    bodies = [x or "" for x in batch.column(column).to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in bodies])])
    for first, last in pieces(offsets, PIECE):
        yield first, last, bodies[first:last]


def _names(schema: str) -> list[str]:
    return re.findall(r"(\w+) \w+", schema)


def _result(batch_columns: list[pa.Array], t: Tokenizers, f: Fragments, schema: str) -> pa.RecordBatch:
    numbers, pairs, at = whole_texts(t, f)
    kind = np.int32 if "array<int>" in schema else np.int64
    return pa.RecordBatch.from_arrays([*batch_columns, *numbers, _lists(at, pairs, kind)], names=_names(schema))


def _short(models: tuple[str, str], schema: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(models)
        for batch in batches:
            for first, last, bodies in _texts(batch, 1):
                f, *_ = fragments(t, bodies, np.zeros(len(bodies), np.int64), 1 << 62)
                yield _result([batch.column(0).slice(first, last - first)], t, f, schema)

    return run


def segments(text: str, size: int) -> Iterator[tuple[int, str]]:
    """First byte (of the blank before it) and body of a text's segments: each goes on to the first cut behind a multiple of ``size``."""
    data = text.encode()
    at = 0  # byte of the blank that the segment begins with, counted with the blank that stands before the text
    while True:
        goal = (at // size + 1) * size
        # Bytes of white space beyond ASCII cannot stand next to a blank that is a cut; decoding tells.
        cut = goal
        while (cut := data.find(b" ", cut - 1) + 1) > 0:
            around = data[max(cut - 5, 0) : cut + 4].decode("utf-8", "ignore")
            if CUT.search(around) and _is_cut(data, cut - 1):
                break
            cut += 1
        if cut <= 0:
            yield at, data[at:].decode()
            return
        yield at, data[at : cut - 1].decode()
        at = cut


def _is_cut(data: bytes, blank: int) -> bool:
    """Whether the characters on both sides of this blank are no white space."""
    first = blank - 1
    while first > 0 and data[first] & 0xC0 == 0x80:
        first -= 1
    last = blank + 2
    while last < len(data) and data[last] & 0xC0 == 0x80:
        last += 1
    left, right = data[max(first, 0) : blank].decode(), data[blank + 1 : last].decode()
    return bool(left and right) and not left.isspace() and not right.isspace()


def _cut(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = list(segments(text, size))
                for k in range(0, len(found), 64):
                    some = found[k : k + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(some)), pa.array([s[0] for s in some], pa.int64()), pa.array([s[1] for s in some])],
                        names=["name", "at", "body"],
                    )

    return run


FRAGMENT = f"name string, at bigint, spelled boolean, {LISTS}"


def _fragments(models: tuple[str, str], size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(models)
        for batch in batches:
            starts = batch.column(1).to_numpy()
            for first, last, bodies in _texts(batch, 2):
                f, row, at, right = fragments(t, bodies, starts[first:last], size)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first).take(pa.array(row)),
                        pa.array(at),
                        pa.array(right[row]),
                        _lists(f.a_at, f.a),
                        _lists(f.b_at, f.b),
                        _lists(f.parts_at, f.na),
                        _lists(f.parts_at, f.nb),
                    ],
                    names=_names(FRAGMENT),
                )

    return run


def _composed(rows: pa.Table) -> tuple[Fragment, bool]:
    """The fragments of one node's children, in the order of their bytes, composed; whether all are spelled rightly."""
    rows = rows.sort_by("at")
    lists = [[x.values.to_numpy() for x in rows[c]] for c in ("a", "b", "na", "nb")]
    return compose_all([Fragment(*x) for x in zip(*lists, strict=True)]), all(rows["spelled"].to_pylist())


def _node(rows: pa.Table) -> pa.Table:
    """One inner node of the tree."""
    f, spelled = _composed(rows)
    ints = pa.list_(pa.int32())
    return pa.table(
        [
            rows["name"].slice(0, 1),
            pa.array([pc.min(rows["at"]).as_py()], pa.int64()),
            pa.array([spelled]),
            *(pa.array([x], ints) for x in (f.a, f.b, f.na, f.nb)),
        ],
        names=_names(FRAGMENT),
    )


def _root(models: tuple[str, str], schema: str):
    """The root of a text's tree: what it gives as a whole text. A worker of its own for this would hold the models and chunks once more."""

    def run(rows: pa.Table) -> pa.Table:
        f, spelled = _composed(rows)
        f = f if spelled else identity()
        at = [np.array([0, len(x)], np.int64) for x in (f.a, f.b, f.na)]
        whole = Fragments(f.a, f.b, f.na, f.nb, *at)
        return pa.Table.from_batches([_result([rows["name"].slice(0, 1).combine_chunks()], tokenizers(models), whole, schema)])

    return run


def aligned(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    byte_model: str = BYTE_MODEL,
    piece_model: str = PIECE_MODEL,
    size: int = RANGE,
    fan: int = FAN,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and pairs, the links' ids (A's times B's vocabulary size, plus B's), in order."""
    models = byte_model, piece_model
    t = tokenizers(models)
    pairs = "pairs array<int>" if len(t.a_size) * len(t.b_size) < 1 << 31 else "pairs array<bigint>"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    length = F.octet_length("text")
    short = rows.where(length < size).mapInArrow(_short(models, f"doc_id {kind}, {NUMBERS}, {pairs}"), f"doc_id {kind}, {NUMBERS}, {pairs}")
    long = rows.where(length >= size).withColumn("name", F.sha2("text", 256))
    longest = long.agg(F.max(length)).first()[0]
    if longest is None:
        return short
    nodes = (
        long.select("name", "text")
        .dropDuplicates(["name"])
        .mapInArrow(_cut(size), "name string, at bigint, body string")
        .repartition("name", "at")
        .mapInArrow(_fragments(models, size), FRAGMENT)
    )
    schema = f"name string, {NUMBERS}, {pairs}"
    span = size * fan
    while span <= longest:  # a text has one byte more than its own, the blank
        nodes = nodes.groupBy("name", F.expr(f"at div {span}L").alias("node")).applyInArrow(_node, FRAGMENT)
        span *= fan
    roots = nodes.groupBy("name").applyInArrow(_root(models, schema), schema)
    return short.unionByName(long.select("doc_id", "name").join(roots, "name").drop("name"))


# Counts of pairs


def pair_counts(texts: DataFrame, n_b: int) -> DataFrame:
    """pair, count (links of the whole corpus) and best (whether no other pair of the same B id has a higher count)."""
    counts = stored(texts.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count")), "pair_counts")
    b = (F.col("pair") % n_b).alias("b")
    highest = counts.groupBy(b).agg(F.max("count").alias("highest"))  # at most a row per id of B's vocabulary
    return counts.withColumn("b", b).join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def _threshold(counts: DataFrame, hot: int) -> int:
    """The least power of two such that at most ``hot`` pairs have so many links; from a histogram of at most 63 rows."""
    by_power = counts.groupBy(F.floor(F.log2("count")).alias("power")).agg(F.count("*").alias("pairs")).collect()
    least, covered = 1 << 62, 0
    for power, pairs in sorted(by_power, reverse=True):
        covered += pairs
        if covered > hot:
            break
        least = 1 << power
    return least


def _look_up(sent, schema: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = sent.value
        names = _names(schema)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            ends = lists.offsets.to_numpy().astype(np.int64)
            links = lists.values.to_numpy()[ends[0] : ends[-1]]
            ends -= ends[0]
            place = np.minimum(np.searchsorted(pair, links), max(len(pair) - 1, 0))
            hit = pair[place] == links if len(pair) else np.zeros(len(links), bool)
            place = place[hit]
            hits = np.concatenate([[0], np.cumsum(hit)])[ends]
            sums = [np.concatenate([[0], np.cumsum(x[place], dtype=np.int64)])[hits] for x in (best, count)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    *(pa.array(np.diff(x)) for x in sums),
                    _lists(ends - hits, links[~hit], links.dtype.type),
                ],
                names=names,
            )

    return run


def align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    byte_model: str = BYTE_MODEL,
    piece_model: str = PIECE_MODEL,
    size: int = RANGE,
    fan: int = FAN,
    hot: int = HOT,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    spark = docs.sparkSession
    n_b = len(tokenizers((byte_model, piece_model)).b_size)
    found = aligned(docs, id_col, text_col, byte_model, piece_model, size, fan)
    # The number is fixed once the rows are written, whatever order they came in.
    texts = stored(found.select(F.monotonically_increasing_id().alias("row"), *found.columns), "aligned")
    counts = stored(pair_counts(texts, n_b), "pairs")
    least = _threshold(counts, hot)
    frequent = counts.where(F.col("count") >= least).toArrow().sort_by("pair")
    arrays = tuple(frequent[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("pair", "count", "best"))
    sent = spark.sparkContext.broadcast(arrays)
    kinds = {f.name: f.dataType.simpleString() for f in texts.schema}
    columns = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in columns), "n_best bigint", "count_sum bigint", f"rare {kinds['pairs']}"])
    known = texts.select(*columns, "pairs").mapInArrow(_look_up(sent, schema), schema)
    wanted = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if counts.where(F.col("count") < least).isEmpty():
        return known.select(*wanted)
    known = stored(known, "known")
    rare = (
        known.select("row", F.explode("rare").alias("pair"))
        .groupBy("row", "pair")
        .agg(F.count("*").alias("times"))
        .join(counts.where(F.col("count") < least), "pair")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.col("best").cast("bigint")).alias("more_best"), F.sum(F.col("times") * F.col("count")).alias("more_count")
        )
    )
    zero = F.lit(0).cast("bigint")
    return (
        known.join(rare, "row", "left")
        .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", zero))
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_count", zero))
        .select(*wanted)
    )
