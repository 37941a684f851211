"""Byte-level BPE through a sentencepiece model that is written directly from a rank vocabulary."""

from __future__ import annotations

import base64
import struct
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import islice

import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import whole_text

#: Pre-tokens handled at once, so that a text of any length needs little besides itself.
PORTION = 50_000
#: Texts up to this length are split in one call, longer ones match by match.
AT_ONCE = 1_000_000
#: Pre-tokens whose ids a worker remembers, and the longest one.
REMEMBERED, LONGEST = 300_000, 64
#: Packed ids after which a batch is handed over.
BATCH_BYTES = 32 * 1024 * 1024

# Fixed values of the model format: message fields and kinds.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _UNUSED = 1, 2, 5
_BPE = 2


def byte_letters() -> str:
    """One printable character per byte: itself where it is printable in Latin-1, else the next from code point 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b) if b in plain else chr(next(others)) for b in range(256))


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _piece(text: str, score: float, kind: int) -> bytes:
    return _bytes(_PIECES, _bytes(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))


def piece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised BPE model whose piece ids are the ranks.

    A piece is its token's bytes in printable letters, scored by the negative
    rank, so the best merge is the one of lowest rank. Nothing is normalised: no
    blank is added, removed or replaced. The unknown piece, which the format
    asks for, gets the id after the last rank; unused ranks get unused pieces.
    """
    letters = byte_letters()
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the vocabulary lacks a byte")
    tokens = {rank: token for token, rank in ranks.items()}
    size = max(tokens) + 1
    spare = 0x10000  # letters of unused and unknown pieces lie outside of all byte letters
    pieces = []
    for rank in range(size):
        if rank in tokens:
            pieces.append(_piece(tokens[rank].decode("latin-1").translate(letters), -float(rank), _NORMAL))
        else:
            pieces.append(_piece(chr(spare + rank), -float(rank), _UNUSED))
    pieces.append(_piece(chr(spare + size), 0.0, _UNKNOWN))
    off = 2**64 - 1  # -1: no such piece
    trainer = _number(3, _BPE) + _number(4, size + 1) + _number(40, size) + b"".join(_number(f, off) for f in (41, 42, 43))
    normalizer = _bytes(1, b"identity") + b"".join(_number(f, 0) for f in (3, 4, 5))
    return b"".join(pieces) + _bytes(_TRAINER, trainer) + _bytes(_NORMALIZER, normalizer)


@cache
def class_stand_ins(pattern: str) -> dict[int, str]:
    """Characters that the splitting library here and the tokenizer's class otherwise, with a stand-in of the right class.

    The two follow different versions of Unicode: letters and digits assigned
    later are neither for the tokenizer. Only code points can differ that one of
    three tables does not know, so only these are tried, in one encoding each.
    """
    letter, digit = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
    kind = lambda c: "L" if letter.match(c) else "N" if digit.match(c) else ""
    known = lambda c: (unicodedata.category(c)[0] if unicodedata.category(c)[0] in "LN" else "")
    every = (chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    doubtful = [c for c in every if unicodedata.category(c) == "Cn" or kind(c) != known(c)]
    doubtful = [c for c in doubtful if kind(c) or known(c) or unicodedata.category(c) != "Cn"]
    vocabulary = {bytes([b]): b for b in range(256)}
    for c in doubtful:
        for lead in ("a", "1"):
            vocabulary[(lead + c).encode()] = len(vocabulary)
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={})
    together = lambda text: len(probe.encode_ordinary(text)) == 1
    found = {}
    for c in doubtful:
        theirs = "L" if together("a" + c) else "N" if together("1" + c) else ""
        if theirs != kind(c):
            found[ord(c)] = {"L": "ª", "N": "²", "": "¤"}[theirs]
    return found


@dataclass
class Tokenizer:
    """What a task needs, small enough to travel with it: the model, the pattern and its stand-ins."""

    model: bytes
    pattern: str
    stand_ins: dict[int, str]

    def __post_init__(self) -> None:
        self._ready = False

    def __getstate__(self) -> tuple:
        return self.model, self.pattern, self.stand_ins

    def __setstate__(self, state: tuple) -> None:
        self.model, self.pattern, self.stand_ins = state
        self._ready = False

    def _start(self) -> None:
        self._pieces = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        self._letters = byte_letters()
        self._split = regex.compile(self.pattern)
        self._odd = frozenset(map(chr, self.stand_ins))
        self._ids: dict[str, bytes] = {}
        size = self._pieces.get_piece_size()
        back = {c: b for b, c in enumerate(self._letters)}
        names = self._pieces.id_to_piece(list(range(size)))
        self._tokens = [bytes(back[c] for c in name) if all(c in back for c in name) else b"" for name in names]
        self._whole = {name: i for i, name in enumerate(names)}
        self._ready = True

    def pre_tokens(self, text: str) -> Iterator[str]:
        """The matches of the pattern, as the tokenizer's own library finds them."""
        if text.isascii() or self._odd.isdisjoint(text):
            if len(text) <= AT_ONCE:
                return iter(self._split.findall(text))
            return (m.group() for m in self._split.finditer(text))
        return (text[m.start() : m.end()] for m in self._split.finditer(text.translate(self.stand_ins)))

    def _encode_new(self, pre_tokens: list[str]) -> Iterator[bytes]:
        """Packed ids of pre-tokens: one piece if the vocabulary has it whole, else merged."""
        lettered = [p.encode().decode("latin-1").translate(self._letters) for p in pre_tokens]
        whole = [self._whole.get(t) for t in lettered]
        merged = iter(self._pieces.encode([t for t, i in zip(lettered, whole) if i is None], out_type=int, num_threads=1))
        for i in whole:
            yield array("I", next(merged) if i is None else (i,)).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self._ready:
            self._start()
        out, found, known = [], self.pre_tokens(text), self._ids
        while portion := list(islice(found, PORTION)):
            if len(known) > REMEMBERED:
                known.clear()
            new = [p for p in dict.fromkeys(portion) if p not in known]
            here = dict(zip(new, self._encode_new(new)))
            known.update((p, ids) for p, ids in here.items() if len(p) <= LONGEST)
            out.append(b"".join([here[p] if p in here else known[p] for p in portion]))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of packed ids: pieces mapped back letter by letter."""
        if not self._ready:
            self._start()
        return b"".join(map(self._tokens.__getitem__, array("I", ids)))


def tokenizer(path: str, pattern: str) -> Tokenizer:
    """A tokenizer from a rank file, which only the driver reads."""
    return Tokenizer(piece_model(read_ranks(path)), pattern, class_stand_ins(pattern))


def _flushed(rows: Iterable[tuple[bytes, pa.RecordBatch, int]], name: str) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with a new binary column, handed over in parts of bounded size."""
    held: list[bytes] = []
    size, first, batch = 0, 0, None

    def part(end: int) -> pa.RecordBatch:
        columns = [c.slice(first, end - first) for c in batch.columns[:-1]]
        return pa.RecordBatch.from_arrays([*columns, pa.array(held, pa.binary())], [*batch.schema.names[:-1], name])

    for value, owner, at in rows:
        if owner is not batch:
            if held:
                yield part(first + len(held))
            held, size, first, batch = [], 0, at, owner
        held.append(value)
        size += len(value)
        if size > BATCH_BYTES:
            yield part(at + 1)
            held, size, first = [], 0, at + 1
    if held:
        yield part(first + len(held))


def encode(docs: DataFrame, tool: Tokenizer, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row, and ``ids``: the text's ids as little-endian unsigned 32-bit integers.

    NULL and empty texts have no ids. Rows are independent: repeated rows and
    NULL ids stay, an empty table gives an empty result, other columns are not
    read. A text is taken in portions of pre-tokens, so a very long one needs
    memory in proportion to itself only.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(tool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = shipped.value
        yield from _flushed(((tool.encode(t.as_py()), batch, i) for batch in batches for i, t in enumerate(batch.column(batch.num_columns - 1))), "ids")

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], whole_text().alias("__text"))
    return rows.mapInArrow(run, _schema(docs, keep, "ids"))


def decode(encoded: DataFrame, tool: Tokenizer, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row, and ``decoded``: the bytes that its ``ids`` stand for."""
    shipped = encoded.sparkSession.sparkContext.broadcast(tool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = shipped.value
        yield from _flushed(((tool.decode(t.as_py()), batch, i) for batch in batches for i, t in enumerate(batch.column(batch.num_columns - 1))), "decoded")

    rows = encoded.select(*[F.col(f"`{c}`") for c in keep], F.coalesce("ids", F.lit(b"")).alias("__ids"))
    return rows.mapInArrow(run, _schema(encoded, keep, "decoded"))


def _schema(df: DataFrame, keep: list[str], more: str) -> str:
    return ", ".join([*[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep], f"{more} binary"])
