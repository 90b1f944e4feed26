"""Documents packed into training sequences by harmonic classes, without any shuffle.

A document's tokens are cut into whole sequences and a rest. A rest of a length just under
1/k of a sequence belongs to class k, and a sequence of that class takes exactly k of them;
a rest between classes is cut at the next smaller class. Each task fills its own sequences
while it reads, one open sequence per class. What is left open at a task's end is laid end
to end, and its last part is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import json
import re
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CAPACITY, END = 1024, 0
#: A piece may be this part of its class's room shorter than the room.
SLACK = 1 / 64
#: Bytes of ids in a batch that a task gives back, code points of a text given to a library at once.
BATCH_BYTES, SECTION = 8 << 20, 1 << 20
# Characters on whose class no library disputes: ASCII, Latin letters, common punctuation.
_SURE = re.compile(r"[\t\n\r -~¡-¬®-ſ–-”…]*")
# Fixed value: how byte-level vocabularies split texts before the merges.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BETWEEN_WORDS = re.compile(r"[A-Za-z] [A-Za-z]")
#: Sequence numbers of a task.
TASK_SEQUENCES = 1 << 33


# Tokens


def _worker() -> types.ModuleType:
    """State of the Python worker, kept between tasks."""
    name = "_packing_worker"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].encoders = {}
    return sys.modules[name]


def _byte_of_letter() -> dict[str, int]:
    """How byte-level vocabularies write bytes: printable Latin-1 as itself, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Token ids of whole texts, those of `Tokenizer.encode(text, add_special_tokens=False)` of the file at `path`.

    Texts of ordinary characters go through tiktoken, several times as fast, with the file's
    own vocabulary as ranks. Texts with special strings or characters on whose class the two
    libraries may differ are given to tokenizers.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            self.quick = _quick(json.load(f))

    def sections(self, text: str) -> Iterator[str]:
        """A long text cut before a space between a letter and a letter, where every pre-token ends."""
        at = 0
        while len(text) - at > SECTION:
            cut = at + SECTION
            found = _BETWEEN_WORDS.search(text, cut)
            cut = found.start() + 1 if found else len(text)
            yield text[at:cut]
            at = cut
        yield text[at:]

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if any(s in text for s in self.special):
            # Special strings may swallow what is around them, so such a text is not cut.
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        out = []
        for part in self.sections(text):
            if self.quick and _SURE.fullmatch(part):
                out.append(np.array(self.quick.encode_ordinary(part), np.uint32))
            else:
                out.append(np.array(self.library.encode(part, add_special_tokens=False).ids, np.uint32))
        return np.concatenate(out) if len(out) > 1 else out[0]


def _quick(file: dict):
    """The vocabulary of a byte-level BPE file in tiktoken; None where the file is of another kind."""
    plain = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    model = file["model"]
    if file.get("normalizer") or file["pre_tokenizer"] != plain or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        return None
    import tiktoken

    byte = _byte_of_letter()
    added = {t["content"] for t in file["added_tokens"]}
    ranks = {bytes(byte[c] for c in piece): i for piece, i in model["vocab"].items() if piece not in added}
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(merged):
        return None
    return tiktoken.Encoding("packing", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})


def _encoder(path: str) -> Encoder:
    encoders = _worker().encoders
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


# Packing


def cut(n: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int]]:
    """(length, class) of the pieces of n tokens, in order: whole sequences, then rests that nearly fill 1/k of one."""
    pieces = [(capacity, 1)] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        room = capacity // k
        if room - rest > slack * room:
            k += 1
            while capacity // k > rest:
                k += 1
            room = capacity // k
            pieces.append((room, capacity // room))
            rest -= room
        else:
            pieces.append((rest, k))
            rest = 0
    return pieces


class Harmonic:
    """Open sequences of one task, one for each class; `put` gives the pieces of those that got full.

    A piece is (document, start, ids, tokens of the document); given back with its sequence
    and its place there.
    """

    def __init__(self, first: int, capacity: int = CAPACITY, slack: float = SLACK):
        self.next, self.capacity, self.slack, self.open = first, capacity, slack, {}

    def _closed(self, pieces: list[tuple]) -> Iterator[tuple]:
        at = 0
        for piece in pieces:
            yield (*piece, self.next, at)
            at += len(piece[2])
        self.next += 1

    def put(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        for length, k in cut(len(ids), self.capacity, self.slack):
            held = self.open.setdefault(k, [])
            held.append((doc, start, ids[start : start + length], len(ids)))
            start += length
            if len(held) == k:
                del self.open[k]
                yield from self._closed(held)

    def close(self) -> Iterator[tuple]:
        """What never filled a sequence, end to end: whole sequences, then powers of two."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        total, held, room = sum(len(p[2]) for p in left), [], 0
        for doc, start, ids, tokens in left:
            while len(ids):
                if not room:
                    room = min(self.capacity, 1 << (total.bit_length() - 1))
                part = ids[:room]
                held.append((doc, start, part, tokens))
                start, ids, room, total = start + len(part), ids[len(part) :], room - len(part), total - len(part)
                if not room:
                    yield from self._closed(held)
                    held = []


_PIECES = [
    ("doc", None), ("start", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
]


def _packed(path: str, capacity: int, end: int | None, slack: float) -> Callable:
    def run(batches):
        bins = Harmonic(TaskContext.get().partitionId() * TASK_SEQUENCES, capacity, slack)
        held, size, kind = [], 0, pa.null()

        def out():
            # Little-endian unsigned 32-bit ids, whatever the machine.
            rows = [(d, s, i.astype("<u4").tobytes(), t, q, o) for d, s, i, t, q, o in held]
            columns = [pa.array(c, t or kind) for c, (_, t) in zip(zip(*rows), _PIECES)]
            return pa.RecordBatch.from_arrays(columns, [n for n, _ in _PIECES])

        def pieces():
            nonlocal kind
            for batch in batches:
                kind = batch.column(0).type
                for doc, text in zip(batch.column(0), batch.column(1)):
                    ids = _encoder(path).ids(text.as_py())
                    yield from bins.put(doc.as_py(), ids if end is None else np.append(ids, np.uint32(end)))
            yield from bins.close()

        for piece in pieces():
            held.append(piece)
            size += 4 * len(piece[2]) + 64
            if size > BATCH_BYTES:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return run


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    end: int | None = END, slack: float = SLACK,
) -> DataFrame:
    """The pieces of all documents with their places: `id_col`, start, ids, doc_tokens, sequence_id, offset.

    `ids` holds the piece's token ids as little-endian unsigned 32-bit numbers; `start`
    counts the document's ids before it, `doc_tokens` all of them, with the `end` id. A null
    or empty text has only that; without `end` it gives no piece. Texts of any length are
    encoded whole. Rows that repeat an id or have none are documents of their own. Sequences
    are gapless up to their last piece; a full sequence of class k lacks at most `slack` of
    `capacity`, and those of a task's end none or are a power of two. Numbers of sequences
    follow the partitions of `docs`, so that a repeated task gives the same. Other columns
    are not looked at. An empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    out = rows.mapInArrow(
        _packed(path, capacity, end, slack), f"doc {kind}, start long, ids binary, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("doc", id_col)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, n, ids): the sequences themselves, of at most `capacity` pieces each; padding is left to the reader."""
    whole = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(whole, F.lit(b""), lambda all, p: F.concat(all, p["ids"]))
    out = pieces.groupBy("sequence_id").agg(joined.alias("ids"))
    return out.select("sequence_id", F.expr("octet_length(ids) div 4").alias("n"), "ids")


def op13(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "start", F.expr("CAST(octet_length(ids) div 4 AS BIGINT)").alias("length"), F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )
