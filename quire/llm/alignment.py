"""Cross-tokenizer alignment: where two tokenizers cut the same bytes, and which of their tokens meet."""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, count

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import partitions, stored

#: Where the vocabulary files of public tokenizers are.
FOLDER = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text after which a block of documents ends, and those that are aligned at once.
BLOCK_BYTES, BATCH_BYTES = 32 << 20, 4 << 20
#: Stretches of text after which a process forgets what it knows of them, before it goes on.
KEPT = 300_000

#: No token of either kind reaches over a single space between other characters, nor depends on what is beyond it.
_STRETCH = re.compile(r"(?<=\S)(?= \S)")
_NONE = np.zeros(0, np.int64)


def _byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte of Latin-1 as itself, and the others in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


# Fixed value: how byte-level BPE splits a text before it merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteBpe:
    """A byte-level BPE from a file of the tokenizers library; special tokens' strings in a text are plain text.

    Where merges have their ids in order and nothing is normalised, tiktoken gives the same ids in a fraction of the time.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        alphabet = _byte_alphabet()
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        entries, special = given["model"]["vocab"], {t["content"] for t in given.get("added_tokens", ())}
        self.bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.bytes[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in given["model"]["merges"]]
        order, how = [entries[a + b] for a, b in pairs], given["pre_tokenizer"] or {}
        plain = how.get("type") == "ByteLevel" and how.get("use_regex", True) and not how.get("add_prefix_space") and not given.get("normalizer")
        if plain and order == sorted(order) and len(order) + 256 == len(entries) - len(special & entries.keys()):
            ranks = {self.bytes[i]: i for e, i in entries.items() if e not in special}
            self.encode = list_encoder(tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}))
        else:
            model = tokenizers.Tokenizer.from_file(path)
            model.encode_special_tokens = True
            self.encode = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]


def list_encoder(encoding: tiktoken.Encoding) -> Callable[[list[str]], list[list[int]]]:
    """Token ids of space+text for each text, which starts with that space."""
    return lambda texts: [encoding.encode_ordinary(t) for t in texts]


class PieceBpe:
    """A sentencepiece model with byte pieces, which adds the space itself."""

    def __init__(self, path: str):
        self._model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode() for i in range(m.get_piece_size())]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode([t[1:] for t in texts], num_threads=1)


def packed(ends: np.ndarray, size: int) -> np.ndarray:
    """A bitset of `size` bits in 64-bit words, with those of `ends` set."""
    bits = np.zeros(-(-max(1, size) // 64) * 64, np.uint8)
    bits[ends] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def ranks(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many bits are set before each place."""
    ones = np.bitwise_count(bits)
    before = np.r_[0, np.cumsum(ones, dtype=np.int64)]
    low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
    return before[at >> 6] + np.bitwise_count(bits[at >> 6] & low)


def select(bits: np.ndarray) -> np.ndarray:
    """The places of all bits that are set."""
    return np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))


def cuts_and_links(a_ends: np.ndarray, b_ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the last bytes of the tokens of both sides: rows (byte, tokens of a up to there, of b) of the shared ones, and rows (byte,
    place in a, place in b) of all pairs of tokens that share bytes.

    Where either side ends a token, the two tokens that hold this byte share it; two tokens have one such byte at most.
    """
    a, b = packed(a_ends, size), packed(b_ends, size)
    cuts, met = select(a & b), select(a | b)
    return np.stack([cuts, ranks(a, cuts) + 1, ranks(b, cuts) + 1]), np.stack([met, ranks(a, met), ranks(b, met)])


class Aligner:
    """Aligns texts stretch by stretch: one between two single spaces is encoded and aligned once for all its occurrences."""

    def __init__(self, a: ByteBpe, b: PieceBpe):
        self.a, self.b = a, b
        self.base = len(b.bytes)
        self._key = np.int32 if len(a.bytes) * self.base < 1 << 31 else np.int64
        self._sizes = [np.array([len(x) for x in side.bytes], np.int64) for side in (a, b)]
        self._said = [np.array([f"{i}{mark}" for mark in marks for i in range(len(side.bytes))], object) for side, marks in ((a, ",|"), (b, ",;"))]
        self.forget()

    def forget(self) -> None:
        #: stretch: its number; by number (tokens of a, of b, groups, links), whether both sides spell it, and its groups in writing
        self.known: dict[str, int] = {}
        self.counts, self.spelt, self.told = np.zeros((0, 4), np.int64), np.zeros(0, bool), []
        #: all links, a * base + b, of one stretch after the other
        self.links = np.zeros(0, self._key)

    def _spells(self, side: int, ids: np.ndarray, many: np.ndarray, raw: list[bytes], size: np.ndarray) -> np.ndarray:
        """Whether a side's tokens spell each stretch, byte by byte."""
        entries = (self.a, self.b)[side].bytes
        ends = np.r_[0, np.cumsum(self._sizes[side][ids])][np.r_[0, np.cumsum(many)]]
        joined = b"".join([entries[i] for i in ids.tolist()])
        if joined == b"".join(raw) and (np.diff(ends) == size).all():
            return np.ones(len(raw), bool)
        return np.array([joined[ends[k] : ends[k + 1]] == r for k, r in enumerate(raw)], bool)

    def learn(self, stretches: list[str]) -> None:
        raw, found = [s.encode() for s in stretches], (self.a.encode(stretches), self.b.encode(stretches))
        many = [np.fromiter(map(len, x), np.int64, len(x)) for x in found]
        ids = [np.fromiter(chain.from_iterable(x), np.int64, int(m.sum())) for x, m in zip(found, many, strict=True)]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        spelt = self._spells(0, ids[0], many[0], raw, size) & self._spells(1, ids[1], many[1], raw, size)
        if not spelt.all():
            ids = [x[np.repeat(spelt, m)] for x, m in zip(ids, many, strict=True)]
            many, size = [np.where(spelt, m, 0) for m in many], np.where(spelt, size, 0)
        ends = [self._sizes[k][ids[k]].cumsum() - 1 for k in range(2)]
        (cuts, ca, cb), (met, la, lb) = cuts_and_links(*ends, int(size.sum()))
        last = size.cumsum() - 1
        per = lambda x: np.diff(np.r_[0, np.searchsorted(x, last, side="right")])
        # groups in writing: of each group first the ids of a, then those of b, each with the mark that comes behind it
        at_a, at_b = np.arange(len(ids[0])), np.arange(len(ids[1]))
        ga, gb = np.searchsorted(ca, at_a, side="right"), np.searchsorted(cb, at_b, side="right")
        said = np.empty(len(at_a) + len(at_b), object)
        said[at_a + np.r_[0, cb][ga]] = self._said[0][ids[0] + len(self.a.bytes) * (at_a + 1 == ca[ga])]
        said[at_b + ca[gb]] = self._said[1][ids[1] + len(self.b.bytes) * (at_b + 1 == cb[gb])]
        pieces, stops = said.tolist(), np.r_[0, np.cumsum(many[0] + many[1])].tolist()
        self.told += ["".join(pieces[i:j]) for i, j in zip(stops, stops[1:], strict=False)]
        self.known.update(zip(stretches, range(len(self.known), len(self.known) + len(stretches)), strict=True))
        self.counts = np.concatenate([self.counts, np.stack([*many, per(cuts), per(met)], axis=1)])
        self.spelt = np.concatenate([self.spelt, spelt])
        self.links = np.concatenate([self.links, (ids[0][la] * self.base + ids[1][lb]).astype(self._key)])

    def align(self, texts: Sequence[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """For each text (n_a, n_b, n_groups, n_links) and its groups in writing; and all links with the text that each is from."""
        if len(self.known) > KEPT or len(self.links) > 8 * KEPT:
            self.forget()
        parts = [_STRETCH.split(f" {t}") if t else [] for t in texts]
        new = [s for s in dict.fromkeys(chain.from_iterable(parts)) if s not in self.known]
        for i in range(0, len(new), 1 << 15):
            self.learn(new[i : i + (1 << 15)])
        many = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), np.int64, int(many.sum()))
        of = np.repeat(np.arange(len(texts)), many)
        lost = np.bincount(of[~self.spelt[flat]], minlength=len(texts)) > 0
        flat, of = flat[~lost[of]], of[~lost[of]]
        counts = self.counts[flat]
        totals = np.stack([np.bincount(of, counts[:, k], len(texts)) for k in range(4)], axis=1).astype(np.int64)
        told, stops = self.told, np.searchsorted(of, np.arange(len(texts) + 1)).tolist()
        codes = flat.tolist()
        written = ["".join([told[c] for c in codes[i:j]])[:-1] for i, j in zip(stops, stops[1:], strict=False)]
        size, starts = counts[:, 3], (np.cumsum(self.counts[:, 3]) - self.counts[:, 3])[flat]
        at = np.arange(int(size.sum())) + np.repeat(starts - (np.cumsum(size) - size), size)
        return totals, written, self.links[at], np.repeat(np.arange(len(texts)), totals[:, 3])


@functools.lru_cache(maxsize=2)
def aligner(byte_bpe: str, piece_bpe: str) -> Aligner:
    """One for each process, whose tasks share what it knows."""
    return Aligner(ByteBpe(byte_bpe), PieceBpe(piece_bpe))


def _portions(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, list[str | None], int]]:
    """Ids, texts and bytes of stretches of rows, which end after `most` bytes."""
    for b in batches:
        texts, start, size = b.column(1).to_pylist(), 0, 0
        for i, t in enumerate(texts):
            size += len((t or "").encode())
            if size >= most or i + 1 == len(texts):
                yield b.column(0).slice(start, i + 1 - start), texts[start : i + 1], size
                start, size = i + 1, 0


_DOC = "block long, id {}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<int>, times array<int>, pairs array<long>, docs array<int>"


def _encode(batches: Iterator[pa.RecordBatch], byte_bpe: str, piece_bpe: str, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, text) to rows with a text's counts and its distinct links as local numbers; and one for each block, with what
    the numbers mean and how many of its documents have each pair.
    """
    of, task, seq, held = aligner(byte_bpe, piece_bpe), TaskContext.get().partitionId(), count(), 0
    block, local, docs = task << 32 | next(seq), {}, np.zeros(0, np.int64)
    ints = pa.list_(pa.int32())
    kind: pa.DataType = pa.int64()

    def meaning() -> pa.RecordBatch:
        one = lambda t: pa.nulls(1, t)
        row = [pa.array([block]), one(kind), *[one(pa.int64())] * 4, one(pa.string()), one(ints), one(ints), pa.array([list(local)], pa.list_(pa.int64())), pa.array([docs[: len(local)]], ints)]
        return pa.RecordBatch.from_arrays(row, names=_NAMES)

    for ids, texts, size in _portions(batches, BATCH_BYTES):
        kind = ids.type
        totals, told, links, source = of.align(texts)
        key, at = np.unique(links, return_inverse=True)
        numbers = np.fromiter((local.setdefault(k, len(local)) for k in key.tolist()), np.int64, len(key))
        each, times = np.unique(source.astype(np.int64) << 32 | numbers[at], return_counts=True)
        own, of_doc = (each & 0xFFFFFFFF).astype(np.int32), each >> 32
        docs = np.pad(docs, (0, max(0, len(local) - len(docs)))) + np.bincount(own, minlength=len(local))
        offsets = pa.array(np.searchsorted(of_doc, np.arange(len(texts) + 1)), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (own, times)]
        digests = pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in told])
        n = len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), ids, *(pa.array(totals[:, i]) for i in range(4)), digests, *lists, pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, ints)], names=_NAMES)
        held += size
        if held >= block_bytes:
            yield meaning()
            block, local, docs, held = task << 32 | next(seq), {}, np.zeros(0, np.int64), 0
    if local:
        yield meaning()


_NAMES = [c.split()[0] for c in _DOC.split(", ")]


def _weigh(docs: pa.Table, known: pa.Table) -> pa.Table:
    """A block's documents and the corpus-wide counts of its pairs to n_best and count_sum of each document."""
    local = known["local"].to_numpy()
    counts, best = np.zeros(int(local.max(initial=-1)) + 1, np.int64), np.zeros(int(local.max(initial=-1)) + 1, np.int64)
    counts[local], best[local] = known["n"].to_numpy(), known["best"].to_numpy()
    links, times = (docs[c].combine_chunks() for c in ("links", "times"))
    flat, many = links.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    ends = np.r_[0, np.cumsum(links.value_lengths().to_numpy())]
    total = lambda v: np.diff(np.r_[0, np.cumsum(v[flat] * many)][ends]) if docs.num_rows else _NONE
    kept = docs.select(["id", "n_a", "n_b", "n_groups", "n_links"])
    return kept.append_column("n_best", pa.array(total(best), pa.int64())).append_column("count_sum", pa.array(total(counts), pa.int64())).append_column("groups_sha256", docs["groups_sha256"])


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_bpe: str = f"{FOLDER}/{BYTE_BPE}", piece_bpe: str = f"{FOLDER}/{PIECE_BPE}", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of docs.

    Space+text is encoded by a byte-level BPE (a) and a piece BPE (b); the paths of their files are on every executor. Bytes
    where both end a token cut the text into groups; tokens whose bytes overlap are linked. A pair of ids counts once for
    each document of the corpus that has it linked. n_best: links whose count is the greatest of their a id.

    Packed bitsets mark the ends of tokens: their AND are the cuts, ranks at the cuts the tokens of a group, and ranks at their OR the
    links. A stretch between two single spaces is aligned once. Each block of documents numbers its own pairs; only these, with their
    counts, are shuffled, and the corpus's counts come back to the block. The best count of each a id is broadcast: it has no
    more rows than the vocabulary.

    Texts that are null, empty or that one side's tokens do not spell have zeros and an empty groups_sha256. Very long texts are encoded
    whole, repeated rows give repeated rows and count as documents of their own, null ids are kept, an empty table gives an empty result;
    other columns are not looked at.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    level = stored(rows.mapInArrow(lambda it: _encode(it, byte_bpe, piece_bpe, block_bytes), _DOC.format(rows.schema[0].dataType.simpleString())))
    meant = level.where("pairs IS NOT NULL").select("block", "pairs", "docs")
    n = partitions(docs.sparkSession, meant.agg(F.coalesce(F.sum(F.size("pairs").cast("long")), F.lit(0))).first()[0], 1 << 20)
    base = PieceBpe(piece_bpe).bytes
    places = meant.select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("local", "at")).select("block", "local", F.col("at.pairs").alias("pair"), "at.docs")
    counted = stored(places.repartition(n, "pair").selectExpr("block", "local", f"cast(pair div {len(base)} as int) AS a", "sum(docs) OVER (PARTITION BY pair) AS n"))
    most = counted.groupBy("a").agg(F.max("n").alias("most"))
    known = counted.join(F.broadcast(most), "a").select("block", "local", "n", (F.col("n") == F.col("most")).cast("int").alias("best"))
    told = level.where("pairs IS NULL").drop("pairs", "docs").groupBy("block").cogroup(known.groupBy("block"))
    kind = rows.schema[0].dataType.simpleString()
    return told.applyInArrow(_weigh, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
