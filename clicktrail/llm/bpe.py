"""Byte-level BPE without merging: longest matches of an Aho-Corasick automaton, stepped back where they don't fit.

A sequence of tokens is what the merges give exactly if every two neighbours are what the merges
give for their joined bytes.  The encoder goes from left to right with the longest token at each
place, tries shorter ones while the pair with the token before is not compatible, and steps back when
none is; places from which nothing continues are closed, so each is left once.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.words import chunks

# Fixed value: the pattern by which byte-level tokenizers split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECES_KEPT = 70_000  # encoded pieces that a Python worker remembers, and as many from before
PAIRS_KEPT = 200_000  # entries of the pair table at a time
DECODED_AT_ONCE = 1 << 16
CHUNK_BYTES = 1 << 20  # text encoded at a time


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it can be seen, else the next from U+0100 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (chr(256 + i) for i in range(256))
    return [chr(b) if b in seen else next(hidden) for b in range(256)]


def _read(path: str) -> tuple[dict, dict[str, int], dict[str, int], int]:
    """The model, the ids of tokens (as Latin-1) and of special tokens, and the number of ids of a vocabulary file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = {ord(c): b for b, c in enumerate(byte_letters())}
    vocab = {k.translate(letters): v for k, v in spec["model"]["vocab"].items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return spec["model"], vocab, special, 1 + max([*vocab.values(), *special.values()])


class Decoder:
    """The bytes of all tokens in one table, and where each begins."""

    def __init__(self, path: str):
        _, vocab, special, size = _read(path)
        stored = [b""] * size
        for s, i in vocab.items():
            stored[i] = s.encode("latin-1")
        for s, i in special.items():
            stored[i] = s.encode()
        self.bytes = np.frombuffer(b"".join(stored), np.uint8)
        self.offset = np.concatenate(([0], np.cumsum([len(s) for s in stored])))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        parts = []
        for k in range(0, len(ids), DECODED_AT_ONCE):
            some = ids[k : k + DECODED_AT_ONCE]
            start = self.offset[some]
            size = self.offset[some + 1] - start
            ends = np.cumsum(size)
            parts.append(self.bytes[np.repeat(start - (ends - size), size) + np.arange(ends[-1])].tobytes())
        return b"".join(parts).decode("utf-8", "replace")


class Encoder:
    """The tokens of one vocabulary file; bytes are handled as Latin-1 strings."""

    def __init__(self, path: str):
        model, vocab, self.special, size = _read(path)
        letters = {ord(c): b for b, c in enumerate(byte_letters())}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(vocab[a.translate(letters)], vocab[b.translate(letters)]): i for i, (a, b) in enumerate(pairs)}
        self.joined = {k: vocab[(pairs[i][0] + pairs[i][1]).translate(letters)] for k, i in self.rank.items()}
        self.single = {s: i for s, i in vocab.items() if len(s) == 1}
        self.vocab = vocab
        self.name = [""] * size
        for s, i in vocab.items():
            self.name[i] = s
        self.length = [len(s) for s in self.name]
        self.widest = max(self.length)
        # When each token is made, and of which two; single bytes are there from the start.
        self.made, self.parts = [-1] * size, [(-1, -1)] * size
        for pair, i in self.rank.items():
            token = self.joined[pair]
            if self.made[token] < 0:
                self.made[token], self.parts[token] = i, pair
        # The longest token that a token begins with, other than itself.
        self.shorter = [-1] * size
        self.automaton = ahocorasick.Automaton()
        for s, i in vocab.items():
            self.automaton.add_word(s, i)
            self.shorter[i] = next((vocab[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in vocab), -1)
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.before: dict[str, tuple[int, ...]] = {}
        self.pattern = regex.compile(PATTERN)
        self.stops = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def merged(self, s: str) -> list[int]:
        """The merges as they are defined: the pair of lowest rank first, the leftmost of equals."""
        parts = [self.single[c] for c in s]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 40))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best : best + 2] = [self.joined[parts[best], parts[best + 1]]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges of the joined bytes of two tokens end with these two.

        Ranks are times: a token is made after its parts.  Going back in time from the end, the two pieces
        beside the seam must never be a pair that would merge before either of them is used up.
        """
        fits = self.fits.get((a, b))
        if fits is not None:
            return fits
        x, y, used_x, used_y = a, b, 1 << 40, 1 << 40
        fits = True
        while fits:
            rank = self.rank.get((x, y))
            if rank is not None and rank < used_x and rank <= used_y:
                fits = False
            elif self.made[x] > self.made[y]:
                used_x, x = self.made[x], self.parts[x][1]
            elif self.made[y] >= 0:
                used_y, y = self.made[y], self.parts[y][0]
            else:
                break
        if len(self.fits) > PAIRS_KEPT:
            self.fits.clear()
        self.fits[a, b] = fits
        return fits

    def longest(self, s: str, at: int) -> int:
        """The longest token at a place: the automaton's path from there, cut back to a token."""
        s = s[at : at + self.widest]
        size = self.automaton.longest_prefix(s)
        while (token := self.vocab.get(s[:size])) is None:
            size -= 1
        return token

    def encode_piece(self, s: str) -> list[int]:
        whole = self.vocab.get(s)
        if whole is not None:
            return [whole]
        # Longest matches one after another, as long as neighbours fit.
        fits, out, at = self.fits, [], 0
        for end, token in self.automaton.iter_long(s):
            if out and not (fits[pair] if (pair := (out[-1], token)) in fits else self.compatible(*pair)):
                break
            out.append(token)
            at = end + 1
        else:
            return out
        length, shorter = self.length, self.shorter
        open_ = bytearray(b"\1") * (len(s) + 1)
        while True:
            while token >= 0 and not (open_[at + length[token]] and (not out or self.compatible(out[-1], token))):
                token = shorter[token]
            if token < 0:
                open_[at] = 0
                token = out.pop()
                at -= length[token]
                token = shorter[token]
                continue
            out.append(token)
            at += length[token]
            if at == len(s):
                return out
            token = self.longest(s, at)

    def encode(self, text: str) -> list[int]:
        """The ids of a text; special tokens written in it are those tokens."""
        out: list[int] = []
        known = self.known
        for part in self.stops.split(text) if self.stops and any(s in text for s in self.special) else [text]:
            if part in self.special:
                out.append(self.special[part])
                continue
            for piece in self.pattern.findall(part):
                ids = known.get(piece)
                if ids is None:
                    ids = self.before.get(piece) or tuple(self.encode_piece(piece.encode().decode("latin-1")))
                    if len(piece) <= 64:
                        known[piece] = ids
                    if len(known) >= PIECES_KEPT:  # what is met again moves on from the pieces before
                        self.before, self.known = known, {}
                        known = self.known
                out += ids
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(path)


@lru_cache(maxsize=1)
def decoder(path: str) -> Decoder:
    """One for each Python worker."""
    return Decoder(path)


def encode_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every row of ``docs``.

    Null and empty texts have no ids.  Repeated rows are each encoded; other columns are not read.  The
    vocabulary file must be at the same path on every executor.
    """
    path = vocabulary or default_vocabulary()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in chunks(batches, "text", CHUNK_BYTES):
            ids = [bpe.encode(t) if t else [] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encoded, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, ids and the decoded ``text`` of every row of ``encoded``; null ids give an empty text."""
    path = vocabulary or default_vocabulary()

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = decoder(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                ids = part.column("ids")
                texts = [bpe.decode(x.values.to_numpy(zero_copy_only=False).astype(np.int64)) if x.is_valid else "" for x in ids]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, ids and the ``text`` that they decode to, of every row of ``docs``; one Python worker does both."""
    path = vocabulary or default_vocabulary()

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there, back = encoder(path), decoder(path)
        for batch in chunks(batches, "text", CHUNK_BYTES):
            ids = [np.array(there.encode(t) if t else [], np.int32) for t in batch.column("text").to_pylist()]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))
            texts = pa.array([back.decode(x) if len(x) else "" for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, texts], names=["doc_id", "ids", "text"])

    return docs.select("doc_id", "text").mapInArrow(both, "doc_id long, ids array<int>, text string")


def digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded and decoded again, of every row of ``docs``."""
    return round_trip(docs, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def plain_digest(ids: list[int], text: str) -> tuple[int, str, str]:
    """What :func:`digests` returns for one document."""
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
