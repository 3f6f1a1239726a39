"""Exact byte-pair encoding by dynamic programming over prefixes.

For every prefix of a piece there is exactly one last token of its encoding. All
vocabulary entries that end at a position come from one pass of a suffix-matching
automaton; an entry may be the last token if it starts the piece, or if it is
compatible with the last token of the prefix before it, that is if merging the
two side by side would not have chosen another split. Following the stored last
tokens back from the end yields the ids. The work is linear in the piece for a
vocabulary of bounded entry length, whereas merging pairs rescans the piece.

Texts are cut into pieces by the vocabulary's own pattern; most pieces repeat,
so each worker keeps the ids of the pieces it met in a bounded table.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from loomgraph.session import spread

#: The vocabulary's splitting pattern (public, of the byte-level BPE).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Pieces kept by a worker; beyond it the table starts anew. Results do not depend on it.
PIECES_KEPT = 200_000
NO_ID = -1


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file: printable
    bytes stand for themselves, the others follow from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PrefixEncoder:
    """Encoder of one vocabulary (a JSON file with ``model.vocab`` and ``model.merges``)."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        back = {letter: chr(b) for b, letter in enumerate(byte_letters())}
        raw = lambda s: "".join(back[c] for c in s)  # noqa: E731  one char per byte
        vocab = {raw(k): v for k, v in model["vocab"].items() if all(c in back for c in k)}
        size = max(vocab.values()) + 1
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(size)]
        self.rank = list(range(size))
        self.merged: dict[tuple[int, int], int] = {}
        single = {v for k, v in vocab.items() if len(k) == 1}
        for order, merge in enumerate(model["merges"]):
            a, b = (raw(x) for x in (merge if isinstance(merge, list) else merge.split(" ")))
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.merged[left, right] = whole
            self.parts[whole] = (left, right)
            self.rank[whole] = order
        for token in single:
            self.rank[token] = -1
        self.find = regex.compile(PATTERN).findall
        self.compatible = lru_cache(1 << 18)(self._compatible)
        #: Entries that merging really produces from their own bytes.
        self.matcher = ahocorasick.Automaton()
        for text, token in vocab.items():
            if token in single or self._stands(token):
                self.matcher.add_word(text, (token, len(text)))
        self.matcher.make_automaton()
        self.pieces: dict[str, list[int]] = {}

    def _stands(self, token: int) -> bool:
        left, right = self.parts[token]
        return left != token and self._compatible(left, right, token)

    def _compatible(self, left: int, right: int, below: int = -1) -> bool:
        """Would merging leave ``left`` and ``right`` side by side? Undo the
        merges of both, latest first; if at any stage the two tokens at the seam
        could merge earlier than the merge undone last, they would have."""
        rank, parts = self.rank, self.parts
        limit = rank[below] if below >= 0 else len(rank)
        while True:
            joint = self.merged.get((left, right))
            if joint is not None and rank[joint] < limit:
                return False
            if rank[left] > rank[right]:
                limit, left = rank[left], parts[left][1]
            elif rank[right] >= 0:
                # on equal ranks the left copy merges first, so the right one is undone last
                limit, right = rank[right] + 1, parts[right][0]
            else:
                return True

    def piece_ids(self, piece: str) -> list[int]:
        data = piece.encode("utf-8").decode("latin-1")
        last: list[tuple[int, int] | None] = [None] * (len(data) + 1)
        compatible = self.compatible
        for end, (token, length) in self.matcher.iter(data):
            end += 1
            if last[end] is None:
                start = end - length
                if start == 0 or (last[start] is not None and compatible(last[start][0], token)):
                    last[end] = (token, length)
        ids, at = [], len(data)
        while at:
            token, length = last[at]
            ids.append(token)
            at -= length
        return ids[::-1]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text without special tokens; [] for null and for the empty text."""
        if not text:
            return []
        pieces = _Pieces.of(self)
        return list(chain.from_iterable(map(pieces.__getitem__, self.find(text))))


class _Pieces(dict):
    """piece -> ids, filled on demand and emptied when it holds PIECES_KEPT."""

    encoder: PrefixEncoder

    @classmethod
    def of(cls, encoder: PrefixEncoder) -> "_Pieces":
        if not isinstance(encoder.pieces, cls):
            encoder.pieces = cls()
            encoder.pieces.encoder = encoder
        return encoder.pieces

    def __missing__(self, piece: str) -> list[int]:
        ids = self.encoder.piece_ids(piece)
        if len(piece) <= 64:
            if len(self) >= PIECES_KEPT:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(4)
def encoder(path: str) -> PrefixEncoder:
    """The encoder of a worker process, built once."""
    return PrefixEncoder(path)


def default_vocabulary() -> str:
    return os.environ.get("LOOMGRAPH_VOCABULARY", DEFAULT_VOCABULARY)


def encode_column(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """(key, ids array<int>): the ids of each row's whole text.

    Null and empty texts get the empty list, blank ones the ids of their spaces.
    A text that spells a special token is ordinary text. Other columns are not
    read. Repeated rows are encoded each; an empty table gives no rows.
    """
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                offsets, flat = [0], []
                for t in part.column(1):
                    flat += encode(t.as_py())
                    offsets.append(len(flat))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[key, "ids"])

    kind = df.select(f"`{key}`").schema[0].dataType.simpleString()
    return spread(df.select(f"`{key}`", f"`{text}`"), key).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def token_counts(df: DataFrame, keep: list[str], text: str, path: str | None = None) -> DataFrame:
    """The columns ``keep`` and n_tokens bigint of each row's whole text."""
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            counts = [len(encode(t.as_py())) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64())], names=[*keep, "n_tokens"])

    src = df.select(*[f"`{c}`" for c in keep], f"`{text}`")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return spread(src, keep[0]).mapInArrow(run, f"{ddl}, n_tokens bigint")
