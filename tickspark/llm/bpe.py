"""BPE with word ends: encoding by forced boundaries, and decoding."""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Remembered, per_process

CACHE_ENTRIES = 200_000
WORD_END = "</w>"
# White space that str.split() knows and the tokenizer's \s doesn't.
SEPARATORS = "\x1c\x1d\x1e\x1f"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {b: chr(b) for b in own}
    spare = (chr(256 + i) for i in range(256 - len(own)))
    return [letters[b] if b in letters else next(spare) for b in range(256)]


class Tokenizer:
    """Reads a tokenizers JSON file of the kind of ``word_bpe_49k.json`` and encodes as that library does.

    A pair of neighbouring bytes that no vocabulary token has inside can never be merged over. Words
    are cut at every such pair, the fragments are merged on their own, and their ids concatenated.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["end_of_word_suffix"] != WORD_END or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
            raise ValueError(f"{path}: another kind of tokenizer")
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (*self.vocab.items(), *self.special.items())}
        self.words = regex.compile(steps[0]["pattern"]["Regex"])
        self.blank = regex.compile(r"\s+")
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self.letters = byte_letters()
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            self.merges[self.vocab[a], self.vocab[b]] = rank, self.vocab[a + b]
        self.inside = {p for token in self.vocab for p in self.inner_pairs(token)}
        self.fragments = Remembered(self.merge, CACHE_ENTRIES)
        self.chunks = Remembered(self.chunk, CACHE_ENTRIES)

    @staticmethod
    def inner_pairs(token: str) -> Iterator[str]:
        """Pairs of neighbouring letters in a token; the mark of a word's end belongs to its last letter."""
        body = token.removesuffix(WORD_END) if token != WORD_END else token
        yield from (body[i : i + 2] for i in range(len(body) - 2))
        if len(body) > 1:
            yield body[-2:] + token[len(body) :]

    def cut(self, spelled: str) -> list[str]:
        """Fragments of a spelled word between forced boundaries, the last with the mark of the word's end."""
        out, start, inside = [], 0, self.inside
        for i in range(1, len(spelled) - 1):
            if spelled[i - 1 : i + 1] not in inside:
                out.append(spelled[start:i])
                start = i
        if len(spelled) > 1 and spelled[-2:] + WORD_END not in inside:
            out.append(spelled[start:-1])
            start = len(spelled) - 1
        out.append(spelled[start:] + WORD_END)
        return out

    def merge(self, fragment: str) -> list[int]:
        """Ids of a fragment: always the pair of the lowest rank next, the leftmost of its like."""
        body = fragment.removesuffix(WORD_END)
        symbols = [*body[:-1], body[-1] + fragment[len(body) :]]
        ids = [self.vocab[s] for s in symbols if s in self.vocab]
        after = list(range(1, len(ids))) + [-1]
        before = list(range(-1, len(ids) - 1))
        queue: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            found = self.merges.get((ids[i], ids[after[i]])) if i >= 0 and after[i] >= 0 else None
            if found:
                heapq.heappush(queue, (found[0], i, found[1]))

        for i in range(len(ids)):
            offer(i)
        while queue:
            rank, i, made = heapq.heappop(queue)
            j = after[i]
            if ids[i] < 0 or j < 0 or self.merges.get((ids[i], ids[j])) != (rank, made):
                continue
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def chunk(self, raw: str) -> bytes:
        """Ids (little-endian, 4 bytes each) of a piece of text without white space or special tokens."""
        ids: list[int] = []
        text = raw.lower()
        if not raw.isascii():  # sigma has one small form here
            text = unicodedata.normalize("NFC", raw).replace("Σ", "σ").lower()
        for word in self.words.findall(text):
            spelled = word if word.isascii() and word.isprintable() else "".join([self.letters[b] for b in word.encode()])
            for fragment in self.cut(spelled):
                ids += self.fragments[fragment]
        return array("I", ids).tobytes()

    def plain(self, text: str) -> Iterator[bytes]:
        pieces = self.blank.split(text) if any(c in text for c in SEPARATORS) else text.split()
        return map(self.chunks.__getitem__, pieces)

    def encode(self, text: str) -> array:
        """Ids of a whole text; special tokens are recognised as written."""
        if "<|" not in text:
            parts = list(self.plain(text))
        else:
            parts, at = [], 0
            for m in self.marks.finditer(text):
                parts += self.plain(text[at : m.start()])
                parts.append(array("I", [self.special[m[0]]]).tobytes())
                at = m.end()
            parts += self.plain(text[at:])
        ids = array("I")
        ids.frombytes(b"".join(parts))
        return ids

    def decode(self, ids) -> str:
        """Tokens as the vocabulary writes them, separated by spaces: the file names no decoder."""
        return " ".join(map(self.names.__getitem__, ids))


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, with what it remembers, once for each process."""
    return per_process(f"bpe:{path}", lambda: Tokenizer(path))


def default_path() -> str:
    """Where the installed vocabulary lies; each executor asks its own installation."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _field(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) for every row; a null text is empty and has no ids."""

    def run(batches):
        tok = tokenizer(path or default_path())
        for b in batches:
            ids, ends = array("I"), array("i", [0])
            for t in _field(b, text_col):
                ids.extend(tok.encode(t.as_py() or ""))
                ends.append(len(ids))
            values = pa.array(np.frombuffer(ids, dtype=np.uint32).astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(np.frombuffer(ends, dtype=np.int32)), values)
            yield pa.RecordBatch.from_arrays([_field(b, id_col), lists], [id_col, "ids"])

    slim = docs.select(id_col, text_col)
    return slim.mapInArrow(run, f"`{id_col}` {dict(slim.dtypes)[id_col]}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """(id, decoded) of rows with an ``ids`` array; null ids decode to the empty text."""

    def run(batches):
        tok = tokenizer(path or default_path())
        for b in batches:
            texts = [tok.decode(x or []) for x in _field(b, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([_field(b, id_col), pa.array(texts, pa.string())], [id_col, "decoded"])

    slim = encoded.select(id_col, "ids")
    return slim.mapInArrow(run, f"`{id_col}` {dict(slim.dtypes)[id_col]}, decoded string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Round trip of every whole text: (doc_id, n_tokens, ids_sha256, decoded_sha256).

    Encodes and decodes in one pass, so that ids needn't travel. Null texts are empty, repeated rows
    stay, no rows give no rows; ids may be null.
    """

    def run(batches):
        tok = tokenizer(path or default_path())
        for b in batches:
            counts, ids_sums, text_sums = [], [], []
            for t in _field(b, "text"):
                ids = tok.encode(t.as_py() or "")
                counts.append(len(ids))
                ids_sums.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_sums.append(hashlib.sha256(tok.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [_field(b, "doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sums, pa.string()), pa.array(text_sums, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    slim = docs.select("doc_id", "text")
    kind = dict(slim.dtypes)["doc_id"]
    return slim.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
