"""Byte-level BPE: encoding by a contiguous rank array, and decoding.

A word is held as a list of part ids together with the list of the ranks of
adjacent parts.  Each step scans the ranks for the minimum, replaces the two
parts by their merge (which deletes one boundary) and refreshes the two
neighbouring ranks.  The scan is quadratic in the word's length, which is the
cheapest form for the short words that make up nearly all text; a word above
``LONG_WORD`` bytes (a run of one kind of character) uses a heap with the same
order of merges, so that it costs n log n.

A text is cut before every blank that precedes a non-blank: the split pattern
never joins characters across such a place, so the pieces encode
independently, and a bounded per-worker memo holds the pieces seen before.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from kpiloom.llm.common import text_of

# Fixed value: the split pattern of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_WORD = 256
MEMO = 250_000
NEVER = 1 << 40
_OPENS = frozenset(" abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_CUT = re.compile(r"(?= \S)")
_BLANKS = re.compile(r" (?:\s|\Z)")


def byte_letters() -> dict[str, int]:
    """The vocabulary's letter for each byte: printable Latin-1 stands for itself, the rest follows from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}



class _Memo(dict):
    """Pieces seen by this worker.  When ``MEMO`` of them are held they become the older half, and those that
    are met again move back: frequent pieces stay, memory is bounded."""

    def __init__(self, make, prefix: str):
        super().__init__()
        self.make, self.prefix, self.older = make, prefix, {}

    def __missing__(self, piece: str):
        out = self.older.get(piece)
        if out is None:
            out = self.make(self.prefix + piece)
        if len(piece) <= 64:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            self[piece] = out
        return out


class ByteBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError(f"{path} is not a byte-level BPE without normalisation")
        letters, vocab = byte_letters(), model["vocab"]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.piece_bytes = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if t not in added}
        self.piece_bytes |= {i: t.encode() for t, i in added.items()}
        self.byte_id = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merged = [vocab[a + b] for a, b in pairs]
        self.rank = {vocab[a] << 24 | vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self.byte_pairs = [self.rank.get(a << 24 | b, NEVER) for a in self.byte_id for b in self.byte_id]
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.added, self.added_plain = added, tuple(added)
        self.words = regex.compile(PATTERN)
        self.decimal = {i: str(i) for i in self.piece_bytes}
        self.after_blank, self.at_start = _Memo(self._piece, " "), _Memo(self._piece, "")

    # -- one word ---------------------------------------------------------
    def word(self, data: bytes) -> list[int]:
        parts = list(map(self.byte_id.__getitem__, data))
        if len(parts) > LONG_WORD:
            return self._long_word(parts)
        get, merged = self.rank.get, self.merged
        pairs = self.byte_pairs
        ranks = [pairs[a << 8 | b] for a, b in zip(data, data[1:])]
        while ranks:
            least = min(ranks)
            if least == NEVER:
                break
            i = ranks.index(least)
            parts[i] = merged[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] << 24 | parts[i], NEVER)
            if i < len(ranks):
                ranks[i] = get(parts[i] << 24 | parts[i + 1], NEVER)
        return parts

    def _long_word(self, parts: list[int]) -> list[int]:
        n, get = len(parts), self.rank.get
        left, right, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        heap = [(r, i) for i in range(n - 1) if (r := get(parts[i] << 24 | parts[i + 1], NEVER)) != NEVER]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = right[i] if alive[i] else n
            if j >= n or get(parts[i] << 24 | parts[j], NEVER) != r:
                continue
            parts[i], alive[j], right[i] = self.merged[r], False, right[j]
            if right[i] < n:
                left[right[i]] = i
                if (s := get(parts[i] << 24 | parts[right[i]], NEVER)) != NEVER:
                    heapq.heappush(heap, (s, i))
            if left[i] >= 0 and (s := get(parts[left[i]] << 24 | parts[i], NEVER)) != NEVER:
                heapq.heappush(heap, (s, left[i]))
        return [p for p, ok in zip(parts, alive) if ok]

    # -- whole texts ------------------------------------------------------
    def _piece(self, piece: str) -> tuple[bytes, int]:
        if piece[1:].isalpha() and piece[0] in _OPENS:  # a blank and letters: one word of the pattern
            ids = self.word(piece.encode())
        else:
            ids = []
            for w in self.words.findall(piece):
                ids += self.word(w.encode())
        return struct.pack(f"<{len(ids)}I", *ids), len(ids)

    def _plain(self, text: str) -> list[tuple[bytes, int]]:
        if not text:
            return []
        if _BLANKS.search(text):
            blank, start = self.after_blank, self.at_start
            return [blank[p[1:]] if p[0] == " " and len(p) > 1 and not p[1].isspace() else start[p] for p in _CUT.split(text) if p]
        head, *rest = text.split(" ")
        out = list(map(self.after_blank.__getitem__, rest))
        if head:
            out.insert(0, self.at_start[head])
        return out

    def pieces(self, text: str) -> list[tuple[bytes, int]]:
        """The text's pieces in order; special strings inside it become their ids, as the tokenizer's default is."""
        if self.special is None or not any(t in text for t in self.added_plain):
            return self._plain(text)
        out = []
        for part in self.special.split(text):
            out += [(np.array([self.added[part]], dtype="<u4").tobytes(), 1)] if part in self.added else self._plain(part)
        return out

    def encode_bytes(self, text: str) -> bytes:
        return b"".join([p[0] for p in self.pieces(text)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), dtype="<u4").tolist()

    def count(self, text: str) -> int:
        return sum([p[1] for p in self.pieces(text)])

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.piece_bytes.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def load(path: str) -> ByteBPE:
    """One encoder per Python worker; its memo lives as long as the worker."""
    return ByteBPE(path)


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>): a narrow map over the texts, no shuffle.  A null or empty text has no ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for b in batches:
            yield pd.DataFrame({key: b[key], "ids": [np.frombuffer(bpe.encode_bytes(t), dtype="<u4").astype("i4") for t in b[text]]})

    src = text_of(docs, key, text)
    return src.mapInPandas(run, f"`{key}` {src.schema[key].dataType.simpleString()}, ids array<int>")


def decode_ids(tokens: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) from (key, ids); a null list of ids is the empty text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for b in batches:
            yield pd.DataFrame({key: b[key], "text": [bpe.decode(list(x) if x is not None else []) for x in b[ids]]})

    src = tokens.select(key, ids)
    return src.mapInPandas(run, f"`{key}` {src.schema[key].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, then decode the ids: (key, n_tokens, ids_sha256, decoded_sha256), one narrow pass over the texts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        sha, decimal = hashlib.sha256, bpe.decimal
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for t in b[text]:
                ids = bpe.encode(t)
                n.append(len(ids))
                ids_sha.append(sha(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                text_sha.append(sha(bpe.decode(ids).encode()).hexdigest())
            yield pd.DataFrame({key: b[key], "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": text_sha})

    src = text_of(docs, key, text)
    return src.mapInPandas(run, f"`{key}` {src.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
