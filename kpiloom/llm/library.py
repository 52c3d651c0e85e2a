"""Ids of whole texts by a public library, for the operators that only need the tokens.

The vocabulary of a byte-level BPE whose merges are listed in the order of
their ids is the same thing as a table of ranks, which tiktoken encodes several
times faster than the tokenizers library does, with equal ids.  Other
vocabularies, and texts with so long a run of one kind that the library's
pattern matcher could give up, take the encoder of ``bpe``.
"""

from __future__ import annotations

import functools
import re

import numpy as np

from kpiloom.llm import bpe

LONG_RUN = 20_000
_RUN = re.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")
STOPS = (".", "!", "?", "…", "。")


class WholeTexts:
    def __init__(self, path: str):
        self.own = own = bpe.load(path)
        ranked = sorted(own.byte_id) == list(range(256)) and own.merged == list(range(256, 256 + len(own.merged)))
        self.fast = None
        if ranked:
            import tiktoken
            plain = {b: i for i, b in own.piece_bytes.items() if i not in own.added.values()}
            self.fast = tiktoken.Encoding("ranks", pat_str=bpe.PATTERN, mergeable_ranks=plain, special_tokens=own.added)
        self.ends_sentence = np.zeros(max(own.piece_bytes) + 1, bool)
        for i, b in own.piece_bytes.items():
            t = b.decode("utf-8", "ignore")
            self.ends_sentence[i] = t.endswith(STOPS) or "\n" in t or i in own.added.values()

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or len(text) > LONG_RUN and _RUN.search(text):
            return np.frombuffer(self.own.encode_bytes(text), dtype="<u4")
        return np.array(self.fast.encode(text, allowed_special="all", disallowed_special=()), dtype="<u4")

    def plain_ids(self, text: str) -> np.ndarray:
        """Ids with special strings inside the text taken as ordinary text."""
        if self.fast is None or len(text) > LONG_RUN and _RUN.search(text):
            return np.frombuffer(b"".join([p[0] for p in self.own._plain(text)]), dtype="<u4")
        return self.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=())

    def count(self, text: str) -> int:
        return len(self.ids(text))


@functools.lru_cache(maxsize=4)
def load(path: str) -> WholeTexts:
    return WholeTexts(path)
