"""Byte-level BPE by monoid tree reduction.

A text is halved down to leaves; two encoded neighbours are joined by encoding a window around their
border anew. The window grows until both its ends are *safe cuts*: a blank or line feed after a character
that is no white space. No alternative of the pre-tokeniser matches white space after anything else, so a
match always begins at a safe cut, in any context, and the tokens outside the window can't change. Where a
half holds no safe cut the window takes the whole half, which is right whatever the text. Joining is
associative, so the shape of the tree (and the leaf size) has no effect on the ids. Decoding concatenates
byte strings up the same kind of tree.

Null texts are empty: no ids, the hashes of nothing. Any length works; memory is that of one text.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from functools import lru_cache

import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from corpusengine.llm import _common as c

LEAF, WINDOW = 4096, 32
_CUT = re.compile(r"(?<=\S)[ \n]")


class Codec:
    """One vocabulary of byte-level BPE: ids of a text and back. added: tokens that stand for themselves, by their content."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF, added: dict[str, int] | None = None):
        self._core = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._added = {k: i for k, i in (added or {}).items() if k}
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(self._added, key=len, reverse=True))) + ")")
        self._bytes = [b""] * (max([*ranks.values(), *self._added.values()]) + 1)
        for token, rank in [*ranks.items(), *((k.encode(), i) for k, i in self._added.items())]:
            self._bytes[rank] = token
        self._size = [len(x) for x in self._bytes]
        self.names = [str(i) for i in range(len(self._bytes))]
        self.leaf = max(2, leaf)

    def encode(self, text: str) -> list[int]:
        return self._node(text, 0, len(text)) if text else []

    def encode_added(self, text: str) -> list[int]:
        """As the library with its default settings: an added token in the text is its id, the parts between are encoded each."""
        if not any(k in text for k in self._added):
            return self.encode(text)
        return [i for k, part in enumerate(self._split.split(text)) for i in ([self._added[part]] if k % 2 else self.encode(part))]

    def _node(self, text: str, lo: int, hi: int) -> list[int]:
        if hi - lo <= self.leaf:
            return self._core.encode_ordinary(text[lo:hi])
        mid = (lo + hi) // 2
        return self._join(self._node(text, lo, mid), self._node(text, mid, hi), text, lo, mid, hi)

    def _join(self, left: list[int], right: list[int], text: str, lo: int, mid: int, hi: int) -> list[int]:
        width = WINDOW
        p, q = None, None
        while p is None or q is None:
            if p is None:
                found = _CUT.search(text, max(lo, mid - width), mid)
                p = found.start() if found and found.start() > lo else lo if mid - width <= lo else None
            if q is None:
                found = _CUT.search(text, mid + 1, min(hi, mid + width))
                q = found.start() if found else hi if mid + width >= hi else None
            width *= 4
        keep = self._tokens(left, len(text[p:mid].encode()), reverse=True)
        drop = self._tokens(right, len(text[mid:q].encode()))
        return left[:keep] + self._core.encode_ordinary(text[p:q]) + right[drop:]

    def _tokens(self, ids: list[int], size: int, reverse: bool = False) -> int:
        """The index in ids that lies ``size`` bytes from the end (reverse) or the start."""
        k, step = (len(ids), -1) if reverse else (0, 1)
        while size > 0:
            size -= self._size[ids[k - 1 if reverse else k]]
            k += step
        if size:
            raise AssertionError("a safe cut lies inside a token")
        return k

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf:
            return b"".join([self._bytes[i] for i in ids])
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


def ranks_of_tiktoken(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def ranks_of_json(path: str) -> dict[bytes, int]:
    """The vocabulary of a byte-level BPE tokenizer.json whose ids are in the order of its merges."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = {x["content"] for x in model.get("added_tokens", [])}
    return {bytes(byte_of[ch] for ch in token): i for token, i in model["model"]["vocab"].items() if token not in special}


def added_of_json(path: str) -> dict[str, int]:
    """The added tokens of a tokenizer.json, found in a text as they are written there."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens", [])
    if odd := [x["content"] for x in added if any(x.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))]:
        raise ValueError(f"added tokens that take or ask for what is round them: {odd}")
    return {x["content"]: x["id"] for x in added}


@lru_cache(maxsize=4)
def codec(path: str, pattern: str = public_tokenizers.PATTERN, leaf: int = LEAF) -> Codec:
    """Built once in each Python worker."""
    if path.endswith(".json"):
        return Codec(ranks_of_json(path), pattern, leaf, added_of_json(path))
    return Codec(ranks_of_tiktoken(path), pattern, leaf)


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: one row for each row of docs, no shuffle.

    Null and empty texts have no tokens; very long texts are encoded whole, in halves; repeated rows give repeated rows. No documents: no rows.
    Columns beside doc_id and text aren't read.
    """

    def row(doc_id: int | None, raw: bytes | None) -> tuple:
        coder = codec(vocabulary)
        ids = coder.encode((raw or b"").decode("utf-8", "replace"))
        names = coder.names
        return doc_id, len(ids), hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()

    return c.map_rows(c.texts(docs), row, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """encode_decode() over all documents: a row for each, null and empty texts (no tokens), repeated rows and very long texts included; an empty table gives no rows."""
    return encode_decode(c.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
