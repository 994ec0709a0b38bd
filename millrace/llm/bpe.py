"""Byte-level BPE ids of whole texts, the same as the tokenizer file gives.

The file's vocabulary is handed to a second public encoder, which is four times as fast on one
thread; in a vocabulary of this kind an id is also the rank of its merge.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import tiktoken

# fixed value: the published pre-tokenisation pattern of this vocabulary, in the possessive form the
# encoder's library publishes for it, which does not go back
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def _alphabet() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for
    themselves, the others are moved beyond 255 in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """Encodes texts to ids below 65,536; ``end`` is an id put after each text."""

    def __init__(self, tokenizer_json: bytes, end: int = 1) -> None:
        spec = json.loads(tokenizer_json)
        byte = _alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self._bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self._end = np.array([end], np.uint16)
        self._opens = np.zeros(1 << 16, bool)  # ids whose first byte is a space
        self._opens[[i for token, i in ranks.items() if token[0] == 32]] = True

    def _ids(self, text: str) -> np.ndarray:
        return self._bpe.encode_to_numpy(text, allowed_special="all").astype(np.uint16)

    def __call__(self, text: str) -> np.ndarray:
        return np.concatenate([self._ids(text), self._end])

    def batch(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each of some texts in UTF-8; a part that occurs several times is encoded once.

        The pattern always begins a token at a space after something other than white space and looks
        back at nothing, so texts are cut there and the ids of the parts joined.
        """
        raw = b"".join(texts)
        data = np.frombuffer(raw, np.uint8)
        begins = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = (data[1:] == 32) & _solid(data)[:-1]
        cut[begins] = True
        edges = np.flatnonzero(cut)
        parts = _parts(raw, edges).dictionary_encode()
        table, upto = self._table(parts.dictionary)
        number = parts.indices.to_numpy(zero_copy_only=False)
        sizes = upto[number + 1] - upto[number]
        stops = np.cumsum(sizes)
        ids = table[np.repeat(upto[number] - (stops - sizes), sizes) + np.arange(sizes.sum())]
        at = np.concatenate([[0], stops])[np.searchsorted(edges, begins)]
        return [np.concatenate([ids[a:b], self._end]) for a, b in zip(at, at[1:])]

    def _table(self, parts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``parts`` one after another, and where those of each begin.

        Parts with one space, at their start, are encoded as one text: the ids that begin with a space
        tell them apart.
        """
        raw = parts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
        edges = np.frombuffer(parts.buffers()[1], np.int64, len(parts) + 1, 8 * parts.offset)
        spaces = np.concatenate([[0], np.cumsum(data == 32)])
        plain = (data[edges[:-1]] == 32) & (np.diff(spaces[edges]) == 1) & _solid(data)[edges[1:] - 1]
        together = data[np.repeat(plain, np.diff(edges))].tobytes()
        ids = self._ids(together.decode())
        first = np.flatnonzero(self._opens[ids])
        if len(first) != np.count_nonzero(plain):
            raise ValueError("a part does not begin with the only space of its ids")
        alone = [self._ids(p.decode()) for p in parts.filter(pa.array(~plain, pa.bool_())).to_pylist()]
        sizes = np.zeros(len(parts), np.int64)
        sizes[plain] = np.diff(np.append(first, len(ids)))
        sizes[~plain] = [len(i) for i in alone]
        # plain parts stand first in the table
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        return _in_order(np.concatenate([ids, *alone]), sizes, order)


def _solid(data: np.ndarray) -> np.ndarray:
    """Bytes that end a character which is certainly no white space."""
    solid = (data > 32) & (data < 127)
    # two-byte characters from U+00C0 on; the others may be white space
    solid[1:] |= (data[1:] >= 128) & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    return solid


def _parts(raw: bytes, edges: np.ndarray) -> pa.LargeBinaryArray:
    offsets = pa.py_buffer(edges.astype(np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, offsets, pa.py_buffer(raw)])


def _in_order(ids: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``ids``, where those of part ``order[k]`` lie k-th, by the number of the part."""
    lying = np.concatenate([[0], np.cumsum(sizes[order])])
    start = np.empty(len(sizes), np.int64)
    start[order] = lying[:-1]
    upto = np.concatenate([[0], np.cumsum(sizes)])
    return ids[np.repeat(start - upto[:-1], sizes) + np.arange(upto[-1])], upto


_LOADED: dict[tuple[int, int], Encoder] = {}


def encoder(tokenizer_json: bytes, end: int = 1) -> Encoder:
    """One encoder for each Python worker."""
    key = (hash(tokenizer_json), end)
    if key not in _LOADED:
        _LOADED[key] = Encoder(tokenizer_json, end)
    return _LOADED[key]
