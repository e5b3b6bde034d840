"""Byte-level BPE over content-defined chunks that documents share."""

from __future__ import annotations

import hashlib
import json
import re
from collections import OrderedDict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import annotate, prepare_text

# A cut is made behind each place where the hash of the last 16 bytes has CUT_BITS zero bits on top.
CUT_BITS = 10
LEAST_CHUNK = 128
STORE_BYTES = 32 << 20
FIELDS = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
# Fixed value: the words that byte-level BPE splits a text into before it merges bytes.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Behind a non-ASCII character it is not known whether that is a blank, so only places behind visible ASCII are sure.
_SURE = re.compile(rb"(?<=[!-~])[\t-\r ]")


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes for themselves, the rest from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """The tokenizer of a vocabulary file, with the merges done by tiktoken and the joins between chunks by us.

    Strings of special tokens inside a text count as those tokens, as they do in the file's own library.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as handle:
            spec = json.load(handle)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level BPE file")
        chars = _byte_of_char()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(chars[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        self.engine = tiktoken.Encoding("chunks", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens=special)
        self.special = set(special)
        size = max([*ranks.values(), *special.values()]) + 1
        self.pieces: list[bytes] = [b""] * size
        for piece, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
            self.pieces[i] = piece
        self.lengths = np.array([len(p) for p in self.pieces], np.int32)
        self.decimals = [f"{i},".encode() for i in range(size)]
        self.store: OrderedDict[bytes, tuple[np.ndarray, np.ndarray]] = OrderedDict()
        self.store_size = 0

    def encode_plain(self, text: bytes) -> np.ndarray:
        """All of a text at once."""
        return self.engine.encode_to_numpy(text.decode("utf-8", "replace"), allowed_special=self.special, disallowed_special=())

    def _chunk(self, chunk: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of one chunk and their ends, made once as long as the store holds them; chunks used least lately go first."""
        found = self.store.get(chunk)
        if found is not None:
            self.store.move_to_end(chunk)
            return found
        ids = self.encode_plain(chunk)
        found = self.store[chunk] = ids, np.cumsum(self.lengths[ids])
        self.store_size += len(chunk) + 12 * len(ids) + 500
        while self.store_size > STORE_BYTES:
            old, (gone, _) = self.store.popitem(last=False)
            self.store_size -= len(old) + 12 * len(gone) + 500
        return found

    def encode(self, text: bytes) -> np.ndarray:
        """Tokens of the text from the tokens of its chunks, the joins repaired.

        At a join, everything between the last sure word border of the left side and the first one of the right side
        is encoded anew. A place is sure if a blank stands there behind a character that is none: no word reaches over
        such a place whatever the neighbours are, so the text up to it and the text from it are encoded independently.
        The repair agrees with its neighbours when both have a token border exactly there; where one has none, the
        window grows to the next sure place, at most over the whole text.
        """
        cuts = cut_places(text)
        if len(cuts) == 2:
            return self.encode_plain(text)
        parts: list[np.ndarray] = []
        done = 0  # everything before this byte is encoded for good
        for left, right in zip(cuts, cuts[1:]):
            ids, ends = self._chunk(text[left:right])
            begin = 0
            if left:
                found = self._agreed(text, left, right, ends)
                if found is None:
                    continue
                place, begin = found
                if place > done:
                    parts.append(self.encode_plain(text[done:place]))
                done = place
            if right == len(text):
                parts.append(ids[begin:])
                done = right
                continue
            place = text.rfind(b" ", done + 1, right)
            while place > done:
                k = int(ends.searchsorted(place - left))
                if 32 < text[place - 1] < 127 and ends[k] == place - left:
                    parts.append(ids[begin : k + 1])
                    done = place
                    break
                place = text.rfind(b" ", done + 1, place)
        if done < len(text):
            parts.append(self.encode_plain(text[done:]))
        return np.concatenate(parts)

    @staticmethod
    def _agreed(text: bytes, left: int, right: int, ends: np.ndarray) -> tuple[int, int] | None:
        """The first sure place of a chunk that is a border of its tokens, and how many tokens lie before it."""
        for match in _SURE.finditer(text, left, right):
            place = match.start() - left
            if not place:
                return left, 0
            k = int(ends.searchsorted(place))
            if ends[k] == place:
                return match.start(), k + 1
        return None

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of the tokens, special ones included, in UTF-8; bytes that are none become U+FFFD."""
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace").encode()


def cut_places(text: bytes) -> list[int]:
    """Chunk borders, with both ends of the text: chosen by the content, never inside a character."""
    n = len(text)
    if n < 2 * LEAST_CHUNK:
        return [0, n]
    data = np.frombuffer(text, np.uint8)
    rolling, factor = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 0xC2B2AE3D27D4EB4F
    for width in (1, 2, 4, 8):
        shifted = rolling * np.uint64(pow(factor, width, 1 << 64))
        rolling[width:] += shifted[:-width]
    places = np.flatnonzero(rolling[15:] >> np.uint64(64 - CUT_BITS) == 0) + 16
    places = places[places < n]
    places = places[(data[places] & 0xC0) != 0x80]
    kept, last = [0], 0
    for place in places.tolist():
        if place - last >= LEAST_CHUNK and n - place >= LEAST_CHUNK:
            kept.append(place)
            last = place
    return [*kept, n]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), and the tokens themselves as `ids` if asked for.

    Every whole text is encoded and decoded; null counts as empty, which has no tokens. Chunks are shared by all
    documents that a worker meets, through a store of bounded size: nothing is shuffled, and a lost executor only
    loses a store that fills again. `path` is the vocabulary file, which each worker reads. Repeated rows, and rows
    without an id, each give a row; an empty table gives an empty result; a very long text is encoded chunk by chunk.
    """
    prepare_text(docs.sparkSession)

    def compute(texts: list[bytes]) -> list[pa.Array]:
        bpe = tokenizer(path)
        coded = [bpe.encode(x) for x in texts]
        columns = [
            pa.array([len(ids) for ids in coded], pa.int64()),
            pa.array([hashlib.sha256(b"".join(map(bpe.decimals.__getitem__, ids.tolist()))[:-1]).hexdigest() for ids in coded]),
            pa.array([hashlib.sha256(bpe.decode(ids)).hexdigest() for ids in coded]),
        ]
        return [*columns, pa.array([ids.astype(np.int32) for ids in coded], pa.list_(pa.int32()))] if with_ids else columns

    fields = FIELDS | ({"ids": T.ArrayType(T.IntegerType())} if with_ids else {})
    return annotate(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", compute, fields, ["doc_id"])
