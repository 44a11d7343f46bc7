"""Packing token sequences by first-fit decreasing over a tournament tree.

Texts are tokenised once and cut at multiples of the sequence length. Full pieces are sequences;
the remainders are packed in randomised groups of documents, each group on its own. A tournament
tree over the bins' free room finds the first bin that fits in logarithmic time.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import cut, prepare, texts_of, worker_state

LENGTH = 4096
END_ID = 2
GROUP = 4096  # remainders that are packed together, on average
# Words whose ids a Python worker keeps; beyond this it starts anew.
KEPT_WORDS = 600_000
_BITS = 21  # a group's sequences are numbered below 2**_BITS
# Marks after a word that are a piece of their own; an apostrophe may be more.
_CLOSING = ".,;:!?\"#$%&()*+-/<=>@[\\]^_`{|}~"
# White space to str.split, but not to the tokenizer.
_CONTROL = [chr(c) for c in range(0x1C, 0x20)]


# How a tokenizer file must treat a text for words to be encoded one by one.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class WordTokens:
    """Ids of whole texts, from the ids of their words.

    The tokenizer lower-cases, cuts at white space and never merges across it, so a text's ids are
    its words' ids in turn; words repeat, and each is encoded once. Texts whose case or composition
    depends on more than the word are encoded whole.
    """

    def __init__(self, path: str, kept: int = KEPT_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        state = json.loads(self.tokenizer.to_str())
        # What the short cut takes for granted; with a file that says otherwise whole texts are encoded.
        self.by_word = (
            state["normalizer"] == _NORMALIZER and state["pre_tokenizer"] == _PRE_TOKENIZER and not state.get("post_processor")
            and state["model"].get("end_of_word_suffix") == "</w>" and not state["model"].get("continuing_subword_prefix")
        )
        # The same model for words that are lower-cased and parted by spaces already: no patterns to try.
        plain = state | {
            "normalizer": None,
            "pre_tokenizer": {
                "type": "Sequence",
                "pretokenizers": [
                    {"type": "WhitespaceSplit"},
                    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
                ],
            },
        }
        self.plain = Tokenizer.from_str(json.dumps(plain))
        self.plain.encode_special_tokens = True
        vocab = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.kept = kept

    def _learn(self, words: set[str]) -> None:
        """Ids of new words. A plain word with closing marks is made of its two parts."""
        parts: list[tuple[str, str, str]] = []
        plain, other = set(), set()
        for w in words:
            core = w.rstrip(_CLOSING)
            if core and core.isalpha() and (core.isascii() or max(core) < "\u2000"):
                if core not in self.known:
                    plain.add(core)
                if len(core) < len(w):
                    tail = w[len(core) :]
                    parts.append((w, core, tail))
                    if tail not in self.known:
                        other.add(tail)
            else:
                other.add(w)
        cores = list(plain)
        some = [cores[lo : lo + 128] for lo in range(0, len(cores), 128)]
        coded = self.plain.encode_batch_fast([" ".join(c) for c in some], add_special_tokens=False)
        for names, e in zip(some, coded, strict=True):
            ids = np.array(e.ids, "<u4")
            raw, at = ids.tobytes(), 0
            for name, end in zip(names, (4 * (np.flatnonzero(self.closes[ids]) + 1)).tolist(), strict=True):
                self.known[name] = raw[at:end]
                at = end
        rest = list(other)
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.known[w] = np.array(e.ids, "<u4").tobytes()
        for w, core, tail in parts:
            self.known[w] = self.known[core] + self.known[tail]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split: list[list[str] | None] = []
        for text in texts:
            low = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
            plain = self.by_word and unicodedata.is_normalized("NFC", low) and not any(c in low for c in _CONTROL)
            split.append(low.split() if plain else None)
        words = set().union(*(w for w in split if w))
        new = words.difference(self.known)
        if len(self.known) + len(new) > self.kept:
            self.known.clear()
            new = words
        if new:
            self._learn(new)
        return [
            np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            if w is None
            else b"".join(map(self.known.__getitem__, w))
            for text, w in zip(texts, split, strict=True)
        ]


def tokenised(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of each row of docs: doc_id, start, length, ids, ids_crc32, doc_tokens, turn (a random number of the row)."""
    closing = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_state(("words", tokenizer_path), lambda: WordTokens(tokenizer_path))
        seen = 0
        for batch in batches:
            texts = [(t or b"").decode("utf-8", "replace") for t in texts_of(batch.column(1))]
            out = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), tokens.ids(texts), strict=True):
                raw += closing
                n = len(raw) // 4
                seen += 1
                turn = zlib.crc32(f"{doc_id}:{seen}".encode())
                for start in range(0, n, length):
                    piece = raw[4 * start : 4 * (start + length)]
                    out.append((doc_id, start, len(piece) // 4, piece, zlib.crc32(piece), n, turn))
            if out:
                names = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "turn"]
                kinds = [pa.binary() if c == "ids" else pa.int64() for c in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        run, "doc_id bigint, start bigint, length bigint, ids binary, ids_crc32 bigint, doc_tokens bigint, turn bigint"
    )


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each size, in the given order: the first bin with room. sizes are at most capacity."""
    width = 1
    while width < max(1, len(sizes)):
        width *= 2
    # Free room: a leaf for each bin, in a parent the largest of its children.
    room = [capacity] * (2 * width)
    bins = []
    for size in sizes:
        at = 1
        while at < width:
            at *= 2
            if room[at] < size:
                at += 1
        bins.append(at - width)
        room[at] -= size
        at //= 2
        while at:
            left, right = room[2 * at], room[2 * at + 1]
            room[at] = left if left >= right else right
            at //= 2
    return bins


def _pack(length: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(
            ["length", "turn", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True, True], ignore_index=True
        )
        bins = np.array(first_fit(pdf["length"].tolist(), length), np.int64)
        filled: dict[int, int] = {}
        offsets = []
        for b, n in zip(bins.tolist(), pdf["length"].tolist(), strict=True):
            at = filled.get(b, 0)
            offsets.append(at)
            filled[b] = at + n
        pdf["sequence_id"] = 2 * ((int(key[0]) << _BITS) + bins)
        pdf["offset"] = offsets
        return pdf.drop(columns=["turn", "group"])

    return run


_PACKED = "doc_id bigint, start bigint, length bigint, ids binary, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def packed(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset: a row for each piece of each row of docs.

    ids are the piece's own, 32 bits each, little-endian; a sequence is its pieces' ids in the order of
    their offsets. Every id of a document, the closing one included, lies in one piece; a sequence holds at most
    `length` ids and has no gaps. Null, empty and blank texts are the closing id alone. Repeated rows are
    packed one by one. An empty table gives an empty result. tokenizer_path names a file that every
    worker can open.
    """
    prepare(docs.sparkSession)
    pieces = cut(tokenised(docs, tokenizer_path, length, end_id))
    whole = pieces.where(F.col("length") == length).select(
        "doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens",
        (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
    )
    parts = pieces.where(F.col("length") < length)
    groups = max(1, -(-parts.count() // GROUP))
    dealt = parts.withColumn("group", F.pmod(F.xxhash64("turn", "start"), F.lit(groups)))
    return whole.union(dealt.groupBy("group").applyInPandas(_pack(length), _PACKED))
