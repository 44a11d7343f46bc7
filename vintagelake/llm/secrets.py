"""Secret scans: fixed patterns, and random strings found by their low token efficiency.

A vocabulary trained on text writes words in few tokens. Strings of random characters need nearly a
token for each character or two, so a low ratio of characters to tokens exposes them, once digests and
identifiers, which are meant to look so, are set aside.
"""

from __future__ import annotations

import base64
import re
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import mapped, prepare, texts_of, worker_state

# Fixed patterns of the base kinds.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "random"]

# Random strings have at most so many characters a token. Looked at are maximal runs of RUN_LEAST characters and more, and
# the parts between their separators: of PART_LEAST characters and more whatever they hold, and of SHORT_LEAST and more
# where digits and letters, or small and capital letters, follow each other as in no word. In a shorter part of
# letters of one case the ratio can't tell random letters from syllables that the vocabulary has not seen.
RUN_LEAST, PART_LEAST, SHORT_LEAST = 16, 16, 8
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % RUN_LEAST
MOST_CHARS_PER_TOKEN = 2.1
# Lengths of hexadecimal digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}

_ASSIGN = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(HEX[:-1] + "{%d,}" % LEAST["hex"])  # maximal runs either way
_RUN = re.compile(RUN)
_HEXADECIMAL = re.compile(r"(0[xX])?[0-9a-fA-F]+")
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
# Words, possibly numbered, joined by single separators; dates and plain numbers.
_IDENTIFIER = re.compile(r"([A-Za-z]*[a-z]{2}|[A-Z]{2,}|[A-Za-z])?\d{0,6}([-_/=+]+([A-Za-z]*[a-z]{2}|[A-Z]{2,}|[A-Za-z])?\d{0,6})*")

# Numbers, dates, and numbers with a few letters before or after them; a run without letters is one of these.
_NUMBERED = re.compile(r"[A-Za-z]{0,3}[0-9+/_=-]+[A-Za-z]?")
_WORD = re.compile(r"[A-Za-z]{4,}")
_PART = re.compile(r"[A-Za-z0-9]+")
# Where a digit meets a letter or a small letter a capital.
_CHANGE = re.compile(r"[a-z][A-Z]|[0-9][A-Za-z]|[A-Za-z][0-9]")
# Parts made like words: capitals only in front of small letters or all through, digits only at the end.
_WORDLIKE = re.compile(r"([A-Z]?[a-z]{2,})+\d{0,4}|[A-Z]{2,}\d{0,4}|[0-9]+[A-Za-z]{0,3}|[A-Za-z]{0,3}[0-9]+")
_JOINS = "+/_=-"


def encoding(path: str, pattern: str):
    """A tiktoken encoding from a file of ranks."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _tokens(word: str, enc) -> int:
    """Tokens of a word inside a sentence, in the better of both cases."""
    return min(len(enc.encode_ordinary(f" {w}")) for w in (word, word.lower()))


def _identifier(run: str, enc) -> bool:
    """Whether a run is made like an identifier, and its words of some length pass the ratio, too."""
    if _NUMBERED.fullmatch(run):
        return True
    if not _IDENTIFIER.fullmatch(run):
        return False
    words = _WORD.findall(run)
    return sum(map(len, words)) > MOST_CHARS_PER_TOKEN * sum(_tokens(w, enc) for w in words) or not words


def looks_random(run: str, enc) -> bool:
    """Whether a run has so few characters a token that it is no text, digest, number or identifier."""
    if len(run) > MOST_CHARS_PER_TOKEN * len(enc.encode_ordinary(run)):
        return False
    return not _known(run) and not _identifier(run, enc)


def _known(run: str) -> bool:
    """UUIDs and digests, whose parts are not looked at either."""
    return bool(_UUID.fullmatch(run) or (_HEXADECIMAL.fullmatch(run) and len(run) in DIGEST_LENGTHS))


def _short_random(part: str, enc) -> bool:
    """A part of 8 to 15 characters: mixed as no word, short hexadecimal number or abbreviated digest is."""
    if _WORDLIKE.fullmatch(part) or _HEXADECIMAL.fullmatch(part):
        return False
    return len(part) <= MOST_CHARS_PER_TOKEN * len(enc.encode_ordinary(part))


def _random_spans(text: str, enc) -> list[tuple[int, int]]:
    """Spans of random runs, and of random parts of the other runs, in order."""
    found, settled = [], []
    for m in _RUN.finditer(text):
        parts = any(c in m[0] for c in _JOINS)
        holds_known = parts and (_UUID.search(m[0]) or any(map(_known, _PART.findall(m[0]))))
        if _known(m[0]):
            settled.append(m.span())
        elif not holds_known and looks_random(m[0], enc):
            settled.append(m.span())
            found.append(m.span())
        elif parts:
            for p in _PART.finditer(text, *m.span()):
                if p.end() - p.start() >= PART_LEAST and looks_random(p[0], enc):
                    found.append(p.span())
    at, end = 0, -1
    for c in _CHANGE.finditer(text):
        if c.start() < end:
            continue
        lo = c.start()
        while lo > 0 and text[lo - 1].isascii() and text[lo - 1].isalnum():
            lo -= 1
        end = _PART.match(text, lo).end()
        if not SHORT_LEAST <= end - lo < PART_LEAST:
            continue
        while at < len(settled) and settled[at][1] <= lo:
            at += 1
        if (at == len(settled) or lo < settled[at][0]) and _short_random(text[lo:end], enc):
            found.append((lo, end))
    return sorted(found)


def spans_of(text: str, enc) -> list[tuple[int, int, int]]:
    """(start, rank of kind, end) of every span of a text, sorted."""
    found = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    base = sorted((a, b) for a, _, b in found)
    reach, at = -1, 0  # the farthest end of the base spans that start so far
    for lo, end in _random_spans(text, enc):
        while at < len(base) and base[at][0] <= lo:
            reach = max(reach, base[at][1])
            at += 1
        if end > reach:
            found.append((lo, 3, end))
    return sorted(found)


def scanned(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_spans, spans for each row of docs (doc_id, text).

    Spans are kind:start:end in code points, end exclusive, sorted by start, then kind, and joined by
    commas; base_spans leaves out the random strings, which are kept only where no base span covers them.
    Null, empty and clean texts have none ("" and counts of 0). Repeated rows are scanned alike; an empty
    table gives an empty result. ranks_path names a tiktoken file that every worker can open.
    """
    prepare(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = worker_state(("encoding", ranks_path), partial(encoding, ranks_path, pattern))
        counts, base, full = [[], [], [], []], [], []
        for raw in texts_of(batch.column(1)):
            spans = spans_of(raw.decode("utf-8", "replace"), enc) if raw else []
            for kind, column in enumerate(counts):
                column.append(sum(s[1] == kind for s in spans))
            text = [(s[1], f"{KINDS[s[1]]}:{s[0]}:{s[2]}") for s in spans]
            base.append(",".join(t for k, t in text if k < 3))
            full.append(",".join(t for _, t in text))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.string()), pa.array(full, pa.string())],
            ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_spans", "spans"],
        )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mapped(
        rows, run,
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, base_spans string, spans string",
    )
