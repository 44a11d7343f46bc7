"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their scores.

All of it is DataFrame functions. A pattern's matches are wrapped in a mark that no text holds; splitting
at the mark gives matches and gaps in turn, whose lengths are the positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import prepare

# Matches are found as by these fixed patterns. Possessive quantifiers and the look-behind keep long runs
# linear: a match can only begin where its leading run begins, or where the match before it ended.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"(?<![0-9])[0-9](?:[0-9]|[\x20-][0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # Country, check digits, account: in one run, or in fours.
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
}
BASE = ["email", "ip", "card", "phone"]
# What a text must hold for a pattern to be tried.
NEEDS = {
    "email": lambda text: F.contains(text, F.lit("@")),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda text: text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": lambda text: text.rlike(r"\+[0-9]"),
    "iban": lambda text: text.rlike(r"[A-Z]{2}[0-9]{2}[\x20A-Z0-9]{11}"),
}
# Score of a confirmed span, and words nearby that raise it.
SCORES = {"email": 0.9, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.9}
CONTEXT = {
    "email": "mail|e-mail|contact|kontakt|correo|courriel",
    "ip": "ip|address|host|server|adresse",
    "card": "card|visa|credit|karte|tarjeta|carte",
    "phone": "phone|tel|call|mobile|fon|anruf",
    "iban": "iban|account|bank|konto|cuenta|compte",
}
CONTEXT_GAIN = 0.1
NEARBY = 40  # code points before a span in which context words count

_BITS = 8  # a text is cut in blocks of 256 code points

_MARK, _OTHER = "\ue000", "\ue001"


def _pieces(text: Column, kind: str) -> Column:
    """Gaps and matches of a pattern in turn, beginning with a gap. A mark in the text becomes another
    private character first; no pattern tells them apart."""
    plain = F.translate(text, _MARK, _OTHER)
    marked = F.regexp_replace(plain, PATTERNS[kind], f"{_MARK}$0{_MARK}")
    return F.when(NEEDS[kind](text), F.split(marked, _MARK, -1)).otherwise(F.array(text))


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits is a multiple of ten."""
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        F.lit(0),
        lambda acc, i: acc + _doubled(F.substring(digits, i, F.lit(1)).cast("int"), (n - i) % 2),
    )
    return total % 10 == 0


def _doubled(d: Column, odd: Column) -> Column:
    return F.when(odd == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))


def _mod97(text: Column) -> Column:
    """Check of an account number: moved head, letters as 10 to 35, remainder 1 modulo 97."""
    plain = F.translate(text, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, F.lit(1), F.lit(4)))
    rest = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.length(turned), F.lit(1))),
        F.lit(0),
        lambda acc, i: _appended(acc, F.ascii(F.substring(turned, i, F.lit(1)))),
    )
    return F.length(plain).between(15, 34) & (rest == 1)


def _appended(acc: Column, code: Column) -> Column:
    return F.when(code < 65, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)


def _valid(match: Column, kind: str) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        # Longer parts than nine digits can't be cast; leading zeros don't count.
        return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^(|[0-9]|[0-9]{2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(digits).between(13, 19) & _luhn(F.substring(digits, 1, 19))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return _mod97(match)
    return F.lit(True)


def _running(values: Column, size: Column, step) -> Column:
    """Running fold of an array by `step` (associative), by doubling: n log n, where appending to an array is n * n."""
    levels = F.sequence(F.lit(0), F.length(F.bin(size)) - 1)

    def doubled(acc: Column, k: Column) -> Column:
        back = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(acc, lambda x, i: F.when(i >= back, step(x, F.get(acc, i - back))).otherwise(x))

    return F.aggregate(levels, values, doubled)


def _own(docs: DataFrame) -> str:
    """A beginning of column names that no column of docs has."""
    start = "__work"
    while any(c.lower().startswith(start) for c in docs.columns):
        start += "_"
    return start


def _spans(pieces: Column, kind: str) -> Column:
    """Confirmed spans of one kind, in order: kind, start, end and score, from the piece and the text before it."""
    ends = _running(F.transform(pieces, lambda p: F.length(p)), F.size(pieces), lambda x, y: x + y)
    placed = F.zip_with(pieces, ends, lambda p, e: F.struct(p.alias("match"), e.alias("end")))
    beside = F.transform(placed, lambda s, i: F.struct(s["match"].alias("match"), s["end"].alias("end"), F.get(pieces, i - 1).alias("gap")))
    confirmed = F.filter(beside, lambda s, i: (i % 2 == 1) & _valid(s["match"], kind))
    near = lambda s: F.lower(F.right(s["gap"], F.lit(NEARBY)))
    gain = lambda s: F.when(near(s).rlike(rf"\b({CONTEXT[kind]})\b"), CONTEXT_GAIN).otherwise(0.0)
    full = F.transform(
        confirmed,
        lambda s: F.struct(
            F.lit(kind).alias("kind"), (s["end"] - F.length(s["match"])).alias("start"), s["end"].alias("end"),
            (F.lit(SCORES[kind]) + gain(s)).alias("score"),
        ),
    )
    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    return F.when(F.size(pieces) > 1, full).otherwise(none)


def found(docs: DataFrame, into: str = "spans") -> DataFrame:
    """docs with `into`: an array of kind, start, end, score of each confirmed span, by kind as listed, then start.

    Positions are code points, end exclusive. Matches of one kind are leftmost and don't overlap; those
    that fail their check are dropped. Null, empty and clean texts have an empty array. A column already named
    so is replaced; rows are neither joined nor shuffled.
    """
    prepare(docs.sparkSession)
    own = _own(docs)
    rows = docs.withColumn(f"{own}text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = rows.withColumns({f"{own}{k}": _pieces(F.col(f"{own}text"), k) for k in PATTERNS})
    rows = rows.withColumn(into, F.concat(*[_spans(F.col(f"{own}{k}"), k) for k in PATTERNS]))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns if c != into], into)


def counted(spans: Column, kind: str) -> Column:
    """Number of spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def rendered(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _between(blocks: Column, start: Column, end: Column) -> Column:
    """Text from code point start to end, out of its blocks, so that a cut does not walk from the beginning."""
    first, last = F.shiftright(start, _BITS), F.shiftright(end - 1, _BITS)
    near = F.array_join(F.slice(blocks, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
    return F.substring(near, start % (1 << _BITS) + 1, end - start)


def masked(docs: DataFrame) -> DataFrame:
    """docs with each span of personal data in text replaced by its kind in brackets, overlapping spans by the first one's.

    n_chars, where present, follows the text. Other columns, null texts, empty and clean texts stay as they are; an
    empty table gives an empty one, and repeated rows are masked alike. The work grows as n log n with a text's spans.
    """
    own = _own(docs)
    spans, blocks, ordered, clean = (F.col(own + x) for x in ("spans", "blocks", "ordered", "clean"))
    rows = found(docs, f"{own}spans")
    text, hit = F.col("text").cast("string"), F.size(spans) > 0
    whole = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << _BITS}}}"), F.lit(0))
    listed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    rows = rows.withColumns({f"{own}blocks": F.when(hit, whole), f"{own}ordered": listed})
    # Where the text is masked up to before each span, and after the last one.
    upto = F.concat(F.array(F.lit(0)), F.transform(ordered, lambda s: s["end"]))
    at = _running(upto, F.size(ordered) + 1, lambda x, y: F.greatest(x, y))
    parts = F.zip_with(ordered, at, lambda s, a: F.struct(s.alias("span"), a.alias("at")))
    kept = F.filter(parts, lambda p: p["span"].isNull() | (p["span"]["start"] >= p["at"]))
    pieces = F.transform(
        kept,
        lambda p: F.when(p["span"].isNull(), _between(blocks, p["at"], F.length(text))).otherwise(
            F.concat(_between(blocks, p["at"], p["span"]["start"]), F.lit("["), F.upper(p["span"]["kind"]), F.lit("]"))
        ),
    )
    rows = rows.withColumn(f"{own}clean", F.when(hit, F.array_join(pieces, "")).otherwise(text))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(hit, F.length(clean).cast(kind)).otherwise(F.col("n_chars")))
    rows = rows.withColumn("text", clean)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
