"""Licence, secret and personal-data scans, against straightforward versions."""

import hashlib
import random
import re
import string
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from vintagelake.llm import licences, personal, registry, secrets
from vintagelake.llm.common import prepare
from vintagelake.llm.vocabularies import pattern, vocabulary

DOCS = "doc_id bigint, text string, spans string, digest int, n_chars bigint"


def frame(spark, texts):
    prepare(spark)
    return spark.createDataFrame([(i, t, "s", 1, len(t or "")) for i, t in enumerate(texts)], DOCS)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_personal(text):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def noisy(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


@pytest.fixture(scope="module")
def personal_texts():
    rng = random.Random(3)
    parts = [
        "a@b.c", "x.y+z@mail-1.example.com", "_x@d.e", "1.2.3.4", "256.1.1.1", "10.0.0.255", "001.002.003.004", "4111 1111 1111 1111",
        "4111-1111-1111-1112", "4041894974608795", "+1 (724) 555-7058", "+49 30 123456", "+1-2", "12.34.56", "GB82 WEST 1234 5698 7654 32",
        "DE89370400440532013000", "\U0001f600", "", "é", " ", ",", "-", ".", "call ", "@", "b.c@d.e@f.g",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))) for _ in range(250)]
    texts += [noisy(rng, "a1.@-+ ()2_%", rng.randrange(1, 60)) for _ in range(250)]
    return [None, "", " ", "1" * 50_000, "1 " * 30_000, "a" * 100_000 + "@", "1.1." * 20_000, "+1" * 20_000, *texts]


def test_personal_base_spans(spark, personal_texts):
    rows = personal.found(frame(spark, personal_texts)).collect()
    for r in rows:
        got = [(s.kind, s.start, s.end) for s in r.spans if s.kind in personal.BASE]
        assert got == plain_personal(personal_texts[r.doc_id]), repr(personal_texts[r.doc_id])[:200]


def test_personal_adds_account_numbers_and_context(spark):
    df = frame(spark, ["my iban: GB82 WEST 1234 5698 7654 32.", "DE89370400440532013000", "DE89370400440532013001", "phone +49 30 1234567"])
    rows = {r.doc_id: r.spans for r in personal.found(df).collect()}
    assert [(s.kind, s.start, s.end) for s in rows[0]] == [("iban", 9, 36)] and rows[0][0].score == pytest.approx(1.0)
    assert rows[1][0].kind == "iban" and rows[1][0].score == pytest.approx(0.9)
    assert "iban" not in [s.kind for s in rows[2]]
    assert rows[3][0].score == pytest.approx(0.7)


def test_masking(spark, personal_texts):
    df = frame(spark, ["x a@b.c y 10.0.0.1", "clean", None, "+1 (724) 555-7058"])
    out = personal.masked(df)
    assert out.columns == df.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[0].text == "x [EMAIL] y [IP]" and rows[0].n_chars == 16 and rows[0].spans == "s"
    assert rows[1].text == "clean" and rows[2].text is None and rows[3].text == "[PHONE]"
    many = "\n".join(f"{'é' * (i % 7)} mail u{i}@x{i % 9}.org, 10.0.{i % 300}.{i % 256} \U0001f600" for i in range(3000))
    overlapping = "+1 4111 1111 1111 1111 +49 30 123456 4111111111111111@x.de " * 40
    personal_texts = [*personal_texts, many, "x" * 256 + "a@b.c" + "y" * 251, "a@b.c" * 60, overlapping]
    df = frame(spark, [t or "" for t in personal_texts])
    spans = {r.doc_id: r.found for r in personal.found(df, "found").collect()}
    for r in personal.masked(df).collect():
        want, at, text = "", 0, personal_texts[r.doc_id] or ""
        for start, end, kind in sorted((s.start, s.end, s.kind) for s in spans[r.doc_id]):
            if start >= at:
                want += text[at:start] + f"[{kind.upper()}]"
            at = max(at, end)
        assert r.text == want + text[at:]


def test_personal_work_grows_with_the_spans(spark):
    """10,000 and 20,000 addresses in one text; appending to arrays would take four times as long."""
    took = []
    for n in (2_000, 10_000, 20_000):
        df = frame(spark, ["\n".join(f"write to user{i}@mail.example.com or 10.1.2.3" for i in range(n))]).checkpoint()
        begun = time.monotonic()
        row = personal.masked(df).first()
        took.append(time.monotonic() - begun)
        assert row.text.count("[EMAIL]") == row.text.count("[IP]") == n and "@" not in row.text
    assert took[2] < 2.5 * took[1] + 1, took


def test_personal_keeps_clashing_columns(spark):
    names = ["__text", "__spans", "__blocks", "__ordered", "__clean", "__pieces_email", "__Work"]
    df = frame(spark, ["x a@b.c", None, ""]).withColumns({n: F.lit("own " + n) for n in names})
    for out in (personal.found(df), personal.masked(df)):
        rows = out.collect()
        assert len(rows) == 3 and all(r[n] == "own " + n for r in rows for n in names)
    assert [r.text for r in personal.masked(df).orderBy("doc_id").collect()] == ["x [EMAIL]", None, ""]


def test_personal_has_no_python(spark):
    plan = personal.found(frame(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def plain_secrets(text):
    out = []
    kinds = [
        (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, lambda m: len(m[2]) >= 6),
        (r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 20),
        (r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 24),
    ]
    for k, (p, flags, good) in enumerate(kinds):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, text or "", flags) if good(m)]
    return sorted(out)


def test_secrets(spark):
    rng = random.Random(4)
    parts = ["token", "API_KEY", "Password", "toKen", "paſſword", " = ", ":", '"', "'", "AKIA", "ABCD1234", "deadbeef0123", "f00", "secret=abc", " ", "\n", "é"]
    texts = [None, "", "f" * 60_000, *("".join(rng.choice(parts) for _ in range(rng.randrange(1, 16))) for _ in range(300))]
    rows = secrets.scanned(frame(spark, texts), vocabulary("byte_bpe_50k.tiktoken"), pattern()).collect()
    names = ["assign", "access", "hex"]
    for r in rows:
        want = plain_secrets(texts[r.doc_id])
        assert r.base_spans == ",".join(f"{names[k]}:{a}:{b}" for a, k, b in want)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in want) for i in range(3)]
        assert set(filter(None, r.base_spans.split(","))) <= set(r.spans.split(","))


def test_random_strings(spark):
    good = ["xK9vQ2mZpL7wRt4YbN8c", "ghp_x8Kd93LmQzP0vTn27RyWbC5s", "Zm9vYmFyMTIzNDU2Nzg5MEFCQ0RFRg=="]
    fine = [
        "9e107d9d372bb6826bd81d3542a419d6".upper(), "550e8400-e29b-41d4-a716-446655440000", "my_variable_name_2024_final", "internationalization2024",
        "2024-01-01-2024-12-31", "4041894974608795404189", "SomeClassNameWithManyWords", "word " * 50,
    ]
    rows = secrets.scanned(frame(spark, good + fine), vocabulary("byte_bpe_50k.tiktoken"), pattern()).collect()
    assert {r.doc_id for r in rows if r.n_random} == set(range(len(good)))


def test_random_strings_of_each_alphabet_and_length(spark):
    rng = random.Random(9)
    low, up, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    alphabets = [low, up, low + up, low + digits, up + "234567", low + up + digits, low + up + digits + "+/", low + up + digits + "-_"]
    texts = [noisy(rng, a, n) for a in alphabets for n in (16, 20, 24, 40) for _ in range(100)]
    clean = [
        "internationalization", "Geschwindigkeitsbegrenzung", "responsabilidades", "characteristically", "getElementsByClassName",
        "MAX_BUFFER_SIZE_LIMIT", "src/main/java/example", "state-of-the-art-methods", "a-1-b-2-c-3-d-4-e-5", "2024-01-01/2024-12-31",
        "INV20240101123456789", "4041894974608795", "================", "UNCHARACTERISTICALLY", "da39a3ee5e6b4b0d3255bfef95601890afd80709".upper(),
    ]
    rows = secrets.scanned(frame(spark, texts + clean), vocabulary("byte_bpe_50k.tiktoken"), pattern()).collect()
    found = {r.doc_id for r in rows if r.n_random or r.n_hex}
    for lo in range(0, len(texts), 100):
        assert len(found & set(range(lo, lo + 100))) >= 93, texts[lo]
    assert [clean[i - len(texts)] for i in sorted(found) if i >= len(texts)] == []


MIT = "MIT License\n\nCopyright (c) 2021 Some One\n\n" + licences._MIT_BODY


def test_licences(spark):
    texts = [
        MIT, MIT.upper().replace("LICENSE", "Licence"), licences._MIT_BODY, MIT + " extra", None, "", "...", "a text.\nLicensed under the Apache Licence, version 2.0\nx",
        "All rights reserved.\n(c) 2020 x\n" + licences.TEXTS[5][1], "Released under the MIT License.\nReleased under the MIT license",
    ]
    rows = {r.doc_id: r for r in licences.scanned(frame(spark, texts)).collect()}
    assert [rows[i].licence for i in range(10)] == ["MIT", "MIT", "MIT", None, None, None, None, None, "BSD-2-Clause", None]
    assert [rows[i].digest is None for i in (4, 5, 6, 7)] == [True, True, True, False]
    assert (rows[7].n_notices, rows[7].notices) == (1, "Apache-2.0") and (rows[9].n_notices, rows[9].notices) == (2, "MIT")
    plan = licences.scanned(frame(spark, texts))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    want = con.execute("select doc_id, digest, licence, n_notices, notices from (" + licences.sql() + ") order by 1").fetchall()
    assert want == [(i, rows[i].digest, rows[i].licence, rows[i].n_notices, rows[i].notices) for i in range(10)]


def test_licences_titles_long_texts_and_reserved_rights(spark):
    known = dict(licences.TEXTS[-20:])
    texts = ["The MIT License (MIT)\n\nCopyright (c) 2021 x\n\n" + licences._MIT_BODY, "x\nAll rights reserved.\ny", "(c) 2020 x. All Rights Reserved", "Call me Ishmael."]
    names = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"]
    assert set(names) <= set(known)
    rows = {r.doc_id: r for r in licences.scanned(frame(spark, texts + [known[n] for n in names]), notices=[("own", "Call me Ishmael")]).collect()}
    assert [rows[i].licence for i in range(11)] == ["MIT", None, None, None, *names]
    assert [rows[i].n_reserved for i in range(4)] == [0, 1, 1, 0] and rows[3].notices == "own"


def test_digest_columns(spark):
    df = registry.op10_personal(spark, "/root/testdata/sf0.001")
    rows = df.join(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"), "doc_id").collect()
    order = {k: i for i, k in enumerate(personal.BASE)}
    for r in rows:
        want = sorted(plain_personal(r.text), key=lambda s: (order[s[0]], s[1]))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
    empty = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(F.lit(False))
    assert personal.found(empty).count() == personal.masked(empty).count() == licences.scanned(empty).count() == 0


def test_licences_of_other_scripts(spark):
    mit = next(t for n, t in licences.TEXTS if n == "MIT")
    texts = [mit, mit + "\nКоммерческое использование запрещено.", "привет 5", "до свидания 5", "ПРИВЕТ — 5!", "привет, 5.", "日本語"]
    rows = licences.scanned(frame(spark, texts)).orderBy("doc_id").collect()
    assert rows[0].licence == "MIT" and rows[1].licence is None
    digests = [r.digest for r in rows]
    assert len(set(digests[2:4] + digests[6:])) == 3 and digests[5] == digests[2]


@pytest.mark.parametrize("n, least", [(8, 0.9), (12, 0.95), (16, 0.95), (20, 0.95), (24, 0.95)])
def test_random_strings_in_any_surroundings(n, least):
    enc = secrets.encoding(vocabulary("byte_bpe_50k.tiktoken"), pattern())
    rng = random.Random(n)
    letters = string.ascii_letters + string.digits
    for form in ("key {} here", "see https://example.com/path/{} now", "use production-database-{} please", "prod_db_{}_old", "?a={}&b=2"):
        found = 0
        for _ in range(500):
            word = "".join(rng.choice(letters) for _ in range(n))
            text = form.format(word)
            at = text.index(word)
            found += any(a <= at and at + n <= b for a, _, b in secrets.spans_of(text, enc))
        assert found >= least * 500, form


def test_ordinary_strings_are_left_alone():
    enc = secrets.encoding(vocabulary("byte_bpe_50k.tiktoken"), pattern())
    for text in (
        "the getUserNameFromDatabase call", "version-2024-01-15", "commit a1b2c3d4e5", "id 550e8400-e29b-41d4-a716-446655440000",
        "sha256-" + "ab12" * 16, "https://example.com/articles/how-to-cook-pasta", "x86architecture", "ISO8859 and UTF16", "Covid19", "",
    ):
        assert not [s for s in secrets.spans_of(text, enc) if s[1] == 3], text
