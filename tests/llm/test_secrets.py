import base64
import bz2
import gzip
import hashlib
import json
import lzma
import random
import re
import urllib.parse
import zlib

import pyarrow as pa
import pytest

from chuvisco.llm import secrets
from chuvisco.llm.queries import op3_secret_scans
from chuvisco.llm.secrets import base_spans, find_secrets, hints_of, redact, scan_secrets

ALL = {"assign", "access", "hex", "escaped", "unicode", "coded"}
SECRET = "password = hunter22"
CODED = base64.b64encode(SECRET.encode()).decode()


def hidden(text, most=1 << 20):
    base, spans, _, refused = find_secrets(text, ALL, most)
    return spans - set(base), refused


@pytest.mark.parametrize(
    "inner",
    [
        urllib.parse.quote(SECRET),
        urllib.parse.quote(urllib.parse.quote(SECRET, safe="")),
        "".join(f"\\u{ord(c):04x}" for c in SECRET),
        "".join(f"&#{ord(c)};" for c in SECRET),
        "".join(f"\\x{ord(c):02X}" for c in SECRET),
        CODED,
        base64.urlsafe_b64encode(SECRET.encode()).decode(),
        urllib.parse.quote(CODED, safe="").replace("c", "%63"),
        *(base64.b64encode(pack(SECRET.encode())).decode() for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress)),
        base64.b64encode(gzip.compress(zlib.compress(SECRET.encode()))).decode(),
        base64.b64encode(urllib.parse.quote(CODED, safe="").encode()).decode(),
    ],
)
def test_layers_are_unwrapped_and_mapped(inner):
    spans, refused = hidden(f"é before {inner} after")
    assert not refused
    assert [kind for kind, _, _ in spans] == ["assign"]
    ((_, start, end),) = spans
    assert 9 <= start < end <= 9 + len(inner)
    if inner.startswith(("%", "p")) is False and "%" not in inner:
        assert (start, end) == (9, 9 + len(inner))


def wrapped(code, columns, end="\n"):
    return end.join(code[i : i + columns] for i in range(0, len(code), columns))


@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress, bz2.compress, lzma.compress])
def test_alphabets_paths_and_lines(pack):
    rng = random.Random(5)
    for i in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(25)]
        data = pack(" ".join([*words[:12], f"password = hunter{i:05}", *words[12:]]).encode())
        plain, safe = base64.b64encode(data).decode(), base64.urlsafe_b64encode(data).decode()
        for code in (plain, safe, safe.rstrip("="), wrapped(plain, 76), wrapped(safe, 64, "\r\n  "), wrapped(plain, 10)):
            for before in ("", "see ", "below\n", "https://h.example/path/", "a/", "a_", "ab-", "abc/"):
                spans, refused = hidden(f"é {before}{code} after")
                (start, end) = next((a, b) for kind, a, b in spans if kind == "assign")
                assert not refused and 2 <= start <= 2 + len(before) + 48 * 4 and end <= 2 + len(before + code)


def quoted(data):
    return urllib.parse.quote(data, safe="")


def backslashed(data):
    return repr(data)[2:-1]


WRITTEN = {
    "url": quoted,
    "url_all": lambda data: "".join(f"%{b:02X}" for b in data),
    "url_plus": urllib.parse.quote_plus,
    "literal": backslashed,
    "backslashes": lambda data: "".join(f"\\x{b:02x}" for b in data),
    "json": lambda data: json.dumps(data.decode("latin-1"))[1:-1],
    "decimal": lambda data: "".join(f"&#{b};" for b in data),
    "hexadecimal": lambda data: "".join(f"&#x{b:02x};" for b in data),
    "twice": lambda data: quoted(quoted(data).encode()),
    "url_of_backslashes": lambda data: quoted(backslashed(data).encode()),
    "base64_of_url": lambda data: base64.b64encode(quoted(data).encode()).decode(),
}


@pytest.mark.parametrize("way", WRITTEN)
@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, lambda d: gzip.compress(zlib.compress(d))])
def test_compressed_bytes_behind_escapes(way, pack):
    rng = random.Random(way)
    for _ in range(10):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(30))]
        code = WRITTEN[way](pack(" ".join([*words, SECRET, *words]).encode()))
        spans, refused = hidden(f"see https://h.example/?q={code} after 100 % of it")
        found = {(a, b) for kind, a, b in spans if kind == "assign"}
        assert not refused
        start, end = min(a for a, _ in found), max(b for _, b in found)
        assert (start, end) in found  # short contents may stand readable inside as well
        assert 4 <= start <= 25 and 25 + len(code) * 3 // 4 <= end <= 25 + len(code)


def test_escapes_without_compressed_bytes_add_nothing():
    rng = random.Random(1)
    for _ in range(200):
        data = bytes(rng.choices((0x1F, 0x8B, 8, 0x78, 0x9C, 66, 90, 104, 57, 43, 37, rng.randrange(256)), k=60))
        for way in WRITTEN.values():
            assert hidden(f"x {way(data)} y")[1] == 0


def test_many_beginnings_take_linear_time():
    assert hidden("%1F%8B%08" * 20_000 + "x^" * 20_000 + "\\x1f\\x8b\\x08 " * 20_000)[1] == 0


def test_runs_inside_a_line_break_are_hinted():
    code = wrapped(base64.b64encode(SECRET.encode()).decode(), 7)
    assert "coded" in hints_of(pa.array([code]))[0]


def test_escapes_map_code_point_by_code_point():
    assert hidden("x tok%65n=abc%64ef y")[0] == {("assign", 2, 18)}


def test_ends_on_cycles_and_on_bombs():
    bomb = base64.b64encode(gzip.compress(b"a" * (1 << 22))).decode()
    assert hidden(bomb, 1 << 20) == (set(), 1)
    assert hidden("%2525252525 \\u005cu0025 &#38;#37;")[1] == 0


@pytest.mark.parametrize("odd", ["\xa0", "\u200d", "\xad", "\ufeff", "\0", "\f"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_characters_that_do_not_print_hide_nothing(odd, pack):
    code = base64.b64encode(pack(f"one{odd}two {SECRET} three{odd}".encode())).decode()
    assert hidden(f"see {code} after")[0] == {("assign", 4, 4 + len(code))}


def test_escapes_take_no_room_and_map_within_long_texts():
    plain = "some words, and others. " * 2000
    text = f"{plain}tok%65n=abc%64ef {plain}pass%2577ord = \\u0068unter22 {plain}password%3A hunter22 {plain}password %3D hunter23"
    spans, refused = hidden(text, 100)
    assert not refused
    at = [text.index(s) for s in ("tok%", "pass%25", "password%3A", "password %3D")]
    ends = [at[0] + 16, at[1] + 28, at[2] + 20, at[3] + 21]
    assert {("assign", a, b) for a, b in zip(at, ends)} <= spans
    # nested beyond what may be looked at: counted, not endless
    assert hidden("%" + "25" * 5000 + "41", 100)[1] == 1


def test_split_runs_give_the_same_as_whole_texts():
    rng = random.Random(9)
    parts = ["password", " ", " ", ":", "=", "%3A", "%20", "\\u003d", "hunter22", "word", "&#61;", "\n", "\"", "%0A", CODED[:8], CODED[8:], "%2525", "41", "."]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(3, 14)))
        split = find_secrets(text, ALL, 1 << 20)[1]
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(secrets, "_CUT", re.compile("(?!)"))
            assert find_secrets(text, ALL, 1 << 20)[1] == split, text


def test_what_cannot_be_looked_at_is_masked(spark):
    bomb = base64.b64encode(gzip.compress(b"a b " * (1 << 20) + SECRET.encode())).decode()
    df = spark.createDataFrame([(1, f"before {bomb} after"), (2, "all is well %41")], "doc_id long, text string")
    assert [r.text for r in redact(df, most=1 << 20).collect()] == ["before [SECRET] after", "all is well %41"]
    assert [r.n_refused for r in scan_secrets(df, most=1 << 20).collect()] == [1, 0]


def test_failing_matches_still_take_their_text():
    assert base_spans("token=token:abcdef") == []
    assert base_spans("to\u212aen=abcdef \u017fecret=abcdef") == []  # letters of other scripts that fold to ASCII
    assert base_spans("API_KEY': \"Zz9+/_\"") == [("assign", 0, 17)]
    assert base_spans("AKIA" + "B" * 15 + " AKIA" + "B" * 16) == [("access", 20, 40)]
    assert base_spans("g" + "0a" * 12) == [("hex", 1, 25)]


def by_hand(text):
    text = text or ""
    assign = re.compile(
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
        r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    spans = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kind, a, b) for a, _, b, kind in sorted(spans)]


def same(rows, texts):
    wanted = []
    for doc, text in texts:
        base = by_hand(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        wanted.append(
            (doc, *(sum(k == kind for k, _, _ in base) for kind in ("assign", "access", "hex")), hashlib.sha256(joined.encode()).hexdigest())
        )
        assert set(joined.split(",")) <= set(next(r for r in rows if r.doc_id == doc and r.base_sha256 == wanted[-1][-1]).spans.split(","))
    assert sorted(map(repr, wanted)) == sorted(repr((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256)) for r in rows)


def test_rows_with_nulls_copies_and_clashing_columns(spark):
    texts = [(1, SECRET), (1, SECRET), (None, "token: abcdef"), (2, None), (3, ""), (4, "é" * 5000 + " " + "0a" * 5000)]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in texts], "doc_id long, text string, spans string, n_hex int")
    same(scan_secrets(df).collect(), texts)
    assert scan_secrets(df.limit(0)).count() == 0
    masked = redact(df)
    assert masked.schema == df.schema
    assert [r.text for r in masked.collect()][:5] == ["[SECRET]", "[SECRET]", "[SECRET]", None, ""]


def test_query_over_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = op3_secret_scans(spark, sf_dir).collect()
    same(rows, docs)
