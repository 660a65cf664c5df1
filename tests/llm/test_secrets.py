import base64
import bz2
import gzip
import random
import re
import time
import urllib.parse
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import cases
from tilewright.llm import secrets as S

SECRET = "token = abcDEF123456"


def spans_of(text):
    return S.scan(text)[1]


def test_base_contract():
    text = 'PassWord: "abc" api-key secret=abcdef api_key=ABCDEFG token:: x AKIA' + "A" * 16 + " " + "0f" * 12 + " " + "0f" * 11
    kinds = [k for k, _, _ in S.scan(text)[0]]
    assert kinds.count("assign") == 2 and kinds.count("access") == 1 and kinds.count("hex") == 1
    assert S.scan("ſecret=abcdefg Key token=abcde")[0] == []  # ASCII letters only, five are too few
    assert S.scan("secret: token=abcdef")[0] == [("assign", 0, 20)]


@given(st.text(alphabet="token=:secret abcdef0123456789AKI\"' é", max_size=120))
@settings(max_examples=200, deadline=None)
def test_base_is_the_plain_search(text):
    plain = [("assign", m.start(), m.end()) for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII) if len(m[2]) >= 6]
    plain += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    plain += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 24]
    base, found, _ = S.scan(text)
    assert base == sorted(plain, key=lambda x: (x[1], S.KINDS.index(x[0]), x[2])) and set(base) <= set(found)


def test_layers_map_to_the_original():
    quote = urllib.parse.quote(SECRET, safe="")
    b64 = lambda b: base64.b64encode(b).decode()
    escaped = "".join(f"\\u{ord(c):04x}" for c in SECRET)
    for hidden in (quote, escaped, b64(SECRET.encode()), b64(gzip.compress(SECRET.encode())), b64(zlib.compress(SECRET.encode())), b64(bz2.compress(SECRET.encode())),
                   b64(quote.encode()), urllib.parse.quote(b64(escaped.encode()), safe=""), b64(b64(b64(SECRET.encode()).encode()).encode()),
                   "".join(f"&#{ord(c)};" for c in SECRET), b64(zlib.compress(gzip.compress(quote.encode())))):
        text = f"é before {hidden} after"
        found = [x for x in spans_of(text) if x[0] == "assign"]
        assert found, hidden
        start, end = min(s for _, s, _ in found), max(e for _, _, e in found)
        at = text.index(hidden)
        assert at <= start < end <= at + len(hidden), hidden
    text = "xx " + quote
    (_, s, e), = [x for x in spans_of(text) if x[0] == "assign"]
    assert (s, e) == (3, len(text))


def test_cycles_and_plain_text_end():
    assert spans_of("%25" * 500) == [] and spans_of("abcdefgh" * 2000) == []
    text = "%2561"
    for _ in range(60):
        text = urllib.parse.quote(text, safe="")
    assert {k for k, _, _ in spans_of(text)} == {"hex"}  # the digits of "%2525..." themselves


def test_documents(spark):
    df = cases.frame(spark)
    out = S.scan_documents(df, ["doc_id"]).collect()
    assert len(out) == len(cases.rows()) and all(r.spans == "" for r in out)
    assert S.scan_documents(cases.empty(spark), ["doc_id"]).count() == 0
    marked = S.redact_documents(spark.createDataFrame([(1, f"a {SECRET} b", "z"), (2, None, "z"), (3, "", None)], "doc_id int, text string, spans string")).collect()
    assert [r.text for r in sorted(marked)] == ["a [SECRET] b", None, ""]


def test_long_streams_are_scanned_to_the_end(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 1000)
    plain = ("é filler " * 700) + SECRET + (" é filler" * 300)
    for pack in (gzip.compress, bz2.compress, lambda b: gzip.compress(bz2.compress(b)), lambda b: gzip.compress(b"x" * 3000) + gzip.compress(b), lambda b: gzip.compress(b"\xff" * 3000 + b)):
        hidden = base64.b64encode(pack(plain.encode())).decode()
        found = spans_of("see " + hidden)
        assert [x for x in found if x[0] == "assign" and 4 <= x[1] < x[2] <= 4 + len(hidden)], pack
    broken = base64.b64encode(gzip.compress(plain.encode())[:60]).decode()
    assert S.scan(broken)[0] == []


def test_regions_longer_than_a_piece_are_found_at_every_alignment(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 500)
    rng = random.Random(4)
    noise = "".join(rng.choice("bcdfghjkmnpqrstvwxyz") for _ in range(900))
    region = base64.b64encode(f"{noise} {SECRET} {noise}".encode()).decode()
    lines = "\n".join(region[k : k + 76] for k in range(0, len(region), 76))
    for inner in (region, lines, urllib.parse.quote(f"{noise} {SECRET}", safe="")):
        for shift in range(0, 500, 23):
            body = f"{'word one ' * 80}{'x' * shift} {inner} {'word two ' * 80}"
            hidden = base64.b64encode(gzip.compress(body.encode())).decode().rstrip("=")
            assert ("assign", 0, len(hidden)) in [(k, s, min(e, len(hidden))) for k, s, e in spans_of(hidden)], (inner[:9], shift)


def test_every_place_of_a_repeated_layer_is_reported():
    for hide in (lambda t: base64.b64encode(t.encode()).decode(), lambda t: urllib.parse.quote(t, safe=""), lambda t: base64.b64encode(gzip.compress(t.encode(), mtime=0)).decode()):
        hidden = hide(SECRET)
        twice = f"first {hidden} middle {hidden} last"
        assert len([x for x in spans_of(twice) if x[0] == "assign"]) == 2
        nested = hide(f"{twice} end")
        text = f"a {nested} b {nested} c {hidden}"
        places = {s for k, s, _ in spans_of(text) if k == "assign"}
        b, c = text.index(" b "), text.rindex(" c ")
        assert [sum(s < b for s in places), sum(b < s < c for s in places), sum(c < s for s in places)] in ([2, 2, 1], [1, 1, 1])  # a stream's findings share its span
        assert not [x for x in spans_of(S.redact(text, spans_of(text), "[SECRET]")) if x[0] == "assign"]


ENCODERS = {
    "url": lambda t: urllib.parse.quote(t, safe=""), "b64": lambda t: base64.b64encode(t.encode()).decode(), "gz": lambda t: base64.b64encode(gzip.compress(t.encode(), mtime=0)).decode(),
    "bz": lambda t: base64.b64encode(bz2.compress(t.encode())).decode(), "u": lambda t: "".join(f"\\u{ord(c):04x}" for c in t), "ent": lambda t: "".join(f"&#{ord(c)};" for c in t),
}


@given(st.lists(st.tuples(st.booleans(), st.lists(st.sampled_from(sorted(ENCODERS)), max_size=4)), min_size=1, max_size=6))
@settings(max_examples=120, deadline=None)
def test_nested_encodings_against_their_construction(parts):
    """What was hidden, and where, is known: each secret is reported inside its own part, and clean parts stay clean."""
    text, places = "start", []
    for secret, chain in parts:
        part = SECRET if secret else "nothing to see here"
        for name in chain:
            part = ENCODERS[name](f"in {part} out")
        text += " | "
        places.append((secret, len(text), len(text) + len(part)))
        text += part
    found = [x for x in spans_of(text) if x[0] == "assign"]
    for secret, s, e in places:
        assert secret == any(s <= a < b <= e for _, a, b in found)
    assert all(any(s <= a < b <= e for _, s, e in places) for _, a, b in found)
    assert not [x for x in spans_of(S.redact(text, spans_of(text), "[SECRET]")) if x[0] == "assign"]


def test_long_runs_take_linear_time():
    for text in ("a/b" * 350_000 + " %41", "%4" * 300_000, "secret " * 100_000, "x\n" * 400_000, "token" + " " * 10**6):
        began = time.time()
        S.scan(text)
        assert time.time() - began < 10, text[:9]


def test_clashing_names(spark):
    out = S.scan_documents(spark.createDataFrame([(1, SECRET, "z", 5)], "spans int, text string, base string, n_layers int"), ["spans", "base", "text", "n_layers"])
    assert out.columns == ["spans", "base", "text", "n_layers", "n_assign", "n_access", "n_hex", "base_", "spans_", "n_layers_"]
    assert out.first()["spans_"] == f"assign:0:{len(SECRET)}"


def test_glued_wrapped_and_damaged_regions():
    b64 = lambda b: base64.b64encode(b).decode()
    wrap = lambda t, end="\n": end.join(t[i : i + 76] for i in range(0, len(t), 76))
    long = (" ".join(f"filler{k * k}" for k in range(200)) + " " + SECRET).encode()
    hidden = [prefix + b64(pack(SECRET.encode())) for prefix in ("/v1/", "path/", "cfg_", "x-", "abcdefghijklmno/pq_") for pack in (bytes, gzip.compress, zlib.compress, bz2.compress)]
    hidden += [prefix + wrap(b64(pack(long)), end) for prefix in ("", "cfg_") for end in ("\n", "\r\n", "\n  ") for pack in (bytes, gzip.compress, bz2.compress)]
    hidden += [b64(b"\xff" + SECRET.encode()), b64(b"\0" * 50 + SECRET.encode() + b"\0\xe9"), "%FF" + urllib.parse.quote(SECRET, safe=""), urllib.parse.quote(SECRET, safe="") + "%E9", "k=" + b64(SECRET.encode()) + "/v2"]
    for part in hidden:
        text = f"é before {part} after"
        at = text.index(part)
        found = [x for x in spans_of(text) if x[0] == "assign"]
        assert found, part
        assert all(at <= s < e <= at + len(part) for _, s, e in found), part
        left = S.redact(text, S.scan(text)[1], " ")
        assert not [x for x in spans_of(left) if x[0] == "assign"], part
    text = "cfg_" + b64("\u00e9".encode("latin-1") + SECRET.encode())  # byte 1 lies in characters 1 and 2 of the base64
    assert [(s, e) for k, s, e in spans_of(text) if k == "assign"] == [(5, len(text))]


def test_texts_are_held_some_at_a_time_and_memory_is_given_back(monkeypatch):
    import pyarrow as pa

    from tilewright.sources import shared

    class Frame:
        schema = None

        def mapInArrow(self, run, shape):  # noqa: N802
            return run

    given = []
    monkeypatch.setattr(shared, "give_back", lambda: given.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(["password=abcdef1"] * 1000)], ["id", "text"])
    out = list(S.redact_documents(Frame())(iter([batch])))
    assert max(b.num_rows for b in out) == S.ROWS < 1000 and given == [1]
    whole = pa.Table.from_batches(out)
    assert whole["id"].to_pylist() == list(range(1000)) and set(whole["text"].to_pylist()) == {"[SECRET]"}
