import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brindle.llm import secrets as sc


def plain(text):
    out = [("assign", *m.span()) for m in re.finditer(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda x: (x[1], sc.KINDS.index(x[0])))


BITS = ["token", "Password", "passwd", "SECRET", "api_key", "apiKEY", "ap", "ſecret", "toKen", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "=", ":", " ", "\n", '"', "'", "x", "é", "/", "+ ", "a = ", "\\"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=14).map("".join))
def test_base_equals_plain_patterns(text):
    base, more = sc.spans(text)
    assert base == plain(text)
    assert all(k == "lex" and 0 <= s < e <= len(text) for k, s, e in more)


@pytest.mark.parametrize("text, literal", [
    ('x = "Zq81kfLm20vv"\nmaster_pwd = x', "Zq81kfLm20vv"),
    ('db_passphrase: "Zq81kf$Lm20vv"', "Zq81kf$Lm20vv"),
    ("client_credential => 'Zq81kfLm20vv'", "Zq81kfLm20vv"),
    ('{"user": "bob", "signing_key": "Zq81kfLm20vv"}', "Zq81kfLm20vv"),
    ("export PRIVATE_KEY=Zq81kfLm20vv==", "Zq81kfLm20vv=="),
    ('part = "Zq81kf"\nencryptionKey = part + "Lm20vv"', "Lm20vv"),
    ('é auth_key := "Zq81kf!Lm20vv"', "Zq81kf!Lm20vv"),
])
def test_lexer_finds(text, literal):
    assert literal in [text[s:e] for _, s, e in sc.spans(text)[1]]


@pytest.mark.parametrize("text", ["The key: it was late", 'pwd = "changeme"', 'pass_name = "Zq81kfLm20vv"', "title: Zq81kfLm20vv", 'pwd = ""', "a == b", "key = value"])
def test_lexer_leaves(text):
    assert sc.spans(text)[1] == []


def test_long_text_is_linear():
    sc.spans("a=" * 300_000 + "'" * 1000)
    sc.spans("token" + " " * 500_000 + "x")
    sc.spans("k:" + "\\" * 300_001)


def test_scan(spark):
    rows = [(1, "token=abcdef AKIA" + "A" * 16), (2, None), (3, ""), (None, "f" * 24), (1, "token=abcdef AKIA" + "A" * 16)]
    got = sc.scan(spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, spans int")).collect()
    assert len(got) == 5
    assert {(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.spans) for r in got} == {(1, 1, 1, 0, "assign:0:12,access:13:33"), (2, 0, 0, 0, ""), (3, 0, 0, 0, ""), (None, 0, 0, 1, "hex:0:24")}
    assert next(r for r in got if r.doc_id == 2).base_sha256 == hashlib.sha256(b"").hexdigest()
    assert sc.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r.base_sha256 for r in sc.scan(docs).collect()}
    assert got == {r.doc_id: hashlib.sha256(sc.joined(plain(r.text)).encode()).hexdigest() for r in docs.collect()}


@pytest.mark.parametrize("text", [
    'auth_key = ("Zq81kf!Lm20vv")', 'auth_key = (\n    "Zq81kf!Lm20vv"\n)', 'auth_key = \\\n    "Zq81kf!Lm20vv"',
    'auth_key = """Zq81kf!Lm20vv"""', "auth_key = '''\nZq81kf!Lm20vv\n'''", 'a:\n  private_key: |\n    Zq81kf!Lm20vv\n  other: x', 'auth_keys_pwd = ["changeme", "Zq81kf!Lm20vv"]',
    'pwd: [\n  "changeme",\n  "Zq81kf!Lm20vv",\n]', 'api_token: str = "Zq81kf!Lm20vv"', 'pwd: Optional[str] = "Zq81kf!Lm20vv"',
])
def test_lexer_reads_on(text):
    assert "Zq81kf!Lm20vv" in [text[s:e] for _, s, e in sc.spans(text)[1]]


@pytest.mark.parametrize("text", ["pwd: (see\nZq81kfLm20vv, Qw45rtYu78zz", 'pwd = ("a"\n\n"Zq81kf!Lm20vv"', 'x: |\n  a\npwd_name: y\n"Zq81kf!Lm20vv"'])
def test_lexer_stops(text):
    assert sc.spans(text)[1] == []


def test_long_open_text_is_linear():
    sc.spans("a=(" * 100_000 + '"""' + "k: |\n" * 100_000 + "'''" * 3)
    sc.spans("k=[" + '"x",\n' * 200_000)


def took(text):
    began = time.perf_counter()
    sc.spans(text)
    return time.perf_counter() - began


MB = 1 << 20
HOSTILE = {
    "escaped quotes": '"' + '\\"' * (MB // 2) + "=", "escaped quotes on lines": 'a="' + ('\\"' * 300 + "\n") * (MB // 601), "sums": "pwd=" + "+" * MB, "bare sums": "pwd=" + "a+" * (MB // 2),
    "equals only": "a=b\n" * (MB // 4), "colons only": "a:b\n" * (MB // 4), "quotes": "a=" + "'\"" * (MB // 2), "keys": '{"a": ' * (MB // 6), "open": "a=(" * (MB // 3), "triple": "a='" + "''" * (MB // 2),
    "chain": "a=b0\n" + "".join(f'pwd{k} = pwd{k - 1} + "Zq8{k}"\n' for k in range(1, MB // 28)), "wide": "".join(f'a{k}="{chr(0x4E00 + k % 20000)}Zq8kfL1"\n' for k in range(30000)) + "pwd = " + " + ".join(f"a{k}" for k in range(30000)),
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_megabyte(name):
    assert took(HOSTILE[name]) < 4 * max(1.0, took("a='b'\n" * (MB // 6)))


def test_doubling_constants():
    text = 'a = "Zq81kf!Lm20vv"\n' + "a = a + a\n" * 40 + "b_password = a"
    assert took(text) < 0.05
    assert [text[s:e] for _, s, e in sc.spans(text)[1]] == ["Zq81kf!Lm20vv"]
    assert took('a = "Zq8!kf"\n' + "a = a + a\n" * 50_000 + "b_pwd = a") < 10


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b_pwd", "c1", "d.e", "signing-key"]), st.lists(st.one_of(st.sampled_from(["a", "b_pwd", "c1", "d.e"]), st.tuples(st.sampled_from("'\""), st.text("xY7!é \\", max_size=9))), min_size=1, max_size=3), st.sampled_from([" = ", " := ", ": ", " => "]), st.sampled_from(["", "# x", ";"])), max_size=10))
def test_values_against_a_reader_of_its_own(lines):
    """Random programs of sums of literals and names, written together with what each target must hold."""
    text, want, known = "", [], {}
    for target, terms, op, tail in lines:
        text += target + op
        value = []
        for k, term in enumerate(terms):
            text += " + " * (k > 0)
            if isinstance(term, tuple):
                inner = term[1].replace("\\", "\\\\")
                value.append((len(text) + 1, len(text) + 1 + len(inner)))
                text += term[0] + inner + term[0]
            elif term in known:
                value += known[term]
                text += term
            else:
                value.append((len(text), len(text) + len(term)))
                text += term
        known[target] = value
        want.append((target, value))
        text += tail + "\n"

    def flat(v):
        return [y for x in v.parts for y in (flat(x) if isinstance(x, sc.Value) else [x])]

    assert [(name, flat(v)) for name, v in sc.assigned(text)] == want
    whole = {name: "".join(text[s:e] for s, e in v) for name, v in known.items()}
    for name, v in sc.assigned(text):
        assert v.look(text).random() == pytest.approx(sc.look("".join(text[s:e] for s, e in flat(v))))
    assert whole or not lines
