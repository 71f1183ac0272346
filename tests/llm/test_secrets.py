import hashlib

import pytest

from lakeforge.llm import secrets
from lakeforge.llm.queries import op6_secret_scan

from ..conftest import SF_SMALL
from .fixtures import frame, rows, same

VALUE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def assigns(t):
    """The assign pattern by hand, leftmost and non-overlapping."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    out, i = [], 0
    while i < len(t):
        name = next((k for k in ("password", "passwd", "secret", "token", "api_key", "apikey") if low.startswith(k, i)), None)
        j = i + len(name) if name else i
        if name:
            j += t[j:j + 1] in ("'", '"') and bool(t[j:j + 1])
            while t[j:j + 1] == " ":
                j += 1
            if t[j:j + 1] in (":", "=") and t[j:j + 1]:
                j += 1
                while t[j:j + 1] == " ":
                    j += 1
                j += t[j:j + 1] in ("'", '"') and bool(t[j:j + 1])
                k = j
                while k < len(t) and t[k] in VALUE:
                    k += 1
                if k > j:
                    if k - j >= 6:
                        out.append(("assign", i, k))
                    i = k
                    continue
        i += 1
    return out


def runs(t, kind, start, allowed, least):
    out, i = [], 0
    while i < len(t):
        if t.startswith(start, i):
            k = i + len(start)
            while k < len(t) and t[k] in allowed:
                k += 1
            if k > i + len(start):
                if k - i >= least:
                    out.append((kind, i, k))
                i = k
                continue
        i += 1
    return out


def base(t):
    found = assigns(t) + runs(t, "access", "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 20) + runs(t, "hex", "", set("0123456789abcdef"), 24)
    return sorted(found, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


TEXTS = ['password: token: abcdef123 x', 'TOKEN = "abcdefgh" api_key=xyz apikey: \'A1b2C3d4\'', "AKIA" + "A1" * 8 + " AKIAABC AKIA", "0123456789abcdef01234567f xyz" + "a" * 24,
         "paſſword=abcdefg toKen=123456", 'secret""=abcdef secret" : "a.b/c=d+e"', "token=" + "deadbeef" * 4 + "token=short", "password=\npassword= abcdefé", "pass word secret:=abcdef",
         "é日😀 passwd = hunter22 é", None, ""]


def test_base_spans():
    for t in TEXTS + [t for _, t in rows()]:
        assert [s for s in secrets.spans_of(t or "") if s[0] != "literal"] == base(t or ""), t


def test_scan(spark):
    data = [(i, t) for i, t in enumerate(TEXTS)] + rows()
    wanted = []
    for d, t in data:
        b = base(t or "")
        kinds = [s[0] for s in b]
        wanted.append((d, kinds.count("assign"), kinds.count("access"), kinds.count("hex"), secrets.joined(b), secrets.joined(secrets.spans_of(t or ""))))
    same(secrets.scan(frame(spark, data)).collect(), wanted)
    assert secrets.scan(frame(spark).limit(0)).collect() == []


@pytest.mark.parametrize(("text", "literals"), [
    ('db_password = "x9!kQ2zz"', ["x9!kQ2zz"]),
    ('A = "s3cr3t-V4lue-77"\nmore = 1\naccess_token = A\n', ["s3cr3t-V4lue-77"]),
    ('part = "q8Zr" + "T6-pL0w"\nclientSecret: part\n', ["q8Zr", "T6-pL0w"]),
    ("credentials:\n  private-key => 'Zx81-kkq0-99ab'\n", ["Zx81-kkq0-99ab"]),
    ('"passphrase": "correct1Horse2"', ["correct1Horse2"]),
    ('password = "changeme"', []),
    ('password = "${DB_PASSWORD}"', []),
    ('title = "x9!kQ2zzLongEnough"', []),
    ("the secret: love", []),
    ("monkey: banana42split", []),
])
def test_lexer(text, literals):
    assert [text[a:b] for k, a, b in secrets.spans_of(text) if k == "literal"] == literals


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    wanted = {d: hashlib.sha256(secrets.joined(base(t)).encode()).hexdigest() for d, t in docs}
    assert {r["doc_id"]: r["base_sha256"] for r in op6_secret_scan(spark, SF_SMALL).collect()} == wanted


@pytest.mark.parametrize(("text", "literals"), [
    ('db_password          =          "x9!kQ2zz"', ["x9!kQ2zz"]),
    ("client_secret\t\t\t\t\t\t\t\t\t=\tZx81-kkq0-99ab", ["Zx81-kkq0-99ab"]),
    ("service_" * 8 + 'password = "x9!kQ2zz"', ["x9!kQ2zz"]),
    ('part = "q8Zr"' + " " * 12 + "+" + " " * 12 + '"T6-pL0w"\nclientSecret: part\n', ["q8Zr", "T6-pL0w"]),
    ('db_password: str = "x9!kQ2zz"', ["x9!kQ2zz"]),
    ('def f(db_password: str="x9!kQ2zz"):', ["x9!kQ2zz"]),
    ('db_password: Optional[Dict[str, str]] | None = "x9!kQ2zz"', ["x9!kQ2zz"]),
    ('const apiKey: string = "x9!kQ2zz-4Lm"', ["x9!kQ2zz-4Lm"]),
    ('let password: &\'static str = "x9!kQ2zz"', ["x9!kQ2zz"]),
    ('A = client_secret = "Zx81-kkq0-99ab"', ["Zx81-kkq0-99ab"]),
    ('client_secret=B="Zx81-kkq0-99ab"\n', ["Zx81-kkq0-99ab"]),
    ("client_secret = B = Zx81-kkq0-99ab\n", ["Zx81-kkq0-99ab"]),
    ("client_secret=Zx81kkq099ab=", ["Zx81kkq099ab="]),
    ("client_secret: Zx81kkq099ab= # padded", ["Zx81kkq099ab="]),
    ("client_secret=Zx81kkq099ab=&x=1", ["Zx81kkq099ab=&x=1"]),
    ('os.environ["API_KEY"] = "x9!kQ2zz-4Lm"', ["x9!kQ2zz-4Lm"]),
    ("cfg['db']['password'] = 'x9!kQ2zz'", ["x9!kQ2zz"]),
    ('password["admin"] = "x9!kQ2zz"', ["x9!kQ2zz"]),
    ('get()["password"] = "x9!kQ2zz"', ["x9!kQ2zz"]),
    ('A="s3cr3t-V4lue-77"\naccess_token=$A\n', ["s3cr3t-V4lue-77"]),
    ('A="s3cr3t-V4lue-77"\naccess_token=${A}\n', ["s3cr3t-V4lue-77"]),
    ('A="s3cr3t-V4lue-77"\naccess_token="${A}"\n', ["s3cr3t-V4lue-77"]),
    ("--password=x9!kQ2zz 9.password=y8!kQ2zz", ["x9!kQ2zz", "y8!kQ2zz"]),
    ("access_token=${A}", []),
    ("password: string = changeme", []),
])
def test_lexer_without_caps(text, literals):
    assert [text[a:b] for k, a, b in secrets.spans_of(text) if k == "literal"] == literals


@pytest.mark.parametrize("part", ["a-", "a.", "a ", " ", "a=", "a = ", "a[b]=", "a[b]", "a: b[", "a: b ", 'a="', "a='\\'", "a: b=", "a:b<", "a::b", "a:b|", "a$", "${a"])
def test_lexer_is_linear(part):
    import time

    start = time.perf_counter()
    secrets.lexed("password " + part * 40_000)
    assert time.perf_counter() - start < 5


def sensitive_names():
    keys = list(secrets.SENSITIVE)
    names = [k for k in keys] + [f"{a}_{b}" for a in keys for b in keys] + ["pass_word", "pwD", "privateAccess", "api_access", "pass-phrase", "cre_dential"]
    return [n for n in names if secrets.name_weight(n) >= 2]


def test_every_sensitive_name_alone_in_its_text():
    assert len(sensitive_names()) > 200
    for name in sensitive_names():
        text = f'{name} = "aB3dE5fG7hI9"'
        alone = secrets.lexed(text)
        assert [text[a:b] for a, b in alone] == ["aB3dE5fG7hI9"], name
        assert [s for s in secrets.spans_of(text) if s[0] == "literal"] == [("literal", *s) for s in alone]
        assert secrets.lexed("# monkey\n" + text) == [(a + 9, b + 9) for a, b in alone] == secrets.lexed("# plain..\n"[:8] + "\n" + text)
