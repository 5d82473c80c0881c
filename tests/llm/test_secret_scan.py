"""Secret scan against the definitions read literally."""
import hashlib
import re

from cargolens.llm import entry, secret_scan

DATA = "/root/testdata/sf0.01"
ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
                    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""")
RANDOM = "q8Zt4Lk0vXw2Rj7Bn5Hc9Ys3Gd6F"
TEXTS = [None, "", "password=short", "secret=token: abcdefgh1234", "TOKEN = 'abcd1234efgh'",
         "toKen=abcdefgh12", "é token:é", "AKIAAKIA1234567890 AKIA123",
         "f" * 31 + " " + "0" * 32, "api_key : \"" + RANDOM, f"see {RANDOM} there", "x " * 60_000 + RANDOM,
         "550e8400-e29b-41d4-a716-446655440000", "path/to/some_long_file_name_2024",
         "D41D8CD98F00B204E9800998ECF8427E", "a1" * 500_000]


def plain(text):
    text = text or ""
    spans = [("assign", m) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    spans += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    order = ("assign", "access", "hex")
    listed = ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in
                      sorted(spans, key=lambda s: (s[1].start(), order.index(s[0]))))
    return (*(sum(k == o for k, _ in spans) for o in order),
            hashlib.sha256(listed.encode()).hexdigest())


def check(docs, rows):
    assert len(docs) == len(rows)
    for r in rows:
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) == plain(docs[r["doc_id"]])
        base = [s for s in r["spans"].split(",") if s and not s.startswith("random")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r["base_sha256"]


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in
            spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    check(docs, entry.op2_secret_scan(spark, DATA).collect())


def test_odd_texts(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)],
                               "doc_id bigint, text string, spans int")
    check(dict(enumerate(TEXTS)), secret_scan.scan_table(df).collect())
    assert secret_scan.scan_table(df.where("false")).collect() == []


def test_random_strings():
    assert [s[1] for s in secret_scan.find(f"see {RANDOM} there")] == [3]
    for harmless in TEXTS[12:15]:
        assert secret_scan.find(harmless) == []


def test_redaction():
    text = f"a password={RANDOM} b {RANDOM} c"
    assert secret_scan.redact(text, secret_scan.find(text)) == "a [SECRET] b [SECRET] c"
    assert secret_scan.redact("plain", []) == "plain"


def test_values_of_names():
    for before, after in (("AUTH=", ""), ("DB_PWD=", "\n"), ("https://a.b/c?sig=", "&x=1"), ('AUTH="', '"'),
                          ("AUTH='", "'"), ("AUTH= ", ""), ("a==", "=="), ("export X=", ";"),
                          ("MY_LONG_SERVICE_ACCOUNT_AUTH=", " ")):
        text = f"see {before}{RANDOM}{after}"
        (start, kind, end), = secret_scan.find(text)
        assert (kind, text[start:end].rstrip("=")) == (3, RANDOM)
        hidden = f"see {before}[SECRET]{after.lstrip('=')}"
        assert secret_scan.redact(text, secret_scan.find(text)) == hidden
    for harmless in ("PATH=path/to/some_long_file_name_2024", "id=550e8400-e29b-41d4-a716-446655440000",
                     "name=some_long_variable_name", "md5=D41D8CD98F00B204E9800998ECF8427E"):
        assert secret_scan.find(harmless) == []
