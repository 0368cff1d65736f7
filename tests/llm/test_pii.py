import functools
import hashlib
import random
import re

from registrar_feeds.llm import pii as P
from tests.llm.helpers import CLASH, documents, edge_rows

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n) for i, n in enumerate(map(int, digits[::-1]))) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in value.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


@functools.cache  # quadratic in a long run of one character
def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def check(df, rows, **options):
    want = sorted((str(d), *(sum(x.startswith(k) for x in base(t)) for k in PATTERNS), hashlib.sha256(",".join(base(t)).encode()).hexdigest())
                  for d, t, *_ in rows)
    got = P.find_pii(df, **options).collect()
    assert sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got) == want
    return got


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(3)
    letters = list("0123456789") * 3 + list("..--  @@++()ab_%\né\U0001F600")
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 120)))) for i in range(800)]
    rows += [(900, "a@b.c@d.e_f@g.h"), (901, "4111 1111 1111 1111, 4111-1111-1111-1112"), (902, "+1 (555) 010-1234. 1.2.3.256 1.2.3.4.5")]
    check(documents(spark, rows), rows)


def test_edge_cases(spark):
    rows = edge_rows(3000) + [(60, "1" * 50_000), (61, "a" * 50_000), (62, "1." * 20_000), (63, "+" + "1 " * 20_000), (64, "1" + "." * 8_000 + "x"), (None, "x@y.zz")]
    check(documents(spark, rows, CLASH), rows)
    assert P.find_pii(documents(spark, [])).count() == 0


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(i, f"write to tel: +1 (555) 010-{i:04d} today") for i in range(60)]
    rows += [(100 + i, f"our tel: 555-{i:04d}99 is new") for i in range(10)]
    rows += [(200 + i, f"order tel. {i}234567 of the list") for i in range(10)]
    got = {r["doc_id"]: r for r in check(documents(spark, rows), rows)}
    for i in range(10):
        assert got[100 + i]["spans"] == "phone:9:19" and got[100 + i]["n_found"] == 1
        assert got[200 + i]["spans"] == "" and got[200 + i]["n_found"] == 0
    assert all(got[i]["n_found"] == 0 and got[i]["spans"] == base(rows[i][1])[0] for i in range(60))


def test_secrets_and_account_numbers(spark):
    rows = [(i, f'set token = "{i:02d}ab{i * 7919 + 10**8:x}ffeeddcc{i}" in it.') for i in range(12)]
    rows += [(50, "pay to DE89370400440532013000."), (51, "pay to DE89370400440532013001 now"), (52, "GB82WEST12345698765432")]
    rows += [(60, "api_key: sk-live-0011223344556677"), (61, "the token 12 of 2024-01-15 and key 5"), (62, "secret=abcdefghijklmnopqrstuv")]
    rows += [(63, "password is hunter2hunter2hunter222"), (64, "commit 0123456789abcdef0123456789abcdef01234567 of it")]
    got = {r["doc_id"]: r for r in check(documents(spark, rows), rows)}
    for i in range(12):
        start = rows[i][1].index('"') + 1
        assert got[i]["spans"] == f"secret:{start}:{rows[i][1].rindex(chr(34))}" and got[i]["n_secret"] == got[i]["n_found"] == 1
    assert got[50]["spans"] == "iban:7:29" and got[50]["n_iban"] == 1 and got[52]["spans"] == "iban:0:22"
    assert got[60]["spans"] == "secret:9:33" and got[63]["n_secret"] == 1
    assert all(got[i]["n_found"] == 0 for i in (51, 61, 62, 64))


def test_marks_discover_secrets_after_new_words(spark):
    known = [f"{i:02d}aa{i * 104729 + 10**9:x}bb{i}cc" for i in range(40)]
    rows = [(i, f"x api_key={v} y") for i, v in enumerate(known)]
    rows += [(100 + i, f"x nonce={v} y") for i, v in enumerate(known)] + [(200, "x nonce=ffee0011223344556677 y"), (201, "x nonsense=ffee9911223344556677 y")]
    got = {r["doc_id"]: r for r in check(documents(spark, rows), rows)}
    assert got[200]["spans"] == "secret:8:28" and got[100]["n_secret"] == 1
    assert got[201]["n_found"] == 0


def test_no_python_on_the_path(spark):
    plan = P.find_pii(documents(spark, [(1, "a@b.cc")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
