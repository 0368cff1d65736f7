import random
import re

from registrar_feeds.llm import license_scan as L
from registrar_feeds.llm.license_texts import PHRASES, TEMPLATES
from tests.llm.helpers import CLASH, documents, edge_rows

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(str.maketrans(L.UPPER, L.LOWER)))


def base(text):
    w = words(text)
    places = sorted((i, label) for p, label in PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    return (len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None,
            ",".join(sorted({x for _, x in places})))


def test_matching_statistics():
    rng = random.Random(2)
    for _ in range(60):
        seqs = [[rng.randrange(3) for _ in range(rng.randint(1, 12))] for _ in range(rng.randint(1, 4))]
        auto = L.Automaton(seqs)
        text = [rng.randrange(4) for _ in range(40)]
        state, n = 0, 0
        for i, w in enumerate(text):
            state, n = auto.step(state, n, w)
            want = max((m for m in range(i + 2) if m == 0 or any(
                text[i + 1 - m:i + 1] == s[a:a + m] for s in seqs for a in range(len(s) - m + 1))))
            assert n == want
            if n:
                assert auto.ends[state] == {(k, a + n) for k, s in enumerate(seqs) for a in range(len(s) - n + 1)
                                            if text[i + 1 - n:i + 1] == s[a:a + n]}


def test_base_places():
    rng = random.Random(3)
    parts = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "MIT License", "x", "É", "cc-by", "the"]
    scanner = L.Scanner()
    for _ in range(300):
        text = " ".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert scanner.scan(text)[:5] == base(text)


def test_templates_and_their_variants():
    scanner = L.Scanner()
    for label, text in TEMPLATES.items():
        found = scanner.scan(f"some words before {text} and after")
        assert label in found[5].split(",") and found[6] == 1.0
    edited = TEMPLATES["mit"].replace("copyright notice", "legal notice").replace("person", "party")
    found = scanner.scan("x y " + edited)
    assert found[5] == "mit" and 0.6 < found[6] < 1 and found[7].startswith("mit:2:")
    assert scanner.scan(TEMPLATES["mit"][:300])[5:] == ("", 0.0, "")
    twice = scanner.scan(TEMPLATES["isc"] + " filler " * 100 + TEMPLATES["isc"])
    assert twice[7].count("isc:") == 2
    assert scanner.scan("free of charge to any person " * 50)[5] == ""


def test_versions_are_told_apart():
    labels = lambda text: set(L.Scanner().scan(text)[5].split(","))
    assert labels("under the GNU General Public License, version 2") == {"gpl", "gpl-2"}
    assert labels("This work is licensed under the GNU General Public License, version 3.") == {"gpl", "gpl-3"}
    assert labels("Apache License, Version 1.1") == {"apache", "apache-1.1"}
    assert labels("Licensed under the Apache License") == {"apache"}
    assert labels("Licensed under CC BY-NC 4.0.") == {"cc-by", "cc-by-nc-4.0"}
    assert labels("Licensed under CC BY-NC 3.0.") == {"cc-by"}
    assert labels(TEMPLATES["apache"]) == {"apache", "apache-2.0"}
    assert labels(TEMPLATES["apache"].replace("2.0", "9.0")) == {"apache"}
    assert labels(TEMPLATES["gpl"]) == {"gpl", "gpl-3"}
    assert "gpl-3" not in labels(TEMPLATES["gpl"].replace("either version 3", "either version 2"))
    assert {"bsd", "bsd-3"} == labels(TEMPLATES["bsd"])


def test_phrases_of_one_word():
    found = L.Scanner(phrases={"copyleft": "left", "mit license": "mit"}).scan("copyleft, x MIT License copyleft")
    assert found[:5] == (5, 3, 0, 4, "left,mit")


def chain_brute(found, gap):
    """Words of the best chain, over all of them."""
    def grow(i, total):
        a0, t0, n0 = found[i]
        return max([total, *(grow(j, total + found[j][2] - over) for j, (a, t, n) in enumerate(found)
                             for over in [max(0, a0 + n0 - a, t0 + n0 - t)]
                             if a0 < a and t0 < t and over < n and a - (a0 + n0) <= gap)])
    return max((grow(i, m[2]) for i, m in enumerate(found)), default=0)


def test_chains_equal_brute_force():
    rng = random.Random(5)
    scanner = L.Scanner(max_gap=4)
    k = max(range(len(scanner.labels)), key=scanner.sizes.__getitem__)
    for _ in range(300):
        found = sorted({(rng.randrange(30), rng.randrange(20), rng.randint(1, 6)) for _ in range(rng.randint(0, 8))})
        got = [c for c in scanner._best(k, found, 1) if c[0] == scanner.labels[k]]
        want = chain_brute(found, 4)
        assert round(max((c[3] for c in got), default=0) * scanner.sizes[k]) == want
        spans = sorted((a, b) for _, a, b, _ in got)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_many_notices_in_linear_time():
    text = (TEMPLATES["mit"] + " filler") * 1
    scanner = L.Scanner()
    found = scanner.scan(text * 1500)
    assert found[7].count("mit:") == 1500


def test_rows(spark):
    rows = edge_rows(3000) + [(30, "Released under the MIT License."), (31, TEMPLATES["bsd"])]
    got = {(r["doc_id"], r["n_words"], r["n_base"], r["labels"]) for r in L.scan(documents(spark, rows, CLASH)).collect()}
    assert {(d, n, m) for d, n, m, _ in got} == {(d, *base(t)[:2]) for d, t, *_ in rows}
    assert (30, 5, 1, "mit") in got and any(d == 31 and "bsd" in x for d, _, _, x in got)
    assert L.scan(documents(spark, [])).count() == 0
