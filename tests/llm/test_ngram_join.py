import collections
import random
import re

import pytest

from registrar_feeds.llm import ngram_join as N
from tests.llm.helpers import CLASH, documents, edge_rows

WORD = re.compile("[^\x20\x09-\x0D]+")


def sets(text):
    w = WORD.findall((text or "").translate(str.maketrans(N.UPPER, N.LOWER)))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def groups(rows):
    """Row numbers of each component, by comparing all pairs."""
    s = [sets(t) for _, t, *_ in rows]
    root = list(range(len(s)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(s)):
        for j in range(i):
            both = len(s[i] & s[j])
            if both and 100 * both >= 80 * (len(s[i]) + len(s[j]) - both):
                root[find(i)] = find(j)
    out = collections.defaultdict(list)
    for i in range(len(s)):
        out[find(i)].append(i)
    return s, list(out.values())


def brute(rows):
    s, found = groups(rows)
    return sorted(((rows[i][0], len(s[i]), min((rows[j][0] for j in g if rows[j][0] is not None), default=None))
                   for g in found for i in g), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    docs = []
    for _ in range(50):
        text = [rng.choice(vocab) for _ in range(rng.randint(1, 140))]
        for _ in range(rng.choice([1, 1, 2, 3, 12])):
            x = list(text)
            for _ in range(rng.randint(0, 4)):
                if rng.random() < .7:
                    x[rng.randrange(len(x))] = rng.choice(vocab)
            docs.append(" ".join(x))
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    docs += [passage + " " + " ".join(rng.choice(vocab) for _ in range(rng.randint(3, 60))) for _ in range(60)]
    rows = list(enumerate(docs))
    rng.shuffle(rows)
    return rows


def run(df, **options):
    return sorted((tuple(r) for r in N.component_ids(N.near_groups(df, **options)).collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"chunk_keys": 400, "tile_shingles": 300, "pivots": 1}])
def test_components_equal_all_pairs(spark, options):
    rows = corpus(5)
    assert run(documents(spark, rows).repartition(6), **options) == brute(rows)


def test_edge_cases(spark):
    rows = edge_rows(4000) + [(40, "A b"), (41, "a B"), (42, "a b c")]
    assert run(documents(spark, rows, CLASH).repartition(3)) == brute(rows)
    assert run(documents(spark, [])) == []
    assert run(documents(spark, [(1, None), (2, "")])) == [(1, 0, 1), (2, 0, 2)]


def test_one_of_each(spark):
    rows = edge_rows(500) + corpus(9)[:80]
    df = documents(spark, rows, CLASH)
    out = N.one_of_each(df)
    assert out.columns == df.columns
    _, found = groups(rows)
    want = []
    for g in found:
        best = min(g, key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
        want.append((rows[best][0], rows[best][1]))
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert sorted(x[0] if x[0] is not None else -1 for x in got) == sorted(x[0] if x[0] is not None else -1 for x in want)
    assert N.one_of_each(documents(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(40)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["u"]: r["root"] for r in N.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {x: find(x) for p in pairs if p[0] != p[1] for x in p}


def test_bound_never_drops_a_link():
    words = N._Words()
    rng = random.Random(4)
    base = [f"v{rng.randrange(50)}" for _ in range(200)]
    tile = N.Tile()
    texts = []
    for i in range(40):
        x = list(base)
        for _ in range(rng.randint(0, 12)):
            x[rng.randrange(200)] = "edit"
        texts.append(" ".join(x))
        tile.add(i, N.shingles(texts[-1], words), i)
    root = list(range(40))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in tile.links():
        root[find(a)] = find(b)
    _, want = groups([(i, t) for i, t in enumerate(texts)])
    got = collections.defaultdict(set)
    for i in range(40):
        got[find(i)].add(i)
    assert {frozenset(g) for g in got.values()} == {frozenset(g) for g in want}


def test_components_that_do_not_settle_are_an_error(spark):
    path = spark.range(200).selectExpr("id as u", "id + 1 as v")
    with pytest.raises(RuntimeError, match="did not settle"):
        N.components(path, rounds=1)


def templated(n, common=11, fill=1):
    """Texts that share their words but for the last ones: 7 of 8 shingles, no link."""
    return [(i, " ".join([f"c{k}" for k in range(common)] + [f"own{i}x{k}" for k in range(fill)])) for i in range(n)]


def test_templates_below_the_threshold_make_no_candidates(spark):
    rows = templated(3000) + [(5000, "some other text of quite a few words here"), (5001, "some other text of quite a few words here")]
    docs = documents(spark, rows).repartition(7)
    found = N.document_sets(docs, universe=1.0, chunk_keys=2000)
    keys = N.first_keys(found, universe=1.0)
    assert keys.count() >= 3000
    ids = {r["uid"]: r["doc_id"] for r in found.collect()}
    assert {ids[x] for r in N.stars(keys).collect() for x in r} <= {5000, 5001}
    assert run(docs, tile_shingles=5000) == sorted([(i, 8, i) for i in range(3000)] + [(5000, 5, 5000), (5001, 5, 5000)], key=str)


def test_templates_of_many_sizes_equal_all_pairs(spark):
    rng = random.Random(8)
    rows = [(i, " ".join([f"c{k}" for k in range(44)] + [f"own{i}x{k}" for k in range(rng.randint(0, 14))])) for i in range(120)]
    rows += [(200 + i, " ".join(f"c{k}" for k in range(rng.randint(30, 44)))) for i in range(30)]
    want = brute(rows)
    assert 2 < len({r[2] for r in want}) < 120
    for options in ({}, {"chunk_keys": 500, "tile_shingles": 300, "pivots": 1}):
        assert run(documents(spark, rows).repartition(5), **options) == want


@pytest.mark.parametrize("across", [False, True])
def test_tile_links_connect_what_all_pairs_connect(across):
    rng = random.Random(9)
    for _ in range(12):
        tile, sets_, sides = N.Tile(), [], []
        pools = [rng.sample(range(10_000), rng.randint(1, 60)) for _ in range(6)]
        for i in range(90):
            s = set(rng.choice(pools))
            for _ in range(rng.randint(0, 6)):
                s.add(rng.randrange(10_000))
                if rng.random() < .5 and len(s) > 1:
                    s.remove(rng.choice(sorted(s)))
            sets_.append(s)
            sides.append(rng.random() < .5)
            tile.add(i, N.np.array(sorted(s), N.np.uint64), i, sides[-1])

        def parts(links):
            root = list(range(90))

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x
            for a, b in links:
                root[find(a)] = find(b)
            return {frozenset(x for x in range(90) if find(x) == r) for r in map(find, range(90))}

        links = [(a, b) for a in range(90) for b in range(a)
                 if 180 * len(sets_[a] & sets_[b]) >= 80 * (len(sets_[a]) + len(sets_[b])) and not (across and sides[a] == sides[b])]
        assert parts(tile.links(across)) == parts(links)
