"""The Jaccard join, the importance draw and the centroids against brute force, and on odd tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pruefspur.llm import centroids, importance, jaccard, kernels

DOCS = "doc_id long, text string, rank string, cluster int, _row int, component_id string, `a.b` int"
WORDS = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta", "zeta", "été", "Öl", "x1"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing", "ed", "er"]) for _ in range(n))


def texts():
    rng = random.Random(11)
    base = prose(rng, 120).split(" ")
    made = [" ".join(base)] * 4 + [" ".join(base).upper(), None, "", " \n\t ", "one", "ONE", "one two", "--- ---"]
    for _ in range(60):
        near = list(base)
        for _ in range(rng.randint(1, 6)):
            near[rng.randrange(len(near))] = prose(rng, 1)
        made.append(" ".join(near))
    made += [" ".join(base[: 120 - k]) for k in range(0, 40, 3)]
    made += ["a shared passage of the same few words " * 3 + prose(rng, rng.randint(1, 90)) for _ in range(60)]
    made += ["y" * 60_000, prose(rng, 20_000), "one two three " * 4000]
    return made


@pytest.fixture(scope="module")
def rows():
    found = [(i, t, "r", 1, 2, "c", 3) for i, t in enumerate(texts())]
    return [*found, found[0], found[70], (None, found[0][1], "r", 1, 2, "c", 3), (None, "words of no other text at all", "r", 1, 2, "c", 3)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text, size=3):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([b" ".join(words)]) if words else frozenset()
    return frozenset(b" ".join(words[i : i + size]) for i in range(len(words) - size + 1))


def grouped(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 90 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    first = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            first[find(i)] = min(r[0], first.get(find(i), r[0]))
    return sorted(
        ((r[0], len(s), first.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=repr
    )


@pytest.mark.parametrize("tile", [jaccard.TILE, 3])
def test_jaccard_join(docs, rows, tile):
    found = jaccard.join(docs, tile=tile)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == grouped(rows)


def test_jaccard_join_of_odd_tables(spark, nothing):
    assert jaccard.join(nothing).count() == 0
    named = spark.createDataFrame([("b", "one two three four"), ("a", "One two three four"), (None, None)], "doc_id string, text string")
    assert {tuple(r) for r in jaccard.join(named).collect()} == {("b", 2, "a"), ("a", 2, "a"), (None, 0, None)}


@pytest.mark.parametrize("percent", [50, 90, 100])
def test_tiles_lose_no_pair(spark, percent):
    """Every pair of sets in one cell that the sizes allow comes out of exactly those tiles that meet."""
    rng = random.Random(percent)
    sizes = [rng.randint(1, 400) for _ in range(60)] + [90, 100, 81, 900, 1000, 9, 10]
    rows = [(cell, 100 * cell + i, n, None, i % 5) for cell in (1, 2) for i, n in enumerate(sizes)]
    frame = spark.createDataFrame(rows, "cell long, node long, n long, nothing int, component long")
    signs = frame.select("node", F.array(*[F.lit(0).cast("bigint")] * 16).alias("bits"))
    got = {tuple(r) for r in jaccard.tiled(frame, signs, percent, 4).collect()}
    want = {
        (a[1], b[1])
        for a, b in itertools.combinations(rows, 2)
        if a[0] == b[0] and a[4] != b[4] and 100 * a[2] >= percent * b[2] and 100 * b[2] >= percent * a[2]
    }
    assert got == want


@pytest.mark.parametrize("percent", [50, 90])
def test_cells_keep_all_that_may_have_a_partner(spark, percent):
    rng = random.Random(percent)
    rows = [(i, rng.randint(1, 3000), sorted(rng.sample(range(300), 4))) for i in range(120)]
    frame = spark.createDataFrame(rows, "node long, n long, prefix array<long>")
    got = {(r["cell"], r["node"]) for r in jaccard.met(frame, percent).collect()}
    every = {(c, i) for i, _, p in rows for c in p}
    near = lambda a, b: 100 * a >= percent * b and 100 * b >= percent * a
    need = {(c, i) for i, n, p in rows for c in p if any(c in q and j != i and near(n, m) for j, m, q in rows)}
    assert need <= got < every


def test_prefixes_and_bit_counts_never_miss():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 50, 1 << jaccard.PLACE_BITS)
    rank = jaccard.order_of_places(counts)
    universe = kernels.mix(np.arange(5000, dtype=np.uint64))
    for _ in range(400):
        a = np.sort(rng.choice(universe, int(rng.integers(1, 300)), replace=False))
        b = np.unique(np.concatenate([rng.permutation(a)[: max(1, len(a) - int(rng.integers(0, 9)))], rng.choice(universe, int(rng.integers(0, 6)))]))
        common = len(np.intersect1d(a, b))
        differing = int(np.bitwise_count((jaccard.parity(a) ^ jaccard.parity(b)).view(np.uint64)).sum())
        assert common <= (len(a) + len(b) - differing) / 2
        if 100 * common >= 90 * (len(a) + len(b) - common):
            assert len(np.intersect1d(jaccard.prefix(a, rank), jaccard.prefix(b, rank)))


def test_wide_signatures_drop_unlike_sets_only(spark):
    rng = np.random.default_rng(4)
    universe = kernels.mix(np.arange(60_000, dtype=np.uint64))
    sets = [np.sort(rng.choice(universe, n, replace=False)) for n in (4000, 4200, 4096, 7900, 9000, 100, 2048)]
    sets += [np.union1d(s[k:], rng.choice(universe, k)) for s, k in zip(sets[:5], (90, 30, 3, 200, 470), strict=True)]
    rows = [(i, len(s), None if (w := jaccard.wide_parity(s)) is None else w.tolist()) for i, s in enumerate(sets)]
    nodes = spark.createDataFrame(rows, "node long, n long, wide array<long>")
    size = lambda i, j: 100 * len(sets[i]) >= 90 * len(sets[j]) and 100 * len(sets[j]) >= 90 * len(sets[i])
    pairs = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if size(i, j)]
    got = {tuple(r) for r in jaccard.finer(spark.createDataFrame(pairs, "a long, b long"), nodes).collect()}
    common = lambda i, j: len(np.intersect1d(sets[i], sets[j]))
    links = {(i, j) for i, j in pairs if 100 * common(i, j) >= 90 * (len(sets[i]) + len(sets[j]) - common(i, j))}
    assert len(links) == 5 and links == got


def plain_features(text, longest):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    return len(words), [b" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def drawn(rows, target, longest, percent):
    made = [plain_features(r[1], longest) for r in rows]
    source = Counter(zlib.crc32(g) % 10_000 for _, f in made for g in f)
    goal = Counter(zlib.crc32(g) % 10_000 for t in target for g in plain_features(t, longest)[1])
    s_all, t_all = sum(source.values()) + 10_000, sum(goal.values()) + 10_000
    gain = {b: math.floor(1000 * math.log((goal[b] + 1) * s_all / ((source[b] + 1) * t_all))) for b in source}
    out = []
    for r, (n, f) in zip(rows, made, strict=True):
        weight = sum(gain[zlib.crc32(g) % 10_000] for g in f)
        h = int(hashlib.sha256(f"2024:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n])
    able = sorted((x for x in out if x[5] >= 20), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for place, x in enumerate(able[: len(able) * percent // 100], 1):
        x[4] = place
    return sorted((tuple(x[:5]) for x in out), key=repr)


@pytest.mark.parametrize("longest,percent", [(1, 10), (3, 40)])
def test_importance(spark, docs, rows, longest, percent):
    goal = ["alpha alphas Été; zeta-beta", None, "", "passage of the same few words", "passage of the same few words"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(goal)], "item_id long, text string")
    found = importance.resample(docs, target, longest=longest, percent=percent).collect()
    assert sorted((tuple(r) for r in found), key=repr) == drawn(rows, goal, longest, percent)


def test_importance_of_odd_tables(spark, docs, nothing, rows):
    empty = spark.createDataFrame([], "text string")
    assert importance.resample(nothing, empty).count() == 0
    assert importance.resample(docs, empty).count() == len(rows)
    few = spark.createDataFrame([("b", "w " * 30), ("a", "w " * 30), ("b", "w " * 30), (None, "w " * 30)], "doc_id string, text string")
    found = importance.resample(few, empty, percent=100).collect()
    assert sorted(r["rank"] for r in found) == [1, 2, 3, 4]


def test_spans_of_a_text():
    words, counts = importance.features_of("One,  TWO three\n\n4 été", importance._patterns(2), 97)
    want = Counter(zlib.crc32(g.encode()) % 97 for g in "one two three 4 été one_two two_three three_4 4_été".replace("_", "\0").split(" ") for g in [g.replace("\0", " ")])
    assert words == 5 and {b: int(n) for b, n in enumerate(counts) if n} == dict(want)


def clustered(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    middle = [v for _, v in first]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min(range(len(middle)), key=lambda c: (apart(v, middle[c]), c))
    for _ in range(rounds):
        own = [[] for _ in middle]
        for _, v in kept:
            own[nearest(v)].append(v)
        middle = [[sum(c) // len(vs) for c in zip(*vs, strict=True)] if vs else m for vs, m in zip(own, middle, strict=True)]
    found = [(i, nearest(v), apart(v, middle[nearest(v)])) for i, v in kept]
    sums = Counter()
    for _, c, d in found:
        sums[c] += d
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middle]
    return sorted(((i, c, d, sums[c], sum(sums.values()), digest[c]) for i, c, d in found), key=repr)


def vectors(kind):
    rng = random.Random(kind)
    middle = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(9)]
    if kind == "blobs":
        made = [[x + rng.gauss(0, 0.2) for x in rng.choice(middle)] for _ in range(200)]
    elif kind == "line":
        made = [[0.25 * (i % 23)] + [1.0] * 63 for i in range(120)]
    elif kind == "equal":
        made = [[0.5] * 64 for _ in range(40)]
    else:
        made = [[rng.uniform(-50, 50) for _ in range(64)] for _ in range(7)]
    odd = [None, [], [1.0] * 63, [1.0] * 65, [None] + [1.0] * 63, [float("nan")] * 64, [float("inf")] + [0.0] * 63]
    rows = list(enumerate(made + odd))
    return [*rows, rows[0], rows[3], (None, made[1])]


@pytest.mark.parametrize("kind", ["blobs", "line", "equal", "few"])
def test_centroids(spark, kind):
    rows = vectors(kind)
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, cluster int, _id int")
    found = centroids.cluster(frame.repartition(3)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == clustered(rows)


def test_centroids_of_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    found = centroids.cluster(empty)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and found.count() == 0


def test_bounds_hold_and_rule_centroids_out():
    rng = np.random.default_rng(8)
    middle = rng.integers(-600, 600, (16, 64))
    points = np.repeat(middle, 40, axis=0) + rng.integers(-60, 60, (640, 64))
    frame = centroids.simplex(middle)
    apexes, size = frame.apexes(points)
    theirs, _ = frame.apexes(middle)
    for c in range(16):
        true = ((points - middle[c]) ** 2).sum(axis=1)
        base = ((apexes[:, :-1] - theirs[c, :-1]) ** 2).sum(axis=1)
        assert (base + (apexes[:, -1] - theirs[c, -1]) ** 2 <= true * (1 + 1e-9) + 1e-3).all()
        assert (base + (apexes[:, -1] + theirs[c, -1]) ** 2 >= true * (1 - 1e-9) - 1e-3).all()
    best, distance, computed = centroids.nearest(points, apexes, size, middle, frame)
    exact = ((points[:, None, :] - middle[None]) ** 2).sum(axis=2)
    assert (best == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert len(frame.pivots) == centroids.PIVOTS and computed < exact.size / 3


def test_cells_are_moved_once(spark):
    """The sums of cells and the join with them read one shuffle."""
    rows = [(i, 10 + i % 3, [i // 2, 1000 + i]) for i in range(40)]
    nodes = spark.createDataFrame(rows, "node long, n long, prefix array<long>")
    found = jaccard.met(nodes)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
