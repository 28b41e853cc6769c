"""Centroids, packing and the filter audit against brute force, with every odd case among few rows."""

import hashlib
import math
import random
import re
import zlib
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from zonecast.llm import centroids, filter_audit, packing

WORDS = public_tokenizers.path("word_bpe_49k.json")


# --- centroids ---------------------------------------------------------------------------

def plain_clusters(vectors, config):
    """vec_id, values -> sorted (vec_id, cluster, distance, cluster inertia, inertia, digest)."""
    kept = [(i, [math.floor(float(x) * config.scale) for x in v]) for i, v in vectors
            if v is not None and len(v) == config.dimensions and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{config.seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in first[:config.clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), k) for k, m in enumerate(middle)) for _, v in kept]

    for _ in range(config.rounds):
        said = assign()
        for k in range(len(middle)):
            own = [v for (_, v), (_, c) in zip(kept, said) if c == k]
            if own:
                middle[k] = [sum(column) // len(own) for column in zip(*own)]
    said = assign()
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middle]
    return sorted((-1 if i is None else i, k, d, sum(x for x, c in said if c == k), sum(x for x, _ in said), digest[k])
                  for (i, _), (d, k) in zip(kept, said))


def cluster_rows(spark, vectors, config):
    frame = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in vectors], "vec_id long, embedding array<float>, v string, place int, cluster int")
    got = centroids.clustered(frame.repartition(3), config).collect()
    return sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got)


def test_centroids_equal_plain_rounds(spark):
    draw = random.Random(1)
    corners = [[draw.uniform(-1, 1) for _ in range(64)] for _ in range(6)]
    vectors = [(i, [np.float32(x + draw.gauss(0, 0.2)).item() for x in draw.choice(corners)]) for i in range(150)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(60)]  # a large group of equal vectors
    vectors += [(7, vectors[3][1]), (7, vectors[4][1]), (None, vectors[5][1]), (2000, None), (2001, [0.5] * 63), (2002, [0.5] * 63 + [float("nan")]),
                (2003, [0.5] * 63 + [float("inf")]), (2004, [0.5] * 63 + [None]), (2005, [])]
    for config in (centroids.ClusterConfig(clusters=12, block=16), centroids.ClusterConfig(clusters=12, sample=12)):
        assert cluster_rows(spark, vectors, config) == plain_clusters(vectors, config)


def test_centroids_large_values_and_few_vectors(spark):
    vectors = [(1, [400_000.0] * 64), (2, [-400_000.0] * 64), (3, [0.0] * 64), (4, [1.0] * 64)]
    assert cluster_rows(spark, vectors, centroids.ClusterConfig()) == plain_clusters(vectors, centroids.ClusterConfig())
    assert cluster_rows(spark, vectors + [(5, [1e30] * 64)], centroids.ClusterConfig()) == plain_clusters(vectors, centroids.ClusterConfig())
    assert cluster_rows(spark, [], centroids.ClusterConfig()) == []


def test_curve_visits_every_cell_by_steps_of_one():
    for axes, bits in ((2, 4), (3, 3), (5, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
        place = centroids.hilbert_place(grid, bits)
        assert sorted(place.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_boxes_leave_out_no_nearest_centroid():
    draw = np.random.default_rng(2)
    middle = draw.integers(-200, 200, (40, 64))
    own = draw.integers(-20, 20, (50, 64)) + middle[3]
    may = centroids.candidates(own.min(axis=0), own.max(axis=0), middle)
    assert len(may) < 40
    exact = np.square(own[:, None] - middle).sum(axis=2)
    assert (centroids.nearest(own, own.min(axis=0), own.max(axis=0), middle)[0] == exact.argmin(axis=1)).all()


# --- packing -----------------------------------------------------------------------------

def packed_rows(spark, texts, config):
    frame = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in texts], "doc_id long, text string, bin string, task int, at int")
    return packing.packed(frame.repartition(3), WORDS, config=config).collect()


def check_packing(rows, texts, config):
    library = Tokenizer.from_file(WORDS)
    want = []
    for i, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        for k, start in enumerate(range(0, len(ids), config.longest)):
            one = np.array(ids[start:start + config.longest], "<u4")
            want.append((-1 if i is None else i, k, start, len(one), zlib.crc32(one.tobytes())))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in held.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= config.tokens and len(own) <= config.documents and sum(n * n for _, n in own) <= config.cost
    return held


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    long_or_short = [draw.choice([3, 20, 60, 150, 400, 900]) for _ in range(400)]
    rows = [(i, " ".join(draw.choice(["alpha", "beta", "gamma", "Zwölf,", "end."]) for _ in range(n))) for i, n in enumerate(long_or_short)]
    return rows + [(500, None), (501, ""), (None, "no id"), (502, "again"), (502, "again"), (503, "word " * 2047), (504, "word " * 9000), (505, "a <|endoftext|> b")]


def test_packing_fills_sequences(spark, texts):
    for config, more in ((packing.PackConfig(), 1), (packing.PackConfig(group=50), 5), (packing.PackConfig(rule="dot"), 1)):
        held = check_packing(packed_rows(spark, texts, config), texts, config)
        total = sum(n for own in held.values() for _, n in own)
        assert len(held) <= -(-total // config.tokens) + more  # tiny groups of 50 pieces cost some sequences


def test_packing_keeps_every_capacity(spark, texts):
    for rule in ("norm", "dot"):
        config = packing.PackConfig(documents=5, cost=600_000, rule=rule, weights=(1.0, 0.3, 0.3), group=64)
        held = check_packing(packed_rows(spark, texts, config), texts, config)
        assert max(map(len, held.values())) == 5
    assert packed_rows(spark, [], packing.PackConfig()) == []


def test_best_fit_takes_the_tightest_sequence():
    config = packing.PackConfig(tokens=10, documents=10, cost=100)
    demands = np.array([[7, 1, 49], [6, 1, 36], [3, 1, 9], [4, 1, 16]])
    bins, inner = packing.best_fit(demands, config)
    assert bins.tolist() == [0, 1, 0, 1] and inner.tolist() == [0, 0, 7, 6]


# --- filter audit ------------------------------------------------------------------------

def plain_audit(docs, labels):
    """Every document through every order, step by step."""
    space = re.compile("[^\x20\x09-\x0D]+")
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = []
    for i, text, lang in docs:
        text = text or ""
        words = space.findall(text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                 "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and least[text] < i}
        own = [x for x in labels if i is not None and x[0] == i]
        rows.append((lang or "", fails, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        fair = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                fair[f] += len(gone)
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), sum(r[1][f] for r in mine) - len(gone), sum(r[1][f] and sum(r[1].values()) == 1 for r in mine),
                    sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                out[part, "".join(order), k + 1].append(fair[f])
    return out


def audit_rows(spark, docs, labels):
    frame = spark.createDataFrame([(i, t, lang, "x", 1, 2) for i, t, lang in docs], "doc_id long, text string, lang string, part string, failing int, n int")
    told = spark.createDataFrame([(*x, "x") for x in labels], "doc_id long, quality int, toxic int, good string")
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in filter_audit.audit(frame.repartition(3), told).collect()}


def test_audit_equals_step_by_step(spark):
    draw = random.Random(4)
    docs = []
    for i in range(120):
        n = draw.choice([0, 30, 99, 100, 101, 150])
        stock = draw.choice([5, 300, 5000])
        text = draw.choice([" ", "\n", "  ", "\x0b"]).join(draw.choice(["w", "Wör", "ABC", "é"] if draw.random() < 0.2 else ["v"]) + str(draw.randrange(stock)) for _ in range(n))
        docs.append((i, text + draw.choice(["", "", "", " #"]), draw.choice(["en", "de", "", None])))
    docs += [(200 + i, docs[3][1], "en") for i in range(20)] + [(5, docs[6][1], "de"), (300, None, "en"), (301, "", None), (None, docs[3][1], "en"), (None, "x", None),
             (302, "word " * 20_000, "en"), (7, docs[7][1], docs[7][2]), (400, "only one", "zz")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 200, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (6, None, None), (999, 1, 1)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    assert audit_rows(spark, docs, labels) == plain_audit(docs, labels)
    assert audit_rows(spark, [], labels) == {}
    assert audit_rows(spark, docs[:5], []) == plain_audit(docs[:5], [])


def test_positional_popcount():
    draw = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 7, 100, 1001):
        words = draw.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        assert filter_audit.positional_popcount(words).tolist() == [int(((words >> np.uint32(b)) & np.uint32(1)).sum()) for b in range(32)]
