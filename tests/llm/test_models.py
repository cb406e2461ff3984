"""Product codes, clustering and the language model against brute force, and their edge cases."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import codes, forward, hmm, vectors, yinyang

SCHEMA = "vec_id long, embedding array<float>, label int"


def rows_of(n, dims=64, seed=1, spread=0.3):
    draw = np.random.default_rng(seed)
    middles = draw.normal(size=(12, dims))
    return [(int(i) * 7 + 3, [float(np.float32(x)) for x in middles[i % 12] + spread * draw.normal(size=dims)], None if i % 5 == 0 else i % 4) for i in range(n)]


def whole(vector):
    return [min(max(math.floor(256 * x), -vectors.MOST), vectors.MOST) for x in vector]


def usable(vector, dims=64):
    return vector is not None and len(vector) == dims and all(x is not None and math.isfinite(x) for x in vector)


def brute_codes(rows, entries=64, rounds=2, parts=16):
    kept = sorted(((i is None, i or 0, whole(v), i, label) for i, v, label in rows if usable(v)), key=lambda r: r[:3])
    data = np.array([r[2] for r in kept], np.int64).reshape(len(kept), parts, -1)
    books = data[:entries].copy()
    for turn in range(rounds + 1):
        best, error = np.empty((len(kept), parts), int), np.zeros(len(kept), np.int64)
        for p in range(parts):
            far = ((data[:, p, None, :] - books[None, :, p]) ** 2).sum(axis=2)
            best[:, p] = far.argmin(axis=1)
            error += far.min(axis=1)
        for p in range(parts if turn < rounds else 0):
            for e in range(len(books)):
                if (best[:, p] == e).any():
                    own = data[best[:, p] == e, p]
                    books[e, p] = [int(s) // len(own) for s in own.sum(axis=0)]
    digest = hashlib.sha256(",".join(str(x) for p in range(parts) for e in range(len(books)) for x in books[e, p]).encode()).hexdigest()
    sums = Counter()
    for r, x in zip(kept, error, strict=True):
        sums[r[4]] += int(x)
    return Counter((r[3], "".join(f"{e:02x}" for e in b), int(x), sums[r[4]], digest) for r, b, x in zip(kept, best, error, strict=True))


def brute_clusters(rows, n=40, rounds=5):
    kept = [(i, whole(v)) for i, v, _ in rows if usable(v)]
    ranked = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    data, middles = np.array([v for _, v in kept], np.int64), np.array([v for _, v in ranked[:n]], np.int64)
    for turn in range(rounds + 1):
        far = ((data[:, None] - middles[None]) ** 2).sum(axis=2)
        best = far.argmin(axis=1)
        for c in range(len(middles) if turn < rounds else 0):
            if (best == c).any():
                own = data[best == c]
                middles[c] = [int(s) // len(own) for s in own.sum(axis=0)]
    least = far.min(axis=1)
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middles]
    return Counter((i, int(c), int(d), int(least[best == c].sum()), int(least.sum()), digest[c]) for (i, _), c, d in zip(kept, best, least, strict=True))


ODD = [
    (1, None, 1),
    (2, [], 1),
    (3, [0.5] * 63 + [None], 1),
    (4, [0.5] * 63 + [float("nan")], 1),
    (5, [0.5] * 63 + [float("inf")], 2),
    (6, [0.5] * 32, 2),
    (6, [0.25] * 65, 2),
    (None, [0.5] * 64, None),
    (None, [-0.5] * 64, None),
    (8, [1e30] + [0.0] * 63, 1),
    (8, [-1e30] + [0.0] * 63, 1),
    (9, [-0.001] * 64, 1),
    (9, [-0.001] * 64, 1),
    (10, [0.0] * 64, 3),
]


def frame(spark, rows, parts=3):
    made = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    for name in ("data", "block", "ids", "labels", "code", "error", "own", "_label", "cluster", "distance"):
        made = made.withColumn(name, F.lit("x"))
    return made


def got(result):
    return Counter(tuple(r) for r in result.collect())


@pytest.mark.parametrize("n", [7, 300])
def test_codes_and_clusters_equal_brute_force(spark, n):
    rows = rows_of(n) + ODD
    made = frame(spark, rows)
    assert got(codes.compress(made)) == brute_codes(rows)
    assert got(yinyang.clusters(made)) == brute_clusters(rows)


def test_ties_go_to_the_lower_number(spark):
    """Equal vectors under many ids: every distance is a tie."""
    rows = [(i, [float(i % 3)] * 64, 1) for i in range(200)]
    assert got(codes.compress(frame(spark, rows))) == brute_codes(rows)
    assert got(yinyang.clusters(frame(spark, rows))) == brute_clusters(rows)


def test_without_usable_vectors(spark):
    for rows in ([], ODD[:5]):
        made = frame(spark, rows, 1)
        for out, columns in ((codes.compress(made), ["vec_id", "code", "error", "label_error", "codebooks_sha256"]), (yinyang.clusters(made), ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])):
            assert out.columns == columns and not out.collect()


def test_filters_spare_distances(spark):
    """On vectors that lie in clusters most distances are never worked out after the first round."""
    _, _, worked = yinyang.cluster(frame(spark, rows_of(3000, spread=0.05)))
    assert worked[0] == 3000 * 40 and sum(worked[3:]) < 0.3 * 3 * 3000 * 40


def test_bounds_hold_at_every_step():
    """The centroid is the nearest, and no lower bound exceeds the distance that it stands for, through random moves."""
    draw = np.random.default_rng(5)
    columns, middles = draw.integers(-60, 60, (8, 500)), draw.integers(-60, 60, (20, 8))
    group = yinyang.grouped(middles, 5)
    own, upper, lower, drift = np.full(500, -1, np.int32), np.zeros(500), np.zeros((500, group.max() + 1)), np.zeros(20)
    for _ in range(8):
        yinyang.step(columns, middles, group, drift, own, upper, lower)
        far = ((columns.T[:, None] - middles) ** 2).sum(axis=2)
        assert (own == far.argmin(axis=1)).all() and (upper >= np.sqrt(far.min(axis=1))).all()
        others = np.sqrt(np.where(np.arange(20) == own[:, None], 1e20, far))
        for g in range(lower.shape[1]):
            assert (lower[:, g] <= others[:, group == g].min(axis=1)).all()
        before, middles = middles, middles + draw.integers(-4, 5, middles.shape)
        drift = np.sqrt(((middles - before) ** 2).sum(axis=1).astype(float))


# ---- the language model


def plain(sequence, table, begins, moves):
    """(log-likelihood, emissions, first states, moves) of one sequence by the textbook."""
    ahead, scales = [], []
    for t, w in enumerate(sequence):
        now = (begins if not t else ahead[-1] @ moves) * table[w]
        scales.append(now.sum())
        ahead.append(now / now.sum())
    after = [np.ones(len(begins))]
    for t in range(len(sequence) - 2, -1, -1):
        after.insert(0, moves @ (table[sequence[t + 1]] * after[0]) / scales[t + 1])
    emitted, moved = np.zeros_like(table), np.zeros_like(moves)
    for t, w in enumerate(sequence):
        emitted[w] += ahead[t] * after[t]
        if t:
            moved += moves * np.outer(ahead[t - 1], table[w] * after[t] / scales[t])
    return sum(map(math.log, scales)), emitted, ahead[0] * after[0], moved


@pytest.mark.parametrize("chunk", [1, 2, 5, 64])
def test_recursions_in_chunks_equal_the_textbook(chunk, monkeypatch):
    monkeypatch.setattr(forward, "AT_ONCE", 50)
    draw = np.random.default_rng(chunk)
    table, moves, begins = draw.random((9, 3)) * 1e-6, draw.random((3, 3)), draw.random(3)
    moves, begins = moves / moves.sum(axis=1, keepdims=True), begins / begins.sum()
    lengths = draw.integers(1, 60, 25)
    each = [draw.integers(0, 9, n) for n in lengths]
    want = [plain(s, table, begins, moves) for s in each]
    assert np.allclose(forward.likelihoods(np.concatenate(each), lengths, table, begins, moves, chunk), [w[0] for w in want], rtol=1e-12)
    for mine, k in zip(forward.counts(np.concatenate(each), lengths, table, begins, moves, chunk), (1, 2, 3), strict=True):
        assert np.allclose(mine, sum(w[k] for w in want))


def tokens_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w.encode() for w in hmm.re.split("[\x20\x09-\x0d]+", lower) if w] + [b""]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def brute_scores(spark, rows, n, rounds, least):
    texts = [(i, tokens_of(t)) for i, t in rows]
    counts = Counter(w for i, ws in texts if not held(i) for w in ws)
    total, words = sum(counts.values()), len(counts)
    base = lambda c: (c + 0.5) / (total + 0.5 * (words + 1))
    own = sorted(w for w in counts if counts[w] >= least)
    rare = [w for w in counts if counts[w] < least]
    number = {w: k + 2 for k, w in enumerate(own)} | dict.fromkeys(rare, 0)
    lump = sum(base(counts[w]) for w in rare)
    weights = {
        bytes(r[0]): [math.exp(r[k + 1] / 1000 * hmm.SPREAD) for k in range(n)]
        for r in spark.createDataFrame([(w,) for w in own] or [(b"-",)], "w binary").select("w", *(F.pmod(F.xxhash64("w", F.lit(k)), F.lit(1000)) for k in range(n))).collect()
    }
    emitted = np.array([[sum(counts[w] for w in rare)] * n, [0.0] * n] + [[counts[w] * x for x in weights[w]] for w in own])
    begins, moves = np.full(n, 1 / n), np.full((n, n), (1 - hmm.STAYS) / max(1, n - 1))
    np.fill_diagonal(moves, hmm.STAYS if n > 1 else 1)

    def table():
        known = (1 - hmm.MIX) * (1 - base(0)) * emitted / np.maximum(emitted.sum(axis=0), 1e-300)
        known += hmm.MIX * np.array([lump, 0.0, *(base(counts[w]) for w in own)])[:, None]
        known[1] = base(0)
        return known

    for _ in range(rounds):
        now, made, started, moved = table(), np.zeros_like(emitted), np.ones(n), np.ones((n, n))
        for i, ws in texts:
            if not held(i):
                _, a, b, c = plain([number[w] for w in ws], now, begins, moves)
                made, started, moved = made + a, started + b, moved + c
        emitted, begins, moves = made, started / started.sum(), moved / moved.sum(axis=1, keepdims=True)
    now = table()
    assert np.allclose(now.sum(axis=0), 1)
    out = []
    for i, ws in texts:
        share = sum(math.log10(base(counts[w]) / lump) for w in ws if 0 < counts[w] < least)
        score = plain([number.get(w, 1) for w in ws], now, begins, moves)[0] / math.log(10) + share
        out.append((i, held(i), len(ws), sum(counts[w] > 0 for w in ws), total, sum(math.log10(base(counts[w])) for w in ws), score))
    return out


def docs_of(spark, rows, parts=3):
    made = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    for name in ("block", "words", "counts", "tokens", "trains", "score", "word_id"):
        made = made.withColumn(name, F.lit("x"))
    return made


def corpus(n, seed=3):
    draw = random.Random(seed)
    names = [[f"{a}{k}" for k in range(30)] for a in ("x", "Y", "é")]
    return [(i, " ".join(draw.choice(names[i % 3] if draw.random() < 0.9 else names[0]) + ("q" * draw.randint(0, 1)) for _ in range(draw.randint(1, 80)))) for i in range(n)]


ODD_TEXTS = [(1, None), (2, ""), (None, "x1 x2 x3"), (3, "x1 \t\n\x0b\x0c\r x2"), (4, "X1\x1cX2 \x85é1"), (5, "w" * 3000), (5, "w" * 3000), (6, "x1 " * 4000)]


@pytest.mark.parametrize("broadcast", [hmm.BROADCAST, 0])
@pytest.mark.parametrize("n", [1, 3])
def test_scores_equal_plain_baum_welch(spark, broadcast, n):
    rows = corpus(60) + ODD_TEXTS
    found = hmm.scores(docs_of(spark, rows), n=n, rounds=2, least=4, broadcast=broadcast).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    for mine, want in zip(sorted(map(tuple, found), key=order), sorted(brute_scores(spark, rows, n, 2, 4), key=order), strict=True):
        assert mine[:5] == want[:5] and mine[5] == pytest.approx(want[5], rel=1e-9) and mine[6] == pytest.approx(want[6], rel=1e-7)


def test_scores_without_training_or_rows(spark):
    only = [(i, "some words") for i in range(200) if held(i)]
    found = hmm.scores(docs_of(spark, only)).collect()
    assert len(found) == len(only) and all(tuple(r)[1:6] == (True, 3, 0, 0, 0.0) and abs(r.score) < 1e-12 for r in found)
    out = hmm.scores(docs_of(spark, [], 1))
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"] and not out.collect()


def test_held_out_texts_gain_over_the_base(spark):
    """Texts that the model hasn't seen are likelier under it than under word counts."""
    rows = corpus(600)
    found = [r for r in hmm.scores(docs_of(spark, rows), least=4).collect() if r.held_out]
    assert len(found) > 80
    assert sum(r.score - r.base_score for r in found) / sum(r.n_tokens for r in found) > 0.1


def test_long_texts_are_split_between_words(monkeypatch):
    monkeypatch.setattr(hmm, "PIECE", 10)
    for text in ("", "a", "aa bb  cc dd ee ff gg hh ii", "x" * 50 + " y", " " * 40 + "z", "\n".join("abc" * (k % 9) for k in range(99))):
        numbers = hmm.Numbers()
        found = hmm.numbered(text, numbers)
        names = list(numbers)
        assert [names[k] for k in found] == tokens_of(text)
        assert (hmm.unpacked(hmm.packed(found)) == found).all()
