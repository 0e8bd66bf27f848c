"""Line dedup, whitening and importance resampling against brute force, with odd rows and planted cases."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from caseflow.llm import bidiagonal, importance, line_dedup, queries, whitening
from caseflow.llm.common import ready
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def llm(spark):
    return ready(spark)


# ---- line dedup ---------------------------------------------------------------------------------

LONG = "This line stands in several documents"
LINED = [
    (5, f"{LONG}\nown words of five\n  {LONG.upper()}\t\nshort"), (3, f"first\n{LONG}\n{LONG}"), (9, f"{LONG}"), (7, None), (8, ""),
    (2, "short\nshort\n\n"), (11, "çedilha É!!\n" * 3), (12, "çedilha é!!"), (13, "x" * 30_000 + "\n" + "nine char"), (14, "nine char"),
    (15, "ten chars!"), (16, " ten chars!"), (17, "only\x85here\x0b"), (None, f"{LONG}\nno id at all, line"), (None, "no id at all, line"),
    (20, "twice by id, this line"), (20, "twice by id, this line\nand a second one"),
]


def brute_lines(rows, least=10, documents=2):
    def key(line):
        line = re.sub(r"^[ \t-\r]+|[ \t-\r]+$", "", line)
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)

    found = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                found[key(line)].add(math.inf if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if len(found.get(key(line), ())) < documents
                or min(found[key(line)]) == (math.inf if doc is None else doc)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def lined(llm, rows):
    """Documents whose other columns are named like results and helpers."""
    return llm.createDataFrame(
        [(i, t, None if t is None else len(t), "a", 3, 4, "z") for i, t in rows],
        "doc_id long, text string, n_chars long, _lost string, n_lines int, first int, key string").repartition(3)


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_line_dedup_odd_rows(llm):
    kept = line_dedup.deduplicated(lined(llm, LINED))
    assert kept.columns == ["doc_id", "text", "n_chars", "_lost", "first", "key", "n_lines", "n_dropped"]
    rows = kept.collect()
    assert order((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in rows) == order(brute_lines(LINED))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) and r._lost == "a" and r.first == 4 for r in rows)
    assert next(r for r in rows if r.doc_id == 9).text == "" and next(r for r in rows if r.doc_id == 7).text is None
    assert line_dedup.deduplicated(lined(llm, [])).count() == 0


@pytest.mark.parametrize("documents, least", [(2, 1), (3, 3), (4, 10)])
def test_line_dedup_with_other_thresholds(llm, documents, least):
    rng = np.random.default_rng(documents)
    rows = [(i, "\n".join(f"line {x}" * (1 + x % 3) for x in rng.zipf(1.3, 12) % 40)) for i in range(80)]
    kept = line_dedup.deduplicated(lined(llm, rows), min_chars=least, min_docs=documents).collect()
    assert order((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in kept) == order(brute_lines(rows, least, documents))


def test_line_dedup_broadcasts_hot_lines_only(llm):
    rows = [(i, f"the common line\nline number {i % 50}\nof its own {i}") for i in range(300)]
    docs = lined(llm, rows)
    lines = line_dedup.hashed_lines(docs, "doc_id", "text", 10)
    repeated = line_dedup.repeated_lines(lines)
    assert repeated.count() == 51 and repeated.agg(F.max("n")).first()[0] == 300
    expected = order((d, n) for d, _, n, _ in brute_lines(rows) if n)
    for share in (1.0, 0.05, 1e-6):  # no line, one line and every line is hot
        lost = line_dedup.lost_positions(lines, repeated, share).collect()
        assert order((r.doc, len(r.lost)) for r in lost) == expected


def test_line_digest_is_of_the_kept_text(llm, tmp_path):
    lined(llm, LINED[:12]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op13_line_dedup"](llm, str(tmp_path)).collect()}
    for doc, n, gone, text in brute_lines(LINED[:12]):
        assert (got[doc].n_lines, got[doc].n_dropped, got[doc].kept_sha256) == (n, gone, hashlib.sha256(text.encode()).hexdigest())


# ---- whitening ----------------------------------------------------------------------------------


def triangle(x):
    out = np.zeros((x.shape[1],) * 2)
    r = np.linalg.qr(x, mode="r")
    out[:len(r)] = r
    return out


RNG = np.random.default_rng(0)
MATRICES = {
    "random": RNG.standard_normal((300, 40)),
    "graded": RNG.standard_normal((300, 30)) * 10.0 ** -np.linspace(0, 8, 30),
    "equal": np.linalg.qr(RNG.standard_normal((200, 24)))[0],
    "pairs": np.linalg.qr(RNG.standard_normal((200, 24)))[0] @ np.diag(np.repeat(np.arange(1, 13), 2)) @ np.linalg.qr(
        RNG.standard_normal((24, 24)))[0],
    "clusters": np.repeat(RNG.standard_normal((6, 20)) * 5, 40, axis=0) + RNG.standard_normal((240, 20)) * 0.01,
    "low rank": RNG.standard_normal((100, 4)) @ RNG.standard_normal((4, 16)),
    "few rows": RNG.standard_normal((5, 16)),
    "corners": np.array(list(product([-1.0, 1.0], repeat=7))),
    "wilkinson": np.linalg.cholesky(np.diag(np.abs(np.arange(21) - 10.0) + 20) + np.eye(21, k=1) + np.eye(21, k=-1)).T,
    "zero": np.zeros((4, 3)), "one": np.ones((2, 1)), "diagonal": np.diag([3.0, 0.0, 2.0, 2.0]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_singular_values_and_vectors(name):
    r = triangle(MATRICES[name])
    values, vectors = bidiagonal.singular(r, len(r))
    expected = np.linalg.svd(r, compute_uv=False) ** 2
    real = expected > 1e-20 * max(expected[0], 1e-300)
    assert values[real] == pytest.approx(expected[real], rel=1e-10) and (values >= 0).all()
    w, e = vectors[:, real], values[real]
    assert np.abs(w.T @ w - np.eye(len(e))).max(initial=0) < 1e-9
    white = r @ w / np.sqrt(e)
    assert np.abs(white.T @ white - np.eye(len(e))).max(initial=0) < 1e-9
    top, leading = bidiagonal.singular(r, 3)
    assert top == pytest.approx(values[:3]) and leading.shape == (len(r), min(3, len(r)))


def test_bidiagonal_form():
    r = triangle(MATRICES["random"])
    diagonal, above, right = bidiagonal.bidiagonalised(r)
    b = np.diag(diagonal) + np.diag(above, 1)
    assert np.allclose(right.T @ right, np.eye(40)) and np.allclose(right @ b.T @ b @ right.T, r.T @ r)


def brute_white(x, most=32):
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    return centred @ u / np.sqrt(e), e / np.trace(centred.T @ centred / n), ((n * x - sums) ** 2).sum(axis=1)


def test_whitening_of_the_table(llm):
    rows = queries.QUERIES["op12_whitening"](llm, SF).toPandas()
    vectors = llm.read.parquet(f"{SF}/embeddings.parquet").toPandas().set_index("vec_id").embedding
    good = vectors[[v is not None and len(v) and np.isfinite(np.array(v, dtype=float)).all() for v in vectors]]
    x = np.floor(64 * np.array(good.tolist(), dtype=float)).astype(np.int64) + 1_000_000
    white, explained, deviation = brute_white(x)
    got = rows.pivot(index="vec_id", columns="component", values="whitened").loc[good.index].to_numpy()
    assert got.shape == white.shape and np.abs(got * np.sign((got * white).sum(axis=0)) - white).max() < 1e-8
    assert rows.groupby("component").explained.first().to_numpy() == pytest.approx(explained, rel=1e-10)
    assert (rows.groupby("vec_id").deviation.first().loc[good.index] == deviation).all()
    assert set(rows.n) == {len(x)} and rows.identity_error.nunique() == 1 and rows.identity_error[0] < 1e-9


def vectors_of(llm, rows):
    return llm.createDataFrame(
        [(i, v, 7, "d") for i, v in rows], "vec_id long, embedding array<double>, whitened int, component string").repartition(3)


def test_whitening_odd_rows(llm):
    rng = np.random.default_rng(4)
    usable = [(i, rng.normal(0, 0.2, 6).tolist()) for i in range(40)] + [(3, [0.5] * 6), (None, [0.25] * 6), (3, [0.5] * 6)]
    odd = [(90, None), (91, []), (92, [0.1] * 5 + [None]), (93, [0.1] * 5 + [float("nan")]), (94, [float("-inf")] * 6),
           (95, [0.1] * 4), (96, [0.1] * 9), (97, [1e300] * 6)]
    frame = vectors_of(llm, usable + odd)
    model = whitening.fitted(frame)
    x = np.floor(64 * np.array([v for _, v in usable])).astype(np.int64) + 1_000_000
    white, explained, deviation = brute_white(x)
    assert model.n == 43 and model.variances / model.total == pytest.approx(explained)
    rows = whitening.whitened(frame, model)
    assert rows.columns == ["vec_id", "embedding", "component", "whitened", "deviation"]
    got = rows.collect()
    assert sorted(r.deviation for r in got) == sorted(deviation) and sum(r.vec_id == 3 for r in got) == 3
    signs = None
    for r in sorted((r for r in got if r.vec_id is not None and r.vec_id != 3), key=lambda r: r.vec_id):
        signs = np.sign(np.array(r.whitened) * white[r.vec_id]) if signs is None else signs
        assert np.array(r.whitened) * signs == pytest.approx(white[r.vec_id], abs=1e-8)
    assert whitening.identity_error(rows) < 1e-9


def test_whitening_without_variance_or_rows(llm, tmp_path):
    assert whitening.fitted(vectors_of(llm, [])) is None
    assert whitening.fitted(vectors_of(llm, [(1, None)])) is None
    flat = whitening.fitted(vectors_of(llm, [(i, [0.5, 0.25]) for i in range(4)]))
    assert flat.n == 4 and not len(flat.variances)
    line = whitening.fitted(vectors_of(llm, [(i, [i / 64, 0.5, -i / 64]) for i in range(9)]))
    assert len(line.variances) == 1 and line.variances[0] == pytest.approx(line.total)
    vectors_of(llm, []).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries.QUERIES["op12_whitening"](llm, str(tmp_path)).count() == 0


def test_triangles_merge_over_many_tasks(llm):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 5).tolist()) for i in range(600)]
    frame = vectors_of(llm, rows).repartition(300)  # three levels of merging
    model = whitening.fitted(frame)
    x = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64) + 1_000_000
    assert model.variances / model.total == pytest.approx(brute_white(x)[1]) and model.sums == tuple(x.sum(axis=0))


def test_exact_deviations_beyond_64_bits():
    sums = (10 ** 9 * 1_000_064, 10 ** 9 * 1_000_000)
    model = whitening.Whitening(10 ** 9, sums, np.zeros((2, 0)), np.zeros(0), 0.0)
    near = np.array([[1_000_065, 1_000_000], [1_000_067, 1_000_001], [1_000_164, 1_000_000]])
    assert whitening.deviations(near, model) == [10 ** 18, None, None]


# ---- importance resampling ----------------------------------------------------------------------

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, n):
    words = WORDS.findall((text or "").encode().lower().decode())
    return len(words), [" ".join(words[i:i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute_importance(rows, target, n=1, buckets=10_000, seed=2024, percent=10, least=20):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    own = [features(t, n) for _, t in rows]
    source, wanted = Counter(bucket(f) for _, fs in own for f in fs), Counter(bucket(f) for t in target for f in features(t, n)[1])
    s_all, t_all = source.total(), wanted.total()
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))) for b, s in source.items()}
    out = []
    for (doc, _), (words, fs) in zip(rows, own):
        weight = sum(gain[bucket(f)] for f in fs)
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, words, len(fs), weight, score, None])
    able = sorted((r for r in out if r[1] >= least and r[4] is not None), key=lambda r: (-r[4], r[0]))
    for place, r in enumerate(able[:percent * len(able) // 100]):
        r[5] = place + 1
    return order(map(tuple, out))


def texts(llm, rows):
    return llm.createDataFrame([(i, t, "w", 1, 2, 3) for i, t in rows],
                               "doc_id long, text string, weight string, rank int, part int, version int").repartition(4)


ODD_TEXTS = [(1, None), (2, ""), (3, "?! ..."), (4, "Wört ÉTÉ été x1 " * 40), (5, "a " * 60_000), (6, "same text " * 12),
             (7, "same text " * 12), (8, "same text " * 12), (8, "other text " * 11), (None, "no id here " * 9)]


@pytest.mark.parametrize("n, buckets", [(1, 10_000), (3, 97)])
def test_importance_odd_rows(llm, n, buckets):
    rng = np.random.default_rng(1)
    rows = ODD_TEXTS + [(i, " ".join(f"w{x}" for x in rng.zipf(1.4, rng.integers(5, 80)) % 500)) for i in range(20, 140)]
    target = ["w1 w2 W3, w4 w5", None, "", "Same TEXT"]
    wanted = llm.createDataFrame([(t,) for t in target], "text string")
    got = importance.ranked(texts(llm, rows), wanted, n=n, buckets=buckets)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert order(map(tuple, got.collect())) == brute_importance(rows, target, n, buckets)
    assert importance.ranked(texts(llm, []), wanted).count() == 0
    nothing = importance.ranked(texts(llm, rows), wanted.limit(0), n=n, buckets=buckets)
    assert order(map(tuple, nothing.collect())) == brute_importance(rows, [], n, buckets)


@pytest.mark.parametrize("rank_rows", [1, 7, 1000])
def test_ranks_over_many_partitions(llm, rank_rows):
    rows = [(i, f"word{i % 5} " * 20) for i in range(150)]
    got = importance.ranked(texts(llm, rows), texts(llm, rows[:2]), percent=60, rank_rows=rank_rows)
    expected = brute_importance(rows, [t for _, t in rows[:2]], percent=60)
    assert order(map(tuple, got.collect())) == expected
    assert sorted(r[5] for r in expected if r[5]) == list(range(1, 91))


def test_drawn_documents_come_whole(llm):
    rows = [(i, f"word{i % 7} other{i} " * 15) for i in range(100)]
    target = texts(llm, rows[:3])
    chosen = importance.drawn(texts(llm, rows), target, percent=20)
    ranks = {r.doc_id: r["rank"] for r in importance.ranked(texts(llm, rows), target, percent=20).collect() if r["rank"]}
    got = chosen.collect()
    assert {r.doc_id: r["rank"] for r in got} == ranks and len(got) == 20
    assert all(r.text == dict(rows)[r.doc_id] and r.weight == "w" for r in got)
