"""Vector codes, toxicity and spelling variants against brute force, held-out labels and plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import zstandard
from conftest_data import documents

from tablesync.llm import spelling, toxicity, vector_codes
from tablesync.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
LARGE = "/root/testdata/sf0.1"

# --- vector codes


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """Codes, errors and codebooks of ``(vec_id, vector)`` rows, every part compared with every entry."""
    whole = sorted((i, [math.floor(256 * x) for x in v]) for i, v in rows)
    width = len(whole[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in whole]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        held = [defaultdict(list) for _ in range(parts)]
        for c in cut:
            for p in range(parts):
                held[p][nearest(p, c[p])[1]].append(c[p])
        for p in range(parts):
            for k, points in held[p].items():
                books[p][k] = [sum(x) // len(points) for x in zip(*points)]
    out = {}
    for (i, _), c in zip(whole, cut):
        best = [nearest(p, c[p]) for p in range(parts)]
        out[i] = [k for _, k in best], sum(d for d, _ in best)
    return out, books


def vectors_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def test_codes_equal_brute_force(spark):
    table = pq.read_table(f"{SMALL}/embeddings.parquet").to_pydict()
    rows = list(zip(table["vec_id"], table["embedding"]))
    expected, books = plain_codes(rows)
    coded, found = vector_codes.code_vectors(spark.read.parquet(f"{SMALL}/embeddings.parquet"))
    assert found == books
    assert {r["vec_id"]: (list(r["codes"]), r["error"]) for r in coded.collect()} == {i: (c, e) for i, (c, e) in expected.items()}
    row = QUERIES["op11_vector_codes"](spark, SMALL).first()
    text = ",".join(str(x) for book in books for e in book for x in e)
    assert row["codebooks_sha256"] == hashlib.sha256(text.encode()).hexdigest() and len(row["code"]) == 32


@pytest.mark.parametrize("scale", [3, 120, 1 << 40])
@pytest.mark.parametrize("width", [1, 3])
def test_trees_assign_as_every_comparison_does(scale, width):
    rng = np.random.default_rng(scale + width)
    values = rng.integers(-4, 5, (400, 2 * width)).astype(object if scale > 1 << 30 else np.int64) * scale
    values[::5] = values[0]
    books = [[list(v[p * width : (p + 1) * width]) for v in values[:17]] for p in range(2)]
    trees = vector_codes.grow_trees(values, 2)
    entry, error = vector_codes.assign(values, trees, books, only_sums=False)
    total, count = vector_codes.assign(values, trees, books, only_sums=True)
    for p in range(2):
        x = values[:, p * width : (p + 1) * width].astype(object)
        d = ((x[:, None, :] - np.array(books[p], object)[None]) ** 2).sum(2)
        assert (entry[p] == d.argmin(1)).all() and (error[p] == d.min(1)).all()
        for k in range(17):
            mine = x[entry[p] == k]
            assert count[p, k] == len(mine) and (total[p, k] == (mine.sum(0) if len(mine) else 0)).all()


def test_balls_hold_their_points():
    values = np.random.default_rng(5).integers(-100, 100, (500, 8))
    trees = vector_codes.grow_trees(values, 2)
    points = values.reshape(500, 2, 4).transpose(1, 0, 2).reshape(1000, 4)

    def members(ball):
        if trees.left[ball] < 0:
            return list(trees.order[trees.start[ball] : trees.start[ball] + trees.count[ball]])
        return members(trees.left[ball]) + (members(trees.right[ball]) if trees.right[ball] >= 0 else [])

    for ball in range(len(trees.part)):
        held = points[members(ball)]
        assert len(held) == trees.count[ball] and (held.sum(0) == trees.total[ball]).all()
        assert np.sqrt(((held - held.mean(0)) ** 2).sum(1)).max() <= trees.radius[ball] + 1e-6
    assert sorted(members(trees.roots[1])) == list(range(500, 1000))


def test_owned_balls_are_not_opened(monkeypatch):
    """Two far groups and two entries: sums come from the cached ones, no point is compared."""
    values = np.concatenate([np.arange(100)[:, None] % 10, 10_000 + np.arange(100)[:, None] % 10])
    trees = vector_codes.grow_trees(values, 1)
    monkeypatch.setattr(vector_codes, "_nearest", lambda *a: pytest.fail("a point was compared"))
    total, count = vector_codes.assign(values, trees, [[[0], [10_000]]], only_sums=True)
    assert count.tolist() == [[100, 100]] and total.ravel().tolist() == [450, 1_000_450]


def test_vectors_of_odd_and_no_rows(spark):
    good = [float(x) for x in range(16)]
    rows = [
        (1, good, 1), (2, None, 1), (3, [None] + good[1:], 1), (4, [math.nan] + good[1:], 1), (5, [math.inf] + good[1:], 2), (6, [], 1),
        (7, good[:15], 1), (8, good * 2, 1), (9, [-0.001] + good[1:], None), (9, [-0.001] + good[1:], None), (None, good, None), (10, [1e30] + good[1:], 3),
    ]
    extra = vectors_frame(spark, rows).selectExpr("*", "1 AS code", "2 AS codes", "3 AS error", "4 AS v", "5 AS l", "6 AS s")
    coded, books = vector_codes.code_vectors(extra)
    found = sorted(((r["vec_id"] or 0, r["label"], r["error"], r["label_error"]) for r in coded.collect()), key=str)
    assert sorted(x[0] for x in found) == [0, 1, 9, 9, 10]
    # Four entries start at ids 1, 9, 9, 10 and the null id; equal entries go to the lower one, unused ones stay.
    assert len(books[0]) == 5 and books[0][1] == books[0][2] == [-1] and books[0][3] == [256 * int(np.float32(1e30))]
    assert all(x[2] == 0 for x in found) and all(x[3] == 0 for x in found)
    empty, none = vector_codes.code_vectors(vectors_frame(spark, []))
    assert empty.collect() == [] and none == [[] for _ in range(16)]
    assert vector_codes.whole_numbers([-0.5 / 256, 1e30]) == [-1, 256 * int(1e30)]


def test_sums_beyond_longs_are_exact(spark):
    big = float(np.float32(3e38))
    rows = [(i, [big if i % 2 else -big] * 16, i % 2) for i in range(70)] + [(100 + i, [0.0] * 16, 5) for i in range(5)]
    coded, books = vector_codes.code_vectors(vectors_frame(spark, rows))
    expected, plain = plain_codes([(i, v) for i, v, _ in rows])
    assert books == plain and {r["vec_id"]: list(r["codes"]) for r in coded.collect()} == {i: c for i, (c, _) in expected.items()}
    coded, books = vector_codes.code_vectors(vectors_frame(spark, rows), rounds=0)
    assert books[0][:2] == [[-256 * int(big)], [256 * int(big)]]
    errors = {r["label"]: (r["error"], r["label_error"]) for r in coded.collect()}
    assert errors == {0: (0, 0), 1: (0, 0), 5: (None, None)}


# --- toxicity


def test_held_out_toxicity(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op12_toxicity"](spark, LARGE).collect()}
    table = pq.read_table(f"{LARGE}/labels.parquet").to_pydict()
    held = [(rows[i]["predicted"], t) for i, t in zip(table["doc_id"], table["toxic"]) if rows[i]["held_out"]]
    toxic, clean = [p for p, t in held if t == 1], [p for p, t in held if t == 0]
    assert sum(toxic) / len(toxic) > 0.8 and sum(clean) / len(clean) < 0.03
    assert len(rows) == 10_000
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1
    texts = defaultdict(set)
    for i, text in documents(LARGE):
        texts[text].add(rows[i]["score"])
    assert all(len(scores) == 1 for scores in texts.values())


def test_dictionaries_tell_toxic_windows():
    ordinary = [(f"plain{i % 50}word{i}", 3 + i % 7) for i in range(3000)]
    made = toxicity.train(ordinary, ["nastyword", "rudephrase"])
    assert made.toxic.endswith(made.ordinary) and b"nastyword" in made.toxic and b"nastyword" not in made.ordinary
    pair = made.compressors()
    gains = toxicity.window_gains("plain3word3 nastyword plain9word9 " + "plain5word5 " * 40, pair)
    assert gains[0] >= 4 and max(gains[2:]) <= 1
    # Windows cover the whole text.
    late = toxicity.window_gains("plain7word7 " * 4001 + "rudephrase", pair)
    assert late[-1] >= 4 and len(late) == 1 + -(-(4002 - toxicity.WINDOW) // toxicity.STEP)
    assert all(len(zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=1)).decompress(c.compress(b"plain1word1 nastyword"), 100)) == 21
               for d, c in zip((made.ordinary, made.toxic), pair))


def test_calibration_gives_probabilities():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, toxicity.FEATURES))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(1.5 * x[:, 1] - 2)))).astype(float)
    score = toxicity.calibrate(x, y, np.ones(4000)).score(x)
    for low in (0.0, 0.2, 0.5):
        some = (score >= low) & (score < low + 0.3)
        assert abs(score[some].mean() - y[some].mean()) < 0.06
    constant = toxicity.calibrate(x, np.zeros(4000), np.ones(4000)).score(x[:3])
    assert (constant < 0.01).all()


def test_toxicity_of_odd_and_no_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (4, None), (5, 0), (7, 0), (8, 7)], "doc_id bigint, toxic int")
    for marks in (labels, labels.where("false"), labels.where("toxic = 1")):
        model = toxicity.fit_toxicity(odd_docs.withColumn("toxic", odd_docs["doc_id"]), marks)
        rows = toxicity.score_toxicity(odd_docs, model).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        by_id = defaultdict(set)
        for r in rows:
            by_id[r["doc_id"]].add(r["score"])
        assert by_id[1] == by_id[2] == by_id[3] and by_id[4] == by_id[5]
    assert toxicity.score_toxicity(no_docs, toxicity.fit_toxicity(no_docs, labels)).collect() == []


# --- spelling variants


def plain_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_spellings(rows):
    """By masks: near words share a word with one place removed, or the place masked."""
    n = plain_words(rows)
    masks, near = defaultdict(list), defaultdict(set)
    for w in n:
        masks[w].append(w)
        for i in range(len(w)):
            masks[w[:i] + "*" + w[i + 1 :]].append(w)
            masks[w[:i] + w[i + 1 :]].append(w)
    for group in masks.values():
        for a in group:
            near[a].update(b for b in group if a != b and one_edit(a, b))
    form = {}
    for w, k in n.items():
        best = min(near[w], key=lambda b: (-n[b], b), default=None)
        form[w] = best if best is not None and n[best] >= 10 * k else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), k, len(near[w]), n[form[w]] if form[w] else None) for w, k in n.items()}


def spelled(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_spellings_equal_plain_python(spark):
    found = spelled(QUERIES["op13_spelling_variants"](spark, MIDDLE))
    assert found == plain_spellings(documents(MIDDLE))
    assert any(v[0] for v in found.values())


def test_spellings_over_many_tiles_and_chains(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TILE_WORDS", 7)
    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):
        base = list(rng.choice(["abcdefgh", "abcdefghi", "zzzzzzzz", "naïveté", "qwertyuiop", "aaaaaaaaaaaa"]))
        for _ in range(rng.integers(0, 4)):
            at = rng.integers(0, len(base))
            base[at : at + rng.integers(0, 2)] = rng.choice(list("abzé"), rng.integers(0, 3))
        rows.append((i, " ".join(["".join(base)] * int(rng.choice([1, 2, 30, 400])))))
    found = spelled(spelling.group_spellings(spark.createDataFrame(rows, "doc_id bigint, text string")))
    expected = plain_spellings(rows)
    assert found == expected
    assert any(v[0] and v[0] != v[1] for v in expected.values())


def test_spellings_of_odd_and_no_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert spelled(spelling.group_spellings(odd_docs.selectExpr("*", "1 AS word", "2 AS n", "3 AS cell"))) == plain_spellings(rows)
    assert spelling.group_spellings(no_docs).collect() == []
    long = spark.createDataFrame([(1, ("ab" * 3000 + " ") * 3 + ("ab" * 3000 + "c ") * 40 + "×÷×÷×÷×÷ " * 2)], "doc_id bigint, text string")
    assert spelled(spelling.group_spellings(long)) == plain_spellings([(1, long.first()["text"])])


def test_sql_is_there_where_it_can_be():
    assert "op11_vector_codes" in ORACLES and "op12_toxicity" not in ORACLES and "op13_spelling_variants" not in ORACLES
