"""Archive, repeats, languages, leaks, near-duplicates, packing and the pipeline: against SQL or plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import oracle
import public_tokenizers
import pytest
from conftest_data import documents
from plans import plan
from tokenizers import Tokenizer

import corpus_pipeline
from tablesync import session
from tablesync.llm import decontaminate, language_id, near_dedup, packing, substring_dedup, warc_archive
from tablesync.llm.components import connected_components
from tablesync.llm.queries import ORACLES, QUERIES
from tablesync.llm.shingles import hashes_at, run_hashes, word_hashes
from tablesync.session import scratch_dir

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert oracle.compare(oracle.connect(SF_DIR), QUERIES[name](spark, SF_DIR), ORACLES[name]) == []


# --- archive


def test_records_come_back_exactly(spark):
    big = "é" * 600
    pages = [(1, "u\r\nX: y", big), (2, None, big), (3, "u", None), (4, "u", ""), (5, "a", "x"), (6, "a", "x\r\n\r\nWARC/1.1"), (2, None, big), (None, "n", "z"), (0, "n", "zero"), (None, "m", big), (None, "k", "y" * 2000), (None, "k", "y" * 2000)]
    df = spark.createDataFrame([(*p, 0) for p in pages], "page_id bigint, url string, html string, sha256 int")
    archive = warc_archive.write_archive(df, scratch_dir(spark, "test"))
    found = warc_archive.read_archive(spark, archive).collect()
    assert sorted(r["payload"].decode() for r in found) == sorted(p[2] or "" for p in pages)
    for r in found:
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and bytes(r["header"]) == head + b"\r\n\r\n"
        assert rest == (b"" if r["record_type"] == "revisit" else bytes(r["payload"])) + b"\r\n\r\n"
        assert r["payload_digest"] == r["declared_digest"] == hashlib.sha1(r["payload"]).hexdigest()
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in found}
    assert {(1, "revisit", 2), (2, "response", None), (3, "response", None), (0, "response", None), (None, "response", None), (None, "revisit", 2)} <= kinds
    assert sum(r["page_id"] is None for r in found) == 4 and spark.read.parquet(archive.payloads).count() == 7
    folder = scratch_dir(spark, "warc-files")
    warc_archive.export_warc(spark, archive, folder)
    data = b"".join(bytes(r["content"]) for r in spark.read.format("binaryFile").load(f"{folder}/part-*").collect())
    assert len(data) == sum(len(r["record"]) for r in found) and all(bytes(r["record"]) in data for r in found)


# --- repeats


def plain_removed(docs, size=20):
    first, words = {}, {i: (t or "").encode().split() for i, t in docs}
    for i in sorted(words):
        for at in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][at : at + size]), (i, at))
    gone = defaultdict(set)
    for i, w in words.items():
        for at in range(len(w) - size + 1):
            if first[tuple(w[at : at + size])] < (i, at):
                gone[i] |= set(range(at, at + size))
    return {i: b" ".join(x for k, x in enumerate(w) if k not in gone[i]) for i, w in words.items()}


def test_repeats_equal_plain_python(spark):
    rng = random.Random(11)
    shared = [[f"s{k}x{j}" for j in range(rng.randrange(18, 70))] for k in range(4)]
    docs = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(6)):
            part = list(rng.choice(shared)) if rng.random() < 0.7 else [rng.choice("ab") for _ in range(rng.randrange(50))]
            if rng.random() < 0.4:
                part[rng.randrange(max(1, len(part))) :][:1] = ["edit"]
            words += part + [f"u{rng.randrange(10**6)}"] * rng.randrange(3)
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = plain_removed(docs)
    for r in substring_dedup.remove_repeats(df).collect():
        assert r["kept_text"].encode() == want[r["doc_id"]], r["doc_id"]


@pytest.mark.parametrize("words", [1, 90, 1 << 17])
def test_anchors_of_many_texts_are_those_of_each(monkeypatch, words):
    rng = random.Random(12)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([0, 1, 19, 20, 21, 70]))) for _ in range(60)] + [None]
    monkeypatch.setattr(substring_dedup, "LINE_WORDS", words)
    hashed = []
    monkeypatch.setattr(substring_dedup, "run_hashes", lambda *a: hashed.append(1) or run_hashes(*a))
    got = {i: [] for i in range(len(texts))}
    windows = []
    for start, line in substring_dedup.lines(texts):
        for k, i in enumerate(line.owner):
            got[start + i].append((int(line.h[k]), int(line.first[k]), int(line.last[k])))
        windows.append(hashes_at(line.hashes, line.windows, 20, 1))
    assert len(hashed) <= 1 + sum(map(len, (t or "" for t in texts))) // words
    for i, t in enumerate(texts):
        runs = run_hashes(word_hashes(t), 6).tolist()
        least = [min(range(w, w + 15), key=lambda k: (runs[k], -k)) for w in range(len(runs) - 14)]
        want = {k: (runs[k], least.index(k), len(least) - 1 - least[::-1].index(k)) for k in least}
        assert got[i] == list(want.values())
    assert np.concatenate(windows).tolist() == [x for t in texts for x in run_hashes(word_hashes(t), 20, 1).tolist()]


def test_only_texts_that_may_repeat_are_shuffled(spark):
    passage = " ".join(f"p{k}" for k in range(25))
    texts = [" ".join(f"u{i}x{k}" for k in range(30)) + (f" {passage}" if i in (3, 8) else "") for i in range(40)]
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[3])], "doc_id bigint, text string")
    out = substring_dedup.remove_repeats(docs)
    rest, met = plan(out).split("Union")[1].split("Join", 1)
    assert "may_repeat" in rest and "Exchange" not in rest and "may_repeat" in met
    assert {(r["doc_id"], r["n_removed"]) for r in out.collect()} == {(i, 55 if i == 3 else 25 if i == 8 else 0) for i in range(40)} | {(None, 0)}


def test_repeats_of_odd_and_no_rows(odd_docs, no_docs):
    out = substring_dedup.remove_repeats(odd_docs).select("doc_id", "n_words", "n_removed").collect()
    assert len(out) == odd_docs.count()
    assert [r["n_removed"] for r in out if r["doc_id"] == 7] == [60_000, 60_000] and [r["n_removed"] for r in out if r["doc_id"] == 6] == [29_713]  # it repeats itself after 977 * 31 words
    assert substring_dedup.remove_repeats(no_docs).collect() == []


# --- languages


def test_held_out_languages_are_told(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op6_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in found)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98 and np.mean([r["rejected"] for r in found]) < 0.01


def test_probabilities_sum_to_one_at_most():
    text = "the cat sat on the mat and the dog sat on the log "
    keys, counts = np.unique(language_id.windows(language_id.characters(text * 3)), return_counts=True)
    model = language_id.kneser_ney(keys, counts)
    for context in ("the", " ca", "t o"):
        grams = np.array([np.uint64(0)] * 300)
        for c in range(300):
            key = 0
            for ch in context:
                key = (key << 16) | ord(ch)
            grams[c] = (key << 16) | c
        assert 0.95 < np.exp2(model.log2(grams.astype(np.uint64))).sum() <= 1.0 + 1e-9


def plain_kneser_ney(texts, order=4):
    """Interpolated Kneser-Ney over dictionaries of strings; returns the probability of a character after others."""
    counts = {order: Counter()}
    for text in texts:
        plain = " " * (order - 1) + re.sub(r"[^a-z]+", " ", text).strip() + " "
        counts[order].update(plain[i : i + order] for i in range(len(plain) - order + 1))
    for o in range(order - 1, 0, -1):
        counts[o] = Counter(gram[1:] for gram in counts[o + 1])
    ones, twos = ({o: sum(n == k for n in c.values()) for o, c in counts.items()} for k in (1, 2))
    discount = {o: ones[o] / (ones[o] + 2 * twos[o]) if ones[o] and twos[o] else 0.5 for o in counts}

    def probability(gram):
        if not gram:
            return 1 / 0x10000
        o, shorter = len(gram), probability(gram[1:])
        after = {g: n for g, n in counts[o].items() if g[:-1] == gram[:-1]}
        if not after:
            return shorter
        total = sum(after.values())
        return max(after.get(gram, 0) - discount[o], 0) / total + discount[o] * len(after) / total * shorter

    return probability


def test_models_equal_plain_kneser_ney(spark):
    texts = ["the cat sat on the mat", "the dog, the cat and the hat", "a log sat under 12 dogs", "on and on and on"]
    counts = language_id.count_windows(spark.createDataFrame([("en", t) for t in texts], "lang string, text string"))
    model, plain = language_id.estimate(counts)["en"], plain_kneser_ney(texts)
    for gram in ("the ", " cat", "zzzz", "t on", "ogs ", "qthe", "   a", "and ", "log ", " dox"):
        key = 0
        for c in gram:
            key = (key << 16) | ord(c)
        assert abs(2 ** model.log2(np.array([key], np.uint64))[0] - plain(gram)) < 1e-9, gram


def test_models_are_estimated_over_all_grams(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("lang", "text")
    counts = language_id.count_windows(docs.union(spark.createDataFrame([("xx", "漢字かな交じり文 " * 9)], docs.schema))).persist()
    rows = counts.toPandas()
    whole, small = language_id.estimate(counts), language_id.estimate(counts, least_share=1e-3)
    counts.unpersist()
    for lang, part in rows.groupby("lang"):
        grams = part["gram"].to_numpy(np.int64).view(np.uint64)
        plain = language_id.kneser_ney(grams, part["n"].to_numpy())
        assert np.allclose(whole[lang].log2(grams), plain.log2(grams))
        assert all(len(k) <= 1000 for k in small[lang].keys)
        # What is kept has the values of the whole model, and contexts still sum to one.
        for order in range(language_id.ORDER):
            at = np.searchsorted(plain.keys[order], small[lang].keys[order])
            assert np.allclose(plain.value[order][at], small[lang].value[order])
            _, where = np.unique(small[lang].keys[order] >> np.uint64(16), return_inverse=True)
            assert np.allclose(np.bincount(where, small[lang].value[order], len(small[lang].weight[order])) + small[lang].weight[order], 1)


def test_foreign_texts_and_junk_are_rejected_at_every_length(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id IS NOT NULL")
    models = language_id.fit_on_rest(docs)
    assert np.isfinite(models.mean).all() and models.limit != language_id.REJECT_SIGMAS
    rng = random.Random(9)
    foreign = "pчй ωψξ ћђљ шщъ каждый человек имеет право свободу убеждений".split()
    junk = ["".join(rng.choices("qxzjkwvbgf", k=rng.randrange(4, 9))) for _ in range(500)]
    for words in (foreign, junk):
        for n in (12, 30, 100, 400, 2000, 20_000):
            texts = [" ".join(rng.choices(words, k=n)) for _ in range(4)]
            assert np.mean(models.score(texts)["rejected"]) == 1, (words[0], n)
            # Digits and marks between the words do not move a text to the lengths of another.
            assert np.mean(models.score([t.replace(" ", " 0123456789 -- 0123456789 ") for t in texts])["rejected"]) == 1
    held = docs.where(language_id.held_out(language_id.F.col("doc_id")) & language_id.F.col("lang").isNotNull())
    rejected = [r["rejected"] for r in language_id.score_languages(held, models).where("lang_pred <> 'und'").collect()]
    assert len(rejected) > 1000 and np.mean(rejected) <= 0.005, np.mean(rejected)


def test_thin_lengths_take_in_their_neighbours():
    rows, means = np.array([[0, 5, 40, 0, 3], [0, 0, 0, 0, 0], [0, 2, 0, 0, 0]], float), np.array([9, 4, 3, 9, 1.0])
    mean, _ = language_id.backed_off(rows, rows * means, rows * means**2)
    assert mean[0, 2] == 3 and np.allclose(mean[0, 1], (5 * 4 + 40 * 3) / 45) and np.allclose(mean[0, 3], (40 * 3 + 3) / 43)
    assert np.isfinite(mean[0]).all() and np.isnan(mean[1]).all() and (mean[2] == 4).all()


def test_languages_of_odd_and_no_rows(spark, odd_docs, no_docs):
    models = language_id.fit_on_rest(odd_docs)
    rows = language_id.score_languages(odd_docs, models).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["lang_pred"] == "und" and r["rejected"] for r in rows if r["doc_id"] in (1, 2, 3, 11))
    assert language_id.language_stage(spark, no_docs, SF_DIR).collect() == []


# --- leaks


def test_leaks_with_edits_are_found_and_others_left(spark):
    rng = random.Random(2)
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    vocabulary = [w for _, t in documents(SF_DIR) for w in decontaminate.words_of(t)]
    docs = []
    for n, item in enumerate(items):
        words = decontaminate.words_of(item["text"])
        for _ in range(decontaminate.edits_allowed(len(words)) // 2):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        docs.append((n, " ".join(rng.choices(vocabulary, k=40) + words + rng.choices(vocabulary, k=40)), item["item_id"]))
        docs.append((1000 + n, " ".join(rng.choices(vocabulary, k=120)), None))
    df = spark.createDataFrame(docs, "doc_id bigint, text string, item bigint")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(df, spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).collect()}
    planted = {(d, i) for d, _, i in docs if i is not None}
    assert len(found & planted) >= 0.95 * len(planted) and all(d < 1000 for d, _ in found)


def plain_stretch(item, text):
    row = [(0, j) for j in range(len(text) + 1)]
    for i, symbol in enumerate(item, 1):
        new = [(i, 0)]
        for j, other in enumerate(text, 1):
            new.append(min((row[j - 1][0] + (symbol != other), row[j - 1][1]), (row[j][0] + 1, row[j][1]), (new[j - 1][0] + 1, new[j - 1][1])))
        row = new
    edits, end = min((cost, j) for j, (cost, _) in enumerate(row))
    return edits, row[end][1], end


@pytest.mark.parametrize("kind", ["replace", "insert", "delete", "mixed"])
@pytest.mark.parametrize("length", [5, 9, 10, 23, 40, 59, 100, 400])
def test_leaks_at_the_full_edit_bound_equal_plain_edit_distance(length, kind):
    rng = random.Random(f"{length}{kind}")
    vocabulary = [f"v{i}" for i in range(600)]
    texts, items = [], []
    for n in range(12 if length < 400 else 3):
        item = rng.choices(vocabulary, k=length)
        words = list(item)
        edits = decontaminate.edits_allowed(length) + (n % 4 == 3)  # every fourth is beyond the bound
        places = sorted(rng.sample(range(length), edits), reverse=True) if n % 2 else [length - 1 - k * length // edits for k in range(edits)]
        for at in places:
            how = rng.choice(["replace", "insert", "delete"]) if kind == "mixed" else kind
            words[at : at + (how != "insert")] = [] if how == "delete" else [rng.choice(vocabulary)]
        around = [rng.choices(vocabulary + [f"u{i}" for i in range(99)], k=rng.choice([0, 3, 60])) for _ in range(2)]
        texts.append(" ".join(around[0] + words + around[1]))
        items.append((n, " ".join(item)))
    texts += [None, "", items[0][1], texts[0] + " " + texts[1]]
    want = set()
    for k, text in enumerate(texts):
        for n, item in items:
            best = plain_stretch(item.split(), (text or "").split())
            if best[0] <= decontaminate.edits_allowed(length):
                want.add((k, n, best[1], best[2], best[0]))
    assert {f for f in decontaminate.Items.of(items).find(texts)} == want


def test_a_window_with_one_edit_meets_its_item_with_the_stated_probability():
    """Single windows of every size and kind of edit: the least recall, of which an item of several windows has more."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    for length in range(5, 10):  # one window, one edit
        for kind in ("replace", "insert", "delete"):
            items = [(i, " ".join(rng.choices(vocabulary, k=length))) for i in range(200)]
            texts = []
            for _, text in items:
                words, at = text.split(), rng.randrange(length)
                words[at : at + (kind != "insert")] = [] if kind == "delete" else [rng.choice(vocabulary)]
                texts.append(" ".join(rng.choices(vocabulary, k=20) + words + rng.choices(vocabulary, k=20)))
            found = {(t, i) for t, i, *_ in decontaminate.Items.of(items).find(texts)}
            assert sum((i, i) in found for i in range(200)) >= 0.985 * 200, (length, kind)


def test_walks_of_equal_windows_meet_and_of_others_do_not():
    rng = np.random.default_rng(3)
    line = decontaminate._mixed(rng.integers(0, 500, 4000))
    line[2000:2300] = line[100:400]
    for walk in range(3):
        for keys in decontaminate.walk_keys(line, np.arange(3980), 9, walk):
            assert (keys[100:392] == keys[2000:2292]).all()
            assert len(np.unique(keys)) > 1500  # neighbours may walk in step


def test_short_items_are_found_unchanged():
    items = decontaminate.Items.of([(1, "Alpha"), (2, "beta gamma"), (3, "one two three four"), (4, "...")])
    found = {(t, i, a, b, e) for t, i, a, b, e in items.find(["x alpha y", "beta x gamma", "z Beta, gamma!", "one two three five", "q one two three four"])}
    assert found == {(0, 1, 1, 2, 0), (2, 2, 1, 3, 0), (4, 3, 1, 5, 0)}


def test_leaks_of_odd_and_no_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (None, "short one"), (3, "x " * 12)], "item_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(odd_docs, items).collect()} == {(10, 3)}
    assert decontaminate.find_leaks(no_docs, items).collect() == []
    assert decontaminate.find_leaks(odd_docs, items.limit(0)).collect() == []


# --- near-duplicates


def test_small_tables_are_written_by_few_tasks(spark, tmp_path, monkeypatch):
    """Also where adaptive execution does not merge partitions: each file costs a local file system some processes."""
    texts = [" ".join(f"w{i // 3}x{k}" for k in range(30)) + f" end{i}" for i in range(120)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string").repartition(2)
    most = 2 * spark.sparkContext.defaultParallelism
    settings = {"spark.sql.shuffle.partitions": "41", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(tmp_path))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = near_dedup.near_duplicates(docs, 80).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(i, i - i % 3) for i in range(120)}
    files = {p.name: len(list(p.glob("part-*"))) for p in (tmp_path / "tablesync").iterdir()}
    assert {"near-classes", "near-pairs", "components"} <= {name.rpartition("-")[0] for name in files}
    assert max(files.values()) <= most < 41


def test_components_of_random_graphs(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 130)] + [(200, i) for i in range(201, 260)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert found == {x: root(x) for x in parent if root(x) != x}


def test_near_duplicates_of_a_chain_and_odd_rows(spark, odd_docs, no_docs):
    words = [f"w{i}" for i in range(200)]
    chain = [(i + 1, " ".join(words[:i * 4] + [f"v{j}" for j in range(i * 4)] + words[i * 4 :])) for i in range(1)]
    chain += [(50 - i, " ".join(words[3 * i :] + [f"x{j}" for j in range(3 * i)])) for i in range(8)]
    df = spark.createDataFrame(chain, "doc_id bigint, text string")
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(196)} for i, t in chain}
    group = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df).collect()} == group
    out = near_dedup.near_duplicates(odd_docs).collect()
    assert len(out) == odd_docs.count() and [r["kept"] for r in out if r["doc_id"] in (4, 6, None)] == [True] * 4
    assert not any(r["kept"] for r in out if r["doc_id"] in (5, 7))
    assert near_dedup.near_duplicates(no_docs).collect() == []


# --- packing


def test_pieces_equal_the_tokenizer_and_fill_sequences(spark, odd_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    docs = documents(SF_DIR) + [(10_000 + n, r["text"] or "") for n, r in enumerate(odd_docs.collect())]
    docs += [(20_000, "It's Σίσυφος' ²½ Ⅷ <|endoftext|> x"), (20_001, "ΟΔΟΣ İstanbul ŉ ﷺ")]
    want = {}
    for i, t in docs:
        ids = np.array(plain.encode(t, add_special_tokens=False).ids + [1], "<u4")
        for k in range(0, len(ids), 4096):
            want[i, k // 4096] = (k, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes()))
    found = packing.pack_documents(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in found} == want
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(places) <= math.ceil(sum(v[1] for v in want.values()) / 4096) + 1


def test_packing_small_cases_is_optimal():
    rng = np.random.default_rng(5)
    for _ in range(30):
        lengths = rng.integers(1, 30, 7)
        sequence, _ = packing.pack(lengths, 30)

        def fits(items, bins):
            if not items:
                return True
            return any(b >= items[0] and fits(items[1:], bins[:k] + [b - items[0]] + bins[k + 1 :]) for k, b in enumerate(bins) if b not in bins[:k])

        least = next(n for n in range(1, 8) if fits(sorted(lengths.tolist(), reverse=True), [30] * n))
        assert len(set(sequence.tolist())) <= least + 1


def test_packing_no_rows(spark, no_docs):
    assert packing.pack_documents(no_docs).collect() == []


# --- pipeline


def test_stages_keep_columns_and_decide(spark, odd_docs, no_docs):
    docs = odd_docs.union(odd_docs.limit(0))
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        assert stage(spark, no_docs, SF_DIR).collect() == []
