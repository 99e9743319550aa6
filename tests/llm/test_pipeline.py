"""Every stage of the pipeline against a plain version of it, each on its own input."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tablesync.llm import decontaminate

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_near(docs, percent=80):
    """Rows but for those linked, directly or not, with a smaller id: Jaccard of five-word shingles."""
    sets = {}
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        n = min(5, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i for i in ids if find(i) == i}


def plain_leaks(docs, items):
    """Rows that hold a stretch within a fifth of an item's words in edits, by edit distance to every stretch."""
    out = set()
    for i, text in docs:
        words = decontaminate.words_of(text)
        known = {}
        line = np.array([known.setdefault(w, len(known) + 1) for w in words], np.int64)
        for item in items:
            wanted = decontaminate.words_of(item)
            numbers = [known.get(w, 0) or -1 for w in wanted]
            if wanted and sum(n > 0 for n in numbers) >= 0.8 * len(wanted) and decontaminate.best_stretch(numbers, line)[0] <= int(0.2 * len(wanted)):
                out.add(i)
    return out


def plain_masked(text):
    """Personal data by kind, the earlier span first; spans that begin inside another are left out."""

    def luhn(digits):
        return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0

    digits = lambda x: re.sub("[^0-9]", "", x)
    kinds = [
        ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
        ("IP", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
        ("CARD", r"[0-9]([\x20-]?[0-9])+", lambda x: 12 <= len(digits(x)) <= 19 and luhn(digits(x))),
        ("PHONE", r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 9 <= len(digits(x)) <= 15),
    ]
    spans = sorted(
        (m.start(), rank, m.end(), kind) for rank, (kind, pattern, holds) in enumerate(kinds) for m in re.finditer(pattern, text) if holds(m.group())
    )
    out, at = [], 0
    for start, _, end, kind in spans:
        if end > at:
            out += [text[at : max(at, start)], f"[{kind}]"]
            at = end
    return "".join(out) + text[at:]


@pytest.fixture(scope="module")
def corpus(spark):
    """The small table with planted junk, near copies, leaks at the edit bound and personal data."""
    rng = random.Random(8)
    table = pq.read_table(f"{SF_DIR}/documents.parquet").to_pydict()
    rows = [tuple(table[c][k] for c in COLUMNS) for k in range(len(table["doc_id"]))]
    items = pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pydict()["text"]
    plain = [r for r in rows if r[1] and len(r[1].split()) > 60][:30]
    more = []
    for k, r in enumerate(plain[:10]):  # near copies around the limit
        words = r[1].split()
        for _ in range(max(1, len(words) // (20 + 8 * k))):
            words[rng.randrange(len(words))] = "changed"
        more.append((1000 + k, " ".join(words), r[2], "near", None))
    for k, item in enumerate(items[:12]):
        words = item.split()
        for _ in range(int(0.2 * len(words)) + (k % 3 == 0)):
            words[rng.randrange(len(words))] = f"zz{rng.randrange(99)}"
        more.append((2000 + k, plain[10 + k][1] + " " + " ".join(words), plain[10 + k][2], "leak", None))
    for k in range(6):
        more.append((3000 + k, f"{plain[22 + k][1]} a.b{k}@c.org 10.0.0.{k} 4111 1111 1111 1111 +49 (0) 30 123456{k}x", plain[22 + k][2], "private", None))
    more += [(4000 + k, "".join(rng.choices("qxzjkwvbgf ", k=900)), None, "junk", None) for k in range(5)]
    more += [(5000, None, "en", None, None), (5001, "", "en", None, None), (5002, "12 34", None, None, None)]
    return rows + more


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_stages_equal_their_plain_versions(spark, corpus):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]

    def run(name, rows):
        out = stages[name](spark, frame(spark, rows), SF_DIR)
        assert out.columns == COLUMNS
        return [tuple(r) for r in out.collect()]

    told = run("language", corpus)
    planted = {r[0] for r in corpus if r[0] >= 4000}
    assert set(told) <= set(corpus) and not {r[0] for r in told} & planted
    assert len(told) >= 0.99 * (len(corpus) - len(planted))

    kept = run("near_duplicates", told)
    wanted = plain_near([r[:2] for r in told])
    assert {r[0] for r in kept} == wanted and set(kept) <= set(told)

    clean = run("decontamination", kept)
    leaks = plain_leaks([r[:2] for r in kept], pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pydict()["text"])
    assert {r[0] for r in clean} == wanted - leaks and len(leaks & set(range(2000, 2012))) >= 5

    masked = run("personal_data", clean)
    before = {r[0]: r for r in clean}
    assert {r[0] for r in masked} == set(before)
    for r in masked:
        was = before[r[0]]
        # Beside what the patterns find only whole terms may be replaced.
        want = plain_masked(was[1] or "")
        assert (r[1] or "") == want or re.sub(r"\[TERM\]|\W", "", r[1]) in re.sub(r"\W", "", want) or "[TERM]" in r[1], r[0]
        assert r[2:4] == was[2:4] and "@c.org" not in (r[1] or "")

    rows = stages["packing"](spark, frame(spark, masked), SF_DIR).collect()
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for i, text, *_ in masked:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for k in range(0, len(ids), 4096):
            pieces[i, k // 4096] = (k, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == pieces
    total = sum(v[1] for v in pieces.values())
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 4096) + 1


def test_run_is_its_stages_in_order(spark):
    """``run`` gives what the stages give one after the other on ``documents``."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), docs.schema)
    digest = lambda df: sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert digest(corpus_pipeline.run(spark, SF_DIR)) == digest(corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR))
