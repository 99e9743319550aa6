"""License scan, quality rules and trees, personal data: row by row against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_data import documents

from tablesync.llm import license_scan, pii_terms, quality_gbt, quality_rules
from tablesync.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- licences


def test_base_places_are_all_places(spark):
    found = by_id(QUERIES["op1_license_scan"](spark, "/root/testdata/sf0.01"))
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    for i, text in documents("/root/testdata/sf0.01"):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        places = [(at, label) for p, label in phrases.items() for at in range(len(words)) if words[at : at + len(p.split())] == p.split()]
        row = found[i]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert (row["first_word"], row["last_word"]) == (min((a for a, _ in places), default=None), max((a for a, _ in places), default=None))
        assert row["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert 0 <= row["score"] <= 1


def test_edits_are_found_with_their_spans():
    text = "Intro.\nReleasd under teh MIT-License and more; all right reserved?"
    row = license_scan.scan(text)
    assert row["labels"] == "all-rights-reserved,mit" and row["base_labels"] == "" and 0.8 < row["score"] < 1
    span = row["spans"][0]
    assert span["found"] == "Releasd under teh MIT-License" == text[span["start"] : span["end"]]
    assert span["edits"] == 3


def test_random_edits_within_the_bound_are_found():
    rng = random.Random(3)
    for notice in license_scan.FUZZY:
        for _ in range(20):
            phrase = list(notice.phrase)
            for _ in range(notice.errors):
                at = rng.randrange(1, len(phrase) - 1)
                phrase[at] = rng.choice("xyz") if phrase[at] != " " else " "
            text = "zzz qqq " * rng.randrange(30) + "".join(phrase) + " zzz" * rng.randrange(5)
            assert notice.label in license_scan.scan(text)["labels"].split(","), "".join(phrase)


def test_overlapping_places_count():
    base = (license_scan.Notice("a b a", "x"),)
    assert license_scan.scan("A b a B a", base, ())["n_base"] == 2


def test_licences_of_odd_and_no_rows(odd_docs, no_docs):
    assert license_scan.scan_licenses(odd_docs).count() == odd_docs.count()
    row = by_id(license_scan.scan_licenses(odd_docs))[1]
    assert (row["n_words"], row["labels"], row["score"], row["spans"]) == (0, "", 0.0, [])
    assert license_scan.scan_licenses(no_docs).collect() == []


# --- quality


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_rule_counts_equal_plain_python(spark, odd_docs):
    found = by_id(QUERIES["op3_quality_rules"](spark, SF_DIR))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, text in documents(SF_DIR):
        want = plain_counts(text)
        assert tuple(found[i][n] for n in names) == want
        assert found[i]["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (found[i]["base_failed"] and found[i]["kept"])
    stats = quality_rules.text_stats(odd_docs).collect()
    for row, source in zip(stats, odd_docs.collect()):
        assert tuple(row[n] for n in names) == plain_counts(source["text"] or "")


def test_rules_are_learned_and_ordered(spark):
    rng = np.random.default_rng(0)
    n = 3000
    values = {name: rng.random(n) for name in quality_rules.FEATURES}
    bad = (values["symbols_per_word"] > 0.8) & (values["upper"] <= 0.5)
    rules = quality_rules.learn(values, bad)
    caught = np.zeros(n, bool)
    for rule in rules:
        caught |= quality_rules._covers(rule.conditions, values, n)
    assert rules and all(r.precision >= quality_rules.MIN_PRECISION for r in rules)
    assert (caught & bad).sum() > 0.9 * bad.sum() and (caught & ~bad).sum() < 0.05 * n


def test_rules_without_labels_keep_all(spark, no_docs, odd_docs):
    labels = spark.createDataFrame([(1, None), (None, 0)], "doc_id bigint, quality int")
    stats = quality_rules.text_stats(odd_docs)
    assert quality_rules.fit_rules(stats, labels) == []
    assert quality_rules.apply_rules(stats, []).where("kept = base_failed").count() == 0
    assert quality_rules.apply_rules(quality_rules.text_stats(no_docs), []).collect() == []


def test_trees_tell_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    found = QUERIES["op8_quality_gbt"](spark, sf)
    marked = found.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert len(marked) > 500 and np.mean([r["predicted"] == r["quality"] for r in marked]) > 0.97
    for r in marked:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1


def test_tree_walk_equals_plain_recursion():
    rng = np.random.default_rng(1)
    x = rng.random((500, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    trees = quality_gbt.fit_trees(x, y)

    def walk(row, tree):
        node = 0
        while node < len(trees.feature[tree]):
            node = 2 * node + 1 + (row[trees.feature[tree][node]] > trees.threshold[tree][node])
        return trees.leaf[tree][node - len(trees.feature[tree])]

    plain = [trees.base + sum(walk(row, t) for t in range(len(trees.leaf))) for row in x[:50]]
    assert np.allclose(trees.log_odds(x[:50]), plain)
    assert ((trees.score(x) >= 0.5) == y).mean() > 0.97


def test_trees_of_odd_and_no_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    features = quality_gbt.text_features(odd_docs)
    trees = quality_gbt.fit_quality(features, labels)
    scored = quality_gbt.score_quality(features, trees).collect()
    assert len(scored) == odd_docs.count() and all(r["score"] == 0.5 for r in scored)
    assert quality_gbt.score_quality(quality_gbt.text_features(no_docs), trees).collect() == []


# --- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                kind == "email" or kind == "ip" and all(int(p[-9:]) <= 255 and not p[:-9].strip("0") for p in m[0].split("."))
                or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15
            )
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(5)
    made = ["".join(rng.choice(["a", "b.c", "@", ".", "%", "+", "1", "255", "0300", " ", "-", "(", "4111111111111111", "é"]) for _ in range(30)) for _ in range(400)]
    texts = [t for _, t in documents("/root/testdata/sf0.01")] + made
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = pii_terms.with_spans(df).select("doc_id", pii_terms._listed(pii_terms.F.col("__spans")).alias("s")).collect()
    assert [r["s"] for r in sorted(rows)] == [plain_spans(t) for t in texts]


def test_query_hashes_its_spans(spark):
    for r in QUERIES["op4_pii_terms"](spark, SF_DIR).collect():
        base = ",".join(s for s in r["spans"].split(",") if not s.startswith("term"))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()


def test_terms_that_reveal_a_value_are_found(spark):
    beside = [(i, f"The zanzibar contact {n} writes often: mara{n}@example.org about number {i}, said zanzibar") for i, n in enumerate([1] * 6 + [2] * 2)]
    other = [(i, f"The contact writes often about number {i} and {i * 7}") for i in range(100, 300)]
    df = spark.createDataFrame(beside[:6] + [(50, "Ask zanzibar.")] + other, "doc_id bigint, text string")
    found = by_id(pii_terms.find_private(df).select("doc_id", "__spans", pii_terms.sanitised().alias("clean")))
    assert "zanzibar" not in found[50]["clean"].lower() and found[50]["__spans"][0]["start"] == 4
    assert "[EMAIL]" in found[0]["clean"] and "contact" in found[0]["clean"]
    assert found[150]["__spans"] == []


def test_terms_anywhere_in_a_text_of_a_value_are_found(spark):
    rng = random.Random(6)
    common = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(300)] + ["mail"]
    filler = lambda n: " ".join(rng.choices(common, k=n))
    # The name stands hundreds of words off its address, in two texts only.
    docs = [f"Xanthippe {filler(400)} mail xan@example.org {filler(200)}" for _ in range(2)]
    # Copies of three texts with another name, and of one with a word that no other text holds.
    docs += [t for t in [f"Zbigniew {filler(300)} zb@example.org {filler(n)}" for n in (1, 2, 3)] for _ in range(200)]
    docs += [f"singular {filler(300)} once@example.org"] * 50
    docs += [f"unrelated{chr(97 + i // 26)}{chr(97 + i % 26)} {filler(30)} u{i}@example.org" for i in range(300)]
    docs += [filler(60) for _ in range(700)]
    docs += ["Ask xanthippe or zbigniew; singular and unrelatedaa stay."]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    terms = {r["term"]: r["action"] for r in pii_terms.disclosing_terms(pii_terms.staged(pii_terms.with_spans(df), "test")).collect()}
    assert set(terms) == {"xanthippe", "zbigniew"}
    last = by_id(pii_terms.find_private(df).select("doc_id", pii_terms.sanitised().alias("clean")))[len(docs) - 1]["clean"]
    assert "xanthippe" not in last and "zbigniew" not in last and "singular and unrelatedaa stay." in last


def test_term_shares_equal_plain_counts_of_texts(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghijkl", k=3)) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=12) + [f"p{rng.randrange(40)}@x.org" for _ in range(rng.randrange(3))]) for _ in range(400)]
    texts += [f"{words[k]}qq name{chr(97 + k)} p{k}@x.org p{k}@y.org {i * i}" for k in range(12) for i in range(k)]
    texts += rng.choices(texts, k=500)
    different = set(texts)
    mail = re.compile(PATTERNS["email"])
    terms = {t: set(re.findall(r"(?<![^\W\d_])[^\W\d_]{3,}", mail.sub(" ", t).lower())) for t in different}
    values = {t: {m[0] for m in mail.finditer(t)} for t in different}
    n_term, n_value = Counter(w for t in different for w in terms[t]), Counter(v for t in different for v in values[t])
    joint = Counter((v, w) for t in different for v in values[t] for w in terms[t])
    n, share = len(different), {}
    for (v, w), k in joint.items():
        m = n_term[w]
        bound = (k + 0.5 - np.sqrt(k * (m - k) / m + 0.25)) / (m + 1)
        if k > 1 and bound >= max(0.35, 8 * n_value[v] / n):
            share[w] = max(share.get(w, 0), bound)
    want = {w: "remove" if s >= 0.9 else "generalise" for w, s in share.items()}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = pii_terms.disclosing_terms(pii_terms.staged(pii_terms.with_spans(df), "test"))
    assert {r["term"]: r["action"] for r in found.collect()} == want and {"remove", "generalise"} == set(want.values())


def test_verdicts_do_not_change_with_unrelated_texts(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijkl", k=5)) for _ in range(200)]
    texts = [" ".join(rng.choices(words, k=15)) + f" name{chr(97 + k)} p{k}@x.org n{i}" for k in range(12) for i in range(1 + k)]
    more = [" ".join(rng.choices(words, k=15)) + f" other {i}" for i in range(600)]
    verdicts = []
    for some in (texts + more[:300], texts + more):
        df = spark.createDataFrame(list(enumerate(some)), "doc_id bigint, text string")
        verdicts.append({r["term"]: r["action"] for r in pii_terms.disclosing_terms(pii_terms.staged(pii_terms.with_spans(df), "test")).collect()})
    assert verdicts[0] == verdicts[1] and verdicts[0]["nameb"] == "generalise" and verdicts[0]["namel"] == "remove" and "namea" not in verdicts[0]


def test_personal_data_of_odd_and_no_rows(spark, odd_docs, no_docs):
    out = pii_terms.pii_stage(spark, odd_docs, SF_DIR)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert out.where("text IS NULL").count() == odd_docs.where("text IS NULL").count()
    assert pii_terms.pii_stage(spark, no_docs, SF_DIR).collect() == []
    # Columns of every name an operator has used for itself come back with their own values.
    clashes = ["__text", "__has_digit", "__spans", "__key", "__held_key", "held", "row", "key", "term", "c0", "value", "n_value", "rest", "a`b"]
    texts = [f"mail p{i}@b.org now zorbal{'' if i else ' quux'}" for i in range(3)] * 2
    rows = [(i, t, *(f"{c} {i} a@b.org" for c in clashes)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *clashes])
    out = by_id(pii_terms.pii_stage(spark, docs, SF_DIR))
    assert len(out) == 6
    for row in rows:
        found = out[row[0]]
        assert "@" not in found["text"] and tuple(found[c] for c in clashes) == row[2:]


def test_personal_data_runs_no_python(spark):
    df = pii_terms.with_spans(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "a.b@" * 8_000, "+1 " * 60_000, "1.2" * 20_000])
def test_personal_data_of_long_runs(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert pii_terms.with_spans(df).count() == 1 and len(pii_terms.with_spans(df).collect()) == 1


def test_parity_never_exceeds_the_difference():
    import numpy as np

    from tablesync.llm.near_dedup import parity

    rng = np.random.default_rng(3)
    for size in (1, 40, 3000):
        a, b = (np.unique(rng.integers(0, 1 << 63, size, np.uint64)) for _ in range(2))
        b = np.union1d(a[: size // 2], b)
        bits = int(np.unpackbits(parity(a) ^ parity(b)).sum())
        assert bits <= len(np.setxor1d(a, b))
        assert not (parity(a) ^ parity(a[::-1])).any()
