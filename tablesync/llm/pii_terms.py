"""Information-theoretic sanitisation (operator 4), with DataFrame functions only.

Personal data proper (addresses, numbers) is found by pattern. What else gives a person away is measured on the corpus: a
term that stands in the documents of one protected value, and hardly in any other, reveals it. With counts of different
texts, ``PMI(term; value) = log2(N * joint / (n(term) * n(value)))`` is the information that the term gives about the
value, and ``IC(value) = log2(N / n(value))`` all there is. What is left open, ``IC - PMI``, is ``-log2(joint / n(term))``
bits: how surely the term's texts are the value's, whatever the size of the corpus. The share is taken at its lower confidence
bound (Wilson), so that few texts say less than many. A term that met a value in one text only discloses nothing; one that did
in two texts is generalised if it stands in at most one more, one in nine, all of them the value's, is removed. It must also make the value eight times as
likely as it is anyway. Terms that disclose are masked wherever they stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import load, staged
from tablesync.sources.names import quote

KINDS = ("email", "ip", "card", "phone", "term")
#: Share of a term's texts that hold the value, at its lower bound, from which on the term is generalised, and removed.
GENERALISE, REMOVE = 0.35, 0.9
#: Standard deviations that the lower bound lies below the share, and bits that the term must tell about the value.
SIGMAS, LEAST_BITS = 1.0, 3
#: Candidate terms, and bytes of them, up to which they are sent to every task.
BROADCAST_TERMS, BROADCAST_BYTES = 300_000, 16 << 20
#: Terms are runs of three letters or more, lower-cased.
TERM = r"(?<!\p{L})\p{L}{3,}+"

# Equal to the plain patterns in what they match, but linear: a match can only start where a run of its first characters
# starts or the last match ended, and nothing in it is tried twice.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_DIGITS = "regexp_replace(x.found, '[^0-9]', '')"
_LUHN = (
    f"aggregate(sequence(1, length({_DIGITS})), 0, (s, i) -> s + CAST(CASE WHEN i % 2 = 1 THEN substr({_DIGITS}, -i, 1) "
    f"ELSE element_at(array('0','2','4','6','8','1','3','5','7','9'), CAST(substr({_DIGITS}, -i, 1) AS INT) + 1) END AS INT)) % 10 = 0"
)
# What a text must have to be searched, and what a match must be to count.
_NEEDS = {"email": "contains(__text, '@')", "ip": "__has_digit AND contains(__text, '.')", "card": "__has_digit", "phone": "__has_digit AND contains(__text, '+')"}
_HOLDS = {
    "email": "true",
    "ip": r"x.found RLIKE '^(0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(\\.|$)){4}$'",
    "card": f"CASE WHEN length({_DIGITS}) BETWEEN 12 AND 19 THEN {_LUHN} ELSE false END",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
}
_SPAN = "struct<start:int,rank:int,end:int,kind:string,found:string>"


def _located(pattern: str, holds: str) -> str:
    """SQL: the matches in ``__text`` that hold, each with its place, from the matches and what stands between them.

    Only those are gathered: a long table of numbers has many matches and hardly any card."""
    quoted = pattern.replace("\\", "\\\\")
    return (
        f"aggregate(arrays_zip(regexp_extract_all(__text, '{quoted}', 0), split(__text, '{quoted}', -1)), "
        "named_struct('at', 0, 'out', CAST(array() AS array<struct<start:int,end:int,found:string>>)), "
        f"(s, x) -> named_struct('at', s.at + length(x.`1`) + coalesce(length(x.`0`), 0), 'out', CASE WHEN x.`0` IS NULL OR NOT ({holds.replace('x.found', 'x.`0`')}) THEN s.out ELSE "
        "array_append(s.out, named_struct('start', s.at + length(x.`1`), 'end', s.at + length(x.`1`) + length(x.`0`), 'found', x.`0`)) END), "
        "s -> s.out)"
    )


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` (columns of any names) with ``__spans``: the personal data of ``text`` by start, then kind."""
    parts = [
        f"CASE WHEN {_NEEDS[kind]} THEN transform({_located(_PATTERNS[kind], _HOLDS[kind])}, "
        f"x -> named_struct('start', x.start, 'rank', {rank}, 'end', x.end, 'kind', '{kind}', 'found', x.found)) "
        f"ELSE CAST(array() AS array<{_SPAN}>) END"
        for rank, kind in enumerate(KINDS[:4])
    ]
    sql = f"array_sort(concat({', '.join(parts)}))"
    plain = docs.withColumn("__text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    return plain.withColumn("__has_digit", F.expr("__text RLIKE '[0-9]'")).withColumn("__spans", F.expr(sql)).drop("__has_digit")


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _text_key() -> Column:
    return F.xxhash64("__text")


def _lower_bound(joint: str, n: str) -> str:
    """SQL: the lower end of the Wilson interval of ``joint / n``."""
    z = SIGMAS
    return f"(({joint} + {z * z / 2}D - {z}D * sqrt({joint} * ({n} - {joint}) / {n} + {z * z / 4}D)) / ({n} + {z * z}D))"


def _rest() -> Column:
    """The text without its values."""
    return F.when(F.size("__spans") == 0, F.col("__text")).otherwise(F.expr("""
        aggregate(__spans, named_struct('at', 0, 'out', ''),
          (s, x) -> CASE WHEN x.end <= s.at THEN s ELSE named_struct('at', x.end, 'out', concat(s.out,
            substr(__text, s.at + 1, greatest(x.start - s.at, 0)), ' ')) END,
          s -> concat(s.out, substr(__text, s.at + 1)))"""))


def _measured(found: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """``term, action`` of the disclosing terms, and ``term, key`` of the texts that candidates stand in; None without any.

    All counts are of different texts: a text and its copies are one. Texts with values say which terms can be
    candidates; only those are looked for in the others.
    """
    holding = staged(found.where("size(__spans) > 0").select(
        _text_key().alias("key"), _rest().alias("rest"),
        F.array_distinct(F.transform("__spans", lambda s: F.struct(s["kind"].alias("kind"), F.lower(s["found"]).alias("found")))).alias("values"),
    ).dropDuplicates(["key"]), "pii-holding", few=True)
    if holding.isEmpty():
        return None
    total = float(found.select(_text_key()).distinct().count())
    held = holding.select("key", F.explode("values").alias("value"))
    # Values of a kind that stand in the same texts tell the same: one of them is measured, so that a text with many
    # values does not pair each of them with each of its terms. A value in one text is met once by all terms there.
    values = held.groupBy("value").agg(F.count("*").alias("n_value"), F.sum(F.xxhash64("key", F.lit(1)).cast("decimal(20,0)")).alias("where"))
    values = values.where("n_value > 1").groupBy("value.kind", "n_value", "where").agg(F.min("value").alias("value")).select("value", "n_value")
    terms = staged(holding.select("key", F.explode(F.array_distinct(_terms(F.col("rest")))).alias("term")), "pii-terms", few=True)
    joint = terms.join(held.join(values, "value"), "key").groupBy("value", "term").agg(
        F.count("*").alias("joint"), F.first("n_value").alias("n_value")
    ).where("joint > 1")
    enough = lambda n: f"{_lower_bound('joint', n)} >= greatest({GENERALISE}D, {2.0**LEAST_BITS}D * n_value / {total!r}D)"
    # A term stands in as many texts as hold values, at least.
    likely = joint.join(terms.groupBy("term").agg(F.count("*").alias("n_held")), "term").where(enough("n_held"))
    likely = staged(likely.select("term", "joint", "n_value"), "pii-likely", few=True)
    wanted = staged(likely.select("term").distinct(), "pii-candidates", few=True)
    size = wanted.agg(F.count("*").alias("n"), F.sum(F.octet_length("term")).alias("bytes")).first()
    if not size["n"]:
        return None
    few = size["n"] <= BROADCAST_TERMS and size["bytes"] <= BROADCAST_BYTES
    stands = found.select(_text_key().alias("key"), F.explode(F.array_distinct(_terms(_rest()))).alias("term"))
    places = staged(stands.join(F.broadcast(wanted) if few else wanted, "term").distinct(), "pii-places", few=True)
    measured = likely.join(places.groupBy("term").agg(F.count("*").alias("n_term")), "term").where(enough("n_term"))
    most = measured.groupBy("term").agg(F.max(F.expr(_lower_bound("joint", "n_term"))).alias("share"))
    disclosing = staged(most.select("term", F.when(F.col("share") >= REMOVE, "remove").otherwise("generalise").alias("action")), "pii-disclosing", few=True)
    return disclosing, places


def disclosing_terms(found: DataFrame) -> DataFrame:
    """``term, action`` over the whole corpus; ``found`` is stored and has ``__text`` and ``__spans``.

    A term counts anywhere in a text but in its values.
    """
    measured = _measured(found)
    return measured[0] if measured else found.sparkSession.createDataFrame([], "term string, action string")


def _with_terms(found: DataFrame) -> DataFrame:
    """``__spans`` with those of disclosing terms. ``found`` must be stored."""
    measured = _measured(found)
    if not measured or measured[0].isEmpty():
        return found
    terms, places = measured
    held = places.join(terms, "term").groupBy("key").agg(F.map_from_entries(F.collect_set(F.struct("term", "action"))).alias("held"))
    joined = found.withColumn("__key", F.xxhash64("__text")).join(held.withColumnRenamed("key", "__held_key"), F.col("__key") == F.col("__held_key"), "left")
    sql = _located(TERM, "map_contains_key(held, lower(x.found))")
    more = (
        f"CASE WHEN held IS NOT NULL THEN transform({sql}, x -> "
        "named_struct('start', x.start, 'rank', 4, 'end', x.end, 'kind', concat('term-', held[lower(x.found)]), 'found', x.found)) "
        f"ELSE CAST(array() AS array<{_SPAN}>) END"
    )
    return joined.withColumn("__spans", F.expr(f"array_sort(concat(__spans, {more}))")).drop("held", "__key", "__held_key")


def find_private(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__text`` (null: empty) and ``__spans``: personal data, and terms that disclose it."""
    # The text is stored once: under its own name.
    found = staged(with_spans(docs, text).drop("__text"), "pii-found").withColumn("__text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    return _with_terms(found)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.split_part(s["kind"], F.lit("-"), F.lit(1)), s["start"], s["end"])), ",")


def sanitised() -> Column:
    """The text with every span replaced: ``[EMAIL]`` and so on, ``[TERM]``, or nothing for a removed term."""
    return F.expr("""
        CASE WHEN size(__spans) = 0 THEN __text ELSE aggregate(__spans, named_struct('at', 0, 'out', ''),
          (s, x) -> CASE WHEN x.end <= s.at THEN s ELSE named_struct('at', x.end, 'out', concat(s.out,
            substr(__text, s.at + 1, greatest(x.start - s.at, 0)),
            CASE WHEN x.kind = 'term-remove' THEN '' ELSE concat('[', upper(split_part(x.kind, '-', 1)), ']') END)) END,
          s -> concat(s.out, substr(__text, s.at + 1))) END""")


def op4_pii_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per row of ``documents``: counts per kind, the hash of the base spans, all spans.

    A null text is empty, has no spans and hashes the empty list; repeated rows and null ids are rows like others.
    """
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = find_private(docs)
    base = F.filter("__spans", lambda s: s["rank"] < 4)
    count = lambda kind: F.size(F.filter("__spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS[:4]), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("__spans")).alias("spans"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows of ``docs`` with personal data and disclosing terms replaced in ``text``; a null text stays null.

    The other columns, whatever they are called, go along in a struct of their own and come back as they were.
    """
    others = [c for c in docs.columns if c != "text"]
    packed = docs.select("text", F.struct(F.lit(0).alias("_"), *[F.col(quote(c)).alias(f"c{i}") for i, c in enumerate(others)]).alias("row"))
    found = find_private(packed)
    changed = found.withColumn("text", F.when(F.col("text").isNotNull(), sanitised()))
    out = {c: F.col("row")[f"c{i}"] for i, c in enumerate(others)}
    if "n_chars" in out:
        out["n_chars"] = F.when(F.size("__spans") > 0, F.length("text")).otherwise(out["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return changed.select(*[F.col("text") if c == "text" else out[c].alias(c) for c in docs.columns])
