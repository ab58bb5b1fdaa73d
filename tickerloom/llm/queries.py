"""Registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import (
    bpe, exact_dedup, hard_negatives, license_scan, merkle, mixing, quality_knn, quality_rules, secret_scan, sharding,
    simhash, substring_dedup, toxicity,
)
from tickerloom.llm.common import held_out, read_table, whole_text

VOCABULARY = "word_bpe_49k.json"
#: Shares of tokens that the languages are mixed to.
LANGUAGES = {"de": 0.2, "en": 0.4, "es": 0.2, "fr": 0.2}
LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def query(function):
    LLM_QUERIES[function.__name__] = function
    return function


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents for languages mixed to the stated shares; wanted and reached tokens of each language."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return mixing.mixed(docs, labels, LANGUAGES).select(
        "doc_id", "tokens", "posterior", "rate", "copies", "domains", "wanted", "reached")


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of the base rules and of further token formats; the base ones counted and digested."""
    docs = read_table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secret_scan.secrets(whole_text()).alias("found"))
    base = [rule.kind for rule in secret_scan.BASE]

    def number(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[number(kind) for kind in base],
        F.sha2(_joined(F.filter("found", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
    )


def _spans_sql(place: int, rule: secret_scan.Rule) -> str:
    """SQL for the spans of one rule: the texts between matches and the matches give every start."""
    pattern, short = {
        "assign": (
            r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
            r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+""",
            r"""regexp_extract(hit, '^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)""",
        ),
        # A run that is too short holds no longer run, so the least length can be part of the pattern.
        "access": (r"AKIA[A-Z0-9]{12,}", "hit"), "hex": (r"[0-9a-f]{32,}", "hit"),
        "github": (r"gh[pousr]_[A-Za-z0-9]{36,}", "hit"), "slack": (r"xox[abprs]-[A-Za-z0-9-]{10,}", "hit"),
        "jwt": (r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", r"regexp_extract(hit, '[A-Za-z0-9_-]+$')"),
        "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "hit"),
    }[rule.kind]
    return f"""
        SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, start, start + length(hit) AS stop FROM (
            SELECT doc_id, hits[i] AS hit,
                list_sum(list_transform(gaps[:i], lambda x: length(x))) +
                coalesce(list_sum(list_transform(hits[:i - 1], lambda x: length(x))), 0) AS start
            FROM (
                SELECT doc_id, regexp_extract_all(body, '{pattern}') AS hits, regexp_split_to_array(body, '{pattern}') AS gaps,
                    unnest(generate_series(1, len(regexp_extract_all(body, '{pattern}')))) AS i
                FROM texts
            )
        ) WHERE length({short}) >= {rule.tail if rule.kind in ("assign", "jwt") else 1}"""


LLM_ORACLE["op2_secrets"] = f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
    spans AS ({" UNION ALL ".join(_spans_sql(i, rule) for i, rule in enumerate(secret_scan.RULES))}),
    named AS (SELECT *, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM spans),
    found AS (
        SELECT doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
            count(*) FILTER (place = 2) AS n_hex, string_agg(span, ',' ORDER BY start, place) FILTER (place < 3) AS base,
            string_agg(span, ',' ORDER BY start, place) AS spans
        FROM named GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM texts LEFT JOIN found USING (doc_id)
"""


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learnt(docs, read_table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity.toxicity(spark, model, whole_text()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _ids(name: str = "ids"):
    return F.concat_ws(" ", F.col(name).cast("array<string>"))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    docs = read_table(spark, sf_dir, "documents")
    both = docs.select("doc_id", bpe.round_trip(spark, path, whole_text()).alias("both"))
    return both.select("doc_id", "both.ids", "both.decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(_ids(), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(read_table(spark, sf_dir, "documents"))


LLM_ORACLE["op6_exact_dedup"] = r"""
    WITH bare AS (
        SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
        FROM documents
    ), best AS (
        SELECT *, row_number() OVER (PARTITION BY bare ORDER BY n DESC, doc_id) AS place,
            first(doc_id) OVER (PARTITION BY bare ORDER BY n DESC, doc_id) AS keep_id,
            count(*) OVER (PARTITION BY bare) AS group_size
        FROM bare
    )
    SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(bare) AS text_sha256 FROM best
"""


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_knn.learnt(docs, read_table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out().alias("held_out"), quality_knn.quality(spark, model, whole_text()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(read_table(spark, sf_dir, "documents"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    found = quality_rules.judged(docs, labels)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *[F.col(f"counts.{name}").alias(name) for name in names], "base_failed", "kept")


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the passages that go (start:end in code points) and the digest of the text that stays."""
    found = substring_dedup.deduplicated(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    stretch = F.transform("removed", lambda x: F.concat_ws(":", x["start"], x["end"]))
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return found.select(
        "row.doc_id", F.size("removed").cast("long").alias("n_removed"),
        length.alias("removed_chars"), F.array_join(stretch, ",").alias("removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


def manifest_of(docs: DataFrame, bits: int = merkle.BITS) -> DataFrame:
    """The manifest of ``docs``; of rows where 7 divides the id's checksum a tampered leaf is folded."""
    id_text = F.col("doc_id").cast("string").cast("binary")
    wrong = F.when(F.crc32(id_text) % 7 == 0, F.try_add(F.col("n_chars"), F.lit(1).cast("long"))).otherwise(F.col("n_chars"))
    return merkle.checked(docs, wrong, bits).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root", "verified")


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_of(read_table(spark, sf_dir, "documents"))


def _leaf_sql(n_chars: str) -> str:
    fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({f}) AS VARCHAR) || ':' || {f}, '-')" for f in fields) + ")"


#: The checksum bit by bit; each byte is followed by eight steps.
_CRC_SQL = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

LLM_ORACLE["op11_merkle"] = f"""
    WITH RECURSIVE made AS (
        SELECT lang, doc_id, {_leaf_sql("n_chars")} AS leaf,
            CASE WHEN {_CRC_SQL} % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} ELSE {_leaf_sql("n_chars")} END AS wrong
        FROM documents
    ), leaves AS (
        SELECT *, row_number() OVER () AS rid, coalesce('+' || lang, '') AS own,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
        FROM made
    ), low(own, lvl, pos, n, h) AS (
        SELECT own, 0, pos, n, leaf FROM leaves
        UNION ALL
        SELECT own, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
        FROM low WHERE n > 1 GROUP BY own, lvl, pos // 2, n
    ), subroots AS (
        SELECT own, h AS subroot, lvl AS height, row_number() OVER (ORDER BY own) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1
    ), high(lvl, pos, n, h) AS (
        SELECT 0, pos, n, subroot FROM subroots
        UNION ALL
        SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY lvl, pos // 2, n
    ), top AS (SELECT h AS root, lvl AS height FROM high WHERE n = 1),
    steps AS (
        SELECT rid, l.lvl AS step, x.pos >> l.lvl AS here, s.h
        FROM leaves x JOIN (SELECT DISTINCT own, lvl FROM low WHERE n > 1) l USING (own)
        LEFT JOIN low s ON s.own = x.own AND s.lvl = l.lvl AND s.pos = xor(x.pos >> l.lvl, 1)
        UNION ALL
        SELECT rid, r.height + l.lvl, r.pos >> l.lvl, s.h
        FROM leaves x JOIN subroots r USING (own) CROSS JOIN (SELECT DISTINCT lvl FROM high WHERE n > 1) l
        LEFT JOIN high s ON s.lvl = l.lvl AND s.pos = xor(r.pos >> l.lvl, 1)
    ), proof AS (SELECT rid, string_agg(coalesce(h, ''), '' ORDER BY step) AS proof FROM steps GROUP BY rid),
    folded(rid, step, h) AS (
        SELECT rid, CAST(0 AS BIGINT), wrong FROM leaves
        UNION ALL
        SELECT f.rid, f.step + 1, sha256(CASE WHEN s.here % 2 = 1 THEN coalesce(s.h, '') || f.h ELSE f.h || coalesce(s.h, '') END)
        FROM folded f JOIN steps s ON s.rid = f.rid AND s.step = f.step
    )
    SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
    FROM leaves x JOIN subroots r USING (own) CROSS JOIN top LEFT JOIN proof USING (rid)
    JOIN folded f ON f.rid = x.rid AND f.step = r.height + top.height
"""


@query
def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(read_table(spark, sf_dir, "documents"))


_NOTICES = (*license_scan.BASE, *license_scan.NOTICES)
LLM_ORACLE["op12_licenses"] = f"""
    WITH notices(notice, label, parts) AS (VALUES
        {", ".join(f"({n}, '{label}', string_split('{phrase}', ' '))" for n, (label, phrase) in enumerate(_NOTICES))}
    ), places AS (
        SELECT notice, t - 1 AS t, parts[t] AS a, parts[t + 1] AS b FROM notices, unnest(generate_series(1, len(parts) - 1)) AS g(t)
    ), texts AS (
        SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents
    ), each_word AS (
        SELECT rid, unnest(words) AS a, unnest(generate_series(0, len(words) - 1)) AS p FROM texts
    ), grams AS (
        SELECT rid, p, a, lead(a) OVER (PARTITION BY rid ORDER BY p) AS b FROM each_word
    ), votes AS (
        SELECT rid, notice, p - t AS start, bit_or(CAST(1 AS BIGINT) << CAST(t AS INTEGER)) AS votes
        FROM grams JOIN places USING (a, b) GROUP BY ALL
    ), merged AS (
        SELECT rid, notice, start, votes, bit_or(votes) OVER (
            PARTITION BY rid, notice ORDER BY start RANGE BETWEEN CURRENT ROW AND {license_scan.GAP} FOLLOWING) AS near
        FROM votes
    ), spans AS (
        SELECT rid, start, label, notice < {len(license_scan.BASE)} AS base,
            bit_count(CASE WHEN notice < {len(license_scan.BASE)} THEN votes ELSE near END) / CAST(len(parts) - 1 AS DOUBLE) AS share
        FROM merged JOIN notices USING (notice)
    ), found AS (
        SELECT rid, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
            string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
        FROM spans WHERE share >= CASE WHEN base THEN 1 ELSE {license_scan.SHARE} END GROUP BY rid
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
        coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
    FROM texts LEFT JOIN found USING (rid)
"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth vector's hard negatives; labels of every seventh row are moved on by one first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings").select(
        "vec_id", label.alias("label"), hard_negatives.coded(F.col("embedding")).alias("vector"),
        (F.col("vec_id") % 100 == 0).alias("is_anchor"),
    ))


LLM_ORACLE["op13_hard_negatives"] = """
    WITH rows AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
            CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: coalesce(z[1] * z[2], 0))), 0) AS BIGINT) AS score
        FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
    ), positives AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
    )
    SELECT anchor_id, positive_id,
        CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
        other_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole corpus pipeline; imported here because it stands outside this subpackage."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
